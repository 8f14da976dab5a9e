"""Katz scores against a plain model of a few texts."""

import math
import re
import zlib
from collections import Counter

import pytest

from chartloom.llm import katz

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    tokens = [[*WORDS.findall(lowered(t)), None] for _, t in rows]
    train = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2 for d, _ in rows]
    uni = Counter(w for ws, t in zip(tokens, train) if t for w in ws)
    bi = Counter(p for ws, t in zip(tokens, train) if t for p in zip(["<s>", *ws[:-1]], ws))
    n = sum(uni.values())

    def kept(counter):
        c = Counter(counter.values())
        return katz.discounts([c[r] for r in range(7)])

    k1, k2 = kept(uni), kept(bi)
    cut = lambda k, c: k[c] if c <= 5 else 1.0
    mass = sum(cut(k1, c) * c for c in uni.values()) / max(n, 1)
    scale1 = n / (n + 1) if mass > 1 - 1e-9 else 1.0
    unknown = 1 - scale1 * mass
    p1 = lambda w: scale1 * cut(k1, uni[w]) * uni[w] / n if uni[w] else unknown
    after = {}
    for (h, w), c in bi.items():
        after.setdefault(h, {})[w] = c

    def p2(h, w):
        if h not in after:
            return p1(w)
        total = sum(after[h].values())
        lost = sum((1 - cut(k2, c)) * c for c in after[h].values())
        scale = 1.0 if lost > 1e-9 * total else total / (total + 1)
        left = lost / total if lost > 1e-9 * total else 1 / (total + 1)
        if w in after[h]:
            return scale * cut(k2, after[h][w]) * after[h][w] / total
        return left / (1 - sum(p1(x) for x in after[h])) * p1(w)

    for h in after:  # exactly normalised
        assert sum(p2(h, w) for w in uni) + p2(h, "no such word") == pytest.approx(1)
    out = []
    for (d, _), ws, t in zip(rows, tokens, train):
        base = sum(math.log10((uni[w] + 1) / (n + len(uni) + 1)) for w in ws)
        score = sum(math.log10(p2(h, w)) for h, w in zip(["<s>", *ws[:-1]], ws))
        out.append((d, not t, len(ws), sum(uni[w] > 0 for w in ws), n, round(base, 6), round(score, 6)))
    return sorted(out, key=repr)


def texts():
    import random
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.8))}" for _ in range(400)]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40)))) for i in range(80)]
    return rows + [(80, None), (81, ""), (82, "W1 w1 x É"), (None, "w1 w2"), (5, "w1 w1"),
                   (83, "w1 w2"), (84, "w1 w2"), (84, "w1 w2"), (85, "w3 " * 3000)]


def got(spark, rows, schema="doc_id long, text string"):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], schema + ", row string, word string")
    return sorted(((None if r.doc_id is None else int(r.doc_id), r.held_out, r.n_tokens, r.n_known,
                    r.train_tokens, round(r.base_score, 6), round(r.score, 6))
                   for r in katz.katz_scores(frame).collect()), key=repr)


def test_scores(spark):
    assert got(spark, texts()) == brute(texts())


def test_many_buckets_and_shuffled_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 300)
    assert got(spark, texts()) == brute(texts())
    monkeypatch.setattr(katz, "VOCABULARY", 10)
    assert got(spark, texts()) == brute(texts())


def test_empty_table(spark):
    assert got(spark, []) == []


def test_no_training_text(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    [row] = got(spark, [(held, "a b")])
    assert row[1:5] == (True, 3, 0, 0) and row[6] == 0


@pytest.mark.parametrize("share", [0.4, 0.05, 1 / 2000])
def test_frequent_pairs_and_contexts(spark, monkeypatch, share):
    """A pair that is a third of the corpus, one that only held-out texts repeat, in any bucket."""
    monkeypatch.setattr(katz, "SHARE", share)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 500)
    monkeypatch.setattr(katz, "GROUP_TEXTS", 7)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = texts()[:60] + [(1000 + i, "the same " * 40) for i in range(30)]
    rows += [(held[i], "only here " * 25 + f"w{i}") for i in range(20)]
    assert got(spark, rows) == brute(rows)


def recursive(rows, order):
    """Scores of the model of an order, token by token."""
    tokens = [[*WORDS.findall(lowered(t)), None] for _, t in rows]
    train = [zlib.crc32(b"" if d is None else str(d).encode()) % 7 != 2 for d, _ in rows]
    grams = {k: Counter() for k in range(1, order + 1)}
    for ws, t in zip(tokens, train):
        for i in range(len(ws) if t else 0):
            for k in range(1, min(order, max(2, i + 2)) + 1):
                grams[k][tuple(["<s>", *ws][max(0, i + 2 - k):i + 2])] += 1
    kept = {}
    for k, counter in grams.items():
        types = Counter(counter.values())
        kept[k] = katz.discounts([types[r] for r in range(7)])
    cut = lambda k, c: kept[k][c] if c <= 5 else 1.0
    n = sum(grams[1].values())
    mass = sum(cut(1, c) * c for c in grams[1].values()) / max(n, 1)
    scale1 = n / (n + 1) if mass > 1 - 1e-9 else 1.0
    after = {k: {} for k in grams}
    for k in grams:
        for gram, c in grams[k].items():
            after[k].setdefault(gram[:-1], {})[gram[-1]] = c

    def p(context, w):
        k = len(context) + 1
        if k == 1:
            c = grams[1][w,]
            return scale1 * cut(1, c) * c / n if c else 1 - scale1 * mass
        if context not in after[k]:
            return p(context[1:], w)
        seen = after[k][context]
        total = sum(seen.values())
        lost = sum((1 - cut(k, c)) * c for c in seen.values())
        scale, left = (1.0, lost / total) if lost > 1e-9 * total else (total / (total + 1), 1 / (total + 1))
        if w in seen:
            return scale * cut(k, seen[w]) * seen[w] / total
        return left / (1 - sum(p(context[1:], x) for x in seen)) * p(context[1:], w)

    for context in list(after[order])[:20]:  # exactly normalised
        assert sum(p(context, w) for w, in grams[1]) + p(context, "no such word") == pytest.approx(1)
    scores = [sum(math.log10(p(tuple(["<s>", *ws][max(0, i + 2 - order):i + 1]), w)) for i, w in enumerate(ws))
              for ws in tokens]
    return sorted(((d, round(s, 6)) for (d, _), s in zip(rows, scores)), key=repr)


@pytest.mark.parametrize("order, share, bucket, group", [
    (2, 1 / 2000, 10**6, 5000), (3, 1 / 2000, 10**6, 5000), (3, 0.4, 300, 7), (3, 0.01, 500, 3), (4, 0.05, 200, 9)])
def test_orders(spark, monkeypatch, order, share, bucket, group):
    """Every order is evaluated recursively, whatever is hot, in any buckets and batches."""
    monkeypatch.setattr(katz, "SHARE", share)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", bucket)
    monkeypatch.setattr(katz, "GROUP_TEXTS", group)
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = texts() + [(1000 + i, "the same " * 20 + f"w{i}") for i in range(30)]
    rows += [(held[i], "only here " * 15 + f"w{i} w1 the same w2") for i in range(20)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = katz.katz_scores(frame, order=order).collect()
    assert sorted(((None if r.doc_id is None else int(r.doc_id), round(r.score, 6)) for r in found),
                  key=repr) == recursive(rows, order)


def test_counts_are_stored_by_context(spark, monkeypatch):
    """Each order has a table of its counts, and a context that is not hot lies in one bucket."""
    written = {}
    plain = katz.materialise
    monkeypatch.setattr(katz, "materialise", lambda df, name: written.setdefault(name, plain(df, name)))
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 300)
    monkeypatch.setattr(katz, "SHARE", 0.9)
    rows = [(i, t) for i, t in texts() if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    katz.katz_scores(spark.createDataFrame(rows, "doc_id long, text string"), order=3).count()
    for k in (2, 3):
        tables = written[f"counts{k}"].collect()
        places = [(tuple(c), row.bucket) for row in tables for c in katz._grams(row.grams, k)[:-1].T.tolist()]
        owners = {}
        for context, bucket in places:
            owners.setdefault(context, set()).add(bucket)
        assert len({b for _, b in places}) > 1
        assert all(len(own) == 1 for context, own in owners.items() if context != (int(katz.START),))
        total = sum(int(katz._columns(row["counts"], 2)[0].sum()) for row in tables)
        sizes = [len(WORDS.findall(lowered(t))) + 1 for _, t in rows]
        assert total == sum(sizes) - (k - 2) * len(rows)
