"""Collocations against counting everything."""

import random
import re
from collections import Counter

import pytest

from chartloom.llm import phrases
from tests.llm.helpers import lowered, odd_texts, table


def brute(rows, least, longest, top, contained):
    out = []
    for lang in {r[1] or "und" if r[1] is None else r[1] for r in rows}:
        f, n = Counter(), 0
        for _, own, text in rows:
            if ("und" if own is None else own) != lang:
                continue
            for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(text)):
                w = re.findall("[^\x20\x09]+", piece)
                n += len(w)
                f.update(tuple(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1))
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        found = []
        for p, a in candidates.items():
            inside = any(q[i:i + len(p)] == p and 100 * b >= contained * a
                         for q, b in candidates.items() if len(q) > len(p) for i in range(len(q) - len(p) + 1))
            if not inside:
                score, _, le, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]])
                                      for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), le, r))
        out += [(lang, i + 1, p.decode(), -a, le, r, n, -s)
                for i, (s, a, p, le, r) in enumerate(sorted(found)[:top])]
    return sorted(out)


def made_rows(seed=5):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "ß\x1c", "\x01", "a\xa0b"]
    rows = [(i, rng.choice(["en", "de", None, ""]), t) for i, t in enumerate(odd_texts())]
    for i in range(120):
        words = rng.choices(vocabulary, [1 / (k + 1) for k in range(len(vocabulary))], k=rng.randint(0, 60))
        text = "".join(w + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b"]) for w in words)
        rows.append((1000 + i, rng.choice(["en", "de", None]), text.replace("w3", "W3 New York City")))
    return rows + rows[-3:]


@pytest.mark.parametrize("options", [
    (2, 3, 50, 50, 10**9), (3, 3, 2000, 80, 2_000), (2, 2, 2000, 50, 1), (1, 3, 30, 50, 50_000)])
def test_collocations(spark, options):
    least, longest, top, contained, sample = options
    rows = made_rows()
    got = phrases.collocations(table(spark, rows, "doc_id long, lang string, text string"),
                               least, longest, top, contained, sample)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, longest, top, contained)


def test_small_runs_and_flushes(spark, monkeypatch):
    """In one process: what a task does when it holds little and reads a few bytes at once."""
    import pyarrow as pa
    monkeypatch.setattr(phrases, "RUN", 7)
    monkeypatch.setattr(phrases, "RUN_BYTES", 9)
    monkeypatch.setattr(phrases, "WORDS", 15)
    held = {}
    monkeypatch.setattr(phrases, "small_batches", lambda spark: None)

    class Docs:
        sparkSession = None

        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            held["run"] = run
            return self

        def groupBy(self, *columns):
            return self

        def agg(self, *columns):
            return self

    phrases._counted(Docs(), None, None, (1, 2, 3))
    text = "a b c. A b c d e f g h i j k l m n o, p q r s t u v w x y z a b c"
    rows = [(0, "en", text), (1, "de", None), (2, "en", ""), (3, "de", text * 3), (4, "en", "longer than nine bytes")]
    batch = pa.RecordBatch.from_pydict({"lang": [r[1] for r in rows], "text": [r[2] for r in rows]})
    counts = Counter()
    for out in held["run"](iter([batch, batch])):
        for r in out.to_pylist():
            counts[r["lang"], r["phrase"]] += r["f"]
    want = Counter()
    for _, lang, t in rows * 2:
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered(t)):
            w = re.findall("[^\x20\x09]+", piece)
            want[lang, ""] += len(w)
            want.update((lang, " ".join(w[i:i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    assert +counts == +want


def test_expansion(spark):
    """A sample that proposes nothing still ends with every frequent phrase."""
    rows = [(i, "en", "new york city hall " * 3) for i in range(20)]
    docs = table(spark, rows, "doc_id long, lang string, text string")
    found = phrases.frequent_phrases(docs, 10, 3, 1)
    got = {r.phrase: r.f for r in found.collect()}
    assert got["new york city"] == 60 and got["hall new york"] == 40 and got[""] == 240
    assert phrases.collocations(docs.limit(0)).collect() == []
