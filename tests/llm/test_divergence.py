"""Source divergence against dense vectors."""

import random
import re
from collections import Counter

import pytest

from chartloom.llm import divergence
from tests.llm.helpers import lowered, odd_texts, table

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    rows = [tuple(v or "" for v in r[1:]) for r in rows]
    out = []
    for lang in {r[0] for r in rows}:
        counts, documents = {}, Counter()
        for own, source, text in rows:
            if own == lang:
                terms = TERM.findall(lowered(text))
                counts.setdefault(source, Counter()).update(terms)
                documents.update(set(terms))
        kept = [t for t, d in documents.items() if d >= least]

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        apart = lambda x, y: (x - y) ** 2 // (x + y)
        q = shares(sum(counts.values(), Counter()))
        of = {s: shares(c) for s, c in counts.items()}
        for s, p in of.items():
            pairs = sorted((-sum(apart(p[t], o[t]) for t in kept), i.encode()) for i, o in of.items() if i != s)
            terms = sorted((-apart(p[t], q[t]), t.encode()) for t in kept if counts[s][t] and p[t] > q[t])[:top]
            for part, found in (("pair", pairs), ("term", terms)):
                out += [(lang, s, part, i.decode(), -v, k + 1) for k, (v, i) in enumerate(found)]
    return sorted(out)


def made_rows(seed=2):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", None]), t)
            for i, t in enumerate(odd_texts())]
    words = ["Straße", "éa", "x1y", "don't", "the", "The", "of", "über", "日本", "q_r", "W", "\x85z", "\xa0"] + [
        f"v{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    for i in range(150):
        source = rng.choice(["a"] * 5 + ["b", "c", "d", "é", None])
        lang = rng.choice(["en"] * 3 + ["de", None, "fr"])
        start = rng.randrange(30)
        rows.append((500 + i, lang, source, " ".join(rng.choices(words[start:start + 40], k=rng.randint(0, 50)))))
    rows += [(900, "none", "a", "one two"), (901, "none", "b", None), (902, "none", "c", ""), (903, "one", "x", "")]
    return rows + rows[-30:-20]


SCHEMA = "doc_id long, lang string, source string, text string"


@pytest.mark.parametrize("least,top,bits", [(10, 10, 64), (2, 3, 64), (3, 10, 7), (1, 10, 4)])
def test_divergence(spark, least, top, bits):
    rows = made_rows()
    got = divergence.divergence(table(spark, rows, SCHEMA), least, top, bits)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, least, top)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 2)
    monkeypatch.setattr(divergence, "CELLS", 20)
    rows = made_rows(4)
    got = divergence.divergence(table(spark, rows, SCHEMA), 3)
    assert sorted(map(tuple, got.collect())) == brute(rows, 3, 10)


def test_empty_and_large_counts(spark):
    assert divergence.divergence(table(spark, [], SCHEMA)).collect() == []
    n = spark.createDataFrame([(10**18, 5 * 10**17, 7)], "n long, total long, kinds long")
    [row] = n.select(divergence._share(n.n, n.n + n.total, n.kinds)).collect()
    assert row[0] == 1 + 10**9 * (10**18 + 2) // (15 * 10**17 + 14)
