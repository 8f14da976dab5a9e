"""Exact, near and substring copies against brute force."""

import hashlib
import itertools

import pytest

from chartloom.llm import exact, nearmin, substring
from tests.llm.helpers import lowered, odd_texts, table, words


def exact_rows(spark, rows, **options):
    got = exact.exact_copies(table(spark, rows), **options).collect()
    return sorted((r.doc_id, bytes(r.digest).hex(), r.keep_id, r.group_size, r.kept) for r in got)


def exact_brute(rows):
    out = []
    for d, t in rows:
        same = [e for e, u in rows if (u or "") == (t or "")]
        out.append((d, hashlib.sha256((t or "").encode()).hexdigest(), max(same), len(same), d == max(same)))
    return sorted(out)


@pytest.mark.parametrize("share", [0.001, 0.05, 1.0])
def test_exact(spark, share):
    rows = list(enumerate(odd_texts() + ["hot"] * 60 + ["warm"] * 9))
    assert exact_rows(spark, rows, share=share) == exact_brute(rows)


def test_exact_repeated_and_null_ids(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "b"), (None, "c"), (3, "d"), (3, "e"), (4, "e"), (4, "e")]
    kept = exact.exact_copies(table(spark, rows)).filter("kept").collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.group_size) for r in kept) == [
        (False, 1, 2), (False, 2, 2), (False, 3, 1), (False, 4, 3), (True, 0, 1)]
    left = exact.drop_exact_copies(table(spark, rows))
    assert sorted((r.doc_id or 0, r.text) for r in left.collect()) == [
        (0, "c"), (1, "a"), (2, "b"), (3, "d"), (4, "e")]
    assert left.columns == table(spark, rows).columns


@pytest.mark.parametrize("names", [("_d", "_digest", "_keep"), ("own", "Digest", "keep"), ("_own", "own", "__digest")])
def test_exact_drop_beside_any_columns(spark, names):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "b"), (3, "b")]
    docs = spark.createDataFrame(
        [(*r, f"x{i}", "y", "z") for i, r in enumerate(rows)], ["doc_id", "text", *names])
    left = exact.drop_exact_copies(docs)
    assert left.columns == docs.columns
    kept = sorted((r.doc_id, r.text, r[names[0]][0], r[names[1]], r[names[2]]) for r in left.collect())
    assert kept == [(1, "a", "x", "y", "z"), (3, "b", "x", "y", "z")]


def test_exact_drop(spark):
    rows = list(enumerate(odd_texts()))
    left = exact.drop_exact_copies(table(spark, rows)).collect()
    assert sorted(r.doc_id for r in left) == [r[0] for r in exact_brute(rows) if r[4]]


def test_misra_gries():
    import pyarrow as pa
    values = [b"a"] * 50 + [b"b"] * 30 + [bytes([i]) for i in range(100)]
    batches = [pa.RecordBatch.from_arrays([pa.array(values[i::7], pa.binary())], ["d"]) for i in range(7)]
    [out] = exact.misra_gries(iter(batches), 5)
    held = dict(zip(out.column(0).to_pylist(), out.column(1).to_pylist()))
    assert 50 >= held[b"a"] >= 50 - 180 / 6 and len(held) <= 5


def shingles(text):
    w = words(lowered(text))
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    label = {d: d for d in sets}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != label[b]
            label[a] = label[b] = low
    return sorted((d, len(sets[d]), label[d], label[d] == d) for d in sets)


def near_rows(spark, rows):
    got = nearmin.near_groups(table(spark, rows)).collect()
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got)


def test_near(spark):
    rows = list(enumerate(odd_texts()))
    assert near_rows(spark, rows) == near_brute(rows)


def test_near_large_groups(spark, monkeypatch):
    """Groups larger than a small node: centres, outsiders and blocks decide."""
    import random
    monkeypatch.setattr(nearmin, "SMALL", 4)
    monkeypatch.setattr(nearmin, "BLOCK", 16)
    rng = random.Random(9)
    rows = []
    for g in range(3):
        base = [f"g{g}w{rng.randrange(5000)}" for _ in range(120)]
        for i in range(70):
            text = base[:]
            for at in rng.sample(range(120), rng.randint(0, 9)):
                text[at] = f"e{g}x{i}x{at}"
            rows.append((len(rows) * 3, " ".join(text)))
    rng.shuffle(rows)
    assert near_rows(spark, rows) == near_brute(rows)
    gone = {d for d, _, _, kept in near_brute(rows) if not kept}
    left = nearmin.drop_near_copies(table(spark, rows))
    assert sorted(r.doc_id for r in left.collect()) == sorted(d for d, _ in rows if d not in gone)


def test_near_null_and_repeated_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(None, a), (5, a), (5, b), (7, a), (9, b), (11, b + " end")]
    got = nearmin.near_groups(table(spark, rows)).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(None, None), (5, 5), (7, 5), (9, 5), (11, 5)}
    assert len(got) == len(rows)


def substring_brute(rows, length=50):
    out, split = [], [(d, words(t)) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - length + 1):
            key = tuple(w[i:i + length])
            first[key] = min(first.get(key, d), d)
    for d, w in split:
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i:i + length])] < d:
                gone |= set(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("period", [31, 13, 20])
def test_substring(spark, period):
    rows = [(i * 2, t) for i, t in enumerate(odd_texts())]
    rows += [(1, rows[-4][1]), (3, " ".join(words(rows[20][1])[5:90]))]
    got = substring.drop_repeats(table(spark, rows), period=period).collect()
    mine = sorted((r.doc_id, r.n_words, r.n_removed, r.whole if r.kept_text is None else
                   hashlib.sha256(r.kept_text).hexdigest()) for r in got)
    assert mine == substring_brute(rows)


def test_covers():
    for period in range(1, 60):
        cover = substring.difference_cover(period)
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_substring_null_and_repeated_ids(spark):
    text, other = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(None, text), (4, text), (4, text), (4, other), (6, text), (8, other + " z")]
    got = substring.drop_repeats(table(spark, rows)).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [
        (0, 0), (4, 0), (4, 0), (4, 0), (6, 60), (8, 60)]


def test_empty_tables(spark):
    empty = table(spark, [])
    assert exact.exact_copies(empty).count() == 0
    assert exact.drop_exact_copies(empty).count() == 0
    assert nearmin.near_groups(empty).count() == 0
    assert nearmin.drop_near_copies(empty).count() == 0
    assert substring.drop_repeats(empty).count() == 0
