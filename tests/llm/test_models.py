"""Learned scores: held-out accuracy on the given tables, and odd inputs."""

import zlib

import numpy as np
import pytest

from chartloom.llm import quality, toxicity
from tests.llm.helpers import odd_texts, table

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def marks(spark):
    rows = spark.read.parquet(f"{SF}/labels.parquet").collect()
    return {r.doc_id: (r.quality, r.toxic) for r in rows}


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_quality_held_out(spark, marks):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.quality_scores(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    held = [(r.predicted, marks[r.doc_id][0]) for r in rows if r.held_out and r.doc_id in marks]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(p == y for p, y in held) / len(held) > 0.97


def test_toxicity_held_out(spark, marks):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    chain = toxicity.learn(docs, labels.filter("doc_id % 4 != 1"))
    held = docs.filter("doc_id % 4 = 1")
    rows = [(r.p_toxic >= toxicity.THRESHOLD, marks[r.doc_id][1])
            for r in toxicity.score(held, chain).collect() if r.doc_id in marks]
    caught = [p for p, y in rows if y]
    assert sum(caught) / len(caught) > 0.85
    assert sum(p for p, y in rows if not y) / len(rows) < 0.01


def test_chain_uses_earlier_categories():
    rng = np.random.default_rng(0)
    x = (rng.random((600, 6)) < 0.4).astype(np.float32)
    first = x[:, 0]
    second = np.where(rng.random(600) < 0.1, 1 - first, first)
    chain = toxicity.train_chain(x, np.column_stack([first, second]), ("a", "b"), {})
    assert len(chain.weights[1]) == len(chain.weights[0]) + 1
    p = chain.predict(x)
    assert ((p[:, 0] > 0.5) == first).all() and ((p[:, 1] > 0.5) == second).mean() > 0.85


def test_odd_rows(spark):
    docs = table(spark, [*enumerate(odd_texts()), (None, "x"), (3, "again")])
    labels = labels_of(spark, [(0, 1, 0), (3, 0, 1), (3, 0, 1), (4, None, 1), (None, 1, 1), (999, 1, 0),
                               *((i, i % 2, 1 - i % 2) for i in range(8, 30))])
    scored = toxicity.score(docs, toxicity.learn(docs, labels)).collect()
    assert len(scored) == docs.count() and all(0 <= r.p_toxic <= 1 for r in scored)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() <= docs.count()
    rated = quality.quality_scores(docs, labels).collect()
    assert len(rated) == docs.count() and all(0 <= r.score <= 1 for r in rated)


def test_no_labels_no_documents(spark):
    docs, none = table(spark, [(1, "a"), (2, None)]), labels_of(spark, [])
    assert {r.p_toxic < 1e-3 for r in toxicity.score(docs, toxicity.learn(docs, none)).collect()} == {True}
    assert {r.score for r in quality.quality_scores(docs, none).collect()} == {0.5}
    empty = table(spark, [])
    assert toxicity.drop_toxic(empty, none).count() == 0
    assert quality.quality_scores(empty, none).count() == 0


def test_isotonic():
    centres, values = quality.isotonic(np.arange(5.0), np.ones(5), np.array([0, 1, 0, 1, 1.0]))
    assert values.tolist() == [0, 0.5, 1] and centres.tolist() == [0, 1.5, 3.5]
