"""Toxicity by a classifier chain.

Features are the words of a text, their beginnings and endings, present or absent.  Those that
tell the labelled texts of a category from the others best are chosen from counts over the
whole sample.  Each category in turn gets a linear (logistic) model on these features and on
the log-odds of all earlier categories; in training these come from models that have not seen
the row (out of fold), in use from the earlier models themselves.

The models are fitted on at most ``SAMPLE`` labelled rows, those with the smallest hash of their
id: a bound on the training rows only.  Every whole text is scored.

Rows and cases: null and empty texts have no features and get what is left, the intercepts;
labels that are null, or of no document, do not count, repeated ones count once with the larger
mark; without labelled rows, or with one outcome only, a category's probability is the share of
that outcome, 0 without rows; repeated rows are scored each; other columns play no part.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import (
    arrow_pass, materialise, release_memory, slices, small_batches, text_bytes)

SAMPLE, FEATURES, FOLDS = 16_000, 128, 5
LEAST_DOCS, PENALTY, THRESHOLD = 3, 0.2, 0.4
EDGES = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

#: The categories in the order of the chain, from the marks of a label.
CATEGORIES: dict[str, str] = {
    "junk": "quality = 0",
    "toxic": "toxic = 1",
    "toxic_junk": "toxic = 1 AND quality = 0",
}


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashes of the word, its beginnings and its endings."""
    word = word.lower().strip(EDGES)
    parts = {b"w" + word} if word else set()
    for n in (4, 5):
        if len(word) > n:
            parts |= {b"<" + word[:n], b">" + word[-n:]}
    return tuple(map(zlib.crc32, parts))


#: Words of which a task remembers the features, some hundred bytes each.
REMEMBERED = 60_000


class Remembered(dict):
    """word -> the features, or only those of a choice by their number."""

    def __init__(self, chosen: dict[int, int] | None = None):
        super().__init__()
        self.chosen = chosen

    def __missing__(self, word: bytes):
        if len(self) > REMEMBERED:
            self.clear()
        found = word_features(word)
        if self.chosen is not None:
            found = tuple(self.chosen[f] for f in found if f in self.chosen)
        self[word] = found
        return found


def present(text: str | None, known: Remembered) -> set[int]:
    out: set[int] = set()
    for found in map(known.__getitem__, set(text_bytes(text).split())):
        if found:
            out.update(found)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the intercept comes last, unpenalised."""
    share = y.mean() if len(y) else 0.0
    w = np.zeros(x.shape[1] + 1)
    if share in (0.0, 1.0):
        w[-1] = 30.0 if share else -30.0
        return w
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float32)
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6
    w[-1] = np.log(share / (1 - share))
    for _ in range(12):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p) + 1e-6)[:, None].astype(np.float32)).T @ x
        step = np.linalg.solve(curve.astype(float) + np.diag(ridge), slope)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-3:
            break
    return w


@dataclass(frozen=True)
class Chain:
    names: tuple[str, ...]
    chosen: dict[int, int]
    weights: tuple[np.ndarray, ...]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """A column of probabilities per category."""
        margins: list[np.ndarray] = []
        for w in self.weights:
            full = np.column_stack([x, *margins]) if margins else x
            margins.append(np.clip(full @ w[:-1] + w[-1], -8, 8))
        return _sigmoid(np.column_stack(margins)) if margins else np.zeros((len(x), 0))


def train_chain(x: np.ndarray, marks: np.ndarray, names: tuple[str, ...],
                chosen: dict[int, int], folds: int = FOLDS) -> Chain:
    """A chain over rows ``x``; later models see out-of-fold log-odds of earlier categories."""
    fold = np.arange(len(x)) % folds
    weights, margins = [], []
    for c in range(len(names)):
        full = np.column_stack([x, *margins]) if margins else x
        y = marks[:, c].astype(float)
        weights.append(fit(full, y))
        unseen = np.zeros(len(x))
        for k in range(folds):
            w = fit(full[fold != k], y[fold != k])
            unseen[fold == k] = full[fold == k] @ w[:-1] + w[-1]
        margins.append(np.clip(unseen, -8, 8).astype(np.float32))
    return Chain(names, chosen, tuple(weights))


def _matrix(texts: list[str | None], known: Remembered, width: int) -> np.ndarray:
    x = np.zeros((len(texts), width), np.float32)
    for row, text in enumerate(texts):
        x[row, list(present(text, known))] = 1
    return x


def _sampled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
             categories: dict[str, str], sample: int) -> DataFrame:
    """(id, text, marks) of at most ``sample`` labelled documents, one for each id: that with the
    smallest text."""
    marks = F.array(*[F.coalesce(F.expr(rule), F.lit(False)).cast("int")
                      for rule in categories.values()])
    key: Column = F.col(id_col)
    rows = (
        labels.filter(key.isNotNull() & F.col("toxic").isNotNull() & F.col("quality").isNotNull())
        .groupBy(key.alias("_id")).agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
        .select("_id", marks.alias("marks"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    given = docs.select(key.alias("_id"), F.col(text_col).cast("string").alias("text"))
    least = F.min(F.struct("text", "marks")).alias("row")
    return given.join(F.broadcast(rows), "_id").groupBy(F.col("_id").alias("id")).agg(least).select(
        "id", "row.text", "row.marks")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          categories: dict[str, str] = CATEGORIES, sample: int = SAMPLE,
          features: int = FEATURES) -> Chain:
    rows = materialise(_sampled(docs, labels, id_col, text_col, categories, sample), "labelled")
    names = tuple(categories)
    width = len(names)

    def count():
        known = Remembered()

        def work(batch):
            found = [np.fromiter(present(t, known), np.int64) for t in batch.column(0).to_pylist()]
            marks = np.array(batch.column(1).to_pylist(), np.int64).reshape(-1, width)
            feature, at = np.unique(np.concatenate(found), return_inverse=True)
            row = np.repeat(np.arange(len(found)), [len(f) for f in found])
            sums = [np.bincount(at, minlength=len(feature))] + [
                np.bincount(at, weights=marks[row, c], minlength=len(feature)) for c in range(width)]
            return [feature, *(s.astype(np.int64) for s in sums)]
        return work

    columns = ["n", *(f"n{c}" for c in range(width))]
    counts = arrow_pass(
        rows.select("text", "marks"), count, "feature long, " + ", ".join(f"{c} long" for c in columns),
        pa.schema([("feature", pa.int64()), *((c, pa.int64()) for c in columns)]))
    counts = materialise(
        counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in columns])
        .filter(F.col("n") >= LEAST_DOCS), "features")
    total = rows.count()
    sums = rows.agg(*[F.coalesce(F.sum(F.col("marks")[c]), F.lit(0)) for c in range(width)]).first()
    chosen: dict[int, int] = {}
    for c, with_mark in enumerate(sums):
        if not 0 < with_mark < total:
            continue
        a, n = F.col(f"n{c}").cast("double"), F.col("n").cast("double")
        off = a * F.lit(float(total)) - n * F.lit(float(with_mark))
        chi = off * off / (n * (F.lit(float(total) + 1) - n))
        for row in counts.orderBy(chi.desc(), "feature").limit(features).select("feature").collect():
            chosen.setdefault(row[0], len(chosen))
    if not total:
        return Chain(names, chosen, tuple(np.full(i + 1, -30.0) * (np.arange(i + 1) == i)
                                          for i in range(width)))

    def pack():
        known = Remembered(chosen)

        def work(batch):
            x = _matrix(batch.column(1).to_pylist(), known, len(chosen)).astype(bool)
            return (batch.column(0), batch.column(2), [np.packbits(r).tobytes() for r in x])
        return work

    packed = arrow_pass(
        rows.select(F.col("id").cast("string"), "text", "marks"), pack,
        "id string, marks array<int>, bits binary",
        pa.schema([("id", pa.string()), ("marks", pa.list_(pa.int32())), ("bits", pa.binary())]))
    table = packed.orderBy(F.xxhash64("id"), "id", "bits").toArrow()  # at most ``sample`` ids
    bits = np.stack([np.frombuffer(b, np.uint8) for b in table["bits"].to_pylist()])
    x = np.unpackbits(bits, axis=1, count=len(chosen)).astype(np.float32)
    marks = np.array(table["marks"].to_pylist()).reshape(-1, width)
    return train_chain(x, marks, names, chosen)


def score(docs: DataFrame, chain: Chain, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """doc_id (as a long) and ``p_<category>`` of every row."""
    def make():
        known = Remembered(chain.chosen)

        def work(batch):
            p = chain.predict(_matrix(batch.column(1).to_pylist(), known, len(chain.chosen)))
            return [batch.column(0), *p.T]
        return work

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    columns = [f"p_{name}" for name in chain.names]
    return arrow_pass(
        given, make, "doc_id long, " + ", ".join(f"{c} double" for c in columns),
        pa.schema([("doc_id", pa.int64()), *((c, pa.float64()) for c in columns)]))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, with all columns."""
    chain = learn(docs, labels, id_col, text_col)
    at = chain.names.index("toxic")

    column = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(chain.chosen)
        for batch in batches:
            for rows in slices(batch):
                texts = rows.column(column).cast(pa.string()).to_pylist()
                p = chain.predict(_matrix(texts, known, len(chain.chosen)))[:, at]
                yield rows.filter(pa.array(p < threshold))
        del known
        release_memory()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)
