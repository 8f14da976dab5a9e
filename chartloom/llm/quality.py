"""Document quality: ridge regression on random Fourier features, calibrated.

Each text becomes a few statistics (lengths, shares of character classes, repetition).
Standardised, they are mapped to cosines with random directions and phases, whose products
approximate a Gaussian kernel.  Blocks of labelled rows are summed to normal equations, one set
per fold; a fold's prediction comes from the sum of the others, and isotonic regression on these
out-of-fold predictions, in fine bins, turns the ridge value into a probability.

Rows and cases: null and empty texts have the statistics of an empty text and are scored like
any other; labels that are null, of no document or held out teach nothing, repeated ones count
each; without training rows every score is 0.5, with one outcome only it is that outcome;
repeated rows are scored each; other columns play no part.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import arrow_pass, materialise, text_bytes, training_rows

FEATURES, FOLDS, PENALTY, SEED = 256, 5, 0.3, 11
BLOCK_ROWS, BINS = 20_000, 2000
THRESHOLD = 0.3

_CLASS = np.zeros(256, np.int64)  # other, upper, lower, digit, space, line end, beyond ASCII
for _codes, _class in ((range(65, 91), 1), (range(97, 123), 2), (range(48, 58), 3),
                       ((9, 11, 12, 13, 32), 4), ((10,), 5), (range(128, 256), 6)):
    _CLASS[list(_codes)] = _class
_SENTENCE = np.frombuffer(b".,;:'\"!?-", np.uint8)


def statistics(text: str | None) -> list[float]:
    raw = text_bytes(text)
    codes = np.frombuffer(raw, np.uint8)
    n = max(len(codes), 1)
    table = np.bincount(codes, minlength=256)
    other, upper, lower, digit, space, lines, beyond = np.bincount(
        _CLASS, weights=table, minlength=7)
    words = raw.split()
    w = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    distinct = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    rows = [r for r in raw.split(b"\n") if r.strip()]
    lines_of = Counter(rows)
    ends = sum(1 for x in words if not (x[-1:].isalnum() or x[-1] > 127))
    bare = sum(1 for x in words if len(x) == 1 and not (x.isalnum() or x[0] > 127))
    p = table[table > 0] / n
    return [
        np.log1p(len(words)), lengths.mean() if len(words) else 0.0,
        lengths.std() if len(words) else 0.0, float(lengths.max(initial=0)) ** 0.5,
        upper / max(upper + lower, 1), digit / n, (other - table[_SENTENCE].sum()) / n,
        table[_SENTENCE].sum() / n, space / n, beyond / n, ends / w, bare / w,
        len(distinct) / w, max(distinct.values(), default=0) / w,
        1 - pairs / max(len(words) - 1, 1), np.log1p(n / max(len(rows), 1)),
        1 - len(lines_of) / max(len(rows), 1),
        sum(len(r) for r, c in lines_of.items() if c > 1) / n,
        table[33] / n, float(-(p * np.log2(p)).sum()),
    ]


WIDTH = len(statistics(""))


def document_statistics(docs: DataFrame, id_col: str = "doc_id",
                        text_col: str = "text") -> DataFrame:
    """doc_id and x, the statistics of each row."""
    def make():
        def work(batch):
            rows = [statistics(t) for t in batch.column(1).to_pylist()]
            return batch.column(0), rows
        return work

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    return arrow_pass(given, make, "doc_id long, x array<double>",
                      pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))]))


class Fourier:
    """Standardised statistics to random cosines and a constant."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, features: int, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, spread
        self.directions = rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), features))
        self.phases = rng.uniform(0, 2 * np.pi, features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -4, 4)
        cosines = np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)
        return np.column_stack([cosines, np.ones(len(x))])


def _stack(column) -> np.ndarray:
    return np.array(column.to_pylist(), float).reshape(-1, WIDTH)


def normal_equations(rows: DataFrame, blocks: int, fourier: Fourier) -> dict[int, np.ndarray]:
    """fold -> the summed products of features with features and the label, from rows of
    fold, x, y.  Each block of rows sums up first; only sums are shuffled."""
    def summed(table: pa.Table) -> pa.Table:
        phi = fourier(_stack(table["x"]))
        both = np.column_stack([phi, table["y"].to_numpy()])
        matrix = phi.T @ both
        return pa.table({
            "fold": pa.array([table["fold"][0].as_py()] * len(matrix), pa.int64()),
            "i": pa.array(range(len(matrix)), pa.int64()),
            "row": pa.array(matrix.tolist(), pa.list_(pa.float64()))})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"fold": [pdf["fold"].iloc[0]], "i": [pdf["i"].iloc[0]],
                             "row": [np.sum(np.stack(pdf["row"]), 0)]})

    kind = "fold long, i long, row array<double>"
    sums = (
        rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
        .groupBy("fold", "block").applyInArrow(summed, kind)
        .groupBy("fold", "i").applyInPandas(added, kind)
    )
    out: dict[int, list] = {}
    for r in sums.collect():
        out.setdefault(r["fold"], []).append((r["i"], r["row"]))
    return {k: np.array([row for _, row in sorted(v)]) for k, v in out.items()}


def ridge(matrix: np.ndarray, penalty: float) -> np.ndarray:
    a, b = matrix[:, :-1], matrix[:, -1]
    lift = np.full(len(a), penalty)
    lift[-1] = 1e-9
    return np.linalg.solve(a + np.diag(lift), b)


def isotonic(x: np.ndarray, total: np.ndarray, ones: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pooled adjacent violators over bins in the order of x: (centres, values)."""
    pools: list[list[float]] = []
    for at, n, s in zip(x, total, ones):
        pools.append([at * n, n, s])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return (np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools]))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "quality", modulus: int = 5,
                   out: int = 0, threshold: float = THRESHOLD) -> DataFrame:
    """A row per input row: doc_id, held_out, score, predicted."""
    stats = materialise(document_statistics(docs, id_col, text_col), "statistics")
    moments = stats.agg(*[f(F.col("x")[i]) for f in (F.avg, F.stddev_pop) for i in range(WIDTH)])
    row = np.array([0.0 if v is None else v for v in moments.first()])
    spread = row[WIDTH:].copy()
    spread[spread < 1e-9] = 1.0
    fourier = Fourier(row[:WIDTH], spread, FEATURES, SEED)
    marks = labels.filter(F.col(label_col).isin(0, 1)).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
    rows = materialise(
        stats.join(marks, "doc_id")
        .filter(training_rows(F.col("doc_id"), modulus, out))
        .withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(FOLDS))), "labelled")
    total = rows.count()
    weights, centres, values = np.zeros(FEATURES + 1), np.zeros(1), np.array([0.5])
    if total:
        by_fold = normal_equations(rows, max(1, -(-total // (BLOCK_ROWS * FOLDS))), fourier)
        whole = sum(by_fold.values())
        weights = ridge(whole, PENALTY)
        others = {k: ridge(whole - m, PENALTY) for k, m in by_fold.items()}

        @F.pandas_udf("double")
        def unseen(x: pd.Series, fold: pd.Series) -> pd.Series:
            phi = fourier(np.stack(x))
            w = np.stack([others[int(k)] for k in fold])
            return pd.Series((phi * w).sum(1))

        bins = F.floor((F.greatest(F.lit(-1.0), F.least(F.lit(2.0), "raw")) + 1) * (BINS / 3))
        counted = sorted(
            rows.select(unseen("x", "fold").alias("raw"), "y").groupBy(bins.alias("bin"))
            .agg(F.avg("raw"), F.count("*"), F.sum("y")).collect())
        centres, values = isotonic(*np.array([r[1:] for r in counted], float).T)

    def make():
        def work(batch):
            raw = fourier(_stack(batch.column(1))) @ weights
            return batch.column(0), np.clip(np.interp(raw, centres, values), 0, 1)
        return work

    scored = arrow_pass(stats, make, "doc_id long, score double",
                        pa.schema([("doc_id", pa.int64()), ("score", pa.float64())]))
    return scored.select(
        "doc_id", (~training_rows(F.col("doc_id"), modulus, out)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))
