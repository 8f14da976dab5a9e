"""Both classifiers against dense models of the whole fixture in one process."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.llm import quality, toxicity


def fixture(seed=4, n=260):
    rng = random.Random(seed)
    good, bad, vile = (["calm", "river", "stone", "paper", "window", "light"], ["xx", "qq1", "zz9", "!!", "##"],
                       ["vilely", "vilest", "hatefully", "scornful"])
    docs, labels = [], []
    for i in range(n):
        junk, toxic = rng.random() < 0.4, rng.random() < 0.3
        words = rng.choices(bad if junk else good, k=rng.randint(3, 40))
        words += rng.choices(vile, k=2) if toxic else []
        rng.shuffle(words)
        docs.append((i, " ".join(w.capitalize() if rng.random() < 0.2 else w for w in words) + rng.choice(["", ".", "\n"])))
        if i % 10 != 7:
            labels.append((i, 0 if junk else 1, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def pooled(points):
    """Isotonic means of (x, n, ones) by merging neighbours until none falls."""
    pools = [[x * n, n, ones] for x, n, ones in points]
    while True:
        at = next((i for i in range(len(pools) - 1)
                   if pools[i][2] / pools[i][1] >= pools[i + 1][2] / pools[i + 1][1]), None)
        if at is None:
            return [p[0] / p[1] for p in pools], [p[2] / p[1] for p in pools]
        pools[at:at + 2] = [[a + b for a, b in zip(pools[at], pools[at + 1])]]


@pytest.mark.parametrize("block", [20_000, 7])
def test_quality_against_a_dense_model(spark, monkeypatch, block):
    monkeypatch.setattr(quality, "BLOCK_ROWS", block)
    docs, labels = fixture()
    frame, marks = frames(spark, docs, labels)
    got = {r.doc_id: (r.score, r.predicted, r.held_out) for r in quality.quality_scores(frame, marks).collect()}
    fold = {r.doc_id: r.f for r in frame.select("doc_id", F.pmod(
        F.xxhash64("doc_id", F.lit(3)), F.lit(quality.FOLDS)).alias("f")).collect()}
    x = np.array([quality.statistics(t) for _, t in docs])
    spread = x.std(0)
    spread[spread < 1e-9] = 1.0
    rng = np.random.default_rng(quality.SEED)
    directions = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], quality.FEATURES))
    phases = rng.uniform(0, 2 * np.pi, quality.FEATURES)
    phi = np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((x - x.mean(0)) / spread, -4, 4) @ directions + phases)
    phi = np.column_stack([phi, np.ones(len(phi))])
    held = np.array([zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(docs))])
    y = np.full(len(docs), np.nan)
    for i, q, _ in labels:
        y[i] = q
    known = np.flatnonzero(~held & ~np.isnan(y))
    lift = np.diag([quality.PENALTY] * quality.FEATURES + [1e-9])
    fit = lambda rows: np.linalg.solve(phi[rows].T @ phi[rows] + lift, phi[rows].T @ y[rows])
    folds = np.array([fold[i] for i in range(len(docs))])
    raw = np.zeros(len(docs))
    for k in range(quality.FOLDS):
        own = known[folds[known] == k]
        raw[own] = phi[own] @ fit(known[folds[known] != k])
    bins = np.floor((np.clip(raw[known], -1, 2) + 1) * (quality.BINS / 3))
    points = [(raw[known][bins == b].mean(), (bins == b).sum(), y[known][bins == b].sum()) for b in sorted(set(bins))]
    scores = np.clip(np.interp(phi @ fit(known), *pooled(points)), 0, 1)
    for i in range(len(docs)):
        assert got[i][0] == pytest.approx(scores[i], abs=1e-6) and got[i][2] == held[i]
        assert got[i][1] == int(got[i][0] >= 0.3)


def parts(word):
    word = word.lower().strip(toxicity.EDGES.decode())
    out = {b"w" + word.encode()} if word else set()
    for n in (4, 5):
        if len(word) > n:
            out |= {b"<" + word[:n].encode(), b">" + word[-n:].encode()}
    return {zlib.crc32(p) for p in out}


def logistic(x, y):
    """Ridge logistic regression by small damped Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    ridge = np.array([toxicity.PENALTY] * (x.shape[1] - 1) + [1e-6])
    w = np.zeros(x.shape[1])
    for _ in range(300):
        p = 1 / (1 + np.exp(-x @ w))
        w -= 0.3 * np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
    return w


def test_toxicity_against_a_dense_chain(spark):
    docs, labels = fixture(9)
    frame, marks = frames(spark, docs, labels)
    chain = toxicity.learn(frame, marks, features=12)
    got = {r.doc_id: [r.p_junk, r.p_toxic, r.p_toxic_junk] for r in toxicity.score(frame, chain).collect()}
    sets = {i: set().union(*map(parts, t.split())) for i, t in docs}
    order = [r.doc_id for r in marks.orderBy(F.xxhash64(F.col("doc_id").cast("string")), F.col("doc_id").cast("string")).collect()]
    y = np.array([[q == 0, t == 1, q == 0 and t == 1] for _, q, t in sorted(labels, key=lambda r: order.index(r[0]))], float)
    every = sorted(set().union(*(sets[i] for i in order)))
    n = {f: sum(f in sets[i] for i in order) for f in every}
    chosen = []
    for c in range(3):
        total, ones = len(order), y[:, c].sum()
        chi = {f: (sum(y[k, c] for k, i in enumerate(order) if f in sets[i]) * total - n[f] * ones) ** 2
               / (n[f] * (total + 1 - n[f])) for f in every if n[f] >= toxicity.LEAST_DOCS}
        chosen += [f for f in sorted(chi, key=lambda f: (-chi[f], f))[:12] if f not in chosen]
    assert set(chain.chosen) == set(chosen)
    matrix = lambda ids: np.array([[f in sets[i] for f in chosen] for i in ids], float)
    x, fold = matrix(order), np.arange(len(order)) % toxicity.FOLDS
    unseen, weights = [], []
    for c in range(3):
        full = np.column_stack([x, *unseen])
        weights.append(logistic(full, y[:, c]))
        margin = np.zeros(len(x))
        for k in range(toxicity.FOLDS):
            w = logistic(full[fold != k], y[fold != k, c])
            margin[fold == k] = full[fold == k] @ w[:-1] + w[-1]
        unseen.append(np.clip(margin, -8, 8))
    margins, whole = [], matrix([i for i, _ in docs])
    for w in weights:
        margins.append(np.clip(np.column_stack([whole, *margins]) @ w[:-1] + w[-1], -8, 8))
    want = 1 / (1 + np.exp(-np.column_stack(margins)))
    assert np.abs(want - np.array([got[i] for i, _ in docs])).max() < 0.02
