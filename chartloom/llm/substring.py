"""Substring dedup over anchors at the positions of a difference cover.

Two equal windows of ``length`` words, wherever they begin, share a position whose remainders
by the period both lie in the cover, at most ``period - 1`` words in.  So anchors, windows of
``length - period + 1`` words hashed only at cover positions, cannot miss a repeat: six of 31
positions are hashed.  An anchor of two documents or more is extended to the full windows
around it; these alone are hashed whole, 128 bits each, and the smallest document of each is
the one that keeps its words.  Documents that repeat another word for word are decided by a
digest of all words and take no part.  Nothing lists pairs: a passage shared by a third of all
documents is aggregated before each shuffle.

Rows and cases: null texts have no words; documents with fewer words than a window lose
nothing; rows with a null id neither lose words nor count as a source; rows that repeat an id
are one document's, judged each by its own text; other columns play no part.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import (
    WordHashes, arrow_pass, materialise, rows_of, rows_without, text_bytes, window_hashes,
    word_hashes)

LENGTH, PERIOD = 50, 31
#: Perfect difference sets: each difference occurs once. Fixed values.
PERFECT = {7: (1, 2, 4), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14), 31: (1, 5, 11, 24, 25, 27)}
EMPTY = hashlib.sha256(b"").hexdigest()


def difference_cover(period: int) -> tuple[int, ...]:
    """Remainders of which two have any given difference modulo the period."""
    if period in PERFECT:
        return PERFECT[period]
    step = int(np.ceil(np.sqrt(period)))
    return tuple(sorted({*range(min(step, period)), *range(0, period, step)}))


def anchor_positions(n: int, period: int) -> np.ndarray:
    """The positions below ``n`` whose remainders are in the cover."""
    return np.flatnonzero(np.isin(np.arange(n) % period, difference_cover(period)))


def removed_words(n: int, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of ``n`` words the windows beginning at ``starts`` cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:n]) > 0


def _heads(given: DataFrame) -> DataFrame:
    def make():
        def work(batch):
            words = [text_bytes(t).split() for t in batch.column(1).to_pylist()]
            return (batch.column(0), [len(w) for w in words],
                    [hashlib.sha256(b" ".join(w)).hexdigest() for w in words])
        return work

    return arrow_pass(given, make, "doc_id long, n_words long, whole string", pa.schema(
        [("doc_id", pa.int64()), ("n_words", pa.int64()), ("whole", pa.string())]))


def _anchors(given: DataFrame, length: int, period: int) -> DataFrame:
    size = length - period + 1

    def make():
        known = WordHashes()

        def work(batch):
            ids, found = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text_bytes(text).split()
                if len(words) >= length:
                    hashes = window_hashes(word_hashes(words, known), size)
                    hashes = np.unique(hashes[anchor_positions(len(hashes), period)])
                    found.append(hashes.view(np.int64))
                    ids.append(np.full(len(hashes), doc, np.int64))
            if not found:
                return None
            return np.concatenate(found), np.concatenate(ids)
        return work

    return arrow_pass(given, make, "anchor long, doc_id long",
                      pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64())]))


def _windows(texts: DataFrame, length: int, period: int) -> DataFrame:
    """(w1, w2, doc_id) of the distinct full windows around shared anchors; the texts come
    with ``anchors``, those that are shared."""
    size = length - period + 1

    def make():
        known, other = WordHashes(), WordHashes(7)

        def work(batch):
            first, second, ids = [], [], []
            for doc, text, shared in zip(*(c.to_pylist() for c in batch.columns)):
                words = text_bytes(text).split()
                if len(words) < length:
                    continue
                hashes = word_hashes(words, known)
                short = window_hashes(hashes, size)
                at = anchor_positions(len(short), period)
                at = at[np.isin(short[at].view(np.int64), np.array(shared, np.int64))]
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, np.maximum(at - period + 1, 0), 1)
                np.add.at(edge, at + 1, -1)
                near = np.flatnonzero(np.cumsum(edge)[: len(words) - length + 1] > 0)
                one = window_hashes(hashes, length)[near]
                two = window_hashes(word_hashes(words, other), length, seed=5)[near]
                one, keep = np.unique(one, return_index=True)
                first.append(one.view(np.int64))
                second.append(two[keep].view(np.int64))
                ids.append(np.full(len(one), doc, np.int64))
            if not first:
                return None
            return np.concatenate(first), np.concatenate(second), np.concatenate(ids)
        return work

    return arrow_pass(texts, make, "w1 long, w2 long, doc_id long", pa.schema(
        [("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64())]))


def _cut(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, whole, n_removed, kept_text) of texts that come with ``gone``, the windows
    that are to go."""
    def make():
        known = WordHashes()

        def work(batch):
            whole, removed, kept = [], [], []
            for _, text, gone in zip(*(c.to_pylist() for c in batch.columns)):
                words = text_bytes(text).split()
                hashes = window_hashes(word_hashes(words, known), length)
                starts = np.flatnonzero(np.isin(hashes.view(np.int64), np.array(gone, np.int64)))
                out = removed_words(len(words), starts, length)
                whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
                removed.append(int(out.sum()))
                kept.append(b" ".join(w for w, o in zip(words, out.tolist()) if not o))
            return batch.column(0), whole, removed, kept
        return work

    return arrow_pass(
        texts, make, "doc_id long, whole string, n_removed long, kept_text binary", pa.schema(
            [("doc_id", pa.int64()), ("whole", pa.string()), ("n_removed", pa.int64()),
             ("kept_text", pa.binary())]))


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     length: int = LENGTH, period: int = PERIOD) -> tuple[DataFrame, DataFrame]:
    """Two tables: a head per row (doc_id, n_words, whole, first: the smallest id with the
    same words), and (doc_id, gone) with the hashes of the windows each document loses."""
    if not 1 <= period < length:
        raise ValueError("the period must be below the window's length")
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    heads = materialise(_heads(given), "heads")
    first = heads.groupBy("whole").agg(F.min("doc_id").alias("first"))
    heads = materialise(heads.join(first, "whole"), "heads")
    copies = materialise(
        heads.filter("doc_id > first AND n_words >= %d" % length).select("doc_id").distinct(),
        "copies")
    several = heads.groupBy("doc_id").agg(F.min("whole").alias("x"), F.max("whole").alias("y"))
    copies = materialise(
        copies.join(several.filter("x != y"), "doc_id", "left_anti"), "copies")

    own = rows_without(given, copies).filter("doc_id IS NOT NULL")
    anchors = _anchors(own, length, period)
    shared = materialise(
        anchors.groupBy("anchor").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
        .filter("x < y").select("anchor"), "anchors")
    hits = materialise(
        rows_of(anchors, shared, "anchor").groupBy("doc_id")
        .agg(F.collect_set("anchor").alias("anchors")), "hits")
    texts = rows_of(own, hits.select("doc_id")).join(hits, "doc_id")
    windows = materialise(_windows(texts.select("doc_id", "text", "anchors"), length, period),
                          "windows")
    repeated = materialise(
        windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y"))
        .filter("x < y").select("w1", "w2", F.col("x").alias("source")), "repeated")
    gone = (
        windows.join(repeated, ["w1", "w2"]).filter("doc_id > source")
        .groupBy("doc_id").agg(F.collect_set("w1").alias("gone"))
    )
    return heads, materialise(gone, "gone")


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 length: int = LENGTH, period: int = PERIOD) -> DataFrame:
    """A row per input row: doc_id, n_words, n_removed, kept_text (null where nothing went),
    whole (the digest of all words)."""
    heads, gone = repeated_windows(docs, id_col, text_col, length, period)
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    texts = rows_of(given, gone.select("doc_id")).join(gone, "doc_id")
    cut = _cut(texts.select("doc_id", "text", "gone"), length).dropDuplicates(["doc_id", "whole"])
    copy = F.coalesce((F.col("doc_id") > F.col("first")) & (F.col("n_words") >= length), F.lit(False))
    return heads.join(cut, ["doc_id", "whole"], "left").select(
        "doc_id", "n_words", "whole",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
        .cast("long").alias("n_removed"),
        F.when(copy, F.lit(b"")).when(F.col("n_removed") > 0, F.col("kept_text"))
        .alias("kept_text"))
