"""Exact dedup by a heavy-hitter split.

Every row becomes a SHA-256 digest.  Misra-Gries summaries, one per task, name the digests
that may make up more than a share of all rows; a second pass counts those exactly, and the
verified ones with their winners, at most ``2 / share`` rows, are broadcast: their copies are
decided on the map side and never shuffled.  All other digests have fewer rows than the share
each and meet in an ordinary shuffle of (digest, id).

Rows and cases: null and empty texts are one and the same text; of equal texts the largest id
stays, null ids rank last; rows that repeat an id with its text count each, one of them stays;
other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import materialise, rows_without

#: Digests with at least this share of all rows are handled on the map side.
SHARE = 0.001


def text_digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("binary"), F.lit(b"")), 256))


def misra_gries(batches: Iterator[pa.RecordBatch], counters: int) -> Iterator[pa.RecordBatch]:
    """One summary per task: any value with more than rows / (counters + 1) rows is in it,
    with a count that is too low by at most that."""
    held: dict[bytes, int] = {}
    for batch in batches:
        found = batch.column(0).value_counts()
        for value, n in zip(found.field("values").to_pylist(), found.field("counts").to_pylist()):
            held[value] = held.get(value, 0) + n
        if len(held) > counters:
            cut = sorted(held.values())[-counters - 1]
            held = {value: n - cut for value, n in held.items() if n > cut}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())],
        ["digest", "n"])


def heavy_digests(keys: DataFrame, rows: int, share: float) -> DataFrame:
    """(digest, keep_row, keep_id, group_size) of digests with at least ``share`` of all rows.

    Summaries have ``2 / share`` counters, so a digest with ``share`` of the rows keeps at least
    half of its count in their sum, and at most ``2 / share`` digests can reach that.
    """
    counters = int(2 / share)
    least = max(2.0, share * rows)
    candidates = (
        keys.select("digest")
        .mapInArrow(lambda batches: misra_gries(batches, counters), "digest binary, n long")
        .groupBy("digest").agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least / 2)
        .select("digest")
    )
    counted = (
        keys.join(F.broadcast(candidates), "digest")
        .groupBy("digest")
        .agg(F.count("*").alias("group_size"), F.max(F.struct("doc_id", "row_id")).alias("best"))
        .filter(F.col("group_size") >= least)
    )
    winners = counted.select(
        "digest", F.col("best.row_id").alias("keep_row"), F.col("best.doc_id").alias("keep_id"),
        "group_size")
    held = winners.collect()
    if len(held) > counters:
        raise ValueError(f"{len(held)} heavy digests, more than {counters}")
    return keys.sparkSession.createDataFrame(held, winners.schema)


def exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 share: float = SHARE) -> DataFrame:
    """A row per input row: doc_id, digest, keep_id, group_size, kept."""
    if not 0 < share <= 1:
        raise ValueError("share must be above 0 and at most 1")
    keys = materialise(
        docs.select(F.col(id_col).alias("doc_id"), text_digest(F.col(text_col)).alias("digest"))
        .withColumn("row_id", F.monotonically_increasing_id()), "digests")
    heavy = heavy_digests(keys, keys.count(), share)
    by_map = (
        keys.join(F.broadcast(heavy), "digest")
        .withColumn("kept", F.col("row_id") == F.col("keep_row"))
    )
    group = Window.partitionBy("digest")
    ranked = group.orderBy(F.col("doc_id").desc_nulls_last(), F.col("row_id").desc())
    by_shuffle = (
        keys.join(F.broadcast(heavy), "digest", "left_anti")
        .withColumn("kept", F.row_number().over(ranked) == 1)
        .withColumn("keep_id", F.first("doc_id").over(ranked))
        .withColumn("group_size", F.count("*").over(group))
    )
    columns = ("doc_id", "digest", "keep_id", "group_size", "kept")
    return by_map.select(*columns).unionByName(by_shuffle.select(*columns))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      share: float = SHARE) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    decided = materialise(exact_copies(docs, id_col, text_col, share), "decided")
    gone = decided.filter(~F.col("kept"))
    repeated = decided.groupBy("doc_id").count().filter("count > 1")
    if repeated.isEmpty() and gone.filter("doc_id IS NULL").isEmpty():
        return rows_without(docs, gone.select(F.col("doc_id").alias(id_col)), id_col)
    # ids that are null or repeated: rows are told apart by id and text, equal ones by nothing
    keep, digest, own = (free_name(docs, n) for n in ("keep", "digest", "own"))
    stays = decided.filter("kept").select(F.col("doc_id").alias(keep), F.col("digest").alias(digest))
    ours = docs.withColumn(own, text_digest(F.col(text_col)))
    same = (F.col(own) == F.col(digest)) & F.col(id_col).eqNullSafe(F.col(keep))
    left = ours.join(stays, same, "left_semi")
    twice = materialise(
        decided.groupBy(F.col("doc_id").alias(keep), F.col("digest").alias(digest))
        .count().filter("count > 1").select(keep, digest), "repeated")
    once = left.join(twice, same, "left_anti")
    again = left.join(twice, same, "left_semi").dropDuplicates([own])
    return once.unionByName(again).drop(own)
