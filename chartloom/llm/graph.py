"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import materialise


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        "a", F.least("a", "m").alias("m"))
    return (
        both.join(least, "a").filter("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b != m").select(
        F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.withColumnRenamed("m", "b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, label) of every id in the links (a, b): the smallest id that it reaches.

    Large-star and small-star rounds until the links no longer change; each round aggregates
    before it shuffles and is written, so a lost executor costs no more than its own tasks.
    Self links and repeated links are allowed.
    """
    ids = links.select(F.col("a").alias("id")).unionByName(links.select(F.col("b").alias("id")))
    now, mark = links.filter("a != b").select("a", "b"), None
    while True:
        now = materialise(_small_star(_large_star(now)), "links")
        row = now.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    found = ids.distinct().join(
        now.select(F.col("a").alias("id"), F.col("b").alias("m")), "id", "left")
    return found.groupBy("id").agg(F.min(F.coalesce("m", "id")).alias("label"))
