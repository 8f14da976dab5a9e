"""A table by key in versions: a manifest names the folders of one whole state.

Rows lie in buckets by a hash of their key, each bucket of a version in a folder of its own.  A
compaction rewrites the buckets that its changes touch into new folders, leaves the others where
they are, and then adds one manifest file.  That file appears at once or not at all, so a reader
sees the version before or the one after, and a run that ends in between leaves folders that no
manifest names.  One writer at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chartloom.sources.tables import materialise

MANIFEST = "version long, buckets int, bucket int, path string"


def create_snapshots(spark: SparkSession, folder: str, buckets: int = 64) -> None:
    """An empty first version; ``buckets`` bounds what the driver holds of any version."""
    _publish(spark, folder, [(0, buckets, -1, "")])


def _publish(spark: SparkSession, folder: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{folder}/manifest")


def current(spark: SparkSession, folder: str) -> tuple[int, int, dict[int, str]]:
    """(version, number of buckets, folder of each bucket that has rows) of the newest version."""
    listed = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    newest = listed.agg(F.max("version")).first()[0]
    rows = listed.filter(F.col("version") == newest).collect()
    return newest, rows[0]["buckets"], {r["bucket"]: r["path"] for r in rows if r["bucket"] >= 0}


def read_snapshot(spark: SparkSession, folder: str, contract: StructType) -> DataFrame:
    """All rows of the newest version."""
    _, _, paths = current(spark, folder)
    reader = spark.read.schema(contract)
    return reader.parquet(*sorted(paths.values())) if paths else spark.createDataFrame([], contract)


def compact(spark: SparkSession, folder: str, changes: DataFrame, key: str, contract: StructType,
            merge: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Bring ``changes`` into the table; the buckets that were written anew.

    ``merge`` takes old and changed rows of whole keys together and gives those that stay; if
    it keeps the newest, changes may come twice and in any order.
    """
    version, buckets, paths = current(spark, folder)
    bucket = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields]
    written = materialise(changes.select(*columns).withColumn("_bucket", bucket), "changes")
    touched = sorted(r[0] for r in written.select("_bucket").distinct().collect())
    if not touched:
        return []
    old = [paths[b] for b in touched if b in paths]
    both = written.drop("_bucket")
    if old:
        both = both.unionByName(spark.read.schema(contract).parquet(*old))
    merged = merge(both).select(*columns).withColumn("_bucket", bucket)
    target = f"{folder}/data/{version + 1}-{uuid.uuid4().hex}"
    merged.repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(target)
    kept = [r[0] for r in spark.read.parquet(target).select("_bucket").distinct().collect()]
    state = {b: p for b, p in paths.items() if b not in touched} | {b: f"{target}/_bucket={b}" for b in kept}
    _publish(spark, folder, [(version + 1, buckets, b, p) for b, p in state.items()] or [
        (version + 1, buckets, -1, "")])
    return touched
