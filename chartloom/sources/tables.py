"""Tables with a fixed column contract."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from chartloom.config import StreamSettings


_OWN_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, as the session's ``spark.checkpoint.dir`` names it.

    Only where the setting is absent (tests on one machine) a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_DIRS:
        _OWN_DIRS[app] = tempfile.mkdtemp(prefix="chartloom-")
    return _OWN_DIRS[app]


#: For folders of whole texts that come several times over, as parsed documents do.
COMPACT = {"compression": "zstd", "parquet.compression.codec.zstd.level": "6"}


def fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write once, read many: several results share one computation, which a lost
    executor does not undo."""
    path = fresh_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Input of few partitions over all cores, ahead of work that is heavy per row.

    A scan that already has a partition per core, as any large one has, stays as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


#: What Spark sends to a Python worker at once, where the session has not chosen a size.
BATCH_BYTES, BATCH_SETTING, USUAL_BATCH = 4_000_000, "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def small_batches(spark: SparkSession) -> None:
    """Have Spark send texts to Python in batches of a few MB, unless the session has chosen
    a size of its own.  The usual 64 MB are held several times over, by both sides.  Spark reads
    the setting when a plan runs, so it stays set for the session."""
    if spark.conf.get(BATCH_SETTING) == USUAL_BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def conform(df: DataFrame, contract: StructType) -> DataFrame:
    """Exactly the contract's columns, in its order and types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields])


def create_table(
    spark: SparkSession, name: str, contract: StructType, comment: str | None = None
) -> None:
    """Create schema and table if they are absent."""
    if "." in name:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in contract.fields)
    note = "" if comment is None else " COMMENT '" + comment.replace("'", "\\'") + "'"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{note}")


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_table(df: DataFrame, name: str, contract: StructType | None = None) -> None:
    """Replace a table, its schema too."""
    out = df if contract is None else conform(df, contract)
    out.write.format("parquet").mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str, contract: StructType) -> None:
    """Append rows under the contract; extra columns stay out, types are cast."""
    conform(df, contract).write.format("parquet").mode("append").saveAsTable(name)


def append_batch(df: DataFrame, path: str, batch_id: int, *partition_by: str) -> None:
    """Append one micro-batch so that writing it again replaces itself."""
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(f"{path}/batch_id={batch_id}")


def _started(writer, settings: StreamSettings):
    if settings.continuous:
        return writer.trigger(processingTime=settings.processing_time)
    return writer.trigger(availableNow=True)


def run_stream(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    settings: StreamSettings = StreamSettings(),
    output_mode: str = "append",
    **options: str,
) -> StreamingQuery:
    """Append a stream to a parquet folder or table, until the input is used up or,
    with ``continuous`` settings, at a fixed cadence."""
    writer = _started(
        df.writeStream.format("parquet")
        .outputMode(output_mode)
        .options(**options)
        .option("checkpointLocation", checkpoint),
        settings,
    )
    return writer.toTable(table) if table is not None else writer.start(path)


def beside_stream(
    spark: SparkSession, query: StreamingQuery, step: Callable[[], object], settings: StreamSettings
) -> None:
    """Take a step at the stream's cadence as long as it runs; a step that fails ends the stream."""
    trigger = spark.sparkContext._jvm.org.apache.spark.sql.streaming.Trigger
    seconds = trigger.ProcessingTime(settings.processing_time).intervalMs() / 1000

    def run() -> None:
        try:
            while not query.awaitTermination(max(seconds, 1)):
                step()
        finally:
            query.stop()

    threading.Thread(target=run, daemon=True).start()


def run_batches(
    df: DataFrame,
    checkpoint: str,
    path: str,
    *partition_by: str,
    settings: StreamSettings = StreamSettings(),
    output_mode: str = "append",
) -> StreamingQuery:
    """Like :func:`run_stream`, one folder per micro-batch; partition columns allowed."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch, path, batch_id, *partition_by)

    writer = _started(
        df.writeStream.foreachBatch(write)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint),
        settings,
    )
    return writer.start()


def stamped(df: DataFrame, column: str, now: Column | None = None) -> DataFrame:
    return df.withColumn(column, F.current_timestamp() if now is None else now)
