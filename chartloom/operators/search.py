"""Vector search: the k most similar vectors per query, over all vectors or by inverted lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.sources.tables import materialise

# A block of queries travels to every task; this bounds its size.
BLOCK_BYTES = 32 * 1024 * 1024
SCORE_DIGITS = 6


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores with their ids; equal scores by the lower id."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = scores >= kth
        scores, ids = scores[kept], ids[kept]
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def _unit(matrix: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _dense(column, width: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def _scan_block(corpus: DataFrame, block, width: int, k: int) -> DataFrame:
    """Each task's own k best per query of the block."""
    shared = corpus.sparkSession.sparkContext.broadcast(block)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, units = shared.value
        best = [(np.empty(0), np.empty(0, dtype=np.int64)) for _ in query_ids]
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            scores = np.round(units @ _unit(_dense(batch.column(1), width)).T, SCORE_DIGITS)
            for q, row in enumerate(scores):
                old_scores, old_ids = best[q]
                best[q] = _best(
                    np.concatenate([old_scores, row]), np.concatenate([old_ids, ids]), k
                )
        for query_id, (scores, ids) in zip(query_ids, best):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(ids), query_id, dtype=np.int64)),
                    pa.array(ids.astype(np.int64)),
                    pa.array(scores),
                ],
                names=["query_id", "vec_id", "score"],
            )

    return corpus.mapInArrow(scan, "query_id bigint, vec_id bigint, score double")


def _scan_cells(corpus: DataFrame, asked: DataFrame, width: int, k: int, chunks: int,
                blocks: int) -> DataFrame:
    """The k best of each chunk of the corpus per query, a task for each chunk and block."""
    null = F.lit(None).cast("bigint")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    vectors = corpus.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(chunks)).cast("int").alias("chunk"),
        every(blocks).alias("block"), null.alias("query_id"), "vec_id", "vector")
    queries = asked.select(
        every(chunks).alias("chunk"), F.col("block").cast("int"), "query_id", null.alias("vec_id"),
        F.col("query").alias("vector"))

    return _best_of_cells(vectors.unionByName(queries), ["chunk", "block"], width, k)


def _best_of_cells(rows: DataFrame, cell_keys: list[str], width: int, k: int) -> DataFrame:
    """Per cell the k best vectors (rows with a ``vec_id``) of each query (rows with a
    ``query_id``)."""
    def best(cell: pa.Table) -> pa.Table:
        rows = cell.combine_chunks()
        mine = pa.compute.is_valid(rows["query_id"])
        queries, vectors = rows.filter(mine), rows.filter(pa.compute.invert(mine))
        ids = vectors["vec_id"].to_numpy()
        out = ([], [], [])
        if len(ids) and queries.num_rows:
            scores = np.round(
                _unit(_dense(queries["vector"], width)) @ _unit(_dense(vectors["vector"], width)).T,
                SCORE_DIGITS)
            for query_id, row in zip(queries["query_id"].to_pylist(), scores):
                top, top_ids = _best(row, ids, k)
                for column, values in zip(out, ([query_id] * len(top), top_ids.tolist(), top.tolist())):
                    column.extend(values)
        return pa.table({"query_id": pa.array(out[0], pa.int64()),
                         "vec_id": pa.array(out[1], pa.int64()), "score": pa.array(out[2], pa.float64())})

    return rows.groupBy(*cell_keys).applyInArrow(
        best, "query_id bigint, vec_id bigint, score double")


def vector_topk(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``query_id, vec_id, score, rank`` of the k nearest by cosine, over all vectors.

    Scores are rounded to six digits; equal ones rank by the lower vector id.  Queries must
    have one width; vectors of another width cannot be compared with them and drop out.

    Queries of up to ``block_bytes`` are broadcast and the corpus is scanned where it lies;
    only every task's k best per query are shuffled.  More of them are dealt to blocks, the
    corpus to chunks, both of about that size, and each task compares one with the other;
    nothing goes through the driver.
    """
    shape = queries.agg(
        F.count(F.lit(1)).alias("n"), F.min(F.size(query_vector)).alias("least"),
        F.max(F.size(query_vector)).alias("w")).first()
    count, width = shape["n"], shape["w"] or 1
    if shape["least"] != shape["w"]:
        raise ValueError(f"queries of widths {shape['least']} to {shape['w']}: search each by itself")
    per_block = max(1, block_bytes // (8 * width))
    vectors = corpus.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).filter(F.size("vector") == width)
    blocks = max(1, -(-count // per_block))
    asked = queries.select(
        F.col(query_id).cast("bigint").alias("query_id"),
        F.col(query_vector).cast("array<double>").alias("query"),
        F.pmod(F.xxhash64(query_id), F.lit(blocks)).alias("block"),
    )
    if blocks == 1:
        table = asked.orderBy("query_id").toArrow()
        block = (table.column(0).to_numpy(), _unit(_dense(table.column(1), width)))
        found = _scan_block(vectors, block, width, k)
    else:
        chunks = max(1, -(-vectors.count() // per_block))
        found = _scan_cells(vectors, asked, width, k, chunks, blocks)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


#: Vectors that centroids are fitted on, and rounds of fitting.
INDEX_SAMPLE, ROUNDS = 20_000, 12
#: Vectors and queries that meet in one task.
CELL_ROWS, CELL_QUERIES = 50_000, 1_000


class VectorIndex:
    """Inverted lists: centroids, and a folder in which each vector lies in its nearest one's list."""

    def __init__(self, centroids: np.ndarray, folder: str):
        self.centroids, self.folder = centroids, folder


def _fit(units: np.ndarray, lists: int) -> np.ndarray:
    """Spherical k-means from vectors spread over the sample; empty lists keep their centroid."""
    centroids = units[np.linspace(0, len(units) - 1, min(lists, len(units))).astype(int)].copy()
    for _ in range(ROUNDS):
        nearest = (units @ centroids.T).argmax(1)
        for i in range(len(centroids)):
            own = units[nearest == i]
            if len(own):
                centroids[i] = own.sum(0)
        centroids = _unit(centroids)
    return centroids


def _assigned(rows: DataFrame, centroids: np.ndarray, width: int, probes: int) -> DataFrame:
    """(id, vector, list, turn) of the ``probes`` nearest lists of each vector, nearest first."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _unit(_dense(batch.column(1), width)) @ shared.value.T
            most = min(probes, scores.shape[1])
            near = np.argsort(-scores, axis=1, kind="stable")[:, :most]
            every = pa.array(np.repeat(np.arange(batch.num_rows), most))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(every), batch.column(1).take(every),
                 pa.array(near.ravel().astype(np.int32)),
                 pa.array(np.tile(np.arange(most, dtype=np.int32), batch.num_rows))],
                ["id", "vector", "list", "turn"])

    return rows.mapInArrow(run, "id bigint, vector array<double>, list int, turn int")


def build_index(corpus: DataFrame, folder: str, lists: int, vec_id: str = "vec_id",
                vector: str = "embedding", sample: int = INDEX_SAMPLE) -> VectorIndex:
    """Fit centroids on at most ``sample`` vectors and write every vector to its list.

    All vectors must have one width.  The sample is chosen by a hash of the id.
    """
    vectors = corpus.select(
        F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    ).filter(F.col("vector").isNotNull())
    shape = vectors.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if shape[0] != shape[1]:
        raise ValueError(f"vectors of widths {shape[0]} to {shape[1]}")
    width = shape[1] or 1
    chosen = vectors.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
    units = _unit(_dense(chosen.column(0), width)) if chosen.num_rows else np.zeros((1, width))
    centroids = _fit(units, lists)
    _assigned(vectors, centroids, width, 1).drop("turn").write.partitionBy("list").parquet(folder)
    return VectorIndex(centroids, folder)


def index_topk(queries: DataFrame, index: VectorIndex, k: int, probes: int,
               query_id: str = "query_id", query_vector: str = "query") -> DataFrame:
    """``query_id, vec_id, score, rank`` of the k nearest by cosine within the ``probes`` lists
    nearest to each query.

    Only the lists that some query asks for are read.  A list of many vectors, or one that many
    queries ask for, is cut into cells, so no task gets a list of any size; each list's vectors
    are compared exactly.
    """
    spark = queries.sparkSession
    width = index.centroids.shape[1]
    asked = _assigned(queries.select(
        F.col(query_id).cast("bigint").alias("id"), F.col(query_vector).cast("array<double>").alias("vector")),
        index.centroids, width, probes)
    asked = materialise(asked, "probes")
    wanted = asked.groupBy("list").agg(F.count("*").alias("asked"))
    named = [r[0] for r in wanted.select("list").collect()]  # at most one for each centroid
    vectors = spark.read.parquet(index.folder).filter(F.col("list").isin(named))
    sizes = vectors.groupBy("list").agg(F.count("*").alias("held")).join(wanted, "list").select(
        "list", F.ceil(F.col("held") / CELL_ROWS).cast("int").alias("chunks"),
        F.ceil(F.col("asked") / CELL_QUERIES).cast("int").alias("blocks"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    null, sizes = F.lit(None).cast("bigint"), F.broadcast(sizes)
    held = vectors.join(sizes, "list").withColumn("block", every("blocks")).select(
        "list", part("chunks").alias("chunk"), "block", null.alias("query_id"), F.col("id").alias("vec_id"), "vector")
    sought = asked.join(sizes, "list").withColumn("chunk", every("chunks")).select(
        "list", "chunk", part("blocks").alias("block"), F.col("id").alias("query_id"), null.alias("vec_id"), "vector")
    found = _best_of_cells(held.unionByName(sought), ["list", "chunk", "block"], width, k)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def probes_for(sample: DataFrame, exact: DataFrame, index: VectorIndex, target: float = 0.95,
               query_id: str = "query_id", query_vector: str = "query") -> int:
    """The fewest lists to read so that ``target`` of the exact neighbours of some sample queries
    lie in them."""
    spark = sample.sparkSession
    turns = _assigned(sample.select(
        F.col(query_id).cast("bigint").alias("id"), F.col(query_vector).cast("array<double>").alias("vector")),
        index.centroids, index.centroids.shape[1], len(index.centroids)).select(
        F.col("id").alias("query_id"), "list", "turn")
    lists = spark.read.parquet(index.folder).select(F.col("id").alias("vec_id"), "list")
    met = exact.join(lists, "vec_id").join(turns, ["query_id", "list"])
    by_turn = dict(met.groupBy("turn").count().collect())  # a row for each list at most
    held, total = 0, sum(by_turn.values())
    for turn in sorted(by_turn):
        held += by_turn[turn]
        if held >= target * total:
            return turn + 1
    return len(index.centroids)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """``query_id, wanted, hits``: how many of the exact neighbours an index has found; a neighbour
    with the score of the last one counts as found by any of that score."""
    last = exact.groupBy("query_id").agg(F.count("*").alias("wanted"), F.min("score").alias("least"))
    return last.join(found, "query_id", "left").groupBy("query_id", "wanted").agg(
        F.least(F.count_if(F.col("score") >= F.col("least")), F.col("wanted")).alias("hits"))
