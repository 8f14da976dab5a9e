"""What several corpus operators share: words, hashes, Arrow passes, written stages."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.sources.tables import BATCH_BYTES, fresh_dir, materialise, small_batches

ODD = np.uint64(0x9E3779B97F4A7C15)
#: The most ids that are broadcast.
BROADCAST_ROWS = 2_000_000
#: The remembered hashes of words, per Python worker.
REMEMBERED = 120_000


class WordHashes(dict):
    """word -> 64-bit hash, computed once for each word while it is remembered."""

    def __init__(self, seed: int = 0):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value


def text_bytes(value: str | None) -> bytes:
    """UTF-8, in which ``split()`` cuts at exactly x20 and x09-x0D and ``lower()`` changes
    exactly A-Z."""
    return b"" if value is None else value.encode("utf-8", "surrogatepass")


def word_hashes(words: list[bytes], known: WordHashes) -> np.ndarray:
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int, seed: int = 1) -> np.ndarray:
    """A hash of each window of ``length`` consecutive words, in one pass per binary digit
    of the length: windows of doubled lengths are made of two halves."""
    if len(words) < length:
        return np.empty(0, np.uint64)
    factor = np.uint64((seed * 2 + 1) * int(ODD) % 2**64 | 1)
    part, size = mixed(words + np.uint64(seed)), 1
    whole, done = None, 0
    while True:
        if length & size:
            n = len(words) - done - size + 1
            tail = part[done:done + n]
            whole = tail if whole is None else mixed(whole[:n] * factor + tail)
            done += size
        if size * 2 > length:
            return whole[: len(words) - length + 1]
        part = mixed(part[: len(part) - size] * factor + part[size:])
        size *= 2


def slices(batch: pa.RecordBatch, most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes, a row at least."""
    size = np.full(batch.num_rows, 16, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            size += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        past = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, past + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def release_memory() -> None:
    """Give back what a finished task has freed: workers live on and serve later stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        return  # only some C libraries keep freed memory, and can be told to return it


def numbered_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Of a string column: its different words between ASCII white space, the number of each word
    in order, and where each row's words end."""
    parts = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = parts.values.slice(parts.offsets[0].as_py(), parts.offsets[-1].as_py() - parts.offsets[0].as_py())
    coded = flat.cast(pa.binary()).dictionary_encode()
    words, numbers = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    ends = parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()
    if b"" in words:  # around white space at a text's ends
        at = words.index(b"")
        kept = numbers != at
        ends = np.append(0, np.cumsum(kept))[ends]
        numbers = numbers[kept]
        numbers = numbers - (numbers > at)
        del words[at]
    return words, numbers, ends


def arrow_pass(
    df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list | None]], schema: str,
    types: pa.Schema, most: int = BATCH_BYTES,
) -> DataFrame:
    """``mapInArrow`` by a function from rows of ``most`` bytes, a few MB, to columns of ``types``.

    ``make`` runs once in each task and returns that function.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, most):
                columns = work(part)
                if columns is not None:
                    arrays = [c if isinstance(c, pa.Array) else pa.array(c, t.type)
                              for c, t in zip(columns, types)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=types)
        del work
        release_memory()

    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def arrow_type(spark_type: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32()}.get(spark_type, pa.string())


def rows_of(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids``, a written table of distinct ids in a column
    of the same name.  Ids of up to ``BROADCAST_ROWS`` are broadcast, so that no text is
    shuffled; more of them meet the rows in a shuffle."""
    return docs.join(_sent(ids), id_col, "left_semi")


def rows_without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is not in ``ids``, by the same two ways."""
    return docs.join(_sent(ids), id_col, "left_anti")


def _sent(ids: DataFrame) -> DataFrame:
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids.hint("shuffle_merge")


def training_rows(key: Column, modulus: int, out: int) -> Column:
    """True where crc32 of the key as text leaves another remainder than ``out``; a null
    key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus != out
