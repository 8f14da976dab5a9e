"""Token ids in binary files with directly addressable codes.

An id is cut into chunks of eight bits, the lowest first.  Level k of a file holds the k-th chunk
of every id that has one, with a bitmap that says which of them continue, and a directory of the
bitmap's ranks, one for every 512 bits.  The token at a position is read by one chunk, one bit and
one rank per level, wherever it lies: nothing is decoded in front of it.

Documents are dealt to tasks by ranges of their id, sorted there, and encoded and written as they
come: a task closes a file when it holds ``FILE_TOKENS`` ids and begins the next, so it keeps
one file and one slice of texts in memory.  A file's name tells its place in the order; where its
first token stands among all follows from the files' counts, one row a file.

Texts are encoded by the tokenizers library.  A word between ASCII white space has the same ids
wherever it stands (the library's normaliser and splitter drop white space and look at nothing
beyond it), so each task hands the library its distinct words, many in one call, and puts the
texts' ids together from them.  Strings of special tokens in a text are read as the library reads
them by default.

Rows and cases: a null or empty text is the end id alone; null ids come first; rows that repeat
an id, or id and text, are a document each, in the order of the table; ids must be integers; other
columns play no part; an empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.llm.common import fresh_dir, numbered_words, slices, small_batches
from chartloom.llm.warc import file_system

#: Ids per file and bytes of text per task; a single document may exceed either.
FILE_TOKENS, PART_BYTES = 4_000_000, 32_000_000
#: Remembered words and pieces of words, and the bytes of each, per Python worker.
WORDS, PIECES, HELD_BYTES = 300_000, 1_000_000, 24_000_000
ASCII_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LARGEST_VOCABULARY = 64_000_000
FIRST = itemgetter(0)
MAGIC, HEAD, RANKED = b"DAC1", struct.Struct("<4sIQQ"), 512


class Numbered(dict):
    """word -> its number, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number


def _gathered(flat: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some entries, one after the other, and how many each has."""
    first = starts[numbers]
    lengths = starts[numbers + 1] - first
    ends = np.cumsum(lengths)
    return flat[np.repeat(first - (ends - lengths), lengths) + np.arange(lengths.sum())], lengths


class Encoder:
    """Ids of texts by their words, and of words by their pieces: a last mark behind a letter is
    a piece of its own where the tokenizer cuts there, ASCII pieces are in lower case where it
    lowers them.  What a worker has met is kept in flat arrays."""

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer
        self.tokenizer = tokenizer = Tokenizer.from_buffer(vocabulary)
        cut, normal = tokenizer.pre_tokenizer, tokenizer.normalizer
        self.lowers = normal is not None and normal.normalize_str(ASCII_LETTERS) == ASCII_LETTERS.lower()
        self.marks = bytes(m for m in b".,;:!?" if cut is not None and all(
            [at for _, at in cut.pre_tokenize_str(f"x{c}{chr(m)}")] == [(0, 2), (2, 3)]
            for c in ASCII_LETTERS))
        added = tokenizer.get_added_tokens_decoder().values()
        self.added = [t.content.encode().lower() for t in added if t.content]
        self.shortest = min(map(len, self.added), default=1 << 30)
        self._forget_words()
        self._forget_pieces()

    def _forget_words(self) -> None:
        self.words, self.known, self.bytes = Numbered(), 0, 0
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self.uses = np.empty(0, np.uint32)  # in how many slices of texts a word stood

    def _forget_rare_words(self) -> None:
        """All but the words of several slices, the most frequent ones, of at most a third of the
        room: most words come once, and the others would be learnt again at once."""
        often = np.flatnonzero(self.uses > 1)
        if len(often) > WORDS // 3:
            often = np.sort(often[np.argsort(-self.uses[often].astype(np.int64), kind="stable")[:WORDS // 3]])
        words = list(self.words)
        held = [words[i] for i in often.tolist()]
        sizes = np.cumsum([len(w) for w in held])
        fit = int(np.searchsorted(sizes, HELD_BYTES // 3, "right"))
        held, often = held[:fit], often[:fit]
        flat, lengths = _gathered(self.flat, self.starts, often)
        self._forget_words()
        for word in held:
            self.words[word]
        self.known, self.bytes = len(held), sum(map(len, held))
        self.flat, self.starts = flat, np.append(0, np.cumsum(lengths))
        self.uses = np.ones(len(held), np.uint32)

    def _forget_pieces(self) -> None:
        self.pieces, self.encoded, self.piece_bytes = Numbered(), 0, 0
        self.piece_ids, self.piece_starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def _parts(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """Numbers of the words' pieces, and where each word's begin."""
        whole = b" ".join(words).lower()
        special = [t for t in self.added if t in whole]
        numbers, first = [], []
        pieces, marks, lowers = self.pieces, self.marks, self.lowers
        for word, lower in zip(words, whole.split(b" ")):
            first.append(len(numbers))
            if special and len(word) >= self.shortest and any(t in lower for t in special):
                numbers.append(pieces[word])
                continue
            own = lower if lowers and word.isascii() else word
            if word[-1] in marks and word[-2:-1].isalpha():
                numbers.append(pieces[own[:-1]])
                numbers.append(pieces[own[-1:]])
            else:
                numbers.append(pieces[own])
        return numbers, first

    def _learn_pieces(self) -> None:
        new = list(self.pieces)[self.encoded:]
        ids, lengths = [], []
        for at in range(0, len(new), 5_000):
            words = [w.decode("utf-8", "replace") for w in new[at:at + 5_000]]
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
            own = np.array(found.ids, np.uint32)
            places = np.fromiter(map(FIRST, found.offsets), np.int64, len(own))
            ids.append(own)
            lengths.append(np.diff(np.searchsorted(places, ends), prepend=0))
        if new:
            self.piece_ids = np.concatenate([self.piece_ids, *ids])
            self.piece_starts = np.concatenate(
                [self.piece_starts, self.piece_starts[-1] + np.cumsum(np.concatenate(lengths))])
            self.encoded += len(new)
            self.piece_bytes += sum(map(len, new))

    def learn(self) -> None:
        """Ids of the words that were numbered since the last call."""
        new = list(self.words)[self.known:]
        if not new:
            return
        numbers, first = self._parts(new)
        self._learn_pieces()
        ids, lengths = _gathered(self.piece_ids, self.piece_starts, np.array(numbers))
        self.flat = np.concatenate([self.flat, ids])
        self.starts = np.concatenate(
            [self.starts, self.starts[-1] + np.cumsum(np.add.reduceat(lengths, first))])
        self.known += len(new)
        self.bytes += sum(map(len, new))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if self.known > WORDS or self.bytes > HELD_BYTES:
            self._forget_rare_words()
        if self.encoded > PIECES or self.piece_bytes > HELD_BYTES:
            self._forget_pieces()
        words, numbers, ends = numbered_words(texts)
        known = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        self.learn()
        if len(self.uses) < self.known:
            self.uses = np.append(self.uses, np.zeros(self.known - len(self.uses), np.uint32))
        self.uses[known] += 1
        ids, lengths = _gathered(self.flat, self.starts, known[numbers])
        return np.split(ids, np.append(0, np.cumsum(lengths))[ends[:-1]])


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocabulary: bytes) -> Encoder:
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def pack(keys: list[int | None], documents: list[np.ndarray]) -> bytes:
    """A file's bytes: head, keys, their nulls, starts, then levels of chunks, bits and ranks,
    and a checksum."""
    ids = np.concatenate(documents) if documents else np.empty(0, np.uint32)
    starts = np.cumsum([0, *map(len, documents)]).astype("<u8")
    null = np.array([k is None for k in keys], np.uint8)
    levels, sizes = [], []
    while len(ids):
        more = ids > 255
        bits = np.packbits(more, bitorder="little")
        ranks = np.concatenate([[0], np.cumsum(np.add.reduceat(
            more, np.arange(0, len(more), RANKED), dtype=np.int64))])
        levels += [(ids & 255).astype(np.uint8).tobytes(), bits.tobytes(), ranks.astype("<u8").tobytes()]
        sizes.append(len(ids))
        ids = ids[more] >> 8
    body = b"".join([
        HEAD.pack(MAGIC, len(sizes), len(keys), int(starts[-1])), np.array(sizes, "<u8").tobytes(),
        np.array([k or 0 for k in keys], "<i8").tobytes(), null.tobytes(), starts.tobytes(), *levels])
    return body + struct.pack("<I", zlib.crc32(body))


class TokenFile:
    """A file by a function that reads (offset, length) of it."""

    def __init__(self, read: Callable[[int, int], bytes]):
        self.read = read
        magic, levels, self.documents, self.tokens = HEAD.unpack(read(0, HEAD.size))
        if magic != MAGIC:
            raise ValueError("not a file of token ids")
        sizes = np.frombuffer(read(HEAD.size, 8 * levels), "<u8").tolist()
        at = HEAD.size + 8 * levels
        self.keys_at, self.starts_at = at, at + 9 * self.documents
        at = self.starts_at + 8 * (self.documents + 1)
        self.levels = []
        for size in sizes:
            bits = at + size
            ranks = bits + -(-size // 8)
            self.levels.append((at, bits, ranks))
            at = ranks + 8 * (-(-size // RANKED) + 1)
        self.length = at

    def keys(self) -> list[int | None]:
        raw = self.read(self.keys_at, 9 * self.documents)
        null = raw[8 * self.documents:]
        return [None if n else int(k) for k, n in zip(np.frombuffer(raw, "<i8", self.documents), null)]

    def starts(self) -> np.ndarray:
        return np.frombuffer(self.read(self.starts_at, 8 * (self.documents + 1)), "<u8").astype(np.int64)

    def _rank(self, level: int, at: int) -> int:
        """How many ids before ``at`` go on beyond this level."""
        _, bits, ranks = self.levels[level]
        block = at // RANKED
        before = int.from_bytes(self.read(ranks + 8 * block, 8), "little")
        raw = self.read(bits + block * RANKED // 8, -(-(at % RANKED) // 8))
        return before + (int.from_bytes(raw, "little") & ((1 << at % RANKED) - 1)).bit_count()

    def token(self, at: int) -> int:
        """The id at one position."""
        if not 0 <= at < self.tokens:
            raise IndexError(at)
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= self.read(chunks + at, 1)[0] << 8 * level
            if not self.read(bits + at // 8, 1)[0] >> at % 8 & 1:
                break
            at = self._rank(level, at)
        return value

    def span(self, start: int, stop: int) -> np.ndarray:
        """The ids of positions ``start`` to ``stop``."""
        if not 0 <= start <= stop <= self.tokens:
            raise IndexError((start, stop))
        out = np.zeros(stop - start, np.uint32)
        own = np.arange(stop - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if not len(own):
                break
            out[own] |= np.frombuffer(self.read(chunks + start, len(own)), np.uint8).astype(
                np.uint32) << np.uint32(8 * level)
            raw = np.frombuffer(self.read(bits + start // 8, -(-stop // 8) - start // 8), np.uint8)
            more = np.unpackbits(raw, bitorder="little")[start % 8:start % 8 + len(own)].astype(bool)
            own = own[more]
            start = self._rank(level, start) if len(own) else 0
            stop = start + len(own)
        return out


def _put(folder: str, name: str, raw: bytes) -> str:
    """Written under a name of the attempt, then renamed."""
    fs, place = file_system(folder)
    fs.create_dir(place, recursive=True)
    attempt = f"{place}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(attempt, compression=None) as out:
        out.write(raw)
    fs.move(attempt, f"{place}/{name}")
    return f"{folder}/{name}"


def _read_vocabulary(path: str) -> bytes:
    with open(path, "rb") as file:
        raw = file.read(LARGEST_VOCABULARY + 1)
    if len(raw) > LARGEST_VOCABULARY:
        raise ValueError(f"{path} is larger than {LARGEST_VOCABULARY} bytes")
    return raw


def write_tokens(docs: DataFrame, vocabulary: str, folder: str, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text",
                 file_tokens: int = FILE_TOKENS, part_bytes: int = PART_BYTES) -> None:
    """Files of all documents' ids in ``folder/files`` and a row for each in ``folder/list``:
    part, number, path, documents, tokens."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_read_vocabulary(vocabulary))
    files = f"{folder}/files"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // part_bytes))
    order = ("doc_id", "copy")
    ranged = rows.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(
        parts, *order).sortWithinPartitions(*order).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(shared.value), TaskContext.get().partitionId()
        keys, held, tokens, number = [], [], 0, 0
        end = np.array([end_id], np.uint32)

        def close() -> pa.RecordBatch:
            path = _put(files, f"part-{part:08d}-{number:06d}.dac", pack(keys, held))
            return pa.RecordBatch.from_pylist([{
                "part": part, "number": number, "path": path, "documents": len(keys), "tokens": tokens}])

        for batch in batches:
            for piece in slices(batch):
                for key, ids in zip(piece.column(0).to_pylist(),
                                    encoder.encode(piece.column(1))):
                    if keys and tokens + len(ids) >= file_tokens:
                        yield close()
                        keys, held, tokens, number = [], [], 0, number + 1
                    keys.append(key)
                    held.append(np.append(ids, end))
                    tokens += len(ids) + 1
        if keys:
            yield close()

    small_batches(spark)
    ranged.mapInArrow(run, "part long, number long, path string, documents long, tokens long"
                      ).write.parquet(f"{folder}/list")


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, documents, tokens, start) of the files, ``start`` being all tokens before."""
    listed = spark.read.parquet(f"{folder}/list")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    return listed.select("path", "documents", "tokens",
                         F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))


def _open(path: str) -> TokenFile:
    fs, place = file_system(path)
    file = fs.open_input_file(place)

    def read(at: int, length: int) -> bytes:
        file.seek(at)
        return file.read(length)
    return TokenFile(read)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A row per document: doc_id, start, n_tokens, ids (little-endian unsigned 32-bit)."""
    files = token_files(spark, folder)
    count = max(1, min(files.count(), 100_000))
    files = files.select("path", "start").repartition(count, "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                yield from _documents(path, start)

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _documents(path: str, before: int) -> Iterator[pa.RecordBatch]:
    fs, place = file_system(path)
    with fs.open_input_file(place) as source:
        raw = memoryview(source.read())
    file = TokenFile(lambda at, length: raw[at:at + length])
    if zlib.crc32(raw[:file.length]) != int.from_bytes(raw[file.length:], "little"):
        raise ValueError(f"{path} has another checksum")
    keys, starts = file.keys(), file.starts()
    step = 0
    while step < len(keys):  # runs of documents of about a million ids
        stop = max(step + 1, int(np.searchsorted(starts, starts[step] + 1_000_000, "right")) - 1)
        run = file.span(int(starts[step]), int(starts[stop])).astype("<u4").tobytes()
        places = ((starts[step:stop + 1] - starts[step]) * 4).tolist()
        ids = [run[a:b] for a, b in zip(places, places[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys[step:stop], pa.int64()), pa.array(starts[step:stop] + before),
             pa.array(np.diff(starts[step:stop + 1])), pa.array(ids, pa.binary())],
            ["doc_id", "start", "n_tokens", "ids"])
        step = stop


def tokens_at(positions: DataFrame, folder: str, position_col: str = "position",
              file_tokens: int = FILE_TOKENS) -> DataFrame:
    """(position, token) for each row of ``positions``; no row for null or outside positions.

    Positions meet the files by stretches of ``file_tokens``, and are then dealt to tasks by
    range: a task opens the files it needs and reads a few bytes for each position.
    """
    spark = positions.sparkSession
    stretch = lambda c: F.floor(c / file_tokens)
    files = token_files(spark, folder).filter("tokens > 0").select(
        "path", "start", "tokens", F.explode(F.sequence(
            stretch(F.col("start")), stretch(F.col("start") + F.col("tokens") - 1))).alias("stretch"))
    wanted = positions.select(F.col(position_col).cast("long").alias("position")).filter(
        "position >= 0").withColumn("stretch", stretch(F.col("position")))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("tokens"))
    met = wanted.join(files, "stretch").filter(inside).select("position", "path", "start")
    ranged = met.repartitionByRange("position").sortWithinPartitions("position")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            at, paths, starts = (c.to_pylist() for c in batch.columns)
            out = []
            for position, path, start in zip(at, paths, starts):
                if path != name:
                    name, file = path, _open(path)
                out.append(file.token(position - start))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())],
                                             ["position", "token"])

    return ranged.mapInArrow(run, "position long, token long")


def round_trip(docs: DataFrame, vocabulary: str, end_id: int = 1) -> DataFrame:
    """Write the ids of all documents and read them back, as of :func:`read_documents`."""
    folder = fresh_dir(docs.sparkSession, "tokens")
    write_tokens(docs, vocabulary, folder, end_id)
    return read_documents(docs.sparkSession, folder)
