"""Katz backoff scores of whole texts, of any order.

Words are counted over all training texts and numbered by falling count, so that a number
gives its word's count by a short list of steps.  Texts are kept in batches.  Order by order, from
pairs to the highest, each batch asks for its distinct n-grams, in buckets by context.  A bucket
sums what all batches ask for and is stored as a row of that order's table of counts, with the
places of each batch's n-grams in it.  Counts of counts over the stored table give the Good-Turing
discounts; a pass over it answers each batch with the n-grams' counts and their contexts'
denominators and backoff masses.  With the answers of all orders a batch evaluates its tokens
recursively: the discounted n-gram where it was seen, else the context's weight, exactly
normalised, times the same of the order below, down to the unigram and the share of unknown words.

An order asks only for n-grams whose context the order below has seen in training; the others
back off with weight 1.  The context of a text's n-th token has n words at most, the start of the
text being the first: its first token is scored by pairs, whatever the order.

Nothing frequent gathers in one bucket.  An n-gram comes once from each batch, with its times.
Contexts with ``SHARE`` of all tokens, at most ``1 / SHARE`` of them, known from the table of the
order below, are dealt to all buckets by word, and their sums are gathered before the answers.

Numbers reach the tasks by a sorted array of the vocabulary while it has at most
``VOCABULARY`` words; a larger one meets the words in a shuffle, with the same result.

Rows and cases: null texts are empty and consist of the end alone; a null id counts as empty
text for the hold-out; rows that repeat an id are scored each by its own text; without any
training token every token is unknown with probability 1; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import (
    ODD, WordHashes, arrow_pass, materialise, mixed, numbered_words, release_memory, slices,
    small_batches, training_rows, word_hashes)

DISCOUNTED = 5  # counts up to this one are discounted
BUCKET_TOKENS, SHARE, VOCABULARY = 1_000_000, 1 / 2000, 12_000_000
GROUP_TEXTS, BATCH_TOKENS = 5_000, 700_000  # of a batch, about; a text may have more tokens
END = np.uint64(0x5851F42D4C957F2D)  # stands for the end among the words' hashes
START = np.uint32(2**32 - 1)  # the context of a first token
ZSTD, UNZSTD = zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def words_of(texts: pa.Array, known: WordHashes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the distinct lower-cased words of some texts and, last, of the end; which of them
    each token is, and how many tokens each text has."""
    words, numbers, ends = numbered_words(pc.ascii_lower(texts.cast(pa.string())))
    sizes = np.diff(ends, prepend=0) + 1
    tokens = np.full(int(sizes.sum()), len(words), np.int64)
    inner = np.ones(len(tokens), bool)
    inner[np.cumsum(sizes) - 1] = False
    tokens[inner] = numbers
    return np.append(word_hashes(words, known), END), tokens, sizes


def discounts(counts: list[int], most: int = DISCOUNTED) -> np.ndarray:
    """Good-Turing (Katz) discounts of the counts 1..most; ``counts[r]`` says how many types
    have count r.  A count whose discount would leave (0, 1) gets the absolute discount
    n1 / (n1 + 2 n2) instead, at 0 none."""
    n = np.array([*counts, *[0] * (most + 2)], float)[: most + 2]
    out = np.ones(most + 1)
    if n[1] == 0:
        return out
    rest = (most + 1) * n[most + 1] / n[1]
    flat = n[1] / (n[1] + 2 * n[2])
    for r in range(1, most + 1):
        d = 0.0
        if n[r] > 0 and rest < 1:
            d = ((r + 1) * n[r + 1] / (n[r] * r) - rest) / (1 - rest)
        out[r] = d if 0 < d < 1 else 1 - flat / r if flat < r else 0.5
    return out


@dataclass(frozen=True)
class Unigrams:
    """The vocabulary by number: ``steps[i]`` words have a count of ``levels[i]`` or more."""

    levels: np.ndarray
    steps: np.ndarray
    total: int
    words: int
    kept: np.ndarray  # discounts
    scale: float

    @classmethod
    def of(cls, by_count: list[tuple[int, int]]) -> Unigrams:
        """From (count, how many words have it)."""
        by_count = sorted(by_count, reverse=True)
        levels = np.array([c for c, _ in by_count], np.int64)
        types = np.array([n for _, n in by_count], np.int64)
        total = int((levels * types).sum())
        coc = dict(by_count)
        kept = discounts([coc.get(r, 0) for r in range(DISCOUNTED + 2)])
        weights = kept[np.where(levels <= DISCOUNTED, levels, 0)]
        seen = float((levels * types * weights).sum()) / max(total, 1)
        return cls(levels, np.cumsum(types), total, int(types.sum()), kept,
                   total / (total + 1) if seen > 1 - 1e-9 else 1.0)

    def count(self, numbers: np.ndarray) -> np.ndarray:
        """How often the words of these numbers were seen; 0 for unknown ones."""
        at = np.searchsorted(self.steps, numbers, "right")
        return np.append(self.levels, 0)[at]

    def unknown(self) -> float:
        """The probability of an unknown word: all that the known ones leave."""
        types = np.diff(self.steps, prepend=0)
        weights = self.kept[np.where(self.levels <= DISCOUNTED, self.levels, 0)]
        if not self.total:
            return 1.0
        return 1.0 - self.scale * float((self.levels * types * weights).sum()) / self.total

    def probability(self, numbers: np.ndarray) -> np.ndarray:
        count = self.count(numbers)
        weights = self.kept[np.where(count <= DISCOUNTED, count, 0)]
        return np.where(count > 0, self.scale * weights * count / max(self.total, 1),
                        self.unknown())


def word_counts(given: DataFrame) -> DataFrame:
    """(word, c): how often each word's hash stands in the training texts."""
    def make():
        known = WordHashes()

        def work(batch):
            words, tokens, _ = words_of(batch.column(0), known)
            return words.view(np.int64), np.bincount(tokens, minlength=len(words))
        return work

    counted = arrow_pass(given.filter("train").select("text"), make, "word long, c long",
                         pa.schema([("word", pa.int64()), ("c", pa.int64())]))
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def numbered(words: DataFrame) -> DataFrame:
    """(word, number): numbers 0, 1, ... by falling count."""
    spark = words.sparkSession
    ranged = materialise(
        words.repartitionByRange(F.col("c").desc(), "word")
        .sortWithinPartitions(F.col("c").desc(), "word")
        .select("word", "c", F.monotonically_increasing_id().alias("at")), "ranked")
    part = F.shiftright("at", 33)
    sizes = ranged.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, rows = 0, []
    for row in sizes:
        rows.append((row["part"], before))
        before += row["count"]
    offsets = spark.createDataFrame(rows, "part long, before long")
    return ranged.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "word", (F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))


class Numbers:
    """Numbers of words by the sorted vocabulary; that of unknown words is its size."""

    def __init__(self, words: np.ndarray, numbers: np.ndarray):
        self.words, self.numbers = words, numbers

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(hashes), np.uint32)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return np.where(self.words[at] == hashes, self.numbers[at], len(self.words)).astype(np.uint32)


def _batches_of_texts(given: DataFrame, words: DataFrame, unigrams: Unigrams) -> DataFrame:
    """A row per batch of texts: its name, and of its texts doc_id, train, lengths, n_known,
    base_score and, as unsigned 32-bit integers, the numbers of all words."""
    spark = given.sparkSession
    size = unigrams.words
    kind = ("batch long, doc_id array<string>, train array<boolean>, lengths array<long>, "
            "n_known array<long>, base_score array<double>, numbers binary")
    types = pa.schema([
        ("batch", pa.int64()), ("doc_id", pa.list_(pa.string())), ("train", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())),
        ("base_score", pa.list_(pa.float64())), ("numbers", pa.binary())])

    def batched(parts: Iterator[tuple[list, list, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        """(doc_ids, train flags, lengths, numbers) of some texts after others, put together."""
        name, held, count = TaskContext.get().partitionId() << 33, [], 0

        def close() -> pa.RecordBatch:
            ids, train = ([x for part in held for x in part[i]] for i in (0, 1))
            lengths, own = (np.concatenate([part[i] for part in held]) for i in (2, 3))
            starts, seen = np.cumsum(lengths) - lengths, unigrams.count(own)
            base = np.log10((seen + 1) / (unigrams.total + size + 1))
            values = [name, ids, train, lengths, np.add.reduceat((seen > 0).astype(np.int64), starts),
                      np.add.reduceat(base, starts), _packed(own)]
            return pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, types)], schema=types)

        for ids, train, lengths, own in parts:
            ends, a = np.append(0, np.cumsum(lengths)), 0
            while a < len(ids):
                b = int(np.searchsorted(ends, ends[a] + BATCH_TOKENS - count, "right")) - 1
                b = min(max(b, a + (not held)), a + GROUP_TEXTS - sum(len(h[0]) for h in held))
                if b > a:
                    held.append((ids[a:b], train[a:b], lengths[a:b], own[ends[a]:ends[b]]))
                    count, a = count + int(ends[b] - ends[a]), b
                if a < len(ids):
                    yield close()
                    name, held, count = name + 1, [], 0
        if held:
            yield close()
        release_memory()

    if size <= VOCABULARY:
        table = words.toArrow()
        order = np.argsort(hashes := table["word"].to_numpy().view(np.uint64))
        shared = spark.sparkContext.broadcast(
            (hashes[order], table["number"].to_numpy()[order].astype(np.uint32)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, vocabulary = WordHashes(), Numbers(*shared.value)

            def described(part: pa.RecordBatch):
                words, tokens, lengths = words_of(part.column(2), known)
                return (*(c.to_pylist() for c in part.columns[:2]), lengths, vocabulary.of(words)[tokens])
            return batched(described(part) for batch in batches for part in slices(batch))

        small_batches(spark)
        return given.select("doc_id", "train", "text").mapInArrow(run, kind)

    def explode():
        known = WordHashes()

        def work(batch):
            texts = batch.column(2)
            ids, train, rows = (batch.column(i).to_pylist() for i in (0, 1, 3))
            words, tokens, sizes = words_of(texts, known)
            return (pa.array(ids, pa.string()).take(np.repeat(np.arange(len(ids)), sizes)),
                    np.repeat(np.array(train, bool), sizes), np.repeat(rows, sizes),
                    np.concatenate([np.arange(n) for n in sizes]),
                    words[tokens].view(np.int64))
        return work

    tokens = arrow_pass(
        given.select("doc_id", "train", "text", "row"),
        explode, "doc_id string, train boolean, row long, at long, word long",
        pa.schema([("doc_id", pa.string()), ("train", pa.bool_()), ("row", pa.int64()),
                   ("at", pa.int64()), ("word", pa.int64())]))
    found = tokens.join(words, "word", "left").groupBy("doc_id", "train", "row").agg(
        F.sort_array(F.collect_list(F.struct("at", F.coalesce("number", F.lit(size)).alias("n"))))
        .alias("items")).select("doc_id", "train", "row", F.col("items.n").alias("items"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def described(batch: pa.RecordBatch):
            ids, train, items = (c.to_pylist() for c in batch.columns)
            lengths = np.array([len(x) for x in items], np.int64)
            return ids, train, lengths, np.concatenate([np.array(x, np.uint32) for x in items])
        return batched(described(batch) for batch in batches if batch.num_rows)

    return found.select("doc_id", "train", "items").mapInArrow(pack, kind)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of equal length and without negative values, by byte and compressed."""
    block = np.stack([c.astype("<u8") for c in columns])
    size = max(1, -(-int(block.max(initial=0)).bit_length() // 8))
    planes = block.view(np.uint8).reshape(*block.shape, 8)[:, :, :size].transpose(0, 2, 1)
    return bytes([size]) + ZSTD.compress(planes.tobytes())


def _columns(raw: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(UNZSTD.decompress(raw[1:]), np.uint8).reshape(width, raw[0], -1)
    block = np.zeros((width, planes.shape[2], 8), np.uint8)
    block[:, :, :raw[0]] = planes.transpose(0, 2, 1)
    return block.view("<i8")[:, :, 0]


def _packed_grams(columns: np.ndarray) -> bytes:
    """n-grams in order: the first word rises and is kept by what it rises."""
    return _packed(np.diff(columns[0], prepend=np.uint32(0)), *columns[1:])


def _grams(raw: bytes, order: int) -> np.ndarray:
    columns = _columns(raw, order)
    columns[0] = np.cumsum(columns[0])
    return columns.astype(np.uint32)


def _unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where one of each distinct value stands, in order, and which of them each is."""
    order = np.argsort(values)
    new = np.append(True, np.diff(values[order]) != 0)[:len(values)]
    at = np.empty(len(values), np.int64)
    at[order] = np.cumsum(new) - 1
    return order[new], at


def _distinct(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of n-grams, a column for each place: where one of each distinct one stands, in the order of
    their words, and which of them each is."""
    at = columns[0].astype(np.uint64)
    for column in columns[1:]:
        one, at = _unique(at.astype(np.uint64) << np.uint64(32) | column)
    return one, at


def _names(columns: np.ndarray) -> np.ndarray:
    """Names of contexts: their words, of long ones a hash."""
    name = columns[0].astype(np.uint64)
    for n, column in enumerate(columns[1:]):
        name = name << np.uint64(32) | column if n == 0 else mixed(mixed(name + ODD) + column)
    return name


def _bucket_of(columns: np.ndarray, buckets: int, hot: np.ndarray) -> np.ndarray:
    """By context; hot ones are spread by word."""
    name = _names(columns[:-1])
    spread = np.where(_among(name, hot)[0], mixed(columns[-1].astype(np.uint64) + ODD), np.uint64(0))
    return (mixed(mixed(name) ^ spread) % np.uint64(buckets)).astype(np.int64)


def _among(names: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which names are among sorted ones, and where."""
    if not len(known):
        return np.zeros(len(names), bool), np.zeros(len(names), np.int64)
    at = np.minimum(np.searchsorted(known, names), len(known) - 1)
    return known[at] == names, at


@dataclass(frozen=True)
class Level:
    """How the n-grams of an order are dealt, and, once its table stands, their discounts."""

    order: int
    buckets: int
    hot: np.ndarray  # names of contexts, in order
    kept: np.ndarray | None = None


class Batch:
    """The tokens of a batch of texts, with what is known of each: probability, count and
    reciprocal of the context's denominator at the order reached."""

    def __init__(self, words: np.ndarray, lengths: list[int], unigrams: Unigrams):
        self.words, self.lengths = words, np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(words)) - np.repeat(self.starts, self.lengths)
        self.count = unigrams.count(words)
        self.chance = unigrams.probability(words)
        self.share = np.full(len(words), unigrams.scale / max(unigrams.total, 1))
        self.trained = unigrams.total > 0

    def asked(self, level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Tokens whose context was seen, the n-grams that end there, by bucket: distinct ones,
        their buckets, where they first stand, and which of them each token ends."""
        back = level.order - 1
        seen = np.append(False, self.count[:-1] > 0)
        if back == 1:
            seen[self.starts] = self.trained
        tokens = np.flatnonzero(seen & (self.place >= back - 1))
        padded = np.append(self.words, START)
        columns = np.stack([
            padded[np.where(self.place[tokens] >= b, tokens - b, len(self.words))]
            for b in range(back, -1, -1)])
        first, at = _distinct(columns)
        grams = columns[:, first]
        bucket = _bucket_of(grams, level.buckets, level.hot)
        order = np.sort(bucket << 32 | np.arange(len(bucket))) & (2**32 - 1)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return tokens, grams[:, order], bucket[order], first[order], rank[at]

    def answer(self, level: Level, answers: list[tuple[int, bytes, bytes]]) -> None:
        """Raise what is known by one order, by the buckets' answers."""
        tokens, grams, *_, at = self.asked(level)
        seen = np.zeros(len(self.words), np.int64)
        if len(tokens):
            parts = [_columns(raw, 2) for _, raw, _ in sorted(answers)]
            count, under = np.concatenate(parts, 1)
            unseen = np.concatenate([
                _columns(raw, 2).view(np.float64) for *_, raw in sorted(answers)], 1)
            left, share = np.zeros((2, grams.shape[1]))
            left[count == 0], share[count == 0] = unseen
            count, under, left, share = count[at], under[at], left[at], share[at]
            cut = level.kept[np.where(count <= DISCOUNTED, count, 0)]
            weight = left / np.maximum(1 - self.share[tokens] * share, 1e-12)
            self.chance[tokens] = np.where(
                count > 0, cut * count / under, weight * self.chance[tokens])
            self.share[tokens] = 1 / under
            seen[tokens] = count
        self.count = seen


def _ask(batch: int, texts: Batch, train: list[bool], level: Level) -> list[tuple]:
    """What a batch asks of an order's buckets: n-grams with their times in texts for training, and
    the count of each without its first word, which a pair's number tells by itself."""
    tokens, grams, bucket, first, at = texts.asked(level)
    known = np.repeat(np.array(train, bool), texts.lengths)[tokens]
    trained = np.bincount(at[known], minlength=len(bucket))
    lower = texts.count[tokens[first]] if level.order > 2 else np.zeros(len(bucket), np.int64)
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(bucket))
    return [(int(bucket[a]), batch, _packed_grams(grams[:, a:b]),
             _packed(trained[a:b], lower[a:b])) for a, b in zip(edges, edges[1:])]


ASKED = ("bucket long, batch long, grams binary, times binary", pa.schema([
    ("bucket", pa.int64()), ("batch", pa.int64()), ("grams", pa.binary()), ("times", pa.binary())]))
COUNTED = ("bucket long, grams binary, counts binary, batches array<long>, places array<binary>, "
           "types array<double>, common array<long>, names array<long>, sums array<array<double>>",
           pa.schema([
               ("bucket", pa.int64()), ("grams", pa.binary()), ("counts", pa.binary()),
               ("batches", pa.list_(pa.int64())), ("places", pa.list_(pa.binary())),
               ("types", pa.list_(pa.float64())), ("common", pa.list_(pa.int64())),
               ("names", pa.list_(pa.int64())), ("sums", pa.list_(pa.list_(pa.float64())))]))


def _context_sums(grams: np.ndarray, counts: np.ndarray, lower: np.ndarray, kept: np.ndarray):
    """Per context of counted n-grams in order: where it starts, the sum of counts, how many
    n-grams have each count up to ``DISCOUNTED``, and the discounted sum of ``lower``, their counts
    one order below, whose discounts are ``kept``."""
    if not len(counts):
        return np.zeros(0, np.int64), np.zeros((0, DISCOUNTED + 3))
    change = (np.diff(grams[:-1], axis=1) != 0).any(0)
    first = np.append(0, np.flatnonzero(change) + 1)
    below = lower * kept[np.where(lower <= DISCOUNTED, lower, 0)]
    columns = [counts, *[counts == r for r in range(DISCOUNTED + 1)], below]
    return first, np.stack([np.add.reduceat(c.astype(float), first) for c in columns], 1)


def backoff(sums: np.ndarray, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, mass left) of contexts by their sums.  A context of which no count is
    discounted gives one count away, so that unseen words always have a share."""
    total = sums[:, 0]
    lost = (sums[:, 1:-1] * np.arange(DISCOUNTED + 1) * (1 - kept)).sum(1)
    some = lost > 1e-9 * total
    return np.where(some, total, total + 1), np.where(some, lost / total, 1 / (total + 1))


def _counted(asked: DataFrame, level: Level, below: np.ndarray, often: float,
             unigrams: Unigrams) -> DataFrame:
    """The stored table of an order: a row per bucket with its n-grams and counts, and the places
    in it of what each batch asked for; besides counts of counts, contexts of the next order
    that are common, and the sums of hot contexts."""
    def counted(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        parts = [_grams(raw, level.order) for raw in table["grams"].to_pylist()]
        grams = np.concatenate(parts, 1)
        sizes = [p.shape[1] for p in parts]
        del parts
        times = np.concatenate([_columns(raw, 2) for raw in table["times"].to_pylist()], 1)
        first, at = _distinct(grams)
        grams, lower = grams[:, first], times[1, first]
        if level.order == 2:
            lower = unigrams.count(grams[1])
        counts = np.bincount(at, times[0], len(first)).astype(np.int64)
        places = [_packed(np.diff(own, prepend=0)) for own in np.split(at, np.cumsum(sizes)[:-1])]
        known = counts > 0
        names = _names(grams[:-1])
        wanted = known & _among(names, level.hot)[0]
        starts, sums = _context_sums(grams[:, wanted], counts[wanted], lower[wanted], below)
        row = {
            "bucket": bucket, "grams": _packed_grams(grams), "counts": _packed(counts, lower if level.order > 2 else 0 * lower),
            "batches": table["batch"].to_pylist(), "places": places,
            "types": np.bincount(np.minimum(counts[known], DISCOUNTED + 2), minlength=DISCOUNTED + 3)
            .astype(float).tolist(),
            "common": _names(grams[:, counts >= often]).view(np.int64).tolist(),
            "names": names[wanted][starts].view(np.int64).tolist(), "sums": sums.tolist()}
        release_memory()
        return pa.Table.from_pylist([row], schema=COUNTED[1])

    return _stored(asked.groupBy("bucket").applyInArrow(counted, COUNTED[0]), f"counts{level.order}")


def _answers(table: DataFrame, level: Level, below: np.ndarray, hot_sums: np.ndarray,
             unigrams: Unigrams) -> DataFrame:
    """(level, batch, bucket, seen, unseen): what batches asked for, in their order: counts and
    denominators, and of n-grams without a count the mass left and the sum of ``_context_sums``."""
    def make():
        def work(rows):
            out = [[], [], [], [], []]
            for bucket, raw, numbers, batches, places in zip(*(c.to_pylist() for c in rows.columns)):
                grams = _grams(raw, level.order)
                counts, lower = _columns(numbers, 2)
                if level.order == 2:
                    lower = unigrams.count(grams[1])
                change = (np.diff(grams[:-1], axis=1) != 0).any(0)
                context = np.append(0, np.cumsum(change))
                first = np.flatnonzero(np.append(True, change))
                sums = np.zeros((len(first), DISCOUNTED + 3))
                known = counts > 0
                starts, own = _context_sums(grams[:, known], counts[known], lower[known], below)
                sums[context[known][starts]] = own
                held, at = _among(_names(grams[:-1, first]), level.hot)
                sums[held] = hot_sums[at[held]]
                under, left = backoff(sums, level.kept)
                for batch, raw in zip(batches, places):
                    place = np.cumsum(_columns(raw, 1)[0])
                    c, at = counts[place], context[place]
                    unseen = at[c == 0]
                    for column, value in zip(out, (
                            level.order, batch, bucket, _packed(c, under[at]),
                            _packed(left[unseen].view(np.int64), sums[unseen, -1].view(np.int64)))):
                        column.append(value)
            return out
        return work

    return arrow_pass(
        table.select("bucket", "grams", "counts", "batches", "places"), make,
        "level int, batch long, bucket long, seen binary, unseen binary",
        pa.schema([("level", pa.int32()), ("batch", pa.int64()), ("bucket", pa.int64()),
                   ("seen", pa.binary()), ("unseen", pa.binary())]))


def _batch(row: dict, answers: pa.Table | None, levels: list[Level], unigrams: Unigrams) -> Batch:
    """A row's batch, raised by the answers of some orders."""
    batch = Batch(_columns(row["numbers"], 1)[0].astype(np.uint32), row["lengths"], unigrams)
    found = [] if answers is None else list(zip(*(
        answers[c].to_pylist() for c in ("level", "bucket", "seen", "unseen"))))
    for level in levels:
        batch.answer(level, [a[1:] for a in found if a[0] == level.order])
    return batch


def _asked(texts: DataFrame, answers: DataFrame | None, level: Level, done: list[Level],
           unigrams: Unigrams) -> DataFrame:
    """What all batches ask of an order's buckets, by the answers of the orders below."""
    def make():
        def work(rows):
            asked = []
            for row in rows.to_pylist():
                asked += _ask(row["batch"], _batch(row, None, [], unigrams), row["train"], level)
            return list(zip(*asked)) or None
        return work

    def ask(own: pa.Table, found: pa.Table) -> pa.Table:
        [row] = own.to_pylist()
        asked = _ask(row["batch"], _batch(row, found, done, unigrams), row["train"], level)
        release_memory()
        return pa.table(list(zip(*asked)) or [[]] * 4, schema=ASKED[1])

    if answers is None:
        return arrow_pass(texts, make, *ASKED)
    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(ask, ASKED[0])


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Written once; the shuffles behind it, which nothing reads again, are given up at once."""
    spark, setting = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, "false")
    spark.conf.set(setting, "true")
    try:
        return materialise(df, name)
    finally:
        spark.conf.set(setting, before)


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                modulus: int = 7, out: int = 2, order: int = 2) -> DataFrame:
    """A row per input row: doc_id (as text), held_out, n_tokens, n_known, train_tokens,
    base_score, score, by n-grams of up to ``order`` words."""
    if order < 2:
        raise ValueError("an order below 2 leaves nothing to back off from")
    given = docs.select(
        F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        training_rows(F.col(id_col), modulus, out).alias("train"),
        F.monotonically_increasing_id().alias("row"))
    words = _stored(word_counts(given), "words")
    unigrams = Unigrams.of([tuple(r) for r in words.groupBy("c").count().collect()])
    total = unigrams.total
    numbers = _stored(numbered(words), "numbers")
    texts = _stored(_batches_of_texts(given, numbers, unigrams), "texts")
    tokens = texts.agg(F.coalesce(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)),
                                  F.lit(0))).first()[0]
    buckets = max(1, -(-tokens // BUCKET_TOKENS))
    hot = np.arange(unigrams.steps[unigrams.levels >= SHARE * max(total, 1)].max(initial=0))
    hot = np.append(hot, START).astype(np.uint64)
    often = max(2.0, SHARE * total)
    below, levels, answers = unigrams.kept, [], None

    parts = texts.select("batch", "train", "lengths", "numbers")
    for n in range(2, order + 1):
        level = Level(n, buckets, hot)
        asked = _asked(parts, answers, level, list(levels), unigrams)
        table = _counted(asked, level, below, often, unigrams)
        # counts of counts, at most 1 / SHARE contexts, and as many with their sums
        types = table.select(F.posexplode("types").alias("c", "n")).groupBy("c").agg(F.sum("n")).collect()
        types = {r[0]: int(r[1]) for r in types}
        kept = discounts([types.get(c, 0) for c in range(DISCOUNTED + 2)])
        facts = table.select(F.explode(F.arrays_zip("names", "sums")).alias("x")).groupBy("x.names").agg(
            *[F.sum(F.col("x.sums")[i]) for i in range(DISCOUNTED + 3)]).collect()
        sums = np.zeros((len(hot), DISCOUNTED + 3))
        for r in facts:
            sums[np.searchsorted(hot, np.int64(r[0]).view(np.uint64))] = r[1:]
        common = table.select(F.explode("common")).collect()
        level = Level(n, buckets, hot, kept)
        found = _answers(table, level, below, sums, unigrams)
        levels.append(level)
        answers = found if answers is None else answers.unionByName(found)
        hot = np.unique(np.array([r[0] for r in common], np.int64).view(np.uint64))
        below = kept

    kind = ("doc_id string, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double")

    def scored(own: pa.Table, found: pa.Table) -> pa.Table:
        [row] = own.to_pylist()
        batch = _batch(row, found, levels, unigrams)
        scores = np.add.reduceat(np.log10(batch.chance), batch.starts)
        release_memory()
        return pa.table({
            "doc_id": pa.array(row["doc_id"], pa.string()),
            "held_out": pa.array([not t for t in row["train"]], pa.bool_()),
            "n_tokens": pa.array(row["lengths"], pa.int64()), "n_known": pa.array(row["n_known"], pa.int64()),
            "train_tokens": pa.array([total] * len(scores), pa.int64()),
            "base_score": pa.array(row["base_score"], pa.float64()), "score": scores})

    return texts.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(scored, kind)
