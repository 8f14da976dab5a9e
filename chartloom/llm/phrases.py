"""Collocations by Toivonen's sampling: proposals from a sample, counted exactly until closed.

A bounded sample proposes words and shorter phrases that may be frequent.  One pass over all
texts counts, exactly, every word, every phrase whose two parts (without its last and without
its first word) are proposed, and so the proposals together with their negative border, as far
as the border occurs at all.  A border phrase that turns out to be frequent is a failure: it
joins the proposals, and a further pass counts what this allows and no pass before has counted.
When no frequent phrase is left outside the proposals, none can be missing and the counts of
all frequent phrases are exact.  The sample decides how many passes there are, never the result.

Proposals reach the tasks as bitmaps of a fixed size (``bitmaps.BITS``); what these let through
beyond the proposals is counted too, and changes nothing.  Phrases and counts are shuffled as
rows; a task passes a phrase on once for some millions of counts.

Rows and cases: null texts are empty, null languages are ``und``, empty ones a language of
their own; rows count each, ids and other columns play no part; texts of any length are read in
runs of ``RUN_BYTES`` and counted in runs of ``RUN`` words; an empty table gives no rows.  Counts may reach 10^13.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.bitmaps import Bitmap, bitmap
from chartloom.llm.common import (
    materialise, mixed, numbered_words, release_memory, slices, small_batches, text_bytes)

LEAST, LONGEST, TOP, CONTAINED = 10, 3, 2000, 50
#: Text of the sample.
SAMPLE_BYTES = 32_000_000
#: Different words and counts that a task holds, words that it counts at once, and bytes of text
#: that it numbers at once.
WORDS, COUNTS, RUN, RUN_BYTES = 300_000, 1_200_000, 300_000, 4_000_000
PLACE = 21  # bits of a word's number
#: A-Z in lower case, a blank for each end of a piece.
MARKS = b".,;:!?\x0a\x0b\x0c\x0d"
PIECE_BYTES = bytes(32 if b in MARKS else b + 32 if 65 <= b <= 90 else b for b in range(256))
ENDS = np.array([b in MARKS for b in range(256)])
BETWEEN = re.compile(rb"[ \t.,;:!?\x0a-\x0d]")


def pieces_of(raw: bytes) -> pa.Array:
    """The pieces of a text, in lower case."""
    cuts = np.flatnonzero(ENDS[np.frombuffer(raw, np.uint8)])
    offsets = np.concatenate([[0], cuts, [len(raw)]]).astype(np.int32)
    lowered = pa.py_buffer(raw.translate(PIECE_BYTES))
    return pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), lowered)


def cut(raw: bytes, most: int) -> Iterator[bytes]:
    """Runs of about ``most`` bytes that end between words."""
    at = 0
    while len(raw) - at > most:
        found = BETWEEN.search(raw, at + most)
        stop = found.start() if found else len(raw)
        yield raw[at:stop]
        at = stop
    yield raw[at:]


def language_seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang) | 1


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Of two words' hashes, for the order they stand in."""
    return mixed(mixed(first) * np.uint64(0x9E3779B97F4A7C15) + second)


class Gates:
    """What is proposed: words, and pairs of words."""

    def __init__(self, words: Bitmap, pairs: Bitmap):
        self.words, self.pairs = words, pairs

    def joined(self, other: Gates) -> Gates:
        return Gates(Bitmap(self.words.cells | other.words.cells),
                     Bitmap(self.pairs.cells | other.pairs.cells))


class Tally:
    """Counts of one language in one task."""

    def __init__(self, lang: str, new: Gates | None, old: Gates | None, sizes: tuple[int, ...]):
        self.lang, self.new, self.old, self.sizes = lang, new, old, sizes
        self.seed = language_seed(lang)
        self.total = 0
        self.clear()

    def clear(self) -> None:
        self.numbers = {b"": 0}  # 0 stands between pieces
        self.hashes = np.zeros(1, np.uint64)
        self.within, self.before = np.zeros(1, bool), np.zeros(1, bool)
        self.held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {k: [] for k in self.sizes}
        self.size = 0

    def full(self) -> bool:
        if self.size > COUNTS:
            self.compact()
        return self.size > COUNTS * 2 // 3 or len(self.numbers) > WORDS

    def compact(self) -> None:
        self.size = 0
        for k, parts in self.held.items():
            if parts:
                keys, at = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
                counts = np.bincount(at, np.concatenate([c for _, c in parts])).astype(np.int64)
                self.held[k] = [(keys, counts)]
                self.size += len(keys)

    def _learn(self) -> None:
        known = len(self.hashes)
        if known == len(self.numbers):
            return
        words = list(self.numbers)[known:]
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w, self.seed) for w in words), np.uint64, len(words))
        self.hashes = np.concatenate([self.hashes, hashes])
        for name, gates in (("within", self.new), ("before", self.old)):
            more = gates.words.holds(hashes) if gates else np.full(len(words), name == "within")
            setattr(self, name, np.concatenate([getattr(self, name), more]))

    def _put(self, size: int, keys: np.ndarray) -> None:
        keys, counts = np.unique(keys, return_counts=True)
        self.held[size].append((keys, counts))
        self.size += len(keys)

    def number(self, raw: bytes) -> np.ndarray:
        """Numbers of a text's words, 0 between pieces."""
        words, numbers, ends = numbered_words(pieces_of(raw))
        held = self.numbers
        known = np.fromiter((held.setdefault(w, len(held)) for w in words), np.uint64, len(words))
        self._learn()
        return np.insert(known[numbers], ends[:-1], np.uint64(0))

    def add(self, word: np.ndarray, more: int) -> None:
        """Count the phrases that begin in ``word``, of which the last ``more`` only follow."""
        own = len(word) - more
        is_word = word > 0
        if 1 in self.sizes:
            self.total += int(is_word[:own].sum())
            self._put(1, word[:own][is_word[:own]])
        if len(word) < 2 or max(self.sizes) < 2:
            return
        within, before = self.within[word], self.before[word]
        pair = word[:-1] | word[1:] << np.uint64(PLACE)
        allowed = within[:-1] & within[1:] & is_word[:-1] & is_word[1:]
        known = before[:-1] & before[1:] & allowed
        if 2 in self.sizes:
            at = np.flatnonzero(allowed[:own] & ~known[:own])
            self._put(2, pair[at])
        if 3 not in self.sizes or len(word) < 3:
            return
        at = np.flatnonzero(allowed)
        name = pair_hashes(self.hashes[word[at]], self.hashes[word[at + 1]])
        proposed = np.zeros(len(pair), bool)
        proposed[at] = self.new.pairs.holds(name) if self.new else True
        settled = np.zeros(len(pair), bool)
        if self.old:
            settled[at] = self.old.pairs.holds(name)
            settled &= known
        at = np.flatnonzero((proposed[:-1] & proposed[1:] & ~(settled[:-1] & settled[1:]))[:own])
        self._put(3, pair[at] | word[at + 2] << np.uint64(2 * PLACE))

    def named(self, word: np.ndarray) -> list[bytes]:
        words = list(self.numbers) if len(word) else []
        return [words[int(w)] for w in word]

    def renumbered(self, words: list[bytes]) -> np.ndarray:
        held = self.numbers
        out = np.array([held.setdefault(w, len(held)) for w in words], np.uint64)
        self._learn()
        return out

    def rows(self) -> Iterator[pa.RecordBatch]:
        """(lang, phrase, f) of all that is held; the words' total goes by an empty phrase."""
        self.compact()
        words = pa.array(list(self.numbers)[1:], pa.binary()).cast(pa.string())
        columns = []
        mask = np.uint64((1 << PLACE) - 1)
        for size, parts in self.held.items():
            for keys, counts in parts:
                columns += [(size, keys[i:i + 100_000], counts[i:i + 100_000])
                            for i in range(0, len(keys), 100_000)]
        total = self.total
        self.total = 0
        self.clear()

        def batch(phrase: pa.Array, counts: np.ndarray) -> pa.RecordBatch:
            lang = pa.array([self.lang]).take(pa.array(np.zeros(len(phrase), np.int64)))
            return pa.RecordBatch.from_arrays(
                [lang, phrase, pa.array(counts, pa.int64())], ["lang", "phrase", "f"])

        for size, keys, counts in columns:
            own = [words.take(pa.array((keys >> np.uint64(PLACE * k) & mask).astype(np.int64) - 1))
                   for k in range(size)]
            yield batch(own[0] if size == 1 else pc.binary_join_element_wise(*own, " "), counts)
        if total:
            yield batch(pa.array([""]), np.array([total]))


def _counted(docs: DataFrame, new, old, sizes: tuple[int, ...]) -> DataFrame:
    """(lang, phrase, f) over all texts; ``new`` and ``old`` are broadcast gates or None."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, Tally] = {}
        most = max(sizes) - 1

        def flushed(tally: Tally) -> Iterator[pa.RecordBatch]:
            if tally.full():
                yield from tally.rows()

        def counted(tally: Tally, raw: bytes) -> Iterator[pa.RecordBatch]:
            last = np.empty(0, np.uint64)
            for part in cut(raw, RUN_BYTES):
                # a flush numbers words anew, so words that reach into the next part go with it
                word = np.concatenate([last, tally.number(part)])
                stop = max(0, len(word) - most)
                for at in range(0, stop, RUN):
                    tally.add(word[at:min(at + RUN, stop) + most], most)
                last = word[stop:]
                if tally.full():
                    kept = tally.named(last)
                    yield from tally.rows()
                    last = tally.renumbered(kept)
            tally.add(last, 0)
            yield from flushed(tally)

        for batch in batches:
            for part in slices(batch):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    by_lang.setdefault(lang, []).append(text_bytes(text))
                for lang, texts in by_lang.items():
                    if lang not in tallies:
                        tallies[lang] = Tally(lang, new and new.value, old and old.value, sizes)
                    yield from counted(tallies[lang], b"\n".join(texts) + b"\n")
                if len(tallies) > 1 and sum(t.size + len(t.numbers) for t in tallies.values()) > COUNTS:
                    for tally in tallies.values():
                        yield from tally.rows()
                    tallies.clear()
        for tally in tallies.values():
            yield from tally.rows()
        tallies.clear()
        release_memory()

    small_batches(docs.sparkSession)
    counts = docs.select("lang", "text").mapInArrow(run, "lang string, phrase string, f long")
    return counts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _hashed(phrases: DataFrame) -> DataFrame:
    """(size, hash) of words and pairs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, hashes = [], []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seed = language_seed(lang)
                own = [xxhash.xxh3_64_intdigest(w, seed) for w in phrase.encode().split(b" ")]
                sizes.append(len(own))
                hashes.append(own)
            first = np.array([h[0] for h in hashes], np.uint64)
            second = np.array([h[-1] for h in hashes], np.uint64)
            pair = np.array(sizes) > 1
            name = np.where(pair, pair_hashes(first, second), first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sizes, pa.int64()), pa.array(name.view(np.int64))], ["size", "hash"])

    return phrases.select("lang", "phrase").mapInArrow(run, "size long, hash long")


def _gates(phrases: DataFrame) -> Gates:
    hashed = _hashed(phrases)
    return Gates(*[bitmap(hashed.filter(F.col("size") == k), F.col("hash")) for k in (1, 2)])


def _outside(phrases: DataFrame, gates) -> DataFrame:
    """The words and pairs that the gates do not know."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, name = (c.to_numpy() for c in batch.columns)
            name = name.view(np.uint64)
            known = np.where(size == 1, gates.value.words.holds(name), gates.value.pairs.holds(name))
            yield batch.filter(pa.array(~known))

    return _hashed(phrases).mapInArrow(run, "size long, hash long")


def size_of(phrase: Column) -> Column:
    return F.when(phrase == "", 0).otherwise(
        F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1)


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
                     sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(lang, phrase, f, size) of all words and phrases with at least ``least`` occurrences, and
    each language's total by an empty phrase of size 0.  ``longest`` is 2 or 3."""
    if longest not in (2, 3) or least < 1:
        raise ValueError("phrases have 2 or 3 words, and occur once at least")
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    share = min(1.0, sample_bytes / max(size, 1))
    # in a part of the texts, fewer occurrences will do, by two standard deviations
    low = least if share == 1 else max(1, int(least * share - 2 * (least * share) ** 0.5))
    sample = given if share == 1 else given.sample(share, 7)
    proposed = materialise(
        _counted(sample, None, None, (1, 2)).filter(f"phrase <> '' AND f >= {low}"), "proposed")
    old, gates = None, _gates(proposed)
    every = tuple(range(1, longest + 1))
    passes = []
    while True:
        new = spark.sparkContext.broadcast(gates)
        found = _counted(given, new, old, every if old is None else every[1:])
        passes.append(materialise(found.filter(F.col("f") >= F.when(
            F.col("phrase") == "", 0).otherwise(least)), "counted").withColumn(
                "size", size_of(F.col("phrase"))))
        below = passes[-1].filter((F.col("size") > 0) & (F.col("size") < longest))
        if _outside(below, new).isEmpty():
            break
        gates = gates.joined(_gates(below))
        if old is not None:
            old.unpersist()
        old = new
    out = passes[0]
    for more in passes[1:]:
        out = out.unionByName(more)
    return out


def _wide(count: str) -> Column:
    return F.col(count).cast("decimal(13,0)")


def _part(phrase: str, words: Column) -> Column:
    """The first words of a phrase, or for a negative number the last ones."""
    return F.call_function("substring_index", F.col(phrase), F.lit(" "), words)


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 contained: int = CONTAINED, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases by their weakest cut."""
    found = frequent_phrases(docs, least, longest, sample_bytes)
    counts = found.filter("size > 0").select("lang", "phrase", "f")
    phrases = found.filter("size > 1").select("lang", "phrase", F.col("f").alias("a"), "size")
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k",
        _part("phrase", F.col("k")).alias("head"),
        _part("phrase", F.col("k") - F.col("size")).alias("tail"))
    both = (
        cuts.join(counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
        .join(counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    score = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * _wide("a") * _wide("a"),
                            _wide("l") * _wide("r"))
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(
        score.alias("score"), "k", "l", "r")).alias("cut"))
    parts = [_part("phrase", F.col("size") - 1), _part("phrase", 1 - F.col("size"))]
    holders = (
        phrases.filter("size > 2").select("lang", "a", F.explode(F.array(*parts)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = scored.join(holders, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < contained * F.col("a")))
    order = Window.partitionBy("lang").orderBy(
        F.col("cut.score").desc(), F.col("a").desc(), F.col("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    totals = found.filter("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
