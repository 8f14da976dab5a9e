"""How far sources of a language differ in their terms, with late strings.

Terms are counted per language and source by 64-bit digests of theirs: the only shuffle of all
counts carries (group number, digest, counts), no text.  Digests with too few documents go.  A
second pass over the texts gathers, for the digests that stay, the smallest and the largest term
that has it: where the two differ, terms collide, and a third pass counts these digests' terms
by their text and puts them in the digest's place.  The text is joined back for the terms that
are returned, and nowhere before.

Pairs of sources are compared in blocks: a block of up to ``SOURCES`` sources meets another one
in tasks of up to ``CELLS`` cells, each for a share of the terms; a term that neither source has
counts by one product per pair.

Rows and cases: null text, language and source are read as empty; each row is a document of its
own, ids and other columns play no part; groups without any term are returned too; a language
with a single source has no pairs, one without kept terms has pairs of value 0; an empty table
gives no rows.  Counts may reach 10^18 and are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.bitmaps import bitmap
from chartloom.llm.common import BROADCAST_ROWS, materialise, slices, small_batches, text_bytes

LEAST_DOCUMENTS, TOP = 10, 10
#: Sources per block; cells of sources and terms per task.
SOURCES, CELLS = 256, 1_000_000
#: Different words and counts that a task holds before it passes counts on.
WORDS, COUNTS = 400_000, 2_000_000
#: A-Z in lower case, blanks for everything below x80 that is no letter.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32
                   for b in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return text_bytes(text).translate(TERM_BYTES).split()


def digest_of(term: bytes, bits: int) -> int:
    return (xxhash.xxh3_64_intdigest(term) >> 64 - bits) - (1 << bits - 1)


class Tally:
    """Counts of one task by group and term: occurrences, and documents that hold the term."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, groups: list[int], texts: list[list[bytes]]) -> None:
        numbers = self.numbers
        lengths = [len(t) for t in texts]
        every = np.fromiter((numbers.setdefault(w, len(numbers)) for t in texts for w in t),
                            np.uint64, sum(lengths))
        document = np.repeat(np.arange(len(texts), dtype=np.uint64), lengths)
        one, counts = np.unique(document << np.uint64(32) | every, return_counts=True)
        group = np.array(groups, np.uint64)[(one >> np.uint64(32)).astype(np.int64)]
        self._put(group << np.uint64(32) | one & np.uint64(0xFFFFFFFF), counts, np.ones_like(counts))

    def _put(self, keys: np.ndarray, counts: np.ndarray, documents: np.ndarray) -> None:
        distinct, at = np.unique(keys, return_inverse=True)
        self.parts.append((distinct, np.bincount(at, counts).astype(np.int64),
                           np.bincount(at, documents).astype(np.int64)))
        self.size += len(distinct)

    def compact(self) -> None:
        parts, self.parts, self.size = self.parts, [], 0
        if parts:
            self._put(*(np.concatenate(c) for c in zip(*parts)))

    def full(self) -> bool:
        if self.size > COUNTS:
            self.compact()
        return self.size > COUNTS // 2 or len(self.numbers) > WORDS

    def rows(self) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray, np.ndarray]:
        """group, terms by number, number, occurrences, documents; the tally is empty then."""
        self.compact()
        words, self.numbers = list(self.numbers), {}
        parts, self.parts, self.size = self.parts, [], 0
        keys, counts, documents = parts[0] if parts else (np.empty(0, np.uint64),) * 3
        return ((keys >> np.uint64(32)).astype(np.int64), words,
                (keys & np.uint64(0xFFFFFFFF)).astype(np.int64), counts, documents)


def _counts(docs: DataFrame, bits: int, only=None) -> DataFrame:
    """(g, digest, n, docs) of each task; with ``only``, a broadcast bitmap, of its digests, and
    with their terms."""
    schema = "g long, digest long, n long, docs long" + (", term string" if only else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()

        def rows() -> Iterator[pa.RecordBatch]:
            group, words, number, n, documents = tally.rows()
            if len(number):
                digests = np.fromiter((digest_of(w, bits) for w in words), np.int64, len(words))
                own = (only.value.holds(digests.view(np.uint64)) if only else np.ones(len(words), bool))[number]
                columns = [group, digests[number], n, documents]
                arrays = [pa.array(c[own].astype(np.int64)) for c in columns]
                if only:
                    arrays.append(pa.array(words, pa.binary()).cast(pa.string()).take(
                        pa.array(number[own])))
                table = pa.Table.from_arrays(
                    arrays, ["g", "digest", "n", "docs", "term"][: len(arrays)])
                yield from table.to_batches(max_chunksize=100_000)

        for batch in batches:
            for part in slices(batch):
                tally.add(part.column(0).to_pylist(), [terms_of(t) for t in part.column(1).to_pylist()])
                if tally.full():
                    yield from rows()
        yield from rows()

    small_batches(docs.sparkSession)
    return docs.select("g", "text").mapInArrow(run, schema)


def _spellings(docs: DataFrame, bits: int, kept) -> DataFrame:
    """(digest, least, most): the smallest and the largest term of each digest in ``kept``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: set[bytes] = set()

        def rows() -> Iterator[pa.RecordBatch]:
            every = list(words)
            words.clear()
            digests = np.fromiter((digest_of(w, bits) for w in every), np.int64, len(every))
            own = pa.array(np.flatnonzero(kept.value.holds(digests.view(np.uint64))))
            table = pa.table({"digest": pa.array(digests).take(own),
                              "term": pa.array(every, pa.binary()).cast(pa.string()).take(own)})
            yield from table.to_batches(max_chunksize=100_000)

        for batch in batches:
            for part in slices(batch):
                for text in part.column(0).to_pylist():
                    words.update(terms_of(text))
                if len(words) > WORDS:
                    yield from rows()
        yield from rows()

    terms = docs.select("text").mapInArrow(run, "digest long, term string")
    return terms.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))


def _kept(counts: DataFrame, groups: DataFrame, least: int, *term: str) -> DataFrame:
    """(lang, g, digest[, term], n, all_n, first) of terms in enough documents of a language;
    ``first`` marks one row of each term of a language."""
    own = counts.groupBy("g", *term).agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    own = own.join(groups.select("g", "lang_id"), "g")
    same = Window.partitionBy("lang_id", *term)
    return own.select(
        "lang_id", "g", *term, "n", F.sum("n").over(same).alias("all_n"),
        F.sum("docs").over(same).alias("all_docs"), (F.min("g").over(same) == F.col("g")).alias("first"),
    ).filter(F.col("all_docs") >= least).drop("all_docs")


def _share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(10^9 (n + 2) / (total + 2 kinds)), exactly; null if there are no kinds."""
    wide = lambda c: c.cast("decimal(19,0)")
    made = F.call_function("div", F.lit(1_000_000_000).cast("decimal(10,0)") * wide(n + 2),
                           wide(total + 2 * kinds))
    return F.when(kinds > 0, 1 + made)


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _groups(docs: DataFrame) -> DataFrame:
    """(lang, source, lang_id, g, place, sources): every group with a number, its place among the
    sources of its language and their count."""
    order = Window.partitionBy("lang").orderBy("source")
    found = materialise(docs.select("lang", "source").distinct().select(
        "lang", "source", (F.row_number().over(order) - 1).cast("long").alias("place"),
        F.count("*").over(Window.partitionBy("lang")).alias("sources")), "sources")
    langs = found.filter("place = 0").select("lang", "sources").withColumn(
        "before", F.coalesce(F.sum("sources").over(  # a row a language
            Window.orderBy("lang").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return materialise(found.join(langs.drop("sources"), "lang").select(
        "lang", "source", F.col("before").alias("lang_id"),
        (F.col("before") + F.col("place")).alias("g"), "place", "sources"), "groups")


def _sent(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def cells(docs: DataFrame, least: int = LEAST_DOCUMENTS, bits: int = 64):
    """(groups, cells, terms): the groups; the counts of all kept terms, (lang_id, g, digest, split,
    n, all_n, first), ``split`` being the term where its digest is shared and else empty; and
    the text of each digest that is not shared."""
    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                          for c in ("lang", "source", "text")])
    spark = docs.sparkSession
    groups = _groups(given)
    numbered = given.join(_sent(groups.select("lang", "source", "g")), ["lang", "source"]).select("g", "text")
    counted = _counts(numbered, bits).repartition("digest")
    kept = materialise(_kept(counted, _sent(groups), least, "digest"), "cells")
    digests = kept.filter("first").select("digest")
    wanted = spark.sparkContext.broadcast(bitmap(digests, F.col("digest")))
    terms = materialise(_spellings(given, bits, wanted).join(
        digests.distinct(), "digest", "left_semi"), "terms")
    whole = kept.withColumn("split", F.lit(""))
    shared = terms.filter("least <> most").select("digest")
    if not shared.isEmpty():
        wanted = spark.sparkContext.broadcast(bitmap(shared, F.col("digest")))
        again = _counts(numbered, bits, wanted).withColumnRenamed("term", "split").join(
            shared, "digest", "left_semi")
        apart = _kept(again, _sent(groups), least, "digest", "split")
        whole = materialise(
            whole.join(shared, "digest", "left_anti").unionByName(apart), "split-cells")
    return groups, whole, terms.filter("least = most").select("digest", F.col("least").alias("term"))


def _pair_sums(shares: DataFrame, groups: DataFrame, kinds: DataFrame) -> DataFrame:
    """(lang_id, a, b, value) for the places a < b of two sources of a language."""
    blocks = F.ceil(F.col("sources") / SOURCES).cast("long")
    buckets = F.ceil(F.col("kinds") * F.least(F.col("sources"), F.lit(2 * SOURCES)) / CELLS)
    sized = groups.join(kinds, "lang_id").select(
        "lang_id", "g", "place", "none", "kinds", blocks.alias("blocks"),
        F.greatest(buckets, F.lit(1)).cast("long").alias("buckets"))
    marks = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("buckets") - 1)).alias(
        "bucket"), F.lit(None).cast("long").alias("digest"), F.lit("").alias("split"), F.col("none").alias("p"))
    known = shares.join(_sent(sized), "g").withColumn(
        "bucket", F.pmod(F.xxhash64("digest", "split"), "buckets"))
    columns = ("lang_id", "bucket", "place", "digest", "split", "p")
    block = F.floor(F.col("place") / SOURCES).cast("long")
    both = marks.select(*columns, "blocks").unionByName(known.select(*columns, "blocks")).select(
        *columns, block.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    met = both.select(*columns, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def compared(table: pa.Table) -> pa.Table:
        place, p = table["place"].to_numpy(), table["p"].to_numpy()
        mark = table["digest"].is_null().to_numpy(zero_copy_only=False)
        sources, row = np.unique(place[mark], return_index=True)
        none = p[mark][row]
        terms = table.filter(pa.array(~mark)).combine_chunks()
        column = _term_numbers(terms)
        width = int(column.max(initial=-1)) + 1
        values = np.repeat(none[:, None], width, 1)
        values[np.searchsorted(sources, place[~mark]), column] = p[~mark]
        lang, low, high = (table[c][0].as_py() for c in ("lang_id", "low", "high"))
        split = np.searchsorted(sources, (low + 1) * SOURCES)
        out = []
        for i in range(split):
            j = i + 1 if low == high else split
            apart = lambda x, y: (x - y) ** 2 // (x + y)
            if j < len(sources):
                sums = apart(values[i], values[j:]).sum(1) if width else np.zeros(len(sources) - j, np.int64)
                out.append((np.full(len(sums), sources[i]), sources[j:], sums, apart(none[i], none[j:])))
        a, b, value, rest = (np.concatenate(c) for c in zip(*out)) if out else (np.empty(0, np.int64),) * 4
        return pa.table({"lang_id": pa.array(np.full(len(a), lang, np.int64)), "a": a, "b": b,
                         "value": value, "rest": rest, "seen": np.full(len(a), width, np.int64)})

    sums = met.groupBy("lang_id", "bucket", "low", "high").applyInArrow(
        compared, "lang_id long, a long, b long, value long, rest long, seen long")
    return (
        sums.groupBy("lang_id", "a", "b")
        .agg(F.sum("value").alias("value"), F.max("rest").alias("rest"), F.sum("seen").alias("seen"))
        .join(kinds, "lang_id")
        .select("lang_id", "a", "b",
                (F.col("value") + F.col("rest") * (F.col("kinds") - F.col("seen"))).alias("value")))


def _term_numbers(terms: pa.Table) -> np.ndarray:
    """A number for each different (digest, split), from 0."""
    if not terms.num_rows:
        return np.empty(0, np.int64)
    digest, first = np.unique(terms["digest"].to_numpy(), return_inverse=True)
    split = terms["split"].combine_chunks().dictionary_encode()
    pair = first * len(split.dictionary) + split.indices.to_numpy()
    return np.unique(pair, return_inverse=True)[1]


def divergence(docs: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP, bits: int = 64) -> DataFrame:
    """lang, source, part, item, value, rank: for each group the other sources of its language by
    their distance (part ``pair``), and its ``top`` terms by their excess (part ``term``)."""
    groups, counts, terms = cells(docs, least, bits)
    totals = counts.groupBy("lang_id", "g").agg(
        F.sum("n").alias("total"), F.sum(F.col("first").cast("long")).alias("kinds"))
    totals = materialise(totals, "totals")
    per_lang = totals.groupBy("lang_id").agg(F.sum("total").alias("lang_total"), F.sum("kinds").alias("kinds"))
    kinds = materialise(groups.select("lang_id").distinct().join(per_lang, "lang_id", "left").select(
        "lang_id", F.coalesce("lang_total", F.lit(0)).alias("lang_total"),
        F.coalesce("kinds", F.lit(0)).alias("kinds")), "kinds")
    sized = materialise(
        groups.join(totals.select("g", "total"), "g", "left").fillna(0, ["total"]).join(kinds, "lang_id")
        .withColumn("none", F.coalesce(_share(F.lit(0), F.col("total"), F.col("kinds")), F.lit(1)))
        .drop("kinds"), "sized")
    facts = sized.join(kinds.select("lang_id", "kinds"), "lang_id")
    shares = counts.drop("lang_id").join(_sent(facts.select("lang_id", "g", "total", "lang_total", "kinds")), "g").select(
        "lang_id", "g", "digest", "split", _share(F.col("n"), F.col("total"), F.col("kinds")).alias("p"),
        _share(F.col("all_n"), F.col("lang_total"), F.col("kinds")).alias("q"))
    names = groups.select("lang_id", "lang", "source", "place", "g")

    half = materialise(_pair_sums(shares.select("g", "digest", "split", "p"), sized.select(
        "lang_id", "g", "place", "sources", "none"), kinds.select("lang_id", "kinds")), "pairs")
    both = half.unionByName(half.select("lang_id", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    named = both.join(names.select("lang_id", F.col("place").alias("a"), "lang", "source"), ["lang_id", "a"]).join(
        names.select("lang_id", F.col("place").alias("b"), F.col("source").alias("item")), ["lang_id", "b"])
    pairs = _ranked(named.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    value = F.rank().over(Window.partitionBy("g").orderBy(F.col("value").desc()))
    best = shares.filter("p > q").select("g", "digest", "split", _apart(F.col("p"), F.col("q")).alias("value"))
    best = materialise(best.withColumn("rank", value).filter(F.col("rank") <= top), "best")
    spelt = best.join(terms, "digest", "left").select(
        "g", F.when(F.col("split") == "", F.col("term")).otherwise(F.col("split")).alias("item"), "value")
    excess = spelt.join(names, "g").select("lang", "source", F.lit("term").alias("part"), "item", "value")
    return pairs.unionByName(_ranked(excess).filter(F.col("rank") <= top))


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.withColumn("rank", F.row_number().over(order))
