"""Benchmark decontamination by templates, in DataFrame functions only.

Texts are cut into words and numbers; numbers, units behind them and names (capitalised words)
become typed placeholders, all else is lower-cased.  A capitalised word that begins a sentence
may be either: the documents' windows take it for a name, and each full window of an item is
looked for with every choice of name or word for those it holds.  So a document's window has one
hash, and what is chosen from is the small side.

Windows of one item that lie in a document at distances of one band form an alignment.  Bands are
as wide as the item is long and overlap by half, so distances that differ by up to half of the
item's words always share one.  A band that holds the stated share of the item's windows is a
candidate; its main distance is the one with most windows, each window of the item stands at its
distance nearest to that, and each slot at the nearest of the windows over it.  The candidate
stands if its slots agree: a value that the item repeats must be replaced by one value throughout.
A sentence's first word is a slot if it has another value or is a name elsewhere in its item; where
that value does not agree with the others, it was no name, and the windows over it do not match.
So copies and re-parameterised copies are found, and texts that only share the frame of a question,
with values put in anyhow, are not.

All of it is joins and sums over flat rows, one for a window and its place: nothing is gathered
into arrays, whatever repeats within a text.  The items' windows are broadcast while there are at
most ``BROADCAST_ROWS`` of them; more meet the documents' windows in a shuffle.  Of the documents,
only those that hold a candidate are shuffled.

Rows and cases: null and empty texts, and items without a word, match nothing; items shorter
than a window are one window, in which first words stand for themselves; repeated items are
matched each; rows with a null id are matched by nothing; rows that repeat an id are judged
together, by the smallest of their values at a place; other columns play no part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import BROADCAST_ROWS, materialise, rows_of, rows_without

WINDOW, SHARE = 8, 0.5
#: Units that become a placeholder behind a number.
UNITS = ("kilometers kilometres kilograms kilometer kilometre kilogram centimeters centimetres "
         "meters metres meter metre grams gram liters litres liter litre miles mile inches inch "
         "pounds pound ounces ounce seconds second minutes minute hours hour days day weeks week "
         "months month years year dollars dollar euros euro cents cent percent degrees km kg cm "
         "mm ml mg mph kmh lb oz ft hz").split()
_UNIT = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
#: x01 before a word that begins a sentence, x02 before a unit.
FIRST = "(^|[.!?:][\"')\\]]*[\\x20\\x09-\\x0D]+)(\\p{Lu})"
UNIT = f"(\\p{{N}})[\\x20\\x09-\\x0D]*((?i:{_UNIT}))\\b"
TOKEN = "[\\x01\\x02]?(?:\\p{N}+(?:[.,:/]\\p{N}+)*|[\\p{L}\\p{M}']+)"


def tokens_of(text: Column) -> Column:
    """array of words, sentence beginnings and units marked."""
    plain = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x01\\x02]", " ")
    marked = F.regexp_replace(plain, UNIT, "$1 \x02$2")
    marked = F.regexp_replace(marked, FIRST, "$1\x01$2")
    return F.regexp_extract_all(marked, F.lit(TOKEN), 0)


def template_of(token: Column) -> Column:
    return (
        F.when(token.startswith("\x02"), "<unit>")
        .when(token.rlike("^\\p{N}"), "<num>")
        .when(token.rlike("^\\p{Lu}[\\p{Ll}\\p{M}']+$"), "<name>")
        .otherwise(F.ltrim(F.lower(token), F.lit("\x01"))))


def value_of(token: Column) -> Column:
    return F.ltrim(F.lower(token), F.lit("\x01\x02"))


def _templated(rows: DataFrame, key: str, text: str, name: str) -> DataFrame:
    return rows.select(F.col(key).alias(name), tokens_of(F.col(text)).alias("tokens")).filter(
        F.col(name).isNotNull())


def begins(token: Column) -> Column:
    """True for a capitalised word that begins a sentence."""
    return token.rlike("^\\x01\\p{Lu}[\\p{Ll}\\p{M}']+$")


def _hashed(token: Column, as_name: Column) -> Column:
    return F.when(as_name, F.xxhash64(F.lit("<name>"))).otherwise(F.xxhash64(template_of(token)))


def _at(hash: Column, k: int) -> Column:
    return F.xxhash64(hash, F.lit(k))


def _window_hashes(hashes: Column, size: int) -> Column:
    """array of the hashes of all windows of ``size`` tokens."""
    last = F.size(hashes) - size

    def one(i: Column) -> Column:
        whole = F.xxhash64(F.lit(size))
        for k in range(size):
            whole = whole.bitwiseXOR(_at(F.get(hashes, i + k), k))
        return whole

    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one)
                  ).otherwise(F.array().cast("array<bigint>"))


def _document_windows(templated: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(doc_id, d, hash) of all windows of the given sizes."""
    parts = []
    for size in sizes:
        full = F.lit(size == window)
        hashes = templated.select("doc_id", F.transform(
            "tokens", lambda t: _hashed(t, full & begins(t))).alias("hashes"))
        parts.append(hashes.select("doc_id", F.posexplode(
            _window_hashes(F.col("hashes"), size)).alias("d", "hash")))
    return reduce(DataFrame.unionByName, parts)


def _item_windows(items: DataFrame, sizes: list[int], window: int) -> DataFrame:
    """(item_id, q, hash) of the items' windows, a full one by all choices for its first words."""
    parts = []
    for size in sizes:
        own = items.filter(F.least(F.size("tokens"), F.lit(window)) == size)
        hashes = own.select("item_id", F.transform("tokens", lambda t: F.struct(
            _hashed(t, F.lit(False)).alias("word"), begins(t).alias("first"))).alias("t"))
        name = F.xxhash64(F.lit("<name>"))

        def turns(q: Column) -> Column:
            """For each first word of a window what turns its hash into that with a name."""
            return F.filter(F.array(*[
                F.when(F.get("t", q + k)["first"], _at(F.get("t", q + k)["word"], k).bitwiseXOR(_at(name, k)))
                for k in range(size)]), lambda t: t.isNotNull())

        rows = hashes.select("item_id", "t", F.posexplode(_window_hashes(
            F.transform("t", lambda t: t["word"]), size)).alias("q", "hash"))
        if size == window:
            rows = rows.withColumn("hash", F.explode(F.aggregate(
                turns(F.col("q")), F.array("hash"), lambda held, turn: F.concat(
                    held, F.transform(held, lambda h: h.bitwiseXOR(turn))))))
        parts.append(rows.select("item_id", "q", "hash").distinct())
    return reduce(DataFrame.unionByName, parts)


def _slot_tokens(items: DataFrame, window: int) -> DataFrame:
    """(item_id, j, type, item, opens, named) of the items' tokens that may be slots: ``opens`` for a
    first word, ``named`` for one that is a name elsewhere in its item."""
    names = F.transform(F.filter("tokens", lambda t: template_of(t) == "<name>"), value_of)
    full = F.size("tokens") >= window
    tokens = items.select("item_id", names.alias("names"), full.alias("full"), F.posexplode("tokens").alias("j", "t"))
    opens = F.col("full") & begins(F.col("t"))
    return tokens.select(
        "item_id", "j", F.when(opens, "<name>").otherwise(template_of(F.col("t"))).alias("type"),
        value_of(F.col("t")).alias("item"), opens.alias("opens"),
        F.array_contains("names", value_of(F.col("t"))).alias("named"),
    ).filter(F.col("type").isin("<num>", "<unit>", "<name>"))


KEYS = ["doc_id", "item_id", "band"]


def _slots(places: DataFrame, tokens: DataFrame, words: DataFrame) -> DataFrame:
    """(KEYS, j, type, item, turned, doc) of the slots in windows ``places``, each with the
    document's value at the nearest distance of the windows over it."""
    inside = (F.col("j") >= F.col("q")) & (F.col("j") < F.col("q") + F.col("size"))
    at = F.min(F.struct(F.abs(F.col("at") - F.col("main")).alias("off"), "at"))
    placed = places.join(tokens, "item_id").filter(inside).groupBy(
        *KEYS, "j", "type", "item", "opens", "named").agg(at["at"].alias("at"))
    met = placed.withColumn("d", F.col("at") + F.col("j")).join(words, ["doc_id", "d"])
    turned = F.col("opens") & (F.col("doc") != F.col("item"))
    return met.select(*KEYS, "j", "type", "item", "doc", turned.alias("turned")).filter(
        ~F.col("opens") | turned | F.col("named"))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                 window: int = WINDOW, share: float = SHARE) -> DataFrame:
    """A row per document and item: doc_id, item_id, start (the word where the item begins, by
    its first matched window), matched and windows (of the item), slots (in matched windows),
    changed (slots with another value)."""
    items = materialise(_templated(benchmark, item_col, item_text, "item_id").filter(
        F.size("tokens") > 0), "items")
    sizes = sorted(r[0] for r in items.select(
        F.least(F.size("tokens"), F.lit(window)).alias("s")).distinct().collect()) or [window]
    wanted = materialise(_item_windows(items, sizes, window), "windows")
    given = _templated(docs, id_col, text_col, "doc_id")
    side = wanted.hint("broadcast") if wanted.count() <= BROADCAST_ROWS else wanted
    size = F.least(F.size("tokens"), F.lit(window))
    lengths = items.groupBy("item_id").agg(F.max(F.struct(
        F.size("tokens").alias("n"), size.alias("size"))).alias("x")).select(
        "item_id", "x.size", (F.col("x.n") - F.col("x.size") + 1).alias("windows"),
        (F.floor(F.col("x.n") / 2) + 1).alias("step"))
    hits = _document_windows(given, sizes, window).join(side, "hash").select(
        "doc_id", "item_id", "q", (F.col("d") - F.col("q")).alias("at")).distinct()
    band = F.floor(F.col("at") / F.col("step"))
    banded = materialise(hits.join(lengths, "item_id").select(
        "doc_id", "item_id", F.explode(F.array(band, band - 1)).alias("band"), "q", "at", "size", "windows"), "hits")
    enough = banded.groupBy(*KEYS, "windows").agg(F.countDistinct("q").alias("found")).filter(
        F.col("found") >= F.col("windows") * share).select(*KEYS)
    held = banded.join(enough, KEYS, "left_semi")
    best = F.max(F.struct(F.col("own"), (-F.col("at")).alias("back")))
    main = held.groupBy(*KEYS, "at").agg(F.count("*").alias("own")).groupBy(*KEYS).agg(best.alias("b")).select(
        *KEYS, F.col("b.own").alias("own"), (-F.col("b.back")).alias("main"))
    near = F.min(F.struct(F.abs(F.col("at") - F.col("main")).alias("off"), "at"))
    places = materialise(held.join(main, KEYS).groupBy(
        *KEYS, "q", "size", "windows", "own", "main").agg(near["at"].alias("at")), "places")

    found = materialise(places.select("doc_id").distinct(), "ids")
    texts = rows_of(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("_text")), found)
    words = materialise(
        _templated(texts, "doc_id", "_text", "doc_id")
        .select("doc_id", F.posexplode("tokens").alias("d", "t"))
        .groupBy("doc_id", "d").agg(F.min(value_of(F.col("t"))).alias("doc")), "words")
    tokens = materialise(_slot_tokens(items, window).distinct(), "slots")
    given_slots = _slots(places, tokens, words)
    disagree = given_slots.groupBy(*KEYS, "type", "item").agg(
        F.countDistinct("doc").alias("values"), F.collect_set(F.when(F.col("turned"), F.col("j"))).alias("js")
    ).filter(F.col("values") > 1).select(*KEYS, F.explode("js").alias("j"))
    over = (F.col("j") >= F.col("q")) & (F.col("j") < F.col("q") + F.col("size"))
    gone = places.join(disagree, KEYS).filter(over).select(*KEYS, "q").distinct()
    left = materialise(places.join(gone, [*KEYS, "q"], "left_anti"), "left")
    slots = materialise(_slots(left, tokens, words), "judged")
    uneven = slots.groupBy(*KEYS, "type", "item").agg(F.countDistinct("doc").alias("values")).filter("values > 1")
    sums = slots.groupBy(*KEYS).agg(
        F.count("*").alias("slots"), F.count_if(F.col("item") != F.col("doc")).alias("changed"))
    rows = (
        left.groupBy(*KEYS, "windows", "own", "main")
        .agg(F.count("*").alias("matched"), F.min_by("at", "q").alias("start"))
        .filter(F.col("matched") >= F.col("windows") * share)
        .join(uneven, KEYS, "left_anti").join(sums, KEYS, "left"))
    chosen = F.max(F.struct(
        "matched", "own", (-F.col("main")).alias("back"), (-F.col("band")).alias("low"), "start", "windows",
        F.coalesce("slots", F.lit(0)).alias("slots"), F.coalesce("changed", F.lit(0)).alias("changed")))
    return rows.groupBy("doc_id", "item_id").agg(chosen.alias("b")).select(
        "doc_id", "item_id", *[F.col(f"b.{c}").cast("long").alias(c) for c in (
            "start", "matched", "windows", "slots", "changed")])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns."""
    gone = materialise(contaminated(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias(id_col)).distinct(), "gone")
    return rows_without(docs, gone, id_col)
