"""Secrets in texts, in DataFrame functions only.

Patterns find assignments, access keys and long hex strings.  Beyond them every long run of key
characters goes through a battery of randomness tests for the encoding it seems to have: chi
squared against a uniform alphabet, runs above and below its middle, and serial correlation.  A
run that none of them rejects gets a second p-value, the chance that ordinary writing of its
length uses the alphabet so evenly; these are compared with a false-discovery bound
(Benjamini-Hochberg) within each class of lengths over all texts.

Positions come from the pieces between matches, added up.  All arrays belong to one text and
stay in its row; only counts by length and p-value are shuffled.

Rows and cases: null texts are empty and have no spans; positions count code points; rows are
judged one by one, repeated ones alike; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import materialise

# The base patterns.
ASSIGN = (r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
          r"([A-Za-z0-9+/_.=-]+)")
ACCESS = r"(AKIA[A-Z0-9]+)()"
HEX = r"([0-9a-f]+)()"
KINDS = ("assign", "access", "hex", "random")

RUN = r"([A-Za-z0-9+/_-]{20,})()"
#: (name, pattern, size of the alphabet, its characters in order); a run has the first that holds it
ENCODINGS = (
    ("hex", "^[0-9a-f]+$|^[0-9A-F]+$", 16, "0123456789abcdef"),
    ("base32", "^[A-Z2-7]+$", 32, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base32 lower", "^[a-z2-7]+$", 32, "abcdefghijklmnopqrstuvwxyz234567"),
    ("base36", "^[A-Z0-9]+$", 36, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base36 lower", "^[a-z0-9]+$", 36, "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base58", "^[1-9A-HJ-NP-Za-km-z]+$", 58,
     "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"),
    ("base62", "^[0-9A-Za-z]+$", 62, "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "", 64, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
)
REJECTED = 0.001  # a run is no random string if a test's p-value is below this
DISCOVERY = 0.01  # of the reported runs, at most this share may be ordinary writing
COINCIDENCE = 0.065  # chance that two letters of ordinary writing agree
LENGTHS = (24, 32, 48, 64, 128)  # bounds of the length classes
BINS, BIN_WIDTH = 200, 0.1  # p-values in tenths of a power of ten


def _found(text: Column, pattern: str, keep) -> Column:
    """array<struct<start, end, text>> of the matches that ``keep(match, group 2)`` holds for."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), 0),
        F.regexp_extract_all(text, F.lit(pattern), 2))
    kind = "array<struct<start:int,end:int,text:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("spans"))

    def step(held: Column, piece: Column) -> Column:
        begin = held["at"] + F.length(piece["0"])
        end = begin + F.coalesce(F.length(piece["1"]), F.lit(0))
        span = F.struct(begin.alias("start"), end.alias("end"), piece["1"].alias("text"))
        hit = piece["1"].isNotNull() & keep(piece["1"], piece["2"])
        return F.struct(
            end.alias("at"),
            F.when(F.coalesce(hit, F.lit(False)), F.concat(held["spans"], F.array(span)))
            .otherwise(held["spans"]).alias("spans"))

    return F.aggregate(pieces, start, step, lambda held: held["spans"])


def _if(condition: Column, spans: Column) -> Column:
    return F.when(condition, spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,text:string>>"))


def normal_cdf(z: Column) -> Column:
    z = F.greatest(F.lit(-12.0), F.least(F.lit(12.0), z))
    return 1 / (1 + F.exp(-(1.5976 * z + 0.070566 * z * z * z)))


def _chi_squared_tail(x: Column, df: int) -> Column:
    """Upper tail by the cube-root approximation."""
    spread = 2 / (9 * df)
    return 1 - normal_cdf((F.pow(x / df, F.lit(1 / 3)) - (1 - spread)) / spread ** 0.5)


def _two_sided(z: Column) -> Column:
    return 2 * (1 - normal_cdf(F.abs(z)))


def battery(run: Column, size: int, alphabet: str) -> Column:
    """struct<uniform, runs, serial, ordinary>: the p-values of one run of characters."""
    plain = F.translate(run, "-_", "+/") if size == 64 else (
        F.lower(run) if size == 16 else run)
    n = F.length(run).cast("double")
    chars = F.split(plain, "")
    squares = F.aggregate(
        F.array_distinct(chars), F.lit(0.0),
        lambda held, c: held + F.pow(n - F.length(F.replace(plain, c, F.lit(""))), F.lit(2.0)))
    chi = squares * size / n - n
    values = F.transform(chars, lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))
    pairs = F.zip_with(values, F.slice(values, 2, 1_000_000_000), lambda a, b: F.struct(
        a.alias("a"), b.alias("b")))
    middle = (size - 1) / 2
    kind = "struct<runs:double,high:double,sum:double,squares:double,lagged:double>"
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("runs", "high", "sum", "squares", "lagged")])

    def add(held: Column, pair: Column) -> Column:
        a, b = pair["a"] - middle, pair["b"] - middle
        return F.struct(
            (held["runs"] + F.when((a > 0) != (b > 0), 1.0).otherwise(0.0)).alias("runs"),
            (held["high"] + F.when(a > 0, 1.0).otherwise(0.0)).alias("high"),
            (held["sum"] + a).alias("sum"), (held["squares"] + a * a).alias("squares"),
            (held["lagged"] + F.coalesce(a * b, F.lit(0.0))).alias("lagged")).cast(kind)

    def finish(held: Column) -> Column:
        high, low = held["high"], n - held["high"]
        expected = 2 * high * low / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        runs = F.when(variance > 0, _two_sided((held["runs"] + 1 - expected) / F.sqrt(variance))
                      ).otherwise(0.0)
        mean = held["sum"] / n
        spread = held["squares"] - n * mean * mean
        serial = F.when(spread > 0, _two_sided(
            (held["lagged"] - (n - 1) * mean * mean) / spread * F.sqrt(n))).otherwise(0.0)
        excess = size * COINCIDENCE - 1
        usual = n * excess + size
        wide = F.sqrt(2.0 * size + 4.0 * n * size * COINCIDENCE)
        return F.struct(
            _chi_squared_tail(F.greatest(chi, F.lit(0.0)), size - 1).alias("uniform"),
            runs.alias("runs"), serial.alias("serial"),
            normal_cdf((chi - usual) / wide).alias("ordinary"))

    return F.aggregate(pairs, zero.cast(kind), add, finish)


def _judged(spans: Column) -> Column:
    """The runs with length class, bin of their p-value, and whether all tests pass."""
    def one(span: Column) -> Column:
        run = span["text"]
        tests = battery(run, *ENCODINGS[-1][2:])
        for _, pattern, size, alphabet in reversed(ENCODINGS[:-1]):
            tests = F.when(run.rlike(pattern), battery(run, size, alphabet)).otherwise(tests)
        return F.struct(span["start"].alias("start"), span["end"].alias("end"),
                        F.length(run).alias("n"), tests.alias("tests"))

    def verdict(x: Column) -> Column:
        tests = x["tests"]
        length = sum((x["n"] >= bound).cast("int") for bound in LENGTHS)
        place = F.floor(-F.log10(F.greatest(tests["ordinary"], F.lit(1e-30))) / BIN_WIDTH)
        random = F.least(tests["uniform"], tests["runs"], tests["serial"]) >= REJECTED
        return F.struct(
            x["start"].alias("start"), x["end"].alias("end"), length.alias("length"),
            F.least(place, F.lit(BINS - 1)).cast("int").alias("bin"), random.alias("random"))

    return F.transform(F.transform(spans, one), verdict)


def _least_bins(rows: DataFrame) -> dict[int, int]:
    """length class -> the smallest bin that keeps the false-discovery bound, from the counts
    of all runs; at most ``len(LENGTHS) + 1`` times ``BINS`` of them."""
    counts = (
        rows.select(F.explode("judged").alias("x"))
        .groupBy(F.col("x.length").alias("length"), F.col("x.bin").alias("bin")).count().collect())
    least = {}
    for length in range(len(LENGTHS) + 1):
        own = {r["bin"]: r["count"] for r in counts if r["length"] == length}
        total, above = sum(own.values()), 0
        for place in range(BINS - 1, -1, -1):
            above += own.get(place, 0)
            if above and 10 ** (-BIN_WIDTH * place) <= DISCOVERY * above / total:
                least[length] = place
    return least


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per input row: doc_id and ``spans``, array<struct<start, kind, end>> in order of
    start and kind; kind is an index of ``KINDS``."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text_of = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    t = F.col("text")
    assign = _if(t.rlike(ASSIGN), _found(t, ASSIGN, lambda m, g: F.length(g) >= 8))
    access = _if(t.contains("AKIA"), _found(t, ACCESS, lambda m, g: F.length(m) >= 16))
    hexes = _if(t.rlike("[0-9a-f]{32}"), _found(
        t, HEX.replace("+", "{32,}"), lambda m, g: F.lit(True)))
    runs = _if(t.rlike("[A-Za-z0-9+/_-]{20}"), _found(t, RUN, lambda m, g: F.lit(True)))
    bare = lambda spans, kind: F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))
    rows = materialise(text_of.select(
        "doc_id",
        F.concat(bare(assign, 0), bare(access, 1), bare(hexes, 2)).alias("base"),
        _judged(runs).alias("judged")), "spans")
    least = _least_bins(rows)
    limit = F.create_map(*[F.lit(v) for k in range(len(LENGTHS) + 1)
                           for v in (k, least.get(k, BINS))])
    added = F.filter("judged", lambda x: x["random"] & (x["bin"] >= limit[x["length"]]) & ~F.exists(
        "base", lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return rows.select("doc_id", F.array_sort(F.concat("base", F.transform(
        added, lambda x: F.struct(x["start"].alias("start"), F.lit(3).alias("kind"),
                                  x["end"].alias("end"))))).alias("spans"))


def spelt(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))
