"""Where a source text bears out what was extracted from it, and where it speaks against it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.config import QualityFloors
from chartloom.functions.jsonval import let
from chartloom.operators import unnest

#: Edits per character up to which a passage counts as a misspelt value, one at least.
NEAR = 0.25
#: Words that a negation or a doubt reaches.
SCOPE = 6

# What begins a negation or a doubt, what negates the words before it, and what ends
# either.
NEGATIONS = (
    "absence of", "denied", "denies", "free of", "negative for", "never had", "no evidence of",
    "no signs of", "no", "not", "without")
DOUBTS = ("cannot exclude", "concern for", "likely", "may have", "possible", "possibly", "probable",
          "questionable", "suspected")
NEGATIONS_BEHIND = ("is absent", "is unlikely", "not seen", "was excluded", "was ruled out")
ENDS = ("although", "aside from", "but", "except", "however", "reports", "though", "yet")

#: Kinds of facts that no extraction may leave out.
CRITICAL = ("allergy", "chief_complaint", "diagnosis", "medication")

VALUE = "array<struct<kind:string,value:string>>"


def stated(entity: Column) -> Column:
    """array<struct<kind, value>> of what the entities state, without null and empty values."""
    def of(kind: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(kind).alias("kind"), v.alias("value")))

    every = F.concat(
        of("chief_complaint", F.array(entity["chief_complaint"])),
        of("symptom", F.transform(entity["symptoms"], lambda s: s["symptom"])),
        of("diagnosis", F.transform(entity["diagnoses"], lambda d: d["diagnosis"])),
        of("medication", F.transform(entity["medications"], lambda m: m["name"])),
        of("dosage", F.transform(entity["medications"], lambda m: m["dosage"])),
        of("procedure", F.transform(entity["procedures"], lambda p: p["procedure"])),
        of("allergy", entity["allergies"]))
    return F.filter(every, lambda v: F.coalesce(F.trim(v["value"]), F.lit("")) != "").cast(VALUE)


def words_of(text: Column) -> Column:
    """Lower-case words without marks at their ends."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}](?:[^\s,;]*[\p{L}\p{N}%])?"), F.lit(0))


def _limit(value: Column, near: float) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(value) * near).cast("int"))


def distance(a: Column, b: Column, limit: Column) -> Column:
    """Edits between two texts, null beyond a limit: only a band of that width is computed, and
    nothing where the lengths differ by more."""
    edits = F.call_function("levenshtein", a, b, limit)
    close = F.when(F.abs(F.length(a) - F.length(b)) <= limit, edits)
    return F.when(close >= 0, close)


def nearest_passage(words: Column, value: Column, near: float = NEAR) -> Column:
    """``struct(distance, position, words)``: the run of words with fewest edits from a value, of a
    word more or less than the value has; the first and shortest of equal ones, null if none is
    near."""
    lowered = F.lower(value)
    own = F.size(F.split(F.trim(lowered), r"\s+"))

    def at(size: Column) -> Column:
        last = F.size(words) - size + 1
        return F.when((size > 0) & (last > 0), F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.struct(
            distance(lowered, F.array_join(F.slice(words, i, size), " "), _limit(value, near)).alias("distance"),
            i.alias("position"), size.alias("words"))))

    sizes = F.array(own - 1, own, own + 1)
    runs = F.flatten(F.filter(F.transform(sizes, at), lambda r: r.isNotNull()))
    return F.array_min(F.filter(runs, lambda r: r["distance"].isNotNull()))


def _judged(v: Column, place: Column, words: Column, near: float) -> Column:
    """``struct(kind, value, status, distance, position, correction)`` of a stated value, which
    stands at a place of the text or, at 0, nowhere."""
    def row(kind: Column, status: Column, distance: Column, position: Column, correction: Column) -> Column:
        return F.struct(
            kind.alias("kind"), v["value"].alias("value"), status.alias("status"), distance.alias("distance"),
            position.alias("position"), correction.alias("correction"))

    def searched(best: Column) -> Column:
        passage = F.array_join(F.slice(words, best["position"], best["words"]), " ")
        return row(v["kind"], F.when(best.isNotNull(), "near").otherwise("absent"), best["distance"],
                   best["position"], F.when(best.isNotNull(), passage))

    none = F.lit(None).cast("string")
    return F.when(place > 0, row(v["kind"], F.lit("stated"), F.lit(0), place, none)).otherwise(
        let(nearest_passage(words, v["value"], near), searched))


def _with_judged(df: DataFrame, text: str, entity: str, near: float) -> DataFrame:
    """``df`` with ``_judged``, the judged values of each row.  Each value is looked up once, and the
    words of a text are cut only where it lacks one."""
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    staged = df.withColumns({"_text": lowered, "_values": stated(F.col(entity))}).withColumn(
        "_places", F.transform("_values", lambda v: F.position(F.lower(v["value"]), F.col("_text"))))
    cut = staged.withColumn("_words", F.when(
        F.array_contains("_places", F.lit(0)), words_of(F.col(text))))
    return cut.withColumn("_judged", F.transform("_values", lambda v, i: _judged(
        v, F.get(F.col("_places"), i), F.col("_words"), near))).drop("_text", "_words", "_values", "_places")


def evidence(df: DataFrame, *keys: str, text: str = "text", entity: str = "entity",
             near: float = NEAR) -> DataFrame:
    """A row per stated value: ``keys, kind, value, status, distance, position, correction``.

    ``stated`` values stand in the text, at a character; ``near`` ones have a passage within a
    quarter of their characters in edits, which begins at a word and is the correction; the
    others are ``absent``.
    """
    judged = _with_judged(df.select(*keys, text, entity), text, entity, near)
    return unnest(judged, "_judged", *keys).select(*keys, "item.*")


def _lacking(entity: Column, found: Column, near: float) -> Column:
    """What ``found`` states and no value of that kind in ``entity`` has."""
    def untold(own: Column) -> Column:
        # the same value under the same kind needs no edits to be computed
        return F.array_distinct(F.filter(stated(found), lambda fact: ~(
            F.array_contains(own, fact) | F.exists(own, lambda v: (
                v["kind"] == fact["kind"]) & distance(F.lower(v["value"]), F.lower(fact["value"]), _limit(
                    fact["value"], near)).isNotNull()))))

    return let(stated(entity), untold)


def verdicts(df: DataFrame, text: str = "text", entity: str = "entity", found: str = "found",
             near: float = NEAR, floors: QualityFloors = QualityFloors()) -> DataFrame:
    """Add the whole ``verdict`` on a row's entities, as a struct.

    ``accuracy_score`` is the share of values that the text states (1.0 without any), ``counts`` has
    the values by status, ``hallucinations`` the absent ones, ``corrections`` the misspelt ones
    with what the text says, ``missing_critical`` what the text states (``found``, read from it by
    rule) of a critical kind and the entities leave out.  It passes at the floor of
    entity validation with nothing critical missing.
    """
    staged = _with_judged(df, text, entity, near).withColumn("_missing", F.filter(
        _lacking(F.col(entity), F.col(found), near), lambda f: f["kind"].isin(*CRITICAL)))
    of = lambda status: F.filter("_judged", lambda j: j["status"] == status)
    named = lambda values, *names: F.transform(values, lambda v: F.struct(*[v[n].alias(n) for n in names]))
    total, held = F.size("_judged"), F.size(of("stated"))
    accuracy = F.when(total > 0, held.cast("double") / total).otherwise(F.lit(1.0))
    verdict = F.struct(
        accuracy.alias("accuracy_score"),
        F.struct(total.alias("values"), held.alias("stated"), F.size(of("near")).alias("near"),
                 F.size(of("absent")).alias("absent")).alias("counts"),
        named(of("absent"), "kind", "value").alias("hallucinations"),
        named(of("near"), "kind", "value", "correction").alias("corrections"),
        F.col("_missing").alias("missing_critical"),
        ((accuracy >= floors.entity_validation) & (F.size("_missing") == 0)).alias("pass"))
    return staged.withColumn("verdict", verdict).drop("_judged", "_missing")


def evidence_counts(rows: DataFrame, *keys: str) -> DataFrame:
    """Per document and kind: values, and how many of them are stated, near and absent."""
    of = lambda status: F.count_if(F.col("status") == status).alias(status)
    return rows.groupBy(*keys, "kind").agg(F.count("*").alias("values"), of("stated"), of("near"), of("absent"))


def missing_facts(df: DataFrame, *keys: str, entity: str = "entity", found: str = "found",
                  near: float = NEAR) -> DataFrame:
    """``keys, kind, value`` of what the text states (``found``, entities read from it by rule) and
    no value of that kind in ``entity`` has, misspelt ones included."""
    rows = df.select(*keys, _lacking(F.col(entity), F.col(found), near).alias("_lacking"))
    return unnest(rows, "_lacking", *keys).select(*keys, "item.*")


def marked(text: Column) -> Column:
    """The text in lower case, with x01 for what negates, x02 for doubt, x03 for what negates the
    words before it, and x04 for ends."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[\\x01-\\x04]", " ")
    for mark, triggers in ((3, NEGATIONS_BEHIND), (1, NEGATIONS), (2, DOUBTS), (4, ENDS)):
        longest = sorted(triggers, key=lambda t: (-len(t), t))
        out = F.regexp_replace(out, rf"\b(?:{'|'.join(longest)})\b".replace(" ", r"\s+"), f" {chr(mark)} ")
    return F.regexp_replace(out, r"[.!?](?=\s|$)|[;:\n]", " \x04 ")


def _mentions(text: Column, finding: Column) -> Column:
    """How often a finding stands in a text as whole words."""
    pattern = F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), F.lower(finding), F.lit(r"\E(?![\p{L}\p{N}])"))
    return F.size(F.regexp_extract_all(text, pattern, F.lit(0)))


def finding_status(text: Column, finding: Column, scope: int = SCOPE) -> Column:
    """``struct(mentions, negated, uncertain, status)`` of a finding in a :func:`marked` text.

    A negation or doubt reaches as many words as the scope, up to an end; one behind reaches as far
    back.  ``negated`` is a finding of which each mention is, ``uncertain`` one of which each is
    either, ``affirmed`` any other that is mentioned, ``absent`` the rest.
    """
    # possessive, and from the first letter of a word only: a run of words is not cut in other ways
    word = r"[^\s\x01-\x04]++"
    ahead = rf"((?:[ \t]*+(?:{word}|\x01)){{0,{scope}}}+)"

    def scopes(pattern: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
        return F.aggregate(found, F.lit(0), lambda n, s: n + _mentions(s, finding))

    behind = rf"(?<![^\s\x01-\x04])((?:{word}[ \t]*+){{1,{scope}}}+)\x03"

    def judged(x: Column) -> Column:
        status = (
            F.when(x["mentions"] == 0, "absent").when(x["negated"] >= x["mentions"], "negated")
            .when(x["negated"] + x["uncertain"] >= x["mentions"], "uncertain").otherwise("affirmed"))
        return F.struct(x["mentions"].alias("mentions"), x["negated"].alias("negated"),
                        x["uncertain"].alias("uncertain"), status.alias("status"))

    return let(F.struct(
        _mentions(text, finding).alias("mentions"),
        (scopes(rf"\x01{ahead}") + scopes(behind)).alias("negated"),
        scopes(rf"\x02{ahead}").alias("uncertain")), judged)


def findings(entity: Column) -> Column:
    """Symptoms and diagnoses that the entities state."""
    return F.transform(F.filter(stated(entity), lambda v: v["kind"].isin("symptom", "diagnosis")),
                       lambda v: v["value"])


def judged_findings(df: DataFrame, *keys: str, text: str = "text", entity: str = "entity",
                    scope: int = SCOPE) -> DataFrame:
    """A row per stated symptom and diagnosis: ``keys, finding, mentions, negated, uncertain,
    status``."""
    rows = df.select(*keys, marked(F.col(text)).alias("_text"), findings(F.col(entity)).alias("_findings"))
    judged = rows.withColumn("_judged", F.transform("_findings", lambda f: F.struct(
        f.alias("finding"), finding_status(F.col("_text"), f, scope).alias("x"))))
    return unnest(judged, "_judged", *keys).select(*keys, "item.finding", "item.x.*")


def contradicted(text: Column, entity: Column, scope: int = SCOPE) -> Column:
    """The stated findings that a text negates throughout."""
    return let(marked(text), lambda t: F.filter(
        findings(entity), lambda f: finding_status(t, f, scope)["status"] == "negated"))
