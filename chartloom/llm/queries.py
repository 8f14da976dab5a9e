"""The corpus operators as queries over the given tables, each next to its SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import (
    bpe, decontaminate, divergence, exact, katz, nearmin, phrases, quality, secrets, substring,
    tokenfile, toxicity, warc)
from chartloom.queries.inputs import table

#: The longest n-grams of the language model.
ORDER = 3
VOCABULARY, WORD_VOCABULARY = "byte_bpe_50k.tiktoken", "word_bpe_49k.json"


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = substring.drop_repeats(table(spark, sf, "documents"))
    return rows.select(
        "doc_id", "n_words", "n_removed",
        F.coalesce(F.sha2("kept_text", 256), "whole").alias("kept_sha256"))


OP1_SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                             lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS text
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
gone AS (
  SELECT doc_id, i FROM windows
  JOIN (SELECT text, min(doc_id) AS source FROM windows GROUP BY text) USING (text)
  WHERE doc_id > source),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM gone),
cut AS (SELECT doc_id, list(i) AS gone FROM covered GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(
         list_filter(w, lambda x, i: NOT list_contains(coalesce(gone, []), i)), ' '), '')) AS kept_sha256
FROM words LEFT JOIN cut USING (doc_id)
"""


def op2_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


OP2_SQL = r"""
WITH marked AS (
  SELECT kind, id, regexp_replace(regexp_replace(coalesce(text, ''), '(\p{N})[\x20\x09-\x0D]*((?i:%s))\b',
           '\1 ' || chr(2) || '\2', 'g'),
         '(^|[.!?:]["'')\]]*[\x20\x09-\x0D]+)(\p{Lu})', '\1' || chr(1) || '\2', 'g') AS t
  FROM (SELECT 'doc' AS kind, doc_id AS id, text FROM documents
        UNION ALL SELECT 'item', item_id, text FROM benchmark)),
tokens AS (
  SELECT kind, id, regexp_extract_all(t,
    '[\x01\x02]?(?:\p{N}+(?:[.,:/]\p{N}+)*|[\p{L}\p{M}'']+)') AS w FROM marked),
templates AS (
  SELECT kind, id, w, list_transform(w, lambda x: regexp_matches(x, '^\x01\p{Lu}[\p{Ll}\p{M}'']+$')) AS first,
    list_transform(w, lambda x: CASE
      WHEN starts_with(x, chr(2)) THEN '<unit>'
      WHEN regexp_matches(x, '^\p{N}') THEN '<num>'
      WHEN regexp_matches(x, '^\p{Lu}[\p{Ll}\p{M}'']+$') THEN '<name>'
      ELSE ltrim(lower(x), chr(1)) END) AS t
  FROM tokens WHERE len(w) > 0),
items AS (
  SELECT id AS item_id, w, t, first, least(len(t), 8) AS size, len(t) - least(len(t), 8) + 1 AS windows,
         len(t) // 2 + 1 AS step FROM templates WHERE kind = 'item'),
item_windows AS (
  SELECT item_id, q, size, array_to_string([CASE WHEN size = 8 AND first[q + k] THEN '<first>' ELSE t[q + k] END
           FOR k IN range(1, size + 1)], chr(31)) AS text, t[q + 1:q + size] AS words, first[q + 1:q + size] AS first
  FROM (SELECT *, unnest(range(0, windows)) AS q FROM items)),
choices AS (
  SELECT item_id, q, size, array_to_string([CASE WHEN size = 8 AND first[k] AND (mask >> (k - 1)::INT) & 1 = 1
           THEN '<name>' ELSE words[k] END FOR k IN range(1, size + 1)], chr(31)) AS text
  FROM (SELECT *, unnest(range(0, CASE WHEN size = 8 AND list_contains(first, true) THEN 256 ELSE 1 END)) AS mask
        FROM item_windows)),
wanted AS (SELECT DISTINCT item_id, q, size, text FROM choices),
doc_windows AS (
  SELECT id AS doc_id, d, n, array_to_string(CASE WHEN n = 8 THEN named[d + 1:d + n] ELSE t[d + 1:d + n] END, chr(31)) AS text
  FROM (SELECT id, t, named, n, unnest(range(0, len(t) - n + 1)) AS d
        FROM (SELECT id, t, [CASE WHEN first[k] THEN '<name>' ELSE t[k] END FOR k IN range(1, len(t) + 1)] AS named,
                     unnest(range(1, 9)) AS n FROM templates WHERE kind = 'doc'))),
hits AS (
  SELECT DISTINCT doc_id, item_id, q, d - q AS pos
  FROM doc_windows JOIN wanted ON doc_windows.text = wanted.text AND n = size),
banded AS (
  SELECT doc_id, item_id, unnest([floor(pos / step)::BIGINT, floor(pos / step)::BIGINT - 1]) AS band, q, pos, size, windows
  FROM hits JOIN items USING (item_id)),
held AS (
  SELECT * FROM banded
  JOIN (SELECT doc_id, item_id, band FROM banded GROUP BY doc_id, item_id, band, windows HAVING count(DISTINCT q) >= windows * 0.5)
  USING (doc_id, item_id, band)),
mains AS (
  SELECT doc_id, item_id, band, pos AS main, count(*) AS own FROM held GROUP BY doc_id, item_id, band, pos
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, band ORDER BY own DESC, main) = 1),
places AS (
  SELECT * FROM held JOIN mains USING (doc_id, item_id, band)
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, band, q ORDER BY abs(pos - main), pos) = 1),
slot_tokens AS (
  SELECT item_id, j, ltrim(lower(w[j + 1]), chr(1) || chr(2)) AS item, size = 8 AND first[j + 1] AS opens,
         CASE WHEN size = 8 AND first[j + 1] THEN '<name>' ELSE t[j + 1] END AS type,
         list_contains([lower(w[k]) FOR k IN range(1, len(t) + 1) IF t[k] = '<name>'],
                       ltrim(lower(w[j + 1]), chr(1) || chr(2))) AS named
  FROM (SELECT *, unnest(range(0, len(t))) AS j FROM items)),
slots AS (
  SELECT doc_id, item_id, band, j, type, item, opens, named, opens AND other <> item AS turned, other
  FROM (SELECT p.doc_id, p.item_id, band, j, type, item, opens, named,
               ltrim(lower(d.w[j + pos + 1]), chr(1) || chr(2)) AS other
        FROM places p JOIN slot_tokens s ON s.item_id = p.item_id AND j >= q AND j < q + size
          AND type IN ('<num>', '<unit>', '<name>')
        JOIN templates d ON d.kind = 'doc' AND d.id = p.doc_id
        QUALIFY row_number() OVER (PARTITION BY p.doc_id, p.item_id, band, j ORDER BY abs(pos - main), pos) = 1)
  WHERE NOT opens OR other <> item OR named),
wrong AS (
  SELECT DISTINCT s.doc_id, s.item_id, s.band, s.j FROM slots s
  JOIN (SELECT doc_id, item_id, band, type, item FROM slots GROUP BY ALL HAVING count(DISTINCT other) > 1) x
  ON s.doc_id = x.doc_id AND s.item_id = x.item_id AND s.band = x.band AND s.type = x.type AND s.item = x.item
  WHERE s.turned),
remaining AS (
  SELECT * FROM places p WHERE NOT EXISTS (
    SELECT 1 FROM wrong x WHERE x.doc_id = p.doc_id AND x.item_id = p.item_id AND x.band = p.band
      AND x.j >= p.q AND x.j < p.q + p.size)),
last_slots AS (
  SELECT * FROM (
    SELECT p.doc_id, p.item_id, band, j, type, item, opens, named,
           ltrim(lower(d.w[j + pos + 1]), chr(1) || chr(2)) AS other
    FROM remaining p JOIN slot_tokens s ON s.item_id = p.item_id AND j >= q AND j < q + size
      AND type IN ('<num>', '<unit>', '<name>')
    JOIN templates d ON d.kind = 'doc' AND d.id = p.doc_id
    QUALIFY row_number() OVER (PARTITION BY p.doc_id, p.item_id, band, j ORDER BY abs(pos - main), pos) = 1)
  WHERE NOT opens OR other <> item OR named),
judged AS (
  SELECT doc_id, item_id, band, count(*) AS slots, count(*) FILTER (item <> other) AS changed,
         count(DISTINCT (type, item)) = count(DISTINCT (type, item, other)) AS agree
  FROM last_slots GROUP BY ALL),
standing AS (
  SELECT doc_id, item_id, band, windows, own, main, count(*) AS matched, arg_min(pos, q) AS start
  FROM remaining GROUP BY ALL HAVING count(*) >= windows * 0.5)
SELECT doc_id, item_id, start::BIGINT AS start, matched, windows::BIGINT AS windows,
       coalesce(slots, 0) AS slots, coalesce(changed, 0) AS changed
FROM standing LEFT JOIN judged USING (doc_id, item_id, band) WHERE coalesce(agree, true)
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, own DESC, main, band) = 1
""".replace("%s", decontaminate._UNIT)


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    chain = toxicity.learn(docs, table(spark, sf, "labels"))
    return toxicity.score(docs, chain).withColumn(
        "toxic", F.col("p_toxic") >= toxicity.THRESHOLD)


def op4_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = exact.exact_copies(table(spark, sf, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept",
                       F.lower(F.hex("digest")).alias("text_sha256"))


OP4_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


def op5_katz_lm(spark: SparkSession, sf: str) -> DataFrame:
    rows = katz.katz_scores(table(spark, sf, "documents"), order=ORDER)
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op7_warc(spark: SparkSession, sf: str) -> DataFrame:
    return warc.round_trip(table(spark, sf, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS winner,
         upper(sha1(coalesce(html, ''))) AS h
  FROM pages),
digits AS (
  SELECT page_id, n, winner,
         list_transform(range(0, 32), lambda i: (
           list_reduce(list_transform(range(0, 5), lambda j:
             ((strpos('0123456789ABCDEF', h[((i * 5 + j) // 4 + 1)::INT]) - 1)
              >> (3 - (i * 5 + j) % 4)::INT) & 1), lambda a, b: a * 2 + b))) AS d
  FROM p)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(d, lambda x: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(x + 1)::INT]),
                      'string_agg', '') AS payload_digest,
       CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> winner THEN winner END AS refers_to
FROM digits
"""


def op8_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return nearmin.near_groups(table(spark, sf, "documents"))


OP8_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                      lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS item FROM sets),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM items a JOIN items b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)
"""


def op9_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    both = bpe.there_and_back(table(spark, sf, "documents"), path, public_tokenizers.PATTERN)
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_secrets(spark: SparkSession, sf: str) -> DataFrame:
    rows = secrets.find_secrets(table(spark, sf, "documents"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return rows.select(
        "doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"),
        F.sha2(secrets.spelt(base), 256).alias("base_sha256"),
        secrets.spelt(F.col("spans")).alias("spans"))


def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
spans AS (SELECT lang, w, unnest([1, 2, 3]) AS size FROM pieces),
grams AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
          FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM spans)),
f AS (SELECT lang, size, phrase, count(*)::HUGEINT AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY ALL),
candidates AS (SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
cuts AS (SELECT *, unnest(range(1, size)) AS k FROM candidates),
scored AS (
  SELECT c.lang, c.phrase, c.size, a, k, x.f AS l, y.f AS r, 1000000 * a * a // (x.f * y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, k) = 1),
holders AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
        FROM candidates WHERE size = 3) GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
       s.phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM scored s JOIN totals USING (lang) LEFT JOIN holders h ON h.lang = s.lang AND h.phrase = s.phrase
WHERE longer IS NULL OR 100 * longer < 50 * a
QUALIFY rank <= 2000
"""


def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.divergence(table(spark, sf, "documents"))


OP12_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
words AS (SELECT d, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT d) >= 10),
kinds AS (SELECT lang, count(*) AS v, sum(lang_n)::BIGINT AS lang_total FROM kept GROUP BY ALL),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (
  SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total
  FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p,
         1 + (1000000000::HUGEINT * (lang_n + 2)) // (lang_total + 2 * v) AS q
  FROM totals JOIN kinds USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM every QUALIFY part = 'pair' OR rank <= 10
"""


def op13_token_file(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path(WORD_VOCABULARY)
    return tokenfile.round_trip(table(spark, sf, "documents"), path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_katz_lm": op5_katz_lm,
    "op6_quality": op6_quality,
    "op7_warc": op7_warc,
    "op8_near_dedup": op8_near_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_secrets": op10_secrets,
    "op11_phrases": op11_phrases,
    "op12_divergence": op12_divergence,
    "op13_token_file": op13_token_file,
}
ORACLES = {
    "op1_substring_dedup": OP1_SQL,
    "op2_decontaminate": OP2_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op7_warc": OP7_SQL,
    "op8_near_dedup": OP8_SQL,
    "op11_phrases": OP11_SQL,
    "op12_divergence": OP12_SQL,
}
