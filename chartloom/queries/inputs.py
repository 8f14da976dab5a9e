"""Inputs that the queries share, derived by Spark from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.jsonval import to_json
from chartloom.operators.elements import HTML_BLOCKS, element_tree, text_elements
from chartloom.sources.tables import spread


#: Tasks on notes for each split of the orders, so that a task stays small whatever the table is.
TASKS_A_SPLIT = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, key: str, *columns: str) -> DataFrame:
    """Columns of a text table, spread for work that is heavy per row."""
    return spread(table(spark, sf_dir, name).select(key, *columns), key)


def lit_null() -> Column:
    return F.lit(None).cast("string")


def _text(value: Column) -> Column:
    return value.cast("string")


def _entity(k: Column) -> Column:
    """Entities with gaps that follow from the order key."""
    def symptom(i: Column) -> Column:
        n = k + i
        return F.struct(
            F.when(i == 0, "chest pain").otherwise("cough").alias("symptom"),
            F.when(n % 4 != 0, F.concat(F.lit("day "), _text(n % 10))).alias("onset"),
            F.when(n % 2 != 0, F.when(n % 3 == 0, "mild").when(n % 3 == 1, "moderate")
                   .otherwise("severe")).alias("severity"),
            F.when(n % 5 == 0, "").otherwise(F.col("segment")).alias("location"),
        )

    diagnosis = F.struct(
        F.concat(F.lit("condition "), _text(k % 50)).alias("diagnosis"),
        F.when(k % 2 != 0, F.concat(F.lit("J"), _text(k % 80 + 10))).alias("icd10_code"),
        F.when(F.col("o_orderstatus") == "F", "confirmed")
        .when(F.col("o_orderstatus") == "O", "suspected")
        .otherwise("differential").alias("status"),
    )
    medication = F.struct(
        F.concat(F.lit("drug "), _text(k % 30)).alias("name"),
        F.when(k % 3 != 0, F.concat(_text(k % 9 + 1), F.lit("00mg"))).alias("dosage"),
        F.when(k % 6 != 0, F.lit("BID")).alias("frequency"),
        lit_null().alias("route"),
    )
    procedure = F.struct(F.lit("ECG").alias("procedure"), lit_null().alias("cpt_code"))

    def one(item: Column, condition: Column) -> Column:
        return F.filter(F.array(item), lambda _: condition)

    return F.struct(
        F.when(k % 7 == 0, lit_null()).when(k % 11 == 0, "")
        .otherwise(F.concat("o_orderpriority", F.lit(" visit"))).alias("chief_complaint"),
        F.transform(
            F.filter(F.array(F.lit(0), F.lit(1)), lambda i: i < k % 3), symptom
        ).alias("symptoms"),
        one(diagnosis, k % 4 != 0).alias("diagnoses"),
        one(medication, k % 5 > 1).alias("medications"),
        one(procedure, k % 8 == 0).alias("procedures"),
        F.struct(
            F.concat(_text(k % 60 + 100), F.lit("/"), _text(k % 30 + 60)).alias("blood_pressure"),
            F.when(k % 9 != 0, F.concat(_text(k % 4 + 97), F.lit("F"))).alias("temperature"),
            _text(k % 50 + 60).alias("heart_rate"),
            lit_null().alias("respiratory_rate"),
            F.concat(F.lit("9"), _text(k % 10), F.lit("%")).alias("oxygen_saturation"),
        ).alias("vital_signs"),
        one(F.lit("penicillin"), k % 6 == 0).alias("allergies"),
        F.struct(
            F.when(k % 2 == 0, "never").alias("smoking"),
            lit_null().alias("alcohol"),
            F.lit("").alias("occupation"),
        ).alias("social_history"),
        F.when(k % 10 == 0, "low").when(k % 3 == 0, "medium").otherwise("high")
        .alias("extraction_confidence"),
        F.array().cast("array<string>").alias("missing_information"),
    )


def _note(e: Column, k: Column) -> Column:
    """Encounter note that states the entities; one in thirteen leaves out the drugs."""
    drugs = F.transform(
        e["medications"],
        lambda m: F.concat_ws(" ", m["name"], m["dosage"], m["frequency"]),
    )
    vitals = e["vital_signs"]
    blank = F.lit("")
    return F.concat(
        F.lit("MRN: "), F.col("mrn"), F.lit(" PATIENT: "), F.col("patient_name"),
        F.lit(" ENCOUNTER DATE: "), F.col("visit_date"),
        F.lit("\nCHIEF COMPLAINT: "), F.coalesce(e["chief_complaint"], blank),
        F.lit("\nSYMPTOMS: "),
        F.array_join(F.transform(e["symptoms"], lambda s: s["symptom"]), ", "),
        F.lit("\nVITAL SIGNS: BP: "), vitals["blood_pressure"],
        F.lit(", HR: "), vitals["heart_rate"],
        F.lit(", Temp: "), F.coalesce(vitals["temperature"], blank),
        F.lit(", SpO2: "), vitals["oxygen_saturation"],
        F.lit("\nMEDICATIONS: "), F.when(k % 13 == 0, blank).otherwise(F.array_join(drugs, "; ")),
        F.lit("\nASSESSMENT: "),
        F.array_join(F.transform(e["diagnoses"], lambda d: d["diagnosis"]), ". "),
        F.lit(".\nPLAN: "),
        F.array_join(F.transform(e["procedures"], lambda p: F.concat(p["procedure"],
                                                                     F.lit(" ordered."))), " "),
    )


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a visit: identity, entity struct and JSON, and the note."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    # lower-cased once for a customer, not for each symptom of each order
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.lower("c_mktsegment").alias("segment"))
    k = F.col("o_orderkey")
    # spread behind the join, which would leave a few tasks with all the work on the notes
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey).drop("c_custkey")
    cores = spark.sparkContext.defaultParallelism
    tasks = max(cores, TASKS_A_SPLIT * orders.rdd.getNumPartitions())
    visits = joined.repartition(tasks, "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice").select(
        k.alias("k"),
        F.concat(F.lit("enc-"), _text(k)).alias("document_id"),
        F.concat(F.lit("MRN"), F.lpad(_text(F.col("o_custkey")), 8, "0")).alias("mrn"),
        F.col("c_name").alias("patient_name"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("visit_date"),
        _entity(k).alias("entity"),
        "o_orderdate",
        "o_totalprice",
    )
    return visits.withColumns(
        {"entities": to_json(F.col("entity")), "text": _note(F.col("entity"), F.col("k"))}
    )


ENC = """
enc AS (
  SELECT k, document_id, mrn, patient_name, visit_date, e, o_orderdate, o_totalprice,
    to_json(e)::VARCHAR AS entities,
    'MRN: ' || mrn || ' PATIENT: ' || patient_name || ' ENCOUNTER DATE: ' || visit_date
    || chr(10) || 'CHIEF COMPLAINT: ' || coalesce(e.chief_complaint, '')
    || chr(10) || 'SYMPTOMS: ' || array_to_string([s.symptom FOR s IN e.symptoms], ', ')
    || chr(10) || 'VITAL SIGNS: BP: ' || e.vital_signs.blood_pressure
    || ', HR: ' || e.vital_signs.heart_rate
    || ', Temp: ' || coalesce(e.vital_signs.temperature, '')
    || ', SpO2: ' || e.vital_signs.oxygen_saturation
    || chr(10) || 'MEDICATIONS: ' || CASE WHEN k % 13 = 0 THEN '' ELSE array_to_string(
         [concat_ws(' ', m.name, m.dosage, m.frequency) FOR m IN e.medications], '; ') END
    || chr(10) || 'ASSESSMENT: ' || array_to_string([d.diagnosis FOR d IN e.diagnoses], '. ')
    || '.' || chr(10) || 'PLAN: '
    || array_to_string([p.procedure || ' ordered.' FOR p IN e.procedures], ' ') AS text
  FROM (
    SELECT o_orderkey AS k, 'enc-' || o_orderkey AS document_id,
      'MRN' || lpad(o_custkey::VARCHAR, 8, '0') AS mrn, c_name AS patient_name,
      strftime(o_orderdate, '%Y-%m-%d') AS visit_date, o_orderdate, o_totalprice,
      {
        'chief_complaint': CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN ''
          ELSE o_orderpriority || ' visit' END,
        'symptoms': [{
          'symptom': CASE WHEN i = 0 THEN 'chest pain' ELSE 'cough' END,
          'onset': CASE WHEN (o_orderkey + i) % 4 <> 0
            THEN 'day ' || ((o_orderkey + i) % 10)::VARCHAR END,
          'severity': CASE WHEN (o_orderkey + i) % 2 <> 0 THEN
            CASE (o_orderkey + i) % 3 WHEN 0 THEN 'mild' WHEN 1 THEN 'moderate'
            ELSE 'severe' END END,
          'location': CASE WHEN (o_orderkey + i) % 5 = 0 THEN '' ELSE lower(c_mktsegment) END
        } FOR i IN range(o_orderkey % 3)],
        'diagnoses': [{
          'diagnosis': 'condition ' || (o_orderkey % 50)::VARCHAR,
          'icd10_code': CASE WHEN o_orderkey % 2 <> 0
            THEN 'J' || (o_orderkey % 80 + 10)::VARCHAR END,
          'status': CASE o_orderstatus WHEN 'F' THEN 'confirmed' WHEN 'O' THEN 'suspected'
            ELSE 'differential' END
        } FOR i IN range(CASE WHEN o_orderkey % 4 <> 0 THEN 1 ELSE 0 END)],
        'medications': [{
          'name': 'drug ' || (o_orderkey % 30)::VARCHAR,
          'dosage': CASE WHEN o_orderkey % 3 <> 0 THEN (o_orderkey % 9 + 1)::VARCHAR || '00mg' END,
          'frequency': CASE WHEN o_orderkey % 6 <> 0 THEN 'BID' END,
          'route': NULL::VARCHAR
        } FOR i IN range(CASE WHEN o_orderkey % 5 > 1 THEN 1 ELSE 0 END)],
        'procedures': [{'procedure': 'ECG', 'cpt_code': NULL::VARCHAR}
          FOR i IN range(CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 0 END)],
        'vital_signs': {
          'blood_pressure': (o_orderkey % 60 + 100)::VARCHAR || '/'
            || (o_orderkey % 30 + 60)::VARCHAR,
          'temperature': CASE WHEN o_orderkey % 9 <> 0
            THEN (o_orderkey % 4 + 97)::VARCHAR || 'F' END,
          'heart_rate': (o_orderkey % 50 + 60)::VARCHAR,
          'respiratory_rate': NULL::VARCHAR,
          'oxygen_saturation': '9' || (o_orderkey % 10)::VARCHAR || '%'
        },
        'allergies': ['penicillin' FOR i IN range(CASE WHEN o_orderkey % 6 = 0 THEN 1 ELSE 0 END)],
        'social_history': {
          'smoking': CASE WHEN o_orderkey % 2 = 0 THEN 'never' END,
          'alcohol': NULL::VARCHAR,
          'occupation': ''
        },
        'extraction_confidence': CASE WHEN o_orderkey % 10 = 0 THEN 'low'
          WHEN o_orderkey % 3 = 0 THEN 'medium' ELSE 'high' END,
        'missing_information': []::VARCHAR[]
      } AS e
    FROM orders JOIN customer ON o_custkey = c_custkey
  )
)"""


def paged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as parsed element trees, a new page after every ten lines."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line, n: F.when((n > 0) & (n % 10 == 0), F.concat(F.lit("\f"), line)).otherwise(line),
    )
    paged = F.array_join(lines, "\n")
    return texts(spark, sf_dir, "documents", "doc_id", "text").select(
        F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"),
        element_tree(text_elements(paged)).alias("parsed_content"),
    )


# Lines of documents with their element category; form feeds do not occur in the input.
LINES = """
lines AS (
  SELECT doc_id, n, trim(line, ' ') AS text,
    CASE WHEN regexp_matches(line, '\\||\\t') THEN 'Table'
      WHEN regexp_matches(line, '^\\s*(?:[-*•]|\\d+[.)])\\s') THEN 'ListItem'
      WHEN regexp_matches(line, '^\\s*[A-Z][A-Z /]+:\\s*\\S') THEN 'NarrativeText'
      WHEN regexp_matches(line, '^\\s*\\p{Lu}[^.!?]*$') THEN 'Title'
      ELSE 'NarrativeText' END AS type
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS n FROM documents)
  WHERE trim(line, ' ') <> ''
)"""

# Visible blocks of HTML pages with their element category.
BLOCKS = r"""
visible AS (
  SELECT page_id, regexp_replace(html,
    '(?is)<head\b.*?</head>|<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g') AS v
  FROM pages),
parts AS (
  SELECT page_id, unnest(ps) AS part, generate_subscripts(ps, 1) AS m
  FROM (SELECT page_id, string_split(regexp_replace(regexp_replace(v,
      '(?i)<table\b', chr(3) || '\0', 'g'), '(?i)</table\s*>', '\0' || chr(3), 'g'), chr(3)) AS ps
    FROM visible)),
pieces AS (
  SELECT page_id, m, unnest(bs) AS piece, generate_subscripts(bs, 1) AS n
  FROM (SELECT page_id, m, CASE WHEN regexp_matches(part, '(?i)^<table\b') THEN ['table' || chr(2) || part]
      ELSE string_split(regexp_replace(part, '(?i)<(/?(?:%s))(?:\s[^>]*)?/?>',
        chr(1) || '\1' || chr(2), 'g'), chr(1)) END AS bs
    FROM parts)),
blocks AS (
  SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY m, n) - 1 AS pos, type, text,
    CASE WHEN type = 'Table' THEN string_split(piece, chr(2))[2] END AS html
  FROM (
    SELECT page_id, m, n, piece,
      CASE WHEN NOT contains(piece, chr(2)) THEN 'NarrativeText'
        WHEN regexp_matches(piece, '(?i)^h[1-6]' || chr(2)) THEN 'Title'
        WHEN regexp_matches(piece, '(?i)^li' || chr(2)) THEN 'ListItem'
        WHEN regexp_matches(piece, '^table' || chr(2) || '(?i)<table') THEN 'Table'
        ELSE 'NarrativeText' END AS type,
      trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(
        regexp_replace(string_split(piece, chr(2))[-1], '<[^>]*>', ' ', 'g'), '&nbsp;', ' '),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&copy;', '©'),
        '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'), ' ') AS text
    FROM pieces)
  WHERE text <> ''
)""" % "|".join(HTML_BLOCKS)
