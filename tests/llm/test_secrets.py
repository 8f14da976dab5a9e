"""Secrets against Python's regular expressions, and the battery on known strings."""

import hashlib
import random
import re

from chartloom.llm import secrets
from pyspark.sql import functions as F

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")


def base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m.group()) >= 16]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if len(m.group()) >= 32]
    return sorted(spans)


def texts():
    rng = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    key = lambda n, a: "".join(rng.choice(a) for _ in range(n))
    rows = [
        None, "", "password = hunter2hunter2", "token: secret:abcdefghijk", "É🙂 api_key='abcd1234'",
        "AKIA" + "B" * 12, "AKIA" + "B" * 11, "AKIAAKIA" + "Z" * 12, "x" * 300_000,
        "0123456789abcdef" * 2 + "g" + "ab" * 40, "APIKEY=abcdefgh APIKEY=abcdefgh",
        "passwordpassword=12345678", "secret\"  :  'a.b-c_d=e+f/g", "ab" * 15,
        "key " + key(64, b64) + " end", "key " + key(40, b64) + " and " + key(60, b64),
    ]
    parts = ["password", "=", ":", " ", "'", "abcdefgh", "deadbeef" * 4, "AKIA", "ABCD1234ABCD", "é",
             "token", "x9", "\n"]
    rows += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(200)]
    rows += [" ".join("".join(rng.choice(["the", "ing", "on", "er", "th"]) for _ in range(
        rng.randint(1, 9))) for _ in range(200)) for _ in range(40)]
    return rows


def test_spans(spark):
    rows = texts()
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").withColumn(
        "spans", F.lit("own")).withColumn("base", F.lit(1))
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in secrets.find_secrets(docs).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(rows):
        assert [s for s in got[i] if s[1] < 3] == base(text), text
    added = {i: [s for s in spans if s[1] == 3] for i, spans in got.items()}
    assert added[14] == [(4, 3, 68)] and len(added[15]) == 2
    assert not any(added[i] for i in range(len(rows) - 40, len(rows)))
    assert not added[8]


def test_empty_table(spark):
    assert secrets.find_secrets(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_digest(spark):
    docs = spark.createDataFrame([(1, "password = hunter2hunter2")], "doc_id long, text string")
    row = secrets.find_secrets(docs).select(secrets.spelt(F.col("spans")).alias("s")).first()
    assert row.s == "assign:0:25"
    assert hashlib.sha256(row.s.encode()).hexdigest()


def test_smaller_alphabets(spark):
    rng = random.Random(11)
    digits, lower = "0123456789", "abcdefghijklmnopqrstuvwxyz"
    kinds = [(lower + digits, 128), (lower + "234567", 128), (lower.upper() + digits, 128),
             ("".join(c for c in digits + lower.upper() + lower if c not in "0OIl"), 1024),
             (digits + lower.upper() + lower, 4096)]
    for number, (alphabet, n) in enumerate(kinds):
        rows = [(i, "see " + "".join(rng.choice(alphabet) for _ in range(n)) + " there") for i in range(40)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        spans = [[tuple(s) for s in r.spans] for r in secrets.find_secrets(docs).collect()]
        assert sum(x == [(4, 3, 4 + n)] for x in spans) >= 38, number
