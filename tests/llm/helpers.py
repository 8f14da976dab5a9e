"""Words as the operators define them, and small tables with every odd case."""

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORDS.findall(text or "")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def odd_texts(seed=1):
    """Null, empty, blank, short, very long, repeated and near-equal texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, base = draw(70), draw(300)
    rows = [None, "", " \t\n", "one", "One two\x0bthree\x1cfour\xa0five", "a b c d e", "A B C D E",
            " ".join(draw(20_000))]
    rows += [" ".join(base)] * 4
    for i in range(12):
        near = base[:]
        for at in rng.sample(range(300), rng.randint(1, 12)):
            near[at] = f"new{i}x{at}"
        rows.append(" ".join(near))
    for _ in range(12):
        own = draw(rng.randint(60, 150))
        at = rng.randrange(len(own))
        rows.append(" ".join(own[:at] + passage[rng.randint(0, 10):] + own[at:]))
    rows += [" ".join(passage[:60] + passage[:60]), " ".join(["x"] * 200), " ".join(["x"] * 120)]
    return rows


def table(spark, rows, schema="doc_id long, text string"):
    """With further columns whose names the operators use themselves."""
    extra = ("gone", 7, "own", b"1", 2.5)
    names = "digest string, row_id int, label string, items binary, score double"
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{schema}, {names}")
