"""Templates and slots of benchmark items."""

import random
import time

import regex
from pyspark.sql import functions as F

from chartloom.llm import decontaminate
from tests.llm.helpers import table

ITEMS = [
    (1, "A farmer named Alice has 12 apples and gives 5 kg of apples to Alice again, so how many "
        "of the 12 apples are left for the farmer in the end?"),
    (2, "Short item here"),
    (3, None),
    (4, "..."),
    (5, "There was a river that ran to the sea and nobody ever asked why it did so."),
]
COPY = "Intro text. " + ITEMS[0][1] + " Some more text follows."
OTHER = COPY.replace("Alice", "Robert").replace("12", "94").replace("5 kg", "7 pounds")
UNEVEN = OTHER.replace("of the 94", "of the 31")
DOCS = [
    (10, COPY), (11, OTHER), (12, UNEVEN), (13, None), (14, ""), (None, COPY),
    (15, "nothing to see here at all, only plain words in a long enough row of words"),
    (16, "well: short item here, indeed"), (17, ITEMS[4][1].upper().replace(" ", "*** ")),
    (18, ITEMS[4][1][:30]), (19, COPY), (19, COPY), (20, "filler " * 50_000 + ITEMS[4][1]),
]


def found(spark, docs=DOCS, items=ITEMS):
    frame = decontaminate.contaminated(table(spark, docs), table(spark, items, "item_id long, text string"))
    return {(r.doc_id, r.item_id): r for r in frame.collect()}


def test_items(spark):
    got = found(spark)
    assert set(got) == {(10, 1), (11, 1), (16, 2), (17, 5), (19, 1), (20, 5)}
    assert got[10, 1].changed == 0 and got[10, 1].start == 2
    assert got[10, 1].slots == got[11, 1].slots == 6 and got[11, 1].changed == 6
    assert got[20, 5].start == 50_000


def test_shuffled_windows(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    monkeypatch.setattr("chartloom.llm.common.BROADCAST_ROWS", 0)
    assert set(found(spark)) == {(10, 1), (11, 1), (16, 2), (17, 5), (19, 1), (20, 5)}


def test_drop(spark):
    docs = table(spark, DOCS)
    left = decontaminate.drop_contaminated(docs, table(spark, ITEMS, "item_id long, text string"))
    assert left.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 12, 13, 14, 15, 18]


def test_empty_tables(spark):
    assert not found(spark, [], ITEMS)
    assert not found(spark, DOCS, [])


def test_template(spark):
    row = spark.range(1).select(decontaminate.tokens_of(F.lit(
        "He saw Bob run 5km. Then 3.5 miles, naïve ABC x1")).alias("t")).select(
        F.transform("t", decontaminate.template_of).alias("t"),
        F.transform("t", decontaminate.value_of).alias("v")).first()
    assert row.t == ["he", "saw", "<name>", "run", "<num>", "<unit>", "then", "<num>", "<unit>",
                     "naïve", "abc", "x", "<num>"]
    assert row.v[2:9] == ["bob", "run", "5", "km", "then", "3.5", "miles"]


LONG = ("A farmer named Alice has 12 apples in 3 kg boxes and gives 5 of the 12 apples to a friend "
        "called Robert who then eats 3 of them, so how many of the 12 apples are left for Alice now?")


def test_copies_that_go_on_differently(spark):
    cut = " ".join(LONG.split()[:32]) + " old Berta ran 77 miles with 99 dogs over the hills at night"
    [row] = found(spark, [(1, cut)], [(1, LONG)]).values()
    assert row.matched < row.windows and row.changed == 0 and row.start == 0


def test_inserted_and_left_out_words(spark):
    w = LONG.replace("Alice", "Berta").replace("12", "40").split()
    uneven = " ".join(w).replace("of the 40 apples are", "of the 41 apples are")
    docs = [(1, " ".join([*w[:19], "really", *w[19:]])), (2, " ".join([*w[:19], *w[20:]])),
            (3, "Well: " + " ".join([*w[:19], "and", "so", "forth", *w[19:]])), (4, uneven),
            (5, " ".join(w) + " " + LONG)]
    got = found(spark, docs, [(1, LONG)])
    assert set(got) == {(1, 1), (2, 1), (3, 1), (5, 1)}
    assert [got[i, 1].start for i in (1, 2, 3, 5)] == [0, 0, 1, 0]
    assert got[1, 1].matched == got[1, 1].windows - 7 and got[1, 1].changed == 5


MARIA = ("Maria bought 12 pencils and 3 notebooks for school. Maria then gave 4 pencils to Tom. Tom lost 2 "
         "of them on the way home. How many pencils does Maria have left?")
FIRST_ONLY = MARIA.replace("to Tom. Tom lost", "away. Bob lost").replace("does Maria have", "are")


def renamed(text, *pairs):
    for old, new in pairs:
        text = text.replace(old, new)
    return text


def test_names_that_begin_sentences(spark):
    new = (("Maria", "Elena"), ("Tom", "Oscar"), ("12", "15"), ("3 ", "6 "))
    docs = [
        (1, renamed(MARIA, *new)), (2, MARIA), (3, "Before it. " + renamed(MARIA, *new) + " After it."),
        (4, renamed(MARIA, *new).replace("does Elena", "does Clara").replace("to Oscar", "to Felix")),
        (5, renamed(FIRST_ONLY, ("Maria", "Elena"), ("Bob", "Oscar"))),
        (6, "in one go: " + MARIA.lower()),
    ]
    got = found(spark, docs, [(1, MARIA), (2, FIRST_ONLY)])
    assert {1, 2, 3, 5} <= {d for d, _ in got} and (4, 1) not in got
    assert got[1, 1].matched == got[1, 1].windows and got[1, 1].changed == 7
    assert got[2, 1].matched == got[2, 1].windows and got[2, 1].changed == 0
    assert got[3, 1].start == 2
    assert got[5, 2].matched == got[5, 2].windows and got[5, 2].changed == 3


def test_first_words_that_are_no_names(spark):
    item = ("The river runs to the sea by day and night. The people of the old town never ask why it does. "
            "The boats lie on the sand and wait for the tide to come in again.")
    docs = [(1, item.replace("night. The", "night. Those")), (2, item)]
    got = found(spark, docs, [(1, item)])
    assert set(got) == {(1, 1), (2, 1)} and got[2, 1].slots == 0


def brute(docs, items, share=0.5):
    """The rule by loops over all places; windows are compared token by token."""
    units = "|".join(sorted(decontaminate.UNITS, key=lambda u: (-len(u), u)))

    def tokens(text):
        text = regex.sub(rf"(\p{{N}})[\x20\x09-\x0D]*((?i:{units}))\b", "\\1 \x02\\2", text or "")
        text = regex.sub(r"(^|[.!?:][\"')\]]*[\x20\x09-\x0D]+)(\p{Lu})", "\\1\x01\\2", text)
        out = []
        for t in regex.findall(r"[\x01\x02]?(?:\p{N}+(?:[.,:/]\p{N}+)*|[\p{L}\p{M}']+)", text):
            cap = regex.match(r"\x01?\p{Lu}[\p{Ll}\p{M}']+$", t)
            kind = ("<unit>" if t[0] == "\x02" else "<num>" if regex.match(r"\p{N}", t) else
                    "<name>" if cap and t[0] != "\x01" else None)
            out.append((kind, t.lower().lstrip("\x01\x02"), bool(cap) and t[0] == "\x01"))
        return out

    def same(own, other, full):
        kind = other[0] or ("<name>" if full and other[2] else other[1])
        return kind == (own[0] or own[1]) or full and own[2] and kind == "<name>"

    best = {}
    for d, text in docs:
        doc = tokens(text)
        for i, body in items:
            item = tokens(body)
            if d is None or not item:
                continue
            size = min(len(item), 8)
            windows, step = len(item) - size + 1, len(item) // 2 + 1
            hits = [(q, p - q) for q in range(windows) for p in range(len(doc) - size + 1)
                    if all(same(item[q + k], doc[p + k], size == 8) for k in range(size))]
            names = {t[1] for t in item if t[0] == "<name>"}
            for band in {b for _, a in hits for b in (a // step, a // step - 1)}:
                own = [(q, a) for q, a in hits if band in (a // step, a // step - 1)]
                if len({q for q, _ in own}) < windows * share:
                    continue
                number = {a: sum(x == a for _, x in own) for _, a in own}
                main = min(number, key=lambda a: (-number[a], a))
                places = {q: min((a for x, a in own if x == q), key=lambda a: (abs(a - main), a)) for q, _ in own}

                def slots(places):
                    out = []
                    for j, (kind, value, first) in enumerate(item):
                        over = [a for q, a in places.items() if q <= j < q + size]
                        opens = first and size == 8
                        if not over or not (kind or opens):
                            continue
                        at = min(over, key=lambda a: (abs(a - main), a))
                        other = doc[j + at][1]
                        if not opens or other != value or value in names:
                            out.append((j, "<name>" if opens else kind, value, other, opens and other != value))
                    return out

                def uneven(found):
                    values = {}
                    for _, kind, value, other, _ in found:
                        values.setdefault((kind, value), set()).add(other)
                    return {k for k, v in values.items() if len(v) > 1}

                found = slots(places)
                wrong = [s[0] for s in found if s[4] and s[1:3] in uneven(found)]
                places = {q: a for q, a in places.items() if not any(q <= j < q + size for j in wrong)}
                found = slots(places)
                if len(places) < windows * share or uneven(found):
                    continue
                row = (len(places), number[main], -main, -band, places[min(places)], windows, len(found),
                       sum(s[2] != s[3] for s in found))
                best[d, i] = max(best.get((d, i), row), row)
    return {k: (v[4], v[0], *v[5:]) for k, v in best.items()}


def test_against_brute_force(spark):
    rng = random.Random(11)
    items = [(1, ITEMS[0][1]), (2, LONG), (3, MARIA), (4, FIRST_ONLY), (5, "Short item here"),
             (6, " ".join(str(n % 7) for n in range(20))), (7, "Eight words make one window of this item.")]
    docs = []
    for n in range(60):
        text = rng.choice(items)[1]
        for _ in range(rng.randint(0, 4)):
            words = text.split()
            at = rng.randrange(len(words))
            words[at:at + rng.randint(0, 1)] = rng.choice([["really"], ["And."], ["Bob"], ["17"], []])
            text = " ".join(words)
        for old, new in rng.sample([("Alice", "Berta"), ("12", "9"), ("Maria", "Elena"), ("Tom", "Bob"), ("kg", "lb")], 2):
            text = text.replace(old, new)
        docs.append((n, rng.choice(["", "Before it. ", "some words and "]) + text + rng.choice(["", " After. " + text])))
    got = {k: (r.start, r.matched, r.windows, r.slots, r.changed) for k, r in found(spark, docs, items).items()}
    want = brute(docs, items)
    assert got == want and len(want) > 20


def test_lists_of_numbers(spark):
    """All windows are alike: no place is compared with all others."""
    numbers = " ".join(str(n * 37 % 1000) for n in range(20_000))
    item = " ".join(str(n * 37 % 1000) for n in range(500, 600))
    start = time.monotonic()
    got = found(spark, [(1, numbers), (2, " ".join(["5"] * 3_000))], [(1, item)])
    assert got[1, 1].matched == got[1, 1].windows == 93
    assert time.monotonic() - start < 120
