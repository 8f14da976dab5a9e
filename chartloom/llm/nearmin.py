"""Near-duplicate documents by a chosen-path set similarity join over minwise tokens.

A document's set holds its distinct shingles.  Equal sets are one class, and only its smallest
id goes on.  A tree begins with all of these and branches a node by the value of a minwise token
that the node's name chooses: once at its root, further down once or twice, 1/similarity times
in the mean, so that a pair at the threshold is expected in one child of each node it shares.
Nodes of up to ``SMALL`` documents are compared exhaustively; larger ones branch again.  Trees
are independent and repeated until a pair at the threshold is missed with a chance below 1e-5.

Nodes that stay large are groups of texts that are alike.  Their overlapping unions are first
joined to their most central members; every member that is then outside the largest component
is compared with all others, in blocks of bounded size, each by one task.  Pairs pass a 128-bit
sketch (a link fails it once in a million), and are confirmed on their full sets.

Rows and cases: without words a set is empty and linked with nothing; null texts are empty; a
null id or a repeated id with other text joins the links of all rows with that id; documents
that repeat an id with the same text are one class and each gets its row; other columns play no
part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import (
    WordHashes, arrow_pass, materialise, mixed, rows_of, rows_without, text_bytes, window_hashes,
    word_hashes)
from chartloom.llm.graph import components

SHINGLE, PERCENT = 5, 75
TREES, TOKENS, LEVELS = 16, 64, 4
SMALL, BLOCK = 32, 256
#: Of 128 sketch bits, a link at the threshold agrees in 112 on average, 3.7 either way.
AGREEING = 94
_SEEDS = mixed(np.arange(1, TOKENS + 129, dtype=np.uint64)) | np.uint64(1)


def shingle_set(text: str | None, known: WordHashes, size: int = SHINGLE) -> np.ndarray:
    words = word_hashes(text_bytes(text).lower().split(), known)
    if len(words) == 0:
        return words
    return np.unique(window_hashes(words, min(size, len(words)), seed=min(size, len(words))))


def minwise(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Minwise tokens (one row of ``TOKENS`` per set, none empty) and two longs of bits."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    least = np.empty((len(sets), len(_SEEDS)), np.uint64)
    for j, seed in enumerate(_SEEDS):
        least[:, j] = np.minimum.reduceat(flat * seed + (seed >> np.uint64(7)), starts)
    tokens = (mixed(least[:, :TOKENS]) >> np.uint64(33)).astype(np.int32)
    bits = (mixed(least[:, TOKENS:]) & np.uint64(1)).reshape(len(sets), 2, 64)
    return tokens, (bits << np.arange(64, dtype=np.uint64)).sum(2, dtype=np.uint64).view(np.int64)


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, set_key, sk1, sk2, tokens."""
    def make():
        known = WordHashes()

        def work(batch):
            sets = [shingle_set(t, known, size) for t in batch.column(1).to_pylist()]
            full = [i for i, s in enumerate(sets) if len(s)]
            tokens, bits = [None] * len(sets), np.zeros((len(sets), 2), np.int64)
            if full:
                found, bits[full] = minwise([sets[i] for i in full])
                for i, row in zip(full, found):
                    tokens[i] = row
            keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            return (batch.column(0), [len(s) for s in sets], keys, bits[:, 0], bits[:, 1],
                    pa.array(tokens, pa.list_(pa.int32())))
        return work

    return arrow_pass(
        docs, make,
        "doc_id long, n_shingles long, set_key binary, sk1 long, sk2 long, tokens array<int>",
        pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()),
                   ("sk1", pa.int64()), ("sk2", pa.int64()), ("tokens", pa.list_(pa.int32()))]))


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """id, items: the set as 64-bit values in a binary; rows of one id are made one."""
    def make():
        known = WordHashes()

        def work(batch):
            sets = [shingle_set(t, known, size).tobytes() for t in batch.column(1).to_pylist()]
            return batch.column(0), sets
        return work

    return arrow_pass(docs, make, "id long, items binary",
                      pa.schema([("id", pa.int64()), ("items", pa.binary())]))


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _may_link(a: str, b: str, percent: int) -> Column:
    """Sizes and sketches that a link can have."""
    n, m = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    apart = sum(F.bit_count(F.col(f"{a}.{s}").bitwiseXOR(F.col(f"{b}.{s}"))) for s in ("sk1", "sk2"))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (apart <= 128 - AGREEING)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are alike."""
    both = (
        pairs.join(sets.select(F.col("id").alias("b"), F.col("items").alias("right")), "b")
        .join(sets.select(F.col("id").alias("a"), F.col("items").alias("left")), "a")
        .select("a", "b", "left", "right")
    )

    def make():
        def work(batch):
            lefts, rights = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = [alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
                    for x, y in zip(lefts, rights)]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            return kept.column(0), kept.column(1)
        return work

    return arrow_pass(both, make, "a long, b long",
                      pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def chosen_paths(reps: DataFrame, percent: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """(node, id) of small nodes, and of nodes that are large after ``LEVELS`` branchings."""
    tokens = reps.select("id", "tokens")
    rows = tokens.select(
        "id", F.posexplode(F.slice("tokens", 1, trees)).alias("tree", "token")
    ).select(F.xxhash64("tree", "token").alias("node"), "id")
    small = None
    twice = round(100 * (100 / percent - 1))  # in a hundred nodes, so many branch twice
    for level in range(LEVELS):
        rows = materialise(rows, f"level{level}")
        sizes = rows.groupBy("node").count().filter("count > 1")
        sized = materialise(rows.join(sizes, "node"), f"sized{level}")
        done = sized.filter(F.col("count") <= SMALL).select("node", "id")
        small = done if small is None else small.unionByName(done)
        large = sized.filter(F.col("count") > SMALL).select("node", "id")
        if level == LEVELS - 1 or large.isEmpty():
            return small, large
        name = F.xxhash64("node", F.lit(level))
        first, second = F.pmod(name, F.lit(TOKENS)), F.pmod(
            F.xxhash64(name), F.lit(TOKENS))
        ways = F.when(F.pmod(F.shiftright(name, 20), F.lit(100)) < twice,
                      F.array_distinct(F.array(first, second))).otherwise(F.array(first))
        rows = (
            large.join(tokens, "id")
            .select("id", "node", "tokens", F.explode(ways).alias("way"))
            .select(F.xxhash64("node", "way", F.get("tokens", F.col("way").cast("int")))
                    .alias("node"), "id")
        )
    raise AssertionError


def pairs_within(nodes: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs a < b of small nodes that may be links."""
    facts = reps.select("id", "n_shingles", "sk1", "sk2")
    rows = materialise(nodes.join(facts, "id"), "members")
    return (
        rows.alias("x").join(rows.alias("y"), "node")
        .filter((F.col("x.id") < F.col("y.id")) & _may_link("x", "y", percent))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()
    )


def _bits(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A row of 128 zeros and ones for each sketch."""
    both = np.column_stack([first, second]).astype("<i8").view(np.uint8)
    return np.unpackbits(both, axis=1, bitorder="little")


def majorities(members: DataFrame) -> DataFrame:
    """(group, c1, c2): the majority of each sketch bit among the members (group, sk1, sk2).

    Votes are summed per batch, then in 32 parts of a group, then per group."""
    def make():
        def work(batch):
            groups, at = np.unique(batch.column(0).to_numpy(), return_inverse=True)
            votes = np.zeros((len(groups), 128), np.int64)
            np.add.at(votes, at, 2 * _bits(batch.column(1).to_numpy(), batch.column(2).to_numpy())
                      .astype(np.int64) - 1)
            part = xxhash.xxh32_intdigest(votes.tobytes()) % 32
            return groups, [part] * len(groups), votes.tolist()
        return work

    def added(table: pa.Table) -> pa.Table:
        votes = np.array(table["votes"].to_pylist()).sum(0)
        return pa.table({"group": table["group"][:1], "votes": pa.array([votes.tolist()])})

    def decided(table: pa.Table) -> pa.Table:
        votes = np.array(table["votes"].to_pylist()).sum(0)
        c1, c2 = np.packbits(votes > 0, bitorder="little").view("<i8").tolist()
        return pa.table({"group": table["group"][:1], "c1": pa.array([c1]), "c2": pa.array([c2])})

    votes = arrow_pass(
        members.select("group", "sk1", "sk2"), make, "group long, part long, votes array<long>",
        pa.schema([("group", pa.int64()), ("part", pa.int64()), ("votes", pa.list_(pa.int64()))]))
    return (
        votes.groupBy("group", "part").applyInArrow(added, "group long, votes array<long>")
        .groupBy("group").applyInArrow(decided, "group long, c1 long, c2 long")
    )


def central_pairs(members: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of each group's most central member, the one nearest to the majority of each
    sketch bit, with all other members that may be linked to it."""
    facts = materialise(
        members.join(reps.select("id", "n_shingles", "sk1", "sk2"), "id"), "facts")
    near = 128 - F.bit_count(F.col("sk1").bitwiseXOR(F.col("c1"))) - F.bit_count(
        F.col("sk2").bitwiseXOR(F.col("c2")))
    chosen = (
        facts.join(majorities(facts), "group")
        .groupBy("group").agg(F.max_by(F.struct("id", "n_shingles", "sk1", "sk2"),
                                       F.struct(near, -F.col("id"))).alias("p"))
        .select("group", "p.*")
    )
    return (
        facts.alias("x").join(chosen.alias("y"), "group")
        .filter((F.col("x.id") != F.col("y.id")) & _may_link("x", "y", percent))
        .select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        .distinct()
    )


def outsiders_against_all(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between a member outside its group's largest component and any other
    member with another label; members have group, id, label.

    Both sides are dealt to blocks of about ``BLOCK``; a task compares one block of each.
    """
    sizes = members.groupBy("group", "label").count()
    main = sizes.groupBy("group").agg(
        F.max_by("label", F.struct("count", -F.col("label"))).alias("main"),
        F.sum("count").alias("all"), F.max("count").alias("most"))
    main = main.filter(F.col("all") > F.col("most")).select(
        "group", "main", F.ceil(F.col("all") / BLOCK).alias("chunks"),
        F.ceil((F.col("all") - F.col("most")) / BLOCK).alias("blocks"))
    rows = members.join(main, "group")
    i = F.pmod(F.xxhash64("id"), F.col("blocks"))
    j = F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    outside = rows.filter("label != main").select(
        "group", "id", "label", i.alias("i"), every.alias("j"), F.lit(True).alias("outside"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    inside = rows.select(
        "group", "id", "label", every.alias("i"), j.alias("j"), F.lit(False).alias("outside"))
    cells = outside.unionByName(inside).join(sets, "id")

    def compare(cell: pa.Table) -> pa.Table:
        own = [np.frombuffer(x, np.uint64) for x in cell["items"].to_pylist()]
        ids, labels, outside = (cell[c].to_pylist() for c in ("id", "label", "outside"))
        links = []
        for x in (k for k, out in enumerate(outside) if out):
            for y in (k for k, out in enumerate(outside) if not out):
                n, m = len(own[x]), len(own[y])
                if labels[x] != labels[y] and 100 * min(n, m) >= percent * max(n, m) and alike(
                        own[x], own[y], percent):
                    links.append((min(ids[x], ids[y]), max(ids[x], ids[y])))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()),
                         "b": pa.array([b for _, b in links], pa.int64())})

    return cells.groupBy("group", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def _labels(links: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, label) of all given ids."""
    found = components(links)
    return ids.join(found, "id", "left").select("id", F.coalesce("label", "id").alias("label"))


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends have different labels."""
    left = labels.select(F.col("id").alias("a"), F.col("label").alias("la"))
    right = labels.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    return pairs.join(left, "a").join(right, "b").filter("la != lb").select("a", "b")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                size: int = SHINGLE, percent: int = PERCENT, trees: int = TREES) -> DataFrame:
    """A row per input row: doc_id, n_shingles, component_id, kept."""
    given = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.col(text_col).cast("string").alias("text"))
    sketched = materialise(sketches(given, size), "sketches")
    full = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = full.groupBy("set_key").agg(F.min("doc_id").alias("rep"))
    member = materialise(
        full.select("doc_id", "set_key").join(classes, "set_key").select("doc_id", "rep"), "classes")
    reps = materialise(
        full.join(classes.select(F.col("rep").alias("doc_id"), "set_key"), ["doc_id", "set_key"],
                  "left_semi")
        .dropDuplicates(["doc_id", "set_key"])
        .select(F.col("doc_id").alias("id"), "n_shingles", "sk1", "sk2", "tokens"), "reps")

    small, large = chosen_paths(reps, percent, trees)
    pairs = materialise(pairs_within(small, reps, percent), "pairs")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    grouped = not large.isEmpty()
    if grouped:
        least = large.groupBy("node").agg(F.min("id").alias("b"))
        groups = components(large.join(least, "node").select(F.col("id").alias("a"), "b"))
        groups = materialise(groups.select("id", F.col("label").alias("group")), "groups")
        wanted = wanted.union(groups.select("id"))
    wanted = materialise(wanted.distinct(), "wanted")
    texts = rows_of(given.withColumnRenamed("doc_id", "id"), wanted, "id")
    sets = materialise(
        shingle_sets(texts.select("id", "text"), size).dropDuplicates(["id", "items"]), "sets")

    # one pair per document and the groups' centres first: most others then lie within a component
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    if grouped:
        first = first.unionByName(central_pairs(groups, reps, percent)).distinct()
    links = materialise(confirmed(first, sets, percent), "links")
    labels = materialise(_labels(links, wanted), "labels")
    more = _apart(pairs, labels)
    if grouped:
        more = more.unionByName(_apart(
            central_pairs(_outside(groups, labels), reps, percent), labels)).distinct()
    links = links.unionByName(materialise(confirmed(more, sets, percent), "links"))
    by_class = materialise(_labels(links, wanted), "labels")
    if grouped:
        rest = materialise(
            outsiders_against_all(groups.join(by_class, "id"), sets, percent), "links")
        if not rest.isEmpty():
            links = links.unionByName(rest)
            by_class = components(links)

    classed = member.filter("doc_id != rep").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    # an id may stand in several classes, when rows repeat it with another text
    several = member.groupBy("doc_id").agg(
        F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low != high")
    if not materialise(several, "several").isEmpty():
        by_class = components(links.unionByName(classed))
    found = (
        member.distinct().join(by_class.withColumnRenamed("id", "rep"), "rep", "left")
        .groupBy("doc_id").agg(F.min(F.coalesce("label", "rep")).alias("component_id"))
    )
    return (
        sketched.select("doc_id", "n_shingles").join(found, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)))
    )


def _outside(groups: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (id, group) outside the largest component of their group."""
    rows = groups.join(labels, "id")
    sizes = rows.groupBy("group", "label").count()
    main = sizes.groupBy("group").agg(
        F.max_by("label", F.struct("count", -F.col("label"))).alias("main"))
    return rows.join(main, "group").filter("label != main").select("id", "group")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that a smaller id stands for, with all columns."""
    gone = near_groups(docs, id_col, text_col).filter(~F.col("kept")).select(
        F.col("doc_id").alias(id_col)).distinct()
    gone = materialise(gone, "gone")
    kind = docs.schema[id_col].dataType
    gone = gone.select(F.col(id_col).cast(kind).alias(id_col))
    return rows_without(docs, gone, id_col)
