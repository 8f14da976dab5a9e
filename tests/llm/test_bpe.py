"""Byte-level BPE against the tiktoken library, there and back."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from chartloom.llm import bpe
from tests.llm.helpers import odd_texts, table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.parse_ranks(bpe.read_ranks(PATH))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS,
                            special_tokens={})


def test_round_trip(spark):
    rows = list(enumerate([*odd_texts(), "<|endoftext|> a", "a" * 3000, "\x00　\x85 é🙂日本"]))
    encoded = bpe.encode(table(spark, rows), PATH, public_tokenizers.PATTERN)
    got = {r.doc_id: r for r in bpe.decode(encoded, PATH).collect()}
    for d, text in rows:
        ids = LIBRARY.encode_ordinary(text or "")
        assert np.frombuffer(got[d].ids, "<u4").tolist() == ids
        assert got[d].n_tokens == len(ids) and bytes(got[d].decoded) == (text or "").encode()


def test_one_pass_is_both(spark):
    docs = table(spark, list(enumerate(odd_texts())))
    two = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    one = bpe.there_and_back(docs, PATH, public_tokenizers.PATTERN)
    assert one.columns == two.columns
    assert sorted(map(tuple, one.collect()), key=lambda r: r[0]) == sorted(map(tuple, two.collect()), key=lambda r: r[0])


def test_random_texts():
    rng = random.Random(4)
    letters = "aaabst \n\t\x1c\x85　​'sldé1२Ⅷ-.!日🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    assert [i.tolist() for i in encoder.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_merges_that_come_first_later():
    """A merge may make a pair possible whose rank is lower than its own."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"ab", b"cab", b"bc", b"aa"]
    ranks = {t: i for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("t", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    encoder = bpe.Encoder(ranks, r"\S+|\s+")
    assert [i.tolist() for i in encoder.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_forgets(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 10)
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in ("one two three four five six seven", "eight nine ten eleven twelve one", "two"):
        assert encoder.encode([text])[0].tolist() == LIBRARY.encode_ordinary(text)


def test_size_of_vocabulary_is_checked(monkeypatch):
    monkeypatch.setattr(bpe, "LARGEST_VOCABULARY", 1000)
    with pytest.raises(ValueError):
        bpe.read_ranks(PATH)


def test_empty_table(spark):
    encoded = bpe.encode(table(spark, []), PATH, public_tokenizers.PATTERN)
    assert bpe.decode(encoded, PATH).count() == 0


def test_segments_take_little_memory():
    """Cutting takes a few bytes for each byte of text, not a wide number for several of them."""
    import tracemalloc
    text = "a few words of a note, " * 100_000
    tracemalloc.start()
    array, counts = bpe.segments([text, None])
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert b"".join(array.to_pylist()) == text.encode() and counts.tolist()[1] == 0
    assert peak < 20 * len(text)


def test_new_pieces_take_little_memory(monkeypatch):
    """Many new pieces are replayed in runs, with the same ids."""
    import tracemalloc
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    pieces = [f"piece{i * 7919}x".encode() for i in range(30_000)]
    whole = bpe.replay(pieces[:3000], ranks)
    tracemalloc.start()
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    for piece in pieces:
        encoder.pieces.numbers[piece.decode()]
    encoder._learn_pieces()
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert encoder.pieces.of(np.arange(3000))[0].tolist() == [i for ids in whole for i in ids]
    assert peak < 60 * sum(map(len, pieces))
    monkeypatch.setattr(bpe, "REPLAYED", 10)
    assert list(bpe.replayed(pieces[:50] + [b"z" * 40, b""], ranks)) == bpe.replay(pieces[:50] + [b"z" * 40, b""], ranks)


def test_waves_are_the_merges_of_each_piece():
    """Pieces of all lengths side by side, also where a merge makes a lower pair possible, against the library."""
    tokens = [bytes([i]) for i in range(256)] + [b"abc", b"ab", b"cab", b"bc", b"aa", b"aaaa", b"bcab"]
    own = {t: i for i, t in enumerate(tokens)}
    library = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=own, special_tokens={})
    rng = random.Random(6)
    pieces = ["".join(rng.choice("aabc") for _ in range(n)) for n in list(range(1, 80)) * 8 + [2000]]
    flat, counts = bpe.Merges(own).encode([p.encode() for p in pieces], own)
    ids = np.split(flat, np.cumsum(counts)[:-1])
    assert [i.tolist() for i in ids] == [library.encode_ordinary(p) for p in pieces]


def test_segments_are_cut_together(monkeypatch):
    """Cutting many segments at once changes no id, whatever stands at their ends, nor does a pattern that
    leaves text out."""
    monkeypatch.setattr(bpe, "CUT_AT_ONCE", 9)
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab1 \n\t\x85　'sé!日🙂") for _ in range(rng.randint(0, 60))) for _ in range(400)]
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    assert [i.tolist() for i in encoder.encode(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]
    words = tiktoken.Encoding("w", pat_str=r"[a-z]+", mergeable_ranks=RANKS, special_tokens={})
    encoder = bpe.Encoder(RANKS, r"[a-z]+")
    assert [i.tolist() for i in encoder.encode(texts)] == [words.encode_ordinary(t) for t in texts]


def test_new_pieces_are_encoded_by_columns():
    """30,000 new pieces take no Python step for each of their merges."""
    import sys
    encoder = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    text = " ".join(f"w{i * 7919:x}q" for i in range(30_000))
    lines = 0

    def count(frame, event, arg):
        nonlocal lines
        lines += event == "line"
        return count

    sys.settrace(count)
    try:
        ids = encoder.encode([text])[0]
    finally:
        sys.settrace(None)
    assert ids.tolist() == LIBRARY.encode_ordinary(text) and lines < 10 * 30_000


def test_a_task_encodes_little_at_once(spark, monkeypatch):
    """A batch of 4 MB of texts full of new words takes the memory of a part of it, with the same ids."""
    import tracemalloc

    import pyarrow as pa
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(2_000)) for _ in range(180)]
    docs, runs = table(spark, []), []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: runs.append(run))
    bpe.there_and_back(docs, PATH, public_tokenizers.PATTERN)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    list(runs[0](iter([batch.slice(0, 1)])))
    tracemalloc.start()
    sizes = [n for out in runs[0](iter([batch])) for n in out.column(1).to_pylist()]
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sizes == [len(LIBRARY.encode_ordinary(t)) for t in texts]
    assert peak < 20 * sum(map(len, texts)), peak / sum(map(len, texts))
