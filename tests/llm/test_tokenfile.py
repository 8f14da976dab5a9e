"""Token files against the library on whole texts, and random access against the ids."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chartloom.llm import tokenfile
from tests.llm.helpers import odd_texts, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
HARD = [
    "It's THE cat's, we'LL see'm 'S 'tis don't", "áb e ́x ́", "ΣΑΣ σας Σ ΟΔΟΣ.", "İstanbul İx",
    "x y\u0085z w​q　", "12 1234 ½ ² ٣٤ Ⅷ", "汉字テスト 한국어 한", "👩‍👩‍👧 🎉🎉 ok", "\x1c\x1d a\x1fb \x00 c",
    "<|endoftext|> a<|startoftext|>b <|endoftext |> <|ENDOFTEXT|> x<|endoftext|>y. Hi. Hi Hi, É. é. e\u0301. T\u0308. A.. a.b, T. t.", "ﬁn ﬂ ǅ ß ẞ", "a,b;c!!...?? -- __ $%^", "� \U0010ffff", "x" * 5000,
    "'ll", "''s's", " lead", "trail ", "\t\n\x0b\x0c\r ", "Ａｂｃ １２", "ȩ́ ̧́e q̣̇",
]


def brute(texts):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for t in texts]


@pytest.mark.parametrize("sizes", [(4_000_000, 32_000_000), (300, 5_000)])
def test_round_trip(spark, tmp_path, sizes):
    texts = odd_texts() + HARD
    rows = [(7 * i % 101 - 3, t) for i, t in enumerate(texts)]
    rows += [(None, "no id"), (rows[5][0], "twice"), (rows[5][0], "twice")]
    folder = str(tmp_path / "out")
    tokenfile.write_tokens(table(spark, rows), VOCABULARY, folder, file_tokens=sizes[0], part_bytes=sizes[1])
    got = tokenfile.read_documents(spark, folder).orderBy("start").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r.doc_id for r in got] == [d for d, _ in order]
    at = 0
    want = {}
    for (key, _), ids in zip(order, brute([t for _, t in order])):
        want.setdefault(key, []).append(np.array(ids, "<u4").tobytes())
    for row in got:
        assert row.start == at and row.n_tokens * 4 == len(row.ids)
        want[row.doc_id].remove(bytes(row.ids))
        at += row.n_tokens
    assert not any(want.values())
    assert (tokenfile.token_files(spark, folder).count() > 20) == (sizes[0] == 300)
    flat = np.frombuffer(b"".join(bytes(r.ids) for r in got), "<u4")
    places = [*range(0, at, 97), 0, at - 1, at - 1]
    wanted = spark.createDataFrame([(p,) for p in [*places, at, -1, None]], "position long")
    found = tokenfile.tokens_at(wanted, folder, file_tokens=sizes[0]).collect()
    assert sorted(map(tuple, found)) == sorted((p, int(flat[p])) for p in places)


def test_levels():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2**rng.integers(1, 33, 5_000), dtype=np.uint64).astype(np.uint32)
    ids[[0, -1]] = 2**32 - 1, 0
    raw = tokenfile.pack([4, None, -9], [ids[:1000], ids[:0], ids[1000:]])
    reads = []
    file = tokenfile.TokenFile(lambda at, n: reads.append(n) or raw[at:at + n])
    assert file.keys() == [4, None, -9] and file.starts().tolist() == [0, 1000, 1000, 5000]
    assert len(file.levels) == 4 and len(raw) == file.length + 4
    reads.clear()
    assert [file.token(i) for i in range(0, 5000, 7)] == ids[::7].tolist()
    assert max(reads) <= 64
    for a, b in [(0, 5000), (511, 513), (512, 1024), (1, 1), (4999, 5000), (1000, 3333)]:
        assert file.span(a, b).tolist() == ids[a:b].tolist()
    with pytest.raises(IndexError):
        file.token(5000)
    assert tokenfile.TokenFile(lambda at, n: tokenfile.pack([], [])[at:at + n]).tokens == 0


def test_damage_and_empty(spark, tmp_path):
    folder = str(tmp_path / "none")
    tokenfile.write_tokens(table(spark, []), VOCABULARY, folder)
    assert tokenfile.read_documents(spark, folder).collect() == []
    raw = bytearray(tokenfile.pack([1], [np.array([5, 600], np.uint32)]))
    raw[-6] ^= 1
    (tmp_path / "bad.dac").write_bytes(raw)
    with pytest.raises(ValueError):
        list(tokenfile._documents(str(tmp_path / "bad.dac"), 0))


def test_query(spark):
    from chartloom.llm import queries
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    got = queries.op13_token_file(spark, sf).orderBy("start").collect()
    ids = brute([d.text for d in docs])
    start = 0
    for row, doc, own in zip(got, docs, ids, strict=True):
        assert (row.doc_id, row.start, row.n_tokens) == (doc.doc_id, start, len(own))
        assert row.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes())
        start += len(own)


def test_frequent_words_stay_known(monkeypatch):
    """What comes again and again is learnt once, however many words come once; ids stay the same."""
    vocabulary = tokenfile._read_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    often = ["The", "patient,", "d\u00c9j\u00e0", "[UNK]x", "a.b"]
    slices = [pa.array([" ".join([*often, *(f"r{n}q{i}" for i in range(30))]), None]) for n in range(40)]
    plain = tokenfile.Encoder(vocabulary)
    want = [[ids.tolist() for ids in plain.encode(s)] for s in slices]
    monkeypatch.setattr(tokenfile, "WORDS", 60)
    monkeypatch.setattr(tokenfile, "PIECES", 80)
    small = tokenfile.Encoder(vocabulary)
    learnt = []
    parts = small._parts
    monkeypatch.setattr(small, "_parts", lambda words: learnt.extend(words) or parts(words))
    assert [[ids.tolist() for ids in small.encode(s)] for s in slices] == want
    assert [learnt.count(w.encode()) for w in often] == [1] * len(often)
    assert small.known <= 60 + 35
