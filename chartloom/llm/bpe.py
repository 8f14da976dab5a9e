"""Byte-level BPE by corpus-level merge replay.

Each task cuts its texts into segments (white space with what follows), numbers the distinct ones,
cuts those into pieces by the pattern and encodes the new pieces, many at once.  Short pieces stand
side by side as columns of an index that holds the rank of the pair at each position: wave by wave
the lowest entry of every column is taken out, and a merge updates only the two pairs it touches.
Long pieces go through an index from the rank of a pair to the positions where it stands, emptied in
rank order.  Pieces that are remembered from earlier batches are looked up.  The pieces of a text
never leave their task, so nothing is shuffled.  Decoding gathers bytes by flat arrays.

Rows and cases: a null text counts as empty and gives no ids; repeated rows give repeated
results; texts of any length are read whole; other columns play no part.
"""

from __future__ import annotations

import base64
import functools
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import arrow_pass, arrow_type, text_bytes

#: White space as Unicode names it, which is what the pattern's \s stands for.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = np.array([b in b"\t\n\x0b\x0c\r " for b in range(256)])
#: Remembered pieces, and their bytes, per Python worker, and the bytes of texts that are encoded at once.
PIECES, HELD_BYTES, AT_ONCE = 60_000, 8_000_000, 1_000_000
LARGEST_VOCABULARY, DECODED, REPLAYED = 64_000_000, 1_000_000, 60_000
#: Positions of a wave's columns, by the length of their pieces, and the cells of a wave at most.
WIDTHS, CELLS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 44, 62), 200_000
PLACE_BITS, NO_PAIR = 6, np.iinfo(np.int32).max
#: Characters of segments that are cut by one call of the pattern.
CUT_AT_ONCE = 100_000


def read_ranks(path: str) -> bytes:
    """The rank file's bytes; its size is checked, for it is sent to every executor."""
    with open(path, "rb") as file:
        raw = file.read(LARGEST_VOCABULARY + 1)
    if len(raw) > LARGEST_VOCABULARY:
        raise ValueError(f"{path} is larger than {LARGEST_VOCABULARY} bytes")
    return raw


def parse_ranks(raw: bytes) -> dict[bytes, int]:
    pairs = (line.split() for line in raw.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


def unicode_spaces(pattern: str) -> str:
    """The pattern with \\s and \\S spelt out, inside and outside brackets."""
    out, inside, i = [], False, 0
    while i < len(pattern):
        pair = pattern[i:i + 2]
        if pair == r"\s":
            out.append(SPACE if inside else f"[{SPACE}]")
        elif pair == r"\S" and not inside:
            out.append(f"[^{SPACE}]")
        elif pair[0] == "\\":
            out.append(pair)
        else:
            inside = pair[0] == "[" or inside and pair[0] != "]"
            out.append(pair[0])
            i -= 1
        i += 2
    return "".join(out)


def replay(pieces: list[bytes], ranks: dict[bytes, int]) -> list[list[int]]:
    """The ids of each piece: all merges of all pieces, lowest rank first, leftmost first."""
    tokens: list[bytes | None] = []
    bounds = [0]
    singles = [bytes([b]) for b in range(256)]
    for piece in pieces:
        tokens.extend(map(singles.__getitem__, piece))
        tokens.append(None)
        bounds.append(len(tokens))
    after = list(range(1, len(tokens) + 1))
    before = list(range(-1, len(tokens) - 1))
    at = [-1] * len(tokens)  # the rank of the pair that begins at a position
    index: dict[int, list[int]] = {}
    get = ranks.get
    left = None
    for i, right in enumerate(tokens):
        if left is not None and right is not None:
            rank = get(left + right)
            if rank is not None:
                at[i - 1] = rank
                if rank in index:
                    index[rank].append(i - 1)
                else:
                    index[rank] = [i - 1]
        left = right
    queue = list(index)
    heapq.heapify(queue)
    while queue:
        rank = heapq.heappop(queue)
        places = index.pop(rank, None)
        if places is None:
            continue
        places.sort()
        merged = None
        for n, i in enumerate(places):
            if at[i] != rank:
                continue
            j = after[i]
            if merged is None:
                merged = tokens[i] + tokens[j]
            tokens[i] = merged
            k = after[i] = after[j]
            at[j] = at[i] = -1
            before[k] = i
            lowest = rank
            right = tokens[k]
            if right is not None:
                made = get(merged + right)
                if made is not None:
                    at[i] = made
                    lowest = min(lowest, made)
                    if made in index:
                        index[made].append(i)
                    else:
                        index[made] = [i]
                        heapq.heappush(queue, made)
            h = before[i]
            left = tokens[h] if h >= 0 else None
            if left is not None:
                made = get(left + merged)
                at[h] = -1 if made is None else made
                if made is not None:
                    lowest = min(lowest, made)
                    if made in index:
                        index[made].append(h)
                    else:
                        index[made] = [h]
                        heapq.heappush(queue, made)
            if lowest < rank:  # a merge that comes first has just become possible
                index[rank] = places[n + 1:]
                heapq.heappush(queue, rank)
                break
    out = []
    for start, end in zip(bounds, bounds[1:]):
        ids, i = [], start
        while i < end - 1:
            ids.append(ranks[tokens[i]])
            i = after[i]
        out.append(ids)
    return out


def replayed(pieces: list[bytes], ranks: dict[bytes, int]) -> Iterator[list[int]]:
    """The ids of each piece, replayed in runs of ``REPLAYED`` bytes, each of which takes about a
    hundred bytes of memory meanwhile; a piece may be longer."""
    held, size = [], 0
    for piece in pieces:
        if held and size + len(piece) > REPLAYED:
            yield from replay(held, ranks)
            held, size = [], 0
        held.append(piece)
        size += len(piece)
    yield from replay(held, ranks)


class Merges:
    """The mergeable pairs of tokens as sorted arrays.  Tokens are numbered by rank, bytes that the
    ranks leave out come behind them, and the last number, ``none``, stands beside a piece's ends."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = sorted(ranks, key=ranks.__getitem__)
        tokens += [b for b in map(bytes, zip(range(256))) if b not in ranks]
        number = {token: n for n, token in enumerate(tokens)}
        self.none, self.ids = len(tokens), np.array([ranks.get(t, -1) for t in tokens], np.int64)
        if self.none >= NO_PAIR >> PLACE_BITS:
            raise ValueError(f"{self.none} tokens are too many")
        keys, made = array("q"), array("i")
        get, factor = number.get, self.none + 1
        for n, token in enumerate(tokens[:len(ranks)]):
            for at in range(1, len(token)):
                left, right = get(token[:at]), get(token[at:])
                if left is not None and right is not None:
                    keys.append(left * factor + right)
                    made.append(n)
        order = np.argsort(np.frombuffer(keys, np.int64) if keys else np.empty(0, np.int64))
        self.keys = np.append(np.frombuffer(keys, np.int64)[order] if keys else order, np.iinfo(np.int64).max)
        self.made = np.append(np.frombuffer(made, np.int32)[order] if made else order, 0).astype(np.int32)
        self.single = np.array([number[bytes([b])] for b in range(256)], np.int32)
        pair = np.arange(256)
        self.double = self.find(self.single[np.repeat(pair, 256)], self.single[np.tile(pair, 256)])

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The numbers that pairs merge into, shifted by a place's bits; ``NO_PAIR`` where they do not."""
        wanted = left.astype(np.int64) * (self.none + 1) + right
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.made[at] << PLACE_BITS, NO_PAIR).astype(np.int32)

    def waves(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> tuple[
            np.ndarray, np.ndarray]:
        """The ids of pieces of ``width`` bytes at most, one after the other, and how many each has.

        Row p of the index holds, for each piece, the number that the pair at place p merges into,
        and p itself, so that a column's least entry is its lowest pair, leftmost first.
        """
        many, place = len(starts), np.arange(width)[:, None]
        inside = place < lengths
        read = raw[np.minimum(starts + place, len(raw) - 1)].astype(np.int32)
        tokens = np.full((width + 2, many), self.none, np.int32)
        tokens[1:-1] = np.where(inside, self.single[read], self.none)
        index = np.full((width + 2, many), NO_PAIR, np.int32)
        pairs = self.double[read[:-1] * 256 + read[1:]]
        index[1:-2] = np.where(inside[1:] & (pairs != NO_PAIR), pairs | place[:-1] + 1, NO_PAIR)
        whole, columns = tokens, np.arange(many)
        after = np.repeat(np.arange(1, width + 3, dtype=np.int16)[:, None], many, 1)
        before = after - np.int16(2)
        while True:
            lowest = index.min(0)
            live = np.flatnonzero(lowest != NO_PAIR)
            if 2 * len(live) < len(lowest):  # finished columns leave
                if tokens is not whole:
                    whole[:, columns] = tokens
                if not len(live):
                    break
                columns, lowest = columns[live], lowest[live]
                tokens, index, after, before = (np.ascontiguousarray(t[:, live]) for t in (
                    tokens, index, after, before))
                live = np.arange(len(live))
            size, flat = len(lowest), [t.reshape(-1) for t in (tokens, index, after, before)]
            token, entry, right_of, left_of = flat
            least = lowest[live]
            merged, i = least >> PLACE_BITS, (least & (1 << PLACE_BITS) - 1).astype(np.int64)
            at = i * size + live
            gone = right_of[at].astype(np.int64) * size + live
            k = right_of[gone]
            right, h = k.astype(np.int64) * size + live, left_of[at].astype(np.int64)
            left = h * size + live
            token[at], token[gone], right_of[at], left_of[right] = merged, -1, k, i
            found = self.find(np.concatenate([token[left], merged]), np.concatenate([merged, token[right]]))
            places = np.concatenate([h, i]).astype(np.int32)
            entry[gone] = NO_PAIR
            entry[np.concatenate([left, at])] = np.where(found == NO_PAIR, NO_PAIR, found | places)
        kept = whole[1:-1].T
        held = (kept >= 0) & (kept < self.none)
        ids = self.ids[kept[held]]
        if len(ids) and ids.min() < 0:
            raise KeyError("a byte that the ranks leave out")
        return ids, held.sum(1)

    def encode(self, pieces: list[bytes], ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces, one after the other, and how many each has."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts, parts = np.zeros(len(pieces), np.int64), []
        raw = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum(lengths) - lengths
        kinds = np.searchsorted(WIDTHS, lengths)
        kinds[lengths == 0] = -1
        for kind, width in enumerate(WIDTHS):
            own = np.flatnonzero(kinds == kind)
            for n in range(0, len(own), CELLS // width):
                some = own[n:n + CELLS // width]
                ids, counts[some] = self.waves(raw, starts[some], lengths[some], width)
                parts.append((some, ids))
        long = np.flatnonzero(kinds == len(WIDTHS))
        for n, ids in zip(long, replayed([pieces[n] for n in long], ranks)):
            counts[n] = len(ids)
            parts.append((np.array([n]), np.array(ids)))
        begin = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.uint32)
        for some, ids in parts:
            own = counts[some]
            flat[np.repeat(begin[some] - (np.cumsum(own) - own), own) + np.arange(len(ids))] = ids
        return flat, counts


class Numbers(dict):
    """piece -> its number, in order of appearance."""

    def __missing__(self, piece: bytes | str) -> int:
        number = self[piece] = len(self)
        return number


class Spans:
    """Ids of numbered entries, in flat arrays."""

    def __init__(self):
        self.numbers, self.known, self.bytes = Numbers(), 0, 0
        self.flat, self.starts = np.empty(0, np.uint32), np.zeros(1, np.int64)

    def new(self) -> list:
        return list(self.numbers)[self.known:]

    def add(self, flat: np.ndarray, lengths: np.ndarray, size: int) -> None:
        self.flat = np.concatenate([self.flat, flat])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(lengths)])
        self.known = len(self.numbers)
        self.bytes += size

    def of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some entries, one after the other, and how many each has."""
        return gathered(self.flat, self.starts, numbers)

    def full(self, most: int) -> bool:
        return self.known > most or self.bytes > HELD_BYTES


def gathered(flat: np.ndarray, starts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = starts[numbers]
    lengths = starts[numbers + 1] - first
    ends = np.cumsum(lengths)
    return flat[np.repeat(first - (ends - lengths), lengths) + np.arange(lengths.sum())], lengths


def ends_word(last: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether the character that ends with the byte ``last``, after ``second``, is surely no white space."""
    return (last < 128) & ~BLANK[last] | (last >= 128) & (second >= 0xC3) & (second <= 0xDF)


def segments(texts: list[str | None]) -> tuple[pa.Array, np.ndarray]:
    """Runs of white space with what follows, of all texts, and how many each text has.

    No piece reaches from a word into the white space behind it, and how white space is cut
    depends on nothing beyond the next word's first character.  A cut is made before ASCII white
    space, unless the character before it might be white space too.
    """
    raw = [text_bytes(t) for t in texts]
    ends = np.cumsum([len(r) for r in raw])
    whole = b"".join(raw)
    data = np.frombuffer(whole, np.uint8)
    blank = BLANK[data]
    none = np.zeros(2, np.uint8)  # of the type of the bytes, which a wider one would hold eight times over
    before = np.concatenate([none[:1], data[:-1]])[:len(data)]
    further = np.concatenate([none, data[:-2]])[:len(data)]
    cut = np.append(blank & ends_word(before, further), False)
    cut[0] = True
    cut[ends] = True
    cuts = np.flatnonzero(cut)
    array = pa.BinaryArray.from_buffers(
        pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(whole)])
    return array, np.diff(np.searchsorted(cuts, ends, "left"), prepend=0)


class Encoder:
    """Pieces seen by this worker, with their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.merges = ranks, Merges(ranks)
        self.cut = regex.compile(unicode_spaces(pattern))
        self.pieces = Spans()

    def _learn_pieces(self) -> None:
        new = [text_bytes(p) for p in self.pieces.new()]
        if not new:
            return
        ranks = np.fromiter((self.ranks.get(p, -1) for p in new), np.int64, len(new))
        apart = np.flatnonzero(ranks < 0)
        ids, counts = self.merges.encode([new[n] for n in apart], self.ranks)
        lengths = np.ones(len(new), np.int64)
        lengths[apart] = counts
        flat = np.repeat(ranks, lengths).astype(np.uint32)
        flat[np.repeat(ranks < 0, lengths)] = ids
        self.pieces.add(flat, lengths, sum(map(len, new)))

    def _numbers(self, text: str) -> np.ndarray:
        """The numbers of a text's pieces."""
        number = self.pieces.numbers.__getitem__
        if len(text) > 1_000_000:
            return np.fromiter((number(m.group()) for m in self.cut.finditer(text)), np.int64)
        return np.array([number(p) for p in self.cut.findall(text)], np.int64)

    def _parts(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The numbers of all segments' pieces, and how many each segment has.

        Segments that stand between others in their text are cut many at once: one may follow any
        other of them, as each begins with white space and ends with what is none.
        """
        ends = np.frombuffer(found.buffers()[1], np.int32)[found.offset:found.offset + len(found) + 1]
        data = found.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)
        sizes = np.diff(ends)
        inner = sizes > 1
        last, second = data[ends[1:][inner] - 1], data[ends[1:][inner] - 2]
        inner[inner] = BLANK[data[ends[:-1][inner]]] & ends_word(last, second)
        numbers, counts = [], np.zeros(len(found), np.int64)
        first = np.cumsum(np.append(0, (data[ends[0]:ends[-1]] & 0xC0) != 0x80))[ends - ends[0]]
        at = 0
        while at < len(found):
            stop = at + 1
            if inner[at]:
                stop = max(stop, int(np.searchsorted(first, first[at] + CUT_AT_ONCE, "right")) - 1)
                others = np.flatnonzero(~inner[at:stop])
                stop = at + int(others[0]) if len(others) else stop
            whole = data[ends[at]:ends[stop]].tobytes().decode("utf-8", "surrogatepass")
            if stop > at + 1:
                pieces = self.cut.findall(whole)
                past = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
                wanted = first[at + 1:stop + 1] - first[at]
                upto = np.searchsorted(past, wanted)
                if len(past) and past[-1] == wanted[-1] and (past[upto] == wanted).all():
                    numbers.append(np.array(list(map(self.pieces.numbers.__getitem__, pieces)), np.int64))
                    counts[at:stop] = np.diff(upto, prepend=-1)
                    at = stop
                    continue
                stop = at + 1  # a pattern that leaves text out, or that looks beyond segments
                inner[at] = False
                whole = data[ends[at]:ends[stop]].tobytes().decode("utf-8", "surrogatepass")
            numbers.append(self._numbers(whole))
            counts[at] = len(numbers[-1])
            at = stop
        return np.concatenate(numbers) if numbers else np.empty(0, np.int64), counts

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        if self.pieces.full(PIECES):
            self.pieces = Spans()
        found, counts = segments(texts)
        coded = found.dictionary_encode()
        numbers, parts = self._parts(coded.dictionary)
        self._learn_pieces()
        ids, lengths = self.pieces.of(numbers)
        starts = np.append(0, np.cumsum(lengths))[np.append(0, np.cumsum(parts))]
        ids, lengths = gathered(ids, starts, coded.indices.to_numpy())
        return np.split(ids, np.append(0, np.cumsum(lengths))[np.cumsum(counts)[:-1]])


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(raw: bytes, pattern: str) -> Encoder:
    """The worker's encoder for these ranks; what it remembers serves later tasks too."""
    key = (hash(raw), pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(raw), pattern)
    return _ENCODERS[key]


@functools.lru_cache(maxsize=2)
def _spelling(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all tokens, one after the other by id, and where each starts; ids that the
    file leaves out have none."""
    by_id = {rank: token for token, rank in parse_ranks(raw).items()}
    tokens = [by_id.get(i, b"") for i in range(max(by_id, default=-1) + 1)]
    return np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([0, *map(len, tokens)])


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids: ids as little-endian unsigned 32-bit integers in a binary."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        encoder = _encoder(shared.value, pattern)

        def work(batch):
            ids = encoder.encode(batch.column(1).to_pylist())
            raw = [i.astype("<u4").tobytes() for i in ids]
            return batch.column(0), [len(i) for i in ids], raw
        return work

    key = docs.schema[id_col].dataType.simpleString()
    return arrow_pass(
        docs.select(F.col(id_col), F.col(text_col).cast("string")), make,
        f"doc_id {key}, n_tokens long, ids binary",
        pa.schema([("doc_id", arrow_type(key)), ("n_tokens", pa.int64()), ("ids", pa.binary())]), AT_ONCE)


def _decoded(raw: bytes, flat: np.ndarray, starts: np.ndarray) -> bytes:
    """The bytes that ids stand for."""
    ids = np.frombuffer(raw, "<u4")
    return b"".join(gathered(flat, starts, ids[i:i + DECODED].astype(np.int64))[0].tobytes()
                    for i in range(0, len(ids), DECODED))


def there_and_back(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids, decoded: as of :func:`encode` and :func:`decode`, in one pass, which
    takes half as many Python workers as one after the other."""
    shared = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        encoder, spelling = _encoder(shared.value, pattern), _spelling(shared.value)

        def work(batch):
            raw = [i.astype("<u4").tobytes() for i in encoder.encode(batch.column(1).to_pylist())]
            return batch.column(0), [len(r) // 4 for r in raw], raw, [_decoded(r, *spelling) for r in raw]
        return work

    key = docs.schema[id_col].dataType.simpleString()
    return arrow_pass(
        docs.select(F.col(id_col), F.col(text_col).cast("string")), make,
        f"doc_id {key}, n_tokens long, ids binary, decoded binary",
        pa.schema([("doc_id", arrow_type(key)), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                   ("decoded", pa.binary())]), AT_ONCE)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of :func:`encode` with ``decoded``, the bytes their ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    def make():
        flat, starts = _spelling(shared.value)

        def work(batch):
            spelt = [_decoded(raw, flat, starts) for raw in batch.column(2).to_pylist()]
            return *batch.columns, spelt
        return work

    key = encoded.schema["doc_id"].dataType.simpleString()
    return arrow_pass(
        encoded.select("doc_id", "n_tokens", "ids"), make,
        f"doc_id {key}, n_tokens long, ids binary, decoded binary",
        pa.schema([("doc_id", arrow_type(key)), ("n_tokens", pa.int64()), ("ids", pa.binary()),
                   ("decoded", pa.binary())]))
