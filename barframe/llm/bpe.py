"""Byte-level BPE encoding and decoding.

Pre-tokenisation runs over flat arrays of code-point classes. Every code point is a transition
function on the few states of the splitting pattern; composing any four of them gives a constant
function, so the scan over all positions needs four vector steps instead of a regular expression
(``tests/llm`` holds it against the pattern). The slices between boundaries go through a cache of
merged pieces. Token byte offsets are kept, and decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import heapq
import struct
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barframe.llm.arrays import LETTER, NUMBER, OTHER, SPACE, code_points, point_classes, text_chunks, tidy, with_input

CACHE_PIECES = 200_000  # merged pieces in each of the two generations of a worker's cache
_NEVER = 1 << 62  # the rank of a pair that does not merge
LONG_PIECE = 64  # pieces of more bytes merge with a heap

# States: what the last code point was, and how far a contraction has come.
_WIDE, _BLANK, _LETTER, _NUMBER, _OTHER, _QUOTE, _AWAIT_E, _AWAIT_L, _DONE = range(9)
# Symbols: classes of code points, with the letters of contractions apart.
_S_LETTER, _S_NUMBER, _S_OTHER, _S_WIDE, _S_BLANK, _S_QUOTE, _S_END, _S_E, _S_RV, _S_L, _S_FIRST = range(11)


@cache
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The symbol of every code point, and the state after each pair of symbol and state."""
    symbol = np.array([_S_LETTER, _S_NUMBER, _S_OTHER, _S_WIDE], dtype=np.uint8)[point_classes()]
    symbol[32], symbol[39] = _S_BLANK, _S_QUOTE
    for letters, kind in (("stmd", _S_END), ("e", _S_E), ("rv", _S_RV), ("l", _S_L)):
        symbol[[ord(c) for c in letters]] = kind
    step = np.zeros((11, 9), dtype=np.uint8)
    for kind, state in ((_S_LETTER, _LETTER), (_S_NUMBER, _NUMBER), (_S_OTHER, _OTHER), (_S_WIDE, _WIDE), (_S_BLANK, _BLANK), (_S_FIRST, _WIDE)):
        step[kind] = state
    step[[_S_END, _S_E, _S_RV, _S_L]] = _LETTER
    step[_S_END, _QUOTE] = step[_S_E, _AWAIT_E] = step[_S_L, _AWAIT_L] = _DONE
    step[_S_RV, _QUOTE], step[_S_L, _QUOTE] = _AWAIT_E, _AWAIT_L
    step[_S_QUOTE] = _QUOTE
    step[_S_QUOTE, [_BLANK, _OTHER, _QUOTE]] = _OTHER
    return symbol, step


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bytes at which the pieces of the concatenated texts begin."""
    if not len(data):
        return np.zeros(0, np.int64)
    points, places = code_points(data)
    symbol, step = _tables()
    kind = symbol[points]
    n = len(points)
    first = np.zeros(n + 1, dtype=bool)
    begins = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[np.searchsorted(places, begins)] = True
    first[n] = True
    before = np.empty(n, dtype=np.uint8)
    state = step[kind, 0]
    for _ in range(4):  # four symbols fix the state
        before[0] = _WIDE
        before[1:] = state[:-1]
        before[first[:-1]] = _WIDE
        state = step[kind, before]
    group = point_classes()[points]
    white = group == SPACE
    earlier = np.concatenate([[SPACE], group[:-1]])
    start = (group != earlier) & ~(before == _BLANK) | (white & (earlier != SPACE)) | (before == _DONE) & (group == LETTER)
    start |= ~white & (before == _WIDE)
    last_white = white[:-1] & ~white[1:] & ~first[1:-1]
    start[:-1] |= last_white
    done = state == _DONE
    start[done] = False
    pair = np.flatnonzero(done & ((before == _AWAIT_E) | (before == _AWAIT_L)))
    start[pair - 1] = False
    start |= first[:-1]
    return places[start]


class Vocabulary(dict):
    """Pieces to their packed little-endian 32-bit ids, merged on first use."""

    def __init__(self, ranks: dict[bytes, int], limit: int = CACHE_PIECES):
        super().__init__()
        self.ranks, self.limit = ranks, limit
        self.older: dict[bytes, bytes] = {}
        size = max(ranks.values(), default=-1) + 1
        self.words = [b""] * size
        for word, rank in ranks.items():
            self.words[rank] = word

    def __missing__(self, piece: bytes) -> bytes:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        packed = self.older.get(piece)
        if packed is None:
            rank = self.ranks.get(piece)
            ids = [rank] if rank is not None else self.merge(piece)
            packed = struct.pack(f"<{len(ids)}I", *ids)
        self[piece] = packed
        return packed

    def forget(self) -> None:
        """Drop the merged pieces: a worker lives on after its task, and so would its cache."""
        self.older = {}
        self.clear()

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: the adjacent pair of lowest rank merges first, the leftmost on ties."""
        if len(piece) > LONG_PIECE:
            return self._merge_long(piece)
        rank = self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank(piece[i : i + 2], _NEVER) for i in range(len(piece) - 1)]
        while pairs and (low := min(pairs)) < _NEVER:
            i = pairs.index(low)
            joined = parts[i] = parts[i] + parts[i + 1]
            del parts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = rank(joined + parts[i + 1], _NEVER)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + joined, _NEVER)
        return [self.ranks[p] for p in parts]

    def _merge_long(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        end, left, right = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, middle, stop = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or end[i] != middle or end[j] != stop:
                continue
            end[i], right[i], alive[j] = stop, right[j], False
            if right[i] < n:
                left[right[i]] = i
            for a in (left[i], i):
                if a >= 0 and (b := right[a]) < n and (r := ranks.get(piece[a : end[b]])) is not None:
                    heapq.heappush(heap, (r, a, end[a], end[b]))
        return [ranks[piece[i : end[i]]] for i in range(n) if alive[i]]


def read_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks of a file of lines ``base64 rank``."""
    return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in content.splitlines() if line)}


_vocabularies: dict[int, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """The vocabulary of a rank file's content, made once in a worker."""
    key = hash(content)
    if key not in _vocabularies:
        _vocabularies.clear()
        _vocabularies[key] = Vocabulary(read_ranks(content))
    return _vocabularies[key]


def encode_chunk(words: Vocabulary, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The packed ids of each text."""
    starts = piece_starts(data, offsets)
    raw = data.tobytes()
    at = starts.tolist()
    packed = list(map(words.__getitem__, [raw[a:b] for a, b in zip(at, [*at[1:], len(raw)][: len(at)], strict=True)]))
    cuts = np.searchsorted(starts, offsets).tolist()
    return [b"".join(packed[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def decode(words: Vocabulary, ids: bytes) -> bytes:
    """The bytes of packed ids."""
    table = words.words
    return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])


def token_offsets(words: Vocabulary, ids: bytes) -> bytes:
    """The byte each token begins at, packed as little-endian 64-bit integers."""
    lengths = [len(words.words[i]) for i in np.frombuffer(ids, dtype="<u4").tolist()]
    return (np.cumsum([0, *lengths])[:-1]).astype("<i8").tobytes()


def encode_texts(
    df: DataFrame, ranks_path: str, text: str = "text", ids: str = "ids", offsets: str | None = None, decoded: str | None = None
) -> DataFrame:
    """Add the packed ids of every whole text, and on request token offsets and decoded bytes.

    ``ids`` is binary: little-endian unsigned 32-bit integers. A null or empty text has no ids.
    Text is ordinary throughout: no special token is recognised. Columns of these names in
    ``df`` are replaced, all others are kept. The rank file (0.8 MB for 50,000 tokens) is read
    by the driver and travels with the job; the vocabulary is not trained here.
    """
    with open(ranks_path, "rb") as file:
        content = df.sparkSession.sparkContext.broadcast(file.read())
    added = [name for name in (ids, offsets, decoded) if name]
    source, rest, schema = with_input(df, text, added)
    for name in added:
        schema = schema.add(name, "binary")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(content.value)
        for batch in batches:
            for row, end, data, at in text_chunks(batch.column(0)):
                packed = encode_chunk(words, data, at)
                columns = [packed]
                if offsets:
                    columns.append([token_offsets(words, p) for p in packed])
                if decoded:
                    columns.append([decode(words, p) for p in packed])
                kept = [batch.column(i + 1).slice(row, end - row) for i in range(len(rest))]
                yield pa.RecordBatch.from_arrays([*kept, *[pa.array(c, pa.binary()) for c in columns]], names=[*rest, *added])
        words.forget()

    return source.mapInArrow(tidy(run), schema)
