"""Problem 6: encoding a corpus with a public byte-level BPE vocabulary.

The text is cut into pieces by the vocabulary's pattern. Each distinct piece is merged once per
worker: a segment tree over its byte positions holds, for every live position, the rank of the
pair formed with the next live position; the root gives the leftmost pair of the lowest rank, and
a merge updates the merged position, its right neighbour (dead) and its left neighbour, each in
logarithmic time. The ids of pieces are remembered in a bounded table, so common words cost one
look-up.

Defined results: null text and empty text give an empty list; strings that look like special
tokens are ordinary text; other columns of the input are not read and may have any names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: Pieces remembered by one worker before its table is emptied (memory bound, not a limit on text).
PIECE_MEMORY = 400_000

#: Pattern of the public vocabulary (a fixed value).
PIECE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space with the word that follows it: no piece crosses the end of such a chunk.
CHUNK_PATTERN = r"\s*\S+|\s+"


def default_vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """Byte strings and their ranks from the text of a rank file."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in raw.splitlines() if line.strip())}


class PairTree:
    """Segment tree over the byte positions of one piece; leaves hold the rank of (position, next live)."""

    __slots__ = ("size", "tree")
    NONE = 1 << 60

    def __init__(self, ranks: list[int]):
        size = 1
        while size < len(ranks):
            size *= 2
        self.size = size
        tree = [self.NONE] * (2 * size)
        tree[size : size + len(ranks)] = ranks
        for i in range(size - 1, 0, -1):
            left, right = tree[2 * i], tree[2 * i + 1]
            tree[i] = left if left <= right else right
        self.tree = tree

    def leftmost_minimum(self) -> int:
        """Position of the leftmost pair of lowest rank, or -1."""
        tree, low, i = self.tree, self.tree[1], 1
        if low == self.NONE:
            return -1
        while i < self.size:
            i = 2 * i if tree[2 * i] == low else 2 * i + 1
        return i - self.size

    def update(self, position: int, rank: int) -> None:
        tree, i = self.tree, position + self.size
        tree[i] = rank
        i //= 2
        while i:
            left, right = tree[2 * i], tree[2 * i + 1]
            low = left if left <= right else right
            if tree[i] == low:
                return
            tree[i] = low
            i //= 2


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(n)]
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    none = PairTree.NONE
    tree = PairTree([ranks.get(piece[i : i + 2], none) for i in range(n - 1)] + [none])
    while (i := tree.leftmost_minimum()) >= 0:
        j = after[i]
        merged = parts[i] + parts[j]
        parts[i], parts[j] = merged, None
        k = after[i] = after[j]
        tree.update(j, none)
        if k >= 0:
            before[k] = i
            tree.update(i, ranks.get(merged + parts[k], none))
        else:
            tree.update(i, none)
        if (h := before[i]) >= 0:
            tree.update(h, ranks.get(parts[h] + merged, none))
    return [ranks[p] for p in parts if p is not None]


class Encoder:
    """Encodes texts with one rank table; remembers the ids of chunks as packed bytes."""

    def __init__(self, raw: bytes):
        import regex

        self.ranks = read_ranks(raw)
        self.pieces = regex.compile(PIECE_PATTERN).findall
        self.chunks = regex.compile(CHUNK_PATTERN).findall
        self.seen: dict[str, bytes] = {}

    def _chunk(self, chunk: str) -> bytes:
        import numpy as np

        ids = [i for p in self.pieces(chunk) for i in merge_piece(p.encode(), self.ranks)]
        return np.array(ids, dtype="<i4").tobytes()

    def packed(self, text: str) -> bytes:
        """Little-endian 32-bit ids."""
        seen, out = self.seen, []
        if len(seen) > PIECE_MEMORY:
            seen.clear()
        for chunk in self.chunks(text):
            got = seen.get(chunk)
            if got is None:
                got = self._chunk(chunk)
                if len(chunk) <= 64:
                    seen[chunk] = got
            out.append(got)
        return b"".join(out)


_ENCODERS: dict[int, Encoder] = {}


def _encoder(raw: bytes) -> Encoder:
    key = hash(raw)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(raw)
    return _ENCODERS[key]


def encode_corpus(df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(key, ids array<int>) of every row, by the rank file at ``vocabulary``.

    One pass without a shuffle: only the two columns are read. The rank file (under 1 MB) is
    read once by the driver and broadcast, so executors need no copy of it.
    """
    with open(vocabulary or default_vocabulary_path(), "rb") as f:
        raw = df.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoder = _encoder(raw.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            for start in range(0, len(texts), 2000):
                packed = [encoder.packed(t) if t else b"" for t in texts[start : start + 2000]]
                offsets = np.zeros(len(packed) + 1, dtype="<i4")
                np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
                values = pa.array(np.frombuffer(b"".join(packed), dtype="<i4"), type=pa.int32())
                ids = pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), values)
                yield pa.RecordBatch.from_arrays([keys[start : start + 2000], ids], names=[key, "ids"])

    narrow = df.select(key, text)
    return narrow.mapInArrow(run, f"`{key}` {narrow.schema[key].dataType.simpleString()}, ids array<int>")
