"""Problem 7: passages of evaluation items inside a training corpus.

Texts are compared by their letters and digits alone, in one form and lower case; what the method
calls token windows are windows of WINDOW letters here, as quotations start and end inside words.
A 64-bit hash of every window of every item goes into one sorted array, which is broadcast; of a
document only every STRIDE-th window is looked up, all documents of a batch at once. With
WINDOW + STRIDE - 1 = MIN_RUN, any common run of MIN_RUN letters holds such a window, so nothing
is missed; each hit is verified by extending it to both sides in the item's text.

The array takes 16 bytes a window, so a block of BLOCK_LETTERS letters of items takes at most
BLOCK_BYTES on a worker whatever the alphabet; more items go in several blocks, one pass each.

Defined results: null, empty and short texts give no rows; a document that quotes an item twice,
or an item delivered twice, gives one row; extra columns are not read.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..common import cut_lineage
from .charforms import _INVISIBLE, _LOOKS_TABLE, _MARKS, _NOT_WORD, fold_for_match

#: Letters and digits in unbroken sequence that make a quotation.
MIN_RUN = 40
WINDOW = 20
STRIDE = MIN_RUN - WINDOW + 1
#: Bytes that one block of items may take on a worker: 16 a window, 4 a letter of the texts.
BLOCK_BYTES = 160 * 1024 * 1024
BLOCK_LETTERS = BLOCK_BYTES // 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Letters of documents that are looked up together (a memory bound; a longer document alone).
HELD_LETTERS = 2_000_000


def _letters(folded: str) -> np.ndarray:
    return np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def window_hashes(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hashes of the windows at ``starts``: the same letters give the same hash wherever they stand."""
    x = np.zeros(len(starts), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            x = x * _BASE + letters[starts + k]
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


class ItemIndex:
    """Windows of item texts as sorted hashes, and the runs a text shares with each item."""

    def __init__(self, items: list[tuple[int, str]]):
        self.keys = [key for key, _ in items]
        folded = [_letters(fold_for_match(text)) for _, text in items]
        sizes = np.array([len(x) for x in folded], dtype=np.int64)
        self.letters = np.concatenate(folded) if folded else np.zeros(0, np.uint32)
        self.ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        counts = np.maximum(sizes - WINDOW + 1, 0)
        starts = np.repeat(self.ends[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum()) if len(items) else np.zeros(0, np.int64)
        hashes = window_hashes(self.letters, starts)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.places = hashes[order], starts[order].astype(np.int64)

    def runs(self, folded: str) -> dict[int, list[tuple[int, int]]]:
        """Of a folded text: for each item it quotes, the (start, end) runs of at least MIN_RUN."""
        return self.runs_of([folded])[0]

    def runs_of(self, texts: list[str]) -> list[dict[int, list[tuple[int, int]]]]:
        """``runs`` of several folded texts, looked up together in groups of about HELD_LETTERS."""
        out, group, size = [], [], 0
        for t in texts:
            if group and size + len(t) > HELD_LETTERS:
                out += self._runs_of(group)
                group, size = [], 0
            group.append(t)
            size += len(t)
        return out + self._runs_of(group)

    def _runs_of(self, texts: list[str]) -> list[dict[int, list[tuple[int, int]]]]:
        found: list[dict[int, list[tuple[int, int]]]] = [{} for _ in texts]
        letters = [_letters(t) for t in texts]
        sizes = np.array([len(x) for x in letters], dtype=np.int64)
        counts = np.where(sizes >= WINDOW, (sizes - WINDOW) // STRIDE + 1, 0)
        if not counts.sum() or not len(self.hashes):
            return found
        base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        text = np.repeat(np.arange(len(texts)), counts)
        at = (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)) * STRIDE
        hashes = window_hashes(np.concatenate(letters), base[text] + at)
        first = np.searchsorted(self.hashes, hashes, side="left")
        hit = np.flatnonzero(self.hashes[np.minimum(first, len(self.hashes) - 1)] == hashes)
        for h in hit:
            stop = np.searchsorted(self.hashes, hashes[h], side="right")
            for place in self.places[first[h] : stop]:
                self._extend(letters[text[h]], int(at[h]), int(place), found[text[h]])
        return found

    def _extend(self, t: np.ndarray, at: int, place: int, found: dict) -> None:
        """Adds the run around a window that a text and an item share, if it is long enough and new."""
        n = int(np.searchsorted(self.ends, place, side="right")) - 1
        key, low, high = self.keys[n], int(self.ends[n]), int(self.ends[n + 1])
        if any(a <= at and at + WINDOW <= b for a, b in found.get(key, ())) or not np.array_equal(t[at : at + WINDOW], self.letters[place : place + WINDOW]):
            return
        left, right = min(at, place - low), min(len(t) - at, high - place)
        differs = np.flatnonzero(t[at - left : at][::-1] != self.letters[place - left : place][::-1])
        a = at - (int(differs[0]) if len(differs) else left)
        differs = np.flatnonzero(t[at : at + right] != self.letters[place : place + right])
        b = at + (int(differs[0]) if len(differs) else right)
        if b - a >= MIN_RUN:
            found.setdefault(key, []).append((a, b))


def _item_blocks(items: DataFrame, key: str, text: str) -> Iterator[ItemIndex]:
    """Indexes of items in blocks of bounded size, each small enough to broadcast."""
    held = items.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("t")).where("k is not null and t is not null")
    size = held.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_LETTERS))
    for b in range(blocks):
        part = held if blocks == 1 else held.where(F.pmod(F.xxhash64("k"), F.lit(blocks)) == b)
        yield ItemIndex([(r.k, r.t) for r in part.toLocalIterator()])


def leaked_items(
    documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "item_text"
) -> DataFrame:
    """(key, item_key, n_runs, longest_run): documents and the items they give away.

    One pass over the documents for each block of items, without a shuffle.
    """
    narrow = documents.select(key, text)
    kinds = [narrow.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()]
    out = None
    for block in _item_blocks(items, item_key, item_text):
        shared = narrow.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                docs, found, counts, longest = [], [], [], []
                texts = [fold_for_match(t) if t and len(t) >= MIN_RUN else "" for t in batch.column(1).to_pylist()]
                for doc, quoted in zip(batch.column(0).to_pylist(), index.runs_of(texts)):
                    for item, runs in quoted.items():
                        docs.append(doc)
                        found.append(item)
                        counts.append(len(runs))
                        longest.append(max(b - a for a, b in runs))
                types = (batch.schema.field(0).type, item_type)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, types[0]), pa.array(found, types[1]), pa.array(counts, pa.int32()), pa.array(longest, pa.int32())],
                    names=[key, item_key, "n_runs", "longest_run"],
                )

        item_type = pa.int64() if kinds[1] == "bigint" else pa.int32() if kinds[1] == "int" else pa.string()
        part = narrow.mapInArrow(run, f"`{key}` {kinds[0]}, `{item_key}` {kinds[1]}, n_runs int, longest_run int")
        out = part if out is None else out.unionByName(part)
    return out


@functools.cache
def _joins_back() -> frozenset[str]:
    """Starters that compose with what stands before them, such as the vowels and tails of syllables."""
    seconds = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in range(0x110000):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            seconds.add(chr(int(parts[1], 16)))
    return frozenset(c for c in seconds if not unicodedata.combining(c))


def _clusters(kept: list[tuple[int, str]]) -> Iterator[tuple[int, int, str]]:
    """(start, end, composed form) of each base with the jamo and marks that follow it."""
    held, start, end = "", 0, 0
    for i, c in kept:
        first = unicodedata.normalize("NFKD", c)[0]
        if held and not unicodedata.combining(first) and first not in _joins_back():
            yield start, end, unicodedata.normalize("NFKC", held)
            held = ""
        if not held:
            start = i
        held, end = held + c, i + 1
    if held:
        yield start, end, unicodedata.normalize("NFKC", held)


def folded_positions(text: str) -> tuple[str, list[int], list[int]]:
    """``fold_for_match`` of the text, and for each of its letters the start and end of the place it comes from."""
    kept = [(i, c) for i, c in enumerate(text) if not _MARKS.match(c)]
    bare = "".join(c for _, c in kept)
    if unicodedata.is_normalized("NFKC", bare):
        parts = ((i, i + 1, c) for i, c in kept)
    else:
        parts = _clusters([(i, c) for i, c in kept if not _INVISIBLE.match(c)])
    starts, ends = [], []
    for start, end, form in parts:
        # Lower case may take more letters than upper case.
        n = len(_NOT_WORD.sub("", form.translate(_LOOKS_TABLE)).lower())
        starts += [start] * n
        ends += [end] * n
    folded = fold_for_match(text)
    if len(folded) != len(starts):
        raise ValueError("the places of the folded letters do not fit the folded text")
    return folded, starts, ends


def remove_leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "item_text") -> DataFrame:
    """The documents with every quoted span of an item cut out of ``text`` (other columns as they were).

    Repeated until no text quotes an item: what a cut brings together may be a quotation again.
    """
    blocks = [documents.sparkSession.sparkContext.broadcast(b) for b in _item_blocks(items, item_key, item_text)]
    out = documents
    while True:
        for shared in blocks:
            out = out.withColumn(text, _cutter(shared)(F.col(f"`{text}`")))
        if len(blocks) == 1:
            return out
        # A cut for one block may bring together a quotation of another block.
        out = cut_lineage(out)
        if leaked_items(out, items, key, text, item_key, item_text).isEmpty():
            return out


def _cutter(shared):
    """UDF: the text without the spans that items of one block share with it."""

    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = shared.value
        for batch in batches:
            kept = []
            texts = batch.to_pylist()
            quoted = index.runs_of([fold_for_match(t) if t and len(t) >= MIN_RUN else "" for t in texts])
            for t, found in zip(texts, quoted):
                while found:
                    _, starts, ends = folded_positions(t)
                    spans = sorted((starts[a], ends[b - 1]) for runs in found.values() for a, b in runs)
                    left, end = [], 0
                    for a, b in spans:
                        left.append(t[end:a])
                        end = max(end, b)
                    t = "".join(left) + t[end:]
                    # What a cut brings together may be a quotation again.
                    found = index.runs(fold_for_match(t)) if len(t) >= MIN_RUN else {}
                kept.append(t)
            yield pa.array(kept, type=pa.string())

    return F.arrow_udf(cut, "string")
