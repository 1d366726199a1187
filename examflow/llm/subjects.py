"""Problem 1: the subject areas of each question.

Each area has an interpolated n-gram language model over words without particles: its bigram and
unigram relative frequencies and the background model of all areas, mixed with fixed weights. What a
token says for an area is its cross-entropy under the background less that under the area; a token
or bigram that is not in the model says nothing, as all models agree on it. The gains of all tokens
are summed for every area; the area with the greatest sum is the first, if it reaches its
acceptance. A second area is accepted if the tokens it predicts better than the first add up to its
own acceptance. Acceptances are calibrated for every area on labelled stems held out from the
models, alone and joined in twos. The models start from the other labels and are then re-estimated
on all questions of a clear area, in as many rounds as LEARN has.

The printed subject decides where the stem names no matter: a heading is a token of its own with
counts per area from the clear stems under it, and is judged by the same gain. A question without a
matter in either takes the area of the least cross-entropy of both, however small its gain, and the
area most probable in the background if both are empty.

Words are read once: hashes of the tokens are written and every round counts them with NumPy.
Counts cover all labels and stems and have no threshold that depends on their number; the model
holds every n-gram of the labels and of at least MIN_STEMS stems. Up to MAX_GRAMS of them are
broadcast. More stay a table, and each block of stems is judged with the n-grams that it holds:
with the sums over the whole table these have the same gains as in the whole model.

Defined results: repeated deliveries are one question; nulls, empty and long texts are read whole;
without areas there are no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from ..common import cut_lineage, first_delivery

#: One label in so many is held out from the models for the calibration, in the order of each area.
HELD_OUT = 4
#: Weights of bigram, unigram and background in an area's model. With a heavy background only n-grams
#: several times as frequent in an area as elsewhere gain; slight preferences of common words do not add up.
WEIGHTS = (0.1, 0.1, 0.8)
#: Weights of bigram and unigram in the background.
BACKGROUND = (0.5, 0.5)
#: Occurrences added to each count, spread over the areas like the background.
PRIOR = 2.0
#: Occurrences of a word before in the background's proportions.
HISTORY = 30.0
#: Gains under this, in gains of a word of one area only, are slight preferences and say nothing.
MIN_GAIN = 0.6
#: In each round a stem teaches its first area from the first gain, a second one from the second, in gains of a word of one area only.
LEARN = ((0.9, 0.9),) * 4
#: Stems that an n-gram without a label is in at least.
MIN_STEMS = 3
#: n-grams that a worker holds (a memory bound, 8 bytes for each area and 17 more for each n-gram): a larger model is joined block by block.
MAX_GRAMS = 400_000
#: Acceptances tried in the calibration for the first and the second area, in gains of a word of one area only.
FIRST_GRID = (0.3, 0.4, 0.5, 0.6, 0.7)
SECOND_GRID = (0.45, 0.5, 0.55, 0.6, 0.65, 0.7, 0.75)
#: Other held-out stems that each one is joined with in the calibration.
JOINED = 4
#: n-grams a worker sums before it passes them on (a memory bound: the shuffle completes the sums).
HELD_GRAMS = 200_000
#: Stems of a block judged at once (a memory bound).
BLOCK_ROWS = 10_000
#: Words whose hashes a worker remembers (a memory bound).
HELD_WORDS = 200_000
#: Gain from which a heading decides.
HEADING_GAIN = 0.7

# Closing particles, longest first.
PARTICLES = "으로부터 에서의 에서는 에서도 에게서 으로는 으로서 으로써 이라는 에서 에게 에는 에도 에만 으로 로는 라는 까지 부터 마다 보다 처럼 만큼 이나 과의 와의 은 는 이 가 을 를 의 와 과 도 만 에 로".split()

_PARTICLES = frozenset(PARTICLES)
_PARTICLE = re.compile("(?<=[가-힣]{2})(?:" + "|".join(PARTICLES) + ")$")
_SPLIT = re.compile("(?<=\\w)[-\u2010\u2011\u00ac\u00ad\u2212\u2013][ \t]*\r?\n[ \t]*(?=[a-z가-힣])")
_WORD = re.compile(r"[가-힣]+|[a-z0-9@]*[a-z][a-z0-9@]*|[α-ω]")
_GLYPHS = str.maketrans("01i59@6c", "ollsgabe")
_HEADING = r"^\s*제?\s*\d*\s*과목\s*[:.]?\s*\d*\s*"


def skeleton(word: str) -> str:
    """Latin words by their glyph skeleton, so misread letters do not matter."""
    word = word.translate(_GLYPHS)
    for a, b in (("ll", "h"), ("rn", "m"), ("vv", "w")):
        word = word.replace(a, b)
    return word


def words_of(stem: str) -> list[str]:
    text = _SPLIT.sub("", stem).lower()
    return [_PARTICLE.sub("", w) if "가" <= w[0] <= "힣" else skeleton(w) for w in _WORD.findall(text) if w not in _PARTICLES]


def word_id(word: str) -> int:
    """A positive 63-bit name of a word."""
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1 or 1


def bigram_ids(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of bigrams of two arrays of words, apart from those of words by their sign."""
    with np.errstate(over="ignore"):
        x = left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + right.astype(np.uint64)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return -((x >> np.uint64(1)).astype(np.int64) | 1)


class Stems:
    """Tokens of several stems as one array: ``words``, the stem of each in ``row``, and the place of its bigram with the word before."""

    def __init__(self, words: np.ndarray, ends: np.ndarray):
        self.size = len(ends) - 1
        self.words, self.row = words, np.repeat(np.arange(self.size), np.diff(ends))
        pair = np.zeros(len(words), dtype=bool)
        pair[1:] = self.row[1:] == self.row[:-1]
        self.pairs = np.zeros(len(words), dtype=np.int64)  # 0: no word before
        at = np.flatnonzero(pair)
        self.pairs[at] = bigram_ids(words[at - 1], words[at])

    @classmethod
    def of(cls, lists: list[list[int]]) -> Stems:
        ends = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
        return cls(np.array([w for x in lists for w in x], dtype=np.int64), ends)

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """(row, gram), words and bigrams, once for each stem."""
        has = self.pairs != 0
        row, gram = np.concatenate([self.row, self.row[has]]), np.concatenate([self.words, self.pairs[has]])
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        first = np.ones(len(gram), dtype=bool)
        first[1:] = (gram[1:] != gram[:-1]) | (row[1:] != row[:-1])
        return row[first], gram[first]


def unit(n: int) -> float:
    """Gain of a word that stands in one of ``n`` areas only, and there as often as areas are many."""
    return float(np.log(WEIGHTS[2] + (1 - WEIGHTS[2]) * max(n, 2)))


def shares(of_words: np.ndarray) -> np.ndarray:
    """Shares of the areas in the occurrences of all words."""
    share = np.maximum(of_words, 1e-9)
    return share / share.sum()


class Model:
    """Gains of cross-entropy over the background, for each area, of the n-grams known.

    ``grams`` (sorted) with ``counts`` per area; ``before`` names the first word of each bigram.
    ``of_words`` are the sums of the counts of all words and ``n_words`` the number of these: ``grams``
    may be those of some stems only, and have the gains they have in the whole model.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, before: np.ndarray, of_words: np.ndarray, n_words: int):
        n = counts.shape[1]
        word = grams > 0
        share = shares(of_words)
        # The background holds every area alike, so areas with more questions do not gain by that.
        counts, of_words = counts / (n * share), of_words / (n * share)
        whole = counts.sum(1)
        # Every area gets PRIOR occurrences of the n-gram in the background's proportions.
        smooth = counts + PRIOR / n
        total = of_words + n_words * PRIOR / n
        back_one = (whole + PRIOR) / max(of_words.sum() + n_words * PRIOR, 1e-9)
        one = smooth / np.maximum(total, 1e-9)
        at = np.searchsorted(grams, before)
        known = ~word & (at < len(grams))
        known[known] = grams[at[known]] == before[known]
        head = np.where(known, at, 0)
        # After a word before it, an area's proportions are the background's until HISTORY occurrences tell otherwise.
        two_area, two_back = np.zeros_like(one), np.zeros(len(grams))
        two_back[known] = whole[known] / np.maximum(np.maximum(whole[head[known]], whole[known]), 1e-9)
        of_head = np.maximum(counts[head[known]], counts[known])
        two_area[known] = (counts[known] + HISTORY * two_back[known, None]) / (of_head + HISTORY)
        self.grams, self.width = grams, n
        self.one, self.back_one, self.two, self.two_back, self.known = one.astype(np.float32), back_one.astype(np.float32), two_area.astype(np.float32), two_back.astype(np.float32), known
        self.unit = unit(n)

    def _find(self, ids: np.ndarray) -> np.ndarray:
        """Places of n-grams, -1 for unknown ones."""
        if not len(self.grams):
            return np.full(len(ids), -1)
        at = np.minimum(np.searchsorted(self.grams, ids), len(self.grams) - 1)
        return np.where(self.grams[at] == ids, at, -1)

    def gains(self, stems: Stems) -> np.ndarray:
        """(tokens, areas): cross-entropy under the background less that under each area."""
        w, b = self._find(stems.words), self._find(stems.pairs)
        out = np.zeros((len(w), self.width), dtype=np.float32)
        some = w >= 0
        w, b = w[some], b[some]
        pair = (b >= 0) & self.known[np.maximum(b, 0)]
        two = np.where(pair[:, None], self.two[np.maximum(b, 0)], self.one[w])
        back_two = np.where(pair, self.two_back[np.maximum(b, 0)], self.back_one[w])
        back = BACKGROUND[0] * back_two + BACKGROUND[1] * self.back_one[w]
        area = WEIGHTS[0] * two + WEIGHTS[1] * self.one[w] + WEIGHTS[2] * back[:, None]
        gain = np.log(area / back[:, None])
        out[some] = np.where(gain >= MIN_GAIN * self.unit, gain, 0)
        return out

    def judge(self, stems: Stems) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each stem: the gains of all areas, the best area, and what each other area adds to it."""
        g = self.gains(stems)
        total = np.zeros((stems.size, self.width), dtype=np.float64)
        np.add.at(total, stems.row, g)
        first = total.argmax(1)
        more = np.maximum(g - g[np.arange(len(g)), first[stems.row]][:, None], 0) if len(g) else g
        # A token counts for a second area only as far as it is better than the background there.
        added = np.zeros_like(total)
        np.add.at(added, stems.row, np.minimum(more, np.maximum(g, 0)))
        return total, first, added


class Acceptance:
    """Per area: the gain the first area needs and the gain a second one adds."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first, second

    def areas(self, total: np.ndarray, first: np.ndarray, added: np.ndarray) -> list[list[int]]:
        added = np.where(np.arange(total.shape[1]) == first[:, None], -np.inf, added - self.second)
        other = added.argmax(1) if total.size else first
        at = np.arange(len(first))
        is_first, is_second = total[at, first] >= self.first[first], added[at, other] >= 0
        return [[int(a), int(b)] if p and q else [int(a)] if p else [] for a, b, p, q in zip(first, other, is_first, is_second)]


def tallies(model: Model, stems: Stems, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What the calibration adds up over held-out stems of area ``a`` (``b`` is -1) and joined ones of ``a`` and ``b``.

    For each value of FIRST_GRID the stems of one area that get it less those that get a wrong one, and
    for each pair of values of both grids and each area the stems rightly less those wrongly given it.
    """
    total, top, added = model.judge(stems)
    at, areas = np.arange(stems.size), np.arange(model.width)
    best = total[at, top]
    hit, single = (top == a) | (top == b), b < 0
    sign = np.where((areas == a[:, None]) | (areas == b[:, None]), 1, -1) * (areas != top[:, None])
    firsts, seconds = [x * model.unit for x in FIRST_GRID], [x * model.unit for x in SECOND_GRID]
    out = [np.array([(np.where(hit, 1, -1) * (single & (best >= t))).sum() for t in firsts])]
    for t in firsts:
        some = hit & (best >= t)
        out += [((added[some] >= u) * sign[some]).sum(0) for u in seconds]
    return np.concatenate(out).astype(np.int64)


def acceptance(sums: np.ndarray, width: int) -> Acceptance:
    """Acceptances from the sums of ``tallies``.

    First area: the value of FIRST_GRID with most true areas less wrong ones, of equally good ones that
    nearest the middle. Second area: for each area the value of SECOND_GRID with most joined stems
    right less stems wrongly given it, of equally good ones that nearest the best of all areas.
    """
    firsts, seconds = [x * unit(width) for x in FIRST_GRID], [x * unit(width) for x in SECOND_GRID]
    best = max(range(len(firsts)), key=lambda i: (sums[i], -abs(firsts[i] - unit(width) / 2)))
    right = sums[len(firsts) :].reshape(len(firsts), len(seconds), width)[best]
    whole = seconds[int(right.sum(1).argmax())]
    near = np.array([-abs(t - whole) for t in seconds])
    second = np.array([seconds[max(range(len(seconds)), key=lambda j: (right[j, a], near[j]))] for a in range(width)])
    return Acceptance(np.full(width, firsts[best]), second)


def token_names(text: Column) -> Column:
    """Names of the words of a text."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held: dict[str, int] = {}
        for batch in batches:
            flat: list[int] = []
            ends = [0]
            for text in batch.to_pylist():
                for w in words_of(text) if text else ():
                    h = held.get(w)
                    if h is None:
                        if len(held) >= HELD_WORDS:
                            held.clear()
                        h = held[w] = word_id(w)
                    flat.append(h)
                ends.append(len(flat))
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))

    return F.arrow_udf(run, "array<bigint>")(text)


def tokenised(rows: DataFrame, stem: str, heading: str) -> DataFrame:
    """``rows`` with ``words`` (names of the stem's words) and ``head`` (name of the heading, null without) instead of the texts."""
    name = F.lower(F.trim(F.regexp_replace(F.regexp_replace(heading, _HEADING, ""), r"(?U)\s+", " ")))
    head = F.when(name != "", F.xxhash64(name))
    return rows.withColumn("words", token_names(F.col(f"`{stem}`"))).withColumn("head", head).drop(stem, heading)


def _stems(column: pa.Array) -> Stems:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.array([0 if n is None else n for n in pa.compute.list_value_length(column).to_pylist()], dtype=np.int64)
    return Stems(flat, np.concatenate([[0], np.cumsum(sizes)]))


Judge = Callable[[Model, Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


class Tokens:
    """Rows with ``words``, and in blocks with the n-grams of each where the model is joined to them."""

    def __init__(self, rows: DataFrame):
        self.rows = rows
        self._blocks: tuple[DataFrame, DataFrame] | None = None

    def blocks(self) -> tuple[DataFrame, DataFrame]:
        """The rows with ``block``, and (block, gram) of them; blocks of so many tokens that MAX_GRAMS n-grams hold all theirs."""
        if self._blocks is None:
            n = self.rows.agg(F.sum(F.when(F.col("words").isNotNull(), F.size("words")).otherwise(0))).first()[0] or 0
            rows = self.rows.withColumn("block", F.pmod(F.xxhash64(*self.rows.columns), F.lit(2 * n // MAX_GRAMS + 1)))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    row, gram = _stems(batch.column("words")).grams()
                    pairs = np.unique(np.stack([batch.column("block").to_numpy()[row], gram], axis=1), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["block", "gram"])

            self._blocks = rows, cut_lineage(rows.select("block", "words").mapInArrow(run, "block bigint, gram bigint").distinct())
        return self._blocks


class Fitted:
    """A model of a table of counts (gram, before, c0, c1, …): broadcast up to MAX_GRAMS n-grams, else joined."""

    def __init__(self, counts: DataFrame, width: int):
        self.counts, self.width, self.unit = cut_lineage(counts), width, unit(width)
        names, word = [f"c{k}" for k in range(width)], F.col("gram") > 0
        size, n_words, *sums = self.counts.agg(F.count(F.lit(1)), F.count_if(word), *[F.sum(F.when(word, F.col(c))) for c in names]).first()
        self.of_words, self.n_words = np.array([x or 0.0 for x in sums]), n_words
        self.shared = None
        if size <= MAX_GRAMS:
            model = _model(self.counts.select("gram", "before", *names).toArrow(), self.of_words, n_words)
            self.shared = self.counts.sparkSession.sparkContext.broadcast(model)

    def judged(self, stems: Tokens, columns: list[str], f: Judge, schema: str | StructType) -> DataFrame:
        """What ``f`` makes of the ``columns`` of all stems with the model, or with the part of it that a block of stems holds."""
        if self.shared is not None:
            shared = self.shared
            return stems.rows.select(*columns).mapInArrow(lambda batches: f(shared.value, batches), schema)
        rows, grams = stems.blocks()
        of_words, n_words = self.of_words, self.n_words

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            model = _model(right.drop_columns(["block"]), of_words, n_words)
            return pa.Table.from_batches(list(f(model, iter(left.to_batches(max_chunksize=BLOCK_ROWS)))))

        part = grams.join(self.counts, "gram").select("block", "gram", "before", *(f"c{k}" for k in range(self.width)))
        return rows.select("block", *columns).groupBy("block").cogroup(part.groupBy("block")).applyInArrow(run, schema)


def _model(counts: pa.Table, of_words: np.ndarray, n_words: int) -> Model:
    """The model of a table of gram, before and counts per area, in any order."""
    gram, before, *areas = (c.to_numpy() for c in counts.columns)
    order = np.argsort(gram)
    return Model(gram[order], np.stack(areas, axis=1)[order], before[order], of_words, n_words)


def _counted(batches: Iterator[pa.RecordBatch], width: int, weights: Callable[[pa.RecordBatch, Stems], np.ndarray]) -> Iterator[pa.RecordBatch]:
    """(gram, before, stems, c0, c1, …): counts of each n-gram by the weights of its stems for each area, combined first."""
    names = ["gram", "before", "stems", *(f"c{k}" for k in range(width))]
    held: list[tuple] = []
    size = 0

    def combined():
        gram, before, n, c = (np.concatenate([h[i] for h in held]) for i in range(4))
        keys, first, inverse = np.unique(gram, return_index=True, return_inverse=True)
        sums = np.stack([np.bincount(inverse, weights=c[:, k], minlength=len(keys)) for k in range(width)], axis=1).astype(np.float64)
        return keys, before[first], np.bincount(inverse, weights=n, minlength=len(keys)).astype(np.int64), sums

    def flush(got):
        keys, before, n, sums = got
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(before), pa.array(n), *(pa.array(np.ascontiguousarray(sums[:, k])) for k in range(width))], names=names)

    for batch in batches:
        s = _stems(batch.column("words"))
        w = weights(batch, s)
        row, gram = s.grams()
        before = np.zeros(len(gram), dtype=np.int64)
        pairs, at = np.unique(s.pairs, return_index=True)
        place = np.searchsorted(pairs, gram[gram < 0])
        before[gram < 0] = s.words[at[place] - 1]
        held.append((gram, before, np.ones(len(gram)), w[row]))
        size += len(gram)
        if size > HELD_GRAMS:
            got = combined()
            held, size = [got], len(got[0])
            if size > HELD_GRAMS // 2:
                yield flush(got)
                held, size = [], 0
    if held:
        yield flush(combined())


def _count_schema(width: int) -> str:
    return "gram bigint, before bigint, stems bigint, " + ", ".join(f"c{k} double" for k in range(width))


def _summed(parts: DataFrame, width: int) -> DataFrame:
    return parts.groupBy("gram").agg(F.max("before").alias("before"), F.sum("stems").alias("stems"), *[F.sum(f"c{k}").alias(f"c{k}") for k in range(width)])


def soft_counts(stems: Tokens, model: Fitted, least: tuple[float, float]) -> DataFrame:
    """(gram, before, stems, c0, c1, …): counts of each n-gram weighted by the areas of its stems, combined within each partition first."""
    width = model.width
    learn = Acceptance(np.full(width, least[0] * model.unit), np.full(width, least[1] * model.unit))

    def run(m: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def weights(batch: pa.RecordBatch, s: Stems) -> np.ndarray:
            total, first, added = m.judge(s)
            # Only stems of a clear area teach; one of two areas teaches both by halves.
            w = np.zeros_like(total)
            for i, areas_ in enumerate(learn.areas(total, first, added)):
                w[i, areas_] = 1 / max(len(areas_), 1)
            return w

        return _counted(batches, width, weights)

    return _summed(model.judged(stems, ["words"], run, _count_schema(width)), width)


def label_counts(labels: DataFrame, width: int) -> DataFrame:
    """(gram, before, stems, c0, c1, …): stems of each area ``i`` that hold the n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _counted(batches, width, lambda batch, s: np.eye(width)[batch.column("i").to_numpy()])

    return _summed(labels.select("i", "words").mapInArrow(run, _count_schema(width)), width)


def numbered_labels(labels: DataFrame, codes: list[str]) -> DataFrame:
    """(i, n, words): area and words of each labelled stem, and its place among those of the area."""
    known = labels.select("label_id", "stem", (F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("area_code")) - 1).cast("int").alias("i"))
    known = known.where((F.col("stem") != "") & (F.col("i") >= 0)).withColumn("words", token_names(F.col("stem")))
    return known.select("i", (F.row_number().over(Window.partitionBy("i").orderBy("label_id", "stem")) - 1).alias("n"), "words")


def calibrated(model: Fitted, labels: DataFrame) -> Acceptance:
    """Acceptances from the held-out ones of ``numbered_labels``, alone and joined with later ones of other areas.

    A second matter is often told by a few words only, so stems are joined with either half of another.
    """
    width = model.width
    held = labels.where(F.col("n") % HELD_OUT == HELD_OUT - 1)
    sizes = dict(held.groupBy("i").count().collect())
    size = sum(sizes.values())
    if not size:
        return Acceptance(np.full(width, 0.5 * model.unit), np.full(width, 0.75 * model.unit))
    starts = np.concatenate([[0], np.cumsum([sizes.get(k, 0) for k in range(width)])[:-1]]).tolist()
    x = held.select("i", "words", (F.get(F.lit(starts), F.col("i")) + F.floor(F.col("n") / HELD_OUT)).cast("bigint").alias("at"))
    y = x.select(F.col("i").alias("b"), F.col("words").alias("more"), F.col("at").alias("other"))
    other = F.explode(F.array(*[(F.col("at") + k * size // (JOINED + 1) + k) % size for k in range(1, JOINED + 1)]))
    joined = x.withColumn("other", other).join(y, "other").where(F.col("i") != F.col("b"))
    half = F.floor(F.size("more") / 2).cast("int")
    halves = F.explode(F.array(F.slice("more", F.lit(1), half), F.slice("more", half + 1, F.size("more") - half)))
    joined = joined.select("i", "b", "words", halves.alias("half")).select("i", "b", F.concat("words", "half").alias("words"))
    stems = Tokens(x.select("i", F.lit(-1).alias("b"), "words").unionByName(joined))

    def run(m: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = tallies(m, _stems(batch.column("words")), batch.column("i").to_numpy(), batch.column("b").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(sums)], names=["place", "n"])

    sums = model.judged(stems, ["i", "b", "words"], run, "place bigint, n bigint").groupBy("place").agg(F.sum("n")).orderBy("place").collect()
    return acceptance(np.array([n for _, n in sums]), width)


def fit(stems: Tokens, labels: DataFrame, areas: DataFrame) -> tuple[Fitted | None, Acceptance | None, list[str]]:
    """The final model, from labels and then from all stems, its acceptances, and the areas in their order; without areas no model."""
    codes = sorted(r[0] for r in areas.select("area_code").where("area_code is not null").distinct().collect())
    if not codes:
        return None, None, codes
    known = cut_lineage(numbered_labels(labels, codes))
    names = [f"c{k}" for k in range(len(codes))]
    base = cut_lineage(label_counts(known.where(F.col("n") % HELD_OUT != HELD_OUT - 1), len(codes)))
    model = Fitted(base, len(codes))
    for least in LEARN:
        learnt = soft_counts(stems, model, least).where(F.col("stems") >= MIN_STEMS).where(sum((F.col(c) for c in names[1:]), F.col(names[0])) > 0)
        model = Fitted(_summed(learnt.unionByName(base), len(codes)), len(codes))
    return model, calibrated(model, known), codes


def subject_areas(questions: DataFrame, labels: DataFrame, areas: DataFrame, key: str = "question_id") -> DataFrame:
    """(key, area_code, by): the areas of each question and what decided: 'stem', 'subject' or 'least' (cross-entropy).

    ``questions`` has the key, subject and stem.
    """
    # Tokenised where the texts are read; only the tokens cross the network.
    rows = cut_lineage(first_delivery(tokenised(questions.select(key, "subject", "stem"), "stem", "subject"), key))
    stems = Tokens(rows)
    model, accept, codes = fit(stems, labels, areas)
    if model is None:
        return rows.select(key, F.lit(None).cast("string").alias("area_code"), F.lit("stem").alias("by")).limit(0)

    def run(m: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, first, added = m.judge(_stems(batch.column("words")))
            found = pa.array(accept.areas(total, first, added), pa.list_(pa.int32())), pa.array(total.tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("head"), *found], names=[key, "head", "areas", "gains"])

    schema = StructType([rows.schema[key], StructField("head", LongType()), StructField("areas", ArrayType(IntegerType())), StructField("gains", ArrayType(DoubleType()))])
    scored = cut_lineage(model.judged(stems, [key, "head", "words"], run, schema))
    code = lambda i: F.get(F.array(*[F.lit(c) for c in codes]), i)
    by_stem = scored.select(key, F.explode("areas").alias("i")).select(key, code(F.col("i")).alias("area_code"), F.lit("stem").alias("by"))

    # Headings: counts per area of the clear stems under each, the areas' own names with a weight of 5.
    clear = scored.where(F.size("areas") == 1).select("head", F.get("areas", F.lit(0)).alias("i"))
    numbers = areas.where("area_code is not null").select(F.explode(F.array(F.lower("name_ko"), F.lower("name_en"))).alias("name"), "area_code")
    numbers = numbers.select(F.xxhash64("name").alias("head"), (F.array_position(F.array(*[F.lit(c) for c in codes]), F.col("area_code")) - 1).cast("int").alias("i"), F.lit(5).cast("bigint").alias("n"))
    each = clear.where("head is not null").groupBy("head", "i").agg(F.count(F.lit(1)).alias("n")).unionByName(numbers).groupBy("head", "i").agg(F.sum("n").alias("n"))
    totals = each.groupBy("i").agg(F.sum("n").alias("of_area"))
    heads = each.join(F.broadcast(totals), "i").withColumn("all", F.lit(each.agg(F.sum("n")).first()[0] or 1))
    of_head = heads.groupBy("head").agg(F.sum("n").alias("of_head"))
    heads = heads.join(of_head, "head")
    # Interpolated with the background like any other token.
    back = F.col("of_head") / F.col("all")
    gain = F.log(((1 - WEIGHTS[2]) * F.col("n") / F.col("of_area") + WEIGHTS[2] * back) / back)
    heads = heads.groupBy("head").agg(F.max_by("i", F.struct(gain, "i")).alias("i"), F.max(gain).alias("gain"))
    silent = scored.where(F.size("areas") == 0).select(key, "head", "gains").join(heads, "head", "left")
    decides = F.coalesce(F.col("gain") >= HEADING_GAIN, F.lit(False))
    # Neither: the least cross-entropy of stem and heading, then the area most frequent in the background.
    best = F.array_max(F.transform("gains", lambda g, j: F.struct((g + F.when(j == F.col("i"), F.col("gain")).otherwise(0.0) + F.get(F.lit(list(map(float, 1e-6 * np.log(shares(model.of_words))))), j)).alias("g"), (-j).alias("j"))))
    rest = silent.select(key, code(F.when(decides, F.col("i")).otherwise(-best["j"])).alias("area_code"), F.when(decides, "subject").otherwise("least").alias("by"))
    return by_stem.unionByName(rest)
