"""Problem 3: noise in text from scanned pages.

Lines whose digit-masked form recurs in the page margins of several uploads, or is a known exam
title, are headers; page numbers on a line of their own go too; words split by a hyphen at a line
end are joined; words are grouped by confusable-glyph skeleton and a rare form gives way to a
frequent form of its group which the neighbouring words support; the rest is reflowed with windows.
An unreadable sign is an open position of the skeleton: it stands for any one letter, and the form
that the neighbouring words support best takes its place. A word with an open position that no
form of its group fits is still found, and stays as it is in the repaired text.

Everything is counted over all rows of all tables given: nothing is sampled or capped, and no
threshold depends on the number of rows. The lines of a text are judged once and written; three
more passes over the cleaned texts count words, the contexts of rare forms, and the same contexts of
their frequent forms. Texts are not shuffled: each pass combines its counts within the partition
and only these move. A skeleton group of Hangul holds at most the 28 values of one glyph part, so
no group grows with the data. Sets sent to the executors are checked for size: words go in blocks
of at most BLOCK_ENTRIES, one pass for each block; more than MAX_FORMS header forms are joined.

Defined results: null and empty texts give no noise and stay as they are; repeated deliveries of
a row are one row of the result (in the word counts they weigh as often as they were delivered);
a missing box or page height only means that the row teaches no margin line; numbers on lines that
follow one another are the rows of a grid and no page numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..common import cut_lineage
from .charforms import SUSPICIOUS, plain_form, with_plain_form

# Signs that end a split word, signs of unreadable characters, misread choice marks.
HYPHENS = "\\-\u2010\u2011\u00ac\u00ad\u2212\u2013"
UNREADABLE = "\u25af\ufffd\u25a1"
MISREAD_MARKS = "@\u00a9\u00ae"

PAGE_NUMBER = (
    r"^\s*(?:[-\u2013\u2014\u00b7]\s*\d{1,4}\s*[-\u2013\u2014\u00b7]|\[\s*\d{1,4}\s*\]|\(\s*\d{1,4}\s*\)"
    r"|\d{1,4}\s*쪽|[pP]\.?\s*\d{1,4}|[Pp]age\s*\d{1,4}|\d{1,4}\s*/\s*\d{1,4}|\d{1,4})\s*$"
)
SPLIT_WORD = rf"(?<=[\p{{L}}\p{{N}}@{UNREADABLE}])[{HYPHENS}][ \t]*\n[ \t]*(?=[a-z가-힣0-9@{UNREADABLE}])"
#: Share of the page height that counts as margin.
MARGIN = 0.055
#: Uploads in which a masked margin line must recur.
MIN_UPLOADS = 2
#: A frequent form has at least this many occurrences; one that fills an open position is attested so often.
MIN_FREQUENT = 20
MIN_ATTESTED = 2
#: A rare form has at most one in so many of the occurrences of the frequent form.
RATIO = 12

# Closing particles of one syllable.
PARTICLES = tuple("은는이가을를의에도로와과만")

KINDS = ("hyphen", "misread", "header", "pageno")
#: Counts a worker holds before it passes them on (a memory bound: sums are completed by the shuffle).
HELD_COUNTS = 300_000
#: Entries of one set sent to the executors.
BLOCK_ENTRIES = 500_000
#: Bits of the map of contexts asked for (8 MB on every worker, whatever the number of contexts).
CONTEXT_BITS = 1 << 26
#: Header forms that are broadcast; more of them are joined with the lines instead.
MAX_FORMS = 200_000

_LINE_END = re.compile("\r\n|\r|\n")
_PAGE = re.compile(PAGE_NUMBER)
_DIGITS, _BLANK = re.compile(r"\d+"), re.compile(r"\s+")
_LEAD = re.compile(r"^[^\w#\[(]+")
_SESSION = re.compile(r"^(?:#교시|무단복제금지)[^\w#]*")
_FORM_LETTER = re.compile(r"\[[A-Z가-힣]형\]$")
_SPLIT = re.compile(rf"(?<=[\w@{UNREADABLE}])[{HYPHENS}][ \t]*\n[ \t]*(?=[a-z가-힣0-9@{UNREADABLE}])")
_TOKEN = re.compile(rf"[가-힣{UNREADABLE}]+|[A-Za-z0-9@{UNREADABLE}]*[A-Za-z][A-Za-z0-9@{UNREADABLE}]*|[0-9][0-9.,]*|[^\s]")
_WORD = re.compile(rf"[가-힣{UNREADABLE}]{{2,}}|[a-z0-9@{UNREADABLE}]*[a-z][a-z0-9@{UNREADABLE}]*")
_PAGE_FORM = r"^[^#\p{L}\p{N}]{0,2}#(?:[^#\p{L}\p{N}]#)?[^#\p{L}\p{N}]{0,2}$"
_UNREADABLE = re.compile(f"[{UNREADABLE}]")
_UNREADABLE_IN_WORD = re.compile(rf"\w[{UNREADABLE}]|[{UNREADABLE}]\w")
_MARK = re.compile(f"[{MISREAD_MARKS}]")
_MARK_OPENS = re.compile(rf"(?:^|\n)[ \t]*[{MISREAD_MARKS}][ \t]")
_DIGIT_INSIDE = re.compile("[a-z][0-9@][a-z]")
_DIGIT_IN_WORD = re.compile(r"(?<![@.\w])[A-Za-z]*[a-z][0-9@][a-z]")
_SUSPICIOUS = re.compile(SUSPICIOUS)
_SOFT_SPLIT = re.compile("\u00ad(?=[ \t]*(?:\r\n|\r|\n))")


def line_form(line: Column) -> Column:
    """The digit-masked line without spaces, leading signs, session numbers and form letters."""
    masked = F.regexp_replace(F.regexp_replace(line, r"\d+", "#"), r"(?U)\s+", "")
    bare = F.regexp_replace(masked, r"^[^\p{L}\p{N}#\[(]+", "")
    bare = F.regexp_replace(bare, "^(?:#교시|무단복제금지)[^\\p{L}\\p{N}#]*", "")
    return F.regexp_replace(bare, r"\[[A-Z가-힣]형\]$", "")


def margin_forms(blocks: DataFrame, exams: DataFrame | None = None) -> DataFrame:
    """(form): masked forms of header lines and page numbers, from blocks that stand in a page margin and from exam titles."""
    height = F.coalesce(F.col("page_height"), F.lit(841.9))
    edge = (F.col("bbox.y0") < MARGIN * height) | (F.col("bbox.y0") > (1 - MARGIN) * height)
    lines = blocks.where(edge & (F.col("bbox.y0") >= 0)).select("upload_id", F.explode(F.split("text", "\r\n|\r|\n")).alias("line"))
    lines = lines.select("upload_id", F.when(F.col("line").rlike(PAGE_NUMBER), F.lit("")).otherwise(line_form(F.col("line"))).alias("form"), F.regexp_replace(F.regexp_replace("line", r"\d+", "#"), r"(?U)\s+", "").alias("masked"))
    lines = lines.select("upload_id", F.when(F.col("masked").rlike(_PAGE_FORM), F.concat(F.lit(PAGE), "masked")).otherwise(F.col("form")).alias("form"))
    forms = lines.where(F.col("form").rlike(r"\p{L}{2}") | F.col("form").startswith(PAGE)).distinct().groupBy("form").count()
    forms = forms.where(F.col("count") >= MIN_UPLOADS).select("form")
    if exams is not None:
        forms = forms.unionByName(exams.select(line_form(F.col("title")).alias("form")).where("form <> ''"))
    return forms.distinct()


#: Stands before the masked form of a page number among the forms.
PAGE = "\u0001"


def form_of(line: str) -> str:
    """``line_form`` of one line."""
    bare = _LEAD.sub("", _BLANK.sub("", _DIGITS.sub("#", line)))
    return _FORM_LETTER.sub("", _SESSION.sub("", bare))


class Judge:
    """Judges the lines of a text by the forms of headers and page numbers."""

    def __init__(self, forms: set[str]):
        self.forms = forms
        self.longest = 4 * max(map(len, forms), default=0) + 8
        # A line can only be a header if it ends like one: most lines need no closer look.
        self.ends = frozenset(f[-1] for f in forms if f) | {"]"} | (frozenset("0123456789") if any(f.endswith("#") for f in forms) else frozenset())

    def lines(self, text: str) -> tuple[list[str], bool, bool]:
        """The lines that are text; whether there was a header; whether there was a page number."""
        if _SUSPICIOUS.search(text):
            # A soft hyphen at a line end splits a word; elsewhere it is an invisible sign.
            text = plain_form(_SOFT_SPLIT.sub("\u00ac", text))[0]
        kept, header, pageno = [], False, False
        numbers: list[str] = []  # lines of a number alone that follow one another
        for line in _LINE_END.split(text) if "\n" in text or "\r" in text else (text,):
            bare = line.strip()
            if bare.isdigit() and len(bare) <= 4:
                numbers.append(line)
                continue
            if numbers:
                pageno = pageno or len(numbers) == 1
                kept += numbers if len(numbers) > 1 else []
                numbers = []
            if len(line) < 12 and (_PAGE.match(line) or PAGE + _BLANK.sub("", _DIGITS.sub("#", line)) in self.forms):
                pageno = True
            elif len(line) <= self.longest and bare[-1:] in self.ends and form_of(line) in self.forms:
                header = True
            elif bare:
                kept.append(line)
        kept += numbers if len(numbers) > 1 else []
        return kept, header, pageno or len(numbers) == 1


def judged(rows: DataFrame, text: str, blocks: DataFrame, exams: DataFrame | None = None) -> DataFrame:
    """``rows`` with a struct ``__judged`` (joined, hyphen, header, pageno) of column ``text``, null for null.

    Up to MAX_FORMS forms are broadcast; beyond, each row gets the forms of its own lines by a join.
    """
    forms = cut_lineage(margin_forms(blocks, exams))
    column = F.col(f"`{text}`")
    if forms.count() <= MAX_FORMS:
        judge = rows.sparkSession.sparkContext.broadcast(Judge({f for (f,) in forms.toLocalIterator()}))
        return rows.withColumn("__judged", _judge(judge)(column))
    rows = with_plain_form(rows, text, "__plain").withColumn("__key", F.xxhash64("__plain"))
    lines = F.split("__plain", "\r\n|\r|\n")
    masked = lambda x: F.concat(F.lit(PAGE), F.regexp_replace(F.regexp_replace(x, r"\d+", "#"), r"(?U)\s+", ""))
    both = F.array_distinct(F.concat(F.transform(lines, line_form), F.transform(lines, masked)))
    own = rows.select("__key", F.explode(both).alias("form")).join(forms, "form", "left_semi").groupBy("__key").agg(F.collect_set("form").alias("__own"))
    return rows.join(own, "__key", "left").withColumn("__judged", _judge(None)(column, F.coalesce("__own", F.array().cast("array<string>")))).drop("__plain", "__key", "__own")


def _judge(judge):
    """UDF over texts, with the forms of the broadcast judge or of a second column."""

    def one(text: str | None, lines):
        if text is None:
            return None
        kept, header, pageno = lines(text)
        joined = join_split(kept)
        return {"joined": joined, "hyphen": len(kept) > 1 and joined.count("\n") < len(kept) - 1, "header": header, "pageno": pageno}

    kind = pa.struct([("joined", pa.string()), ("hyphen", pa.bool_()), ("header", pa.bool_()), ("pageno", pa.bool_())])

    def shared(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        lines = judge.value.lines
        for batch in batches:
            yield pa.array([one(t, lines) for t in batch.to_pylist()], type=kind)

    def own(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, forms in batches:
            yield pa.array([one(t, Judge(set(f)).lines) for t, f in zip(texts.to_pylist(), forms.to_pylist())], type=kind)

    return F.arrow_udf(shared if judge is not None else own, "joined string, hyphen boolean, header boolean, pageno boolean")


def join_split(kept: list[str]) -> str:
    """Kept lines as one text in which words split at line ends are whole."""
    text = "\n".join(kept)
    return _SPLIT.sub("", text) if len(kept) > 1 else text


def tokens_of(joined: str) -> list[str]:
    """Words, numbers (as #) and signs in lower case."""
    return ["#" if "0" <= t[0] <= "9" and not any(c.isalpha() for c in t) else t for t in _TOKEN.findall(joined.lower())]


def words_of(joined: str) -> list[str]:
    """The words of ``tokens_of`` alone: Hangul of two syllables or more, and Latin with its digits."""
    return _WORD.findall(joined.lower())


def open_skeleton(joined: str) -> bool:
    """Whether the glyphs of a word or choice mark show by themselves that they were misread.

    An unreadable sign inside a word is an open position, a digit between small letters or a sign
    in place of a choice mark belongs to another glyph class than its neighbours.
    """
    if _UNREADABLE.search(joined) and _UNREADABLE_IN_WORD.search(joined):
        return True
    if _MARK.search(joined) and _MARK_OPENS.search(joined):
        return True
    return bool(_DIGIT_INSIDE.search(joined) and _DIGIT_IN_WORD.search(joined))


def _blocks(rows: DataFrame, *keys: str) -> Iterator[list]:
    """Rows in blocks of at most about BLOCK_ENTRIES, by a hash of ``keys``."""
    n = -(-rows.count() // BLOCK_ENTRIES)
    for b in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64(*keys), F.lit(n)) == b)
        yield [tuple(r) for r in part.toLocalIterator()]


def _counted(texts: DataFrame, schema: str, emit) -> DataFrame:
    """Counts of what ``emit`` finds in each cleaned text, combined within each partition."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def flush():
            keys = list(counts)
            columns = [pa.array([k[i] for k in keys] if len(names) > 1 else keys, pa.string()) for i in range(len(names))]
            out = pa.RecordBatch.from_arrays([*columns, pa.array([counts[k] for k in keys], pa.int64())], names=[*names, "n"])
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    emit(text, counts)
            if len(counts) > HELD_COUNTS:
                yield flush()
        yield flush()

    parts = texts.mapInArrow(run, f"{schema}, n bigint")
    return parts.groupBy(*names).agg(F.sum("n").alias("n"))


def single_glyphs(word: Column) -> Column:
    """The word in lower case with one sign for each class of confusable single glyphs."""
    return F.translate(F.lower(word), "01i59@6c", "ollsgabe")


def latin_skeleton(word: Column) -> Column:
    """One skeleton for Latin words whose glyphs are easily confused: single glyphs, then pairs that look like one."""
    w = single_glyphs(word)
    for a, b in (("ll", "h"), ("rn", "m"), ("vv", "w")):
        w = F.replace(w, F.lit(a), F.lit(b))
    return w


def open_forms(word: Column) -> Column:
    """The word with each of its letters as an open position."""
    at = F.sequence(F.lit(1), F.length(word))
    return F.transform(at, lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.lit("*"), F.substring(word, i + 1, F.length(word))))


def hangul_skeletons(word: Column) -> Column:
    """For each syllable and each of its three glyph parts: the word with that part masked."""
    at = F.sequence(F.lit(1), F.length(word))

    def masked(i: Column) -> Column:
        code = F.ascii(F.substring(word, i, F.lit(1))) - 0xAC00
        lead, vowel, tail = F.floor(code / 588), F.floor(code / 28) % 21, code % 28
        head, rest = F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))
        s = lambda c: c.cast("int").cast("string")
        return F.array(
            F.concat(head, F.lit("<"), s(vowel), F.lit(","), s(tail), F.lit(",L>"), rest),
            F.concat(head, F.lit("<"), s(lead), F.lit(","), s(tail), F.lit(",V>"), rest),
            F.concat(head, F.lit("<"), s(lead), F.lit(","), s(vowel), F.lit(",T>"), rest),
        )

    return F.flatten(F.transform(at, masked))


def stem(word: Column) -> Column:
    """A Korean word without its closing particles, unless a single syllable would be left."""
    return F.regexp_replace(word, "(?<=[가-힣]{2})(?:으로|에서|에게|부터|까지|[은는이가을를의에도로와과만])+$", "")


def candidate_pairs(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From (word, n): Latin pairs (wrong, right), and pairs (wrong, right, n, m, gap) still to be supported by context.

    ``gap`` says whether the wrong form has an open position.
    """
    unreadable = F.col("word").rlike(f"[{UNREADABLE}]")
    gaps = counts.where(unreadable & (F.length(F.regexp_replace("word", f"[{UNREADABLE}]", "")) == F.length("word") - 1))
    counts = counts.where(~unreadable).withColumn("least", F.lit(MIN_FREQUENT))
    hangul = F.col("word").rlike("^[가-힣]")
    attested = counts.where((F.col("n") >= MIN_ATTESTED) & ~F.col("word").rlike("[0-9@]")).select(F.col("word").alias("right"), F.col("n").alias("m"), F.explode(open_forms(single_glyphs(F.col("word")))).alias("form"))
    gaps = gaps.select(F.col("word").alias("wrong"), "n", single_glyphs(F.regexp_replace("word", f"[{UNREADABLE}]", "*")).alias("form"))
    gaps = gaps.join(attested, "form").select("wrong", "right", "n", "m", F.lit(True).alias("gap"))

    # Latin: one skeleton, the most frequent form of the group.
    latin = counts.where(~hangul).withColumn("skeleton", latin_skeleton(F.col("word")))
    best = latin.where("n >= least and word rlike '^[a-z]+$'").groupBy("skeleton").agg(F.max_by("word", F.struct("n", "word")).alias("form"), F.max("n").alias("m"))
    latin_pairs = latin.join(best, "skeleton").where((F.col("word") != F.col("form")) & (F.col("m") >= RATIO * F.col("n")))
    latin_pairs = latin_pairs.where(F.col("word").rlike("[0-9@]") | (F.length("word") >= 4)).select(F.col("word").alias("wrong"), F.col("form").alias("right"))

    # Hangul: forms that differ in one glyph part.
    ko = counts.where(hangul)
    rare = ko.select(F.col("word").alias("wrong"), "n", F.explode(hangul_skeletons(F.col("word"))).alias("skeleton"))
    often = ko.where("n >= least").select(F.col("word").alias("right"), F.col("n").alias("m"), F.explode(hangul_skeletons(F.col("word"))).alias("skeleton"))
    pairs = rare.join(often, "skeleton").where((F.col("wrong") != F.col("right")) & (F.col("m") >= RATIO * F.col("n"))).select("wrong", "right", "n", "m").distinct()
    # Two forms of one word that differ in a closing particle are both right.
    last = lambda c: F.substring(c, -1, 1)
    pairs = pairs.where((last("wrong") == last("right")) | ~last("wrong").isin(*PARTICLES) | ~last("right").isin(*PARTICLES))
    # A word of its own stands with many particles: the whole stem must be as rare.
    stems = ko.groupBy(stem(F.col("word")).alias("s")).agg(F.sum("n").alias("k"))
    pairs = pairs.join(stems.select(F.col("s").alias("s1"), F.col("k").alias("k1")), stem(F.col("wrong")) == F.col("s1"))
    pairs = pairs.join(stems.select(F.col("s").alias("s2"), F.col("k").alias("k2")), stem(F.col("right")) == F.col("s2"))
    pairs = pairs.where(F.col("k2") >= RATIO * F.col("k1")).select("wrong", "right", "n", "m", F.lit(False).alias("gap"))
    return latin_pairs, pairs.unionByName(gaps)


class Repair:
    """Noise found in rows, and their repaired text. ``rows``: table_name, row_key, text."""

    def __init__(self, rows: DataFrame, blocks: DataFrame, exams: DataFrame | None = None):
        rows = rows.select("table_name", "row_key", "text")
        filled = F.col("text").isNotNull() & (F.col("text") != "")
        self.blank = rows.where(~filled)
        # Judged once; every later pass reads the cleaned texts.
        self.rows = cut_lineage(judged(rows.where(filled), "text", blocks, exams).select("table_name", "row_key", "__judged.*"))
        self.texts = self.rows.select("joined")
        self.pairs = cut_lineage(self._pairs())

    def _pairs(self) -> DataFrame:
        """(wrong, right): forms to replace and the form of their skeleton that the context supports."""
        context = self.rows.sparkSession.sparkContext

        def words(joined: str, counts: Counter) -> None:
            counts.update(words_of(joined))

        latin, others = candidate_pairs(cut_lineage(_counted(self.texts, "word string", words)))
        others = cut_lineage(others)

        # Contexts of the wrong forms, in one pass for each block of them.
        seen = None
        for block in _blocks(cut_lineage(others.select("wrong").distinct()), "wrong"):
            rare = context.broadcast(frozenset(w for (w,) in block))

            def contexts(joined: str, counts: Counter, rare=rare) -> None:
                sought = rare.value
                if sought.isdisjoint(words_of(joined)):
                    return
                tokens = tokens_of(joined)
                for left, t, right in zip(["", *tokens], tokens, [*tokens[1:], ""]):
                    if t in sought:
                        counts[t, "l", left] += 1
                        counts[t, "r", right] += 1

            part = _counted(self.texts, "word string, side string, x string", contexts)
            seen = part if seen is None else seen.unionByName(part)
        if seen is None:
            return latin
        at = cut_lineage(seen.withColumnRenamed("word", "wrong").join(others.select("wrong", "right"), "wrong"))

        # The same contexts of the right forms. Which ones are wanted is told by a bitmap of fixed size;
        # what it lets through by chance finds no partner in the join.
        bit = F.pmod(F.xxhash64(F.concat_ws("\0", "right", "side", "x")), F.lit(CONTEXT_BITS)).cast("int")
        wanted = np.zeros(CONTEXT_BITS, dtype=bool)
        wanted[at.select(bit.alias("b")).distinct().toArrow().column("b").to_numpy()] = True
        bits = context.broadcast(np.packbits(wanted, bitorder="little").tobytes())
        held = None
        for block in _blocks(cut_lineage(others.select("right").distinct()), "right"):
            heads = context.broadcast(frozenset(w for (w,) in block))

            def support(joined: str, counts: Counter, heads=heads, known: dict = {}) -> None:  # noqa: B006 - one memory for each worker
                sought, bitmap = heads.value, bits.value
                tokens = tokens_of(joined)
                for left, t, right in zip(["", *tokens], tokens, [*tokens[1:], ""]):
                    if t in sought:
                        for key in ((t, "l", left), (t, "r", right)):
                            asked = known.get(key)
                            if asked is None:
                                if len(known) >= HELD_COUNTS:
                                    known.clear()
                                b = xxhash.xxh64_intdigest("\0".join(key).encode("utf-8", "replace"), 42) & (CONTEXT_BITS - 1)
                                asked = known[key] = bool(bitmap[b >> 3] >> (b & 7) & 1)
                            if asked:
                                counts[key] += 1

            part = _counted(self.texts, "right string, side string, x string", support)
            held = part if held is None else held.unionByName(part)
        met = cut_lineage(at.withColumnRenamed("n", "k").join(held.withColumnRenamed("n", "held"), ["right", "side", "x"]).groupBy("wrong", "right", "side").agg(F.sum("k").alias("k"), F.sum("held").alias("held")))
        share = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("k"))), F.lit(0))
        sides = met.groupBy("wrong", "right").agg(share("l").alias("l"), share("r").alias("r"), F.sum("held").alias("held"))
        strong, weak = F.greatest("l", "r") / F.col("n"), F.least("l", "r") / F.col("n")
        closed = others.where("not gap").join(sides, ["wrong", "right"]).where((strong >= 0.6) & ((F.col("n") < 4) | (weak >= 0.08)))
        closed = closed.groupBy("wrong").agg(F.max_by("right", F.struct("m", "right")).alias("right"))
        # An open position takes the form met in most of its contexts; without any, only the one form that fits.
        filled = others.where("gap").join(sides, ["wrong", "right"], "left").withColumn("k", F.coalesce(F.col("l") + F.col("r"), F.lit(0)))
        rank = F.struct("k", F.coalesce("held", F.lit(0)).alias("held"), "m", "right")
        filled = filled.groupBy("wrong").agg(F.max_by("right", rank).alias("right"), F.max("k").alias("k"), F.count(F.lit(1)).alias("forms"))
        return latin.unionByName(closed).unionByName(filled.where("k > 0 or forms = 1").select("wrong", "right"))

    def _fixes(self):
        """Corrections for the executors, in blocks."""
        for block in [*_blocks(self.pairs, "wrong")] or [[]]:
            yield self.rows.sparkSession.sparkContext.broadcast(dict(block))

    def found(self) -> DataFrame:
        """(table_name, row_key, noise_kind)."""
        misread = F.lit(False)
        for fixes in self._fixes():
            misread = misread | _holder(fixes)(F.col("joined"))
        kinds = F.array(*[F.when(c, F.lit(k)) for k, c in zip(KINDS, (F.col("hyphen"), misread, F.col("header"), F.col("pageno")))])
        return self.rows.select("table_name", "row_key", F.explode(F.array_compact(kinds)).alias("noise_kind")).distinct()

    def _corrected(self) -> DataFrame:
        """(table_name, row_key, joined): whole words in their right forms, line by line."""
        column = F.col("joined")
        for fixes in self._fixes():
            column = _corrector(fixes)(column)
        return self.rows.dropDuplicates(["table_name", "row_key"]).select("table_name", "row_key", column.alias("joined"))

    def repaired(self) -> DataFrame:
        """(table_name, row_key, text): continuous paragraphs, reflowed with windows over the lines.

        A line starts a new paragraph if it starts with a choice mark (a misread mark gets the
        number it must have) or an image token; every other line continues the one before.
        """
        lines = self._corrected().select("table_name", "row_key", F.posexplode(F.split("joined", "\n")).alias("at", "line"))
        by_row = Window.partitionBy("table_name", "row_key").orderBy("at")
        misread = F.col("line").rlike(rf"^\s*[{MISREAD_MARKS}]\s")
        choice = misread | F.col("line").rlike(r"^\s*[①-⑩]")
        lines = lines.withColumn("mark", F.sum(choice.cast("int")).over(by_row)).withColumn("starts", choice | F.col("line").rlike(r"^\s*\[image"))
        marks = F.array(*[F.lit(c) for c in "①②③④⑤⑥⑦⑧⑨⑩"])
        mended = F.concat(F.coalesce(F.get(marks, F.col("mark") - 1), F.lit("")), F.regexp_replace("line", rf"^\s*[{MISREAD_MARKS}]", ""))
        lines = lines.withColumn("line", F.trim(F.when(misread, mended).otherwise(F.col("line"))))
        lines = lines.withColumn("paragraph", F.sum(F.col("starts").cast("int")).over(by_row))
        parts = F.array_sort(F.collect_list(F.struct("at", "paragraph", "line")))
        held = lines.groupBy("table_name", "row_key").agg(parts.alias("parts"))
        numbers = F.array_distinct(F.transform("parts", lambda p: p.paragraph))
        text = F.transform(numbers, lambda k: F.array_join(F.transform(F.filter("parts", lambda p: p.paragraph == k), lambda p: p.line), " "))
        blank = self.blank.dropDuplicates(["table_name", "row_key"])
        return held.select("table_name", "row_key", F.array_join(text, "\n").alias("text")).unionByName(blank)


def _holder(fixes):
    """UDF: whether a cleaned text holds a misread word."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        wrong = fixes.value
        for batch in batches:
            yield pa.array([open_skeleton(t) or not wrong.keys().isdisjoint(words_of(t)) for t in batch.to_pylist()], type=pa.bool_())

    return F.arrow_udf(run, "boolean")


def _corrector(fixes):
    """UDF: puts the words of cleaned texts in their right forms."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        right = fixes.value

        def better(m: re.Match) -> str:
            word = right.get(m[0].lower())
            return m[0] if word is None else word.capitalize() if m[0][:1].isupper() else word

        for batch in batches:
            yield pa.array([_TOKEN.sub(better, t) for t in batch.to_pylist()], type=pa.string())

    return F.arrow_udf(run, "string")


def without_margins(rows: DataFrame, key: str, text: str, blocks: DataFrame, exams: DataFrame | None = None) -> DataFrame:
    """``rows`` whose ``text`` has lost its header and page-number lines and whose split words are whole."""
    return judged(rows, text, blocks, exams).withColumn(text, F.col("__judged.joined")).drop("__judged")
