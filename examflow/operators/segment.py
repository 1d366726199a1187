"""Ordered lines to questions, chunks, spans and runs: gaps-and-islands with windows.

Every window is partitioned by a document key, so documents are independent and one shuffle on
that key serves a whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def islands(df: DataFrame, keys: list[str], order: str, starts: Column, into: str = "island") -> DataFrame:
    """Number rows by the start at or before them; rows before the first start get 0."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn(into, F.sum(F.coalesce(starts, F.lit(False)).cast("int")).over(w))


def build_questions(lines: DataFrame, key: str = "upload_id") -> DataFrame:
    """(key, island, question_number, n_lines, text, first and last page, bbox) from ordered lines.

    Skip lines are dropped, lines before the first question too; numbers may repeat. ``lines`` has
    the key, seq, page_number, text and bbox; null boxes do not count for the union of boxes.
    """
    kept = lines.where(F.col("text").isNotNull() & ~T.is_skip_line(F.col("text"))).withColumn("text", T.collapse(F.col("text")))
    numbered = islands(kept, [key], "seq", T.is_question_line(F.col("text"))).where("island > 0")
    held = numbered.groupBy(key, "island").agg(
        F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("parts"),
        F.min("page_number").alias("first_page"), F.max("page_number").alias("last_page"),
        F.round(F.min("bbox.x0"), 3).alias("x0"), F.round(F.min("bbox.y0"), 3).alias("y0"), F.round(F.max("bbox.x1"), 3).alias("x1"), F.round(F.max("bbox.y1"), 3).alias("y1"),
    )
    text = F.array_join(F.transform("parts", lambda p: p.text), " ")
    return held.select(
        key, "island", F.regexp_extract(text, r"^(\d{1,3})\.", 1).cast("int").alias("question_number"), F.size("parts").alias("n_lines"),
        F.regexp_replace(text, r"^\d{1,3}\.\s*", "").alias("text"), "first_page", "last_page", "x0", "y0", "x1", "y1",
    )


def explode_choices(questions: DataFrame, text: str = "text", marks: str = "①-④") -> DataFrame:
    """One row for each choice: the columns of ``questions`` and choice_pos, number, choice_text."""
    out = questions.withColumn("__c", F.explode(F.transform(T.split_choices(F.col(text), marks), lambda c, i: F.struct((i + 1).alias("pos"), c.number.alias("number"), c.text.alias("text")))))
    return out.select("*", F.col("__c.pos").alias("choice_pos"), F.col("__c.number").alias("choice_number"), F.col("__c.text").alias("choice_text")).drop("__c")


def line_groups(words: DataFrame, keys: list[str], tolerance: float = 3.0) -> DataFrame:
    """Words to lines: a word joins the open line if its y0 is near the running mean of that line.

    The mean moves with every word, so this is a fold over the ordered words of a page column, not
    a window; the group held is one page column.
    """
    ordered = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("y0", "x0", "x1", "y1", "text"))).alias("ws"))
    word = "struct<y0:double,x0:double,x1:double,y1:double,text:string>"
    start = F.struct(F.array().cast(f"array<array<{word}>>").alias("done"), F.array().cast(f"array<{word}>").alias("open"), F.lit(0.0).alias("sum"))

    def step(acc: Column, w: Column) -> Column:
        near = (F.size(acc["open"]) > 0) & (F.abs(w["y0"] - acc["sum"] / F.greatest(F.size(acc["open"]), F.lit(1))) <= tolerance)
        fresh = F.size(acc["open"]) == 0
        return F.struct(
            F.when(near | fresh, acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["open"]))).alias("done"),
            F.when(near, F.concat(acc["open"], F.array(w))).otherwise(F.array(w)).alias("open"),
            F.when(near, acc["sum"] + w["y0"]).otherwise(w["y0"]).alias("sum"),
        )

    lines = F.aggregate("ws", start, step, lambda acc: F.concat(acc["done"], F.array(acc["open"])))
    out = ordered.select(*keys, F.posexplode(lines).alias("line_no", "line"))
    by_x = F.array_sort(F.transform("line", lambda w: F.struct(w["x0"].alias("x0"), w["text"].alias("text"))))
    out = out.select(
        *keys, "line_no", T.collapse(F.array_join(F.transform(by_x, lambda w: w["text"]), " ")).alias("text"),
        F.array_min(F.transform("line", lambda w: w["x0"])).alias("x0"), F.array_min(F.transform("line", lambda w: w["y0"])).alias("y0"),
        F.array_max(F.transform("line", lambda w: w["x1"])).alias("x1"), F.array_max(F.transform("line", lambda w: w["y1"])).alias("y1"),
    )
    return out.where(~T.is_skip_line(F.col("text")))


def runs(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    """(keys, start, end, size) of runs of consecutive positions; repeated positions count once."""
    distinct = df.select(*keys, position).distinct()
    w = Window.partitionBy(*keys).orderBy(position)
    grouped = distinct.withColumn("g", F.col(position) - F.row_number().over(w))
    return grouped.groupBy(*keys, "g").agg(F.min(position).alias("start"), F.max(position).alias("end"), F.count(F.lit(1)).alias("size")).drop("g")


def prefix_run(df: DataFrame, keys: list[str], position: str, flag: str, cap: int) -> DataFrame:
    """(keys, n): how many rows from position 0 on have the flag without a gap, ``cap`` at most."""
    first_off = F.min(F.when(~F.coalesce(F.col(flag), F.lit(False)), F.col(position)))
    return df.groupBy(*keys).agg(F.least(F.coalesce(first_off, F.max(position) + 1), F.lit(cap)).cast("int").alias("n"))


def ocr_chunks(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, chunk_no, qno, chunk): recognised text cut at question starts; without any start one chunk.

    Text before the first start is dropped if there is a start.
    """
    lines = F.filter(F.transform(T.lines_of(F.col(text)), lambda x: F.rtrim(x)), lambda x: F.trim(x) != "")
    rows = texts.select(F.col(key), F.posexplode(lines).alias("at", "line"))
    w = Window.partitionBy(key).orderBy("at")
    rows = rows.withColumn("qno", T.ocr_question_number(F.col("line"))).withColumn("chunk_no", F.count("qno").over(w))
    rows = rows.withColumn("any", F.max("chunk_no").over(Window.partitionBy(key))).where("chunk_no > 0 or any = 0")
    parts = F.array_sort(F.collect_list(F.struct("at", "line")))
    return rows.groupBy(key, "chunk_no").agg(F.max("qno").alias("qno"), F.trim(F.array_join(F.transform(parts, lambda p: p.line), "\n")).alias("chunk"))


def renumber_shifted(chunks: DataFrame, key: str, order: str, qno: str = "qno", least: int = 6) -> DataFrame:
    """Question numbers that from some place on are one too high are renumbered from 1.

    Only documents of at least ``least`` chunks, all numbered, starting at 1 and strictly rising,
    whose numbers after the first deviation are all exactly one too high.
    """
    w, whole = Window.partitionBy(key).orderBy(order), Window.partitionBy(key)
    n = F.col(qno)
    marked = chunks.withColumn("__want", F.row_number().over(w)).withColumn("__rise", F.coalesce(n > F.lag(n).over(w), n.isNotNull()))
    marked = marked.withColumn("__off", n - F.col("__want")).withColumn("__late", F.max((F.col("__off") != 0).cast("int")).over(w))
    ok = (
        (F.count(F.lit(1)).over(whole) >= least) & (F.count(qno).over(whole) == F.count(F.lit(1)).over(whole)) & (F.first(qno).over(w) == 1)
        & F.min(F.col("__rise")).over(whole) & F.min((F.col("__late") == 0) | (F.col("__off") == 1)).over(whole)
    )
    marked = marked.withColumn("__ok", ok).withColumn("new_qno", F.when(F.col("__ok"), F.col("__want")).otherwise(n))
    return marked.drop("__want", "__rise", "__off", "__late", "__ok")


def split_at_choices(texts: DataFrame, text: str, wide: bool = False) -> DataFrame:
    """Add question_text and choices_text: everything before and from the first choice line."""
    lines = T.lines_of(F.col(text))
    is_choice = (lambda x: T.is_ocr_choice(x)) if wide else (lambda x: x.rlike(r"^\s*[①-⑩]\s*|^\s*\(\s*[1-5]\s*\)\s*"))
    flags = F.transform(lines, is_choice)
    at = F.array_position(flags, F.lit(True)).cast("int")
    head = F.when(at > 0, F.slice(lines, F.lit(1), at - 1)).otherwise(lines)
    tail = F.when(at > 0, F.slice(lines, at, F.size(lines))).otherwise(F.array().cast("array<string>"))
    return texts.withColumn("question_text", T.trim_u(F.array_join(head, "\n"))).withColumn("choices_text", T.trim_u(F.array_join(tail, "\n")))


def score_candidate(text: Column) -> Column:
    """Sort key of a recognised text: has a number, choices up to 5, low number, enough text, not too long."""
    lines = T.lines_of(text)
    starts = F.transform(lines, T.ocr_question_number)
    n_choices = F.size(F.filter(lines, T.is_ocr_choice))
    qno = F.get(F.filter(starts, lambda x: x.isNotNull()), F.lit(0))
    size = F.length(T.collapse(text))
    return F.struct(qno.isNotNull().cast("int").alias("numbered"), F.least(n_choices, F.lit(5)).alias("choices"), (-F.coalesce(qno, F.lit(999))).alias("low"), (size >= 20).cast("int").alias("long"), (-F.greatest(F.lit(0), size - 1800)).alias("over"))


def best_candidate(df: DataFrame, keys: list[str], text: str, order: str) -> DataFrame:
    """The best scored text of each key; of equal ones the first in ``order``."""
    return df.groupBy(*keys).agg(F.max_by(text, F.struct(score_candidate(F.col(text)), -F.col(order))).alias("best_text"), F.count(F.lit(1)).alias("n_candidates"))


def markdown_questions(docs: DataFrame, key: str, markdown: str) -> DataFrame:
    """(key, question_index, qno, content): a Markdown text cut at lines that start a question."""
    rows = docs.select(key, F.posexplode(F.split(markdown, "\n")).alias("at", "line"))
    rows = rows.withColumn("qno", F.nullif(F.regexp_extract(F.regexp_replace("line", "^[- ]+", ""), r"^\s*(\d{1,3})\s*[.)]\s*", 1), F.lit("")).cast("int"))
    rows = islands(rows, [key], "at", F.col("qno").isNotNull(), "question_index").where("question_index > 0")
    parts = F.array_sort(F.collect_list(F.struct("at", "line")))
    return rows.groupBy(key, "question_index").agg(F.max("qno").alias("qno"), T.trim_u(F.array_join(F.transform(parts, lambda p: p.line), "\n")).alias("content"))


def question_spans(starts: DataFrame, cells: DataFrame, key: str) -> DataFrame:
    """(key, index, qno, page, col, start_y, end_y): the page columns each question covers.

    ``starts``: key, page, col, y0, qno; ``cells``: key, page, col, page_height, every column of
    every page. A question runs to the next start; cells of at most 4 high are dropped.
    """
    w = Window.partitionBy(key).orderBy("page", "col", "y0")
    s = starts.select(
        key, F.row_number().over(w).alias("index"), "qno", F.col("page").alias("p0"), F.col("col").alias("c0"), F.col("y0").alias("from_y"),
        F.lead("page").over(w).alias("p1"), F.lead("col").over(w).alias("c1"), F.lead("y0").over(w).alias("to_y"),
    )
    at = F.struct("page", "col")
    met = s.join(cells, key).where((at >= F.struct("p0", "c0")) & (F.col("p1").isNull() | (at <= F.struct("p1", "c1"))))
    start_y = F.when((F.col("page") == F.col("p0")) & (F.col("col") == F.col("c0")), F.col("from_y")).otherwise(0.0)
    end_y = F.when((F.col("page") == F.col("p1")) & (F.col("col") == F.col("c1")), F.col("to_y")).otherwise(F.col("page_height"))
    return met.select(key, "index", "qno", "page", "col", start_y.alias("start_y"), end_y.alias("end_y")).where("end_y > start_y + 4.0")


def split_by_anchor(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, segment_no, segment): a block cut where a number exceeds the last accepted one by 1 or 2.

    The accepted number moves only when a cut is made, so this is a fold over the block's lines.
    """
    lines = T.clean_lines(F.coalesce(F.col(text), F.lit("")))
    start = F.struct(F.array().cast("array<array<string>>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(None).cast("int").alias("last"))

    def step(acc: Column, line: Column) -> Column:
        n = T.question_number(line)
        cut = F.coalesce((F.size(acc["open"]) > 0) & (n - acc["last"]).between(1, 2), F.lit(False))
        return F.struct(
            F.when(cut, F.concat(acc["done"], F.array(acc["open"]))).otherwise(acc["done"]).alias("done"),
            F.when(cut, F.array(line)).otherwise(F.concat(acc["open"], F.array(line))).alias("open"),
            F.when(cut | acc["last"].isNull(), F.coalesce(n, acc["last"])).otherwise(acc["last"]).alias("last"),
        )

    parts = F.aggregate(lines, start, step, lambda acc: F.filter(F.concat(acc["done"], F.array(acc["open"])), lambda s: F.size(s) > 0))
    rows = texts.select(key, F.posexplode(parts).alias("at", "lines"))
    return rows.select(key, (F.col("at") + 1).alias("segment_no"), F.array_join("lines", "\n").alias("segment"))


def subject_of_lines(lines: DataFrame, key: str = "upload_id") -> DataFrame:
    """Add ``subject``: of the last subject heading at or before each line."""
    w = Window.partitionBy(key).orderBy("seq")
    return lines.withColumn("subject", F.last(T.detect_subject(F.col("text")), ignorenulls=True).over(w))


def free_indexes(wanted: DataFrame, key: str, order: str, preferred: str) -> DataFrame:
    """(key, order, index): each row in turn gets the least free index from its preferred one on."""
    rows = wanted.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(preferred).alias("p")))).alias("rows"))
    start = F.struct(F.array().cast("array<int>").alias("used"))

    def step(acc: Column, r: Column) -> Column:
        base = F.greatest(F.lit(1), r["p"]).cast("int")
        free = F.filter(F.sequence(base, base + F.size(acc["used"])), lambda x: ~F.array_contains(acc["used"], x))
        return F.struct(F.concat(acc["used"], F.array(F.get(free, F.lit(0)))).alias("used"))

    used = rows.select(key, "rows", F.aggregate("rows", start, step, lambda acc: acc["used"]).alias("used"))
    out = used.select(key, F.posexplode("rows").alias("at", "r"), "used")
    return out.select(key, F.col("r.o").alias(order), F.get("used", F.col("at")).alias("index"))
