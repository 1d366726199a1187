"""Paths and sets of question images: resolution, shared images, synthetic questions, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def source_path(crop_path: Column, source: Column, path: Column) -> Column:
    """The first of the paths of an image that is not empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in (crop_path, source, path)])


def absolute_paths(images: DataFrame, files: DataFrame, root: Column, path: str = "path") -> DataFrame:
    """Relative paths below ``root`` that exist become absolute; others stay. ``files``: path."""
    full = F.concat(root, F.lit("/"), F.col(path))
    known = files.select(F.col("path").alias("__full")).distinct()
    out = images.withColumn("__want", F.when(~F.col(path).startswith("/"), full)).join(known, F.col("__want") == F.col("__full"), "left")
    return out.withColumn(path, F.coalesce("__full", path)).drop("__want", "__full")


def relative_path(path: Column, root: Column) -> Column:
    """A path below ``root`` without it; any other path stays."""
    base = F.concat(root, F.lit("/"))
    return F.when(path.startswith(base), F.substring(path, F.length(base) + 1, F.length(path))).otherwise(path)


def output_paths(sets: DataFrame, passages: DataFrame, key: str) -> DataFrame:
    """(key, path): problem, choices and passage images, each path once."""
    parts = [sets.select(key, F.explode(c).alias("path")) for c in ("problem_image_paths", "choices_image_paths")] + [passages.select(key, F.explode("image_paths").alias("path"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).dropDuplicates([key, "path"])


def take_shared_image(problem: Column, choices: Column) -> Column:
    """(shared, problem, choices): the last problem image if there are two, else the last choices image, taken out."""
    two, some = F.size(problem) >= 2, F.size(choices) >= 1
    last, head = lambda a: F.try_element_at(a, F.lit(-1)), lambda a: F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))
    return F.struct(F.when(two, last(problem)).when(some, last(choices)).alias("shared"), F.when(two, head(problem)).otherwise(problem).alias("problem"), F.when(~two & some, head(choices)).otherwise(choices).alias("choices"))


def synthetic_strips(texts: DataFrame, sets: DataFrame, doc: str) -> DataFrame:
    """(doc, question_index, path, strip_no, n_strips): questions read from the one image of an earlier index.

    A text without its own image belongs to the last image set at or before it, like an as-of join;
    only sets of one problem image and no choices image are cut, into as many strips as texts.
    """
    marks = sets.select(doc, "question_index", F.struct("question_index", "problem_image_paths", "choices_image_paths").alias("s"))
    both = texts.select(doc, "question_index").distinct().join(marks, [doc, "question_index"], "full_outer").join(texts.select(doc, "question_index").distinct().withColumn("is_text", F.lit(True)), [doc, "question_index"], "left")
    w = Window.partitionBy(doc).orderBy("question_index")
    held = both.withColumn("s", F.last("s", ignorenulls=True).over(w)).where("s is not null and is_text")
    group = Window.partitionBy(doc, "s.question_index")
    held = held.withColumn("n_strips", F.count(F.lit(1)).over(group)).withColumn("strip_no", F.row_number().over(group.orderBy("question_index")))
    good = (F.col("n_strips") > 1) & (F.size("s.problem_image_paths") == 1) & (F.coalesce(F.size("s.choices_image_paths"), F.lit(0)) <= 0)
    return held.where(good).select(doc, "question_index", F.get("s.problem_image_paths", F.lit(0)).alias("path"), "strip_no", "n_strips")


def section_title(index: Column, qno: Column) -> Column:
    number = F.when(qno.isNotNull(), F.concat(F.lit(" (No. "), qno.cast("string"), F.lit(")"))).otherwise("")
    return F.concat(F.lit("\\section*{Question "), index.cast("string"), number, F.lit("}"))


def passage_tex(passage_id: Column, start: Column, end: Column, qnos: Column, paths: Column) -> Column:
    """LaTeX block of a shared passage: a comment, a heading and its figures."""
    head = F.concat(F.lit("% "), F.array_join(F.transform(qnos, lambda q: F.concat(F.lit("q"), q.cast("string"))), ","), F.lit(" -> "), passage_id, F.lit(".txt\n\\subsection*{Shared Passage (No. "), start.cast("string"), F.lit("-"), end.cast("string"), F.lit(")}\n"))
    figure = F.transform(paths, lambda p: F.concat(F.lit("\\begin{figure}[H]\n\\centering\n\\includegraphics[width=\\textwidth]{"), p, F.lit("}\n\\end{figure}\n")))
    return F.concat(head, F.when(F.coalesce(F.size(paths), F.lit(0)) <= 0, F.lit("% shared passage image unavailable\n")).otherwise(F.array_join(figure, "\n")))


def marked_rows(markers: Column, rows: Column) -> Column:
    """Choice marks with the recognised rows beside them; the marks alone if no row says anything."""
    marks = T.clean_lines(markers)
    lines = F.transform(marks, lambda m, i: F.trim(F.concat_ws(" ", m, T.sparse_row(F.get(rows, i)))))
    useful = F.exists(F.transform(marks, lambda m, i: T.sparse_row(F.get(rows, i))), lambda r: r != "")
    return F.when(useful, F.array_join(lines, "\n")).otherwise(T.trim_u(markers))


def prefers_ocr(question: Column, choices: Column, ocr_choices: Column) -> Column:
    """Whether recognised choices replace parsed ones: parsed ones are missing or stuck in the question."""
    has = lambda c: F.exists(T.lines_of(F.coalesce(c, F.lit(""))), T.is_ocr_choice)
    blank = lambda c: T.collapse(F.coalesce(c, F.lit(""))) == ""
    return (has(question) & has(ocr_choices)) | (blank(choices) & ~blank(ocr_choices))


def from_expected(chunks: DataFrame, doc: str, order: str, expected: str) -> DataFrame:
    """Chunks from the first one with the expected number on; all of them if there is none."""
    w = Window.partitionBy(doc)
    first = F.min(F.when(F.col("qno") == F.col(expected), F.col(order))).over(w)
    return chunks.withColumn("__first", first).where(F.col("__first").isNull() | (F.col(order) >= F.col("__first"))).drop("__first")


def with_leading_number(text: Column, qno: Column) -> Column:
    """A question text whose leading number (or slash) is the given one."""
    return F.when(qno.isNull(), text).otherwise(T.trim_u(F.regexp_replace(text, r"^\s*(?:/|\d{1,3})\s*[.)]\s*", F.concat(qno.cast("string"), F.lit(". ")))))


def question_block(texts: DataFrame, key: str, text: str, expected: str | None = None) -> DataFrame:
    """(key, block): lines of the wanted question, up to the next start after three choices."""
    rows = texts.select(key, *([expected] if expected else []), F.posexplode(T.lines_of(F.col(text))).alias("at", "line"))
    qno = T.ocr_question_number(F.col("line"))
    wanted = (qno == F.col(expected)) if expected else qno.isNotNull()
    if expected:
        wanted = F.when(F.col(expected).isNull(), qno.isNotNull()).otherwise(wanted)
    whole, w = Window.partitionBy(key), Window.partitionBy(key).orderBy("at")
    rows = rows.withColumn("from", F.coalesce(F.min(F.when(wanted, F.col("at"))).over(whole), F.lit(0))).where(F.col("at") >= F.col("from"))
    seen = F.coalesce(F.sum(T.is_ocr_choice(F.col("line")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("seen", seen).withColumn("to", F.min(F.when(qno.isNotNull() & (F.col("at") > F.col("from")) & (F.col("seen") >= 3), F.col("at"))).over(whole))
    kept = rows.where(F.col("to").isNull() | (F.col("at") < F.col("to")))
    parts = F.array_sort(F.collect_list(F.struct("at", F.rtrim("line").alias("line"))))
    return kept.groupBy(key).agg(T.trim_u(F.array_join(F.transform(parts, lambda p: p["line"]), "\n")).alias("block"))


def file_name(kind: str, number: Column) -> Column:
    """Names of the text files written for a question: kind is concepts, answer or single_concept."""
    return F.concat(F.lit("question_"), T.padded(number, 3), F.lit(f"_{kind}.txt"))


def output_folder(root: Column, kind: str) -> Column:
    """Folder beside an input folder: kind is concepts, answer or single_concept."""
    parent = F.regexp_replace(root, "/[^/]+/?$", "")
    return F.concat(parent, F.lit(f"/exam_{kind}_txt"))


def document_folders(target: Column) -> Column:
    """Paths of the outputs of one document."""
    return F.struct(target.alias("target"), F.concat(target, F.lit("/latex_pages")).alias("pages"), F.concat(target, F.lit("/question_texts")).alias("texts"), F.concat(target, F.lit("/output.tex")).alias("tex"))
