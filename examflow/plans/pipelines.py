"""Whole pipelines composed of the operators: lines or trees in, records out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import answers, canonical, columns, layout, nodes, passages, segment
from ..operators.nested import FlatTables
from ..sources import writers

PARSERS = ("lines", "trees", "payloads")


def parse_exam(lines: DataFrame, blocks: DataFrame, doc: str = "upload_id") -> DataFrame:
    """(doc, question_no, subject, page_range, stem, choices, answer, confidence) of papers of lines and blocks.

    Lines whose left edge is over 20 from the median of the numbered lines of their page column do
    not open a question. Answers come from grids in the blocks; of several the last counts.
    """
    medians = layout.anchor_medians(lines, [doc, "page_number", "column_index"])
    marked = segment.subject_of_lines(lines, doc).join(medians, [doc, "page_number", "column_index"], "left")
    near = F.coalesce(F.abs(F.col("bbox.x0") - F.col("anchor_x")) <= 20, F.lit(True))
    kept = marked.where(F.col("text").isNotNull() & ~T.is_noise_line(F.col("text")) & T.detect_subject(F.col("text")).isNull())
    opens = T.question_number(F.col("text")).between(1, 100) & near
    rows = segment.islands(kept, [doc], "seq", opens).where("island > 0")
    held = rows.groupBy(doc, "island").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("p"), F.min_by("subject", "seq").alias("subject"), F.array(F.min("page_number"), F.max("page_number")).alias("page_range"))
    text = F.array_join(F.transform("p", lambda x: x["text"]), "\n")
    q = held.select(doc, "island", "subject", "page_range", T.question_number(text).alias("question_no"), T.strip_question_number(text).alias("raw_text"))
    q = q.withColumn("stem", T.normalize_stem(T.stem_before_choices(F.col("raw_text")))).withColumn("choices", T.split_choices(F.col("raw_text")))
    found = answers.grid_answers(blocks, "block_id", "text").join(blocks.select("block_id", doc), "block_id").groupBy(doc, "qno").agg(F.max_by("answer", "block_id").alias("answer"))
    out = answers.with_answers(q, found, [doc], "question_no")
    return out.withColumn("confidence", T.confidence(F.coalesce("stem", F.lit("")), F.size("choices"), F.col("answer"), F.coalesce("raw_text", F.lit(""))))


def parse_trees(docs: DataFrame, doc: str, raw: str, max_depth: int = 12) -> DataFrame:
    """Questions of element trees."""
    return nodes.extract_questions(docs, doc, raw, max_depth)


def parse_words(words: DataFrame, pages: DataFrame, doc: str) -> DataFrame:
    """Questions of words with boxes: bounds, columns, lines, islands."""
    placed = columns.ordered_words(words, pages, doc)
    placed = placed.select(doc, "page", "column_index", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"), "text")
    lines = segment.line_groups(placed, [doc, "page", "column_index"])
    # Wide enough for any page: places in a column and columns of a page never run into each other.
    seq = (F.col("page").cast("bigint") * 100 + F.col("column_index")) * 10_000_000 + F.col("line_no")
    return segment.build_questions(lines.select(doc, seq.alias("seq"), F.col("page").alias("page_number"), "text", layout.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("bbox")), doc)


def final_records(payloads: DataFrame, key: str = "record_id", payload: str = "payload") -> DataFrame:
    """Canonical questions of parser payloads in any dialect."""
    return canonical.normalize_questions(FlatTables(payloads, key, payload))


def to_markdown(docs: DataFrame, doc: str, raw: str, max_depth: int = 8) -> DataFrame:
    """(doc, markdown) of element trees: headings, paragraphs, lists and pictures in reading order."""
    n = nodes.flatten(docs, doc, raw, max_depth).where(F.col("type").isin("heading", "paragraph", "text block", "caption", "list item", *nodes.VISUAL))
    none = F.lit(None).cast("string")
    n = n.withColumn("md", nodes.element_markdown(F.col("type"), F.col("content"), F.col("heading_level"), none, F.col("source"), none))
    return nodes.assemble_markdown(n, doc, "path")


def database_records(texts: DataFrame, images: DataFrame, doc: str, stem: str) -> DataFrame:
    return passages.db_records(texts, images, doc, stem)


def write_finals(finals: DataFrame, doc: str, order: str, path: str) -> None:
    """One JSON text for each document."""
    writers.final_json(finals, doc, order).write.mode("overwrite").json(path)
