"""Shared passages and database-ready records."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

PASSAGE = r"\[\s*(\d{1,3})\s*[~\-]\s*(\d{1,3})\s*\]\s*다음\s*글을\s*읽고\s*물음에\s*답하시오\.?"


def shared_passages(texts: DataFrame, doc: str, order: str, qno: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Passages (doc, passage_id, start_qno, end_qno, passage_text) and their questions (doc, qno, passage_id).

    Swapped ends are put right; only question numbers the document has count, and a passage without
    any is dropped. Of one passage id the first counts; of two passages for one question the later.
    """
    a, b = (F.regexp_extract(text, PASSAGE, g).try_cast("int") for g in (1, 2))
    found = texts.where(F.col(text).rlike(PASSAGE)).select(doc, order, F.least(a, b).alias("start_qno"), F.greatest(a, b).alias("end_qno"), T.trim_u(F.regexp_extract(text, f"(?s)({PASSAGE}.*)$", 1)).alias("passage_text"))
    number = lambda c: F.lpad(F.col(c).cast("string"), 3, "0")
    found = found.withColumn("passage_id", F.concat(F.lit("shared_passage_"), number("start_qno"), F.lit("_"), number("end_qno")))
    numbers = texts.where(F.col(qno).isNotNull()).select(doc, F.col(qno).alias("qno")).distinct()
    targets = found.select(doc, order, "passage_id", F.explode(F.sequence("start_qno", "end_qno")).alias("qno")).join(numbers, [doc, "qno"], "left_semi")
    kept = found.join(targets.select(doc, order).distinct(), [doc, order], "left_semi")
    first = kept.withColumn("n", F.row_number().over(Window.partitionBy(doc, "passage_id").orderBy(order))).where("n = 1").drop("n")
    links = targets.join(first.select(doc, order, "passage_id"), [doc, order, "passage_id"], "left_semi")
    links = links.groupBy(doc, "qno").agg(F.max_by("passage_id", order).alias("passage_id"))
    return first.drop(order), links


def db_records(texts: DataFrame, images: DataFrame, doc: str, stem: str) -> DataFrame:
    """Flat records from question texts and question images, matched by index; either may be missing.

    ``texts``: doc, stem, question_index, qno, question_text, choices_text; ``images``: doc,
    question_index, image_qno, problem_image_paths. The text's number counts wherever the text exists.
    """
    both = texts.withColumn("has_text", F.lit(True)).join(images, [doc, "question_index"], "full_outer")
    q, c = F.coalesce("question_text", F.lit("")), F.coalesce("choices_text", F.lit(""))
    number = F.when(F.col("has_text"), F.col("qno")).otherwise(F.col("image_qno"))
    digest = F.sha1(T.collapse(F.concat(q, F.lit("\n"), c, F.lit("\n"))))
    record = F.concat(F.coalesce(stem, F.lit("")), F.lit(":"), F.lpad(F.col("question_index").cast("string"), F.greatest(F.lit(3), F.length(F.col("question_index").cast("string"))), F.lit("0")), F.lit(":"), F.coalesce(number.cast("string"), F.lit("na")), F.lit(":"), F.substring(digest, 1, 12))
    return both.select(doc, F.lit("v1").alias("schema_version"), record.alias("record_id"), "question_index", number.alias("question_number"), q.alias("question_text"), c.alias("choices_text"), F.coalesce("problem_image_paths", F.array().cast("array<string>")).alias("problem_image_paths"), digest.alias("content_hash"))


def latex_document(records: DataFrame, doc: str, order: str) -> DataFrame:
    """(doc, tex): one LaTeX document of question sections in order."""
    body = F.concat(F.lit("\\section*{"), F.coalesce(F.concat(F.lit("문제 "), F.col("question_number").cast("string")), F.lit("문제")), F.lit("}\n"), T.escape_latex(F.col("question_text")))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), body.alias("body"))))
    tex = F.concat(F.lit("\\documentclass{article}\n\\begin{document}\n"), F.array_join(F.transform(parts, lambda p: p["body"]), "\n"), F.lit("\n\\end{document}\n"))
    return records.groupBy(doc).agg(tex.alias("tex"))
