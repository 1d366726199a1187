"""Answer grids, inline answers and their joins with questions. Of repeated numbers the last wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

PAIR = r"(?:^|\s)(\d{1,3})\s*[.:)]\s*([①②③④⑤]|모두답|[1-5](?:\s*,\s*[1-5])*)(?=\s|$)"
NUMBER_ROW = r"^\s*(?:\d{1,3}\s+){3,}\d{1,3}\s*$"
ANSWER_TOKEN = r"^(?:[①②③④⑤]|\d(?:\s*,\s*\d+)*|모두답)$"


def inline_answers(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, qno, answer) from pairs such as ``1.① 2.모두답 3.2,4``; numbers 1 to 100."""
    both = F.arrays_zip(F.regexp_extract_all(text, F.lit(PAIR), F.lit(1)).alias("q"), F.regexp_extract_all(text, F.lit(PAIR), F.lit(2)).alias("a"))
    rows = texts.select(key, F.posexplode(both).alias("at", "x")).select(key, "at", F.col("x.q").try_cast("int").alias("qno"), T.normalize_answer(F.col("x.a")).alias("answer"))
    return rows.where("qno between 1 and 100").groupBy(key, "qno").agg(F.max_by("answer", "at").alias("answer"))


def grid_answers(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, qno, answer) from a row of numbers over a row of as many answers; else from alternating tokens."""
    lines = T.clean_lines(F.coalesce(F.col(text), F.lit("")))
    held = texts.select(key, lines.alias("lines"))
    rows = held.select(key, "lines", F.posexplode("lines").alias("at", "line")).withColumn("next", F.get("lines", F.col("at") + 1))
    numbers, answers = F.split("line", " "), F.split("next", " ")
    good = F.col("line").rlike(NUMBER_ROW) & (F.size(numbers) == F.size(answers)) & F.forall(answers, lambda a: a.rlike(ANSWER_TOKEN))
    grid = rows.where(good).select(key, "at", F.posexplode(F.arrays_zip(numbers.alias("q"), answers.alias("a"))).alias("i", "x"))
    grid = grid.select(key, (F.col("at") * 1000 + F.col("i")).alias("o"), F.col("x.q").try_cast("int").alias("qno"), F.col("x.a").alias("a")).where("qno between 1 and 100")
    tokens = F.filter(F.split(F.array_join("lines", " "), " "), lambda t: t != "")
    pairs = held.select(key, tokens.alias("tokens")).where("size(tokens) >= 2").select(key, "tokens", F.explode(F.sequence(F.lit(0), F.size("tokens") - 2, F.lit(2))).alias("o"))
    pairs = pairs.select(key, "o", F.get("tokens", F.col("o")).alias("q"), F.get("tokens", F.col("o") + 1).alias("a"))
    pairs = pairs.where(F.col("q").rlike("^[0-9]{1,3}$") & F.col("a").rlike(ANSWER_TOKEN)).select(key, "o", F.col("q").cast("int").alias("qno"), "a").where("qno between 1 and 100")
    both = grid.withColumn("kind", F.lit(0)).unionByName(pairs.withColumn("kind", F.lit(1)))
    both = both.withColumn("best", F.min("kind").over(Window.partitionBy(key))).where("kind = best")
    return both.groupBy(key, "qno").agg(T.normalize_answer(F.max_by("a", "o")).alias("answer"))


def with_answers(questions: DataFrame, answers: DataFrame, keys: list[str], qno: str) -> DataFrame:
    """Questions with the answer of their number; without one it is null."""
    return questions.join(answers.withColumnRenamed("qno", qno), [*keys, qno], "left")


def answer_pages(blocks: DataFrame, keys: list[str], text: str = "text", least: int = 5) -> DataFrame:
    """(keys, n_answers, n_regions, is_answer_page) of pages: blocks with at least ``least`` answers are regions."""
    marked = blocks.withColumn("__b", F.monotonically_increasing_id()) if "block_id" not in blocks.columns else blocks.withColumn("__b", F.col("block_id"))
    found = grid_answers(marked, "__b", text).select("__b", "qno").unionByName(inline_answers(marked.where(F.col(text).isNotNull()), "__b", text).select("__b", "qno")).distinct()
    sizes = found.groupBy("__b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    in_regions = marked.select("__b", *keys).join(found.join(sizes, "__b"), "__b")
    counts = in_regions.groupBy(*keys).agg(F.countDistinct("qno").alias("n_answers"), F.countDistinct("__b").alias("n_regions"))
    titled = marked.groupBy(*keys).agg(F.max(F.coalesce(F.col(text).contains("정답 및 해설"), F.lit(False))).alias("titled"))
    out = titled.join(counts, keys, "left").fillna(0, ["n_answers", "n_regions"])
    return out.select(*keys, "n_answers", "n_regions", ((F.col("titled") & (F.col("n_answers") >= 20)) | (F.col("n_answers") >= 80)).alias("is_answer_page"))
