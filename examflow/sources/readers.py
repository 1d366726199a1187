"""Sources: element trees, image folders, pages of text, arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T


def require_folder(spark: SparkSession, path: str) -> str:
    """The path, if it is a folder on whatever filesystem it names; an error otherwise."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(where) or not files.getFileStatus(where).isDirectory():
        raise NotADirectoryError(path)
    return path


def element_trees(spark: SparkSession, path: str) -> DataFrame:
    """(path, raw): one JSON document a file."""
    return spark.read.option("wholetext", True).text(path).select(F.input_file_name().alias("path"), F.col("value").alias("raw"))


def image_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, content, size) of image files; only names are read unless content is used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.where(F.lower("path").rlike(r"\.(png|jpg|jpeg|webp)$")).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "content", F.col("length").alias("size"))


def question_image_groups(files: DataFrame, name: str = "name") -> DataFrame:
    """(question_number, files): names ``question_NNN_*`` grouped by number.

    Problem images come first, then choices, then others, by part number and name.
    """
    kind = F.when(F.col(name).contains("problem"), 0).when(F.col(name).contains("choices"), 1).otherwise(2)
    part = F.coalesce(F.regexp_extract(name, r"(?i)_part_(\d+)", 1).try_cast("int"), F.lit(0))
    number = F.regexp_extract(name, r"(?i)^question_(\d{3})_.+\.(?:png|jpg|jpeg|webp)$", 1)
    rows = files.select(number.alias("n"), F.struct(kind.alias("kind"), part.alias("part"), F.col(name).alias("name")).alias("f")).where("n <> ''")
    return rows.groupBy(F.col("n").cast("int").alias("question_number")).agg(F.transform(F.array_sort(F.collect_list("f")), lambda f: f["name"]).alias("files"))


def resume_from(groups: DataFrame, start: int | None) -> DataFrame:
    """Groups from a question number on, which must be one of them and at least 1."""
    if start is None:
        return groups
    if start < 1 or groups.where(F.col("question_number") == start).limit(1).count() == 0:
        raise ValueError(f"no question {start} to start from")
    return groups.where(F.col("question_number") >= start)


def lines_of_texts(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, seq, line) of multi-line texts."""
    return df.select(key, F.posexplode(T.lines_of(F.col(text))).alias("seq", "line"))


def arriving_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stream of line files as they arrive, for the operators of ``streaming``."""
    return spark.readStream.schema(schema).parquet(path)
