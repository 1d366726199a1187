"""Sinks: nested JSON, JSON lines, Markdown and text files, copy manifests. All are idempotent by path."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def json_lines(df: DataFrame, path: str) -> None:
    """One JSON object a line, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def final_json(finals: DataFrame, doc: str, order: str) -> DataFrame:
    """(doc, json): the nested record of each document."""
    q = F.struct("content", "question_source", "images", "hint_explanation", "options")
    parts = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.to_json(q, {"ignoreNullFields": "false"}).alias("j"))))
    return finals.groupBy(doc).agg(F.concat(F.lit('{"questions":['), F.array_join(F.transform(parts, lambda p: p["j"]), ","), F.lit("]}")).alias("json"))


def question_file(number: Column, kind: str, suffix: str = ".md") -> Column:
    return F.concat(F.lit(kind), T.padded(number, 3), F.lit(suffix))


def text_files(df: DataFrame, root: str, name: str, text: str) -> DataFrame:
    """Write one file a row below ``root``; gives (name, bytes). A file that exists is replaced as a whole.

    ``root`` may be on any filesystem Spark can write: each executor writes its own rows there through
    pyarrow, first under another name, so a task that runs twice leaves whole files.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        where, base = fs.FileSystem.from_uri(root if "://" in root else f"file://{os.path.abspath(root)}")
        for f in frames:
            sizes = []
            for n, t in zip(f[name], f[text]):
                target = f"{base}/{n}"
                where.create_dir(os.path.dirname(target), recursive=True)
                data = (t or "").encode()
                part = f"{target}.{os.getpid()}"
                with where.open_output_stream(part) as out:
                    out.write(data)
                where.move(part, target)
                sizes.append(len(data))
            yield pd.DataFrame({"name": f[name], "bytes": sizes})

    return df.select(name, text).mapInPandas(run, "name string, bytes bigint")


def copy_manifest(images: DataFrame, files: DataFrame) -> DataFrame:
    """(src, dst, exists): what to copy; a missing source still gets its (empty) place."""
    known = files.select(F.col("path").alias("src"), F.lit(True).alias("exists")).distinct()
    return images.join(known, "src", "left").select("src", "dst", F.coalesce("exists", F.lit(False)).alias("exists"))


def free_name(wanted: DataFrame, taken: DataFrame, name: str = "name") -> DataFrame:
    """(name, free): the name itself or the first of name_2, name_3, … not taken."""
    numbers = taken.select(F.regexp_extract("name", r"^(.*?)(?:_(\d+))?$", 1).alias("base"), F.coalesce(F.regexp_extract("name", r"_(\d+)$", 1).try_cast("int"), F.lit(1)).alias("n"))
    used = numbers.groupBy("base").agg(F.collect_set("n").alias("used"))
    out = wanted.join(used, F.col(name) == F.col("base"), "left")
    at = F.get(F.filter(F.sequence(F.lit(1), F.coalesce(F.size("used"), F.lit(0)) + 1), lambda i: ~F.coalesce(F.array_contains("used", i), F.lit(False))), F.lit(0))
    return out.select(name, F.when(at == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit("_"), at.cast("string"))).alias("free"))
