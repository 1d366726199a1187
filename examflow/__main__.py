"""python -m examflow PARSER INPUT OUTPUT [options]: parse tables, trees or payloads and write questions.

One call takes any number of papers: folders named by a pattern (``data/*``) are read in one job and
their rows stay apart by their own keys, so there is no loop over files and no process for each paper.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "json")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    from .plans import pipelines

    parser = argparse.ArgumentParser(prog="examflow")
    parser.add_argument("parser", choices=(*pipelines.PARSERS, "markdown", "finals"), help="what the input is and what is made of it")
    parser.add_argument("input", help="folder with text_lines and text_blocks, a folder of JSON trees, or a table of payloads")
    parser.add_argument("output")
    parser.add_argument("--format", choices=FORMATS, default="parquet", help="how the questions are written")
    parser.add_argument("--start", type=int, help="questions from this number on")
    parser.add_argument("--keep", action="store_true", help="keep what the output folder holds, and stop if it exists")
    parser.add_argument("--max-depth", type=int, default=12, help="levels of an element tree; deeper ones are an error")
    args = parser.parse_args(argv)
    if args.start is not None and args.start < 1:
        parser.error("--start must be at least 1")
    return args


def parsed(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """The questions (or texts) that the arguments ask for."""
    from .plans import pipelines
    from .sources import readers
    from .sources.writers import final_json

    if args.parser in ("trees", "markdown"):
        trees = readers.element_trees(spark, args.input).withColumnRenamed("path", "document")
        return (pipelines.to_markdown if args.parser == "markdown" else pipelines.parse_trees)(trees, "document", "raw", args.max_depth)
    if args.parser == "lines":
        if not any(c in args.input for c in "*?[{"):
            readers.require_folder(spark, args.input)
        lines = spark.read.parquet(f"{args.input}/text_lines.parquet").dropDuplicates(["line_id"])
        return pipelines.parse_exam(lines, spark.read.parquet(f"{args.input}/text_blocks.parquet").dropDuplicates(["block_id"]))
    if args.parser == "finals":
        finals = spark.read.parquet(args.input).dropDuplicates(["qf_id"])
        return final_json(finals, "upload_id", "qf_id")
    return pipelines.final_records(spark.read.parquet(args.input))


def run(spark: SparkSession, argv: list[str] | None = None) -> None:
    args = arguments(argv)
    out = parsed(spark, args)
    number = next((c for c in ("question_no", "question_number", "question_pos") if c in out.columns), None)
    if args.start is not None:
        if number is None:
            raise SystemExit("--start needs an output with question numbers")
        out = out.where(F.col(number) >= args.start)
    write = out.write.mode("errorifexists" if args.keep else "overwrite")
    (write.option("ignoreNullFields", "false") if args.format == "json" else write).format(args.format).save(args.output)


def main() -> None:
    run(SparkSession.builder.appName("examflow").getOrCreate())


if __name__ == "__main__":
    main()
