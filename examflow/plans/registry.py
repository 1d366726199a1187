"""Queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import load
from ..functions import text as T
from ..operators import nested, segment
from . import exam, pipelines, stages  # noqa: F401 - stages registers its queries with exam

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines to questions with stem, choices and confidence, one row for each question."""
    questions = segment.build_questions(exam._lines(spark, sf_dir))
    choices = T.first_of_each_number(T.split_choices(F.col("text")))
    stem = T.collapse(T.stem_before_choices(F.col("text")))
    out = questions.withColumn("choices", choices).withColumn("stem", stem)
    return out.select("upload_id", "question_number", "stem", "choices", "first_page", "last_page", T.confidence(F.col("stem"), F.size("choices"), F.lit(None).cast("string"), F.col("text")).alias("confidence"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The place of every image object nested in payloads and final questions."""
    return nested.image_places(load(spark, sf_dir, "final_payloads"), load(spark, sf_dir, "questions_final"))


def p5_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.FlatTables(load(spark, sf_dir, "final_payloads")).questions()


def p5_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.FlatTables(load(spark, sf_dir, "final_payloads")).options()


def p5_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.FlatTables(load(spark, sf_dir, "final_payloads")).sources()


def p5_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nested.FlatTables(load(spark, sf_dir, "final_payloads")).images()


def p5_final_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options nested in the final questions."""
    return nested.typed_options(load(spark, sf_dir, "questions_final"))


def p5_final_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the final questions."""
    return nested.typed_sources(load(spark, sf_dir, "questions_final"))


def exam_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole papers parsed from lines and blocks."""
    return pipelines.parse_exam(exam._lines(spark, sf_dir), exam._blocks(spark, sf_dir))


def tree_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Element trees as Markdown."""
    return pipelines.to_markdown(exam._trees(spark, sf_dir), "upload_id", "raw", 6)


def repaired_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page columns made safe by the question starts."""
    from ..operators import columns, layout

    blocks, lines = exam._blocks(spark, sf_dir), exam._lines(spark, sf_dir)
    pages = layout.columns_by_centres(blocks, ["upload_id", "page"])
    centres = columns.start_centres(lines.withColumnRenamed("page_number", "page"), ["upload_id", "page"])
    pages = pages.join(centres, ["upload_id", "page"], "left").withColumn("centres", F.coalesce("centres", F.array().cast("array<double>")))
    return columns.repaired_columns(pages.withColumn("separator", F.lit(None).cast("double"))).drop("centres", "separator")


QUERIES |= {"exam_results": exam_results, "tree_markdown": tree_markdown, "repaired_columns": repaired_columns}
QUERIES |= exam.QUERIES
ORACLE_SQL |= exam.ORACLE_SQL
QUERIES |= {"p5_found": p5_found, "p5_questions": p5_questions, "p5_options": p5_options, "p5_sources": p5_sources, "p5_images": p5_images, "p5_final_options": p5_final_options, "p5_final_sources": p5_final_sources}


def _sql_unwrap(x: str) -> str:
    return f"CASE WHEN json_type({x}) = 'VARCHAR' AND json_valid({x} ->> '$') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END"


def _sql_list(x: str) -> str:
    """An array or an object keyed by numbers as it is, any other object as the only element of an array."""
    return f"CASE WHEN json_type({x}) = 'OBJECT' AND len(list_filter(json_keys({x}), lambda k: NOT regexp_full_match(k, '[0-9]+'))) > 0 THEN json_array({x}) WHEN json_type({x}) IN ('ARRAY', 'OBJECT') THEN {x} END"


def _sql_field(x: str, *names: str) -> str:
    return "coalesce(" + ", ".join(f"CASE WHEN json_type({x} -> '$.{n}') <> 'NULL' THEN {x} -> '$.{n}' END" for n in names) + ")"


def _sql_place(kind: str) -> str:
    return f"CASE WHEN json_type({kind}) = 'ARRAY' THEN CAST(e.key AS INT) + 1 ELSE CAST(e.key AS INT) END"


#: Questions and options of the payloads: q (record_id, question_pos, v) and o (the same with option_pos).
_SQL_NESTED = f"""WITH p AS (SELECT record_id, CAST(payload AS JSON) AS j FROM {exam.once('final_payloads', 'record_id')} WHERE json_valid(payload)),
s AS (SELECT record_id, 0 AS part, {_sql_unwrap("j -> '$.questions'")} AS l FROM p UNION ALL SELECT record_id, 0, {_sql_unwrap("j -> '$.result.questions'")} FROM p
 UNION ALL SELECT record_id, CAST(e.key AS INT), {_sql_unwrap("e.value -> '$.questions'")} FROM p, json_each(p.j, '$.sections') e),
q0 AS (SELECT record_id, part, CAST(e.key AS INT) AS pos_, e.value AS v FROM s, json_each(s.l) e WHERE json_type(l) = 'ARRAY'),
q AS (SELECT record_id, row_number() OVER (PARTITION BY record_id ORDER BY part, pos_) AS question_pos, v FROM q0),
o0 AS (SELECT record_id, question_pos, {_sql_unwrap('x')} AS x FROM (SELECT *, {_sql_field('v', 'options', 'choices')} AS x FROM q)),
o1 AS (SELECT record_id, question_pos, {_sql_list('x')} AS x FROM o0),
o AS (SELECT record_id, question_pos, {_sql_place('x')} AS option_pos, e.value AS v FROM o1, json_each(o1.x) e WHERE x IS NOT NULL),"""

ORACLE_SQL["p5_found"] = f"""{_SQL_NESTED}
l0 AS (SELECT record_id, question_pos, 0 AS option_pos, {_sql_field('v', 'images', 'assets')} AS x FROM q UNION ALL SELECT record_id, question_pos, option_pos, {_sql_field('v', 'images', 'assets')} FROM o WHERE json_type(v) = 'OBJECT' UNION ALL SELECT record_id, question_pos, option_pos, v -> '$.image' FROM o WHERE json_type(v) = 'OBJECT'),
l1 AS (SELECT record_id, question_pos, option_pos, {_sql_unwrap('x')} AS x FROM l0 WHERE x IS NOT NULL), l AS (SELECT record_id, question_pos, option_pos, {_sql_list('x')} AS x FROM l1),
i AS (SELECT record_id, question_pos, option_pos, {_sql_place('x')} AS image_pos, {_sql_unwrap('e.value')} AS v FROM l, json_each(l.x) e WHERE x IS NOT NULL),
f AS (SELECT * FROM {exam.once('questions_final', 'qf_id')}), fo AS (SELECT qf_id, generate_subscripts(options, 1) AS option_pos, unnest(options) AS o FROM f),
fi AS (SELECT qf_id, 0 AS option_pos, generate_subscripts(images, 1) AS image_pos, unnest(images) AS v FROM f UNION ALL SELECT qf_id, option_pos, generate_subscripts(o.images, 1), unnest(o.images) FROM fo WHERE o IS NOT NULL)
SELECT 'final_payloads' AS table_name, record_id AS record_key, CAST(question_pos AS INT) AS question_pos, CAST(option_pos AS INT) AS option_pos, CAST(image_pos AS INT) AS image_pos FROM i WHERE json_type(v) = 'OBJECT'
UNION ALL SELECT 'questions_final', qf_id, 1, CAST(option_pos AS INT), CAST(image_pos AS INT) FROM fi WHERE v IS NOT NULL"""


_SQL_TEXT = "coalesce(v ->> '$.content', v ->> '$.question_text', v ->> '$.stem', v ->> '$.text')"
_SQL_WITH = _SQL_NESTED.rstrip(",")
ORACLE_SQL["p5_questions"] = f"""{_SQL_WITH}
SELECT record_id || '/' || question_pos AS question_key, record_id AS record_key, CAST(question_pos AS INT) AS question_pos, {_SQL_TEXT} AS content, v ->> '$.hint_explanation' AS hint_explanation FROM q"""
ORACLE_SQL["p5_options"] = f"""{_SQL_WITH},
n AS (SELECT *, trim(coalesce(v ->> '$.order', v ->> '$.number', v ->> '$.option_number', v ->> '$.label')) AS t FROM o WHERE json_type(v) <> 'NULL')
SELECT record_id || '/' || question_pos || '/' || option_pos AS option_key, record_id || '/' || question_pos AS question_key, record_id AS record_key, CAST(question_pos AS INT) AS question_pos, CAST(option_pos AS INT) AS option_pos,
CASE WHEN t = '' THEN NULL WHEN instr('①②③④⑤⑥⑦⑧⑨⑩', t) > 0 THEN CAST(instr('①②③④⑤⑥⑦⑧⑨⑩', t) AS INT) ELSE try_cast(t AS INT) END AS number, {_SQL_TEXT} AS content,
try_cast(v ->> '$.is_correct' AS BOOLEAN) AS is_correct, v ->> '$.option_explanation' AS option_explanation FROM n"""
ORACLE_SQL["p5_sources"] = f"""{_SQL_WITH},
s1 AS (SELECT record_id, question_pos, {_sql_unwrap("v -> '$.question_source'")} AS s FROM q)
SELECT record_id || '/' || question_pos AS question_key, record_id AS record_key, CAST(question_pos AS INT) AS question_pos, CASE WHEN json_type(s) = 'VARCHAR' THEN s ->> '$' END AS source_text, s ->> '$.exam.exam_id' AS exam_id,
s ->> '$.exam.title' AS title, try_cast(s ->> '$.question_no' AS INT) AS question_no, s ->> '$.subject.name' AS subject FROM s1 WHERE s IS NOT NULL AND json_type(s) <> 'NULL'"""
ORACLE_SQL["p5_final_options"] = f"""SELECT qf_id AS record_key, CAST(option_pos AS INT) AS option_pos, o.opt_order AS number, o.content, o.is_correct, o.option_explanation
FROM (SELECT qf_id, generate_subscripts(options, 1) AS option_pos, unnest(options) AS o FROM {exam.once('questions_final', 'qf_id')}) WHERE o IS NOT NULL"""
ORACLE_SQL["p5_final_sources"] = f"""SELECT qf_id AS record_key, question_source AS source_text FROM {exam.once('questions_final', 'qf_id')} WHERE question_source <> ''"""
_SQL_IMAGES = ORACLE_SQL["p5_found"][: ORACLE_SQL["p5_found"].index("f AS (SELECT * FROM (SELECT *")].rstrip().rstrip(",")
ORACLE_SQL["p5_images"] = f"""{_SQL_IMAGES}
SELECT record_id AS record_key, record_id || '/' || question_pos || CASE WHEN option_pos = 0 THEN '' ELSE '/' || option_pos END AS parent_key, CAST(question_pos AS INT) AS question_pos, CAST(option_pos AS INT) AS option_pos,
CAST(image_pos AS INT) AS image_pos, v ->> '$.image_id' AS image_id, v ->> '$.image_name' AS image_name, v ->> '$.image_caption' AS image_caption FROM i WHERE json_type(v) = 'OBJECT'"""
