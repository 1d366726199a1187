"""The queries of the corpus problems and, where SQL can state them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import load
from . import charforms, leakage, neardup, pii, scannoise, subjects, tokenise


def _clean_stems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions whose stems are free of header and page-number lines."""
    questions = load(spark, sf_dir, "questions").select("question_id", "upload_id", "subject", "stem")
    return scannoise.without_margins(questions, "question_id", "stem", load(spark, sf_dir, "text_blocks"), load(spark, sf_dir, "exams"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The subject areas of every question."""
    found = subjects.subject_areas(_clean_stems(spark, sf_dir), load(spark, sf_dir, "subject_labels"), load(spark, sf_dir, "subject_areas"))
    return found.select("question_id", "area_code")


def p1_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Questions of each area, and what decided."""
    found = subjects.subject_areas(_clean_stems(spark, sf_dir), load(spark, sf_dir, "subject_labels"), load(spark, sf_dir, "subject_areas"))
    return found.groupBy("area_code", "by").agg(F.count(F.lit(1)).alias("n_questions"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose text holds a character or sequence that only looks like the plain one."""
    parts = []
    for table, key, text in (("text_lines", "line_id", "text"), ("choices", "choice_id", "text"), ("questions_final", "qf_id", "content")):
        rows = load(spark, sf_dir, table).select(key, text)
        formed = charforms.with_plain_form(rows, text, "plain", "kinds")
        parts.append(formed.where(charforms.has_difference(F.col("kinds"))).select(F.lit(table).alias("table_name"), F.col(key).alias("row_key")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).distinct()


def p2_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of the three tables in its consistent form, one row for each key."""
    parts = []
    for table, key, text in (("text_lines", "line_id", "text"), ("choices", "choice_id", "text"), ("questions_final", "qf_id", "content")):
        rows = load(spark, sf_dir, table).select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"), F.col(text).alias("text"))
        parts.append(charforms.with_plain_form(rows, "text", "text"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).dropDuplicates(["table_name", "row_key"])


def _scanned_rows(spark: SparkSession, sf_dir: str) -> scannoise.Repair:
    parts = []
    for table, key, text in (("questions", "question_id", "stem"), ("text_blocks", "block_id", "text"), ("questions_final", "qf_id", "content")):
        parts.append(load(spark, sf_dir, table).select(F.lit(table).alias("table_name"), F.col(key).alias("row_key"), F.col(text).alias("text")))
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return scannoise.Repair(rows, load(spark, sf_dir, "text_blocks"), load(spark, sf_dir, "exams"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of scan noise in each row."""
    return _scanned_rows(spark, sf_dir).found()


def p3_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The continuous text of each row."""
    return _scanned_rows(spark, sf_dir).repaired()


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of final questions whose similarity is at least 0.5."""
    return neardup.NearDuplicates(load(spark, sf_dir, "questions_final")).pairs()


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each final question with its class of equal texts, its group and its number of links."""
    return neardup.NearDuplicates(load(spark, sf_dir, "questions_final")).groups()


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document."""
    return tokenise.encode_corpus(load(spark, sf_dir, "documents"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the evaluation items they give away."""
    return leakage.leaked_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "eval_items")).select("doc_id", "item_id")


def p7_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the spans it quotes from evaluation items."""
    return leakage.remove_leaks(load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "eval_items"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of personal data with its type and place."""
    return pii.personal_data(load(spark, sf_dir, "documents")).select("doc_id", "pii_type", "start_pos")


def p8_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with placeholders in place of personal data."""
    return pii.redact(load(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"p1_found": p1_found, "p1_counts": p1_counts, "p2_found": p2_found, "p2_plain": p2_plain, "p3_found": p3_found, "p3_repaired": p3_repaired, "p4_found": p4_found, "p4_groups": p4_groups, "p6_ids": p6_ids, "p7_found": p7_found, "p7_clean": p7_clean, "p8_found": p8_found, "p8_redacted": p8_redacted}


# Written apart from the operator's own tables, so that a fault in those shows.
_SQL_INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufeff"
_SQL_SPACES = "\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000"
_SQL_LATIN, _SQL_GREEK = "A-Za-zÀ-ÖØ-öø-ɏ", "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρυικχ"
_SQL_OTHER = "АВЕЅІЈКМНОРСТУХаеорсухіјѕһԁԛԝօսոհց"
_SQL_AS_LATIN = "ABEZHIKMNOPTYXovpuikx" + "ABESIJKMHOPCTYXaeopcyxijshdqw" + "ounhg"
_SQL_WIDE = "".join(map(chr, range(0xFF01, 0xFF5F)))
_SQL_NARROW = "".join(map(chr, range(0x21, 0x7F))).replace("'", "''")


def _sql_different(x: str) -> str:
    """Whether a text of the exam tables differs from its plain form."""
    looks = _SQL_GREEK + _SQL_OTHER
    return (
        f"(regexp_matches({x}, '[{_SQL_INVISIBLE}{_SQL_SPACES}\uff01-\uffee]') OR nfc_normalize({x}) <> {x}"
        f" OR regexp_matches({x}, '[{_SQL_LATIN}][{looks}]|[{looks}][{_SQL_LATIN}]|[{_SQL_OTHER}]'))"
    )


def _sql_plain(x: str) -> str:
    """The plain form of a text of the exam tables: signs and widths first, then the runs of letters that mix alphabets."""
    looks = _SQL_GREEK + _SQL_OTHER
    bare = f"nfc_normalize(translate(regexp_replace(regexp_replace({x}, '[{_SQL_INVISIBLE}]', '', 'g'), '[{_SQL_SPACES}]', ' ', 'g'), '{_SQL_WIDE}', '{_SQL_NARROW}'))"
    run = f"CASE WHEN regexp_matches(r, '[{_SQL_LATIN}{_SQL_OTHER}]') THEN translate(r, '{looks}', '{_SQL_AS_LATIN}') ELSE r END"
    runs = f"regexp_extract_all({bare}, '[{_SQL_LATIN}{looks}]+|[^{_SQL_LATIN}{looks}]+')"
    return f"coalesce(array_to_string(list_transform({runs}, lambda r: {run}), ''), CASE WHEN {x} = '' THEN '' END)"


def _sql_folded(x: str) -> str:
    """Letters and digits of a text in one form and lower case."""
    bare = f"translate(translate(nfc_normalize(regexp_replace({x}, '[{_SQL_INVISIBLE}]', '', 'g')), '{_SQL_WIDE}', '{_SQL_NARROW}'), '{_SQL_GREEK}{_SQL_OTHER}', '{_SQL_AS_LATIN}')"
    return f"lower(regexp_replace({bare}, '[^\\p{{L}}\\p{{Nd}}]', '', 'g'))"


# Every two records that share a pair of words, compared in full.
_SQL_SETS = f"""WITH RECURSIVE f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qf_id) AS rn_ FROM questions_final) WHERE rn_ = 1),
t AS (SELECT qf_id, content AS x FROM f UNION ALL SELECT qf_id, o.content FROM (SELECT qf_id, unnest(options) AS o FROM f) WHERE o IS NOT NULL),
w AS (SELECT qf_id, regexp_extract_all(regexp_replace(lower({_sql_plain("x")}), '\\[image\\d+\\]', ' ', 'g'), '[\\p{{L}}\\p{{M}}\\p{{Nd}}]+') AS w FROM t WHERE x IS NOT NULL),
g AS (SELECT DISTINCT qf_id, w[i] || ' ' || w[i + 1] AS g FROM (SELECT qf_id, w, unnest(range(1, len(w))) AS i FROM w)),
n AS (SELECT qf_id, count(*) AS n, string_agg(g, '|' ORDER BY g) AS s FROM g GROUP BY qf_id),
p AS (SELECT x.qf_id AS a, y.qf_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.qf_id < y.qf_id GROUP BY ALL),
s AS (SELECT a, b FROM p JOIN n x ON x.qf_id = a JOIN n y ON y.qf_id = b WHERE 2 * c >= x.n + y.n - c)"""

ORACLE_SQL: dict[str, str] = {
    "p4_found": f"{_SQL_SETS} SELECT a AS qf_id_a, b AS qf_id_b FROM s",
    "p4_groups": f"""{_SQL_SETS}, k AS (SELECT qf_id, min(qf_id) OVER (PARTITION BY s) AS class_id FROM n), l AS (SELECT a, b FROM s JOIN k x ON x.qf_id = a AND x.class_id = a JOIN k y ON y.qf_id = b AND y.class_id = b),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l), r AS (SELECT a, a AS b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b), c AS (SELECT a, min(b) AS group_id FROM r GROUP BY a), d AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT f.qf_id, coalesce(class_id, f.qf_id) AS class_id, coalesce(group_id, class_id, f.qf_id) AS group_id, coalesce(n_links, 0) AS n_links FROM f LEFT JOIN k ON k.qf_id = f.qf_id LEFT JOIN c ON c.a = k.class_id LEFT JOIN d ON d.a = k.class_id""",
    "p2_found": " UNION ".join(
        f"SELECT '{table}' AS table_name, {key} AS row_key FROM {table} WHERE {_sql_different(text)}"
        for table, key, text in (("text_lines", "line_id", "text"), ("choices", "choice_id", "text"), ("questions_final", "qf_id", "content"))
    ),
    "p2_plain": " UNION ".join(
        f"SELECT '{table}' AS table_name, {key} AS row_key, {_sql_plain(text)} AS text FROM {table}"
        for table, key, text in (("text_lines", "line_id", "text"), ("choices", "choice_id", "text"), ("questions_final", "qf_id", "content"))
    ),
    "p7_found": f"""WITH i AS (SELECT item_id, {_sql_folded("item_text")} AS t FROM eval_items WHERE item_text IS NOT NULL),
d AS (SELECT doc_id, {_sql_folded("text")} AS t FROM documents WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, substr(t, a, 40) AS w FROM (SELECT item_id, t, unnest(range(1, length(t) - 38)) AS a FROM i)),
dw AS (SELECT DISTINCT doc_id, substr(t, a, 40) AS w FROM (SELECT doc_id, t, unnest(range(1, length(t) - 38)) AS a FROM d))
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (w)""",
}
