"""Queries over the exam tables and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..common import first_delivery, load
from ..functions import text as T
from ..operators import answers, canonical, layout, nodes, passages, segment

QUERIES = {}
ORACLE_SQL = {}

WS = T.WS


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return register


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}+', ' ', 'g'))"


def trim_u(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def once(table: str, key: str) -> str:
    return f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key}) AS rn_ FROM {table}) WHERE rn_ = 1)"


def label(n: str) -> str:
    return f"CASE WHEN {n} BETWEEN 1 AND 10 THEN substr('{T.CIRCLED}', CAST({n} AS INT), 1) ELSE CAST({n} AS VARCHAR) END"


def circled(x: str) -> str:
    return f"(CASE WHEN length({x}) = 1 THEN instr('{T.CIRCLED}', {x}) ELSE 0 END)"


def lines_of(x: str) -> str:
    return f"string_split(replace(replace({x}, chr(13) || chr(10), chr(10)), chr(13), chr(10)), chr(10))"


def clean_lines(x: str) -> str:
    return f"list_filter(list_transform({lines_of(x)}, lambda v: {collapse('v')}), lambda v: v <> '')"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return first_delivery(load(spark, d, "text_lines").select("line_id", "upload_id", "seq", "page_number", "column_index", "text", "bbox"), "line_id", "upload_id")


def _blocks(spark: SparkSession, d: str, within: str | None = None) -> DataFrame:
    return first_delivery(load(spark, d, "text_blocks").select("block_id", "upload_id", "page", "page_height", "bbox", "text"), "block_id", within)


def _questions(spark: SparkSession, d: str, within: str | None = None) -> DataFrame:
    return first_delivery(load(spark, d, "questions").select("question_id", "upload_id", "exam_id", "question_no", "subject", "stem", "answer", "assets"), "question_id", within)


def _finals(spark: SparkSession, d: str, *columns: str, within: str | None = None) -> DataFrame:
    return first_delivery(load(spark, d, "questions_final").select("qf_id", "upload_id", *columns), "qf_id", within)


SKIP = (
    "(t = '' OR t IN ('1 회', '정답 및 해설', '저작권 안내') OR regexp_matches(t, '^-\\s*\\d+\\s*-$') OR regexp_matches(t, '^제\\s*\\d*\\s*과목')"
    + "".join(f" OR starts_with(t, '{s}')" for s in T.SKIP_STARTS)
    + "".join(f" OR contains(t, '{s}')" for s in T.SKIP_CONTAINS)
    + ")"
)
ISLANDS = f"""
WITH l AS (SELECT upload_id, seq, page_number, bbox, {collapse('text')} AS t FROM {once('text_lines', 'line_id')} WHERE text IS NOT NULL),
i AS (SELECT *, sum(CASE WHEN regexp_matches(t, '^\\d{{1,3}}\\.') THEN 1 ELSE 0 END) OVER (PARTITION BY upload_id ORDER BY seq) AS island FROM l WHERE NOT {SKIP}),
q AS (SELECT upload_id, CAST(island AS BIGINT) AS island, string_agg(t, ' ' ORDER BY seq) AS t, CAST(count(*) AS INT) AS n_lines, min(page_number) AS first_page, max(page_number) AS last_page,
 round(min(bbox.x0), 3) AS x0, round(min(bbox.y0), 3) AS y0, round(max(bbox.x1), 3) AS x1, round(max(bbox.y1), 3) AS y1 FROM i WHERE island > 0 GROUP BY upload_id, island),
b AS (SELECT upload_id, island, CAST(regexp_extract(t, '^(\\d{{1,3}})\\.', 1) AS INT) AS question_number, n_lines, regexp_replace(t, '^\\d{{1,3}}\\.\\s*', '') AS text, first_page, last_page, x0, y0, x1, y1 FROM q)
"""


@query(f"SELECT doc_id, sha1({collapse("coalesce(text, '')")}) AS text_hash, CAST(len({clean_lines("coalesce(text, '')")}) AS INT) AS n_lines FROM documents")
def text_hash(spark: SparkSession, d: str) -> DataFrame:
    """Collapsed text, its SHA-1, clean lines."""
    return load(spark, d, "documents").select("doc_id", T.content_hash(F.col("text")).alias("text_hash"), F.size(T.clean_lines(F.coalesce("text", F.lit("")))).alias("n_lines"))


@query(ISLANDS + "SELECT * FROM b")
def question_islands(spark: SparkSession, d: str) -> DataFrame:
    """Lines to questions."""
    return segment.build_questions(_lines(spark, d))


CHOICES = ISLANDS + f"""
, e AS (SELECT upload_id, island, unnest(regexp_extract_all(text, '[①-④][^①-④]*')) AS p, generate_subscripts(regexp_extract_all(text, '[①-④][^①-④]*'), 1) AS choice_pos FROM b)
, c AS (SELECT upload_id, island, CAST(choice_pos AS INT) AS choice_pos, CAST({circled('substr(p, 1, 1)')} AS INT) AS choice_number, {trim_u('substr(p, 2)')} AS choice_text FROM e)
"""


@query(CHOICES + "SELECT * FROM c")
def question_choices(spark: SparkSession, d: str) -> DataFrame:
    """Choices of questions, repeated numbers kept."""
    return segment.explode_choices(segment.build_questions(_lines(spark, d)).select("upload_id", "island", "text")).drop("text")


@query(CHOICES + "SELECT upload_id, island, choice_number, arg_min(choice_text, choice_pos) AS choice_text, CAST(count(*) AS BIGINT) AS n_same FROM c GROUP BY upload_id, island, choice_number")
def choices_first_of_number(spark: SparkSession, d: str) -> DataFrame:
    """Of choices with one number the first counts."""
    return question_choices(spark, d).groupBy("upload_id", "island", "choice_number").agg(F.min_by("choice_text", "choice_pos").alias("choice_text"), F.count(F.lit(1)).alias("n_same"))


@query(ISLANDS + f"""SELECT upload_id, island, {collapse("regexp_extract(text, '^([^①-⑩]*)', 1)")} AS stem, CAST(len(regexp_extract_all(text, '[①-⑩]')) AS INT) AS n_choices,
 list_transform(regexp_extract_all(text, '[①-⑩]'), lambda m: CAST({circled('m')} AS INT)) AS numbers FROM b""")
def stem_and_choices(spark: SparkSession, d: str) -> DataFrame:
    """Stem before the first mark, marks in order."""
    q = segment.build_questions(_lines(spark, d))
    c = T.split_choices(F.col("text"))
    return q.select("upload_id", "island", T.collapse(T.stem_before_choices(F.col("text"))).alias("stem"), F.size(c).alias("n_choices"), F.transform(c, lambda x: x.number).alias("numbers"))


@query(f"""
WITH t AS (SELECT question_id, {clean_lines('stem')} AS l FROM {once('questions', 'question_id')} WHERE stem IS NOT NULL),
s AS (SELECT question_id, len(l) >= 2 AND regexp_full_match(l[2], '[A-Za-z0-9][A-Za-z0-9\\-+/&() ]{{0,12}}') AND ends_with(l[1], '중') AS swap, l FROM t)
SELECT question_id, array_to_string(CASE WHEN swap THEN list_concat([l[2] || ' ' || l[1]], l[3:]) ELSE l END, chr(10)) AS stem FROM s""")
def normalized_stems(spark: SparkSession, d: str) -> DataFrame:
    """Stems with clean lines."""
    return _questions(spark, d).where("stem is not null").select("question_id", T.normalize_stem(F.col("stem")).alias("stem"))


GRID = f"""
WITH h AS (SELECT block_id, {clean_lines("coalesce(text, '')")} AS l FROM {once('text_blocks', 'block_id')}),
r AS (SELECT block_id, l, generate_subscripts(l, 1) AS pos_, unnest(l) AS line FROM h),
n AS (SELECT block_id, pos_, string_split(line, ' ') AS q, string_split(l[pos_ + 1], ' ') AS a, line FROM r WHERE pos_ < len(l)),
g AS (SELECT block_id, pos_ * 1000 AS base, q, a FROM n WHERE regexp_matches(line, '^(?:\\d{{1,3}}\\s+){{3,}}\\d{{1,3}}$') AND len(q) = len(a) AND len(list_filter(a, lambda v: NOT regexp_full_match(v, '(?:[①②③④⑤]|\\d(?:\\s*,\\s*\\d+)*|모두답)'))) = 0),
grid AS (SELECT block_id, base + generate_subscripts(q, 1) AS o, CAST(unnest(q) AS INT) AS qno, unnest(a) AS a, 0 AS kind FROM g),
tk AS (SELECT block_id, string_split(array_to_string(l, ' '), ' ') AS t FROM h WHERE len(l) > 0),
tp AS (SELECT block_id, t, unnest(range(1, len(t), 2)) AS o FROM tk),
pr AS (SELECT block_id, o, t[o] AS q, t[o + 1] AS a FROM tp),
pairs AS (SELECT block_id, o, CAST(q AS INT) AS qno, a, 1 AS kind FROM pr WHERE regexp_full_match(q, '[0-9]{{1,3}}') AND regexp_full_match(a, '(?:[①②③④⑤]|\\d(?:\\s*,\\s*\\d+)*|모두답)')),
u AS (SELECT * FROM grid WHERE qno BETWEEN 1 AND 100 UNION ALL SELECT * FROM pairs WHERE qno BETWEEN 1 AND 100),
w AS (SELECT *, min(kind) OVER (PARTITION BY block_id) AS best FROM u),
z AS (SELECT block_id, qno, arg_max(a, o) AS a FROM w WHERE kind = best GROUP BY block_id, qno),
ans AS (SELECT block_id, qno, CASE WHEN regexp_full_match(a, '\\d(?:\\s*,\\s*\\d+)*') THEN array_to_string(list_transform(string_split(a, ','), lambda v: {label('TRY_CAST(v AS INT)')}), ',') ELSE a END AS answer FROM z)
"""


@query(GRID + "SELECT * FROM ans")
def answer_grid(spark: SparkSession, d: str) -> DataFrame:
    """Answers of grids in blocks."""
    return answers.grid_answers(_blocks(spark, d), "block_id", "text")


@query(GRID + """, c AS (SELECT b.upload_id, b.page, count(DISTINCT a.qno) AS n_answers, count(DISTINCT a.block_id) AS n_regions
 FROM (SELECT block_id, qno, count(*) OVER (PARTITION BY block_id) AS n FROM ans) a JOIN (SELECT DISTINCT block_id, upload_id, page FROM text_blocks) b USING (block_id) WHERE a.n >= 5 GROUP BY ALL),
p AS (SELECT upload_id, page, bool_or(coalesce(contains(text, '정답 및 해설'), false)) AS titled FROM text_blocks GROUP BY ALL)
SELECT p.upload_id, p.page, coalesce(n_answers, 0) AS n_answers, coalesce(n_regions, 0) AS n_regions, (titled AND coalesce(n_answers, 0) >= 20) OR coalesce(n_answers, 0) >= 80 AS is_answer_page
FROM p LEFT JOIN c USING (upload_id, page)""")
def answer_pages(spark: SparkSession, d: str) -> DataFrame:
    """Answer regions and answer pages."""
    return answers.answer_pages(_blocks(spark, d), ["upload_id", "page"])


ANSWERED = f"""
WITH q AS (SELECT * FROM {once('questions', 'question_id')} WHERE question_no BETWEEN 1 AND 100 AND regexp_full_match(answer, '[①②③④⑤]|모두답|[1-5](?:\\s*,\\s*[1-5])*'))
"""


@query(ANSWERED + f"""SELECT upload_id, question_no AS qno, arg_max(CASE WHEN regexp_full_match(answer, '\\d(?:\\s*,\\s*\\d+)*') THEN array_to_string(list_transform(string_split(answer, ','), lambda v: {label("TRY_CAST(trim(v) AS INT)")}), ',') ELSE answer END, question_id) AS answer
FROM q GROUP BY ALL""")
def inline_answers(spark: SparkSession, d: str) -> DataFrame:
    """E5: answers printed as one text an upload, read back."""
    q = _questions(spark, d, "upload_id")
    parts = F.array_sort(F.collect_list(F.struct("question_id", F.concat(F.col("question_no").cast("string"), F.lit("."), F.col("answer")).alias("t"))))
    texts = q.groupBy("upload_id").agg(F.array_join(F.transform(parts, lambda p: p.t), "  ").alias("text"))
    return answers.inline_answers(texts, "upload_id", "text")


@query(f"""
WITH c AS (SELECT question_id, CAST(count(*) AS INT) AS n FROM {once('choices', 'choice_id')} GROUP BY question_id)
SELECT q.question_id, coalesce(c.n, 0) AS n_choices, CAST(greatest(0, 1.00 - (CASE WHEN coalesce(c.n, 0) < 4 THEN 0.20 ELSE 0 END) - (CASE WHEN length(coalesce(stem, '')) < 15 THEN 0.15 ELSE 0 END)
 - (CASE WHEN answer IS NULL OR answer = '' THEN 0.15 ELSE 0 END) - (CASE WHEN length(coalesce(stem, '')) < 30 THEN 0.10 ELSE 0 END)) AS DOUBLE) AS confidence,
 list_sort(list_distinct(list_filter(list_transform(string_split(replace(coalesce(answer, ''), ' ', ''), ','), lambda p: CASE WHEN regexp_full_match(p, '\\d{{1,9}}') THEN CAST(TRY_CAST(p AS INT) AS BIGINT) WHEN {circled('p')} > 0 THEN {circled('p')} END), lambda n: n IS NOT NULL))) AS correct_orders
FROM {once('questions', 'question_id')} q LEFT JOIN c USING (question_id)""")
def question_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Score of a parsed question; option numbers its answer names."""
    n = first_delivery(load(spark, d, "choices").select("choice_id", "question_id"), "choice_id").groupBy("question_id").agg(F.count(F.lit(1)).cast("int").alias("n_choices"))
    q = _questions(spark, d).join(n, "question_id", "left").withColumn("n_choices", F.coalesce("n_choices", F.lit(0)))
    stem = F.coalesce("stem", F.lit(""))
    return q.select("question_id", "n_choices", T.confidence(stem, F.col("n_choices"), F.col("answer"), stem).alias("confidence"), F.array_sort(T.correct_orders(F.col("answer"))).cast("array<bigint>").alias("correct_orders"))


def subject_sql(x: str) -> str:
    t = f"array_to_string({clean_lines(x)}, chr(10))"
    found = "coalesce(" + ", ".join(f"nullif(regexp_extract({t}, '{p}', 1), '')" for p in T.SUBJECT_PATTERNS) + ")"
    return f"nullif({collapse(f"regexp_replace({found}, '[0-9]+|[:：.]', ' ', 'g')")}, '')"


@query(f"SELECT question_id, {subject_sql('subject')} AS detected FROM {once('questions', 'question_id')} WHERE subject IS NOT NULL")
def detected_subjects(spark: SparkSession, d: str) -> DataFrame:
    """Subject of a printed heading."""
    return _questions(spark, d).where("subject is not null").select("question_id", T.detect_subject(F.col("subject")).alias("detected"))


@query(f"""WITH t AS (SELECT line_id, upload_id, seq, {subject_sql('text')} AS s FROM {once('text_lines', 'line_id')})
SELECT line_id, last_value(s IGNORE NULLS) OVER (PARTITION BY upload_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS subject FROM t""")
def subject_of_lines(spark: SparkSession, d: str) -> DataFrame:
    """Subject carried to the lines below its heading."""
    return segment.subject_of_lines(_lines(spark, d)).select("line_id", "subject")


NOISE = "(t = '' OR regexp_matches(t, '^\\s*-\\s*\\d+\\s*-\\s*$') OR regexp_matches(t, '^\\s*\\d+\\s*회\\s*$') OR t IN ('저작권 안내', '정답 및 해설', '기출문제', '-') OR (contains(t, '기출문제') AND contains(t, '정답 및 해설'))" + "".join(f" OR starts_with(t, '{s}')" for s in T.NOISE_STARTS) + ")"


@query(f"""WITH e AS (SELECT block_id, unnest({lines_of('text')}) AS x FROM {once('text_blocks', 'block_id')} WHERE text IS NOT NULL), n AS (SELECT block_id, {collapse('x')} AS t FROM e)
SELECT block_id, count(*) AS n_lines, count(*) FILTER (WHERE {NOISE}) AS n_noise, count(*) FILTER (WHERE {SKIP}) AS n_skip FROM n GROUP BY block_id""")
def noise_lines(spark: SparkSession, d: str) -> DataFrame:
    """Noise lines of blocks."""
    rows = _blocks(spark, d).where("text is not null").select("block_id", F.explode(T.lines_of(F.col("text"))).alias("x"))
    return rows.groupBy("block_id").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(T.is_noise_line(F.col("x"))).alias("n_noise"), F.count_if(T.is_skip_line(F.col("x"))).alias("n_skip"))


@query(f"""WITH t AS (SELECT upload_id, array_to_string({clean_lines('text')}, chr(10)) AS margin_text, bbox.y1 <= page_height * 0.12 AS t, bbox.y0 >= page_height * (1 - 0.06) AS b FROM {once('text_blocks', 'block_id')})
SELECT upload_id, margin_text, count(*) FILTER (WHERE t) AS n_top, count(*) FILTER (WHERE b) AS n_bottom FROM t WHERE margin_text <> '' AND (t OR b) GROUP BY ALL""")
def margin_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts of page margins."""
    return layout.margin_texts(_blocks(spark, d, "upload_id"), "upload_id")


@query(f"""WITH b AS (SELECT upload_id, page, bbox.x0 AS x0, bbox.x1 AS x1, lead(bbox.x0) OVER (PARTITION BY upload_id, page ORDER BY bbox.x0) AS nx FROM {once('text_blocks', 'block_id')} WHERE bbox IS NOT NULL),
g AS (SELECT upload_id, page, arg_max({{'gap': nx - x0, 'mid': (x0 + nx) / 2}}, {{'a': nx - x0, 'b': -x0}}) FILTER (WHERE nx IS NOT NULL) AS g, count(*) AS n, list((x0 + x1) / 2) AS c FROM b GROUP BY ALL),
k AS (SELECT *, len(list_filter(c, lambda v: v < g.mid)) AS l FROM g)
SELECT upload_id, page, CASE WHEN two THEN 2 ELSE 1 END AS n_columns, CASE WHEN two THEN g.mid END AS separator FROM (SELECT *, coalesce(n >= 4 AND g.gap >= 595 * 0.15 AND l >= 2 AND n - l >= 2, false) AS two FROM k)""")
def columns_by_starts(spark: SparkSession, d: str) -> DataFrame:
    """Columns from the widest gap between left edges."""
    return layout.columns_by_starts(_blocks(spark, d, "upload_id"), ["upload_id", "page"])


@query(f"""WITH b AS (SELECT upload_id, page, bbox.x0 AS x0, bbox.x1 AS x1, (bbox.x0 + bbox.x1) / 2 AS c FROM {once('text_blocks', 'block_id')} WHERE bbox.x1 > bbox.x0),
n AS (SELECT *, lead(c) OVER (PARTITION BY upload_id, page ORDER BY c) AS nx FROM b),
m AS (SELECT upload_id, page, arg_max({{'gap': nx - c, 'mid': (c + nx) / 2}}, {{'a': nx - c, 'b': -c}}) FILTER (WHERE nx IS NOT NULL) AS g, count(*) AS n FROM n GROUP BY ALL),
a AS (SELECT upload_id, page, any_value(g) AS g, any_value(m.n) AS n, count(*) FILTER (WHERE c <= g.mid) AS l, min(x0) FILTER (WHERE c <= g.mid) AS l0, max(x1) FILTER (WHERE c <= g.mid) AS l1, min(x0) FILTER (WHERE NOT c <= g.mid) AS r0, max(x1) FILTER (WHERE NOT c <= g.mid) AS r1 FROM b JOIN m USING (upload_id, page) GROUP BY ALL),
t AS (SELECT upload_id, page, coalesce(n >= 4 AND g.gap >= 595 * 0.18 AND l >= 2 AND n - l >= 2, false) AS two, greatest(0, l0 - 4.0) AS l0, least(595.0, l1 + 4.0) AS l1, greatest(0, r0 - 4.0) AS r0, least(595.0, r1 + 4.0) AS r1 FROM a),
s AS (SELECT upload_id, page, CASE WHEN two THEN 2 ELSE 1 END AS n_columns, CASE WHEN two THEN l0 ELSE 0 END AS l0, CASE WHEN NOT two THEN 595.0 WHEN l1 >= r0 THEN greatest(l0, (l1 + r0) / 2 - 2) ELSE l1 END AS l1,
 CASE WHEN two THEN CASE WHEN l1 >= r0 THEN least(r1, (l1 + r0) / 2 + 2) ELSE r0 END END AS r0, CASE WHEN two THEN r1 END AS r1 FROM t),
k AS (SELECT upload_id, count(*) AS n_two, median(l0) AS a, median(l1) AS b, median(r0) AS c, median(r1) AS d FROM s WHERE n_columns = 2 GROUP BY upload_id HAVING count(*) >= 2)
SELECT s.upload_id, page, CASE WHEN u THEN 2 ELSE n_columns END AS n_columns, CASE WHEN u THEN a ELSE l0 END AS l0, CASE WHEN u THEN b ELSE l1 END AS l1, CASE WHEN u THEN c ELSE r0 END AS r0, CASE WHEN u THEN d ELSE r1 END AS r1, u AS from_template
FROM (SELECT s.*, n_columns = 1 AND n_two IS NOT NULL AS u, a, b, c, d FROM s LEFT JOIN k USING (upload_id)) s""")
def page_columns(spark: SparkSession, d: str) -> DataFrame:
    """Padded columns, with the document's template for pages without two."""
    return layout.apply_column_template(layout.columns_by_centres(_blocks(spark, d, "upload_id"), ["upload_id", "page"]), "upload_id")


@query(f"""WITH s AS (SELECT upload_id, page_number AS page, column_index AS col, bbox.y0 AS y0, CAST(regexp_extract({collapse('text')}, '^(\\d{{1,3}})\\.', 1) AS INT) AS qno FROM {once('text_lines', 'line_id')} WHERE bbox IS NOT NULL AND regexp_matches({collapse('text')}, '^\\d{{1,3}}\\.')),
n AS (SELECT *, row_number() OVER w AS index, lead(page) OVER w AS p1, lead(col) OVER w AS c1, lead(y0) OVER w AS to_y FROM s WINDOW w AS (PARTITION BY upload_id ORDER BY page, col, y0)),
c AS (SELECT DISTINCT upload_id, page_number AS page, column_index AS col FROM text_lines)
SELECT * FROM (SELECT n.upload_id, n.index, n.qno, c.page, c.col, CASE WHEN c.page = n.page AND c.col = n.col THEN n.y0 ELSE 0.0 END AS start_y, CASE WHEN c.page = p1 AND c.col = c1 THEN to_y ELSE 842.0 END AS end_y
FROM n JOIN c ON n.upload_id = c.upload_id AND (c.page > n.page OR (c.page = n.page AND c.col >= n.col)) AND (p1 IS NULL OR c.page < p1 OR (c.page = p1 AND c.col <= c1))) WHERE end_y > start_y + 4.0""")
def question_spans(spark: SparkSession, d: str) -> DataFrame:
    """Page columns each question covers."""
    lines = _lines(spark, d)
    t = T.collapse(F.col("text"))
    starts = lines.where(F.col("bbox").isNotNull() & t.rlike(r"^\d{1,3}\.")).select("upload_id", F.col("page_number").alias("page"), F.col("column_index").alias("col"), F.col("bbox.y0").alias("y0"), F.regexp_extract(t, r"^(\d{1,3})\.", 1).cast("int").alias("qno"))
    cells = lines.select("upload_id", F.col("page_number").alias("page"), F.col("column_index").alias("col"), F.lit(842.0).alias("page_height")).distinct()
    return segment.question_spans(starts, cells, "upload_id")


@query(f"""WITH b AS (SELECT upload_id, page, block_id, bbox AS k FROM {once('text_blocks', 'block_id')} WHERE bbox IS NOT NULL)
SELECT b.block_id AS a_id, c.block_id AS b_id, greatest(0, least(b.k.x1, c.k.x1) - greatest(b.k.x0, c.k.x0)) * greatest(0, least(b.k.y1, c.k.y1) - greatest(b.k.y0, c.k.y0)) AS shared FROM b JOIN b c ON b.upload_id = c.upload_id AND b.page = c.page
WHERE b.block_id < c.block_id AND b.k.x1 > c.k.x0 AND b.k.x0 < c.k.x1 AND b.k.y1 > c.k.y0 AND b.k.y0 < c.k.y1""")
def overlapping_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Rectangles of a page that overlap."""
    b = _blocks(spark, d, "upload_id").where("bbox is not null")
    x, y = b.select("upload_id", "page", F.col("block_id").alias("a_id"), F.col("bbox").alias("p")), b.select("upload_id", "page", F.col("block_id").alias("b_id"), F.col("bbox").alias("q"))
    met = x.join(y, ["upload_id", "page"]).where((F.col("a_id") < F.col("b_id")) & layout.overlaps(F.col("p"), F.col("q")))
    return met.select("a_id", "b_id", layout.shared_area(F.col("p"), F.col("q")).alias("shared"))


@query(f"""WITH l AS (SELECT * FROM {once('text_lines', 'line_id')} WHERE bbox IS NOT NULL AND TRY_CAST(nullif(regexp_extract(text, '^\\s*(\\d{{1,3}})\\s*[.)]', 1), '') AS INT) BETWEEN 1 AND 100)
SELECT upload_id, page_number, column_index, median(bbox.x0) AS anchor_x FROM l GROUP BY ALL""")
def anchor_medians(spark: SparkSession, d: str) -> DataFrame:
    """Median left edge of numbered lines."""
    lines = _lines(spark, d).where(F.col("text").rlike(r"^\s*\d{1,3}\s*[.)]"))
    return layout.anchor_medians(lines, ["upload_id", "page_number", "column_index"])


GEO = "round({0}, 6)"


@query(f"""WITH b AS (SELECT block_id, bbox AS k, coalesce(page_height, 841.9) AS h FROM {once('text_blocks', 'block_id')} WHERE bbox IS NOT NULL),
r AS (SELECT block_id, h, k, greatest(greatest(0, k.y0 - 6), k.y0 + 1) AS y0, least(h, k.y1 - 2) AS y1a FROM b),
s AS (SELECT *, CASE WHEN k.y1 >= h - 1 THEN least(y1a, greatest(y0 + 5, h)) ELSE y1a END AS y1 FROM r)
SELECT block_id, y0 AS clip_y0, y1 AS clip_y1, greatest(0, k.x1 - k.x0) * greatest(0, k.y1 - k.y0) AS area, greatest(0, k.x0 - 8) AS pad_x0, least(595.0, k.x1 + 8) AS pad_x1, h - k.y1 AS flip_y0,
 CASE WHEN (k.x0 + k.x1) / 2 < 297.5 THEN 0 ELSE 1 END AS page_column, CASE WHEN least(y1, k.y1 + 3) <= greatest(y0, k.y0 - 3) + 4 THEN y0 ELSE greatest(y0, k.y0 - 3) END AS fine_y0,
 CASE WHEN least(y1, k.y1 + 3) <= greatest(y0, k.y0 - 3) + 4 THEN y1 ELSE least(y1, k.y1 + 3) END AS fine_y1, CASE WHEN k.x0 > 24 THEN k.x0 - 12 ELSE 0.0 END AS fine_x0, CASE WHEN 595 - k.x1 > 24 THEN k.x1 + 12 ELSE 595.0 END AS fine_x1,
 y1 - y0 > 4 AS renders FROM s""")
def clip_geometry(spark: SparkSession, d: str) -> DataFrame:
    """Boxes, clips and their refinement."""
    b = _blocks(spark, d).where("bbox is not null").withColumn("h", F.coalesce("page_height", F.lit(841.9)))
    k, h = F.col("bbox"), F.col("h")
    clip = layout.raw_clip(k["y0"], k["y1"], h, F.lit(1))
    b = b.withColumn("clip", clip)
    y0, y1 = F.col("clip.y0"), F.col("clip.y1")
    fine_y, fine_x = layout.refine_y(y0, y1, k["y0"], k["y1"]), layout.refine_x(F.lit(0.0), F.lit(595.0), k["x0"], k["x1"])
    padded = layout.pad(k, F.lit(595.0), h)
    return b.select(
        "block_id", y0.alias("clip_y0"), y1.alias("clip_y1"), layout.area(k).alias("area"), padded["x0"].alias("pad_x0"), padded["x1"].alias("pad_x1"), layout.flip_y(k, h)["y0"].alias("flip_y0"),
        layout.page_column(k, F.lit(595.0)).alias("page_column"), fine_y["y0"].alias("fine_y0"), fine_y["y1"].alias("fine_y1"), fine_x["x0"].alias("fine_x0"), fine_x["x1"].alias("fine_x1"), layout.renders(F.lit(1), y1 - y0).alias("renders"),
    )


@query(f"""WITH b AS (SELECT * FROM {once('text_blocks', 'block_id')}),
c AS (SELECT upload_id, page, min(bbox.y0) AS choice_y0 FROM b WHERE len(list_filter({lines_of('text')}, lambda v: regexp_matches(v, '^\\s*[①-⑩]\\s*|^\\s*\\(\\s*[1-5]\\s*\\)\\s*'))) > 0 GROUP BY ALL),
p AS (SELECT DISTINCT upload_id, page FROM b), s AS (SELECT p.*, choice_y0, greatest(60.0, choice_y0) AS y FROM p LEFT JOIN c USING (upload_id, page)),
f AS (SELECT *, least(790.0, y - 1) > 64 AS pp, 790 > y + 4 AS cc FROM s)
SELECT upload_id, page, CASE WHEN choice_y0 IS NULL OR (NOT pp AND NOT cc) OR pp THEN 60.0 END AS p0, CASE WHEN choice_y0 IS NULL OR (NOT pp AND NOT cc) THEN 790.0 WHEN pp THEN least(790.0, y - 1) END AS p1,
 CASE WHEN choice_y0 IS NOT NULL AND cc THEN y END AS c0, CASE WHEN choice_y0 IS NOT NULL AND cc THEN 790.0 END AS c1 FROM f""")
def split_clips(spark: SparkSession, d: str) -> DataFrame:
    """Problem and choices part of a page."""
    b = _blocks(spark, d, "upload_id")
    tops = layout.choice_block_top(b, ["upload_id", "page"])
    pages = b.select("upload_id", "page").distinct().join(tops, ["upload_id", "page"], "left")
    return pages.select("upload_id", "page", layout.split_clip(F.lit(60.0), F.lit(790.0), F.col("choice_y0")).alias("s")).select("upload_id", "page", "s.p0", "s.p1", "s.c0", "s.c1")


FLAGS = f"""SELECT block_id, regexp_matches(text, '{T.NUMBER_LIST}') OR {' OR '.join(f"contains(text, '{w}')" for w in T.TEXT_VISUALS)} AS is_text_visual,
 len(c) >= 2 AND len(list_filter(c, lambda v: NOT regexp_full_match(v, '[①-⑩]'))) = 0 AS is_sparse, regexp_full_match({collapse('text')}, '\\[\\s*[^\\]]+\\s*\\]') AS is_label, regexp_full_match(text, '\\s*([①-⑩]\\s*)+') AS is_label_only,
 regexp_matches(text, '{T.SMART_QUOTES}') AS has_quotes, len(list_filter(c, lambda v: regexp_matches(v, '^\\s*(?:(?:문\\s*\\d+)|(?:제\\s*\\d+\\s*문)|(?:\\d+\\s*번)|(?:\\d+\\s*[.)]))\\s*') AND coalesce(TRY_CAST(nullif(regexp_extract(v, '(\\d+)', 1), '') AS INT) BETWEEN 1 AND 100, false)
 AND regexp_matches(regexp_replace(v, '^\\s*(?:(?:문\\s*\\d+)|(?:제\\s*\\d+\\s*문)|(?:\\d+\\s*번)|(?:\\d+\\s*[.)]))\\s*', ''), '[0-9A-Za-z가-힣]'))) AS n_starts
FROM (SELECT block_id, text, {clean_lines('text')} AS c FROM {once('text_blocks', 'block_id')} WHERE text IS NOT NULL)"""


@query(FLAGS)
def block_flags(spark: SparkSession, d: str) -> DataFrame:
    """Predicates on blocks."""
    t = F.col("text")
    starts = F.size(F.filter(T.clean_lines(t), T.is_legacy_question_start)).cast("bigint")
    return _blocks(spark, d).where("text is not null").select("block_id", T.is_text_visual(t).alias("is_text_visual"), T.is_marker_only(t, 2).alias("is_sparse"), T.is_boxed_label(t).alias("is_label"), T.is_label_only(t).alias("is_label_only"), t.rlike(T.SMART_QUOTES).alias("has_quotes"), starts.alias("n_starts"))


@query(f"""WITH t AS (SELECT block_id, coalesce(text, '') AS x, {clean_lines("coalesce(text, '')")} AS c FROM {once('text_blocks', 'block_id')}),
s AS (SELECT block_id, {' + '.join(f"(CASE WHEN regexp_matches(x, '{p}') THEN 2 ELSE 0 END)" for p in T.APPENDIX_PROMOS)} AS promo, len(list_filter(c, lambda v: regexp_matches(v, '^\\s*(?:\\d{{1,2}}\\s+){{4,}}\\d{{1,2}}\\s*$'))) AS nr, len(list_filter(c, lambda v: regexp_matches(v, '^\\s*(?:[①②③④⑤]\\s+){{4,}}[①②③④⑤]\\s*$'))) AS ar,
 len(list_filter(c, lambda v: len(string_split(v, ' ')) >= 8 AND len(list_filter(string_split(v, ' '), lambda w: length(w) > 2)) = 0)) AS sh, len(list_filter(c, lambda v: regexp_matches(v, '{T.OCR_CHOICE}') AND NOT regexp_matches(v, '{T.OCR_START}'))) AS ch FROM t),
k AS (SELECT block_id, promo + (CASE WHEN nr >= 2 THEN 2 ELSE 0 END) + (CASE WHEN ar >= 2 THEN 2 ELSE 0 END) AS strong, (CASE WHEN nr = 1 THEN 1 ELSE 0 END) + (CASE WHEN ar = 1 THEN 1 ELSE 0 END) + (CASE WHEN sh >= 2 THEN 2 ELSE 0 END) AS weak, ch FROM s)
SELECT block_id, NOT (ch >= 3 AND strong = 0) AND (strong >= 4 OR (strong >= 2 AND weak >= 2)) AS is_appendix FROM k""")
def appendix_blocks(spark: SparkSession, d: str) -> DataFrame:
    """promotion and answer tables."""
    return _blocks(spark, d).select("block_id", T.is_appendix(F.col("text")).alias("is_appendix"))


def sparse_sql(x: str) -> str:
    return f"trim(regexp_replace(trim(regexp_replace(replace({collapse(x)}, '|', ' '), '{WS}+', ' ', 'g')), '^[^0-9A-Za-z가-힣#]+', ''))"


@query(f"""WITH e AS (SELECT block_id, unnest({lines_of('text')}) AS x, generate_subscripts({lines_of('text')}, 1) AS pos_ FROM {once('text_blocks', 'block_id')} WHERE text IS NOT NULL), r AS (SELECT block_id, pos_, {sparse_sql('x')} AS row_text FROM e)
SELECT block_id, CAST(pos_ - 1 AS INT) AS line_no, row_text, CAST(length(regexp_replace(row_text, '[^0-9]', '', 'g')) * 3 + length(regexp_replace(row_text, '[^#]', '', 'g')) * 4 + length(regexp_replace(row_text, '[^,.]', '', 'g')) * 2 - length(regexp_replace(row_text, '[^가-힣]', '', 'g')) * 3 AS INT) AS useful,
 row_text <> '' AND len(string_split(row_text, ' ')) BETWEEN 2 AND 4 AND len(list_filter(string_split(row_text, ' '), lambda v: NOT regexp_full_match(v, '[0-9#.,]+'))) = 0 AS is_structured FROM r""")
def sparse_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of sparse tables and their score."""
    rows = _blocks(spark, d).where("text is not null").select("block_id", F.posexplode(T.lines_of(F.col("text"))).alias("line_no", "x"))
    rows = rows.select("block_id", "line_no", T.sparse_row(F.col("x")).alias("row_text"))
    return rows.select("block_id", "line_no", "row_text", T.sparse_score(F.col("row_text"))["useful"].alias("useful"), T.is_structured_row(F.col("row_text")).alias("is_structured"))


@query(f"""SELECT doc_id, {trim_u(f"regexp_replace(regexp_replace(regexp_replace(text, '{WS}+([,?.!])', '\\1', 'g'), '([,?.!])([^{WS[1:-1]}\\]),.?!])', '\\1 \\2', 'g'), '{WS}{{2,}}', ' ', 'g')")} AS repaired FROM documents WHERE text IS NOT NULL""")
def repaired_text(spark: SparkSession, d: str) -> DataFrame:
    """Mechanical repair of spaces around punctuation."""
    return load(spark, d, "documents").where("text is not null").select("doc_id", T.repair_text(F.col("text")).alias("repaired"))


@query("SELECT doc_id, list_filter([" + ", ".join(f"CASE WHEN regexp_matches(text, '{p}') THEN '{n}' END" for n, p in T.ARTIFACTS) + "], lambda v: v IS NOT NULL) AS findings FROM documents WHERE text IS NOT NULL")
def text_artifacts(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of parse damage."""
    return load(spark, d, "documents").where("text is not null").select("doc_id", T.artifacts(F.col("text")).alias("findings"))


def _phrases_sql(x: str) -> str:
    for p, to in T.OCR_PHRASES:
        x = f"regexp_replace({x}, '{p}', '{to.replace('$1', chr(92) + '1')}', 'g')"
    return x


@query(f"SELECT question_id, {_phrases_sql('''replace(stem, '옳지 않은 것은', '올지 않은 것은')''')} AS fixed FROM {once('questions', 'question_id')} WHERE stem IS NOT NULL")
def ocr_phrases(spark: SparkSession, d: str) -> DataFrame:
    """Damaged phrases put right (the stems are damaged first)."""
    damaged = F.replace(F.col("stem"), F.lit("옳지 않은 것은"), F.lit("올지 않은 것은"))
    return _questions(spark, d).where("stem is not null").select("question_id", T.fix_ocr_phrases(damaged).alias("fixed"))


LATEX_SQL = "CASE v " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in T.LATEX.items()) + " ELSE v END"


@query(f"SELECT qf_id, array_to_string(list_transform(string_split(content, ''), lambda v: {LATEX_SQL}), '') AS tex FROM {once('questions_final', 'qf_id')} WHERE content IS NOT NULL")
def latex_escape(spark: SparkSession, d: str) -> DataFrame:
    """Text safe for LaTeX."""
    return _finals(spark, d, "content").where("content is not null").select("qf_id", T.escape_latex(F.col("content")).alias("tex"))


PAGES = f"""WITH p AS (SELECT upload_id || '/' || page_number AS page_key, string_agg(text, chr(10) ORDER BY seq) AS text FROM {once('text_lines', 'line_id')} WHERE text IS NOT NULL GROUP BY upload_id, page_number),
l AS (SELECT page_key, unnest(list_filter(list_transform(string_split(text, chr(10)), lambda v: rtrim(v)), lambda v: trim(v) <> '')) AS line, generate_subscripts(list_filter(list_transform(string_split(text, chr(10)), lambda v: rtrim(v)), lambda v: trim(v) <> ''), 1) AS pos_ FROM p),
q AS (SELECT *, CASE WHEN regexp_matches(line, '{T.OCR_START}') THEN CAST(regexp_extract(line, '{T.OCR_START}', 1) AS INT) WHEN regexp_matches(line, '{T.OCR_START_SLASH}') THEN 7 END AS qno FROM l),
c AS (SELECT *, count(qno) OVER (PARTITION BY page_key ORDER BY pos_) AS chunk_no, count(qno) OVER (PARTITION BY page_key) AS n FROM q)
"""


def _pages(spark: SparkSession, d: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("seq", "text")))
    return _lines(spark, d).where("text is not null").groupBy(F.concat_ws("/", "upload_id", "page_number").alias("page_key")).agg(F.array_join(F.transform(parts, lambda p: p.text), "\n").alias("text"))


@query(PAGES + "SELECT page_key, chunk_no, max(qno) AS qno, trim(string_agg(line, chr(10) ORDER BY pos_)) AS chunk FROM c WHERE chunk_no > 0 OR n = 0 GROUP BY page_key, chunk_no")
def ocr_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Page texts cut at question starts."""
    return segment.ocr_chunks(_pages(spark, d), "page_key", "text")


@query(f"""WITH q AS (SELECT upload_id, question_id, CASE WHEN question_no >= 3 THEN question_no + 1 ELSE question_no END AS qno FROM {once('questions', 'question_id')}),
w AS (SELECT *, row_number() OVER o AS want, coalesce(qno > lag(qno) OVER o, qno IS NOT NULL) AS rise, first_value(qno) OVER o AS f FROM q WINDOW o AS (PARTITION BY upload_id ORDER BY question_id)),
l AS (SELECT *, max(CASE WHEN qno - want <> 0 THEN 1 ELSE 0 END) OVER (PARTITION BY upload_id ORDER BY question_id) AS late FROM w),
k AS (SELECT upload_id, count(*) >= 4 AND count(qno) = count(*) AND bool_and(rise) AND bool_and(late = 0 OR qno - want = 1) AND bool_and(f = 1) AS ok FROM l GROUP BY upload_id)
SELECT question_id, CASE WHEN ok THEN CAST(want AS INT) ELSE qno END AS new_qno FROM l JOIN k USING (upload_id)""")
def renumbered(spark: SparkSession, d: str) -> DataFrame:
    """Numbers one too high from some place on."""
    q = _questions(spark, d, "upload_id").select("upload_id", "question_id", F.when(F.col("question_no") >= 3, F.col("question_no") + 1).otherwise(F.col("question_no")).alias("qno"))
    return segment.renumber_shifted(q, "upload_id", "question_id", "qno", 4).select("question_id", F.col("new_qno").cast("int").alias("new_qno"))


@query(PAGES + f""", s AS (SELECT page_key, chunk_no, max(qno) AS qno, trim(string_agg(line, chr(10) ORDER BY pos_)) AS chunk FROM c WHERE chunk_no > 0 OR n = 0 GROUP BY page_key, chunk_no),
z AS (SELECT page_key, chunk_no, chunk, qno, len(list_filter(string_split(chunk, chr(10)), lambda v: regexp_matches(v, '{T.OCR_CHOICE}') AND NOT regexp_matches(v, '{T.OCR_START}') AND NOT regexp_matches(v, '{T.OCR_START_SLASH}'))) AS nc, length({collapse('chunk')}) AS size FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY page_key ORDER BY (qno IS NOT NULL)::INT DESC, least(nc, 5) DESC, coalesce(qno, 999), (size >= 20)::INT DESC, greatest(0, size - 1800), chunk_no) AS rn, count(*) OVER (PARTITION BY page_key) AS n_candidates FROM z)
SELECT page_key, chunk AS best_text, n_candidates FROM r WHERE rn = 1""")
def best_ocr_text(spark: SparkSession, d: str) -> DataFrame:
    """The best scored text of each page."""
    return segment.best_candidate(ocr_chunks(spark, d), ["page_key"], "chunk", "chunk_no")


@query(PAGES.split("l AS (")[0] + r"""s AS (SELECT page_key, string_split(text, chr(10)) AS l, text FROM p), f AS (SELECT *, list_position(list_transform(l, lambda v: regexp_matches(v, '^\s*[①-⑩]\s*|^\s*\(\s*[1-5]\s*\)\s*')), true) AS pos_ FROM s)
SELECT page_key, """ + trim_u("array_to_string(CASE WHEN pos_ > 0 THEN l[1:pos_ - 1] ELSE l END, chr(10))") + " AS question_text, " + trim_u("array_to_string(CASE WHEN pos_ > 0 THEN l[pos_:] ELSE [] END, chr(10))") + " AS choices_text FROM f")
def page_split(spark: SparkSession, d: str) -> DataFrame:
    """Text before and from the first choice line."""
    return segment.split_at_choices(_pages(spark, d), "text").select("page_key", "question_text", "choices_text")


@query("""WITH t AS (SELECT a.range AS total, b.range AS l, c.range AS r FROM range(0, 14) a, range(0, 14) b, range(0, 14) c)
SELECT CAST(total AS INT) AS total, CAST(l AS INT) AS l, CAST(r AS INT) AS r, CAST(CASE WHEN l > 0 AND r > 0 AND l + r = greatest(total, 1) THEN l WHEN l > 0 AND r > 0 THEN greatest(1, least(greatest(total, 1) - 1, round_even(greatest(total, 1) * (l / (l + r)), 0))) ELSE (greatest(total, 1) + 1) // 2 END AS INT) AS left_count FROM t""")
def column_counts(spark: SparkSession, d: str) -> DataFrame:
    """Questions of the left column."""
    n = F.col("id")
    grid = spark.range(14**3).select(F.floor(n / 196).cast("int").alias("total"), (F.floor(n / 14) % 14).cast("int").alias("l"), (n % 14).cast("int").alias("r"))
    return grid.select("total", "l", "r", T.column_counts(F.col("total"), F.col("l"), F.col("r"))["left"].cast("int").alias("left_count"))


IMAGES = f"""WITH f AS (SELECT * FROM {once('questions_final', 'qf_id')}), o AS (SELECT upload_id, qf_id, generate_subscripts(options, 1) AS option_pos, unnest(options) AS o FROM f),
i AS (SELECT upload_id, qf_id, 0 AS option_pos, generate_subscripts(images, 1) AS image_pos, unnest(images) AS i, NULL AS opt_order FROM f UNION ALL SELECT upload_id, qf_id, option_pos, generate_subscripts(o.images, 1), unnest(o.images), o.opt_order FROM o WHERE o IS NOT NULL),
n AS (SELECT * FROM i WHERE i IS NOT NULL)
"""


@query(IMAGES + """, k AS (SELECT upload_id, qf_id, CAST(option_pos AS INT) AS option_pos, CAST(image_pos AS INT) AS image_pos, row_number() OVER (PARTITION BY upload_id ORDER BY qf_id, option_pos, image_pos) AS image_no FROM n)
SELECT upload_id, qf_id, option_pos, image_pos, CAST(image_no AS INT) AS image_no, 'image' || CASE WHEN image_no < 1000 THEN lpad(CAST(image_no AS VARCHAR), 3, '0') ELSE substr(CAST(image_no AS VARCHAR), 1, 3) END AS image_id, 'image' || CASE WHEN image_no < 1000 THEN lpad(CAST(image_no AS VARCHAR), 3, '0') ELSE substr(CAST(image_no AS VARCHAR), 1, 3) END || '.png' AS image_name FROM k""")
def numbered_images(spark: SparkSession, d: str) -> DataFrame:
    """Images numbered within an upload."""
    return canonical.number_images(_finals(spark, d, "images", "options", within="upload_id"), "upload_id", "qf_id")


@query(IMAGES + "SELECT qf_id, CASE WHEN option_pos = 0 THEN 'question' ELSE 'option' END AS scope, opt_order AS option_order, i.image_id AS image_id FROM n")
def caption_targets(spark: SparkSession, d: str) -> DataFrame:
    """Every image with its place."""
    return canonical.caption_targets(_finals(spark, d, "images", "options"), "qf_id")


@query(f"""WITH f AS (SELECT upload_id, list_filter(coalesce(images, []), lambda v: v IS NOT NULL) AS im, list_filter(coalesce(options, []), lambda v: v IS NOT NULL) AS op FROM {once('questions_final', 'qf_id')})
SELECT upload_id, count(*) AS total_questions, CAST(sum(len(im) + coalesce(list_sum(list_transform(op, lambda v: len(list_filter(coalesce(v.images, []), lambda w: w IS NOT NULL)))), 0)) AS BIGINT) AS total_images,
 bool_or(len(op) > 0 AND len(list_filter(op, lambda v: coalesce(v.is_correct, false))) = 0) AS requires_answer_review FROM f GROUP BY upload_id""")
def document_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Counts and the review flag."""
    return canonical.document_metadata(_finals(spark, d, "images", "options", within="upload_id"), "upload_id")


@query(f"""WITH f AS (SELECT qf_id, unnest([CASE WHEN content IS NULL THEN 'content' END, CASE WHEN question_source IS NULL THEN 'question_source' END, CASE WHEN images IS NULL THEN 'images' END, CASE WHEN hint_explanation IS NULL THEN 'hint_explanation' END,
 CASE WHEN options IS NULL THEN 'options' END, CASE WHEN len(list_filter(options, lambda v: v IS NULL OR v.opt_order IS NULL)) > 0 THEN 'option' END]) AS problem FROM {once('questions_final', 'qf_id')}) SELECT * FROM f WHERE problem IS NOT NULL""")
def record_violations(spark: SparkSession, d: str) -> DataFrame:
    """Records that miss required fields."""
    return canonical.violations(_finals(spark, d, "content", "question_source", "images", "hint_explanation", "options"), "qf_id")


@query(f"""WITH f AS (SELECT qf_id, content, {collapse('content')} AS c FROM {once('questions_final', 'qf_id')} WHERE content IS NOT NULL) SELECT qf_id, content AS before, c AS after FROM f WHERE content <> c""")
def content_changes(spark: SparkSession, d: str) -> DataFrame:
    """Texts that a step changed."""
    f = _finals(spark, d, "content").where("content is not null").select("qf_id", "content")
    return canonical.text_changes(f, f.withColumn("content", T.collapse(F.col("content"))), ["qf_id"])


@query("""WITH e AS (SELECT *, event_type = 'error' AS bad, coalesce(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n FROM events),
s AS (SELECT event_id, user_id, props, CASE WHEN n >= 3 THEN 'skipped' WHEN bad THEN 'failed' ELSE 'done' END AS state FROM e)
SELECT user_id, count(*) AS total, count(*) FILTER (WHERE state = 'done') AS done, count(*) FILTER (WHERE state = 'failed') AS failed, count(*) FILTER (WHERE state = 'skipped') AS skipped, coalesce((list(props ORDER BY event_id) FILTER (WHERE state = 'failed'))[1:10], []) AS errors FROM s GROUP BY user_id""")
def breaker_metadata(spark: SparkSession, d: str) -> DataFrame:
    """Calls of a stage under a circuit breaker."""
    calls = canonical.breaker(load(spark, d, "events"), ["user_id"], "event_id", F.col("event_type") == "error", 3)
    return canonical.stage_metadata(calls, ["user_id"], "event_id", "props").drop("timeouts")


@query("SELECT event_id, coalesce(json_valid(props) AND json_type(props) = 'OBJECT', false) AS is_object FROM events")
def json_replies(spark: SparkSession, d: str) -> DataFrame:
    """Replies that are JSON objects (in fenced blocks)."""
    fenced = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    return load(spark, d, "events").select("event_id", T.json_object(fenced).isNotNull().alias("is_object"))


@query(f"""WITH q AS (SELECT qf_id, hint_explanation, options, qf_id % 3 AS m FROM {once('questions_final', 'qf_id')})
SELECT qf_id, CASE WHEN m = 0 THEN 'hint ' || qf_id ELSE hint_explanation END AS hint_explanation, CAST(len(list_filter(options, lambda v: CASE WHEN m = 0 THEN coalesce(v.opt_order = 2, false) ELSE coalesce(v.is_correct, false) END)) AS INT) AS n_correct FROM q""")
def merged_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Replies merged into questions."""
    f = _finals(spark, d, "hint_explanation", "options")
    replies = f.where("qf_id % 3 = 0").select("qf_id", F.concat(F.lit('{"hint_explanation":" hint '), F.col("qf_id"), F.lit(' ","option_explanations":{"1":"one"},"correct_orders":[2]}')).alias("payload"))
    out = canonical.merge_enrichment(f, replies, ["qf_id"])
    return out.select("qf_id", "hint_explanation", F.size(F.filter("options", lambda o: F.coalesce(o["is_correct"], F.lit(False)))).alias("n_correct"))


@query(f"""WITH q AS (SELECT upload_id, question_id, question_no, CASE WHEN question_no % 5 = 1 THEN '앞 글 [' || (question_no + 2) || ' ~ ' || question_no || '] 다음 글을 읽고 물음에 답하시오. ' || stem ELSE stem END AS t FROM {once('questions', 'question_id')}),
f AS (SELECT upload_id, question_id, question_no AS a, question_no + 2 AS b, 'shared_passage_' || lpad(CAST(question_no AS VARCHAR), 3, '0') || '_' || lpad(CAST(question_no + 2 AS VARCHAR), 3, '0') AS passage_id FROM q WHERE question_no % 5 = 1 AND stem_ok(t)),
x AS (SELECT DISTINCT f.upload_id, q.question_no AS qno, f.passage_id, f.question_id FROM f JOIN q ON f.upload_id = q.upload_id AND q.question_no BETWEEN a AND b),
k AS (SELECT upload_id, passage_id, min(question_id) AS question_id FROM x GROUP BY ALL)
SELECT upload_id, qno, arg_max(passage_id, question_id) AS passage_id FROM x JOIN k USING (upload_id, passage_id, question_id) GROUP BY upload_id, qno""".replace("stem_ok(t)", "t IS NOT NULL"))
def shared_passages(spark: SparkSession, d: str) -> DataFrame:
    """Shared passages and the questions they belong to."""
    no = F.col("question_no")
    marked = F.concat(F.lit("앞 글 ["), (no + 2).cast("string"), F.lit(" ~ "), no.cast("string"), F.lit("] 다음 글을 읽고 물음에 답하시오. "), F.col("stem"))
    q = _questions(spark, d, "upload_id").select("upload_id", "question_id", "question_no", F.when(no % 5 == 1, marked).otherwise(F.col("stem")).alias("t"))
    return passages.shared_passages(q, "upload_id", "question_id", "question_no", "t")[1]


@query(f"""WITH t AS (SELECT upload_id, exam_id, question_id, question_no AS qno, stem AS question_text, assets, CAST(row_number() OVER (PARTITION BY upload_id ORDER BY question_id) AS INT) AS question_index FROM {once('questions', 'question_id')}),
c AS (SELECT question_id, string_agg(coalesce(label, '') || ' ' || coalesce(text, ''), chr(10) ORDER BY choice_id) AS choices_text FROM {once('choices', 'choice_id')} GROUP BY question_id),
x AS (SELECT upload_id, exam_id, question_index, qno, question_text, choices_text, true AS has_text FROM t LEFT JOIN c USING (question_id) WHERE question_text IS NOT NULL),
i AS (SELECT upload_id, question_index, qno AS image_qno, ['q' || question_index || '.png'] AS problem_image_paths FROM t WHERE len(assets) > 0),
j AS (SELECT * FROM x FULL OUTER JOIN i USING (upload_id, question_index)), k AS (SELECT *, coalesce(question_text, '') AS q, coalesce(choices_text, '') AS c, CASE WHEN has_text THEN qno ELSE image_qno END AS n FROM j),
h AS (SELECT *, sha1({collapse('q || chr(10) || c || chr(10)')}) AS content_hash FROM k)
SELECT upload_id, 'v1' AS schema_version, coalesce(exam_id, '') || ':' || lpad(CAST(question_index AS VARCHAR), CAST(greatest(3, length(CAST(question_index AS VARCHAR))) AS INT), '0') || ':' || coalesce(CAST(n AS VARCHAR), 'na') || ':' || substr(content_hash, 1, 12) AS record_id, question_index, n AS question_number, q AS question_text, c AS choices_text, coalesce(problem_image_paths, []) AS problem_image_paths, content_hash FROM h""")
def db_records(spark: SparkSession, d: str) -> DataFrame:
    """Flat records of texts and images."""
    w = Window.partitionBy("upload_id").orderBy("question_id")
    t = _questions(spark, d, "upload_id").withColumn("question_index", F.row_number().over(w))
    part = F.struct("choice_id", F.concat(F.coalesce("label", F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))).alias("t"))
    c = first_delivery(load(spark, d, "choices").select("choice_id", "question_id", "label", "text"), "choice_id").groupBy("question_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(part)), lambda p: p.t), "\n").alias("choices_text"))
    texts = t.where("stem is not null").join(c, "question_id", "left").select("upload_id", "exam_id", "question_index", F.col("question_no").alias("qno"), F.col("stem").alias("question_text"), "choices_text")
    images = t.where("size(assets) > 0").select("upload_id", "question_index", F.col("question_no").alias("image_qno"), F.array(F.concat(F.lit("q"), F.col("question_index").cast("string"), F.lit(".png"))).alias("problem_image_paths"))
    return passages.db_records(texts, images, "upload_id", "exam_id")


@query("""WITH p AS (SELECT vec_id, unnest(embedding) AS v FROM embeddings)
SELECT vec_id, round(avg(CAST(v AS DOUBLE) * 64 + 128), 4) AS mean, round(stddev_pop(CAST(v AS DOUBLE) * 64 + 128), 4) AS sd, avg(CASE WHEN CAST(v AS DOUBLE) * 64 + 128 <= 128 THEN 1.0 ELSE 0.0 END) AS dark_ratio FROM p GROUP BY vec_id""")
def pixel_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics of rows of grey values (vectors stand for rows)."""
    rows = load(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double") * 64 + 128).alias("pixels"))
    out = layout.pixel_stats(rows, ["vec_id"], "pixels", 128.0)
    return out.select("vec_id", F.round("mean", 4).alias("mean"), F.round("sd", 4).alias("sd"), "dark_ratio")


RULES = """WITH p AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos_, unnest(embedding) > 0 AS on_ FROM embeddings),
d AS (SELECT DISTINCT vec_id, pos_ FROM p WHERE on_), g AS (SELECT vec_id, pos_, pos_ - row_number() OVER (PARTITION BY vec_id ORDER BY pos_) AS g FROM d),
r AS (SELECT vec_id, CAST(min(pos_) AS INT) AS start, CAST(max(pos_) AS INT) AS "end", count(*) AS size FROM g GROUP BY vec_id, g)
"""


def _flags(spark: SparkSession, d: str) -> DataFrame:
    return load(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("at", "v")).select("vec_id", "at", (F.col("v") > 0).alias("on"))


@query(RULES + "SELECT * FROM r")
def consecutive_runs(spark: SparkSession, d: str) -> DataFrame:
    """Runs of consecutive positions."""
    return segment.runs(_flags(spark, d).where("on"), ["vec_id"], "at")


@query(RULES + """, k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY size DESC, "end" - start DESC, start) AS n FROM r WHERE "end" - start >= 1)
SELECT vec_id, start, "end", size AS score, row_number() OVER (PARTITION BY vec_id ORDER BY start) AS span_no FROM k WHERE n <= 3""")
def best_spans(spark: SparkSession, d: str) -> DataFrame:
    """O3: the three best scored spans in order (a top-k report)."""
    return layout.best_spans(consecutive_runs(spark, d).withColumnRenamed("size", "score"), ["vec_id"], 3, 1).withColumn("span_no", F.col("span_no").cast("bigint"))


@query("""WITH p AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS pos_, unnest(embedding) > 0 AS on_ FROM embeddings)
SELECT vec_id, CAST(least(coalesce(min(pos_) FILTER (WHERE NOT on_), max(pos_) + 1), 5) AS INT) AS n FROM p GROUP BY vec_id""")
def edge_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rows to trim from the start."""
    return segment.prefix_run(_flags(spark, d), ["vec_id"], "at", "on", 5)


@query("""WITH s AS (SELECT CAST(o_orderkey AS INT) AS k, o_totalprice % 256 AS mean, o_totalprice % 50 AS sd, (o_orderkey % 100) / 100 AS dark, (o_custkey % 100) / 100 AS run FROM orders)
SELECT k, dark >= 0.88 OR (sd <= 8 AND mean <= 247) OR (run >= 0.75 AND dark >= 0.18 AND mean <= 252 AND sd <= 32) AS is_rule, (run >= 0.9 AND dark >= 0.65) OR (run >= 0.92 AND sd <= 12 AND mean <= 250) OR (run >= 0.85 AND dark >= 0.75 AND sd <= 45 AND mean <= 230) AS is_vertical_rule FROM s""")
def boundary_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rows and columns that look like printed rules."""
    s = load(spark, d, "orders").select(F.col("o_orderkey").cast("int").alias("k"), (F.col("o_totalprice") % 256).alias("m"), (F.col("o_totalprice") % 50).alias("sd"), ((F.col("o_orderkey") % 100) / 100).alias("dark"), ((F.col("o_custkey") % 100) / 100).alias("run"))
    args = [F.col(c) for c in ("m", "sd", "dark", "run")]
    return s.select("k", layout.is_rule(*args).alias("is_rule"), layout.is_vertical_rule(*args).alias("is_vertical_rule"))


@query("""WITH f AS (SELECT CAST(1 + p_partkey % 60 AS INT) AS q, CASE p_partkey % 3 WHEN 0 THEN 'problem' WHEN 1 THEN 'choices' ELSE 'extra' END AS kind, p_size AS part, p_partkey AS k FROM part),
n AS (SELECT q, CASE kind WHEN 'problem' THEN 0 WHEN 'choices' THEN 1 ELSE 2 END AS o, part, 'question_' || lpad(CAST(q AS VARCHAR), 3, '0') || '_' || kind || '_part_' || part || '_' || k || '.png' AS name FROM f)
SELECT q AS question_number, list(name ORDER BY o, part, name) AS files FROM n WHERE q >= 12 GROUP BY q""")
def image_groups(spark: SparkSession, d: str) -> DataFrame:
    """Image files grouped by question, from a number on."""
    from ..sources import readers

    p = load(spark, d, "part")
    q, kind = 1 + F.col("p_partkey") % 60, F.when(F.col("p_partkey") % 3 == 0, "problem").when(F.col("p_partkey") % 3 == 1, "choices").otherwise("extra")
    name = F.concat(F.lit("question_"), F.lpad(q.cast("string"), 3, "0"), F.lit("_"), kind, F.lit("_part_"), F.col("p_size").cast("string"), F.lit("_"), F.col("p_partkey").cast("string"), F.lit(".png"))
    return readers.resume_from(readers.question_image_groups(p.select(name.alias("name"))), 12)


@query(ISLANDS + """, m AS (SELECT upload_id, string_agg('- ' || question_number || '. ' || text, chr(10) ORDER BY island) AS md FROM b GROUP BY upload_id)
SELECT b.upload_id, island AS question_index, question_number AS qno, trim('- ' || question_number || '. ' || text) AS content FROM b""")
def markdown_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions printed as Markdown and cut again."""
    q = segment.build_questions(_lines(spark, d))
    line = F.concat(F.lit("- "), F.col("question_number").cast("string"), F.lit(". "), F.col("text"))
    parts = F.array_sort(F.collect_list(F.struct("island", line.alias("l"))))
    docs = q.groupBy("upload_id").agg(F.array_join(F.transform(parts, lambda p: p.l), "\n").alias("md"))
    return segment.markdown_questions(docs, "upload_id", "md")


def _trees(spark: SparkSession, d: str) -> DataFrame:
    """Element trees printed from questions and choices: one list an upload, with a header and an image."""
    c = first_delivery(load(spark, d, "choices").select("choice_id", "question_id", "label", "text"), "choice_id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("choice_id", F.concat(F.coalesce("label", F.lit("")), F.lit(" "), F.coalesce("text", F.lit(""))).alias("t")))), lambda p: p.t), " ")
    q = _questions(spark, d, "upload_id").where("question_no is not null").join(c.groupBy("question_id").agg(text.alias("c")), "question_id", "left")
    kid = F.struct(F.lit("paragraph").alias("type"), F.coalesce("c", F.lit("")).alias("content"))
    item = F.struct(F.lit("list item").alias("type"), F.concat(F.col("question_no").cast("string"), F.lit(". "), F.coalesce("stem", F.lit(""))).alias("content"), F.array(kid).alias("kids"))
    items = F.transform(F.array_sort(F.collect_list(F.struct("question_id", item.alias("i")))), lambda x: x.i)
    tree = F.to_json(F.struct(F.array(F.struct(F.lit("header").alias("type"), F.array().cast(f"array<struct<type:string,content:string,kids:array<struct<type:string,content:string>>>>").alias("list items")), F.struct(F.lit("list").alias("type"), items.alias("list items"))).alias("kids")))
    return q.groupBy("upload_id").agg(tree.alias("raw"))


TREE_Q = f"""WITH q AS (SELECT * FROM {once('questions', 'question_id')} WHERE question_no IS NOT NULL), c AS (SELECT question_id, string_agg(coalesce(label, '') || ' ' || coalesce(text, ''), ' ' ORDER BY choice_id) AS c FROM {once('choices', 'choice_id')} GROUP BY question_id)
"""


@query(TREE_Q + """SELECT upload_id, count(*) AS n_items, count(*) AS n_paragraphs, 1 AS n_lists FROM q GROUP BY upload_id""")
def tree_nodes(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of element trees."""
    n = nodes.content_nodes(nodes.flatten(_trees(spark, d), "upload_id", "raw", 6))
    k = lambda t: F.count_if(F.col("type") == t)
    return n.groupBy("upload_id").agg(k("list item").alias("n_items"), k("paragraph").alias("n_paragraphs"), k("list").cast("int").alias("n_lists"))


_SQL_BLANK = r"[\s\x{00a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}]+"


@query(TREE_Q + f""", p AS (SELECT upload_id, question_id, question_no, regexp_replace(coalesce(stem, ''), '^{_SQL_BLANK}|{_SQL_BLANK}$', '', 'g') AS stem, regexp_extract_all(coalesce(c, ''), '[①-⑩][^①-⑩]*') AS l FROM q LEFT JOIN c USING (question_id)),
f AS (SELECT *, list_filter(l, lambda x, i: list_position(list_transform(l, lambda y: y[1]), x[1]) = i) AS k FROM p)
SELECT upload_id, CAST(row_number() OVER (PARTITION BY upload_id ORDER BY question_no, question_id) AS INT) AS question_index, question_no AS question_number, stem AS question_text, CAST(len(k) AS INT) AS n_choices,
array_to_string(list_transform(k, lambda x: instr('①②③④⑤⑥⑦⑧⑨⑩', x[1]) || ':' || regexp_replace(substr(x, 2), '^{_SQL_BLANK}|{_SQL_BLANK}$', '', 'g')), '|') AS choices FROM f""")
def tree_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions of element trees."""
    q = nodes.extract_questions(_trees(spark, d), "upload_id", "raw")
    choices = F.array_join(F.transform("choices", lambda c: F.concat(c["number"].cast("string"), F.lit(":"), c["text"])), "|")
    return q.select("upload_id", "question_index", "question_number", "question_text", F.size("choices").alias("n_choices"), choices.alias("choices"))


# Element trees with everything that hangs between questions: what belongs to which is stated beside each.
_TREE_EVENTS = [
    ("split choices", [{"type": "list", "list items": [{"content": "1. 가"}, {"content": "2. 나", "kids": [{"type": "paragraph", "content": "① ㄱ ② ㄴ"}]}]}, {"type": "paragraph", "content": "① ㄷ"}, {"type": "paragraph", "content": "② ㄹ"}], [(1, "가", "1:ㄷ", ""), (2, "나", "1:ㄱ|2:ㄴ|2:ㄹ", "")]),
    ("circled list", [{"type": "list", "list items": [{"content": "32. 다"}]}, {"type": "list", "numbering style": "circled arabic numbers", "list items": [{"content": "① a"}, {"content": "b"}]}, {"type": "list", "numbering style": "circled arabic numbers", "list items": [{"content": "④ d"}]}], [(32, "다", "1:a|2:b|4:d", "")]),
    ("orphans", [{"type": "list", "list items": [{"content": "28. 라"}]}, {"type": "list", "list items": [{"content": "① x ② y"}, {"content": "29. 마"}]}], [(28, "라", "1:x|2:y", ""), (29, "마", "", "")]),
    ("pictures", [{"type": "list", "list items": [{"content": "3. 바"}]}, {"type": "image", "id": 9}, {"type": "image", "id": 12, "bounding box": [9, 0, 1, 1]}, {"type": "image", "id": 11, "bounding box": [1, 0, 1, 1]}, {"type": "caption", "content": "① ②"}], [(3, "바", "1:|2:", "9")]),
    ("blocks", [{"type": "header"}, {"type": "list", "list items": [{"content": "5) 사"}]}, {"type": "text block", "kids": [{"type": "heading", "content": "과목"}]}, {"type": "text block", "kids": [{"type": "paragraph", "content": "보기"}]}, {"type": "table", "id": 4}, {"type": "paragraph", "content": "① ㅁ"}, {"type": "table", "id": 5}], [(5, "사\n보기", "1:ㅁ", "4")]),
]
_TREE_EVENTS_SQL = " UNION ALL ".join(f"SELECT '{doc}' AS doc, {n} AS question_number, '{text}' AS question_text, '{choices}' AS choices, '{images}' AS images" for doc, _, want in _TREE_EVENTS for n, text, choices, images in want)


@query(_TREE_EVENTS_SQL)
def tree_events(spark: SparkSession, d: str) -> DataFrame:
    """Choices, pictures, blocks and tables between the questions of a tree, against stated results."""
    import json

    docs = spark.createDataFrame([(doc, json.dumps({"kids": kids})) for doc, kids, _ in _TREE_EVENTS], "doc string, raw string")
    choices = F.array_join(F.transform("choices", lambda c: F.concat(c["number"].cast("string"), F.lit(":"), c["text"])), "|")
    return nodes.extract_questions(docs, "doc", "raw").select("doc", "question_number", "question_text", choices.alias("choices"), F.array_join(F.col("images").cast("array<string>"), ",").alias("images"))


@query()
def canonical_questions(spark: SparkSession, d: str) -> DataFrame:
    """Canonical questions of parsed payloads."""
    from ..operators.nested import FlatTables

    return canonical.normalize_questions(FlatTables(load(spark, d, "final_payloads")))


@query()
def line_groups(spark: SparkSession, d: str) -> DataFrame:
    """Words to lines by a running mean."""
    words = _lines(spark, d).where("bbox is not null").select("upload_id", "page_number", "column_index", F.col("bbox.x0").alias("x0"), F.col("bbox.y0").alias("y0"), F.col("bbox.x1").alias("x1"), F.col("bbox.y1").alias("y1"), "text")
    return segment.line_groups(words.where("text is not null"), ["upload_id", "page_number", "column_index"])


@query()
def anchored_segments(spark: SparkSession, d: str) -> DataFrame:
    """Blocks cut at following numbers."""
    return segment.split_by_anchor(_pages(spark, d), "page_key", "text")


@query()
def latex_documents(spark: SparkSession, d: str) -> DataFrame:
    """LaTeX documents of records."""
    return passages.latex_document(db_records(spark, d), "upload_id", "question_index")
