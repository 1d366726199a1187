"""Queries over boxes, images, requests, replies and rasters, with SQL written from literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..common import first_delivery, load
from ..functions import text as T
from ..operators import canonical, columns, images, layout, nodes, prompts, raster, reading, segment
from ..sources import writers
from .exam import _blocks, _lines, once, query

FINALS = once("questions_final", "qf_id")
LINES, BLOCKS, QUESTIONS = once("text_lines", "line_id"), once("text_blocks", "block_id"), once("questions", "question_id")


def _finals(spark: SparkSession, d: str) -> DataFrame:
    return first_delivery(load(spark, d, "questions_final"), "qf_id")


# Boxes


@query(f"""SELECT * FROM (SELECT upload_id, page_number, column_index, arg_min(bbox.y1, seq) AS top, min(CASE WHEN regexp_matches(text, '^[①②③④]') THEN bbox.y0 END) AS bottom
FROM {LINES} WHERE bbox IS NOT NULL AND text IS NOT NULL GROUP BY ALL) WHERE bottom > top""")
def visual_bands(spark: SparkSession, d: str) -> DataFrame:
    """The band between the first line and the first choice of a page column."""
    lines = _lines(spark, d).where("bbox is not null and text is not null")
    return columns.visual_band(lines, ["upload_id", "page_number", "column_index"], "seq")


@query(f"""WITH l AS (SELECT line_id, upload_id, page_number, column_index, seq, text, coalesce(text <> '' AND (contains(text, 'ㆍ') OR contains(text, 'SELECT ') OR contains(text, 'while (')), false) AS m FROM {LINES}),
f AS (SELECT *, min(CASE WHEN m THEN seq END) OVER (PARTITION BY upload_id, page_number, column_index) AS f FROM l)
SELECT line_id, coalesce(m OR (seq = f - 1 AND regexp_matches(trim(text), '^\\[\\s*[^\\]]+\\s*\\]$')), false) AS included FROM f""")
def boxed_text_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of boxed texts and the label right before them."""
    t = F.col("text")
    lines = _lines(spark, d).withColumn("matched", F.coalesce((t != "") & (t.contains("ㆍ") | t.contains("SELECT ") | t.contains("while (")), F.lit(False)))
    return columns.boxed_lines(lines, ["upload_id", "page_number", "column_index"], "seq", "matched").select("line_id", "included")


@query(f"""WITH l AS (SELECT upload_id, page_number, column_index, seq, bbox, lag(bbox.y1) OVER (PARTITION BY upload_id, page_number, column_index ORDER BY seq) AS before_, text FROM {LINES} WHERE bbox IS NOT NULL AND text IS NOT NULL),
i AS (SELECT * FROM l WHERE regexp_matches(text, '^[①②③④]')),
a AS (SELECT upload_id, page_number, column_index, min(bbox.x0) AS x0, min(bbox.y0) AS y0, max(bbox.x1) AS x1, max(bbox.y1) AS y1, arg_min(struct_pack(b := before_, t := bbox.y0), seq) AS f FROM i GROUP BY ALL),
t AS (SELECT *, least(100.0, y0 - 6) AS t0 FROM a)
SELECT upload_id, page_number, column_index, greatest(least(100.0, x0 - 6), 0) AS x0, greatest(CASE WHEN f.b < f.t THEN greatest(t0, (f.b + f.t) / 2) ELSE t0 END, 0) AS y0, least(greatest(200.0, x1 + 6), 595) AS x1, least(greatest(150.0, y1 + 6), 842) AS y1 FROM t""")
def boxed_rects(spark: SparkSession, d: str) -> DataFrame:
    """Drawings of boxed texts grown to their lines, not into the line before, within the page."""
    number = lambda x: F.lit(float(x))
    lines = _lines(spark, d).where("bbox is not null and text is not null").withColumn("included", F.col("text").rlike("^[①②③④]")).withColumn("rect", layout.box(number(100), number(100), number(200), number(150)))
    keys = ["upload_id", "page_number", "column_index"]
    return columns.boxed_rect(lines, keys, "seq", layout.box(number(0), number(0), number(595), number(842))).select(*keys, "rect.*")


@query(f"""WITH b AS (SELECT block_id, upload_id, page, bbox AS r FROM {BLOCKS} WHERE bbox IS NOT NULL), w AS (SELECT upload_id, page_number AS page, bbox AS w FROM {LINES} WHERE bbox IS NOT NULL),
f AS (SELECT * FROM b WHERE r.y0 >= CASE WHEN page = 1 THEN 215 ELSE 60 END AND r.y1 <= 790 AND r.x1 - r.x0 >= 20 AND r.y1 - r.y0 >= 12),
o AS (SELECT block_id, sum(CASE WHEN w.x1 > r.x0 AND w.x0 < r.x1 AND w.y1 > r.y0 AND w.y0 < r.y1 THEN greatest(0, least(r.x1, w.x1) - greatest(r.x0, w.x0)) * greatest(0, least(r.y1, w.y1) - greatest(r.y0, w.y0)) ELSE 0 END) AS c,
 any_value((r.x1 - r.x0) * (r.y1 - r.y0)) AS s, sum(CASE WHEN w.x1 > r.x0 AND w.x0 < r.x1 AND w.y1 > r.y0 AND w.y0 < r.y1 THEN 1 ELSE 0 END) AS n FROM f LEFT JOIN w USING (upload_id, page) GROUP BY block_id)
SELECT block_id AS rect_id FROM o WHERE NOT (CASE WHEN s > 0 THEN c / s ELSE 0 END >= 0.35 AND n >= 8)""")
def visual_rects(spark: SparkSession, d: str) -> DataFrame:
    """Boxes within the page bounds that are not mostly text."""
    drawings = _blocks(spark, d).where("bbox is not null").select(F.col("block_id").alias("rect_id"), "upload_id", "page", F.col("bbox").alias("rect"))
    words = _lines(spark, d).where("bbox is not null").select("upload_id", F.col("page_number").alias("page"), F.col("bbox").alias("word"))
    return columns.visual_candidates(drawings, words, ["upload_id", "page"]).select("rect_id")


@query(f"""SELECT block_id FROM {BLOCKS} WHERE bbox.x1 > bbox.x0 AND bbox.y1 > bbox.y0 AND least(bbox.x1, 300) - greatest(bbox.x0, 40) > 0 AND least(bbox.y1, 500) - greatest(bbox.y0, 100) > 0
AND (least(bbox.x1, 300) - greatest(bbox.x0, 40)) / (bbox.x1 - bbox.x0) >= 0.3""")
def clipped_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks that lie in a clip by a share of their width, one clip a page."""
    b = _blocks(spark, d).where("bbox is not null").select("block_id", "upload_id", "page", F.col("bbox").alias("block"))
    n = lambda x: F.lit(float(x))
    clips = b.select("upload_id", "page").distinct().withColumn("clip", layout.box(n(40), n(100), n(300), n(500)))
    return layout.blocks_in_clip(b, clips, ["upload_id", "page"]).select("block_id")


@query(f"""WITH b AS (SELECT question_id, upload_id, unnest(assets) AS a FROM {QUESTIONS}), c AS (SELECT upload_id, question_id, a.page AS page, a.column_label AS column_label, min(a.bbox[1]) AS x0, min(a.bbox[2]) AS y0, max(a.bbox[3]) AS x1, max(a.bbox[4]) AS y1
FROM b WHERE len(a.bbox) = 4 AND a.page IS NOT NULL AND a.column_label IS NOT NULL GROUP BY ALL),
n AS (SELECT *, row_number() OVER (PARTITION BY upload_id, question_id ORDER BY page, column_label) AS n FROM c)
SELECT upload_id, question_id, page, column_label, greatest(0, x0 - 8) AS x0, greatest(0, y0 - 8) AS y0, least(595, x1 + 8) AS x1, least(842, y1 + 8) AS y1,
'q' || CASE WHEN question_id < 1000 THEN lpad(CAST(question_id AS VARCHAR), 3, '0') ELSE CAST(question_id AS VARCHAR) END || '_p' || CASE WHEN page < 100 THEN lpad(CAST(page AS VARCHAR), 2, '0') ELSE CAST(page AS VARCHAR) END || '_' || column_label || '_' || CASE WHEN n < 100 THEN lpad(CAST(n AS VARCHAR), 2, '0') ELSE CAST(n AS VARCHAR) END || '.png' AS file FROM n""")
def question_assets(spark: SparkSession, d: str) -> DataFrame:
    """One padded box for each page column a question has assets in."""
    q = first_delivery(load(spark, d, "questions").select("question_id", "upload_id", "assets"), "question_id").select("upload_id", "question_id", F.explode("assets").alias("a"))
    g = lambda i: F.get("a.bbox", F.lit(i))
    blocks = q.where("size(a.bbox) = 4 and a.page is not null and a.column_label is not null").select("upload_id", "question_id", "a.page", "a.column_label", layout.box(g(0), g(1), g(2), g(3)).alias("bbox"))
    return columns.asset_groups(blocks, "upload_id", "question_id").select("upload_id", "question_id", "page", "column_label", "rect.*", "file")


@query(f"""WITH b AS (SELECT question_id, generate_subscripts(assets, 1) AS n, unnest(assets) AS a FROM {QUESTIONS})
SELECT question_id, CAST(n AS INT) AS n, CASE WHEN len(a.bbox) = 4 AND a.page BETWEEN 1 AND 30 THEN a.bbox[1] END AS x0, CASE WHEN len(a.bbox) = 4 AND a.page BETWEEN 1 AND 30 THEN 842 - a.bbox[4] END AS y0,
CASE WHEN len(a.bbox) = 4 AND a.page BETWEEN 1 AND 30 THEN a.bbox[3] END AS x1, CASE WHEN len(a.bbox) = 4 AND a.page BETWEEN 1 AND 30 THEN 842 - a.bbox[2] END AS y1 FROM b""")
def element_crops(spark: SparkSession, d: str) -> DataFrame:
    """Rectangles to render, from boxes whose origin is at the bottom of the page."""
    q = first_delivery(load(spark, d, "questions").select("question_id", "assets"), "question_id").select("question_id", F.posexplode("assets").alias("at", "a"))
    rect = columns.crop_of_element(F.col("a.bbox"), F.col("a.page"), F.lit(30), F.lit(842.0))
    return q.select("question_id", (F.col("at") + 1).alias("n"), rect.alias("r")).select("question_id", "n", "r.x0", "r.y0", "r.x1", "r.y1")


_CROPS = f"""WITH b AS (SELECT block_id, upload_id, page, bbox AS r FROM {BLOCKS} WHERE bbox IS NOT NULL), q AS (SELECT upload_id, page, min(block_id) AS question_index FROM b GROUP BY ALL),
w AS (SELECT q.*, r AS box FROM q JOIN b ON block_id = question_index), m AS (SELECT w.upload_id, w.page, w.question_index, b.block_id, b.r FROM w JOIN b USING (upload_id, page)
WHERE (b.r.x0 + b.r.x1) / 2 BETWEEN box.x0 - 8 AND box.x1 + 8 AND (b.r.y0 + b.r.y1) / 2 BETWEEN box.y0 - 12 AND box.y1 + 12)"""


@query(f"{_CROPS} SELECT upload_id, question_index, count(*) AS n_crops, list_sort(list(r.y0)) AS tops FROM m GROUP BY ALL")
def question_crops(spark: SparkSession, d: str) -> DataFrame:
    """Drawings whose centre lies in the box of a question, here the first block of each page."""
    b = _blocks(spark, d).where("bbox is not null").select("block_id", "upload_id", "page", F.col("bbox").alias("rect"))
    q = b.groupBy("upload_id", "page").agg(F.min("block_id").alias("question_index"), F.min_by("rect", "block_id").alias("box"))
    crops = columns.crops_of_questions(q, b, ["upload_id", "page"], "upload_id")
    return crops.groupBy("upload_id", "question_index").agg(F.count(F.lit(1)).alias("n_crops"), F.sort_array(F.collect_list("rect.y0")).alias("tops"))


# Files and paths


@query(f"""SELECT qf_id, '/out/exam_concepts_txt' AS folder, 'question_' || CASE WHEN qf_id < 1000 THEN lpad(CAST(qf_id AS VARCHAR), 3, '0') ELSE CAST(qf_id AS VARCHAR) END || '_answer.txt' AS answer_file,
'question' || CASE WHEN qf_id < 1000 THEN lpad(CAST(qf_id AS VARCHAR), 3, '0') ELSE CAST(qf_id AS VARCHAR) END || '.md' AS question_file, '/data/' || upload_id || '/output.tex' AS tex, '/data/' || upload_id || '/question_texts' AS texts FROM {FINALS}""")
def output_files(spark: SparkSession, d: str) -> DataFrame:
    """Folders and names of what is written for each question."""
    f = _finals(spark, d)
    folders = images.document_folders(F.concat(F.lit("/data/"), F.col("upload_id").cast("string")))
    return f.select("qf_id", images.output_folder(F.lit("/out/images"), "concepts").alias("folder"), images.file_name("answer", F.col("qf_id")).alias("answer_file"), writers.question_file(F.col("qf_id"), "question").alias("question_file"), folders["tex"].alias("tex"), folders["texts"].alias("texts"))


_NAMES = f"SELECT DISTINCT upload_id, i.image_name AS name FROM (SELECT upload_id, unnest(images) AS i FROM {FINALS}) WHERE i IS NOT NULL AND i.image_name IS NOT NULL AND i.image_name <> ''"


@query(f"""WITH n AS ({_NAMES}) SELECT upload_id, name, CASE WHEN length(name) % 2 = 0 THEN '/data/' || name ELSE name END AS path, name AS back FROM n""")
def image_places(spark: SparkSession, d: str) -> DataFrame:
    """Image paths made absolute where the file exists, and relative again."""
    names = _names(spark, d)
    files = names.where(F.length("name") % 2 == 0).select(F.concat(F.lit("/data/"), F.col("name")).alias("path")).distinct()
    out = images.absolute_paths(names.withColumn("path", F.col("name")), files, F.lit("/data"))
    return out.select("upload_id", "name", "path", images.relative_path(F.col("path"), F.lit("/data")).alias("back"))


def _names(spark: SparkSession, d: str) -> DataFrame:
    rows = _finals(spark, d).select("upload_id", F.explode("images").alias("i")).where("i is not null and i.image_name <> ''")
    return rows.select("upload_id", F.col("i.image_name").alias("name")).distinct()


@query(f"""WITH n AS ({_NAMES}) SELECT upload_id || '/' || name AS src, 'images/' || name AS dst, length(name) % 3 > 0 AS "exists" FROM n""")
def copied_images(spark: SparkSession, d: str) -> DataFrame:
    """What to copy beside a document, and whether its source is there."""
    names = _names(spark, d)
    src = F.concat(F.col("upload_id").cast("string"), F.lit("/"), F.col("name"))
    files = names.where(F.length("name") % 3 > 0).select(src.alias("path"))
    return writers.copy_manifest(names.select(src.alias("src"), F.concat(F.lit("images/"), F.col("name")).alias("dst")), files)


@query("""SELECT * FROM (VALUES ('set', 1, 'a'), ('set', 1, 'b'), ('set', 1, 'c'), ('set', 1, 'p'), ('set', 2, 'd')) t(kind, k, path)""")
def output_image_paths(spark: SparkSession, d: str) -> DataFrame:
    """Every image path of a result once."""
    sets = spark.createDataFrame([(1, ["a", "b"], ["b", "c"]), (2, ["d"], [])], "k int, problem_image_paths array<string>, choices_image_paths array<string>")
    shared = spark.createDataFrame([(1, ["p", "a"])], "k int, image_paths array<string>")
    return images.output_paths(sets, shared, "k").select(F.lit("set").alias("kind"), "k", "path")


@query(f"SELECT qf_id, '\\section*{{Question ' || qf_id || CASE WHEN qf_id % 7 = 0 THEN '' ELSE ' (No. ' || (qf_id % 60) || ')' END || '}}' AS title FROM {FINALS}")
def section_titles(spark: SparkSession, d: str) -> DataFrame:
    """Titles of sections, with the printed number where there is one."""
    number = F.when(F.col("qf_id") % 7 != 0, F.col("qf_id") % 60)
    return _finals(spark, d).select("qf_id", images.section_title(F.col("qf_id"), number).alias("title"))


@query(r"""SELECT * FROM (VALUES (1, 'q1,q2 -> P.txt', 1, FALSE), (2, 'q3 -> P.txt', 0, TRUE)) t(k, head, n_figures, unavailable)""")
def passage_blocks(spark: SparkSession, d: str) -> DataFrame:
    """LaTeX blocks of shared passages with and without images."""
    df = spark.createDataFrame([(1, [1, 2], ["a.png"]), (2, [3], None)], "k int, qnos array<int>, paths array<string>")
    tex = images.passage_tex(F.lit("P"), F.get("qnos", F.lit(0)), F.element_at("qnos", -1), F.col("qnos"), F.col("paths"))
    return df.select("k", tex.alias("t")).select("k", F.regexp_extract("t", r"^% (.*)\n", 1).alias("head"), F.regexp_count("t", F.lit(r"\\includegraphics")).cast("int").alias("n_figures"), F.col("t").contains("unavailable").alias("unavailable"))


# Requests and replies


@query(f"""SELECT qf_id, len(im) AS n_images, len(im) IN (2, 3) AS ok, CAST(CASE WHEN qf_id % 2 = 0 THEN range(1, len(im) + 1) WHEN len(im) = 2 THEN [7, 8] END AS INT[]) AS ids
FROM (SELECT qf_id, list_filter(coalesce(images, []), lambda i: i IS NOT NULL) AS im FROM {FINALS}) WHERE len(im) > 0""")
def image_requests(spark: SparkSession, d: str) -> DataFrame:
    """V4 V6 V7: how many images are sent and the ids they go by."""
    im = F.filter(F.coalesce("images", F.array().cast(load(spark, d, "questions_final").schema["images"].dataType)), lambda i: i.isNotNull())
    f = _finals(spark, d).select("qf_id", im.alias("im")).where("size(im) > 0")
    given = F.when(F.col("qf_id") % 2 == 1, F.array(F.lit(7), F.lit(8)))
    return f.select("qf_id", F.size("im").cast("bigint").alias("n_images"), prompts.image_count_ok(F.col("im")).alias("ok"), prompts.question_ids(given, F.size("im")).alias("ids"))


@query(f"""WITH f AS (SELECT qf_id, question_source AS s, content AS c, list_transform(options, lambda o: CASE WHEN o IS NULL THEN NULL ELSE o.opt_order END) AS o FROM {FINALS})
SELECT qf_id, s AS source, c AS content, o AS orders, TRUE AS has_place FROM f""")
def question_requests(spark: SparkSession, d: str) -> DataFrame:
    """The context sent with each question, read back from its JSON."""
    body = prompts.filled("before {{INPUT_JSON}} after", prompts.question_context(F.col("options"), F.col("content"), F.col("question_source")))
    text = F.substring(F.col("body"), F.lit(8), F.length("body") - 13)
    f = _finals(spark, d).select("qf_id", body.alias("body")).withColumn("j", F.from_json(text, "question_source string, question_content string, options array<struct<order:int,content:string>>"))
    return f.select("qf_id", F.col("j.question_source").alias("source"), F.col("j.question_content").alias("content"), F.transform("j.options", lambda o: o["order"]).alias("orders"), (F.col("body").startswith("before {") & F.col("body").endswith("} after")).alias("has_place"))


@query("""SELECT * FROM (VALUES (1, '[{"test_id":"T","question_id":1,"question_image_urls":["a"],"option_image_urls":["b","c"]}]', '{"questions":[{"question_id":5,"image_index":1},{"question_id":6,"image_index":2}]}', 3, 'data:image/png;base64,AQI=')) t(k, answer, concept, parts, url)""")
def message_parts(spark: SparkSession, d: str) -> DataFrame:
    """Inputs of the answer and concept stages, parts of a message, image addresses."""
    row = spark.createDataFrame([(1, ["a", "b", "c"], [5, 6], bytearray([1, 2]))], "k int, paths array<string>, ids array<int>, raw binary")
    answer = F.concat(F.lit("["), prompts.answer_input(F.lit("T"), F.col("k"), F.col("paths")), F.lit("]"))
    url = T.data_url(F.col("raw"), F.lit(None).cast("string"))
    return row.select("k", answer.alias("answer"), prompts.concept_input(F.col("ids")).alias("concept"), F.size(prompts.message(F.lit("t"), F.array(url, url))).alias("parts"), url.alias("url"))


@query("""SELECT * FROM (VALUES (1, 1, 'a>b|>c'), (2, 0, ''), (3, 0, ''), (4, 0, '설명')) t(k, n, said)""")
def reply_parts(spark: SparkSession, d: str) -> DataFrame:
    """Corrections and captions of replies; what is no text says nothing."""
    rows = [(1, '[{"before":" a ","after":"b"},{"before":"","after":" "},{"after":"c","reason":null}]'), (2, "[]"), (3, '{"x":1}'), (4, '" 설명 "')]
    df = spark.createDataFrame(rows, "k int, raw string").withColumn("v", F.try_parse_json("raw"))
    fixes = F.transform(prompts.corrections(F.col("v")), lambda c: F.concat(c["before"], F.lit(">"), c["after"]))
    return df.select("k", F.least(F.size(fixes), F.lit(1)).alias("n"), F.concat(F.array_join(fixes, "|"), prompts.caption(F.col("v"))).alias("said"))


def _client():
    """An adapter that stands for a service: replies by the words of the prompt."""
    asked: dict[str, int] = {}

    def call(prompt: str) -> str:
        asked[prompt] = asked.get(prompt, 0) + 1
        if "slow" in prompt:
            raise TimeoutError("Request timed out.")
        if "refuse" in prompt:
            raise RuntimeError("refused")
        if "later" in prompt and asked[prompt] < 2:
            return "not json"
        return '```json\n{"ok": true}\n```' if "fenced" in prompt else '{"ok": true}'

    return call


@query("""SELECT * FROM (VALUES (1, 5, 2, 2, 1, 1)) t(doc, total, done, failed, skipped, timeouts)""")
def service_stage(spark: SparkSession, d: str) -> DataFrame:
    """Requests with bounded attempts, fenced replies, a breaker after two failed records, and the counts of the stage."""
    asks = spark.createDataFrame([(1, 1, "later"), (1, 2, "slow"), (1, 3, "fenced"), (1, 4, "refuse"), (1, 5, "plain")], "doc int, o int, prompt string").coalesce(1)
    tried = raster.ask(asks, ["doc", "o"], "prompt", _client)
    best = canonical.first_valid_reply(tried, ["doc", "o"])
    failed = F.col("error").isNotNull()
    calls = canonical.breaker(best.select("doc", "o", *[c for c in best.columns if c not in ("doc", "o")]), ["doc"], "o", failed, 2)
    return canonical.stage_metadata(calls, ["doc"], "o", "error").select("doc", "total", "done", "failed", "skipped", "timeouts")


@query("""SELECT * FROM (VALUES (1, 'abc'), (2, 'a b'), (3, 'x # y'), (4, 'k'), (5, ''), (6, '"')) t(k, value)""")
def setting_values(spark: SparkSession, d: str) -> DataFrame:
    """Values of setting lines, without quotes and comments."""
    rows = [(1, " abc # note"), (2, "'a b'"), (3, '"x # y"'), (4, "k"), (5, "  "), (6, '"')]
    return spark.createDataFrame(rows, "k int, raw string").select("k", T.dotenv_value(F.col("raw")).alias("value"))


@query("""SELECT * FROM (VALUES (1, ['/a b.pdf', '/c.pdf']), (2, CAST([] AS VARCHAR[]))) t(k, files)""")
def dialog_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that a dialog names, one a line."""
    return spark.createDataFrame([(1, " /a b.pdf\n\n/c.pdf \n"), (2, "\n")], "k int, out string").select("k", T.picked_files(F.col("out")).alias("files"))


# Rasters


def _raster(rows: list[str], scale: int = 1) -> tuple[int, int, bytearray]:
    """A raster of a drawing: # black, + grey, anything else white."""
    grey = {"#": 0, "+": 200}
    data = [[grey.get(c, 255) for c in row for _ in range(scale)] for row in rows for _ in range(scale)]
    return len(data[0]), len(data), bytearray(v for row in data for v in row)


def _drawings(spark: SparkSession, drawings: dict[str, list[str]], scale: int = 1) -> DataFrame:
    return spark.createDataFrame([(k, *_raster(v, scale)) for k, v in drawings.items()], "k string, w int, h int, data binary")


_INNER = {"inner": ["..........", "..##......", "..##......", ".........."], "edge": ["#.........", "#...##....", "#.........", "#........."], "blank": ["....", "...."], "grey": ["......", "..++..", "......"]}


@query("""SELECT * FROM (VALUES ('inner', 2, 1, 4, 3, 4), ('edge', 4, 1, 6, 2, 2), ('blank', NULL, NULL, NULL, NULL, 0), ('grey', 2, 1, 4, 2, 2)) t(k, x0, y0, x1, y1, n_dark)""")
def inner_boxes(spark: SparkSession, d: str) -> DataFrame:
    """The box of the dark pixels of a raster without what touches its edges."""
    return raster.dark_box(raster.without_edge_components(_drawings(spark, _INNER), "k"), "k")


@query("""SELECT * FROM (VALUES ('cut', 1, 12, 10), ('cut', 2, 12, 10), ('cut', 3, 12, 10)) t(k, strip_no, w, h)""")
def image_strips(spark: SparkSession, d: str) -> DataFrame:
    """Equal strips of one image for several questions; too low images give none."""
    df = _drawings(spark, {"cut": ["." * 12] * 30, "low": ["." * 12] * 20}).withColumn("n", F.lit(3))
    return raster.strips(df, "k", "n").select("k", "strip_no", "w", "h")


@query("""SELECT * FROM (VALUES ('b', 4, 2, 2), ('b2', 8, 4, 8)) t(k, w, h, n_black)""")
def binary_rasters(spark: SparkSession, d: str) -> DataFrame:
    """Rasters in black and white, larger ones for small print, and their dark pixels."""
    df = _drawings(spark, {"b": ["#+..", "#..."]})
    both = raster.binarised(df, "k", 180).unionByName(raster.binarised(df.withColumn("k", F.lit("b2")), "k", 180, 2))
    dark = raster.dark_box(both, "k", 0).select("k", F.col("n_dark").alias("n_black"))
    return both.join(dark, "k").select("k", "w", "h", "n_black")


@query("""SELECT * FROM (VALUES ('tall', '#'), ('comma', '#,#'), ('dot', '#.'), ('rule', ''), ('specks', '')) t(k, mask)""")
def cell_masks(spark: SparkSession, d: str) -> DataFrame:
    """Signs, commas and dots of a table cell."""
    blank = "." * 30
    tall = [blank] * 3 + ["...##......" + "." * 19] * 8 + [blank] * 3
    comma = [blank] * 3 + ["...##..........##............."] * 6 + ["...##....#.....##............."] * 2 + [blank] * 3
    dot = [blank] * 2 + ["...##....#...................."] * 1 + ["...##........................."] * 8 + [blank] * 3
    rule = [blank] * 6 + ["." * 4 + "#" * 22 + "." * 4] + [blank] * 7
    specks = [blank] * 6 + ["....#........................."] + [blank] * 7
    return raster.symbol_mask(_drawings(spark, {"tall": tall, "comma": comma, "dot": dot, "rule": rule, "specks": specks}), "k")


@query("""SELECT * FROM (VALUES ('framed', 28, 18, TRUE), ('small', 22, 12, FALSE), ('plain', 30, 20, FALSE)) t(k, w, h, trimmed)""")
def trimmed_rasters(spark: SparkSession, d: str) -> DataFrame:
    """Rasters without the rules at their edges, where enough is left."""
    df = _drawings(spark, {"framed": ["." * 30] * 20, "small": ["." * 22] * 12, "plain": ["." * 30] * 20})
    trims = spark.createDataFrame([("framed", 1, 1, 1, 1), ("small", 2, 1, 1, 2)], "k string, top int, bottom int, left int, right int")
    return raster.trimmed(df, "k", trims).select("k", "w", "h", "trimmed")


@query("""SELECT * FROM (VALUES ('narrow', 0, 40), ('wide', 0, 1000), ('wide', 1, 580), ('wide', 2, 580), ('split', 0, 40), ('split', 1, 12), ('split', 2, 12)) t(k, variant, w)""")
def reading_areas(spark: SparkSession, d: str) -> DataFrame:
    """What is read of an image: the whole, halves of wide ones, either side of a separator."""
    df = _drawings(spark, {"narrow": ["." * 40] * 4, "wide": ["." * 1000] * 4})
    split = _drawings(spark, {"split": ["." * 40] * 4}).withColumn("at", F.lit(20.0))
    return raster.reading_variants(df, "k").unionByName(raster.reading_variants(split, "k", "at")).select("k", "variant", "w")


def _reader():
    """An adapter that stands for a recogniser: what it reads depends on size, contrast and configuration."""

    def read(data: bytes, w: int, h: int, config: str) -> str:
        if "psm 8" in config:
            raise RuntimeError("no such mode")
        dark = sum(v < 128 for v in data)
        return "" if dark == 0 else f"| {dark} , {w} |" if "psm 7" in config else "가"

    return read


@query("""SELECT * FROM (VALUES (1, '72 , 24 36 , 24'), (2, '#')) t(row_no, text)""")
def table_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a choice table read by a grid of attempts, the best by score, the mask of signs where no digit is read."""
    cells = {"a": ["....", ".##.", "...."], "b": ["....", ".#..", "...."], "c": ["....", "....", "...."]}
    df = _drawings(spark, cells)
    tried = reading.attempts(df.where("k <> 'c'"), "k", _reader, scales=(2, 6), thresholds=(160, 210), configs=reading.CELL_CONFIGS)
    empty = spark.createDataFrame([("c", 1, "")], "k string, attempt int, text string")
    masks = spark.createDataFrame([("c", "#"), ("a", "#")], "k string, mask string")
    best = reading.best_cells(tried.select("k", "attempt", "text").unionByName(empty), masks, "k")
    placed = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 2, 1)], "k string, row_no int, column_no int").join(best, "k")
    return reading.cell_rows(placed.withColumn("doc", F.lit(1)), ["doc"]).select("row_no", "text")


@query("""SELECT * FROM (VALUES ('a', '| 8 , 8 |', 1, CAST(NULL AS VARCHAR)), ('c', '', NULL, CAST(NULL AS VARCHAR)), ('failures', '', NULL, 'no such mode: 2')) t(k, text, attempt, failed)""")
def region_texts(spark: SparkSession, d: str) -> DataFrame:
    """The first reading of a region that finds anything; each failure reported once."""
    df = _drawings(spark, {"a": ["....", ".##.", "...."], "c": ["....", "....", "...."]})
    tried = reading.attempts(df, "k", _reader, scales=(2,), configs=("--psm 7", "--psm 8"))
    found = reading.first_found(tried, "k").withColumn("failed", F.lit(None).cast("string"))
    counts = reading.warnings(tried).select(F.lit("failures").alias("k"), F.lit("").alias("text"), F.lit(None).cast("int").alias("attempt"), F.concat("error", F.lit(": "), F.col("n").cast("string")).alias("failed"))
    return found.select("k", "text", "attempt", "failed").unionByName(counts)


# Images of questions


@query("""SELECT * FROM (VALUES (149, 'crops/b.png'), (150, CAST(NULL AS VARCHAR)), (151, 'crops/c.png')) t(element_id, crop_path)""")
def linked_crops(spark: SparkSession, d: str) -> DataFrame:
    """Pictures of a tree with the crop of their element, the last of several."""
    tree = '{"kids":[{"type":"image","id":149},{"type":"list","list items":[{"content":"1. x","kids":[{"type":"table","id":150},{"type":"formula","id":151}]}]}]}'
    found = nodes.image_nodes(nodes.flatten(spark.createDataFrame([("d", tree)], "doc string, raw string"), "doc", "raw")).select("doc", F.col("id").alias("element_id"))
    crops = spark.createDataFrame([("d", 149, "crops/a.png", 1), ("d", 149, "crops/b.png", 2), ("d", 151, "crops/c.png", 1), ("e", 150, "no", 1)], "doc string, element_id int, crop_path string, n int")
    return nodes.link_crops(found, crops, ["doc"], "n").select("element_id", "crop_path")


@query("""SELECT * FROM (VALUES (1, 'b', ['a'], ['c']), (2, 'c', ['a'], CAST([] AS VARCHAR[])), (3, NULL, ['a'], CAST([] AS VARCHAR[]))) t(k, shared, problem, choices)""")
def shared_images(spark: SparkSession, d: str) -> DataFrame:
    """The image of a shared passage taken out of a question's images."""
    df = spark.createDataFrame([(1, ["a", "b"], ["c"]), (2, ["a"], ["c"]), (3, ["a"], [])], "k int, problem array<string>, choices array<string>")
    return df.select("k", images.take_shared_image(F.col("problem"), F.col("choices")).alias("s")).select("k", "s.*")


@query("""SELECT * FROM (VALUES (1, 'p.png', 1, 3), (2, 'p.png', 2, 3), (3, 'p.png', 3, 3)) t(question_index, path, strip_no, n_strips)""")
def synthetic_questions(spark: SparkSession, d: str) -> DataFrame:
    """Questions read from the one image of an earlier question; images with choices are not cut."""
    texts = spark.createDataFrame([(1, i) for i in range(1, 7)], "doc int, question_index int")
    sets = spark.createDataFrame([(1, 1, ["p.png"], []), (1, 4, ["q.png"], ["r.png"])], "doc int, question_index int, problem_image_paths array<string>, choices_image_paths array<string>")
    return images.synthetic_strips(texts, sets, "doc").select("question_index", "path", "strip_no", "n_strips")


@query("""SELECT * FROM (VALUES (1, 1, 1), (1, 2, 2), (1, 3, 3), (1, 4, 5), (2, 1, 7)) t(doc, o, "index")""")
def free_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Each row takes the least free index from the one it wants."""
    df = spark.createDataFrame([(1, 1, 1), (1, 2, 1), (1, 3, 0), (1, 4, 5), (2, 1, 7)], "doc int, o int, wanted int")
    return segment.free_indexes(df, "doc", "o", "wanted")


@query("""SELECT * FROM (VALUES ('a', 'a_3'), ('b', 'b'), ('c', 'c_2')) t(name, free)""")
def free_names(spark: SparkSession, d: str) -> DataFrame:
    """Folder names that are not taken."""
    wanted = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    taken = spark.createDataFrame([("a",), ("a_2",), ("c",), ("c_3",), ("bb",)], "name string")
    return writers.free_name(wanted, taken)


@query("""SELECT * FROM (VALUES (1, 'figure_p03_012.png'), (2, 'table_p100_1000.png')) t(k, name)""")
def crop_names(spark: SparkSession, d: str) -> DataFrame:
    """Names of image files; long numbers are not cut."""
    df = spark.createDataFrame([(1, "picture", 3, 12), (2, "table", 100, 1000)], "k int, kind string, page int, n int")
    return df.select("k", T.image_file_name(F.col("kind"), F.col("page"), F.col("n")).alias("name"))


# Recognised texts


@query("""SELECT * FROM (VALUES (1, '① 1 2' || chr(10) || '② 3'), (2, '①' || chr(10) || '②')) t(k, text)""")
def marked_rows(spark: SparkSession, d: str) -> DataFrame:
    """Choice marks with the recognised rows beside them."""
    df = spark.createDataFrame([(1, "①\n②", ["| 1 | 2", "3"]), (2, "①\n②", ["", "--"])], "k int, marks string, found array<string>")
    return df.select("k", images.marked_rows(F.col("marks"), F.col("found")).alias("text"))


@query("""SELECT * FROM (VALUES (1, TRUE), (2, FALSE), (3, TRUE), (4, FALSE)) t(k, ocr)""")
def preferred_readings(spark: SparkSession, d: str) -> DataFrame:
    """Whether recognised choices replace parsed ones."""
    df = spark.createDataFrame([(1, "문제", " ", "① 가"), (2, "문제", "① 나", "① 가"), (3, "문제\n① 가", "① 나", "① 가"), (4, "문제", "", "")], "k int, q string, c string, o string")
    return df.select("k", images.prefers_ocr(F.col("q"), F.col("c"), F.col("o")).alias("ocr"))


@query("""SELECT * FROM (VALUES (1, 2), (1, 3), (2, 1), (2, 2)) t(doc, n)""")
def expected_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks from the expected question on, or all of them."""
    df = spark.createDataFrame([(1, 1, 4, 5), (1, 2, 5, 5), (1, 3, 6, 5), (2, 1, 1, 9), (2, 2, 2, 9)], "doc int, n int, qno int, expected int")
    return images.from_expected(df, "doc", "n", "expected").select("doc", "n")


@query("""SELECT * FROM (VALUES (1, '7. 문제'), (2, '그대로'), (3, '12. 문제')) t(k, text)""")
def numbered_texts(spark: SparkSession, d: str) -> DataFrame:
    """Texts whose leading number is the one of their question."""
    df = spark.createDataFrame([(1, "/. 문제", 7), (2, "그대로", None), (3, "3) 문제", 12)], "k int, t string, n int")
    return df.select("k", images.with_leading_number(F.col("t"), F.col("n")).alias("text"))


@query("""SELECT * FROM (VALUES (1, '5. 나' || chr(10) || '① a' || chr(10) || '② b' || chr(10) || '③ c')) t(k, block)""")
def question_blocks(spark: SparkSession, d: str) -> DataFrame:
    """The lines of the wanted question in a recognised page."""
    df = spark.createDataFrame([(1, "4. 가\n① x\n5. 나\n① a\n② b\n③ c\n6. 다\n① y", 5)], "k int, t string, n int")
    return images.question_block(df, "k", "t", "n")


@query("""SELECT * FROM (VALUES (1, '1 2 3'), (2, '7')) t(k, best)""")
def better_rows(spark: SparkSession, d: str) -> DataFrame:
    """The better of two readings of a table row."""
    df = spark.createDataFrame([(1, "가나", "| 1 2 3"), (2, "7", "")], "k int, a string, b string")
    return df.select("k", T.better_sparse_row(F.col("a"), F.col("b")).alias("best"))


# Page columns


@query("""SELECT * FROM (VALUES (0, 22.0, 298.0), (1, 292.0, 568.0)) t(idx, x0, x1)""")
def wide_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns widened by a margin, not over their neighbours."""
    df = spark.createDataFrame([(1, 0, 40.0, 290.0), (1, 1, 300.0, 550.0)], "page int, idx int, x0 double, x1 double")
    return layout.expand_columns(df, ["page"]).select("idx", F.col("wide_x0").alias("x0"), F.col("wide_x1").alias("x1"))


@query("""SELECT * FROM (VALUES (1, 0), (2, 1), (3, 0)) t(k, column_no)""")
def nearest_columns(spark: SparkSession, d: str) -> DataFrame:
    """The column whose centre is nearest, the first of equally near ones."""
    df = spark.createDataFrame([(1, 10.0), (2, 400.0), (3, 250.0)], "k int, x double").withColumn("centres", F.array(F.lit(100.0), F.lit(400.0)))
    return df.select("k", layout.nearest_column(F.col("x"), F.col("centres")).alias("column_no"))


@query("""SELECT * FROM (VALUES (1, 314.0, CAST(290.0 AS DOUBLE)), (2, 295.0, 200.0)) t(k, right_edge, separator)""")
def safe_columns(spark: SparkSession, d: str) -> DataFrame:
    """A left column with room to the right one, and separators of pixel runs."""
    df = spark.createDataFrame([(1, 290.0, 300.0, 290.0), (2, 280.0, 300.0, 295.0)], "k int, l1 double, r0 double, x1 double")
    runs = spark.createDataFrame([(1, 10, 14), (1, 285, 295), (1, 400, 410), (2, 199, 201)], "k int, start int, end int")
    separators = columns.separator_of_runs(runs, ["k"])
    return df.join(separators, "k").select("k", columns.widen_left(F.col("l1"), F.col("r0"), F.col("x1"), F.lit(595.0)).alias("right_edge"), "separator")


@query("""SELECT * FROM (VALUES (1, 163.4, 164.4), (2, 199.0, 200.0)) t(k, p1, c0)""")
def table_splits(spark: SparkSession, d: str) -> DataFrame:
    """Where choices start above evenly spaced lone marks of a table."""
    box = lambda y: (0.0, float(y), 10.0, float(y) + 12.0)
    blocks = spark.createDataFrame([(1, "①", box(180)), (1, "②", box(200)), (1, "③", box(220)), (2, "①", box(180)), (2, "②", box(300)), (2, "③", box(310))], "k int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>")
    lead = layout.sparse_marker_shift(blocks, ["k"])
    n = lambda x: F.lit(float(x))
    all_ = spark.createDataFrame([(1,), (2,)], "k int").join(lead, "k", "left")
    split = columns.shifted_split(n(199), n(200), n(100), n(400), F.col("first_y0"), F.least("lead", n(15.6)))
    return all_.select("k", split.alias("s")).select("k", F.round("s.p1", 3).alias("p1"), F.round("s.c0", 3).alias("c0"))


@query(f"""WITH l AS (SELECT line_id, upload_id, page_number, column_index, bbox FROM {LINES} WHERE bbox IS NOT NULL)
SELECT line_id, CAST(row_number() OVER (PARTITION BY upload_id, page_number, column_index ORDER BY round_even(bbox.y0 / 4, 0), bbox.x0, bbox.y0, line_id) AS INT) AS place FROM l""")
def reading_places(spark: SparkSession, d: str) -> DataFrame:
    """Lines of a column by rows, then from left to right."""
    lines = _lines(spark, d).where("bbox is not null").withColumn("bbox", F.col("bbox"))
    keys = ["upload_id", "page_number", "column_index"]
    return columns.reading_order(lines, keys, "place", "line_id").select("line_id", "place")


# Texts and replies


@query(f"""SELECT qf_id, CASE WHEN len(n) = 0 THEN content ELSE regexp_replace(concat_ws(chr(10), nullif(content, ''), array_to_string(list_transform(n, lambda v: '[' || v || ']'), chr(10))), '^[\\s\\x{{00a0}}\\x{{2000}}-\\x{{200a}}\\x{{3000}}]+|[\\s\\x{{00a0}}\\x{{2000}}-\\x{{200a}}\\x{{3000}}]+$', '', 'g') END AS content
FROM (SELECT qf_id, content, list_filter(list_transform(coalesce(images, []), lambda i: i.image_id), lambda v: v IS NOT NULL) AS n FROM {FINALS})""")
def texts_with_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Contents with a token for each of their images."""
    ids = F.filter(F.transform(F.coalesce("images", F.array().cast(load(spark, d, "questions_final").schema["images"].dataType)), lambda i: i["image_id"]), lambda v: v.isNotNull())
    return _finals(spark, d).select("qf_id", canonical.append_tokens(F.col("content"), ids).alias("content"))


@query("""SELECT * FROM (VALUES (1, '라.', 'medium'), (2, '다', 'medium')) t(q, content, confidence)""")
def refined_questions(spark: SparkSession, d: str) -> DataFrame:
    """The last valid round of refinement and its confidence."""
    finals = spark.createDataFrame([(1, "가 ,나"), (2, "다")], "q int, content string")
    rounds = spark.createDataFrame([(1, 1, '{"content": "라 .", "confidence": "low"}'), (1, 2, '{"content": ""}')], "q int, attempt int, payload string")
    return canonical.merge_refinement(finals, rounds, ["q"]).select("q", "content", "confidence")


@query("""SELECT * FROM (VALUES (1, CAST(NULL AS VARCHAR)), (2, 'quotes'), (3, 'json')) t(q, problem)""")
def concept_replies(spark: SparkSession, d: str) -> DataFrame:
    """Why replies with concepts are refused."""
    r = spark.createDataFrame([(1, '{"concepts":[{}],"question_concept_mapping":[{"question_id":"b"},{"question_id":"a"}]}', ["a", "b"]), (2, "“x”", []), (3, "[]", [])], "q int, raw string, want array<string>")
    return canonical.valid_concepts(r, "q", "raw", "want").select("q", "problem")


@query("""SELECT * FROM (VALUES (1, 'option', 2, 'i1', 1), (2, 'question', NULL, 'i2', 0)) t(k, place, target, image_id, n_findings)""")
def caption_requests(spark: SparkSession, d: str) -> DataFrame:
    """What is sent with an image to describe, and the damage reported with a text to refine."""
    option = "struct<opt_order:int,content:string>"
    df = spark.createDataFrame([(1, "글 , , 말", [(1, "a"), (2, "b")], ("i1", "n1"), (2, "b")), (2, "글", [(1, "a")], ("i2", "n2"), None)], f"k int, content string, options array<{option}>, image struct<image_id:string,image_name:string>, option {option}")
    source = F.lit("s")
    with_option = prompts.caption_context(F.col("options"), F.col("content"), source, F.col("image"), F.col("option"))
    alone = prompts.caption_context(F.col("options"), F.col("content"), source, F.col("image"))
    findings = prompts.question_findings(F.col("content"), F.col("options"))
    refine = prompts.refine_context(F.col("content"), F.col("options"), findings)
    sent = df.select("k", F.when(F.col("option").isNotNull(), with_option).otherwise(alone).alias("j"), refine.alias("r"))
    get = F.get_json_object
    n = F.size(F.from_json(get("r", "$.artifacts"), "array<string>"))
    return sent.select("k", get("j", "$.target_image.location").alias("place"), get("j", "$.target_option.order").cast("int").alias("target"), get("j", "$.target_image.image_id").alias("image_id"), F.least(n, F.lit(1)).alias("n_findings"))
