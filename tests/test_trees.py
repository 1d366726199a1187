import json

from helpers import rows
from pyspark.sql import functions as F

from examflow.operators import nodes, passages


def items(*texts, kids=()):
    return {"type": "list", "list items": [{"type": "list item", "content": t, "kids": list(kids)} for t in texts]}


def read(spark, *kids):
    df = spark.createDataFrame([(1, json.dumps({"kids": list(kids)}))], "doc int, raw string")
    return [(r.question_number, r.question_text, [(c.number, c.text, c.image) for c in r.choices], r.images) for r in nodes.extract_questions(df, "doc", "raw").orderBy("question_index").collect()]


def test_simple_and_split_choices(spark):
    got = read(spark, items("1. 첫 번째 문제 ", kids=[{"type": "paragraph", "content": "① \\ ② > ③ : ④ $"}]), items("2. 두 번째"), {"type": "image", "id": 5}, {"type": "paragraph", "content": "① 버스형 ② 성형"}, {"type": "paragraph", "content": "③ 링형 ④ 망형"})
    assert got[0][1] == "첫 번째 문제" and [c[0] for c in got[0][2]] == [1, 2, 3, 4]
    assert [c[1] for c in got[1][2]] == ["버스형", "성형", "링형", "망형"] and got[1][3] == [5]


def test_image_choices(spark):
    img = lambda i, x: {"type": "image", "id": i, "bounding box": [x, 0, 1, 1]}
    got = read(spark, items("3. 그림"), img(209, 0), img(212, 9), img(211, 1), {"type": "paragraph", "content": "① ②"}, img(215, 9), img(214, 1), {"type": "caption", "content": "③ ④"})
    assert [(c[0], c[2]) for c in got[0][2]] == [(1, 211), (2, 212), (3, 214), (4, 215)] and got[0][3] == [209]


def test_page_split_orphans_and_order(spark):
    got = read(spark, items("32. 문제"), {"type": "list", "numbering style": "circled arabic numbers", "list items": [{"content": "① 가"}, {"content": "나"}]}, items("① 다 ② 라", "29. 앞"), {"type": "text block", "kids": [{"type": "heading", "content": "과목"}]}, {"type": "text block", "kids": [{"type": "paragraph", "content": "보기"}]})
    assert [q[0] for q in got] == [29, 32] and [c[1] for c in got[1][2]] == ["가", "나", "다", "라"] and got[0][1] == "앞\n보기"


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (2, "{}"), (3, "bad"), (4, "[]")], "doc int, raw string")
    assert nodes.extract_questions(df, "doc", "raw").count() == 0
    assert nodes.flatten(df, "doc", "raw", 3).count() == 0


def test_flatten_and_filter(spark):
    tree = {"kids": [{"type": "header", "kids": [{"type": "paragraph", "content": "h"}]}, {"type": "caption", "content": "광고"}, {"type": "caption", "content": "① 가"}, {"type": "list", "list items": [{"type": "list item", "kids": [{"type": "image", "id": 7, "page number": 2, "bounding box": [1, 2, 3, 4]}]}]}]}
    df = spark.createDataFrame([(1, json.dumps(tree))], "doc int, raw string")
    n = nodes.flatten(df, "doc", "raw", 5)
    assert n.count() == 7 and rows(nodes.image_nodes(n), "id", "page_number", "role") == [(7, 2, "kids")]
    assert rows(nodes.content_nodes(n.where(F.size("path") == 2)), "type") == [("caption",), ("list",)]


def test_markdown(spark):
    e = [(1, 1, "heading", "1과목. 컴퓨터 일반", 1, None, None), (1, 2, "heading", "문제 1", 2, None, None), (1, 3, "paragraph", "가", None, None, None), (1, 4, "paragraph", "나", None, None, None), (1, 5, "table", None, None, "./images/t.png", None), (1, 6, "caption", "", None, None, None), (1, 7, "image", None, None, None, None), (1, 8, "formula", None, None, None, "x^2")]
    df = spark.createDataFrame(e, "doc int, pos int, type string, content string, level int, image_path string, latex string")
    df = df.withColumn("md", nodes.element_markdown(F.col("type"), F.col("content"), F.col("level"), F.col("image_path"), F.lit(None).cast("string"), F.col("latex")))
    assert nodes.assemble_markdown(df, "doc", "pos").first().markdown == "# 1과목. 컴퓨터 일반\n## 문제 1\n가\n\n나\n![표](./images/t.png)\n**\n$x^2$"


def test_passages(spark):
    q = spark.createDataFrame([(1, 1, 1, "앞 글 [3 ~ 1] 다음 글을 읽고 물음에 답하시오. 지문"), (1, 2, 2, "가"), (1, 3, 9, "나"), (1, 4, None, None)], "d int, o int, qno int, t string")
    p, links = passages.shared_passages(q, "d", "o", "qno", "t")
    assert rows(links) == [(1, 1, "shared_passage_001_003"), (1, 2, "shared_passage_001_003")] and p.first().passage_text.startswith("[3 ~ 1]")
