from helpers import rows
from pyspark.sql import functions as F

from examflow.operators import columns, images, layout, prompts, raster, segment

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def test_columns(spark):
    pages = spark.createDataFrame([(1, 0.0, 290.0, 300.0, 595.0, None, [50.0, 60.0]), (2, 0.0, 290.0, 300.0, 595.0, 297.5, [50.0]), (3, 0.0, 100.0, 120.0, 595.0, None, [40.0, 320.0, 330.0]), (4, 0.0, 290.0, 300.0, 595.0, None, [50.0, 400.0])], "p int, l0 double, l1 double, r0 double, r1 double, separator double, centres array<double>")
    got = {r.p: (r.l0, r.l1, r.r0, r.r1) for r in columns.repaired_columns(pages).collect()}
    assert got == {1: (0.0, 595.0, None, None), 2: (0.0, 289.5, 305.5, 595.0), 3: (0.0, 176.0, 184.0, 595.0), 4: (0.0, 290.0, 300.0, 595.0)}
    lit = lambda *x: [F.lit(v) for v in x]
    r = spark.range(1).select(columns.safe_refine_x(*lit(0.0, 100.0, 30.0, 70.0)).alias("a"), columns.widen_left(*lit(290.0, 300.0, 290.0, 595.0)).alias("b"), columns.shifted_split(*lit(200.0, 201.0, 0.0, 400.0, 200.0, 22.0)).alias("c")).first()
    assert tuple(r.a) == (18.0, 100.0) and r.b == 314.0 and tuple(r.c) == (177.0, 178.0)


def test_page_noise_and_order(spark):
    b = spark.createDataFrame([("컴퓨터활용능력 1급", (0.0, 21.8, 9.0, 30.0)), ("식 x", (0.0, 65.0, 9.0, 70.0)), ("3과목 : 데이터베이스", (0.0, 182.0, 9.0, 190.0)), (" ", (0.0, 0.0, 1.0, 1.0)), (None, None)], f"text string, bbox {BOX}")
    assert rows(columns.without_page_noise(b), "text") == [("식 x",)]
    lines = spark.createDataFrame([(1, "b", (50.0, 10.0, 60.0, 12.0)), (1, "a", (5.0, 9.5, 20.0, 12.0)), (1, "c", (0.0, 30.0, 9.0, 32.0))], f"k int, text string, bbox {BOX}")
    assert [r.text for r in columns.reading_order(lines, ["k"]).orderBy("seq").collect()] == ["a", "b", "c"]


def test_crops(spark):
    q = spark.createDataFrame([(1, 1, 1, (0.0, 100.0, 200.0, 200.0))], f"doc int, page int, question_index int, box {BOX}")
    d = spark.createDataFrame([(1, 1, (10.0, 195.0, 30.0, 225.0)), (1, 1, (10.0, 300.0, 30.0, 320.0)), (1, 2, (10.0, 110.0, 30.0, 120.0))], f"doc int, page int, rect {BOX}")
    assert rows(columns.crops_of_questions(q, d, ["doc", "page"], "doc", 7), "element_id", "crop_path") == [(7, "crops/crop_id0007_p1.png")]
    words = spark.createDataFrame([(1, 1, (0.0, 0.0, 100.0, 100.0))] * 8, f"doc int, page int, word {BOX}")
    rects = spark.createDataFrame([(1, 1, 1, (0.0, 0.0, 10.0, 10.0)), (2, 1, 1, (90.0, 90.0, 290.0, 290.0)), (3, 1, 2, (0.0, 0.0, 1.0, 1.0))], f"rect_id int, doc int, page int, rect {BOX}")
    got = {r.rect_id: (r.n_words, r.is_text_heavy) for r in layout.text_overlap(rects, words, ["doc", "page"]).collect()}
    assert got == {1: (8, True), 2: (8, False), 3: (0, False)}


def test_shared_and_synthetic_images(spark):
    df = spark.createDataFrame([(1, ["a", "b"], ["c"]), (2, ["a"], ["c", "d"]), (3, ["a"], [])], "i int, p array<string>, c array<string>")
    got = [tuple(r.x) for r in df.select("i", images.take_shared_image(F.col("p"), F.col("c")).alias("x")).orderBy("i").collect()]
    assert got == [("b", ["a"], ["c"]), ("d", ["a"], ["c"]), (None, ["a"], [])]
    texts = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 5)], "d int, question_index int")
    sets = spark.createDataFrame([(1, 1, ["x.png"], []), (1, 5, ["y.png"], [])], "d int, question_index int, problem_image_paths array<string>, choices_image_paths array<string>")
    assert rows(images.synthetic_strips(texts, sets, "d")) == [(1, 1, "x.png", 1, 3), (1, 2, "x.png", 2, 3), (1, 3, "x.png", 3, 3)]


def test_rows_of_marks_and_blocks(spark):
    df = spark.createDataFrame([("①\n②", ["|| 1 2", ""]), ("①\n②", ["", None])], "m string, r array<string>")
    assert [r.x for r in df.select(images.marked_rows(F.col("m"), F.col("r")).alias("x")).collect()] == ["① 1 2\n②", "①\n②"]
    text = "머리\n1. 가\n@ 가\n@ 나\n@ 다\n@ 라\n2. 나"
    t = spark.createDataFrame([(1, text, 2), (2, text, None)], "k int, t string, want int")
    assert rows(images.question_block(t, "k", "t", "want")) == [(1, "2. 나"), (2, "1. 가\n@ 가\n@ 나\n@ 다\n@ 라")]
    assert spark.range(1).select(images.with_leading_number(F.lit("/. 다음"), F.lit(7))).first()[0] == "7. 다음"


def test_prompts(spark):
    import json

    df = spark.createDataFrame([([(1, "a"), (2, "b ,c")], "가", None)], "options array<struct<opt_order:int,content:string>>, content string, s string")
    r = df.select(prompts.question_context(F.col("options"), F.col("content"), F.col("s")).alias("q"), prompts.filled("x {{INPUT_JSON}} y", F.lit("{}")).alias("f"), prompts.answer_input(F.lit(1), F.lit(2), F.array(F.lit("p"), F.lit("o"))).alias("a"), prompts.concept_input(F.array(F.lit(5), F.lit(6))).alias("c"), prompts.message(F.lit("t"), F.array(F.lit("u"))).alias("m")).first()
    assert json.loads(r.q) == {"question_source": None, "question_content": "가", "options": [{"order": 1, "content": "a"}, {"order": 2, "content": "b ,c"}]} and r.f == "x {} y"
    assert json.loads(r.a) == {"test_id": 1, "question_id": 2, "question_image_urls": ["p"], "option_image_urls": ["o"]} and json.loads(r.c)["questions"][1] == {"question_id": 6, "image_index": 2}
    assert [p.type for p in r.m] == ["text", "image_url"]


def test_symbols_trims_and_statistics(spark):
    w, h = 120, 40
    a = [[255] * w for _ in range(h)]
    for x0, x1, y0, y1 in ((10, 22, 8, 32), (40, 44, 32, 36), (70, 82, 8, 32)):
        for y in range(y0, y1):
            for x in range(x0, x1):
                a[y][x] = 0
    df = spark.createDataFrame([(1, w, h, bytearray(v for r in a for v in r))], "k int, w int, h int, data binary")
    assert raster.symbol_mask(df, "k").first().mask == "#,#"
    assert raster.binarised(df, "k", 200, 2).first().w == 240
    stats = layout.pixel_stats(raster.row_statistics(df, "k"), ["k", "position"], "pixels")
    assert stats.count() == h and stats.where("position = 0").first().dark_ratio == 0
    trims = spark.createDataFrame([(1, 3, 0, 2, 0)], "k int, top int, bottom int, left int, right int")
    t = raster.trimmed(df, "k", trims).first()
    assert (t.w, t.h, t.trimmed) == (118, 37, True)
    assert raster.reading_variants(df, "k").count() == 1
    runs = segment.runs(spark.createDataFrame([(1, i) for i in (3, 4, 5, 9, 20, 21, 22)], "k int, p int"), ["k"], "p")
    assert columns.separator_of_runs(runs, ["k"]).first().separator == 4.0


def test_pipelines(spark, tmp_path):
    import json

    from examflow.plans import pipelines

    lines = [(1, i, 1, 0, t, (x, float(i), 90.0, i + 1.0)) for i, (t, x) in enumerate([("2과목 : 데이터", 10.0), ("1. 다음 중", 10.0), ("① 가 ② 나 ③ 다 ④ 라", 14.0), ("30 대의 표", 60.0), ("2. 둘째", 10.0)])]
    df = spark.createDataFrame(lines, f"upload_id long, seq int, page_number int, column_index int, text string, bbox {BOX}")
    blocks = spark.createDataFrame([(1, 1, "1 2 3 4\n② ① ③ ④")], "block_id long, upload_id long, text string")
    got = pipelines.parse_exam(df, blocks).orderBy("question_no").collect()
    assert [(r.question_no, r.subject, r.answer, len(r.choices)) for r in got] == [(1, "데이터", "②", 4), (2, "데이터", "①", 0)]
    tree = spark.createDataFrame([(1, json.dumps({"kids": [{"type": "heading", "content": "제목", "heading level": 1}, {"type": "paragraph", "content": "본문"}]}))], "d int, raw string")
    assert pipelines.to_markdown(tree, "d", "raw").first().markdown == "# 제목\n본문"
    words = spark.createDataFrame([(1, 1, (10.0, 300.0, 20.0, 308.0), "1."), (1, 1, (25.0, 301.0, 60.0, 308.0), "가"), (1, 2, (10.0, 300.0, 20.0, 308.0), "2.")], f"d int, page int, bbox {BOX}, text string")
    pages = spark.createDataFrame([(1, 1, 595.0), (1, 2, 595.0)], "d int, page int, page_width double")
    assert rows(pipelines.parse_words(words, pages, "d"), "question_number", "text") == [(1, "가")]


def test_numbers_from_1000_on_stay_whole(spark):
    from examflow.operators import canonical, passages

    image = "struct<image_id:string>"
    finals = spark.createDataFrame([(1, 1, [("x",)] * 1010, None)], f"u int, q int, images array<{image}>, options array<struct<images:array<{image}>>>")
    ids = {r.image_no: r.image_id for r in canonical.number_images(finals, "u", "q").collect()}
    assert len(set(ids.values())) == 1010 and (ids[7], ids[100], ids[1000]) == ("image007", "image100", "image1000")
    texts = spark.createDataFrame([(1, "s", 1000, 5, "t", "c"), (1, "s", None, 5, "t", "c")], "d int, stem string, question_index int, qno int, question_text string, choices_text string")
    pictures = spark.createDataFrame([], "d int, question_index int, image_qno int, problem_image_paths array<string>")
    got = {r.question_index: r.record_id for r in passages.db_records(texts, pictures, "d", "stem").collect()}
    assert got[1000].startswith("s:1000:5:") and got[None] is None
