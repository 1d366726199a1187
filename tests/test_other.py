import os

from helpers import rows
from pyspark.sql import functions as F

from examflow.operators import canonical, raster
from examflow.sources import readers, writers


def picture(spark):
    w, h = 12, 10
    a = [[255] * w for _ in range(h)]
    for y in range(h):
        a[y][0] = 0  # a rule at the edge
    for y in range(3, 6):
        for x in range(4, 8):
            a[y][x] = 10
    return spark.createDataFrame([(1, w, h, bytearray(v for row in a for v in row)), (2, 2, 2, bytearray([255] * 4))], "k int, w int, h int, data binary")


def test_raster(spark):
    df = picture(spark)
    assert rows(raster.dark_box(df, "k")) == [(1, 0, 0, 8, 10, 22), (2, None, None, None, None, 0)]
    assert rows(raster.dark_box(raster.without_edge_components(df, "k"), "k")) == [(1, 4, 3, 8, 6, 12), (2, None, None, None, None, 0)]
    got = raster.strips(spark.createDataFrame([(1, 3, 30, bytearray(90), 3), (2, 3, 20, bytearray(60), 3)], "k int, w int, h int, data binary, n int"), "k", "n")
    assert rows(got, "k", "strip_no", "h") == [(1, 1, 10), (1, 2, 10), (1, 3, 10)]


def test_readers_in_order(spark):
    def made():
        def broken(_):
            raise RuntimeError

        return [broken, lambda d: "" if d == b"a" else "x", lambda d: " y "]

    df = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"b"))], "k int, data binary")
    assert rows(raster.read_text(df, "k", made)) == [(1, "y", 2), (2, "x", 1)]


def test_asking_with_retries(spark):
    def client():
        seen = {}

        def call(prompt):
            seen[prompt] = seen.get(prompt, 0) + 1
            if prompt == "fail":
                raise TimeoutError("timed out")
            return "not-json" if seen[prompt] == 1 else '{"ok": true}'

        return call

    df = spark.createDataFrame([(1, "a"), (2, "fail")], "q int, prompt string")
    got = canonical.first_valid_reply(raster.ask(df, ["q"], "prompt", client), ["q"])
    assert rows(got) == [(1, '{"ok": true}', 2, None), (2, None, 3, "timed out")]


def test_sources_and_sinks(spark, tmp_path):
    folder = tmp_path / "img"
    folder.mkdir()
    for n in ("question_002_choices_part_1.png", "question_002_problem_part_2.png", "question_002_problem_part_1.png", "question_001_x.JPG", "other.txt"):
        (folder / n).write_bytes(b"x")
    groups = readers.question_image_groups(readers.image_files(spark, str(folder)))
    assert rows(readers.resume_from(groups, 2)) == [(2, ["question_002_problem_part_1.png", "question_002_problem_part_2.png", "question_002_choices_part_1.png"])]
    texts = spark.createDataFrame([("a/q001.md", "가"), ("a/q002.md", None)], "name string, text string")
    assert rows(writers.text_files(texts, str(tmp_path / "out"), "name", "text")) == [("a/q001.md", 3), ("a/q002.md", 0)]
    assert (tmp_path / "out/a/q001.md").read_text() == "가" and sorted(os.listdir(tmp_path / "out/a")) == ["q001.md", "q002.md"]
    writers.json_lines(texts, str(tmp_path / "lines"))
    assert spark.read.json(str(tmp_path / "lines")).count() == 2
    taken = spark.createDataFrame([("a",), ("a_2",), ("b_7",)], "name string")
    want = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    assert rows(writers.free_name(want, taken)) == [("a", "a_3"), ("b", "b"), ("c", "c")]


def test_streaming(spark, tmp_path):
    from examflow.streaming import arrivals

    schema = "line_id long, upload_id long, seq int, page_number int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>"
    rows_ = [(1, 1, 0, 1, "1. 가", None), (1, 1, 0, 1, "1. 가", None), (2, 1, 1, 1, "나", None)]
    spark.createDataFrame(rows_, schema).write.parquet(str(tmp_path / "in"))
    q = arrivals.write_questions(readers.arriving_lines(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "question_number", "text") == [(1, "가 나")]


def test_an_upload_in_two_files(spark, tmp_path):
    from examflow.streaming import arrivals

    schema = "line_id long, upload_id long, seq int, page_number int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>"
    parts = [[(1, 1, 0, 1, "1. 가", None), (3, 2, 0, 1, "5. 라", None)], [(2, 1, 1, 1, "나", None), (4, 1, 2, 1, "2. 다", None)]]
    for part in parts:
        spark.createDataFrame(part, schema).write.mode("append").parquet(str(tmp_path / "in"))
        arrivals.write_questions(readers.arriving_lines(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    got = arrivals.latest_questions(spark.read.parquet(str(tmp_path / "out")))
    assert rows(got, "upload_id", "question_number", "text") == [(1, 1, "가 나"), (1, 2, "다"), (2, 5, "라")]


def test_entry_contract():
    import __spark_entry__ as e

    q, sql = e.queries(), e.oracle_sql()
    assert set(sql) <= set(q) and "p5_found" in q and len(q) > 40


def test_metadata(spark):
    image = "struct<image_id:string,image_name:string,image_caption:string>"
    schema = f"d int, q int, images array<{image}>, options array<struct<opt_order:int,is_correct:boolean,content:string,images:array<{image}>,option_explanation:string>>"
    i = ("x", None, None)
    df = spark.createDataFrame([(1, 1, [i, None], [(1, False, "", [i], "")]), (1, 2, None, None), (2, 1, [], [(1, True, "", None, "")])], schema)
    assert rows(canonical.document_metadata(df, "d")) == [(1, 2, 2, True), (2, 1, 0, False)]
    assert rows(canonical.number_images(df, "d", "q"), "q", "option_pos", "image_pos", "image_id") == [(1, 0, 1, "image001"), (1, 1, 1, "image002")]
    assert spark.range(1).select(canonical.append_tokens(F.lit("가"), F.array(F.lit("image001")))).first()[0] == "가\n[image001]"
