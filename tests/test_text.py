import pytest
from helpers import rows
from pyspark.sql import functions as F

from examflow.functions import text as T


def one(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_numbers(spark):
    assert one(spark, T.question_number, "1. 문제", "11 문제", "3) 문제", "① 가", "본문", "10 20") == [1, 11, 3, None, None, None]
    assert one(spark, T.strip_question_number, "1. 첫 번째 문제", "본문 ") == ["첫 번째 문제", "본문"]
    assert one(spark, T.ocr_question_number, "7.다음", "/. 다음", "다음") == [7, 7, None]
    assert one(spark, T.is_legacy_question_start, "문 3 다음", "제 4 문 다음", "5번 다음", "6) 다음", "1)))}", "101. 다음") == [True, True, True, True, False, False]


def test_choices(spark):
    got = one(spark, T.split_choices, "다음 중? ① 첫째 ② 둘째 ③ 셋째 ④ 넷째", "없음", "")
    assert [(c.number, c.text) for c in got[0]] == [(1, "첫째"), (2, "둘째"), (3, "셋째"), (4, "넷째")] and got[1] == [] and got[2] == []
    assert one(spark, T.stem_before_choices, "다음 중? ① 첫째") == ["다음 중? "]
    assert one(spark, T.is_label_only, "① ②", "① 가", " ") == [True, False, False]
    assert one(spark, lambda c: T.is_marker_only(c, 2), "①\n②\n③\n④", "①", "① 가\n②") == [True, False, False]


def test_subject_and_answers(spark):
    assert one(spark, T.detect_subject, "2과목 : 소프트웨어 개발", "제 과목 3. 데이터", "본문") == ["소프트웨어 개발", "데이터", None]
    assert one(spark, T.normalize_answer, "4", "2,4", "모두답", "②", "") == ["④", "②,④", "모두답", "②", ""]
    assert one(spark, T.correct_orders, "②,④", "2, 4", "모두답", None) == [[2, 4], [2, 4], [], []]


def test_text_repair(spark):
    assert one(spark, T.repair_text, "가 , 나.다  라") == ["가, 나. 다 라"]
    assert one(spark, T.escape_latex, r"a_b{c}\d") == [r"a\_b\{c\}\textbackslash{}d"]
    assert one(spark, T.collapse, "  a  b\n", None) == ["a b", None]
    assert one(spark, T.normalize_stem, "다음 중\nRAID\n옳은") == ["RAID 다음 중\n옳은"]
    assert one(spark, lambda c: F.size(T.artifacts(c)), "조회인출입금송금의 , , , 기능", "정상") == [1, 0] or one(spark, lambda c: F.size(T.artifacts(c)), "조회인출입금송금의 , , , 기능", "정상")[0] >= 1


def test_sparse_and_appendix(spark):
    assert one(spark, T.sparse_row, "|| 123,456 | #.#", "- a") == ["123,456 #.#", "a"]
    df = spark.createDataFrame([("가나다", "12 #.#"), ("1 2", "3 4 5")], "a string, b string")
    assert [r.x for r in df.select(T.better_sparse_row(F.col("a"), F.col("b")).alias("x")).collect()] == ["12 #.#", "3 4 5"]
    appendix = "전자문제집 CBT란?\n최신 수정된\n1 2 3 4 5 6\n7 8 9 10 11 12"
    assert one(spark, T.is_appendix, appendix, "① 가\n② 나\n③ 다\n④ 라", "숫자 1 2 3", None, "") == [True, False, False, False, False]


@pytest.mark.parametrize("total, left, right, want", [(12, 6, 6, (6, 6)), (11, 0, 0, (6, 5))])
def test_column_counts(spark, total, left, right, want):
    got = spark.range(1).select(T.column_counts(F.lit(total), F.lit(left), F.lit(right)).alias("x")).first().x
    assert (got.left, got.right) == want


def test_column_counts_rebalance(spark):
    got = spark.range(1).select(T.column_counts(F.lit(10), F.lit(2), F.lit(20)).alias("x")).first().x
    assert got.left + got.right == 10 and got.left >= 1 and got.right >= 1


def test_json_and_names(spark):
    got = one(spark, lambda c: T.json_object(c).isNotNull(), '{"a":1}', "```json\n{}\n```", "[1]", "not-json", None)
    assert got == [True, True, False, False, False]
    df = spark.createDataFrame([("table", 1, 1), ("picture", 2, 3)], "k string, p int, i int")
    assert rows(df.select(T.image_file_name(F.col("k"), F.col("p"), F.col("i")).alias("n"))) == [("figure_p02_003.png",), ("table_p01_001.png",)]
