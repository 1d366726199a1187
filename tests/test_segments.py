import random

from helpers import rows
from pyspark.sql import functions as F

from examflow.operators import answers, layout, segment

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def lines(spark, texts):
    return spark.createDataFrame([(1, i, 1, t, (1.0, float(i), 2.0, i + 1.0) if i % 3 else None) for i, t in enumerate(texts)], f"upload_id long, seq int, page_number int, text string, bbox {BOX}")


def test_build_questions(spark):
    df = lines(spark, ["머리", "1. 첫 문제", "계속", "- 3 -", None, "", "2. 둘째", "① 가 ② 나", "1. 다시"])
    got = rows(segment.build_questions(df), "island", "question_number", "n_lines", "text")
    assert got == [(1, 1, 2, "첫 문제 계속"), (2, 2, 2, "둘째 ① 가 ② 나"), (3, 1, 1, "다시")]
    assert segment.build_questions(df.limit(0)).count() == 0
    assert rows(segment.build_questions(df.repartition(5)), "island", "text") == rows(segment.build_questions(df.coalesce(1)), "island", "text")


def test_ocr_chunks_and_renumbering(spark):
    df = spark.createDataFrame([(1, "서문\n1. 가\n나\n2. 다"), (2, "번호 없음\n줄"), (3, ""), (4, None)], "k int, t string")
    assert rows(segment.ocr_chunks(df, "k", "t")) == [(1, 1, 1, "1. 가\n나"), (1, 2, 2, "2. 다"), (2, 0, None, "번호 없음\n줄")]
    nums = [1, 2, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13]
    c = spark.createDataFrame([(1, i, n) for i, n in enumerate(nums)] + [(2, i, n) for i, n in enumerate([1, 2, 3, 4, 5, 9])], "k int, o int, qno int")
    got = {(r.k, r.o): r.new_qno for r in segment.renumber_shifted(c, "k", "o").collect()}
    assert [got[1, i] for i in range(12)] == list(range(1, 13)) and [got[2, i] for i in range(6)] == [1, 2, 3, 4, 5, 9]


def test_split_and_best(spark):
    df = spark.createDataFrame([(1, 0, "7. 다음 중 옳은 것은 무엇인가 고르시오\n① 가\n② 나"), (1, 1, "1. 다음 중 옳은 것은 무엇인가 고르시오\n① 가\n② 나")], "k int, o int, t string")
    got = segment.best_candidate(df, ["k"], "t", "o").first()
    assert got.best_text.startswith("1.") and got.n_candidates == 2
    s = segment.split_at_choices(df.where("o = 0"), "t").first()
    assert s.question_text.startswith("7.") and s.choices_text == "① 가\n② 나"


def test_line_groups_follow_the_running_mean(spark):
    words = [(1, 0, 10.0 * i, y, 10.0 * i + 5, y + 8, f"w{i}") for i, y in enumerate([100.0, 102.0, 104.0, 106.0, 120.0])]
    df = spark.createDataFrame(words, "page int, col int, x0 double, y0 double, x1 double, y1 double, text string")
    got = rows(segment.line_groups(df, ["page", "col"]), "text", "y0", "y1")

    def brute():
        groups = []
        for w in sorted(words, key=lambda w: (w[3], w[2])):
            if groups and abs(w[3] - sum(x[3] for x in groups[-1]) / len(groups[-1])) <= 3.0:
                groups[-1].append(w)
            else:
                groups.append([w])
        return sorted((" ".join(x[6] for x in sorted(g, key=lambda x: x[2])), min(x[3] for x in g), max(x[5] for x in g)) for g in groups)

    assert got == brute()


def test_anchor_segments(spark):
    df = spark.createDataFrame([(1, "45. 가\n나\n46. 다\n99 라"), (2, ""), (3, None)], "k int, t string")
    assert rows(segment.split_by_anchor(df, "k", "t")) == [(1, 1, "45. 가\n나"), (1, 2, "46. 다\n99 라")]


def test_free_indexes_and_runs(spark):
    df = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (1, 2, 2), (1, 3, 1)], "k int, o int, p int")
    assert rows(segment.free_indexes(df, "k", "o", "p"), "o", "index") == [(0, 1), (1, 2), (2, 3), (3, 4)]
    r = random.Random(1)
    places = sorted({r.randrange(60) for _ in range(30)})
    want, start = [], None
    for i, p in enumerate(places):
        start = p if start is None else start
        if i + 1 == len(places) or places[i + 1] != p + 1:
            want.append((start, p))
            start = None
    got = segment.runs(spark.createDataFrame([(1, p) for p in places * 2], "k int, p int"), ["k"], "p")
    assert rows(got, "start", "end") == sorted(want, key=repr)


def test_answers(spark):
    df = spark.createDataFrame([(1, "1 2 3 4 5\n4 1 모두답 2,4 3"), (2, "1.① 2.③ 3.모두답 4.2,4"), (3, None), (4, "1 ② 2 ③")], "k int, t string")
    grid = {(r.k, r.qno): r.answer for r in answers.grid_answers(df, "k", "t").collect()}
    assert [grid[1, i] for i in range(1, 6)] == ["④", "①", "모두답", "②,④", "③"] and grid[4, 1] == "②" and grid[4, 2] == "③"
    inline = {(r.k, r.qno): r.answer for r in answers.inline_answers(df, "k", "t").collect()}
    assert [inline[2, i] for i in range(1, 5)] == ["①", "③", "모두답", "②,④"]


def test_columns(spark):
    left, right = [(22.8, 0.0, 280.0, 9.0)] * 3, [(301.9, 0.0, 560.0, 9.0)] * 3
    one = [(x, 0.0, 500.0, 9.0) for x in (22.8, 24.0, 26.0, 28.0)]
    df = spark.createDataFrame([(1, b) for b in left + right] + [(2, b) for b in one] + [(3, None)], f"page int, bbox {BOX}")
    got = {r.page: r for r in layout.columns_by_starts(df, ["page"]).collect()}
    assert got[1].n_columns == 2 and 280 > got[1].separator > 22.8 and got[2].n_columns == 1
    wide = {r.page: r for r in layout.columns_by_centres(df, ["page"]).collect()}
    assert wide[1].n_columns == 2 and wide[1].l1 < wide[1].r0 and (wide[2].l0, wide[2].l1) == (0.0, 595.0)


def test_spans_and_clips(spark):
    starts = spark.createDataFrame([(1, 0, 0, 10.0, 1), (1, 0, 1, 50.0, 2)], "d int, page int, col int, y0 double, qno int")
    cells = spark.createDataFrame([(1, 0, 0, 100.0), (1, 0, 1, 100.0), (1, 1, 0, 100.0)], "d int, page int, col int, page_height double")
    assert rows(segment.question_spans(starts, cells, "d"), "index", "page", "col", "start_y", "end_y") == [(1, 0, 0, 10.0, 100.0), (1, 0, 1, 0.0, 50.0), (2, 0, 1, 50.0, 100.0), (2, 1, 0, 0.0, 100.0)]
    s = spark.range(1).select(layout.split_clip(F.lit(18.8), F.lit(195.0), F.lit(None).cast("double")).alias("a"), layout.split_clip(F.lit(0.0), F.lit(300.0), F.lit(180.0)).alias("b")).first()
    assert tuple(s.a) == (18.8, 195.0, None, None) and tuple(s.b) == (0.0, 179.0, 180.0, 300.0)


def test_best_spans(spark):
    spans = spark.createDataFrame([(1, 0, 20, 5), (1, 20, 40, 1), (1, 40, 90, 9), (1, 90, 110, 0), (1, 110, 160, 7), (1, 160, 165, 99)], "k int, start int, end int, score int")
    assert rows(layout.best_spans(spans, ["k"], 3, 10), "start", "end") == [(0, 20), (110, 160), (40, 90)]
