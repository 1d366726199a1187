import pytest

from examflow.llm import scannoise as S

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"


def test_lines():
    judge = S.Judge({"#년제#회체육지도자격필기", "PracticeBookletFormA"})
    kept, header, pageno = judge.lines("본문 하나\n※ 2013년 제4회 체육지도자격 필기  [C형]\n- 9 -\r\n둘째 줄")
    assert kept == ["본문 하나", "둘째 줄"] and header and pageno
    assert judge.lines("이 글은 2013년 제4회 체육지도자격 필기 자료에서") == (["이 글은 2013년 제4회 체육지도자격 필기 자료에서"], False, False)
    for page in ("— 1 —", "[9]", "10쪽", "p. 7", "Page 9", "4 / 24", "· 4 ·", "( 5 )", "-3-", "12"):
        assert judge.lines(page) == ([], False, True), page
    for text in ("31 32 33 34 35", "① 가", "3. 다음", "12점"):
        assert judge.lines(text)[2] is False, text


def test_learned_page_numbers_and_grids():
    judge = S.Judge({S.PAGE + "<#>"})
    assert judge.lines("본문\n< 12 >\n끝") == (["본문", "끝"], False, True)
    assert S.Judge(set()).lines("본문\n< 12 >")[2] is False
    assert judge.lines("31\n32\n33\n가") == (["31", "32", "33", "가"], False, False)
    assert judge.lines("가\n31\n나\n32") == (["가", "나"], False, True)


def test_soft_hyphen_at_a_line_end():
    kept, _, _ = S.Judge(set()).lines("photo\u00ad\nsynthesis in\u00adside")
    assert S.join_split(kept) == "photosynthesis inside"


def test_split_words():
    assert S.join_split(["느린 sport psych-", "ology와"]) == "느린 sport psychology와"
    assert S.join_split(["demonstra‐ ", "tes"]) == "demonstrates"
    assert S.join_split(["끝이다.", "둘째"]) == "끝이다.\n둘째"


@pytest.fixture(scope="module")
def found(spark):
    base = "다음 설명으로 옳은 것은 무엇인가 photosynthesis 값을 구하라"
    rows = [("t", i, base) for i in range(60)]
    rows += [("t", 100, base.replace("것은", "젓은")), ("t", 101, base.replace("photosynthesis", "ph0tosynthesis")), ("t", 102, base.replace("photosynthesis", "photosynthcsis"))]
    rows += [("t", 103, "② 나\n© 다"), ("t", 104, "하▯모 값"), ("t", 105, None), ("t", 106, ""), ("t", 107, base + "\n3쪽"), ("t", 108, base.replace("photosynthesis", "photo-\nsynthesis")), ("t", 109, base + " 가" * 100_000)]
    rows += [("t", 110, base + "\n2013년 제4회 시험 필기"), ("t", 110, base + "\n2013년 제4회 시험 필기")]
    df = spark.createDataFrame(rows, "table_name string, row_key long, text string")
    blocks = spark.createDataFrame([(u, 841.9, (1.0, 20.0, 2.0, 30.0), "2014년 제1회 시험 필기") for u in range(3)] + [(1, None, None, "x"), (1, 800.0, (0.0, 10.0, 1.0, 12.0), None)], f"upload_id long, page_height double, bbox {BOX}, text string")
    return S.Repair(df, blocks)


def test_found(found):
    got = {}
    for r in found.found().collect():
        got.setdefault(r.row_key, set()).add(r.noise_kind)
    assert got == {100: {"misread"}, 101: {"misread"}, 102: {"misread"}, 103: {"misread"}, 104: {"misread"}, 107: {"pageno"}, 108: {"hyphen"}, 110: {"header"}}


def test_repaired(found):
    got = {r.row_key: r.text for r in found.repaired().collect()}
    base = got[0]
    assert got[100] == got[101] == got[102] == got[107] == got[108] == got[110] == base
    assert got[103] == "② 나\n② 다" or got[103].startswith("② 나\n")
    assert 105 in got and got[105] is None and got[106] == "" and len(got[109]) > 200_000


def test_open_positions(spark):
    base = "빛을 받는 photosynthesis 과정은 광합성이다"
    rows = [("t", i, base) for i in range(30)] + [("t", 50, "빛을 받는 photosynthes▯s 과정은 광�성이다"), ("t", 51, "빛을 받는 ph0tosynth□sis 과정은 광합성이다"), ("t", 52, "모르는 돌▯말 xq▯z")]
    df = spark.createDataFrame(rows, "table_name string, row_key long, text string")
    blocks = spark.createDataFrame([], f"upload_id long, page_height double, bbox {BOX}, text string")
    r = S.Repair(df, blocks)
    got = {x.row_key: x.text for x in r.repaired().collect()}
    assert got[50] == got[51] == base and got[52] == "모르는 돌▯말 xq▯z"
    assert sorted(map(tuple, r.found().collect())) == [("t", i, "misread") for i in (50, 51, 52)]


def test_many_forms_are_joined(spark, monkeypatch):
    rows = [("t", 1, "본문\n※ 2013년 제4회 시험 필기\n- 3 -\n끝"), ("t", 2, "가\n< 4 >"), ("t", 3, None), ("t", 1, "본문\n※ 2013년 제4회 시험 필기\n- 3 -\n끝")]
    df = spark.createDataFrame(rows, "table_name string, row_key long, text string")
    margin = [(u, 841.9, (1.0, 20.0, 2.0, 30.0), x) for u in range(3) for x in ("2014년 제1회 시험 필기", f"<{u}>")]
    blocks = spark.createDataFrame(margin, f"upload_id long, page_height double, bbox {BOX}, text string")
    results = []
    for limit in (S.MAX_FORMS, 0):
        monkeypatch.setattr(S, "MAX_FORMS", limit)
        r = S.Repair(df, blocks)
        results.append((sorted(map(tuple, r.found().collect())), sorted(map(tuple, r.repaired().collect()), key=repr)))
    assert results[0] == results[1] == ([("t", 1, "header"), ("t", 1, "pageno"), ("t", 2, "pageno")], [("t", 1, "본문 끝"), ("t", 2, "가"), ("t", 3, None)])


def test_empty(spark):
    df = spark.createDataFrame([], "table_name string, row_key long, text string")
    blocks = spark.createDataFrame([], f"upload_id long, page_height double, bbox {BOX}, text string")
    assert S.Repair(df, blocks).found().count() == 0
