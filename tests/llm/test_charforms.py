import unicodedata

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from examflow.llm import charforms as C


def test_kinds():
    assert C.plain_form("agenсу power") == ("agency power", ["script"])
    assert C.plain_form("１． 다음") == ("1. 다음", ["width"])
    assert C.plain_form(unicodedata.normalize("NFD", "각 é")) == ("각 é", ["decomposed"])
    assert C.plain_form("a​b­c") == ("abc", ["invisible"])
    assert C.plain_form("a b　c") == ("a b c", ["space"])
    assert C.plain_form("TCР 연결") == ("TCP 연결", ["script"])


def test_what_stays():
    for text in ("①②③ Ⅱ x² α 입자 Ω 단위 Α 입자 Fréchet ㅋㅋ", "слово Ελληνικά", "a\nb\r\nc", "\U0001f469‍\U0001f3eb 수업", "", "-¬‐—▯"):
        assert C.plain_form(text) == (text, [])


def test_whole_script_confusable():
    assert C.plain_form("ТСР")[0] == "TCP"
    assert C.plain_form("시험 сахар")[0] == "시험 caxap"
    for text in ("купить сахар", "русский хор и ухо", "это ТСР"):
        assert C.plain_form(text) == (text, [])


def test_mixed_words_take_the_script_that_fits():
    for text, want in (("Привeт", "Привет"), ("Mосква", "Москва"), ("αpple", "apple"), ("Ελλαδa", "Ελλαδα"), ("ſtop ⅼoop ʏes", "stop loop yes"), ("𝐇𝐞𝐥𝐥𝐨 𝟏", "Hello 1"), ("ΤСP", "TCP"), ("TСР", "TCP"), ("слово TСР", "слово ТСР"), ("лgl", "лgl")):
        assert C.plain_form(text)[0] == want, text
    for text in ("αx + βy", "μs", "Type Ⅱ, ⅱ)", "Δt", "ɡɑ"):
        assert C.plain_form(text) == (text, []), text


def test_sets():
    assert C.scripts_of("а") == {"Cyrillic"} and set(C.readings("а")) == {"Latin", "Greek", "Cyrillic"}
    assert C.proved_scripts(["слово", "ТСР"]) == {"Cyrillic"} and C.proved_scripts(["ТСР", "x"]) == set()


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_idempotent(text):
    once = C.plain_form(text)[0]
    assert C.plain_form(once)[0] == once


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_unsuspicious_text_is_plain(text):
    import re

    if not re.search(C.SUSPICIOUS, text):
        assert C.plain_form(text) == (text, [])


def test_frames(spark):
    long = "가나다 " * 50_000 + "​"
    df = spark.createDataFrame([(1, None, "k"), (2, "", "k"), (3, "aсb", "k"), (3, "aсb", "k"), (4, long, "k")], "id int, text string, kinds string")
    got = {r.id: r for r in C.with_plain_form(df, "text", "plain", "found").collect()}
    assert got[1].plain is None and got[1].found == [] and got[2].plain == "" and got[3].plain == "acb" and got[3].found == ["script"]
    assert got[4].plain == long[:-1] and got[4].kinds == "k" and len(got) == 4
    assert C.with_plain_form(df.limit(0), "text", "plain", "found").count() == 0
    assert C.with_plain_form(df, "text", "text").where(F.col("id") == 3).count() == 2


def test_fold_for_match():
    assert C.fold_for_match("① Ａbс, 가 나-1!") == "abc가나1"
