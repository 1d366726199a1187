import json

import pytest
from helpers import rows

from examflow.operators import canonical, nested

IMG = {"image_id": "i", "image_name": "n.png"}


def tables(spark, payloads):
    df = spark.createDataFrame([(i, p, "clash") for i, p in enumerate(payloads)], "record_id long, payload string, record_key string")
    return nested.FlatTables(df)


def places(spark, *payloads):
    return rows(tables(spark, [p if p is None or isinstance(p, str) else json.dumps(p) for p in payloads]).images(), "record_key", "question_pos", "option_pos", "image_pos")


def test_shapes(spark):
    q = {"content": "가", "images": [None, IMG], "options": [{"order": 1, "images": IMG}, None, {"image": IMG, "images": [IMG, IMG]}]}
    assert places(spark, {"questions": [q]}) == [(0, 1, 0, 2), (0, 1, 1, 1), (0, 1, 3, 1), (0, 1, 3, 1), (0, 1, 3, 2)]
    keyed = {"sections": [{"questions": [{"choices": {"2": {"assets": [IMG]}, "10": {"assets": [IMG]}}}]}, {"questions": json.dumps([{"assets": [IMG]}])}]}
    assert places(spark, keyed) == [(0, 1, 10, 1), (0, 1, 2, 1), (0, 2, 0, 1)]
    assert places(spark, {"result": {"questions": [{"options": json.dumps([{"images": json.dumps([IMG])}])}]}}) == [(0, 1, 1, 1)]


def test_first_name_wins(spark):
    assert places(spark, {"questions": [{"images": [], "assets": [IMG], "options": [{"images": None, "assets": [IMG]}], "choices": [{"images": [IMG, IMG]}]}]}) == [(0, 1, 1, 1)]


def test_invalid_and_empty(spark):
    good = {"questions": [{"images": [IMG]}]}
    text = json.dumps(good)
    assert places(spark, None, "", "not json", text[:-3], text + " x", text + text, "[]", "3", good, {"questions": None}, {"questions": []}) == [(8, 1, 0, 1)]
    assert places(spark) == []


def test_repeated_delivery_and_keys(spark):
    text = json.dumps({"questions": [{"stem": "가", "images": [IMG], "options": [{"label": "②", "text": "나"}, {"number": "3"}]}, {"text": "다", "question_source": {"exam": {"exam_id": "E", "title": "T"}, "question_no": 4, "pages": [{"page": 2, "column": "left"}]}}]})
    df = spark.createDataFrame([(7, text), (7, text)], "record_id long, payload string")
    t = nested.FlatTables(df)
    assert rows(t.questions(), "question_key", "content") == [("7/1", "가"), ("7/2", "다")]
    assert rows(t.options(), "option_key", "question_key", "number", "content") == [("7/1/1", "7/1", 2, "나"), ("7/1/2", "7/1", 3, None)]
    assert rows(t.images(), "parent_key", "image_pos") == [("7/1", 1)]
    assert rows(t.sources(), "question_key", "exam_id", "question_no") == [("7/2", "E", 4)]
    assert rows(t.source_pages()) == [("7/2", 1, 2, "left")]


def test_wrappers_of_other_kinds_hide_nothing(spark):
    good = {"result": {"sections": [{"questions": [{"images": [IMG]}]}]}}
    assert places(spark, good, {"result": "ok"}, [1], json.dumps(json.dumps(good))) == [(0, 1, 0, 1), (3, 1, 0, 1)]


def test_any_depth(spark):
    deep, bare = {"questions": [{"images": [IMG]}]}, {"meta": 1}
    for _ in range(8):
        bare = [bare]
    deep = {"a": 1, "sections": [{"result": json.dumps({"result": deep})}]}
    assert places(spark, deep, {"sections": "x"}, bare) == [(0, 1, 0, 1)]
    for _ in range(nested.MAX_LEVELS):
        deep = [deep]
    with pytest.raises(ValueError, match="levels deep"):
        places(spark, deep)


def test_no_record_hides_another(spark):
    one = {"questions": [{"content": "가", "images": [IMG]}]}
    assert places(spark, {"a": [one]}, {"a": 5}) == [(0, 1, 0, 1)]
    assert places(spark, {"result": json.dumps({"data": one})}) == [(0, 1, 0, 1)]
    both = {"questions": [{"images": [IMG]}], "annex": {"questions": [None, {"images": [IMG]}]}}
    assert places(spark, both, {"annex": "x"}) == [(0, 1, 0, 1), (0, 3, 0, 1)]


def test_child_tables(spark):
    df = spark.createDataFrame([(1, json.dumps({"sections": [{"title": "t", "questions": [None, {"content": "가", "n": 1}]}], "tags": ["a"]})), (1, json.dumps({"sections": [{"title": "t", "questions": [None, {"content": "가", "n": 1}]}], "tags": ["a"]})), (2, json.dumps({"sections": {"title": "u", "questions": {"3": {"content": "나"}}}}))], "record_id long, payload string")
    t = nested.FlatTables(df)
    assert {"/sections", "/sections/questions", "/tags"} <= set(t.schema)
    assert rows(t.child_table("/sections")) == [("1/sections:1", "1", 1, 1, "t"), ("2/sections:1", "2", 2, 1, "u")]
    got = t.child_table("/sections/questions")
    assert rows(got, "node_key", "parent_key", "ordinal", "content", "n") == [("1/sections:1/questions:2", "1/sections:1", 2, "가", 1), ("2/sections:1/questions:3", "2/sections:1", 3, "나", None)]
    assert nested.fields_of("OBJECT<a: BIGINT, `b: c`: STRING, d: OBJECT<x: BIGINT, y: ARRAY<STRING>>, e: DECIMAL(3,1), f: VARIANT>") == [("a", "bigint"), ("b: c", "string"), ("e", "double"), ("f", "string")]


def test_records_without_a_key(spark):
    df = spark.createDataFrame([(None, json.dumps({"questions": [{"content": c}]})) for c in "가나가"], "record_id long, payload string")
    assert rows(nested.FlatTables(df).questions(), "content") == [("가",), ("나",)]


def test_typed_images(spark):
    image = "struct<image_id:string,image_name:string,image_caption:string>"
    schema = f"qf_id long, images array<{image}>, options array<struct<opt_order:int,is_correct:boolean,content:string,images:array<{image}>,option_explanation:string>>"
    i = ("a", None, None)
    df = spark.createDataFrame([(1, [None, i], [(1, True, "", [i], ""), None, (2, None, None, [None, i], None)]), (1, [None, i], [(1, True, "", [i], ""), None, (2, None, None, [None, i], None)]), (2, None, None), (3, [], [])], schema)
    assert rows(nested.typed_images(df), "record_key", "option_pos", "image_pos") == [(1, 0, 2), (1, 1, 1), (1, 3, 2)]


def test_canonical(spark):
    text = json.dumps({"questions": [{"question_text": "가", "description": "나", "answer": "②", "choices": [{"number": 2, "text": "b"}, {"label": "①", "content": "a", "is_correct": True}]}]})
    df = spark.createDataFrame([(1, text)], "record_id long, payload string")
    got = canonical.normalize_questions(nested.FlatTables(df)).first()
    assert got.content == "가\n나" and [(o.order, o.content, o.is_correct) for o in got.options] == [(1, "a", False), (2, "b", True)]


def test_replies(spark):
    df = spark.createDataFrame([(1, 1, "not-json", None), (1, 2, '{"ok": true}', None), (2, 1, None, "timed out"), (2, 2, None, "refused")], "q int, attempt int, raw string, error string")
    assert rows(canonical.first_valid_reply(df, ["q"])) == [(1, '{"ok": true}', 2, None), (2, None, 2, "refused")]


def test_breaker(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, i, "e" if i in (1, 2) else None) for i in range(5)], "d int, o int, e string")
    calls = canonical.breaker(df, ["d"], "o", F.col("e").isNotNull(), 2)
    assert [r.state for r in calls.orderBy("o").collect()] == ["done", "failed", "failed", "skipped", "skipped"]
    got = canonical.stage_metadata(calls, ["d"], "o", "e").first()
    assert (got.total, got.done, got.failed, got.skipped, got.errors) == (5, 1, 2, 2, ["e", "e"])


def test_refinement_and_concepts(spark):
    finals = spark.createDataFrame([(1, "가 ,나"), (2, "다")], "q int, content string")
    rounds = spark.createDataFrame([(1, 1, '{"content": "라 .", "confidence": "low"}'), (1, 2, '{"content": ""}')], "q int, attempt int, payload string")
    got = rows(canonical.merge_refinement(finals, rounds, ["q"]), "q", "content", "confidence", "needs_review")
    assert got == [(1, "라.", "medium", False), (2, "다", "medium", False)]
    r = spark.createDataFrame([(1, '{"concepts":[{}],"question_concept_mapping":[{"question_id":"b"},{"question_id":"a"}]}', ["a", "b"]), (2, "“x”", []), (3, "[]", [])], "q int, raw string, want array<string>")
    assert rows(canonical.valid_concepts(r, "q", "raw", "want"), "q", "problem") == [(1, None), (2, "quotes"), (3, "json")]
