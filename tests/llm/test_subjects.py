import random

import pytest
from pyspark.sql import functions as F

from examflow.llm import subjects as J

TERMS = {"BIO": ["광합성", "염색체", "meiosis", "항체"], "LAW": ["저당권", "소멸시효", "mortgage", "형벌"], "NET": ["라우터", "대역폭", "packet", "홉수"]}
FRAMES = ["{}에 대한 설명으로 옳은 것은?", "{}의 특징을 모두 고른 것은?", "다음 중 {}과 가장 관련이 깊은 것은?"]


def test_words():
    assert J.words_of("광합성을 c0urt-\nesy") == ["광합성", J.skeleton("courtesy")]
    assert J.words_of("") == []


@pytest.fixture(scope="module")
def tables(spark):
    r = random.Random(5)
    labels = [(i, r.choice(FRAMES).format(r.choice(TERMS[a][:3])), a, "x") for i, a in enumerate(sorted(TERMS) * 30)]
    questions, truth = [], {}
    for i in range(600):
        a = r.choice(sorted(TERMS))
        stem = r.choice(FRAMES).format(r.choice(TERMS[a]) + "과 " + r.choice(TERMS[a]))
        truth[i] = {a}
        if i % 10 == 0:
            b = r.choice([x for x in sorted(TERMS) if x != a])
            stem, truth[i] = stem + " " + r.choice(FRAMES).format(r.choice(TERMS[b]) + "과 " + r.choice(TERMS[b])), {a, b}
        heading = {"BIO": "1과목: 생물", "LAW": "제 2과목 법학", "NET": "통신"}[a]
        if i % 13 == 0:
            stem, truth[i] = "다음 설명 중 옳은 것은?", {a}
        questions.append((i, 1, heading, stem))
    questions += [(600, 1, None, None), (601, 1, "", ""), (602, 2, "생물", "라우터 " * 30_000), (0, 1, questions[0][2], questions[0][3])]
    q = spark.createDataFrame([(*x, "z") for x in questions], "question_id long, upload_id long, subject string, stem string, area_code string")
    la = spark.createDataFrame(labels, "label_id long, stem string, area_code string, annotator string")
    areas = spark.createDataFrame([("BIO", "생명과학", "life"), ("LAW", "법률", "law"), ("NET", "네트워크", "network")], "area_code string, name_ko string, name_en string")
    return q, la, areas, truth


def test_accuracy(tables):
    q, la, areas, truth = tables
    got = {}
    for r in J.subject_areas(q, la, areas).collect():
        got.setdefault(r.question_id, set()).add(r.area_code)
    assert set(got) == set(range(603)) and all(1 <= len(v) <= 2 for v in got.values())
    right = sum(got[i] == t for i, t in truth.items())
    assert right / len(truth) > 0.95
    assert got[602] == {"NET"}


def test_empty(spark, tables):
    q, la, areas, _ = tables
    assert J.subject_areas(q.limit(0), la, areas).count() == 0
    assert J.subject_areas(q.where(F.col("question_id") < 5), la.limit(0), areas).count() >= 0


def test_model_of_any_size(tables, monkeypatch):
    """A model of more n-grams than a worker holds gives the same rows."""
    q, la, areas, _ = tables
    whole = sorted(map(tuple, J.subject_areas(q, la, areas).collect()))
    monkeypatch.setattr(J, "MAX_GRAMS", 10)
    assert sorted(map(tuple, J.subject_areas(q, la, areas).collect())) == whole


def test_all_labels(spark, tables):
    """Labels teach and calibrate however many come before them."""
    _, _, areas, _ = tables
    a = F.when(F.col("id") >= 20_000, "LAW").when(F.col("id") % 2 == 0, "NET").otherwise("BIO")
    stem = F.when(a == "LAW", "저당권 소멸시효").when(a == "NET", "라우터 대역폭").otherwise("광합성 염색체")
    labels = spark.range(20_040).select(F.col("id").alias("label_id"), stem.alias("stem"), a.alias("area_code"))
    questions = spark.createDataFrame([(1, None, "저당권"), (2, None, "라우터")], "question_id long, subject string, stem string")
    assert sorted(map(tuple, J.subject_areas(questions, labels, areas).collect())) == [(1, "LAW", "stem"), (2, "NET", "stem")]
