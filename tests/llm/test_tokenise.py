import random

import pytest

from examflow.llm import tokenise as K

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def raw():
    try:
        return open(K.default_vocabulary_path(), "rb").read()
    except (ImportError, OSError):
        pytest.skip("no public vocabulary here")


def reference(raw):
    return tiktoken.Encoding("own", pat_str=K.PIECE_PATTERN, mergeable_ranks=K.read_ranks(raw), special_tokens={})


def test_tree_finds_leftmost_minimum():
    r = random.Random(1)
    for n in (1, 2, 3, 7, 8, 33):
        ranks = [r.randint(0, 5) for _ in range(n)]
        tree = K.PairTree(ranks)
        for _ in range(n):
            assert tree.leftmost_minimum() == (ranks.index(min(ranks)) if min(ranks) < tree.NONE else -1)
            i = tree.leftmost_minimum()
            ranks[i] = tree.NONE
            tree.update(i, tree.NONE)
        assert tree.leftmost_minimum() == -1


def test_equals_public_encoder(spark, raw):
    texts = ["", None, " ", "Hello  world's", "한국어 시험지 문항", "a" * 5000, "\n\n x\t y ", "<|endoftext|> text", "👩‍🏫 é", "가나다라" * 3000, "1234567 !!?? 한글abc"]
    r = random.Random(2)
    texts += ["".join(r.choice("ab 가나\n1!é") for _ in range(r.randint(0, 80))) for _ in range(200)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(0, "", "y")], "doc_id long, text string, ids string")
    want = reference(raw)
    for row in K.encode_corpus(df).collect():
        assert row.ids == (want.encode_ordinary(texts[row.doc_id]) if texts[row.doc_id] else [])
    assert K.encode_corpus(df.limit(0)).count() == 0
    assert K.encode_corpus(df).count() == len(texts) + 1


def test_round_trip(raw):
    want, enc = reference(raw), K.Encoder(raw)
    import numpy as np

    for t in ("문항 12. ① 가 ② 나", "x" * 999 + "　끝"):
        assert want.decode(np.frombuffer(enc.packed(t), dtype="<i4").tolist()) == t
