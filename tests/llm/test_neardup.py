import random
from itertools import combinations

import pytest

from examflow.llm import neardup as N

OPTION = "array<struct<opt_order:int,content:string>>"


def pairs_of(text):
    import re

    w = re.findall(r"\w+", text.lower())
    return set(zip(w, w[1:]))


def brute(records):
    sets = {}
    for key, content, options in records:
        s = pairs_of(content or "")
        for o in options or []:
            if o and o[1]:
                s |= pairs_of(o[1])
        sets.setdefault(key, s)
    out = set()
    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 2 * len(x & y) >= len(x | y):
            out.add((a, b))
    return out


def made(seed, n=90):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    records = []
    for i in range(n):
        if records and r.random() < 0.6:
            _, content, options = r.choice(records)
            w = content.split()
            for _ in range(r.randrange(0, 5)):
                w[r.randrange(len(w))] = r.choice(words)
            records.append((i, " ".join(w), options))
        else:
            records.append((i, " ".join(r.choice(words) for _ in range(r.randrange(2, 22))), [(1, " ".join(r.choice(words) for _ in range(4))), None] if r.random() < 0.5 else None))
    return records


@pytest.mark.parametrize("block, buckets, hot", [(2000, N.BUCKETS, 1000), (2, N.BUCKETS, 1000), (2, 16, 0)])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, monkeypatch, seed, block, buckets, hot):
    monkeypatch.setattr(N, "BLOCK", block)
    monkeypatch.setattr(N, "BUCKETS", buckets)
    monkeypatch.setattr(N, "HOT_ROWS", hot)
    records = made(seed)
    df = spark.createDataFrame([(k, c, o, "x") for k, c, o in records + records[:5]], f"qf_id long, content string, options {OPTION}, grams string")
    found = N.NearDuplicates(df)
    got = [tuple(r) for r in found.pairs().collect()]
    assert len(got) == len(set(got)) and set(got) == brute(records)
    groups = {r.qf_id: r.group_id for r in found.groups().collect()}
    assert len(groups) == len(records)
    for a, b in got:
        assert groups[a] == groups[b]


def test_edges(spark):
    schema = f"qf_id long, content string, options {OPTION}"
    df = spark.createDataFrame([(1, None, None), (2, "", []), (3, "one", None), (4, "a b [image001]", None), (5, "A  B", [(1, None)]), (6, "a b c", None)], schema)
    assert [tuple(r) for r in N.NearDuplicates(df).pairs().orderBy("qf_id_a", "qf_id_b").collect()] == [(4, 5), (4, 6), (5, 6)]
    assert N.NearDuplicates(df.limit(0)).pairs().count() == 0
    assert N.NearDuplicates(df.limit(0)).groups().count() == 0


def test_long_chain_of_labels(spark):
    chain = [(i, i + 1) for i in range(40)]
    edges = spark.createDataFrame(chain + [(b, a) for a, b in chain], "a long, b long")
    assert {r.label for r in N.connected_labels(edges).collect()} == {0}


@pytest.mark.parametrize("block", [2000, 50])
def test_every_pair_of_a_large_class(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    texts = [(i, "a b c d", [(1, "x y"), (2, "v w")] if i % 2 else [(1, "v w"), (2, "x y")]) for i in range(301)] + [(999, "a b c d", [(1, "x y")])]
    got = [tuple(r) for r in N.NearDuplicates(spark.createDataFrame(texts, f"qf_id long, content string, options {OPTION}")).pairs().collect()]
    assert len(got) == len(set(got)) == 301 * 300 // 2 + 301 and all(a < b for a, b in got)
