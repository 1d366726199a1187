import random
import unicodedata

from examflow.llm import leakage as L
from examflow.llm.charforms import fold_for_match

ITEM = "Had the statute been halted 2393 turns earlier no central statute of limitations would have been left by the scheme"


def longest_common(a, b):
    best, prev = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(prev[j] + 1 if x == y else 0)
            best = max(best, now[-1])
        prev = now
    return best


def test_against_brute_force():
    r = random.Random(3)
    items = [(i, "".join(r.choice("ab") for _ in range(120))) for i in range(6)] + [(9, "short")]
    index = L.ItemIndex(items)
    for _ in range(40):
        i, a, n = r.randrange(6), r.randrange(60), r.randrange(30, 55)
        text = "".join(r.choice("cd") for _ in range(r.randrange(50))) + items[i][1][a : a + n] + "".join(r.choice("cd") for _ in range(9))
        want = {k for k, t in items if longest_common(text, t) >= L.MIN_RUN}
        assert set(index.runs(text)) == want


def test_frames(spark):
    folded = fold_for_match(ITEM)
    spaced = " ".join(ITEM[10:80].upper())
    docs = [(1, "intro " + spaced + " outro", 5), (1, "intro " + spaced + " outro", 5), (2, ITEM[:30], 5), (3, None, 5), (4, "", 5), (5, "가" * 200_000 + ITEM, 5), (6, folded[:39], 5), (7, folded[:40], 5)]
    d = spark.createDataFrame(docs, "doc_id long, text string, item_id int")
    items = spark.createDataFrame([(11, ITEM), (12, None), (13, ""), (14, ITEM)], "item_id long, item_text string")
    got = sorted((r.doc_id, r.item_id) for r in L.leaked_items(d, items).collect())
    assert got == sorted([(1, 11), (1, 14)] * 2 + [(5, 11), (5, 14), (7, 11), (7, 14)])
    assert L.leaked_items(d.limit(0), items).count() == 0 and L.leaked_items(d, items.limit(0)).count() == 0
    cut = {r.doc_id: r.text for r in L.remove_leaks(d, items).collect()}
    assert cut[2] == ITEM[:30] and cut[3] is None and ITEM[20:60] not in cut[5] and cut[1].startswith("intro") and "CENTRAL" not in cut[1].replace(" ", "")


def test_blocks_give_the_same(spark, monkeypatch):
    d = spark.createDataFrame([(1, ITEM), (2, "x" * 60)], "doc_id long, text string")
    items = spark.createDataFrame([(i, ITEM if i % 2 else "y" * 50) for i in range(8)], "item_id long, item_text string")
    whole = sorted(map(tuple, L.leaked_items(d, items).collect()))
    monkeypatch.setattr(L, "BLOCK_LETTERS", 100)
    assert sorted(map(tuple, L.leaked_items(d, items).collect())) == whole and len(whole) == 4


KOREAN = "다음 중 체육 정책의 변천 과정에 대한 설명으로 옳지 않은 것은 무엇인지 고르고 그 까닭을 café 주인에게 두 문장으로 설명하시오"


def test_places_fit_the_folded_text():
    r = random.Random(5)
    signs = ["가", "각", "ᄀ", "ᅡ", "ᆨ", "e", "é", "\u0301", "\u0327", "\u00ad", "\u200b", "ﾊ", "ﾞ", "①", "²", "ﬁ", "Α", "Σ", "İ", " ", "-", "_", "5", "\u034f", "か", "\u3099", "ㅏ", "ㄱ", "\u115f"]
    for _ in range(3000):
        text = "".join(r.choice(signs) for _ in range(r.randrange(14)))
        folded, starts, ends = L.folded_positions(text)
        assert folded == fold_for_match(text) and len(folded) == len(starts) == len(ends)
        assert all(0 <= a < b <= len(text) for a, b in zip(starts, ends)) and starts == sorted(starts)


def test_decomposed_and_nested_quotations_are_removed(spark, monkeypatch):
    quoted = unicodedata.normalize("NFD", KOREAN)
    inner = ITEM[:50] + " " + quoted + " " + ITEM[50:]
    d = spark.createDataFrame([(1, "앞말 " + quoted + " 뒷말"), (2, "before " + ITEM[:35] + quoted + ITEM[35:70] + " after"), (3, inner)], "doc_id long, text string")
    items = spark.createDataFrame([(1, KOREAN), (2, ITEM)], "item_id long, item_text string")
    for size in (L.BLOCK_LETTERS, 100):
        monkeypatch.setattr(L, "BLOCK_LETTERS", size)
        out = L.remove_leaks(d, items)
        assert L.leaked_items(out, items).count() == 0
        got = {x.doc_id: x.text for x in out.collect()}
        assert got[1] == "앞말  뒷말" and got[2].startswith("before") and got[2].endswith("after")


def test_index_is_bounded():
    r = random.Random(7)
    items = [(i, "".join(r.choice("가나다라마바사아자차") for _ in range(1000))) for i in range(200)]
    index = L.ItemIndex(items)
    held = index.hashes.nbytes + index.places.nbytes + index.letters.nbytes + index.ends.nbytes
    assert held <= 20 * 200_000 + 2000
    assert index.runs(items[5][1][100:180]) == {5: [(0, 80)]}


def test_common_preamble():
    same = "이 글을 읽고 물음에 답하시오 "
    items = [(i, same + f"문항 {i} 의 본문은 서로 다르며 번호 {i * 7919} 로 시작한다 그리고 이어지는 문장") for i in range(300)]
    assert L.ItemIndex(items).runs(fold_for_match(same * 3)) == {}
