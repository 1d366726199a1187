from examflow.llm import pii as P

CASES = [
    ("문의는 남궁담뫼 선생님(010-0407-7439)께 해 주시기 바랍니다.", [("name", "남궁담뫼"), ("phone", "010-0407-7439")]),
    ("담당 조교 장빛율 <marbe-thal21@class.example.com>", [("name", "장빛율"), ("email", "marbe-thal21@class.example.com")]),
    ("성명 윤온율 생년 확인 790619-2424443 거주지 하늘도 한빛시 푸른구 한솔동 677-23번지 (19층)", [("name", "윤온율"), ("id_number", "790619-2424443"), ("address", "하늘도 한빛시 푸른구 한솔동 677-23번지 (19층)")]),
    ("Candidate Jarnsby, Dalia (ID 930-83-0434) made the same slip.", [("name", "Jarnsby, Dalia"), ("id_number", "930-83-0434")]),
    ("Reviewed by Lysan C. Hathmoor, quinmiler29[at]onul[dot]example[dot]org", [("name", "Lysan C. Hathmoor"), ("email", "quinmiler29[at]onul[dot]example[dot]org")]),
    ("Reach the office by (212) 555-0131 or zelli.ston40 (at) post.example.net.", [("phone", "212) 555-0131"), ("email", "zelli.ston40 (at) post.example.net")]),
    ("Please contact Torin Dunmarsh at +1 617 555 0106 about this.", [("name", "Torin Dunmarsh"), ("phone", "1 617 555 0106")]),
    ("신분증 번호 M02401281 확인함. 연락처 ０１０－０５２９－７６３８", [("id_number", "M02401281"), ("phone", "０１０－０５２９－７６３８")]),
    ("Home: 588 Larkmere St.; tel. +82 10 0305 2721", [("address", "588 Larkmere St."), ("phone", "82 10 0305 2721")]),
    ("출제 위원 임슬르, 검토 신슬율", [("name", "임슬르"), ("name", "신슬율")]),
    ("홍 담누님이 지난 회차 풀이를 올려 주셨습니다.", [("name", "홍 담누")]),
    ("주소: 누리도 한빛시 새터구 바람길 207 (13층) / 전화: (02) 0195-0709", [("address", "누리도 한빛시 새터구 바람길 207 (13층)"), ("phone", "02) 0195-0709")]),
]
NOT_CASES = [
    "접수 번호 2026-2023-19283 는 다음 주에 처리된다.", "사업자등록번호 343-89-13134", "교재 번호 979-11-8405-973-0 을 참고하라.", "서버 주소는 192.0.2.37 이고 포트는 8030 이다.", "풀이 도구 v1.68.679 에서 확인하였다.",
    "1234567890123", "미르시 새터구 시험장은 지난 회차와 같다.", "The centre in Bridmoor opens at 9.", "선지 @ 와 © 는 스캔 과정에서 바뀐 기호이다.", "공고일 2026.03.04, 시행일 2026.05.13", "문항 010-19 부터 010-45 까지는 배점이 같다.",
    "코드 검토 없는 핀르렌 곡선", "코드 검토 정리", "코드 검토\n정답 ②", "고정된 군집이 나타난다", "", "Ticket 2026-5903-28260 is still open.",
]


def test_cases():
    for text, want in CASES:
        assert [(k, text[a:b]) for k, a, b in P.find_pii(text)] == want, text


def test_not_cases():
    for text in NOT_CASES:
        assert P.find_pii(text) == [], text


def test_ordinary_words_after_a_cue():
    for text in ("contact United States", "name: Machine Learning", "student Higher Education", "Reviewed by Annual Committee", "교수 방법은", "감독관 이것은", "작성자 연구"):
        assert P.find_pii(text) == [], text
    assert [text[a:b] for text in ("교수 김지은은", "작성자 이름담") for _, a, b in P.find_pii(text)] == ["김지은", "이름담"]


def test_identity_shapes():
    text = "여권 M12345678, AB1234567 / 12-34-567890-12 / 790619 2424443"
    assert [(k, text[a:b]) for k, a, b in P.find_pii(text)] == [("id_number", x) for x in ("M12345678", "AB1234567", "12-34-567890-12", "790619 2424443")]
    assert P.find_pii("XYZM123456789 1912-34-567890-12 7906192424443000") == []


def test_time_is_linear():
    import time

    for part in ("this way and that road to the st place one two ", "검토 ", "tel 010-1234-5678 ", "user@", "123 Main "):
        text = part * (250_000 // len(part))
        began = time.process_time()
        P.find_pii(text)
        assert time.process_time() - began < 3, part


def test_redaction_keeps_the_rest():
    assert P.redact_text("연락처 010-0407-7439 끝") == "연락처 [PHONE] 끝"
    assert P.redact_text(None) is None and P.redact_text("") == ""


def test_frames(spark):
    long = "가 나 " * 100_000 + "연락처 010-0407-7439"
    df = spark.createDataFrame([(1, "연락처 010-0407-7439", "z"), (1, "연락처 010-0407-7439", "z"), (2, None, "z"), (3, "", "z"), (4, long, "z")], "doc_id long, text string, pii_type string")
    got = sorted(map(tuple, P.personal_data(df).collect()))
    assert got == [(1, "phone", 4, 17)] * 2 + [(4, "phone", len(long) - 13, len(long))]
    assert P.personal_data(df.limit(0)).count() == 0
    out = {r.doc_id: r for r in P.redact(df).collect()}
    assert out[1].text == "연락처 [PHONE]" and out[1].pii_type == "z" and out[2].text is None
