"""Problem 8: personal data inside free text, found and replaced by typed placeholders.

An Aho-Corasick automaton walks each text once and reports anchors: at-signs (also written out),
dialling prefixes, words that announce a name, and the ends of street names. A second one walks the
digit-masked text of rows with digits and reports the shapes of identity numbers. A deterministic
parser expands each anchor to both sides, validates the boundaries and the inner shape, and drops
what only looks alike (booklet, ticket, business and version numbers, server addresses, dates,
places without a house number, ordinary words after a cue for a name). Every parser looks at a
bounded stretch around its anchor, so the time is linear in the length of a text.

Positions are code points of the original text: every folding used is one character to one.
Defined results: null and empty text give no rows and stay as they are; overlapping finds keep the
longer one (then the earlier type in TYPES); the same text in another row gives its own rows.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TYPES = ("email", "id_number", "phone", "address", "name")

# Full-width forms and unusual spaces, one character to one.
_FOLD = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {c: 0x20 for c in [0xA0, 0x3000, 0x202F, *range(0x2000, 0x200B)]}
_FOLD |= {c: 0x2D for c in (0x2010, 0x2011, 0x2012, 0x2013, 0x2212)}
_FOLDABLE = re.compile("[！-～ 　  - ‐-–−]")

# Korean dialling prefixes (mobile, area, internet), family names, words around names.
KR_PREFIXES = "010 011 016 017 018 019 02 031 032 033 041 042 043 044 051 052 053 054 055 061 062 063 064 070 080".split()
FAMILY_TWO = "남궁 제갈 선우 황보 독고 사공 서문 동방 어금 망절".split()
FAMILY_ONE = "김이박최정강조윤장임한오서신권황안송류유홍전고문양손배백허남심노하곽성차주우구민진지엄채원천방공현함변염여추도소석선설마길연위표명기반왕금옥육인맹제모탁국어은편용"
KO_BEFORE = "담당 조교|조교|작성자|성명|이름|응시자|수험자|지원자|담당자|문의는|출제 위원|검토 위원|검토|학생은|답변은|해설은|저자|지은이|글쓴이|강사|감독관|교수|필자".split("|")
KO_AFTER = "님|씨| 선생님| 교수| 조교| 강사".split("|")
EN_BEFORE = ("prepared by|reviewed by|written by|compiled by|edited by|submitted by|graded by|author:|author|contact|candidate|applicant|care of|c/o|talk by|lecture by|name:|student|tutor").split("|")
EN_AFTER = (" asked about", " wrote", " made the same", " submitted")
STREET_WORDS = "Avenue|Ave|Street|St|Road|Rd|Lane|Ln|Drive|Dr|Court|Ct|Boulevard|Blvd|Way|Place|Pl|Terrace|Square|Sq|Highway|Hwy".split("|")
# Ordinary words that follow a cue for a name but are none.
KO_WORDS = (
    "강의 강좌 강조 계산 공부 공식 과목 과정 구분 구성 구조 국가 국어 기관 기록 기본 기준 기출 노력 노트 도구 명단 명령 명시 명칭 모두 문단 문법 문서 문의 문장 문제 문항 "
    "방법 방식 방향 배점 배정 변경 변화 비교 서류 서술 선발 선택 선생 설명 성과 성명 성적 소개 소속 송부 신분 신청 안내 양식 양측 여기 여러 여부 연구 연락 연습 예시 예정 오늘 "
    "오답 우리 우선 원고 원리 원문 유의 유형 육성 은행 의견 이것 이곳 이날 이론 이름 이번 이상 이하 이후 인원 인정 임시 임용 자격 장소 전원 전체 정답 정리 정보 정의 정확 제도 "
    "제목 제출 조건 조교 조사 주관 주소 주의 주장 지도 지면 지문 지시 지원 진도 진행 차례 차이 채점 책임 천천 최근 최종 추가 추천 출제 탁월 편집 표기 표시 하나 학습 한국 한글 "
    "함께 해설 허용 현재 형식 홍보 황금"
).split()
EN_WORDS = frozenset(
    "Academy Act Agency All Annual Any April Assistant Association August Bank Board Book Bureau Centre Center Chair Chapter City College Committee Common Community Company Congress Copy Corporation Council "
    "Country County Course Court Daily Data December Deep Department Desk Director District Each East Editor English Every Exam Faculty February Federal Final First Form Foundation Friday General Global "
    "Government Graduate Great Group Help Her High Higher His House Human International January July June Junior Kingdom Korea Korean Law Library Local Machine March Math May Mathematics Ministry Monday "
    "Museum National New News North November October Office Open Our Paper Part Please Policy Press Primary Problem Professor Project Public Question Questions Records Republic Research Saturday School "
    "Science Second Section Senior September Service Services Society Software South State States Student Study Sunday Support Systems Teacher Team Test That The Their These This Thursday Tuesday Union "
    "Unit United University Web Wednesday Week West What When Which World Year Young Your".split()
)
EN_ENDINGS = ("tion", "sion", "ment", "ness", "ology", "ics", "ism", "ship", "ance", "ence", "ability", "ivity")

_KO_WORDS = frozenset(KO_WORDS)
#: What may follow an ordinary word: nothing, a particle, or the ending of a derived word.
_ENDINGS = ("", *"은는이가을를의에도로와과만들자어서")
_NAME_KO = rf"(?:(?:{'|'.join(FAMILY_TWO)}) ?[가-힣]{{1,2}}|[{FAMILY_ONE}] ?[가-힣]{{2}}|[{FAMILY_ONE}][가-힣](?![가-힣]))"
_KO_NAME_AT = re.compile(rf"[ \t]*[:：]?[ \t]*({_NAME_KO})(?=$|[^가-힣]|님|씨|이고|이다|이며|의|은|는|이|가|을|를|에게|께|과|와|도|\s)")
_KO_NAME_TO = re.compile(rf"(?<![가-힣])((?:(?:{'|'.join(FAMILY_TWO)}) ?[가-힣]{{1,2}}|[{FAMILY_ONE}] ?[가-힣]{{2}}))$")
_EN_WORD = r"[A-Z][a-z]+(?:[-'’][A-Z][a-z]+)?"
_NAME_EN = rf"(?:{_EN_WORD}(?: [A-Z]\.)* {_EN_WORD}|{_EN_WORD}, {_EN_WORD}(?: [A-Z]\.)?)"
_EN_NAME_AT = re.compile(rf"\s*:?\s*(?:(?:Dr|Prof|Professor|Mr|Mrs|Ms|Miss)\.? )?({_NAME_EN})\b")
_EN_NAME_TO = re.compile(rf"({_NAME_EN})$")

_LOCAL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+\-]*$")
_DOT = r"(?:\.|\s?[\[(]\s?(?:dot|점)\s?[\])]\s?|\s(?:dot|점)\s)"
_DOMAIN = re.compile(rf"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:{_DOT}[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)+")
_LOCAL_SPELT = re.compile(rf"[A-Za-z0-9][A-Za-z0-9_%+\-]*(?:{_DOT}[A-Za-z0-9_%+\-]+)*$")
_AT_WORDS = ("(at)", "[at]", "{at}", "<at>", " at ", "골뱅이", "(AT)", "[AT]", "(골뱅이)", "[골뱅이]")

_KR_PHONE = re.compile(r"(?:(?:\+|00)82[ .\-]?\(?0?\)?)?[ .\-]?\(?0?(?:1[016789]|2|3[1-3]|4[1-4]|5[1-5]|6[1-4]|[78]0)\)?[ .\-)]{0,2}\d{3,4}[ .\-]?\d{4}(?![\d])")
_US_PHONE = re.compile(r"(?:\+?1[ .\-])?(?:\([2-9]\d{2}\) ?|[2-9]\d{2}[ .\-])\d{3}[ .\-]\d{4}(?!\d|-\d)")
_RRN = re.compile(r"(?<![\d\-.])\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])\s?-?\s?[1-8]\d{6}(?![\d]|-\d)")
_PASSPORT = re.compile(r"(?<![A-Za-z0-9])[A-Z]{1,2}\d{7,8}(?![A-Za-z0-9])")
_LICENCE = re.compile(r"(?<![\d\-])\d{2}-\d{2}-\d{6}-\d{2}(?![\d]|-\d)")
_SSN = re.compile(r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d]|-\d)")
_ID_NUMBERS = {"rrn": _RRN, "passport": _PASSPORT, "licence": _LICENCE, "ssn": _SSN}
_DIGIT = re.compile(r"\d")
#: Every digit as 0, every blank as a space: what the shapes are looked up in.
_MASK = {c: 0x30 for c in range(0x31, 0x3A)} | {c: 0x20 for c in (9, 10, 11, 12, 13)}
_NOT_PERSONAL = re.compile(r"(?:사업자|법인|접수 번호|교재 번호|주문|ticket|booklet|build|version|isbn)[^\d]{0,8}$", re.I)

_KO_HOUSE = (
    r"(?:[가-힣]{2,10}(?:대로|로|길) ?(?:\d+(?:번)?길 ?)?\d+(?:-\d+)?(?!\d|[번가-힣]*길)"
    r"|[가-힣]{1,8}\d?(?:동|리|가) (?:산 ?)?\d+(?:-\d+)?(?!\d))"
)
_KO_ADDRESS = re.compile(
    r"(?<![가-힣])(?:[가-힣]{2,5}도 )?(?:[가-힣]{2,6}(?:특별시|광역시|특별자치시|시|군) )(?:[가-힣]{1,6}(?:구|군|시) )?(?:[가-힣]{1,6}(?:읍|면) )?"
    + _KO_HOUSE + r"(?: ?번지)?(?:,? ?\d+동)?(?:,? ?\d+호)?(?: ?\(?\d+층\)?)?"
)
_EN_ADDRESS = re.compile(
    rf"(?<![\w\-.])\d{{1,5}} (?:[NSEW]\.? )?(?:{_EN_WORD} ){{1,3}}(?:{'|'.join(STREET_WORDS)})\b\.?(?:, (?:Apt|Unit|Suite|Floor)\.? ?\w+)?(?:, {_EN_WORD}(?! \d))?"
)


class _Anchors:
    """The automaton over lower-case text: each word ends with the parser that expands it."""

    def __init__(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        words: dict[str, set[str]] = {}
        add = lambda kind, *w: [words.setdefault(x.lower(), set()).add(kind) for x in w]
        add("at", "@", *_AT_WORDS)
        add("ko_before", *KO_BEFORE)
        add("ko_after", *KO_AFTER)
        add("en_before", *EN_BEFORE)
        add("en_after", *EN_AFTER)
        add("kr_phone", *KR_PREFIXES, *(f"+82{s}" for s in ("", " ", "-", ".")))
        add("us_phone", *(f"{n}{s}" for n in range(200, 1000) for s in "-. )"), "+1 ", "+1-", "+1.")
        add("ko_street", *(f"{w} " for w in ("시", "군")))
        add("en_street", *(f" {w.lower()}{e}" for w in STREET_WORDS for e in " ,.;\n)"))
        for w, kinds in words.items():
            a.add_word(w, (len(w), tuple(kinds)))
        a.make_automaton()
        self.iter = a.iter
        b = ahocorasick.Automaton()
        shapes = {"rrn": [f"000000{x}0000000" for x in ("", "-", " ", " -", "- ", " - ", "  ")], "passport": ["0000000"], "licence": ["00-00-000000-00"], "ssn": ["000-00-0000"]}
        for kind, forms in shapes.items():
            for f in forms:
                b.add_word(f, (len(f), kind))
        b.make_automaton()
        self.shapes = b.iter


_ANCHORS: list[_Anchors] = []


def _kr_phone_ok(s: str) -> bool:
    d = re.sub(r"\D", "", s)
    if d.startswith("0082"):
        d = d[4:]
    elif d.startswith("82") and ("+" in s or len(d) > 11):
        d = d[2:]
    elif not d.startswith("0"):
        return False
    d = d if d.startswith("0") else "0" + d
    return (d[:2] == "02" and len(d) in (9, 10)) or (d[:2] != "02" and len(d) in (10, 11))


def find_pii(text: str) -> list[tuple[str, int, int]]:
    """(type, start, end) of each piece, in order; start and end are code points of ``text``."""
    if not text:
        return []
    if not _ANCHORS:
        _ANCHORS.append(_Anchors())
    t = text.translate(_FOLD) if _FOLDABLE.search(text) else text
    low = t.lower()
    if len(low) != len(t):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in t)
    found: list[tuple[str, int, int]] = []
    digits_to = street_to = 0
    for end, (size, kinds) in _ANCHORS[0].iter(low):
        at, after = end + 1 - size, end + 1
        for kind in kinds:
            if kind == "at":
                _email(t, at, after, found)
            elif kind == "ko_before":
                if (m := _KO_NAME_AT.match(t, after, after + 16)) and _opens(t, at, t[at:after]) and _ko_name(m[1]):
                    found.append(("name", m.start(1), m.end(1)))
            elif kind == "ko_after":
                if (m := _KO_NAME_TO.search(t[max(0, at - 7) : at])) and _ko_name(m[1]):
                    found.append(("name", max(0, at - 7) + m.start(1), at))
            elif kind == "en_before":
                if (m := _EN_NAME_AT.match(t, after, after + 120)) and (at == 0 or not t[at - 1].isalnum()) and _en_name(m[1]):
                    found.append(("name", m.start(1), m.end(1)))
            elif kind == "en_after":
                if (m := _EN_NAME_TO.search(t[max(0, at - 60) : at])) and _en_name(m[1]):
                    found.append(("name", max(0, at - 60) + m.start(1), at))
            elif kind in ("kr_phone", "us_phone"):
                start = at
                while start and t[start - 1] in "(+":
                    start -= 1
                if start and (t[start - 1].isdigit() or t[start - 1] in "-." and start > 1 and t[start - 2].isdigit()):
                    continue
                m = (_KR_PHONE if kind == "kr_phone" else _US_PHONE).match(t, start)
                if m and (kind == "us_phone" or _kr_phone_ok(m[0])) and not _NOT_PERSONAL.search(t[max(0, start - 16) : start]):
                    if t[m.end() : m.end() + 1] != "-" or not t[m.end() + 1 : m.end() + 2].isdigit():
                        found.append(("phone", start, m.end()))
            elif kind == "ko_street":
                if end >= digits_to:
                    start = max(0, at - 14)
                    for m in _KO_ADDRESS.finditer(t, start, min(len(t), after + 60)):
                        if m.start() <= at < m.end():
                            found.append(("address", m.start(), m.end()))
                            digits_to = m.end()
                            break
            elif kind == "en_street" and after > street_to:
                start = max(0, at - 48, street_to)
                for m in _EN_ADDRESS.finditer(t, start, min(len(t), after + 80)):
                    if m.start() > at:
                        break
                    if m.end() > at and (m.start() > start or start in (0, street_to)):
                        found.append(("address", m.start(), m.end()))
                        street_to = m.end()
                        break
    _numbers(t, found)
    # The longest first; what is kept never overlaps, so its neighbours in order tell about the rest.
    best: list[tuple[int, int, str]] = []
    found = [(k, _first(t, a, b), b) for k, a, b in found]
    for k, a, b in sorted(set(found), key=lambda x: (x[1] - x[2], TYPES.index(x[0]), x[1])):
        at = bisect_left(best, (a, b, k))
        if (at == 0 or best[at - 1][1] <= a) and (at == len(best) or best[at][0] >= b):
            best.insert(at, (a, b, k))
    return [(k, a, b) for a, b, k in best]


def _ko_name(name: str) -> bool:
    """Whether a candidate is not an ordinary word with or without a particle."""
    return name[1:2] == " " or name[:2] not in _KO_WORDS or name[2:3] not in _ENDINGS


def _en_name(name: str) -> bool:
    """Whether no part of a candidate is an ordinary word of offices, papers and subjects."""
    parts = [p for p in re.split(r"[ ,]+", name) if len(p) > 2]
    return not any(p in EN_WORDS or (len(p) > 5 and p.endswith(EN_ENDINGS)) for p in parts)


def _opens(t: str, at: int, cue: str) -> bool:
    """Whether a cue stands as a word; a review is one only at the start of a clause, as it is also a matter of papers."""
    if at and "가" <= t[at - 1] <= "힣":
        return False
    while at and t[at - 1] == " ":
        at -= 1
    return cue != "검토" or t[at - 1 : at] in ("", "\n", ",", ".", "(", ":", ";")


def _first(t: str, a: int, b: int) -> int:
    """Place of the first letter or digit."""
    while a < b and not t[a].isalnum():
        a += 1
    return a


def _email(t: str, at: int, after: int, found: list) -> None:
    spelt = t[at:after] != "@"
    left, right = at, after
    if spelt or t[at - 1 : at] == " ":
        while left and t[left - 1] in " ([{<":
            left -= 1
    if spelt or t[after : after + 1] == " ":
        while right < len(t) and t[right] in " )]}>":
            right += 1
    if spelt and t[at:after].strip().lower() == "at" and "[" not in t[right : right + 40] and " dot " not in t[right : right + 40]:
        return  # an ordinary word
    base = max(0, left - 80)
    m = (_LOCAL_SPELT if spelt else _LOCAL).search(t[base:left])
    d = _DOMAIN.match(t, right)
    if not m or not d:
        return
    if not re.search(r"[A-Za-z]{2,}$", d[0]):
        return
    found.append(("email", base + m.start(), d.end()))


def _numbers(t: str, found: list) -> None:
    """Identity numbers: the automaton of shapes finds where one may stand, its pattern validates it there."""
    if not _DIGIT.search(t):
        return
    for end, (size, kind) in _ANCHORS[0].shapes(t.translate(_MASK)):
        start = end + 1 - size
        if kind == "passport":  # its letters stand before the digits
            while start and end - start < 9 and t[start - 1].isascii() and t[start - 1].isalpha():
                start -= 1
        m = _ID_NUMBERS[kind].match(t, start)
        if m and not _NOT_PERSONAL.search(t[max(0, start - 16) : start]):
            found.append(("id_number", start, m.end()))


def redact_text(text: str | None) -> str | None:
    """The text with each piece replaced by a placeholder of its type."""
    if not text:
        return text
    out, end = [], 0
    for kind, a, b in find_pii(text):
        out += [text[end:a], f"[{kind.upper()}]"]
        end = b
    return "".join(out) + text[end:]


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, pii_type, start_pos, end_pos) of each piece of personal data; one pass, no shuffle."""
    narrow = df.select(key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, kinds, starts, ends = [], [], [], []
            for doc, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, a, b in find_pii(t or ""):
                    keys.append(doc)
                    kinds.append(kind)
                    starts.append(a)
                    ends.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, batch.schema.field(0).type), pa.array(kinds, pa.string()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                names=[key, "pii_type", "start_pos", "end_pos"],
            )

    return narrow.mapInArrow(run, f"`{key}` {narrow.schema[key].dataType.simpleString()}, pii_type string, start_pos int, end_pos int")


def redact(df: DataFrame, text: str = "text", into: str | None = None) -> DataFrame:
    """``text`` (or a new column ``into``) with placeholders; every other column as it was."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([redact_text(t) for t in batch.to_pylist()], type=pa.string())

    return df.withColumn(into or text, F.arrow_udf(run, "string")(F.col(f"`{text}`")))
