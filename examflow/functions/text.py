"""Scalar text functions and predicates as Catalyst expressions: nothing here runs in Python.

White space is what Unicode calls white space: a plain ``\\s`` of Java would leave no-break spaces.
Null gives null for text functions; predicates treat null as no match where they say so.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Marks, rule lists and patterns of exam papers.
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩"
WS = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
QUESTION_LINE = r"^(\d{1,3})\.\s*(.*)$"
QUESTION_NUMBER = r"^\s*(\d{1,3})\s*[.)]\s*|^\s*(\d{1,3})\s+(?!\d)"
OCR_START = r"^\s*(\d{1,3})\s*[.)]\s*"
OCR_START_SLASH = r"^\s*/\s*[.)]\s*"
OCR_CHOICE = r"^\s*(?:[①-⑩]|\(\s*[1-5]\s*\)|[1-5]\s*[.)]|[@©○●◦•※]|[A-Ea-e]\s*[.)])\s*"
LEGACY_START = r"^\s*(?:문\s*\d+|제\s*\d+\s*문|\d+\s*번|\d+\s*[.)])\s*"
SUBJECT_PATTERNS = (
    r"^\s*\d+\s*과목\s*[.:]?\s*(.+?)\s*$",
    r"^\s*제\s*과목\s*\d+\s*[.:]?\s*(.+?)\s*$",
    r"^\s*제\s*과목\s+(.*\S)\s*$",
)
SKIP_EQUAL = ("1 회", "정답 및 해설", "저작권 안내")
SKIP_STARTS = ("2024 년 1 회 정보처리기사 필기", "이 자료는 시나공 카페 회원", "다른 매체에 옮겨 실을 수 없으며", "※ 다음 문제를 읽고 알맞은 것을 골라", "답란 (")
SKIP_CONTAINS = ("기출문제 & 정답 및 해설",)
NOISE_EQUAL = ("저작권 안내", "정답 및 해설", "기출문제", "-")
NOISE_STARTS = ("이 자료는 시나공 카페", "다른 매체에 옮겨")
TEXT_VISUALS = ("SELECT ", "UPDATE ", "#include", "public class", "System.out", "printf", "while (")
BOXED_VISUALS = ("ㆍ", "SELECT ", "UPDATE ", "#include", "public class", "System.out", "while (", "for (", "JavaScript")
NUMBER_LIST = r"(?:\d+\s*,\s*){4,}\d+"
TOP_NOISE = r"컴퓨터활용능력|기출문제|전자문제집\s*CBT|(?i:www\.comcbt\.com)"
BOTTOM_NOISE = r"^\s*\d+\s*과목\s*:\s*|(?i:최강\s*자격증.*전자문제집\s*CBT)|(?i:www\.comcbt\.com)"
APPENDIX_PROMOS = (r"(?i)전자문제집\s*CBT", r"(?i)CBT란", r"(?i)최신\s*수정된", r"(?i)OMR", r"(?i)교사용\s*/\s*학생용")
SMART_QUOTES = "[“”‘’＂]"
LATEX = {
    "\\": r"\textbackslash{}", "{": r"\{", "}": r"\}", "#": r"\#", "$": r"\$", "%": r"\%",
    "&": r"\&", "_": r"\_", "~": r"\textasciitilde{}", "^": r"\textasciicircum{}",
}
PARTICLES = "에서|으로|은|는|이|가|을|를|의|와|과|도|만|에|로"
# Kinds of parse damage and the pattern of each. What follows may be matched too: only presence counts.
ARTIFACTS = (
    ("단어 내부가 쉼표로 분리된 패턴", rf"[가-힣A-Za-z]{{1,6}}\s*,\s*[가-힣A-Za-z]{{1,6}}(?:{PARTICLES})"),
    ("빈 쉼표 나열 패턴", r",\s*,"),
    ("연결 어미 뒤 단어가 붙은 패턴", rf"(?:하며|이고|이며|되며|하여|하고)[가-힣]{{2,}}(?:{PARTICLES})"),
    ("여러 한국어 단어가 길게 붙은 패턴", r"[가-힣]{8,}(?:의|을|를|은|는|이|가)\s"),
)
# Substitutions for phrases an optical reader is known to damage, applied in this order.
OCR_PHRASES = (
    (r"Firmware\)O", "(Firmware)에"),
    (r"관한\s*설명으로\s*22\s*것은\?", "관한 설명으로 옳은 것은?"),
    (r"설명으로\s*올지\s*않은\s*것은\?", "설명으로 옳지 않은 것은?"),
    (r"설명으로\s*율지\s*않은\s*것은\?", "설명으로 옳지 않은 것은?"),
    (r"브리지\(\s*31006\s*\)", "브리지(Bridge)"),
    (r"주로\s*하드디스크의\s*부트\s*레코드\s*부분에\s*AVEC\b", "주로 하드디스크의 부트 레코드 부분에 저장된다."),
    (r"16%!\-=\(Hexadecimal\}", "16진수(Hexadecimal)"),
    (r"A~FILAL\s*문지", "A~F의 문자"),
    (r"10진수\s*실수0030로", "10진수 실수로"),
    (r"\(\s*([1-5])\s+10진수\(0600130\s*정수", r"($1) 10진수의 정수"),
    (r"변환\s+하려면", "변환하려면"),
    (r"변환\s*히\s*려면", "변환하려면"),
    (r"더\s*이상\s*LA\s*지", "더 이상 나누어지"),
    (r",\s*KE\s*제외한", ", 그 나머지를"),
    (r"나머지를\s+나머지를", "나머지를"),
)


def trim_u(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def collapse(c: Column) -> Column:
    """White space runs become one space; ends are trimmed."""
    return F.trim(F.regexp_replace(c, f"{WS}+", " "))


def content_hash(c: Column) -> Column:
    """SHA-1 of the collapsed text."""
    return F.sha1(collapse(F.coalesce(c, F.lit(""))))


def lines_of(c: Column) -> Column:
    return F.split(c, r"\r\n|\r|\n")


def clean_lines(c: Column) -> Column:
    """Lines collapsed each, blank ones dropped."""
    return F.filter(F.transform(lines_of(c), collapse), lambda x: x != "")


def normalize_lines(c: Column) -> Column:
    return F.array_join(clean_lines(c), "\n")


def circled_to_number(c: Column) -> Column:
    """① to 1 and so on; 0 for anything else."""
    return F.when(F.length(c) == 1, F.instr(F.lit(CIRCLED), c)).otherwise(0)


def number_to_label(n: Column) -> Column:
    return F.when(n.between(1, 10), F.substring(F.lit(CIRCLED), n, F.lit(1))).otherwise(n.cast("string"))


def question_number(c: Column) -> Column:
    """Number at the start: ``n.``, ``n)`` or ``n `` not before another digit; null without one."""
    return F.coalesce(*[F.nullif(F.regexp_extract(c, QUESTION_NUMBER, g), F.lit("")) for g in (1, 2)]).try_cast("int")


def strip_question_number(c: Column) -> Column:
    return trim_u(F.regexp_replace(c, rf"^\s*\d{{1,3}}\s*[.)]\s*|^\s*\d{{1,3}}\s+(?!\d)", ""))


def any_number(c: Column) -> Column:
    """First run of digits anywhere."""
    return F.nullif(F.regexp_extract(c, r"(\d+)", 1), F.lit("")).try_cast("int")


def is_question_line(c: Column) -> Column:
    return c.rlike(QUESTION_LINE)


def is_legacy_question_start(c: Column) -> Column:
    """A start phrase, a number from 1 to 100, and at least one letter or digit after the phrase."""
    rest = trim_u(F.regexp_replace(c, LEGACY_START, ""))
    return c.rlike(LEGACY_START) & F.coalesce(any_number(c).between(1, 100), F.lit(False)) & rest.rlike("[0-9A-Za-z가-힣]")


def ocr_question_number(line: Column) -> Column:
    """Number at the start of a recognised line; ``/.`` is read as 7."""
    return F.coalesce(F.nullif(F.regexp_extract(line, OCR_START, 1), F.lit("")).cast("int"), F.when(line.rlike(OCR_START_SLASH), 7))


def is_ocr_choice(line: Column) -> Column:
    return line.rlike(OCR_CHOICE) & ocr_question_number(line).isNull()


def is_skip_line(c: Column) -> Column:
    """Blank lines, footers, titles, notices and subject lines."""
    t = collapse(c)
    starts = F.lit(False)
    for s in SKIP_STARTS:
        starts = starts | t.startswith(s)
    for s in SKIP_CONTAINS:
        starts = starts | t.contains(s)
    return (t == "") | t.isin(*SKIP_EQUAL) | t.rlike(r"^-\s*\d+\s*-$") | t.rlike(r"^제\s*\d*\s*과목") | starts


def is_noise_line(c: Column) -> Column:
    t = normalize_lines(c)
    starts = F.lit(False)
    for s in NOISE_STARTS:
        starts = starts | t.startswith(s)
    return (t == "") | t.rlike(r"^\s*-\s*\d+\s*-\s*$") | t.rlike(r"^\s*\d+\s*회\s*$") | t.isin(*NOISE_EQUAL) | (t.contains("기출문제") & t.contains("정답 및 해설")) | starts


def detect_subject(c: Column) -> Column:
    """Subject of a heading such as ``2과목 : …``, without digits and separators; null if there is none."""
    t = normalize_lines(c)
    found = F.coalesce(*[F.nullif(F.regexp_extract(t, p, 1), F.lit("")) for p in SUBJECT_PATTERNS])
    return F.nullif(collapse(F.regexp_replace(found, "[0-9]+|[:：.]", " ")), F.lit(""))


def normalize_answer(token: Column) -> Column:
    """Digits of a list become circled marks; other answers stay."""
    t = trim_u(token)
    marks = F.array_join(F.transform(F.split(t, r"\s*,\s*"), lambda x: number_to_label(x.try_cast("int"))), ",")
    return F.when(t.rlike(r"^\d(?:\s*,\s*\d+)*$"), marks).otherwise(t)


def correct_orders(answer: Column) -> Column:
    """Option numbers an answer names, by digits or circled marks; empty for anything else."""
    parts = F.split(F.regexp_replace(F.coalesce(answer, F.lit("")), " ", ""), ",")
    numbers = F.transform(parts, lambda p: F.when(p.rlike(r"^\d{1,9}$"), p.try_cast("int")).when(circled_to_number(p) > 0, circled_to_number(p)))
    return F.array_distinct(F.filter(numbers, lambda n: n.isNotNull()))


def normalize_stem(c: Column) -> Column:
    """A short Latin second line after a first line that ends in 중 is pulled before it."""
    lines = clean_lines(c)
    swap = (F.size(lines) >= 2) & F.get(lines, F.lit(1)).rlike(r"^[A-Za-z0-9][A-Za-z0-9\-+/&() ]{0,12}$") & F.get(lines, F.lit(0)).endswith("중")
    swapped = F.concat(F.array(F.concat_ws(" ", F.get(lines, F.lit(1)), F.get(lines, F.lit(0)))), F.slice(lines, F.lit(3), F.greatest(F.size(lines), F.lit(0))))
    return F.array_join(F.when(swap, swapped).otherwise(lines), "\n")


def split_choices(c: Column, marks: str = "①-⑩") -> Column:
    """Choices (number, text) of a text with circled marks, in order, repeated numbers kept."""
    parts = F.regexp_extract_all(c, F.lit(f"([{marks}][^{marks}]*)"), F.lit(1))
    return F.transform(parts, lambda p: F.struct(circled_to_number(F.substring(p, 1, 1)).alias("number"), trim_u(F.substring(p, F.lit(2), F.length(p))).alias("text")))


def first_of_each_number(choices: Column) -> Column:
    """Choices without later ones of the same number."""
    numbers = F.transform(choices, lambda x: x.number)
    return F.filter(choices, lambda x, i: F.array_position(numbers, x.number) == i + 1)


def stem_before_choices(c: Column, marks: str = "①-⑩") -> Column:
    return F.regexp_extract(c, f"^([^{marks}]*)", 1)


def confidence(stem: Column, n_choices: Column, answer: Column, raw: Column) -> Column:
    """1 less .20 for fewer than four choices, .15 for a short stem, .15 without answer, .10 for a short text."""
    minus = lambda cond, x: F.when(cond, F.lit(x).cast("decimal(4,2)")).otherwise(F.lit("0.00").cast("decimal(4,2)"))
    off = minus(n_choices < 4, "0.20") + minus(F.length(stem) < 15, "0.15") + minus(answer.isNull() | (answer == ""), "0.15") + minus(F.length(raw) < 30, "0.10")
    return F.greatest(F.lit("0.00").cast("decimal(4,2)"), F.lit("1.00").cast("decimal(4,2)") - off).cast("double")


def escape_latex(c: Column) -> Column:
    """One pass over the characters, so nothing is escaped twice."""
    table = F.create_map(*[F.lit(x) for pair in LATEX.items() for x in pair])
    return F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")


def repair_text(c: Column) -> Column:
    """Spaces before punctuation go, one comes after it where a word follows, runs of spaces become one."""
    t = F.regexp_replace(c, r"(?U)\s+([,?.!])", "$1")
    t = F.regexp_replace(t, r"(?U)([,?.!])([^\s\]),.?!])", "$1 $2")
    return trim_u(F.regexp_replace(t, r"(?U)\s{2,}", " "))


def artifacts(c: Column) -> Column:
    """Kinds of parse damage still in a text, in fixed order."""
    return F.array_compact(F.array(*[F.when(c.rlike(p), F.lit(name)) for name, p in ARTIFACTS]))


def fix_ocr_phrases(c: Column) -> Column:
    for pattern, to in OCR_PHRASES:
        c = F.regexp_replace(c, pattern, to)
    return c


def contains_any(c: Column, words: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | c.contains(w)
    return found


def is_text_visual(c: Column) -> Column:
    return contains_any(c, TEXT_VISUALS) | c.rlike(NUMBER_LIST)


def is_boxed_text(c: Column) -> Column:
    return F.coalesce((c != "") & (contains_any(c, BOXED_VISUALS) | c.rlike(NUMBER_LIST) | (F.size(lines_of(F.regexp_replace(c, r"\r?\n$", ""))) >= 2)), F.lit(False))


def is_boxed_label(c: Column) -> Column:
    return collapse(c).rlike(r"^\[\s*[^\]]+\s*\]$")


def is_marker_only(c: Column, least: int = 1) -> Column:
    """Every line is exactly one circled mark, and there are at least ``least`` lines."""
    lines = clean_lines(c)
    return (F.size(lines) >= least) & F.forall(lines, lambda x: x.rlike("^[①-⑩]$"))


def is_label_only(c: Column) -> Column:
    """Only circled marks and spaces, at least one mark."""
    return c.rlike(r"^\s*(?:[①-⑩]\s*)+$")


def _matches(pattern: str):
    return lambda x: x.rlike(pattern)


def is_appendix(c: Column) -> Column:
    """Promotion, answer tables and the like after the last question."""
    lines = clean_lines(F.coalesce(c, F.lit("")))
    count = lambda p: F.size(F.filter(lines, p))
    strong = sum((F.when(c.rlike(p), 2).otherwise(0) for p in APPENDIX_PROMOS), F.lit(0))
    weak = F.lit(0)
    for pattern in (r"^\s*(?:\d{1,2}\s+){4,}\d{1,2}\s*$", r"^\s*(?:[①②③④⑤]\s+){4,}[①②③④⑤]\s*$"):
        rows = F.size(F.filter(lines, _matches(pattern)))
        strong = strong + F.when(rows >= 2, 2).otherwise(0)
        weak = weak + F.when(rows == 1, 1).otherwise(0)
    short = count(lambda x: (F.size(F.split(x, " ")) >= 8) & F.forall(F.split(x, " "), lambda t: F.length(t) <= 2))
    weak = weak + F.when(short >= 2, 2).otherwise(0)
    choices = count(lambda x: x.rlike(OCR_CHOICE) & ~x.rlike(OCR_START))
    return F.coalesce(~((choices >= 3) & (strong == 0)) & ((strong >= 4) | ((strong >= 2) & (weak >= 2))), F.lit(False))


def sparse_row(c: Column) -> Column:
    """A recognised table row: bars become spaces, leading signs go."""
    t = F.trim(F.regexp_replace(F.replace(collapse(F.coalesce(c, F.lit(""))), F.lit("|"), F.lit(" ")), f"{WS}+", " "))
    return F.trim(F.regexp_replace(t, "^[^0-9A-Za-z가-힣#]+", ""))


def sparse_score(row: Column) -> Column:
    """(useful signs, marks and digits, length) of a cleaned row; larger is better."""
    n = lambda p: F.length(F.regexp_replace(row, f"[^{p}]", ""))
    return F.struct((n("0-9") * 3 + n("#") * 4 + n(",.") * 2 - n("가-힣") * 3).alias("useful"), (n("#") + n("0-9")).alias("marks"), F.length(row).alias("size"))


def is_structured_row(row: Column) -> Column:
    tokens = F.split(row, " ")
    return (row != "") & F.size(tokens).between(2, 4) & F.forall(tokens, lambda t: t.rlike("^[0-9#.,]+$"))


def better_sparse_row(primary: Column, fallback: Column) -> Column:
    """Of two readings the structured one, else the better scored one, the primary at a tie."""
    a, b = sparse_row(primary), sparse_row(fallback)
    sa, sb = is_structured_row(a), is_structured_row(b)
    return F.when(sa & ~sb, a).when(sb & ~sa, b).when(sparse_score(a) >= sparse_score(b), a).otherwise(b)


def is_timeout(message: Column) -> Column:
    return F.coalesce(F.lower(message).rlike("timed out|timeout"), F.lit(False))


def column_counts(total: Column, left: Column, right: Column) -> Column:
    """Questions of the left and right column: as detected if they add up, else in proportion, else in halves."""
    t = F.greatest(total, F.lit(1))
    a, b = F.greatest(left, F.lit(0)), F.greatest(right, F.lit(0))
    share = F.greatest(F.lit(1), F.least(t - 1, F.bround(t * (a / F.nullif(a + b, F.lit(0))), 0).cast("int")))
    both = (a > 0) & (b > 0)
    half = F.floor((t + 1) / 2).cast("int")
    chosen = F.when(both & (a + b == t), a).when(both, share).otherwise(half)
    return F.struct(chosen.alias("left"), (t - chosen).alias("right"))


def image_file_name(kind: Column, page: Column, index: Column) -> Column:
    name = F.when(kind.isin("picture", "image"), "figure").otherwise(kind)
    return F.concat(name, F.lit("_p"), padded(page, 2), F.lit("_"), padded(index, 3), F.lit(".png"))


def data_url(content: Column, mime: Column) -> Column:
    return F.concat(F.lit("data:"), F.coalesce(mime, F.lit("image/png")), F.lit(";base64,"), F.regexp_replace(F.base64(content), r"\s", ""))


def strip_fences(c: Column) -> Column:
    """JSON text of a reply that may stand in a fenced block."""
    t = trim_u(c)
    return F.when(t.startswith("```"), trim_u(F.regexp_replace(F.regexp_replace(t, "^`+|`+$", ""), "^json", ""))).otherwise(t)


def json_object(c: Column) -> Column:
    """VARIANT of a reply that is a JSON object; null otherwise."""
    v = F.try_parse_json(strip_fences(c))
    return F.when(F.schema_of_variant(v).startswith("OBJECT"), v)


def padded(number: Column, width: int) -> Column:
    """A number with leading zeros; longer ones are not cut."""
    return F.format_string(f"%0{width}d", number.cast("bigint"))


def dotenv_value(raw: Column) -> Column:
    """The value of a setting line: without its quotes, or without a comment after a blank."""
    t = trim_u(raw)
    quoted = (F.length(t) >= 2) & ((t.startswith("'") & t.endswith("'")) | (t.startswith('"') & t.endswith('"')))
    return F.when(quoted, F.substring(t, F.lit(2), F.length(t) - 2)).otherwise(trim_u(F.regexp_replace(t, r"\s#.*$", "")))


def picked_files(stdout: Column) -> Column:
    """Paths that a file dialog printed, one a line."""
    return F.filter(F.transform(F.split(stdout, "\n"), trim_u), lambda x: x != "")
