"""Problem 2: text that looks the same but differs in its characters.

Every letter has the scripts it belongs to (its Unicode script extensions) and those it can be read
in: the scripts of all letters of its confusable class. For every token (a run of letters with the
marks inside it) both sets are intersected over its letters. If the own scripts share none, the
token mixes scripts: it takes the spelling of the script all its letters can be read in, whichever
alphabet that is; with none it stays. Of several it takes Latin, or one that other words of the text
prove to be in use if more of its letters belong there. If the own scripts
share one but every letter can be read as a Latin one, it is a whole-script confusable and takes the
Latin spelling, unless other words of the text prove that the text is written in that script.
Full-width and styled forms, decomposed letters and syllables, invisible signs and unusual spaces are
brought to their plain form. Circled marks, Roman numeral signs, superscripts, compatibility jamo,
emoji, composed letters, and Greek letters as symbols (alone or beside one letter) stay.

Defined results: null stays null, empty stays empty, applying it twice changes nothing more.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes of letters that look the same, the Latin letter first.
CONFUSABLE = (
    "AΑАᎪ BΒВᏴ CСϹᏟ DᎠ EΕЕᎬ GԌᏀ HΗНᎻ IΙІӀ JЈᎫ KΚКᏦ LᏞ MΜМᎷ NΝ OΟОՕ PΡРᏢ QԚ SЅՏᏚ TΤТᎢ UՍ VѴᏙ WԜᎳ XΧХ YΥУ ZΖᏃ "
    "aаα cсϲ dԁ eе gց hһհ iіι jјϳ kκ lӏ nո oοоօ pрρ qԛ sѕ uυս vνѵ wԝ xхχ yуγ"
).split()
# Latin letters of a form of their own inside ordinary words.
LATIN_FORMS = {"ſ": "s", "ʏ": "y", "ɡ": "g", "ɑ": "a", "ⅰ": "i", "ⅴ": "v", "ⅹ": "x", "ⅼ": "l", "ⅽ": "c", "ⅾ": "d", "ⅿ": "m"}
SCRIPTS = ("Latin", "Greek", "Cyrillic", "Armenian", "Cherokee")
LOOKS = {c: word[0] for word in CONFUSABLE for c in word[1:]}
# Signs without width, and spaces other than U+0020.
INVISIBLE = (
    "­͏؜ᅟᅠ឴឵᠎​‌‍‎‏‪‫‬‭‮"
    "⁠⁡⁢⁣⁤⁦⁧⁨⁩⁪⁫⁬⁭⁮⁯﻿"
)
SPACES = "               　"

_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_SPACES = re.compile(f"[{SPACES}]")
_WIDTH = re.compile("[！-￮]+")
_STYLED = re.compile("[\U0001d400-\U0001d7ff]+")
_OTHER = "Ͱ-ϿЀ-ԯԱ-ևᎠ-Ᏼ"
_TOKEN = re.compile(f"(?:[A-Za-zÀ-ɏ{_OTHER}][̀-ͯ]*)+")
_FORMS = "".join(LATIN_FORMS)
_FORM_IN_WORD = re.compile(f"(?<![^\\W\\d_])[{_FORMS}](?=[a-z]{{2}})|(?<=[A-Za-z])[{_FORMS}](?=[a-z])|(?<=[A-Za-z]{{2}})[ſʏɡɑ](?![^\\W\\d_])")
_OTHER_LETTER = re.compile(f"[{_OTHER}]")
_EMOJI_JOIN = re.compile("(?<=[☀-➿️\U0001f000-\U0001faff])‍(?=[☀-➿\U0001f000-\U0001faff])")
#: Stands for the joiner inside an emoji while invisible signs are removed.
_HELD = "\U000f0000"
#: A row without any of these is already plain: it never leaves the JVM.
SUSPICIOUS = (
    f"[{INVISIBLE}{SPACES}！-￮̀-ͯᄀ-ᇿꥠ-꥿ힰ-퟿{_OTHER}{_FORMS}\U0001d400-\U0001d7ff"
    "ΩKÅ豈-﫿]"
)
KINDS = ("invisible", "space", "width", "decomposed", "script")


@functools.cache
def scripts_of(ch: str) -> frozenset[str]:
    """Scripts a letter belongs to, by its Unicode script extensions."""
    return frozenset(s for s in SCRIPTS if regex.match(rf"\p{{scx={s}}}", ch))


@functools.cache
def readings(ch: str) -> dict[str, str]:
    """For each script a letter can be read in, the letter of that script."""
    out = {s: c for word in CONFUSABLE if ch in word for c in word for s in scripts_of(c)}
    return out | {s: ch for s in scripts_of(ch)}


def proved_scripts(tokens: list[str]) -> frozenset[str]:
    """Scripts other than Latin that a word of at least two letters proves: it is in no other, and not all of it can be read as Latin."""
    out = set()
    for token in tokens:
        letters = [c for c in token if not unicodedata.combining(c)]
        shared = frozenset.intersection(*map(scripts_of, letters))
        if len(letters) > 1 and shared and "Latin" not in shared and not all("Latin" in readings(c) for c in letters):
            out |= shared
    return frozenset(out)


def plain_token(token: str, proved: frozenset[str] = frozenset()) -> str:
    """The spelling of a token in one script, if it mixes scripts or is a whole-script confusable."""
    letters = [c for c in token if not unicodedata.combining(c)]
    own = [scripts_of(c) for c in letters]
    shared = frozenset.intersection(*own)
    symbol = any("Greek" in s for s in own) and len(letters) < 3 and not all(c.isupper() for c in letters)
    if "Latin" in shared or shared & proved or symbol or (len(letters) == 1 and "Greek" in shared):
        return token
    able = frozenset.intersection(*(frozenset(readings(c)) for c in letters))
    if shared:
        able &= {"Latin"}
    if not able:
        return token
    if "Latin" in able:
        able &= proved | {"Latin"}
    target = max(able, key=lambda s: (sum(s in o for o in own), s == "Latin", s))
    return "".join(readings(c).get(target, c) for c in token)


def plain_form(text: str) -> tuple[str, list[str]]:
    """The consistent form of a text and the kinds of differences found, in the order of KINDS."""
    kinds: list[str] = []
    joined = "\u200d" in text and _EMOJI_JOIN.search(text) is not None
    if joined:
        text = _EMOJI_JOIN.sub(_HELD, text)
    s = _INVISIBLE.sub("", text)
    if s != text:
        kinds.append("invisible")
    t = _SPACES.sub(" ", s)
    if t != s:
        kinds.append("space")
    u = _WIDTH.sub(lambda m: unicodedata.normalize("NFKC", m[0]), t)
    u = _STYLED.sub(lambda m: unicodedata.normalize("NFKC", m[0]), u)
    if u != t:
        kinds.append("width")
    v = unicodedata.normalize("NFC", u)
    if v != u:
        kinds.append("decomposed")
    w = _FORM_IN_WORD.sub(lambda m: LATIN_FORMS[m[0]], v)
    if _OTHER_LETTER.search(w):
        proved = proved_scripts(_TOKEN.findall(w))
        w = unicodedata.normalize("NFC", _TOKEN.sub(lambda m: plain_token(m[0], proved), w))
    if w != v:
        kinds.append("script")
    return (w.replace(_HELD, "\u200d") if joined else w), kinds


def _plain_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("text", pa.string()), ("kinds", pa.list_(pa.string()))])
    for batch in batches:
        out = []
        for text in batch.to_pylist():
            if text is None:
                out.append(None)
            else:
                form, kinds = plain_form(text)
                out.append({"text": form, "kinds": kinds})
        yield pa.array(out, type=kind)


def with_plain_form(df: DataFrame, text: str, into: str, kinds: str | None = None) -> DataFrame:
    """Add the consistent form of column ``text`` as ``into`` (and the kinds found as ``kinds``).

    Rows without a suspicious character keep their text unread; only the others cross to Python.
    Columns of the input keep their values whatever their names; ``into`` and ``kinds`` are replaced
    if they exist.
    """
    column = F.col(f"`{text}`")
    suspicious = column.rlike(SUSPICIOUS)
    held = df.withColumn("__form", F.arrow_udf(_plain_batches, "text string, kinds array<string>")(F.when(suspicious, column)))
    held = held.withColumn(into, F.when(F.col("__form").isNotNull(), F.col("__form.text")).otherwise(column))
    if kinds:
        empty = F.array().cast("array<string>")
        held = held.withColumn(kinds, F.when(F.col("__form").isNotNull(), F.col("__form.kinds")).otherwise(empty))
    return held.drop("__form")


_MARKS = re.compile("[①-⓿❶-➓ᅟᅠㅤ\u00ad]")
_NOT_WORD = re.compile(r"[\W_]+")
_LOOKS_TABLE = str.maketrans(LOOKS)


def fold_for_match(text: str) -> str:
    """Letters and digits only, in one form and lower case: what problem 7 compares."""
    if not text.isascii():
        text = _MARKS.sub("", text)
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", _INVISIBLE.sub("", text))
        if _OTHER_LETTER.search(text):
            text = text.translate(_LOOKS_TABLE)
    return _NOT_WORD.sub("", text).lower()


def has_difference(kinds: Column) -> Column:
    return F.size(kinds) > 0
