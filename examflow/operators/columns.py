"""Repairs of detected columns and crops of drawings: per page, as expressions and keyed joins.

Column pairs are the columns l0, l1, r0, r1 of a page; one column is r0 and r1 null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from . import layout

_C = ("l0", "l1", "r0", "r1")


def start_centres(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, centres): sorted x centres of lines that start a question."""
    rows = lines.where(F.col("text").rlike(T.LEGACY_START) & F.col("bbox").isNotNull())
    return rows.groupBy(*keys).agg(F.array_sort(F.collect_list((F.col("bbox.x0") + F.col("bbox.x1")) / 2)).alias("centres"))


def from_separator(x: Column, page_width: Column, half_gap: float = 8.0) -> Column:
    """Columns either side of a separator; one column if nothing would be left."""
    l1, r0 = F.greatest(F.lit(0.0), F.least(page_width, x - half_gap)), F.greatest(F.lit(0.0), F.least(page_width, x + half_gap))
    one = (page_width <= 0) | (r0 <= l1 + 4.0)
    null = F.lit(None).cast("double")
    return F.struct(F.lit(0.0).alias("l0"), F.when(one, page_width).otherwise(l1).alias("l1"), F.when(one, null).otherwise(r0).alias("r0"), F.when(one, null).otherwise(page_width).alias("r1"))


def widest_gap(centres: Column) -> Column:
    """(gap, at) of sorted numbers: the widest gap and its middle, the first of equal ones."""
    pairs = F.transform(F.sequence(F.lit(1), F.size(centres) - 1), lambda i: F.struct((F.get(centres, i) - F.get(centres, i - 1)).alias("gap"), (-i).alias("first"), ((F.get(centres, i) + F.get(centres, i - 1)) / 2).alias("at")))
    return F.when(F.size(centres) >= 2, F.array_max(pairs))


def repaired_columns(pages: DataFrame, page_width: float = 595.0) -> DataFrame:
    """Pages (l0, l1, r0, r1, separator, centres) with safer columns.

    A printed separator decides. Else two columns of which one is under 30 % wide are parted anew at
    the widest gap between question starts, and two tight columns without any start on the right
    become one.
    """
    w = F.lit(page_width)
    two = F.col("r0").isNotNull()
    gap = widest_gap(F.col("centres"))
    narrow = F.least(F.col("l1") - F.col("l0"), F.col("r1") - F.col("r0")) / w < 0.3
    anew = two & narrow & (gap["gap"] >= page_width * 0.18) & gap["at"].between(page_width * 0.25, page_width * 0.75)
    rebuilt = F.when(F.coalesce(anew, F.lit(False)), from_separator(gap["at"], w, 4.0)).otherwise(F.struct(*_C))
    out = pages.withColumn("__c", F.when(F.col("separator").isNotNull(), from_separator(F.col("separator"), w)).otherwise(rebuilt))
    c = F.col("__c")
    between = c["r0"] - c["l1"]
    covered = (c["l1"] - c["l0"]) + (c["r1"] - c["r0"]) + F.greatest(between, F.lit(0.0))
    no_right = F.size(F.filter("centres", lambda x: x > (c["l1"] + c["r0"]) / 2)) == 0
    tight = F.col("separator").isNull() & (F.size("centres") > 0) & (between <= 12.0) & (covered / w >= 0.85) & no_right
    one = F.struct(F.lit(0.0).alias("l0"), w.alias("l1"), F.lit(None).cast("double").alias("r0"), F.lit(None).cast("double").alias("r1"))
    out = out.withColumn("__c", F.when(F.coalesce(tight, F.lit(False)), one).otherwise(c))
    return out.withColumns({k: F.col(f"__c.{k}") for k in _C}).drop("__c")


def widen_left(l1: Column, r0: Column, x1: Column, page_width: Column) -> Column:
    """Right edge of a left column, 24 wider where the gap to the right column is at most 12."""
    return F.when((r0 - l1) <= 12.0, F.least(page_width, x1 + 24.0)).otherwise(x1)


def safe_refine_x(x0: Column, x1: Column, text_x0: Column, text_x1: Column) -> Column:
    """``refine_x`` that gives small cuts back: up to 24 on the right and 8 on the left."""
    fine = layout.refine_x(x0, x1, text_x0, text_x1)
    a = F.when(fine["x0"] - x0 <= 8.0, x0).otherwise(fine["x0"])
    b = F.when(x1 - fine["x1"] <= 24.0, x1).otherwise(fine["x1"])
    return F.struct(F.when(b <= a + 4.0, x0).otherwise(a).alias("x0"), F.when(b <= a + 4.0, x1).otherwise(b).alias("x1"))


def separator_of_runs(runs: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, separator): middle of the longest run of rule-like pixel columns, the first of equal ones."""
    return runs.groupBy(*keys).agg(F.max_by((F.col("start") + F.col("end")) / 2, F.struct(F.col("end") - F.col("start"), -F.col("start"))).alias("separator"))


def shifted_split(p1: Column, c0: Column, y0: Column, y1: Column, first_y0: Column, lead: Column) -> Column:
    """Where evenly spaced lone marks start a table, the choices start ``lead`` above the first one."""
    at = F.least(F.greatest(y0, first_y0 - lead), c0)
    good = (at < c0 - 2.0) & (at - 1.0 > y0 + 4.0) & (y1 > at + 4.0)
    good = F.coalesce(good, F.lit(False))
    return F.struct(F.when(good, at - 1.0).otherwise(p1).alias("p1"), F.when(good, at).otherwise(c0).alias("c0"))


def without_page_noise(blocks: DataFrame) -> DataFrame:
    """Blocks that are neither blank nor running text of the top or bottom of a page, trimmed."""
    t = T.trim_u(F.col("text"))
    return blocks.withColumn("text", t).where((F.col("text") != "") & ~layout.is_top_noise(F.col("text"), F.col("bbox.y0"), F.col("bbox.y1")) & ~layout.is_bottom_noise(F.col("text")))


def reading_order(lines: DataFrame, keys: list[str], into: str = "seq", *ties: str) -> DataFrame:
    """Number lines of a column by rows of 4 units, then from left to right (half-even rounding), then by ``ties``."""
    w = Window.partitionBy(*keys).orderBy(F.bround(F.col("bbox.y0") / 4, 0), "bbox.x0", "bbox.y0", *ties)
    return lines.withColumn(into, F.row_number().over(w))


def ordered_words(words: DataFrame, pages: DataFrame, doc: str) -> DataFrame:
    """Words within the vertical bounds of their page, with their column; the last page is left out."""
    last = Window.partitionBy(doc)
    kept = pages.withColumn("__last", F.max("page").over(last)).where("page < __last").drop("__last")
    bounds = layout.content_bounds(F.col("page"))
    rows = words.join(kept, [doc, "page"]).where((F.col("bbox.y0") >= bounds["top"]) & (F.col("bbox.y1") <= bounds["bottom"]))
    return rows.withColumn("column_index", layout.page_column(F.col("bbox"), F.col("page_width")))


def visual_candidates(drawings: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """Drawings (rect_id, rect) within the page bounds, at least 20 by 12, that are not mostly text."""
    r, bounds = F.col("rect"), layout.content_bounds(F.col("page"))
    fit = drawings.where((r["y0"] >= bounds["top"]) & (r["y1"] <= bounds["bottom"]) & (layout.width(r) >= 20) & (layout.height(r) >= 12))
    heavy = layout.text_overlap(fit, words, keys).where("is_text_heavy").select("rect_id")
    return fit.join(heavy, "rect_id", "left_anti")


def crops_of_questions(questions: DataFrame, drawings: DataFrame, keys: list[str], doc: str, first_id: int = 1) -> DataFrame:
    """Drawings whose centre lies in the box of a question (8 and 12 wider), numbered within a document.

    ``questions``: keys, question_index, box; ``drawings``: keys, rect.
    """
    q, r = F.col("box"), F.col("rect")
    wide = layout.box(q["x0"] - 8, q["y0"] - 12, q["x1"] + 8, q["y1"] + 12)
    met = questions.join(drawings, keys).where(layout.contains_point(wide, (r["x0"] + r["x1"]) / 2, (r["y0"] + r["y1"]) / 2))
    w = Window.partitionBy(doc).orderBy("question_index", "page", "rect.y0", "rect.x0")
    out = met.withColumn("element_id", F.row_number().over(w) + first_id - 1)
    return out.withColumn("crop_path", F.concat(F.lit("crops/crop_id"), T.padded(F.col("element_id"), 4), F.lit("_p"), F.col("page").cast("string"), F.lit(".png")))


def visual_band(lines: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, top, bottom): between the first line of a question and its first choice; none if inverted."""
    out = lines.groupBy(*keys).agg(F.min_by("bbox.y1", order).alias("top"), F.min(F.when(F.col("text").rlike("^[①②③④]"), F.col("bbox.y0"))).alias("bottom"))
    return out.where("bottom > top")


def boxed_lines(lines: DataFrame, keys: list[str], order: str, matched: str) -> DataFrame:
    """Add ``included``: matched lines and the label line right before the first of them."""
    w = Window.partitionBy(*keys)
    first = F.min(F.when(F.col(matched), F.col(order))).over(w)
    return lines.withColumn("included", F.coalesce(F.col(matched) | ((F.col(order) == first - 1) & T.is_boxed_label(F.col("text"))), F.lit(False)))


def boxed_rect(lines: DataFrame, keys: list[str], order: str, page: Column, by: float = 6.0) -> DataFrame:
    """(keys, rect): the drawing of a boxed text grown to its included lines, not into the line before.

    ``lines`` has the drawing as ``rect`` on every row and ``included``.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.lag("bbox.y1").over(w)
    rows = lines.withColumn("__before", before).where("included")
    a = rows.groupBy(*keys).agg(layout.union_box("bbox").alias("b"), F.first("rect").alias("r"), F.min_by(F.struct(F.col("__before").alias("bottom"), F.col("bbox.y0").alias("top")), order).alias("f"))
    top = F.least(F.col("r.y0"), F.col("b.y0") - by)
    top = F.when(F.col("f.bottom") < F.col("f.top"), F.greatest(top, (F.col("f.bottom") + F.col("f.top")) / 2)).otherwise(top)
    rect = layout.box(F.least(F.col("r.x0"), F.col("b.x0") - by), top, F.greatest(F.col("r.x1"), F.col("b.x1") + by), F.greatest(F.col("r.y1"), F.col("b.y1") + by))
    return a.select(*keys, layout.clamp(rect, page).alias("rect"))


def asset_groups(blocks: DataFrame, doc: str, question: str, page_width: float = 595.0, page_height: float = 842.0) -> DataFrame:
    """(doc, question, page, column_label, rect, file): one padded box for each page column of a question."""
    out = blocks.groupBy(doc, question, "page", "column_label").agg(layout.union_box("bbox").alias("b"))
    w = Window.partitionBy(doc, question).orderBy("page", "column_label")
    n = T.padded
    out = out.withColumn("n", F.row_number().over(w))
    file = F.concat(F.lit("q"), n(F.col(question), 3), F.lit("_p"), n(F.col("page"), 2), F.lit("_"), F.col("column_label"), F.lit("_"), n(F.col("n"), 2), F.lit(".png"))
    return out.select(doc, question, "page", "column_label", layout.pad(F.col("b"), F.lit(page_width), F.lit(page_height)).alias("rect"), file.alias("file"))


def crop_of_element(bbox: Column, page: Column, n_pages: Column, page_height: Column) -> Column:
    """Top-left rectangle of an element in bottom-left coordinates; null without a box of four or outside the document."""
    good = (F.size(bbox) == 4) & page.between(1, n_pages)
    g = lambda i: F.get(bbox, F.lit(i))
    return F.when(F.coalesce(good, F.lit(False)), layout.box(g(0), page_height - g(3), g(2), page_height - g(1)))
