"""Boxes, columns, clips and rectangle joins. Rectangle joins are always keyed by document and page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def width(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["x1"] - b["x0"])


def height(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["y1"] - b["y0"])


def area(b: Column) -> Column:
    return width(b) * height(b)


def box(x0, y0, x1, y1) -> Column:
    return F.struct(x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def pad(b: Column, page_width: Column, page_height: Column, by: float = 8.0) -> Column:
    return box(F.greatest(F.lit(0.0), b["x0"] - by), F.greatest(F.lit(0.0), b["y0"] - by), F.least(page_width, b["x1"] + by), F.least(page_height, b["y1"] + by))


def clamp(b: Column, page: Column) -> Column:
    return box(F.greatest(b["x0"], page["x0"]), F.greatest(b["y0"], page["y0"]), F.least(b["x1"], page["x1"]), F.least(b["y1"], page["y1"]))


def flip_y(b: Column, page_height: Column) -> Column:
    """Bottom-left coordinates to top-left ones."""
    return box(b["x0"], page_height - b["y1"], b["x1"], page_height - b["y0"])


def overlaps(a: Column, b: Column) -> Column:
    """Open rectangles share an inner point."""
    return (a["x1"] > b["x0"]) & (a["x0"] < b["x1"]) & (a["y1"] > b["y0"]) & (a["y0"] < b["y1"])


def contains_point(b: Column, x: Column, y: Column) -> Column:
    return x.between(b["x0"], b["x1"]) & y.between(b["y0"], b["y1"])


def shared_area(a: Column, b: Column) -> Column:
    w = F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"]))
    h = F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"]))
    return w * h


def union_box(b: str) -> Column:
    """Aggregate: the box around all boxes."""
    return F.struct(F.min(f"{b}.x0").alias("x0"), F.min(f"{b}.y0").alias("y0"), F.max(f"{b}.x1").alias("x1"), F.max(f"{b}.y1").alias("y1"))


def content_bounds(page: Column) -> Column:
    """Vertical bounds of the text of a page: the first page has a taller head."""
    return F.struct(F.when(page == 1, 215.0).otherwise(60.0).alias("top"), F.lit(790.0).alias("bottom"))


def page_column(b: Column, page_width: Column) -> Column:
    return F.when((b["x0"] + b["x1"]) / 2 < page_width / 2, 0).otherwise(1)


def text_overlap(rects: DataFrame, words: DataFrame, keys: list[str]) -> DataFrame:
    """(rect_id, ratio, n_words, is_text_heavy): how much of each rectangle words cover."""
    met = rects.join(words, keys, "left")
    share = F.when(overlaps(F.col("rect"), F.col("word")), shared_area(F.col("rect"), F.col("word"))).otherwise(0.0)
    hit = F.when(overlaps(F.col("rect"), F.col("word")), 1).otherwise(0)
    out = met.groupBy("rect_id").agg(F.sum(share).alias("covered"), F.first(area(F.col("rect"))).alias("size"), F.sum(hit).cast("int").alias("n_words"))
    ratio = F.when(F.col("size") > 0, F.col("covered") / F.col("size")).otherwise(0.0)
    return out.select("rect_id", ratio.alias("ratio"), "n_words", ((ratio >= 0.35) & (F.col("n_words") >= 8)).alias("is_text_heavy"))


def blocks_in_clip(blocks: DataFrame, clips: DataFrame, keys: list[str], least_share: float = 0.3) -> DataFrame:
    """Blocks that overlap a clip by at least a share of their own width."""
    b, c = F.col("block"), F.col("clip")
    x = F.least(b["x1"], c["x1"]) - F.greatest(b["x0"], c["x0"])
    y = F.least(b["y1"], c["y1"]) - F.greatest(b["y0"], c["y0"])
    return blocks.join(clips, keys).where((b["x1"] > b["x0"]) & (b["y1"] > b["y0"]) & (x > 0) & (y > 0) & (x / (b["x1"] - b["x0"]) >= least_share))


def columns_by_starts(blocks: DataFrame, keys: list[str], page_width: float = 595.0, least_gap: float = 0.15) -> DataFrame:
    """(keys, n_columns, separator): two columns if the widest gap between left edges is wide enough.

    Needs four boxes and two on each side of the separator; of equal gaps the leftmost counts.
    ``blocks`` has ``bbox``.
    """
    w = Window.partitionBy(*keys).orderBy("x0")
    rows = blocks.where("bbox is not null").select(*keys, F.col("bbox.x0").alias("x0"), F.col("bbox.x1").alias("x1"))
    rows = rows.withColumn("next", F.lead("x0").over(w))
    best = rows.groupBy(*keys).agg(
        F.max_by(F.struct((F.col("next") - F.col("x0")).alias("gap"), ((F.col("x0") + F.col("next")) / 2).alias("at")), F.struct(F.col("next") - F.col("x0"), -F.col("x0"))).alias("g"),
        F.count(F.lit(1)).alias("n"), F.collect_list((F.col("x0") + F.col("x1")) / 2).alias("centres"),
    )
    left = F.size(F.filter("centres", lambda c: c < F.col("g.at")))
    two = (F.col("n") >= 4) & (F.col("g.gap") >= page_width * least_gap) & (left >= 2) & (F.col("n") - left >= 2)
    return best.select(*keys, F.when(two, 2).otherwise(1).alias("n_columns"), F.when(two, F.col("g.at")).alias("separator"))


def columns_by_centres(blocks: DataFrame, keys: list[str], page_width: float = 595.0) -> DataFrame:
    """(keys, n_columns, l0, l1, r0, r1): padded columns split at the widest gap between box centres."""
    rows = blocks.where("bbox.x1 > bbox.x0").select(*keys, F.col("bbox.x0").alias("x0"), F.col("bbox.x1").alias("x1"), ((F.col("bbox.x0") + F.col("bbox.x1")) / 2).alias("c"))
    w = Window.partitionBy(*keys).orderBy("c")
    rows = rows.withColumn("next", F.lead("c").over(w))
    whole = Window.partitionBy(*keys)
    gap = F.col("next") - F.col("c")
    rows = rows.withColumn("best", F.max_by(F.struct(gap.alias("gap"), ((F.col("c") + F.col("next")) / 2).alias("at")), F.struct(gap, -F.col("c"))).over(whole))
    left = F.col("c") <= F.col("best.at")
    on = lambda agg, side, x: agg(F.when(side, F.col(x)))
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.first("best").alias("best"), F.count_if(left).alias("n_left"),
        on(F.min, left, "x0").alias("l0"), on(F.max, left, "x1").alias("l1"), on(F.min, ~left, "x0").alias("r0"), on(F.max, ~left, "x1").alias("r1"),
    )
    two = (F.col("n") >= 4) & (F.col("best.gap") >= page_width * 0.18) & (F.col("n_left") >= 2) & (F.col("n") - F.col("n_left") >= 2)
    out = out.withColumn("two", F.coalesce(two, F.lit(False)))
    lo, hi = (lambda x: F.greatest(F.lit(0.0), F.col(x) - 4.0)), (lambda x: F.least(F.lit(page_width), F.col(x) + 4.0))
    out = out.select(*keys, F.when(F.col("two"), 2).otherwise(1).alias("n_columns"), lo("l0").alias("l0"), hi("l1").alias("l1"), lo("r0").alias("r0"), hi("r1").alias("r1"), "two")
    return separate_columns(out).withColumns({k: F.when(F.col("two"), F.col(k)) for k in ("r0", "r1")} | {"l0": F.when(F.col("two"), F.col("l0")).otherwise(0.0), "l1": F.when(F.col("two"), F.col("l1")).otherwise(page_width)}).drop("two")


def separate_columns(columns: DataFrame) -> DataFrame:
    """Two columns (l0, l1, r0, r1) that overlap are parted at the middle with 2 on each side."""
    clash = F.col("l1") >= F.col("r0")
    mid = (F.col("l1") + F.col("r0")) / 2
    return columns.withColumns({"l1": F.when(clash, F.greatest(F.col("l0"), mid - 2.0)).otherwise(F.col("l1")), "r0": F.when(clash, F.least(F.col("r1"), mid + 2.0)).otherwise(F.col("r0"))})


def apply_column_template(pages: DataFrame, doc: str) -> DataFrame:
    """Pages found to have one column take the median columns of their document's two-column pages, if it has two."""
    two = pages.where("n_columns = 2").groupBy(doc).agg(F.count(F.lit(1)).alias("n_two"), *[F.median(c).alias(f"t_{c}") for c in ("l0", "l1", "r0", "r1")])
    joined = pages.join(two.where("n_two >= 2"), doc, "left")
    use = (F.col("n_columns") == 1) & F.col("n_two").isNotNull()
    out = joined.withColumns({c: F.when(use, F.col(f"t_{c}")).otherwise(F.col(c)) for c in ("l0", "l1", "r0", "r1")})
    out = out.withColumn("from_template", use).withColumn("n_columns", F.when(use, 2).otherwise(F.col("n_columns")))
    return out.drop("n_two", "t_l0", "t_l1", "t_r0", "t_r1")


def expand_columns(columns: DataFrame, keys: list[str], page_width: float = 595.0, margin: float = 18.0, guard: float = 2.0) -> DataFrame:
    """Widen each column (idx, x0, x1) by a margin, bounded by its neighbours; too narrow ones stay."""
    w = Window.partitionBy(*keys).orderBy("idx")
    lo = F.greatest(F.lit(0.0), F.col("x0") - margin, F.coalesce(F.lag("x1").over(w) + guard, F.lit(0.0)))
    hi = F.least(F.lit(page_width), F.col("x1") + margin, F.coalesce(F.lead("x0").over(w) - guard, F.lit(page_width)))
    return columns.withColumn("wide_x0", F.when(hi <= lo + 4.0, F.col("x0")).otherwise(lo)).withColumn("wide_x1", F.when(hi <= lo + 4.0, F.col("x1")).otherwise(hi))


def raw_clip(start_y: Column, end_y: Column, page_height: Column, part: Column, top: float = 6.0, gap: float = 2.0, footer: float = 0.0) -> Column:
    """Vertical clip of a segment: the first part starts below its line, the last one ends above the footer."""
    y0 = F.greatest(F.lit(0.0), start_y - top)
    y0 = F.when(part == 1, F.greatest(y0, start_y + 1.0)).otherwise(y0)
    y1 = F.least(page_height, end_y - gap)
    y1 = F.when(end_y >= page_height - 1.0, F.least(y1, F.greatest(y0 + 5.0, page_height - footer))).otherwise(y1)
    return F.struct(y0.alias("y0"), y1.alias("y1"))


def renders(part: Column, size: Column) -> Column:
    """Whether a segment is worth an image: over 4 high, later parts at least 150."""
    return (size > 4.0) & ((part < 2) | (size >= 150.0))


def refine_y(y0: Column, y1: Column, text_y0: Column, text_y1: Column) -> Column:
    """Shrink a clip to its text plus 3; keep it if nothing would be left or there is no text."""
    a, b = F.greatest(y0, text_y0 - 3.0), F.least(y1, text_y1 + 3.0)
    keep = F.coalesce(b <= a + 4.0, F.lit(True))
    return F.struct(F.when(keep, y0).otherwise(a).alias("y0"), F.when(keep, y1).otherwise(b).alias("y1"))


def refine_x(x0: Column, x1: Column, text_x0: Column, text_x1: Column) -> Column:
    """Shrink a side to the text plus 12 where more than 24 is empty."""
    a = F.when(text_x0 - x0 > 24.0, F.greatest(x0, text_x0 - 12.0)).otherwise(x0)
    b = F.when(x1 - text_x1 > 24.0, F.least(x1, text_x1 + 12.0)).otherwise(x1)
    keep = b <= a + 4.0
    return F.struct(F.when(keep, x0).otherwise(a).alias("x0"), F.when(keep, x1).otherwise(b).alias("x1"))


def split_clip(y0: Column, y1: Column, choice_y0: Column) -> Column:
    """Problem and choices part of a clip, parted at the topmost block with a choice line."""
    at = F.greatest(y0, choice_y0)
    p_end = F.least(y1, at - 1.0)
    p, c = p_end > y0 + 4.0, y1 > at + 4.0
    lone = choice_y0.isNull() | (~p & ~c)
    return F.struct(
        F.when(lone | p, y0).alias("p0"), F.when(lone, y1).when(p, p_end).alias("p1"), F.when(~lone & c, at).alias("c0"), F.when(~lone & c, y1).alias("c1"),
    )


def choice_block_top(blocks: DataFrame, keys: list[str], wide: bool = False) -> DataFrame:
    """(keys, choice_y0): top of the first block that has a choice line."""
    is_choice = (lambda x: x.rlike(T.OCR_CHOICE)) if wide else (lambda x: x.rlike(r"^\s*[①-⑩]\s*|^\s*\(\s*[1-5]\s*\)\s*"))
    return blocks.where(F.exists(T.lines_of(F.col("text")), is_choice)).groupBy(*keys).agg(F.min("bbox.y0").alias("choice_y0"))


def nearest_column(x: Column, centres: Column) -> Column:
    """Index of the nearest centre, the first of equally near ones."""
    d = F.transform(centres, lambda c: F.abs(c - x))
    return (F.array_position(d, F.array_min(d)) - 1).cast("int")


def margin_texts(blocks: DataFrame, key: str, top: float = 0.12, bottom: float = 0.06) -> DataFrame:
    """(key, margin_text, n_top, n_bottom): texts of blocks wholly within a page margin."""
    t = T.normalize_lines(F.col("text"))
    is_top, is_bottom = F.col("bbox.y1") <= F.col("page_height") * top, F.col("bbox.y0") >= F.col("page_height") * (1 - bottom)
    rows = blocks.select(key, t.alias("margin_text"), is_top.alias("t"), is_bottom.alias("b")).where("margin_text <> '' and (t or b)")
    return rows.groupBy(key, "margin_text").agg(F.count_if("t").alias("n_top"), F.count_if("b").alias("n_bottom"))


def is_top_noise(text: Column, y0: Column, y1: Column) -> Column:
    t = T.collapse(text)
    return (t != "") & ~((y0 > 48.0) & (y1 > 56.0)) & t.rlike(T.TOP_NOISE)


def is_bottom_noise(text: Column) -> Column:
    t = T.collapse(text)
    return (t != "") & t.rlike(T.BOTTOM_NOISE)


def anchor_medians(lines: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, anchor_x): median left edge of numbered lines; anchors more than 20 away are continuations."""
    return lines.where(T.question_number(F.col("text")).between(1, 100) & F.col("bbox").isNotNull()).groupBy(*keys).agg(F.median("bbox.x0").alias("anchor_x"))


def sparse_marker_shift(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, lead): how far above the first of three or more evenly spaced lone marks the choices start."""
    marks = blocks.where(T.is_marker_only(F.col("text"))).select(*keys, F.col("bbox.y0").alias("y0"), F.col("bbox.y1").alias("y1"))
    w = Window.partitionBy(*keys).orderBy("y0")
    marks = marks.withColumn("gap", F.lead("y0").over(w) - F.col("y0"))
    out = marks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg("gap").alias("avg"), (F.max("gap") - F.min("gap")).alias("spread"), F.min_by(F.col("y1") - F.col("y0"), "y0").alias("h"), F.min("y0").alias("first_y0"))
    even = (F.col("n") >= 3) & (F.col("avg") > 8.0) & (F.col("spread") <= F.greatest(F.lit(6.0), F.col("avg") * 0.25))
    return out.where(even).select(*keys, "first_y0", F.greatest(F.greatest(F.lit(1.0), F.col("h")) * 1.6, F.col("avg") * 0.78).alias("lead"))


def is_rule(mean: Column, sd: Column, dark: Column, run: Column) -> Column:
    """A pixel row that looks like a printed rule."""
    return (dark >= 0.88) | ((sd <= 8.0) & (mean <= 247.0)) | ((run >= 0.75) & (dark >= 0.18) & (mean <= 252.0) & (sd <= 32.0))


def is_vertical_rule(mean: Column, sd: Column, dark: Column, run: Column) -> Column:
    return ((run >= 0.9) & (dark >= 0.65)) | ((run >= 0.92) & (sd <= 12.0) & (mean <= 250.0)) | ((run >= 0.85) & (dark >= 0.75) & (sd <= 45.0) & (mean <= 230.0))


def pixel_stats(rows: DataFrame, key: list[str], pixels: str, dark_at: float = 235.0) -> DataFrame:
    """(key, mean, sd, dark_ratio, longest_run_ratio) of arrays of grey values."""
    p = F.col(pixels)
    n = F.size(p)
    mean = F.aggregate(p, F.lit(0.0), lambda a, x: a + x) / n
    var = F.aggregate(p, F.lit(0.0), lambda a, x: a + (x - mean) * (x - mean)) / n
    dark = F.size(F.filter(p, lambda x: x <= dark_at)) / n
    run = F.aggregate(p, F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")), lambda a, x: F.struct(F.when(x <= dark_at, a["now"] + 1).otherwise(0).alias("now"), F.greatest(a["best"], F.when(x <= dark_at, a["now"] + 1).otherwise(0)).alias("best")), lambda a: a["best"]) / n
    return rows.select(*key, mean.alias("mean"), F.sqrt(var).alias("sd"), dark.alias("dark_ratio"), run.alias("longest_run_ratio"))


def best_spans(spans: DataFrame, keys: list[str], k: int, least: float) -> DataFrame:
    """The k best scored spans (start, end, score) of each key, in position order; narrow and unscored ones drop."""
    good = spans.where((F.col("end") - F.col("start") >= least) & (F.col("score") > 0))
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc(F.col("end") - F.col("start")), "start")
    top = good.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return top.withColumn("span_no", F.row_number().over(Window.partitionBy(*keys).orderBy("start"))).drop("rank")
