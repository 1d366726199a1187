"""Element trees: flattening, node filters, Markdown, and the question state machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..common import cut_lineage
from ..functions import text as T

VISUAL = ("image", "table", "picture", "figure", "formula")
DROPPED = ("header", "footer", "caption")
MARK = "[①-⑩]"


def flatten(docs: DataFrame, doc: str, raw: str, max_depth: int = 12) -> DataFrame:
    """Every node of each tree: doc, path, parent_path, role, and the fields of the node.

    The tree is parsed once and goes down level by level: each level explodes the nodes reached last
    into themselves and their ``kids`` and ``list items``, without a shuffle. Order by ``path`` is
    pre-order. Trees deeper than ``max_depth`` raise an error at run time instead of losing nodes.
    """
    kind = "array<struct<path:array<int>,role:string,node:variant,open:boolean>>"
    nodes = docs.select(doc, F.array().cast("array<int>").alias("path"), F.lit(None).cast("string").alias("role"), F.try_parse_json(raw).alias("node"), F.lit(True).alias("open")).where("node is not null")

    def below(field: str, rank: int) -> Column:
        items = F.filter(
            F.transform(F.try_variant_get("node", f"$['{field}']", "array<variant>"), lambda x, i: F.struct(F.concat("path", F.array(F.lit(rank), i)).alias("path"), F.lit(field).alias("role"), x.alias("node"), F.lit(True).alias("open"))),
            lambda c: F.schema_of_variant(c["node"]).startswith("OBJECT"),
        )
        return F.when(F.col("open"), F.coalesce(items, F.array().cast(kind))).otherwise(F.array().cast(kind)).cast(kind)

    for depth in range(max_depth + 1):
        children = F.concat(below("kids", 0), below("list items", 1))
        if depth == max_depth:
            children = F.when(F.size(children) > 0, F.raise_error(F.lit("tree deeper than max_depth")).cast(kind)).otherwise(children)
        own = F.array(F.struct("path", "role", "node", F.lit(False).alias("open"))).cast(kind)
        nodes = nodes.select(doc, F.explode(F.concat(own, children)).alias("n")).select(doc, "n.*")
    out = nodes.where(F.size("path") > 0)
    get = lambda p, t: F.try_variant_get("node", p, t)
    return out.select(
        doc, "path", F.slice("path", F.lit(1), F.size("path") - 2).alias("parent_path"), "role", get("$.type", "string").alias("type"), get("$.id", "int").alias("id"),
        get("$['page number']", "int").alias("page_number"), get("$['bounding box']", "array<double>").alias("bbox"), get("$.content", "string").alias("content"),
        get("$['numbering style']", "string").alias("numbering_style"), get("$.source", "string").alias("source"), get("$['heading level']", "int").alias("heading_level"),
    )


def content_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes that are not headers, footers or captions; captions with a choice mark stay."""
    marked = (F.col("type") == "caption") & F.coalesce(F.col("content"), F.lit("")).rlike(MARK)
    return nodes.where(~F.coalesce(F.col("type"), F.lit("")).isin(*DROPPED) | marked)


def image_nodes(nodes: DataFrame) -> DataFrame:
    return nodes.where(F.col("type").isin(*VISUAL))


def element_markdown(element_type: Column, content: Column, level: Column, image_path: Column, source: Column, latex: Column) -> Column:
    """Markdown of one element without nested ones; empty for elements that print nothing."""
    c = F.coalesce(content, F.lit(""))
    base = F.element_at(F.split(source, "/"), -1)
    picture = F.coalesce(F.nullif(image_path, F.lit("")), F.when(F.coalesce(source, F.lit("")) != "", F.concat(F.lit("./images/"), base)))
    link = lambda name, path: F.coalesce(F.concat(F.lit(f"!["), F.lit(name), F.lit("]("), path, F.lit(")")), F.lit(""))
    return (
        F.when(element_type == "heading", F.concat(F.repeat(F.lit("#"), F.least(F.greatest(F.coalesce(level, F.lit(1)), F.lit(1)), F.lit(6))), F.lit(" "), c))
        .when(element_type.isin("paragraph", "text block"), c).when(element_type == "caption", F.concat(F.lit("*"), c, F.lit("*"))).when(element_type.isin("list item", "list"), F.concat(F.lit("- "), c))
        .when(element_type == "table", link("표", F.nullif(image_path, F.lit("")))).when(element_type.isin("image", "picture", "figure"), link("그림", picture))
        .when(element_type == "formula", F.when(F.coalesce(latex, F.lit("")) != "", F.concat(F.lit("$"), latex, F.lit("$"))).otherwise(link("수식", F.nullif(image_path, F.lit(""))))).otherwise("")
    )


def assemble_markdown(elements: DataFrame, doc: str, order: str, markdown: str = "md") -> DataFrame:
    """(doc, markdown): elements in order; blank lines before headings and lists and between paragraphs.

    The type before is that of the last element that printed something.
    """
    rows = elements.where(F.col(markdown) != "")
    before = F.lag("type").over(Window.partitionBy(doc).orderBy(order))
    prose = ("paragraph", "text block")
    gap = (F.col("type").isin("heading", "list") & before.isNotNull() & (before != "heading")) | (F.col("type").isin(*prose) & before.isin(*prose))
    rows = rows.withColumn("line", F.when(F.coalesce(gap, F.lit(False)), F.concat(F.lit("\n"), F.col(markdown))).otherwise(F.col(markdown)))
    parts = F.array_sort(F.collect_list(F.struct(F.col(order), F.col("line"))))
    return rows.groupBy(doc).agg(F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("markdown"))


def link_crops(images: DataFrame, crops: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Images with the crop of their element id; of several crops the last counts."""
    last = crops.groupBy(*keys, "element_id").agg(F.max_by("crop_path", order).alias("crop_path"))
    return images.join(last, [*keys, "element_id"], "left")


ASSET = "element_id:int,type:string,page_number:int,bounding_box:array<double>,source:string"
_CHOICES = "array<struct<number:int,text:string,image:int>>"
CIRCLED_STYLE = "circled arabic numbers"


def _choices_of_text(text: Column) -> Column:
    """Choices of a text with marks; none where it is null."""
    no_image = F.lit(None).cast("int").alias("image")
    return F.coalesce(F.transform(T.split_choices(text), lambda c: F.struct(c["number"].alias("number"), c["text"].alias("text"), no_image)), F.array()).cast(_CHOICES)


def _choices_of_items(items: Column) -> Column:
    """Choices of list items (i, content): their mark tells the number, or else their place."""

    def choice(item: Column) -> Column:
        text = T.trim_u(F.coalesce(item["content"], F.lit("")))
        marked = text.rlike("^" + MARK)
        number = F.when(marked, T.circled_to_number(F.substring(text, 1, 1))).otherwise(item["i"] + 1)
        return F.struct(number.cast("int").alias("number"), F.when(marked, T.trim_u(F.substring(text, F.lit(2), F.length(text)))).otherwise(text).alias("text"), F.lit(None).cast("int").alias("image"))

    return F.transform(items, choice).cast(_CHOICES)


def _collected(order: str, *columns: Column | str) -> Column:
    """The structs of ``columns`` of a group in ``order``."""
    return F.array_sort(F.collect_list(F.struct(order, *columns)))


def _placed_nodes(docs: DataFrame, doc: str, raw: str, max_depth: int) -> DataFrame:
    """The nodes of each tree that count, with what stands before them told by windows.

    t: place of the top node; depth; top_type, style: of the top node; is_question; q: number of the
    latest question at or before the node; lists: number of the latest list; in_question: in an item that is a question.
    """
    n = flatten(docs, doc, raw, max_depth).withColumn("t", F.get("path", F.lit(1))).withColumn("depth", (F.size("path") / 2).cast("int")).withColumn("content", F.coalesce("content", F.lit("")))
    of_top = Window.partitionBy(doc, "t")
    is_top = F.col("depth") == 1
    dropped = F.coalesce(F.col("type"), F.lit("")).isin(*DROPPED) & ~((F.col("type") == "caption") & F.col("content").rlike(MARK))
    n = n.where(F.get("path", F.lit(0)) == 0).withColumn("gone", F.max(is_top & dropped).over(of_top)).where(~F.col("gone"))
    n = n.withColumn("top_type", F.max(F.when(is_top, F.coalesce("type", F.lit("")))).over(of_top)).withColumn("style", F.max(F.when(is_top, F.coalesce("numbering_style", F.lit("")))).over(of_top))
    item = (F.col("depth") == 2) & (F.col("role") == "list items") & (F.col("top_type") == "list")
    n = n.withColumn("number", F.when(item, T.question_number(F.col("content"))))
    # A list of circled numbers holds choices as soon as there is a question to take them.
    n = n.withColumn("first", F.min(F.when(F.col("number").isNotNull(), F.col("t"))).over(Window.partitionBy(doc)))
    n = n.withColumn("choice_list", (F.col("style") == CIRCLED_STYLE) & F.coalesce(F.col("t") > F.col("first"), F.lit(False)))
    n = n.withColumn("is_question", F.col("number").isNotNull() & ~F.col("choice_list"))
    order = Window.partitionBy(doc).orderBy("path")
    n = n.withColumn("q", F.sum(F.col("is_question").cast("int")).over(order)).withColumn("lists", F.sum((is_top & (F.col("type") == "list")).cast("int")).over(order))
    return n.withColumn("in_question", (F.col("depth") > 2) & F.max("is_question").over(Window.partitionBy(doc, F.slice("path", 1, 4))))


def _own_parts(n: DataFrame, doc: str) -> DataFrame:
    """(doc, q, own, description, own_assets): what stands inside the item of each question."""
    inside = n.where("in_question").withColumn("k", F.get("path", F.lit(5)))
    deep = inside.where(F.col("depth") >= 4).groupBy(doc, "q", "k").agg(
        _collected("path", F.when((F.col("depth") == 4) & (F.col("role") == "kids"), F.col("content")).alias("content")).alias("subs"),
        _collected("path", F.when((F.col("depth") == 4) & (F.col("role") == "list items"), F.struct(F.get("path", F.lit(7)).alias("i"), "content")).alias("item")).alias("items"),
        _collected(
            "path", F.when(~F.col("content").rlike(MARK) & (T.trim_u(F.col("content")) != "") & (((F.col("depth") == 4) & (F.col("role") == "kids") & (F.col("type") == "paragraph")) | ((F.col("depth") == 5) & (F.col("role") == "list items"))), T.trim_u(F.col("content"))).alias("line")
        ).alias("lines"),
    )
    present = lambda c, f: F.filter(F.transform(F.coalesce(c, F.array()), lambda x: x[f]), lambda x: x.isNotNull())
    kids = inside.where((F.col("depth") == 3) & (F.col("role") == "kids")).join(deep, [doc, "q", "k"], "left")
    kids = kids.withColumn("items", F.when(F.col("items").isNotNull(), present(F.col("items"), "item"))).withColumn("lines", F.when(F.col("lines").isNotNull(), present(F.col("lines"), "line")))
    text = F.when(F.col("content") != "", F.col("content")).otherwise(T.trim_u(F.array_join(F.when(F.col("subs").isNotNull(), present(F.col("subs"), "content")), " ")))
    prose = F.col("type").isin("paragraph", "text block")
    choices = F.when(prose, _choices_of_text(text)).when((F.col("type") == "list") & F.col("items").isNotNull(), _choices_of_items(F.col("items"))).otherwise(F.array().cast(_CHOICES))
    asset = F.when(F.col("type").isin(*VISUAL), _asset())
    held = kids.groupBy(doc, "q").agg(_collected("k", choices.alias("c"), F.when(F.col("type") == "text block", F.col("lines")).alias("lines"), asset.alias("a")).alias("kids"))
    each = lambda f: F.transform("kids", lambda x: x[f])
    return held.select(
        doc, "q", T.first_of_each_number(F.flatten(each("c"))).alias("own"), F.array_join(F.flatten(F.filter(each("lines"), lambda x: x.isNotNull())), "\n").alias("description"),
        F.filter(each("a"), lambda x: x.isNotNull()).alias("own_assets"),
    )


def _asset() -> Column:
    return F.struct(F.col("id").alias("element_id"), "type", "page_number", F.col("bbox").alias("bounding_box"), F.coalesce("source", F.lit("")).alias("source"))


def _images_for_labels(tops: DataFrame, doc: str) -> tuple[DataFrame, DataFrame]:
    """(doc, t, state, taken) of each line of marks alone, and (doc, lists, left) images that no line took.

    Images between two lists lie on a pile. A line of n marks takes the n latest, left to right; it is an
    ordinary line of choices ('plain') where the pile is empty, and takes none where it is too small.
    """
    image = F.col("type").isin("image", "picture", "figure", "formula")
    label = F.col("marks") > 0
    events = tops.where((F.col("q") > 0) & (image | (label & F.col("bare")))).groupBy(doc, "lists").agg(_collected("t", F.when(image, _asset()).alias("a"), F.when(~image, F.col("marks")).alias("n")).alias("events"))
    pile = f"array<struct<{ASSET}>>"
    start = F.struct(F.array().cast(pile).alias("pile"), F.array().cast(f"array<struct<t:int,state:string,taken:{pile}>>").alias("out"))

    def step(s: Column, e: Column) -> Column:
        size = F.size(s["pile"])
        fits = (size > 0) & (e["n"] <= size)
        taken = F.when(fits, F.slice(s["pile"], F.greatest(size - e["n"] + 1, F.lit(1)), F.greatest(e["n"], F.lit(0)))).otherwise(F.array().cast(pile))
        state = F.when(size == 0, "plain").when(fits, "taken").otherwise("none")
        label_row = F.array(F.struct(e["t"].alias("t"), state.alias("state"), taken.alias("taken")))
        pushed = F.concat(s["pile"], F.array(e["a"]))
        return F.when(e["n"].isNull(), F.struct(pushed.cast(pile).alias("pile"), s["out"].alias("out"))).otherwise(
            F.struct(F.when(fits, F.slice(s["pile"], F.lit(1), F.greatest(size - e["n"], F.lit(0)))).otherwise(s["pile"]).alias("pile"), F.concat(s["out"], label_row).alias("out"))
        )

    done = events.select(doc, "lists", F.aggregate("events", start, step).alias("s"))
    return done.select(doc, F.explode("s.out").alias("o")).select(doc, "o.*"), done.select(doc, "lists", F.col("s.pile").alias("left"))


def extract_questions(docs: DataFrame, doc: str, raw: str, max_depth: int = 12) -> DataFrame:
    """(doc, question_index, question_number, page_number, question_text, description, bounding_box, choices, images, assets) of each tree.

    Numbered list items are questions. Choices outside of an item go to the latest question that has
    none yet, or to the latest one. That is a matching of brackets: a question without choices opens
    one, a source of choices closes the one opened last, and windows find its partner as the last
    opening of the same level. Images go to the latest question unless a line of marks takes them as choices,
    tables only while it has no choices, texts of blocks that are not headings are added to its text.
    """
    if doc != "__doc":  # the key may have the name of any column used below
        named = extract_questions(docs.select(F.col(f"`{doc}`").alias("__doc"), F.col(f"`{raw}`").alias("__raw")), "__doc", "__raw", max_depth)
        return named.withColumnRenamed("__doc", doc)
    n = cut_lineage(_placed_nodes(docs, doc, raw, max_depth))
    own = _own_parts(n, doc)
    questions = n.where("is_question").join(own, [doc, "q"], "left").withColumn("own", F.coalesce("own", F.array().cast(_CHOICES)))
    questions = cut_lineage(questions.select(doc, "q", "path", "number", "page_number", F.col("bbox").alias("bounding_box"), T.strip_question_number(F.col("content")).alias("text"), F.coalesce("description", F.lit("")).alias("description"), "own", "own_assets"))

    children = n.where("depth = 2").withColumn("i", F.get("path", F.lit(3)))
    opened = F.min(F.when(F.col("is_question"), F.col("i"))).over(Window.partitionBy(doc, "t"))
    children = children.withColumn("opened", opened)
    orphan = (F.col("role") == "list items") & F.col("number").isNull() & F.col("content").rlike(MARK) & (F.col("opened").isNull() | (F.col("i") < F.col("opened")))
    parts = children.groupBy(doc, "t").agg(
        F.filter(F.transform(_collected("path", F.when(F.col("role") == "list items", F.struct("i", "content")).alias("item")), lambda x: x["item"]), lambda x: x.isNotNull()).alias("items"),
        F.max_by("content", F.when(orphan, F.col("i"))).alias("orphan"), F.max(orphan).alias("has_orphan"),
        T.trim_u(F.array_join(F.transform(_collected("path", F.when(F.col("role") == "kids", F.col("content")).alias("c")), lambda x: x["c"]), " ")).alias("block"),
        F.bool_and((F.col("role") != "kids") | (F.coalesce(F.col("type"), F.lit("")) == "heading")).alias("headings"),
    )
    marks = F.regexp_count("content", F.lit(MARK)).cast("int")
    bare = T.trim_u(F.regexp_replace("content", MARK, "")) == ""
    line = F.col("type").isin("paragraph", "caption")
    tops = cut_lineage(n.where("depth = 1").join(parts, [doc, "t"], "left").withColumn("marks", F.when(line, marks).otherwise(0)).withColumn("bare", line & bare))

    labels, left = _images_for_labels(tops, doc)
    numbers = F.transform(_choices_of_text(F.col("content")), lambda c: c["number"])
    from_left = F.transform("taken", lambda a, i: F.struct(F.coalesce(F.get(a["bounding_box"], F.lit(0)), F.lit(0.0)).alias("x"), i.alias("i"), a["element_id"].alias("element_id")))
    chosen = F.array_sort(from_left)
    pictured = F.zip_with(numbers, chosen, lambda k, a: F.struct(k.alias("number"), F.lit("").alias("text"), a["element_id"].alias("image"))).cast(_CHOICES)
    sources = tops.where("q > 0").join(labels, [doc, "t"], "left").withColumn(
        "choices",
        F.when(F.col("choice_list"), _choices_of_items(F.col("items"))).when((F.col("type") == "list") & F.col("has_orphan"), _choices_of_text(F.col("orphan")))
        .when(F.col("state") == "taken", pictured).when((F.col("marks") > 0) & (F.coalesce("state", F.lit("plain")) == "plain"), _choices_of_text(F.col("content"))),
    ).where(F.size("choices") > 0)
    sources = sources.select(doc, "q", "t", "path", "choices", (F.coalesce("state", F.lit("")) == "taken").alias("to_last"))

    # Brackets: a line that takes images goes to the latest question and closes it if it is still open.
    is_open = questions.where(F.size("own") == 0).select(doc, "q", F.lit(True).alias("open"))
    sources = sources.join(is_open, [doc, "q"], "left").withColumn("nth", F.row_number().over(Window.partitionBy(doc, "q").orderBy("path")))
    closes = ~F.col("to_last") | ((F.col("nth") == 1) & F.coalesce("open", F.lit(False)))
    pushes = questions.where(F.size("own") == 0).select(doc, "path", F.col("q"), F.lit(None).cast("int").alias("t"), F.lit(1).alias("step"))
    pops = sources.where(closes).select(doc, "path", "q", "t", F.lit(-1).alias("step"))
    order = Window.partitionBy(doc).orderBy("path")
    walked = pushes.unionByName(pops).withColumn("sum", F.sum("step").over(order))
    walked = walked.withColumn("level", F.col("sum") - F.least(F.lit(0), F.min("sum").over(order))).withColumn("before", F.coalesce(F.lag("level").over(order), F.lit(0)))
    walked = walked.withColumn("bracket", F.when(F.col("step") > 0, F.col("level")).otherwise(F.col("before")))
    partner = F.last(F.when(F.col("step") > 0, F.col("q")), ignorenulls=True).over(Window.partitionBy(doc, "bracket").orderBy("path"))
    matched = walked.withColumn("partner", partner).where("step < 0").select(doc, "t", F.when(F.col("bracket") > 0, F.col("partner")).alias("partner"))
    given = sources.join(matched, [doc, "t"], "left").select(doc, F.when(F.col("to_last"), F.col("q")).otherwise(F.coalesce("partner", "q")).alias("q"), "t", "choices")
    more = given.groupBy(doc, "q").agg(F.flatten(F.transform(_collected("t", "choices"), lambda x: x["choices"])).alias("more"), F.min("t").alias("first_source"))

    told = tops.where((F.col("q") > 0) & (F.col("type") == "text block") & ~F.coalesce("headings", F.lit(False)) & (F.coalesce("block", F.lit("")) != ""))
    told = told.groupBy(doc, "q").agg(F.transform(_collected("t", "block"), lambda x: x["block"]).alias("blocks"))
    tables = tops.where((F.col("q") > 0) & (F.col("type") == "table")).join(is_open, [doc, "q"]).join(more.select(doc, "q", "first_source"), [doc, "q"], "left")
    tables = tables.where(F.col("first_source").isNull() | (F.col("first_source") > F.col("t"))).select(doc, "q", F.col("lists"), F.lit(0).alias("late"), "t", _asset().alias("a"))
    last_of = n.groupBy(doc, "lists").agg(F.max("q").alias("q"))
    images = left.where(F.size("left") > 0).join(last_of, [doc, "lists"]).select(doc, "q", "lists", F.lit(1).alias("late"), F.posexplode("left").alias("t", "a"))
    hung = tables.unionByName(images).groupBy(doc, "q").agg(F.transform(F.array_sort(F.collect_list(F.struct("lists", "late", "t", "a"))), lambda x: x["a"]).alias("hung"))

    out = questions.join(more, [doc, "q"], "left").join(told, [doc, "q"], "left").join(hung, [doc, "q"], "left")
    out = out.withColumn("choices", F.concat("own", F.coalesce("more", F.array().cast(_CHOICES)))).withColumn("assets", F.when(F.col("own_assets").isNotNull() & F.col("hung").isNotNull(), F.concat("own_assets", "hung")).otherwise(F.coalesce("own_assets", "hung")))
    text = F.when(F.col("blocks").isNotNull(), F.concat_ws("\n", "text", F.array_join("blocks", "\n"))).otherwise(F.col("text"))
    out = out.withColumn("question_index", F.row_number().over(Window.partitionBy(doc).orderBy("number", "q")))
    ids = F.coalesce(F.transform("assets", lambda a: a["element_id"]), F.array().cast("array<int>"))
    return out.select(doc, "question_index", F.col("number").alias("question_number"), "page_number", text.alias("question_text"), "description", "bounding_box", "choices", ids.alias("images"), "assets")
