"""Problem 5: deeply nested semi-structured records as related flat tables.

Payloads are parsed into VARIANT and walked level by level: each level explodes the lists right below
the rows of the one before, so a record of any depth becomes rows that carry the record's key, the
trail of list names and ordinals down to them, and what stands there. A first walk infers the merged
schema of all records: the path of every list with the merged fields of its entries. The second
follows only the paths of the schema that lead to the tables asked for. A list may be written as an
array, as an object keyed by numbers, as a single object, or as a string that holds any of these;
wrappers are lists of one entry, so no record can hide the lists of another, whatever kinds they have.
Every path of the schema is a child table (``child_table``) whose rows name their parent and their
ordinal; questions, options, images and sources are tables of their own with positions.

Defined results: payloads that are null, empty or not valid JSON give no rows; null entries give no
rows but keep their place; of several names for one field the first one present wins; repeated
deliveries of a record are one record, records without a key are told apart by their payload; records
without the list have no rows in the child table; lists deeper than MAX_LEVELS raise an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Names of one field, the first of those present wins.
OPTION_NAMES = ("options", "choices")
IMAGE_NAMES = ("images", "assets")
NUMBER_NAMES = ("order", "number", "option_number", "label")
TEXT_NAMES = ("content", "question_text", "stem", "text")
CIRCLED = "①②③④⑤⑥⑦⑧⑨⑩"

#: Later names of a field and the name their rows go by.
ALIASES = {OPTION_NAMES[1]: OPTION_NAMES[0], IMAGE_NAMES[1]: IMAGE_NAMES[0]}
#: Levels of containers that are gone down; lists below the second number are an error.
FIRST_LEVELS, MAX_LEVELS = 6, 24
#: Different paths of a merged schema; more (keys that are data) are an error.
MAX_PATHS = 20_000

_ENTRY = "array<struct<ordinal:int,item:variant>>"
_CHILD = "array<struct<name:string,rank:int,ordinal:int,item:variant>>"
_TRAIL = "array<struct<name:string,rank:int,ordinal:int>>"


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def parse(text: Column) -> Column:
    """VARIANT of a JSON text, null if it is not valid JSON.

    The text is parsed as the only element of an array, so anything after its end is refused.
    """
    whole = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return let(F.try_variant_get(whole, "$", "array<variant>"), lambda a: F.when(F.size(a) == 1, F.get(a, F.lit(0))))


def unwrap(value: Column) -> Column:
    """A value, or what the JSON text in it holds."""
    return let(
        value,
        lambda v: F.when(
            F.schema_of_variant(v) == "STRING",
            let(F.try_variant_get(v, "$", "string"), lambda t: F.when(t.rlike(r"^\s*[\[{]"), parse(t)).otherwise(v)),
        ).otherwise(v),
    )


def _entries(v: Column) -> Column:
    """Entries of an unwrapped value."""
    array = F.transform(F.try_variant_get(v, "$", "array<variant>"), lambda x, i: F.struct((i + 1).cast("int").alias("ordinal"), x.alias("item")))
    keyed = lambda p: F.forall(p, lambda e: e["key"].rlike(r"^\s*\d{1,9}\s*$"))
    numbered = lambda p: F.transform(p, lambda e: F.struct(F.trim(e["key"]).try_cast("int").alias("ordinal"), e["value"].alias("item")))
    ordered = lambda p: F.array_sort(numbered(p), lambda x, y: x["ordinal"] - y["ordinal"])
    single = F.array(F.struct(F.lit(1).alias("ordinal"), v.alias("item")))
    pairs = F.map_entries(F.try_variant_get(v, "$", "map<string,variant>"))
    objects = let(pairs, lambda p: F.when(F.size(p) == 0, None).when(keyed(p), ordered(p)).otherwise(single))
    kind = F.schema_of_variant(v)
    return F.when(kind.startswith("ARRAY"), array).when(kind.startswith("OBJECT"), objects).cast(_ENTRY)


def as_list(value: Column) -> Column:
    """Entries (ordinal, item) of a list in any of its shapes; null for null and for plain values."""
    return let(unwrap(value), _entries)


def field(value: Column, names: tuple[str, ...]) -> Column:
    """The first of several fields that is present (a JSON null counts as present only if no other is)."""
    got = [F.try_variant_get(value, f"$.{n}", "variant") for n in names]
    filled = [F.when(~F.is_variant_null(g), g) for g in got]
    return F.coalesce(*filled)


def text_of(value: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(*[F.try_variant_get(value, f"$.{n}", "string") for n in names])


def number_of(value: Column) -> Column:
    """Number of an option from the first name present: a number, digits, or a circled mark."""
    text = F.trim(text_of(value, NUMBER_NAMES))
    mark = F.instr(F.lit(CIRCLED), text)
    return F.when(F.length(text) == 0, None).when(mark > 0, mark).otherwise(text.try_cast("int"))


def _there(v: Column) -> Column:
    """Whether a value is present and not a JSON null."""
    return v.isNotNull() & ~F.is_variant_null(v)


def _children(v: Column, path: Column, follow: tuple[str, ...] | None) -> Column:
    """(name, rank, ordinal, item) of the entries of all lists right inside an unwrapped value, in reading order.

    The entries of a list within a list have the empty name. Of the fields of an object ``questions`` comes first.
    """
    nothing = F.array().cast(_CHILD)
    kind = F.schema_of_variant(v)
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    child = lambda name, rank: lambda x: F.struct(name.alias("name"), rank.cast("int").alias("rank"), x["ordinal"].alias("ordinal"), unwrap(x["item"]).alias("item"))
    listed = F.transform(_entries(v), child(F.lit(""), F.lit(0)))

    def name_of(key: Column) -> Column:
        name = key
        for later, first in ALIASES.items():
            name = F.when(key == later, F.lit(first)).otherwise(name)
        return name

    def of_fields(m: Column) -> Column:
        held = lambda name: _there(F.try_element_at(m, F.lit(name)))

        def wanted(e: Column) -> Column:
            ok = F.lit(True)
            for later, first in ALIASES.items():
                ok = ok & ~((e["key"] == later) & held(first))
            return ok & F.concat(path, F.lit("/"), name_of(e["key"])).isin(*follow) if follow is not None else ok

        def entries(e: Column, i: Column) -> Column:
            rank = F.when(e["key"] == "questions", -1).otherwise(i)
            return F.transform(F.coalesce(as_list(e["value"]), F.array().cast(_ENTRY)), child(name_of(e["key"]), rank))

        rows = F.flatten(F.transform(F.filter(F.map_entries(m), wanted), entries))
        keyed = (F.cardinality(m) > 0) & F.forall(F.map_keys(m), lambda k: k.rlike(r"^\s*\d{1,9}\s*$"))
        return F.when(keyed, listed).otherwise(rows)

    return F.coalesce(F.when(kind.startswith("ARRAY"), listed).when(kind.startswith("OBJECT"), let(fields, of_fields)), nothing)


def path_of(trail: Column) -> Column:
    """The names of a trail, each after a slash."""
    return F.concat_ws("", F.transform(trail, lambda t: F.concat(F.lit("/"), t["name"])))


def walk(payloads: DataFrame, key: str, payload: str, levels: int, follow: tuple[str, ...] | None = None) -> DataFrame:
    """(root, record_key, trail, item, open): every entry of every list down to ``levels``, the records themselves among them.

    ``open`` rows are those of the last level: nothing below them was looked at.
    """
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.concat(F.lit("#"), F.hex(F.xxhash64(F.col(f"`{payload}`")))))
    rows = payloads.select(name.alias("root"), F.col(f"`{key}`").alias("record_key"), F.array().cast(_TRAIL).alias("trail"), unwrap(parse(F.col(f"`{payload}`"))).alias("item"), F.lit(True).alias("open"))
    rows = rows.where("item is not null")
    kind = f"array<struct<trail:{_TRAIL},item:variant,open:boolean>>"
    # The same expression for every level: it is built once.
    own = F.array(F.struct("trail", "item", F.lit(False).alias("open"))).cast(kind)
    step = lambda c: F.struct(F.concat(F.col("trail"), F.array(F.struct(c["name"], c["rank"], c["ordinal"]))).alias("trail"), c["item"].alias("item"), F.lit(True).alias("open"))
    nothing = F.array().cast(kind)
    below = F.when(F.col("open"), F.transform(_children(F.col("item"), path_of(F.col("trail")), follow), step)).otherwise(nothing).cast(kind)
    reached = F.explode(F.concat(own, below)).alias("n")
    for _ in range(levels):
        rows = rows.select("root", "record_key", reached).select("root", "record_key", "n.*")
    return rows


def merged_schema(payloads: DataFrame, key: str = "record_id", payload: str = "payload") -> dict[str, str]:
    """Path of every list of any record, and the merged schema of its entries.

    A row for each path comes to the driver, at most MAX_PATHS of them.
    """
    levels = FIRST_LEVELS
    while True:
        rows = walk(payloads, key, payload, levels)
        deeper = F.col("open") & (F.size(_children(F.col("item"), F.lit(""), None)) > 0)
        found = rows.groupBy(path_of(F.col("trail")).alias("path")).agg(F.schema_of_variant_agg("item").alias("fields"), F.max(deeper).alias("deeper")).limit(MAX_PATHS + 1).collect()
        if len(found) > MAX_PATHS:
            raise ValueError(f"the merged schema has more than {MAX_PATHS} paths")
        if not any(r["deeper"] for r in found):
            return {r["path"]: r["fields"] for r in found}
        if levels == MAX_LEVELS:
            raise ValueError(f"lists lie more than {MAX_LEVELS} levels deep")
        levels = min(2 * levels, MAX_LEVELS)


def leading_to(schema: dict[str, str], names: tuple[str, ...]) -> tuple[str, ...]:
    """Paths of the schema that end in one of the names, and those on the way to them."""
    ends = [p.split("/") for p in schema if p.rsplit("/", 1)[-1] in names]
    return tuple(sorted({"/".join(p[:i]) for p in ends for i in range(2, len(p) + 1)}))


def fields_of(merged: str) -> list[tuple[str, str]]:
    """Plain fields of a merged schema such as OBJECT<a: BIGINT, b: ARRAY<…>>, with their types as columns."""
    if not merged.startswith("OBJECT<"):
        return []
    parts, depth, start, quoted = [], 0, 7, False
    for i, c in enumerate(merged):
        quoted ^= c == "`"
        depth += 0 if quoted else (c in "<(") - (c in ">)")
        if (c == "," and depth == 1 and not quoted) or i == len(merged) - 1:
            parts.append(merged[start:i].strip())
            start = i + 1
    out = []
    for part in filter(None, parts):
        name, _, kind = part.rpartition(": ") if not part.endswith(">") else part.partition(": ")
        kind = {"BIGINT": "bigint", "STRING": "string", "BOOLEAN": "boolean", "DOUBLE": "double", "VARIANT": "string"}.get(kind, "double" if kind.startswith("DECIMAL") else "")
        if kind:
            out.append((name.strip("`").replace("``", "`"), kind))
    return out


class FlatTables:
    """Child tables of final payloads: one for each path of the merged schema, and questions, options, images and sources."""

    def __init__(self, payloads: DataFrame, key: str = "record_id", payload: str = "payload"):
        # JSON allows a key to stand twice; the last one counts. The parser reads this from the session only.
        payloads.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
        self._read = (payloads, key, payload)
        self.schema = merged_schema(*self._read)

    def _rows(self, *names: str) -> DataFrame:
        """Rows of the walk whose last name is one of these: root, record_key, trail, item, name."""
        follow = leading_to(self.schema, names)
        levels = max((p.count("/") for p in follow), default=0)
        rows = walk(*self._read, levels, follow).withColumn("name", F.coalesce(F.try_element_at("trail", F.lit(-1))["name"], F.lit("")))
        return rows.where(F.col("name").isin(*names)).drop("open")

    def child_table(self, path: str) -> DataFrame:
        """(node_key, parent_key, record_key, ordinal, the plain fields) of the entries of one list, such as ``/result/questions/options``."""
        follow = tuple(sorted({path[:i] for i in range(1, len(path) + 1) if i == len(path) or path[i] == "/"}))
        rows = walk(*self._read, path.count("/"), follow).where(path_of(F.col("trail")) == path)
        key = lambda trail: F.concat("root", F.array_join(F.transform(trail, lambda t: F.concat(F.lit("/"), t["name"], F.lit(":"), t["ordinal"].cast("string"))), ""))
        taken = {"node_key", "parent_key", "record_key", "ordinal"}
        plain = [(n, t) for n, t in fields_of(self.schema.get(path, "")) if n not in taken and "'" not in n and f"{path}/{ALIASES.get(n, n)}" not in self.schema]
        columns = [F.try_variant_get("item", f"$['{n}']", t).alias(n) for n, t in plain]
        up = F.slice("trail", F.lit(1), F.size("trail") - 1)
        rows = rows.where(_there(F.col("item")))
        return rows.select(key(F.col("trail")).alias("node_key"), key(up).alias("parent_key"), "record_key", F.try_element_at("trail", F.lit(-1))["ordinal"].alias("ordinal"), *columns).dropDuplicates(["node_key"])

    def placed(self, names: tuple[str, ...], **columns: Column) -> DataFrame:
        """(root, record_key, question_pos, question_key, trail below the question, name, columns) of rows in or below questions.

        Questions count in reading order within their record; repeated deliveries of a record count once.
        Rows are brought together by record, without the payload unless ``columns`` take it.
        """
        rows = self._rows("questions", *names)
        of_question = F.size("trail") - F.array_position(F.reverse(F.transform("trail", lambda t: t["name"])), F.lit("questions")) + 1
        inside = F.exists("trail", lambda t: t["name"] == "questions")
        rows = rows.where(inside).withColumn("at", of_question.cast("int"))
        places = F.transform(F.slice("trail", F.lit(1), F.col("at")), lambda t: F.struct(t["rank"], t["ordinal"], t["name"]))
        rows = rows.select("root", "record_key", places.alias("places"), F.slice("trail", F.col("at") + 1, F.size("trail")).alias("below"), "name", *[c.alias(n) for n, c in columns.items()])
        rows = rows.withColumn("question_pos", F.dense_rank().over(Window.partitionBy("root").orderBy("places")))
        return rows.withColumn("question_key", _key("root", "question_pos")).drop("places")

    def question_rows(self) -> DataFrame:
        """(record_key, question_key, question_pos, q) of every question, as it stands in the payload."""
        rows = self.placed((), q=F.col("item")).where(F.size("below") == 0)
        return rows.select("record_key", "question_key", "question_pos", "q")

    def questions(self) -> DataFrame:
        i = F.col("item")
        rows = self.placed((), content=text_of(i, TEXT_NAMES), hint_explanation=F.try_variant_get(i, "$.hint_explanation", "string")).where(F.size("below") == 0)
        return rows.select("root", "question_key", "record_key", "question_pos", "content", "hint_explanation").dropDuplicates(["root", "question_key"]).drop("root")

    def options(self) -> DataFrame:
        o = F.col("item")
        rows = self.placed(
            ("options",), number=number_of(o), content=text_of(o, TEXT_NAMES), is_correct=F.try_variant_get(o, "$.is_correct", "boolean"),
            option_explanation=F.try_variant_get(o, "$.option_explanation", "string"), filled=_there(o),
        )
        rows = rows.where((F.size("below") == 1) & (F.col("name") == "options") & F.col("filled")).withColumn("option_pos", F.get("below", F.lit(0))["ordinal"]).withColumn("option_key", _key("question_key", "option_pos"))
        return rows.select("root", "option_key", "question_key", "record_key", "question_pos", "option_pos", "number", "content", "is_correct", "option_explanation").dropDuplicates(["root", "option_key"]).drop("root")

    def images(self) -> DataFrame:
        """Images of questions (option_pos 0) and of options."""
        i = F.col("item")
        texts = {n: F.try_variant_get(i, f"$.{n}", "string") for n in ("image_id", "image_name", "image_caption")}
        rows = self.placed(("options", "images", "image"), **texts, is_image=F.coalesce(F.schema_of_variant(i).startswith("OBJECT"), F.lit(False)))
        first, last = F.get("below", F.lit(0)), F.try_element_at("below", F.lit(-1))
        own = (F.size("below") == 1) & (F.col("name") == "images")
        of_option = (F.size("below") == 2) & (first["name"] == "options") & F.col("name").isin("images", "image")
        rows = rows.where(F.col("is_image") & (own | of_option)).withColumn("option_pos", F.when(own, 0).otherwise(first["ordinal"])).withColumn("image_pos", last["ordinal"])
        rows = rows.withColumn("parent_key", F.when(own, F.col("question_key")).otherwise(_key("question_key", "option_pos"))).dropDuplicates(["root", "parent_key", "name", "image_pos"])
        return rows.select("record_key", "parent_key", "question_pos", "option_pos", "image_pos", *texts)

    def sources(self) -> DataFrame:
        """Where each question comes from: a text, or an object with an exam, a number, a subject and pages."""
        s = unwrap(F.try_variant_get("item", "$.question_source", "variant"))
        get = lambda p, t: F.try_variant_get(s, p, t)
        rows = self.placed(
            (), source_text=F.when(F.schema_of_variant(s) == "STRING", get("$", "string")), exam_id=get("$.exam.exam_id", "string"), title=get("$.exam.title", "string"), question_no=get("$.question_no", "int"),
            subject=get("$.subject.name", "string"), filled=_there(s),
        ).where((F.size("below") == 0) & F.col("filled"))
        return rows.select("root", "question_key", "record_key", "question_pos", "source_text", "exam_id", "title", "question_no", "subject").dropDuplicates(["root", "question_key"]).drop("root")

    def source_pages(self) -> DataFrame:
        """Pages named by a source object."""
        pages = F.transform(as_list(F.try_variant_get("item", "$.question_source.pages", "variant")), lambda e: F.struct(e["ordinal"].alias("page_pos"), F.try_variant_get(e["item"], "$.page", "int").alias("page"), F.try_variant_get(e["item"], "$.column", "string").alias("page_column")))
        rows = self.placed((), pages=pages).where(F.size("below") == 0).select("question_key", F.explode("pages").alias("p"))
        return rows.select("question_key", "p.*").dropDuplicates(["question_key", "page_pos"])


def _key(parent: str, ordinal: str) -> Column:
    return F.concat_ws("/", F.col(parent).cast("string"), F.col(ordinal).cast("string"))


def typed_options(finals: DataFrame, key: str = "qf_id") -> DataFrame:
    """Options nested in questions_final, with their place; null entries keep their place."""
    rows = finals.select(F.col(key).alias("record_key"), F.posexplode("options").alias("at", "o")).where("o is not null").dropDuplicates(["record_key", "at"])
    return rows.select("record_key", (F.col("at") + 1).alias("option_pos"), F.col("o.opt_order").alias("number"), "o.content", "o.is_correct", "o.option_explanation")


def typed_sources(finals: DataFrame, key: str = "qf_id") -> DataFrame:
    """Sources of questions_final that are neither null nor empty."""
    rows = finals.where("question_source is not null and question_source <> ''").dropDuplicates([key])
    return rows.select(F.col(key).alias("record_key"), F.col("question_source").alias("source_text"))


def typed_images(finals: DataFrame, key: str = "qf_id") -> DataFrame:
    """Images nested in questions_final: of the question itself (option_pos 0) and of its options."""
    rows = finals.select(F.col(key).alias("record_key"), "images", "options")
    own = rows.select("record_key", F.lit(0).alias("option_pos"), F.posexplode("images").alias("at", "i"))
    opts = rows.select("record_key", F.posexplode("options").alias("at", "o")).select("record_key", (F.col("at") + 1).alias("option_pos"), F.posexplode("o.images").alias("at", "i"))
    both = own.unionByName(opts).where("i is not null").dropDuplicates(["record_key", "option_pos", "at"])
    return both.select("record_key", F.lit(1).alias("question_pos"), "option_pos", (F.col("at") + 1).alias("image_pos"), "i.image_id", "i.image_name", "i.image_caption")


def image_places(payloads: DataFrame, finals: DataFrame) -> DataFrame:
    """(table_name, record_key, question_pos, option_pos, image_pos) of every image object."""
    a = FlatTables(payloads).images().select(F.lit("final_payloads").alias("table_name"), "record_key", "question_pos", "option_pos", "image_pos")
    b = typed_images(finals).select(F.lit("questions_final").alias("table_name"), "record_key", "question_pos", "option_pos", "image_pos")
    return a.unionByName(b)
