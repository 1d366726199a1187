"""Three parser dialects to one record, image numbering, validation and merges of external replies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .nested import FlatTables, as_list, let


def first_present(value: Column, *names: str) -> Column:
    """The first field present; one that is present with null gives null and hides the later ones."""
    found = F.lit(None).cast("variant")
    for n in reversed(names):
        got = F.try_variant_get(value, f"$.{n}", "variant")
        found = F.when(got.isNotNull(), got).otherwise(found)
    return found


def as_text(value: Column) -> Column:
    return F.coalesce(T.trim_u(F.when(~F.is_variant_null(value), F.try_variant_get(value, "$", "string"))), F.lit(""))


def as_number(value: Column) -> Column:
    """An integer, digits or a circled mark; 0 for anything else."""
    text = as_text(value)
    return F.coalesce(F.nullif(T.circled_to_number(text), F.lit(0)), text.try_cast("int"), F.lit(0))


def normalize_option(o: Column) -> Column:
    """(order, content, is_correct, images, option_explanation) of an option in any dialect."""
    images = F.coalesce(as_list(first_present(o, "images", "assets")), F.array().cast("array<struct<ordinal:int,item:variant>>"))
    return F.struct(
        as_number(first_present(o, "order", "number", "option_number", "label")).alias("order"), as_text(first_present(o, "content", "text")).alias("content"),
        F.coalesce(F.try_variant_get(o, "$.is_correct", "boolean"), F.lit(False)).alias("is_correct"), F.size(images).alias("n_images"), as_text(first_present(o, "option_explanation")).alias("option_explanation"),
    )


def normalize_questions(tables: FlatTables) -> DataFrame:
    """One canonical row for each question of parsed payloads, options sorted by their order."""
    q = F.col("q")
    options = F.coalesce(F.transform(F.filter(as_list(first_present(q, "options", "choices")), lambda e: F.schema_of_variant(e["item"]).startswith("OBJECT")), lambda e: let(e["item"], normalize_option)), F.array().cast("array<struct<order:int,content:string,is_correct:boolean,n_images:int,option_explanation:string>>"))
    answers = T.correct_orders(as_text(first_present(q, "answer", "correct_answer")))
    marked = let(F.struct(options.alias("o"), answers.alias("a")), lambda s: F.when(F.size(s["a"]) > 0, F.transform(s["o"], lambda o: o.withField("is_correct", F.array_contains(s["a"], o["order"])))).otherwise(s["o"]))
    content, description = as_text(first_present(q, "content", "question_text", "stem")), as_text(first_present(q, "description"))
    sorted_options = F.array_sort(marked, lambda a, b: a["order"] - b["order"])
    rows = tables.question_rows().select("record_key", "question_pos", F.concat_ws("\n", F.nullif(content, F.lit("")), F.nullif(description, F.lit(""))).alias("content"), as_text(first_present(q, "hint_explanation", "explanation")).alias("hint_explanation"), sorted_options.alias("options"))
    return rows.dropDuplicates(["record_key", "question_pos"])


def number_images(finals: DataFrame, doc: str, question: str) -> DataFrame:
    """(doc, question, option_pos, image_pos, image_no, image_id, image_name): images numbered within a document.

    In the order question, own images, options, option images; null entries are not images.
    """
    own = finals.select(doc, question, F.lit(0).alias("option_pos"), F.posexplode("images").alias("image_pos", "i"))
    opts = finals.select(doc, question, F.posexplode("options").alias("o_at", "o")).select(doc, question, (F.col("o_at") + 1).alias("option_pos"), F.posexplode("o.images").alias("image_pos", "i"))
    rows = own.unionByName(opts).where("i is not null").drop("i")
    w = Window.partitionBy(doc).orderBy(question, "option_pos", "image_pos")
    rows = rows.withColumn("image_no", F.row_number().over(w)).withColumn("image_pos", F.col("image_pos") + 1)
    image_id = F.concat(F.lit("image"), F.lpad(F.col("image_no").cast("string"), F.greatest(F.lit(3), F.length(F.col("image_no").cast("string"))), F.lit("0")))
    return rows.withColumn("image_id", image_id).withColumn("image_name", F.concat(image_id, F.lit(".png")))


def append_tokens(content: Column, ids: Column) -> Column:
    """Content and one ``[id]`` line for each image."""
    tokens = F.array_join(F.transform(ids, lambda i: F.concat(F.lit("["), i, F.lit("]"))), "\n")
    return F.when(F.coalesce(F.size(ids), F.lit(0)) <= 0, content).otherwise(T.trim_u(F.concat_ws("\n", F.nullif(content, F.lit("")), tokens)))


def document_metadata(finals: DataFrame, doc: str) -> DataFrame:
    """(doc, total_questions, total_images, requires_answer_review)."""
    n_images = F.size(F.filter(F.coalesce("images", F.array().cast(finals.schema["images"].dataType)), lambda i: i.isNotNull()))
    options = F.filter(F.coalesce("options", F.array().cast(finals.schema["options"].dataType)), lambda o: o.isNotNull())
    in_options = F.aggregate(options, F.lit(0), lambda n, o: n + F.coalesce(F.size(F.filter(o["images"], lambda i: i.isNotNull())), F.lit(0)))
    review = (F.size(options) > 0) & ~F.exists(options, lambda o: F.coalesce(o["is_correct"], F.lit(False)))
    return finals.groupBy(doc).agg(F.count(F.lit(1)).alias("total_questions"), F.sum(n_images + in_options).alias("total_images"), F.max(review).alias("requires_answer_review"))


def caption_targets(finals: DataFrame, key: str) -> DataFrame:
    """(key, scope, option_order, image_id): every image with its place, a question's own ones first."""
    own = finals.select(key, F.lit("question").alias("scope"), F.lit(None).cast("int").alias("option_order"), F.explode("images").alias("i"))
    opts = finals.select(key, F.explode("options").alias("o")).select(key, F.lit("option").alias("scope"), F.col("o.opt_order").alias("option_order"), F.explode("o.images").alias("i"))
    return own.unionByName(opts).where("i is not null").select(key, "scope", "option_order", "i.image_id")


def violations(finals: DataFrame, key: str) -> DataFrame:
    """(key, problem) of records that miss required fields."""
    problems = F.array_compact(F.array(
        F.when(F.col("content").isNull(), F.lit("content")), F.when(F.col("question_source").isNull(), F.lit("question_source")), F.when(F.col("images").isNull(), F.lit("images")),
        F.when(F.col("hint_explanation").isNull(), F.lit("hint_explanation")), F.when(F.col("options").isNull(), F.lit("options")), F.when(F.exists("options", lambda o: o.isNull() | o["opt_order"].isNull()), F.lit("option")),
    ))
    return finals.select(key, F.explode(problems).alias("problem"))


def text_changes(before: DataFrame, after: DataFrame, keys: list[str], field: str = "content") -> DataFrame:
    """(keys, before, after) where a text differs; a missing one counts as empty."""
    a, b = before.select(*keys, F.col(field).alias("before")), after.select(*keys, F.col(field).alias("after"))
    out = b.join(a, keys, "left").select(*keys, F.coalesce("before", F.lit("")).alias("before"), F.coalesce("after", F.lit("")).alias("after"))
    return out.where("before <> after")


def first_valid_reply(replies: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, payload, attempts, error): the first attempt whose reply is a JSON object.

    Without one, the last error, or the reply that could not be read.
    """
    valid = T.json_object(F.col("raw")).isNotNull()
    out = replies.groupBy(*keys).agg(
        F.min_by(T.strip_fences(F.col("raw")), F.when(valid, F.col("attempt"))).alias("payload"), F.count(F.lit(1)).alias("attempts"), F.max(valid).alias("ok"),
        F.max_by(F.coalesce("error", F.lit("not a JSON object")), "attempt").alias("last_error"),
    )
    return out.select(*keys, F.when(F.col("ok"), F.col("payload")).alias("payload"), "attempts", F.when(~F.col("ok"), F.col("last_error")).alias("error"))


def breaker(calls: DataFrame, keys: list[str], order: str, failed: Column, limit: int) -> DataFrame:
    """Add ``state``: done, failed or skipped; after ``limit`` failures the rest of a key is skipped."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(failed.cast("int")).over(w), F.lit(0))
    return calls.withColumn("state", F.when(before >= max(limit, 1), "skipped").when(failed, "failed").otherwise("done"))


def stage_metadata(calls: DataFrame, keys: list[str], order: str, error: str, cap: int = 10) -> DataFrame:
    """(keys, total, done, failed, skipped, timeouts, errors): counters and the first ``cap`` errors of a stage (a report)."""
    # Only the first errors of a key are held, however many there are.
    failed = F.col("state") == "failed"
    calls = calls.withColumn("__nth", F.sum(failed.cast("int")).over(Window.partitionBy(*keys).orderBy(order)))
    errors = F.array_sort(F.collect_list(F.when(failed & (F.col("__nth") <= cap), F.struct(order, error))))
    n = lambda s: F.count_if(F.col("state") == s)
    timeouts = F.count_if(failed & T.is_timeout(F.col(error)))
    return calls.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), n("done").alias("done"), n("failed").alias("failed"), n("skipped").alias("skipped"), timeouts.alias("timeouts"), F.transform(errors, lambda e: e[error]).alias("errors"))


def merge_enrichment(finals: DataFrame, replies: DataFrame, keys: list[str]) -> DataFrame:
    """Questions with hints, explanations and correct options from replies (``payload`` JSON), if given there."""
    held = finals.join(replies.select(*keys, F.try_parse_json("payload").alias("__p")), keys, "left")
    hint = T.trim_u(F.try_variant_get("__p", "$.hint_explanation", "string"))
    said = F.try_variant_get("__p", "$.option_explanations", "map<string,string>")
    right = F.try_variant_get("__p", "$.correct_orders", "array<int>")
    options = F.transform(
        "options",
        lambda o: o.withField("option_explanation", F.coalesce(F.nullif(T.trim_u(F.try_element_at(said, o["opt_order"].cast("string"))), F.lit("")), o["option_explanation"])).withField(
            "is_correct", F.when(F.size(right) > 0, F.array_contains(right, o["opt_order"])).otherwise(o["is_correct"])
        ),
    )
    return held.withColumn("hint_explanation", F.coalesce(F.nullif(hint, F.lit("")), F.col("hint_explanation"))).withColumn("options", options).drop("__p")


def merge_refinement(finals: DataFrame, rounds: DataFrame, keys: list[str]) -> DataFrame:
    """Content after refinement: the last round with a valid text wins; adds confidence and needs_review.

    ``rounds`` has the keys, attempt and payload (JSON); every text is mechanically repaired first.
    """
    v = F.try_parse_json("payload")
    got = rounds.select(*keys, "attempt", F.nullif(T.repair_text(F.try_variant_get(v, "$.content", "string")), F.lit("")).alias("c"), F.lower(T.trim_u(F.try_variant_get(v, "$.confidence", "string"))).alias("conf"))
    last = got.groupBy(*keys).agg(F.max_by("c", F.when(F.col("c").isNotNull(), F.col("attempt"))).alias("refined"), F.max_by("conf", "attempt").alias("conf"))
    out = finals.join(last, keys, "left")
    text = F.coalesce("refined", T.repair_text(F.col("content")))
    confidence = F.when(F.col("conf").isin("high", "medium", "low"), F.col("conf")).otherwise("medium")
    out = out.withColumn("content", text).withColumn("confidence", confidence)
    return out.withColumn("needs_review", (F.col("confidence") == "low") | (F.size(T.artifacts(F.col("content"))) > 0)).drop("refined", "conf")


def valid_concepts(replies: DataFrame, key: str, raw: str, expected: str) -> DataFrame:
    """Add ``problem``: why a concept reply is refused, null if it is valid. ``expected``: array of question ids."""
    v = T.json_object(F.col(raw))
    ids = F.transform(F.try_variant_get(v, "$.question_concept_mapping", "array<variant>"), lambda m: F.try_variant_get(m, "$.question_id", "string"))
    concepts = F.try_variant_get(v, "$.concepts", "array<variant>")
    problem = (
        F.when(F.col(raw).rlike(T.SMART_QUOTES), "quotes").when(v.isNull(), "json").when(F.coalesce(F.size(concepts), F.lit(0)) != 1, "concepts")
        .when(~F.coalesce(F.array_sort(ids) == F.array_sort(F.col(expected)), F.lit(False)), "question ids")
    )
    return replies.withColumn("problem", problem)
