"""Requests to external services as data: context JSON, message parts, checks of what is sent.

The instruction texts are parameters: this engine joins them with the context of each record.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

_KEEP_NULLS = {"ignoreNullFields": "false"}
PLACE = "{{INPUT_JSON}}"


def filled(template: str, json: Column) -> Column:
    """A template with its place for input replaced."""
    return F.replace(F.lit(template), F.lit(PLACE), json)


def question_context(options: Column, content: Column, source: Column) -> Column:
    """JSON of a question with the order and content of its options."""
    short = F.transform(options, lambda o: F.struct(o["opt_order"].alias("order"), o["content"].alias("content")))
    return F.to_json(F.struct(source.alias("question_source"), content.alias("question_content"), short.alias("options")), _KEEP_NULLS)


def caption_context(options: Column, content: Column, source: Column, image: Column, option: Column | None = None) -> Column:
    """JSON of a question and the image to describe, with the option it belongs to, if any."""
    short = F.transform(options, lambda o: F.struct(o["opt_order"].alias("order"), o["content"].alias("content")))
    place = F.lit("question" if option is None else "option")
    fields = [source.alias("question_source"), content.alias("question_content"), short.alias("options"), F.struct(image["image_id"].alias("image_id"), image["image_name"].alias("image_name"), place.alias("location")).alias("target_image")]
    if option is not None:
        fields.append(F.struct(option["opt_order"].alias("order"), option["content"].alias("content")).alias("target_option"))
    return F.to_json(F.struct(*fields), _KEEP_NULLS)


def refine_context(content: Column, options: Column, findings: Column) -> Column:
    """JSON of the mechanically repaired texts and the damage still seen in them."""
    short = F.transform(options, lambda o: F.struct(o["opt_order"].alias("order"), T.repair_text(o["content"]).alias("content")))
    return F.to_json(F.struct(T.repair_text(content).alias("content"), short.alias("options"), findings.alias("artifacts")), _KEEP_NULLS)


def question_findings(content: Column, options: Column) -> Column:
    """Damage of a question and of its options, each with its place."""
    own = F.transform(T.artifacts(content), lambda x: F.concat(F.lit("content: "), x))
    of_options = F.flatten(F.transform(options, lambda o: F.transform(T.artifacts(o["content"]), lambda x: F.concat(F.lit("option "), o["opt_order"].cast("string"), F.lit(": "), x))))
    return F.concat(own, F.coalesce(of_options, F.array().cast("array<string>")))


def message(text: Column, urls: Column) -> Column:
    """Parts of one message: the text, then every image."""
    part = lambda kind, t, u: F.struct(F.lit(kind).alias("type"), t.alias("text"), u.alias("image_url"))
    none = F.lit(None).cast("string")
    return F.concat(F.array(part("text", text, none)), F.transform(urls, lambda u: part("image_url", none, u)))


def answer_input(test_id: Column, question_id: Column, paths: Column) -> Column:
    """JSON input of one question: its first image is the question, the others are options."""
    return F.to_json(F.struct(test_id.alias("test_id"), question_id.alias("question_id"), F.slice(paths, 1, 1).alias("question_image_urls"), F.slice(paths, F.lit(2), F.greatest(F.size(paths) - 1, F.lit(0))).alias("option_image_urls")))


def concept_input(question_ids: Column) -> Column:
    """JSON input of several questions, each with the place of its image."""
    return F.to_json(F.struct(F.transform(question_ids, lambda q, i: F.struct(q.alias("question_id"), (i + 1).alias("image_index"))).alias("questions")))


def question_ids(given: Column, n_images: Column) -> Column:
    """Given ids if there is one for each image, 1 to n if none are given, else null."""
    return F.when(given.isNull(), F.sequence(F.lit(1), n_images)).when(F.size(given) == n_images, given)


def image_count_ok(paths: Column) -> Column:
    """Two or three images are sent."""
    return F.size(paths).isin(2, 3)


def corrections(value: Column) -> Column:
    """Corrections of a VARIANT reply that say anything, trimmed."""
    text = lambda v, n: F.coalesce(T.trim_u(F.try_variant_get(v, f"$.{n}", "string")), F.lit(""))
    rows = F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: F.struct(text(v, "before").alias("before"), text(v, "after").alias("after"), text(v, "reason").alias("reason")))
    return F.coalesce(F.filter(rows, lambda c: (c["before"] != "") | (c["after"] != "") | (c["reason"] != "")), F.array().cast("array<struct<before:string,after:string,reason:string>>"))


def caption(value: Column) -> Column:
    """A caption from a VARIANT reply; empty unless it is a text."""
    return F.when(F.schema_of_variant(value) == "STRING", T.trim_u(F.try_variant_get(value, "$", "string"))).otherwise("")
