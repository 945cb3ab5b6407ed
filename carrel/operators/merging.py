"""Extraction results: parsing model payloads, merging, filtering, seeding and defaults.

Results are long: keys, item, extracted, resolved, confidence, evidence, seq.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import text

SKIP_FROM = 0.9
EVIDENCE = 300
# Staging items where a bare number of five and more is an item number, not a code.
STAGING_ITEMS = [880, 890, 900, 910, 940, 950, 960, 970, 1001, 1002, 1003, 1004, 1011, 1012, 1013, 1014]
# Fields that every record has unless something else was found.
DEFAULTS = {10: "A", 50: "260"}
PAYLOAD = "map<string,struct<value:string,confidence:string,evidence:string>>"


def merged(results: DataFrame, keys: list[str]) -> DataFrame:
    """The result with the highest confidence for each item; the earliest among equals."""
    others = [c for c in results.columns if c not in (*keys, "item")]
    best = F.max_by(F.struct(*others), F.struct(F.coalesce("confidence", F.lit(0.0)), -F.col("seq")))
    return results.groupBy(*keys, "item").agg(best.alias("best")).select(*keys, "item", "best.*")


def still_open(items: DataFrame, prior: DataFrame, keys: list[str]) -> DataFrame:
    """Items worth asking again: not yet found with a confidence of SKIP_FROM or more."""
    return items.join(prior.where(F.col("confidence") >= SKIP_FROM).select(*keys, "item"), [*keys, "item"], "left_anti")


def leaked_number(item: Column, code: Column) -> Column:
    """True for a staging item whose code looks like an item number."""
    s = text(code)
    return item.isin(STAGING_ITEMS) & s.rlike("^[0-9]+$") & ~s.isin("88", "99") & (s.try_cast("bigint") >= 5)


def payload_items(responses: DataFrame, column: str = "response") -> DataFrame:
    """Explode a JSON object of field -> {value, confidence, evidence}; a one-element array is unwrapped.

    Fields starting with _ and blank values go; a confidence that is no number counts as 0.
    """
    body = F.trim(column)
    inner = F.when(body.startswith("["), F.regexp_replace(body, r"(?s)^\[\s*(.*?)\s*\]$", "$1")).otherwise(body)
    spread = responses.withColumn("entry", F.explode(F.map_entries(F.from_json(inner, PAYLOAD))))
    conf = F.coalesce(F.col("entry.value.confidence").try_cast("double"), F.lit(0.0))
    rows = spread.select(*responses.columns, F.col("entry.key").alias("field"), text(F.col("entry.value.value")).alias("value"), conf.alias("model_confidence"), F.substring(F.coalesce("entry.value.evidence", F.lit("")), 1, EVIDENCE).alias("evidence"))
    return rows.where("value <> '' and not startswith(field, '_')")


def combined_confidence(model: Column, resolution: Column) -> Column:
    """The lesser of both if the code resolved, else half of the model's."""
    return F.round(F.when(resolution > 0, F.least(model, resolution)).otherwise(model * 0.5), 4)


def seeded(tumors: DataFrame, keys: list[str]) -> DataFrame:
    """Results for items 400 and 522 from a detected tumor's codes, at full confidence."""
    pair = F.explode(F.array(F.struct(F.lit(400).alias("item"), F.col("primary_site_code").alias("code")), F.struct(F.lit(522).alias("item"), F.col("histology_code").alias("code"))))
    return tumors.select(*keys, pair.alias("p")).where("coalesce(p.code, '') <> ''").select(*keys, "p.item", F.col("p.code").alias("extracted"), F.col("p.code").alias("resolved"), F.lit(1.0).alias("confidence"))


def with_defaults(values: DataFrame, keys: list[str], defaults: dict[int, str] | None = None) -> DataFrame:
    """Add each default item to the records that lack it. ``values``: keys, item, value."""
    entries = F.explode(F.array(*(F.struct(F.lit(k).alias("item"), F.lit(x).alias("value")) for k, x in (defaults or DEFAULTS).items())))
    wanted = values.select(*keys).distinct().select(*keys, entries.alias("d")).select(*keys, "d.item", "d.value")
    return values.select(*keys, "item", "value").unionByName(wanted.join(values.select(*keys, "item"), [*keys, "item"], "left_anti"))


def usage_numbers(body: Column) -> Column:
    """The numbers of a reply's usage (or usageMetadata) object as a map of whole numbers; null if it has none.

    Only JSON numbers count: no texts that look like one, no truth values, no nested objects.
    """
    reply = F.try_parse_json(body)
    inner = lambda path: F.try_variant_get(reply, path, "map<string,variant>")
    entries = F.coalesce(inner("$.usage"), inner("$.usageMetadata"))
    numbers = F.map_filter(entries, lambda _, v: F.schema_of_variant(v).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"))
    whole = F.transform_values(numbers, lambda _, v: F.coalesce(F.try_variant_get(v, "$", "bigint"), F.try_variant_get(v, "$", "double").cast("bigint")))
    return F.when(F.size(whole) > 0, whole)


def content_text(content: Column) -> Column:
    """A content payload (JSON text of a string, of a list of parts or of one object) as plain text.

    Of a part that is an object, its text counts, or else its content; parts with neither go.
    """
    parts = F.from_json(content, "array<string>")
    piece = lambda p: F.when(p.startswith("{"), F.coalesce(F.get_json_object(p, "$.text"), F.get_json_object(p, "$.content"))).otherwise(p)
    joined = F.array_join(F.filter(F.transform(parts, piece), lambda p: p.isNotNull()), "")
    return F.coalesce(F.when(F.ltrim(content).startswith("["), joined).otherwise(content), F.lit(""))


def _said(content: Column) -> Column:
    """The texts of an output block's content: strings, text parts, refusals, else a part's own content."""
    parts = F.from_json(content, "array<string>")
    kind = lambda p: F.get_json_object(p, "$.type")
    text_ = lambda p: F.when(kind(p).isin("output_text", "text"), F.get_json_object(p, "$.text"))
    refusal = lambda p: F.when(kind(p) == "refusal", F.get_json_object(p, "$.refusal"))
    piece = lambda p: F.when(p.startswith("{"), F.coalesce(text_(p), refusal(p), F.get_json_object(p, "$.content"))).otherwise(p)
    joined = F.array_join(F.filter(F.transform(parts, piece), lambda p: p.isNotNull()), "")
    return F.coalesce(F.when(F.ltrim(content).startswith("["), joined).otherwise(content), F.lit(""))


def output_text(body: Column) -> Column:
    """The messages among a reply's output blocks, joined; '' if it has none."""
    blocks = F.from_json(F.get_json_object(body, "$.output"), "array<string>")
    own = F.filter(blocks, lambda b: F.get_json_object(b, "$.type").isin("message", "output_message") | (F.get_json_object(b, "$.role") == "assistant"))
    return F.coalesce(F.array_join(F.transform(own, lambda b: _said(F.get_json_object(b, "$.content"))), ""), F.lit(""))


def envelope_text(body: Column) -> Column:
    """The text of a model's reply: output text or output blocks, chat choices, content blocks or candidates' parts."""
    paths = ["$.choices[0].message.content", "$.content", "$.output.message.content", "$.candidates[0].content.parts"]
    first = F.nullif(F.coalesce(F.get_json_object(body, "$.output_text"), F.lit("")), F.lit(""))
    return F.coalesce(first, F.nullif(output_text(body), F.lit("")), content_text(F.coalesce(*(F.get_json_object(body, p) for p in paths))))
