"""Prompt blocks as grouped string aggregates: field instructions, prior state, narratives, code tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import either, text
from carrel.operators.resolution import small

NO_STATE = "Nothing is known yet: these are the first notes."
NO_NARRATIVES = "No narratives yet: these are the first notes."
SITE_ITEM, HISTOLOGY_ITEM = 400, 522


def field_rule(codes_text: Column) -> Column:
    """What a field's value must look like: its codes, else its date, digit, site, histology or length rule."""
    kind = F.lower(text(F.col("data_type")))
    size = F.greatest(F.coalesce("length", F.lit(1)), F.lit(1)).cast("string")
    return (
        F.when(either(codes_text) != "", F.concat(F.lit("Valid codes: "), codes_text))
        .when(kind == "date", "YYYYMMDD, 99 for an unknown day or month")
        .when(kind == "digits", text(F.concat(size, F.lit("-digit number. "), text(F.col("allowable_values")))))
        .when(F.col("item") == SITE_ITEM, "ICD-O-3 topography code C##.#, such as C50.4")
        .when(F.col("item") == HISTOLOGY_ITEM, "4-digit ICD-O-3 morphology code, 8000 to 9989")
        .otherwise(F.concat(F.lit("at most "), size, F.lit(" characters")))
    )


def field_instructions(items: DataFrame, codes_text: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """keys, instructions: one line a field, in item order. ``items``: keys, item, name, xml_id, length, data_type, allowable_values."""
    keys = keys or []
    name = either(text(F.col("xml_id")), F.concat(F.lit("item_"), F.col("item").cast("string")))
    line = F.concat(F.lit('"'), name, F.lit('": '), F.col("name"), F.lit(" (item "), F.col("item").cast("string"), F.lit("). "), field_rule(F.coalesce("codes_text", F.lit(""))))
    rows = items.join(small(codes_text), "item", "left").select(*keys, F.struct("item", line.alias("line")).alias("l"))
    return rows.groupBy(*keys).agg(_lines("l").alias("instructions"))


def _lines(column: str) -> Column:
    return F.array_join(F.transform(F.array_sort(F.collect_list(column)), lambda x: x["line"]), "\n")


def prior_state(results: DataFrame, units: DataFrame, keys: list[str]) -> DataFrame:
    """keys, prior for every unit: its results with a value and a confidence above 0, in item order."""
    value = either(F.coalesce("resolved", F.lit("")), F.coalesce("extracted", F.lit("")))
    shown = results.where((F.col("confidence") > 0) & (value != "")).select(*keys, F.struct("item", F.format_string("- %s (item %d): %s (confidence %.2f)", F.coalesce("name", F.lit("")), "item", value, "confidence").alias("line")).alias("l"))
    # the units join the grouping as rows without a line: a join behind it would sort all blocks
    whose = units.select(*keys).distinct().withColumn("l", F.lit(None).cast(shown.schema["l"].dataType))
    named = shown.dropna(subset=keys).select("*", F.lit(False).alias("unit")).unionByName(whose.withColumn("unit", F.lit(True)))
    blocks = named.groupBy(*keys).agg(F.max("unit").alias("unit"), F.count("l").alias("n"), _lines("l").alias("lines")).where("unit")
    return blocks.select(*keys, F.when(F.col("n") > 0, F.concat(F.lit("Known so far (change only on better evidence):\n"), "lines")).otherwise(NO_STATE).alias("prior"))


def prior_narratives(results: DataFrame, units: DataFrame, keys: list[str], text_items: list[int]) -> DataFrame:
    """keys, narratives for every unit: the summaries of its text items, in item order."""
    shown = results.where(F.col("item").isin(text_items) & (F.coalesce("resolved", F.lit("")) != "")).select(*keys, F.struct("item", F.concat(F.lit("- "), F.coalesce("name", F.lit("")), F.lit(": "), F.col("resolved")).alias("line")).alias("l"))
    blocks = shown.groupBy(*keys).agg(F.concat(F.lit("Narratives so far:\n"), _lines("l")).alias("narratives"))
    return units.select(*keys).distinct().join(blocks, keys, "left").withColumn("narratives", F.coalesce("narratives", F.lit(NO_NARRATIVES)))


def narrative_results(payloads: DataFrame, items: DataFrame) -> DataFrame:
    """Text items keep their words, cut to the item's length; no code is looked up. ``payloads``: field, value, model_confidence."""
    names = small(items.select("item", either(text(F.col("xml_id")), F.concat(F.lit("item_"), F.col("item").cast("string"))).alias("field"), "length"))
    cut = F.when(F.col("length") > 0, F.substring(F.col("value"), F.lit(1), F.col("length"))).otherwise(F.col("value"))
    kept = [c for c in payloads.columns if c not in ("field", "value", "model_confidence")]
    return payloads.join(names, "field").select(*kept, "item", F.col("value").alias("extracted"), cut.alias("resolved"), F.col("model_confidence").alias("confidence"))


def code_table(labels: DataFrame, title: str) -> DataFrame:
    """One row: a titled list of code and label in code order."""
    line = F.struct("code", F.concat("code", F.lit(" "), "label").alias("line"))
    return labels.select(line.alias("l")).agg(F.concat(F.lit(f"{title}:\n"), _lines("l")).alias("table_text"))
