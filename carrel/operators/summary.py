"""Diagnosis summary: one row for each record, codes with their descriptions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import either, histology_code, one_line, site_code, stage_display, text
from carrel.operators.resolution import small

# Items shown, and the stage items with their column names.
SITE_ITEM, HISTOLOGY_ITEM = 400, 522
STAGE_COLUMNS = {1001: "clinical_t", 1002: "clinical_n", 1003: "clinical_m", 1004: "clinical_stage", 1011: "pathologic_t", 1012: "pathologic_n", 1013: "pathologic_m", 1014: "pathologic_stage"}


def _public(x: Column) -> Column:
    return F.when(F.lower(text(x)) == "blank", "").otherwise(text(x))


def _words(extracted: Column) -> Column:
    """An extracted value, unless it is only a code."""
    x = one_line(extracted)
    return F.when(x.rlike(r"(?i)^C?[0-9]{2,4}[./]?[0-9]?$"), "").otherwise(x)


def diagnosis_summary(results: DataFrame, tumors: DataFrame, codes: DataFrame, site_labels: DataFrame, histology_labels: DataFrame, keys: list[str]) -> DataFrame:
    """``results``: keys, item, extracted, resolved. ``tumors``: keys, primary_site_hint, histology, cancer_type.

    ``codes``: item, code, description. ``site_labels`` (code as Cdd or Cdd.d, label) and
    ``histology_labels`` (code, label) are the caller's reference tables.
    """
    items = [SITE_ITEM, HISTOLOGY_ITEM, *STAGE_COLUMNS]
    value = either(F.coalesce("resolved", F.lit("")), F.coalesce("extracted", F.lit("")))
    described = codes.groupBy("item", F.lower(text(F.col("code"))).alias("k")).agg(F.first("description").alias("description"))
    keyed = results.where(F.col("item").isin(items)).select(*keys, "item", F.coalesce("extracted", F.lit("")).alias("extracted"), value.alias("raw"))
    found = keyed.withColumn("k", F.lower(text(F.col("raw")))).join(small(described), ["item", "k"], "left")
    wide = found.groupBy(*keys).pivot("item", items).agg(F.first(F.struct("raw", "extracted", "description")))
    c = lambda item, f: F.coalesce(F.col(f"`{item}`.{f}"), F.lit(""))
    rows = tumors.join(wide, keys, "left").withColumn("site_key", site_code(c(SITE_ITEM, "raw"))).withColumn("histology_key", histology_code(c(HISTOLOGY_ITEM, "raw")))
    exact = small(site_labels.select(F.col("code").alias("site_key"), F.col("label").alias("exact_label")))
    broad = small(site_labels.where(F.length("code") == 3).select(F.col("code").alias("prefix"), F.col("label").alias("broad_label")))
    morph = small(histology_labels.select(F.col("code").alias("histology_key"), F.col("label").alias("morphology_label")))
    rows = rows.withColumn("prefix", F.substring("site_key", 1, 3)).join(exact, "site_key", "left").join(broad, "prefix", "left").join(morph, "histology_key", "left")
    empty = lambda name: F.coalesce(F.col(name), F.lit(""))
    site_text = either(one_line(c(SITE_ITEM, "description")), empty("exact_label"), empty("broad_label"), _words(c(SITE_ITEM, "extracted")), one_line(F.col("primary_site_hint")))
    histology_text = either(one_line(c(HISTOLOGY_ITEM, "description")), empty("morphology_label"), _words(c(HISTOLOGY_ITEM, "extracted")), one_line(F.col("histology")), one_line(F.col("cancer_type")))
    stages = [x for item, name in STAGE_COLUMNS.items() for x in (_public(c(item, "raw")).alias(f"{name}_code"), either(one_line(c(item, "description")), stage_display(_public(c(item, "raw")))).alias(f"{name}_text"))]
    return rows.select(*keys, _public(c(SITE_ITEM, "raw")).alias("site_code"), site_text.alias("site_text"), _public(c(HISTOLOGY_ITEM, "raw")).alias("histology_code"), histology_text.alias("histology_text"), *stages)
