"""Data dictionary tables: items, codes and alternate names (CSV with a blank first line)."""

from __future__ import annotations

import csv
import io

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.functions.scalars import text

# CSV headers and the columns they become.
ITEM_COLUMNS = {"Data Item Number": "item", "Data Item Name": "name", "Length": "length", "Section Name": "section", "XML NAACCR ID": "xml_id", "Parent XML Element": "parent_element", "Year Retired": "year_retired", "Version Retired": "version_retired", "NPCR Collect": "npcr_collect", "CoC Collect": "coc_collect", "SEER Collect": "seer_collect", "Description": "description", "Instructions for Coding": "instructions", "Allowable Values": "allowable_values", "Data Type": "data_type", "Format": "format"}
CODE_COLUMNS = {"Data Item Number": "item", "Data Item Name": "name", "Length": "length", "Code": "code", "Description": "description"}
NAME_COLUMNS = {"Data Item Number": "item", "Data Item Name": "name", "Alternate Name": "alternate_name"}


def read(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Stripped cells of rows whose item number is a number, with their place in the file (pos).

    The files start with a byte-order mark and a blank line, so the header is the first line that
    isn't blank. A dictionary is one small file, parsed on the driver.
    """
    lines = spark.read.text(path, wholetext=True).select(F.regexp_replace(F.regexp_replace("value", "^﻿", ""), r"^(\s*\r?\n)+", "").alias("value"))
    body = lines.first()["value"]
    reader = csv.DictReader(io.StringIO(body))
    names = [c.strip() for c in reader.fieldnames or []]
    missing = [c for c in columns if c not in names]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    data = [(k, *((r.get(c) or "").strip() for c in columns)) for k, r in enumerate(reader)]
    found = spark.createDataFrame(data, "pos int, " + ", ".join(f"{n} string" for n in columns.values()))
    number = F.col("item").try_cast("int")
    found = found.where(number.isNotNull()).withColumn("item", number)
    return found.withColumn("length", F.coalesce(F.col("length").try_cast("int"), F.lit(0))) if "length" in found.columns else found


def items(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, ITEM_COLUMNS)


def codes(spark: SparkSession, path: str) -> DataFrame:
    return read(spark, path, CODE_COLUMNS)


def alternate_names(spark: SparkSession, path: str) -> DataFrame:
    """k (lower case), item: the last row of a name counts."""
    rows = read(spark, path, NAME_COLUMNS).where("alternate_name <> ''")
    return rows.groupBy(F.lower(text(F.col("alternate_name"))).alias("k")).agg(F.max_by("item", "pos").alias("item"))
