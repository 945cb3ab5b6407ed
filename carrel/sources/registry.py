"""Registry files: hierarchical XML, registry exports, prediction tables, manuals and web pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.functions.dates import registry_date
from carrel.functions.scalars import text
from carrel.operators.scoring import ITEMS
from carrel.sources.notes import read_table

_ITEM = "array<struct<_VALUE:string,_naaccrId:string,_naaccrNum:string>>"
# Columns of the registry export that the scorer knows, and the fields they become; others are given as a parameter.
EXPORT = {"DFCI_MRN": "mrn", "DIAGNOSIS_DT": "date", "DERIVED_BEST_ROW_IND": "best_row", "SITE_CD": "site", "SITE_DESCR": "site_descr", "HISTOLOGY_CD": "hist", "HISTOLOGY_DESCR": "hist_descr", "BEHAVIOR_CD": "beh", "LATERALITY_CD": "lat", "GRADE_DIFF_CODE": "grade", "GENERAL_STAGE_CD": "ss", "BEST_AJCC_STAGE_CD": "ajcc", "CLIN_T_CD": "t", "CLIN_N_CD": "n", "CLIN_M_CD": "m", "SSDI_ER_SUMMARY": "er", "SSDI_PR_SUMMARY": "pr", "SSDI_HER2_OVERALL_SUMMARY": "her2"}


def _pairs(items: Column) -> Column:
    """Direct items as a map; without an id the number names an item. The last of equal names counts."""
    named = F.transform(F.coalesce(items, F.array().cast(_ITEM)), lambda i: F.named_struct(F.lit("k"), F.coalesce(F.nullif(i["_naaccrId"], F.lit("")), i["_naaccrNum"]), F.lit("v"), F.coalesce(i["_VALUE"], F.lit(""))))
    named = F.filter(named, lambda p: p["k"].isNotNull())
    last = F.filter(named, lambda p, n: ~F.exists(F.slice(named, n + 2, F.size(named)), lambda q: q["k"] == p["k"]))
    return F.map_from_entries(last)


def _over(upper: Column, lower: Column) -> Column:
    """Both maps; the lower level's value counts."""
    return F.map_concat(F.map_filter(upper, lambda k, _: ~F.array_contains(F.map_keys(lower), k)), lower)


_PATIENT = f"Item {_ITEM}, Tumor array<struct<Item:{_ITEM}>>"
END = "</Patient>"


def read_xml(spark: SparkSession, path: str) -> DataFrame:
    """file, patient_no (place in its file), tumor_no, values map: file, patient and tumor items, lower levels over upper ones.

    A patient without tumors gives one row. Files are read in splits: the end of a patient ends a record, so
    a large file takes many tasks and no task holds more than a patient. What stands outside patients (file
    items, ahead of the first or behind the last) is gathered by file. Patients are numbered by their
    split's count and their place in the split. The element names carry no prefix.
    """
    records = spark.read.option("lineSep", END).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    closed = F.regexp_extract_all("value", F.lit(r"(?s)<Patient\b[^>]*/>|<Patient\b.*"), F.lit(0))  # an empty patient may stand before a full one
    found = records.select("file", "block", "at", F.posexplode(closed).alias("place", "patient"))
    counted = found.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = counted.select("file", "block", before.alias("before"))
    order = Window.partitionBy("file", "block").orderBy("at", "place")
    outer = F.regexp_replace("value", r"(?s)<Patient\b.*", "")
    items = F.regexp_extract_all(outer, F.lit(r"(?s)<Item\b[^>]*/>|<Item\b.*?</Item>"), F.lit(0))
    heads = records.select("file", "block", "at", items.alias("items")).where(F.size("items") > 0).groupBy("file").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "items"))), lambda x: x["items"])).alias("items"))
    heads = heads.select("file", _pairs(F.from_xml(F.concat(F.lit("<r>"), F.array_join("items", ""), F.lit("</r>")), f"Item {_ITEM}")["Item"]).alias("top"))
    whole = F.when(F.col("patient").endswith("/>"), F.col("patient")).otherwise(F.concat("patient", F.lit(END)))
    splits = max(records.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)  # as many tasks as read them: text shuffles far smaller than it is
    parsed = found.repartition(splits, "file", "block").select("file", "block", F.row_number().over(order).alias("nth"), F.from_xml(whole, _PATIENT).alias("p"))
    numbered = parsed.join(blocks, ["file", "block"]).join(heads, "file", "left").select("file", (F.col("before") + F.col("nth") - 1).cast("int").alias("patient_no"), F.coalesce("top", F.create_map().cast("map<string,string>")).alias("top"), "p")
    tumors = numbered.select("file", "patient_no", _over(F.col("top"), _pairs(F.col("p.Item"))).alias("upper"), F.posexplode_outer("p.Tumor").alias("tumor_no", "tumor"))
    return tumors.select("file", "patient_no", F.coalesce("tumor_no", F.lit(0)).alias("tumor_no"), F.when(F.col("tumor").isNull(), F.col("upper")).otherwise(_over(F.col("upper"), _pairs(F.col("tumor.Item")))).alias("values"))


def read_export(spark: SparkSession, path: str, columns: dict[str, str] | None = None) -> DataFrame:
    """A registry export with the scorer's fields; missing ones are null; key and date must be there.

    ``columns``: the export's columns and the fields they become (an institution's own names).
    """
    raw, columns = read_table(spark, path), columns or EXPORT
    needed = [c for c, f in columns.items() if f in ("mrn", "date")]
    if not set(needed) <= set(raw.columns):
        raise ValueError(f"a registry export needs {' and '.join(needed)}")
    rows = raw.select(*((F.col(c) if c in raw.columns else F.lit(None).cast("string")).alias(f) for c, f in columns.items()))
    return rows.withColumn("mrn", text(F.col("mrn")).try_cast("bigint")).withColumn("day", registry_date(F.col("date"))).where("mrn is not null")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Raw item columns of a wide prediction table, found by their [item] ending."""
    raw = read_table(spark, path)
    ending = lambda item: next((c for c in raw.columns if c.strip().endswith(f"[{item}]")), None)
    if ending(ITEMS["mrn"]) is None:
        raise ValueError(f"predictions need a column for item {ITEMS['mrn']}")
    return raw.select(F.monotonically_increasing_id().alias("ord"), *(F.col(f"`{ending(i)}`").alias(n) for n, i in ITEMS.items() if ending(i)))


def read_for_patients(spark: SparkSession, path: str, column: str, patients: DataFrame, columns: list[str]) -> DataFrame:
    """Some columns of the rows of some patients (a semi-join; columns are pruned in the scan)."""
    return read_table(spark, path).select(column, *columns).join(patients.select(column).distinct(), column, "left_semi")


def manuals(spark: SparkSession, manifest: str, root: str) -> DataFrame:
    """category, title, url, path, text of the manifest's entries whose text file is there."""
    listed = spark.read.json(manifest, multiLine=True).where("text_path is not null")
    files = spark.read.text(f"{root}/*/*.txt", wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    tail = lambda c: F.regexp_extract(F.url_decode(c), r"([^/]+/[^/]+)$", 1)
    return listed.withColumn("k", F.regexp_extract("text_path", r"([^/]+/[^/]+)$", 1)).join(files.withColumn("k", tail(F.col("file"))), "k").select("category", "title", "url", F.col("text_path").alias("path"), F.col("value").alias("text"))

