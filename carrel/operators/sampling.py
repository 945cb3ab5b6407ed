"""Evaluation sets: repeatable samples of diagnoses, and document statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.functions.web import file_name, plain_url
from carrel.sources.sinks import scratch


def sampled(diagnoses: DataFrame, n: int, seed: int, keys: list[str]) -> DataFrame:
    """n rows by the smallest seeded hash of their keys: the same rows on every run and layout."""
    return diagnoses.withColumn("h", F.xxhash64(F.lit(seed), *keys)).orderBy("h", *keys).limit(n).drop("h").orderBy(*keys)


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column).limit(n)


def documents_each(docs: DataFrame, key: str) -> DataFrame:
    """min, median, max and mean number of documents of a key."""
    return docs.groupBy(key).agg(F.count("*").alias("n")).agg(F.count("*").alias("n_keys"), F.min("n").alias("least"), F.median("n").alias("middle"), F.max("n").alias("most"), F.round(F.avg("n"), 4).alias("mean"))


def without_documents(patients: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    return patients.join(docs.select(key).distinct(), key, "left_anti")


def manifest(entries: DataFrame) -> DataFrame:
    """One row for each address (plain_url; blank ones go): first category and title, all source pages in order, each once.

    An address without a title has its file name for one.
    """
    pages = F.array_sort(F.collect_list(F.struct("pos", "source_page")))
    named = entries.withColumn("url", plain_url(F.col("url"))).where("url <> ''").groupBy("url")
    rows = named.agg(F.min_by("category", "pos").alias("category"), F.min_by("title", "pos").alias("title"), F.array_distinct(F.transform(pages, lambda p: p["source_page"])).alias("source_pages"))
    return rows.withColumn("title", F.when(F.coalesce("title", F.lit("")) == "", file_name(F.col("url"), F.lit(""))).otherwise(F.col("title")))


#: folders over which a stored manifest's addresses are dealt
MANIFEST_PARTS = 64


def upsert_manifest(entries: DataFrame, folder: str, parts: int = MANIFEST_PARTS) -> DataFrame:
    """Merge entries (url, category, title, pos, source_page) into a stored manifest and return it.

    A known address keeps its category and title and gains the source pages it doesn't have, in order; a
    new one is added. The manifest is dealt over folders by a hash of the address, and only the folders
    that new entries touch are read and replaced.
    """
    spark = entries.sparkSession
    part = F.pmod(F.xxhash64("url"), F.lit(parts)).cast("int")
    fresh = manifest(entries).withColumn("part", part)
    if not _has_rows(spark, folder):
        fresh.write.partitionBy("part").mode("overwrite").parquet(folder)
        return stored_manifest(spark, folder)
    touched = [r["part"] for r in fresh.select("part").distinct().collect()]  # at most ``parts`` numbers
    known = stored_manifest(spark, folder, keep_part=True).where(F.col("part").isin(touched))
    k, f = known.alias("k"), fresh.alias("f")
    old, new = F.coalesce("k.source_pages", F.array().cast("array<string>")), F.coalesce("f.source_pages", F.array().cast("array<string>"))
    merged = k.join(f, F.col("k.url") == F.col("f.url"), "full").select(F.coalesce("k.url", "f.url").alias("url"), F.coalesce("k.category", "f.category").alias("category"), F.coalesce("k.title", "f.title").alias("title"), F.array_distinct(F.concat(old, new)).alias("source_pages"), F.coalesce("k.part", "f.part").alias("part"))
    path = scratch(spark, "manifest")
    merged.write.parquet(path)  # whole before anything is replaced
    spark.read.schema(merged.schema).parquet(path).repartition("part").write.partitionBy("part").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(folder)
    return stored_manifest(spark, folder)


def stored_manifest(spark: SparkSession, folder: str, keep_part: bool = False) -> DataFrame:
    rows = spark.read.schema("url string, category string, title string, source_pages array<string>, part int").parquet(folder)
    return rows if keep_part else rows.drop("part")


def _has_rows(spark: SparkSession, folder: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/_SUCCESS")
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
