"""Writers: hierarchical XML, fixed-width, wide CSV, JSON, audit, review, summary and checkpoints."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.operators.resolution import small

NAMESPACE = "http://naaccr.org/naaccrxml"


def pivoted(values: DataFrame, keys: list[str]) -> tuple[DataFrame, list[int]]:
    """One column for each observed item, in order; '' where missing. ``values``: keys, item, value."""
    items = [r["item"] for r in values.select("item").distinct().orderBy("item").collect()]
    wide = values.groupBy(*keys).pivot("item", items).agg(F.first("value"))
    return wide.na.fill("", [str(i) for i in items]), items


def wide_table(values: DataFrame, names: DataFrame, keys: list[str]) -> DataFrame:
    """Columns named 'name [item]' (names: item, name)."""
    wide, items = pivoted(values, keys)
    known = {r["item"]: r["name"] for r in names.where(F.col("item").isin(items)).collect()}
    return wide.select(*keys, *(F.col(f"`{i}`").alias(f"{known.get(i) or f'Item {i}'} [{i}]") for i in items))


def fixed_width(values: DataFrame, lengths: DataFrame, keys: list[str]) -> DataFrame:
    """keys and one line: every observed item cut and padded to its length (1 where unknown)."""
    wide, items = pivoted(values, keys)
    known = {r["item"]: r["length"] for r in lengths.where(F.col("item").isin(items)).collect()}
    cells = [F.rpad(F.substring(f"`{i}`", 1, max(known.get(i) or 1, 1)), max(known.get(i) or 1, 1), " ") for i in items]
    return wide.select(*keys, F.concat(*cells).alias("line"))


def _item(item: Column, xml_id: Column, value: Column, depth: int) -> Column:
    safe = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.concat(F.lit("  " * depth + '<Item naaccrId="'), xml_id, F.lit('" naaccrNum="'), item.cast("string"), F.lit('">'), safe, F.lit("</Item>"))


#: values of one task, and of one document where there may be several: what a task sorts doesn't grow with the table
XML_VALUES = 500_000


def _parts(values: DataFrame) -> int:
    return max(1, -(-values.count() // XML_VALUES))


def _patients(values: DataFrame, items: DataFrame, patient: str, tumor: str, parts: int) -> DataFrame:
    """patient, xml, top (file items of the first tumor). Values are dealt by patient once, nothing is exchanged after it."""
    dealt = values.select(patient, tumor, "item", "value").repartition(max(parts, values.sparkSession.sparkContext.defaultParallelism), patient)
    rows = dealt.join(small(items.select("item", "xml_id", "parent_element")), "item", "left")
    told = (F.coalesce("value", F.lit("")) != "") & F.col(patient).isNotNull() & F.col(tumor).isNotNull()

    def lines(parent: str, depth: int) -> Column:
        held = F.collect_list(F.when(told & (F.col("parent_element") == parent), F.struct("item", _item(F.col("item"), F.col("xml_id"), F.col("value"), depth).alias("x"))))
        return F.nullif(F.array_join(F.transform(F.array_sort(held), lambda s: s["x"]), "\n"), F.lit(""))

    tumors = rows.groupBy(patient, tumor).agg(lines("Tumor", 3).alias("xml"), lines("Patient", 2).alias("own"), lines("NaaccrData", 1).alias("top"))
    tumor_xml = F.concat(F.lit("    <Tumor>\n"), F.coalesce(F.concat("xml", F.lit("\n")), F.lit("")), F.lit("    </Tumor>"))
    ordered = tumors.groupBy(patient).agg(F.array_sort(F.collect_list(F.struct(F.col(tumor).alias("t"), tumor_xml.alias("x"), "own", "top"))).alias("tumors"))
    first = F.get(F.filter("tumors", lambda x: x["t"].isNotNull()), F.lit(0))
    body = F.concat(F.lit("  <Patient>\n"), F.coalesce(F.concat(first["own"], F.lit("\n")), F.lit("")), F.array_join(F.transform("tumors", lambda x: x["x"]), "\n"), F.lit("\n  </Patient>"))
    return ordered.select(F.col(patient).alias("patient"), body.alias("xml"), first["top"].alias("top"))


def _head(patients: DataFrame) -> DataFrame:
    """head: what stands ahead of the patients, with the file items of the first one."""
    opened = F.lit(f'<?xml version="1.0" encoding="UTF-8"?>\n<NaaccrData xmlns="{NAMESPACE}">')
    return patients.agg(F.min_by("top", "patient").alias("top")).select(F.concat(opened, F.coalesce(F.concat(F.lit("\n"), "top"), F.lit(""))).alias("head"))


FOOT = "</NaaccrData>"


def xml_lines(values: DataFrame, items: DataFrame, patient: str, tumor: str) -> DataFrame:
    """part, patient, xml: the head (items of the first record), each patient, the foot.

    ``values``: patient, tumor, item, value. ``items``: item, xml_id, parent_element. Unknown items
    and blank values go; file and patient items come from the first record they could come from.
    """
    body = _patients(values, items, patient, tumor, _parts(values))
    nobody = F.lit(None).cast(values.schema[patient].dataType).alias("patient")
    opening = _head(body).select(F.lit(0).alias("part"), nobody, F.col("head").alias("xml"))
    closing = values.sparkSession.range(1).select(F.lit(2).alias("part"), nobody, F.lit(FOOT).alias("xml"))
    return opening.union(body.select(F.lit(1).alias("part"), "patient", "xml")).union(closing)


def write_xml(values: DataFrame, items: DataFrame, path: str, patient: str = "patient_id", tumor: str = "tumor_index", documents: int | None = 1) -> None:
    """One document in one file, as a submission needs it; or at least ``documents`` whole ones, patients dealt over them by range.

    There are more than ``documents`` where one would get over about XML_VALUES values; None asks for no
    least number. Each document has the same head and foot. Readers take a folder of them like one file.
    """
    if documents == 1:
        xml_lines(values, items, patient, tumor).orderBy("part", "patient").select("xml").coalesce(1).write.mode("overwrite").text(path)
        return
    parts = _parts(values)
    n = max(parts, documents or 1)
    dealt = _patients(values, items, patient, tumor, parts).repartitionByRange(n, "patient")
    placed = dealt.sortWithinPartitions("patient").withColumn("file", F.spark_partition_id()).withColumn("row", F.monotonically_increasing_id())
    placed = written_once(placed, f"{path}-patients")
    edges = placed.groupBy("file").agg(F.min("row").alias("first"), F.max("row").alias("last"))
    whole = placed.join(F.broadcast(edges), "file").join(F.broadcast(_head(placed))).select(
        "file", "row", F.concat(F.when(F.col("row") == F.col("first"), F.concat("head", F.lit("\n"))).otherwise(""), F.col("xml"), F.when(F.col("row") == F.col("last"), F.lit("\n" + FOOT)).otherwise("")).alias("xml")
    )
    whole.repartitionById(n, "file").sortWithinPartitions("file", "row").select("file", "xml").write.mode("overwrite").partitionBy("file").text(path)


def written_once(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: rows of one CSV file: values may hold line ends, so a reader takes each file in one task
CSV_ROWS = 20_000


def write_csv(df: DataFrame, path: str) -> None:
    """Files of at most CSV_ROWS rows, quoted where needed; outer blanks of values stay."""
    df.write.mode("overwrite").option("maxRecordsPerFile", CSV_ROWS).csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share (spark.checkpoint.dir; in local mode a temporary one of our own), removed when Python ends."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="carrel-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    path = f"{folder}/{uuid.uuid4().hex}-{name}"
    atexit.register(_drop, spark, path)
    return path


def _drop(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended before the clean-up
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def write_json(values: DataFrame, path: str, keep_blank: bool = False, names: dict[str, str] | None = None) -> None:
    """One object a record from a ``values`` map; blanks dropped and keys renamed on request."""
    cells = F.col("values") if keep_blank else F.map_filter("values", lambda k, x: (k != "") & (x != ""))
    if names:
        lookup = F.create_map(*(F.lit(x) for kv in names.items() for x in kv))
        cells = F.transform_keys(cells, lambda k, _: F.coalesce(F.try_element_at(lookup, k), k))
    values.select(F.to_json(cells).alias("value")).write.mode("overwrite").text(path)


def flattened(values: DataFrame) -> DataFrame:
    """A ``values`` map as columns, in order of first appearance; columns without any value go."""
    entries = values.withColumn("row", F.monotonically_increasing_id()).select("row", F.posexplode(F.map_entries("values")).alias("pos", "e"))
    used = entries.where("e.value <> ''").groupBy("e.key").agg(F.min(F.struct("row", "pos")).alias("first")).orderBy("first")
    return values.select(*(F.coalesce(F.try_element_at("values", F.lit(r["key"])), F.lit("")).alias(r["key"]) for r in used.collect()))


def audit_rows(results: DataFrame, keys: list[str]) -> DataFrame:
    return results.select(*keys, "item", "extracted", "resolved", "confidence", F.substring(F.coalesce("evidence", F.lit("")), 1, 500).alias("evidence"))


def write_audit(results: DataFrame, keys: list[str], path: str) -> bool:
    """No file for no entries."""
    if results.isEmpty():
        return False
    write_csv(audit_rows(results, keys), path)
    return True


def write_review(queue: DataFrame, keys: list[str], path: str) -> None:
    write_csv(queue.orderBy(*keys, "priority_rank", "final_confidence", "item"), path)


def write_log(calls: DataFrame, path: str) -> None:
    """Model calls, appended as JSON lines."""
    calls.write.mode("append").json(path)


def checkpoint_key(patient: Column) -> Column:
    """A stable, short and safe name for a patient's checkpoint."""
    return F.substring(F.sha2(patient, 256), 1, 20)


def write_checkpoint(state: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a round's state as Parquet (the committer makes it whole or absent) and read it back."""
    path = f"{folder}/{name}"
    state.write.mode("overwrite").parquet(path)
    return state.sparkSession.read.parquet(path)
