"""Clinical notes: reading, required columns, structured columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.functions.scalars import strip, text
from carrel.operators.chunking import document_index

REQUIRED = ["patient_id", "date", "text"]
# Other names of structured columns and their items.
STRUCTURED = {
    "mrn": 2300, "medical_record_number": 2300, "last_name": 2230, "name_last": 2230, "first_name": 2240, "name_first": 2240, "middle_name": 2250, "name_middle": 2250,
    "dob": 240, "date_of_birth": 240, "birth_date": 240, "sex": 220, "gender": 220, "race": 160, "race1": 160, "ethnicity": 190, "hispanic": 190, "spanish_hispanic_origin": 190,
    "address": 2330, "street": 2330, "addr_at_dx": 2330, "city": 70, "state": 80, "zip": 100, "zip_code": 100, "postal_code": 100, "ssn": 2320, "social_security": 2320, "social_security_number": 2320,
    "marital_status": 150, "county": 90,
}


def read_table(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """Parquet, CSV or TSV by suffix; text columns only unless ``typed``."""
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "parquet":
        return spark.read.parquet(path)
    if kind in ("csv", "tsv"):
        return spark.read.csv(path, header=True, sep="\t" if kind == "tsv" else ",", multiLine=True, escape='"', inferSchema=typed)
    raise ValueError(f"unsupported file type: {path}")


def required(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Rename the required columns, found without regard to case and outer blanks; name all that are missing."""
    names = names or REQUIRED
    there = {c.strip().lower(): c for c in df.columns}
    missing = [n for n in names if n.lower() not in there]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    return df.withColumnsRenamed({there[n.lower()]: n for n in names})


def nonblank(df: DataFrame, column: str = "text") -> DataFrame:
    return df.where(F.col(column).isNotNull() & (strip(F.col(column)) != ""))


def structured_columns(columns: list[str]) -> dict[str, int]:
    normal = lambda c: c.strip().lower().replace(" ", "_").replace("-", "_")
    return {c: STRUCTURED[normal(c)] for c in columns if normal(c) in STRUCTURED}


def load(spark: SparkSession, path: str, typed: bool = False) -> DataFrame:
    """Notes with patient_id, date, text, doc_index and all other columns; blank texts and keys go."""
    df = required(read_table(spark, path, typed)).withColumn("ord", F.monotonically_increasing_id())
    return document_index(nonblank(df).where("patient_id is not null"))


def structured_items(notes: DataFrame, order: list | None = None) -> DataFrame:
    """patient_id, item, value from each patient's first note; of two columns for an item, the later one."""
    found = structured_columns(notes.columns)
    if not found:
        return notes.sparkSession.createDataFrame([], "patient_id string, item int, value string")
    first = notes.withColumn("n", F.row_number().over(Window.partitionBy("patient_id").orderBy(*(order or ["doc_index"])))).where("n = 1")
    entries = F.array(*(F.struct(F.lit(k).alias("pos"), F.lit(item).alias("item"), text(F.col(c)).alias("value")) for k, (c, item) in enumerate(found.items())))
    rows = first.select("patient_id", F.explode(entries).alias("e")).select("patient_id", "e.*").where("value <> ''")
    return rows.groupBy("patient_id", "item").agg(F.max_by("value", "pos").alias("value"))
