"""Streaming extras: incremental compression and running best results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from carrel.operators.compression import compressed, fingerprint, pending
from carrel.operators.models import Client


def compress_stream(notes: DataFrame, client: Client, out: str, checkpoint: str) -> StreamingQuery:
    """Compress arriving notes; a note already in ``out`` with the same fingerprint isn't asked again."""

    def step(batch: DataFrame, _: int) -> None:
        keyed = batch.withColumn("fingerprint", fingerprint()).dropDuplicates(["row_index", "fingerprint"])
        spark = batch.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(out)
        there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
        todo = pending(keyed, spark.read.parquet(out)) if there else keyed
        compressed(todo, client).write.mode("append").parquet(out)

    return notes.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def best_results(results: DataFrame, keys: list[str]) -> DataFrame:
    """Running highest-confidence result of each item (the earliest among equals); for update mode."""
    best = F.max_by(F.struct("extracted", "resolved", "confidence"), F.struct("confidence", -F.col("seq")))
    return results.groupBy(*keys, "item").agg(best.alias("best"))
