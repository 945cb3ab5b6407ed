"""The running tumor list over arriving chunks: one list state a patient, carried from batch to batch."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from carrel.operators.models import Client
from carrel.operators.tumors import COLUMNS, FIELDS, SCHEMA, Listing

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class TumorList(StatefulProcessor):
    """Folds a patient's chunks of a batch, in order, into the list that earlier batches left.

    A chunk that was folded before (a source may repeat itself) is left out; one that comes late is
    folded when it comes.
    """

    def __init__(self, client: Client, attempts: int = 1):
        self.client, self.attempts = client, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entries = handle.getListState("entries", ", ".join(f"{f} string" for f in FIELDS))
        self.origin = handle.getMapState("origin", "entry string", "chunks array<string>")
        self.folded = handle.getMapState("folded", "chunk_id string", "chunk_index int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values("chunk_index", kind="stable")
        listing = Listing([dict(zip(FIELDS, row, strict=True)) for row in self.entries.get()], {k[0]: list(v[0]) for k, v in self.origin.iterator()})
        for chunk_id, index, body in zip(batch["chunk_id"], batch["chunk_index"], batch["chunk_text"], strict=True):
            if not self.folded.containsKey((chunk_id,)):
                listing.take(chunk_id, body, self.client, self.attempts)
                self.folded.updateValue((chunk_id,), (int(index),))
        if listing.running:
            self.entries.put([tuple(row[f] for f in FIELDS) for row in listing.running])
        else:
            self.entries.clear()
        for name, chunks in listing.origin.items():
            self.origin.updateValue((name,), (chunks,))
        yield pd.DataFrame(listing.rows(key[0]), columns=COLUMNS)

    def close(self) -> None:
        pass


def running_lists(chunks: DataFrame, client: Client, out: str, checkpoint: str, attempts: int = 1) -> StreamingQuery:
    """Fold arriving chunks (patient_id, chunk_id, chunk_index, chunk_text) and write each batch's changed lists to ``out``.

    A stopped query goes on from its checkpoint. A batch that is run again replaces its own folder.
    """
    spark = chunks.sparkSession

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        keyed = chunks.select("patient_id", "chunk_id", "chunk_index", "chunk_text").groupBy("patient_id")
        lists = keyed.transformWithStateInPandas(TumorList(client, attempts), SCHEMA, "Update", "None")
        return lists.writeStream.foreachBatch(store).outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def latest_lists(spark: SparkSession, out: str) -> DataFrame:
    """Every patient's list as of the last batch that changed it."""
    rows = spark.read.schema(f"{SCHEMA}, batch int").parquet(out)
    last = rows.groupBy("patient_id").agg(F.max("batch").alias("batch"))
    return rows.join(last, ["patient_id", "batch"]).select(*COLUMNS)
