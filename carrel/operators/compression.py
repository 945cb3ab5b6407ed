"""Note compression: a fingerprinted, resumable map of notes to summaries."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carrel.functions.scalars import summary_text, text
from carrel.operators.models import Client, Limiter, converse, in_flight, request_id
from carrel.sources.answers import answered_durably

SYSTEM = "Summarise the clinical note. Keep every fact on diagnosis, stage, treatment and dates. Add nothing."


def fingerprint(row: str = "row_index", patient: str = "patient_id", date: str = "date", document: str | None = None, body: str = "text") -> Column:
    """Changes with a row's place, keys or text."""
    ident = F.struct(F.col(row).alias("row"), F.col(patient).cast("string").alias("patient"), F.col(date).cast("string").alias("date"), (F.col(document).cast("string") if document else F.lit("")).alias("document"), F.sha2(F.coalesce(body, F.lit("")), 256).alias("text"))
    return F.sha2(F.to_json(ident), 256)


def pending(notes: DataFrame, done: DataFrame) -> DataFrame:
    """Rows without a finished result for the same place and fingerprint."""
    return notes.join(done.select("row_index", "fingerprint"), ["row_index", "fingerprint"], "left_anti")


#: notes that a task keeps in flight
NOTES_IN_FLIGHT = 4


def compressed(notes: DataFrame, client: Client, attempts: int = 3, width: int = NOTES_IN_FLIGHT, per_second: float | None = None) -> DataFrame:
    """All columns with output_text, used_fallback and error; a failed row keeps its text."""

    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        limiter = Limiter(per_second)

        def one(body: str | None) -> tuple[str | None, bool, str | None]:
            call = converse(client, SYSTEM, body or "", attempts, limiter=limiter)
            return (body, True, f"{type(call.error).__name__}: {call.error}") if call.error else (call.value, False, None)

        for frame in frames:
            out = list(in_flight(iter(frame["text"]), one, width))
            yield frame.assign(output_text=[x[0] for x in out], used_fallback=[x[1] for x in out], error=[x[2] for x in out])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in notes.schema)
    asked = notes.mapInPandas(ask, f"{kinds}, output_text string, used_fallback boolean, error string")
    return asked.withColumn("output_text", F.when(F.col("used_fallback"), F.col("output_text")).otherwise(summary_text(F.col("output_text"))))


def compress(notes: DataFrame, client: Client, folder: str, attempts: int = 3, width: int = NOTES_IN_FLIGHT, **options) -> DataFrame:
    """All rows in their order with output_text, used_fallback, error and fingerprint.

    ``notes``: row_index, patient_id, date, text and any other columns. Equal texts are asked once. Answers
    are stored in ``folder`` as they come, so a stopped run goes on with the open ones; texts whose call
    failed are asked again by the next run, and keep their text until then.
    """
    keyed = notes.withColumn("fingerprint", fingerprint()).withColumn("system", F.lit(SYSTEM)).withColumn("prompt", F.coalesce("text", F.lit("")))
    answers = answered_durably(keyed.select("system", "prompt"), client, folder, attempts=attempts, width=width, **options)
    rows = keyed.withColumn("request_id", request_id()).join(answers.select("request_id", "response", "error"), "request_id", "left")
    failed = F.col("response").isNull()
    return rows.select(*notes.columns, "fingerprint", F.when(failed, F.col("text")).otherwise(summary_text(F.col("response"))).alias("output_text"), failed.alias("used_fallback"), "error").orderBy("row_index")


def prompt(body: Column, **metadata: Column) -> Column:
    """The note behind a line for each given piece of metadata."""
    lines = [F.when(text(v) != "", F.concat(F.lit(f"{k.replace('_', ' ').title()}: "), text(v), F.lit("\n"))).otherwise("") for k, v in metadata.items()]
    return F.concat(*lines, F.lit("\nNote:\n"), F.coalesce(body, F.lit("")))


def outcome(done: DataFrame) -> DataFrame:
    return done.agg(F.count("*").alias("rows"), F.count_if(F.col("error").isNotNull()).alias("errors"), F.count_if("used_fallback").alias("fallbacks"))
