"""The whole run: notes to chunks, tumors, scoped extraction rounds, checked records and files.

Every step is a DataFrame plan; the driver only loops over rounds. A round's state is written as
Parquet phase by phase, which cuts the lineage and lets a stopped run resume behind its last whole
phase.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.functions import dates
from carrel.functions.reasoning import parser_of
from carrel.functions.scalars import either
from carrel.operators import chunking, confidence, matching, merging, models, resolution, rules, tumors
from carrel.operators.prompts import narrative_results
from carrel.sources import notes, sinks
from carrel.sources.answers import answered_durably, stored

KEYS = ["patient_id", "tumor_index"]
SYSTEM = "Extract the listed registry items from the notes. Answer with a JSON object: field -> {value, confidence, evidence}."
STATE = "patient_id string, tumor_index int, item int, extracted string, resolved string, confidence double, evidence string, seq bigint"


@dataclass(frozen=True)
class Run:
    """``items`` and ``codes``: dictionary tables. The clients answer detection and extraction prompts."""

    items: DataFrame
    codes: DataFrame
    detector: models.Client
    extractor: models.Client
    folder: str
    target_tokens: int = chunking.TARGET_TOKENS
    overlap_tokens: int = chunking.OVERLAP_TOKENS
    items_per_call: int = 50
    attempts: int = models.ATTEMPTS
    in_flight: int = models.IN_FLIGHT
    per_second: float | None = None
    model: str = ""
    parser: str | None = "auto"


def _exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path``, or what a former run left there whole."""
    if not _exists(df.sparkSession, path):
        df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def asked(requests: DataFrame, client: models.Client, run: Run) -> DataFrame:
    """Answers that are stored as they come: a stopped phase asks for its open requests only."""
    return answered_durably(requests, client, f"{run.folder}/answers", attempts=run.attempts, objects=True, width=run.in_flight, per_second=run.per_second, parser=parser_of(run.model, run.parser))


def calls(spark: SparkSession, run: Run) -> DataFrame:
    """The log of all coding and extraction calls so far, one row a request."""
    return stored(spark, f"{run.folder}/answers").select("request_id", F.timestamp_seconds("asked_at").alias("asked_at"), F.col("response").alias("final_output"), "error", "log.*")


def scoped_chunks(docs: DataFrame, found: DataFrame, run: Run) -> DataFrame:
    """Chunks of the documents in each tumor's window."""
    spans = dates.with_interval(docs.select("patient_id", "doc_index", "date", "text"), "date", "span")
    windows = dates.with_window(found.select(*KEYS, "approximate_date"), "approximate_date", "window").drop("approximate_date")
    inside = matching.in_window(spans, windows).select(*KEYS, "doc_index", "date", "text")
    return chunking.chunked(inside, KEYS, run.target_tokens, run.overlap_tokens)


def first_state(docs: DataFrame, found: DataFrame) -> DataFrame:
    """What is known before any call: structured columns and the codes of the detected tumors."""
    structured = notes.structured_items(docs).join(found.select(*KEYS), "patient_id").select(*KEYS, "item", F.col("value").alias("extracted"), F.col("value").alias("resolved"))
    both = structured.unionByName(merging.seeded(found, KEYS).drop("confidence"))
    rows = both.withColumn("confidence", F.lit(1.0)).withColumn("evidence", F.lit("")).withColumn("seq", F.lit(-1).cast("bigint"))
    return merging.merged(rows, KEYS).select(*KEYS, "item", "extracted", "resolved", "confidence", "evidence", "seq")


def field_names(items: DataFrame) -> DataFrame:
    return items.select("item", either(F.trim(F.coalesce("xml_id", F.lit(""))), F.concat(F.lit("item_"), F.col("item").cast("string"))).alias("field"))


def phase_items(units: DataFrame, state: DataFrame, phase: str) -> DataFrame:
    """KEYS, item: what a phase asks of each unit; the staging phase asks by the unit's schema."""
    if phase != "staging":
        return units.select(*KEYS, F.explode(F.array(*(F.lit(i) for i in resolution.DOMAIN_ITEMS[phase]))).alias("item"))
    value = either(F.coalesce("resolved", F.lit("")), F.coalesce("extracted", F.lit("")))
    known = state.where(F.col("item").isin(400, 522)).groupBy(*KEYS).agg(F.max(F.when(F.col("item") == 400, value)).alias("site"), F.max(F.when(F.col("item") == 522, value)).alias("histology"))
    schema = resolution.schema_of(F.coalesce("site", F.lit("")), F.coalesce("histology", F.lit("")))
    return units.select(*KEYS).join(known, KEYS, "left").select(*KEYS, F.explode(resolution.staging_items(schema)).alias("item"))


def extraction_phase(units: DataFrame, state: DataFrame, phase: str, number: int, run: Run) -> DataFrame:
    """The state after one phase of one round: open items are asked, replies resolved and merged."""
    wanted = resolution.extractable(run.items)
    fields = resolution.small(field_names(wanted))
    ask = merging.still_open(phase_items(units, state, phase).join(fields, "item"), state, KEYS)
    prior = state.where("confidence > 0").groupBy(*KEYS).agg(F.array_join(F.array_sort(F.collect_list(F.format_string("%05d=%s (%.2f)", "item", either(F.col("resolved"), F.col("extracted")), "confidence"))), "\n").alias("prior"))
    batches = chunking.batched(ask, KEYS, ["item"], run.items_per_call).groupBy(*KEYS, "batch").agg(F.array_join(F.array_sort(F.collect_list("field")), ", ").alias("asked"))
    prompts = batches.join(units, KEYS).join(prior, KEYS, "left").select(*KEYS, F.lit(SYSTEM).alias("system"), F.concat(F.lit(f"Phase: {phase}\nItems: "), F.col("asked"), F.lit("\nKnown:\n"), F.coalesce("prior", F.lit("")), F.lit("\nNotes:\n"), F.col("chunk_text")).alias("prompt"))
    prompts = prompts.withColumn("request_id", models.request_id())
    answers = asked(prompts.select("system", "prompt"), run.extractor, run)
    replies = prompts.select(*KEYS, "request_id").join(answers.where("error is null"), "request_id").select(*KEYS, "response")
    seq = F.lit(number).cast("bigint").alias("seq")
    if phase == "text":
        said = merging.payload_items(replies).join(fields.select("field"), "field", "left_semi")
        rows = narrative_results(said, wanted).select(*KEYS, "item", "extracted", "resolved", "confidence", "evidence", seq)
    else:
        found = resolution.resolved(merging.payload_items(replies).join(fields, "field"), run.codes, resolution.numeric_ranges(wanted))
        rows = found.where(~merging.leaked_number(F.col("item"), F.col("code"))).select(*KEYS, "item", F.col("value").alias("extracted"), F.col("code").alias("resolved"), merging.combined_confidence(F.col("model_confidence"), F.col("resolution")).alias("confidence"), "evidence", seq)
    return merging.merged(state.unionByName(rows), KEYS).select(*state.columns)


#: the phases of a round, in order: what a phase finds is known to the next (the schema, above all)
PHASES = ["demographics", "staging", "surgery", "radiation", "systemic", "followup", "text"]


def extraction_round(chunks: DataFrame, state: DataFrame, number: int, run: Run) -> DataFrame:
    """The state after every unit's chunk of this round has gone through all phases, each written as it ends."""
    units = chunks.where(F.col("chunk_index") == number).select(*KEYS, "chunk_text")
    for phase in PHASES:
        state = _kept(extraction_phase(units, state, phase, number, run), f"{run.folder}/round={number}/{phase}")
    return state


def rounds_done(chunks: DataFrame, done: DataFrame) -> DataFrame:
    """n_rounds, first_open: the first round that some unit hasn't done, or n_rounds (``done``: KEYS, chunk_index)."""
    wanted = chunks.select(*KEYS, "chunk_index").distinct()
    open_ = wanted.join(done.select(*KEYS, "chunk_index").distinct(), [*KEYS, "chunk_index"], "left_anti").agg(F.min("chunk_index").alias("first"))
    total = wanted.agg((F.coalesce(F.max("chunk_index"), F.lit(-1)) + 1).alias("n_rounds"))
    return total.join(F.broadcast(open_)).select("n_rounds", F.coalesce("first", "n_rounds").alias("first_open"))  # two single rows


def checked(state: DataFrame) -> dict[str, DataFrame]:
    """Violations, fixed results with final confidences, and the review queue."""
    found = rules.violations(rules.wide(state, KEYS), KEYS)
    fixed = rules.fixed(state, found, KEYS)
    scores = confidence.scored(fixed, found, KEYS)
    return {"violations": found, "results": scores, "review": confidence.review_queue(scores, KEYS)}


def run(spark: SparkSession, path: str, setup: Run) -> dict[str, DataFrame]:
    docs = _kept(notes.load(spark, path), f"{setup.folder}/notes")
    whole = chunking.chunked(docs, ["patient_id"], setup.target_tokens, setup.overlap_tokens)
    listed = _kept(tumors.detected(whole, setup.detector, width=setup.in_flight), f"{setup.folder}/listed")
    found = _kept(tumors.coded(listed, setup.detector, ask=lambda requests: asked(requests, setup.detector, setup)), f"{setup.folder}/tumors")
    chunks = _kept(scoped_chunks(docs, found, setup), f"{setup.folder}/chunks")
    state = _kept(first_state(docs, found), f"{setup.folder}/round=start")
    last = chunks.agg(F.max("chunk_index")).first()[0]
    for number in range((last if last is not None else -1) + 1):
        state = extraction_round(chunks, state, number, setup)
    summary = found.agg(F.count("*").alias("records"), F.countDistinct("patient_id").alias("patients"))
    return {"tumors": found, "chunks": chunks, "state": state, "summary": summary, **checked(state)}


def write(found: dict[str, DataFrame], setup: Run, out: str) -> None:
    """Registry XML, fixed-width and wide tables, audit, review and call-log files."""
    values = found["results"].select(*KEYS, "item", either(F.coalesce("resolved", F.lit("")), F.coalesce("extracted", F.lit(""))).alias("value"))
    values = _kept(merging.with_defaults(values, KEYS), f"{setup.folder}/values")
    sinks.write_xml(values, setup.items, f"{out}/registry_xml")
    sinks.fixed_width(values, setup.items, KEYS).select("line").write.mode("overwrite").text(f"{out}/flat")
    sinks.write_csv(sinks.wide_table(values, setup.items, KEYS), f"{out}/wide")
    sinks.write_audit(found["results"], KEYS, f"{out}/audit")
    sinks.write_review(found["review"], KEYS, f"{out}/review")
    sinks.write_log(calls(values.sparkSession, setup), f"{out}/calls")
