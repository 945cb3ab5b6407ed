"""Registered queries of the registry engine and the SQL each is held against."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel import oracles
from carrel.functions import dates, reasoning, scalars, web
from carrel.operators import chunking, compression, confidence, matching, merging, models, prompts, resolution, retrieval, rules, sampling, scoring, summary, tumors
from carrel.plans import pipeline
from carrel.sources import answers as answers_source
from carrel.sources import notes, registry, sinks
from carrel.streaming import tumors as streaming_tumors
from carrel.synthetic import VALUES, long_expressions, pick, picked

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = oracles.ORACLES


def query(f):
    QUERIES[f.__name__] = f
    return f


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- scans, filters, chunking -------------------------------------------------------------


@query
def scan_notes_nonblank(spark, d):
    return notes.nonblank(read(spark, d, "documents")).select("doc_id", "source", F.length("text").alias("n_chars"))


@query
def structured_projection(spark, d):
    table = read(spark, d, "customer").join(read(spark, d, "orders"), F.col("c_custkey") == F.col("o_custkey"))
    shaped = table.select(F.col("c_custkey").cast("string").alias("patient_id"), "o_orderdate", "o_orderkey", F.col("c_name").alias("Last Name"), F.col("c_mktsegment").alias("sex"), F.col("o_orderstatus").alias("gender"), F.col("c_nationkey").cast("string").alias("zip-code"))
    return notes.structured_items(shaped, ["o_orderdate", "o_orderkey"])


@query
def doc_index(spark, d):
    shaped = read(spark, d, "orders").select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return chunking.document_index(shaped, "o_custkey", "date", "o_orderkey").select("o_custkey", "o_orderkey", "doc_index")


def _conversation_docs(spark, d):
    return read(spark, d, "conversations").select("conv_id", F.col("turn").alias("doc_index"), F.when(F.col("turn") % 3 == 0, F.lit(None)).otherwise(F.concat(F.lit("2024-01-"), F.lpad((F.col("turn") % 28 + 1).cast("string"), 2, "0"))).alias("date"), "text")


def _conversation_texts(spark, d):
    return chunking.concatenated(_conversation_docs(spark, d), ["conv_id"])


@query
def notes_concat(spark, d):
    return _conversation_texts(spark, d).select("conv_id", "full_text", F.coalesce("first_doc_date", F.lit("")).alias("first_doc_date"))


@query
def token_estimate(spark, d):
    return read(spark, d, "documents").select("doc_id", scalars.estimated_tokens(F.col("text")).alias("tokens"))


def _chunks(spark, d):
    return chunking.chunked(_conversation_docs(spark, d), ["conv_id"], 40, 5)


@query
def chunk_notes(spark, d):
    return _chunks(spark, d).select("conv_id", "chunk_index", "chunk_text", "token_estimate")


@query
def chunk_dates(spark, d):
    return _chunks(spark, d).select("conv_id", "chunk_index", "first_date", "last_date")


@query
def rounds_by_chunk(spark, d):
    return chunking.rounds(_chunks(spark, d))


@query
def batching(spark, d):
    return chunking.batched(read(spark, d, "part"), ["p_brand"], ["p_partkey"], 50).select("p_partkey", "p_brand", "batch")


# --- dates and windows --------------------------------------------------------------------


def _partial(spark, d):
    shape = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyyMM")).when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("1399")))
    return read(spark, d, "orders").select("o_orderkey", shape.alias("value"))


@query
def partial_date_interval(spark, d):
    return dates.with_interval(_partial(spark, d), "value", "span").select("o_orderkey", "value", "span.lo", "span.hi")


@query
def diagnosis_window(spark, d):
    return dates.with_window(_partial(spark, d), "value", "window").select("o_orderkey", "window.lo", "window.hi")


def _windows(spark, d, hot):
    tumors_ = dates.with_window(_partial(spark, d), "value", "window", 1).select(F.col("o_orderkey").alias("patient_id"), "window")
    docs = read(spark, d, "lineitem").select(F.col("l_orderkey").alias("patient_id"), "l_linenumber", "l_partkey", dates.day_interval(F.col("l_shipdate")).alias("span"))
    return matching.in_window(docs, tumors_, hot=hot).groupBy("patient_id").agg(F.count("*").alias("n_docs"), F.min("span.lo").alias("first_doc"))


@query
def window_overlap_join(spark, d):
    return _windows(spark, d, matching.HOT_DOCUMENTS)


@query
def window_overlap_bins(spark, d):
    """The same join where a patient with more than three documents counts as hot: those meet by bins of time."""
    return _windows(spark, d, 3)


@query
def predicted_dates(spark, d):
    return _partial(spark, d).select("o_orderkey", dates.predicted_date(F.col("value")).alias("day"))


# --- merging and payloads -----------------------------------------------------------------


@query
def merge_highest_confidence(spark, d):
    rows = read(spark, d, "events").select("user_id", F.col("event_type").alias("item"), F.col("props").alias("extracted"), F.col("value").alias("confidence"), F.col("event_id").alias("seq"))
    return merging.merged(rows, ["user_id"]).select("user_id", "item", "extracted", "confidence", "seq")


@query
def high_confidence_skip(spark, d):
    events = read(spark, d, "events")
    prior = events.select("user_id", F.col("event_type").alias("item"), (F.col("value") / 100).alias("confidence"))
    asked = events.select("user_id", F.col("event_type").alias("item")).distinct()
    return merging.still_open(asked, prior, ["user_id"])


@query
def item_number_leak(spark, d):
    rows = read(spark, d, "part").select("p_partkey", F.when(F.col("p_partkey") % 2 == 0, 880).otherwise(400).alias("item"), F.when(F.col("p_partkey") % 7 == 0, F.lit("88")).otherwise(F.col("p_size").cast("string")).alias("code"))
    return rows.where(~merging.leaked_number(F.col("item"), F.col("code")))


@query
def llm_payload_parse(spark, d):
    events = read(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    body = F.concat(F.lit('{"'), F.col("event_type"), F.lit('": {"value": "'), k, F.lit('", "confidence": '), F.when(F.col("event_id") % 5 == 0, F.lit('"high"')).otherwise(F.concat(F.lit("0."), F.lpad((F.col("event_id") % 100).cast("string"), 2, "0"))), F.lit(', "evidence": "note"}, "_meta": {"value": "x"}, "blank": {"value": " "}}'))
    shaped = events.select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("["), body, F.lit("]"))).otherwise(body).alias("response"))
    return merging.payload_items(shaped).select("event_id", "field", "value", F.round("model_confidence", 4).alias("model_confidence"), "evidence")


@query
def resolved_confidence(spark, d):
    e = read(spark, d, "events")
    return e.select("event_id", merging.combined_confidence(F.col("value") / 131, F.when(F.col("event_id") % 2 == 0, 0.75).otherwise(0.0)).alias("confidence"))


@query
def seed_codes(spark, d):
    t = read(spark, d, "orders").select("o_orderkey", F.expr(pick("o_orderkey", 400, VALUES[400])).alias("primary_site_code"), F.expr(pick("o_orderkey", 522, VALUES[522])).alias("histology_code"))
    return merging.seeded(t, ["o_orderkey"]).drop("confidence")


@query
def default_fill(spark, d):
    rows = read(spark, d, "events").select("user_id", F.when(F.col("event_type") == "click", 10).when(F.col("event_type") == "view", 50).otherwise(400).alias("item"), F.col("event_type").alias("value")).distinct()
    return merging.with_defaults(rows, ["user_id"])


# --- dictionary, codes, schemas -----------------------------------------------------------


def _codes(spark):
    rows = [(400, "C504", "Upper-outer quadrant", 0), (410, "1", "Right", 1), (410, "2", "Left", 2), (522, "8140", "Adenocarcinoma", 3), (522, "8140a", "adenocarcinoma", 4)]
    return spark.createDataFrame(rows, "item int, code string, description string, pos int")


@query
def dict_lookup_join(spark, d):
    return read(spark, d, "nation").join(resolution.small(read(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left").select("n_nationkey", "n_name", "r_name")


@query
def alt_name_lookup(spark, d):
    names = read(spark, d, "part").groupBy(F.lower("p_name").alias("k")).agg(F.max("p_partkey").alias("item"))
    return read(spark, d, "part").select("p_partkey", F.lower(F.upper("p_name")).alias("k")).join(names, "k", "left").select("p_partkey", "item")


@query
def code_resolution_tiers(spark, d):
    values = read(spark, d, "orders").select("o_orderkey", F.expr(pick("o_orderkey", 1, ["400", "410", "522", "764", "410"])).cast("int").alias("item"), F.expr(pick("o_orderkey", 2, ["C504", "c504", "left", "Right ", "8140", "ADENOCARCINOMA", "7", "12", "x", "", "8140A", "adenocarcinom", "Upper-outr quadrant", "Lefd"])).alias("value"))
    ranges = resolution.numeric_ranges(spark.createDataFrame([(764, "0-7, 9"), (522, "8000-9999"), (410, "001-010 blank")], "item int, allowable_values string"))
    return resolution.resolved(values, _codes(spark), ranges)


@query
def fuzzy_descriptions(spark, d):
    """Names with slips against all names of their brand: the likest one, by an index of grams."""
    parts = read(spark, d, "part").select("p_partkey", F.substring("p_brand", 7, 1).cast("int").alias("item"), F.lower(F.concat_ws(" ", "p_name", "p_type")).alias("name"))
    slip = F.col("p_partkey") % 5
    k = F.when(slip == 0, F.col("name")).when(slip == 1, F.concat(F.lit("x"), F.col("name"))).when(slip == 2, F.expr("concat(left(name, 3), substring(name, 5))")).when(slip == 3, F.expr("concat(left(name, length(name) - 2), 'zz')")).otherwise(F.reverse("name"))
    values = parts.select("item", k.alias("k"))
    names = parts.select("item", "name", F.col("p_partkey").cast("string").alias("code"), F.col("p_partkey").alias("pos"))
    return resolution.fuzzy_matches(values, names).select("item", "k", "code", F.round("likeness", 4).alias("likeness"))


def _coded(spark, d):
    return read(spark, d, "orders").select("o_orderkey", F.expr(pick("o_orderkey", 400, VALUES[400])).alias("site"), F.expr(pick("o_orderkey", 522, VALUES[522])).alias("hist"))


@query
def schema_selection(spark, d):
    return _coded(spark, d).select("o_orderkey", resolution.schema_of(F.col("site"), F.col("hist")).alias("schema"))


@query
def staging_items(spark, d):
    s = resolution.schema_of(F.col("site"), F.col("hist"))
    return _coded(spark, d).select(s.alias("schema")).distinct().select("schema", F.posexplode(resolution.staging_items(F.col("schema"))).alias("pos", "item"))


@query
def domain_items(spark, d):
    """Every item that the phases with fixed items ask of each unit."""
    units = read(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("patient_id"), F.lit(0).alias("tumor_index"))
    asked = [pipeline.phase_items(units, units, phase).select("patient_id", F.lit(phase).alias("phase"), "item") for phase in resolution.DOMAIN_ITEMS]
    return reduce(DataFrame.union, asked)


@query
def icd_text_lookup(spark, d):
    labels = spark.createDataFrame([("C50.4", "Upper-outer quadrant of breast"), ("C50", "Breast"), ("C18", "Colon"), ("C61", "Prostate")], "code string, label string")
    coded = _coded(spark, d).withColumn("code", scalars.site_code(F.col("site"))).withColumn("prefix", F.substring("code", 1, 3))
    exact, broad = resolution.small(labels), resolution.small(labels.where(F.length("code") == 3).select(F.col("code").alias("prefix"), F.col("label").alias("broad")))
    return coded.join(exact, "code", "left").join(broad, "prefix", "left").select("o_orderkey", F.coalesce("label", "broad", F.lit("")).alias("label"))


@query
def valid_codes_prompt(spark, d):
    codes = read(spark, d, "nation").select(F.col("n_regionkey").alias("item"), F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("description"), F.col("n_nationkey").alias("pos"))
    return resolution.valid_codes_text(codes, 4)


@query
def prior_state_block(spark, d):
    results = _results(spark, d).withColumn("name", F.concat(F.lit("n"), F.col("item").cast("string")))
    return prompts.prior_state(results, results.select("rec"), ["rec"])


@query
def field_instructions(spark, d):
    items = read(spark, d, "nation").select(F.col("n_nationkey").alias("item"), F.col("n_name").alias("name"), F.lit("").alias("xml_id"), (F.col("n_regionkey") + 1).alias("length"), F.when(F.col("n_nationkey") % 2 == 0, "date").otherwise("text").alias("data_type"), F.lit("").alias("allowable_values"), "n_regionkey")
    codes = read(spark, d, "region").select(F.col("r_regionkey").alias("item"), F.col("r_name").alias("codes_text"))
    return prompts.field_instructions(items, codes, ["n_regionkey"])


# --- normalisers --------------------------------------------------------------------------


def _probe(spark, d, salt, values):
    return read(spark, d, "orders").select("o_orderkey", F.expr(pick("o_orderkey", salt, values)).alias("x"))


@query
def site_normalise(spark, d):
    x = F.col("x")
    return _probe(spark, d, 3, oracles.SITE_PROBES).select("o_orderkey", scalars.site(x).alias("site"), scalars.site3(x).alias("site3"), scalars.topography(x).alias("topography"), scalars.rule_site(x).alias("rule_site"), scalars.histology4(x).alias("histology4"), scalars.behavior_digit(x).alias("behavior"), scalars.morphology(x).alias("morphology"))


@query
def tnm_normalise(spark, d):
    x = F.col("x")
    return _probe(spark, d, 4, oracles.TNM_PROBES).select("o_orderkey", scalars.tnm(x, "T").alias("t"), scalars.tnm_main(scalars.tnm(x, "T")).alias("t_main"), scalars.tnm(x, "N").alias("n"), scalars.unknown(x).alias("unknown"))


@query
def stage_crosswalk(spark, d):
    x = F.col("x")
    return _probe(spark, d, 5, oracles.STAGE_PROBES).select("o_orderkey", scalars.stage_group(x).alias("stage"), scalars.stage_group_main(x).alias("main"), scalars.stage_group_extent(x).alias("extent"), scalars.summary_stage_extent(x).alias("summary"))


@query
def biomarker_collapse(spark, d):
    x = F.col("x")
    return _probe(spark, d, 6, oracles.MARKER_PROBES).select("o_orderkey", scalars.biomarker(x).alias("marker"), scalars.laterality(x).alias("laterality"))


@query
def normalize_summary(spark, d):
    wrapped = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Summary: "), F.col("text"))).when(F.col("turn") % 3 == 1, F.concat(F.lit("```\n"), F.col("text"), F.lit("\n```"))).otherwise(F.concat(F.lit("  CLINICAL SUMMARY:  "), F.col("text"), F.lit("\n ")))
    return read(spark, d, "conversations").select("conv_id", "turn", scalars.summary_text(wrapped).alias("summary"))


@query
def coded_date_order(spark, d):
    return _wide(spark, d).select("rec", dates.coded_difference(F.col("v1750"), F.col("v390")).alias("difference"))


# --- rules, confidence, review ------------------------------------------------------------


def _wide(spark, d):
    keys = rules.spread(read(spark, d, "orders").select(F.col("o_orderkey").alias("rec")), ["rec"])
    return keys.select("rec", *(picked("rec", i, x).alias(f"v{i}") for i, x in VALUES.items()))


def _results(spark, d):
    entries = F.explode(F.array(*(F.struct(F.lit(i).alias("item"), F.col(f"v{i}").alias("value")) for i in VALUES)))
    rows = _wide(spark, d).select("rec", entries.alias("e")).select("rec", "e.item", "e.value")
    extracted, resolved, conf = long_expressions()
    return rows.select("rec", "item", F.expr(extracted).alias("extracted"), F.expr(resolved).alias("resolved"), F.expr(conf).cast("double").alias("confidence"))


def _violations(spark, d):
    return rules.violations(_wide(spark, d), ["rec"])


@query
def edit_rules_violations(spark, d):
    return _violations(spark, d).select("rec", "seq", "edit_name", "severity", F.array_join(F.col("item_numbers").cast("array<string>"), ",").alias("items"))


@query
def rule_counts(spark, d):
    return _violations(spark, d).groupBy("edit_name", "severity").agg(F.count("*").alias("n"), F.countDistinct("rec").alias("records"))


@query
def eav_pivot_rules(spark, d):
    """The rules over pivoted long results, as the pipeline runs them."""
    found = rules.violations(rules.wide(_results(spark, d), ["rec"]), ["rec"])
    return found.select("rec", "seq", "edit_name")


@query
def auto_fix(spark, d):
    fixed = rules.fixed(_results(spark, d), _violations(spark, d), ["rec"])
    return fixed.where("item = 523").select("rec", "extracted", "resolved")


def _scored(spark, d):
    """Rules and results come from one wide row, so the severities go along and nothing is shuffled."""
    entries = F.array(*(F.struct(F.lit(i).alias("item"), F.col(f"v{i}").alias("value")) for i in VALUES))
    found = rules.named(_wide(spark, d).withColumn("entries", entries), ["rec", "entries"])
    with_severity = F.transform("entries", lambda e: F.struct(e["item"].alias("item"), e["value"].alias("value"), confidence.severity_of(e["item"], F.col("errors"), F.col("warnings")).alias("severity")))
    rows = found.select("rec", F.explode(with_severity).alias("e")).select("rec", "e.*")
    extracted, resolved, conf = long_expressions()
    values = F.struct(F.expr(extracted).alias("extracted"), F.expr(resolved).alias("resolved"), F.expr(conf).cast("double").alias("confidence"))
    long = rows.select("rec", "item", "severity", F.inline(F.array(values)))  # computed once a row, whatever is asked of them
    return confidence.with_final(long)


@query
def confidence_of_long_results(spark, d):
    """The same from long results and a table of violations, as the pipeline has them."""
    found = confidence.scored(_results(spark, d), _violations(spark, d), ["rec"])
    return found.select("rec", "item", F.coalesce("severity", F.lit(0)).alias("severity"), "final_confidence")


@query
def confidence_score(spark, d):
    return _scored(spark, d).select("rec", "item", F.coalesce("severity", F.lit(0)).alias("severity"), "final_confidence")


@query
def review_queue(spark, d):
    return confidence.review_queue(_scored(spark, d), ["rec"]).select("rec", "item", "priority", "priority_rank", "final_confidence")


@query
def review_queue_violation_mode(spark, d):
    return confidence.review_queue(_scored(spark, d), ["rec"], "violations").select("rec", "item", "priority")


@query
def worst_severity(spark, d):
    return confidence.worst_severities(_violations(spark, d), ["rec"])


# --- outputs ------------------------------------------------------------------------------


def _values(spark, d):
    return read(spark, d, "events").groupBy("user_id", (F.length("event_type") * 100).alias("item")).agg(F.max_by("event_type", "event_id").alias("value"))


@query
def eav_pivot_wide(spark, d):
    names = spark.createDataFrame([(500, "Five"), (400, "Four")], "item int, name string")
    return sinks.wide_table(_values(spark, d), names, ["user_id"])


@query
def flat_fixed_width(spark, d):
    lengths = spark.createDataFrame([(400, 3), (500, 7), (600, 2)], "item int, length int")
    return sinks.fixed_width(_values(spark, d), lengths, ["user_id"])


@query
def diagnosis_summary(spark, d):
    results = _results(spark, d).where(F.col("item").isin(400, 522)).unionByName(_results(spark, d).where("item = 940").withColumn("item", F.lit(1001)))
    people = read(spark, d, "orders").select(F.col("o_orderkey").alias("rec"), F.lit("site hint").alias("primary_site_hint"), F.lit("").alias("histology"), F.lit("cancer").alias("cancer_type"))
    sites = spark.createDataFrame([("C50.4", "Upper-outer quadrant of breast"), ("C50", "Breast"), ("C18", "Colon"), ("C61", "Prostate")], "code string, label string")
    hist = spark.createDataFrame([("8140", "Adenocarcinoma"), ("8720", "Melanoma")], "code string, label string")
    return summary.diagnosis_summary(results, people, _codes(spark), sites, hist, ["rec"]).select("rec", "site_code", "site_text", "histology_code", "histology_text", "clinical_t_code", "clinical_t_text")


@query
def diagnosis_summary_stages(spark, d):
    """All stage columns of the summary, clinical and pathological."""
    moved = F.create_map(*(F.lit(x) for pair in oracles.STAGE_PROBE_ITEMS.items() for x in pair))
    results = _results(spark, d).where(F.col("item").isin(list(oracles.STAGE_PROBE_ITEMS))).withColumn("item", F.try_element_at(moved, F.col("item")))
    people = read(spark, d, "orders").select(F.col("o_orderkey").alias("rec"), F.lit("").alias("primary_site_hint"), F.lit("").alias("histology"), F.lit("").alias("cancer_type"))
    none = spark.createDataFrame([], "code string, label string")
    codes = spark.createDataFrame([(1011, "t1", "Described T1"), (1014, "99", "Stage unknown")], "item int, code string, description string")
    found = summary.diagnosis_summary(results, people, codes, none, none, ["rec"])
    return found.drop("site_code", "site_text", "histology_code", "histology_text")


@query
def audit_rows(spark, d):
    return sinks.audit_rows(_results(spark, d).withColumn("evidence", F.concat(F.col("rec").cast("string"), F.repeat(F.lit("e"), 600))), ["rec"]).select("rec", "item", "extracted", "resolved", F.sha2("evidence", 256).alias("evidence"))


@query
def xml_roundtrip(spark, d):
    """Written as lines, read back by the parser: values that survive, by patient and item."""
    values = _results(spark, d).where(F.col("item").isin(220, 400, 522)).select(F.expr("rec div 10").alias("patient_id"), F.expr("rec % 10").cast("int").alias("tumor_index"), "item", F.col("resolved").alias("value"))
    items = spark.createDataFrame([(220, "sex", "Patient"), (400, "primarySite", "Tumor"), (522, "histologicTypeIcdO3", "Tumor")], "item int, xml_id string, parent_element string")
    lines = sinks.xml_lines(values, items, "patient_id", "tumor_index").where("part = 1")
    kinds = "Item array<struct<_VALUE:string,_naaccrNum:int>>, Tumor array<struct<Item:array<struct<_VALUE:string,_naaccrNum:int>>>>"
    parsed = lines.select("patient", F.from_xml("xml", kinds).alias("p"))
    every = F.concat(F.coalesce("p.Item", F.array()), F.flatten(F.transform(F.coalesce("p.Tumor", F.array()), lambda t: F.coalesce(t["Item"], F.array()))))
    return parsed.select("patient", F.explode(every).alias("i")).groupBy("patient", F.col("i._naaccrNum").alias("item"), F.col("i._VALUE").alias("value")).agg(F.count("*").alias("n"))


# --- retrieval ----------------------------------------------------------------------------


@query
def keyword_score_topk(spark, d):
    turns = read(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("query_id"), retrieval.keywords(F.col("text")).alias("words"))
    manuals = read(spark, d, "benchmark").select(F.expr(pick("item_id", 9, ["appendix_c", "staging", "solid_tumor_rules", "hematopoietic", "other"])).alias("category"), F.concat(F.lit("t"), F.lpad(F.col("item_id").cast("string"), 9, "0")).alias("title"), F.lit("manual").alias("path"), "text")
    return retrieval.best(retrieval.scores(turns, manuals)).select("query_id", "title", "score", "place")


# --- scoring ------------------------------------------------------------------------------


def _scoring_tables(spark, d):
    """Even orders are truth, odd ones predictions of the same customer."""
    base = _wide(spark, d).join(read(spark, d, "orders").select(F.col("o_orderkey").alias("rec"), F.col("o_custkey").alias("mrn"), F.col("o_orderdate").cast("date").alias("day")), "rec")
    c = lambda i: F.col(f"v{i}")
    rows = base.select("mrn", "rec", "day", c(400).alias("site"), c(522).alias("hist"), c(523).alias("beh"), c(410).alias("lat"), c(441).alias("grade"), c(764).alias("ss"), c(910).alias("ajcc"), c(940).alias("t"), c(950).alias("n"), c(960).alias("m"), c(1112).alias("er"), c(1113).alias("pr"), c(1114).alias("her2"))
    w = Window.partitionBy("mrn").orderBy("rec")
    truth = rows.where("rec % 2 = 0").withColumn("ti", F.row_number().over(w) - 1)
    predicted = rows.where("rec % 2 = 1").withColumn("pi", F.row_number().over(w) - 1)
    return truth, predicted


@query
def greedy_match(spark, d):
    truth, predicted = _scoring_tables(spark, d)
    short = lambda df, n: df.select("mrn", n, scalars.site3(F.col("site")).alias("site"), "day")
    return matching.greedy_matches(short(truth, "ti"), short(predicted, "pi"), "mrn")


@query
def match_acceptance(spark, d):
    return scoring.matched(*_scoring_tables(spark, d)).select("mrn", "ti", "matched", "days")


@query
def diagnosis_flags(spark, d):
    scored = scoring.flags(scoring.matched(*_scoring_tables(spark, d)))
    return scored.select("mrn", "ti", *(F.col(c).cast("int").alias(c) for c in ("present_site", "ok_site3", "ok_hist4", "ok_ajcc_main", "ok_t_main", "ok_date365", "ok_year", "present_er", "ok_er", "ok_stage_axis")))


@query
def field_metrics(spark, d):
    return scoring.metrics(scoring.flags(scoring.matched(*_scoring_tables(spark, d)))).drop("k")


@query
def match_recall(spark, d):
    truth, predicted = _scoring_tables(spark, d)
    found = scoring.matched(truth, predicted)
    short = lambda df, n: df.select("mrn", n, scalars.site3(F.col("site")).alias("site"), "day")
    return scoring.summary(scoring.flags(found), predicted, matching.greedy_matches(short(truth, "ti"), short(predicted, "pi"), "mrn"))


@query
def registry_filter(spark, d):
    rows = read(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("day"), F.col("o_orderstatus").alias("beh"), F.expr(pick("o_orderkey", 8, ["Y", "n ", "N", "", "y"])).alias("best_row"))
    return scoring.filtered_registry(rows, 1996, 1999, {"F", " O "}).select("o_orderkey")


# --- sets, samples, statistics ------------------------------------------------------------


@query
def semi_anti_patients(spark, d):
    customers, orders = read(spark, d, "customer"), read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return customers.join(orders.distinct(), "c_custkey", "left_semi").select("c_custkey", F.lit("with").alias("kind")).union(sampling.without_documents(customers, orders, "c_custkey").select("c_custkey", F.lit("without")))


@query
def docs_per_patient_stats(spark, d):
    return sampling.documents_each(read(spark, d, "documents"), "source")


@query
def value_counts_top10(spark, d):
    return sampling.top_values(read(spark, d, "part"), "p_brand")


@query
def union_sources(spark, d):
    shaped = [read(spark, d, t).select(F.lit(t).alias("source"), F.length(c).alias("n")) for t, c in (("documents", "text"), ("pages", "html"), ("conversations", "text"))]
    return shaped[0].unionByName(shaped[1]).unionByName(shaped[2]).groupBy("source").agg(F.count("*").alias("rows"), F.sum("n").alias("chars"))


@query
def manifest_upsert(spark, d):
    entries = read(spark, d, "pages").select(F.col("page_id").alias("pos"), F.regexp_extract("url", "://([^/?#]*)", 1).alias("url"), F.regexp_extract("html", "<html lang=\"([a-z]*)\"", 1).alias("category"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("p"), F.col("page_id").cast("string"))).otherwise("").alias("title"), F.concat(F.lit("s"), (F.col("page_id") % 5).cast("string")).alias("source_page"))
    folder, third = f"{sinks.scratch(spark, 'manifest')}/table", entries.count() / 3
    for k in range(3):  # entries come in three batches, in the order of their places
        stored = sampling.upsert_manifest(entries.where((F.col("pos") >= k * third) & ((F.col("pos") < (k + 1) * third) | F.lit(k == 2))), folder)
    return stored.select("url", "category", "title", F.array_join("source_pages", ",").alias("source_pages"))


@query
def sample_diagnoses(spark, d):
    return sampling.sampled(read(spark, d, "orders").select("o_custkey", "o_orderkey"), 100, 42, ["o_custkey", "o_orderkey"])


@query
def run_summary(spark, d):
    o = read(spark, d, "orders")
    return o.agg(F.count("*").alias("records"), F.countDistinct("o_custkey").alias("patients"), F.round(F.count("*") / F.countDistinct("o_custkey"), 4).alias("per_patient"))


# --- web pages ----------------------------------------------------------------------------


@query
def link_harvest(spark, d):
    """Every link of every page, resolved against the page's address, with its text and place."""
    found = read(spark, d, "pages").select("page_id", F.posexplode(web.links(F.col("html"), F.col("url"))).alias("place", "link"))
    return found.select("page_id", "place", "link.url", "link.text")


@query
def reference_resolution(spark, d):
    """References of every kind against each page's address."""
    pages = read(spark, d, "pages").select("page_id", "url", F.expr(pick("page_id", 17, oracles.REFERENCES)).alias("reference"))
    return pages.select("page_id", web.resolved(F.col("url"), F.col("reference")).alias("resolved"))


@query
def url_normalise(spark, d):
    u = F.concat(F.lit("  "), F.replace(F.col("url"), F.lit(".example."), F.lit(".Example.")), F.when(F.col("url").rlike("[?#]"), "").otherwise(F.concat(F.lit("/a é%20%7E+("), F.col("page_id").cast("string"), F.lit(").PDF"))), F.lit(" "))
    return read(spark, d, "pages").select("page_id", web.plain_url(u).alias("url"), web.url_extension(F.trim(u)).alias("extension"), web.file_name(F.trim(u), F.lit("")).alias("file_name"))


@query
def html_to_text(spark, d):
    return read(spark, d, "pages").select("page_id", web.html_text(F.col("html")).alias("text"))


# --- compression and tumor detection ------------------------------------------------------


def _compressible(spark, d):
    return read(spark, d, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_index"), F.col("conv_id").cast("string").alias("patient_id"), F.col("turn").cast("string").alias("date"), "text")


def _answer(_: str, prompt: str) -> str:
    if len(prompt) % 7 == 0:
        raise RuntimeError("endpoint unavailable")
    return f"Summary: {prompt[:40]}"


@query
def compress_fingerprint(spark, d):
    return _compressible(spark, d).select("row_index", compression.fingerprint().alias("fingerprint"))


@query
def pending_rows(spark, d):
    n = _compressible(spark, d).withColumn("fingerprint", F.sha2(F.coalesce("text", F.lit("")), 256))
    done = n.where("row_index % 3 = 0").withColumn("fingerprint", F.when(F.col("row_index") % 2 == 0, F.col("fingerprint")).otherwise("stale"))
    return compression.pending(n, done).select("row_index")


@query
def compress_with_fallback(spark, d):
    return compression.compressed(_compressible(spark, d), models.EchoClient(_answer), 1).select("row_index", "output_text", "used_fallback", "error")


def _diagnose(_: str, prompt: str) -> str:
    found = "breast" if "the" in prompt else "colon"
    return '{"diagnoses": [{"cancer_type": "' + found + '", "primary_site_hint": "site", "laterality": "left"}]}'


@query
def tumor_fold(spark, d):
    chunks = _chunks(spark, d).withColumn("patient_id", F.col("conv_id").cast("string"))
    return tumors.detected(chunks, models.EchoClient(_diagnose)).select("patient_id", "tumor_index", "cancer_type", "primary_site_hint", "laterality", F.size(F.split("contributing_chunks", ",")).alias("n_chunks"))


@query
def tumor_stream(spark, d):
    """The running list over chunks that arrive in three batches, each by a query that starts from the last one's checkpoint."""
    folder = sinks.scratch(spark, "tumor-stream")
    chunks = _chunks(spark, d).withColumn("patient_id", F.col("conv_id").cast("string")).select("patient_id", "chunk_id", "chunk_index", "chunk_text")
    chunks.write.parquet(f"{folder}/chunks")
    chunks = spark.read.schema(chunks.schema).parquet(f"{folder}/chunks")
    for k in range(3):
        part = chunks.where((F.col("chunk_index") >= 2 * k) & ((F.col("chunk_index") < 2 * k + 2) | F.lit(k == 2)))
        part.write.parquet(f"{folder}/arrived/{k}")
        arriving = spark.readStream.schema(chunks.schema).parquet(f"{folder}/arrived/*")
        streaming_tumors.running_lists(arriving, models.EchoClient(_diagnose), f"{folder}/lists", f"{folder}/checkpoint").awaitTermination()
    return streaming_tumors.latest_lists(spark, f"{folder}/lists").select("patient_id", "tumor_index", "cancer_type", "primary_site_hint", "laterality", F.size(F.split("contributing_chunks", ",")).alias("n_chunks"))


def _codes_of(_: str, prompt: str) -> str:
    if "breast" in prompt:
        return '{"coded": [{"primary_site_code": "c509", "histology_code": "8500/3"}]}'
    return '{"coded": [{"primary_site_code": "C18.2", "histology_code": "none"}, {"primary_site_code": "C61.9"}]}'


@query
def tumor_codes(spark, d):
    """Detection and the coding pass behind it; codes of no valid shape are blank."""
    chunks = _chunks(spark, d).withColumn("patient_id", F.col("conv_id").cast("string"))
    found = tumors.coded(tumors.detected(chunks, models.EchoClient(_diagnose)), models.EchoClient(_codes_of))
    return found.select("patient_id", "tumor_index", "cancer_type", "primary_site_hint", "primary_site_code", "histology_code")


def _staging_units(spark, d):
    coded = _coded(spark, d).select(F.col("o_orderkey").cast("string").alias("patient_id"), F.lit(0).alias("tumor_index"), "site", "hist")
    rows = coded.select("patient_id", "tumor_index", F.inline(F.array(F.struct(F.lit(400).alias("item"), F.col("site").alias("resolved")), F.struct(F.lit(522).alias("item"), F.col("hist").alias("resolved")))))
    return coded.select("patient_id", "tumor_index"), rows.withColumn("extracted", F.lit(""))


@query
def staging_phase_items(spark, d):
    """Every item that the staging phase asks of each unit."""
    units, state = _staging_units(spark, d)
    return pipeline.phase_items(units, state, "staging").select("patient_id", "item")


@query
def first_open_round(spark, d):
    turns = read(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("patient_id"), F.lit(0).alias("tumor_index"), F.col("turn").cast("int").alias("chunk_index"))
    return pipeline.rounds_done(turns, turns.where("chunk_index < 2 or patient_id % 3 = 0"))


@query
def parser_names(spark, d):
    return _probe(spark, d, 11, oracles.PARSER_PROBES).select("o_orderkey", reasoning.parser_name(F.col("x")).alias("parser"))


@query
def parser_choice(spark, d):
    """The reasoning parser of a model by a configured name or, with auto, by the model's own."""
    model, setting = F.expr(pick("o_orderkey", 12, oracles.MODEL_PROBES)), F.expr(pick("o_orderkey", 13, oracles.SETTING_PROBES))
    return read(spark, d, "orders").select("o_orderkey", reasoning.chosen_parser(model, setting).alias("parser"), scalars.model_size(model).alias("size"))


@query
def reasoning_split(spark, d):
    """Scripted replies of several model families, some with the server's own reasoning field, split into reasoning and final text."""
    turns = read(spark, d, "conversations").where("text is not null").withColumn("t", F.regexp_replace(F.regexp_replace("text", "[<>|]", " "), r"^\s+|\s+$", ""))
    t, kind = F.col("t"), F.col("turn") % 7
    wrap = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    reply = (
        F.when(kind == 0, wrap("<think>why ", t, "</think>\n", t))
        .when(kind == 1, wrap("why</think>", t))
        .when(kind == 2, wrap("<|channel>thought\nwhy<channel|>", t))
        .when(kind == 3, wrap("<|channel|>analysis<|message|>why<|end|><|start|>assistant<|channel|>final<|message|>", t, "<|return|>"))
        .when(kind == 4, wrap("<think>why<tool_call>", t))
        .otherwise(t)
    )
    parser = F.when(kind.isin(0, 1, 4), "qwen3").when(kind == 2, "gemma4").when(kind == 3, "openai_gptoss").when(kind == 5, "qwen3")
    split = reasoning.split_text(reply, parser, F.when(kind == 6, "said by the server"))
    return turns.select("conv_id", "turn", split.alias("s")).select("conv_id", "turn", "s.reasoning", "s.final")


@query
def text_cleanup(spark, d):
    """Fences, headings and sides: one text in several wrappings, and site hints with a side."""
    turns = read(spark, d, "conversations").where("text is not null").withColumn("t", F.regexp_replace(F.regexp_replace("text", "`", ""), r"^\s+|\s+$", "")).where("t <> ''")
    t, kind = F.col("t"), F.col("turn") % 5
    wrapped = F.when(kind == 0, F.concat(F.lit("```json\n"), t, F.lit("\n```"))).when(kind == 1, F.concat(F.lit("note ```x``` "), t)).when(kind == 2, F.concat(F.lit("```\n"), t)).when(kind == 3, F.concat(F.lit("Clinical Summary: "), t)).otherwise(F.concat(F.lit(" "), t))
    side = F.when(kind == 0, "LEFT").when(kind == 1, "right").when(kind == 2, "not_applicable").otherwise("x")
    hint = F.when(kind == 0, "outer quadrant of left breast").when(kind == 1, "Right lung").when(kind == 2, "").otherwise("colon")
    return turns.select("conv_id", "turn", scalars.unfenced(wrapped).alias("unfenced"), scalars.summary_text(wrapped).alias("summary"), scalars.sided_site(hint, side).alias("site"))


@query
def text_normalisers(spark, d):
    """One-line and manual texts of every turn, and its stage words without their letters."""
    x = F.concat(F.lit(" *  "), F.col("text"), F.lit("\t \n\n\n\n x * "))
    stage = F.concat(F.expr(pick("turn", 21, ["c", "p", "P", "", "yp"])), F.expr(pick("conv_id", 22, ["T1", "N0", "IIA", "M1", "X", "other"])))
    turns = read(spark, d, "conversations").where("text is not null")
    return turns.select("conv_id", "turn", scalars.one_line(x).alias("one_line"), scalars.manual_text(x).alias("manual"), scalars.stage_display(stage).alias("stage"))


@query
def compression_prompts(spark, d):
    """The note of every turn behind the metadata that it has."""
    turns = read(spark, d, "conversations")
    body = compression.prompt(F.col("text"), document_type=F.when(F.col("turn") % 2 == 0, F.col("role")), note_date=F.concat(F.lit(" 2024-"), F.col("turn").cast("string")))
    return turns.select("conv_id", "turn", body.alias("prompt"))


@query
def compression_outcome(spark, d):
    """Rows, errors and fallbacks by conversation length of a compression whose client fails now and then."""
    done = compression.compressed(_compressible(spark, d), models.EchoClient(_answer), 1)
    return compression.outcome(done)


@query
def prior_state_blocks(spark, d):
    """What is known of every record, as the prompt of the next round shows it."""
    results = _results(spark, d).where(F.col("item").isin(220, 400, 522, 880, 1290)).withColumn("name", F.concat(F.lit("n"), F.col("item").cast("string")))
    units = read(spark, d, "orders").select(F.col("o_orderkey").alias("rec"))
    return prompts.prior_state(results, units, ["rec"]).select("rec", "prior")


@query
def usage_numbers(spark, d):
    """The numbers of a reply's usage object under either name."""
    inner = F.concat(F.lit('{"prompt_tokens": '), F.col("event_id").cast("string"), F.lit(', "kind": "5", "cached": '), F.when(F.col("event_id") % 3 == 0, "null").otherwise("7.9"), F.lit(', "ok": true, "more": {"a": 1}}'))
    body = F.when(F.col("event_id") % 4 == 3, F.lit('{"usage": {"note": "12"}}')).otherwise(F.concat(F.lit('{"id": 1, "'), F.when(F.col("event_id") % 2 == 0, "usage").otherwise("usageMetadata"), F.lit('": '), inner, F.lit("}")))
    found = read(spark, d, "events").select("event_id", merging.usage_numbers(body).alias("usage"))
    return found.select("event_id", F.size("usage").cast("int").alias("n"), F.try_element_at("usage", F.lit("prompt_tokens")).alias("prompt_tokens"), F.try_element_at("usage", F.lit("cached")).alias("cached"))


@query
def envelope_text(spark, d):
    """The text of a model's reply, whatever envelope it comes in."""
    t = F.to_json(F.struct(F.col("text").alias("t")))
    quoted = F.substring(t, 6, F.length(t) - 6)
    kind = F.col("turn") % 7
    wrap = lambda head, tail: F.concat(F.lit(head), quoted, F.lit(tail))
    body = (
        F.when(kind == 0, wrap('{"choices": [{"message": {"content": ', "}}]}"))
        .when(kind == 1, wrap('{"choices": [{"message": {"content": [{"type": "text", "text": ', '}, {"type": "image"}, {"text": "!"}]}}]}'))
        .when(kind == 2, wrap('{"content": [{"type": "text", "text": ', "}]}"))
        .when(kind == 3, wrap('{"candidates": [{"content": {"parts": [{"text": ', "}]}}]}"))
        .when(kind == 4, wrap('{"output": [{"type": "reasoning", "content": [{"type": "text", "text": "hm"}]}, {"type": "message", "content": [{"type": "output_text", "text": ', '}, {"type": "refusal", "refusal": "no"}, {"type": "image", "text": "x"}]}]}'))
        .when(kind == 5, wrap('{"output": [{"role": "assistant", "content": ', "}, {\"role\": \"user\", \"content\": \"x\"}]}"))
        .otherwise(wrap('{"output_text": ', ', "content": "other"}'))
    )
    return read(spark, d, "conversations").where("text is not null").select("conv_id", "turn", merging.envelope_text(body).alias("answer"))


def _scripted(system: str, prompt: str) -> models.Reply | str:
    """Answers with a JSON object; every third length gives none, every fifth a reply with usage and reasoning."""
    n = len(prompt.split("\n\nThe last answer")[0])
    if n % 3 == 0 and "The last answer" not in prompt:
        return "no object"
    if n % 5 == 0:
        return models.Reply(json.dumps({"n": n}), "thought", {"tokens": n})
    return f"<think>hm</think>{json.dumps({'n': n})}"


@query
def answered_calls(spark, d):
    """One call for each distinct text, sixteen in flight a task: answer, attempts, reasoning and usage from one pass."""
    turns = read(spark, d, "conversations").where("text is not null")
    answers = models.answered(turns.select(F.lit("s").alias("system"), F.col("text").alias("prompt")), models.EchoClient(_scripted), objects=True, parser="qwen3")
    return answers.select("request_id", "response", "error", "log.attempts", "log.reasoning", F.try_element_at("log.usage", F.lit("tokens")).alias("tokens"))


@query
def durable_answers(spark, d):
    """The same calls stored as they come and read back; a second run over more texts asks the open ones only."""
    folder = sinks.scratch(spark, "answers")
    turns = read(spark, d, "conversations").where("text is not null").select(F.lit("s").alias("system"), F.col("text").alias("prompt"), "turn")
    first = answers_source.answered_durably(turns.where("turn % 2 = 0"), models.EchoClient(_scripted), folder, objects=True, parser="qwen3").select("request_id")
    n_first = first.count()
    every = answers_source.answered_durably(turns, models.EchoClient(_scripted), folder, objects=True, parser="qwen3")
    return every.select("request_id", "response", F.lit(n_first).alias("n_first"))


@query
def checkpoint_keys(spark, d):
    return read(spark, d, "customer").select("c_custkey", sinks.checkpoint_key(F.col("c_custkey").cast("string")).alias("name"))


# --- files written and read back ----------------------------------------------------------


@query
def notes_loaded(spark, d):
    """Notes written as CSV and loaded: blank texts go, documents are numbered by date."""
    path = sinks.scratch(spark, "notes.csv")
    rows = read(spark, d, "conversations").select(F.col("conv_id").alias(" Patient_ID"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("DATE"), "text")
    sinks.write_csv(rows, path)
    return notes.load(spark, path).select("patient_id", "date", "doc_index", F.sha2("text", 256).alias("text_sha256"))


@query
def xml_scan(spark, d):
    """Registry XML in several documents, read by the scan: every tumor with the items of its patient."""
    long = _results(spark, d).where(F.col("item").isin(220, 400, 522)).select(F.expr("rec div 10").alias("patient_id"), F.expr("rec % 10").cast("int").alias("tumor_index"), "item", F.col("resolved").alias("value"))
    keys = rules.spread(read(spark, d, "orders").select(F.col("o_orderkey").alias("rec")), ["rec"]).distinct()
    ids = keys.select(F.expr("rec div 10").alias("patient_id"), F.expr("rec % 10").cast("int").alias("tumor_index")).select("*", F.lit(20).alias("item"), F.col("patient_id").cast("string").alias("value"))
    items = spark.createDataFrame([(20, "patientIdNumber", "Patient"), (220, "sex", "Patient"), (400, "primarySite", "Tumor"), (522, "histologicTypeIcdO3", "Tumor")], "item int, xml_id string, parent_element string")
    path = sinks.scratch(spark, "registry_xml")
    sinks.write_xml(long.unionByName(ids), items, path, documents=3)
    value = lambda k: F.coalesce(F.try_element_at("values", F.lit(k)), F.lit(""))
    return registry.read_xml(spark, path).select(value("patientIdNumber").cast("bigint").alias("patient"), F.col("tumor_no").cast("int").alias("tumor_no"), value("sex").alias("sex"), value("primarySite").alias("site"), value("histologicTypeIcdO3").alias("hist"))


@query
def export_scan(spark, d):
    path = sinks.scratch(spark, "export.csv")
    rows = read(spark, d, "orders").select(F.when(F.col("o_orderkey") % 50 == 0, "none").otherwise(F.col("o_custkey").cast("string")).alias("DFCI_MRN"), F.date_format("o_orderdate", "dd-MMM-yyyy").alias("DIAGNOSIS_DT"), F.expr(pick("o_orderkey", 400, VALUES[400])).alias("SITE_CD"), "o_orderkey")
    sinks.write_csv(rows, path)
    return registry.read_export(spark, path).groupBy("mrn").agg(F.count("*").alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.max("site").alias("site"), F.count("hist").alias("n_hist"))


@query
def predictions_scan(spark, d):
    path = sinks.scratch(spark, "predictions.csv")
    values = _wide(spark, d).select("rec", F.inline(F.array(*(F.struct(F.lit(i).alias("item"), c.cast("string").alias("value")) for i, c in ((2300, F.col("rec")), (400, F.col("v400")), (522, F.col("v522"))))))).where("value <> ''")
    names = spark.createDataFrame([(2300, "Medical Record Number"), (400, "Primary Site")], "item int, name string")
    sinks.write_csv(sinks.wide_table(values, names, ["rec"]), path)
    return registry.read_predictions(spark, path).select(F.col("mrn").cast("bigint").alias("mrn"), F.coalesce("site", F.lit("")).alias("site"), F.coalesce("hist", F.lit("")).alias("hist"))


@query
def audit_scan(spark, d):
    """Audit rows as written: long evidence is cut."""
    path = sinks.scratch(spark, "audit.csv")
    sinks.write_audit(_results(spark, d).where("item = 400").withColumn("evidence", F.repeat(F.lit(' "e", '), 100)), ["rec"], path)
    found = notes.read_table(spark, path)
    return found.select(F.col("rec").cast("bigint").alias("rec"), F.col("item").cast("int").alias("item"), F.coalesce("extracted", F.lit("")).alias("extracted"), F.coalesce("resolved", F.lit("")).alias("resolved"), F.col("confidence").cast("double").alias("confidence"), F.sha2("evidence", 256).alias("evidence_sha256"))


@query
def json_scan(spark, d):
    """Records as JSON lines: blanks dropped, keys renamed."""
    path = sinks.scratch(spark, "records.json")
    record = _wide(spark, d).select(F.map_from_arrays(F.array(F.lit("rec"), F.lit("site"), F.lit("hist")), F.array(F.col("rec").cast("string"), "v400", "v522")).alias("values"))
    sinks.write_json(record, path, names={"site": "primarySite"})
    found = spark.read.schema("rec string, primarySite string, hist string, site string").json(path)
    return found.select(F.col("rec").cast("bigint").alias("rec"), "primarySite", "hist", "site")


@query
def checkpoint_scan(spark, d):
    kept = sinks.write_checkpoint(_values(spark, d), sinks.scratch(spark, "state"), "round=0")
    return kept.select("user_id", "item", "value")
