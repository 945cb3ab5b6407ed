"""Predictions against a registry: matching, per-diagnosis flags and 25 field metrics."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrel.functions.dates import predicted_date
from carrel.functions.scalars import UNKNOWN_STAGE, UNKNOWN_TNM, biomarker, digits, histology3, histology4, site, site3, stage_group, stage_group_extent, stage_group_main, summary_stage_extent, text, tnm, tnm_main
from carrel.operators.matching import accepted, greedy_matches

# Items of a prediction row.
ITEMS = {"mrn": 2300, "date": 390, "site": 400, "hist": 522, "beh": 523, "lat": 410, "grade": 440, "ss": 764, "clin_t": 1001, "clin_n": 1002, "clin_m": 1003, "clin_group": 1004, "path_t": 1011, "path_n": 1012, "path_m": 1013, "path_group": 1014, "er": 3827, "pr": 3915, "her2": 3855}
#: columns of a truth or prediction table: key, number within the key, day and coded fields
FIELDS = ["site", "hist", "beh", "lat", "grade", "ss", "ajcc", "t", "n", "m", "er", "pr", "her2"]
# Metric, present in truth, answered, right.
METRICS = [
    ("primary_site_exact", "present_site", "pp_site", "ok_site_exact"), ("primary_site_3char", "present_site", "pp_site", "ok_site3"),
    ("histology_4digit", "present_hist", "pp_hist", "ok_hist4"), ("histology_3digit", "present_hist", "pp_hist", "ok_hist3"),
    ("behavior", "present_beh", "pp_beh", "ok_beh"), ("laterality", "present_lat", "pp_lat", "ok_lat"), ("grade", "present_grade", "pp_grade", "ok_grade"),
    ("summary_stage_exact", "present_ss", "pp_ss", "ok_ss_exact"), ("summary_stage_collapsed", "present_ss", "pp_ss", "ok_ss_collapse"),
    ("stage_extent_crosswalk", "present_stage_axis", "pp_stage_axis", "ok_stage_axis"),
    ("ajcc_stage_group_exact", "present_ajcc", "pp_ajcc", "ok_ajcc_exact"), ("ajcc_stage_group_main", "present_ajcc", "pp_ajcc", "ok_ajcc_main"),
    ("ajcc_clin_T_exact", "present_t", "pp_t", "ok_t_exact"), ("ajcc_clin_T_main", "present_t", "pp_t", "ok_t_main"),
    ("ajcc_clin_N_exact", "present_n", "pp_n", "ok_n_exact"), ("ajcc_clin_N_main", "present_n", "pp_n", "ok_n_main"), ("ajcc_clin_M_exact", "present_m", "pp_m", "ok_m_exact"),
    ("dx_date_exact", "present_date_gt", "present_date_pred", "ok_date_exact"), ("dx_date_within30d", "present_date_gt", "present_date_pred", "ok_date30"),
    ("dx_date_within90d", "present_date_gt", "present_date_pred", "ok_date90"), ("dx_date_within365d", "present_date_gt", "present_date_pred", "ok_date365"),
    ("dx_year_match", "present_date_gt", "present_date_pred", "ok_year"),
    ("ER_breast", "present_er", "pp_er", "ok_er"), ("PR_breast", "present_pr", "pp_pr", "ok_pr"), ("HER2_breast", "present_her2", "pp_her2", "ok_her2"),
]


def shaped_predictions(raw: DataFrame) -> DataFrame:
    """Prediction fields from raw item columns (named as in ITEMS, any may be missing) and an order column ord.

    Stage group: the pathological one where it says something, else the clinical one. T, N and M:
    the clinical value, else the pathological one (the clinical X counts as a value here).
    """
    c = lambda name: text(F.col(name)) if name in raw.columns else F.lit("")
    mrn = F.nullif(digits(F.col("mrn")), F.lit("")).try_cast("bigint")
    group = F.when(stage_group_main(c("path_group")) != "unknown", c("path_group")).otherwise(c("clin_group"))
    axis = lambda a: F.when(~tnm(c(f"clin_{a}"), a.upper()).isin(UNKNOWN_TNM), c(f"clin_{a}")).otherwise(c(f"path_{a}")).alias(a)
    rows = raw.select(mrn.alias("mrn"), F.col("ord"), *(c(x).alias(x) for x in ("site", "hist", "beh", "lat", "grade", "ss")), group.alias("ajcc"), *(axis(a) for a in "tnm"), *(c(x).alias(x) for x in ("er", "pr", "her2")), predicted_date(c("date")).alias("day"))
    return rows.where("mrn is not null").withColumn("pi", F.row_number().over(Window.partitionBy("mrn").orderBy("ord")) - 1).drop("ord")


def filtered_registry(rows: DataFrame, year_min: int | None = None, year_max: int | None = None, behaviors: set[str] | None = None, best_rows_only: bool = True) -> DataFrame:
    """Filters on day, beh and best_row. Undated rows stay unless a year is asked for."""
    if year_min is not None or year_max is not None:
        rows = rows.where(F.year("day").between(year_min if year_min is not None else -(10**9), year_max if year_max is not None else 10**9))
    if behaviors and "beh" in rows.columns:
        rows = rows.where(F.col("beh").isin([b.strip() for b in behaviors]))
    if best_rows_only and "best_row" in rows.columns:
        rows = rows.where(F.upper(text(F.coalesce("best_row", F.lit("Y")))) != "N")
    return rows


def matched(truth: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every truth row (mrn, ti, day, FIELDS) with its match: p (prediction fields or null), matched, site_match, days.

    A rejected pair keeps its prediction taken, as the greedy order has it.
    """
    short = lambda df, n: df.select("mrn", n, site3(F.col("site")).alias("site"), "day")
    pairs = greedy_matches(short(truth, "ti"), short(predictions, "pi"), "mrn")
    fields = predictions.select("mrn", "pi", F.struct("day", *FIELDS).alias("p"))
    found = truth.join(pairs, ["mrn", "ti"], "left").join(fields, ["mrn", "pi"], "left")
    good = F.col("pi").isNotNull() & accepted(F.col("site_match"), F.col("days"))
    return found.withColumn("matched", good).withColumn("p", F.when(good, F.col("p")))


def flags(rows: DataFrame) -> DataFrame:
    """All present_*, pp_* and ok_* flags of matched() rows."""
    g = {f: F.col(f) for f in FIELDS}
    p = {f: F.col(f"p.{f}") for f in FIELDS}
    has = F.col("matched")
    low = lambda x: F.lower(text(x))
    gs, gh, ga = site(g["site"]), histology4(g["hist"]), text(g["ajcc"])
    extent, predicted_extent = stage_group_extent(ga), summary_stage_extent(p["ss"])
    breast = site3(g["site"]) == "C50"
    yes_no = ["positive", "negative"]
    out: dict[str, Column] = {
        "present_site": gs != "", "present_hist": gh != "", "present_beh": ~text(g["beh"]).isin("", "nan"), "present_lat": ~text(g["lat"]).isin("", "9", "nan"),
        "present_grade": ~text(g["grade"]).isin("", "9", "nan"), "present_ss": ~text(g["ss"]).isin("", "9", "nan"), "present_ajcc": stage_group_main(ga) != "unknown",
        "present_stage_axis": extent != "unknown", "present_date_gt": F.col("day").isNotNull(),
        "pp_site": site(p["site"]) != "", "pp_hist": histology4(p["hist"]) != "", "pp_beh": ~text(p["beh"]).isin("", "9", "nan"), "pp_lat": ~low(p["lat"]).isin("", "9", "unknown", "nan"),
        "pp_grade": ~low(p["grade"]).isin(UNKNOWN_STAGE), "pp_ss": ~low(p["ss"]).isin(UNKNOWN_STAGE), "pp_ajcc": stage_group_main(p["ajcc"]) != "unknown", "pp_stage_axis": predicted_extent != "unknown",
        "present_date_pred": F.col("p.day").isNotNull(),
        "ok_site_exact": (gs != "") & (gs == site(p["site"])), "ok_site3": (site3(g["site"]) != "") & (site3(g["site"]) == site3(p["site"])),
        "ok_hist4": (gh != "") & (gh == histology4(p["hist"])), "ok_hist3": (gh != "") & (histology3(g["hist"]) == histology3(p["hist"])),
        "ok_stage_axis": (extent != "unknown") & (extent == predicted_extent),
        "ok_ss_exact": (text(g["ss"]) != "") & (F.substring(digits(g["ss"]), 1, 1) == F.substring(digits(p["ss"]), 1, 1)),
        "ok_ss_collapse": (summary_stage_extent(g["ss"]) != "unknown") & (summary_stage_extent(g["ss"]) == summary_stage_extent(p["ss"])),
        "ok_ajcc_exact": (ga != "") & (stage_group(ga) == stage_group(p["ajcc"])), "ok_ajcc_main": (stage_group_main(ga) != "unknown") & (stage_group_main(ga) == stage_group_main(p["ajcc"])),
    }
    for f in ("beh", "lat", "grade"):
        out[f"ok_{f}"] = (text(g[f]) != "") & (text(g[f]) == text(p[f]))
    for f in "tnm":
        a, b = tnm(g[f], f.upper()), tnm(p[f], f.upper())
        out[f"present_{f}"], out[f"pp_{f}"] = ~F.lower(a).isin(UNKNOWN_TNM), ~F.lower(b).isin(UNKNOWN_TNM)
        out[f"ok_{f}_exact"] = (a != "") & (a == b)
        if f != "m":
            out[f"ok_{f}_main"] = (tnm_main(a) != "") & (tnm_main(a) == tnm_main(b))
    for f in ("er", "pr", "her2"):
        out[f"present_{f}"], out[f"pp_{f}"] = breast & biomarker(g[f]).isin(yes_no), biomarker(p[f]).isin(yes_no)
        out[f"ok_{f}"] = biomarker(g[f]).isin(yes_no) & (biomarker(g[f]) == biomarker(p[f]))
    apart = F.abs(F.date_diff("day", "p.day"))
    out["ok_date_exact"] = apart == 0
    for n in (30, 90, 365):
        out[f"ok_date{n}"] = apart <= n
    out["ok_year"] = F.year("day") == F.year("p.day")
    given = {k: F.coalesce(v if k.startswith("present_") and k != "present_date_pred" else has & v, F.lit(False)) for k, v in out.items()}
    return rows.select("mrn", "ti", "matched", "site_match", "days", *(v.alias(k) for k, v in given.items()))


def metrics(scored: DataFrame) -> DataFrame:
    """metric, n_gt, accuracy, coverage, n_attempted, accuracy_attempted over matched rows, in one pass."""
    entry = F.explode(F.array(*(F.struct(F.lit(k).alias("k"), F.lit(m).alias("metric"), F.col(a).alias("there"), F.col(b).alias("answered"), F.col(c).alias("right")) for k, (m, a, b, c) in enumerate(METRICS))))
    rows = scored.select("matched", entry.alias("e")).select("matched", "e.*")
    base = F.col("matched") & F.col("there")
    n, attempted = F.count_if(base), F.count_if(base & F.col("answered"))
    share = lambda x, y: F.round(F.try_divide(x, y), 4)
    return rows.groupBy("k", "metric").agg(
        n.alias("n_gt"),
        share(F.count_if(base & F.col("right")), n).alias("accuracy"),
        share(attempted, n).alias("coverage"),
        attempted.alias("n_attempted"),
        share(F.count_if(base & F.col("answered") & F.col("right")), attempted).alias("accuracy_attempted"),
    )


def summary(scored: DataFrame, predictions: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: diagnoses, patients, recall, matches, and predictions no truth row of their patient took."""
    counts = scored.agg(F.count("*").alias("n_truth_diagnoses"), F.countDistinct("mrn").alias("n_patients"), F.round(F.coalesce(F.avg(F.col("matched").cast("double")), F.lit(0.0)), 4).alias("diagnosis_match_recall"), F.count_if("matched").alias("n_matched"))
    extra = predictions.join(scored.select("mrn").distinct(), "mrn", "left_semi").join(pairs.select("mrn", "pi"), ["mrn", "pi"], "left_anti").agg(F.count("*").alias("n_extra_predicted_tumors"))
    return counts.join(extra, F.lit(True))  # one row each


def summary_json(one: DataFrame, by_metric: DataFrame) -> str:
    fields = {r["metric"]: {k: r[k] for k in ("n_gt", "accuracy", "coverage", "n_attempted", "accuracy_attempted")} for r in by_metric.orderBy("k").collect()}
    return json.dumps(one.first().asDict() | {"fields": fields}, indent=2)
