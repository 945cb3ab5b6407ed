import datetime as dt
import json
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from carrel.functions import dates
from carrel.operators import chunking, compression, confidence, matching, merging, models, resolution, retrieval, rules, sampling, scoring, summary, tumors
from carrel.plans import pipeline
from carrel.sources import dictionary, notes, registry, sinks
from carrel.streaming import notes as streams
from carrel.streaming import tumors as streaming_tumors

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import test modules


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_chunks_cover_the_text(spark):
    text = "".join(chr(97 + k % 26) for k in range(1000))
    df = spark.createDataFrame([("p", 0, "2020", text), ("q", 0, "", "short")], "k string, doc_index int, date string, text string")
    whole = {r["k"]: r["full_text"] for r in chunking.concatenated(df, ["k"]).collect()}
    got = chunking.chunked(df, ["k"], 40, 5).orderBy("k", "chunk_index").collect()
    p = [r["chunk_text"] for r in got if r["k"] == "p"]
    assert p[0] + "".join(c[17:] for c in p[1:]) == whole["p"]
    assert [r["chunk_text"] for r in got if r["k"] == "q"] == [whole["q"]]
    with pytest.raises(ValueError):
        chunking.chunked(df, ["k"], 5, 5)


def sliced(text, target, overlap):
    """Chunks of one text, the plain way."""
    size, stride = int(target * 3.5), int(target * 3.5) - int(overlap * 3.5)
    if max(1, int(len(text) / 3.5)) <= target:
        return [text]
    return [text[k * stride : k * stride + size] for k in range(-(-max(len(text) - size, 0) // stride) + 1)]


def test_chunks_by_offsets_equal_slices_of_the_whole_text(spark, monkeypatch):
    monkeypatch.setattr(chunking, "SPAN", 4)
    rng = random.Random(8)
    docs = [(k, 3 * n + 1, rng.choice(["2020-01-01", "2021", None]), rng.choice(["", None, "é" * rng.randint(1, 300), "w " * rng.randint(1, 90), "=== Clinical Note dated 1999 ===\n"])) for k in ("a", "b", None) for n in range({"a": 60, "b": 3, None: 9}[k])]
    docs.append(("hot", 0, "2020", "z" * 20_000))
    df = spark.createDataFrame(docs, "k string, doc_index int, date string, text string").repartition(5)
    whole = {r["k"]: r["full_text"] for r in chunking.concatenated(df, ["k"]).collect()}
    for target, overlap in ((40, 5), (7, 6), (100, 0), (100_000, 10)):
        got = {}
        for r in chunking.chunked(df, ["k"], target, overlap).orderBy("chunk_index").collect():
            assert r["chunk_index"] == len(got.setdefault(r["k"], []))
            got[r["k"]].append(r["chunk_text"])
        assert got == {k: sliced(t, target, overlap) for k, t in whole.items()}


def test_chunk_dates_carry_on(spark):
    docs = spark.createDataFrame([("p", 0, "2020-01-01", "x" * 200), ("p", 1, "2021-02-02", "y" * 30)], "p string, doc_index int, date string, text string")
    got = chunking.chunked(docs, ["p"], 40, 20).orderBy("chunk_index").select("first_date", "last_date").collect()
    assert tuple(got[0]) == ("2020-01-01", "2020-01-01") and got[1]["first_date"] == "2020-01-01"
    assert got[-1]["last_date"] == "2021-02-02" and len(got) == 4


@pytest.mark.parametrize(("diagnosis", "kept"), [("2024-01-15", ["2023-07-15", "2024-01-15", "2024-07-15"]), ("bad", ["2023-07-14", "2023-07-15", "2024-01-15", "2024-07-15", "2024-07-16"])])
def test_documents_in_window(spark, diagnosis, kept):
    docs = spark.createDataFrame([("p", d) for d in ["2023-07-14", "2023-07-15", "2024-01-15", "2024-07-15", "2024-07-16"]], "patient_id string, date string").withColumn("span", dates.interval(F.col("date")))
    tumor = spark.createDataFrame([("p", diagnosis)], "patient_id string, dx string").withColumn("window", dates.window(F.col("dx")))
    assert sorted(r["date"] for r in matching.in_window(docs, tumor).collect()) == kept


def test_merge_keeps_best_and_earliest(spark):
    df = spark.createDataFrame([("p", 400, "a", 0.5, 1), ("p", 400, "b", 0.9, 2), ("p", 400, "c", 0.9, 3)], "k string, item int, extracted string, confidence double, seq int")
    assert merging.merged(df, ["k"]).first()["extracted"] == "b"
    assert merging.still_open(df.select("k", "item").distinct(), df, ["k"]).count() == 0


def test_payload_quirks(spark):
    bodies = ['[{"site": {"value": "C50", "confidence": 0.9, "evidence": "e"}}]', '{"site": {"value": null, "confidence": 1}, "x": {"value": "1", "confidence": "high"}, "_m": {"value": "z"}}', "garbage"]
    got = merging.payload_items(spark.createDataFrame(enumerate(bodies), "n int, response string")).orderBy("n").select("n", "field", "value", "model_confidence").collect()
    assert [tuple(r) for r in got] == [(0, "site", "C50", 0.9), (1, "x", "1", 0.0)]


def record(spark, **values):
    items = rules.referenced_items()
    return spark.createDataFrame([("r", *(values.get(f"v{i}") for i in items))], "rec string, " + ", ".join(f"v{i} string" for i in items))


CASES = [
    ("IF39_Site_Sex", {"v400": "C619", "v220": "2"}, {"v400": "C619", "v220": "1"}), ("IF39_Site_Sex", {"v400": "C53.9", "v220": "1"}, {"v400": "C539", "v220": "9"}),
    ("IF25_Site_Histology", {"v400": "C509", "v522": "8170"}, {"v400": "C220", "v522": "8170"}), ("IF25_Site_Histology", {"v400": "C180", "v522": "8720"}, {"v400": "C445", "v522": "8720"}), ("IF25_Site_Histology", {"v400": "C509", "v522": "9050"}, {"v400": "C384", "v522": "9050"}),
    ("Laterality_PairedSite", {"v400": "C509", "v410": ""}, {"v400": "C509", "v410": "9"}), ("Behavior_Histology", {"v522": "9801", "v523": "2"}, {"v522": "9801", "v523": "3"}), ("Behavior_Histology", {"v522": "8140", "v523": "0"}, {"v522": "8140", "v523": "3"}),
    ("Age_Site_Plausibility", {"v400": "C619", "v230": "19"}, {"v400": "C619", "v230": "999"}), ("Age_Histology_Plausibility", {"v400": "C692", "v522": "9510", "v230": "11"}, {"v522": "9510", "v230": "11"}),
    ("TNM_Clinical_Consistency", {"v940": "T1"}, {"v940": "T1", "v970": "1"}), ("TNM_Pathological_T0_Npositive", {"v880": "T0", "v890": "N1"}, {"v880": "T0", "v890": "N0"}), ("TNM_Clinical_Tis_Behavior", {"v940": "Tis", "v523": "3"}, {"v940": "Tis", "v523": "2"}),
    ("Treatment_Date_Before_Diagnosis", {"v390": "20200601", "v1210": "20200101"}, {"v390": "20200601", "v1210": "99999999"}), ("DiagConfirm_Histology", {"v490": "1"}, {"v490": "1", "v522": "8140"}), ("DiagConfirm_PathStaging", {"v490": "7", "v880": "T1"}, {"v490": "9", "v880": "T1"}),
    ("Surgery_Date_Missing", {"v1290": "20"}, {"v1290": "20", "v1200": "2020"}), ("Surgery_Margins_Missing", {"v1291": "A200"}, {"v1291": "A200", "v1320": "0"}), ("Reason_No_Surgery_Missing", {"v1290": "00"}, {"v1290": "00", "v1340": "1"}),
    ("Radiation_Date_Missing", {"v1360": "1"}, {"v1360": "7"}), ("Reason_No_Radiation_Missing", {"v1360": "0"}, {"v1360": "0", "v1430": "1"}), ("DLC_Before_Diagnosis", {"v390": "2021", "v1750": "2020"}, {"v390": "2020", "v1750": "2021"}), ("Dead_No_CauseOfDeath", {"v1760": "0"}, {"v1760": "1"}),
    ("Surgery_TumorSizePath_Missing", {"v1290": "20"}, {"v1290": "20", "v754": "025"}), ("Radiation_Modality_Missing", {"v1360": "2"}, {"v1360": "2", "v1570": "31"}), ("Chemo_Text_Missing", {"v1390": "01"}, {"v1390": "82"}), ("DistantStage_No_Mets_Site", {"v764": "7", "v1112": "0"}, {"v764": "7", "v1116": "1"}),
    ("PathStaging_No_Surgery", {"v880": "T1", "v1290": "00"}, {"v880": "T1"}), ("SentinelLN_Scope_Missing", {"v834": "02"}, {"v834": "00"}), ("SentinelLN_Scope_Mismatch", {"v834": "02", "v1292": "0"}, {"v834": "02", "v1292": "2"}), ("GradePath_No_Surgery", {"v441": "1", "v1290": "00"}, {"v441": "9", "v1290": "00"}),
]


def test_rules_hit_and_miss(spark):
    items = rules.referenced_items()
    data = [(f"{kind}{k}", *(values.get(f"v{i}") for i in items)) for k, (_, hit, miss) in enumerate(CASES) for kind, values in (("hit", hit), ("miss", miss))]
    found = rules.violations(spark.createDataFrame(data, "rec string, " + ", ".join(f"v{i} string" for i in items)), ["rec"]).collect()
    by = {(r["rec"], r["edit_name"]) for r in found}
    for k, (edit, *_) in enumerate(CASES):
        assert (f"hit{k}", edit) in by, edit
        assert (f"miss{k}", edit) not in by, edit


def test_fix_then_penalty_then_review(spark):
    results = spark.createDataFrame([("r", 940, "Tis", "Tis", 0.95), ("r", 523, "3", "3", 0.95), ("r", 970, "0", "0", 0.7)], "rec string, item int, extracted string, resolved string, confidence double")
    found = rules.violations(rules.wide(results, ["rec"]), ["rec"])
    fixed = rules.fixed(results, found, ["rec"])
    assert {r["item"]: r["resolved"] for r in fixed.collect()}[523] == "2"
    scores = {r["item"]: r["final_confidence"] for r in confidence.scored(fixed, found, ["rec"]).collect()}
    assert scores == {940: 0.65, 523: 0.52, 970: 0.7}
    queue = {r["item"]: r["priority"] for r in confidence.review_queue(confidence.scored(fixed, found, ["rec"]), ["rec"]).collect()}
    assert queue == {940: "HIGH", 523: "HIGH"}


def test_greedy_prefers_site_then_days(spark):
    day = dt.date
    truth = spark.createDataFrame([(1, 0, "C50", day(2020, 1, 1)), (1, 1, "C34", day(2020, 1, 2)), (2, 0, "C18", None)], "mrn int, ti int, site string, day date")
    predicted = spark.createDataFrame([(1, 0, "C34", day(2019, 1, 1)), (1, 1, "C61", day(2020, 1, 1)), (2, 0, "C20", day(2020, 1, 1))], "mrn int, pi int, site string, day date")
    got = {(r["mrn"], r["ti"]): (r["pi"], r["site_match"], r["days"]) for r in matching.greedy_matches(truth, predicted, "mrn").collect()}
    assert got == {(1, 1): (0, True, 366), (1, 0): (1, False, 0), (2, 0): (0, False, None)}


def test_scoring_attempted_and_strict(spark):
    fields = ", ".join(f"{f} string" for f in scoring.FIELDS)
    blank = dict.fromkeys(scoring.FIELDS, "")
    d = dt.date(2024, 1, 15)
    make = lambda n, rows_: spark.createDataFrame([(m, k, day, *({**blank, **v}[f] for f in scoring.FIELDS)) for m, k, day, v in rows_], f"mrn long, {n} int, day date, {fields}")
    truth = make("ti", [(1, 0, d, {"site": "C504", "hist": "85003", "grade": "2", "er": "1: ER positive"}), (2, 0, d, {"site": "C340", "grade": "3"}), (3, 0, d, {"site": "C61"})])
    predicted = make("pi", [(1, 0, d, {"site": "C50.4", "hist": "8500/3", "grade": "2", "er": "positive"}), (2, 0, dt.date(2024, 3, 1), {"site": "C34.1", "grade": ""}), (3, 0, dt.date(2010, 1, 1), {"site": "C18"})])
    found = scoring.matched(truth, predicted)
    scored = scoring.flags(found)
    m = {r["metric"]: r for r in scoring.metrics(scored).collect()}
    assert (m["primary_site_exact"]["n_gt"], m["primary_site_exact"]["accuracy"], m["primary_site_3char"]["accuracy"]) == (2, 0.5, 1.0)
    assert (m["grade"]["accuracy"], m["grade"]["coverage"], m["grade"]["accuracy_attempted"]) == (0.5, 0.5, 1.0)
    assert m["ER_breast"]["accuracy"] == 1.0 and m["HER2_breast"]["accuracy"] is None
    assert m["dx_date_within30d"]["accuracy"] == 0.5 and len(m) == 25
    pairs = found.where("pi is not null").select("mrn", "pi")
    one = scoring.summary(scored, predicted, pairs)
    said = json.loads(scoring.summary_json(one, scoring.metrics(scored)))
    assert (said["n_matched"], said["diagnosis_match_recall"], said["n_extra_predicted_tumors"]) == (2, 0.6667, 0)


def test_registry_filter_keeps_undated_without_years(spark):
    df = spark.createDataFrame([(1, None, "3", "Y"), (2, dt.date(2020, 1, 1), "3", "N"), (3, dt.date(2020, 1, 1), "2", None)], "k int, day date, beh string, best_row string")
    ids = lambda x: sorted(r["k"] for r in x.collect())
    assert ids(scoring.filtered_registry(df)) == [1, 3]
    assert ids(scoring.filtered_registry(df, 2019, None)) == [3]
    assert ids(scoring.filtered_registry(df, behaviors={" 3"}, best_rows_only=False)) == [1, 2]


def test_prediction_shaping(spark):
    raw = spark.createDataFrame([("MRN 0012", 0, "C50", "T2", "", "X", "N1", "99", "IIA")], "mrn string, ord long, site string, clin_t string, path_t string, clin_n string, path_n string, path_group string, clin_group string")
    r = scoring.shaped_predictions(raw).first()
    assert (r["mrn"], r["pi"], r["t"], r["n"], r["ajcc"], r["grade"]) == (12, 0, "T2", "X", "IIA", "")


def dictionary_files(tmp_path):
    head = ",".join(dictionary.ITEM_COLUMNS)
    line = lambda **v: ",".join(v.get(n, "") for n in dictionary.ITEM_COLUMNS.values())
    (tmp_path / "items.csv").write_text("﻿\n" + head + "\n" + line(item="220", name="Sex", length="1", xml_id="sex", parent_element="Patient", seer_collect="R") + "\n" + line(item="400", name="Primary Site", length="4", xml_id="primarySite", parent_element="Tumor", coc_collect="R") + "\n" + line(item="10", name="Record Type", length="1", xml_id="recordType", parent_element="NaaccrData") + "\n" + line(item="bad", name="x") + "\n" + line(item="77", name="Old", year_retired="2003", seer_collect="R") + "\n", encoding="utf-8")
    (tmp_path / "codes.csv").write_text("﻿\n" + ",".join(dictionary.CODE_COLUMNS) + "\n220,Sex,1,1,Male\n220,Sex,1,2,Female\n", encoding="utf-8")
    (tmp_path / "names.csv").write_text("﻿\n" + ",".join(dictionary.NAME_COLUMNS) + "\n220,Sex,Gender\n400,Primary Site,Topography\n", encoding="utf-8")
    return tmp_path


def test_dictionary(spark, tmp_path):
    at = dictionary_files(tmp_path)
    items = dictionary.items(spark, f"{at}/items.csv")
    assert sorted(r["item"] for r in items.collect()) == [10, 77, 220, 400]
    assert sorted(r["item"] for r in resolution.extractable(items).collect()) == [220, 400]
    assert {r["k"]: r["item"] for r in dictionary.alternate_names(spark, f"{at}/names.csv").collect()} == {"gender": 220, "topography": 400}
    assert rows(resolution.valid_codes_text(dictionary.codes(spark, f"{at}/codes.csv"))) == [(220, "1=Male; 2=Female")]


def test_resolution_tiers(spark):
    codes = spark.createDataFrame([(1, "A1", "Left side", 0), (1, "B2", "Right side", 1)], "item int, code string, description string, pos int")
    ranges = resolution.numeric_ranges(spark.createDataFrame([(2, "001-100, 999")], "item int, allowable_values string"))
    values = spark.createDataFrame([(1, "A1"), (1, "a1"), (1, "RIGHT SIDE"), (2, "7"), (2, "101"), (1, None)], "item int, value string")
    got = {(r["item"], r["value"]): (r["code"], r["resolution"]) for r in resolution.resolved(values, codes, ranges).collect()}
    assert got == {(1, "A1"): ("A1", 1.0), (1, "a1"): ("A1", 0.95), (1, "RIGHT SIDE"): ("B2", 0.9), (2, "7"): ("007", 0.85), (2, "101"): ("101", 0.0), (1, None): ("", 0.0)}


def test_schemas(spark):
    df = spark.createDataFrame([("C50.4", "8500"), ("C445", "8720"), ("C445", "8070"), ("x", ""), (None, None)], "s string, h string")
    assert [r[0] for r in df.select(resolution.schema_of(F.col("s"), F.col("h"))).collect()] == ["breast", "melanoma_skin", "generic", "generic", "generic"]
    items = df.limit(1).select(resolution.staging_items(F.lit("breast"))).first()[0]
    assert items[:38] == resolution.CORE_STAGING_ITEMS and len(items) == len(set(items)) == 59


def test_retrieval(spark):
    manuals = spark.createDataFrame([("appendix_c", "Breast", "c/breast.txt", "breast surgery codes " * 50), ("other", "Lung", "o/lung.txt", "lung and breast"), ("staging", "Other", "s/o.txt", "nothing")], "category string, title string, path string, text string")
    queries = spark.createDataFrame([("q", "Carcinoma of the breast")], "query_id string, q string").select("query_id", retrieval.keywords(F.col("q")).alias("words"))
    assert queries.first()["words"] == ["breast"]
    best = retrieval.best(retrieval.scores(queries, manuals))
    assert [(r["title"], r["score"]) for r in best.orderBy("place").collect()] == [("Breast", 15), ("Other", 3), ("Lung", 1)]
    context = retrieval.context_blocks(retrieval.with_texts(best, queries, manuals), 1500).first()["context"]
    assert context.startswith("## Breast\nbreast surgery") and len(context) <= 1500


def test_summary_falls_back(spark):
    results = spark.createDataFrame([("a", 400, "C50.4", "C504"), ("a", 522, "8140", "8140"), ("a", 1001, "cT1", "cT1"), ("b", 400, "left lung", ""), ("c", 400, "", "blank")], "rec string, item int, extracted string, resolved string")
    people = spark.createDataFrame([("a", "h", "x", "t"), ("b", "h", "x", "t"), ("c", "hint", "", "type")], "rec string, primary_site_hint string, histology string, cancer_type string")
    codes = spark.createDataFrame([(1001, "cT1", "Tumor 2 cm or less")], "item int, code string, description string")
    sites = spark.createDataFrame([("C50.4", "Upper-outer"), ("C50", "Breast")], "code string, label string")
    hist = spark.createDataFrame([("8140", "Adenocarcinoma")], "code string, label string")
    got = {r["rec"]: r for r in summary.diagnosis_summary(results, people, codes, sites, hist, ["rec"]).collect()}
    assert (got["a"]["site_text"], got["a"]["histology_text"], got["a"]["clinical_t_text"]) == ("Upper-outer", "Adenocarcinoma", "Tumor 2 cm or less")
    assert (got["b"]["site_text"], got["b"]["histology_text"]) == ("left lung", "x")
    assert (got["c"]["site_code"], got["c"]["site_text"], got["c"]["histology_text"]) == ("", "hint", "type")


def test_xml_round_trip(spark, tmp_path):
    items = spark.createDataFrame([(10, "recordType", "NaaccrData"), (220, "sex", "Patient"), (400, "primarySite", "Tumor"), (522, "histologicTypeIcdO3", "Tumor")], "item int, xml_id string, parent_element string")
    values = spark.createDataFrame([("p1", 0, 10, "A"), ("p1", 0, 220, "2"), ("p1", 0, 400, "C504"), ("p1", 0, 522, "a<b&c"), ("p1", 1, 220, "1"), ("p1", 1, 400, "C509"), ("p2", 0, 400, "C61"), ("p2", 0, 999, "x"), ("p2", 0, 522, "")], "patient_id string, tumor_index int, item int, value string")
    sinks.write_xml(values, items, f"{tmp_path}/out")
    got = sorted(tuple(sorted(r["values"].items())) for r in registry.read_xml(spark, f"{tmp_path}/out").collect())
    assert got == sorted(
        [
            (("histologicTypeIcdO3", "a<b&c"), ("primarySite", "C504"), ("recordType", "A"), ("sex", "2")),
            (("primarySite", "C509"), ("recordType", "A"), ("sex", "2")),
            (("primarySite", "C61"), ("recordType", "A")),
        ]
    )


def test_flat_and_wide(spark):
    values = spark.createDataFrame([("a", 1, "xyz"), ("a", 2, "q"), ("b", 2, "rs")], "k string, item int, value string")
    lengths = spark.createDataFrame([(1, 2, "One"), (2, 3, "Two")], "item int, length int, name string")
    assert sorted(rows(sinks.fixed_width(values, lengths, ["k"]))) == [("a", "xyq  "), ("b", "  rs ")]
    wide = sinks.wide_table(values, lengths, ["k"])
    assert wide.columns == ["k", "One [1]", "Two [2]"] and sorted(rows(wide)) == [("a", "xyz", "q"), ("b", "", "rs")]
    assert sorted(rows(merging.with_defaults(values.withColumn("item", F.col("item") * 10), ["k"]).where("item in (10, 50)"))) == [("a", 10, "xyz"), ("a", 50, "260"), ("b", 10, "A"), ("b", 50, "260")]


def test_json_and_flatten(spark, tmp_path):
    df = spark.createDataFrame([({"a": "1", "b": ""},), ({"c": "x"},)], "values map<string,string>")
    sinks.write_json(df, f"{tmp_path}/j", names={"a": "Alpha"})
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/j").collect()) == ['{"Alpha":"1"}', '{"c":"x"}']
    assert sinks.flattened(df.coalesce(1)).columns == ["a", "c"]


def test_notes_loading(spark, tmp_path):
    (tmp_path / "n.csv").write_text("Patient_ID,Date,Text,MRN,sex,gender\np1,2021,later,,F,\np1,2020,\"first\nnote\",77,M,2\np2,, ,,,\n")
    loaded = notes.load(spark, f"{tmp_path}/n.csv")
    got = loaded.orderBy("doc_index").select("patient_id", "date", "doc_index", "text").collect()
    assert [tuple(r) for r in got] == [("p1", "2020", 0, "first\nnote"), ("p1", "2021", 1, "later")]
    assert sorted(rows(notes.structured_items(loaded))) == [("p1", 220, "2"), ("p1", 2300, "77")]
    with pytest.raises(ValueError, match="date, text"):
        notes.required(spark.createDataFrame([("p",)], "patient_id string"))
    with pytest.raises(ValueError, match="unsupported"):
        notes.read_table(spark, "x.doc")


def test_predictions_and_export(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Medical Record Number [2300],Primary Site [400],Date [390]\n12,C50.4,20240115\n,C1,\n")
    got = scoring.shaped_predictions(registry.read_predictions(spark, f"{tmp_path}/p.csv")).collect()
    assert [(r["mrn"], r["site"], str(r["day"])) for r in got] == [(12, "C50.4", "2024-01-15")]
    (tmp_path / "r.csv").write_text("DFCI_MRN,DIAGNOSIS_DT,SITE_CD\n12,15-Jan-2024,C504\nx,15-Jan-2024,C1\n")
    assert [(r["mrn"], r["site"], r["t"]) for r in registry.read_export(spark, f"{tmp_path}/r.csv").collect()] == [(12, "C504", None)]
    (tmp_path / "bad.csv").write_text("a\n1\n")
    with pytest.raises(ValueError):
        registry.read_predictions(spark, f"{tmp_path}/bad.csv")


def test_retry_policy():
    waits = [models.wait_before(k) for k in range(1, 8)]
    assert waits == [2, 4, 8, 16, 32, 64, 120] and models.wait_before(1, 9.0) == 9.0
    tries = []

    class Flaky:
        def generate(self, system, prompt):
            tries.append(1)
            if len(tries) < 3:
                raise models.Retryable("busy", 7)
            return "ok"

    slept = []
    assert models.called(Flaky(), "s", "p", sleep=slept.append) == "ok" and slept == [7, 7]
    assert models.as_object('```json\n[{"a": 1}]\n```') == {"a": 1}
    for bad in ("[1, 2]", "x", "[{}, {}]"):
        with pytest.raises(ValueError):
            models.as_object(bad)


def fail_on_even(system, prompt):
    if prompt == "Document two text.":
        raise RuntimeError("endpoint unavailable")
    return "Summary: short"


def test_compression_resumes_and_falls_back(spark, tmp_path):
    df = spark.createDataFrame([(0, "p1", "2025-01-01", "Document one text.", "F"), (1, "p1", "2025-02-01", "Document two text.", "F")], "row_index long, patient_id string, date string, text string, sex string")
    out = compression.compress(df.where("row_index = 0"), models.EchoClient(fail_on_even), f"{tmp_path}/c")
    assert [(r["output_text"], r["sex"]) for r in out.collect()] == [("short", "F")]
    out = compression.compress(df, models.EchoClient(fail_on_even), f"{tmp_path}/c").collect()
    assert [(r["row_index"], r["output_text"], r["used_fallback"]) for r in out] == [(0, "short", False), (1, "Document two text.", True)]
    assert "RuntimeError: endpoint unavailable" in out[1]["error"] and out[0]["fingerprint"] != out[1]["fingerprint"]
    out = compression.compress(df, models.EchoClient(lambda s, p: "```\nagain\n```"), f"{tmp_path}/c").collect()  # only what failed is asked again
    assert [(r["output_text"], r["used_fallback"], r["error"]) for r in out] == [("short", False, None), ("again", False, None)]


def test_answers_are_asked_once(spark):
    asked = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "b")], "system string, prompt string")
    first = models.answered(asked.limit(1), models.EchoClient(lambda s, p: p.upper()))
    both = models.answered(asked, models.EchoClient(lambda s, p: p.upper() + "2"), first)
    assert sorted(r["response"] for r in both.collect()) == ["A", "B2"]


def detect(system, prompt):
    if "bad" in prompt:
        return "no json"
    n = prompt.count("tumor")
    return json.dumps({"diagnoses": [{"cancer_type": f"t{k}", "evidence": "e" * 400} for k in range(n)]})


def test_tumor_fold(spark):
    chunks = spark.createDataFrame([("p", "c1", 0, "tumor"), ("p", "c2", 1, "bad"), ("q", "c3", 0, "nothing")], "patient_id string, chunk_id string, chunk_index int, chunk_text string")
    got = sorted((r["patient_id"], r["cancer_type"], len(r["evidence"]), r["contributing_chunks"]) for r in tumors.detected(chunks, models.EchoClient(detect)).collect())
    assert got == [("p", "t0", 300, "c1"), ("q", "unknown", 0, "")]


class Scripted:
    """Answers in turn; notes every prompt in a file, so that calls in workers can be counted."""

    def __init__(self, folder, *answers):
        self.folder, self.answers = str(folder), answers

    def generate(self, system, prompt):
        import os
        import uuid

        n = len(os.listdir(self.folder))
        with open(f"{self.folder}/{n:04}-{uuid.uuid4().hex}", "w") as f:
            f.write(prompt)
        return self.answers[min(n, len(self.answers) - 1)]


def test_detection_then_coding_takes_one_call_a_chunk_and_one_more(spark, tmp_path):
    chunks = spark.createDataFrame([("p", "c1", 0, "a"), ("p", "c2", 1, "b")], "patient_id string, chunk_id string, chunk_index int, chunk_text string")
    first = json.dumps({"diagnoses": [{"cancer_type": "lung", "primary_site_hint": "upper lobe"}]})
    client = Scripted(tmp_path, first, json.dumps({"diagnoses": [{"cancer_type": "lung", "primary_site_hint": "upper lobe"}, {"cancer_type": "colon"}]}), json.dumps({"coded": [{"primary_site_code": "C341", "histology_code": "8140/3"}, {"primary_site_code": "lung", "histology_code": 81400}]}))
    listed = spark.createDataFrame(tumors.detected(chunks, client).toPandas(), tumors.SCHEMA)
    got = sorted((r["tumor_index"], r["cancer_type"], r["primary_site_code"], r["histology_code"]) for r in tumors.coded(listed, client).collect())
    assert got == [(0, "lung", "C34.1", "8140"), (1, "colon", "", "")]
    asked = [f.read_text() for f in sorted(tmp_path.iterdir())]
    assert len(asked) == 3 and "1. lung; site upper lobe" in asked[2] and "2. colon" in asked[2]


def test_coding_of_nothing_known_and_of_bad_answers(spark, tmp_path):
    found = spark.createDataFrame([("p", 0, "unknown", "", "", "", "", "unknown", ""), ("q", 0, "lung", "x", "", "", "", "left", "c1")], tumors.SCHEMA)
    (tmp_path / "calls").mkdir()
    rows_ = tumors.coded(found, Scripted(tmp_path / "calls", "no object")).collect()
    assert sorted((r["patient_id"], r["primary_site_code"], r["histology_code"]) for r in rows_) == [("p", "", ""), ("q", "", "")]
    assert len(list((tmp_path / "calls").iterdir())) == 1


def test_unreadable_answers_go_back_with_feedback(tmp_path):
    client = Scripted(tmp_path, "not json", "[1, 2]", '```json\n{"a": 1}\n```')
    assert models.called_object(client, "s", "the prompt", attempts=3) == {"a": 1}
    first, second, third = (f.read_text() for f in sorted(tmp_path.iterdir()))
    assert first == "the prompt" and second.startswith("the prompt\n\n") and "not json" in second and "[1, 2]" in third
    with pytest.raises(ValueError):
        models.called_object(models.EchoClient(lambda s, p: "never"), "s", "p", attempts=2)


def test_answers_as_objects(spark):
    asked = spark.createDataFrame([("s", "a"), ("s", "b")], "system string, prompt string")
    client = models.EchoClient(lambda s, p: '[{"k": "é"}]' if p.startswith("a") else "none")
    got = sorted((r["response"] or "", (r["error"] or "")[:15]) for r in models.answered(asked, client, attempts=2, objects=True).collect())
    assert got == [("", "JSONDecodeError"), ('{"k": "é"}', "")]


def test_phases_ask_in_order_and_staging_by_schema(spark, tmp_path):
    at = dictionary_files(tmp_path)
    (tmp_path / "notes.csv").write_text("patient_id,date,text\np1,2024-01-10,breast mass\n")
    (tmp_path / "asked").mkdir()
    extractor = Scripted(tmp_path / "asked", '{"primarySite": {"value": "C50.4", "confidence": 0.95}}')
    run = pipeline.Run(items=dictionary.items(spark, f"{at}/items.csv"), codes=dictionary.codes(spark, f"{at}/codes.csv"), detector=models.EchoClient(detect_one), extractor=extractor, folder=f"{tmp_path}/work", attempts=1)
    pipeline.run(spark, f"{tmp_path}/notes.csv", run)
    order = [f.read_text().split("\n")[0].removeprefix("Phase: ") for f in sorted((tmp_path / "asked").iterdir())]
    assert order == [p for p in pipeline.PHASES if p in order] and order[0] == "demographics"
    units = spark.createDataFrame([("p", 0), ("q", 0)], "patient_id string, tumor_index int")
    state = spark.createDataFrame([("p", 0, 400, "", "C61.9")], "patient_id string, tumor_index int, item int, extracted string, resolved string")
    asked = pipeline.phase_items(units, state, "staging").groupBy("patient_id").agg(F.collect_set("item").alias("i")).collect()
    assert {r["patient_id"]: 3838 in r["i"] for r in asked} == {"p": True, "q": False}


def test_windows_by_bins_equal_windows_by_key(spark):
    rng = random.Random(6)
    day = lambda: dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 900))

    def interval():
        a = day()
        return rng.choice([None, (a, a + dt.timedelta(days=rng.choice([0, 0, 5, 29, 30, 31, 200])))])

    docs = spark.createDataFrame([(k, n, interval()) for k in "abc" for n in range({"a": 120, "b": 40, "c": 3}[k])] * 2, "p string, n int, span struct<lo:date,hi:date>")
    tumors = spark.createDataFrame([(k, n, interval()) for k in "abcd" for n in range(9)], "p string, ti int, window struct<lo:date,hi:date>")
    plain, mixed, bins = (sorted(map(str, matching.in_window(docs, tumors, "p", hot).select("p", "ti", "n").collect())) for hot in (10**6, 50, 0))
    assert plain == mixed == bins and len(plain) > 500
    parts = matching._by_bins(docs, tumors, "p").select("p").rdd.glom().map(len).collect()
    assert max(parts) < sum(parts)


def test_matching_by_rounds_equals_the_fold(spark):
    rng = random.Random(3)
    side = lambda name, n: spark.createDataFrame([(k, i, rng.choice(["", "C50", "C61", "C18"]), rng.choice([None, dt.date(2020, 1, 1) + dt.timedelta(days=rng.randint(0, 60))])) for k in "pqr" for i in range(n)], f"k string, {name} int, site string, day date")
    truth, predicted = side("ti", 14), side("pi", 11)
    fold, rounds = (sorted(rows(matching.greedy_matches(truth, predicted, "k", most)), key=str) for most in (10**6, 1))
    assert fold == rounds and len(fold) == 33
    mixed = matching.greedy_matches(truth, predicted.where("k <> 'p' or pi < 2"), "k", 100)
    assert sorted(rows(mixed.where("k <> 'p'")), key=str) == [r for r in fold if r[0] != "p"] and mixed.where("k = 'p'").count() == 2


def test_matching_of_a_key_with_very_many_pairs(spark):
    day = lambda c: F.date_add(F.lit("2020-01-01").cast("date"), c.cast("int"))
    many = spark.range(600).select(F.lit("p").alias("k"), F.col("id").alias("ti"), F.concat(F.lit("C"), (F.col("id") % 50).cast("string")).alias("site"), day(F.col("id") * 7 % 600).alias("day"))
    other = many.select("k", (F.lit(599) - F.col("ti")).alias("pi"), "site", "day")
    got = matching.greedy_matches(many, other, "k").collect()
    assert len(got) == 600 and all(r["site_match"] and r["days"] == 0 and r["ti"] + r["pi"] == 599 for r in got)


def test_fuzzy_matches_equal_all_pairs(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc ") for _ in range(rng.randint(1, 24)))
    names = [(k % 2, word(), str(k), k) for k in range(60)] + [(0, "é" * 9, "x", 99), (0, "aaaaaaaaaaaa", "y", 100), (1, "", "z", 101)]

    def slipped(t):
        t = list(t)
        for _ in range(rng.randint(0, 3)):
            if t:
                i = rng.randrange(len(t))
                t[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "q"])
        return "".join(t)

    values = [(n[0], slipped(n[1])) for n in names for _ in range(6)] + [(0, None), (None, "abc"), (0, "aaaaaaaaaaa")]
    want = {}
    for item, k in set(values):
        for other, name, code, pos in names:
            if item == other and k and name:
                m, e = max(len(k), len(name)), edits(k, name)
                if 100 * e <= 15 * m:
                    want[item, k] = max(want.get((item, k), (0.0, 0, "")), (100.0 * (m - e) / m, -pos, code))
    got = resolution.fuzzy_matches(spark.createDataFrame(values, "item int, k string"), spark.createDataFrame(names, "item int, name string, code string, pos int"))
    assert {(r["item"], r["k"]): (round(r["likeness"], 6), r["code"]) for r in got.collect()} == {k: (round(v[0], 6), v[2]) for k, v in want.items()} and len(want) > 100


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_one_large_xml_file_is_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(5)
    item = lambda name, value: f'<Item naaccrId="{name}" naaccrNum="1">{value}</Item>'
    body, want = [], []
    for k in range(400):
        if k % 50 == 7:
            body.append("<Patient/>")
            want.append({"head": "h", "tail": "t"})
            continue
        own, n = {"id": str(k), "sex": rng.choice("12")}, rng.randint(0, 3)
        found = [{"site": f"C{rng.randint(10, 80)}", "note": "x &amp; y" * rng.randint(0, 20)} for _ in range(n)]
        body.append("<Patient>\n  " + "".join(item(*x) for x in own.items()) + "".join("\n<Tumor>" + "".join(item(*x) for x in t.items()) + "</Tumor>" for t in found) + "\n</Patient>")
        for t in found or [{}]:
            want.append({"head": "h", "tail": "t"} | own | {a: b.replace("&amp;", "&") for a, b in t.items()})
    (tmp_path / "big.xml").write_text('<?xml version="1.0"?>\n<NaaccrData xmlns="http://naaccr.org/naaccrxml">\n' + item("head", "h") + "\n" + "\n".join(body) + item("tail", "t") + "</NaaccrData>")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        found = registry.read_xml(spark, f"{tmp_path}/big.xml")
        tasks = spark.read.option("lineSep", registry.END).text(f"{tmp_path}/big.xml").rdd.getNumPartitions()
        got = found.orderBy("patient_no", "tumor_no").select("values").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert tasks > 5 and [r["values"] for r in got] == want


def test_first_open_round(spark):
    chunks = spark.createDataFrame([("p", 0, 0), ("p", 0, 1), ("q", 0, 0)], "patient_id string, tumor_index int, chunk_index int")
    answer = lambda done: tuple(pipeline.rounds_done(chunks, done).first())
    assert answer(chunks) == (2, 2) and answer(chunks.limit(0)) == (2, 0) and answer(chunks.where("chunk_index = 0")) == (2, 1)
    assert tuple(pipeline.rounds_done(chunks.limit(0), chunks).first()) == (0, 0)


def test_many_xml_documents_read_back_like_one(spark, tmp_path):
    values = spark.createDataFrame([(f"p{k:02}", 0, 220, str(k % 3)) for k in range(20)] + [(f"p{k:02}", t, 400, f"C{k:02}.{t}") for k in range(20) for t in (0, 1)], "patient_id string, tumor_index int, item int, value string")
    items = spark.createDataFrame([(220, "sex", "Patient"), (400, "primarySite", "Tumor")], "item int, xml_id string, parent_element string")
    sinks.write_xml(values, items, f"{tmp_path}/one")
    sinks.write_xml(values, items, f"{tmp_path}/many", documents=4)
    read = lambda p: sorted(tuple(sorted(r["values"].items())) for r in registry.read_xml(spark, p).collect())
    assert read(f"{tmp_path}/many") == read(f"{tmp_path}/one") and len(read(f"{tmp_path}/one")) == 40
    assert len(list((tmp_path / "many").glob("file=*"))) > 1


def test_export_under_other_column_names(spark, tmp_path):
    (tmp_path / "e.csv").write_text("PAT,DX,SITE\n7,01-JAN-2020,C50\n")
    got = registry.read_export(spark, f"{tmp_path}/e.csv", {"PAT": "mrn", "DX": "date", "SITE": "site", "HIST": "hist"}).first()
    assert (got["mrn"], str(got["day"]), got["site"], got["hist"]) == (7, "2020-01-01", "C50", None)


def extract(system, prompt):
    return json.dumps({"primarySite": {"value": "C50.4", "confidence": 0.95, "evidence": "x"}, "sex": {"value": "Female", "confidence": 0.6, "evidence": "y"}})


def detect_one(system, prompt):
    return json.dumps({"diagnoses": [{"cancer_type": "breast", "approximate_date": "2024-01", "laterality": "left"}]})


def test_pipeline_end_to_end(spark, tmp_path):
    at = dictionary_files(tmp_path)
    (tmp_path / "notes.csv").write_text("patient_id,date,text,mrn\np1,2024-01-10,breast mass,77\np1,2015-01-01,old note,77\n")
    run = pipeline.Run(items=dictionary.items(spark, f"{at}/items.csv"), codes=dictionary.codes(spark, f"{at}/codes.csv"), detector=models.EchoClient(detect_one), extractor=models.EchoClient(extract), folder=f"{tmp_path}/work")
    found = pipeline.run(spark, f"{tmp_path}/notes.csv", run)
    results = {r["item"]: r for r in found["results"].collect()}
    assert results[220]["resolved"] == "2" and results[220]["confidence"] == 0.6
    assert results[2300]["resolved"] == "77" and results[400]["extracted"] == "C50.4"
    assert found["chunks"].where("chunk_text like '%old note%'").count() == 0
    assert found["review"].count() >= 1 and found["summary"].first()["patients"] == 1
    pipeline.write(found, run, f"{tmp_path}/out")
    assert registry.read_xml(spark, f"{tmp_path}/out/registry_xml").first()["values"]["sex"] == "2"
    again = pipeline.run(spark, f"{tmp_path}/notes.csv", run)  # resumes from the rounds it finds
    assert again["results"].count() == found["results"].count()


def test_streams(spark, tmp_path):
    schema = "row_index long, patient_id string, date string, text string"
    spark.createDataFrame([(0, "p", "2020", "one")], schema).write.parquet(f"{tmp_path}/in/a")
    source = lambda: spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
    for _ in range(2):
        streams.compress_stream(source(), models.EchoClient(fail_on_even), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(60)
    spark.createDataFrame([(0, "p", "2020", "one"), (1, "p", "2021", "two")], schema).write.parquet(f"{tmp_path}/in/b")
    streams.compress_stream(source(), models.EchoClient(fail_on_even), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(60)
    assert sorted(r["row_index"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == [0, 1]


def test_running_lists_go_on_from_their_checkpoint(spark, tmp_path):
    schema = "patient_id string, chunk_id string, chunk_index int, chunk_text string"
    chunks = [(f"p{k}", f"p{k}-{n}", n, ("breast" if (k + n) % 3 else "bad") + f" note {n}") for k in range(6) for n in range(5)]

    def listed(system, prompt):
        if "Notes:\nbad" in prompt:
            return "no json"
        n = prompt.count("cancer_type")
        return json.dumps({"diagnoses": [{"cancer_type": f"breast {i}", "evidence": "e" * 400} for i in range(n + 1)]})

    want = sorted(map(tuple, tumors.detected(spark.createDataFrame(chunks, schema), models.EchoClient(listed)).collect()))
    for k, part in enumerate(([c for c in chunks if c[2] < 2], [c for c in chunks if c[2] == 2], [c for c in chunks if c[2] > 2] + chunks[:3])):  # some come again
        spark.createDataFrame(part, schema).write.parquet(f"{tmp_path}/in/{k}")
        arriving = spark.readStream.schema(schema).parquet(f"{tmp_path}/in/*")
        streaming_tumors.running_lists(arriving, models.EchoClient(listed), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    assert sorted(map(tuple, streaming_tumors.latest_lists(spark, f"{tmp_path}/out").collect())) == want
    assert len(list((tmp_path / "out").glob("batch=*"))) == 3 and max(r[1] for r in want) > 1


def test_a_stored_manifest_takes_new_entries_in(spark, tmp_path):
    kinds = "url string, category string, title string, pos int, source_page string"
    first = [("u1", "c1", "t1", 0, "s1"), ("u1", "cx", "tx", 1, "s2"), ("u2", "c2", "t2", 2, "s1")]
    second = [("u2", "cy", "ty", 3, "s3"), ("u2", "cy", "ty", 4, "s1"), ("u3", "c3", "t3", 5, "s2")]
    sampling.upsert_manifest(spark.createDataFrame(first, kinds), f"{tmp_path}/m", 8)
    before = {f"{f.parent.name}/{f.name}": f.stat().st_mtime_ns for f in (tmp_path / "m").glob("part=*/*.parquet")}
    got = sampling.upsert_manifest(spark.createDataFrame(second, kinds), f"{tmp_path}/m", 8)
    want = {("u1", "c1", "t1", ("s1", "s2")), ("u2", "c2", "t2", ("s1", "s3")), ("u3", "c3", "t3", ("s2",))}
    assert {(r["url"], r["category"], r["title"], tuple(r["source_pages"])) for r in got.collect()} == want
    after = {f"{f.parent.name}/{f.name}": f.stat().st_mtime_ns for f in (tmp_path / "m").glob("part=*/*.parquet")}
    assert set(before.items()) & set(after.items())  # folders without new entries stay as they were


def test_the_sample_is_the_smallest_hashes(spark):
    import struct

    import xxhash

    def seeded(seed, *values):  # a long is hashed on its eight bytes, with the last hash as seed
        h = xxhash.xxh64_intdigest(struct.pack("<i", seed), 42)
        for v in values:
            h = xxhash.xxh64_intdigest(struct.pack("<q", v), h)
        return h - (1 << 64) if h >> 63 else h

    keys = [(k % 13, k) for k in range(500)]
    want = sorted(sorted(keys, key=lambda k: (seeded(42, *k), k))[:60])
    df = spark.createDataFrame(keys, "a long, b long").repartition(6)
    assert [tuple(r) for r in sampling.sampled(df, 60, 42, ["a", "b"]).collect()] == want


def test_manifest_addresses_and_titles(spark):
    rows = [(" http://a.org/x y.pdf ", "c", "", 0, "s"), ("http://a.org/x%20y.pdf", "d", "later", 1, "t"), ("", "c", "t", 2, "s"), (None, "c", "t", 3, "s")]
    got = sampling.manifest(spark.createDataFrame(rows, "url string, category string, title string, pos int, source_page string")).collect()
    assert [(r["url"], r["category"], r["title"], r["source_pages"]) for r in got] == [("http://a.org/x%20y.pdf", "c", "x_20y.pdf", ["s", "t"])]


def test_sampling(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    a, b = rows(sampling.sampled(df, 10, 42, ["k"])), rows(sampling.sampled(df.repartition(7), 10, 42, ["k"]))
    assert a == b and len(a) == 10 and a != rows(sampling.sampled(df, 10, 43, ["k"]))
