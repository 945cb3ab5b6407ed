"""Registered queries against their SQL over a small generated folder, and the entry module without the training-data part."""

import datetime as dt
import os
import random
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from carrel import catalog
from carrel.synthetic import VALUES

ROOT = Path(__file__).resolve().parents[1]
QUICK = [
    "scan_notes_nonblank", "doc_index", "notes_concat", "chunk_notes", "chunk_dates", "partial_date_interval", "diagnosis_window", "merge_highest_confidence", "high_confidence_skip", "llm_payload_parse",
    "default_fill", "code_resolution_tiers", "schema_selection", "site_normalise", "tnm_normalise", "stage_crosswalk", "biomarker_collapse", "edit_rules_violations", "greedy_match", "field_metrics", "registry_filter", "compress_with_fallback", "notes_loaded", "answered_calls", "text_cleanup", "reasoning_split", "parser_choice", "envelope_text", "usage_numbers","xml_scan", "export_scan", "predictions_scan", "audit_scan", "json_scan", "checkpoint_scan", "tumor_fold", "tumor_codes", "staging_phase_items", "first_open_round", "parser_names", "usage_numbers", "envelope_text", "checkpoint_keys", "confidence_score", "confidence_of_long_results", "review_queue", "window_overlap_join", "keyword_score_topk",
]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("small")
    rng = random.Random(1)
    day = lambda k: dt.datetime(1995, 1, 1) + dt.timedelta(days=k % 2400)
    tables = {
        "documents": ([(k, rng.choice(["", "  ", "some text ", "x"]) * rng.randint(0, 9), f"s{k % 3}") for k in range(40)], "doc_id long, text string, source string"),
        "conversations": ([(k // 6, k % 6, "user", ("stage " if k % 7 == 0 else "") + ("Other c9 " if k % 3 == 0 else "") + "word " * rng.randint(1, 60)) for k in range(60)], "conv_id long, turn long, role string, text string"),
        "customer": ([(k,) for k in range(30)], "c_custkey long"),
        "benchmark": ([(k, " ".join(rng.choice(["word", "Words", "swordfish", "xword9", "leukemia", "other", "stages"]) for _ in range(rng.randint(0, 5)))) for k in range(60)], "item_id long, text string"),
        "lineitem": ([(k % 400, k // 400, k, day(k * 29)) for k in range(1200)], "l_orderkey long, l_linenumber int, l_partkey long, l_shipdate timestamp_ntz"),
        "orders": ([(k, k % 17, rng.choice("FOP"), 1.0, day(k * 37), "1") for k in range(400)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "events": ([(k, k % 7, rng.choice(["click", "view", "error"]), rng.randint(0, 9999) / 100, '{"k": %d}' % (k % 90)) for k in range(300)], "event_id long, user_id long, event_type string, value double, props string"),
    }
    con = duckdb.connect()
    for name, (rows, kinds) in tables.items():
        spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(f"{at}/{name}.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{at}/{name}.parquet/*.parquet'")
    return str(at), con


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, small, name):
    folder, con = small
    found = catalog.QUERIES[name](spark, folder)
    columns = sorted(found.columns)
    result = con.execute(catalog.ORACLES[name])
    theirs = [c[0] for c in result.description]
    assert sorted(theirs) == columns
    show = lambda v: round(v, 6) if isinstance(v, float) else v
    ours = sorted(repr([show(r[c]) for c in columns]) for r in found.collect())
    assert ours == sorted(repr([show(r[theirs.index(c)]) for c in columns]) for r in result.fetchall())


def test_long_results_have_every_item(spark, small):
    """Each order has a row for each of its items, the same by both ways to the scores."""
    folder, _ = small
    rows = lambda name: sorted(map(tuple, catalog.QUERIES[name](spark, folder).collect()))
    found = rows("confidence_of_long_results")
    assert [r[:2] for r in found] == [(rec, item) for rec in range(400) for item in sorted(VALUES)]
    assert found == rows("confidence_score")


def test_manuals_are_searched_to_their_ends(spark, tmp_path):
    """Words behind the first 400,000 characters count, also across that place and within a very long run of letters."""
    run = "".join(random.Random(2).choices("abcdefghij", k=60_000))
    texts = ["filler " * 60_000 + "swordfish", "x " * 199_998 + "lymphnode", "none", run + "lastword", "", "swordfish"]
    asked = ["swordfish lastword", "lymphnode " + run[30_000:30_070], "word", "the of"]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(k, 0, "user", x) for k, x in enumerate(asked)], "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    for name in ("benchmark", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    columns = "query_id", "title", "score", "place"
    found = catalog.QUERIES["keyword_score_topk"](spark, str(tmp_path)).select(*columns)
    assert sorted(map(tuple, found.collect())) == sorted(con.execute(f"SELECT {', '.join(columns)} FROM ({catalog.ORACLES['keyword_score_topk']})").fetchall())


def test_every_sql_has_its_query():
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_entry_imports_without_the_training_part(tmp_path):
    (tmp_path / "carrel").mkdir()
    for p in (ROOT / "carrel").iterdir():
        if p.name != "llm":
            (tmp_path / "carrel" / p.name).symlink_to(p)
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert 'chunk_notes' in q and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=os.environ | {"PYTHONPATH": str(tmp_path)})
