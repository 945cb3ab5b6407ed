"""Steps whose tasks stay bounded as tables grow."""

import random

from pyspark.sql import functions as F

from carrel.operators import confidence, matching, prompts, retrieval, rules
from carrel.sources import notes, registry, sinks
from carrel.synthetic import pick, picked


def test_records_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(rules, "RECORDS", 100)
    dealt = rules.spread(spark.range(2000), ["id"])
    assert dealt.rdd.getNumPartitions() == 20
    assert sorted(r["id"] for r in dealt.collect()) == list(range(2000))
    # what groups by the key needs no second exchange
    plan = dealt.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_picked_values_are_those_of_the_sql(spark):
    keys = spark.range(-50, 50).union(spark.sql("SELECT CAST(NULL AS bigint)"))
    values = ["a", "", "b", "c"]
    assert keys.where(~picked("id", 5, values).eqNullSafe(F.expr(pick("id", 5, values)))).isEmpty()


def test_csv_files_have_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "CSV_ROWS", 20)
    rows = spark.range(50).coalesce(1).select(F.col("id").cast("string").alias("id"), F.lit('a "b",\n c').alias("text"))
    path = f"{tmp_path}/out.csv"
    sinks.write_csv(rows, path)
    found = notes.read_table(spark, path)
    each = [r["n"] for r in found.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert sorted(each) == [10, 20, 20]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, rows.collect()))


def test_prior_state_groups_without_a_join(spark):
    results = spark.createDataFrame([(1, 400, "C50", "", 0.5, "site"), (None, 400, "C18", "", 0.5, "site"), (3, 400, "C61", "", 0.5, "site"), (4, 400, "C61", "", 0.0, "site")], "k int, item int, extracted string, resolved string, confidence double, name string")
    units = spark.createDataFrame([(1,), (1,), (None,), (4,)], "k int")
    found = prompts.prior_state(results, units, ["k"])
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    prior = {r["k"]: r["prior"] for r in found.collect()}
    assert set(prior) == {1, None, 4}
    assert prior[1].endswith("\n- site (item 400): C50 (confidence 0.50)")
    assert prior[None] == prior[4] == prompts.NO_STATE


def test_windows_of_hot_and_other_keys_go_one_way(spark):
    day = lambda n: F.date_add(F.lit("2020-01-01").cast("date"), n.cast("int"))
    span = F.struct(day(F.col("id") * 5).alias("lo"), day(F.col("id") * 5 + F.col("id") % 70).alias("hi"))
    docs = spark.range(120).select((F.sqrt("id").cast("int")).alias("p"), F.col("id").alias("doc"), F.when(F.col("id") % 9 > 0, span).alias("span"))
    docs = docs.union(spark.sql("SELECT CAST(NULL AS int), 500L, CAST(NULL AS struct<lo:date,hi:date>)"))
    window = F.struct(day(F.col("id") * 9 - 30).alias("lo"), day(F.col("id") * 9 + 60).alias("hi"))
    tumors = spark.range(60).select((F.col("id") % 15).cast("int").alias("p"), F.col("id").alias("tumor"), F.when(F.col("id") % 4 > 0, window).alias("window"))
    pairs = lambda df: sorted((r["p"], r["tumor"], r["doc"]) for r in df.collect())
    wanted = pairs(matching._by_key(docs, tumors, "p"))
    for hot in (0, 3, 10):
        found = matching.in_window(docs, tumors, "p", hot)
        assert pairs(found) == wanted
        assert "LeftAnti" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_rules_write_messages_for_those_who_ask(spark):
    """Rules are numbers until they are asked for more; evaluated by a higher-order function, no code was generated for them."""
    records = spark.range(3).select(F.col("id").alias("rec"), *(F.col("id").cast("string").alias(f"v{i}") for i in rules.referenced_items()))
    found = rules.violations(records, ["rec"])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "format_string" in plan(found)
    worst = plan(confidence.worst_severities(found, ["rec"]))
    assert "format_string" not in worst and "lambda" not in worst


def test_xml_documents_have_bounded_values(spark, tmp_path, monkeypatch):
    """More documents than asked for, not larger ones; a patient's rows meet in one exchange, and a scan deals its patients over as many tasks as read them."""
    values = spark.createDataFrame([(p, t, i, f"{p}.{t}.{i}" if (p + t) % 3 else " " * (p % 2)) for p in range(60) for t in range(1 + p % 4) for i in (1, 2, 3, 4)], "patient_id int, tumor_index int, item int, value string")
    values = values.union(spark.sql("SELECT 61, CAST(NULL AS int), 3, 'x' UNION ALL SELECT 62, 0, 9, 'unknown item' UNION ALL SELECT 62, 0, 3, CAST(NULL AS string)"))
    items = spark.createDataFrame([(1, "head", "NaaccrData"), (2, "own", "Patient"), (3, "a", "Tumor"), (4, "b", "Tumor")], "item int, xml_id string, parent_element string")
    read = lambda path: sorted(tuple(sorted(r["values"].items())) for r in registry.read_xml(spark, path).collect())
    sinks.write_xml(values, items, f"{tmp_path}/one")
    wanted = read(f"{tmp_path}/one")
    rows = {(p, t): {k: f"{p}.{t}.{i}" for i, k in ((3, "a"), (4, "b")) if (p + t) % 3} | ({"own": f"{p}.0.2"} if p % 3 else {}) for p in range(60) for t in range(1 + p % 4)}
    blank = {(p, t): {k: " " for k in ("a", "b")} for p, t in rows if p % 2 and (p + t) % 3 == 0}
    owned = {(p, t): {"own": " "} for p, t in rows if p % 2 and p % 3 == 0}
    odd = lambda k: rows[k] | blank.get(k, {}) | owned.get(k, {})
    strip = lambda found: sorted(tuple((k, v.strip()) for k, v in r if k != "head" and v.strip()) for r in found)
    assert strip(wanted) == strip([tuple(sorted(odd(k).items())) for k in rows] + [(), ()])
    monkeypatch.setattr(sinks, "XML_VALUES", 50)
    sinks.write_xml(values, items, f"{tmp_path}/many", documents=2)
    assert read(f"{tmp_path}/many") == wanted
    files = list((tmp_path / "many").glob("file=*/*.txt"))
    assert len(files) > 6 and max(f.read_text().count("<Item") for f in files) < 200
    assert all(f.read_text().startswith("<?xml") and f.read_text().endswith("</NaaccrData>\n") for f in files)
    plan = sinks._patients(values, items, "patient_id", "tumor_index", 9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "REPARTITION_BY_NUM" in registry.read_xml(spark, f"{tmp_path}/many")._jdf.queryExecution().executedPlan().toString()


def test_queries_are_dealt_by_their_hits(spark, monkeypatch):
    """Tasks follow the number of hits, and a query's hits are summed and ranked where its words are; both ways to join give what every word in every text gives."""
    words = ["stage", "lung", "leukemia", "c1", "ung", "none"]
    texts = ["lung stage", "leukemia ung", "xlungx", "stages c12", ""]
    kinds = ["appendix_c", "staging", "solid_tumor_rules", "hematopoietic", "other"]
    manuals = spark.createDataFrame([(kinds[k % 5], f"t{k:02}", "manual", texts[k % 4]) for k in range(40)], "category string, title string, path string, text string")
    asked = {q: [w for k, w in enumerate(words) if q >> k & 1] for q in range(64)}
    queries = spark.createDataFrame(list(asked.items()), "query_id int, words array<string>").union(spark.sql("SELECT 99, CAST(NULL AS array<string>)"))

    def score(ws, kind, title, text):
        base = sum(8 * (w in f"{title} manual {kind}") + (w in text) for w in ws)
        return base + {"appendix_c": 6, "staging": 3, "hematopoietic": 10 * ("leukemia" in ws), "solid_tumor_rules": 2 * (base > 0)}.get(kind, 0)

    wanted = {}
    for q, ws in asked.items():
        ranked = sorted(((-score(ws, *(kind := kinds[k % 5], title := f"t{k:02}", texts[k % 4])), retrieval.CATEGORY_RANKS.get(kind, 9), title) for k in range(40)) if ws else [])
        wanted[q] = [(t, -s) for s, _, t in ranked[:8] if s < 0]
    for hits, most in ((10**6, 10**6), (20, 10**6), (20, 0)):
        monkeypatch.setattr(retrieval, "HITS", hits)
        monkeypatch.setattr(retrieval, "SMALL", most)
        best = retrieval.best(retrieval.scores(queries, manuals))
        found = {q: [] for q in asked}
        for r in best.orderBy("query_id", "place").collect():
            found[r["query_id"]].append((r["title"], r["score"]))
        assert found == wanted
        plan = best._jdf.queryExecution().executedPlan().toString()
        assert (best.rdd.getNumPartitions() > 40) == (hits == 20)
        assert plan.count("hashpartitioning(query_id") == 1


def test_words_are_found_across_pieces(spark, monkeypatch):
    """Texts and tokens are cut into overlapping parts; what they hold is what the whole text holds."""
    rng = random.Random(4)
    texts = ["".join(rng.choices("aab1 -É", k=n)) for n in (0, 1, 6, 7, 8, 40, 41, 90, 200) for _ in range(3)] + [None]
    words = sorted({"".join(rng.choices("aab1", k=n)) for n in (1, 2, 3, 4, 5, 9) for _ in range(12)})
    manuals = spark.createDataFrame([("b-aab", f"t{k:02}", "1", x) for k, x in enumerate(texts)], "category string, title string, path string, text string")
    wanted = {(w, f"t{k:02}", head, body) for k, x in enumerate(texts) for w in words if (head := w in f"t{k:02} 1 b-aab") | (body := w in (x or "").lower())}
    for piece, run, key in ((7, 5, 3), (1, 1, 1), (400_000, 256, 64)):
        for name, value in (("PIECE", piece), ("RUN", run), ("KEY", key)):
            monkeypatch.setattr(retrieval, name, value)
        found = retrieval.word_hits(spark.createDataFrame([(w,) for w in words], "word string"), manuals)
        assert {(r["word"], r["title"], r["in_head"], r["in_body"]) for r in found.collect()} == wanted
