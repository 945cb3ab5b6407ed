"""The stages against their operators' own queries, stage by stage."""

import itertools
import time
from collections import Counter
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from carrel.llm import catalog, quality, sentences, suffixes
from carrel.llm.common import neutral, restored, table, written

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


def as_rows(df):
    return Counter(tuple(r[c] for c in NAMES) for r in df.collect())


def folder_of(spark, df, labels, at):
    df.write.parquet(f"{at}/documents.parquet")
    labels.write.parquet(f"{at}/labels.parquet")
    return str(at)


def firsts(rows):
    """Smallest ids of the groups of texts with a five-word Jaccard similarity of 0.8 or more, by all pairs."""
    sets = {}
    for i, text, *_ in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    up = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            x, y = sorted((up[a], up[b]))
            up = {i: x if r == y else r for i, r in up.items()}
    return set(up.values())


def test_stages_do_what_their_queries_say(spark, folder, tmp_path):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = table(spark, folder, "documents")
    columns = docs.columns
    wanted = ["op3_", "op10_", "op2_", "op9_", "op6_"]
    assert len(corpus_pipeline.STAGES) == 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        here = folder_of(spark, docs, labels, tmp_path / f"in{k}")
        docs = spark.read.parquet(f"{here}/documents.parquet")
        query = next(q for q in catalog.QUERIES if q.startswith(wanted[k]))
        said = [r.asDict() for r in catalog.QUERIES[query](spark, here).collect()]
        out = stage(spark, docs, here)
        before = as_rows(docs)
        if k < 4:
            assert out.columns == columns
        if k == 0:
            good = {r["doc_id"] for r in said if r["kept"]}
            assert as_rows(out) == Counter({r: n for r, n in before.items() if r[0] in good})
        elif k == 1:
            wrong = {r["doc_id"] for r in said if r["lang_pred"] == "und"}
            assert all(n == as_rows(out)[r] for r, n in before.items() if r[0] not in wrong and (r[2] is None or r[2] == next(x["lang_pred"] for x in said if x["doc_id"] == r[0])))
            assert not any(r[0] in wrong for r in as_rows(out))
        elif k == 2:
            assert as_rows(out) == Counter({r: n for r, n in before.items() if r[0] in firsts(before)})
        elif k == 3:
            removed = {r["doc_id"]: r["removed_chars"] for r in said}
            left = as_rows(out)
            assert {r for r in before if not removed[r[0]]} <= set(left)
            assert all(r[4] == len(r[1] or "") for r in left if removed[r[0]])
        else:
            got = Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in out.collect())
            assert got == Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in said)
            break
        docs = out


def test_run_gives_packed_pieces(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    rows = found.collect()
    assert rows and max(r["offset"] + r["length"] for r in rows) <= 1024
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in table(spark, folder, "documents").select("doc_id").collect()}


def test_empty_documents(spark, empty_folder):
    assert corpus_pipeline.run(spark, empty_folder).count() == 0


def test_null_ids_stay(spark):
    docs = spark.createDataFrame([(None, "x" * 300), (None, "x" * 300), (1, "x" * 300)], "doc_id long, text string")
    kept = {(r["doc_id"], r["n_removed"]) for r in suffixes.kept(docs).collect()}
    assert kept == {(None, 0), (1, 299)}  # every 100 bytes but the first start later
    left = sentences.without_repeats(docs)
    assert left.count() == 3 and left.where("removed_chars > 0").count() == 0


def test_clashing_names_come_back(spark):
    df = spark.createDataFrame([(1, "a", "b", 2)], "doc_id long, text string, TEXT string, block int")
    back = restored(neutral(df, "doc_id", "text"), df, "doc_id", "text")
    assert back.columns == df.columns and back.first() == df.first()


def test_model_of_an_order_does_not_hold_the_orders_above(spark):
    counts = spark.range(200).select((F.col("id") * 7919 * 65537).alias("run"), (F.col("id") % 5 + 1).alias("n"))
    for own, rest in quality.kneser_ney(counts)[1:]:
        for part, most in ((rest, 2), (own, 2)):
            assert part._jdf.queryExecution().executedPlan().toString().count("HashAggregate") <= most


def test_quality_exchanges_its_texts_twice(spark, folder, monkeypatch):
    """Each written table is a job with shuffles of its own: one for the runs, one for the scores."""
    texts = []
    monkeypatch.setattr(quality, "written", lambda df, name: (texts.append("hashpartitioning(block" in (plan := df._jdf.queryExecution().executedPlan().toString()) and "text#" in plan), written(df, name))[1])
    catalog.QUERIES["op3_quality_classifier"](spark, folder).collect()
    assert sum(texts) == 2


def test_shuffle_files_go_once_a_table_is_written(spark):
    disk = Path(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()[0])
    left = lambda: {f.name for f in disk.rglob("shuffle_*.data")}
    before = left()
    kept = written(spark.range(50_000).repartition(7, F.col("id") % 1000), "rows")
    for _ in range(50):
        if left() <= before:
            break
        time.sleep(0.1)
    assert left() <= before and kept.count() == 50_000
