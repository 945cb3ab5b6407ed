"""Date-window joins and greedy one-to-one matching."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.operators.resolution import small
from carrel.sources.sinks import scratch, written_once

FAR = 10**9
MAX_DAYS = 365
#: pairs of one key that are sorted and folded as one array; larger keys go by rounds
MOST_PAIRS = 100_000


#: documents of one key beyond which its intervals meet in bins of time, and a bin's days
HOT_DOCUMENTS, BIN_DAYS = 100_000, 30
#: parts over which a hot key's documents are dealt for tumors without a window
DEALT = 64


def in_window(docs: DataFrame, tumors: DataFrame, key: str = "patient_id", hot: int = HOT_DOCUMENTS) -> DataFrame:
    """Documents whose interval overlaps the tumor's window; a tumor without a window takes all.

    ``docs``: key, span struct(lo, hi) (null: never in a window); ``tumors``: key, window struct.
    An equi-join on the key with the overlap as its residual condition; keys with more than ``hot``
    documents, which are counted first, meet by bins of time instead.
    """
    large = docs.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > hot)
    large = written_once(large, scratch(docs.sparkSession, "hot"))  # read several times
    if large.isEmpty():
        return _by_key(docs, tumors, key)
    loose = tumors.where("window is null").select(key).distinct().withColumn("loose_", F.lit(True))
    parts = F.least(F.lit(DEALT), F.ceil(F.col("n") / max(hot, 1))).cast("int")
    known = small(large.select(key, parts.alias("parts_")).join(loose, key, "left"))  # few of them meet the documents where those are
    return _by_bins(docs, tumors, key, known)


def _columns(docs: DataFrame, tumors: DataFrame) -> list:
    return [F.col("t.*"), *(F.col(f"d.{c}") for c in docs.columns if c not in tumors.columns)]


def _by_key(docs: DataFrame, tumors: DataFrame, key: str) -> DataFrame:
    d, t = docs.alias("d"), tumors.alias("t")
    overlap = (F.col("d.span.lo") <= F.col("t.window.hi")) & (F.col("d.span.hi") >= F.col("t.window.lo"))
    return d.join(t, (F.col(f"d.{key}") == F.col(f"t.{key}")) & (F.col("t.window").isNull() | overlap)).select(*_columns(docs, tumors))


def _by_bins(docs: DataFrame, tumors: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """The same pairs: rows of the keys in ``known`` (key, parts_, loose_; every key if none is given) are dealt to the bins of time that they touch.

    A pair that shares several bins counts in the first of them only. A tumor without a window goes to
    every part of its key's documents instead, as many as ``parts_``, and documents to a part only where
    there is such a tumor. All other keys have one slot and go the same way.
    """
    marked = lambda rows: rows.select("*", F.lit(DEALT).alias("parts_"), F.lit(True).alias("loose_")) if known is None else rows.join(known, key, "left")
    bin_of = lambda x: F.floor(F.unix_date(F.col(x).cast("date")) / BIN_DAYS)
    slot = lambda kind, n: F.struct(F.lit(kind).alias("kind"), n.cast("bigint").alias("n"))
    none = F.array().cast("array<struct<kind:int,n:bigint>>")
    bins = lambda x: F.coalesce(F.transform(F.sequence(bin_of(f"{x}.lo"), bin_of(f"{x}.hi")), lambda n: slot(1, n)), none)
    bound = lambda rows, name: rows.select(*(c for c in rows.columns if c != name), F.explode(F.array(name)).alias(name))  # noqa: E731  computed once, whatever reads it
    single = F.when(F.col("parts_").isNull(), F.array(slot(0, F.lit(0))))
    part = F.pmod(F.xxhash64(*(F.col(c) for c in docs.columns if c != key)), F.col("parts_"))
    d, t = marked(bound(docs, "span")), marked(bound(tumors, "window"))
    loose = t.where("window is null and parts_ is not null").withColumn("slot_", F.explode(F.transform(F.sequence(F.lit(0), F.col("parts_") - 1), lambda n: slot(2, n))))
    t = t.withColumn("slot_", F.explode(single.when(F.col("window").isNotNull(), bins("window")).otherwise(none)))
    overlap = (F.col("d.span.lo") <= F.col("t.window.hi")) & (F.col("d.span.hi") >= F.col("t.window.lo"))
    once = (F.col("d.slot_.kind") != 1) | (F.col("d.slot_.n") == F.greatest(bin_of("d.span.lo"), bin_of("t.window.lo")))
    same = (F.col(f"d.{key}") == F.col(f"t.{key}")) & (F.col("d.slot_.kind") == F.col("t.slot_.kind")) & (F.col("d.slot_.n") == F.col("t.slot_.n"))
    columns = [*(F.col(f"t.{c}") for c in tumors.columns), *(F.col(f"d.{c}") for c in docs.columns if c not in tumors.columns)]
    met = d.withColumn("slot_", F.explode(single.otherwise(bins("span")))).alias("d").join(t.alias("t"), same & (F.col("t.window").isNull() | overlap) & once).select(*columns)
    dealt = d.where("loose_").withColumn("slot_", slot(2, part)).alias("d")
    return met.union(dealt.join(loose.alias("t"), same).select(*columns))


def _pairs(truth: DataFrame, predicted: DataFrame, key: str) -> DataFrame:
    t, p = truth.alias("t"), predicted.alias("p")
    site = (F.col("t.site") != "") & (F.col("t.site") == F.col("p.site"))
    days = F.abs(F.date_diff("t.day", "p.day"))
    pair = F.struct(F.when(site, 0).otherwise(1).alias("rank"), F.coalesce(days, F.lit(FAR)).alias("gap"), F.col("t.ti").alias("ti"), F.col("p.pi").alias("pi"))
    return t.join(p, F.col(f"t.{key}") == F.col(f"p.{key}")).select(F.col(f"t.{key}").alias(key), pair.alias("pair"))


def folded_matches(pairs: DataFrame, key: str) -> DataFrame:
    """key, m: a key's few pairs sorted and folded, taking a pair while both sides are free."""
    grouped = pairs.groupBy(key).agg(F.array_sort(F.collect_list("pair")).alias("pairs"))
    start = F.slice("pairs", 1, 0)
    taken = F.aggregate("pairs", start, lambda done, x: F.when(F.exists(done, lambda y: (y["ti"] == x["ti"]) | (y["pi"] == x["pi"])), done).otherwise(F.array_append(done, x)))
    return grouped.select(key, F.explode(taken).alias("m"))


def mutual_matches(pairs: DataFrame, key: str, rounds: int = 10_000) -> DataFrame:
    """key, m: the same matches by rounds of mutual best pairs; pairs of a key never meet in one row or task.

    Under a total order of pairs the greedy choice takes exactly the pairs that are the best of both
    sides, then those that become so. Each round is two aggregations and two joins, its rest written.
    """
    spark, best, rest = pairs.sparkSession, [], pairs
    for _ in range(rounds):
        of_t = rest.groupBy(key, "pair.ti").agg(F.min("pair").alias("m")).select(key, "m")
        of_p = rest.groupBy(key, "pair.pi").agg(F.min("pair").alias("m")).select(key, "m")
        folder = scratch(spark, "matches")
        of_t.join(of_p, [key, "m"]).write.parquet(f"{folder}/taken")
        taken = spark.read.schema(of_t.schema).parquet(f"{folder}/taken")
        if taken.isEmpty():
            break
        best.append(taken)
        left = rest.withColumn("ti", F.col("pair.ti")).withColumn("pi", F.col("pair.pi"))
        left = left.join(taken.select(key, "m.ti"), [key, "ti"], "left_anti").join(taken.select(key, "m.pi"), [key, "pi"], "left_anti").select(key, "pair")
        left.write.parquet(f"{folder}/rest")
        rest = spark.read.schema(left.schema).parquet(f"{folder}/rest")
    else:
        raise RuntimeError("the matches did not settle")
    return reduce(DataFrame.union, best, taken)


def greedy_matches(truth: DataFrame, predicted: DataFrame, key: str, most: int = MOST_PAIRS) -> DataFrame:
    """One-to-one matches within each key: site agreement first, then days apart, then order.

    ``truth``: key, ti, site, day; ``predicted``: key, pi, site, day. All pairs of a key (a patient's few
    tumors) are sorted and folded; a key with more than ``most`` of them is matched by rounds instead.
    Result: key, ti, pi, site_match, days (null where a date is missing).
    """
    sizes = truth.groupBy(key).agg(F.count("*").alias("t")).join(predicted.groupBy(key).agg(F.count("*").alias("p")), key)
    large = sizes.where(F.col("t") * F.col("p") > most).select(key)
    if large.isEmpty():
        found = folded_matches(_pairs(truth, predicted, key), key)
    else:
        own = lambda side, how: side.join(large, key, how)
        found = folded_matches(_pairs(own(truth, "left_anti"), own(predicted, "left_anti"), key), key)
        found = found.union(mutual_matches(_pairs(own(truth, "left_semi"), own(predicted, "left_semi"), key), key))
    return found.select(key, "m.ti", "m.pi", (F.col("m.rank") == 0).alias("site_match"), F.when(F.col("m.gap") < FAR, F.col("m.gap")).alias("days"))


def accepted(site_match, days):
    return F.coalesce(site_match | (days <= MAX_DAYS), F.lit(False))
