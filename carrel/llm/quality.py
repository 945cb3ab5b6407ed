"""Quality classifier: an interpolated modified Kneser-Ney model of letters, trained on trusted text.

Texts are read letter by letter, as UTF-16 units, so every letter of every script is told from
every other (those beyond the basic plane are two units); digits of the basic plane are alike, as
is its white space, case and marks are kept, and a word that repeats the word before it is one
sign, which training leaves out and scoring keeps. Four-letter counts of trusted text and
the continuation counts below them give discounted probabilities and back-off weights, order by
order, in tables sharded by context. Documents are dealt over blocks of bounded size, row by row
whatever they hold (repeated rows and null ids too); the distinct four-letter runs of a block join the sharded tables on their hashes, and what comes
back scores the block's documents: perplexity = exp(-mean log probability). A document is
rejected above its language's threshold, which is taken from quantiles of all documents of that
language: median + SPREAD x (upper quartile - median), widened for short texts.

All documents that the labels trust (quality 1 and not toxic) train the model: their ids find the
blocks they are in, and each block counts its own, so no text is exchanged once more. Null and blank texts have no perplexity and
are rejected. A null language is a group of its own. Repeated rows are rows of their own; a null
doc_id is scored like any other. Without any trusted text, probabilities are uniform and nothing
but blank text is rejected. Extra columns are carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import mapped, neutral, only, pieces, restored, returned, table, written

ORDER = 4
BITS = 16
MASK = (1 << BITS) - 1
BLOCK_BYTES = 24 << 20
#: text handled at once within a task: its arrays take some forty times as much
PIECE = 1 << 20
SPREAD = 8.0
LANGUAGES = 10_000
SHORT = 600.0
START, REPEAT = "\x01", "\x02"


def _letter_table() -> np.ndarray:
    codes = np.arange(MASK + 1, dtype=np.int64)
    for point in range(MASK + 1):
        c = chr(point)
        if c.isdigit():
            codes[point] = ord("0")
        elif c.isspace() and c != "\n":
            codes[point] = ord(" ")
    return codes


_LETTERS = _letter_table()


def signed(text: str) -> str:
    """Words equal to the word before them become one sign each."""
    words = text.split(" ")
    return " ".join([w if w != before or not w else REPEAT for w, before in zip(words, [None, *words[:-1]], strict=True)])


def unrepeated(text: str) -> str:
    """The same without those words: the model never learns the sign, so each one costs."""
    words = text.split(" ")
    return " ".join([w for w, before in zip(words, [None, *words[:-1]], strict=True) if w != before or not w])


def runs(texts: list[str], fold=signed) -> tuple[np.ndarray, np.ndarray]:
    """Four-letter codes of all texts in a row, and how many each text has."""
    plain = [fold(t).encode("utf-16-le", "surrogatepass") for t in texts]
    sizes = np.fromiter(map(len, plain), np.int64, len(plain)) // 2
    start = (START * 3).encode("utf-16-le")
    letters = _LETTERS[np.frombuffer(start + start.join(plain), np.uint16)]
    codes = letters[3:].copy()
    for back in (1, 2, 3):
        codes |= letters[3 - back : len(letters) - back] << (BITS * back)
    first = np.cumsum(sizes + 3) - (sizes + 3)  # of each text, in codes
    keep = np.zeros(len(codes) + 4, np.int64)
    np.add.at(keep, first, 1)
    np.add.at(keep, first + sizes, -1)
    return codes[np.cumsum(keep[: len(codes)]) > 0], sizes


def block_runs(dealt: DataFrame, labels: DataFrame) -> DataFrame:
    """block, run, n: the distinct runs of each block's texts (n is null), and those of its trusted texts with their counts.

    ``dealt``: doc_id, text and their block, by which it is partitioned; one pass gives both, so its texts are exchanged once.
    """
    good = only(labels, "doc_id", "quality", "toxic").where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()

    def ids(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("doc_id")], ["block", "doc_id"])

    kind = dealt.schema["doc_id"].dataType.simpleString()
    found = mapped(dealt, ids, f"block int, doc_id {kind}").join(good, "doc_id", "left_semi").distinct()

    def count(texts: pa.Table, own: pa.Table) -> pa.Table:
        wanted = np.zeros(0, np.int64)
        for batch in pieces(texts.select(["text"]).to_batches(), PIECE):
            wanted = np.union1d(wanted, runs([x or "" for x in batch.column("text").to_pylist()])[0])
        known = texts.select(["doc_id", "text"])
        known = known.filter(pc.is_in(known.column("doc_id"), value_set=own.column("doc_id").combine_chunks()))
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in pieces(known.to_batches(), PIECE):
            more, m = np.unique(runs([x or "" for x in batch.column("text").to_pylist()], unrepeated)[0], return_counts=True)
            codes, at = np.unique(np.concatenate([codes, more]), return_inverse=True)
            n = np.bincount(at, weights=np.concatenate([n, m]), minlength=len(codes)).astype(np.int64)
        block = texts.column("block")[0].as_py()
        returned()
        rows = len(wanted) + len(codes)
        return pa.table({"block": pa.array(np.full(rows, block, np.int32)), "run": pa.array(np.concatenate([wanted, codes])), "n": pa.concat_arrays([pa.nulls(len(wanted), pa.int64()), pa.array(n)])})

    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(count, "block int, run long, n long")


def _context(run: Column) -> Column:
    return F.shiftrightunsigned(run, BITS)


def _shorter(run: Column, order: int) -> Column:
    return run.bitwiseAND(F.lit((1 << (BITS * (order - 1))) - 1))


def discounts(ones: int, twos: int, threes: int, fours: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more."""
    if not (ones and twos and threes):
        return 0.5, 0.75, 0.9
    y = ones / (ones + 2 * twos)
    return tuple(min(max(k - (k + 1) * y * more / less, 0.05), k - 0.05) for k, less, more in ((1, ones, twos), (2, twos, threes), (3, threes, fours)))


def kneser_ney(counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For orders ORDER to 1: (run, own) and (context, rest): p = own + rest x p of the shorter run.

    The counts of each order are written, so that no plan holds those of the orders above it again.
    """
    out = []
    for order in range(ORDER, 0, -1):
        sums = counts.agg(*(F.coalesce(F.sum((F.col("n") == k).cast("long")), F.lit(0)) for k in (1, 2, 3, 4))).first()
        d1, d2, d3 = discounts(*sums)
        d = F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)
        by_context = counts.withColumn("context", _context(F.col("run"))).groupBy("context").agg(F.sum("n").alias("total"), F.sum(d).alias("held"))
        own = counts.withColumn("context", _context(F.col("run"))).join(by_context, "context").select("run", ((F.col("n") - d) / F.col("total")).alias("own"))
        out.append((own, by_context.select("context", (F.col("held") / F.col("total")).alias("rest"))))
        if order > 1:
            counts = written(counts.groupBy(_shorter(F.col("run"), order).alias("run")).agg(F.count("*").alias("n")), "shorter")
    return out


def log_probabilities(wanted: DataFrame, model: list[tuple[DataFrame, DataFrame]], letters: int) -> DataFrame:
    """run, logp for every distinct run of ``wanted``, by joins on runs and contexts."""
    found = wanted.select("run").distinct().withColumn("short", F.col("run")).withColumn("p", F.lit(0.0)).withColumn("left", F.lit(1.0))
    for k, (own, rest) in enumerate(model):
        found = (
            found.withColumn("context", _context(F.col("short")))
            .join(own.withColumnRenamed("run", "short"), "short", "left")
            .join(rest, "context", "left")
            .select("run", _shorter(F.col("short"), ORDER - k).alias("short"), (F.col("p") + F.col("left") * F.coalesce("own", F.lit(0.0))).alias("p"), (F.col("left") * F.coalesce("rest", F.lit(1.0))).alias("left"))
        )
    return found.select("run", F.log(F.col("p") + F.col("left") / letters).alias("logp"))


def perplexities(docs: DataFrame, labels: DataFrame, kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``docs`` with n_runs and perplexity.

    The texts are dealt over blocks twice: for their runs (the branches that find trusted texts and
    count take all columns, so that they read one exchange), and to be scored once the model is there.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(12, -(-size // BLOCK_BYTES))
    # a block is a hash of the row's place in its file, which a task that runs again gives again
    dealt = docs.withColumn("block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("int")).repartition(blocks, "block")
    found = written(block_runs(dealt, labels), "runs")
    counts = written(found.where("n is not null").groupBy("run").agg(F.sum("n").alias("n")), "trusted")
    letters = max(2, counts.select(F.col("run").bitwiseAND(F.lit(MASK))).distinct().count() + 1)
    wanted = found.where("n is null").select("block", "run")
    scores = wanted.join(log_probabilities(wanted, kneser_ney(counts), letters), "run").select("block", "run", "logp")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)

    def score(texts: pa.Table, own: pa.Table) -> pa.Table:
        run, logp = own.column("run").to_numpy(), own.column("logp").to_numpy()
        order = np.argsort(run)
        run, logp = run[order], logp[order]
        n, mean = [], []
        for batch in pieces(texts.to_batches(), PIECE):
            codes, sizes = runs([x or "" for x in batch.column("text").to_pylist()])
            values = logp[np.searchsorted(run, codes)] if len(codes) else np.zeros(0)
            total = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=values, minlength=len(sizes))
            n += sizes.tolist()
            mean += [math.exp(-t / s) if s else None for t, s in zip(total.tolist(), sizes.tolist(), strict=True)]
        columns = [texts.column(c) for c in kept]
        returned()
        return pa.Table.from_arrays([*columns, pa.array(n, pa.int64()), pa.array(mean, pa.float64())], [*kept, "n_runs", "perplexity"])

    return dealt.groupBy("block").cogroup(scores.groupBy("block")).applyInArrow(score, f"{kinds}, n_runs long, perplexity double")


def judged(scored: DataFrame, language: str = "lang") -> DataFrame:
    """Add threshold and kept; ``scored`` has n_runs and perplexity and can be read twice alike."""
    group = F.coalesce(F.col(language).cast("string"), F.lit(""))
    own = scored.where("perplexity is not null").groupBy(group.alias("language_group")).agg(F.percentile_approx("perplexity", [0.5, 0.75], 10_000).alias("q"))
    limits = own.select("language_group", F.col("q")[0].alias("middle"), (F.col("q")[1] - F.col("q")[0]).alias("above"))
    limits = written(limits, "limits")
    if limits.count() <= LANGUAGES:  # a row for each language; beyond that the planner decides
        limits = F.broadcast(limits)
    joined = scored.withColumn("language_group", group).join(limits, "language_group", "left")
    # a short text's mean varies more: the margin grows with the root of SHORT over its length
    threshold = F.col("middle") + SPREAD * F.col("above") * F.sqrt(1 + SHORT / F.greatest("n_runs", F.lit(1)))
    return joined.withColumn("threshold", threshold).withColumn("kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))).drop("language_group", "middle", "above")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "lang", "text")
    scored = written(perplexities(docs, table(spark, sf_dir, "labels"), ["doc_id", "lang"]), "perplexity")
    return judged(scored).select("doc_id", "lang", "n_runs", F.round("perplexity", 6).alias("perplexity"), F.round("threshold", 6).alias("threshold"), "kept")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents above their language's perplexity threshold go."""
    plain = neutral(docs, "doc_id", "text", "lang")
    scored = written(perplexities(plain, table(spark, sf_dir, "labels"), plain.columns), "scored")
    return restored(judged(scored).where("kept"), docs, "doc_id", "text", "lang")
