"""I-Match document fingerprints from randomised lexicons, with DataFrame functions only.

Terms are the runs of letters and digits of the lower-cased text; the lexicon holds those whose document
frequency lies in a band (LEAST_SHARE to MOST_SHARE of the documents, two at least), that is a band of
inverse document frequency. A text's distinct lexicon terms are sorted by their hashes; each of a series of
random subsets of the lexicon hashes those it holds. Level l deals one term in 4**l over SUBSETS disjoint
subsets, and a fingerprint holds LEVELS levels from the first on at which at most TERMS terms are dealt, so
that subsets hold one or a few terms whatever a text's length. A text with fewer than BAND_TERMS terms of
the lexicon there is known by all its terms. Likeness is the share of equal hashes among the subsets that
hold a term of either text, at the sparsest common level with INFORMED of them (else the densest).

The lexicon has at most (mean distinct terms of a document) / LEAST_SHARE entries, however many documents
there are; it is broadcast if its counted size allows and joined by shuffle otherwise. A document's terms
are exploded and gathered again inside the partition its text is in, without another exchange.

Null text counts as empty. The next document is the next larger doc_id (nulls first, then by a hash of the
text); of c equal rows, c - 1 have an equal row as their next one. Two texts without any term are alike
only if they are equal. An empty table gives an empty table; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.llm.common import dropped, only, small, table, written

LEAST_SHARE, MOST_SHARE = 0.0005, 0.1
SUBSETS, LEVELS, TERMS = 32, 3, 128
BAND_TERMS, INFORMED = 4, 16
KEY = ["known", "id", "text_key"]


def term_hashes(text: Column) -> Column:
    """The distinct terms of a text as 64-bit hashes, in order of first occurrence."""
    return F.array_distinct(F.array_remove(F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: F.xxhash64(w)), F.xxhash64(F.lit(""))))


def lexicon(docs: DataFrame) -> DataFrame:
    """term (hash) of every term in the band; written."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.count()
    counts = texts.select(F.explode(term_hashes(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    return written(counts.where((F.col("df") >= max(2.0, LEAST_SHARE * rows)) & (F.col("df") <= max(2.0, MOST_SHARE * rows))).select("term"), "lexicon")


def level_of(size: Column) -> Column:
    """The first level that deals at most TERMS of so many terms."""
    over = F.floor((size - 1) / TERMS)
    return F.when(over <= 0, F.lit(0)).otherwise(F.floor((F.length(F.bin(over)) + 1) / 2).cast("int"))


def dealt(term: Column, level: Column) -> Column:
    """Whether a level deals a term; the bits above those that name the subset decide."""
    return F.shiftrightunsigned(term, SUBSETS.bit_length() - 1).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), 2 * level) - 1) == 0


def of_level(terms: str, level: Column) -> Column:
    return F.filter(terms, lambda t: dealt(t, level))


def of_subset(terms: str, subset: int) -> Column:
    return F.filter(terms, lambda t: t.bitwiseAND(F.lit(SUBSETS - 1)) == subset)


def tagged(terms: str, of: int) -> Column:
    return F.transform(terms, lambda t: F.struct(F.lit(of).alias("of"), t.alias("term")))


def tagged_with(found: str, of: int) -> Column:
    return F.filter(found, lambda x: x["of"] == of)


def sampled(df: DataFrame, texts: list[str]) -> DataFrame:
    """For each text column c: c_level, c_terms (the terms that this level deals), c_whole (a hash of all terms, of a text without any)."""
    others = [c for c in df.columns if c not in texts]
    all_terms = df.select(*others, *texts, *(term_hashes(F.col(c)).alias(f"{c}_all") for c in texts))
    levels = all_terms.select("*", *(level_of(F.size(f"{c}_all")).alias(f"{c}_level") for c in texts))
    out = list(map(F.col, others))
    for c in texts:
        out.append(F.col(f"{c}_level"))
        out.append(of_level(f"{c}_all", F.col(f"{c}_level")).alias(f"{c}_terms"))
        out.append(F.when(F.size(f"{c}_all") > 0, F.xxhash64(F.array_sort(f"{c}_all"))).otherwise(F.xxhash64(F.col(c))).alias(f"{c}_whole"))
    return levels.select(*out)


def hashed(terms: Column) -> Column:
    return F.when(F.size(terms) > 0, (F.xxhash64(F.array_sort(terms)).bitwiseAND(F.lit(0xFFFF)) - 32768).cast("smallint"))


def fingerprinted(df: DataFrame, texts: list[str]) -> DataFrame:
    """For each text c a struct c_print (level, whole, hashes) in place of c_level, c_whole and c_terms; a null c_terms gives null."""
    keep = [x for x in df.columns if x not in {f"{c}_{part}" for c in texts for part in ("level", "whole", "terms")}]
    by_level = df.select(*keep, *(F.col(f"{c}_{part}") for c in texts for part in ("level", "whole")), *(of_level(f"{c}_terms", F.col(f"{c}_level") + k).alias(f"{c}_{k}") for c in texts for k in range(LEVELS)))
    prints = []
    for c in texts:
        hashes = F.array(*(hashed(of_subset(f"{c}_{k}", s)) for k in range(LEVELS) for s in range(SUBSETS)))
        prints.append(F.when(F.col(f"{c}_0").isNotNull(), F.struct(F.col(f"{c}_level").alias("level"), F.col(f"{c}_whole").alias("whole"), hashes.alias("hashes"))).alias(f"{c}_print"))
    return by_level.select(*keep, *prints)


def shown(one: Column) -> Column:
    """A fingerprint as text: its first level, its hashes (a dot for a subset without a term) and the hash of the whole."""
    hashes = F.array_join(F.transform(one["hashes"], lambda h: F.coalesce(F.lower(F.lpad(F.hex(h.cast("int") + 32768), 4, "0")), F.lit("."))), "")
    return F.concat_ws("-", one["level"], hashes, F.lower(F.lpad(F.hex(one["whole"]), 16, "0")))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes at the sparsest common level with INFORMED subsets in use; 1 or 0 by the whole where no subset is."""

    def at(k: int) -> Column:
        there = a["level"] + k - b["level"]
        both = F.arrays_zip(F.slice(a["hashes"], SUBSETS * k + 1, SUBSETS).alias("x"), F.slice(b["hashes"], SUBSETS * there + 1, SUBSETS).alias("y"))
        used = F.filter(both, lambda p: p["x"].isNotNull() | p["y"].isNotNull())
        return F.when((there >= 0) & (there < LEVELS), F.struct(F.size(used).alias("used"), F.size(F.filter(used, lambda p: p["x"] == p["y"])).alias("equal")))

    levels = F.filter(F.array(*(at(k) for k in reversed(range(LEVELS)))), lambda v: v.isNotNull())
    best = F.coalesce(F.get(F.filter(levels, lambda v: v["used"] >= INFORMED), F.lit(0)), F.get(levels, F.size(levels) - 1))
    return F.when(best["used"] > 0, best["equal"] / best["used"]).otherwise((a["whole"] == b["whole"]).cast("double"))


def keyed(docs: DataFrame) -> DataFrame:
    """text, and a key that orders documents: known (0 where the id is null), id, text_key."""
    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.select(F.col("id").isNotNull().cast("int").alias("known"), F.coalesce("id", F.lit(0).cast("long")).alias("id"), F.xxhash64("text").alias("text_key"), "text")


def steps(docs: DataFrame) -> DataFrame:
    """For every key the one before it (the last before the first), that one's length and number of copies; written.

    Keys are sorted over ranges; a row's number within its range tells its neighbour, and the ends of the
    ranges, one row each, tell those across.
    """
    keys = keyed(docs).groupBy(*KEY).agg(F.first(F.length("text")).alias("n"), F.count("*").alias("copies"))
    ordered = written(keys.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("at", F.monotonically_increasing_id()), "order")
    part = F.shiftrightunsigned("at", 33)
    ends = ordered.groupBy(part.alias("part")).agg(F.min("at").alias("first"), F.max("at").alias("last"))
    along = Window.orderBy("part")
    ends = ends.select("last", F.coalesce(F.lead("first").over(along), F.min("first").over(along)).alias("over"))
    linked = ordered.join(small(ends), ordered["at"] == ends["last"], "left").select(*(F.col(c).alias(f"before_{c}") for c in KEY), F.col("n").alias("before_n"), F.col("copies").alias("before_copies"), F.coalesce("over", F.col("at") + 1).alias("at"))
    out = written(ordered.join(linked, "at").select(*KEY, *(f"before_{c}" for c in KEY), "before_n", "before_copies"), "steps")
    dropped(ordered)
    return out


def paired(docs: DataFrame, order: DataFrame) -> DataFrame:
    """Every distinct (id, text) with its number of copies and its successor's head; texts are exchanged once."""
    texts = keyed(docs).groupBy(*KEY).agg(F.first("text").alias("text"))
    known = texts.join(order, KEY)
    heads = known.select(*(F.col(f"before_{c}").alias(c) for c in KEY), F.col("before_copies").alias("copies"), F.expr("left(text, cast(before_n div 2 as int))").alias("head"))
    return texts.join(heads, KEY)


def with_edited(docs: DataFrame, order: DataFrame) -> DataFrame:
    """The key, copies, n_chars and the prints of each text, its edited text and (for copies) the text edited by itself."""
    kept, half = "left(text, cast(length(text) - length(text) div 2 as int))", "cast(length(text) div 2 as int)"
    rows = paired(docs, order).select(*KEY, "copies", "text", F.expr(f"concat({kept}, head)").alias("edited"), F.expr(f"if(copies > 1, concat({kept}, left(text, {half})), null)").alias("doubled"))
    names = ["text", "edited", "doubled"]
    rows = rows.select("*", F.length("text").alias("n_chars"), *(F.sha2(c, 256).alias(f"{c}_sha256") for c in names[1:]))
    drawn = sampled(rows, names)
    own = [c for c in drawn.columns if c not in KEY and not c.endswith("_terms")]
    spread = drawn.select(*KEY, F.struct(*own).alias("own"), F.explode_outer(F.concat(*(F.coalesce(tagged(f"{c}_terms", k), F.array().cast("array<struct<of:int,term:bigint>>")) for k, c in enumerate(names)))).alias("x"))
    words = lexicon(docs)
    marked = spread.select(*KEY, "own", "x.of", "x.term").join(small(words.withColumn("listed", F.lit(True))), "term", "left")
    gathered = marked.groupBy(*KEY).agg(F.first("own").alias("own"), F.collect_list(F.struct("of", "term", "listed")).alias("found"))
    for k, c in enumerate(names):
        gathered = gathered.withColumn(f"{c}_every", tagged_with("found", k))
    gathered = gathered.select(*KEY, "own.*", *(f"{c}_every" for c in names)).select("*", *(F.filter(f"{c}_every", lambda x: x["listed"]).alias(f"{c}_band") for c in names))
    terms = [F.transform(F.when(F.size(f"{c}_band") >= BAND_TERMS, F.col(f"{c}_band")).otherwise(F.col(f"{c}_every")), lambda x: x["term"]).alias(f"{c}_terms") for c in names]
    gathered = gathered.select(*(c for c in gathered.columns if not c.endswith(("_every", "_band"))), *terms)
    return fingerprinted(gathered, names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next: one row for each row of ``docs``."""
    order = steps(docs)
    prints = written(with_edited(docs, order), "prints")
    after = prints.join(order, KEY).select(*(F.col(f"before_{c}").alias(c) for c in KEY), F.col("text_print").alias("next_print"))
    rows = prints.join(after, KEY)
    single = F.struct(F.col("edited_sha256").alias("sha"), F.col("edited_print").alias("print"), F.col("next_print").alias("next"))
    double = F.struct(F.col("doubled_sha256").alias("sha"), F.col("doubled_print").alias("print"), F.col("text_print").alias("next"))
    every = F.concat(F.array(single), F.when(F.col("copies") > 1, F.array_repeat(double, (F.col("copies") - 1).cast("int"))).otherwise(F.slice(F.array(single), 1, 0)))
    rows = rows.select(F.when(F.col("known") == 1, F.col("id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "text_print", F.explode(every).alias("v"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.col("v.sha").alias("edited_sha256"),
        shown(F.col("text_print")).alias("fingerprint"),
        shown(F.col("v.print")).alias("edited_fingerprint"),
        likeness(F.col("text_print"), F.col("v.print")).alias("near_edited"),
        likeness(F.col("text_print"), F.col("v.next")).alias("near_next"),
    )


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
