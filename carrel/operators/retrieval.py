"""Keyword retrieval over reference manuals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrel.functions.scalars import manual_text
from carrel.operators.resolution import SMALL, SMALL_BYTES, small

# Words that are no keywords, and the keywords of blood cancers.
STOP_WORDS = ["a", "an", "and", "at", "by", "cancer", "carcinoma", "for", "from", "histology", "in", "malignant", "neoplasm", "of", "primary", "schema", "site", "the", "to", "tumor", "tumour", "unknown", "with"]
BLOOD_WORDS = ["hematopoietic", "heme", "leukemia", "lymphoid", "lymphoma", "myeloma"]
# Order of manual categories.
CATEGORY_RANKS = {"appendix_c": 0, "solid_tumor_rules": 1, "hematopoietic": 1, "staging": 2, "ssdi_grade": 3, "seer_coding_manual": 4}
TOP = 8


def keywords(query: Column, extra: Column | None = None) -> Column:
    """Lower-case words of a query without stop words and short ones, then ``extra``, each once in order."""
    words = F.regexp_extract_all(F.lower(query), F.lit("[a-z0-9]+"), F.lit(0))
    words = F.filter(words, lambda w: ~w.isin(STOP_WORDS))
    if extra is not None:
        words = F.concat(words, extra)
    words = F.when(F.arrays_overlap(words, F.array(*(F.lit(w) for w in BLOOD_WORDS))), F.concat(words, F.array(F.lit("hematopoietic"), F.lit("leukemia"), F.lit("lymphoma")))).otherwise(words)
    return F.filter(F.array_distinct(words), lambda w: (F.length(w) >= 3) | w.startswith("c"))


def category_rank(category: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in CATEGORY_RANKS.items() for x in kv)), category), F.lit(9))


MANUAL = ["category", "title", "path"]


#: characters of a text whose tokens one row gathers; letters of a token whose parts one row gathers, and of a part at most
PIECE, RUN, KEY = 400_000, 256, 64


def _windows(text: Column, size: int, most: Column) -> Column:
    """Parts of a text that begin every ``size`` characters; what has up to ``most`` characters is whole in the one it begins in."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size)), lambda at: F.substring(text, at, F.lit(size) + most - 1))


def word_hits(words: DataFrame, manuals: DataFrame) -> DataFrame:
    """word and manual, with in_head and in_body, wherever a manual's text holds the word, also within longer ones.

    Both sides are lower-case runs of letters and digits, so a word is in a text exactly if it is
    in one of the text's tokens. Whole texts are read in pieces that overlap by the longest word.
    Distinct tokens give their parts as long as some word (of longer words the first KEY letters
    count), parts meet the distinct words in an equi-join, and the hashes of tokens lead back to
    the manuals, where the token itself is asked for the word.
    """
    distinct = words.select("word").distinct()
    lengths = F.broadcast(distinct.agg(F.array_sort(F.collect_set(F.length("word"))).alias("lengths")))
    head = F.concat_ws(" ", "title", "path", "category")
    sides = F.array(*(F.struct(F.lit(side).alias("in_head"), F.lower(x).alias("held")) for side, x in ((True, head), (False, F.col("text")))))
    pieces = manuals.select(*MANUAL, F.inline(sides)).join(lengths).select(*MANUAL, "in_head", F.explode(_windows(F.col("held"), PIECE, F.array_max("lengths"))).alias("piece"))
    index = pieces.select(*MANUAL, "in_head", F.explode(F.array_distinct(F.regexp_extract_all("piece", F.lit("[a-z0-9]+"), F.lit(0)))).alias("token"))
    short = F.array_distinct(F.transform("lengths", lambda n: F.least(n, F.lit(KEY))))
    runs = index.select("token").distinct().join(lengths).select(F.xxhash64("token").alias("id"), short.alias("lengths"), F.explode(_windows(F.col("token"), RUN, F.lit(KEY))).alias("run"))
    cut = F.flatten(F.transform(F.filter("lengths", lambda n: n <= F.length("run")), lambda n: F.transform(F.sequence(F.lit(1), F.length("run") - n + 1), lambda at: F.substring(F.col("run"), at, n))))
    parts = runs.select("id", F.explode(F.array_distinct(cut)).alias("key"))
    met = parts.join(distinct.withColumn("key", F.substring("word", 1, KEY)), "key").select("id", "word")
    found = met.join(index.withColumn("id", F.xxhash64("token")), "id").where(F.contains("token", "word"))
    return found.groupBy("word", *MANUAL).agg(F.max("in_head").alias("in_head"), F.max(~F.col("in_head")).alias("in_body"))


#: hits of queries' words that one task gathers
HITS = 1_000_000


def scores(queries: DataFrame, manuals: DataFrame, top: int = TOP) -> DataFrame:
    """query_id, category, title, path, score of the manuals that can be among a query's ``top`` (query_id, words).

    Those are all that hold one of its words and, of the manuals with a boost that needs no word,
    the first ``top`` by that boost alone: one that holds a word only moves ahead of them. They stand
    in the index under a word for each kind of query, with no weight. The words' hits are counted
    first; queries are dealt so that a task gathers about HITS of them, and stay there.
    """
    boost = lambda blood: F.when(F.col("category") == "appendix_c", 6).when((F.col("category") == "hematopoietic") & blood, 10).when(F.col("category").isin("staging", "ssdi_grade"), 3)
    kind = lambda blood: F.concat(F.lit("blood: "), blood.cast("string"))
    blood = F.arrays_overlap("words", F.array(*(F.lit(w) for w in BLOOD_WORDS)))
    asked = queries.where(F.size("words") > 0).select("query_id", blood.alias("blood"), F.explode(F.concat("words", F.array(kind(blood)))).alias("word"))
    words = queries.select(F.explode("words").alias("word"))
    hits = word_hits(words, manuals).select("word", *MANUAL, (8 * F.col("in_head").cast("int") + F.col("in_body").cast("int")).alias("weight"))
    for flag in (False, True):
        first = manuals.select(*MANUAL, boost(F.lit(flag)).alias("boost")).where("boost is not null").dropDuplicates(MANUAL).orderBy(F.desc("boost"), category_rank(F.col("category")), F.lower("title"), "title", "path").limit(top)
        hits = hits.unionByName(first.select(kind(F.lit(flag)).alias("word"), *MANUAL, F.lit(0).alias("weight")))
    held = hits.groupBy("word").agg(F.count("*").alias("n"), F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size"))
    rows, size, pairs = held.join(asked.groupBy("word").agg(F.count("*").alias("queries")), "word").agg(*(F.coalesce(F.sum(x), F.lit(0)) for x in (F.col("n"), F.col("size"), F.col("n") * F.col("queries")))).first()
    tasks = max(queries.sparkSession.sparkContext.defaultParallelism, -(-pairs // HITS))
    if rows <= SMALL and size <= SMALL_BYTES:
        met = asked.repartition(tasks, "query_id").join(F.broadcast(hits), "word")
    else:
        met = asked.join(hits, "word").repartition(tasks, "query_id")
    based = met.groupBy("query_id", "blood", *MANUAL).agg(F.sum("weight").alias("base"))
    solid = F.when((F.col("category") == "solid_tumor_rules") & (F.col("base") > 0), 2).otherwise(0)
    return based.select("query_id", *MANUAL, (F.col("base") + F.coalesce(boost(F.col("blood")), F.lit(0)) + solid).cast("int").alias("score")).where("score > 0")


def best(scored: DataFrame, top: int = TOP) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), category_rank(F.col("category")), F.lower("title"))
    return scored.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)


def with_texts(found: DataFrame, queries: DataFrame, manuals: DataFrame) -> DataFrame:
    """Add the manuals' texts and the queries' words to best(); the texts are broadcast only if they are few bytes."""
    return found.join(small(manuals.select(*MANUAL, "text")), MANUAL).join(queries.select("query_id", "words"), "query_id")


def snippet(body: Column, words: Column, most: int) -> Column:
    """Up to four windows around the first keyword places, joined by [...], at most ``most`` characters."""
    clean = manual_text(body)
    size = max(800, most // 3)
    places = F.slice(F.array_sort(F.filter(F.transform(words, lambda w: F.instr(F.lower(clean), w)), lambda p: p > 0)), 1, 4)
    opened = F.aggregate(places, F.array().cast("array<int>"), lambda done, p: F.when((F.size(done) > 0) & (p < F.element_at(done, -1) + size), done).otherwise(F.array_append(done, F.greatest(F.lit(1), p - size // 2))))
    cut = F.array_join(F.transform(opened, lambda p: F.trim(F.substring(clean, p, F.lit(size)))), "\n[...]\n")
    return F.substring(F.when(F.length(clean) <= most, clean).when(F.size(places) == 0, F.substring(clean, 1, most)).otherwise(cut), 1, most)


def context_blocks(found: DataFrame, most: int, each: int = 2400, least: int = 800, reserve: int = 250) -> DataFrame:
    """query_id, context: title and snippet of each manual in order while the budget lasts."""
    block = F.struct("place", F.concat(F.lit("## "), F.col("title"), F.lit("\n"), snippet(F.col("text"), F.col("words"), each)).alias("b"))
    ordered = found.groupBy("query_id").agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    start = F.struct(F.lit(most).alias("left"), F.array().cast("array<string>").alias("out"))

    def add(state, x):
        take = F.substring(x["b"], F.lit(1), F.least(F.lit(each), state["left"] - reserve))
        return F.when(state["left"] < least, state).otherwise(F.struct((state["left"] - F.length(take)).alias("left"), F.array_append(state["out"], take).alias("out")))

    return ordered.select("query_id", F.array_join(F.aggregate("blocks", start, add)["out"], "\n\n").alias("context"))
