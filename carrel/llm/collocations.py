"""Phrase collocation mining: counted n-grams, cut scores, maximal phrases, one ranking a language.

A text (A-Z lower-cased) is split at ``. , ; : ! ?`` and line breaks into pieces and those at spaces and
tabs into words. N-grams are exploded into rows and hash-aggregated per language, shortest first: pairs
only of words, and longer n-grams only of pairs, that reach the smallest count. A phrase is never more
frequent than a part of it, so nothing that is left out could be a candidate or a part of one; rows to be
shuffled stay a fraction of all n-grams (on 0.1 GB of documents 49 million n-grams differ, of which
46,000 reach a count of 100). The frequent words or pairs meet the positions by a broadcast while their
counted rows and bytes are small, by a shuffled join beyond.

Null text counts as empty, a null language as ``und``; repeated rows are documents of their own. An
empty table gives an empty table; extra columns are left out.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.llm.common import dropped, only, small, table, written

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
#: a candidate goes if a longer one has at least so many hundredths of its count
COVER = 100


def pieces_of(docs: DataFrame) -> DataFrame:
    """lang, words (array, at least one): every piece of every text."""
    text = F.replace(F.col("text").cast("string"), F.lit("\t"), F.lit(" "))
    split = only(docs, "text", "lang").where("text <> ''").select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.explode(F.split(text, r"[.,;:!?\x0A-\x0D]")).alias("piece"))
    plain = F.octet_length("piece") == F.length("piece")  # of other letters only A-Z may change
    lowered = F.when(plain, F.lower("piece")).otherwise(F.translate("piece", string.ascii_uppercase, string.ascii_lowercase))
    # a split at one plain letter needs no pattern for each piece; exploded, it is done once, whatever reads the words
    return split.select("lang", F.explode(F.array(F.array_remove(F.split(lowered, " "), ""))).alias("words")).where(F.size("words") > 0)


def windows(pieces: DataFrame, width: int) -> DataFrame:
    """lang, w1 .. w<width>: one row for each word with those behind it; null beyond the piece's end."""
    shifted = [F.slice("words", k, F.size("words")).alias(f"w{k}") for k in range(1, width + 1)]
    return pieces.where(F.size("words") >= 2).select("lang", F.inline(F.arrays_zip(*shifted)))


def counted(rows: DataFrame) -> DataFrame:
    return rows.groupBy("lang", "phrase").agg(F.count("*").alias("f"))


def having(rows: DataFrame, frequent: DataFrame, key, how: str) -> DataFrame:
    """Rows whose ``key`` is a frequent phrase of their language (semi), or all with a mark (left)."""
    side = frequent if how == "left_semi" else frequent.withColumn("hit", F.lit(True))
    return rows.withColumn("phrase", key).join(side, ["lang", "phrase"], how).drop("phrase")


def phrase_counts(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, n) of all words, and (lang, phrase, size, f) of all n-grams with f >= min_count; both written."""
    pieces = pieces_of(docs)
    words = written(counted(pieces.select("lang", F.explode("words").alias("phrase"))), "words")
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "totals")
    frequent = written(words.where(F.col("f") >= min_count), "frequent-words")
    dropped(words)
    levels = [frequent.withColumn("size", F.lit(1))]
    if max_words >= 2:
        known = small(frequent.select("lang", "phrase"))
        rows = windows(pieces, 2).where("w2 is not null")
        for k in (1, 2):
            rows = having(rows, known, F.col(f"w{k}"), "left_semi")
        pairs = written(counted(rows.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"))).where(F.col("f") >= min_count), "frequent-pairs")
        levels.append(pairs.withColumn("size", F.lit(2)))
    if max_words >= 3:
        known = small(pairs.select("lang", "phrase"))
        rows = having(windows(pieces, max_words).where("w3 is not null"), known, F.concat_ws(" ", "w1", "w2"), "left_semi")
        for k in range(2, max_words):  # how far the chain of frequent pairs goes on
            pair = F.when(F.col(f"w{k + 1}").isNotNull(), F.concat_ws(" ", f"w{k}", f"w{k + 1}"))
            rows = having(rows, known, pair, "left").withColumnRenamed("hit", f"hit{k}")
            rows = rows.where("hit2") if k == 2 else rows
        names = [f"w{k}" for k in range(1, max_words + 1)]
        unbroken = [reduce(lambda a, b: a & b, [F.coalesce(F.col(f"hit{j}"), F.lit(False)) for j in range(2, k)]) for k in range(3, max_words + 1)]
        reach = reduce(lambda a, b: a + b, [u.cast("int") for u in unbroken], F.lit(2))
        longer = rows.select("lang", F.array(*names).alias("ws"), F.explode(F.sequence(F.lit(3), reach)).alias("size")).select("lang", "size", F.concat_ws(" ", F.slice("ws", F.lit(1), F.col("size"))).alias("phrase"))
        levels.append(written(longer.groupBy("lang", "phrase").agg(F.count("*").alias("f"), F.first("size").alias("size")).where(F.col("f") >= min_count), "frequent-phrases"))
    return totals, reduce(DataFrame.unionByName, levels)


def scored(totals: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score of every phrase of two words and more, by its lowest-scoring cut."""
    cuts = counts.where("size >= 2").select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("head"), F.expr("substring_index(phrase, ' ', k - size)").alias("tail"))
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r"))
    both = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"]).join(small(totals), "lang")
    exact = both.withColumn("score", F.expr("(cast(1000 as decimal(38,0)) * cast(a as decimal(20,0)) * cast(n as decimal(20,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"))
    best = exact.groupBy("lang", "phrase").agg(F.first("size").alias("size"), F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "n", "cut.score")


def maximal(candidates: DataFrame, cover: int = COVER) -> DataFrame:
    """Without phrases that a longer one covers: one word more is enough, as counts only fall with length."""
    longer = candidates.where("size >= 3").select("lang", F.col("a").alias("longer"), F.explode(F.array(F.expr("substring_index(phrase, ' ', size - 1)"), F.expr("substring_index(phrase, ' ', 1 - size)"))).alias("phrase"))
    most = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    return candidates.join(most, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < cover * F.col("a"))).drop("longer")


def ranked(candidates: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first rows; every task keeps its own first ones before they meet."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return candidates.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP, cover: int = COVER) -> DataFrame:
    totals, counts = phrase_counts(docs, min_count, max_words)
    return ranked(maximal(scored(totals, counts), cover), top)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS piece_id, lang, words FROM (
    SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
    )) WHERE len(words) > 0
), places AS (
  SELECT piece_id, lang, words, unnest(range(1, len(words) + 1)) AS place FROM pieces
), grams AS (
  SELECT lang, size, array_to_string(list_slice(words, place, place + size - 1), ' ') AS phrase FROM places, (SELECT unnest(range(1, 6)) AS size) WHERE place + size - 1 <= len(words)
), counts AS (
  SELECT lang, phrase, size, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, sum(f) AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS words FROM counts WHERE size >= 2 AND f >= 100
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.f AS l, t.f AS r, n, CAST(1000 AS HUGEINT) * c.a * n // (CAST(h.f AS HUGEINT) * t.f) AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counts h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(c.words, 1, k), ' ')
  JOIN counts t ON t.lang = c.lang AND t.phrase = array_to_string(list_slice(c.words, k + 1, c.size), ' ')
  JOIN totals ON totals.lang = c.lang
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM best b WHERE NOT EXISTS (
    SELECT 1 FROM candidates c WHERE c.lang = b.lang AND c.phrase <> b.phrase AND c.a >= b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM placed WHERE rank <= 2000
"""
