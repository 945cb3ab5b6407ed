"""Notes to dated, overlapping chunks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carrel.functions.scalars import CHARS_PER_TOKEN, estimated_tokens, text

TARGET_TOKENS = 50_000
OVERLAP_TOKENS = 500
HEADER = "=== Clinical Note dated (.+?) ==="


def effective_target(target: int = TARGET_TOKENS, context_window: int | None = None) -> int:
    return target if context_window is None else min(target, context_window // 3)


def note_block(date: Column, body: Column) -> Column:
    shown = F.when(text(date) == "", "unknown").otherwise(text(date))
    return F.concat(F.lit("=== Clinical Note dated "), shown, F.lit(" ===\n"), F.coalesce(body, F.lit("")), F.lit("\n"))


def document_index(notes: DataFrame, key: str = "patient_id", date: str = "date", order: str = "ord") -> DataFrame:
    """doc_index: place by date (blank dates last), ties in input order."""
    w = Window.partitionBy(key).orderBy(F.col(date).asc_nulls_last(), F.col(order))
    return notes.withColumn("doc_index", F.row_number().over(w) - 1)


def concatenated(docs: DataFrame, keys: list[str], order: str = "doc_index") -> DataFrame:
    """One text for each key: all its note blocks in order. Columns: keys, full_text, first_doc_date."""
    block = F.struct(F.col(order).alias("o"), note_block(F.col("date"), F.col("text")).alias("b"), F.coalesce("date", F.lit("")).alias("d"))
    grouped = docs.groupBy(*keys).agg(F.array_sort(F.collect_list(block)).alias("blocks"))
    return grouped.select(*keys, F.array_join(F.transform("blocks", lambda x: x["b"]), "\n").alias("full_text"), F.try_element_at("blocks", F.lit(1))["d"].alias("first_doc_date"))


#: documents of a key whose blocks are placed in one window
SPAN = 4096


def _same(a: str, b: str, names: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in names])


def placed(docs: DataFrame, keys: list[str], order: str = "doc_index") -> DataFrame:
    """keys, order, block, start, total, first_doc_date: where each document's block begins in its key's text.

    ``order`` holds whole numbers, each once in a key. Lengths are summed by spans of SPAN numbers, then
    within each span, so a key with very many documents is spread over tasks; no text of a whole key is built.
    """
    blocks = docs.select(*keys, F.col(order).alias("place_"), note_block(F.col("date"), F.col("text")).alias("block"), F.coalesce("date", F.lit("")).alias("date")).withColumn("span_", F.floor(F.col("place_") / SPAN))
    sizes = blocks.groupBy(*keys, "span_").agg(F.sum(F.length("block") + 1).alias("size"), F.min(F.struct("place_", "date")).alias("first"))
    every = Window.partitionBy(*keys)
    ahead = every.orderBy("span_").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.select(*keys, "span_", F.coalesce(F.sum("size").over(ahead), F.lit(0)).alias("before"), (F.sum("size").over(every) - 1).alias("total"), F.min("first").over(every)["date"].alias("first_doc_date"))
    joined = blocks.alias("b").join(spans.alias("s"), _same("b", "s", [*keys, "span_"])).select("b.*", "s.before", "s.total", "s.first_doc_date")
    inside = Window.partitionBy(*keys, "span_").orderBy("place_").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum(F.length("block") + 1).over(inside), F.lit(0))
    return joined.select(*keys, F.col("place_").alias(order), "block", start.alias("start"), "total", "first_doc_date")


def chunked(docs: DataFrame, keys: list[str], target: int = TARGET_TOKENS, overlap: int = OVERLAP_TOKENS, order: str = "doc_index") -> DataFrame:
    """Slices of a fixed stride of each key's concatenated() documents; a text within the target stays whole.

    keys, chunk_id, chunk_index, chunk_text, token_estimate, first_date, last_date. Chunks are ranges of
    offsets: every document sends each chunk it overlaps its part of it, so no task holds more of a key than
    a chunk. A chunk without a note header carries on its predecessor's last date; the first one starts
    with the first note's.
    """
    size, lap = int(target * CHARS_PER_TOKEN), int(overlap * CHARS_PER_TOKEN)
    stride = size - lap
    if stride <= 0:
        raise ValueError("the overlap must be smaller than the target")
    total = F.col("total")
    last = F.when(F.greatest(F.lit(1), F.floor(total / F.lit(CHARS_PER_TOKEN))) <= target, F.lit(-1)).otherwise(F.ceil(F.greatest(total - size, F.lit(0)) / stride)).cast("int")
    text_ = F.when(F.col("start") + F.length("block") < total, F.concat("block", F.lit("\n"))).otherwise(F.col("block"))
    rows = placed(docs, keys, order).select(*keys, order, text_.alias("block"), "start", "first_doc_date", last.alias("last"))
    low = F.greatest(F.lit(0), F.floor((F.col("start") - size) / stride) + 1)
    high = F.least(F.greatest(F.col("last"), F.lit(0)).cast("bigint"), F.floor((F.col("start") + F.length("block") - 1) / stride))
    rows = rows.withColumn("chunk_", F.explode(F.when(F.col("last") <= 0, F.array(F.lit(0).cast("bigint"))).otherwise(F.sequence(F.least(low, high), high))))
    begin = F.greatest(F.col("chunk_") * stride - F.col("start"), F.lit(0))
    end = F.when(F.col("last") < 0, F.length("block")).otherwise(F.least(F.col("chunk_") * stride + size - F.col("start"), F.length("block")))
    part = F.substring("block", (begin + 1).cast("int"), F.greatest(end - begin, F.lit(0)).cast("int"))
    parts = rows.select(*keys, F.col("chunk_").cast("int").alias("chunk_index"), "first_doc_date", F.struct(F.col(order).alias("o"), part.alias("p")).alias("part"))
    whole = parts.groupBy(*keys, "chunk_index").agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda x: x["p"]), "").alias("chunk_text"), F.first("first_doc_date").alias("first_doc_date"))
    headers = F.regexp_extract_all("chunk_text", F.lit(HEADER), F.lit(1))
    found = whole.select(*keys, "chunk_index", "first_doc_date", headers.alias("headers")).select(*keys, "chunk_index", "first_doc_date", F.try_element_at("headers", F.lit(1)).alias("found_first"), F.try_element_at("headers", F.lit(-1)).alias("found_last"))
    before = Window.partitionBy(*keys).orderBy("chunk_index").rowsBetween(Window.unboundedPreceding, -1)
    carried = F.coalesce(F.last("found_last", ignorenulls=True).over(before), F.col("first_doc_date"))
    dated = found.select(*keys, "chunk_index", F.coalesce("found_first", carried).alias("first_date"), F.coalesce("found_last", carried).alias("last_date"))
    both = whole.alias("w").join(dated.alias("d"), _same("w", "d", [*keys, "chunk_index"])).select(*(f"w.{k}" for k in keys), "w.chunk_index", "w.chunk_text", "d.first_date", "d.last_date")
    ident = F.sha2(F.concat_ws("\x1f", *(F.col(k).cast("string") for k in keys), F.col("chunk_index").cast("string")), 256)
    return both.select(*keys, ident.alias("chunk_id"), "chunk_index", "chunk_text", estimated_tokens(F.col("chunk_text")).alias("token_estimate"), "first_date", "last_date")


def rounds(chunks: DataFrame) -> DataFrame:
    """Units and chunks of every round: round N holds the Nth chunk of every unit."""
    return chunks.groupBy(F.col("chunk_index").alias("round")).agg(F.count("*").alias("units"))


def batched(items: DataFrame, partition: list[str], order: list[str], per_call: int) -> DataFrame:
    """batch: at most ``per_call`` consecutive items each (one batch where per_call <= 0)."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return items.withColumn("batch", (F.lit(0) if per_call <= 0 else F.floor((F.row_number().over(w) - 1) / per_call)).cast("int"))
