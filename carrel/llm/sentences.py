"""Substring dedup over sliding spans of consecutive sentences.

A text is cut into sentences (at white space behind ``.``, ``!`` or ``?`` and at line breaks;
sentences of more than UNIT_WORDS words are cut further, ahead of the word with the smallest hash
of every window of UNIT_WORDS words). Those places hang on the words around them only, so a passage
pasted into the middle of a sentence is cut as its first copy is, but for at most UNIT_WORDS - 1
words at its start and UNIT_WORDS at its end. From every sentence on, and back from every sentence,
the shortest run of at least two sentences and SPAN_WORDS words is hashed; what is left of a passage
of PASSAGE_WORDS words between such ends holds a run, wherever the passage starts, and is covered up
to the ends. All runs of all documents are joined on their hashes; the first occurrence (smallest
doc_id, then place) stays, and every sentence that another occurrence covers is removed, judged on
the input.

In scripts that put no space between words every letter is a word, and their full stops end
sentences too. Case and white space do not count in a hash. Occurrences within one Arrow piece are settled
before the shuffle, so a very common passage sends a row for each piece, not for each document.
Null text counts as empty. Rows with a null doc_id are left as they are. Rows with equal ids are
parts of one document, in the order of their texts; identical rows count as one text, and each
of them gets what is left of it. An empty table gives an empty table; extra columns are carried.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import dropped, mapped, neutral, only, pieces, restored, table, written

PASSAGE_WORDS = 50
UNIT_WORDS = 16
SPAN_WORDS = PASSAGE_WORDS - 2 * UNIT_WORDS + 1
_BREAK = re.compile(r"(?<=[.!?])\s+|\n+")
_WORD = re.compile(r"\S+\s*")
# Blocks of scripts that put no space between words (Thai to Tibetan, Burmese, Khmer, kana, Han), and their full stops.
_LETTERS = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SPACELESS = re.compile(f"[{_LETTERS}]")
_SPACELESS_WORD = re.compile(rf"(?:[{_LETTERS}]|[^\s{_LETTERS}]+)\s*")
_SPACELESS_BREAK = re.compile(r"(?<=[.!?])\s+|\n+|(?<=[\u3002\uff01\uff1f\uff61])\s*")


def inner_cuts(long: list[list[str]]) -> list[list[int]]:
    """Where long sentences are cut: the smallest word hash of every window, the last of equal ones."""
    if not long:
        return []
    hashes = np.frombuffer(b"".join([xxhash.xxh3_64_digest(w) for words in long for w in words]), "<u8")
    sizes = np.array([len(words) for words in long])
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(long)), sizes)
    windows = np.lib.stride_tricks.sliding_window_view(hashes[::-1], UNIT_WORDS)
    places = len(hashes) - 1 - (np.arange(len(windows)) + windows.argmin(axis=1))
    whole = (owner[UNIT_WORDS - 1 :] == owner[: len(windows)])[::-1]
    chosen = np.zeros(len(hashes), bool)
    chosen[places[whole]] = True
    chosen[ends - sizes] = True
    cuts = np.flatnonzero(chosen)
    parts = np.split(cuts, np.searchsorted(cuts, ends[:-1]))
    return [[*(part - at).tolist(), n] for part, at, n in zip(parts, (ends - sizes).tolist(), sizes.tolist(), strict=True)]


def units(text: str) -> tuple[list[int], list[int], list[bytes]]:
    """Starts (one more than units), words and digests of the sentences of a text."""
    plain = text.isascii() or not _SPACELESS.search(text)
    word = _WORD if plain else _SPACELESS_WORD
    cuts = [0, *(m.end() for m in (_BREAK if plain else _SPACELESS_BREAK).finditer(text))]
    if cuts[-1] != len(text):
        cuts.append(len(text))
    starts, sizes, digests = [], [], []
    digest = xxhash.xxh64_digest
    if plain:
        found = [(a, b, text[a:b].lower().split()) for a, b in zip(cuts, cuts[1:], strict=False)]
    else:
        found = [(a, b, [w.strip().lower() for w in word.findall(text, a, b)]) for a, b in zip(cuts, cuts[1:], strict=False)]
    inner = iter(inner_cuts([words for _, _, words in found if len(words) > UNIT_WORDS]))
    for a, b, words in found:
        if len(words) <= UNIT_WORDS:
            starts.append(a)
            sizes.append(len(words))
            digests.append(digest(" ".join(words)))
            continue
        places = [m.start() for m in word.finditer(text, a, b)]
        own = next(inner)
        for k, after in zip(own, own[1:], strict=False):
            starts.append(places[k] if k else a)
            sizes.append(after - k)
            digests.append(digest(" ".join(words[k:after])))
    starts.append(len(text))
    return starts, sizes, digests


def spans(text: str) -> list[tuple[int, int, int]]:
    """(hash, first unit, unit behind the last) of all runs of a text."""
    _, sizes, digests = units(text)
    n = len(sizes)
    upto = [0, *np.cumsum(sizes).tolist()] if n else [0]
    found = set()
    j = 0
    for i in range(n):  # from unit i on
        j = max(j, i + 2)
        while j <= n and upto[j] - upto[i] < SPAN_WORDS:
            j += 1
        if j > n:
            break
        found.add((i, j))
    i = n
    for j in range(n, 1, -1):  # back from unit j
        i = min(i, j - 2)
        while i >= 0 and upto[j] - upto[i] < SPAN_WORDS:
            i -= 1
        if i < 0:
            break
        found.add((i, j))
    joined, digest = b"".join(digests), xxhash.xxh3_64_intdigest
    return [(digest(joined[8 * a : 8 * b]), a, b) for a, b in sorted(found)]


def hashed_spans(docs: DataFrame) -> DataFrame:
    """run, doc_id, text_key, place (first unit, unit behind the last in the lower half); run is null where an earlier row of the batch has it."""

    def cut(batches):
        for batch in pieces(batches):
            runs, ids, keys, first, last = [], [], [], [], []
            for doc_id, text in sorted(set(zip(batch.column("doc_id").to_pylist(), (x or "" for x in batch.column("text").to_pylist()), strict=True))):
                own = spans(text)
                runs += [x[0] for x in own]
                first += [x[1] for x in own]
                last += [x[2] for x in own]
                ids += [doc_id] * len(own)
                keys += [np.uint64(xxhash.xxh64_intdigest(text)).astype(np.int64)] * len(own)
            run = np.array(runs, np.uint64).view(np.int64)
            ids_, place = np.array(ids, np.int64), np.array(first, np.int64) << 32 | np.array(last, np.int64)
            order = np.lexsort((place, np.array(keys, np.int64), ids_, run))
            again = np.zeros(len(run), bool)
            again[order[1:]] = run[order][1:] == run[order][:-1]
            yield pa.RecordBatch.from_arrays([pa.array(run, mask=again), pa.array(ids_), pa.array(np.array(keys, np.int64)), pa.array(place)], ["run", "doc_id", "text_key", "place"])

    return mapped(docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), cut, "run long, doc_id long, text_key long, place long")


def repeats(found: DataFrame) -> DataFrame:
    """doc_id, text_key, cover: the places of all non-first runs; ``found`` can be read twice alike."""
    place = F.struct("doc_id", "text_key", "place")
    # one exchange by run feeds both the counting and the join; copies were settled within pieces before
    keyed = found.where("run is not null").repartition("run")
    firsts = keyed.groupBy("run").agg(F.min(place).alias("best"), F.count("*").alias("n")).where("n > 1").select("run", "best")
    later = keyed.join(firsts, "run").where(place != F.col("best"))
    both = later.select("doc_id", "text_key", "place").union(found.where("run is null").select("doc_id", "text_key", "place"))
    return both.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("cover"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """All rows and columns of ``docs``; text is what is left; removed_units and removed_chars are added."""
    columns = docs.columns
    found = written(hashed_spans(docs), "spans")
    covered = written(repeats(found), "covers")
    dropped(found)
    keyed = docs.join(covered.groupBy("doc_id").agg(F.collect_list(F.struct("text_key", "cover")).alias("covers")), "doc_id", "left").select(*columns, "covers")

    def strip(batches):
        for batch in pieces(batches):
            texts, removed, chars = [], [], []
            for text, covers in zip(batch.column("text").to_pylist(), batch.column("covers").to_pylist(), strict=True):
                own = None
                if covers and text:
                    wanted = int(np.uint64(xxhash.xxh64_intdigest(text)).astype(np.int64))
                    own = next((c["cover"] for c in covers if c["text_key"] == wanted), None)
                if not own:
                    texts.append(text)
                    removed.append(0)
                    chars.append(0)
                    continue
                starts = units(text)[0]
                gone = np.zeros(len(starts), np.int64)
                for span in own:
                    gone[span >> 32] += 1
                    gone[span & 0xFFFFFFFF] -= 1
                gone = np.cumsum(gone)[:-1] > 0
                left = "".join(text[starts[k] : starts[k + 1]] for k in np.flatnonzero(~gone).tolist())
                texts.append(left)
                removed.append(int(gone.sum()))
                chars.append(len(text) - len(left))
            yield pa.RecordBatch.from_arrays([*(pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in columns), pa.array(removed, pa.int32()), pa.array(chars, pa.int64())], [*columns, "removed_units", "removed_chars"])

    kinds = ", ".join(f"`{f.name}` {'string' if f.name == 'text' else f.dataType.simpleString()}" for f in docs.schema)
    return mapped(keyed, strip, f"{kinds}, removed_units int, removed_chars long")


def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = without_repeats(only(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return left.select("doc_id", "removed_units", "removed_chars", F.length(F.coalesce("text", F.lit(""))).alias("kept_chars"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: repeated passages go; a document with nothing left goes; n_chars follows the text."""
    left = without_repeats(neutral(docs, "doc_id", "text", "n_chars"))
    left = left.where("removed_chars = 0 or length(trim(text)) > 0")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("removed_chars") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return restored(left, docs, "doc_id", "text", "n_chars")
