"""Best-fit packing by patterns: non-negative least squares over the length histogram.

Texts become token ids, are cut into pieces of at most ``width`` tokens, and the pieces are laid
into sequences. Patterns of one to three lengths that fill a sequence exactly are enumerated;
non-negative least squares fits how often to use each so that the histogram of piece lengths is
met; the fitted counts are rounded down to what the histogram holds; the pieces left over are
packed by count with best-fit decreasing. Only the histogram (at most ``width`` rows) and the
resulting plan (bounded by ``width`` and the number of patterns) reach the driver. A piece then
finds its place from its rank among the pieces of its length.

Null text counts as empty (one end token). Rows with equal ids are documents of their own as far
as packing goes. An empty table gives an empty table. Columns besides doc_id and text are not
carried. Ranks within a length are dealt over salted buckets, so a very common length (the full
one, as a rule) is no single group.
"""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.llm.common import mapped, only, pieces, table, texts_of, written

WIDTH = 1024
END_ID = 2
#: one text in so many is encoded by both encoders
CHECKED = 16
_TOKENIZERS: dict = {}


def byte_bpe(ranks_path: str):
    """The byte-level vocabulary as a fast encoder (one for each worker process)."""
    if ranks_path not in _TOKENIZERS:
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _TOKENIZERS[ranks_path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _TOKENIZERS[ranks_path]


def json_bpe(path: str):
    if path not in _TOKENIZERS:
        from tokenizers import Tokenizer

        _TOKENIZERS[path] = Tokenizer.from_file(path)
    return _TOKENIZERS[path]


def token_pieces(docs: DataFrame, json_path: str, ranks_path: str, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every document.

    Ids are the tokenizers library's. A text that holds an added token goes to the library itself;
    others go to a faster encoder of the vocabulary's rank file, and one text in CHECKED of them,
    chosen by a checksum of its bytes, is encoded by the library too: a difference fails the task.
    """

    def cut(batches):
        fast, library = byte_bpe(ranks_path), json_bpe(json_path)
        added = [token.content for token in library.get_added_tokens_decoder().values()]

        def encoded(text: str) -> list[int]:
            whole = any(token in text for token in added)
            found = None if whole else fast.encode_ordinary(text)
            if whole or zlib.crc32(text.encode()) % CHECKED == 0:
                theirs = library.encode(text, add_special_tokens=False).ids
                if not whole and found != theirs:
                    raise ValueError("the two encoders of one vocabulary differ")
                return theirs
            return found

        for batch in pieces(batches):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                ids = np.append(np.asarray(encoded(text), "<u4"), np.uint32(end_id)).astype("<u4")
                first = len(ids) % width or width
                cuts = [0, *range(min(first, len(ids)), len(ids) + 1, width)]
                rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(x, pa.int64()) for x in columns[2:])], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return mapped(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def patterns(width: int) -> np.ndarray:
    """All multisets of one to three lengths with the sum ``width``; zeros fill short rows."""
    found = [(width, 0, 0)] + [(width - b, b, 0) for b in range(1, width // 2 + 1)]
    for c in range(1, width // 3 + 1):
        b = np.arange(c, (width - c) // 2 + 1)
        found.extend(zip((width - c - b).tolist(), b.tolist(), [c] * len(b), strict=True))
    return np.array(found, np.int32)


def non_negative_fit(rows: np.ndarray, wanted: np.ndarray, steps: int = 400) -> np.ndarray:
    """Least-squares repeat counts, none negative, by accelerated projected gradient."""
    width = len(wanted) - 1
    scale = 1.0 / np.sqrt(np.maximum(wanted, 1.0))
    scale[0] = 0.0
    times = np.zeros(width + 1)
    for column in rows.T:
        np.add.at(times, column, 1.0)
    # step by column: the diagonal of the normal matrix, damped by how many patterns share a length
    pull = sum(scale[column] ** 2 * np.maximum(times[column], 1.0) for column in rows.T)
    x = np.zeros(len(rows))
    y, momentum = x.copy(), 1.0
    for _ in range(steps):
        used = sum(np.bincount(column, weights=y, minlength=width + 1) for column in rows.T)
        miss = scale**2 * (used - wanted)
        miss[0] = 0.0
        slope = sum(miss[column] for column in rows.T)
        after = np.maximum(y - slope / np.maximum(pull, 1e-12) / 3.0, 0.0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = np.maximum(after + (momentum - 1) / following * (after - x), 0.0)
        x, momentum = after, following
    return x


def best_fit(left: dict[int, int], width: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: bins of one content are handled together."""
    open_bins: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            room = next((r for r in range(length, width) if open_bins.get(r)), width)
            if room == width:
                fits = width // length
                whole, rest = divmod(count, fits)
                for n, times in ((fits, whole), (rest, 1 if rest else 0)):
                    if times:
                        at = open_bins[width - n * length]
                        key = (length,) * n
                        at[key] = at.get(key, 0) + times
                break
            content, times = open_bins[room].popitem()
            take = min(times, count)
            if take < times:
                open_bins[room][content] = times - take
            at = open_bins[room - length]
            key = (*content, length)
            at[key] = at.get(key, 0) + take
            count -= take
    return [(content, times) for bins in open_bins.values() for content, times in bins.items()]


def plan(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[tuple[int, ...], int]]:
    """(lengths in one sequence, how many such sequences); covers the histogram exactly."""
    left = dict(histogram)
    chosen: list[tuple[tuple[int, ...], int]] = []
    if left:
        wanted = np.zeros(width + 1)
        for length, count in left.items():
            wanted[length] = count
        rows = patterns(width)
        rows = rows[np.all((rows == 0) | (wanted[rows] > 0), axis=1)]
        if len(rows):
            repeats = np.rint(non_negative_fit(rows, wanted)).astype(np.int64)
            for k in np.argsort(-repeats, kind="stable"):
                if repeats[k] <= 0:
                    break
                content = tuple(int(x) for x in rows[k] if x)
                need = defaultdict(int)
                for x in content:
                    need[x] += 1
                times = min(int(repeats[k]), *(left.get(x, 0) // n for x, n in need.items()))
                if times:
                    chosen.append((content, times))
                    for x, n in need.items():
                        left[x] -= n * times
    return chosen + best_fit({k: v for k, v in left.items() if v}, width)


def packed(found: DataFrame, width: int = WIDTH) -> DataFrame:
    """Add sequence_id and offset to pieces (a table that can be read twice alike)."""
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count("*").alias("n")).collect()}
    total = sum(histogram.values())
    buckets = max(64, total // 500_000)
    places = defaultdict(list)  # length -> (first rank, first sequence, sequences, offset)
    ranks: dict[int, int] = defaultdict(int)
    sequence = 0
    for content, times in plan(histogram, width):
        at = 0
        for length in content:
            places[length].append((ranks[length], sequence, at))
            ranks[length] += times
            at += length
        sequence += times
    starts = {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in places.items()}

    bucketed = found.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = bucketed.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = sizes.select("length", "bucket", (F.sum("n").over(Window.partitionBy("length").orderBy("bucket")) - F.col("n")).alias("before"))
    if buckets * width <= 1 << 17:  # rows of the offsets table: small enough for every executor
        before = F.broadcast(before)
    ranked = bucketed.withColumn("rank", F.row_number().over(Window.partitionBy("length", "bucket").orderBy("doc_id", "piece")) - 1).join(before, ["length", "bucket"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).cast("long").alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            where, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                own = length == x
                first, sequence, at = starts[int(x)]
                k = np.searchsorted(first, rank[own], side="right") - 1
                where[own] = sequence[k] + rank[own] - first[k]
                offset[own] = at[k]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(where), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return mapped(ranked, place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame) -> DataFrame:
    found = token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed(written(found, "pieces"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
