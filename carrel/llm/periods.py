"""Periodic runs of words, found by block matching and exact extension.

A run is a stretch of words with smallest period q and at least max(6, 4 q) words that no neighbour
extends with that period. At scale B = 1, 2, 4 ... a run with B <= q < 2 B holds an aligned block of B words
among its first 2 q words, and that block occurs again q words later. So the aligned blocks of a scale are
the keys (integer sequences) of an Aho-Corasick automaton, the document is searched for them, and every
occurrence at a distance of B to 2 B - 1 seeds an extension to both sides, word by word. Blocks of over
KEY_WORDS words are known by their first ones. Two cuts lose nothing: every word of such a block and of the
next one occurs again less than 2 B words later, so others are no keys and texts far from a key are not
searched; and a block that lies with its occurrence in a run of a smaller period has met a multiple of it.

Documents of an Arrow piece are searched as one array of word numbers, set apart by numbers that occur once.
A section has a bounded number of keys and streams through its automaton, so a document takes time in
proportion to its words times the scales, and memory in proportion to its words.

Words are split at ASCII white space. Null text has no words; null ids and repeated rows are handled each on
their own; an empty table gives an empty table; extra columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import mapped, only, pieces, table, texts_of

LEAST_WORDS = 6
LEAST_PERIODS = 4
KEY_WORDS = 4096
#: keys of an automaton, and words that it is fed at once
SECTION_KEYS, FED_WORDS = 64, 1 << 16
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def split_words(texts: list[bytes]) -> tuple[pa.BinaryArray, np.ndarray]:
    """All words of the texts in one array, and how many each text has."""
    raw = np.frombuffer(b" ".join(texts), np.uint8)
    inner = ~_SPACE[raw]
    first = inner.copy()
    first[1:] &= ~inner[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum([len(x) + 1 for x in texts])
    upto = np.searchsorted(starts, ends)
    letters = raw[inner]
    offsets = np.append(np.cumsum(inner)[starts] - 1, len(letters)).astype(np.int32)
    words = pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(letters.tobytes())])
    return words, np.diff(np.append(0, upto))


def numbered(words: pa.BinaryArray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers with a separator of its own behind each text, and the texts' starts."""
    starts = np.cumsum(sizes + 1) - sizes - 1
    x = np.empty(int(sizes.sum()) + len(sizes), np.int64)
    last = starts + sizes
    coded = words.dictionary_encode()
    x[last] = len(coded.dictionary) + np.arange(len(sizes))
    inner = np.ones(len(x), bool)
    inner[last] = False
    x[inner] = coded.indices.to_numpy()
    return x, starts


def recurrence(x: np.ndarray) -> np.ndarray:
    """Distance from each place to the next equal number; more than len(x) if there is none."""
    order = np.argsort(x, kind="stable")
    step = np.diff(order)
    out = np.full(len(x), len(x) + 1)
    same = x[order[1:]] == x[order[:-1]]
    out[order[:-1][same]] = step[same]
    return out


class Runs:
    """The runs of an array of word numbers that ends with a number that occurs once."""

    def __init__(self, x: np.ndarray, longest: int):
        self.x = x
        self.found: dict[tuple[int, int], int] = {}  # (start, end) of stretches of two periods and more: smallest period
        self.reach = np.zeros(len(x), np.int64)  # how far known stretches of periods up to KEY_WORDS go that hold a place
        worst, size = recurrence(x), 1
        while LEAST_PERIODS * size <= longest:
            near = worst < 2 * size
            blocks = np.flatnonzero(near[:-1] & near[1:])
            self.last: dict[int, tuple[int, int]] = {}
            self.scale(blocks[self.reach[blocks * size] < (blocks + 3) * size - 1], size)
            even = len(worst) // 2 * 2
            worst, size = np.maximum(worst[0:even:2], worst[1:even:2]), 2 * size

    def scale(self, blocks: np.ndarray, size: int) -> None:
        most = max(1, min(SECTION_KEYS, FED_WORDS // size))
        cuts = np.flatnonzero(np.diff(blocks) > 4) + 1
        for group in np.split(blocks, cuts):
            for at in range(0, len(group), most):
                self.section(group[at : at + most], size)

    def section(self, blocks: np.ndarray, size: int) -> None:
        x, key_words = self.x, min(size, KEY_WORDS)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        key_of: dict[int, int] = {}
        for block in blocks.tolist():
            key = tuple(x[block * size : block * size + key_words].tolist())
            known = automaton.get(key, -1)
            if known < 0:
                known = block
                automaton.add_word(key, block)
            key_of[block] = known
        automaton.make_automaton()
        begin, end = int(blocks[0]) * size, min(len(x), (int(blocks[-1]) + 3) * size)
        search = None
        for at in range(begin, end, FED_WORDS):
            fed = tuple(x[at : min(end, at + FED_WORDS)].tolist())
            if search is None:
                search = automaton.iter(fed)
            else:
                search.set(fed)
            for stop, known in search:
                place = begin + stop - key_words + 1
                block = place // size - 1
                if key_of.get(block) == known and self.reach[block * size] < place + key_words:
                    self.extend(block * size, place - block * size)

    def extend(self, place: int, period: int) -> None:
        """The stretch of a period around a place whose word is that of the place a period later."""
        x, known = self.x, self.last.get(period)
        if known and known[0] <= place < known[1]:
            return
        begin = end = place
        step = 32
        while end + period < len(x):
            equal = x[end : end + step][: len(x) - end - period] == x[end + period : end + period + step]
            if not equal.all():
                end += int(equal.argmin())
                break
            end += len(equal)
            step *= 2
        step = 32
        while begin > 0:
            low = max(0, begin - step)
            equal = x[low:begin] == x[low + period : begin + period]
            if not equal.all():
                begin -= int(equal[::-1].argmin())
                break
            begin = low
            step *= 2
        self.last[period] = begin, end
        if end - begin >= period:
            span = begin, end + period
            if span not in self.found:  # scales ascend, so the first period of a span is its smallest
                self.found[span] = period
                if period <= KEY_WORDS:
                    part = self.reach[span[0] : span[1]]
                    np.maximum(part, span[1], out=part)

    def all(self) -> np.ndarray:
        """(start, length, period) by start, then period."""
        rows = [(a, b - a, p) for (a, b), p in self.found.items() if b - a >= max(LEAST_WORDS, LEAST_PERIODS * p)]
        return np.array(sorted(rows, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def collapsed_texts(words: pa.BinaryArray, sizes: np.ndarray, keep: np.ndarray) -> list[bytes]:
    """The kept words of each text, joined by one space."""
    kept = words.filter(pa.array(keep))
    offsets = np.frombuffer(kept.buffers()[1], np.int32)[kept.offset : kept.offset + len(kept) + 1].astype(np.int64) if len(kept) else np.zeros(1, np.int64)
    letters = np.frombuffer(kept.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(kept) else np.zeros(0, np.uint8)
    lengths = np.diff(offsets)
    out = np.full(len(letters) + len(kept), 32, np.uint8)
    out[np.arange(len(letters)) + np.repeat(np.arange(len(kept)), lengths)] = letters
    ends = np.append(0, np.cumsum(lengths + 1))
    counts = np.append(0, np.cumsum(keep))[np.append(0, np.cumsum(sizes))]
    return [out[ends[a] : max(ends[a], ends[b] - 1)].tobytes() for a, b in zip(counts[:-1], counts[1:], strict=True)]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def with_runs(docs: DataFrame, rewrite: Callable[[int | None, int], np.ndarray | None] | None = None) -> DataFrame:
    """doc_id, n_words, runs (by start, then period), collapsed: the text without the repeated words of its runs.

    ``rewrite`` gets a document's id and number of words and may return the places whose words take over.
    """

    def search(batches):
        for batch in pieces(batches, 4 << 20):
            ids = batch.column("doc_id").to_pylist()
            words, sizes = split_words([t.encode() for t in texts_of(batch)])
            if rewrite:
                before = np.cumsum(sizes) - sizes
                moved = [(k, places) for k, (i, n) in enumerate(zip(ids, sizes.tolist(), strict=True)) if (places := rewrite(i, n)) is not None]
                if moved:
                    source = np.arange(len(words))
                    for k, places in moved:
                        source[before[k] : before[k] + sizes[k]] = before[k] + places
                    words = words.take(pa.array(source))
            x, starts = numbered(words, sizes)
            found = Runs(x, int(sizes.max(initial=0))).all()
            owner = np.searchsorted(starts, found[:, 0], side="right") - 1
            gone = np.zeros(len(x) + 1, np.int64)
            np.add.at(gone, found[:, 0] + found[:, 2], 1)
            np.add.at(gone, found[:, 0] + found[:, 1], -1)
            inner = np.ones(len(x), bool)
            inner[starts + sizes] = False
            keep = (np.cumsum(gone)[:-1] == 0)[inner]
            own = found.copy()
            own[:, 0] -= starts[owner]
            cuts = np.searchsorted(owner, np.arange(len(ids) + 1)).astype(np.int32)
            runs = pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays([pa.array(own[:, c]) for c in range(3)], fields=list(_RUNS.value_type)))
            collapsed = [t.decode() for t in collapsed_texts(words, sizes, keep)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64()), runs, pa.array(collapsed, pa.string())], ["doc_id", "n_words", "runs", "collapsed"])

    rows = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return mapped(rows, search, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """One document in ten becomes periodic from some word on, as the query asks for."""
    if doc_id is None or n == 0:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_runs(table(spark, sf_dir, "documents"), planted)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("small"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"), lines.alias("lines"), "collapsed", "n_words").select(
        "doc_id",
        "n_runs",
        (-F.col("best.back")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.small")).alias("period"),
        F.expr("best.length * 1000 div -best.small").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
