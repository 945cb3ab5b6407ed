"""Candidates among rows that meet in cells: signatures travel, edges come back.

Operators name a cell by a 64-bit number and give every row that asks it a signature of one or more
64-bit words. Rows of one cell whose signatures differ in few bits are candidates. Of very near rows
that share a cell in a task (at most CLOSE bits a word) one stands for the others, with a wider bound
by the triangle inequality, so a very common cell gets a few rows from each task. An edge says whether
its rows belong into one group (merge) or are a pair of their own.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carrel.llm.common import mapped

#: of 64 signature bits; at a Jaccard similarity of 0.8 the mean is 9.7 and the standard deviation 2.9
NEAR = 19
CLOSE = 3
#: cell rows a task holds before it sends them
SENT = 1 << 19
SENT_KINDS = "part int, edges boolean, blob binary"


class Forest:
    """Union-find over the points of a shard; keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        label = self.label
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    def flat(self) -> np.ndarray:
        while not np.array_equal(up := self.label[self.label], self.label):
            self.label = up
        return self.label

    def join(self, rows: np.ndarray, columns: np.ndarray, close: np.ndarray) -> None:
        """``close``: which rows and columns link. One partner a column and pass, until all agree."""
        while True:
            label = self.flat()
            open_ = close & (label[rows][:, None] != label[columns][None, :])
            found = np.flatnonzero(open_.any(axis=0))
            if not len(found):
                return
            for a, b in zip(rows[open_[:, found].argmax(axis=0)].tolist(), columns[found].tolist(), strict=True):
                x, y = self.root(a), self.root(b)
                if x != y:
                    self.label[max(x, y)] = min(x, y)
                    self.edges.append((a, b))


def row_type(words: int) -> np.dtype:
    return np.dtype([("cell", "<i8"), ("class", "<i8"), ("signature", "<u8", (words,)) if words > 1 else ("signature", "<u8"), ("home", "?"), ("wide", "?")])


ROW = row_type(1)


def words_of(signature: np.ndarray) -> np.ndarray:
    """Signatures as rows of words."""
    return signature.reshape(len(signature), -1)


def bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which two rows of words differ (one of them may be a single row)."""
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def all_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which every row of a differs from every row of b."""
    out = np.zeros((len(a), len(b)), np.int16)
    for k in range(a.shape[1]):
        out += np.bitwise_count(a[:, k][:, None] ^ b[:, k][None, :])
    return out


def thinned(rows: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Rows sorted by cell, of very near ones in a cell one only; edges of the others to it."""
    words = words_of(rows["signature"])
    rows = rows[np.lexsort((*words.T[::-1], rows["cell"]))]
    words = words_of(rows["signature"])
    close = CLOSE * words.shape[1]
    near = (rows["cell"][1:] == rows["cell"][:-1]) & (bits(words[1:], words[:-1]) <= close)
    starts = np.flatnonzero(np.r_[True, ~near]) if len(rows) else np.zeros(0, np.int64)
    keep, edges = np.ones(len(rows), bool), []
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(rows)], strict=True):
        if b - a < 3:
            continue
        # a run of near neighbours in sorted order: those within the bound of its first row go with it
        gone = a + 1 + np.flatnonzero(bits(words[a + 1 : b], words[a]) <= close)
        keep[gone] = False
        rows["home"][a] |= rows["home"][gone].any()
        rows["wide"][a] |= len(gone) > 0
        edges += [(int(rows["class"][a]), c) for c in set(rows["class"][gone].tolist()) - {int(rows["class"][a])}]
    return rows[keep], edges


def cell_blob(rows: np.ndarray) -> bytes:
    """Cell rows field by field; a vector's number and signature once, however many of its cells are here."""
    number, first, index = np.unique(rows["class"], return_index=True, return_inverse=True)
    flags = rows["home"].astype(np.uint8) | rows["wide"].astype(np.uint8) << 1
    signature = words_of(rows["signature"])[first].astype("<u8")
    return b"".join([np.array([len(rows), len(number), signature.shape[1]], "<i8").tobytes(), number.astype("<i8").tobytes(), signature.tobytes(), rows["cell"].astype("<i8").tobytes(), index.astype("<u4").tobytes(), flags.tobytes()])


def cell_rows(blob: bytes) -> np.ndarray:
    n, m, width = np.frombuffer(blob, "<i8", 3).tolist()
    at = 24
    number, at = np.frombuffer(blob, "<i8", m, at), at + 8 * m
    signature, at = np.frombuffer(blob, "<u8", m * width, at).reshape(m, width), at + 8 * m * width
    cell, at = np.frombuffer(blob, "<i8", n, at), at + 8 * n
    index, flags = np.frombuffer(blob, "<u4", n, at), np.frombuffer(blob, "u1", n, at + 4 * n)
    rows = np.zeros(n, row_type(width))
    rows["cell"], rows["class"] = cell, number[index]
    rows["signature"] = signature[index] if width > 1 else signature[index, 0]
    rows["home"], rows["wide"] = flags & 1, flags >> 1
    return rows


def sent_rows(rows: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of many cells as one blob for each part of the cells; and the edges of very near rows."""
    rows, edges = thinned(rows)
    part = (rows["cell"].view(np.uint64) % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.r_[True, np.diff(part[order]) != 0, True]) if len(part) else np.zeros(1, np.int64)
    out = [(int(part[order[a]]), False, cell_blob(rows[order[a:b]])) for a, b in itertools.pairwise(cuts.tolist())]
    if edges:
        out.append((len(edges) % parts, True, np.array(edges, "<i8").tobytes()))
    return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.bool_()), pa.array([x[2] for x in out], pa.binary())], ["part", "edges", "blob"])


def candidate_edges(sent: DataFrame, parts: int, search) -> DataFrame:
    """a, b, merge: the edges of all cells; ``search`` gives those of one cell as (a, b, merge)."""

    def gather(batches):
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for part, edges, blob in zip(batch.column("part").to_pylist(), batch.column("edges").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if edges:
                    pairs = np.frombuffer(blob, "<i8").reshape(-1, 2)
                    yield found_edges(pairs[:, 0], pairs[:, 1], np.ones(len(pairs), bool))
                else:
                    held.setdefault(part, []).append(cell_rows(blob))
        for part in list(held):
            rows = np.concatenate(held.pop(part))
            rows = rows[np.argsort(rows["cell"], kind="stable")]
            starts = np.flatnonzero(np.r_[True, rows["cell"][1:] != rows["cell"][:-1]])
            sizes = np.diff(np.r_[starts, len(rows)])
            busy = (sizes > 1) & np.logical_or.reduceat(rows["home"], starts)
            found = set()
            for a, k in zip(starts[busy].tolist(), sizes[busy].tolist(), strict=True):
                found.update((min(x, y), max(x, y), merge) for x, y, merge in search(rows[a : a + k]))
                if len(found) > SENT:
                    yield found_edges(*(np.array(c) for c in zip(*found, strict=True)))
                    found = set()
            if found:
                yield found_edges(*(np.array(c) for c in zip(*found, strict=True)))

    return mapped(sent.repartition(parts, "part"), gather, "a long, b long, merge boolean")


def found_edges(a: np.ndarray, b: np.ndarray, merge: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(merge, pa.bool_())], ["a", "b", "merge"])


def in_blocks(rows: DataFrame, size: str, member: str, block: int) -> DataFrame:
    """Deal the rows of groups larger than ``block`` over pairs of blocks: adds columns own, i and j."""
    parts = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64(member), parts).cast("int")
    spread = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    return spread.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).drop("other", size)
