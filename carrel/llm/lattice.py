"""Embedding near-duplicates by E8 lattice hashing.

Unit vectors are projected at random to eight dimensions, several times over; each projection
is decoded to the nearest point of the E8 lattice (its cell) and also asks the PROBES nearest
neighbouring cells. A vector goes to its cells as a number and a signature of 128 bits (signs of more
random projections), not with its components: vectors of one label that meet in a cell and whose
signatures differ in at most NEAR bits are candidates. The projection's scale follows the number of
vectors (cells stay sparse as the table grows), and the number of tables follows the scale.

Candidates are compared where they are few, and by groups where they are dense. A pair is a pair of its
own; only pairs within STRICT bits, and those of a vector with over DEGREE candidates in a cell, join a
group. Group members are compared all against all by blocks of rows; a pair between two groups compares
just these, unless one is large: then both become one. So each pair of vectors is compared once at most,
topical clusters without near vectors cost their candidate pairs only, and a dense ball never sends its
pairs. Cosines are taken in double precision; they give each vector's number of links and the edges
whose components are returned.

Equal vectors of a label are one class and compared once. Of very near vectors that share a cell
in a task one stands for the others, with a wider NEAR by the triangle bound, so a very common
direction sends a few rows a task. Groups with more rows than BLOCK are dealt over pairs of blocks.
Vectors are scaled by their largest component before their length is taken, so very large and very small
ones count like others. Null, zero or non-finite vectors, null components, null labels and null ids
link with nothing. Vectors of different length never link. An empty table gives an empty table; extra
columns are left out; repeated rows are vectors of their own, also under one id.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm import cells
from carrel.llm.cells import CLOSE, SENT_KINDS, Forest, all_bits, candidate_edges, in_blocks, row_type, sent_rows, words_of
from carrel.llm.common import components, mapped, only, runs_of, table, written

THRESHOLD = 0.93
PROBES = 4
RECALL = 0.97
SCALE = 0.7
FITTED = 50_000  # vectors for which SCALE holds
BLOCK = 4_000
#: words of a signature; at cosine 0.93 two differ in 15.3 bits of 128 (standard deviation 3.7), at 0.7 in 32 (4.9)
WORDS, NEAR, STRICT = 2, 26, 9
#: candidates in a cell, and members of a group, beyond which pairs become groups
DEGREE, LARGE = 64, 32
ROW = row_type(WORDS)
SEED = 20_240_501


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8, from its definition."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1.0, -1.0), repeat=8) if np.prod(s) > 0]
    return np.array(out)


NEIGHBOURS = minimal_vectors()


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest point with integer coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    miss = x[odd] - near[odd]
    worst = np.abs(miss).argmax(axis=1)
    near[odd, worst] += np.where(miss[np.arange(len(odd)), worst] >= 0, 1.0, -1.0)
    return near


def nearest_point(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point: the nearer of two cosets of the even-sum lattice."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(closer[:, None], whole, half)


def cell_numbers(points: np.ndarray, salt: int) -> np.ndarray:
    """One 64-bit number for each lattice point (a polynomial of its doubled coordinates)."""
    out = np.full(points.shape[:-1], np.uint64(salt * 2 + 1))
    for k in range(8):
        out = (out ^ (2 * points[..., k]).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out.view(np.int64)


def _cells(x: np.ndarray, salt: int, probes: int) -> np.ndarray:
    """Numbers of the own cell and of the nearest neighbouring ones of each projected point."""
    own = nearest_point(x)
    lean = (x - own) @ NEIGHBOURS.T
    best = np.argpartition(-lean, probes, axis=1)[:, :probes]
    return cell_numbers(np.concatenate([own[:, None, :], own[:, None, :] + NEIGHBOURS[best]], axis=1), salt)


def probed(unit: np.ndarray, tables: int, scale: float, probes: int = PROBES):
    """(table, cell numbers: own first, then the probed ones) for the rows of ``unit``."""
    for t in range(tables):
        projection = np.random.default_rng([SEED, t, unit.shape[1]]).standard_normal((unit.shape[1], 8))
        yield t, _cells(unit @ projection * scale, t, probes)


def meeting_rate(scale: float, threshold: float = THRESHOLD, pairs: int = 20_000) -> float:
    """How often two vectors just at the threshold meet in one table, on drawn projections of such pairs."""
    rng = np.random.default_rng([SEED, 1 << 21])
    x, other = rng.standard_normal((2, pairs, 8))
    y = threshold * x + np.sqrt(1 - threshold**2) * other
    (_, a), (_, b) = ((0, _cells(z * scale, 0, PROBES)) for z in (x, y))
    return float(((a[:, :1] == b).any(axis=1) | (b[:, :1] == a).any(axis=1)).mean())


def parameters(n: int) -> tuple[int, float]:
    """Tables and scale for ``n`` vectors: as many tables as give RECALL at the threshold at that scale.

    A power of 1/8 would keep the rows of a cell at their number; 1/16 lets them grow with the root
    of ``n``, which costs comparisons of signatures in memory, and keeps the tables (the shuffle) few.
    """
    scale = SCALE * max(1.0, n / FITTED) ** (1 / 16)
    return max(1, int(np.ceil(np.log(1 - RECALL) / np.log(1 - min(meeting_rate(scale), 1 - 1e-9))))), scale


def _matrix(column) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(np.float64)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with their class, classes: class, salt, vector, id, size); usable rows only have a class.

    A class is a 64-bit hash of label and vector, and so is its number in edges and groups.
    """
    x = F.col("embedding")
    good = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & x.isNotNull() & (F.size(x) > 0)
    good &= ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists(x, lambda v: v != 0)
    keyed = vectors.select("vec_id", "label", "embedding", F.when(good, F.xxhash64(F.lit(1), "label", "embedding")).alias("class"))
    salt = F.xxhash64(F.lit("label"), "label", F.size("embedding"))
    own = keyed.where("class is not null").groupBy("class").agg(F.first(salt).alias("salt"), F.first("embedding").alias("vector"), F.min("vec_id").alias("id"), F.count("*").alias("size"))
    return keyed.select("vec_id", "class"), own


def signatures(unit: np.ndarray) -> np.ndarray:
    planes = np.random.default_rng([SEED, 1 << 20, unit.shape[1]]).standard_normal((unit.shape[1], 64 * WORDS))
    return np.packbits(unit @ planes > 0, axis=1, bitorder="little").view("<u8").reshape(len(unit), WORDS)


def met(rows: np.ndarray) -> list[tuple[int, int, bool]]:
    """The candidates in one cell, one of the two at home: pairs, or edges of groups where they are very near or many."""
    members = np.flatnonzero(rows["home"])
    words, wide, number = words_of(rows["signature"]), CLOSE * WORDS * rows["wide"].astype(np.int16), rows["class"]
    forest, out = Forest(len(rows)), []
    step = max(1, (1 << 20) // max(len(members), 1))
    for at in range(0, len(rows), step):
        asking = np.arange(at, min(at + step, len(rows)))
        apart = all_bits(words[asking], words[members])
        other = number[asking][:, None] != number[members][None, :]
        close = (apart <= NEAR + wide[asking][:, None] + wide[members][None, :]) & other
        if not close.any():
            continue
        many = close.sum(axis=1) > DEGREE
        grouped = close & ((apart <= STRICT) | many[:, None])
        hit = grouped.any(axis=1)
        if hit.any():
            forest.join(asking[hit], members, grouped[hit])
        a, b = np.nonzero(close & ~grouped)
        out += [(x, y, False) for x, y in zip(number[asking[a]].tolist(), number[members[b]].tolist(), strict=True)]
    return out + [(int(number[a]), int(number[b]), True) for a, b in forest.edges]


def sent_cells(own: DataFrame, tables: int, scale: float, parts: int) -> DataFrame:
    """part, edges, blob: cell rows of many vectors for one part of the cells; or edges of very near vectors."""

    def spread(batches):
        for batch in batches:
            lists = batch.column("vector")
            dims = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(dims):
                same = batch.filter(pa.array(dims == dim)) if not (dims == dim).all() else batch
                unit = _unit(_matrix(same.column("vector")))
                signature, number, salt = signatures(unit), same.column("class").to_numpy(), same.column("salt").to_numpy()
                found = []
                for _, numbers in probed(unit, tables, scale):
                    n, width = numbers.shape
                    rows = np.zeros(n * width, ROW)
                    rows["cell"] = (numbers ^ salt[:, None]).ravel()
                    rows["class"], rows["signature"] = np.repeat(number, width), np.repeat(signature, width, axis=0)
                    rows["home"][::width] = True
                    found.append(rows)
                    if len(found) * len(rows) >= cells.SENT:
                        yield sent_rows(np.concatenate(found), parts)
                        found = []
                if found:
                    yield sent_rows(np.concatenate(found), parts)

    return mapped(own.select("class", "salt", "vector"), spread, SENT_KINDS)


def candidates(own: DataFrame, n: int) -> DataFrame:
    """a, b, merge: the candidates of the ``n`` classes, as pairs or as edges of groups."""
    tables, scale = parameters(n)
    parts = max(12, n * tables // 500_000)
    found = candidate_edges(sent_cells(own, tables, scale, parts), parts, met)
    return found.groupBy("a", "b").agg(F.bool_or("merge").alias("merge"))


def grouped(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(class, group of every class in a group; g, h: pairs of groups to compare, each once), from written candidates.

    A class without a group is a group of its own and has its number. A pair with a group of over LARGE
    members joins both groups to one.
    """
    first = written(components(found.where("merge").select("a", "b")).select(F.col("id").alias("class"), F.col("component").alias("group")), "groups")

    def named(pairs: DataFrame, groups: DataFrame) -> DataFrame:
        for side, name in (("a", "g"), ("b", "h")):
            pairs = pairs.join(groups.select(F.col("class").alias(side), F.col("group").alias(name)), side, "left").withColumn(name, F.coalesce(name, side))
        return pairs.where("g <> h").select(F.least("g", "h").alias("g"), F.greatest("g", "h").alias("h")).distinct()

    pairs = written(named(found.where("not merge").select("a", "b"), first), "pairs")
    large = written(first.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > LARGE).select("group"), "large")
    at = lambda name: pairs.join(large, F.col(name) == F.col("group"), "left_semi")
    joined = at("g").union(at("h")).distinct()
    if joined.isEmpty():
        return first, pairs
    edges = first.where("class <> group").select(F.col("class").alias("a"), F.col("group").alias("b")).union(joined.select(F.col("g").alias("a"), F.col("h").alias("b")))
    second = written(components(edges).select(F.col("id").alias("class"), F.col("component").alias("group")), "groups")
    return second, written(named(pairs.select(F.col("g").alias("a"), F.col("h").alias("b")), second), "pairs")


KEYS = ["group", "other", "i", "j"]
COMPARED = "a long, b long, n long"


def compared(batches):
    """Rows of KEYS, sorted: of a group (other is the same) all pairs of two blocks; else members of two groups, told apart by ``own``."""
    for group in runs_of(batches, KEYS):
        if group.num_rows < 2:
            continue
        number, sizes, block = group.column("class").to_numpy(), group.column("size").to_numpy(), group.column("own").to_numpy()
        vectors = group.column("vector").combine_chunks()
        dims = np.diff(vectors.offsets.to_numpy())
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            yield linked(number[own], sizes[own], block[own], _unit(_matrix(vectors.take(pa.array(own)))), group.column("i")[0].as_py(), group.column("j")[0].as_py())


def linked(number, sizes, block, unit, i, j) -> pa.RecordBatch:
    """a, b, n: the number n of vectors that class a links to (b null), or an edge a, b of their forest."""
    first, second = np.flatnonzero(block == i), np.flatnonzero(block == j)
    n, forest = np.zeros(len(number), np.int64), Forest(len(number))
    for at in range(0, len(first), 1024):
        rows_ = first[at : at + 1024]
        close = (unit[rows_] @ unit[second].T >= THRESHOLD) & (number[rows_][:, None] != number[second][None, :])
        n[rows_] += close @ sizes[second]
        if i != j:
            n[second] += sizes[rows_] @ close
        hit = close.any(axis=1)
        if hit.any():
            forest.join(rows_[hit], second, close[hit])
    some, edges = np.flatnonzero(n), np.array(forest.edges, np.int64).reshape(-1, 2)
    a, b = np.r_[number[some], number[edges[:, 0]]], np.r_[number[some], number[edges[:, 1]]]
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, mask=np.arange(len(b)) < len(some)), pa.array(np.r_[n[some], np.zeros(len(edges), np.int64)])], ["a", "b", "n"])


def verified(own: DataFrame, groups: DataFrame, pairs: DataFrame) -> DataFrame:
    """a, b, n of all comparisons: within groups by pairs of blocks, and between the groups of a pair."""
    rows = own.select("class", "size", "vector").join(groups, "class", "left").withColumn("group", F.coalesce("group", "class"))
    sizes = groups.groupBy("group").agg(F.count("*").alias("n"))
    inside = in_blocks(rows.join(sizes, "group"), "n", "class", BLOCK).select("group", F.col("group").alias("other"), "i", "j", "own", "class", "size", "vector")
    side = lambda name, k: pairs.join(rows.withColumnRenamed("group", name), name).select(F.col("g").alias("group"), F.col("h").alias("other"), F.lit(0).alias("i"), F.lit(1).alias("j"), F.lit(k).alias("own"), "class", "size", "vector")
    dealt = inside.union(side("g", 0)).union(side("h", 1))
    return mapped(dealt.repartition(*KEYS).sortWithinPartitions(*KEYS), compared, COMPARED)


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors`` (vec_id, embedding, label)."""
    keyed, own = classes(only(vectors, "vec_id", "embedding", "label").withColumn("vec_id", F.col("vec_id").cast("long")))
    own = written(own, "classes")
    met_ = written(candidates(own, own.count()), "candidates")
    groups, pairs = grouped(met_)
    found = written(verified(own, groups, pairs), "links")
    counts = found.where("b is null").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b")).select(F.col("id").alias("class"), "component")
    judged = own.select("class", "id", "size").join(counts, "class", "left").join(roots, "class", "left").withColumn("component", F.coalesce("component", "class"))
    first = judged.groupBy("component").agg(F.min("id").alias("component_id"))
    judged = judged.join(first, "component").select("class", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    found = keyed.join(judged, "class", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return found.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))
