"""SimHash near-duplicates, linked exactly by vantage-point trees.

Fingerprints are counted once each. A bounded sample of them builds the upper vantage-point tree
on the driver: a node holds a vantage fingerprint and a radius; nearer fingerprints go left, the
others right. Every fingerprint has one home shard; where the triangle bound cannot exclude
partners on the other side of a radius, it also visits that side as a query. Within a shard the
tree goes on over arrays down to small leaves that are compared outright. Shards grow in number
with the root of the fingerprints: every level of the upper tree sends more guests, while the
levels within a shard send none. A shard reports a
spanning forest of its links, not its pairs, so a dense group costs no more edges than members.
Components of the forest edges are found by star contraction.

Texts: A-Z to lower case, words split at ASCII white space, four-word shingles (fewer words: the
whole sequence; none or null: fingerprint zero, linked like any other). Repeated rows share a
fingerprint. Rows with a null doc_id get a fingerprint and the smallest id of their component
(null if it has none). Extra columns are left out; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm import cells
from carrel.llm.cells import ROW, Forest
from carrel.llm.common import components, mapped, neutral, only, pieces, restored, runs_of, smallest, table, texts_of, written

SHINGLE = 4
RADIUS = 4
SAMPLE = 20_000
ROOTS_PER_SHARD = 8
LEAF = 256
# the pipeline's stage: five words, a Jaccard similarity of 0.8, which ten bands of four permutations
# miss five times in a thousand (1 - 0.8^4, ten times over)
WIDE, SIMILAR = 5, 0.8
BANDS, BAND = 10, 4
_FACTORS, _SUMMANDS = np.random.default_rng(52).integers(1, 1 << 32, (2, BANDS * BAND), np.uint32) | np.array([[1], [0]], np.uint32)
#: rows of a block where a group's sets are compared with one another
BLOCK = 500


def fingerprint(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    digest, n = xxhash.xxh64_intdigest, max(1, len(words) - SHINGLE + 1)
    hashes = np.array([digest(b" ".join(words[i : i + SHINGLE]), 42) for i in range(n)], "<u8")
    bits = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        bits += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * bits > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, print (the 64 bits as a signed long)."""

    def hashed(batches):
        for batch in pieces(batches):
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], ["doc_id", "print"])

    return mapped(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), hashed, "doc_id long, print long")


def _distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Node:
    """A node of the upper tree; a leaf has a shard number."""

    __slots__ = ("far", "near", "radius", "shard", "vantage")


def grow(sample: np.ndarray, leaf: int, shards: list[int]) -> Node:
    """Vantage point: of a few candidates the one whose distances spread most; radius: their median."""
    node = Node()
    node.shard = -1
    if len(sample) > leaf:
        tries = sample[:: max(1, len(sample) // 8)][:8]
        spread = [_distance(sample, v).astype(float).var() for v in tries]
        node.vantage = tries[int(np.argmax(spread))]
        d = _distance(sample, node.vantage)
        node.radius = int(np.median(d))
        near = d <= node.radius
        if near.any() and not near.all():
            node.near, node.far = grow(sample[near], leaf, shards), grow(sample[~near], leaf, shards)
            return node
    node.shard = len(shards)
    shards.append(len(sample))
    return node


def route(node: Node, prints: np.ndarray, at: np.ndarray, home: np.ndarray, out: list) -> None:
    """Append (shard, rows, at home) for every shard that some of ``prints`` live in or must ask.

    A print at home in the near side asks the far side if a partner within RADIUS may lie there;
    a print at home in the far side needs not ask back. A guest asks either side that may hold one.
    """
    if not len(at):
        return
    if node.shard >= 0:
        out.append((node.shard, at, home))
        return
    d = _distance(prints[at], node.vantage).astype(np.int64)
    inside = d <= node.radius
    near = np.where(home, inside, d <= node.radius + RADIUS)
    far = np.where(home, ~inside | (d > node.radius - RADIUS), d > node.radius - RADIUS)
    route(node.near, prints, at[near], home[near], out)
    route(node.far, prints, at[far], home[far] & ~inside[far], out)


def compare(prints: np.ndarray, members: np.ndarray, asking: np.ndarray, forest: Forest, reach: int = RADIUS) -> None:
    """Link every one of ``asking`` to the ``members`` within ``reach`` (both are positions in ``prints``)."""
    if not len(members) or not len(asking):
        return
    if len(members) > LEAF:
        vantage = prints[members[len(members) // 2]]
        d = _distance(prints[members], vantage).astype(np.int64)
        radius = int(np.median(d))
        near = d <= radius
        if near.any() and not near.all():
            q = _distance(prints[asking], vantage).astype(np.int64)
            compare(prints, members[near], asking[q <= radius + reach], forest, reach)
            compare(prints, members[~near], asking[q > radius - reach], forest, reach)
            return
    step = max(1, (1 << 20) // len(members))
    for at in range(0, len(asking), step):
        rows = asking[at : at + step]
        close = _distance(prints[rows][:, None], prints[members][None, :]) <= reach
        close &= rows[:, None] != members[None, :]
        hit = close.any(axis=1)
        if hit.any():
            forest.join(rows[hit], members, close[hit])


def links(distinct: DataFrame, n: int) -> DataFrame:
    """Spanning edges (a, b) of all links between the ``n`` fingerprints in column print."""
    wanted = max(1, round(n**0.5 / ROOTS_PER_SHARD))
    sample = [r["print"] for r in smallest(distinct.select("print"), max(SAMPLE, 8 * wanted), "print", rows=n).collect()]
    points = np.array(sample, np.int64).view(np.uint64)
    shards: list[int] = []
    tree = grow(points, max(2, -(-len(points) // wanted)), shards)

    def dealt(batches):
        for batch in batches:
            prints = batch.column("print").to_numpy().view(np.uint64)
            out: list = []
            route(tree, prints, np.arange(len(prints)), np.ones(len(prints), bool), out)
            for shard, at, home in out:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard, np.int32)), pa.array(prints[at].view(np.int64)), pa.array(home)], ["shard", "print", "home"])

    def linked(rows: pa.Table) -> pa.Table:
        prints, home = rows.column("print").to_numpy().view(np.uint64), rows.column("home").to_numpy(zero_copy_only=False)
        forest = Forest(len(prints))
        compare(prints, np.flatnonzero(home), np.arange(len(prints)), forest)
        edges = np.array(forest.edges, np.int64).reshape(-1, 2)
        return pa.table({"a": prints[edges[:, 0]].view(np.int64), "b": prints[edges[:, 1]].view(np.int64)})

    spread = mapped(distinct.select("print"), dealt, "shard int, print long, home boolean")
    return spread.groupBy("shard").applyInArrow(linked, "a long, b long")


def with_components(found: DataFrame) -> DataFrame:
    """doc_id, print, component_id; ``found`` (doc_id, print) can be read twice alike."""
    distinct = written(found.groupBy("print").agg(F.min("doc_id").alias("least")), "prints")
    edges = links(distinct, distinct.count())
    roots = components(edges).select(F.col("id").alias("print"), "component")
    grouped = distinct.join(roots, "print", "left").select("print", "least", F.coalesce("component", "print").alias("component"))
    smallest = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.join(grouped.join(smallest, "component").select("print", "component_id"), "print").select("doc_id", "print", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    return with_components(written(fingerprints(docs), "fingerprints"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles of WIDE words, in order (fewer words: one, of them all; none: empty)."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + WIDE]), 42) for i in range(max(1, len(words) - WIDE + 1))], np.uint64))


def sketch(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    """SimHash of a set, and BANDS numbers that each stand for the least of BAND permutations of it."""
    if not len(hashes):
        return 0, np.zeros(BANDS, np.int64)
    bits, least = np.zeros(64, np.int64), np.full(BANDS * BAND, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        short = (part ^ (part >> np.uint64(32))).astype(np.uint32)
        least = np.minimum(least, (short[:, None] * _FACTORS + _SUMMANDS).min(axis=0))
    rows = np.ascontiguousarray(least.reshape(BANDS, BAND))
    keys = np.array([xxhash.xxh64_intdigest(row.tobytes(), k) for k, row in enumerate(rows)], np.uint64)
    return int.from_bytes(np.packbits(2 * bits > len(hashes), bitorder="little").tobytes(), "little"), keys.view(np.int64)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, class (a hash of the shingle set), print, n, keys of every row of ``docs`` (doc_id, text)."""

    def work(batches):
        for batch in pieces(batches, 2 << 20):
            rows = []
            for text in texts_of(batch):
                found = shingle_set(text)
                rows.append((xxhash.xxh64_intdigest(found.tobytes()), len(found), *sketch(found)))
            number, n, prints, keys = zip(*rows, strict=True)
            flat = pa.array(np.concatenate(keys))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * BANDS), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.array(number, np.uint64).view(np.int64)), pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(n, pa.int32()), lists], ["doc_id", "class", "print", "n", "keys"])

    return mapped(docs, work, "doc_id long, class long, print long, n int, keys array<long>")


def near_in_cell(rows: np.ndarray) -> list[tuple[int, int, bool]]:
    """The forest of one cell's candidates by a vantage-point tree over its prints."""
    forest, at = Forest(len(rows)), np.arange(len(rows))
    compare(rows["signature"], at, at, forest, cells.NEAR + 2 * cells.CLOSE * bool(rows["wide"].any()))
    return [(int(rows["class"][a]), int(rows["class"][b]), True) for a, b in forest.edges]


def similar_edges(members: DataFrame) -> DataFrame:
    """a, b: edges that connect all classes of a group with a Jaccard similarity of SIMILAR or more.

    ``members``: group, class, items (the sorted shingle set). All are measured against the group's
    first class; of groups with rows that are not similar to it, all rows are compared by blocks.
    """
    first = members.groupBy("group").agg(F.min("class").alias("first"))
    heads = members.join(first, "group").where("class = first").select("group", "first", F.col("items").alias("head"))
    shared = F.size(F.array_intersect("items", "head"))
    union = F.size("items") + F.size("head") - shared
    measured = members.join(heads, "group").where("class <> first").select("group", "class", "first", (shared >= SIMILAR * union).alias("near"))
    measured = written(measured, "measured")
    stars = measured.where("near").select(F.col("class").alias("a"), F.col("first").alias("b"))
    rest = measured.where("not near").select("group").distinct()
    sizes = measured.join(rest, "group", "left_semi").groupBy("group").agg((F.count("*") + 1).alias("size"))
    dealt = cells.in_blocks(members.join(sizes, "group"), "size", "class", BLOCK)
    keys = ["group", "i", "j"]

    def compared(batches):
        for group in runs_of(batches, keys):
            number, block = group.column("class").to_numpy(), group.column("own").to_numpy()
            sets = [x.values.to_numpy() for x in group.column("items").combine_chunks()]
            forest = Forest(len(sets))
            first, second = np.flatnonzero(block == group.column("i")[0].as_py()), np.flatnonzero(block == group.column("j")[0].as_py())
            size = np.array([len(x) for x in sets])
            for a in first.tolist():
                fits = second[(number[second] != number[a]) & (np.minimum(size[second], size[a]) >= SIMILAR * np.maximum(size[second], size[a]))]
                for b in fits.tolist():
                    if forest.root(a) != forest.root(b):
                        both = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                        if both >= SIMILAR * (size[a] + size[b] - both):
                            forest.join(np.array([a]), np.array([b]), np.ones((1, 1), bool))
            edges = np.array(forest.edges, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(number[edges[:, 0]]), pa.array(number[edges[:, 1]])], ["a", "b"])

    return stars.union(mapped(dealt.repartition(*keys).sortWithinPartitions(*keys), compared, "a long, b long"))


def near_copies(docs: DataFrame) -> DataFrame:
    """doc_id, component_id of every row: documents whose shingle sets are similar, by way of others too.

    Equal sets are one class. Classes with an equal band key meet in a cell, where a vantage-point
    tree over their SimHashes finds those within cells.NEAR bits; connected candidates are a group,
    within which the sets themselves decide.
    """
    plain = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = written(sketches(plain), "sketches")
    least = found.where("doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("least"), F.first("print").alias("print"), F.first("keys").alias("keys"), F.first("n").alias("n"))
    least = written(least, "classes")
    parts = max(12, least.count() * BANDS // 2_500_000)

    def spread(batches):
        for batch in batches:
            keys = batch.column("keys").flatten().to_numpy()
            rows = np.zeros(len(keys), ROW)
            rows["cell"], rows["home"] = keys, True
            rows["class"], rows["signature"] = (np.repeat(batch.column(c).to_numpy(), BANDS) for c in ("class", "print"))
            yield cells.sent_rows(rows, parts)

    sent = mapped(least.where("n > 0").select("class", "print", "keys"), spread, cells.SENT_KINDS)
    groups = components(cells.candidate_edges(sent, parts, near_in_cell)).select(F.col("id").alias("class"), F.col("component").alias("group"))
    chosen = least.select("class", "least").join(groups, "class").select("group", "class", F.col("least").alias("doc_id"))

    def sets(batches):
        for batch in pieces(batches, 2 << 20):
            own = [shingle_set(t) for t in texts_of(batch)]
            number = np.array([xxhash.xxh64_intdigest(x.tobytes()) for x in own], np.uint64).view(np.int64)
            same = np.flatnonzero(number == batch.column("class").to_numpy())  # of rows under one id, those of this class
            yield pa.RecordBatch.from_arrays([batch.column("group").take(pa.array(same)), pa.array(number[same]), pa.array([own[k].view(np.int64) for k in same.tolist()], pa.list_(pa.int64()))], ["group", "class", "items"])

    members = mapped(plain.join(chosen, "doc_id").select("group", "class", "text"), sets, "group long, class long, items array<long>")
    members = written(members.dropDuplicates(["group", "class"]), "members")
    roots = components(similar_edges(members)).select(F.col("id").alias("class"), "component")
    judged = least.select("class", "least").join(roots, "class", "left").withColumn("component", F.coalesce("component", "class"))
    kept = judged.groupBy("component").agg(F.min("least").alias("component_id"))
    return found.select("doc_id", "class").join(judged.join(kept, "component").select("class", "component_id"), "class", "left").select("doc_id", "component_id")


def keep_first(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies (five-word shingles, Jaccard 0.8 or more), the smallest id stays.

    Rows without an id stay; texts without a word are one group; rows under one id go or stay together.
    """
    gone = near_copies(docs).where("doc_id <> component_id").select("doc_id").distinct()
    return restored(neutral(docs, "doc_id").join(gone, "doc_id", "left_anti"), docs, "doc_id")
