"""Exact substring dedup: common-prefix-aware distributed merge sort of suffixes.

A byte is removed if a string of LENGTH bytes that covers it also starts earlier: in a document
with a smaller id, or further to the front of the same one. All is judged on the input.

Which suffixes can matter is found first, as in distinguishing-prefix merge sort: in every window
of LENGTH bytes the GRAM-byte string with the least hash is the window's anchor (its place depends
on the window's bytes alone, so equal windows have their anchors at equal places). The hash of an
anchor's gram goes out once for each piece of text; every suffix that begins at an anchor whose
gram occurs again, anywhere, takes part in the sort. Hashes choose these candidates only: what is
removed is decided by the bytes that sorted neighbours share.

A map task sorts its candidates by the hash of their gram, then by their bytes up to the end of
the last window they serve; suffixes of one task that agree in all bytes of their windows are one
entry, their later copies being repeats of it. It front-codes the sorted run (length of the prefix
shared with the entry before, then the rest) and sends a section of it to every range of hashes.
A range merges its sections with a loser tree that keeps, for every section's head, the prefix it
shares with the last entry out, and compares behind it only. Windows with r bytes left of the
anchor are equal where the merged order shares LENGTH - r bytes on the right and the sorted left
contexts share r bytes: both are read off prefixes shared by neighbours.

A gram with more than a bounded number of anchors (a line in very many documents) is no entry of
its own: its windows are sorted as strings of LENGTH bytes under their own hashes, so that they
fall into many ranges and equal windows of a task are one entry.

Null text counts as empty. Rows with a null doc_id are left whole. Rows with equal ids are parts
of one document, ordered by a checksum of their texts; identical rows count once and get the same
result. Empty tables give empty tables; extra columns are left out. Very long texts are cut into
overlapping segments for the search only.
"""

from __future__ import annotations

from array import array
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import mapped, only, pieces, table, written

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1
SEGMENT = 2 << 20
PLACE_BITS = 24
SPREAD = 0x9E3779B97F4B
PART_BYTES = 12 << 20
#: anchors and bytes of candidates that a map task holds before it sends them
HELD = 1 << 19
RUN_BYTES = 12 << 20
#: anchors of one gram in one range; of ten times as many hot grams as this there can't be more than MOST_HOT
HOT = 200_000
MOST_HOT = 1_000_000
_BYTE_CODES = np.random.default_rng(100).integers(1, 1 << 63, 256).astype(np.uint64) | np.uint64(1)


def gram_hashes(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from every place on."""
    h, base, width = _BYTE_CODES[x], 0x9E3779B97F4A7C15, 1
    while width < GRAM:
        h = h[:-width] * np.uint64(base) + h[width:]
        base = base * base % (1 << 64)
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def anchors(x: np.ndarray, ends: np.ndarray):
    """For segments laid end to end in ``x``: anchor, first and last window start, gram hash."""
    starts = np.r_[0, ends[:-1]]
    if len(x) < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    grams = gram_hashes(x)
    least = (grams & ~np.uint64((1 << PLACE_BITS) - 1)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while 2 * reach <= WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < WINDOW:
        least = np.minimum(least[: -(WINDOW - reach)], least[WINDOW - reach :])
    valid = np.zeros(len(x) + 1, np.int32)
    usable = ends - starts >= LENGTH
    np.add.at(valid, starts[usable], 1)
    np.add.at(valid, ends[usable] - LENGTH + 1, -1)
    windows = np.flatnonzero(np.cumsum(valid)[: len(least)] > 0)
    place = (least[windows] & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, (place[1:] != place[:-1]) | (windows[1:] != windows[:-1] + 1)]) if len(place) else np.zeros(0, np.int64)
    last = np.r_[new[1:] - 1, len(place) - 1] if len(new) else new
    at = place[new]
    return at, windows[new], windows[last], grams[at]


def _segments(raw: bytes):
    """(start, bytes) of the parts of one text; windows belong to one part each."""
    for at in range(0, max(len(raw), 1), SEGMENT):
        yield at, raw[at : at + SEGMENT + LENGTH - 1]


ANCHOR = np.dtype([("gram", "<u8"), ("doc", "<i8"), ("key", "<i4"), ("at", "<i4"), ("back", "u1"), ("more", "u1"), ("n", "<u4")])
_FIELDS = [("low", "<u4"), ("high", "<u2"), ("doc", "<i8"), ("key", "<i4"), ("at", "<i4"), ("back", "u1"), ("more", "u1"), ("n", "<u4")]


def _squeezed(blob: bytes) -> bytes:
    return len(blob).to_bytes(8, "little") + pa.compress(blob, codec="zstd", asbytes=True)


def _opened(blob: bytes) -> bytes:
    return pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)


def _packed(rows: np.ndarray) -> bytes:
    """Anchor rows field by field; ids as differences, which compress well."""
    rows = rows[np.lexsort((rows["at"], rows["doc"]))]
    columns = {c: rows[c] for c in ("key", "at", "back", "more", "n")} | {"low": rows["gram"] & np.uint64(0xFFFFFFFF), "high": rows["gram"] >> np.uint64(32), "doc": np.diff(rows["doc"], prepend=0)}
    return _squeezed(b"".join([len(rows).to_bytes(4, "little"), *(columns[c].astype(k).tobytes() for c, k in _FIELDS)]))


def _unpacked(blob: bytes) -> np.ndarray:
    blob = _opened(blob)
    n, at, columns = int.from_bytes(blob[:4], "little"), 4, {}
    for c, k in _FIELDS:
        columns[c] = np.frombuffer(blob, k, n, at)
        at += columns[c].nbytes
    rows = np.zeros(n, ANCHOR)
    rows["gram"] = columns["high"].astype("<u8") << np.uint64(32) | columns["low"]
    rows["doc"] = np.cumsum(columns["doc"])
    for c in ("key", "at", "back", "more", "n"):
        rows[c] = columns[c]
    return rows


def sent_anchors(docs: DataFrame, parts: int) -> DataFrame:
    """part, settled, blob: each gram of a piece once, with its count; grams that the piece itself repeats are settled."""

    def find(batches):
        held: list[np.ndarray] = []

        def anchored(texts):
            x = np.frombuffer(b"".join(s for *_, s in texts), np.uint8)
            ends = np.cumsum([len(s) for *_, s in texts])
            at, first, last, gram = anchors(x, ends)
            rows = np.zeros(len(at), ANCHOR)
            own = np.searchsorted(ends, at, side="right")
            base = np.r_[0, ends[:-1]][own] - np.array([h[2] for h in texts], np.int64)[own]
            rows["gram"] = gram >> np.uint64(16)
            rows["doc"], rows["key"] = np.array([h[0] for h in texts], np.int64)[own], np.array([h[1] for h in texts], np.int32)[own]
            rows["at"], rows["back"], rows["more"] = at - base, at - first, last - first
            held.append(rows)

        def emit():
            rows = np.concatenate(held)
            held.clear()
            rows = rows[np.lexsort((rows["at"], rows["key"], rows["doc"], rows["gram"]))]
            twin = np.r_[False, (rows[1:] == rows[:-1])] if len(rows) else np.zeros(0, bool)  # rows that are in the table twice
            rows = rows[~twin]
            first = np.flatnonzero(np.r_[True, rows["gram"][1:] != rows["gram"][:-1]]) if len(rows) else np.zeros(0, np.int64)
            n = np.diff(np.r_[first, len(rows)])
            here = rows[np.repeat(n > 1, n)]
            lead = rows[first]
            lead["n"] = n
            for c in ("doc", "key", "at", "back", "more"):
                lead[c][n > 1] = 0
            part = (lead["gram"] % np.uint64(parts)).astype(np.int64)
            lead, part = lead[np.argsort(part, kind="stable")], np.sort(part)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True]) if len(part) else np.zeros(1, np.int64)
            out = [(int(part[a]), False, _packed(lead[a:b])) for a, b in pairwise(cuts.tolist())]
            out += [(int(here["gram"][a] % np.uint64(parts)), True, _packed(here[a : a + HELD])) for a in range(0, len(here), HELD)]
            return pa.RecordBatch.from_arrays([pa.array([k for k, *_ in out], pa.int32()), pa.array([s for _, s, _ in out], pa.bool_()), pa.array([b for *_, b in out], pa.binary())], ["part", "settled", "blob"])

        texts, size = [], 0
        for batch in batches:
            for doc_id, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                for at, segment in _segments((text or "").encode()):
                    if len(segment) < LENGTH:
                        continue
                    texts.append((doc_id, key, at, segment))
                    size += len(segment)
                    if size >= SEGMENT:
                        anchored(texts)
                        texts, size = [], 0
                        if sum(map(len, held)) >= HELD:
                            yield emit()
        if texts:
            anchored(texts)
        if held:
            yield emit()

    return mapped(docs, find, "part int, settled boolean, blob binary")


def candidates(sent: DataFrame, parts: int, hot: int) -> DataFrame:
    """doc_id, text_key, at, span of the anchors whose gram occurs again; or only the hash of a gram with over ``hot`` anchors."""

    def marks(rows: np.ndarray, hottest: np.ndarray) -> pa.RecordBatch:
        n, m = len(rows), len(hottest)
        span = rows["back"].astype(np.int32) << 8 | rows["more"]
        columns = [(rows["doc"], pa.int64()), (rows["key"], pa.int32()), (rows["at"], pa.int32()), (span, pa.int32())]
        arrays = [pa.concat_arrays([pa.array(c, k), pa.nulls(m, k)]) for c, k in columns]
        return pa.RecordBatch.from_arrays([*arrays, pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(hottest.astype(np.int64))])], ["doc_id", "text_key", "at", "span", "hot"])

    none = np.zeros(0, np.uint64)

    def settle(batches):
        held = []
        for batch in batches:
            for apart, blob in zip(batch.column("settled").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if apart:
                    yield marks(_unpacked(blob), none)
                else:
                    held.append(_unpacked(blob))
        if held:
            rows = np.concatenate(held)
            held.clear()
            rows = rows[np.argsort(rows["gram"], kind="stable")]
            first = np.flatnonzero(np.r_[True, rows["gram"][1:] != rows["gram"][:-1]])
            total = np.add.reduceat(rows["n"].astype(np.int64), first)
            again = np.repeat(total > 1, np.diff(np.r_[first, len(rows)])) & (rows["n"] == 1)
            yield marks(rows[again], rows["gram"][first[total > hot]])

    return mapped(sent.repartition(2 * parts, "part"), settle, "doc_id long, text_key int, at int, span int, hot long")


def shared(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix; the first ``known`` bytes are known to agree."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - -(-differ.bit_length() // 8)


def front_coded(sorted_run: list[bytes]) -> bytes:
    out, before = [], b""
    for s in sorted_run:
        same = shared(before, s, 0)
        out.append(bytes((same, len(s))) + s[same:])
        before = s
    return b"".join(out)


def front_decoded(blob: bytes) -> tuple[list[bytes], list[int]]:
    """The strings and what each shares with the one before it."""
    strings, common, at, before = [], [], 0, b""
    while at < len(blob):
        same, size = blob[at], blob[at + 1]
        before = before[:same] + blob[at + 2 : at + 2 + size - same]
        strings.append(before)
        common.append(same)
        at += 2 + size - same
    return strings, common


def merged(runs: list[tuple[list[bytes], list[int]]]) -> tuple[array, array]:
    """Loser-tree merge of sorted runs: the run of each string in order, and the prefix shared with the one before.

    ``known[r]`` is what run r's head shares with the last string out. Of two heads, the one that
    shares more comes first; only at a tie are bytes compared, from the shared part on.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads: list[bytes | None] = [runs[r][0][0] if r < len(runs) and runs[r][0] else None for r in range(leaves)]
    known, place = [0] * leaves, [0] * leaves
    loser = [0] * leaves

    def play(a: int, b: int) -> tuple[int, int]:
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        same = shared(x, y, known[a])
        first = x[same:] < y[same:] or (same == len(x) == len(y) and a < b)
        winner, other = (a, b) if first else (b, a)
        known[other] = same
        return winner, other

    def build(node: int) -> int:
        if node >= leaves:
            return node - leaves
        winner, loser[node] = play(build(2 * node), build(2 * node + 1))
        return winner

    top = build(1) if leaves > 1 else 0
    order, common = array("i"), array("h")
    while heads[top] is not None:
        order.append(top)
        common.append(known[top])
        place[top] += 1
        strings, own = runs[top]
        if place[top] < len(strings):
            heads[top], known[top] = strings[place[top]], own[place[top]]
        else:
            heads[top] = None
        node = (top + leaves) // 2
        while node:
            top, loser[node] = play(top, loser[node])
            node //= 2
    return order, common


def _entries(raw: bytes, wanted: list[dict], hottest: np.ndarray):
    """(sort key, left context reversed, place, bytes left of it in its last and first window) of one text's candidates."""
    at = np.array([w["at"] for w in wanted], np.int64)
    grams = gram_hashes(np.frombuffer(b"".join([raw[p : p + GRAM] for p in at.tolist()]), np.uint8))[::GRAM] >> np.uint64(16)
    hot = np.isin(grams, hottest) if len(hottest) else np.zeros(len(at), bool)
    for w, gram, split in zip(wanted, grams.tolist(), hot.tolist(), strict=True):
        p = w["at"]
        first = p - (w["span"] >> 8)
        last = first + (w["span"] & 255)
        if not split:
            # anchors have the least hashes of their windows: a product spreads them over the ranges
            yield (gram * SPREAD & 0xFFFFFFFFFFFF).to_bytes(6, "big") + raw[p : last + LENGTH], raw[first:p][::-1], p, p - last, p - first
            continue
        for start in range(first, last + 1):
            window = raw[start : start + LENGTH]
            yield (xxhash.xxh3_64_intdigest(window) >> 16).to_bytes(6, "big") + window, b"", start, 0, 0


_ENTRY = [("doc", "<i8"), ("key", "<i4"), ("at", "<i4"), ("least", "u1"), ("most", "u1")]


def sorted_runs(docs: DataFrame, marked: DataFrame, parts: int, hottest: np.ndarray) -> DataFrame:
    """part, run, blob: sections of sorted, front-coded runs; where run is false, the ranges of copies within a run."""
    wanted = marked.where("hot is null").groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("at", "span")).alias("wanted"))

    def run(batches):
        def emit():
            order = sorted(range(len(held)), key=held.__getitem__)
            sections: dict[int, list[tuple]] = {}
            copies, before = [], None
            for k in order:
                entry = held[k]
                if before is not None and entry[0] == before[0] and entry[1] == before[1]:
                    if entry[2:5] != before[2:5]:
                        copies.append(entry)  # the earliest place comes first
                    continue
                before = entry
                sections.setdefault(int.from_bytes(entry[0][:6], "big") * parts >> 48, []).append(entry)
            out = []
            for part, own in sections.items():
                columns = dict(zip(("doc", "key", "at", "least", "most"), zip(*(e[2:] for e in own), strict=True), strict=True))
                code = front_coded([e[0] for e in own])
                meta = b"".join(np.array(columns[c], np.int64).astype(k).tobytes() for c, k in _ENTRY)
                out.append((part, True, _squeezed(b"".join([len(own).to_bytes(4, "little"), len(code).to_bytes(4, "little"), code, meta, *(e[1] for e in own)]))))
            if copies:
                doc, key, at, least, most = (np.array(c, np.int64) for c in zip(*(e[2:] for e in copies), strict=True))
                ranges = np.stack([doc, key, at - most, at - least + LENGTH])
                out.append((len(copies) % parts, False, ranges.astype("<i8").tobytes()))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.bool_()), pa.array([x[2] for x in out], pa.binary())], ["part", "run", "blob"])

        held: list[tuple] = []
        size = 0
        for batch in batches:
            seen = set()  # identical rows count once
            for doc_id, key, text, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("text").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                if (doc_id, key) in seen:
                    continue
                seen.add((doc_id, key))
                raw = (text or "").encode()
                for entry, left, at, least, most in _entries(raw, wanted, hottest):
                    held.append((entry, left, doc_id, key, at, least, most))
                    size += len(entry) + len(left)
                    if size >= RUN_BYTES:
                        yield emit()
                        size = 0
        if held:
            yield emit()

    return mapped(docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text_key", "text", "wanted"), run, "part int, run boolean, blob binary")


def _section(blob: bytes):
    """Entries, the prefix each shares with the one before, columns and left contexts of a section."""
    blob = _opened(blob)
    n, size = int.from_bytes(blob[:4], "little"), int.from_bytes(blob[4:8], "little")
    strings, common = front_decoded(blob[8 : 8 + size])
    at, columns = 8 + size, {}
    for c, k in _ENTRY:
        columns[c] = np.frombuffer(blob, k, n, at).astype(np.int64)
        at += n * np.dtype(k).itemsize
    ends = at + np.cumsum(columns["most"] * (columns["most"] > 0))
    left = [blob[b - m : b] for b, m in zip(ends.tolist(), columns["most"].tolist(), strict=True)]
    return strings, common, columns, left


def _neighbours(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Place of each string in sorted order, and the prefix that each in that order shares with the one before."""
    width = WINDOW - 1
    full = [s.ljust(width, b"\0") for s in strings]
    order = np.array(sorted(range(len(full)), key=full.__getitem__))
    letters = np.frombuffer(b"".join(full), np.uint8).reshape(-1, width)
    common = np.zeros(len(full), np.int64)
    for at in range(1, len(full), 65_536):
        differ = letters[order[at : at + 65_536]] != letters[order[at - 1 : at + 65_535][: len(order[at : at + 65_536])]]
        common[at : at + 65_536] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place, common


def equal_windows(right: np.ndarray, left_place: np.ndarray, left_common: np.ndarray, rank: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For entries in merged order: fewest and most bytes left of the anchor of windows that an earlier place has too (-1: none).

    ``right``: bytes right of the anchor shared with the entry before; ``left_place`` and
    ``left_common``: the same for the sorted left contexts; ``rank``: the order of places (equal
    for rows that are in the table twice).
    """
    n = len(right)
    low, high = np.full(n, WINDOW), np.full(n, -1)
    best = np.maximum(right, np.r_[right[1:], 0])
    by_rank = np.argsort(rank, kind="stable")
    for r in range(WINDOW):
        own = by_rank[(least[by_rank] <= r) & (r <= most[by_rank]) & (best[by_rank] >= LENGTH - r)]
        if len(own) < 2:
            continue
        groups = np.cumsum(right < LENGTH - r)[own] * n + np.cumsum(left_common < r)[left_place[own]]
        _, first, group = np.unique(groups, return_index=True, return_inverse=True)
        hit = own[rank[own] > rank[own[first[group]]]]
        low[hit] = np.minimum(low[hit], r)
        high[hit] = np.maximum(high[hit], r)
    return low, high


def repeated(runs: DataFrame, parts: int) -> DataFrame:
    """Merge the sections of each range and give the bytes of windows that an earlier window equals."""
    names = ["doc_id", "text_key", "start", "stop"]

    def covers(doc, key, start, stop):
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(key.astype(np.int32)), pa.array(start.astype(np.int32)), pa.array(stop.astype(np.int32))], names)

    def merge(batches):
        by_part: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, run, blob in zip(batch.column("part").to_pylist(), batch.column("run").to_pylist(), batch.column("blob").to_pylist(), strict=True):
                if run:
                    by_part.setdefault(part, []).append(blob)
                else:
                    yield covers(*np.frombuffer(blob, "<i8").reshape(4, -1))
        for part in list(by_part):
            sections = [_section(b) for b in by_part.pop(part)]
            order, common = merged([s[:2] for s in sections])
            picked = np.empty(len(order), np.int64)
            picked[np.argsort(np.frombuffer(order, np.int32), kind="stable")] = np.arange(len(order))
            left = [x for s in sections for x in s[3]]
            column = {c: np.concatenate([s[2][c] for s in sections])[picked] for c, _ in _ENTRY}
            sections.clear()
            left_place, left_common = _neighbours([left[k] for k in picked.tolist()])
            by_place = np.lexsort((column["at"], column["key"], column["doc"]))
            new = [column[c][by_place][1:] != column[c][by_place][:-1] for c in ("doc", "key", "at")]
            rank = np.empty(len(picked), np.int64)
            rank[by_place] = np.r_[0, np.cumsum(new[0] | new[1] | new[2])]
            low, high = equal_windows(np.frombuffer(common, np.int16).astype(np.int64) - 6, left_place, left_common, rank, column["least"], column["most"])
            hit = np.flatnonzero(high >= 0)
            yield covers(column["doc"][hit], column["key"][hit], column["at"][hit] - high[hit], column["at"][hit] - low[hit] + LENGTH)

    return mapped(runs.repartition(2 * parts, "part"), merge, "doc_id long, text_key int, start int, stop int")


def covered(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, start, stop: byte ranges (they may overlap) whose bytes are repeated."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(12, size // PART_BYTES))
    hot = max(HOT, size // GRAM // MOST_HOT)
    marked = written(candidates(sent_anchors(docs, parts), parts, hot), "anchors")
    hottest = np.sort(np.array([r["hot"] for r in marked.where("hot is not null").select("hot").collect()], np.int64).view(np.uint64))
    return repeated(sorted_runs(docs, marked, parts, hottest), parts)


def kept(docs: DataFrame) -> DataFrame:
    """doc_id, text bytes left, and what was removed, for every row.

    Texts are dealt by id and checksum once: the search for candidates and the removal both join
    the same rows and columns of ``plain``, so that they read one exchange (of a union's branches
    the first keeps its aliases, which would make it another plan: so the rows without an id).
    """
    every = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    every = every.withColumn("text_key", (F.crc32(F.coalesce("text", F.lit("")).cast("binary")) - (1 << 31)).cast("int"))
    plain = every.where("doc_id is not null")
    ranges = covered(plain).groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
    joined = plain.join(ranges, ["doc_id", "text_key"], "left").select("doc_id", "text", "ranges")
    whole = every.where("doc_id is null").select("doc_id", "text", F.lit(None).cast("array<struct<start:int,stop:int>>").alias("ranges"))

    def strip(batches):
        for batch in pieces(batches, SEGMENT):
            rows = []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                raw = (text or "").encode()
                left, removed, spans = raw, 0, 0
                if ranges and raw:
                    own = sorted((r["start"], r["stop"]) for r in ranges)
                    parts, at, open_at = [], 0, None
                    for a, b in own:
                        if open_at is None or a > at:
                            parts.append(raw[at:a])
                            spans += 1
                            open_at = a
                            at = b
                        else:
                            at = max(at, b)
                    parts.append(raw[at:])
                    left = b"".join(parts)
                    removed = len(raw) - len(left)
                rows.append((len(raw), removed, spans, left))
            columns = list(zip(*rows, strict=True)) if rows else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return mapped(whole.union(joined), strip, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op5_suffix_merge_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = kept(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
