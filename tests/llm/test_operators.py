"""Every training-data query against a brute-force version over a small fixture."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

from carrel.llm import catalog, cells, chat, language, lattice, media, packing, quality, sentence_pieces, sentences, simhash, suffixes


WORDS = "the of and ston thing ere here anble tion other wh over and in to it ourt".split()


def prose(rng, n):
    out = []
    while len(out) < n:
        s = [rng.choice(WORDS) + rng.choice(["", "", "an", "er", "on"]) for _ in range(rng.randint(4, 12))]
        out += [s[0].title(), *s[1:-1], s[-1] + "."]
    return " ".join(out[:n])


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def ran(spark, name, folder):
    return [r.asDict() for r in catalog.QUERIES[name](spark, folder).collect()]


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_empty_tables(spark, empty_folder, name):
    rows = ran(spark, name, empty_folder)
    assert len(rows) == (1 if name.startswith("op4") else 0)


def test_rows_without_ids_very_long_texts_and_repeated_rows(spark, tmp_path):
    """Every query of documents gives a row (or pieces) for each of them, and equal texts equal values."""
    rng = random.Random(17)
    long = prose(rng, 190_000)
    assert len(long) > 1_000_000
    rows = [(None, "one two three", "en"), (None, "one two three", "en"), (None, None, None), (1, long, "en"), (1, long, "en"), (2, "", "de"), (3, "eins zwei drei", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in catalog.QUERIES:
        if name.startswith(("op4", "op8", "op11")):
            continue
        found = ran(spark, name, str(tmp_path))
        by = defaultdict(list)
        for r in found:
            by[r["doc_id"]].append({k: v for k, v in r.items() if k not in ("sequence_id", "offset")})
        assert set(by) == {None, 1, 2, 3}, name
        if name.startswith("op6"):
            assert len(by[None]) == 3 and len(by[1]) % 2 == 0 and sum(r["length"] for r in by[1]) > 200_000
            continue
        assert {k: len(v) for k, v in by.items()} == {None: 3, 1: 2, 2: 1, 3: 1}, name
        if name.startswith("op12"):  # of two equal rows one is the other's next document
            assert by[1][0]["fingerprint"] == by[1][1]["fingerprint"] and {r["near_next"] for r in by[1]} == {0.0, 1.0}
            continue
        assert by[1][0] == by[1][1], name
    by5 = [r for r in ran(spark, "op5_suffix_merge_dedup", str(tmp_path)) if r["doc_id"] == 1]
    assert by5[0]["n_bytes"] == len(long)


def test_sentence_pieces(spark, folder, doc_rows):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter()
    for i, t, _ in doc_rows:
        ids = [*library.encode(t or ""), library.eos_id()]
        want[(i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)))] += 1
    rows = ran(spark, "op1_sentence_pieces", folder)
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows) == want
    assert all(r["by_agenda"] for r in rows)


def test_sentence_pieces_say_when_the_library_stepped_in(monkeypatch):
    codec = sentence_pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    monkeypatch.setattr(codec, "many_ids", lambda chunks: [(1,)] * len(chunks))
    assert codec.encode_all(["some text"])[0][0] == [*codec.library.encode("some text"), codec.end]
    assert not codec.agreed


def test_sentence_pieces_odd_texts():
    codec = sentence_pieces.PieceCodec(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(2)
    letters = "ab \n\t▁é世😀<0x0A></s>  ."
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)] + ["x" * 700, "héllo" * 90, " ", "▁▁"]
    assert [ids for ids, _ in codec.encode_all(texts)] == [[*ids, codec.end] for ids in codec.library.encode(texts)]
    for t in texts[:60]:  # the one-chunk heap agrees with the arrays
        for c in codec.chunks(t):
            assert codec.chunk_ids(c) == codec.many_ids([c])[0]


def test_encode_then_decode_operator(spark, folder, doc_rows):
    from carrel.llm.common import table

    path = public_tokenizers.path("piece_bpe_32k.model")
    back = {r["doc_id"]: r["text"] for r in sentence_pieces.decoded(sentence_pieces.encoded(table(spark, folder, "documents"), path), path).collect()}
    assert all(back[i] == (t or "") for i, t, _ in doc_rows)


def components_of(items, linked):
    up = {i: i for i in items}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in items}


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, folder, doc_rows):
    prints = {i: slow_fingerprint(t) for i, t, _ in doc_rows}
    want = components_of(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4])
    for r in ran(spark, "op2_simhash_near_dedup", folder):
        assert r["fingerprint"] == f"{prints[r['doc_id']]:016x}"
        assert r["component_id"] == want[r["doc_id"]]


def test_vantage_point_shards_lose_no_link(spark):
    rng = np.random.default_rng(3)
    points = rng.integers(0, 1 << 63, 400, np.uint64)
    for centre in points[:6].tolist():  # dense groups and chains
        for _ in range(60):
            flips = rng.choice(64, rng.integers(1, 6), replace=False)
            points = np.append(points, np.uint64(centre) ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64)))
    points = np.unique(points)
    tree = simhash.grow(points[::3], 20, [])
    out: list = []
    simhash.route(tree, points, np.arange(len(points)), np.ones(len(points), bool), out)
    shards = defaultdict(list)
    for shard, at, home in out:
        shards[shard] += list(zip(at.tolist(), home.tolist(), strict=True))
    edges = []
    for members in shards.values():
        ids = np.array([i for i, _ in members])
        forest = simhash.Forest(len(ids))
        simhash.compare(points[ids], np.flatnonzero([h for _, h in members]), np.arange(len(ids)), forest)
        assert len(forest.edges) < len(ids)
        edges += [(int(ids[a]), int(ids[b])) for a, b in forest.edges]
    close = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    assert all(close[a, b] for a, b in edges)
    n = range(len(points))
    assert components_of(n, edges) == components_of(n, [(a, b) for a, b in zip(*np.nonzero(np.triu(close, 1)), strict=True)])


def slow_similar(texts):
    """Components of all pairs of five-word sets with a Jaccard similarity of 0.8 or more; texts without words are alike."""
    sets = {}
    for i, t in texts:
        words = (t or "").encode().lower().split()
        sets[i] = {b" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    linked = [(a, b) for a, b in itertools.combinations(sets, 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    return components_of(sets, linked)


def test_near_copies_of_the_stage(spark, doc_rows, monkeypatch):
    """Against all pairs: copies with a few words changed, chains, a dense group whose first class is not near all, clean texts."""
    rng = random.Random(13)
    texts = {i: t for i, t, _ in doc_rows}
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(4000)]
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([12, 60, 200, 900]))]
        for k in range(rng.choice([2, 3, 9])):
            own = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                own[rng.randrange(len(own))] = rng.choice(words)
            texts[1000 + 20 * g + k] = " ".join(own)
    chain = [rng.choice(words) for _ in range(150)]
    for k in range(14):
        texts[2000 + k] = " ".join(chain)
        chain[10 * k : 10 * k + 9] = [rng.choice(words) for _ in range(9)]
    want = slow_similar(texts.items())
    docs = spark.createDataFrame([*texts.items(), (None, texts[1000])], "doc_id long, text string").repartition(3)
    for block in (500, 4):
        monkeypatch.setattr(simhash, "BLOCK", block)
        got = {r["doc_id"]: r["component_id"] for r in simhash.near_copies(docs).collect()}
        assert got.pop(None) == want[1000]
        assert got == want
    assert len(set(want.values())) < len(want) - 30


def test_band_keys_meet_at_the_similarity():
    rng = np.random.default_rng(4)
    met = near = 0
    for _ in range(400):
        base = rng.integers(0, 1 << 63, 400, np.uint64)
        other = base.copy()
        other[:44] = rng.integers(0, 1 << 63, 44, np.uint64)  # Jaccard 356 / 444
        (p, a), (q, b) = simhash.sketch(np.sort(base)), simhash.sketch(np.sort(other))
        met += bool((a == b).any())
        near += (p ^ q).bit_count() <= cells.NEAR
    assert met >= 392 and near >= 396


def slow_kneser_ney(counts):
    """p of a run by the textbook recursion over Counters of four-letter tuples."""
    orders = {4: counts}
    for k in (3, 2, 1):
        orders[k] = Counter(g[1:] for g in orders[k + 1])
    tables = {}
    for k, c in orders.items():
        n = Counter(c.values())
        d = quality.discounts(n[1], n[2], n[3], n[4])
        total, held = Counter(), Counter()
        for g, m in c.items():
            total[g[:-1]] += m
            held[g[:-1]] += d[min(m, 3) - 1]
        tables[k] = (c, d, total, held)
    letters = max(2, len({g[-1] for g in counts}) + 1)

    def p(g):
        if not g:
            return 1 / letters
        c, d, total, held = tables[len(g)]
        if not total[g[:-1]]:
            return p(g[1:])
        own = (c[g] - d[min(c[g], 3) - 1]) / total[g[:-1]] if c[g] else 0.0
        return own + held[g[:-1]] / total[g[:-1]] * p(g[1:])

    return p


def spelled(text, signs):
    """The letters of a text as the model reads them, written anew: UTF-16 units, digits and blanks alike."""
    words, out, before = text.split(" "), [], None
    for w in words:
        if w and w == before:
            if signs:
                out.append("\x02")
        else:
            out.append(w)
        before = w
    units = []
    for c in "\x01\x01\x01" + " ".join(out):
        if ord(c) > 0xFFFF:
            raw = c.encode("utf-16-be")
            units += [raw[:2].hex(), raw[2:].hex()]
        else:
            units.append("0" if c.isdigit() else " " if c.isspace() and c != "\n" else c)
    return [tuple(units[i : i + 4]) for i in range(len(units) - 3)]


SCRIPTS = ["안녕하세요 저는 오늘 학교에 갑니다 그리고 책을 읽습니다", "這說話的人是誰我們不知道他在說什麼", "體龍鳳風雨雷電山川河流草木鳥獸", "उसने कहा कि वह कल आएगा", "😀😁😂 text 😀😁", "٣٤٥ 345 x"]


def test_quality_perplexities(spark, doc_rows, tmp_path):
    rows = [*doc_rows, *((70 + k, t * (1 + k % 2), "zz") for k, t in enumerate(SCRIPTS * 2)), (None, "a row without an id and 안녕", "en"), (None, "a row without an id and 안녕", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 76, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    trusted = [t for i, t, _ in rows if i is not None and i < 76 and i % 2 == 0 and t]
    p = slow_kneser_ney(Counter(g for t in trusted for g in spelled(t, False)))
    found = ran(spark, "op3_quality_classifier", str(tmp_path))
    assert len(found) == len(rows)
    by_doc = {r["doc_id"]: r for r in found}
    for i, t, _ in rows:
        own = spelled(t or "", True)
        assert by_doc[i]["n_runs"] == len(own)
        if own:
            want = np.exp(-np.mean([np.log(p(g)) for g in own]))
            assert by_doc[i]["perplexity"] == pytest.approx(want, rel=1e-5)
        else:
            assert by_doc[i]["perplexity"] is None and not by_doc[i]["kept"]


def test_quality_tells_scripts_apart():
    kinds = [tuple(quality.runs([t])[0].tolist()) for t in ("這說話", "體龍鳳", "안녕하", "세요저", "😀", "😁")]
    assert len(set(kinds)) == len(kinds)


def test_quality_learns_from_every_trusted_text(spark, tmp_path):
    """Texts of one letter each, no two alike: a text left out of the training would cost more than the others."""
    n = 20_400
    spark.createDataFrame([(k, chr(0x4E00 + k), "zh") for k in range(n)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(n)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    found = ran(spark, "op3_quality_classifier", str(tmp_path))
    assert len(found) == n and len({r["perplexity"] for r in found}) == 1


def test_quality_separates_junk(spark, tmp_path):
    rng = random.Random(1)
    good = [(k, prose(rng, 150), "en") for k in range(120)]
    junk = [(200 + k, " ".join(w.upper() + "!!" for w in prose(rng, 100).split()), "en") for k in range(5)] + [(300 + k, " ".join(w for x in prose(rng, 8).split() for w in [x] * 15), "en") for k in range(5)]
    spark.createDataFrame(good + junk, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 120, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"]: r["kept"] for r in ran(spark, "op3_quality_classifier", str(tmp_path))}
    assert all(kept[i] for i, *_ in good)
    assert not any(kept[i] for i, *_ in junk)


def test_chat_round_trip(spark, tmp_path):
    turns = [(1, 0, "user", "hi </turn> <turn:assistant> \\e \\l"), (1, 1, "assistant", "a\\<b>\n"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, None, "tail"), (2, 0, "system", "only"), (3, 0, "assistant", "é😀"), (None, 0, "user", "x"), (4, 0, "user", "t"), (4, 0, "user", "t")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in ran(spark, "op4_chat_formatting", str(tmp_path))}
    turns += [(-7, 0, "user", chat.PLANTED), (-7, 1, "assistant", chat.PLANTED)]
    by = defaultdict(list)
    for c, _, role, text in turns:
        by[c].append((role or "", text or ""))
    assert set(got) == set(by)
    esc = lambda s: s.replace("\\", "\\e").replace("<", "\\l").replace(">", "\\g")
    for c, rows in by.items():
        loss = "".join(t for r, t in rows if r == "assistant")
        blocks = [f"<turn:{esc(r)}>{esc(t)}</turn>\n" for r, t in rows]
        ends = [k for k, (r, _) in enumerate(rows) if r == "assistant" or k == len(rows) - 1]
        r = got[c]
        assert (r["n_turns"], r["turns_sha256"]) == (len(rows), sha("".join(f"{a}\n{b}\n" for a, b in rows)))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(loss), sha(loss))
        assert r["formatted_chars"] == sum(len("".join(blocks[: k + 1])) for k in ends)


def test_chat_examples_mask_one_reply(spark):
    turns = spark.createDataFrame([(1, 0, "user", "q1"), (1, 1, "assistant", "a<1"), (1, 2, "user", "q2"), (1, 3, "assistant", "a2")], "conv_id long, turn long, role string, text string")
    rows = sorted(chat.examples(turns).collect(), key=lambda r: r["example"])
    assert [r["formatted"][r["loss_start"] : r["loss_start"] + r["loss_length"]] for r in rows] == ["a\\l1", "a2"]
    assert rows[1]["formatted"].startswith(rows[0]["formatted"])


def slow_removal(docs):
    seen, out = set(), {}
    for i, raw in sorted(docs):
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            w = raw[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out[i] = (len(raw), sum(gone), spans, sha(bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def suffix_results(spark, rows, at, partitions=5):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions).write.parquet(f"{at}/documents.parquet")
    return [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in ran(spark, "op5_suffix_merge_dedup", str(at))]


def test_suffix_dedup(spark, folder, doc_rows):
    want = slow_removal({(i, (t or "").encode()) for i, t, _ in doc_rows})
    rows = ran(spark, "op5_suffix_merge_dedup", folder)
    assert len(rows) == len(doc_rows)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]


@pytest.mark.parametrize("hot", [4, 200_000])
@pytest.mark.parametrize("line", [33, 60, 95, 130])
def test_suffix_dedup_of_a_line_in_half_of_all_documents(spark, tmp_path, monkeypatch, hot, line):
    """A common line within differing texts, with its gram split by windows (hot) and not; rows that are there twice."""
    monkeypatch.setattr(suffixes, "HOT", hot)
    monkeypatch.setattr(suffixes, "HELD", 400)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 9_000)
    rng = random.Random(line)
    common = prose(rng, 40)[:line]
    rows = [(k, prose(rng, rng.randint(0, 60)) + (common if k % 2 else "") + prose(rng, rng.randint(0, 30))) for k in range(160)]
    rows += [(200 + k, rows[k][1][: rng.randint(90, 200)]) for k in range(40)] + [(300, "x" * 350), (301, "xy" * 300), (302, None), (303, "é世" * 90)]
    rows += rows[:20] + rows[-4:]
    want = slow_removal({(i, (t or "").encode()) for i, t in rows})
    found = suffix_results(spark, rows, tmp_path)
    assert len(found) == len(rows)
    assert all(r == want[i] for i, r in found)
    assert sum(r[1] for _, r in found) > 2000


def test_suffix_dedup_of_texts_under_one_id_and_none(spark, tmp_path):
    """Parts of one document are ordered by the checksum of their texts; rows without an id are left whole."""
    rng = random.Random(8)
    shared, texts = prose(rng, 60), []
    for k in range(3):
        texts.append(prose(rng, 30) + shared + prose(rng, 5 + k))
    found = suffix_results(spark, [(5, texts[0]), (5, texts[1]), (6, texts[2]), (None, texts[2]), (None, texts[2])], tmp_path)
    first, second = sorted(texts[:2], key=lambda t: zlib.crc32(t.encode()))
    want = slow_removal({(0, first.encode()), (1, second.encode()), (2, texts[2].encode())})
    assert sorted(r for i, r in found if i == 5) == sorted((want[0], want[1]))
    assert [r for i, r in found if i == 6] == [want[2]]
    assert all(r[1] == 0 and r[3] == sha(texts[2]) for i, r in found if i is None)


def test_suffix_dedup_never_trusts_a_hash(spark, tmp_path, monkeypatch):
    """With hashes that collide all the time, the bytes still decide."""
    monkeypatch.setattr(suffixes, "gram_hashes", lambda x: np.arange(max(0, len(x) - 31), dtype=np.uint64) * np.uint64(0) + np.uint64(7 << 40))
    rng = random.Random(5)
    texts = [prose(rng, 60).encode() for _ in range(3)]
    entries = []
    for i, raw in enumerate(texts):
        x = np.frombuffer(raw, np.uint8)
        for p, a, b, _ in zip(*(v.tolist() for v in suffixes.anchors(x, np.array([len(x)]))), strict=True):
            entries += [(e, left, i, at, least, most) for e, left, at, least, most in suffixes._entries(raw, [{"at": p, "span": (p - a) << 8 | (b - a)}], np.zeros(0, np.uint64))]
    entries.sort()
    right = np.array([0, *(suffixes.shared(x[0], y[0], 0) for x, y in itertools.pairwise(entries))]) - 6
    place, common = suffixes._neighbours([e[1] for e in entries])
    rank = np.argsort(np.argsort([e[2] * 10**6 + e[3] for e in entries]))
    low, high = suffixes.equal_windows(right, place, common, rank, np.array([e[4] for e in entries]), np.array([e[5] for e in entries]))
    gone = {i: set() for i in range(3)}
    for e, a, b in zip(entries, low.tolist(), high.tolist(), strict=True):
        if b >= 0:
            gone[e[2]] |= set(range(e[3] - b, e[3] - a + 100))
    want = slow_removal(set(enumerate(texts)))
    assert {i: len(x) for i, x in gone.items()} == {i: w[1] for i, w in want.items()}


def test_suffix_dedup_small_segments(spark, doc_rows, monkeypatch):
    """Texts longer than a segment are cut for the search without changing the result."""
    x = ("abcdefghij" * 9 + "".join(random.Random(4).choice("abcdef") for _ in range(900))).encode()
    for segment in (150, 333):
        found = set()
        monkeypatch.setattr(suffixes, "SEGMENT", segment)
        for at, part in suffixes._segments(x):
            a, first, last, _ = suffixes.anchors(np.frombuffer(part, np.uint8), np.array([len(part)]))
            for f, g in zip(first.tolist(), last.tolist(), strict=True):
                windows = set(range(at + f, at + g + 1))
                assert not windows & found
                found |= windows
        assert found == set(range(len(x) - 99))


def test_loser_tree_merges_front_coded_runs():
    rng = random.Random(7)
    strings = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(300)]
    for k in (1, 2, 3, 7):
        runs = [sorted(strings[j::k]) for j in range(k)]
        coded = [suffixes.front_decoded(suffixes.front_coded(r)) for r in runs]
        assert [c[0] for c in coded] == runs
        order, common = suffixes.merged(coded)
        heads = [iter(r) for r in runs]
        got = [next(heads[r]) for r in order]
        assert got == sorted(strings)
        assert common[1:].tolist() == [suffixes.shared(a, b, 0) for a, b in itertools.pairwise(got)]
    assert [x.tolist() for x in suffixes.merged([])] == [[], []]


def test_packing(spark, folder, doc_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, t, _ in doc_rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(itertools.pairwise(cuts)):
            want[(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    rows = ran(spark, "op6_best_fit_packing", folder)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    total = sum(r["length"] for r in rows)
    assert len(by) <= -(-total // 1024) + 2


def test_packing_ids_of_added_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # as loaded
    token = "<|endoftext|>"
    texts = [f"end {token} next", token, f"{token}{token} a", f"x{token}\n{token} " * 700, "<|endoftext", "<|endoftext|", f"  {token}  é世😀", "plain text.", "", " "]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = set()
    for i, t in enumerate(texts):
        ids = [*tokenizer.encode(t, add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want |= {(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(itertools.pairwise(cuts))}
    rows = ran(spark, "op6_best_fit_packing", str(tmp_path))
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert tokenizer.encode(texts[0], add_special_tokens=False).ids == [437, 220, 50256, 1306]


@pytest.mark.parametrize("n", [0, 1, 40, 5000])
def test_plan_covers_histogram(n):
    lengths = np.minimum(np.random.default_rng(n).integers(1, 1300, n), 1024)
    histogram = dict(Counter(lengths.tolist()))
    found = packing.plan(histogram)
    used = Counter()
    for content, times in found:
        assert sum(content) <= 1024
        for x in content:
            used[x] += times
    assert used == histogram
    assert sum(t for _, t in found) <= -(-int(lengths.sum()) // 1024) * 1.02 + 1


def test_media(spark, folder, doc_rows):
    got = defaultdict(list)
    for r in ran(spark, "op7_media_columns", folder):
        got[r["doc_id"]].append(r)
    features = defaultdict(set)
    for i, t, _ in doc_rows:
        raw = (t or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        r = got[i][0]
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) == (len(raw), len(payload), sha(payload), zlib.crc32(payload[-64:]))
        stored = media.wav_bytes(payload)
        assert (r["media_bytes"], r["media_sha256"]) == (len(stored), sha(stored))
        features[t or ""].add(r["feature"])
    assert all(len(x) == 1 for x in features.values())


def test_peak_pairs_by_hand():
    magnitude = np.zeros((4, 65))
    magnitude[0, 5], magnitude[1, 9], magnitude[1, 20], magnitude[3, 7] = 3, 2, 1, 4
    when, code = media.peak_pairs(media.peaks(magnitude))
    pairs = {(t, c >> 12, c >> 4 & 255, c & 15) for t, c in zip(when.tolist(), code.tolist(), strict=True)}
    assert pairs == {(0, 5, 9, 1), (0, 5, 20, 1), (1, 9, 7, 2), (1, 20, 7, 2)}


def slow_pairs(samples):
    """Frame by frame: a direct Fourier sum, local maxima by comparison, pairs by loops."""
    sound = [0.0] * 64 + [x - 128.0 for x in samples] + [0.0] * 64
    turn = np.exp(-2j * np.pi * np.outer(np.arange(65), np.arange(128)) / 128)
    tops = []
    for at in range(0, len(sound) - 127, 64):
        m = np.abs(turn @ (np.array(sound[at : at + 128]) * np.hanning(128)))
        found = [k for k in range(1, 64) if m[k] > m[k - 1] and m[k] >= m[k + 1] and m[k] > 1e-6]
        tops.append(sorted(found, key=lambda k: -m[k])[:2])
    return sorted((t, a << 12 | b << 4 | g) for t in range(len(tops)) for g in (1, 2) if t + g < len(tops) for a in tops[t] for b in tops[t + g])


def test_media_arrays_against_a_direct_transform(spark, folder, doc_rows, monkeypatch):
    rows = {r["doc_id"]: r for r in ran(spark, "op7_media_columns", folder)}
    short = 0
    for i, t, _ in doc_rows:
        raw = (t or "").encode()
        if len(raw) > 3000:
            continue
        r = rows[i]
        assert sorted(zip(r["pair_frame"], r["pair_code"], strict=True)) == slow_pairs(media.padded(raw))
        assert r["feature"].split(";")[2] == str(len(r["pair_code"]))
        short += 0 < len(raw) <= 192 and len(r["pair_code"]) > 0
    assert short > 3
    samples = media.padded(doc_rows[33][1].encode())
    whole = media.described(samples)
    monkeypatch.setattr(media, "FRAMES", 3)
    parts = media.described(samples)
    assert whole[0] == parts[0] and whole[2].tolist() == parts[2].tolist() and whole[3].tolist() == parts[3].tolist()


def test_lattice(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = []
    for k in range(150):
        rows.append((k, rng.standard_normal(16), k % 3))
    for k in range(120):  # neighbours of a few at varied distances, dense groups
        base = rows[k % 6][1]
        rows.append((200 + k, base + rng.standard_normal(16) * rng.choice([0.02, 0.1, 0.2, 0.3]), rows[k % 6][2]))
    rows = [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]
    rows += [(400, rows[0][1], rows[0][2]), (401, rows[0][1], 2 - rows[0][2]), (402, None, 0), (403, [0.0] * 16, 0), (404, [float("nan")] + [1.0] * 15, 0), (405, rows[0][1], None), (406, [1.0, None] + [0.5] * 14, 0), (407, rows[0][1][:8], rows[0][2]), (None, rows[0][1], 0), (408, [float("inf")] + [1.0] * 15, 1)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in ran(spark, "op8_lattice_near_dedup", str(tmp_path))}
    usable = [(i, np.array(v, np.float64), label) for i, v, label in rows if i is not None and label is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    true, found = [], 0
    degree = Counter()
    for (i, a, x), (j, b, y) in itertools.combinations(usable, 2):
        if x == y and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= lattice.THRESHOLD:
            true.append((i, j))
            degree[i] += 1
            degree[j] += 1
    found = sum(r["n_links"] for r in got.values()) / 2
    assert len(true) * 0.9 <= found <= len(true)
    for i, *_ in rows:
        assert got[i]["n_links"] <= degree[i]
        assert got[i]["kept"] == (i is None or got[i]["component_id"] == i)
    for i in (402, 403, 404, 405, 406, 407, 408):
        assert (got[i]["n_links"], got[i]["component_id"]) == (0, i)


def test_lattice_blocks_keep_counts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 7)
    rng = np.random.default_rng(6)
    base = rng.standard_normal(12)
    rows = [(k, [float(x) for x in base + rng.standard_normal(12) * 0.05], 1) for k in range(60)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert {r["n_links"] for r in ran(spark, "op8_lattice_near_dedup", str(tmp_path))} == {59}


@pytest.mark.parametrize("sent", [300, 1 << 19])
def test_lattice_of_doubles_dense_groups_and_repeated_ids(spark, tmp_path, monkeypatch, sent):
    """Cosines that only double precision tells from the threshold; a dense group of many near vectors; one id for two vectors."""
    monkeypatch.setattr(cells, "SENT", sent)
    rng = np.random.default_rng(11)
    rows = []
    for k in range(40):
        a = rng.standard_normal(24)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(24)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        c = lattice.THRESHOLD + (1e-9 if k % 2 else -1e-9)
        rows += [(2 * k, a.tolist(), k), (2 * k + 1, (c * a + np.sqrt(1 - c * c) * b).tolist(), k)]
    base = rng.standard_normal(24)
    rows += [(100 + k, (base + rng.standard_normal(24) * 0.01).tolist(), -1) for k in range(300)]
    rows += [(500, base.tolist(), -2), (500, rng.standard_normal(24).tolist(), -2), (501, base.tolist(), -2)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = ran(spark, "op8_lattice_near_dedup", str(tmp_path))
    assert len(found) == len(rows)
    got = {r["vec_id"]: r for r in found}
    assert all(got[2 * k + j]["n_links"] == 0 for k in range(0, 40, 2) for j in (0, 1))
    assert sum(got[2 * k]["n_links"] for k in range(1, 40, 2)) >= 18
    assert all((got[100 + k]["n_links"], got[100 + k]["component_id"]) == (299, 100) for k in range(300))
    assert sorted(r["n_links"] for r in found if r["vec_id"] == 500) == [0, 1] and got[501]["component_id"] == 500


@pytest.mark.parametrize("inside", [0.5, 0.7])
def test_lattice_prunes_clusters_without_near_vectors(spark, inside):
    """12,000 vectors in 12 clusters of a given inner cosine, some pairs at the threshold planted: few pairs are compared, the planted ones found."""
    rng = np.random.default_rng(13)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centres = unit(rng.standard_normal((12, 64)))
    x = unit(np.sqrt(inside) * np.repeat(centres, 1000, axis=0) + np.sqrt(1 - inside) * unit(rng.standard_normal((12_000, 64))))
    for k in range(0, 12_000, 40):  # a neighbour at cosine 0.94 for one in forty
        away = rng.standard_normal(64)
        away = unit(away - (away @ x[k]) * x[k])
        x[k + 1] = 0.94 * x[k] + np.sqrt(1 - 0.94**2) * away
    links = np.zeros(12_000, np.int64)
    true = []
    for at in range(0, 12_000, 1000):
        close = x[at : at + 1000] @ x.T >= lattice.THRESHOLD
        close[np.arange(1000), at + np.arange(1000)] = False
        links[at : at + 1000] = close.sum(axis=1)
        true += [(at + a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(close)), strict=True) if at + a < b]
    assert len(true) >= 300
    rows = spark.createDataFrame([(k, [float(c) for c in v], 1) for k, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    own = lattice.written(lattice.classes(rows)[1], "classes")
    groups, pairs = lattice.grouped(lattice.written(lattice.candidates(own, 12_000), "candidates"))
    sizes = groups.groupBy("group").count()
    size = {r["group"]: r["count"] for r in sizes.collect()}
    compared = sum(n * (n - 1) // 2 for n in size.values()) + sum(size.get(r["g"], 1) * size.get(r["h"], 1) for r in pairs.collect())
    assert compared < 0.05 * 12_000 * 11_999 / 2
    got = {r["vec_id"]: r for r in lattice.near_duplicates(rows).collect()}
    assert sum(r["n_links"] for r in got.values()) / 2 >= 0.9 * len(true) and all(got[k]["n_links"] <= links[k] for k in range(12_000))
    linked = [(a, b) for a, b in true if got[a]["component_id"] == got[b]["component_id"]]
    want = components_of(range(12_000), linked)
    assert len(linked) >= 0.9 * len(true) and all(got[k]["component_id"] == want[k] for k in range(12_000))


def test_lattice_of_groups_of_all_sizes(spark, tmp_path, monkeypatch):
    """Dense balls, borderline neighbours and large groups that pairs join: links and components as brute force has them, over the pairs found."""
    monkeypatch.setattr(lattice, "LARGE", 6)
    monkeypatch.setattr(lattice, "DEGREE", 5)
    rng = np.random.default_rng(14)
    x = []
    for n, spread in ((60, 0.02), (40, 0.1), (30, 0.2), (20, 0.26), (80, 1.0)):
        base = rng.standard_normal(32)
        x += [base + spread * rng.standard_normal(32) for _ in range(n)]
    x += [x[0] + 0.2 * rng.standard_normal(32) for _ in range(15)]
    rows = [(k, [float(c) for c in v], k % 2 if k > 200 else 0) for k, v in enumerate(x)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r["vec_id"]: r for r in ran(spark, "op8_lattice_near_dedup", str(tmp_path))}
    u = np.array([v for _, v, _ in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    close = (u @ u.T >= lattice.THRESHOLD) & (label[:, None] == label[None, :])
    np.fill_diagonal(close, False)
    assert sum(r["n_links"] for r in got.values()) >= 0.95 * close.sum() and all(got[k]["n_links"] <= close[k].sum() for k in got)
    want = components_of(range(len(rows)), [(a, b) for a, b in zip(*map(np.ndarray.tolist, np.nonzero(close)), strict=True)])
    assert sum(got[k]["component_id"] == want[k] for k in got) >= 0.95 * len(got)


def test_lattice_of_very_large_and_very_small_vectors(spark, tmp_path):
    rng = np.random.default_rng(15)
    base = rng.standard_normal((3, 16))
    rows = [(k, [float(c) for c in base[k % 3] * size], 0) for k, size in enumerate([1e200] * 3 + [1e-200] * 3 + [1.0] * 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = ran(spark, "op8_lattice_near_dedup", str(tmp_path))
    assert all((r["n_links"], r["component_id"]) == (2, r["vec_id"] % 3) for r in got)


def test_lattice_sends_each_vector_a_few_times(spark, tmp_path):
    """Cells travel as numbers: the blobs of a batch are smaller than four times its vectors."""
    rng = np.random.default_rng(12)
    unit = rng.standard_normal((4000, 96))
    own = spark.createDataFrame([(k, 0, [float(x) for x in v], k, 1) for k, v in enumerate(unit.astype(np.float32))], "class long, salt long, vector array<float>, id long, size long").coalesce(1)
    sent = lattice.sent_cells(own, *lattice.parameters(50_000), 12).selectExpr("sum(length(blob)) n").first()["n"]
    assert sent < 2 * 4000 * 96 * 4


def test_e8_decoding():
    rng = np.random.default_rng(8)
    x = rng.standard_normal((300, 8)) * 2
    near = lattice.nearest_point(x)
    doubled = 2 * near
    assert np.allclose(doubled, np.rint(doubled)) and np.allclose(near.sum(axis=1) % 2, 0)
    assert len(lattice.NEIGHBOURS) == 240 and np.allclose((lattice.NEIGHBOURS**2).sum(axis=1), 2)
    gap = ((x - near) ** 2).sum(axis=1)
    for v in lattice.NEIGHBOURS:
        assert (gap <= ((x - near - v) ** 2).sum(axis=1) + 1e-9).all()


def test_lattice_recall_near_the_threshold():
    """Pairs at cosine 0.93 in 64 dimensions meet in some cell at least nine times in ten."""
    rng = np.random.default_rng(9)
    a = rng.standard_normal((2000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((2000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    cosine = rng.uniform(0.93, 0.93001, (2000, 1))
    b = cosine * a + np.sqrt(1 - cosine**2) * b
    met = np.zeros(2000, bool)
    for n in (50_000, 3_000_000, 10**8, 10**10):
        tables, scale = lattice.parameters(n)
        met[:] = False
        for (_, x), (_, y) in zip(lattice.probed(a, tables, scale), lattice.probed(b, tables, scale), strict=True):
            met |= (x[:, :1] == y).any(axis=1) | (y[:, :1] == x).any(axis=1)
        assert met.mean() >= 0.9


def slow_units(text):
    """(start, end, words) of the sentences of a text, letter by letter and window by window."""
    spaceless = lambda c: any(a <= c <= b for a, b in (("\u0e00", "\u0fff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"), ("\u3040", "\u30ff"), ("\u31f0", "\u31ff"), ("\u3400", "\u4dbf"), ("\u4e00", "\u9fff"), ("\uf900", "\ufaff"), ("\U00020000", "\U0003ffff")))
    wide = any(map(spaceless, text))
    cuts, i = [0], 0
    while i < len(text):
        j = i
        if text[i] == "\n" and not (i and text[i - 1] in ".!?" or wide and i and text[i - 1] in "。！？｡"):
            while j < len(text) and text[j] == "\n":
                j += 1
        elif i and text[i - 1] in ".!?" and text[i].isspace() or wide and i and text[i - 1] in "。！？｡" and cuts[-1] != i:
            while j < len(text) and text[j].isspace():
                j += 1
            if j == i:
                cuts.append(i)
        if j > i:
            cuts.append(j)
        i = max(j, i + 1)
    cuts = sorted({*cuts, len(text)})
    out = []
    for a, b in itertools.pairwise(cuts):
        words, k = [], a
        while k < b:
            if text[k].isspace():
                k += 1
                continue
            e = k + 1
            if not (wide and spaceless(text[k])):
                while e < b and not text[e].isspace() and not (wide and spaceless(text[e])):
                    e += 1
            words.append((k, text[k:e].lower()))
            k = e
        size = 16
        if len(words) <= size:
            out.append((a, b, [w for _, w in words]))
            continue
        h = [int.from_bytes(xxhash.xxh3_64_digest(w), "little") for _, w in words]
        inner = {0} | {max(k for k in range(s, s + size) if h[k] == min(h[s : s + size])) for s in range(len(words) - size + 1)}
        places = sorted(inner) + [len(words)]
        for x, y in itertools.pairwise(places):
            out.append((words[x][0] if x else a, words[y][0] if y < len(words) else b, [w for _, w in words[x:y]]))
    return out


def slow_spans(found):
    """Runs of sentences as tuples of words: from every sentence on and back from every one, the shortest of two sentences and 19 words."""
    n, out = len(found), set()
    size = lambda i, j: sum(len(w) for _, _, w in found[i:j])
    for i in range(n):
        out.update([(i, j) for j in range(i + 2, n + 1) if size(i, j) >= 19][:1])
    for j in range(n + 1):
        out.update([(i, j) for i in range(j - 2, -1, -1) if size(i, j) >= 19][:1])
    return {(i, j): tuple(tuple(w) for _, _, w in found[i:j]) for i, j in out}


def test_sentence_spans(spark, doc_rows, tmp_path):
    """Against an independent version that compares words themselves; scripts without spaces, ids that repeat, rows without an id."""
    rng = random.Random(6)
    han = lambda n: "".join(rng.choice("这是一个很长的句子没有空格我们在那里看到山水") + ("。" if rng.random() < 0.06 else "") for _ in range(n))
    passage = han(160)
    rows = [r for r in doc_rows if len(r[1] or "") < 9000] + [(70 + k, han(90) + passage + han(60 + 20 * k), "zh") for k in range(3)]
    rows += [(80, prose(rng, 40) + " " + rows[40][1][:500], "en"), (80, prose(rng, 30) + " " + rows[40][1][:500], "en"), (None, rows[40][1], "en"), (90, "한국어 문장입니다. " * 12 + "ไทยไม่มีช่องว่าง" * 9, "ko")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    texts = sorted({(i, t or "") for i, t, _ in rows if i is not None}, key=lambda x: (x[0], np.uint64(xxhash.xxh64_intdigest(x[1])).astype(np.int64)))
    seen = {}
    for at, (_, t) in enumerate(texts):
        for (i, j), words in slow_spans(slow_units(t)).items():
            seen[words] = min(seen.get(words, (at, i, j)), (at, i, j))
    want, removed = defaultdict(list), 0
    for at, (i, t) in enumerate(texts):
        found = slow_units(t)
        gone = {k for (a, b), words in slow_spans(found).items() if seen[words] != (at, a, b) for k in range(a, b)}
        left = "".join(t[a:b] for k, (a, b, _) in enumerate(found) if k not in gone)
        removed += len(t) - len(left)
        want[i] += [sha(left)] * sum(1 for j, x, _ in rows if j == i and (x or "") == t)
    got = defaultdict(list)
    for r in ran(spark, "op9_sentence_spans", str(tmp_path)):
        got[r["doc_id"]].append(r["kept_sha256"])
    assert got.pop(None) == [sha(rows[40][1])]
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert removed > 4 * 70 * 3 + 2 * 120  # the planted passages and the copies


def test_spans_cover_a_passage_to_its_ends():
    rng = random.Random(3)
    passage = prose(rng, 60).rstrip() + " "
    a, b = prose(rng, 50).rstrip(".\n ") + ". ", prose(rng, 50)
    shared = {h for h, *_ in sentences.spans(passage)}
    t = a + passage + b
    starts = sentences.units(t)[0]
    covered = {k for h, x, y in sentences.spans(t) if h in shared for k in range(x, y)}
    inside = {k for k in range(len(starts) - 1) if len(a) <= starts[k] and starts[k + 1] <= len(a) + len(passage)}
    assert covered == inside


def test_spans_find_passages_pasted_mid_sentence():
    """Against a matcher of 50-word runs: no planted passage goes uncovered, wherever its sentences break."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(3000)]

    def run_of(n, longest):
        out = [rng.choice(words) for _ in range(n)]
        at = rng.randint(1, longest)
        while at < n:
            out[at - 1] += "."
            at += rng.randint(1, longest)
        return out

    for trial in range(300):
        longest = rng.choice([6, 12, 16, 17, 20, 40, 90, 500])
        passage = run_of(rng.choice([50, 50, 51, 60, 120]), longest)
        if trial % 10 == 0:
            passage = [passage[k % (trial // 30 + 1)] for k in range(len(passage))]  # short periods, one repeated word
        texts = []
        for _ in range(2):
            host = run_of(rng.randint(0, 90), longest), run_of(rng.randint(0, 90), longest)
            texts.append((len(host[0]), [*host[0], *passage, *host[1]]))
        seen = {h for h, *_ in sentences.spans(" ".join(texts[0][1]))}
        at, later = texts[1]
        sizes = sentences.units(" ".join(later))[1]
        gone = np.zeros(len(sizes), bool)
        for h, a, b in sentences.spans(" ".join(later)):
            if h in seen:
                gone[a:b] = True
        earlier = {tuple(texts[0][1][k : k + 50]) for k in range(len(texts[0][1]) - 49)}
        held = np.zeros(len(later), bool)
        for k in range(len(later) - 49):
            if tuple(later[k : k + 50]) in earlier:
                held[k : k + 50] = True
        assert held[at : at + len(passage)].all()
        covered = np.repeat(gone, sizes) & held
        assert covered.sum() >= held.sum() - 31, (trial, longest)


def test_language_parsing_matches_brute_force():
    samples = {"en": "the thing that is in the other house of an old man and then", "de": "der mann und die frau in dem alten haus der stadt", "xx": "zzz"}
    parser = language.Parser(samples)

    def slow(text, sample):
        n = i = 0
        while i < len(text):
            k = 1
            while i + k < len(text) + 1 and text[i : i + k] in sample:
                k += 1
            i += max(1, k - 1)
            n += 1
        return n

    rng = random.Random(4)
    texts = ["", "the", "q", "haus", "z" * 1300, "ab" * 900]
    texts += ["".join(rng.choice("thedrinmaus zq") for _ in range(rng.randint(1, 5000))) for _ in range(14)]
    texts += [" ".join(rng.choice(["the", "haus", "house of an old man", "dem alten", "xq"]) for _ in range(900)) for _ in range(4)]
    assert parser.phrases(texts).tolist() == [[slow(t, samples[x]) for x in parser.languages] for t in texts]
    assert parser.judged([None or "", "123 !!", "\u0301\u0302"]) == [("und", 0.0)] * 3


def test_language_segments_join_when_matches_cross_them(monkeypatch):
    monkeypatch.setattr(language, "SEGMENT", 16)
    sample = "abcdefgh" * 40 + " the end of it"
    parser = language.Parser({"x": sample, "y": "hgfedcba"})
    for text in ("abcdefgh" * 30 + "q" + "abcdefgh" * 4, "bcdefgha" * 21, "the end" * 30):
        i = n = 0
        while i < len(text):
            k = next((k for k in range(len(text) - i, 0, -1) if text[i : i + k] in sample), 1)
            i, n = i + k, n + 1
        assert parser.phrases(["", text, "ab"])[1, 0] == n


def test_many_languages_take_as_many_jobs_as_few(spark):
    rng = random.Random(2)

    def jobs(n):
        rows = [(k, prose(rng, 40), f"l{k % n:03}") for k in range(3 * n)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(2)
        spark.sparkContext.setJobGroup(f"languages-{n}", "")
        found = language.learn(docs)
        spark.sparkContext.setJobGroup("none", "")
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"languages-{n}")), found

    few, many = jobs(5), jobs(500)
    assert many[0] <= few[0] + 1
    assert len(many[1]) > 400 and sum(map(len, many[1].values())) <= language.TOTAL
    assert language.samples(spark.createDataFrame([], "doc_id long, text string, lang string")) == {}


def test_language_of_rows_without_an_id(spark, tmp_path):
    rows = [(None, "the old man", "en"), (None, None, "en"), *((k, "the old man and then", "en") for k in range(9))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = [r for r in ran(spark, "op10_language_id", str(tmp_path)) if r["doc_id"] is None]
    assert sorted((r["held_out"], r["lang_pred"]) for r in found) == [(False, "en"), (False, "und")]


def test_language_query(spark, folder, doc_rows):
    rows = {r["doc_id"]: r for r in ran(spark, "op10_language_id", folder)}
    learned = {lang for i, t, lang in doc_rows if lang and t and zlib.crc32(str(i).encode()) % 3 != 1}
    for i, t, _ in doc_rows:
        assert rows[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
        letters = any(c.isalpha() for c in t or "")
        assert (rows[i]["lang_pred"] == "und") == (not letters)
        assert rows[i]["lang_pred"] in learned | {"und"} and 0 <= rows[i]["score"] <= 1
