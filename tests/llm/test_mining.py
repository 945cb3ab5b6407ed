"""Collocations, document fingerprints and periodic runs against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from carrel.llm import catalog, collocations, imatch, periods


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def ran(spark, name, folder):
    return [r.asDict() for r in catalog.QUERIES[name](spark, folder).collect()]


def documents(spark, path, rows, kinds="doc_id long, text string, lang string"):
    spark.createDataFrame(rows, kinds).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


# --- collocations -------------------------------------------------------------------------


def slow_collocations(rows, least, most_words, top, cover):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, most_words + 1):
                for i in range(len(words) - n + 1):
                    counts[lang][tuple(words[i : i + n])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) >= 2 and a >= least}
        scored = []
        for p, a in candidates.items():
            longer = (q for q in candidates if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)))
            if any(100 * candidates[q] >= cover * a for q in longer):
                continue
            score, k = min((1000 * a * totals[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, totals[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(scored)[:top])]
    return sorted(out)


def mixed(seed):
    rng = random.Random(seed)
    words = ["New", "york", "the", "of", "Straße", "É", "ice", "cream", "😀", "a b", "x"]
    fixed = ["New york ice cream", "of the", "É Straße 😀", "x x x x x x"]
    part = lambda: rng.choice(fixed) if rng.random() < 0.5 else rng.choice(words)
    text = lambda: rng.choice(["", " ", "\t"]) + "".join(part() + rng.choice([" ", "  ", "\t", ", ", ".", "\n", " ; ", "\x0b"]) for _ in range(rng.randint(0, 60)))
    return [(text(), rng.choice(["en", "de", None, "und"])) for _ in range(60)] + [(None, "en"), ("", "fr"), (" , . ", "fr")]


@pytest.mark.parametrize(("least", "words", "top", "cover"), [(4, 5, 2000, 100), (2, 4, 7, 60), (3, 2, 50, 100), (1, 3, 100, 100)])
def test_collocations(spark, least, words, top, cover):
    rows = mixed(least)
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "text string, lang string, phrase string, f int").repartition(4)
    got = sorted(tuple(r) for r in collocations.collocations(docs, least, words, top, cover).collect())
    assert got == slow_collocations(rows, least, words, top, cover) and got


def test_collocations_by_shuffled_joins(spark, monkeypatch):
    from carrel.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = mixed(9)
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(tuple(r) for r in collocations.collocations(docs, 3).collect()) == slow_collocations(rows, 3, 5, 2000, 100)


def test_collocation_scores_pass_64_bits(spark):
    counts = spark.createDataFrame([("en", "a", 1, 3 * 10**12), ("en", "b", 1, 4 * 10**12), ("en", "a b", 2, 2 * 10**12 + 1)], "lang string, phrase string, size int, f long")
    totals = spark.createDataFrame([("en", 9 * 10**15 + 7)], "lang string, n long")
    row = collocations.scored(totals, counts).first()
    assert row["score"] == 1000 * (2 * 10**12 + 1) * (9 * 10**15 + 7) // (12 * 10**24)


def test_collocation_query_keeps_its_parameters(spark, tmp_path):
    rows = [(k, "Foo bar baz. Foo bar", "en") for k in range(99)] + [(200, "foo bar", None)]
    got = ran(spark, "op11_phrase_collocations", documents(spark, tmp_path, rows))
    assert [(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in got] == [("en", 1, "foo bar", 198, 198, 198, 495, 1000 * 198 * 495 // (198 * 198))]


# --- document fingerprints ----------------------------------------------------------------


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def term_hash(term):
    return signed(xxhash.xxh64_intdigest(term.encode(), 42))


def hash_longs(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(int(v).to_bytes(8, "little", signed=True), seed)
    return signed(seed)


def slow_terms(text):
    return list(dict.fromkeys(term_hash(t) for t in re.split(r"[\W_]+", text.lower()) if t))


def slow_print(text, lexicon):
    terms = slow_terms(text)
    level = 0
    while len(terms) > imatch.TERMS * 4**level:
        level += 1
    deals = lambda t, k: ((t % (1 << 64)) >> 5) % 4 ** (level + k) == 0
    drawn = [t for t in terms if deals(t, 0)]
    band = [t for t in drawn if t in lexicon]
    own = band if len(band) >= imatch.BAND_TERMS else drawn
    hashes = []
    for k in range(imatch.LEVELS):
        for s in range(imatch.SUBSETS):
            held = sorted(t for t in own if deals(t, k) and t % imatch.SUBSETS == s)
            hashes.append(hash_longs(held) & 0xFFFF if held else None)
    whole = hash_longs(sorted(terms)) if terms else term_hash(text)
    return level, hashes, whole


def slow_likeness(a, b):
    n = imatch.SUBSETS
    found = []
    for k in range(imatch.LEVELS):
        there = a[0] + k - b[0]
        if 0 <= there < imatch.LEVELS:
            pairs = [(x, y) for x, y in zip(a[1][k * n : k * n + n], b[1][there * n : there * n + n], strict=True) if x is not None or y is not None]
            found.append((len(pairs), sum(x == y for x, y in pairs)))
    informed = [f for f in reversed(found) if f[0] >= imatch.INFORMED]
    used, equal = informed[0] if informed else found[0] if found else (0, 0)
    return equal / used if used else float(a[2] == b[2])


def shown(p):
    return f"{p[0]}-" + "".join("." if h is None else f"{h:04x}" for h in p[1]) + f"-{p[2] % (1 << 64):016x}"


def slow_fingerprints(rows):
    texts = [(i, t or "") for i, t in rows]
    n = len(texts)
    df = Counter(t for _, text in texts for t in slow_terms(text))
    lexicon = {t for t, c in df.items() if max(2.0, imatch.LEAST_SHARE * n) <= c <= max(2.0, imatch.MOST_SHARE * n)}
    order = sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, term_hash(r[1])))
    out = []
    for k, (i, text) in enumerate(order):
        after = order[(k + 1) % n][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed, following = (slow_print(t, lexicon) for t in (text, edited, after))
        out.append((i, len(text), sha(edited), shown(own), shown(changed), round(slow_likeness(own, changed), 9), round(slow_likeness(own, following), 9)))
    return Counter(out)


def prose(rng, n, words):
    return " ".join(rng.choice(words) + rng.choice(["", "", ".", ",\n"]) for _ in range(n))


def fingerprint_rows():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 6))) for _ in range(900)]
    rows = [(k * 3, prose(rng, rng.choice([0, 1, 4, 30, 150, 600]), words)) for k in range(70)]
    rows += [(None, "null id one"), (None, None), (None, None), (7, "same"), (7, "same"), (7, "same"), (7, "Other same id"), (8, "..."), (9, "!"), (10, ""), (11, ""), (400, prose(rng, 40_000, words)), (-5, "😀 Zwei Wörter")]
    return rows


def test_fingerprints(spark, tmp_path):
    rows = fingerprint_rows()
    folder = documents(spark, tmp_path, [(i, t, "x", 1) for i, t in rows], "doc_id long, text string, fingerprint string, copies int")
    got = Counter((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in ran(spark, "op12_document_fingerprints", folder))
    assert got == slow_fingerprints(rows)


def test_fingerprints_by_shuffled_joins(spark, tmp_path, monkeypatch):
    from carrel.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    rows = fingerprint_rows()[:40]
    got = Counter((r["doc_id"], r["fingerprint"], round(r["near_edited"], 9)) for r in ran(spark, "op12_document_fingerprints", documents(spark, tmp_path, rows, "doc_id long, text string")))
    assert got == Counter({(k[0], k[3], k[5]): n for k, n in slow_fingerprints(rows).items()})


def test_fingerprints_of_one_document(spark, tmp_path):
    row = ran(spark, "op12_document_fingerprints", documents(spark, tmp_path, [(1, "one two three four")], "doc_id long, text string"))
    assert len(row) == 1 and row[0]["near_next"] == 1.0 and row[0]["edited_sha256"] == sha("one two threeone two"[:9] + "one two t")


def test_fingerprints_run_no_python_worker(spark, tmp_path):
    folder = documents(spark, tmp_path, [(k, f"word{k} other{k % 3} text") for k in range(20)], "doc_id long, text string")
    order = imatch.steps(spark.read.parquet(f"{folder}/documents.parquet"))
    plan = imatch.with_edited(spark.read.parquet(f"{folder}/documents.parquet"), order)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- periodic runs ------------------------------------------------------------------------


def slow_runs(words):
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length, own = j + q - i, words[i : j + q]
            if length >= max(6, 4 * q) and not any(own[z:] == own[:-z] for z in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def slow_periodic(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for k, w in enumerate(words) if k not in gone)))


def periodic_rows():
    rng = random.Random(2)
    rows = []
    for k in range(260):
        vocabulary = [f"w{c}" for c in range(rng.choice([1, 2, 4, 40, 400]))]
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 12, 40, 300]))]
        for _ in range(rng.randint(0, 3)):
            if words:
                at, unit = rng.randrange(len(words)), [rng.choice(vocabulary) for _ in range(rng.randint(1, 30))]
                words[at : at + rng.choice([0, 5])] = (unit * 9)[: rng.randint(2, 9 * len(unit))]
        rows.append((k, rng.choice(["", " ", "\n"]) + "".join(w + rng.choice([" ", "\t", "\r\n", "  "]) for w in words)))
    return rows + [(None, "a a a a a a a"), (None, None), (5, "b b b b b b"), (5, "b b b b b b"), (900, ""), (901, "é x é x é x é x"), (902, "a b " * 3000)]


def test_periodic_runs(spark, tmp_path):
    rows = periodic_rows()
    folder = documents(spark, tmp_path, [(i, t, "x", 3) for i, t in rows], "doc_id long, text string, runs string, collapsed int")
    got = Counter(tuple(r[c] for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")) for r in ran(spark, "op13_periodic_runs", folder))
    assert got == Counter(slow_periodic(i, t) for i, t in rows)
    assert sum(1 for k in got if k[1]) > 60


@pytest.mark.parametrize("seed", range(4))
def test_runs_with_short_keys_and_sections(monkeypatch, seed):
    monkeypatch.setattr(periods, "KEY_WORDS", 4)
    monkeypatch.setattr(periods, "SECTION_KEYS", 2)
    monkeypatch.setattr(periods, "FED_WORDS", 7)
    texts = [t or "" for _, t in periodic_rows()[seed * 60 : seed * 60 + 60]]
    words, sizes = periods.split_words([t.encode() for t in texts])
    x, starts = periods.numbered(words, sizes)
    want = [(s + a, b, c) for s, t in zip(starts.tolist(), texts, strict=True) for a, b, c in slow_runs(t.split())]
    assert [tuple(r) for r in periods.Runs(x, int(sizes.max(initial=0))).all().tolist()] == want


def test_runs_of_long_texts_take_time_in_proportion():
    import time

    for words in (["a"] * 200_000, [str(k % 1000) for k in range(200_000)], [str(k) for k in range(40_000)] * 5):
        began = time.time()
        packed, sizes = periods.split_words([" ".join(words).encode()])
        runs = periods.Runs(periods.numbered(packed, sizes)[0], len(words)).all()
        assert len(runs) == 1 and runs[0][0] == 0 and runs[0][1] == len(words) and time.time() - began < 20


def test_word_splitting_is_by_ascii_white_space():
    words, sizes = periods.split_words([b" a\x0bb\r\n", b"", "x y z".encode(), b"\x1cq"])
    assert words.to_pylist() == [b"a", b"b", "x y".encode(), b"z", b"\x1cq"] and sizes.tolist() == [2, 0, 2, 1]
    assert np.array_equal(periods.recurrence(np.array([5, 6, 5, 5])), [2, 5, 1, 5])
