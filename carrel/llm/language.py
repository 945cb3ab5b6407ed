"""Language identification by cross-parsing with suffix automata.

For every language a suffix automaton of a bounded sample of labelled text is built. A text is
parsed into phrases, each the longest match that the automaton holds; the language with the
fewest phrases wins, normalised by the logarithm of the sample's length (the bits that name a
phrase; per letter, this is the cross-parsing entropy). Texts are folded to lower-case letters,
with their marks, and single spaces. Whole texts are parsed: segments of a text are first parsed
side by side as arrays, each as if a phrase began with it; then every segment is parsed again from
the state that the one before ends in, up to where both parses begin a phrase at the same letter,
behind which they agree.

The sample is bounded by ``letters`` a language, ``total`` over all languages and ``most``
languages, commonest first (documented parameters, so the automata have a proven size bound): the
labelled documents with the smallest hash of their id. A text that is null or has no letter is
``und`` with score 0. Ties go to the alphabetically first language. The score is 1 less the ratio
of the best to the second-best number of phrases (1 if only one language was learned). With
nothing learned, everything is ``und``. A null doc_id is not learned from and not held out. Rows
with equal ids are rows of their own; extra columns are carried by the stage and left out by the
query.
"""

from __future__ import annotations

import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carrel.llm.common import mapped, neutral, only, pieces, restored, table, texts_of

LETTERS = 24_000
TOTAL = 400_000
#: languages learned at most: each then has TOTAL / MOST letters
MOST = 1_000
SEGMENT = 512
#: up to so many segments are followed one by one, more of them as arrays
FEW = 12
#: text handled at once within a task: its arrays take some twenty times as much
PIECE = 2 << 20
UNDETERMINED = "und"


class SuffixAutomaton:
    """All substrings of one text; states as a table of next states (0 where there is none)."""

    def __init__(self, codes: list[int], width: int):
        following: list[dict[int, int]] = [{}]
        link, length = [-1], [0]
        last = 0
        for c in codes:
            new = len(following)
            following.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in following[p]:
                following[p][c] = new
                p = link[p]
            if p >= 0:
                q = following[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(following)
                    following.append(dict(following[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and following[p].get(c) == q:
                        following[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        self.table = np.zeros((len(following), width), np.int32)
        for state, out in enumerate(following):
            for c, to in out.items():
                self.table[state, c] = to


class _Fold(dict):
    """str.translate table: letters to lower case, marks as they are, all else to a space; filled as met."""

    def __missing__(self, point: int):
        c = chr(point)
        kind = unicodedata.category(c)[0]
        low = c.lower()[:1] if kind == "L" else c if kind == "M" else " "
        self[point] = low
        return low


_TRANSLATE = _Fold()


def folded(text: str) -> str:
    return " ".join(text.translate(_TRANSLATE).split())


class Parser:
    """Counts the phrases of many texts under every language."""

    def __init__(self, samples: dict[str, str]):
        self.languages = sorted(samples)
        letters = sorted({c for s in samples.values() for c in s})
        self.code = {ord(c): k + 1 for k, c in enumerate(letters)}  # 0: a letter no sample has
        self.points = np.array(sorted(self.code), np.uint32)
        self.codes = np.array([self.code[p] for p in self.points.tolist()], np.int32)
        #: bits that name a phrase: the logarithm of the places it may be copied from
        self.cost = np.log2([1.0 + len(samples[x]) for x in self.languages])
        self.tables = [SuffixAutomaton([self.code[ord(c)] for c in samples[x]], len(letters) + 1).table for x in self.languages]

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Phrases a text (row) and language (column)."""
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        if not len(points) or not len(self.points):
            return np.zeros((len(texts), len(self.tables)), np.int64)
        at = np.minimum(np.searchsorted(self.points, points), len(self.points) - 1)
        codes = np.where(self.points[at] == points, self.codes[at], 0)
        counts = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), counts)
        within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = np.repeat(np.cumsum(sizes) - sizes, counts) + within * SEGMENT
        size = np.minimum(SEGMENT, np.repeat(sizes, counts) - within * SEGMENT)
        order = np.argsort(-size, kind="stable")
        out = np.zeros((len(texts), len(self.tables)), np.int64)
        for k, step in enumerate(self.tables):
            begins = np.zeros(len(codes), bool)
            state = np.zeros(len(start), np.int32)
            state[order] = self._parsed(step, codes, start[order], size[order], begins)
            per_segment = self._joined(step, codes, start, size, within, state, begins)
            out[:, k] = np.bincount(owner, weights=per_segment, minlength=len(texts)).astype(np.int64)
        return out

    @staticmethod
    def _stepped(step: np.ndarray, state: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states, and where a phrase begins with the letter (one the sample lacks is a phrase of its own)."""
        flat, width = step.ravel(), step.shape[1]
        to = flat[state * width + c]
        begun = (to == 0) | (state == 0)
        failed = np.flatnonzero(to == 0)
        to[failed] = flat[c[failed]]
        return to, begun

    def _parsed(self, step, codes, start, size, begins) -> np.ndarray:
        """Parse segments (longest first) each from a fresh phrase; marks ``begins``, gives the last states."""
        state = np.zeros(len(start), np.int32)
        live = np.searchsorted(-size, -np.arange(SEGMENT), side="left")  # segments longer than t
        for t in range(SEGMENT):
            n = live[t]
            if not n:
                break
            at = start[:n] + t
            state[:n], begun = self._stepped(step, state[:n], codes[at])
            begins[at[begun]] = True
        return state

    @staticmethod
    def _walked(step, codes, begins, state: int, at: int, end: int) -> tuple[int, int, int]:
        """One segment letter by letter up to where ``begins`` agrees: last state, phrases begun, place."""
        flat, width, begun = memoryview(step.reshape(-1)), step.shape[1], 0
        for c, there in zip(codes[at:end].tolist(), begins[at:end].tolist(), strict=True):
            to = flat[state * width + c]
            if not to or not state:
                if there:
                    break
                begun += 1
                to = to or flat[c]
            state = to
            at += 1
        return state, begun, at

    def _joined(self, step, codes, start, size, within, state, begins) -> np.ndarray:
        """Phrases of each segment when every text is parsed as a whole.

        A segment whose state at the end comes out otherwise than first thought has the next one
        parsed again.
        """
        upto = np.r_[0, np.cumsum(begins)]
        phrases = upto[start + size] - upto[start]
        last = state.copy()
        todo = np.flatnonzero(within > 0)
        while len(todo):
            now, own, at = last[todo - 1], np.zeros(len(todo), np.int64), start[todo].copy()
            ends = start[todo] + size[todo]
            after = state[todo].copy()
            live = np.arange(len(todo))
            count = np.zeros(len(todo), np.int64)
            while len(live) > FEW:
                here = at[live]
                to, begun = self._stepped(step, now[live], codes[here])
                met = begun & begins[here]
                own[live] += begun & ~met
                now[live] = to
                at[live] += 1
                count[live[met]] = upto[ends[live[met]]] - upto[here[met]]
                live = live[~met]
                over = at[live] == ends[live]
                after[live[over]] = now[live[over]]
                live = live[~over]
            for lane in live.tolist():
                here, end = int(at[lane]), int(ends[lane])
                now[lane], begun, here = self._walked(step, codes, begins, int(now[lane]), here, end)
                own[lane] += begun
                if here < end:
                    count[lane] = upto[end] - upto[here]
                else:
                    after[lane] = now[lane]
            phrases[todo] = own + count
            changed = todo[after != last[todo]]
            last[todo] = after
            todo = changed + 1
            todo = todo[todo < len(start)]
            todo = todo[within[todo] > 0]
        return phrases

    def judged(self, texts: list[str]) -> list[tuple[str, float]]:
        plain = [folded(t) for t in texts]
        counts = self.phrases(plain) * self.cost
        out = []
        for text, row in zip(plain, counts.tolist(), strict=True):
            if not self.languages or not any(map(str.isalpha, text)):
                out.append((UNDETERMINED, 0.0))
                continue
            best = min(range(len(row)), key=row.__getitem__)
            second = min((v for k, v in enumerate(row) if k != best), default=None)
            out.append((self.languages[best], 1.0 if second is None else 1.0 - row[best] / max(second, 1e-9)))
        return out


_PARSERS: dict[int, Parser] = {}


def parser_of(trained: dict[str, str]) -> Parser:
    """One parser for each worker process and sample."""
    key = zlib.crc32(repr(sorted(trained.items())).encode())
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(trained)
    return _PARSERS[key]


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3))


def samples(labelled: DataFrame, letters: int = LETTERS, total: int = TOTAL, most: int = MOST) -> dict[str, str]:
    """Folded training text by language, at most ``letters`` each and ``total`` together.

    ``labelled``: doc_id, text, lang. Languages are counted first; a bound on the hash of the id
    then leaves a little more than the wanted number of documents of each, whatever the number of
    languages, and the smallest hashes of those give the sample.
    """
    known = labelled.where("lang is not null and text is not null and doc_id is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    if not sizes:
        return {}
    each = min(letters, total // len(sizes))
    wanted = 1 + each // 300
    share = max(600, 4 * each // wanted)
    bounds = [(r["lang"], int(-(2**63) + 2**64 * min(1.0, (2 * wanted + 40) / r["n"])) - 1) for r in sizes]
    limits = labelled.sparkSession.createDataFrame(bounds, f"lang {labelled.schema['lang'].dataType.simpleString()}, bound long")
    h = F.xxhash64("doc_id")
    near = known.join(F.broadcast(limits), "lang").where(h <= F.col("bound")).select("lang", h.alias("h"), "doc_id", F.substring("text", 1, 4 * share).alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))
    found: dict[str, list[str]] = {}
    for r in near.withColumn("place", place).where(F.col("place") <= wanted).orderBy("lang", "place").collect():
        found.setdefault(r["lang"], []).append(r["text"])
    out = {}
    for name, rows in found.items():
        own = max(600, each // max(1, len(rows) // 4))
        text = " ".join(folded(t)[:own] for t in rows)
        if text.strip():
            out[name] = text[:each]
    return out


def identified(docs: DataFrame, trained: dict[str, str], kept: list[str]) -> DataFrame:
    """The columns ``kept`` of ``docs`` with lang_pred and score; ``docs`` has a text column."""

    def judge(batches):
        parser = parser_of(trained)
        for batch in pieces(batches, PIECE):
            names, scores = zip(*parser.judged(texts_of(batch)), strict=True)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    return mapped(docs, judge, f"{kinds}, lang_pred string, score double")


def learn(docs: DataFrame) -> dict[str, str]:
    """The sample from every document that isn't held out."""
    return samples(only(docs, "doc_id", "text", "lang").where(fold_of(F.col("doc_id")) != 1))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = only(table(spark, sf_dir, "documents"), "doc_id", "text", "lang")
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(fold_of(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return identified(asked, learn(docs), ["doc_id", "held_out"])


#: a label this much less fitting than the best language counts as wrong in the pipeline
CERTAIN = 0.4


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a language, or plainly of another than their label, go."""
    plain = neutral(docs, "doc_id", "text", "lang")
    judged = identified(plain, learn(docs), plain.columns)
    wrong = (F.col("lang_pred") == UNDETERMINED) | (F.col("lang").isNotNull() & (F.col("lang") != F.col("lang_pred")) & (F.col("score") >= CERTAIN))
    return restored(judged.where(~wrong), docs, "doc_id", "text", "lang")
