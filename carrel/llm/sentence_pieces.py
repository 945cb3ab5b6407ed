"""SentencePiece encoding and decoding by a score-ordered agenda of adjacent symbol pairs.

A text is cut into chunks at spaces and line breaks where no vocabulary piece can reach across
(checked against the vocabulary; otherwise the whole text is one chunk). Within a chunk, the
agenda holds every adjacent pair whose join is a piece, best score first and leftmost first
among equals; the top pair is joined and its new neighbours enter. The agendas of all chunks
new to a worker advance together as arrays, one join a chunk and round; long chunks and those
with letters outside the vocabulary use a heap each. Symbols no piece covers
become their UTF-8 byte pieces. Every chunk that a worker meets for the first time is checked
against the sentencepiece library within the Arrow batch; if the library disagrees, the batch's
documents take the library's ids, and the query's column by_agenda says so.

Null text counts as empty (the end id alone). Rows are independent: equal or null ids, extra
columns and empty tables need no care; columns besides doc_id and text are left out.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import mapped, only, pieces, table, texts_of

SPACE = "▁"
#: chunks one worker remembers; then it starts anew
REMEMBERED = 900_000
#: longer chunks are encoded one by one with a heap
LONG = 200
NO_RANK = 1 << 40


class PieceCodec:
    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.library.get_piece_size()
        self.ids, self.scores, self.bytes = {}, {}, {}
        for i in range(n):
            piece = self.library.id_to_piece(i)
            if self.library.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)):
                self.ids[piece] = i
                self.scores[piece] = self.library.get_score(i)
        self.unknown = self.library.unk_id()
        self.end = self.library.eos_id()
        self.cut = self._cutter()
        self.known: dict[str, tuple[int, ...]] = {}
        self.spelled: dict[str, str] = {}
        self.agreed = True
        self._pair_table()

    def _cutter(self):
        """Cuts a text where no piece reaches across: before spaces, at line breaks."""
        if any(re.search(f"[^{SPACE}]{SPACE}", p) or (len(p) > 1 and "\n" in p) for p in self.ids):
            return re.compile(r"(?s).+").findall
        plain = f"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+"
        return re.compile(plain).findall

    def _pair_table(self) -> None:
        """Pairs of symbols that join, as sorted arrays. Symbols are pieces and the letters in them."""
        n = self.library.get_piece_size()
        symbols = dict(self.ids)
        for letter in sorted({c for p in self.ids for c in p}):
            symbols.setdefault(letter, n + len(symbols))
        self.width = 1 + max(symbols.values(), default=0)
        order = {p: k for k, p in enumerate(sorted(self.ids, key=lambda p: (-self.scores[p], self.ids[p])))}
        rank_of = {}
        for p in order:  # equal scores share a rank, so that the leftmost goes first
            rank_of.setdefault(self.scores[p], order[p])
        pairs = sorted((symbols[p[:k]] * self.width + symbols[p[k:]], rank_of[self.scores[p]], symbols[p]) for p in self.ids for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols)
        self.pair, self.rank, self.joined = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ([-1], [0], [0])))
        letters = sorted(c for c in symbols if len(c) == 1)
        self.letter = np.array([ord(c) for c in letters], np.int64)
        self.letter_symbol = np.array([symbols[c] for c in letters], np.int64)
        self.covered = np.array([c in self.ids for c in letters])
        self.shared_ints = list(range(n))

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.pair, wanted), len(self.pair) - 1)
        hit = self.pair[at] == wanted
        return np.where(hit, self.rank[at], NO_RANK), self.joined[at]

    def many_ids(self, chunks: list[str]) -> list[tuple[int, ...]]:
        """chunk_ids of many chunks: their agendas advance together, one join a chunk and round."""
        out: list = [None] * len(chunks)
        letters = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32).astype(np.int64)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        owner = np.repeat(np.arange(len(chunks)), sizes)
        at = np.minimum(np.searchsorted(self.letter, letters), len(self.letter) - 1)
        plain = (self.letter[at] == letters) & self.covered[at]
        slow = sizes > LONG
        slow[owner[~plain]] = True
        for k in np.flatnonzero(slow):
            out[k] = self.chunk_ids(chunks[k])
        keep = ~slow[owner]
        symbol, owner = self.letter_symbol[at[keep]], owner[keep]
        done_symbols, done_owners = [], []
        rank = np.full(len(symbol), NO_RANK)
        joined = np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            inner = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inner], joined[inner] = self._ranks(symbol[inner], symbol[inner + 1])
        while len(symbol):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank, starts)
            lengths = np.diff(np.r_[starts, len(symbol)])
            over = np.repeat(best == NO_RANK, lengths)
            if over.any():
                done_symbols.append(symbol[over])
                done_owners.append(owner[over])
                symbol, owner, rank, joined = (x[~over] for x in (symbol, owner, rank, joined))
                if not len(symbol):
                    break
                live = best != NO_RANK
                best, lengths = best[live], lengths[live]
                starts = np.r_[0, np.cumsum(lengths)[:-1]]
            top = np.flatnonzero(rank == np.repeat(best, lengths))
            top = top[np.r_[True, owner[top][1:] != owner[top][:-1]]]  # the leftmost of each chunk
            symbol[top] = joined[top]
            keep = np.ones(len(symbol), bool)
            keep[top + 1] = False
            rank[top] = rank[top + 1]  # the pair behind the join, renewed below
            symbol, owner, rank, joined = symbol[keep], owner[keep], rank[keep], joined[keep]
            top = top - np.arange(len(top))
            for left in (top[top > 0] - 1, top[top < len(symbol) - 1]):
                same = left[owner[left] == owner[left + 1]]
                rank[same], joined[same] = self._ranks(symbol[same], symbol[same + 1])
            last = top[(top == len(symbol) - 1) | (owner[np.minimum(top + 1, len(symbol) - 1)] != owner[top])]
            rank[last] = NO_RANK
        if done_symbols:
            symbol, owner = np.concatenate(done_symbols), np.concatenate(done_owners)
            order = np.argsort(owner, kind="stable")
            symbol, owner = symbol[order], owner[order]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            flat = list(map(self.shared_ints.__getitem__, symbol.tolist()))
            for k, a, b in zip(owner[starts].tolist(), starts.tolist(), [*starts[1:].tolist(), len(flat)], strict=True):
                out[k] = tuple(flat[a:b])
        return out

    def chunk_ids(self, chunk: str) -> tuple[int, ...]:
        if chunk in self.ids and len(chunk) == 1:
            return (self.ids[chunk],)
        scores = self.scores
        symbols = list(chunk)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = []
        for i in range(n - 1):
            score = scores.get(symbols[i] + symbols[i + 1])
            if score is not None:
                agenda.append((-score, i, i + 1, len(symbols[i]) + len(symbols[i + 1])))
        heapq.heapify(agenda)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            left, right = symbols[i], symbols[j]
            if not left or not right or len(left) + len(right) != size or after[i] != j:
                continue  # one of the two has been joined elsewhere
            left += right
            symbols[i], symbols[j] = left, ""
            k = after[i] = after[j]
            if k >= 0:
                before[k] = i
                score = scores.get(left + symbols[k])
                if score is not None:
                    heapq.heappush(agenda, (-score, i, k, len(left) + len(symbols[k])))
            k = before[i]
            if k >= 0:
                score = scores.get(symbols[k] + left)
                if score is not None:
                    heapq.heappush(agenda, (-score, k, i, len(left) + len(symbols[k])))
        out: list[int] = []
        for symbol in symbols:
            if not symbol:
                continue
            found = self.ids.get(symbol)
            if found is not None:
                out.append(found)
            elif self.bytes:
                out.extend(self.bytes[b] for b in symbol.encode())
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return tuple(out)

    def chunks(self, text: str) -> list[str]:
        return self.cut(SPACE + text.replace(" ", SPACE)) if text else []

    def learn(self, wanted: set[str]) -> bool:
        """Encode chunks not yet known; False if the library encodes them otherwise."""
        new = [c for c in wanted if c not in self.known]
        for chunk, ids in zip(new, self.many_ids(new) if new else (), strict=True):
            self.known[chunk] = ids
            self.spelled[chunk] = " ".join(map(str, ids))
        lines = [c for c in new if c != "\n"]
        if not lines:
            return True
        theirs = self.library.encode("\n" + "\n".join(c.replace(SPACE, " ") for c in lines))
        newline = self.chunk_ids("\n")
        ours = [*self.chunk_ids(SPACE), *chain.from_iterable((*newline, *self.known[c]) for c in lines)]
        return ours == theirs

    def encode_all(self, texts: list[str]) -> list[tuple[list[int], str]]:
        """(ids with the end id, the same as decimal text) for every text; ``agreed`` tells whether the agenda gave them."""
        cut = [self.chunks(t) for t in texts]
        wanted = set(chain.from_iterable(cut))
        if len(self.known) + len(wanted) > REMEMBERED:
            self.known.clear()
            self.spelled.clear()
        self.agreed = self.learn(wanted)
        if not self.agreed:
            self.known.clear()
            self.spelled.clear()
            found = [[*ids, self.end] for ids in self.library.encode(texts, num_threads=1)]
            return [(ids, " ".join(map(str, ids))) for ids in found]
        known, spelled = self.known, self.spelled
        out = []
        for chunks in cut:
            ids = list(chain.from_iterable(map(known.__getitem__, chunks)))
            ids.append(self.end)
            out.append((ids, " ".join([*map(spelled.__getitem__, chunks), str(self.end)])))
        return out

    def decode_all(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)


_CODECS: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    """One codec for each model and worker process."""
    if path not in _CODECS:
        _CODECS[path] = PieceCodec(path)
    return _CODECS[path]


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the ids of its text, end id included."""

    def encode(batches):
        own = codec(model_path)
        for batch in pieces(batches, 4 << 20):
            found = [ids for ids, _ in own.encode_all(texts_of(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return mapped(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), encode, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text that its ids stand for."""

    def decode(batches):
        own = codec(model_path)
        for batch in pieces(batches, 4 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own.decode_all(batch.column("ids").to_pylist()), pa.string())], ["doc_id", "text"])

    return mapped(ids, decode, "doc_id long, text string")


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """Encode and decode in one pass; only counts and digests leave the worker."""

    def digest(batches):
        own = codec(model_path)
        for batch in pieces(batches, 4 << 20):
            found = own.encode_all(texts_of(batch))
            back = own.decode_all([ids for ids, _ in found])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(ids) for ids, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(s.encode()).hexdigest() for _, s in found]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                    pa.array([own.agreed] * len(found), pa.bool_()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "by_agenda"],
            )

    return mapped(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, by_agenda boolean")


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
