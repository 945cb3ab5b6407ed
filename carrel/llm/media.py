"""Media columns: WAV blobs, short-time spectra and spectral-peak pair fingerprints.

A text is stored as 8-bit mono WAV and read back by the ``wave`` module. The sound, with half a
frame of silence before and behind, is cut into frames of 128 samples that overlap by half (the
shortest payload has two); each frame's spectrum gives its two strongest local maxima, and every
peak is paired with the peaks of the next frames. A pair (first bin, second bin, frames
between) is one 20-bit code, kept with the frame it starts at: two parallel arrays. Spectra are
computed for a bounded number of frames at a time, so a very long text takes little more than its
own size.

Null text counts as empty (64 zero bytes of payload); an empty table gives an empty table;
columns other than doc_id and text are left out; rows with equal or null ids are handled each
on its own.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carrel.llm.common import mapped, only, pieces, table, texts_of

UNIT = 64
RATE = 8000
FRAME = 128
HOP = FRAME // 2
PEAKS = 2
REACH = 2
#: frames whose spectra are held at once
FRAMES = 4096
SILENCE = 128


def wav_bytes(payload: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as sound:
        sound.setnchannels(1)
        sound.setsampwidth(1)
        sound.setframerate(RATE)
        sound.writeframes(payload)
    return out.getvalue()


def wav_samples(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as sound:
        return sound.readframes(sound.getnframes())


def padded(raw: bytes) -> bytes:
    return raw + bytes(max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


_WINDOW = np.hanning(FRAME)


def spectra(samples: bytes):
    """Magnitudes, one row per frame, in parts of at most FRAMES rows."""
    sound = np.full(len(samples) + FRAME, SILENCE, np.uint8)
    sound[HOP : HOP + len(samples)] = np.frombuffer(samples, np.uint8)
    frames = np.lib.stride_tricks.sliding_window_view(sound, FRAME)[::HOP]
    for at in range(0, len(frames), FRAMES):
        yield np.abs(np.fft.rfft((frames[at : at + FRAMES].astype(np.float64) - SILENCE) * _WINDOW, axis=1))


def peaks(magnitude: np.ndarray) -> np.ndarray:
    """Bins of the strongest local maxima of every row, strongest first; 0 where there are fewer."""
    inner = magnitude[:, 1:-1]
    top = np.where((inner > magnitude[:, :-2]) & (inner >= magnitude[:, 2:]), inner, -1.0)
    rows = np.arange(len(top))
    bins = np.zeros((len(top), PEAKS), np.int32)
    for k in range(PEAKS):
        best = top.argmax(axis=1)
        bins[:, k] = np.where(top[rows, best] > 1e-6, best + 1, 0)
        top[rows, best] = -1.0
    return bins


def peak_pairs(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start frames and codes of all pairs, ordered by frame."""
    times, codes = [], []
    for gap in range(1, REACH + 1):
        for a in range(PEAKS):
            for b in range(PEAKS):
                first, second = bins[:-gap, a], bins[gap:, b]
                found = np.flatnonzero((first > 0) & (second > 0))
                times.append(found)
                codes.append((first[found] << 12) | (second[found] << 4) | gap)
    when, code = np.concatenate(times).astype(np.int32), np.concatenate(codes).astype(np.int32)
    order = np.lexsort((code, when))
    return when[order], code[order]


def described(samples: bytes) -> tuple[int, float, np.ndarray, np.ndarray]:
    """Frames, mean bin of the spectrum, and the pairs' start frames and codes."""
    bins, weight, total = [], 0.0, 0.0
    for magnitude in spectra(samples):
        bins.append(peaks(magnitude))
        column = magnitude.sum(axis=0)
        weight += float(column @ np.arange(len(column)))
        total += float(column.sum())
    found = np.concatenate(bins)
    return len(found), round(weight / total, 6) if total > 1e-9 else 0.0, *peak_pairs(found)


def with_wav(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes and the WAV blob of each text."""

    def store(batches):
        for batch in pieces(batches):
            raw = [x.encode() for x in texts_of(batch)]
            media = [wav_bytes(padded(x)) for x in raw]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in raw], pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return mapped(only(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), store, "doc_id long, n_bytes long, media binary")


def fingerprints(media: DataFrame) -> DataFrame:
    """Read WAV blobs back; add their digests and the pair codes with their start frames."""

    def read(batches):
        for batch in pieces(batches, 4 << 20):
            rows = []
            for blob in batch.column("media").to_pylist():
                samples = wav_samples(blob)
                frames, centre, when, code = described(samples)
                digest = hashlib.sha256(when.astype("<i4").tobytes() + code.astype("<i4").tobytes()).hexdigest()
                feature = f"{frames};{centre:.6f};{len(code)};{digest}"
                rows.append((len(samples), hashlib.sha256(samples).hexdigest(), zlib.crc32(samples[-UNIT:]), len(blob), hashlib.sha256(blob).hexdigest(), feature, when, code))
            columns = list(zip(*rows, strict=True))
            kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pair_frame", "pair_code"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], ["doc_id", "n_bytes", *names])

    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string"
    return mapped(media, read, f"{kinds}, feature string, pair_frame array<int>, pair_code array<int>")


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature: frames, mean bin, number of pairs and the digest of the pairs, which follow as arrays."""
    return fingerprints(with_wav(table(spark, sf_dir, "documents")))
