"""Media columns: texts stored as WAV, short-time Fourier transforms and spectral-peak pair fingerprints."""

from __future__ import annotations

import hashlib
import io
import wave
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 64
RATE = 8000
FRAME = 256
HOP = 128
#: Frames that are transformed at once, so that long payloads need no more memory.
AT_ONCE = 2048
PEAKS = 2
FAN_OUT = 3
MAX_GAP = 63
SCHEMA = (
    "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    "feature string, pair_times array<int>, pair_hashes array<int>"
)


def to_payload(data: bytes) -> bytes:
    """data and bytes 0 up to a positive multiple of BLOCK."""
    return data.ljust(max(BLOCK, -(-len(data) // BLOCK) * BLOCK), b"\0")


def to_wav(payload: bytes) -> bytes:
    """One channel of 8-bit samples, one for each byte."""
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as w:
        return w.readframes(w.getnframes())


def spectral_peaks(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frame and frequency of the PEAKS strongest local maxima of each frame's spectrum, by frame, then frequency."""
    x = np.frombuffer(samples, np.uint8).astype(np.float32) - 128
    x = np.pad(x, (0, max(FRAME, -(-len(x) // HOP) * HOP) - len(x)))
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP]
    window = np.hanning(FRAME).astype(np.float32)
    times, bins = [], []
    for start in range(0, len(frames), AT_ONCE):
        power = np.abs(np.fft.rfft(frames[start : start + AT_ONCE] * window))
        middle = power[:, 1:-1]
        middle = np.where((middle > power[:, :-2]) & (middle >= power[:, 2:]), middle, 0)
        top = np.sort(np.argpartition(middle, -PEAKS, axis=1)[:, -PEAKS:], axis=1)
        row, col = np.nonzero(np.take_along_axis(middle, top, 1) > 0)
        times.append(row + start)
        bins.append(top[row, col] + 1)
    return np.concatenate(times), np.concatenate(bins)


def fingerprint(samples: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each peak with the next FAN_OUT ones, at most MAX_GAP frames later: the first one's frame, and both frequencies and
    the gap in one integer."""
    t, f = spectral_peaks(samples)
    times, hashes = [], []
    for k in range(1, FAN_OUT + 1):
        gap = t[k:] - t[:-k]
        near = gap <= MAX_GAP
        times.append(t[:-k][near])
        hashes.append((f[:-k] << 14 | f[k:] << 6 | gap)[near])
    times, hashes = np.concatenate(times), np.concatenate(hashes)
    order = np.lexsort((hashes, times))
    return times[order].astype(np.int32), hashes[order].astype(np.int32)


def _rows(batches: Iterator[pa.RecordBatch], keep: bool = False) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            rows, kept = [], []
            for doc_id, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist(), strict=True):
                data = (text or "").encode()
                media = to_wav(to_payload(data))
                kept.append(media if keep else None)
                payload = from_wav(media)
                times, hashes = fingerprint(payload)
                feature = f"{len(times)}:{hashlib.md5(times.tobytes() + hashes.tobytes()).hexdigest()}"
                rows.append((doc_id, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-BLOCK:]), len(media), hashlib.sha256(media).hexdigest(), feature, times, hashes))
            names = [x.split()[0] for x in SCHEMA.split(", ")]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * keep, names + ["media"] * keep)


def media_features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False) -> DataFrame:
    """Each text as a WAV of its UTF-8 bytes, read back, with digests of both and its fingerprint.

    With keep_media, the WAV itself is a column, media. pair_times and pair_hashes are the fingerprint's parallel arrays, ordered by time; feature is a digest of them. A null text counts
    as empty; an empty text gives a payload of 64 zero bytes, which has no peaks. Texts are taken whole, each row by itself: repeated
    rows stay, other columns don't, and a null id stays null. One pass, no shuffle.
    """
    return docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{text_col}` as text").mapInArrow(partial(_rows, keep=keep_media), SCHEMA + ", media binary" * keep_media)
