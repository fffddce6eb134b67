"""Media columns: audio stored in WAV containers, spectra, and spectral-peak pair fingerprints.

`to_wav` stores bytes as 8-bit mono samples, `from_wav` reads them back with the wave module, and
`fingerprint` takes short-time Fourier transforms of the samples: in each frame the strongest bin of
each of BANDS bands, if it stands out of its band, is a peak; each peak is paired with the strongest
peaks of its own and the following frames, and a pair's code holds both bins and the frames between. The codes
are stored with their frame as time-coded arrays.

Defined results: null counts as empty; a payload is padded with PAD to a positive multiple of BLOCK,
so that empty text gives one block; equal texts give equal values (spectra are taken per text and
rounded to whole numbers before peaks are compared, ties go to the lower bin); repeated rows are
handled each; other columns are left out.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE, BLOCK, PAD = 8000, 192, 32
#: Samples of a frame, and between frames' starts.
FRAME, HOP = 64, 32
#: Edges of the bands of bins in which peaks are sought, and how many frames further on a peak's partners are.
BANDS, AHEAD = (1, 6, 14, 33), (0, 1, 2)
#: Frames transformed at once.
AT_ONCE = 4096


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A WAV file of 8-bit mono samples."""
    with wave.open(out := io.BytesIO(), "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(rate)
        w.writeframes(payload)
    return out.getvalue()


def from_wav(stored: bytes) -> bytes:
    """The samples of a WAV file."""
    with wave.open(io.BytesIO(stored), "rb") as w:
        return w.readframes(w.getnframes())


def padded(data: bytes) -> bytes:
    return data + bytes([PAD]) * (-len(data) % BLOCK if data else BLOCK)


_WINDOW = np.hamming(FRAME + 1)[:FRAME].astype(np.float64)


def spectra(samples: np.ndarray) -> np.ndarray:
    """Rounded magnitudes, frames by bins."""
    n = max(1, (len(samples) - FRAME) // HOP + 1)
    x = np.zeros(max(len(samples), FRAME))
    x[: len(samples)] = samples
    frames = np.lib.stride_tricks.sliding_window_view(x, FRAME)[::HOP][:n]
    return np.concatenate([np.rint(np.abs(np.fft.rfft((frames[i : i + AT_ONCE] - 128.0) * _WINDOW, axis=1))).astype(np.int32) for i in range(0, n, AT_ONCE)])


def fingerprint(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Frames and codes of the peak pairs, in order of frame, band and distance."""
    s = spectra(np.frombuffer(payload, np.uint8))
    bins = np.stack([s[:, a:b].argmax(1) + a for a, b in zip(BANDS, BANDS[1:])], 1)
    tall = np.take_along_axis(s, bins, 1)
    mean = np.stack([s[:, a:b].sum(1) // (b - a) for a, b in zip(BANDS, BANDS[1:])], 1)
    peak = (tall > mean) & (tall > 1)
    height = np.where(peak, tall, -1)
    best = height.argmax(1)
    rows = np.arange(len(s))
    best_bin, has = bins[rows, best], height[rows, best] >= 0
    codes = np.full((len(s), len(BANDS) - 1, len(AHEAD)), -1, np.int64)
    for k, d in enumerate(AHEAD):
        if len(s) > d:
            m = len(s) - d
            codes[:m, :, k] = np.where(peak[:m] & has[d:, None], (bins[:m] << 12) | (best_bin[d:, None] << 4) | d, -1)
    at, _, _ = np.nonzero(codes >= 0)
    return at.astype(np.int32), codes[codes >= 0].astype(np.int32)


def media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, `n_bytes` of text, `wav` (the stored file), and, from the file read back, `payload`, and `frames` and `codes` (two arrays, one entry for each peak pair)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                ids, part = b.column(0)[lo : lo + 64], [(t or "").encode() for t in b.column(1)[lo : lo + 64].to_pylist()]
                wavs = [to_wav(padded(x)) for x in part]
                back = [from_wav(x) for x in wavs]
                prints = [fingerprint(x) for x in back]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(map(len, part), pa.int64()), pa.array(wavs, pa.binary()), pa.array(back, pa.binary()), pa.array([p[0] for p in prints], pa.list_(pa.int32())), pa.array([p[1] for p in prints], pa.list_(pa.int32()))],
                    names=["id", "n_bytes", "wav", "payload", "frames", "codes"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_bytes bigint, wav binary, payload binary, frames array<int>, codes array<int>").withColumnRenamed("id", id_col)


def digest(stored: DataFrame) -> DataFrame:
    """Digests of the payload read back, the stored file and the fingerprint."""
    return stored.select(
        "doc_id",
        "n_bytes",
        F.length("payload").cast("bigint").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -16, 16)).alias("tail_crc32"),
        F.length("wav").cast("bigint").alias("media_bytes"),
        F.sha2("wav", 256).alias("media_sha256"),
        F.concat_ws(":", F.size("codes"), F.hex(F.xxhash64("frames", "codes"))).alias("feature"),
    )
