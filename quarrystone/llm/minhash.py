"""Near-duplicate documents by MinHash.

A document's set holds its distinct shingles of `size` words (fewer words: the whole sequence as one).
BANDS * ROWS universal hash functions give its minima; ROWS of them make a band, and documents that
share a band are candidates. One bit of each minimum makes a signature whose agreement rules out pairs
far from the threshold; what is left is checked on the full sets of words. Linked documents are closed
to groups by large-star and small-star (see linking).

Equal sets are one node, represented by the least id, so that copies never meet as pairs. At likeness
0.8 a pair misses all bands with probability (1 - 0.8 ** ROWS) ** BANDS, and the signature's bound
(MARGIN deviations below the threshold) with less than 1e-6.

Words are [^\x20\x09-\x0D]+ after lower-casing A-Z. Defined results: without words or text a document has
an empty set and is linked with nothing; rows that share an id are one document (alike if any of
their texts is); a row without an id is linked with nothing, has no component and is kept; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .linking import Likeness, grouped
from .shared import SOLID, Words, bit_filter, buffers, chunks, column, mix, scope, sieve, unused, written

ROWS, BANDS, MARGIN = 6, 36, 5.0
_rng = np.random.default_rng(20)
_A = _rng.integers(0, 1 << 31, ROWS * BANDS, dtype=np.int64).astype(np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 1 << 32, ROWS * BANDS, dtype=np.int64).astype(np.uint32)
_BAND = mix(np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
#: Shingles hashed at once.
AT_ONCE = 2048


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the shingles of all rows, and where each row's begin."""
    h, n = w.hashes(), np.diff(w.first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    first = np.concatenate(([0], np.cumsum(count)))
    row = np.repeat(np.arange(len(n)), count)
    at = w.first[:-1][row] + np.arange(first[-1]) - first[:-1][row]
    padded = np.append(h, np.zeros(size, np.uint64))
    out = np.zeros(len(at), np.uint64)
    for k in range(size):
        # the number of words is part of a short row's hash
        inside = k < n[row]
        out = out * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, padded[at + k], np.uint64(k + 1))
        out ^= out >> np.uint64(29)
    return mix(out), first


def minima(x: np.ndarray) -> np.ndarray:
    """The least value of each hash function over 32-bit values."""
    out = np.full(len(_A), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), AT_ONCE):
        np.minimum(out, (_A[:, None] * x[None, at : at + AT_ONCE] + _B[:, None]).min(1), out=out)
    return out


SKETCH = "id {kind}, n bigint, h1 bigint, h2 bigint, keys array<bigint>, s1 bigint, s2 bigint, s3 bigint, s4 bigint"


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """Of rows (id, text): size and hash of the set, keys of the bands, signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, at = buffers(b.column(1))
            for lo, hi in chunks(at):
                found, first = shingles(Words(data, at, lo, hi, SOLID), size)
                n = hi - lo
                sizes, sums, keys, bits = np.zeros(n, np.int64), np.zeros((n, 2), np.uint64), np.zeros((n, BANDS), np.uint64), np.zeros((n, 256), np.uint8)
                for k in range(n):
                    own = np.unique(found[first[k] : first[k + 1]])
                    if not len(own):
                        continue
                    sizes[k] = len(own)
                    sums[k] = own.sum(dtype=np.uint64), mix(own ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
                    least = minima((own >> np.uint64(32)).astype(np.uint32))
                    key = _BAND.copy()
                    for part in least.reshape(BANDS, ROWS).T:
                        key = mix(key + part)
                    keys[k] = key
                    bits[k, : len(least)] = (least * np.uint32(0x9E3779B1)) >> np.uint32(31)
                words = np.packbits(bits, 1).view(np.int64)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS), pa.int32()), pa.array(keys.view(np.int64).ravel()))
                sums = mix(sums).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[lo:hi], pa.array(sizes), pa.array(sums[:, 0].copy()), pa.array(sums[:, 1].copy()), flat, *[pa.array(words[:, k].copy()) for k in range(4)]],
                    names=["id", "n", "h1", "h2", "keys", "s1", "s2", "s3", "s4"],
                )

    return docs.mapInArrow(run, SKETCH.format(kind=docs.schema["id"].dataType.simpleString()))


def agreement(x: Column, y: Column) -> Column:
    """How many of the signatures' bits agree."""
    differ = [F.bit_count(x[c].bitwiseXOR(y[c])) for c in ("s1", "s2", "s3", "s4")]
    return F.lit(ROWS * BANDS) - (differ[0] + differ[1] + differ[2] + differ[3])


class SetLikeness(Likeness):
    """Percent of the union of two full sets of shingles that is common."""

    sketch = ("n", "s1", "s2", "s3", "s4")

    def __init__(self, size: int, percent: int):
        self.size, self.percent = size, percent
        m, p = ROWS * BANDS, (1 + percent / 100) / 2
        self.least = int(m * p - MARGIN * (m * p * (1 - p)) ** 0.5)

    def near(self, x: Column, y: Column) -> Column:
        return (F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * self.percent) & (agreement(x, y) >= self.least)

    def likely(self, x: Column, y: Column) -> Column:
        return agreement(x, y)

    def near_arrays(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        n, m = x[:, None, 0], y[None, :, 0]
        apart = np.bitwise_count((x[:, None, 1:] ^ y[None, :, 1:]).view(np.uint64)).sum(2)
        return (100 * np.minimum(n, m) >= self.percent * np.maximum(n, m)) & (ROWS * BANDS - apart.astype(np.int64) >= self.least)

    def form(self, text: str) -> frozenset:
        return word_set(text, self.size)

    def alike(self, x: frozenset, y: frozenset) -> bool:
        both = len(x & y)
        return bool(x) and bool(y) and 100 * both >= self.percent * (len(x) + len(y) - both)


def word_set(text: str, size: int) -> frozenset:
    """The full set of shingles; words have no spaces, so that one joins them."""
    w = text.encode().translate(_LOWER).split()
    return frozenset(map(b" ".join, zip(*[w[k:] for k in range(size)], strict=False))) if len(w) >= size else frozenset([b" ".join(w)] if w else [])


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, `n_shingles`, `component_id` (the least id that it is connected with) and `kept` (whether that is its own)."""
    rows = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"))
    all_rows = written(sketches(rows, size))
    full = all_rows.where("n > 0 and id is not null")
    sets = written(full.groupBy("h1", "h2").agg(F.min("id").alias("rep")))
    nodes = written(full.join(sets.select(F.col("rep").alias("id"), "h1", "h2"), ["id", "h1", "h2"], "left_semi"))
    likeness = SetLikeness(size, percent)

    def texts_of(ids: DataFrame) -> DataFrame:
        return sieve(rows, "id", bit_filter(ids, "id")).join(ids, "id", "left_semi")

    groups = grouped(nodes, likeness, texts_of)
    known = written(sets.join(groups.select(F.col("id").alias("rep"), "component"), "rep", "left").select("h1", "h2", F.coalesce("component", "rep").alias("component")))
    out = full.select("id", "n", "h1", "h2").join(known, ["h1", "h2"]).select("id", "n", "component")
    out = out.unionByName(all_rows.where("n = 0 or id is null").select("id", "n", F.col("id").alias("component")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"))


def without_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with all their columns, of every group those of its least id. Only documents that may go pass through the join."""
    (other,) = unused(docs.columns, "gone")
    with scope(docs.sparkSession) as keep:
        gone = keep(near_duplicates(docs, size, percent, id_col, text_col).where(~F.col("kept")).select(column(id_col).alias(other)).distinct())
    bits = bit_filter(gone, other)
    maybe = sieve(docs, id_col, bits)
    return maybe.join(gone, column(id_col) == F.col(other), "left_anti").unionByName(sieve(docs, id_col, bits, hit=False))
