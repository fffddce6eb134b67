"""Byte-level BPE encoding and decoding.

Each match of the split pattern is encoded alone. A segment tree over its byte positions stores, in
every node, the least (rank, position) of the pairs that begin there: the root is the leftmost pair
of the least rank. A merge joins the pair's right part into its left one and updates the tree at the
two pairs that changed, each in logarithmic time. Matches of up to WIDEST bytes are merged many at a time: their trees
are the columns of one array, and each step merges one pair of every match.

Defined results: null text counts as empty, and gives no tokens and no bytes; repeated rows are
encoded each; other columns of the input are left out. Results of matches are kept in a table of
bounded size; when it is full, those not met since the last time go.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sent

NONE = 1 << 62
#: Matches kept by a worker in each of two generations; longer ones than LONG characters are not kept.
KEEP, LONG = 50_000, 64
#: Bytes of a match whose tree is an array's column, such matches merged at once, and texts taken together.
WIDEST, COLUMNS, TEXTS = 128, 1 << 14, 64


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: on each line a token in base64 and its rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece, by merging the leftmost pair of the least rank until none is left."""
    n = len(piece)
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    if n < 2:
        return [ranks[piece]] if n else []
    size = 1 << (n - 2).bit_length() if n > 2 else 1
    # a key is rank * n + position, so that the least key is the leftmost of the least rank
    tree = [NONE] * (2 * size)
    for i in range(n - 1):
        rank = ranks.get(piece[i : i + 2])
        if rank is not None:
            tree[size + i] = rank * n + i
    for k in range(size - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))

    def put(at: int, key: int) -> None:
        k = size + at
        tree[k] = key
        k >>= 1
        while k:
            a, b = tree[2 * k], tree[2 * k + 1]
            least = a if a < b else b
            if tree[k] == least:
                return
            tree[k] = least
            k >>= 1

    def pair(at: int) -> int:
        middle = after[at]
        rank = ranks.get(piece[at : after[middle]]) if middle < n else None
        return NONE if rank is None else rank * n + at

    while tree[1] != NONE:
        left = tree[1] % n
        right = after[left]
        end = after[right]
        after[left] = end
        if end < n:
            before[end] = left
        if right < size:
            put(right, NONE)
        put(left, pair(left))
        if before[left] >= 0:
            put(before[left], pair(before[left]))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


class Merger:
    """`merge` of many pieces at once. The pairs of ids that give a token, in order of left << 32 | right, and their token's rank."""

    def __init__(self, ranks: dict[bytes, int]):
        got = [(ranks[t[:k]] << 32 | ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        pairs = np.array(sorted(got), np.int64).reshape(-1, 2)
        # past the end stands a pair that no lookup asks for
        self.pairs, self.rank = np.append(pairs[:, 0], NONE), np.append(pairs[:, 1], -1)
        self.bytes = np.array([ranks.get(bytes([k]), -1) for k in range(256)], np.int64)

    def keys(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        """rank << bits | at of the pairs of ids; NONE where they give no token."""
        pair = left << 32 | right
        k = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[k] == pair, self.rank[k] << bits | at, NONE)

    def __call__(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pieces of 2 to WIDEST bytes, all of whose bytes are tokens."""
        bits = max(max(map(len, pieces)) - 1, 1).bit_length()
        size, m = 1 << bits, len(pieces)
        n = np.array([len(p) for p in pieces])
        text = np.frombuffer(b"".join(p.ljust(size, b"\0") for p in pieces), np.uint8).reshape(m, size).T
        ids = self.bytes[text]
        place = np.arange(size)[:, None]
        stands = place < n
        tree = np.full((2 * size, m), NONE, np.int64)
        tree[size : 2 * size - 1] = np.where(stands[1:], self.keys(ids[:-1], ids[1:], place[:-1], bits), NONE)
        for k in range(size - 1, 0, -1):
            np.minimum(tree[2 * k], tree[2 * k + 1], out=tree[k])
        after = np.repeat(place + 1, m, 1)
        # what stands before the end of a piece is written there, and nobody reads it
        before = np.repeat(np.arange(-1, size)[:, None], m, 1)
        live = np.flatnonzero(tree[1] != NONE)
        while len(live):
            top = tree[1, live]
            left = top & (size - 1)
            right = after[left, live]
            end = after[right, live]
            ids[left, live] = new = top >> bits
            stands[right, live] = False
            after[left, live], before[end, live] = end, left
            tree[size + right, live] = NONE
            follows = end < n[live]
            tree[size + left, live] = np.where(follows, self.keys(new, ids[np.minimum(end, size - 1), live], left, bits), NONE)
            other = before[left, live]
            some = np.flatnonzero(other >= 0)
            tree[size + other[some], live[some]] = self.keys(ids[other[some], live[some]], new[some], other[some], bits)
            # the three leaves' ways up, level by level
            k, of = np.concatenate((size + left, size + right, size + other[some])), np.concatenate((live, live, live[some]))
            for _ in range(bits):
                k >>= 1
                tree[k, of] = np.minimum(tree[2 * k, of], tree[2 * k + 1, of])
            live = live[tree[1, live] != NONE]
        flat, ends = ids.T[stands.T].tolist(), np.cumsum(stands.sum(0)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends, strict=False)]


class Codec:
    """Encoder and decoder over one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, merger: Merger | None = None):
        import regex

        self.ranks, self.tokens = ranks, {v: k for k, v in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.merger = merger or Merger(ranks)
        self._kept: dict[str, tuple[int, str, bytes]] = {}
        self._old: dict[str, tuple[int, str, bytes]] = {}

    def encode(self, text: str) -> list[int]:
        return [i for m in self.find(text) for i in merge(m.encode(), self.ranks)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def merged(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each piece."""
        out: list[list[int]] = [[]] * len(pieces)
        by: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            if (whole := self.ranks.get(p)) is not None:
                out[k] = [whole]
            elif 1 < len(p) <= WIDEST:
                by.setdefault((len(p) - 1).bit_length(), []).append(k)
            else:
                out[k] = merge(p, self.ranks)
        for same in by.values():
            for lo in range(0, len(same), COLUMNS):
                part = same[lo : lo + COLUMNS]
                for k, ids in zip(part, self.merger([pieces[k] for k in part]), strict=True):
                    out[k] = ids
        return out

    def learn(self, matches: list[str]) -> dict[str, tuple[int, str, bytes]]:
        """Number of ids, the ids as text, and the bytes decoded from them, of each match of the pattern."""
        got = {m: old for m in matches if (old := self._old.get(m)) is not None}
        new = [m for m in matches if m not in got]
        for m, ids in zip(new, self.merged([m.encode() for m in new]), strict=True):
            got[m] = len(ids), ",".join(map(str, ids)), self.decode(ids)
        return got

    def all(self, texts: list[str]) -> list[tuple[int, str, bytes]]:
        """The same for whole texts."""
        found = [self.find(t) for t in texts]
        if len(self._kept) > KEEP:
            self._old, self._kept = self._kept, {}
        kept = self._kept
        got = self.learn(list({m for matches in found for m in matches if m not in kept}))
        long = {m: g for m, g in got.items() if len(m) > LONG}
        kept.update(got)
        out = []
        for matches in found:
            numbers, ids, parts = zip(*map(kept.__getitem__, matches), strict=True) if matches else ((), (), ())
            out.append((sum(numbers), ",".join(ids), b"".join(parts)))
        for m in long:
            del kept[m]
        return out

    def both(self, text: str) -> tuple[int, str, bytes]:
        return self.all([text])[0]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, `ids` (decimal, joined by commas), `n_tokens`, and `decoded`, the bytes that the ids stand for.

    The rank table (some 50,000 tokens, whatever the corpus) is broadcast.
    """
    ranks = read_ranks(path)
    shared = sent(docs.sparkSession, (ranks, Merger(ranks)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, merger = shared.value
        codec = Codec(ranks, pattern, merger)
        for b in batches:
            ids, texts = b.column(0), b.column(1)
            for lo in range(0, b.num_rows, TEXTS):
                got = codec.all([t or "" for t in texts[lo : lo + TEXTS].to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [ids[lo : lo + TEXTS], pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string()), pa.array([g[2] for g in got], pa.binary())],
                    names=["id", "n_tokens", "ids", "decoded"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_tokens bigint, ids string, decoded binary").withColumnRenamed("id", id_col)


def digest(encoded: DataFrame) -> DataFrame:
    """Digests of the ids and of the decoded bytes."""
    return encoded.select("doc_id", "n_tokens", F.sha2(F.col("ids"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
