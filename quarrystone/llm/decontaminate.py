"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of documents of at most shared.CHUNK bytes, or one longer document. All its words go into
the index: each is a symbol, and a run of words that no test phrase has is one break, as is the end of a document. All
phrases are searched backward together through wavelet-tree ranks; occurrences are located by sampled
suffix positions, checked letter by letter, and merged to removal spans.

Words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z. Phrases are all windows of `window`
consecutive words of an item; an item of fewer words, but not none, is one phrase.

Defined results: null text has no words, as document and as item; an item without an id hits words but
is not listed; items that share an id are one; repeated rows are judged each; an empty benchmark hits
nothing; other columns are left out but for those to carry, which may not be called like the result's. Test items
are taken in blocks of at most BLOCK_WORDS words (an item is not divided), and each block is a pass over the documents; its
result is written before the next block is built, so that one block is broadcast at a time at any benchmark size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .fmindex import FMIndex
from .shared import ALNUM, Words, buffers, chunks, column, sent, unused, written

BLOCK_WORDS = 1 << 18


class Phrases:
    """The windows of a block of items, as symbols of 2 and more; 1 stands for a break."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        found: dict[tuple[bytes, ...], set[str]] = {}
        self.n_words = 0
        for item, text in items:
            data, at = buffers(pa.array([text]))
            w = Words(data, at, 0, 1, ALNUM)
            words = [w.word(k) for k in range(len(w.starts))]
            self.n_words += len(words)
            for k in range(max(len(words) - window, 0) + 1 if words else 0):
                found.setdefault(tuple(words[k : k + window]), set()).update(() if item is None else (str(item),))
        vocabulary = sorted({x for p in found for x in p})
        data, at = buffers(pa.array([x.decode() for x in vocabulary], pa.string()))
        hashes = np.concatenate([Words(data, at, lo, hi, ALNUM).hashes() for lo, hi in chunks(at)]) if vocabulary else np.zeros(0, np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.words = hashes[order], [vocabulary[k] for k in order]
        symbol = {x: k + 2 for k, x in enumerate(self.words)}
        self.n_symbols = len(self.words) + 2
        self.items = [sorted(x) for x in found.values()]
        self.lengths = np.array([len(p) for p in found], np.int64)
        self.rows = np.zeros((len(found), max(self.lengths, default=0)), np.int64)
        for k, p in enumerate(found):
            self.rows[k, self.rows.shape[1] - len(p) :] = [symbol[x] for x in p]

    def symbols(self, w: Words) -> np.ndarray:
        """The symbol of each word, 1 for words that no phrase has."""
        if not len(self.hashes):
            return np.ones(len(w.starts), np.int64)
        h = w.hashes()
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, at + 2, 1)

    def occurrences(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Phrases and the words where they begin, for every occurrence within a document."""
        symbols = self.symbols(w)
        n = len(symbols)
        opens = np.zeros(n + 1, bool)
        opens[w.first] = True
        kept = np.flatnonzero(symbols > 1)
        if not len(kept):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        # a break wherever kept words don't follow each other, or a document begins
        gap = np.concatenate(([False], (np.diff(kept) > 1) | opens[kept[1:]]))
        place = np.arange(len(kept)) + np.cumsum(gap)
        text, word = np.ones(place[-1] + 1, np.int64), np.zeros(place[-1] + 1, np.int64)
        text[place], word[place] = symbols[kept], kept
        index = FMIndex(text, self.n_symbols, breaks=True)
        lo, hi = index.search(self.rows, self.lengths)
        count = np.maximum(hi - lo, 0)
        phrase = np.repeat(np.arange(len(count)), count)
        rows = np.repeat(lo - np.cumsum(count) + count, count) + np.arange(count.sum())
        at = word[index.locate(rows)]
        return self._checked(w, symbols, phrase, at)

    def _checked(self, w: Words, symbols: np.ndarray, phrase: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Without occurrences that only share the hashes of the words."""
        cover = np.zeros(len(symbols) + 1, np.int32)
        np.add.at(cover, at, 1)
        np.add.at(cover, at + self.lengths[phrase], -1)
        words = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        false = np.zeros(len(symbols) + 1, np.int64)
        by = words[np.argsort(symbols[words], kind="stable")]
        for group in np.split(by, np.flatnonzero(np.diff(symbols[by])) + 1) if len(by) else []:
            true = np.frombuffer(self.words[symbols[group[0]] - 2], np.uint8)
            same = w.ends[group] - w.starts[group] == len(true)
            same[same] = (w.low[w.starts[group[same]][:, None] + np.arange(len(true))] == true).all(1)
            false[group[~same]] = 1
        if false.any():
            upto = np.concatenate(([0], np.cumsum(false)))
            fine = upto[at + self.lengths[phrase]] == upto[at]
            phrase, at = phrase[fine], at[fine]
        return phrase, at


def blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> Iterator[Phrases]:
    held, size = [], 0
    for item, text in benchmark.select(F.col(item_col), F.col(text_col).cast("string")).toLocalIterator():
        held.append((item, text or ""))
        size += len(text or "") // 2
        if size > BLOCK_WORDS:
            yield Phrases(held, window)
            held, size = [], 0
    yield Phrases(held, window)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", clean: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: its id, `n_words`, `n_hit`, `items` (ids of the items with occurring phrases, as sorted strings), `spans` (byte ranges of the text to remove, merged) and, if asked for, `clean`, the text without them; then the columns of `carry`."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType
    names = unused(list(carry), *[f"carried{k}" for k in range(len(carry))])
    out = docs.select(column(id_col).alias("id"), column(text_col).cast("string").alias("text"), F.expr("cast(array() as array<int>)").alias("hits"), F.expr("cast(array() as array<string>)").alias("items"), *[column(c).alias(n) for c, n in zip(carry, names, strict=True)])
    more = [StructField(n, docs.schema[c].dataType) for c, n in zip(carry, names, strict=True)]
    between = StructType([StructField("id", kind), *out.schema.fields[1:4], *more])
    spans = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))
    result = StructType([StructField("id", kind), StructField("n_words", LongType()), StructField("n_hit", LongType()), StructField("items", ArrayType(StringType())), StructField("spans", spans), *[StructField("clean", StringType())] * clean, *more])
    found = blocks(benchmark, window, item_col, item_text_col)
    block = next(found)
    while (following := next(found, None)) is not None:
        shared = sent(spark, block)
        out = written(out.mapInArrow(_pass(shared, False, clean), between))
        shared.unpersist()
        block = following
    out = out.mapInArrow(_pass(sent(spark, block), True, clean), result)
    return out.toDF(id_col, "n_words", "n_hit", "items", "spans", *["clean"] * clean, *carry)


def _pass(shared, last: bool, clean: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = shared.value
        for b in batches:
            data, at = buffers(b.column(1))
            for lo, hi in chunks(at):
                w = Words(data, at, lo, hi, ALNUM)
                phrase, start = phrases.occurrences(w)
                end = start + phrases.lengths[phrase]
                row = np.searchsorted(w.first, start, "right") - 1
                items: dict[int, set[str]] = {}
                for r, p in set(zip(row.tolist(), phrase.tolist(), strict=True)):
                    items.setdefault(r, set()).update(phrases.items[p])
                cover = np.zeros(len(w.starts) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, end, -1)
                for r, (old, ids) in enumerate(zip(b.column(2)[lo:hi].to_pylist(), b.column(3)[lo:hi].to_pylist(), strict=True)):
                    for s, e in zip(old[::2], old[1::2], strict=True):
                        cover[w.first[r] + s] += 1
                        cover[w.first[r] + e] -= 1
                    if ids:
                        items.setdefault(r, set()).update(ids)
                hit = np.cumsum(cover[:-1]) > 0
                opens = np.zeros(len(hit) + 1, bool)
                opens[w.first] = True
                s = np.flatnonzero(hit & (opens[:-1] | ~np.concatenate(([False], hit[:-1])))) if len(hit) else np.zeros(0, np.int64)
                e = np.flatnonzero(hit & (opens[1:] | ~np.concatenate((hit[1:], [False])))) + 1 if len(hit) else np.zeros(0, np.int64)
                by = np.searchsorted(s, w.first)
                rest, rest_names = [c[lo:hi] for c in b.columns[4:]], b.schema.names[4:]
                named = [sorted(items.get(r, ())) for r in range(hi - lo)]
                if not last:
                    hits = [np.stack((s[by[r] : by[r + 1]], e[by[r] : by[r + 1]]), 1).ravel() - w.first[r] for r in range(hi - lo)]
                    yield pa.RecordBatch.from_arrays([b.column(0)[lo:hi], b.column(1)[lo:hi], pa.array(hits, pa.list_(pa.int32())), pa.array(named, pa.list_(pa.string())), *rest], names=["id", "text", "hits", "items", *rest_names])
                    continue
                upto = np.concatenate(([0], np.cumsum(hit)))
                own = at[lo:hi] - at[lo]
                spans = [[{"start": int(w.starts[a] - own[r]), "end": int(w.ends[z - 1] - own[r])} for a, z in zip(s[by[r] : by[r + 1]], e[by[r] : by[r + 1]], strict=True)] if by[r] < by[r + 1] else [] for r in range(hi - lo)]
                columns = [
                    b.column(0)[lo:hi],
                    pa.array(np.diff(w.first), pa.int64()),
                    pa.array(upto[w.first[1:]] - upto[w.first[:-1]], pa.int64()),
                    pa.array(named, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ]
                if clean:
                    columns.append(pa.array([without(t, x) if x else t for t, x in zip(b.column(1)[lo:hi].to_pylist(), spans, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays([*columns, *rest], names=["id", "n_words", "n_hit", "items", "spans"] + ["clean"] * clean + rest_names)

    return run


def without(text: str, spans: list[dict]) -> str:
    """The text without byte ranges of its UTF-8 form."""
    data, at, left = text.encode(), 0, []
    for x in spans:
        left.append(data[at : x["start"]])
        at = x["end"]
    return b"".join([*left, data[at:]]).decode()


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
