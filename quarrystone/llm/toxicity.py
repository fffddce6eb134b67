"""Toxicity by a convolutional text classifier, trained in numpy.

A word's embedding is the sum of hashed rows: two for the word, and one each for its first 3, 4 and 5
bytes, so that inflected forms share rows. Filters of several widths run over the embeddings, each is
max-pooled over the whole text, and a logistic layer gives a probability. Rows start from how unevenly
their words fall on labelled texts (a z-score of log odds); rows met in fewer than LEAST texts stay
zero, so that the net cannot learn single texts by heart.

Thresholds are calibrated on labelled texts kept out of the training, by language as told from the
text (by langid, whose model never sees held-out rows): a probability at its language's threshold maps
to a score of THRESHOLD, and order within a language is kept. Neither labels nor lang, source or ids
go into a score.

Defined results: null and empty texts have no activation and get the bias's score, which is learned from texts without words too; without labels, or
with one class only, every score is 0; labels that repeat or differ for a document count as toxic if
one does; repeated rows are scored each; other columns are left out.

Everything is learned from all labelled rows outside the held-out fold, from whole texts: in how many texts of either label each
row of the table stands, the net, the thresholds, and the languages (from all rows with a language). Three quarters of the labelled rows of
either label, by a hash of the id, train the net, the others set the thresholds. Training rows are dealt to shares
of a bounded size, a task learns from a share, and what the tasks learned is averaged after each pass of all rows (see shared.passed).
A table of one share is passed EPOCHS times, larger ones fewer times, LEAST_PASSES at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from . import langid
from .shared import ALNUM, Words, bit_filter, buffers, chunks, in_arrow, mix, passed, scope, sent, shares, sieve, written

#: How often a table of one share is passed, and any table at least.
EPOCHS, LEAST_PASSES = 6, 3
THRESHOLD = 0.7
ROWS, DIM, WIDTHS, FILTERS, LEAST = 1 << 20, 8, (1, 2, 3), 8, 3
PREFIXES = (3, 4, 5)
#: In so many texts of the training one is without words.
BLANK = 30
#: Words embedded at once.
AT_ONCE = 1 << 16
#: Of this many parts, one sets the thresholds; up to COUNTED rows of a label they are counted out exactly.
PARTS, COUNTED = 4, 10_000
#: Steps of probability that thresholds are told apart by.
GRID = 1 << 14


def word_rows(w: Words) -> np.ndarray:
    """Hashed rows (of ROWS) of each word; row 0 for prefixes that a word is too short for."""
    h = w.hashes()
    out = np.empty((len(h), 2 + len(PREFIXES)), np.int32)
    low = np.uint64(ROWS - 1)
    out[:, 0], out[:, 1] = h & low, (h >> np.uint64(24)) & low
    for k, n in enumerate(PREFIXES):
        ends = np.minimum(w.starts + n, w.ends)
        p = mix(w.hashes(w.starts, ends) + np.uint64(n)) & low
        out[:, 2 + k] = np.where(w.ends - w.starts >= n, p, 0)
    return out


def embedded(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Each word's sum of the table's rows."""
    out = np.take(table, rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        out += np.take(table, rows[:, k], axis=0)
    return out


@dataclass
class Net:
    #: The hashed rows that `table` has, in order; its row 0 is the zero row, of all others.
    known: np.ndarray
    table: np.ndarray
    filters: list[np.ndarray]
    offsets: np.ndarray
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    language: langid.Model | None = None
    #: Which of the texts it was fitted with were kept out.
    kept_out: list[int] = field(default_factory=list)
    _place: np.ndarray | None = None

    @property
    def place(self) -> np.ndarray:
        """From hashed row to row of `table`."""
        if self._place is None:
            self._place = np.zeros(ROWS, np.int32)
            self._place[self.known] = np.arange(1, len(self.known) + 1)
        return self._place

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_place": None}

    def activations(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter values at each start, by width, for embeddings x of words in a row."""
        got = []
        for n, f in zip(WIDTHS, self.filters, strict=True):
            m = max(len(x) - n + 1, 0)
            a = np.zeros((m, FILTERS), np.float32)
            for k in range(n):
                a += x[k : k + m] @ f[k]
            got.append(a)
        return got

    def pooled(self, w: Words) -> np.ndarray:
        """Largest value of each filter in each row's words, and 0 at least."""
        rows = len(w.first) - 1
        out = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
        hashed = word_rows(w)
        n, reach = len(hashed), max(WIDTHS) - 1
        for at in range(0, n, AT_ONCE):
            end = min(at + AT_ONCE, n)
            x = embedded(self.table, self.place[hashed[at : min(end + reach, n)]])
            # rows without words are in no block: they would get the next row's first value
            inside = np.flatnonzero((w.first[:-1] < end) & (w.first[1:] > at) & (w.first[:-1] < w.first[1:]))
            # words after a row's end are another row's: a filter may not reach over them
            last = w.first[np.searchsorted(w.first, np.arange(at, end), "right")]
            for k, a in enumerate(self.activations(x)):
                a = a[: end - at]
                fits = np.arange(at, at + len(a)) + WIDTHS[k] <= last[: len(a)]
                a = np.where(fits[:, None], a + self.offsets[k * FILTERS : (k + 1) * FILTERS], 0)
                starts = np.maximum(w.first[inside], at) - at
                some = starts < len(a)
                if some.any():
                    own = out[inside[some], k * FILTERS : (k + 1) * FILTERS]
                    out[inside[some], k * FILTERS : (k + 1) * FILTERS] = np.maximum(own, np.maximum.reduceat(a, starts[some]))
        return out

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(pooled @ self.out + self.bias, -30, 30)))

    def score(self, p: float, language: str) -> float:
        t = self.thresholds.get(language, self.thresholds.get("", 0.5))
        return THRESHOLD * p / t if p < t else THRESHOLD + (1 - THRESHOLD) * (p - t) / (1 - t)


def _words(texts: list[str]) -> Words:
    data, at = buffers(pa.array(texts, pa.string()))
    return Words(data, at, 0, len(texts), ALNUM)


class Learner:
    """Trains a net by Adagrad, one text at a time.

    Its numbers are a matrix: DIM columns of the net's numbers, the table's rows first, and as many of Adagrad's sums of squares.
    """

    def __init__(self, net: Net, numbers: np.ndarray | None = None):
        self.net, self.seen = net, 0
        if numbers is None:
            flat = np.concatenate([x.ravel() for x in (*net.filters, net.offsets, net.out, np.array([net.bias]))])
            rest = np.zeros((-(-len(flat) // DIM), DIM), np.float32)
            rest.ravel()[: len(flat)] = flat
            own = np.concatenate((net.table, rest))
            numbers = np.concatenate((own, np.full_like(own, 1e-3)), 1)
        self.numbers = numbers
        self.table, self.grown_table = numbers[: len(net.known) + 1, :DIM].copy(), numbers[: len(net.known) + 1, DIM:]
        self.flat, self.grown = (numbers[len(net.known) + 1 :, k : k + DIM].ravel() for k in (0, DIM))
        net.table = self.table
        # filters, offsets and the layer's weights are views of the flat numbers; the last one is the bias
        net.filters, net.offsets, net.out = self._parts(self.flat)
        self.last = sum(f.size for f in net.filters) + net.offsets.size + net.out.size
        net.bias = float(self.flat[self.last])

    @staticmethod
    def _parts(flat: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        sizes = [n * DIM * FILTERS for n in WIDTHS] + [len(WIDTHS) * FILTERS] * 2
        *filters, offsets, out = (flat[e - n : e] for n, e in zip(sizes, np.cumsum(sizes), strict=True))
        return [f.reshape(n, DIM, FILTERS) for n, f in zip(WIDTHS, filters, strict=True)], offsets, out

    def ended(self) -> np.ndarray:
        """The numbers with all that was learned."""
        self.flat[self.last] = self.net.bias
        self.numbers[: len(self.table), :DIM] = self.table
        self.numbers[len(self.table) :, :DIM], self.numbers[len(self.table) :, DIM:] = self.flat.reshape(-1, DIM), self.grown.reshape(-1, DIM)
        return self.numbers

    def learn_all(self, texts: list[str], toxic: list[int]) -> None:
        w = _words(texts)
        rows = self.net.place[word_rows(w)]
        for k, y in enumerate(toxic):
            self.learn(rows[w.first[k] : w.first[k + 1]], y)
            self.seen += 1
            # texts without words are a share of the training and not toxic, so that no activation means that
            if self.seen % BLANK == 1:
                self.learn(rows[:0], 0)

    def _largest(self, r: np.ndarray) -> tuple[np.ndarray, list[np.ndarray | None]]:
        """Each filter's largest value over a text's words, and where it starts; a part of the words at a time."""
        value, start = np.full((len(WIDTHS), FILTERS), -np.inf, np.float32), np.zeros((len(WIDTHS), FILTERS), np.int64)
        for at in range(0, len(r), AT_ONCE):
            for i, a in enumerate(self.net.activations(embedded(self.table, r[at : at + AT_ONCE + max(WIDTHS) - 1]))):
                a = a[:AT_ONCE]
                if len(a):
                    k = a.argmax(0)
                    top = a[k, np.arange(FILTERS)]
                    more = top > value[i]
                    value[i][more], start[i][more] = top[more], at + k[more]
        return value.ravel(), [start[i] if len(r) >= n else None for i, n in enumerate(WIDTHS)]

    def learn(self, r: np.ndarray, y: int, rate: float = 0.05) -> None:
        net = self.net
        value, best = self._largest(r)
        pooled = np.maximum(np.where(np.isfinite(value), value + net.offsets, 0), 0).astype(np.float32)
        g = float(net.probability(pooled)) - y
        back = np.where(pooled > 0, g * net.out, 0).astype(np.float32)
        filters, offsets, out = self._parts(self.grown)
        seen = [None if at is None else [embedded(self.table, r[at + step]) for step in range(n)] for n, at in zip(WIDTHS, best, strict=True)]
        d = g * pooled
        out += d * d
        net.out -= rate * d / np.sqrt(out)
        self.grown[self.last] += g * g
        net.bias -= rate * g / float(np.sqrt(self.grown[self.last]))
        offsets += back * back
        net.offsets -= rate * back / np.sqrt(offsets)
        for i, n in enumerate(WIDTHS):
            own = back[i * FILTERS : (i + 1) * FILTERS]
            if best[i] is None or not own.any():
                continue
            for step in range(n):
                d = seen[i][step].T * own
                filters[i][step] += d * d
                to_rows = (net.filters[i][step] * own).T
                net.filters[i][step] -= rate * d / np.sqrt(filters[i][step])
                rows = r[best[i] + step]
                touched = rows.ravel()
                d = np.repeat(to_rows, rows.shape[1], 0)
                live = touched > 0
                np.add.at(self.grown_table, touched[live], d[live] ** 2)
                np.subtract.at(self.table, touched[live], rate * d[live] / np.sqrt(self.grown_table[touched[live]]))


def standing(texts: list[str], toxic: list[int]) -> np.ndarray:
    """In how many texts that are not toxic, and that are, each hashed row stands."""
    counts, w = np.zeros((2, ROWS), np.int32), _words(texts)
    rows = word_rows(w)
    for k, y in enumerate(toxic):
        counts[int(y), np.unique(rows[w.first[k] : w.first[k + 1]])] += 1
    return counts


def begun(known: np.ndarray, counts: np.ndarray, total: list[float], rng: np.random.Generator) -> Net:
    """A net whose table starts from the counts (of texts that are not toxic, and that are) of its rows; total: of all texts."""
    t, n, total = counts[1] + 0.5, counts[0] + 0.5, [max(x, 1.0) for x in total]
    z = (np.log(t / total[1]) - np.log(n / total[0])) / np.sqrt(1 / t + 1 / n)
    table = np.zeros((len(known) + 1, DIM), np.float32)
    table[1:] = rng.normal(0, 0.01, (len(known), DIM))
    table[1:, 0] = np.clip(z / 4, -1, 2)
    filters = [rng.normal(0, 0.1, (n, DIM, FILTERS)).astype(np.float32) for n in WIDTHS]
    for f in filters:
        f[:, 0, :2] = 1 / len(f)
    return Net(known, table, filters, np.full(len(WIDTHS) * FILTERS, -0.5, np.float32), np.full(len(WIDTHS) * FILTERS, 0.1, np.float32), float(np.log(total[1] / total[0])))


def fit(texts: list[str], toxic: list[int], epochs: int = EPOCHS, seed: int = 5) -> Net | None:
    """A net trained on texts at hand, but for a fourth that are left for the thresholds."""
    y = np.array(toxic, np.int64)
    if not 0 < y.sum() < len(y):
        return None
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(texts))
    kept_out = np.zeros(len(texts), bool)
    for c in (0, 1):
        own = order[y[order] == c]
        kept_out[own[: len(own) // PARTS]] = True
    train = np.flatnonzero(~kept_out)
    counts = standing([texts[k] for k in train], y[train].tolist())
    counts[:, 0] = 0
    known = np.flatnonzero(counts.sum(0) >= LEAST)
    learner = Learner(begun(known, counts[:, known], [float((y[train] == c).sum()) for c in (0, 1)], rng))
    for _ in range(epochs):
        mixed = rng.permutation(train)
        for lo in range(0, len(mixed), 256):
            learner.learn_all([texts[k] for k in mixed[lo : lo + 256]], y[mixed[lo : lo + 256]].tolist())
    learner.ended()
    learner.net.kept_out = np.flatnonzero(kept_out).tolist()
    return learner.net


def steps(net: Net, language: langid.Model, texts: list[str], toxic: list[int]) -> dict[tuple[str, int], list[int]]:
    """How many texts that are not toxic, and that are, have each language and step of probability."""
    out: dict[tuple[str, int], list[int]] = {}
    for lo in range(0, len(texts), 256):
        part = texts[lo : lo + 256]
        for t, p, y in zip(part, net.probability(net.pooled(_words(part))), toxic[lo : lo + 256], strict=True):
            out.setdefault((told(language, t.encode()), int(p * GRID)), [0, 0])[int(y)] += 1
    return out


def with_thresholds(net: Net, language: langid.Model, found: dict[tuple[str, int], list[int]], least: int = 8) -> Net:
    """The threshold of the best F1 over all languages, and over each that has `least` toxic texts and as many others; between the two steps it parts."""

    def best(name: str | None) -> float | None:
        at = np.zeros((GRID + 1, 2), np.int64)
        for (own, step), n in found.items():
            if name is None or own == name:
                at[step] += n
        if not (at.sum(0) >= (1 if name is None else least)).all():
            return None
        step = np.flatnonzero(at.any(1))[::-1]
        p, n = np.append((step + 0.5) / GRID, 0), at[step]
        f1 = 2 * np.cumsum(n[:, 1]) / (np.cumsum(n.sum(1)) + n[:, 1].sum())
        k = int(f1.argmax())
        # even odds at least: with few texts the best threshold may let everything through
        return float(np.clip((p[k] + p[k + 1]) / 2, 0.5, 0.98))

    every = best(None)
    net.thresholds = {"": 0.5 if every is None else every}
    for name in sorted({x for x, _ in found}):
        if (own := best(name)) is not None:
            net.thresholds[name] = own
    net.language = language
    return net


def calibrate(net: Net, texts: list[str], toxic: list[int], language: langid.Model, least: int = 8) -> Net:
    """Thresholds from texts at hand."""
    return with_thresholds(net, language, steps(net, language, texts, toxic), least)


def told(model: langid.Model, data: bytes | np.ndarray) -> str:
    return model.decode(model.margins(np.frombuffer(data, np.uint8)))[0] if len(data) else langid.UND


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, text, label, kept_out): all rows of docs that have a label outside the held-out fold; one of PARTS of each label's rows is kept out, by a hash of the id."""
    kind = docs.schema["doc_id"].dataType
    own = labels.where(F.col("toxic").isNotNull() & (langid.fold(F.col("doc_id")) != langid.HELD_OUT))
    known = own.groupBy(F.col("doc_id").cast(kind).alias("id")).agg((F.max("toxic") == 1).cast("int").alias("label"))
    texts = docs.select(F.col("doc_id").alias("id"), F.col("text").cast("string").alias("text")).where("id is not null")
    rows = written(sieve(texts, "id", bit_filter(known, "id")).join(known, "id"))
    by = F.xxhash64(F.lit(PARTS), F.col("id").cast("string"))
    every = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(by, 1 / PARTS, COUNTED).alias("cut")).collect()
    cuts = {r["label"]: r["cut"] if r["n"] <= COUNTED else (1 << 64) // PARTS - (1 << 63) for r in every}
    return rows.withColumn("kept_out", by < F.when(F.col("label") == 1, cuts.get(1, 0)).otherwise(cuts.get(0, 0)))


def learned(docs: DataFrame, labels: DataFrame) -> Net | None:
    """A calibrated net from all labelled rows outside the held-out fold; None if there is nothing to learn."""
    with scope(docs.sparkSession):
        rows = labelled(docs, labels)
        train, rest = (rows.where(F.col("kept_out") == x).drop("kept_out") for x in (False, True))
        total = {r["label"]: float(r["count"]) for r in train.groupBy("label").count().collect()}
        return _learned(train, rest, total, langid.learned(docs)) if len(total) == 2 else None


def _learned(train: DataFrame, rest: DataFrame, total: dict[int, float], language: langid.Model) -> Net:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, ROWS), np.int64)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                sums += standing([x or "" for x in b.column(0)[lo : lo + 256].to_pylist()], b.column(1)[lo : lo + 256].to_pylist())
        hit = np.flatnonzero(sums.any(0))
        for lo in range(0, len(hit), 1 << 16):
            at = hit[lo : lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], names=["place", "n", "t"])

    found = train.select("text", "label").mapInArrow(count, "place bigint, n bigint, t bigint").groupBy("place").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    # row 0 is for prefixes that a word is too short for
    found = found.where((F.col("place") > 0) & (F.col("n") + F.col("t") >= LEAST)).toArrow()
    place, n, t = (c.to_numpy() for c in found.columns)
    order = np.argsort(place)
    net = begun(place[order], np.stack((n[order], t[order])), [total[0], total[1]], np.random.default_rng(5))
    dealt, parts = shares(train)
    shared = sent(train.sparkSession, Net(net.known, net.table[:0], [], net.offsets, net.out, 0.0))

    def learn(batches: Iterator[pa.RecordBatch], numbers: np.ndarray) -> list[int]:
        own = Learner(replace(shared.value), numbers)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                own.learn_all([x or "" for x in b.column(0)[lo : lo + 256].to_pylist()], b.column(1)[lo : lo + 256].to_pylist())
        own.ended()
        return []

    numbers = Learner(net).numbers
    for _ in range(max(LEAST_PASSES, -(-EPOCHS // parts))):
        with scope(train.sparkSession):
            numbers, _ = passed(dealt, numbers, learn)
    # the sums of squares have done their work
    net = Learner(net, numbers).net
    models = sent(train.sparkSession, (net, language))

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = steps(*models.value, [x or "" for x in b.column(0).to_pylist()], b.column(1).to_pylist())
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([k[c] for k in got]) for c in (0, 1)] + [pa.array([v[c] for v in got.values()], pa.int64()) for c in (0, 1)], names=["language", "step", "n", "t"])

    at = rest.select("text", "label").mapInArrow(tell, "language string, step bigint, n bigint, t bigint").groupBy("language", "step").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    return with_thresholds(net, language, {(r["language"], r["step"]): [r["n"], r["t"]] for r in at.collect()})


def score(docs: DataFrame, net: Net | None, text_col: str = "text", score_col: str = "__score") -> DataFrame:
    """The rows with all their columns, and score_col, which no column of docs may be called (see shared.unused)."""
    shared = sent(docs.sparkSession, net)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for b in batches:
            data, at = buffers(b.column(place).cast(pa.string()))
            for lo, hi in chunks(at):
                scores = np.zeros(hi - lo)
                if net:
                    p = net.probability(net.pooled(Words(data, at, lo, hi, ALNUM)))
                    scores[:] = [net.score(float(x), told(net.language, data[at[k] : at[k + 1]])) for k, x in enumerate(p, lo)]
                yield pa.RecordBatch.from_arrays([*[c[lo:hi] for c in b.columns], pa.array(scores, pa.float64())], names=[*b.schema.names, f"c{b.num_columns}"])

    return in_arrow(docs, run, [*docs.schema.fields, StructField(score_col, DoubleType())])


def judged(docs: DataFrame, net: Net | None) -> DataFrame:
    got = score(docs.select("doc_id", "text"), net)
    return got.select("doc_id", F.coalesce(langid.fold(F.col("doc_id")) == langid.HELD_OUT, F.lit(False)).alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= THRESHOLD).cast("int").alias("predicted"))
