"""Language identification by error-correcting output codes.

Every language has a codeword; for each of its bits a binary classifier over byte n-grams (pairs, and
hashed triples, of the lower-cased text) is trained by logistic regression. A text's n-gram counts, divided by their number, give a
margin for each bit; decoding sums the exponential loss of the margins against every codeword,
each bit weighted by how well its classifier did on the sample, and takes the nearest codeword. If
the second is not clearly farther, the answer is flagged as ambiguous.

Defined results: null text and text without any letter give `und` with score 0; without rows to
learn from every text gives `und`, and with one language only that one; repeated rows are judged each,
ties go to the first language in order; other columns are left out.

The model is learned from every row with text and language outside the held-out fold, from whole texts. Rows are dealt by
a hash of the id to shares of a bounded size, a task learns from a share, and what the tasks learned is averaged after each pass of all
rows (see shared.passed). A table of one share is passed EPOCHS times, larger ones fewer times, LEAST_PASSES at least.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import LOWER, buffers, chunks, passed, scope, sent, shares

#: How often a table of one share is passed, and any table at least.
EPOCHS, LEAST_PASSES = 12, 2
FOLDS, HELD_OUT = 3, 1
#: Hashed triples; pairs have a weight each.
TRIPLES = 1 << 15
FEATURES = (1 << 16) + TRIPLES
AMBIGUOUS = 0.2
UND = "und"
#: Bytes of which features are taken at once.
STEP = 1 << 18


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo FOLDS; null where the id is null."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(FOLDS))


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """n rows of +1 and -1, far from each other: all two-class splits up to 6 classes, else the best of random codes."""
    if n <= 6:
        columns = [[1 if k == 0 or k in rest else -1 for k in range(n)] for size in range(n - 1) for rest in combinations(range(1, n), size)]
        return np.array(columns, np.float32).T.reshape(n, -1)
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(n)))
    best, least = None, -1
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits)).astype(np.float32)
        apart = int(((bits - code @ code.T) / 2 + bits * np.eye(n)).min())
        if apart > least and (np.abs(code.sum(0)) < n).all():
            best, least = code, apart
    return best


def grams(low: np.ndarray) -> np.ndarray:
    """Features of lower-cased bytes: the pair that begins at each byte, then the triples."""
    x = low.astype(np.uint32)
    pairs = (x[:-1] << np.uint32(8)) | x[1:]
    triples = ((((pairs[:-1].astype(np.uint64) << np.uint64(8)) | x[2:]) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(49)).astype(np.uint32) + np.uint32(1 << 16)
    return np.concatenate((pairs, triples))


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.float32))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((FEATURES, 0), np.float32))
    bias: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    trust: np.ndarray = field(default_factory=lambda: np.zeros(0, np.float32))
    _wide: np.ndarray | None = None

    @property
    def wide(self) -> np.ndarray:
        """The weights as doubles."""
        if self._wide is None:
            self._wide = self.weights.astype(np.float64)
        return self._wide

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_wide": None}

    def margins(self, data: np.ndarray) -> np.ndarray:
        """Mean weight of the n-grams of a text's bytes, for each bit. Long texts are taken in overlapping steps; the counts are whole."""
        total, count = np.zeros(self.code.shape[1], np.float64), 0
        for at in range(0, max(len(data) - 1, 0), STEP):
            part = LOWER[data[at : at + STEP + 2]]
            # a pair and a triple for each byte of the step where they fit
            pairs = min(STEP, len(part) - 1)
            triples = min(STEP, len(part) - 2)
            f = grams(part)
            f = np.concatenate((f[:pairs], f[len(part) - 1 :][:triples]))
            total += np.ones(len(f)) @ np.take(self.wide, f, axis=0)
            count += len(f)
        return total / max(count, 1) + self.bias

    def decode(self, margins: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and whether it is ambiguous, by weighted exponential loss against each codeword."""
        if len(self.languages) < 2:
            return (self.languages[0], 1.0, False) if self.languages else (UND, 0.0, False)
        loss = (self.trust * np.exp(np.clip(-self.code * margins, -8, 8))).sum(1)
        p = np.exp(-(loss - loss.min()))
        p /= p.sum()
        best = int(p.argmax())
        rest = np.delete(p, best).max()
        return self.languages[best], float(p[best]), bool(p[best] - rest < AMBIGUOUS)


class Learner:
    """Logistic regression for all bits at once, by Adagrad over single texts' n-gram frequencies.

    Its numbers are a matrix: a row for each feature and one for the bias, with a column for each bit and one for Adagrad's sum of squares.
    """

    def __init__(self, code: np.ndarray, weigh: list[float], numbers: np.ndarray | None = None):
        self.code, self.weigh = code, weigh
        if numbers is None:
            numbers = np.zeros((FEATURES + 1, code.shape[1] + 1), np.float32)
            numbers[:-1, -1], numbers[-1, -1] = 1e-6, 1
        self.numbers = numbers
        self.right, self.seen = np.zeros(code.shape[1], np.int64), 0

    def learn(self, text: str, language: int) -> None:
        low = LOWER[np.frombuffer(text.encode(), np.uint8)]
        if len(low) < 2:
            return
        f, x = frequencies(low)
        own, bias, y = np.take(self.numbers, f, axis=0), self.numbers[-1], self.code[language]
        margin = x @ own[:, :-1] + bias[:-1]
        self.right += np.sign(margin) == y
        self.seen += 1
        g = -y / (1 + np.exp(np.clip(y * margin, -30, 30))) * np.float32(self.weigh[language])
        step = x[:, None] * g
        own[:, -1] += (step**2).mean(1)
        own[:, :-1] -= 0.5 * step / np.sqrt(own[:, -1:])
        self.numbers[f] = own
        bias[-1] += float((g**2).mean())
        bias[:-1] -= 0.05 * g / np.sqrt(bias[-1])

    def model(self, names: list[str], right: np.ndarray, seen: int) -> Model:
        """right: how often each bit was told rightly, of texts seen in the last pass."""
        better = np.clip(right / max(seen, 1) - 0.5, 0.01, None)
        return Model(names, self.code, self.numbers[:-1, :-1].copy(), self.numbers[-1, :-1].copy(), (better / better.sum() * 2).astype(np.float32))


def frequencies(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The features of lower-cased bytes and their share each; counted in steps, so that long texts take no more memory."""
    if len(low) <= STEP:
        f, c = np.unique(grams(low), return_counts=True)
    else:
        every = np.zeros(FEATURES, np.int64)
        for at in range(0, len(low) - 1, STEP):
            part = low[at : at + STEP + 2]
            g = grams(part)
            every += np.bincount(np.concatenate((g[: min(STEP, len(part) - 1)], g[len(part) - 1 :][: min(STEP, len(part) - 2)])), minlength=FEATURES)
        f = np.flatnonzero(every)
        c = every[f]
    return f, (c / c.sum()).astype(np.float32)


def fit(texts: list[str], languages: list[str], epochs: int = EPOCHS, seed: int = 3) -> Model:
    """A model from texts at hand."""
    names = sorted(set(languages))
    if len(names) < 2:
        return Model(names)
    # languages weigh the same, however many rows each has
    learner = Learner(codewords(len(names)), [len(languages) / (len(names) * languages.count(x)) for x in names])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        learner.right[:], learner.seen = 0, 0
        for k in rng.permutation(len(texts)):
            learner.learn(texts[k], names.index(languages[k]))
    return learner.model(names, learner.right, learner.seen)


def learned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """A model from all rows with text and language outside the held-out fold."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (fold(F.col(id_col)) != HELD_OUT))
    rows = known.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("label"))
    often = dict(sorted((r[0], r[1]) for r in rows.groupBy("label").count().collect()))
    names = list(often)
    if len(names) < 2:
        return Model(names)
    code, number = codewords(len(names)), {x: k for k, x in enumerate(names)}
    weigh = [sum(often.values()) / (len(names) * often[x]) for x in names]
    learner = Learner(code, weigh)
    dealt, parts = shares(rows)

    def learn(batches: Iterator[pa.RecordBatch], numbers: np.ndarray) -> list[int]:
        own = Learner(code, weigh, numbers)
        for b in batches:
            for text, label in zip(b.column(0), b.column(1), strict=True):
                own.learn(text.as_py(), number[label.as_py()])
        return [*own.right.tolist(), own.seen]

    for _ in range(max(LEAST_PASSES, -(-EPOCHS // parts))):
        with scope(docs.sparkSession):
            learner.numbers, (*right, seen) = passed(dealt, learner.numbers, learn, code.shape[1] + 1)
    return learner.model(names, np.array(right), seen)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, `lang_pred`, `score`, `ambiguous`."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = sent(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(r"\p{L}").search
        model = shared.value
        for b in batches:
            data, at = buffers(b.column(1))
            texts = b.column(1)
            out = []
            for lo, hi in chunks(at):
                for k, t in zip(range(lo, hi), texts[lo:hi].to_pylist(), strict=True):
                    out.append(model.decode(model.margins(data[at[k] : at[k + 1]])) if t and letter(t) else (UND, 0.0, False))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64()), pa.array([x[2] for x in out], pa.bool_())], names=["id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double, ambiguous boolean").withColumnRenamed("id", id_col)


def judged(docs: DataFrame, model: Model) -> DataFrame:
    got = predict(docs, model)
    return got.select("doc_id", F.coalesce(fold(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
