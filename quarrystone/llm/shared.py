"""What several operators share: UTF-8 buffers, word scanning on bytes, checkpoints, bounded filters.

Text is handled as one byte buffer with offsets, so that words of a batch are found and hashed by
a few array operations. Work goes in chunks of at most CHUNK bytes (a longer document is a chunk of
its own), which bounds the memory of a Python worker.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

CHUNK = 1 << 20
_MULT = 0x9E3779B97F4A7C15
_INV = pow(_MULT, -1, 1 << 64)

#: A-Z to a-z, all else as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of lower-cased UTF-8.
ALNUM = np.array([b >= 128 or 48 <= b < 58 or 97 <= b < 123 for b in range(256)])
#: Bytes of the words [^\x20\x09-\x0D]+.
SOLID = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = (column.fill_null("") if column.null_count else column).cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def chunks(at: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most `size` bytes, or one row."""
    row, n = 0, len(at) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        yield row, min(end, n)
        row = min(end, n)


_POWERS: list[np.ndarray] = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_MULT, _INV)):
            x = np.full(max(n, CHUNK) + 1, base, np.uint64)
            x[0] = 1
            _POWERS[k] = np.cumprod(x, dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Words of rows lo..hi of a buffer: starts and ends in `low` (the lower-cased bytes), and first[i]..first[i+1], the words of row lo + i."""

    def __init__(self, data: np.ndarray, at: np.ndarray, lo: int, hi: int, table: np.ndarray):
        self.low = LOWER[data[at[lo] : at[hi]]]
        rows = at[lo : hi + 1] - at[lo]
        inside = table[self.low]
        n = len(inside)
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[rows[:-1][rows[:-1] < n]] = False
        after[rows[1:][rows[1:] > 0] - 1] = False
        self.starts, self.ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, rows)
        self._sums: np.ndarray | None = None

    def hashes(self, starts: np.ndarray | None = None, ends: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of other spans of bytes."""
        starts, ends = (self.starts, self.ends) if starts is None else (starts, ends)
        up, down = _powers(len(self.low) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.low) + 1, np.uint64)
            np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * up[: len(self.low)], out=self._sums[1:])
        return mix((self._sums[ends] - self._sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))

    def word(self, k: int) -> bytes:
        return self.low[self.starts[k] : self.ends[k]].tobytes()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, a local one if all runs on one machine, else an error."""
    small_batches(spark)
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not found:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file:///tmp/checkpoints"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


#: Bytes of an Arrow batch. Texts are long, and several copies of a batch are alive at once in the JVM and in Python.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Sets the session's limit of bytes to an Arrow batch to BATCH_BYTES, if it is larger."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark.conf.get(key).removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


class Scope:
    """What is written and broadcast until its end."""

    def __init__(self) -> None:
        self.paths: list[str] = []
        self.values: list[Broadcast] = []


#: The scopes that are open in this thread, the outermost first.
_OPEN: ContextVar[tuple[Scope, ...]] = ContextVar("open", default=())


@contextmanager
def _tidy(spark: SparkSession) -> Iterator[None]:
    """Lets shuffle files go when the execution inside ends: what it has written is read instead."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared folder and read again: later stages survive lost executors and don't run it twice.

    Tables are in a folder of the application, which may be deleted when it has ended; those of a scope go with it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tables/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    with _tidy(spark):
        df.write.parquet(path)
    if _OPEN.get():
        _OPEN.get()[-1].paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def sent(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of value, which goes when the scope ends; outside of scopes, when no plan has it any more."""
    out = spark.sparkContext.broadcast(value)
    if _OPEN.get():
        _OPEN.get()[-1].values.append(out)
    return out


@contextmanager
def scope(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Deletes what is written and broadcast inside when it ends, but for what the function that it gives has written.

    Shuffle files of other plans go when the driver's JVM collects its garbage; that is asked for here.
    """
    own, before = Scope(), _OPEN.get()

    def keep(df: DataFrame) -> DataFrame:
        out = written(df)
        kept = own.paths.pop()
        if before:
            before[-1].paths.append(kept)
        return out

    token = _OPEN.set((*before, own))
    try:
        yield keep
    finally:
        _OPEN.reset(token)
        jvm = spark.sparkContext._jvm
        for value in own.values:
            value.destroy()
        for path in own.paths:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
        jvm.System.gc()


#: Rows and bytes of text in a share, on average, and what parts of 1 changes are added up in, as whole numbers, so that their order is without effect.
SHARE_ROWS, SHARE_BYTES, PARTS = 4000, 16 << 20, 1 << 32


def shares(rows: DataFrame) -> tuple[DataFrame, int]:
    """All rows (id, text, label), dealt by a hash of the id and sorted, as tasks learn from them, and the number of shares. No row is left out."""
    n, size = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-n // SHARE_ROWS), -(-size // SHARE_BYTES))
    by = F.xxhash64(F.col("id").cast("string"))
    return rows.repartition(parts, by).sortWithinPartitions(by, "id", "text", "label").select("text", "label"), parts


def passed(rows: DataFrame, start: np.ndarray, learn: Callable[[Iterator[pa.RecordBatch], np.ndarray], list[int]], sums: int = 0) -> tuple[np.ndarray, list[int]]:
    """What learning from all rows once makes of `start`, the numbers of a model as a matrix, and `sums` sums over the rows.

    Each task changes a copy by its share, in `learn`, which gives its sums; a row of the matrix moves by the mean over the tasks that
    changed it. The driver gets the changed rows alone, so at most the model's size.
    """
    spark, (n, width) = rows.sparkSession, start.shape
    shared = sent(spark, start)
    names = [f"v{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value.copy()
        counted = learn((b for b in batches if b.num_rows), own)
        hit = np.flatnonzero((own != shared.value).any(1))
        for lo in range(0, len(hit), 1 << 14):
            at = hit[lo : lo + (1 << 14)]
            moved = np.rint((own[at].astype(np.float64) - shared.value[at]) * PARTS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(moved[:, k]) for k in range(width)]], names=["place", *names])
        if sums:
            empty = pa.array(np.zeros(sums, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, n + sums)), pa.array(counted, pa.int64()), *[empty] * (width - 1)], names=["place", *names])

    added = rows.mapInArrow(run, "place bigint, " + ", ".join(f"{c} bigint" for c in names)).groupBy("place").agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in names])
    mean = [(F.col(c) / F.col("n") / F.lit(float(PARTS))).cast("float").alias(c) for c in names]
    with _tidy(spark):
        got = added.select("place", F.when(F.col("place") >= n, F.col("v0")).alias("sum"), *mean).toArrow()
    place = got["place"].to_numpy()
    model = place < n
    out = start.copy()
    for k, c in enumerate(names):
        out[place[model], k] += got[c].to_numpy()[model]
    totals = dict(zip(place[~model].tolist(), got["sum"].to_numpy()[~model].astype(np.int64).tolist(), strict=True))
    return out, [totals.get(n + k, 0) for k in range(sums)]


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, changed where a table's columns are called so."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def column(name: str) -> Column:
    """A column by its whole name, whatever signs are in it."""
    return F.col(f"`{name.replace('`', '``')}`")


FILTER_BITS = 1 << 25


def bit_filter(df: DataFrame, key: str) -> np.ndarray:
    """A bitmap of FILTER_BITS (4 MiB, at any size of df) of a long column's values.

    Rows that miss it can be left out of a join's shuffle; those that hit it by chance go there and find no partner.
    """
    at = F.pmod(F.xxhash64(column(key)), F.lit(FILTER_BITS))
    rows = (
        df.select(at.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("w"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(p & 63 as int))")).alias("b"))
        .toArrow()
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out


def marked(df: DataFrame, key: str) -> DataFrame:
    """df with the place of each row's key in the bitmap of bit_filter as a last column."""
    return df.withColumn(unused(df.columns, "at")[0], F.coalesce(F.pmod(F.xxhash64(column(key)), F.lit(FILTER_BITS)), F.lit(0)))


def passing(batches: Iterator[pa.RecordBatch], bits: np.ndarray, hit: bool = True) -> Iterator[pa.RecordBatch]:
    """Of batches with a last column as by `marked`: the rows that the bitmap holds, or the others, without that column."""
    for b in batches:
        p = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
        take = ((bits[p >> 6] >> (p & 63)) & 1 == 1) == hit
        if take.any():
            own = b.select(list(range(b.num_columns - 1)))
            yield own if take.all() else own.filter(pa.array(take))


def sieve(df: DataFrame, key: str, bits: np.ndarray, hit: bool = True) -> DataFrame:
    """Rows of df whose key may be in the bitmap (see bit_filter), or the others."""
    shared = sent(df.sparkSession, bits)
    return in_arrow(marked(df, key), lambda batches: passing(batches, shared.value, hit), df.schema.fields)


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], fields: list[StructField]) -> DataFrame:
    """mapInArrow for columns of any names: in run they are c0, c1 and so on, and so are those that it gives."""
    plain = [StructField(f"c{k}", f.dataType) for k, f in enumerate(fields)]
    out = df.toDF(*[f"c{k}" for k in range(len(df.columns))]).mapInArrow(run, StructType(plain))
    return out.toDF(*[f.name for f in fields])


def places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and bit of longs in a bitmap by key_filter."""
    p = mix(values.view(np.uint64)) % np.uint64(FILTER_BITS)
    return (p >> np.uint64(6)).astype(np.int64), (p & np.uint64(63)).astype(np.int64)


def key_filter(df: DataFrame, key: str) -> np.ndarray:
    """The same as bit_filter with a hash that Python workers have too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            word, bit = places(b.column(0).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(np.int64(1) << bit)], names=["w", "b"])

    rows = df.select(key).mapInArrow(run, "w bigint, b bigint").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[rows["w"].to_numpy()] = rows["b"].to_numpy()
    return out
