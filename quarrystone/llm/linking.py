"""Connected groups from shared buckets, without pairs of whole buckets.

`grouped` gets the keys of nodes' buckets and a sketch of each node to compare; those that share a bucket may be alike. It finds the
same groups as if all pairs within every bucket were compared and checked:

1. In a bucket of up to FEW rows (with `in_arrays` up to FEW * WIDER, if few pairs of them are near) the sketches of all pairs are
   compared; in a larger one each member's with that of the first member (the pivot). Of the pairs that the sketches leave, each member's likeliest is checked, and the links found are closed to groups.
2. The other pairs are checked where they are between groups.
3. Larger buckets that still hold several groups are finished: members outside of a bucket's largest group are compared with all
   its members. Where these are many, both are cut into chunks of bounded size, a row is a pair of chunks, and what it gives is
   links that join groups, not pairs. There is no cap. Chunks are joined by their number too, so that a large bucket's pairs
   of chunks are dealt over as many tasks as it has chunks.

Texts are fetched only for members that the sketches leave a partner.

Buckets are compared in turns, by parts of the keys, so that what lies on disk at once is a part of all members of buckets.

Groups are closed by alternating large-star and small-star, over what links of a partition give among themselves. Every intermediate table is written to the
shared folder, so that no step depends on an executor's memory or disk.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections import OrderedDict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType

from .shared import key_filter, places, scope, sent, written

#: Members and bytes of text in a chunk, on average, and bytes of texts kept in their compared form by a worker.
CHUNK_ROWS, CHUNK_BYTES, KEEP_BYTES = 128, 1 << 19, 4 << 20
#: Up to so many members are compared in a row of their own.
FEW = 32
#: Links, on average, that a task closes among themselves before stars go over all of them.
EDGES = 1 << 15
#: Keys of nodes, on average, whose buckets are compared at once, and the most turns that takes: each reads all nodes.
KEYS_AT_ONCE, TURNS = 12 << 20, 8
#: Where members are rows and not dealt out as bytes, a key takes so many times as much.
ROWS_WEIGH = 6
#: Where they are dealt out: parts of the keys for each task that gets them, keys that a task deals out or compares together, and
#: times FEW the members of a bucket that are compared there.
PARTS_A_TASK, PART_KEYS, WIDER = 16, 1 << 18, 16


class Likeness(ABC):
    """What makes two members alike. The sketch is the columns of longs named in `sketch`."""

    sketch: tuple[str, ...]
    #: Whether ids are longs and `near_rows` is there: members of buckets are then dealt out as bytes and compared in arrays.
    in_arrays = False
    #: Keys whose buckets are compared at once, as `grouped` found; they say how many tasks get them.
    keys_at_once = 0

    @abstractmethod
    def near(self, x: Column, y: Column) -> Column:
        """Whether two structs of the sketch allow it."""

    @abstractmethod
    def likely(self, x: Column, y: Column) -> Column:
        """More for what is likelier."""

    @abstractmethod
    def near_arrays(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """`near` of each row of x and each row of y."""

    def near_rows(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """`near` and `likely` of each row of x and the same row of y, and how many keys two members alike have in common at least."""
        raise NotImplementedError

    @abstractmethod
    def form(self, text: str):
        """A text in the form that `alike` compares."""

    @abstractmethod
    def alike(self, x, y) -> bool: ...

    def may_be_alike(self, x: list, y: list, near: np.ndarray) -> np.ndarray:
        """`near` without pairs of the forms x and y that something cheaper than `alike` rules out."""
        return near


class _Forms:
    """Forms of the texts met last."""

    def __init__(self, likeness: Likeness):
        self.likeness, self.kept, self.size = likeness, OrderedDict(), 0

    def __call__(self, text: str):
        if (f := self.kept.get(text)) is None:
            self.kept[text] = f = self.likeness.form(text)
            self.size += len(text)
            while self.size > KEEP_BYTES and len(self.kept) > 2:
                self.size -= len(self.kept.popitem(last=False)[0])
        return f


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v), u > v: every node's larger (large) or smaller neighbours move to its least neighbour."""
    sym = edges.union(edges.select("v", "u")).toDF("u", "v") if large else edges
    least = sym.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    met = sym.join(least, "u")
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        # the node itself moves too
        out = met.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    out = out.where("u <> v")
    return written(out if large else out.distinct())


def _closed(edges: DataFrame) -> bool:
    """Whether every edge leads from a node to the root of its star: no node has two, and no root has one itself."""
    ends = edges.select(F.col("u").alias("n"), "v", F.lit(0).alias("root")).union(edges.select("v", F.lit(None), F.lit(1)))
    return ends.groupBy("n").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.max("root").alias("root")).where("a <> b or (a is not null and root = 1)").isEmpty()


def _stars_within(links: DataFrame) -> DataFrame:
    """Of links (a, b), some EDGES in each partition: edges (u, v), u > v, from each node to the least that it is connected with inside its partition."""
    kind = links.schema["a"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not tables:
            return
        every = pa.Table.from_batches(tables)
        both = pa.chunked_array([*every.column(0).chunks, *every.column(1).chunks]).combine_chunks()
        names = both.unique()
        names = names.take(pc.sort_indices(names))
        at = pc.index_in(both, names).to_numpy(zero_copy_only=False).tolist()
        up = list(range(len(names)))

        def root(k: int) -> int:
            while up[k] != k:
                up[k] = k = up[up[k]]
            return k

        for x, y in zip(at[: every.num_rows], at[every.num_rows :], strict=True):
            x, y = root(x), root(y)
            up[max(x, y)] = min(x, y)
        roots = np.array([root(k) for k in range(len(up))], np.int64)
        moved = np.flatnonzero(roots != np.arange(len(roots)))
        yield pa.RecordBatch.from_arrays([names.take(pa.array(moved)), names.take(pa.array(roots[moved]))], names=["u", "v"])

    parts = -(-links.count() // EDGES)
    # the order of other kinds of ids is Spark's alone
    if not isinstance(kind, IntegralType | StringType):
        return links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    return links.coalesce(max(parts, 1)).mapInArrow(run, f"u {kind.simpleString()}, v {kind.simpleString()}")


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b): the least id that it is connected with."""
    with scope(links.sparkSession) as keep:
        edges = written(_stars_within(links.select("a", "b")))
        while not _closed(edges):
            edges = _stars(_stars(edges, large=True), large=False)
        return keep(edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))


def _between(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs whose ends are in different groups; an id without a group is one of its own."""
    for end in ("a", "b"):
        pairs = pairs.join(groups.select(F.col("id").alias(end), F.col("component").alias(f"__{end}")), end, "left").withColumn(f"__{end}", F.coalesce(f"__{end}", end))
    return pairs.where("__a <> __b").select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, likeness: Likeness) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) are alike."""
    kind = pairs.schema["a"].dataType.simpleString()
    both = pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = _Forms(likeness)
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                part = b.slice(lo, 64)
                yes = pa.array([likeness.alike(forms(x), forms(y)) for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)], pa.bool_())
                yield pa.RecordBatch.from_arrays([pc.filter(part.column(k), yes) for k in (0, 1)], names=["a", "b"])

    return both.mapInArrow(run, f"a {kind}, b {kind}")


def _in_buckets(nodes: DataFrame, bits: np.ndarray, sketch: tuple[str, ...]) -> DataFrame:
    """(key, id, sketch) for every key of a node that the bitmap may hold, once in a batch."""
    shared = sent(nodes.sparkSession, bits)
    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            flat = keys.flatten().to_numpy(zero_copy_only=False)
            word, bit = places(flat)
            hit = np.flatnonzero((shared.value[word] >> bit) & 1)
            if len(hit):
                rows = np.repeat(np.arange(b.num_rows), pc.list_value_length(keys).to_numpy(zero_copy_only=False))[hit]
                # copies of a node, of which a batch may be full, have the same keys
                number = pc.dictionary_encode(b.column(1)).indices.to_numpy(zero_copy_only=False)[rows]
                order = np.lexsort((number, flat[hit]))
                once = np.ones(len(order), bool)
                once[1:] = (flat[hit][order][1:] != flat[hit][order][:-1]) | (number[order][1:] != number[order][:-1])
                take = order[once]
                yield pa.RecordBatch.from_arrays([pa.array(flat[hit][take]), *[pc.take(c, pa.array(rows[take])) for c in b.columns[1:]]], names=["key", *b.schema.names[1:]])

    return nodes.select("keys", "id", *sketch).mapInArrow(run, "key bigint, " + ", ".join(f"{c} {kinds[c]}" for c in ("id", *sketch)))


def _near_in_buckets(nodes: DataFrame, likeness: Likeness) -> tuple[DataFrame, DataFrame | None]:
    """The pairs (a, b, likely) that the sketches leave of buckets of nodes, and the rows (key, id, sketch, first) of those with more than FEW members."""
    if likeness.in_arrays:
        return _near_in_arrays(nodes, likeness)
    with scope(nodes.sparkSession) as keep:
        multi = nodes.select(F.explode("keys").alias("key"), "id").groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("__last"), F.count(F.lit(1)).alias("__size"))
        multi = written(multi.where("first < __last").select("key", "first", "__size"))
        own = F.struct("id", *likeness.sketch)
        x, y = F.col("x"), F.col("y")
        likely = [F.col("x.id").alias("a"), F.col("y.id").alias("b"), likeness.likely(x, y).alias("likely")]
        # a bucket of few members is a row, so that its pairs need no join
        few = multi.where(F.col("__size") <= FEW).select("key")
        rows = _in_buckets(nodes, key_filter(few, "key"), likeness.sketch).join(few, "key").groupBy("key").agg(F.collect_set(own).alias("own"))
        pairs = rows.select("own", F.explode("own").alias("x")).select("x", F.explode("own").alias("y")).where((F.col("x.id") > F.col("y.id")) & likeness.near(x, y)).select(*likely)
        many = multi.where(F.col("__size") > FEW).select("key", "first")
        met = None
        if not many.isEmpty():
            met = keep(_in_buckets(nodes, key_filter(many, "key"), likeness.sketch).join(many, "key"))
            side = lambda rows, name: rows.select("key", own.alias(name))
            pairs = pairs.unionByName(side(met.where("id <> first"), "x").join(side(met.where("id = first"), "y"), "key").where(likeness.near(x, y)).select(*likely))
        return keep(pairs.groupBy("a", "b").agg(F.max("likely").alias("likely"))), met


def _dealt(nodes: DataFrame, sketch: tuple[str, ...], parts: int) -> DataFrame:
    """(part, members): for every key of a node a key, id and sketch, as longs one after the other, by part of the keys."""
    width = 2 + len(sketch)

    def out(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        part = rows[:, 0].view(np.uint64) % np.uint64(parts)
        order = np.argsort(part)
        rows, part = rows[order], part[order]
        opens = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        at = (np.append(opens, len(part)) * (8 * width)).astype(np.int32)
        members = pa.Array.from_buffers(pa.binary(), len(opens), [None, pa.py_buffer(at), pa.py_buffer(rows)])
        batch = pa.RecordBatch.from_arrays([pa.array(part[opens].astype(np.int32)), members], names=["part", "members"])
        step = max(1, len(opens) * PART_KEYS // (8 * len(rows)))
        for lo in range(0, len(opens), step):
            yield batch.slice(lo, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            # copies of a node, of which a batch may be full, have the same keys
            _, once = np.unique(b.column(1).to_numpy(zero_copy_only=False), return_index=True)
            b = b.take(pa.array(once))
            keys = b.column(0)
            flat = keys.flatten().to_numpy(zero_copy_only=False)
            rows = np.empty((len(flat), width), np.int64)
            rows[:, 0] = flat
            of = np.repeat(np.arange(b.num_rows), pc.list_value_length(keys).to_numpy(zero_copy_only=False))
            rows[:, 1:] = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns[1:]], 1)[of]
            held.append(rows)
            size += len(rows)
            if size >= PART_KEYS:
                yield from out(held)
                held, size = [], 0
        if size:
            yield from out(held)

    return nodes.select("keys", "id", *sketch).mapInArrow(run, "part int, members binary")


def _compared(rows: np.ndarray, likeness: Likeness) -> tuple[np.ndarray, np.ndarray]:
    """Of rows of key, id and sketch, whole buckets: (a, b, likely, least) of the pairs that the sketches leave, `least` the keys they must have in common, and (key, id, first, sketch) of buckets that are too large or hold too many such pairs; of these, pairs with the first member alone, whatever other keys they have."""
    few = max(FEW, 1)

    def shared(rows: np.ndarray) -> np.ndarray:
        same = rows[1:, 0] == rows[:-1, 0]
        return rows[np.append(same, False) | np.append(False, same)]

    if len(rows):
        rows = shared(rows[np.argsort(rows[:, 0])])
    if len(rows):
        rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
        rows = shared(rows[np.append(True, (rows[1:, :2] != rows[:-1, :2]).any(1))])
    if not len(rows):
        return np.zeros((0, 4), np.int64), np.zeros((0, rows.shape[1] + 1), np.int64)
    opens = np.flatnonzero(np.append(True, rows[1:, 0] != rows[:-1, 0]))
    size = np.diff(np.append(opens, len(rows)))
    bucket = np.repeat(np.arange(len(size)), size)
    after = np.repeat(opens + size, size) - np.arange(len(rows)) - 1
    sketch = np.ascontiguousarray(rows[:, 2:])
    pairs, most = np.zeros(len(size), np.int64), np.where(size > WIDER * few, -1, size * few // 2)
    found, step = [], 1
    live = np.flatnonzero((after > 0) & (most[bucket] >= 0))
    while len(live):
        near, likely, least = likeness.near_rows(sketch[live], sketch[live + step])
        hit = live[near]
        found.append((hit, hit + step, likely[near], least[near]))
        np.add.at(pairs, bucket[hit], 1)
        step += 1
        live = live[(after[live] >= step) & (pairs[bucket[live]] <= most[bucket[live]])]
    left = pairs > most
    found = [tuple(c[~left[bucket[f[0]]]] for c in f) for f in found]
    many = np.flatnonzero(left[bucket])
    pivot = opens[bucket[many]]
    near, likely, _ = likeness.near_rows(sketch[many], sketch[pivot])
    near &= many != pivot
    found.append((pivot[near], many[near], likely[near], np.zeros(near.sum(), np.int64)))
    x, y, likely, least = (np.concatenate([f[k] for f in found]) for k in range(4))
    # the ids of a bucket are in order, so that the second is the larger
    return np.stack((rows[y, 1], rows[x, 1], likely, least), 1), np.concatenate((rows[many, :2], rows[pivot, 1:2], rows[many, 2:]), 1)


def _near_in_arrays(nodes: DataFrame, likeness: Likeness) -> tuple[DataFrame, DataFrame | None]:
    """As `_near_in_buckets`, also with the least number of keys that a pair must have in common and how many it has, with the members of buckets dealt out as bytes and compared in arrays; larger buckets are left only if they have over FEW * WIDER members, or more pairs than FEW / 2 a member."""
    spark, sketch = nodes.sparkSession, likeness.sketch
    # a task gets PART_KEYS keys on average, or fewer: all of them are in one Arrow batch at worst
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-likeness.keys_at_once // PART_KEYS))
    width = 2 + len(sketch)

    def given(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, many = _compared(np.concatenate(rows), likeness)
        for part, names in ((pairs, ["a", "b", "likely", "least"]), (many, ["key", "id", "first", *sketch])):
            for lo in range(0, len(part), 1 << 16):
                own = dict(zip(names, np.ascontiguousarray(part[lo : lo + (1 << 16)].T), strict=True))
                n = min(1 << 16, len(part) - lo)
                yield pa.RecordBatch.from_arrays([pa.array(own[c]) if c in own else pa.nulls(n, pa.int64()) for c in columns], names=columns)

    columns = ["a", "b", "likely", "least", "key", "id", "first", *sketch]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for b in batches:
            part = b.column(0).to_numpy()
            _, at, data = b.column(1).buffers()
            at = np.frombuffer(at, np.int32, b.num_rows + 1, 4 * b.column(1).offset)
            rows = np.frombuffer(data, np.uint8)[at[0] : at[-1]].copy().view(np.int64).reshape(-1, width)
            at = (at - at[0]) // (8 * width)
            # whole parts are compared; a part may go on in the next batch
            opens = np.flatnonzero(np.append(part[0] != last, part[1:] != part[:-1]))
            lo = 0
            for k in opens.tolist():
                if size + at[k] - lo >= PART_KEYS:
                    yield from given([*held, rows[lo : at[k]]])
                    held, size, lo = [], 0, at[k]
            held.append(rows[lo:])
            size += len(rows) - lo
            last = part[-1]
        if held:
            yield from given(held)

    with scope(spark) as keep:
        dealt = _dealt(nodes, sketch, tasks * PARTS_A_TASK).repartition(tasks, "part").sortWithinPartitions("part")
        found = written(dealt.mapInArrow(run, ", ".join(f"{c} bigint" for c in columns)))
        pairs = keep(found.where("a is not null").groupBy("a", "b").agg(F.max("likely").alias("likely"), F.min("least").alias("least"), F.count(F.lit(1)).alias("common")))
        met = found.where("key is not null").select("key", "id", *sketch, "first")
        return pairs, None if met.isEmpty() else keep(met)


def _turn(nodes: DataFrame, turn: int, turns: int) -> DataFrame:
    """The nodes with those of their keys that are of a turn. Each key is of one turn, so that each bucket is whole in it."""
    if turns == 1:
        return nodes
    own = nodes.withColumn("keys", F.filter("keys", lambda k: F.pmod(F.shiftright(k, 7), F.lit(turns)) == turn))
    return own.where("size(keys) > 0")


def _turn_in_arrays(nodes: DataFrame, turn: int, turns: int) -> DataFrame:
    """The same, with keys filtered in arrays."""
    if turns == 1:
        return nodes
    rest = [c for c in nodes.columns if c != "keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0)
            flat = keys.flatten().to_numpy(zero_copy_only=False)
            hit = (flat >> 7) % turns == turn
            row = np.repeat(np.arange(b.num_rows), pc.list_value_length(keys).to_numpy(zero_copy_only=False))[hit]
            size = np.bincount(row, minlength=b.num_rows)
            own = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(size))), pa.int32()), pa.array(flat[hit]))
            yield pa.RecordBatch.from_arrays([own, *b.columns[1:]], names=b.schema.names).filter(pa.array(size > 0))

    kinds = {f.name: f.dataType.simpleString() for f in nodes.schema.fields}
    return nodes.select("keys", *rest).mapInArrow(run, "keys array<bigint>, " + ", ".join(f"{c} {kinds[c]}" for c in rest))


def grouped(nodes: DataFrame, likeness: Likeness, texts_of) -> DataFrame:
    """(id, component) of the nodes linked with any other.

    nodes: id, keys (longs), and the sketch's columns; an id may come several times, with the same keys and sketch. texts_of gives
    the texts (id, text) of a table of ids.
    """
    with scope(nodes.sparkSession) as keep:
        keys = nodes.agg(F.sum(F.size("keys"))).first()[0] or 0
        turns = min(TURNS, 1 + keys * (1 if likeness.in_arrays else ROWS_WEIGH) // KEYS_AT_ONCE)
        likeness.keys_at_once = keys // turns
        found = [_near_in_buckets((_turn_in_arrays if likeness.in_arrays else _turn)(nodes, k, turns), likeness) for k in range(turns)]
        # a pair may come in several turns
        pairs = reduce(DataFrame.unionByName, [p for p, _ in found])
        if likeness.in_arrays:
            # what two lines have in common is known when all turns are over; pairs of large buckets are not counted there, and go to _finished
            pairs = written(pairs.groupBy("a", "b").agg(F.max("likely").alias("likely"), F.min("least").alias("least"), F.sum("common").alias("common")).where("common >= least").select("a", "b", "likely"))
        met = [m for _, m in found if m is not None]
        texts = written(texts_of(_ends(pairs)))
        links = written(_verified(pairs.groupBy("a").agg(F.max_by("b", F.struct("likely", "b")).alias("b")), texts, likeness))
        groups = components(links)
        more = written(_verified(written(_between(pairs, groups).distinct()), texts, likeness))
        if not more.isEmpty():
            links = links.union(more)
            groups = components(links)
        last = _finished(reduce(DataFrame.unionByName, met), groups, texts_of, likeness) if met else None
        if last is not None and not last.isEmpty():
            groups = components(links.union(last))
        return keep(groups)


def _ends(pairs: DataFrame) -> DataFrame:
    return written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())


def _finished(met: DataFrame, groups: DataFrame, texts_of, likeness: Likeness) -> DataFrame | None:
    """Links between groups that share a bucket."""
    own = F.struct("id", *likeness.sketch).alias("own")
    # a member meets its group once, not in each of its buckets
    members = met.groupBy("id").agg(F.collect_set("key").alias("keys"), *[F.first(c).alias(c) for c in likeness.sketch])
    rows = members.join(groups, "id", "left").select(F.explode("keys").alias("key"), "id", own, F.coalesce("component", "id").alias("component"))
    by = rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    main = by.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count(F.lit(1)).alias("groups"))
    main = written(main.where("groups > 1").select("key", "main"))
    if main.isEmpty():
        return None
    # what has a bucket in common with a group that is the largest of this bucket
    shared = written(rows.join(main, "key").select("main", "component", "own").distinct())
    sizes = written(shared.groupBy("main").agg(F.count(F.lit(1)).alias("__size")))
    few = shared.join(sizes.where(F.col("__size") <= FEW).select("main"), "main")
    many = written(shared.join(sizes.where(F.col("__size") > FEW).select("main"), "main").select("main", "component", "own.*"))
    x = few.where("component <> main").select("main", F.col("own").alias("x"), F.col("component").alias("cx"))
    y = few.select("main", F.col("own").alias("y"), F.col("component").alias("cy"))
    pairs = x.join(y, "main").where((F.col("cx") != F.col("cy")) & ((F.col("cy") == F.col("main")) | (F.col("x.id") < F.col("y.id"))) & likeness.near(F.col("x"), F.col("y")))
    pairs = written(pairs.select(F.greatest("x.id", "y.id").alias("a"), F.least("x.id", "y.id").alias("b")).distinct())
    partnered = None if many.isEmpty() else written(_chunked(many.withColumn("text", F.lit("")), likeness, links=False).distinct())
    ids = _ends(pairs) if partnered is None else written(_ends(pairs).union(partnered).distinct())
    texts = written(texts_of(ids))
    found = _verified(pairs, texts, likeness)
    if partnered is not None:
        found = found.union(_chunked(many.join(texts, "id"), likeness, links=True))
    return written(found)


def _chunked(full: DataFrame, likeness: Likeness, links: bool) -> DataFrame:
    """Of rows (main, id, component, sketch, text): the links (a, b) that join groups of a main, or the ids that have a partner by the sketch.

    Members go to chunks by a hash, CHUNK_ROWS or CHUNK_BYTES each on average, those of the main group to chunks of their own with the last numbers.
    A row is a pair of chunks, the left one not of the main group and the right one of the same number or a higher one, so that no two chunks meet twice.
    """
    kind = full.schema["id"].dataType.simpleString()
    rest = F.col("component") != F.col("main")

    def parts(of: Column) -> Column:
        return F.greatest(F.ceil(F.count_if(of) / CHUNK_ROWS) + F.floor(F.coalesce(F.sum(F.when(of, F.length("text"))), F.lit(0)) / CHUNK_BYTES), F.lit(1)).cast("bigint")

    sizes = written(full.groupBy("main").agg(parts(rest).alias("others"), parts(~rest).alias("own")))
    parted = full.join(sizes, "main").withColumn("part", F.when(rest, F.pmod(F.xxhash64("id"), "others")).otherwise(F.col("others") + F.pmod(F.xxhash64("id"), "own")))
    y = written(parted.groupBy("main", "part", "others", "own").agg(F.collect_list(F.struct("id", "component", *likeness.sketch, "text")).alias("y")))
    # each left chunk is told its partners' numbers, and they meet by main and number
    x = y.where("part < others").select("main", F.col("y").alias("x"), F.explode(F.sequence("part", F.col("others") + F.col("own") - 1)).alias("other"))
    y = y.select("main", F.col("part").alias("other"), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = _Forms(likeness)
        for b in batches:
            of = b.column(0).type.value_type.field(0).type
            for k in range(b.num_rows):
                (xi, xc, *xs, xt), (yi, yc, *ys, yt) = (b.column(c)[k].values.flatten() for c in (0, 1))
                sx, sy = (np.stack([s.to_numpy() for s in sketch], 1) for sketch in (xs, ys))
                near = likeness.near_arrays(sx, sy)
                xi, xc, yi, yc = (c.to_pylist() for c in (xi, xc, yi, yc))
                number = {c: i for i, c in enumerate({*xc, *yc})}
                near &= np.array([number[c] for c in xc])[:, None] != np.array([number[c] for c in yc])[None, :]
                if not links:
                    ids = {xi[i] for i in np.flatnonzero(near.any(1))} | {yi[j] for j in np.flatnonzero(near.any(0))}
                    if ids:
                        yield pa.RecordBatch.from_arrays([pa.array(list(ids), of)], names=["id"])
                    continue
                xt, yt = xt.to_pylist(), yt.to_pylist()
                joined: dict = {}

                def root(c, joined=joined):
                    while c in joined:
                        c = joined[c]
                    return c

                found = []
                rows, cols = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
                fx, fy = {int(i): forms(xt[i]) for i in rows}, {int(j): forms(yt[j]) for j in cols}
                if len(rows):
                    near[np.ix_(rows, cols)] = likeness.may_be_alike(list(fx.values()), list(fy.values()), near[np.ix_(rows, cols)])
                for i, j in np.argwhere(near).tolist():
                    a, c = root(xc[i]), root(yc[j])
                    # one link between two groups is enough
                    if a != c and likeness.alike(fx[i], fy[j]):
                        joined[a] = c
                        found.append((xi[i], yi[j]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], of) for c in (0, 1)], names=["a", "b"])

    return x.join(y, ["main", "other"]).select("x", "y").mapInArrow(run, f"a {kind}, b {kind}" if links else f"id {kind}")
