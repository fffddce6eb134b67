"""Exports are read in parts, with the rows of whole files."""

import bz2
import gzip
import random

import pytest
from pyspark.sql import functions as F

from quarrystone.sources import dump

HEAD = '<?xml version="1.0" encoding="utf-8"?>\n<mediawiki>\n<siteinfo><namespaces><namespace key="0" /><namespace key="1">N</namespace></namespaces></siteinfo>\n'


def page(i, text="x", start="<page>", end="</page>"):
    return f"{start}<title>T{i}</title><ns>{i % 2}</ns><id>{i}</id><revision><id>{i}0</id><timestamp>t</timestamp><text>{text}</text></revision>{end}\n"


def export(*pages, head=HEAD):
    return f"{head}{''.join(pages)}</mediawiki>\n".encode()


def texts(spark, path):
    return sorted((r.page_id, r.text) for r in dump.read_pages(spark, str(path)).collect())


@pytest.fixture
def splits(spark):
    yield lambda n: spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


N = 3000


@pytest.fixture
def large(spark, tmp_path):
    """An export of N pages in one file, and (page_id, ns, title, text) of them."""
    key = F.col("id")
    rows = spark.range(N).coalesce(1).select(
        F.lit("c").alias("cutoff"), (key % 3).cast("int").alias("ns"), F.concat(F.lit("P"), key).alias("title"), (key + 1).alias("page_id"), F.lit(None).cast("string").alias("redirect_target"),
        F.concat(F.lit(" <b> & \n é </page> "), key).alias("text"), F.lit("t").alias("timestamp"), key.alias("rev_id"),
    )
    dump.write_snapshots(rows, f"{tmp_path}/out")
    assert len(list(tmp_path.glob("out/cutoff=c/part-*"))) == 1
    return f"{tmp_path}/out/cutoff=c", {(i + 1, i % 3, f"P{i}", f" <b> & \n é </page> {i}") for i in range(N)}


def dealt(rows):
    """(page_id, ns, title, text), and the most rows of one task."""
    got = rows.select("page_id", "ns", "title", "text", F.spark_partition_id().alias("task")).collect()
    tasks = [r.task for r in got]
    return sorted(tuple(r)[:4] for r in got), max(map(tasks.count, set(tasks)))


def test_no_task_reads_all_pages_of_a_large_file(spark, large, splits):
    path, want = large
    splits(50_000)
    got, most = dealt(dump.read_pages(spark, path, [0, 1]))
    assert got == sorted(w for w in want if w[1] < 2) and most < N / 5


def test_no_task_reads_all_revisions_of_a_large_file(spark, large, splits):
    path, want = large
    splits(50_000)
    got, most = dealt(dump.read_revisions(spark, path))
    assert got == sorted(want) and most < N / 5


def test_cuts_fall_anywhere(spark, tmp_path, splits):
    data = export(*(page(i, "é" * (i % 7)) for i in range(30)))
    (tmp_path / "a.xml").write_bytes(data)
    want = [(i, "é" * (i % 7)) for i in range(30)]
    for n in [len(data) // 2 + k for k in range(12)] + [61, 149]:
        splits(n)
        assert texts(spark, tmp_path / "a.xml") == want
        assert sorted(map(tuple, dump.read_namespaces(spark, str(tmp_path / "a.xml")).collect())) == [(0, ""), (1, "N")]


def test_packed_exports(spark, tmp_path, splits):
    draw = random.Random(1)
    want = [(i, "".join(draw.choices("abcdefghij é\n", k=draw.randrange(2000)))) for i in range(1500)]
    data = export(*(page(*w) for w in want))
    middle = data.index(b"<page>", len(data) // 2)
    # one stream of many blocks, several streams, and a codec without blocks
    for name, packed in (("a.xml.bz2", bz2.compress(data, 1)), ("b.xml.bz2", bz2.compress(data[:middle], 1) + bz2.compress(data[middle:], 1)), ("c.xml.gz", gzip.compress(data))):
        (tmp_path / name).write_bytes(packed)
        for n in (60_000, 77_777, 130_001):
            splits(n)
            assert texts(spark, tmp_path / name) == want
        splits(60_000)
        tasks = {r.task for r in dump.read_pages(spark, str(tmp_path / name)).select("text", F.spark_partition_id().alias("task")).collect()}
        assert (len(tasks) > 3) == name.endswith("bz2")


ODD = {
    "CDATA": (export(page(1, "<![CDATA[a </page> b]]>"), page(2)), [(1, "a </page> b"), (2, "x")]),
    "comment": (export("<!-- <page><id>9</id></page> -->", page(1), page(2)), [(1, "x"), (2, "x")]),
    "instruction": (export("<?x <page> ?>", page(1), page(2, "q<?y </page> ?>r")), [(1, "x"), (2, "r")]),
    "blank": (export(page(1, end="</page >"), page(2, start='<page a="1">')), [(1, "x"), (2, "x")]),
    "self": (export(page(1), "<page/>", page(2)), [(0, ""), (1, "x"), (2, "x")]),
    "latin": (export(page(1, "é"), head='<?xml version="1.0" encoding="ISO-8859-1"?><mediawiki>').decode().encode("latin1"), [(1, "é")]),
    "utf16": (export(page(1, "é"), head='<?xml version="1.0" encoding="UTF-16"?><mediawiki>').decode().encode("utf16"), [(1, "é")]),
    "mark": (export(page(1, "é"), head="﻿<mediawiki>"), [(1, "é")]),
    "other": (export("<pages>7</pages>", page(1), "<page2>x</page2>", page(2)), [(1, "x"), (2, "x")]),
    "none": (export(), []),
    # a page that can't be parsed takes no other page with it
    "broken": (export(page(1, "a<b>c"), page(2)), [(0, ""), (2, "x")]),
}


def test_odd_exports(spark, tmp_path):
    folder = tmp_path / "many é 1"
    folder.mkdir()
    for name, (data, want) in ODD.items():
        (folder / f"{name} %20.xml").write_bytes(data)
        assert texts(spark, folder / f"{name} %20.xml") == want, name
    assert texts(spark, folder) == sorted(w for _, want in ODD.values() for w in want)
