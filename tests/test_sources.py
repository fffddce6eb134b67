import bz2
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from quarrystone.sources import dump, tables
from quarrystone.streaming import events

XML = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/"><siteinfo><sitename>S</sitename><namespaces><namespace key="0" case="x" /><namespace key="14" case="x">वर्गः</namespace><namespace key="10">T</namespace></namespaces></siteinfo>
<page><title>B/1 </title><ns>0</ns><id>7</id><revision><id>70</id><timestamp>2020-01-01T00:00:00Z</timestamp><contributor><username>U</username></contributor><text bytes="3">old</text></revision><revision><id>71</id><timestamp>2020-02-01T00:00:00Z</timestamp><contributor><ip>1.2.3.4</ip></contributor><comment>c</comment><text>new
 text </text></revision></page>
<page><title>R</title><ns>0</ns><id>8</id><redirect title="B" /><revision><id>80</id><timestamp>2020-01-03T00:00:00Z</timestamp><text deleted="deleted" /></revision></page>
<page><title>वर्गः:X</title><ns>14</ns><id>9</id></page></mediawiki>"""


def test_exports(spark, tmp_path):
    for name, data in (("a.xml", XML.encode()), ("b.xml.bz2", bz2.compress(XML.encode()))):
        (tmp_path / name).write_bytes(data)
        rows = {r.page_id: r for r in dump.read_pages(spark, str(tmp_path / name)).collect()}
        assert rows[7].title == "B/1 " and rows[7].text == "new\n text " and rows[7].rev_id == 71 and rows[7].redirect_target is None
        assert rows[8].redirect_target == "B" and rows[8].text == "" and (rows[9].text, rows[9].timestamp, rows[9].rev_id) == ("", "", 0)
        assert [r.page_id for r in dump.read_pages(spark, str(tmp_path / name), [14]).collect()] == [9]
    revisions = {r.rev_id: r for r in dump.read_revisions(spark, str(tmp_path / "a.xml")).collect()}
    assert (revisions[70].position, revisions[70].editor, revisions[71].editor, revisions[80].editor) == (0, "U", "1.2.3.4", "?") and not revisions[80].visible and revisions[70].visible
    spaces = dump.read_namespaces(spark, str(tmp_path / "a.xml"))
    assert dump.namespace_id(spaces, "वर्गः") == 14 and dump.namespace_id(spaces, "Category", 14) == 14 and dump.namespace_id(spaces, "Index", 106, optional=True) is None
    with pytest.raises(dump.NamespaceMissing):
        dump.namespace_id(spaces, "Index", 106)


def test_snapshot_export(spark, tmp_path):
    pages = dump_rows(spark)
    dump.write_snapshots(pages, str(tmp_path / "out"))
    back = dump.read_pages(spark, str(tmp_path / "out" / "cutoff=2020-01-01"))
    assert {(r.title, r.text, r.redirect_target) for r in back.collect()} == {("A", "x & y", None), ("R", "", "A")}


def dump_rows(spark):
    return spark.createDataFrame([("2020-01-01", 0, "A", 1, None, "x & y", "t", 5), ("2020-01-01", 0, "R", 2, "A", "", "t", 6), ("2020-02-01", 0, "A", 1, None, "z", "t", 7)], "cutoff string, ns int, title string, page_id bigint, redirect_target string, text string, timestamp string, rev_id bigint")


def test_json_and_indexes(spark, tmp_path):
    (tmp_path / "t.json.gz").write_bytes(gzip.compress(json.dumps({"a": 1, "b": "x"}).encode()))
    assert tuple(tables.read_json(spark, str(tmp_path / "t.json.gz"), "a int, b string").first()) == (1, "x")
    (tmp_path / "i.jsonl").write_text('{"ns":"main","pageid":1,"path":"p1","title":"N:A"}\n\nnot json\n{"ns":"page","pageid":2,"path":"p2","title":"B"}\n{"ns":"index","pageid":null,"path":"p3","title":"C"}\n{"ns":"index","pageid":4,"path":"gone","title":"D"}\n')
    index = tables.read_text_index(spark, str(tmp_path / "i.jsonl"))
    assert {r.pageid for r in index.collect()} == {1, 4}
    assert {tuple(r) for r in tables.text_keys(index, spark.createDataFrame([("p1",)], "path string")).collect()} == {("1", "p1"), ("N:A", "p1"), ("A", "p1")}


def test_manifests(spark, tmp_path):
    good = hashlib.sha256(b"x").hexdigest()
    (tmp_path / "SUMS").write_text(f"{good}  a.bin\n{good.upper()}  b.bin\nbad line\n{good}  c.bin\n")
    files = spark.createDataFrame([("a.bin", b"x"), ("b.bin", b"y")], "name string, content binary")
    assert {tuple(r) for r in tables.verified(tables.read_manifest(spark, str(tmp_path / "SUMS")), files).collect()} == {("a.bin", "ok"), ("b.bin", "mismatch"), ("c.bin", "missing")}
    months = spark.createDataFrame([("2020-01-01", True), ("2020-02-01", True), ("2020-03-01", False)], "month string, complete boolean").withColumn("month", F.to_date("month"))
    assert str(tables.latest_complete(months).first()["month"]) == "2020-02-01"
    assert spark.createDataFrame([("tree: 3\ncontent=2020-01\n",)], "t string").select(tables.version_value(F.col("t"), "content")).first()[0] == "2020-01"


def test_content_versions(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("A", 1)], "title string, raw_bytes int")
    path = str(tmp_path / "content")
    tables.write_content(df, path, "2020-01")
    assert tables.read_content(spark, path, "2020-01").count() == 1 and tables.read_content(spark, path, "2020-02").count() == 0
    monkeypatch.setattr(tables, "SCHEMA_VERSION", 2)
    with pytest.raises(tables.VersionMismatch):
        tables.read_content(spark, path, "2020-01")


def test_nested_tree(spark, tmp_path):
    rows = spark.createDataFrame([("A", "R", "A", False, (1,)), ("B", "R", "B", False, (2,)), ("C", "A", "C", False, (3,)), ("C:pointer", "B", "C", True, (3,))], "id string, parent string, node string, is_pointer boolean, stats struct<n: int>")
    tree = tables.nested(rows, "R")
    tables.write_tree(tree, str(tmp_path / "tree.json"))
    assert [c["id"] for c in tree["children"]] == ["A", "B"] and tree["children"][0]["children"][0]["stats"] == {"n": 3} and "children" not in tree["children"][1]["children"][0]
    with pytest.raises(ValueError):
        tables.nested(rows, "R", limit=2)


def test_streams(spark, tmp_path):
    schema = "k string, ts timestamp, v string"
    rows = lambda data: spark.createDataFrame(data, "k string, ts string, v string").withColumn("ts", F.to_timestamp("ts")).coalesce(1)
    rows([("a", "2020-01-01 10:00:00", "1"), ("a", "2020-01-03 10:00:00", "3"), ("b", "2020-02-01 00:00:00", "2")]).write.mode("append").parquet(str(tmp_path / "in"))
    stream = events.latest_states(events.read_stream(spark, str(tmp_path / "in"), schema), "k", "ts", "v")
    events.run_once(stream, "latest", str(tmp_path / "c1"), "update")
    assert {(r.key, r.value) for r in spark.table("latest").collect()} == {("a", "3"), ("b", "2")}
    counts = events.monthly_counts(events.read_stream(spark, str(tmp_path / "in"), schema), late="1 day")
    events.run_once(counts, "counts", str(tmp_path / "c2"))
    assert {(r.month, r.n) for r in spark.table("counts").collect()} == {("2020-01", 1)}


def test_first_available_and_a_missing_index(spark, tmp_path):
    asked = []

    def make(name, has):
        def run(month):
            asked.append(name)
            return f"{name} of {month}" if has else None

        return run

    makers = [make("snapshot", False), make("cache", True), make("everything", True)]
    assert tables.first_available(makers, "2024-01") == "cache of 2024-01" and asked == ["snapshot", "cache"]
    with pytest.raises(LookupError):
        tables.first_available(makers[:1], "2024-01")
    assert tables.read_text_index(spark, str(tmp_path / "none.jsonl")) is None
