import itertools

from pyspark.sql import functions as F

from quarrystone.operators import diff, snapshot


def test_as_of(spark):
    rows = [("p", "2020-01-31", 0, True, "a"), ("p", "2020-02-01", 1, True, "b"), ("p", "2020-02-01", 2, True, "c"), ("p", "2020-02-20", 3, False, "hidden"), ("q", "2020-03-05", 0, True, "d"), ("q", None, 1, True, "no time")]
    h = spark.createDataFrame(rows, "page string, ts string, pos int, visible boolean, text string").withColumn("ts", F.to_date("ts"))
    cuts = spark.createDataFrame([("2020-01-01",), ("2020-02-01",), ("2020-03-01",), ("2020-04-01",)], "cutoff string").select(F.to_date("cutoff").alias("cutoff"))
    got = {(str(r.cutoff), r.page): r.text for r in snapshot.as_of(h, cuts, "page", "ts", "pos", "visible").collect()}
    assert got == {("2020-02-01", "p"): "c", ("2020-03-01", "p"): "c", ("2020-04-01", "p"): "c", ("2020-04-01", "q"): "d"}


def test_classes(spark):
    schema = "item string, categories array<string>, orphaned boolean, bytes bigint, last_changed string"
    old = [("gone", ["a"], False, 1, "1"), ("up", [], True, 2, "1"), ("down", ["a"], False, 3, "1"), ("move", ["a"], False, 4, "1"), ("same", ["a"], False, 5, "1"), ("both", ["a"], False, 6, "1"), ("oo", ["x"], True, 7, "1"), ("blank", ["a"], False, 8, "")]
    new = [("new", ["a"], False, 9, "2"), ("up", ["a"], False, 2, "2"), ("down", [], True, 3, "2"), ("move", ["b"], False, 4, "1"), ("same", ["a"], False, 5, "1"), ("both", ["b"], False, 6, "2"), ("oo", ["y"], True, 7, "2"), ("blank", ["a"], False, 8, "2")]
    got = {r["item"]: (r.kind, r.changed) for r in diff.classified(spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)).collect()}
    assert got == {
        "gone": ("removed", False), "new": ("added", False), "up": ("categorized", False), "down": ("orphaned", False), "move": ("recategorized", False), "same": ("unchanged", False), "both": ("recategorized", True), "oo": ("unchanged", False), "blank": ("unchanged", False),
    }


def fold(events):
    """Net effect of (kind, month) events in plain Python; what each field becomes is told by the event's month."""
    s = None
    for kind, m in events:
        was = s["status"] if s else None
        e = {"old_bytes": 10 * m, "new_bytes": 10 * m + 1, "date": f"d{m}", "from": f"f{m}", "to": f"t{m}", "old": f"o{m}", "new": f"n{m}"}
        if kind == "added":
            s = {"status": "added", "bytes": e["new_bytes"], "date": e["date"]}
        elif kind == "removed":
            s = None if was == "added" else {"status": "removed", "bytes": e["old_bytes"]}
        elif kind == "categorized":
            if was == "added":
                s = {"status": "added", "bytes": e["new_bytes"], "date": e["date"]}
            elif was == "orphaned":
                s = None
            else:
                s = {"status": "categorized", "bytes": e["new_bytes"], "date": e["date"], "to": e["to"], "from": s["from"] if was == "categorized" else e["from"]}
        elif kind == "orphaned":
            if was == "added":
                s = {"status": "added", "bytes": e["old_bytes"], "date": s["date"]}
            elif was == "categorized":
                s = None
            else:
                s = {"status": "orphaned", "bytes": e["old_bytes"], "from": e["from"]}
        elif kind == "recategorized":
            if was not in ("added", "categorized", "orphaned"):
                s = {"status": "recategorized", "bytes": e["new_bytes"], "to": e["to"], "from": s["from"] if was == "recategorized" else e["from"]}
        elif was == "added":
            s = {"status": "added", "bytes": e["new_bytes"], "date": e["new"]}
        elif was and was != "changed":
            s = {**s, "bytes": e["new_bytes"]}
        else:
            s = {"status": "changed", "old": s["old"] if s else e["old"], "new": e["new"], "old_bytes": s["old_bytes"] if s else e["old_bytes"], "new_bytes": e["new_bytes"]}
    return s


def test_netting(spark):
    fields = ("bytes", "date", "from", "to", "old", "new", "old_bytes", "new_bytes")
    rows, want = [], {}
    for n in (1, 2, 3):
        for kinds in itertools.product(diff.EVENTS, repeat=n):
            item = "-".join(kinds)
            rows += [(f"2020-0{m}", item, k, 10 * m, 10 * m + 1, f"d{m}", f"f{m}", f"t{m}", f"o{m}", f"n{m}") for m, k in enumerate(kinds, 1)]
            if s := fold([(k, m) for m, k in enumerate(kinds, 1)]):
                want[item] = (s["status"], *[s.get(f) for f in fields])
    events = spark.createDataFrame(rows, "month string, item string, kind string, old_bytes bigint, new_bytes bigint, date string, `from` string, `to` string, old string, new string").repartition(4)
    got = {r["item"]: (r["status"], *[r[f] for f in fields]) for r in diff.netted(events).collect()}
    assert got == want


def test_order_within_a_month(spark):
    schema = "month string, item string, kind string, old_bytes bigint, new_bytes bigint, date string, `from` string, `to` string, old string, new string"
    rows = [("2020-01", "x", k, 1, 2, "d", "f", "t", "o", "n") for k in ("removed", "added")]
    assert diff.netted(spark.createDataFrame(rows, schema)).count() == 0  # added comes first


def test_upsert_and_reports(spark):
    log = spark.createDataFrame([(1, "a", "b", 1), (2, "b", "c", 2)], "id int, old_date string, date string, v int")
    new = spark.createDataFrame([("b", "c", 20), ("c", "d", 3), ("d", "e", 4)], "old_date string, date string, v int")
    assert {tuple(r) for r in diff.upserted(log, new).select("id", "date", "v").collect()} == {(1, "b", 1), (2, "c", 20), (3, "d", 3), (4, "e", 4)}
    a, b = (spark.createDataFrame([r], "x int, y int") for r in ((0, 10), (5, None)))
    assert {tuple(r) for r in diff.stats_report(a, b, ["x", "y"]).collect()} == {("x", 0, 5, 5, None), ("y", 10, 0, -10, -100.0)}


def test_histogram(spark):
    rows = [(1, "2020-01-05", 0), (1, "2020-02-05", 0), (2, "2020-02-01", 0), (3, "2020-03-01", 4)]
    df = spark.createDataFrame(rows, "page_id int, ts string, ns int").withColumn("ts", F.to_timestamp("ts"))
    got = {tuple(r) for r in snapshot.month_histogram(df, main=F.col("ns") == 0).collect()}
    assert got == {("2020-01", 1, 1, 1), ("2020-02", 2, 2, 1), ("2020-03", 1, 0, 0)}
