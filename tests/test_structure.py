import random

import pytest
from pyspark.sql import functions as F

from quarrystone.operators import audit, checks, graph, paths, rollup, search, transclude


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "parent string, child string")


DAG = [("R", "A"), ("R", "B"), ("A", "C"), ("B", "C")]


def test_distinct_rollup(spark):
    filings = spark.createDataFrame([("A", "p"), ("C", "p"), ("C", "q"), ("B", "r")], "node string, item string")
    items = spark.createDataFrame([("p", 10, "2020"), ("q", 20, ""), ("r", 40, "2021")], "item string, raw_bytes int, last_changed string")
    got = {r.ancestor: (r.raw_bytes, r.last_changed) for r in rollup.distinct_rollup(graph.closure(edges(spark, DAG)), filings, items, ("raw_bytes",)).collect()}
    assert got == {"A": (30, "2020"), "B": (70, "2021"), "C": (30, "2020"), "R": (70, "2021")}


def test_closure_and_cycles(spark):
    rng = random.Random(1)
    pairs = sorted({(f"n{rng.randint(0, 15)}", f"n{rng.randint(0, 15)}") for _ in range(22)})
    nodes = {x for p in pairs for x in p}
    reach = {(a, a) for a in nodes}
    while new := {(a, d) for a, b in reach for c, d in pairs if b == c} - reach:
        reach |= new
    assert {tuple(r) for r in graph.closure(edges(spark, pairs)).collect()} == reach
    assert {r.node for r in graph.on_cycle(edges(spark, pairs)).collect()} == {a for a, b in reach if (b, a) in pairs}
    assert {r.node for r in graph.reachable(edges(spark, DAG), "B").collect()} == {"B", "C"}
    nodes = spark.createDataFrame([(n,) for n in "RABCZ"], "node string")
    assert {r.node for r in graph.orphan_roots(nodes, edges(spark, DAG), "R").collect()} == {"Z"}
    assert [(r.child, r.n_parents) for r in graph.multi_parented(edges(spark, DAG)).collect()] == [("C", 2)]


def test_refile(spark):
    nodes = spark.createDataFrame([(n,) for n in "RABC"], "node string")
    moved = {tuple(r) for r in graph.refile(edges(spark, DAG), nodes, "C", "A", "R").collect()}
    assert moved == {("R", "A"), ("R", "B"), ("B", "C"), ("R", "C")}
    assert {tuple(r) for r in graph.refile(edges(spark, DAG), nodes, "C", "A", "missing").collect()} == set(DAG)
    assert ("A", "B") in {tuple(r) for r in graph.refile(edges(spark, DAG), nodes, "B", "C", "A").collect()}  # the old edge need not be there


def test_follow_and_tops(spark):
    pointers = [("a", "b"), ("b", "c"), ("d", "d"), ("e", "f"), ("f", "e"), ("g", "e"), ("h", None)] + [(f"k{i}", f"k{i + 1}") for i in range(40)]
    got = {r.node: r.last for r in graph.follow(spark.createDataFrame(pointers, "node string, target string")).collect()}
    assert got["a"] == got["b"] == "c" and got["d"] == "d" and got["e"] == "e" and got["f"] == "f" and got["g"] == "g" and got["k0"] == "k40" and "h" not in got
    tops = graph.top_ancestors(spark.createDataFrame([("a", None), ("b", "a"), ("c", "b")], "node string, parent string"))
    assert {tuple(r) for r in tops.collect()} == {("a", "a"), ("b", "a"), ("c", "a")}


def test_display_order(spark):
    pairs = [("R", "A"), ("R", "B"), ("R", "C"), ("B", "C"), ("C", "A"), ("A", "D"), ("C", "D"), ("D", "A")]
    seen, rows = set(), []

    def walk(node, parent, path):
        rows.append((node + ":pointer" if node in seen else node, parent, node, node in seen, path))
        if node in seen:
            return
        seen.add(node)
        for c in sorted(c for p, c in pairs if p == node):
            walk(c, node, [*path, c])

    walk("R", None, ["R"])
    got = [(r.id, r.parent, r.node, r.is_pointer, r.path) for r in graph.display_rows(edges(spark, pairs), "R").collect()]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_page_tree(spark):
    pages = [
        ("A", None), ("A/b", None), ("A/b/c", None), ("A/x/y", None), ("A /b", None), ("A/b /d", None), ("M/n", None), ("Old", "A"), ("Old/q", None), ("L1", "L2"), ("L2", "L1"), ("L1/z", None),
        ("P/s", None), ("P", "P/s"), ("महाभारतम्/सभापर्व", None), ("महाभारतम्-02-सभापर्व-001", None), ("महाभारतम्-03-वनपर्व-001", None), ("ऋग्वेदः मण्डल १", None), ("ऋग्वेदः सूक्तं १.12", None), ("flat", None),
    ]
    df = spark.createDataFrame([(t, r, k) for k, (t, r) in enumerate(pages)], "title string, redirect_target string, position int")
    got = {r.title: r.parent for r in paths.page_tree(df).collect()}
    assert got["A/b"] == "A" and got["A/b/c"] == "A/b" and got["A/x/y"] == "A" and got["A/b /d"] == "A/b" and got["A /b"] == "A"
    assert got["M/n"] is None and got["Old/q"] == "A" and got["L1/z"] == "L1" and got["P/s"] is None and got["flat"] is None and got["A"] is None
    assert got["महाभारतम्-02-सभापर्व-001"] == "महाभारतम्/सभापर्व" and got["महाभारतम्-03-वनपर्व-001"] is None and got["ऋग्वेदः सूक्तं १.12"] == "ऋग्वेदः मण्डल १"
    tree = paths.page_tree(df)
    assert {(r.family, r.n) for r in paths.unresolvable(tree).collect()} == {("M", 1), ("P", 1), ("महाभारतम्", 1)}
    kept = {r.title: r.parent for r in paths.skip_redirects(spark.createDataFrame([("a", None), ("r", "a"), ("c", "r")], "title string, parent string"), spark.createDataFrame([("r",)], "title string")).collect()}
    assert kept == {"a": None, "c": "a"}


def test_suppression_and_pruning(spark):
    tree = spark.createDataFrame([("w", None), ("w/1", "w"), ("w/1/a", "w/1"), ("v", None), ("v/1", "v")], "title string, parent string")
    tags = spark.createDataFrame([("w", "central"), ("w/1", "side"), ("w/1/a", "other"), ("v", "far"), ("v/1", "far"), ("v/1", "near")], "title string, category string")
    tops = graph.top_ancestors(tree.withColumnRenamed("title", "node")).withColumnRenamed("node", "title")
    central = spark.createDataFrame([("central",)], "node string")
    got = {(r.category, r.title): r.kept for r in rollup.judged_filings(tags, tags, tree, tops, central).collect()}
    assert got == {("central", "w"): True, ("side", "w/1"): False, ("other", "w/1/a"): False, ("far", "v"): True, ("far", "v/1"): False, ("near", "v/1"): True}
    filings = spark.createDataFrame([("a", "x", False), ("b", "y", False), ("c", "z", True), ("d", "z", False), ("e", "q", False)], "category string, title string, kept boolean")
    pruned = rollup.pruned(edges(spark, [("a", "b"), ("d", "c"), ("e", "empty")]), filings)
    assert {r.node for r in pruned.collect()} == {"a", "b"}  # c keeps one; e has a child that is merely empty


def test_index_items_and_orphans(spark):
    shells = spark.createDataFrame([("I", 5, 4, 3, "2020"), ("J", 1, 1, 1, "")], "index_title string, raw_bytes int, content_bytes int, transliterated_bytes int, last_changed string")
    leaves = spark.createDataFrame([("I", 10, 10, 10, "2021"), ("I", 1, 1, 1, "")], "index_title string, raw_bytes int, content_bytes int, transliterated_bytes int, last_changed string")
    sums = rollup.untranscluded_leaves(leaves, spark.createDataFrame([("K",)], "index_title string"))
    got = {r.index_title: (r.raw_bytes, r.text_count, r.last_changed) for r in rollup.index_items(shells, sums, spark.createDataFrame([("I",)], "index_title string")).collect()}
    assert got == {"I": (16, 1, "2021"), "J": (1, 0, "")}
    assert {r.text_count for r in rollup.index_items(shells, sums).collect()} == {None}
    tags = spark.createDataFrame([("p", "c"), ("q", "far")], "title string, category string")
    lost = rollup.orphans(spark.createDataFrame([("p",), ("q",), ("s",)], "item string"), tags, spark.createDataFrame([("c",)], "node string"))
    assert {tuple(r) for r in lost.collect()} == {("q", False), ("s", True)}


def test_leaves(spark):
    leaves = spark.createDataFrame([("I", f"I/{k}", k) for k in range(1, 7)] + [("I", "I/x", None)], "index_title string, leaf_title string, n int")
    r = spark.createDataFrame([("p", "I", 2, 3, None), ("p", "I", 3, 4, None), ("q", "I", None, None, None), ("s", "I", 1, 1, [6, 9]), ("t", "I", None, 2, None), ("u", "K", None, None, None)], "title string, index_title string, from_n int, to_n int, include array<int>")
    got = {}
    for row in transclude.resolved_leaves(r, leaves).collect():
        got.setdefault(row.title, set()).add(row.leaf_title)
    assert got == {"p": {"I/2", "I/3", "I/4"}, "q": {f"I/{k}" for k in range(1, 7)}, "s": {"I/6"}, "t": {"I/1", "I/2"}}


def test_audit(spark):
    titles = spark.createDataFrame([(t,) for t in ("a", "a b", "a b c", "ab", "s", "s - 1", "s.2", "z-1")], "title string")
    assert {tuple(r) for r in audit.space_prefixes(titles).collect()} == {("a", "a b"), ("a", "a b c"), ("a b", "a b c"), ("s", "s - 1")}
    assert [tuple(r) for r in audit.separator_families(titles).collect()] == [("s", 2)]
    tree = spark.createDataFrame([("p", None), ("c1", "p"), ("c2", "p"), ("o", None), ("c3", "o")], "title string, parent string")
    tags = spark.createDataFrame([("c1", "x"), ("c2", "x"), ("c1", "y"), ("c2", "z"), ("p", "w"), ("c1", "w"), ("c2", "w")], "title string, tag string")
    assert [tuple(r) for r in audit.shared_by_all(tree, tags).collect()] == [("p", "x")]
    pages = spark.createDataFrame([("a", "http://www.sarit.indology.info/x. http://o.org"), ("b", "http://sarit.indology.info http://o.org http://p.org http://q.org"), ("c", "http://sarit.indology.info http://o.org http://p.org\n=== स्रोतम् ==="), ("d", "== Source ==")], "title string, text string")
    assert {r.title for r in audit.bulk_imports(pages).collect()} == {"a", "c"}
    health = audit.family_health(titles, spark.createDataFrame([("a b", "a")], "title string, parent string"), [("two", "^a b.*$"), ("none", "^q$")])
    assert {tuple(r) for r in health.collect()} == {("two", 2, 1), ("none", 0, 0)}
    groups = {(r.prefix, r.n) for r in audit.token_groups(spark.createDataFrame([("u s a 1",), ("u s a 2",), ("u k",)], "title string")).collect()}
    assert groups == {("u", 3), ("u s a", 2)}


def test_search_and_checks(spark):
    kept = search.filtered_tree(edges(spark, DAG), spark.createDataFrame([("A",)], "node string"))
    assert {r.node for r in kept.collect()} == {"R", "A"}
    t = spark.createDataFrame([("Rāma",)], "t string")
    say = lambda q, exact=False: t.select(search.matches(F.col("t"), q, exact).alias("m")).first()["m"]
    assert (say("ĀMA "), say("rā"), say("rāma", True), say("rā", True)) == (True, False, True, False)
    with pytest.raises(checks.RootMissing):
        checks.require_root(spark.createDataFrame([("a",)], "node string"), "b")
    checks.require_root(spark.createDataFrame([("a",)], "node string"), "a")
    loop = search.breadcrumbs(spark.createDataFrame([("a", "b"), ("b", "a"), ("c", "a"), ("d", None)], "node string, parent string"), spark.createDataFrame([("c",), ("d",)], "node string"))
    assert {(r.node, tuple(r.path)) for r in loop.collect()} == {("c", ("b", "a", "c")), ("d", ("d",))}
