"""Queries over the whole of their tables, against plain Python."""

from collections import defaultdict

from quarrystone.plans import catalog

FOLDER = "/root/testdata/sf0.001"


def test_net_changes_of_all_quarters(spark):
    months = defaultdict(lambda: [set(), 0])
    rows = spark.read.parquet(f"{FOLDER}/orders.parquet").where("o_orderstatus <> 'P'").selectExpr("o_custkey", "date_format(o_orderdate, 'yyyy-MM')", "o_orderstatus", "cast(round(o_totalprice) as bigint)").collect()
    for item, month, status, price in rows:
        m = months[item, month]
        m[0].add(status)
        m[1] = max(m[1], price)
    state = {}
    for (item, month), (kinds, price) in sorted(months.items()):
        at = (4 * (int(month[:4]) - 1995) + (int(month[5:]) - 1) // 3, item)
        if "F" in kinds:
            state[at] = ("added", price)
        if "O" in kinds:
            if state.get(at, ("",))[0] == "added":
                del state[at]
            else:
                state[at] = ("removed", price)
    got = catalog.QUERIES["net_changes_quarterly"](spark, FOLDER).collect()
    assert sorted(map(tuple, got)) == sorted((*k, *v) for k, v in state.items()) and max(r[0] for r in got) > 8


def test_bulk_import_knows_all_hosts(spark, tmp_path):
    rows = [(k, f"http://a.com/{k}", "") for k in range(500)] + [(1000, "http://www.B.com/x", ""), (1002, "http://b.com/y", ""), (1003, "http://c.com/z", ""), (1004, "http://d.org/z", "")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.title: (r.n_urls, r.repo_hits) for r in catalog.QUERIES["bulk_import"](spark, str(tmp_path)).collect()}
    assert got == {str(k): (2 if k % 2 == 0 else 4, 1) for k, u, _ in rows if ".com" in u and (k % 2 == 0 or k % 3 == 0)}
