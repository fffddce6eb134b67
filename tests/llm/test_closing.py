from quarrystone.llm import linking


def test_links_of_one_partition_are_closed_by_it(spark, monkeypatch):
    chain = spark.createDataFrame([(k, k + 1) for k in range(300)], "a bigint, b bigint").repartition(7)
    stars = []
    inside = linking._stars
    monkeypatch.setattr(linking, "_stars", lambda edges, large: stars.append(large) or inside(edges, large))
    assert {r.component for r in linking.components(chain).collect()} == {0} and not stars
    monkeypatch.setattr(linking, "EDGES", 100)
    got = linking.components(chain).collect()
    assert len(got) == 301 and {r.component for r in got} == {0} and stars
    names = spark.createDataFrame([("é", "z"), ("z", "日"), ("a", "b")], "a string, b string")
    assert {r.id: r.component for r in linking.components(names).collect()} == {"é": "z", "z": "z", "日": "z", "a": "a", "b": "a"}
