import random
import re

from quarrystone.llm import urls


def brute(url, mined):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [r for r in urls.STATED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, rule


URLS = [
    None, "", "no scheme.com/en/1", "http://com/en/1", "http://Example.COM/en/7/x?q#f", "https://m.example.com/en/71", "http://example.com/en/6", "http://notexample.com/en/7", "http://example.com?x=/en/7",
    "http://a.net/de/9", "http://x.example.net/de/8", "http://example.net/de/", "ftp://z.org/es/", "http://z.org/es", "://net/de/", "a://b://c.com/en/", "http://ÉCOLE.org/es/é\n", "http://x.com:80/en/", "http://" + "a." * 3000 + "com/en/" + "b" * 9000, "http://x.com/#/en/", "http:///en/7", "http://.com/en/",
]


def test_stated_rules(spark):
    df = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)] + [(3, URLS[3], "again"), (None, URLS[4], "x")], "page_id bigint, url string, verdict string")
    got = urls.judge(df, urls.STATED, []).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        host, path, rule = brute(URLS[4] if r.page_id is None else URLS[r.page_id], [])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule.text if rule else None, rule.verdict if rule else "allow")
    assert urls.judge(df.limit(0), urls.STATED, []).count() == 0


def test_mined_rules(spark, monkeypatch):
    rng = random.Random(4)
    rows = []
    for k in range(1200):
        host, sect = rng.choice(["a", "b", "c", "d", "e"]), rng.choice(["x", "y", "z", "w"])
        bad = (host, sect) == ("a", "x") or host == "e" and rng.random() < 0.9
        rows.append((k, f"http://{host}.site.test/{sect}/{k}", bad))
    df = spark.createDataFrame(rows, "page_id bigint, url string, bad boolean")
    labelled = df.select(urls.tokens(df.url).alias("tokens"), "bad")
    mined = urls.mine(labelled, min_support=0.01)
    held = {frozenset(r.tokens) for r in mined}
    assert frozenset(["host=e"]) in held and any({"host=a", "path=x"} <= h for h in held) and not any(h < g for h in held for g in held if {x.tokens: x.confidence for x in mined}[tuple(sorted(h))] >= {x.tokens: x.confidence for x in mined}[tuple(sorted(g))])
    # an inverted index gives what trying every rule gives, in one block or in several
    want = {}
    for r in df.select("page_id", urls.tokens(df.url).alias("tokens")).collect():
        fits = [m for m in mined if set(m.tokens) <= set(r.tokens)]
        want[r.page_id] = max((m.confidence for m in fits), default=None)
    for at_once in (100_000, 2):
        monkeypatch.setattr(urls, "RULES_AT_ONCE", at_once)
        assert {r.page_id: r.confidence for r in urls.judge(df, [], mined).collect()} == want
    verdicts = {r.page_id: r.verdict for r in urls.judge(df, [], mined).collect()}
    assert sum((verdicts[k] == "block") == bad for k, _, bad in rows) > 0.95 * len(rows)
    assert urls.mine(labelled.limit(0)) == []


def test_rules_of_hot_lists_among_many_rows(spark):
    # eight lists of tokens, each of one bad host, are 80 % of 40,000 rows
    df = spark.range(40_000).selectExpr("concat('http://', if(id % 10 < 8, concat('bad', id % 10), concat('good', id % 50)), '.test/x/', id) as url", "id % 10 < 8 as bad")
    mined = urls.mine(df.select(urls.tokens(df.url).alias("tokens"), "bad"))
    found = {t for r in mined for t in r.tokens}
    assert {f"host=bad{k}" for k in range(8)} <= found | {t.replace("site=", "host=").removesuffix(".test") for t in found}
    assert {round(r.support, 6) for r in mined if any("bad" in t for t in r.tokens)} == {0.1}
