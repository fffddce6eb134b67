"""URL filters: stated host and path rules, and association rules mined from labelled URLs.

FP-growth finds token combinations that go with the label; rules of at most LONGEST tokens that are right for a share
min_support of the labelled rows and for MIN_ROWS rows at least, and often enough (min_confidence), are kept, but for those
that a rule with fewer of the same tokens makes needless. An inverted index posts each rule under its rarest
token; a URL meets only the rules posted under its own tokens, and a rule fits if the URL has all of
its tokens. A URL that a mined rule fits is blocked, unless a stated rule says otherwise.

Defined results: null and URLs without `://` have an empty host and path and no tokens, which no
rule fits; repeated rows are judged each; without labels there are no mined rules; other columns are
left out. Rules are mined from all labelled rows; the index goes to
the executors in blocks of at most RULES_AT_ONCE rules, each a pass over the URLs.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import sent, written

RULES_AT_ONCE = 100_000
#: Rows that a mined rule must be right for, so that none rests on single pages, and tokens that it may have.
MIN_ROWS, LONGEST = 20, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"


class Stated(NamedTuple):
    """A rule for a host, its subdomains, and paths that begin with `path` (which has its first slash)."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


class Mined(NamedTuple):
    tokens: tuple[str, ...]
    confidence: float
    support: float


def rest(url: Column) -> Column:
    """What follows the first ://, or null."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Scheme, labels and ends of the host, segments of the path (digits as 0), its extension, names in the query."""
    labels = F.filter(F.split(host(url), "\\."), lambda x: x != "")
    tag = lambda mark, xs: F.transform(xs, lambda x: F.concat(F.lit(mark), x))
    segments = F.filter(F.split(F.regexp_replace(path(url), "[0-9]+", "0"), "/"), lambda x: x != "")
    query = F.regexp_extract_all(rest(url), F.lit("[?&]([^=&#]+)"), F.lit(1))
    found = F.concat(
        F.array(F.concat(F.lit("scheme="), F.translate(F.substring_index(url, "://", 1), UPPER, LOWER))),
        tag("host=", labels),
        F.array(F.concat(F.lit("site="), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3)), "."))),
        tag("path=", segments),
        F.transform(F.filter(F.array(F.regexp_extract(path(url), "\\.([A-Za-z0-9]{1,8})$", 1)), lambda x: x != ""), lambda x: F.concat(F.lit("ext="), x)),
        tag("query=", query),
    )
    return F.when(F.locate("://", url) > 0, F.array_distinct(found)).otherwise(F.expr("cast(array() as array<string>)"))


def mine(labelled: DataFrame, min_support: float = 0.003, min_confidence: float = 0.6, too_common: float = 0.5, min_rows: int = MIN_ROWS, longest: int = LONGEST) -> list[Mined]:
    """Rules from rows of `tokens` and `bad`. Tokens that more than `too_common` of the rows have tell nothing and are left out."""
    rows = written(labelled)
    n = rows.count()
    common = [r[0] for r in rows.select(F.explode("tokens").alias("t")).groupBy("t").count().where(F.col("count") > too_common * n).select("t").collect()]
    items = F.array_except("tokens", F.array(*[F.lit(x) for x in common]).cast("array<string>"))
    baskets = rows.select(F.when(F.col("bad"), F.array_append(items, F.lit(BAD))).otherwise(items).alias("items")).where(F.size("items") > 0)
    if n < min_rows or baskets.isEmpty():
        return []
    model = FPGrowth(itemsCol="items", minSupport=max(min_support, min_rows / baskets.count()), minConfidence=min_confidence).fit(baskets)
    rules = model.associationRules.where((F.col("consequent") == F.array(F.lit(BAD))) & (F.size("antecedent") <= longest)).select(F.array_sort("antecedent"), "confidence", "support").collect()
    return prune([Mined(tuple(a), c, s) for a, c, s in rules])


def prune(rules: list[Mined]) -> list[Mined]:
    """Without rules that a kept rule of fewer tokens, as sure or surer, fits wherever they do."""
    kept: list[Mined] = []
    by_token: dict[str, list[Mined]] = {}
    for r in sorted(rules, key=lambda r: (len(r.tokens), -r.confidence, -r.support, r.tokens)):
        own = set(r.tokens)
        if not any(k.confidence >= r.confidence and own.issuperset(k.tokens) for t in r.tokens for k in by_token.get(t, ())):
            kept.append(r)
            by_token.setdefault(r.tokens[0], []).append(r)
    return kept


class Index:
    """Rules by their rarest token."""

    def __init__(self, rules: list[Mined]):
        often: dict[str, int] = {}
        for r in rules:
            for t in r.tokens:
                often[t] = often.get(t, 0) + 1
        self.posts: dict[str, list[Mined]] = {}
        for r in rules:
            self.posts.setdefault(min(r.tokens, key=lambda t: (often[t], t)), []).append(r)

    def best(self, own: set[str]) -> Mined | None:
        """The surest rule that fits, then the best supported, then the first in order of tokens."""
        fits = [r for t in own for r in self.posts.get(t, ()) if own.issuperset(r.tokens)]
        return min(fits, key=lambda r: (-r.confidence, -r.support, r.tokens), default=None)


def longest(stated: dict[str, list[Stated]], name: str, where: str) -> Stated | None:
    """The longest stated rule for a host or a domain above it; at equal length, the one first stated."""
    fits, at = [], name
    while at:
        fits += [r for r in stated.get(at, ()) if where.startswith(r.path)]
        at = at.partition(".")[2]
    return max(fits, key=lambda r: len(r.text), default=None)


def judge(pages: DataFrame, stated: list[Stated], mined: list[Mined], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per URL: its id, `host`, `path`, `rule` (the stated one that decides), `verdict`, and `mined` and `confidence` of the surest mined rule that fits."""
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType.simpleString()
    url = F.col(url_col).cast("string")
    out = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"), tokens(url).alias("tokens"), F.lit(None).cast("string").alias("mined"), F.lit(None).cast("double").alias("confidence"))
    by_host: dict[str, list[Stated]] = {}
    for r in stated:
        by_host.setdefault(r.host, []).append(r)

    def fit(shared, final: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for b in batches:
                ids, hosts, paths, own, said, sure = b.columns
                said, sure = said.to_pylist(), sure.to_pylist()
                for k, ts in enumerate(own.to_pylist()):
                    if ts and (r := index.best(set(ts))) and (sure[k] is None or r.confidence > sure[k]):
                        said[k], sure[k] = " & ".join(r.tokens), r.confidence
                new = [pa.array(said, pa.string()), pa.array(sure, pa.float64())]
                if not final:
                    yield pa.RecordBatch.from_arrays([ids, hosts, paths, own, *new], names=["id", "host", "path", "tokens", "mined", "confidence"])
                    continue
                rules = [longest(by_host, h, p) for h, p in zip(hosts.to_pylist(), paths.to_pylist(), strict=True)]
                verdicts = [r.verdict if r else "block" if s is not None else "allow" for r, s in zip(rules, said, strict=True)]
                yield pa.RecordBatch.from_arrays([ids, hosts, paths, pa.array([r.text if r else None for r in rules], pa.string()), pa.array(verdicts, pa.string()), *new], names=["id", "host", "path", "rule", "verdict", "mined", "confidence"])

        return run

    blocks = [mined[k : k + RULES_AT_ONCE] for k in range(0, max(len(mined), 1), RULES_AT_ONCE)]
    for k, block in enumerate(blocks):
        final = k == len(blocks) - 1
        schema = f"id {kind}, host string, path string, " + ("rule string, verdict string" if final else "tokens array<string>") + ", mined string, confidence double"
        out = out.mapInArrow(fit(sent(spark, Index(block)), final), schema)
    return out.withColumnRenamed("id", id_col)


STATED = [Stated("block", "com", "/en/"), Stated("allow", "example.com", "/en/7"), Stated("allow", "net", "/de/"), Stated("block", "example.net", "/de/8"), Stated("block", "org", "/es/")]


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Tokens of the pages that have a label under their id; bad: of low quality, or toxic."""
    known = labels.where("quality is not null or toxic is not null").groupBy(F.col("doc_id").alias("__id")).agg(F.max((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).alias("bad"))
    return pages.select(F.col("page_id").alias("__id"), tokens(F.col("url")).alias("tokens")).join(known, "__id").select("tokens", "bad")
