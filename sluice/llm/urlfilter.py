"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

A rule is a host and a path (``example.org/es/``). It fits its host and all subdomains if the URL's path
starts with the rule's path; the longest rule that fits decides. URLs that a rule decides are the labelled
ones: trees learn from them what blocked URLs look like and judge the URLs without a rule. Features: lengths,
depth, digit ratio, entropy, parameter counts, host labels, and for the last one and two labels of the host
the share of blocked URLs among all labelled ones of the table (smoothed; rows count).

The trees are fitted on at most ``sample`` different labelled URLs (of each verdict the ``sample`` / 2 of least
hash; this is the documented bound), their start is set back to the verdicts' shares of all different labelled
URLs, and they are broadcast with the rules. The shares of suffixes that at least one row in ``OFTEN`` has are
broadcast (at most ``OFTEN`` of each length); rows of other suffixes meet theirs in a join without large keys.

Defined results: a null URL and one without ``://`` have an empty host and path, which no rule fits; the
method judges them by their other features. Without labelled URLs of both verdicts the method's verdict is
that of all labelled ones, or allow. Equal URLs have equal verdicts. Other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import boosting
from sluice.llm.tables import staged, table

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
SAMPLE = 10_000
OFTEN = 1000

_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_URL = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path."""
    found = _URL.search(url or "")
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def decide(host: str, path: str, rules) -> tuple[str, str] | tuple[None, None]:
    """The longest rule that fits, and its verdict; of equally long ones, the one that blocks."""
    best = None
    for verdict, rule in rules:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            rank = (len(rule), verdict == "block")
            if best is None or rank > best[0]:
                best = rank, rule, verdict
    return (best[1], best[2]) if best else (None, None)


def suffixes(host: str) -> tuple[str, str]:
    labels = host.split(".")
    return labels[-1], ".".join(labels[-2:])


def features(url: str | None, host: str, path: str, shares: tuple[float, float]) -> list[float]:
    url = url or ""
    _, _, tail = url.partition("?")
    query = tail.partition("#")[0]
    counts = Counter(url)
    entropy = -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values()) if url else 0.0
    digits = sum(n for c, n in counts.items() if "0" <= c <= "9")
    labels = host.split(".") if host else []
    names = labels[0] if labels else ""
    return [len(url), len(host), len(path), path.count("/"), digits / max(1, len(url)),
            sum("0" <= c <= "9" for c in host), sum("0" <= c <= "9" for c in path), entropy,
            query.count("&") + bool(query), len(query), len(labels), max(map(len, labels), default=0),
            host.count("-"), len(names), "#" in url, url.startswith("https"),
            path.rpartition("/")[2].count("."), sum(counts.get(c, 0) for c in "%_~@"),
            *shares]


def fit(rows: list[tuple[str, str, float, float, int]]) -> dict[str, Any]:
    """Model from (url, verdict, shares of its suffixes, different labelled URLs of that verdict) rows."""
    blocked = np.array([r[1] == "block" for r in rows], dtype=np.float64)
    totals = {r[1]: r[4] for r in rows}
    share = (totals.get("block", 0) + 0.5) / (sum(totals.values()) + 1) if rows else 0.0
    if len(totals) < 2:
        return {"forest": None, "share": share}
    forest = boosting.fit(np.array([features(r[0], *split_url(r[0]), (r[2], r[3])) for r in rows]), blocked)
    drawn = (blocked.sum() + 0.5) / (len(rows) + 1)
    back = math.log(share / (1 - share)) - math.log(drawn / (1 - drawn))
    return {"forest": forest._replace(start=forest.start + back), "share": share}


def labelled(pages: DataFrame, rules) -> DataFrame:
    """url, its two suffixes, and the verdict of the rules or null."""
    def label(batches):
        for batch in batches:
            urls = batch.column("url").to_pylist()
            parts = [split_url(u) for u in urls]
            ends = [suffixes(host) for host, _ in parts]
            yield pa.RecordBatch.from_arrays(
                [batch.column("url"), *(pa.array(c, pa.string()) for c in (
                    [x for x, _ in ends], [x for _, x in ends], [decide(*p, rules)[1] for p in parts]))],
                names=["url", "one", "two", "verdict"])

    return pages.select("url").mapInArrow(label, "url string, one string, two string, verdict string")


def suffix_shares(pages: DataFrame, rules) -> DataFrame:
    """For each last two labels of the table's hosts: two, share_one, share_two, and whether they are frequent."""
    counts = [F.count("*").alias("rows"), F.count("verdict").alias("n"), F.count_if(F.col("verdict") == "block").alias("bad")]
    sums = [F.sum(c).alias(c) for c in ("rows", "n", "bad")]
    two = staged(labelled(pages, rules).groupBy("one", "two").agg(*counts), "suffixes")
    total = two.agg(*sums).first()
    share = (total.bad + 0.5) / (total.n + 1) if total.n else 0.0
    smoothed = F.when(F.col("n") == 0, F.lit(share)).otherwise((F.col("bad") + 10 * share) / (F.col("n") + 10))
    often = F.col("rows") * OFTEN >= (total.rows or 0)
    one = staged(two.groupBy("one").agg(*sums).select("one", smoothed.alias("share_one"), often.alias("often")), "suffix")
    two = two.select("one", "two", smoothed.alias("share_two"), often.alias("often"))
    large = F.broadcast(one.where("often").drop("often"))  # at most ``OFTEN``
    both = two.join(large, "one").unionByName(
        two.join(large, "one", "left_anti").join(one.where("not often").drop("often"), "one"))
    same = F.col("one") == F.col("two")  # a host of one label: its suffixes are one and count as the last label
    return staged(both.select("two", "share_one", F.when(same, F.col("share_one")).otherwise(F.col("share_two"))
                              .alias("share_two"), "often"), "shares")


def training_rows(pages: DataFrame, rules, sample: int = SAMPLE,
                  shares: DataFrame | None = None) -> list[tuple[str, str, float, float, int]]:
    shares = suffix_shares(pages, rules) if shares is None else shares
    urls = staged(labelled(pages, rules).where("verdict is not null").select("url", "two", "verdict").distinct(), "labelled")
    chosen = []
    for verdict in ("allow", "block"):
        own = urls.where(F.col("verdict") == verdict)
        of = own.count()
        few = own.orderBy(F.xxhash64("url"), "url").limit(sample // 2)
        found = shares.join(F.broadcast(few), "two").collect()  # at most ``sample`` / 2 rows
        chosen += [(r.url, verdict, r.share_one, r.share_two, of) for r in found]
    return sorted(chosen)


def judge(pages: DataFrame, rules, model: dict[str, Any], shares: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict and risk (the trees' probability to be blocked) of each row."""
    shares = suffix_shares(pages, rules) if shares is None else shares
    often = {r.two: (r.share_one, r.share_two) for r in shares.where("often").collect()}  # at most ``OFTEN``
    shared = pages.sparkSession.sparkContext.broadcast((model, often))

    def ends(batches):
        for batch in batches:
            two = [suffixes(split_url(u)[0])[1] for u in batch.column("url").to_pylist()]
            known = shared.value[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(two, pa.string()),
                 pa.array([t in known for t in two], pa.bool_())], names=["page_id", "url", "two", "often"])

    def run(batches):
        got, known = shared.value
        for batch in batches:
            urls = batch.column("url").to_pylist()
            parts = [split_url(u) for u in urls]
            if got["forest"] is None:
                risk = np.full(len(urls), got["share"])
            else:
                own = zip(batch.column("share_one").to_pylist(), batch.column("share_two").to_pylist(), strict=True)
                x = [features(u, *p, known.get(suffixes(p[0])[1]) or o) for u, p, o in zip(urls, parts, own, strict=True)]
                risk = boosting.predict(got["forest"], np.array(x, dtype=np.float64).reshape(len(x), -1))
            decided = [decide(*p, rules) for p in parts]
            verdicts = [v or ("block" if r >= 0.5 else "allow") for (_, v), r in zip(decided, risk, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, pa.string()) for c in (
                    [h for h, _ in parts], [p for _, p in parts], [r for r, _ in decided], verdicts)),
                 pa.array(risk, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "risk"])

    kind = pages.schema["page_id"].dataType.simpleString()
    result = f"page_id {kind}, host string, path string, rule string, verdict string, risk double"
    rows = pages.select("page_id", "url").mapInArrow(ends, f"page_id {kind}, url string, two string, often boolean")
    none = F.lit(None).cast("double")
    direct = rows.where("often").select("page_id", "url", none.alias("share_one"), none.alias("share_two"))
    joined = rows.where("not often").join(shares.where("not often").drop("often"), "two").select(
        "page_id", "url", "share_one", "share_two")
    return direct.mapInArrow(run, result).unionByName(joined.mapInArrow(run, result))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    shares = suffix_shares(pages, RULES)
    return judge(pages, RULES, fit(training_rows(pages, RULES, shares=shares)), shares)
