"""URL filtering: given rules first, then association rules mined from labelled URLs.

Every URL becomes a set of tokens. Spark's FP-growth mines the frequent sets of tokens and label over the
labelled URLs; a set that is seen with the label ``block`` often enough (support) and nearly always (confidence)
is a rule, unless a smaller set is as sure. The rules are matched by an inverted index: each stands under
its rarest token, so a URL looks only at the rules of its own tokens.

A URL has at most 16 tokens, so the mining has at most 2**16 / support sets, whatever the input; the rules
that are left of them, and their index, are sent to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm.shared import LOWER, UPPER, stored

ALLOW, BLOCK = "allow", "block"
#: Least share of the labelled URLs in a frequent set, and of the blocked ones among a rule's URLs.
SUPPORT, CONFIDENCE = 0.01, 0.8
#: Least number of blocked URLs behind a rule, which a few chance meetings do not reach.
LEAST = 10
#: Host parts from the end, path segments from the start, and query names that become tokens.
HOST_PARTS, SEGMENTS, NAMES = 4, 3, 3
PARTITIONS = 32


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the beginning of a path: ``example.org/es/``. It holds for subdomains too."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case (A-Z only) and path; both empty without ``://``, as for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, of equally long ones the first by text; else null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text), reverse=True):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host suffixes, first host part, path segments, file ending, names of the query.

    Numbers count as ``#``. The first NAMES names by order stand for the query, the last HOST_PARTS parts for a long host.
    """
    shape = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    parts = F.split(host, "\\.")
    suffixes = [
        F.when(F.size(parts) >= n, F.concat(F.lit("host:"), F.substring_index(host, ".", -n))) for n in range(1, HOST_PARTS + 1)
    ]
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    steps = [
        F.when(F.size(segments) >= n, F.concat(F.lit(f"path{n}:"), shape(F.get(segments, F.lit(n - 1))))) for n in range(1, SEGMENTS + 1)
    ]
    ending = F.regexp_extract(path, "\\.([A-Za-z0-9]{1,8})$", 1)
    query = F.regexp_extract(url, "^[^?#]*\\?([^#]*)", 1)
    names = F.transform(F.filter(F.split(query, "&"), lambda q: q != ""), lambda q: F.substring_index(q, "=", 1))
    named = F.slice(F.array_sort(F.array_distinct(names)), 1, NAMES)
    single = F.array(
        F.concat(F.lit("scheme:"), F.translate(F.substring_index(url, "://", 1), UPPER, LOWER)),
        *suffixes,
        F.when(host != "", F.concat(F.lit("first:"), F.get(parts, F.lit(0)))),
        *steps,
        F.when(ending != "", F.concat(F.lit("ending:"), ending)),
        F.when(F.contains(url, F.lit("#")), F.lit("fragment")),
    )
    tokens = F.concat(single, F.transform(named, lambda n: F.concat(F.lit("query:"), shape(n))))
    return F.array_distinct(F.array_compact(F.when(host != "", tokens).otherwise(F.array().cast("array<string>"))))


def mined_rules(
    labelled: DataFrame,
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    least: int = LEAST,
    partitions: int = PARTITIONS,
) -> DataFrame:
    """(tokens, n, confidence): sets of tokens whose URLs are nearly all blocked, ``n`` of them.

    ``n`` is at least ``least``, and ``support`` of all labelled URLs.

    ``labelled`` has ``tokens`` and ``blocked``. A set is left out where a part of it is as sure, and the set
    without tokens is no rule.
    """
    label = F.lit("label:" + BLOCK)
    items = F.when(F.col("blocked"), F.array_append("tokens", label)).otherwise(F.col("tokens"))
    baskets = stored(labelled.select(items.alias("items")), "url-baskets")
    if baskets.isEmpty():
        return baskets.selectExpr("items AS tokens", "0L AS n", "0D AS confidence")
    sets = FPGrowth(itemsCol="items", minSupport=support, numPartitions=partitions).fit(baskets).freqItemsets
    sets = stored(sets.select(F.array_sort("items").alias("items"), "freq"), "url-sets")
    blocked = sets.where(F.array_contains("items", label)).select(
        F.array_remove("items", label).alias("items"), F.col("freq").alias("n")
    )
    sure = (
        blocked.where(F.size("items") > 0)
        .join(sets, "items")
        .select(F.col("items").alias("tokens"), "n", (F.col("n") / F.col("freq")).alias("confidence"))
        .where((F.col("confidence") >= confidence) & (F.col("n") >= least))
    )
    sure = stored(sure, "url-rules")
    # Parts of a set with one token less are enough: a part that is as sure is kept or has such a part itself.
    part = F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("tokens")
    smaller = sure.select(F.col("tokens").alias("whole"), F.col("confidence").alias("c"), part).where(F.size("tokens") > 0)
    parts = smaller.join(sure, "tokens").where(F.col("confidence") >= F.col("c"))
    return sure.join(parts.select(F.col("whole").alias("tokens")), "tokens", "left_anti")


def _index(rules: list[tuple[list[str], float]]) -> dict[str, list[tuple[frozenset, float]]]:
    """Rules under their rarest token, surest first."""
    seen: dict[str, int] = {}
    for tokens, _ in rules:
        for t in tokens:
            seen[t] = seen.get(t, 0) + 1
    out: dict[str, list] = {}
    for tokens, sure in sorted(rules, key=lambda r: (-r[1], r[0])):
        out.setdefault(min(tokens, key=lambda t: (seen[t], t)), []).append((frozenset(tokens), sure))
    return out


def _matcher(index: dict):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for tokens in batch.column("tokens").to_pylist():
                have = set(tokens)
                found = [sure for t in tokens for need, sure in index.get(t, ()) if need <= have]
                best.append(max(found, default=None))
            names = [n for n in batch.schema.names if n != "tokens"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(best, pa.float64())], [*names, "confidence"]
            )

    return work


def judged_pages(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rest (all columns as a struct), host, path, tokens, and rule and verdict of the given rules (null: none fits)."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    rest = F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("rest")
    host, path = host_and_path(F.col("url"))
    rows = pages.select(rest, url.alias("url")).select("*", host.alias("host"), path.alias("path"))
    found = rows.select(
        "rest",
        "host",
        "path",
        url_tokens(F.col("url"), F.col("host"), F.col("path")).alias("tokens"),
        best_rule(F.col("host"), F.col("path"), rules).alias("given"),
    )
    return found.select("rest", "host", "path", "tokens", "given.rule", "given.verdict")


def filter_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[Rule],
    support: float = SUPPORT,
    confidence: float = CONFIDENCE,
    least: int = LEAST,
) -> DataFrame:
    """rest, host, path, rule, verdict, confidence of every page.

    The longest given rule decides. Where none fits, a URL is blocked if a mined rule fits it (``confidence``
    is the surest one's, else null) and allowed otherwise. The mined rules learn from the pages that
    a given rule judges, with its verdict, and from ``labels`` (page_id, blocked); of several labels of a page,
    and of repeated pages, each counts. A null URL, or one without ``://``, has no host, path or tokens and is
    allowed. Empty tables: no rules, or no rows.
    """
    judged = judged_pages(pages, rules)
    by_rule = judged.where("verdict IS NOT NULL").select("tokens", (F.col("verdict") == BLOCK).alias("blocked"))
    marks = labels.select(F.col("page_id").cast("long").alias("_id"), F.col("blocked").cast("boolean").alias("blocked"))
    open_pages = judged.where("verdict IS NULL AND size(tokens) > 0")
    by_label = open_pages.withColumn("_id", F.col("rest.page_id").cast("long")).join(marks.where("blocked IS NOT NULL"), "_id")
    labelled = by_rule.unionByName(by_label.select("tokens", "blocked"))
    mined = mined_rules(labelled, support, confidence, least).select("tokens", "confidence").collect()
    index = _index([(list(r.tokens), r.confidence) for r in mined])
    schema = reduce(lambda s, c: s.add(judged.schema[c]), ("host", "path", "rule", "verdict"), judged.select("rest").schema)
    matched = judged.select("rest", "host", "path", "rule", "verdict", "tokens").mapInArrow(
        _matcher(index), schema.add("confidence", "double")
    )
    verdict = F.coalesce("verdict", F.when(F.col("confidence").isNotNull(), BLOCK).otherwise(ALLOW))
    return matched.select(
        "rest", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("verdict").isNull(), F.col("confidence")).alias("confidence")
    )
