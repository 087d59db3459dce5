"""URL filters: host-suffix and path-prefix expressions, joined to rules by hash prefix."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relaybook.llm.common import columns, without

#: Hex digits of a digest that the join uses; the full digest is compared afterwards.
SHORT = 8
OTHERWISE = "allow"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """From after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lowered."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _expression(host: Column, path: Column) -> Column:
    """One string for a host and a path; a host has no slash, so two pairs never give the same."""
    return F.concat(host, F.lit("/"), path)


def _suffixes(host: Column) -> Column:
    """The host and all domains above it."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda at: F.array_join(F.slice(labels, at, F.size(labels)), ".")
    )


def _short(digest: Column) -> Column:
    return F.substring(digest, 1, SHORT)


def judge_urls(
    pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = OTHERWISE
) -> DataFrame:
    """Pages with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has (host, path, verdict). A rule fits its host and all subdomains if the path begins
    with the rule's; of several the longest (host and path together) wins, of equally long ones the
    one that blocks. Each distinct host and path is expanded once: its host into suffixes, and for a
    suffix that some rules have, its path into prefixes of the lengths that the paths of these rules have.
    Both joins, to the rules' hosts and to the rules, are by the first digits of a digest; the whole digest
    is compared on what meets. The plan is the same for any number of rules. Which side is sent around is
    left to the measured sizes; rules that fit most pages are joined on pages that are distinct.

    A null url, or one without ``://``, has empty host and path; urls of any length are read whole. No
    rule: null, and ``otherwise``. A rule with a null host, path or verdict is left out; rules may repeat.
    Pages that repeat are judged alike and all kept; an empty table gives an empty one, and without rules
    all pages get ``otherwise``. Columns of the input with the names of result columns are replaced.
    """
    if otherwise not in ("allow", "block"):
        raise ValueError("a verdict is allow or block")
    known = rules.select(
        F.translate("host", _UPPER, _UPPER.lower()).alias("rule_host"),
        F.col("path").alias("rule_path"), "verdict",
    ).filter("rule_host <> '' AND rule_path IS NOT NULL AND verdict IS NOT NULL").distinct()
    split = pages.select(
        F.struct(*columns(without(pages, "host", "path", "rule", "verdict"))).alias("row"),
        host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"),
    )
    host_digest = F.sha2("rule_host", 256)
    hosts = known.groupBy("rule_host").agg(
        # Lengths are few beside rules: they are numbers below the longest path.
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths")
    ).select(_short(host_digest).alias("short"), host_digest.alias("digest"), "lengths")
    digest = F.sha2(_expression(F.col("rule_host"), F.col("rule_path")), 256)
    hashed = known.select(
        _short(digest).alias("short"), digest.alias("digest"),
        F.concat("rule_host", "rule_path").alias("rule"), "verdict",
    )
    distinct = split.select("host", "path").distinct()
    suffixes = distinct.select("host", "path", F.explode(_suffixes(F.col("host"))).alias("suffix")).withColumn(
        "asked", F.sha2("suffix", 256)
    ).withColumn("short", _short(F.col("asked")))
    able = suffixes.join(hosts, "short").filter("asked = digest")
    fitting = F.filter("lengths", lambda n: n <= F.length("path"))
    expanded = able.select("host", "path", "suffix", F.explode(fitting).alias("chars"))
    asked = expanded.select("host", "path", F.sha2(
        _expression(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("chars"))), 256
    ).alias("asked")).withColumn("short", _short(F.col("asked")))
    met = asked.join(hashed, "short").filter("asked = digest")
    blocks = F.when(F.col("verdict") == "block", 1).otherwise(0)
    best = met.groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule"), blocks, "rule", "verdict")).alias("best")
    ).select("host", "path", "best.rule", "best.verdict")
    judged = split.join(best, ["host", "path"], "left")
    return judged.select(
        "row.*", "host", "path", "rule", F.coalesce("verdict", F.lit(otherwise)).alias("verdict")
    )


def rule_table(spark, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict"))
            for v, h, p in rules]
    one = spark.range(1)
    if not rows:
        return one.select(*[F.lit("").alias(n) for n in ("host", "path", "verdict")]).filter(F.lit(False))
    return reduce(DataFrame.unionAll, [one.select(r.alias("r")).select("r.*") for r in rows])
