"""URL filters: host suffixes and path prefixes, equi-joined on short hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free

#: (action, host, path) of the production rules.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Hexadecimal digits of a digest that serve as join key.
SHORT = 8
#: Verdict of an address that no rule fits.
DEFAULT = "allow"


def rules_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "action string, host string, path string")


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(rest, upper, upper.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """Every row of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and all subdomains if the path starts with the rule's.
    The longest wins (host and path together, then the longer host); of two
    rules of one host and path ``block`` wins. A rule's host is lower-cased, a
    rule with a null part is left out.

    Each distinct url is expanded into the suffixes of its host that begin at a
    label and have as many labels as some rule's host, and the prefixes of its
    path that have the length of some rule's path; so a url gives no more
    expressions than the rules have sizes, however long it is.
    The expressions are joined with the rules on the first ``SHORT`` digits of
    their digests, and a match counts when the full digests agree. Null urls and
    urls without ``://`` have an empty host and path, fit no rule and get
    ``default``. Columns of ``pages`` with the names of the new ones are replaced;
    repeated rows stay, an empty table gives an empty one.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    listed = (
        rules.where("action is not null and host is not null and path is not null")
        .select("action", F.translate("host", upper, upper.lower()).alias("r_host"), F.col("path").alias("r_path"))
        .groupBy("r_host", "r_path")
        .agg(F.max("action").alias("action"))  # block comes after allow
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("short", F.substring("r_digest", 1, SHORT))
    )
    # one pair per number of labels and length of path that some rule has, however many rules there are
    size = F.struct(F.size(F.split("r_host", r"\.")).alias("labels"), F.length("r_path").alias("n"))
    sizes = sorted(row[0] for row in listed.select(size).distinct().collect())
    sizes = F.array(*(F.struct(F.lit(labels).alias("labels"), F.lit(n).alias("n")) for labels, n in sizes))
    sizes = sizes.cast("array<struct<labels:int,n:int>>")
    addresses = pages.select(F.col(url).alias("u_url")).distinct().where("instr(u_url, '://') > 0")
    addresses = addresses.select("u_url", host_of(F.col("u_url")).alias("u_host"), path_of(F.col("u_url")).alias("u_path"))
    addresses = addresses.withColumn("u_labels", F.split("u_host", r"\."))
    fitting = F.filter(sizes, lambda s: (s["labels"] <= F.size("u_labels")) & (s["n"] <= F.length("u_path")))
    expanded = addresses.select("u_url", "u_labels", "u_path", F.inline(fitting))
    suffix = F.array_join(F.slice("u_labels", -F.col("labels"), F.col("labels")), ".")
    expanded = expanded.select(
        "u_url", _digest(suffix, F.expr("substring(u_path, 1, n)")).alias("digest")
    ).withColumn("short", F.substring("digest", 1, SHORT))
    length = F.length("r_host") + F.length("r_path")
    best = F.max_by(
        F.struct("action", F.concat("r_host", "r_path").alias("rule")),
        F.struct(length, F.length("r_host")),
    )
    kept = [name for name in pages.columns if name.lower() not in ("host", "path", "rule", "verdict")]
    u_url, u_rule, u_verdict = free(pages.columns, "u_url", "u_rule", "u_verdict")
    found = (
        expanded.join(listed, "short")
        .where("digest = r_digest")
        .groupBy("u_url")
        .agg(best.alias("best"))
        .select(F.col("u_url").alias(u_url), F.col("best.rule").alias(u_rule), F.col("best.action").alias(u_verdict))
    )
    return pages.join(found, F.col(url) == F.col(u_url), "left").select(
        *kept,
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        F.col(u_rule).alias("rule"),
        F.coalesce(u_verdict, F.lit(default)).alias("verdict"),
    )
