"""URL rules by host suffix and path prefix: an equi-join on short hash prefixes, confirmed on full digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Hex digits of the digest that the join compares; the rest is confirmed afterwards.
SHORT = 8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*+([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _slashes(path: Column) -> Column:
    return F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))


def _folder(path: Column) -> Column:
    """A path up to its last slash, that included."""
    return F.regexp_extract(path, r"(?s)^.*/", 0)


def _digest(host: Column, folder: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), folder), 256)


def judge(pages: DataFrame, rules: DataFrame, *, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages(page_id, url)``; other columns are ignored.

    A rule (``host, path, verdict``) fits its host and all subdomains where the url's path starts with the rule's. The longest ``host || path`` wins, of
    equal ones that with the longer host, of equal rules the verdict last by name. Without a fitting rule ``rule`` is null and the verdict is ``default``. A null url,
    or one without ``://``, has an empty host and path and fits none; repeated rows are all returned; no rules or no pages are fine.

    Different urls are expanded once into host suffixes and path folders, no deeper than the rules go, and meet the rules on the first
    digits of a digest; whole digests, then the whole path, are confirmed. Rules come back to the pages by host and path. Nothing is broadcast by hint.
    """
    own = rules.select(F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict"))
    own = own.filter("r_host <> ''").withColumn("r_folder", _folder(F.col("r_path"))).withColumn("r_digest", _digest(F.col("r_host"), F.col("r_folder")))
    own = own.withColumn("short", F.substring("r_digest", 1, SHORT))
    depth = own.agg(F.max(F.size(F.split("r_host", r"\."))).alias("labels"), F.max(_slashes(F.col("r_folder"))).alias("folders")).first()
    labels, folders = depth["labels"] or 0, depth["folders"] or 0
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    suffix = F.explode(F.array_distinct(F.array(*[F.substring_index("host", ".", -k) for k in range(1, max(labels, 1) + 1)])))
    folder = F.explode(F.filter(F.array(F.lit(""), *[F.when(_slashes(F.col("path")) >= k, F.concat(F.substring_index("path", "/", k), F.lit("/"))) for k in range(1, folders + 1)]), lambda f: f.isNotNull()))
    different = parsed.filter("host <> ''").select("host", "path").distinct()
    expanded = different.withColumn("suffix", suffix).withColumn("folder", folder).withColumn("digest", _digest(F.col("suffix"), F.col("folder")))
    met = expanded.withColumn("short", F.substring("digest", 1, SHORT)).join(own, "short")
    fits = met.filter((F.col("digest") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path")))
    rule = F.concat("r_host", "r_path")
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length(rule).alias("n"), F.length("r_host").alias("h"), F.col("r_verdict").alias("verdict"), rule.alias("rule"))).alias("best"))
    joined = parsed.join(best, ["host", "path"], "left")
    return joined.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
