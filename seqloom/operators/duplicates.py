"""Duplicate marking and limiting.

The best template of a duplicate set is a mergeable aggregate, joined back to the set. A set holding a third
of all templates therefore combines on the map side and its join partition is split by adaptive execution.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bases, cigar, flags
from ..functions.joins import join_small
from ..options import choice

TEMPLATE = ["sample", "qname"]
KEY = ["sample", "barcode", "end1", "end2"]


def _score(scoring: str, seed: int) -> Column:
    if scoring == "sum_of_base_qualities":
        return bases.sum_of_good_scores(F.col("qual"))
    if scoring == "total_mapped_reference_length":
        return cigar.ref_len().cast("bigint")
    return F.pmod(F.xxhash64(F.lit(seed), F.col("qname")), F.lit(1 << 31))  # sums of a template stay in range


def _templates(al: DataFrame, scoring: str, barcode: list[str], seed: int) -> DataFrame:
    usable = al.filter(flags.lacks(flags.UNMAPPED | flags.SECONDARY | flags.SUPPLEMENTARY))
    reverse = flags.has(flags.REVERSE)
    end = F.struct("rname", cigar.five_prime(reverse=reverse).alias("at"), flags.strand().alias("strand"))
    code = F.concat_ws("|", *barcode) if barcode else F.lit("")
    return (
        usable.select(*TEMPLATE, end.alias("end"), _score(scoring, seed).alias("score"), code.alias("code"))
        .groupBy(*TEMPLATE)
        .agg(
            F.min("end").alias("end1"), F.max("end").alias("last"), F.count(F.lit(1)).alias("records"),
            F.sum("score").alias("score"), F.min("code").alias("barcode"),
        )
        .withColumn("end2", F.when(F.col("records") > 1, F.col("last")))
        .drop("last")
    )


def _place(name: Column) -> Column:
    """tile, x, y of names with 5 or 7 colon-separated parts, else NULL."""
    parts = F.split(name, ":")
    n = F.size(parts)
    at = lambda i: F.element_at(parts, i).try_cast("int")
    return F.when(n.isin(5, 7), F.struct(at(-3).alias("tile"), at(-2).alias("x"), at(-1).alias("y")))


def duplicate_templates(
    al: DataFrame, *, scoring: str = "sum_of_base_qualities", barcode: list[str] | None = None, optical_distance: int = 100,
    seed: int = 1,
) -> DataFrame:
    """Templates with their set's size, kept name, and whether they are (optical) duplicates.

    The highest score is kept; ties go to the smaller name. A duplicate is optical when it lies on the kept
    template's tile within ``optical_distance`` in x and in y.
    """
    choice("scoring", scoring, ("sum_of_base_qualities", "total_mapped_reference_length", "random"))
    per = _templates(al, scoring, barcode or [], seed)
    best = per.groupBy(*KEY).agg(
        F.min(F.struct((-F.col("score")).alias("s"), F.col("qname").alias("q"))).getField("q").alias("kept"),
        F.count(F.lit(1)).alias("set_size"),
    )
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in KEY]
    on = same[0] & same[1] & same[2] & same[3]
    out = per.alias("a").join(best.alias("b"), on).select("a.*", "b.kept", "b.set_size")
    mine, theirs = _place(F.col("qname")), _place(F.col("kept"))
    near = (
        (mine["tile"] == theirs["tile"])
        & (F.abs(mine["x"] - theirs["x"]) <= optical_distance)
        & (F.abs(mine["y"] - theirs["y"]) <= optical_distance)
    )
    dup = F.col("qname") != F.col("kept")
    return out.withColumns({"is_dup": dup, "is_optical": dup & F.coalesce(near, F.lit(False))})


def mark_duplicates(
    al: DataFrame,
    *,
    remove: bool = False,
    remove_optical: bool = False,
    scoring: str = "sum_of_base_qualities",
    barcode: list[str] | None = None,
    optical_distance: int = 100,
    tag_sets: bool = False,
    tagging_policy: str = "dont_tag",
) -> DataFrame:
    """Set bit 0x400 on all records of duplicate templates and clear it elsewhere; or remove them.

    ``tag_sets`` adds ``ds`` (set size) and ``di`` (kept name) for sets of two and more. ``tagging_policy``
    ``all`` adds ``dt`` LB or SQ (optical), ``optical_only`` only SQ.
    """
    choice("tagging_policy", tagging_policy, ("dont_tag", "optical_only", "all"))
    marked = duplicate_templates(al, scoring=scoring, barcode=barcode, optical_distance=optical_distance)
    # Only members of real sets travel to the join with the records.
    marked = marked.filter("set_size > 1").select(*TEMPLATE, "kept", "set_size", "is_dup", "is_optical")
    joined = al.join(marked, TEMPLATE, "left")
    dup = F.coalesce("is_dup", F.lit(False))
    optical = F.coalesce("is_optical", F.lit(False))
    if remove:
        joined = joined.filter(~dup)
    elif remove_optical:
        joined = joined.filter(~optical)
    extra: dict[str, Column] = {
        "flag": F.when(dup, flags.put(flags.DUPLICATE)).otherwise(flags.clear(flags.DUPLICATE))
    }
    if tag_sets:
        extra.update(ds=F.col("set_size").cast("int"), di=F.col("kept"))
    if tagging_policy == "all":
        extra["dt"] = F.when(optical, "SQ").when(dup, "LB")
    elif tagging_policy == "optical_only":
        extra["dt"] = F.when(optical, "SQ")
    return joined.withColumns(extra).drop("kept", "set_size", "is_dup", "is_optical")


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    """Examined and duplicate counts for unpaired reads and pairs, and the derived fragment numbers."""
    usable = marked.filter(flags.lacks(flags.SECONDARY | flags.SUPPLEMENTARY | flags.UNMAPPED))
    pair = flags.has(flags.PAIRED) & flags.lacks(flags.MATE_UNMAPPED)
    dup = flags.has(flags.DUPLICATE)
    per = usable.groupBy("sample").agg(
        F.count_if(~pair).alias("unpaired_examined"),
        F.floor(F.count_if(pair) / 2).alias("pairs_examined"),
        F.count_if(~pair & dup).alias("unpaired_duplicates"),
        F.floor(F.count_if(pair & dup) / 2).alias("pair_duplicates"),
    )
    examined = F.col("unpaired_examined") + F.col("pairs_examined")
    dups = F.col("unpaired_duplicates") + F.col("pair_duplicates")
    reads = F.col("unpaired_examined") + 2 * F.col("pairs_examined")
    bad = F.col("unpaired_duplicates") + 2 * F.col("pair_duplicates")
    return per.withColumns(
        {
            "fragments_examined": examined,
            "duplicate_fragments": dups,
            "unique_fragments": examined - dups,
            "percent_duplication": F.when(reads > 0, bad / reads).otherwise(0.0),
        }
    )


def binomial_quantile(n: int, p: float, upper_tail: float) -> int:
    """Smallest k with P(X <= k) >= 1 - upper_tail for X ~ Binomial(n, p)."""
    log_term = n * math.log1p(-p)
    total, k = math.exp(log_term), 0
    while total < 1 - upper_tail and k < n:
        log_term += math.log((n - k) / (k + 1)) + math.log(p) - math.log1p(-p)
        k += 1
        total += math.exp(log_term)
    return k


def keep_dup(tags: DataFrame, *, k: int | str = 1, gsize: float | None = None, p: float = 1e-5) -> DataFrame:
    """At most ``k`` tags per (sample, rname, 5' position, strand); ``all`` keeps everything.

    ``auto`` takes the binomial limit for each sample's tag count and the genome size. Either way every task cuts its groups
    before the shuffle, so a hot position ships a few rows per task, not all of its tags.
    """
    if k == "all":
        return tags
    at = F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start"))
    group = Window.partitionBy("sample", "rname", "_at", "strand").orderBy("name")
    ranked = tags.withColumn("_at", at).withColumn("_rank", F.row_number().over(group))
    if k == "auto":
        if not gsize:
            raise ValueError("k='auto' needs gsize")

        @F.pandas_udf("long")
        def limit(totals: pd.Series) -> pd.Series:
            return totals.map(lambda n: max(1, binomial_quantile(int(n), 1.0 / gsize, p)))

        totals = tags.groupBy("sample").agg(F.count(F.lit(1)).alias("_n"))
        limits = totals.select("sample", limit("_n").alias("_limit"))
        # The largest limit is a number that Spark cuts by in each task before the shuffle; the sample's own comes after it.
        most = limits.agg(F.max("_limit")).first()[0] or 1
        ranked = join_small(ranked.filter(F.col("_rank") <= most), limits, "sample").filter(F.col("_rank") <= F.col("_limit")).drop("_limit")
    elif isinstance(k, int) and k >= 1:
        ranked = ranked.filter(F.col("_rank") <= k)
    else:
        raise ValueError(f"k must be a positive number, 'all' or 'auto', not {k!r}")
    return ranked.drop("_at", "_rank")
