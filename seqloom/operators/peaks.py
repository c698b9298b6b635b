"""Peak calling, bin enrichment, library complexity."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.joins import join_small
from ..functions.staging import stage
from ..functions.stats import log_choose, poisson_score
from ..options import choice, positive
from .intervals import TILE, merge_intervals, overlap_join, step_runs

BY = ["sample", "rname"]
#: Rows of the rank table (distinct rounded scores of all samples) that are broadcast at most.
RANKS = 200_000


def _weighted_runs(layers: dict[str, DataFrame]) -> DataFrame:
    """Step functions of several interval sets on common runs, one depth column per layer."""
    parts = None
    for name, iv in layers.items():
        ends = F.array(
            F.struct(F.col("start").alias("pos"), F.lit(1).alias("d")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("d"))
        )
        ev = iv.filter("end > start").select(*BY, F.inline(ends))
        ev = ev.select(*BY, "pos", *[(F.col("d") if n == name else F.lit(0)).alias(n) for n in layers])
        parts = ev if parts is None else parts.unionByName(ev)
    return step_runs(parts, list(layers), by=BY)


def _around(tags: DataFrame, width: int) -> DataFrame:
    """Intervals of ``width`` centred on the 5' end."""
    five = F.when(F.col("strand") == "-", F.col("end")).otherwise(F.col("start"))
    start = F.greatest(five - width // 2, F.lit(0))
    return tags.select(*BY, start.alias("start"), (five - width // 2 + width).alias("end"))


def _directed(tags: DataFrame, ext: int) -> DataFrame:
    """Tags extended from the 5' end to ``ext`` bases."""
    plus = F.col("strand") != "-"
    start = F.when(plus, F.col("start")).otherwise(F.greatest(F.col("end") - ext, F.lit(0)))
    end = F.when(plus, F.col("start") + ext).otherwise(F.col("end"))
    return tags.select(*BY, start.alias("start"), end.alias("end"))


def pileup_with_background(
    treatment: DataFrame,
    control: DataFrame | None = None,
    *,
    gsize: float,
    ext: int = 200,
    slocal: int = 1000,
    llocal: int = 10000,
    nolambda: bool = False,
    to_large: bool = False,
) -> DataFrame:
    """Runs with treatment pileup and the expected pileup ``lam``.

    The background is the genome-wide mean, raised where the control (the treatment itself when there is none, then
    without the small window) is dense within ``ext``, ``slocal`` or ``llocal`` bases. The bigger of the two libraries
    is scaled down, or with ``to_large`` the smaller up. Tags carry (sample, rname, start, end, strand, name);
    a control sample has its treatment's sample name.
    """
    positive("gsize", gsize)
    t_n = treatment.groupBy("sample").agg(F.count(F.lit(1)).alias("_nt"))
    layers = {"treat": _directed(treatment, ext)}
    if not nolambda:
        if control is not None:
            layers["near"] = _around(control, ext)
            layers["small"] = _around(control, slocal)
        layers["wide"] = _around(treatment if control is None else control, llocal)
    runs = _weighted_runs(layers)
    if control is None:
        sizes = t_n.withColumn("_nc", F.col("_nt"))
    else:
        sizes = t_n.join(control.groupBy("sample").agg(F.count(F.lit(1)).alias("_nc")), "sample", "left").na.fill(0, ["_nc"])
    pick = F.greatest if to_large else F.least
    goal = F.when(F.col("_nc") > 0, pick("_nt", "_nc")).otherwise(F.col("_nt"))
    sizes = sizes.select(
        "sample", (goal / F.col("_nt")).alias("_ft"),
        F.when(F.col("_nc") > 0, goal / F.col("_nc")).otherwise(0.0).alias("_fc"),
        (goal * F.lit(ext / gsize)).alias("_bg"),
    )
    local: list[Column] = [F.col("_bg")]
    if "near" in layers:
        local += [F.col("near") * F.col("_fc"), F.col("small") * F.col("_fc") * F.lit(ext / slocal)]
    if "wide" in layers:
        local.append(F.col("wide") * F.col("_fc") * F.lit(ext / llocal))
    lam = F.greatest(*local) if len(local) > 1 else local[0]
    return join_small(runs, sizes, "sample").select(
        *BY, "start", "end", (F.col("treat") * F.col("_ft")).alias("pileup"), lam.alias("lam")
    )


def score_runs(runs: DataFrame, *, digits: int = 3) -> DataFrame:
    """Add ``score`` (-log10 p) and ``qscore`` (-log10 Benjamini-Hochberg q, over bases) per sample.

    Tails are computed on the rows, without a shuffle. Scores are rounded to ``digits``, which bounds the rank table: its window has one row per distinct score.
    """
    scored = runs.withColumn("score", F.round(poisson_score(F.ceil("pileup"), F.col("lam")), digits))
    table = scored.groupBy("sample", "score").agg(F.sum((F.col("end") - F.col("start")).cast("bigint")).alias("len"))
    down = Window.partitionBy("sample").orderBy(F.desc("score"))
    up = Window.partitionBy("sample").orderBy(F.asc("score")).rowsBetween(Window.unboundedPreceding, 0)
    rank = F.sum("len").over(down) - F.col("len") + 1
    total = F.sum("len").over(Window.partitionBy("sample"))
    table = table.withColumn("_q", F.greatest(F.col("score") + F.log10(rank / total), F.lit(0.0)))
    # A q-value never exceeds that of a worse score: running maximum of -log10 q from the worst score up.
    table = table.withColumn("qscore", F.max("_q").over(up)).select("sample", "score", "qscore")
    return join_small(scored, table, ["sample", "score"], limit=RANKS)


def _islands(runs: DataFrame, max_gap: int, min_len: int) -> DataFrame:
    merged = merge_intervals(runs.select(*BY, "start", "end"), gap=max_gap, by=BY, tile=TILE)
    return merged.filter(F.col("end") - F.col("start") >= min_len).drop("n")


def call_peaks(
    treatment: DataFrame,
    control: DataFrame | None = None,
    *,
    gsize: float,
    q: float | None = 0.05,
    p: float | None = None,
    ext: int = 200,
    slocal: int = 1000,
    llocal: int = 10000,
    nolambda: bool = False,
    to_large: bool = False,
    max_gap: int = 50,
    min_len: int | None = None,
    broad: bool = False,
    broad_cutoff: float = 0.1,
) -> DataFrame:
    """Enriched regions with summit, fold enrichment and scores.

    Bases at or below the cutoff are merged over gaps up to ``max_gap``; islands shorter than ``min_len`` (default
    ``ext``) are dropped. ``broad`` reports regions at ``broad_cutoff`` holding at least one narrow island.
    """
    runs = pileup_with_background(
        treatment, control, gsize=gsize, ext=ext, slocal=slocal, llocal=llocal, nolambda=nolambda, to_large=to_large
    )
    # Scoring and island building each read their input several times.
    runs = stage(score_runs(stage(runs)))
    column, cutoff = ("score", p) if p is not None else ("qscore", q)
    if cutoff is None or not 0 < cutoff < 1:
        raise ValueError("give a cutoff p or q between 0 and 1")
    min_len = ext if min_len is None else min_len
    above = runs.filter(F.col(column) >= -math.log10(cutoff))
    regions = _islands(above, max_gap, min_len)
    kept = above
    if broad:
        kept = runs.filter(F.col(column) >= -math.log10(broad_cutoff))
        wide = _islands(kept, 4 * max_gap, min_len)
        inside = overlap_join(wide, regions, by=["sample"], bin_size=16384)
        regions = wide.join(inside.select(*BY, "start", "end").distinct(), [*BY, "start", "end"], "left_semi")
    hits = overlap_join(kept.select(*BY, "start", "end", "pileup", "lam", "score", "qscore"), regions, by=["sample"], bin_size=16384)
    # The summit is the middle of the highest run; ties go to the leftmost.
    top = F.min(F.struct((-F.col("pileup")).alias("h"), "start", "end", "lam", "score", "qscore")).alias("t")
    out = hits.groupBy("sample", "rname", F.col("r_start").alias("_s"), F.col("r_end").alias("_e")).agg(top)
    height = -F.col("t.h")
    return out.select(
        "sample", "rname", F.col("_s").alias("start"), F.col("_e").alias("end"),
        F.floor((F.col("t.start") + F.col("t.end")) / 2).cast("int").alias("summit"), height.alias("pileup"),
        ((height + 1) / (F.col("t.lam") + 1)).alias("fold"), F.col("t.score").alias("score"), F.col("t.qscore").alias("qscore"),
    )


def truncated_rate(mean: Column) -> Column:
    """Rate of a zero-truncated Poisson distribution with this mean: the root of lam = mean (1 - exp(-lam)).

    Newton's method from the right side of a convex function: every step comes closer, at least halving the error
    where the root is near zero and squaring it elsewhere, so 64 steps reach the last bit of a double.
    """
    step = lambda lam, _: lam - (lam + mean * F.expm1(-lam)) / (1 - mean * F.exp(-lam))
    settled = F.aggregate(F.sequence(F.lit(1), F.lit(64)), mean, lambda lam, i: F.when(mean * F.exp(-lam) < 1, F.greatest(step(lam, i), F.lit(0.0))).otherwise(lam))
    return F.when(mean > 1, settled).otherwise(F.lit(0.0))


def enriched_bins(bins: DataFrame, *, p: float = 0.01, dist: str = "poisson") -> DataFrame:
    """Bins of (sample, rname, bin, n) with counts significant under a per-sample count model.

    ``poisson`` takes the mean of all given bins; ``zero_truncated`` fits the non-zero bins only.
    """
    choice("dist", dist, ("poisson", "zero_truncated"))
    if dist == "poisson":
        fit = bins.groupBy("sample").agg(F.avg("n").alias("lam"))
    else:
        fit = bins.filter("n > 0").groupBy("sample").agg(F.avg("n").alias("m"))
        fit = fit.withColumn("lam", truncated_rate(F.col("m"))).drop("m")
    pairs = bins.filter("n > 0").groupBy("sample", "n").agg(F.count(F.lit(1)).alias("_k")).join(fit, "sample")
    score = poisson_score(F.col("n"), F.col("lam"))
    if dist == "zero_truncated":
        score = F.when(F.col("lam") > 1e-12, score + F.log10(-F.expm1(-F.col("lam")))).otherwise(0.0)
    scored = pairs.withColumn("score", score).filter(F.col("score") >= -math.log10(p)).select("sample", "n", "score")
    return bins.join(scored, ["sample", "n"])


def complexity_curve(histogram: DataFrame, *, step: int) -> DataFrame:
    """Expected distinct reads in subsamples of step, 2 step, ... of a duplicate-count histogram.

    ``histogram``: (sample, occurrence, n). Without replacement: sum of n (1 - C(N - j, size) / C(N, size)).
    """
    positive("step", step)
    totals = histogram.groupBy("sample").agg(F.sum(F.col("occurrence") * F.col("n")).alias("total"))
    rows = histogram.join(totals, "sample").withColumn(
        "size", F.explode(F.sequence(F.lit(step).cast("bigint"), F.greatest("total", F.lit(step)), F.lit(step).cast("bigint")))
    ).filter("size <= total")
    unseen = F.exp(log_choose(F.col("total") - F.col("occurrence"), F.col("size")) - log_choose(F.col("total"), F.col("size")))
    return rows.groupBy("sample", "size").agg(F.sum(F.col("n") * (1 - unseen)).alias("distinct_reads"))


def split_peaks(peaks: DataFrame, chip: DataFrame, control: DataFrame, *, min_ratio: float = 2.0) -> DataFrame:
    """Peaks (sample, rname, start, end) with chip and control reads and ``passed`` by their ratio.

    The ratio is (chip + 1) / (control scaled to the chip total + 1), all within the peak's sample; where a sample has no
    control reads the scaled control is 0. Read tables: (sample, rname, start, end), controls under the sample they belong to.
    """

    def counted(reads: DataFrame, name: str) -> DataFrame:
        spots = reads.groupBy("sample", "rname", "start", "end").agg(F.count(F.lit(1)).alias("n"))
        hits = overlap_join(spots, peaks.select("sample", "rname", "start", "end"), by=["sample"])
        return hits.groupBy("sample", "rname", F.col("r_start").alias("start"), F.col("r_end").alias("end")).agg(F.sum("n").alias(name))

    keys = ["sample", "rname", "start", "end"]
    out = peaks.join(counted(chip, "chip"), keys, "left").join(counted(control, "input"), keys, "left").na.fill(0, ["chip", "input"])
    total = lambda reads, name: reads.groupBy("sample").agg(F.count(F.lit(1)).alias(name))
    totals = total(chip, "_all_chip").join(total(control, "_all_input"), "sample", "full")
    factor = F.coalesce(F.try_divide(F.col("_all_chip"), F.col("_all_input")), F.lit(0.0))
    ratio = (F.col("chip") + 1) / (F.col("input") * factor + 1)
    out = out.join(totals, "sample", "left").withColumn("ratio", ratio).drop("_all_chip", "_all_input")
    return out.withColumn("passed", F.col("ratio") >= min_ratio)
