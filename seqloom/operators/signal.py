"""Normalising, comparing and summarising binned signal.

Bins are (sample, rname, bin, start, end, n). Rank-based summaries work on the histogram of counts
(one row per distinct count), never on the sorted bins.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.joins import join_small
from ..functions.stats import poisson_score
from ..options import choice, positive


def normalize(
    bins: DataFrame,
    *,
    method: str,
    totals: DataFrame,
    genome_size: float | None = None,
    fragment_len: float | None = None,
    ignore: Sequence[str] = (),
) -> DataFrame:
    """Add ``value``: RPKM, 1x depth or read-count scaling. ``totals``: mapped reads (sample, rname, mapped).

    RPKM = n / (mapped in millions x bin in kb); 1x divides by mapped x fragment_len / genome_size;
    ``readcount`` scales every sample down to the smallest. Sequences in ``ignore`` do not enter the totals.
    """
    choice("method", method, ("rpkm", "1x", "readcount"))
    used = totals.filter(~F.col("rname").isin(*ignore)) if ignore else totals
    per = used.groupBy("sample").agg(F.sum("mapped").alias("mapped"))
    if method == "rpkm":
        kb = (F.col("end") - F.col("start")) / 1000.0
        value = F.col("n") / (F.col("mapped") / 1e6 * kb)
    elif method == "1x":
        if not genome_size or not fragment_len:
            raise ValueError("method='1x' needs genome_size and fragment_len")
        value = F.col("n") / (F.col("mapped") * F.lit(float(fragment_len)) / F.lit(float(genome_size)))
    else:
        per = per.withColumn("least", per.agg(F.min("mapped")).scalar())
        value = F.col("n") * (F.col("least") / F.col("mapped"))
    return join_small(bins, per, "sample").withColumn("value", value).drop("mapped", "least")


def _value(op: str, a, b, pseudocount: float):
    p = F.lit(float(pseudocount))
    ratio = (a + p) / (b + p)
    return {
        "log2": F.log2(ratio),
        "ratio": ratio,
        "subtract": a - b,
        "add": a + b,
        "mean": (a + b) / 2.0,
        # A ratio below 1 is shown as its negative inverse.
        "reciprocal_ratio": F.when(ratio < 1, -1.0 / ratio).otherwise(ratio),
        "first": a,
        "second": b,
    }[op]


# Comparison names.
OPERATIONS = ("log2", "ratio", "subtract", "add", "mean", "reciprocal_ratio", "first", "second")


def paired_bins(bins: DataFrame, design: DataFrame, column: str) -> DataFrame:
    """(run, rname, bin, a, b): ``column`` of treatment and control for every row (run, treatment, control) of ``design``.

    A bin missing on one side counts 0, and so does a missing control. The bins are read and shuffled once for all pairs; a sample may serve in several.
    """
    sides = F.array(F.struct(F.col("treatment").alias("sample"), F.lit(True).alias("_first")), F.struct(F.col("control").alias("sample"), F.lit(False).alias("_first")))
    roles = design.select("run", F.inline(sides)).filter("sample is not null")
    zero = F.lit(0).cast(dict(bins.dtypes)[column])
    dealt = join_small(bins.select("sample", "rname", "bin", column), roles, "sample")
    side = lambda first: F.coalesce(F.sum(F.when(F.col("_first") == first, F.col(column))), zero)
    return dealt.groupBy("run", "rname", "bin").agg(side(True).alias("a"), side(False).alias("b"))


def compare_signal(
    bins: DataFrame, design: DataFrame, *, op: str | Sequence[str] = "log2", pseudocount: float = 1.0, normalized: bool = False
) -> DataFrame:
    """(run, rname, bin, value): bin-wise comparison of the two signals (sample, rname, bin, value) of every run of ``design``.

    ``design`` has rows (run, treatment, control). Several operations come out as rows with their name in ``op``, from one pass over the bins.
    Normalised input (RPKM, 1x) is allowed with ``subtract`` only.
    """
    ops = [op] if isinstance(op, str) else list(op)
    for o in ops:
        choice("op", o, OPERATIONS)
        if normalized and o != "subtract":
            raise ValueError("normalised signal can only be subtracted")
    j = paired_bins(bins.withColumn("value", F.col("value").cast("double")), design, "value")
    rows = [F.struct(F.lit(o).alias("op"), _value(o, F.col("a"), F.col("b"), pseudocount).cast("double").alias("value")) for o in ops]
    out = j.select("run", "rname", "bin", F.inline(F.array(*rows)))
    return out.drop("op") if isinstance(op, str) else out


def ses_factors(bins: DataFrame, design: DataFrame) -> DataFrame:
    """Signal extraction scaling: the cumulative share difference of two bin counts is largest at the cut.

    Bins (sample, rname, bin, n) of every run (run, treatment, control) are ordered by the treatment's count through a histogram per run. Returns per run
    (run, cut, first_sum, second_sum, factor) with factor = first_sum / second_sum up to the cut.
    """
    hist = paired_bins(bins, design, "n").groupBy("run", "a").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"))
    # A window holds one row per different count of one run.
    whole = Window.partitionBy("run")
    upto = whole.orderBy("a")
    run = hist.withColumns(
        {
            "ca": F.sum("sa").over(upto), "cb": F.sum("sb").over(upto),
            "ta": F.sum("sa").over(whole), "tb": F.sum("sb").over(whole),
        }
    )
    apart = F.try_divide("cb", "tb") - F.try_divide("ca", "ta")
    best = run.groupBy("run").agg(F.min(F.struct((-apart).alias("d"), "a", "ca", "cb")).alias("m"))
    return best.select(
        "run", F.col("m.a").alias("cut"), F.col("m.ca").alias("first_sum"), F.col("m.cb").alias("second_sum"),
        F.try_divide("m.ca", "m.cb").alias("factor"),
    )


def _tiled_window(bins: DataFrame, reach: int, tile: int):
    """Bins copied into the neighbouring tile where they lie within ``reach`` of its border."""
    at = F.col("bin") % tile
    home = F.floor(F.col("bin") / tile)
    sides = F.array(
        F.struct(home.alias("_tile"), F.lit(True).alias("_home")),
        F.when(at < reach, F.struct((home - 1).alias("_tile"), F.lit(False).alias("_home"))),
        F.when(at >= tile - reach, F.struct((home + 1).alias("_tile"), F.lit(False).alias("_home"))),
    )
    return bins.withColumn("_t", F.explode(F.filter(sides, lambda s: s.isNotNull()))).select("*", "_t.*").drop("_t")


def moving_mean(bins: DataFrame, column: str, *, reach: int, out: str, tile: int = 65536) -> DataFrame:
    """Mean of ``column`` over bins ``bin - reach .. bin + reach`` that exist; windows stay inside tiles."""
    if reach == 0:
        return bins.withColumn(out, F.col(column).cast("double"))
    positive("reach", reach)
    if reach > tile:
        raise ValueError("reach must not exceed the tile")
    w = Window.partitionBy("sample", "rname", "_tile").orderBy("bin").rangeBetween(-reach, reach)
    return _tiled_window(bins, reach, tile).withColumn(out, F.avg(column).over(w)).filter("_home").drop("_tile", "_home")


def smooth(bins: DataFrame, *, length: int, bin_size: int, column: str = "value") -> DataFrame:
    """Average a bin with its neighbours over ``length`` bases; no change when shorter than a bin."""
    if length <= bin_size:
        return bins
    reach = max(1, int(length / bin_size) // 2)
    smoothed = moving_mean(bins, column, reach=reach, out="_smooth")
    return smoothed.withColumn(column, F.col("_smooth")).drop("_smooth")


def drop_non_covered(bins: DataFrame) -> DataFrame:
    """Drop bins that are 0 in every sample (``skip_zeros`` of the fingerprint does the same)."""
    covered = bins.filter("n > 0").select("rname", "bin").distinct()
    return bins.join(covered, ["rname", "bin"], "left_semi")


def fingerprint(bins: DataFrame, *, n_bins: int | None = None, seed: int = 1, skip_zeros: bool = False) -> DataFrame:
    """Per sample and distinct count: share of bins up to it and share of reads up to it.

    ``n_bins`` samples that many bins (hash-based, the same for all samples).
    """
    if skip_zeros:
        bins = drop_non_covered(bins)
    if n_bins is not None:
        from .alignments import first_n

        digest = F.xxhash64(F.lit(seed), "rname", "bin")
        places = bins.select("rname", "bin").distinct().withColumns({"_h": digest, "_b": F.shiftright(digest, 48)})
        chosen = first_n(places, n_bins, bucket=["_b"], order=["_h", "rname", "bin"])
        bins = bins.join(chosen.select("rname", "bin"), ["rname", "bin"], "left_semi")
    hist = bins.groupBy("sample", "n").agg(F.count(F.lit(1)).alias("bins"))
    upto = Window.partitionBy("sample").orderBy("n")
    whole = Window.partitionBy("sample")
    reads = F.col("n") * F.col("bins")
    return hist.select(
        "sample", "n", "bins",
        (F.sum("bins").over(upto) / F.sum("bins").over(whole)).alias("bin_share"),
        (F.sum(reads).over(upto) / F.sum(reads).over(whole)).alias("read_share"),
    )


def fingerprint_distance(bins: DataFrame, *, reference: str) -> DataFrame:
    """Jensen-Shannon distance (base 2) of each sample's count distribution to the reference sample's."""
    hist = bins.groupBy("sample", "n").agg(F.count(F.lit(1)).alias("bins"))
    share = hist.withColumn("p", F.col("bins") / F.sum("bins").over(Window.partitionBy("sample")))
    ref = share.filter(F.col("sample") == reference).select("n", F.col("p").alias("q"))
    mine = share.filter(F.col("sample") != reference).select("sample", "n", "p")
    both = mine.join(ref, "n", "left").na.fill(0.0, ["q"])
    m = (F.col("p") + F.col("q")) / 2

    def part(x):
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    # Reference mass on counts the sample never shows contributes q * log2(2) / 2 each.
    seen = both.groupBy("sample").agg(
        F.sum((part(F.col("p")) + part(F.col("q"))) / 2).alias("js"), F.sum("q").alias("q_seen")
    )
    js = F.col("js") + (1 - F.col("q_seen")) / 2
    return seen.select("sample", F.sqrt(F.greatest(js, F.lit(0.0))).alias("distance"))


def binarize(
    bins: DataFrame,
    *,
    p: float = 1e-4,
    fold: float = 0.0,
    min_signal: float = 0.0,
    control: DataFrame | None = None,
    reach: int = 5,
    pseudo: float = 1.0,
) -> DataFrame:
    """1 where a bin's count is Poisson-significant, else 0. ``bins`` must be dense (every bin listed).

    The expectation is the sample's mean count per bin; with a ``control`` (rname, bin, n; dense) it is scaled by
    the control's local enrichment: mean of ``n + pseudo`` over ``2 * reach + 1`` bins over its global mean.
    """
    means = bins.groupBy("sample").agg(F.avg("n").alias("_lam"))
    out = join_small(bins, means, "sample")
    if control is not None:
        c = control.select(F.lit("control").alias("sample"), "rname", "bin", (F.col("n") + pseudo).alias("_u"))
        local = moving_mean(c, "_u", reach=reach, out="_local").drop("sample", "_u")
        level = c.agg(F.avg("_u")).scalar()
        local = local.withColumn("_e", F.col("_local") / level).drop("_local")
        out = out.join(local, ["rname", "bin"], "left")
        out = out.withColumn("_lam", F.col("_lam") * F.coalesce("_e", F.lit(1.0))).drop("_e")
    out = out.withColumn("_score", poisson_score(F.col("n"), F.col("_lam")))
    on = (F.col("_score") > -math.log10(p)) & (F.col("n") >= fold * F.col("_lam")) & (F.col("n") >= min_signal)
    return out.withColumn("state", F.when(on, 1).otherwise(0)).drop("_lam", "_score")


def binarize_peaks(bins: DataFrame, peaks: DataFrame, *, bin_size: int = 4096) -> DataFrame:
    """1 where any peak of the sample overlaps the bin."""
    from .intervals import overlap_join

    places = bins.select("sample", "rname", "start", "end")
    hit = overlap_join(places, peaks.select("rname", "start", "end", "sample"), by=["sample"], bin_size=bin_size)
    hit = hit.select("sample", "rname", "start", "end").distinct().withColumn("_hit", F.lit(1))
    return bins.join(hit, ["sample", "rname", "start", "end"], "left").withColumn("state", F.coalesce("_hit", F.lit(0))).drop("_hit")


def shifted_bins(al: DataFrame, *, bin_size: int = 200, shift: int = 100, center: bool = False) -> DataFrame:
    """Bin picked by each read's 5' end moved ``shift`` downstream, or by its middle; counts per sample."""
    from ..functions import cigar, flags

    mapped = al.filter(flags.lacks(flags.UNMAPPED))
    plus = flags.lacks(flags.REVERSE)
    if center:
        at = F.floor((cigar.start0() + cigar.end0()) / 2)
    else:
        at = F.when(plus, cigar.start0() + shift).otherwise(cigar.end0() - 1 - shift)
    bin_no = F.floor(F.greatest(at, F.lit(0)) / bin_size).cast("bigint")
    return mapped.groupBy("sample", "rname", bin_no.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def densify(counts: DataFrame, grid: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Counts on every bin of the grid for every listed sample, 0 where absent."""
    from .intervals import with_samples

    return with_samples(grid, samples).join(counts, ["sample", "rname", "bin"], "left").na.fill(0, ["n"])
