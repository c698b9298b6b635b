"""Coverage runs, bin and region counts, read extension."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cigar, flags
from ..functions.joins import join_small
from ..options import choice, fail_when, positive
from .intervals import TILE, bin_of, explode_range, grid, join_equal_runs, merge_intervals, overlap_join, step_runs, with_samples

RUN_KEY = ("sample", "rname")


def spans(al: DataFrame, *, split: bool = False) -> DataFrame:
    """Covered intervals of mapped records: whole spans, or the blocks between ``N`` gaps with ``split``."""
    mapped = al.filter(flags.lacks(flags.UNMAPPED)).withColumn("strand", flags.strand())
    if split:
        return mapped.select("sample", "rname", "strand", F.inline(cigar.blocks()))
    return mapped.select("sample", "rname", "strand", cigar.start0().alias("start"), cigar.end0().alias("end"))


def depth_runs(
    intervals: DataFrame,
    *,
    by: Sequence[str] = RUN_KEY,
    forced: DataFrame | None = None,
    cap: int | None = None,
    tile: int = TILE,
) -> DataFrame:
    """Runs of equal depth over ``by``; inner zero runs are included.

    ``forced`` (``by`` columns and ``pos``) adds positions that must start or end a run.
    """
    by = list(by)
    ends = F.array(
        F.struct(F.col("start").alias("pos"), F.lit(1).alias("depth")), F.struct(F.col("end").alias("pos"), F.lit(-1).alias("depth"))
    )
    events = intervals.filter("end > start").select(*by, F.inline(ends))
    if forced is not None:
        fixed = forced.select(*by, "pos", F.lit(0).alias("depth"), F.lit(1).alias("fixed"))
        events = events.withColumn("fixed", F.lit(0)).unionByName(fixed)
    runs = step_runs(events, ["depth"], by=by, tile=tile)
    if cap is None:
        return runs
    return join_equal_runs(runs.withColumn("depth", F.least(F.col("depth"), F.lit(cap))), "depth", by=by, tile=tile)


def genome_coverage(
    al: DataFrame,
    *,
    zero: bool = False,
    chrom_sizes: DataFrame | None = None,
    samples: Sequence[str] | None = None,
    max_depth: int | None = None,
    split: bool = True,
    strand: str | None = None,
    ends: str | None = None,
    scale: float = 1.0,
    tile: int = TILE,
) -> DataFrame:
    """bedGraph runs of equal depth per sample; ``zero`` adds zero runs up to the sequence ends.

    ``ends`` counts only the 5' or 3' base (``"5"``, ``"3"``); ``max_depth`` caps the depth.
    """
    if zero and (chrom_sizes is None or not samples):
        raise ValueError("zero=True needs chrom_sizes and samples")
    iv = spans(al, split=split and ends is None)
    if strand is not None:
        choice("strand", strand, ("+", "-"))
        iv = iv.filter(F.col("strand") == strand)
    if ends is not None:
        choice("ends", ends, ("5", "3"))
        left = (F.col("strand") == "+") == (ends == "5")
        at = F.when(left, F.col("start")).otherwise(F.col("end") - 1)
        iv = iv.select("sample", "rname", "strand", at.alias("start"), (at + 1).alias("end"))
    forced = None
    if zero:
        sides = F.explode(F.array(F.lit(0), F.col("length").cast("int"))).alias("pos")
        forced = with_samples(chrom_sizes.select("rname", sides), samples)
    runs = depth_runs(iv, forced=forced, cap=max_depth, tile=tile)
    if not zero:
        runs = runs.filter("depth <> 0")
    return runs.select("sample", "rname", "start", "end", (F.col("depth") * F.lit(scale)).cast("double").alias("value"))


def read_filters(
    al: DataFrame,
    *,
    min_mapq: int = 0,
    include: int = 0,
    exclude: int = 0,
    min_fragment: int = 0,
    max_fragment: int = 0,
    ignore_duplicates: bool = False,
) -> DataFrame:
    """Mapped records passing quality, flag and fragment length filters; optionally one per start, strand and mate start."""
    keep = flags.lacks(flags.UNMAPPED | exclude) & flags.has(include) & (F.col("mapq") >= min_mapq)
    if min_fragment > 0:
        keep = keep & (F.abs("tlen") >= min_fragment)
    if max_fragment > 0:
        keep = keep & (F.abs("tlen") <= max_fragment)
    out = al.filter(keep)
    if ignore_duplicates:
        one = ["sample", "rname", "pos", "_strand", "pnext"]
        rest = [c for c in ("cigar", "flag", "mapq", "tlen", "rnext") if c in al.columns]
        out = out.withColumn("_strand", flags.strand()).groupBy(*one).agg(F.min(F.struct(*rest)).alias("_r"))
        out = out.select("sample", "rname", "pos", "pnext", "_r.*")
    return out


def touched_bins(start: Column, end: Column, bin_size: int, step: int) -> Column:
    """Indexes of the bins [i * step, i * step + bin_size) an interval overlaps."""
    first = F.greatest(F.floor((start - bin_size) / F.lit(step)).cast("bigint") + 1, F.lit(0).cast("bigint"))
    last = bin_of(end - 1, step)
    return F.when(last >= first, F.sequence(first, last))


def bin_counts(
    al: DataFrame,
    *,
    bin_size: int = 10000,
    gap: int = 0,
    chrom_sizes: DataFrame | None = None,
    samples: Sequence[str] | None = None,
    **filters,
) -> DataFrame:
    """Reads per sample and genome bin; with ``chrom_sizes`` and ``samples`` every bin is listed."""
    positive("bin_size", bin_size)
    step = bin_size + gap
    reads = read_filters(al, **filters).select(
        "sample", "rname", cigar.start0().alias("start"), cigar.end0().alias("end")
    )
    bins = reads.select("sample", "rname", F.explode(touched_bins(F.col("start"), F.col("end"), bin_size, step)).alias("bin"))
    counted = bins.groupBy("sample", "rname", "bin").agg(F.count(F.lit(1)).alias("n"))
    if chrom_sizes is None:
        return counted
    if not samples:
        raise ValueError("chrom_sizes needs samples")
    full = with_samples(grid(chrom_sizes, bin_size=bin_size, step=step), samples)
    joined = full.join(counted, ["sample", "rname", "bin"], "left")
    return joined.select("sample", "rname", "bin", "start", "end", F.coalesce("n", F.lit(0)).alias("n"))


def placements(al: DataFrame, *extra: str) -> DataFrame:
    """Identical placements counted once with multiplicity ``n``: the hot-locus guard of all counting joins."""
    return al.groupBy("sample", "rname", "pos", "cigar", flags.strand().alias("strand"), *extra).agg(F.count(F.lit(1)).alias("n"))


def region_counts(
    al: DataFrame, regions: DataFrame, *, samples: Sequence[str], metagene: bool = False, bin_size: int = 4096, **filters
) -> DataFrame:
    """Reads overlapping each region (``name``); with ``metagene`` regions of one name count a read once."""
    reads = placements(read_filters(al, **filters)).withColumns({"start": cigar.start0(), "end": cigar.end0()})
    spots = regions.select("name", "rname", "start", "end")
    if metagene:
        # Regions of one name are merged; a read counts at the first one it meets: the one before that ends at or before the read's start.
        # Names with a region that has no end meet the reads region by region.
        named = spots.filter("name is not null")
        open_ = named.filter(F.col("end").isNull()).select("name").distinct()
        apart = overlap_join(reads, named.join(open_, "name", "left_semi"), bin_size=bin_size)
        apart = apart.groupBy("sample", "rname", "pos", "cigar", "strand", "r_name").agg(F.max("n").alias("n"))
        spots = merge_intervals(named.join(open_, "name", "left_anti").filter("end > start"), by=["rname", "name"]).drop("n")
        spots = spots.withColumn("before", F.lag("end").over(Window.partitionBy("rname", "name").orderBy("start")))
        hits = overlap_join(reads, spots, bin_size=bin_size).filter("r_before is null or start >= r_before")
        hits = hits.select("sample", "r_name", "n").unionByName(apart.select("sample", "r_name", "n"))
        counted = hits.groupBy("sample", F.col("r_name").alias("name")).agg(F.sum("n").alias("n"))
        names = regions.select("name").distinct()
    else:
        # A region that is given several times counts its reads as often.
        spots = spots.groupBy(*spots.columns).agg(F.count(F.lit(1)).alias("times"))
        reads = reads.groupBy("sample", "rname", "start", "end").agg(F.sum("n").alias("reads"))
        hits = overlap_join(reads, with_samples(spots, samples), by=["sample"], per="right", weight="reads")
        counted = hits.groupBy("sample", "name", "rname", "start", "end").agg(F.sum(F.col("n") * F.col("times")).alias("n"))
        names = spots.drop("times")
    return with_samples(names, samples).join(counted, ["sample", *names.columns], "left").na.fill(0, ["n"])


def extend_reads(al: DataFrame, *, length: int | None = None) -> DataFrame:
    """Intervals extended to the fragment: proper mates give their fragment, others reach ``length``.

    Without ``length`` the sample's mean fragment length is used; reads of a sample without proper pairs stay as they are. Mates more than 4 times that length
    apart count as single; reads longer than it stay as they are.
    """
    mapped = al.filter(flags.lacks(flags.UNMAPPED)).withColumns(
        {"strand": flags.strand(), "start": cigar.start0(), "end": cigar.end0()}
    )
    proper = flags.has(flags.PAIRED | flags.PROPER) & (F.col("tlen") != 0)
    if length is None:
        means = mapped.filter(proper & (F.col("tlen") > 0)).groupBy("sample").agg(
            F.floor(F.avg("tlen")).cast("int").alias("_len")
        )
        mapped = join_small(mapped, means, "sample", "left")
        size = F.col("_len")
    else:
        positive("length", length)
        size = F.lit(length)
    paired = proper & (F.abs("tlen") <= 4 * size)
    short = (F.col("end") - F.col("start")) < size
    plus = F.col("strand") == "+"
    start = (
        F.when(paired & (F.col("tlen") > 0), F.col("start"))
        .when(paired, F.col("end") + F.col("tlen"))
        .when(short & ~plus, F.col("end") - size)
        .otherwise(F.col("start"))
    )
    end = (
        F.when(paired & (F.col("tlen") > 0), F.col("start") + F.col("tlen"))
        .when(paired, F.col("end"))
        .when(short & plus, F.col("start") + size)
        .otherwise(F.col("end"))
    )
    out = mapped.select("*", F.greatest(start, F.lit(0)).alias("_s"), end.alias("_e")).drop("start", "end", "_len")
    return out.withColumnsRenamed({"_s": "start", "_e": "end"})


def center_reads(extended: DataFrame, *, read_len: int) -> DataFrame:
    """Move each fragment to ``read_len`` bases around its centre."""
    positive("read_len", read_len)
    start = F.floor((F.col("start") + F.col("end") - read_len) / 2).cast("int")
    return extended.withColumn("_s", F.greatest(start, F.lit(0))).withColumns(
        {"start": F.col("_s"), "end": F.col("_s") + read_len}
    ).drop("_s")


def shift_reads(tags: DataFrame, *, shift: int, ext: int) -> DataFrame:
    """Shift the 5' end by ``shift`` downstream, then extend to ``ext`` bases 5' to 3'."""
    positive("ext", ext)
    plus = F.col("strand") == "+"
    five = F.when(plus, F.col("start") + shift).otherwise(F.col("end") - shift)
    start = F.when(plus, five).otherwise(five - ext)
    return tags.withColumn("_s", start).withColumns(
        {"start": F.greatest(F.col("_s"), F.lit(0)), "end": F.greatest(F.col("_s") + ext, F.lit(0))}
    ).drop("_s").filter("end > start")


def exclude_blacklist(bins: DataFrame, blacklist: DataFrame, *, bin_size: int = 4096) -> DataFrame:
    """Drop bins that overlap a blacklisted interval; bins are keyed by (rname, start, end)."""
    places = bins.select("rname", "start", "end").distinct()
    bad = overlap_join(places, blacklist.select("rname", "start", "end"), bin_size=bin_size)
    bad = bad.select("rname", "start", "end").distinct()
    return bins.join(bad, ["rname", "start", "end"], "left_anti")


def pad_coverage(long: DataFrame) -> DataFrame:
    """Coverage rows (label, bin_id, n); labels that end early are padded with zero rows up to the last bin of all."""
    # The padding needs each label's length and the longest one: one row per label.
    rows = long.groupBy("label").agg(F.max("bin_id").alias("last"))
    longest = rows.agg(F.max("last")).scalar()
    pad = rows.withColumn("_hi", longest).filter("last < _hi")
    pad = explode_range(pad, F.col("last") + 1, F.col("_hi"), "bin_id").select("label", "bin_id", F.lit(0).cast("bigint").alias("n"))
    return long.select("label", "bin_id", F.col("n").cast("bigint").alias("n")).unionByName(pad)


def merge_coverage_matrices(parts: Mapping[str, DataFrame]) -> DataFrame:
    """Stack coverage columns (bin_id, n) of separate tables by label; shorter ones are padded with zero rows at the end.

    Where the labels are a column already, :func:`pad_coverage` does the same in one plan.
    """
    if not parts:
        raise ValueError("no matrices to merge")
    return pad_coverage(reduce(DataFrame.unionByName, [d.select(F.lit(k).alias("label"), "bin_id", "n") for k, d in parts.items()]))


def pair_controls(design: DataFrame, treatments: DataFrame, controls: DataFrame) -> DataFrame:
    """Each treatment with its control by ``design`` (treatment, control); NULL control means none.

    Returns (run, treatment, control); an id without data is a run-time error.
    """
    have_t = treatments.select(F.col("sample").alias("treatment")).distinct().withColumn("_t", F.lit(True))
    have_c = controls.select(F.col("sample").alias("control")).distinct().withColumn("_c", F.lit(True))
    joined = design.join(have_t, "treatment", "left").join(have_c, "control", "left")
    bad = F.col("_t").isNull() | (F.col("control").isNotNull() & F.col("_c").isNull())
    message = F.concat(F.lit("no data for design row "), F.concat_ws("-", "treatment", "control"))
    run = fail_when(bad, message, F.concat_ws("-", "treatment", "control"))
    return joined.select(run.alias("run"), "treatment", "control")
