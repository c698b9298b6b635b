"""Alignment filters, rewrites, summaries and mate repair.

Rules over all records of a template are aggregates joined back to the records (never a window over a
template), so a name shared by very many records stays split over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bases, cigar, flags
from ..functions.staging import discard, stage_table
from ..options import choice, positive, require
from .intervals import merge_intervals, overlap_join

TEMPLATE = ["sample", "qname"]


def filter_alignments(al: DataFrame, *, keep: int = 0, skip: int = 0, min_mapq: int = 0) -> DataFrame:
    """All bits of ``keep`` set, none of ``skip``, mapping quality at least ``min_mapq``."""
    return al.filter(flags.has(keep) & flags.lacks(skip) & (F.col("mapq") >= min_mapq))


def sort_alignments(al: DataFrame, *, by: str = "coordinate", tag: str | None = None, partitions: int | None = None) -> DataFrame:
    """Range-partitioned global order; the read name breaks ties so one position can span partitions."""
    choice("by", by, ("coordinate", "name", "tag"))
    if by == "tag" and not tag:
        raise ValueError("by='tag' needs a tag column")
    order = {"coordinate": ["rname", "pos", "qname", "flag"], "name": ["qname", "flag", "rname", "pos"]}.get(
        by, [tag, "rname", "pos", "qname"]
    )
    ranged = al.repartitionByRange(partitions, *order) if partitions else al.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def in_region(region: str) -> Column:
    """Predicate for ``chr`` or ``chr:start:end`` (0-based half-open) on overlapping alignments."""
    parts = region.split(":")
    if len(parts) not in (1, 3):
        raise ValueError(f"region must be chr or chr:start:end, not {region!r}")
    keep = F.col("rname") == parts[0]
    if len(parts) == 3:
        start, end = int(parts[1]), int(parts[2])
        if not 0 <= start < end:
            raise ValueError(f"empty region {region!r}")
        keep = keep & (cigar.start0() < end) & (cigar.end0() > start)
    return keep


def filter_region(al: DataFrame, region: str) -> DataFrame:
    return al.filter(in_region(region))


def merge_alignments(parts: Mapping[str, DataFrame], *, region: str | None = None, attach_rg: bool = False) -> DataFrame:
    """Union of alignment tables; with ``attach_rg`` column ``rg`` holds the table's name."""
    if not parts:
        raise ValueError("no tables to merge")
    tables = [df.withColumn("rg", F.lit(n)) if attach_rg else df for n, df in parts.items()]
    merged = reduce(DataFrame.unionByName, tables)
    return filter_region(merged, region) if region else merged


def set_read_group(al: DataFrame, *, rg_id: str) -> DataFrame:
    """All reads to one new group: the RG tag is replaced."""
    require(al, "tags")
    others = F.map_filter("tags", lambda k, v: k != "RG")
    group = F.create_map(F.lit("RG"), F.struct(F.lit("Z").alias("type"), F.lit(rg_id).alias("value")))
    return al.withColumn("tags", F.map_concat(others, group))


def read_group_header(*, rg_id: str, lb: str, pl: str, pu: str, sm: str, **extra: str) -> str:
    fields = {"ID": rg_id, "LB": lb, "PL": pl, "PU": pu, "SM": sm, **{k.upper(): v for k, v in extra.items()}}
    return "\t".join(["@RG", *[f"{k}:{v}" for k, v in fields.items()]])


def idxstats(al: DataFrame, chrom_sizes: DataFrame, *, samples: Sequence[str]) -> DataFrame:
    """Length, mapped and unmapped records per sample and reference sequence, zeros included; ``*`` holds the unplaced ones."""
    per = al.groupBy("sample", "rname").agg(
        F.count_if(flags.lacks(flags.UNMAPPED)).alias("mapped"), F.count_if(flags.has(flags.UNMAPPED)).alias("unmapped")
    )
    unplaced = al.sparkSession.createDataFrame([("*", 0)], "rname string, length bigint")
    named = chrom_sizes.select("rname", F.col("length").cast("bigint")).unionByName(unplaced)
    rows = named.select(F.explode(F.array(*map(F.lit, samples))).alias("sample"), "rname", "length")
    return rows.join(per, ["sample", "rname"], "left").na.fill(0, ["mapped", "unmapped"])


def alignment_stats(al: DataFrame, *, min_mapq: int = 30) -> DataFrame:
    """Summary counts, mean read length and error rate (NM per mapped read base), one pass per sample."""
    mapped = flags.lacks(flags.UNMAPPED)
    length = cigar.query_len()
    return al.groupBy("sample").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(mapped).alias("mapped"),
        F.count_if(flags.has(flags.PAIRED)).alias("paired"),
        F.count_if(flags.has(flags.PAIRED | flags.PROPER)).alias("proper"),
        F.count_if(flags.has(flags.DUPLICATE)).alias("duplicates"),
        F.count_if(flags.has(flags.SECONDARY)).alias("secondary"),
        F.count_if(F.col("mapq") < min_mapq).alias("low_mapq"),
        F.avg(length).alias("mean_length"),
        (F.sum("nm") / F.sum(F.when(mapped, length))).alias("error_rate"),
    )


def to_reads(al: DataFrame, *, keep: int = 0, skip: int = flags.SECONDARY) -> DataFrame:
    """Alignments back to reads, the reverse strand restored."""
    turned = flags.has(flags.REVERSE)
    return filter_alignments(al, keep=keep, skip=skip).select(
        "sample", "qname", flags.mate_number().alias("mate"),
        F.when(turned, bases.reverse_complement("seq")).otherwise(F.col("seq")).alias("seq"),
        F.when(turned, F.reverse("qual")).otherwise(F.col("qual")).alias("qual"),
    )


def count_targets(al: DataFrame) -> DataFrame:
    """Records per (flag, reference name up to the first pipe and underscore); unplaced records dropped."""
    ref = F.substring_index(F.substring_index("rname", "|", 1), "_", 1)
    placed = al.filter(~F.contains("rname", F.lit("*")))
    return placed.groupBy("sample", "flag", ref.alias("ref")).agg(F.count(F.lit(1)).alias("n"))


def unique_pairs_only(al: DataFrame) -> DataFrame:
    """Primary records of templates with one record, or two that are mate 1 and mate 2.

    A lone record gets the mate-unmapped bit.
    """
    primary = al.filter(flags.lacks(flags.SECONDARY))
    good = _template_kinds(primary).filter("kind = 'kept'").select(*TEMPLATE, "n")
    joined = primary.join(good, TEMPLATE)
    return joined.withColumn("flag", flags.put_if(F.col("n") == 1, flags.MATE_UNMAPPED)).drop("n")


def _template_kinds(primary: DataFrame) -> DataFrame:
    both = flags.FIRST | flags.SECOND
    per = primary.groupBy(*TEMPLATE).agg(F.count(F.lit(1)).alias("n"), F.bit_or("flag").alias("bits"))
    kind = (
        F.when(F.col("n") > 2, "discard_gt_2")
        .when((F.col("n") == 2) & ~flags.has(both, "bits"), "discard_40_80")
        .otherwise("kept")
    )
    return per.withColumn("kind", kind)


def unique_pairs_report(al: DataFrame) -> DataFrame:
    """Rows read and written, percentage, and templates discarded per reason, per sample."""
    read = al.groupBy("sample").agg(F.count(F.lit(1)).alias("rcount"))
    kinds = _template_kinds(al.filter(flags.lacks(flags.SECONDARY)))
    done = kinds.groupBy("sample").agg(
        F.sum(F.when(F.col("kind") == "kept", F.col("n")).otherwise(0)).alias("wcount"),
        F.count_if(F.col("kind") == "discard_gt_2").alias("discard_gt_2"),
        F.count_if(F.col("kind") == "discard_40_80").alias("discard_40_80"),
    )
    joined = read.join(done, "sample", "left").na.fill(0)
    return joined.withColumn("wpercent", F.col("wcount") * 100.0 / F.col("rcount"))


def fix_mates(al: DataFrame) -> DataFrame:
    """Repair mate fields of multi-mapped templates: mappings are numbered by ``xi``.

    All mappings of a name must have one record, or all two; else a run-time error names it.
    ``nh`` becomes the number of mappings; a single mapping loses the secondary bit. The result is a staged table.
    """
    given = stage_table(al)
    me = F.struct("flag", "rname", "pos", "cigar")
    mapping = given.groupBy(*TEMPLATE, "xi").agg(F.count(F.lit(1)).alias("size"))
    template = mapping.groupBy(*TEMPLATE).agg(
        F.count(F.lit(1)).alias("nh"), F.min("size").alias("lo"), F.max("size").alias("hi")
    )
    # Counts come back by mapping, and a window holds one mapping, of two records unless it is an error: whole records are shuffled once.
    # The counts are staged, so that their shuffles are gone before that.
    counts = stage_table(mapping.drop("size").join(template.hint("merge"), TEMPLATE))
    one = Window.partitionBy(*TEMPLATE, "xi")
    both = given.drop("nh").withColumns({"m1": F.min(me).over(one), "m2": F.max(me).over(one)})
    joined = both.join(counts.hint("merge"), [*TEMPLATE, "xi"])
    bad = (F.col("lo") != F.col("hi")) | (F.col("hi") > 2)
    message = F.concat(F.lit("single and paired mappings mixed: "), F.col("qname"))
    paired = F.when(bad, F.raise_error(message).cast("boolean")).otherwise(F.col("hi") == 2)
    joined = joined.withColumns({"paired": paired, "mate": F.when(me == F.col("m1"), F.col("m2")).otherwise(F.col("m1"))})
    flag = F.when(F.col("nh") <= 1, flags.clear(flags.SECONDARY)).otherwise(F.col("flag"))
    flag = flags.put_if(~F.col("paired") & flags.has(flags.PAIRED), flags.MATE_UNMAPPED, flag)
    flag = flags.put_if(F.col("paired") & flags.has(flags.REVERSE, F.col("mate.flag")), flags.MATE_REVERSE, flag)
    same = F.col("mate.rname") == F.col("rname")
    repaired = joined.withColumns(
        {
            "flag": flag,
            "nh": F.col("nh").cast("int"),
            "rnext": F.when(~F.col("paired"), F.col("rnext")).when(same, "=").otherwise(F.col("mate.rname")),
            "pnext": F.when(F.col("paired"), F.col("mate.pos")).otherwise(F.col("pnext")),
        }
    ).drop("m1", "m2", "lo", "hi", "paired", "mate")
    out = stage_table(repaired)
    for done in [counts, *[given] * (given is not al)]:
        discard(done)
    return out


def filter_for_snp_calling(al: DataFrame) -> DataFrame:
    """Drop templates with several mappings, and pairs whose mates lie on different sequences."""
    # Read twice below, so it is computed once; a table staged before, as from ``fix_mates``, is not written again.
    al = stage_table(al)
    first = flags.lacks(flags.SECOND)
    per = al.groupBy(*TEMPLATE).agg(
        F.min("xi").alias("lo"),
        F.max("xi").alias("hi"),
        F.count_if(first).alias("n1"),
        F.count_if(~first).alias("n2"),
        F.bool_or(first & (F.col("rnext") != "=")).alias("apart"),
    )
    bad = per.filter("lo <> hi or (n1 = n2 and apart)").select(*TEMPLATE)
    return al.join(bad.hint("merge"), TEMPLATE, "left_anti")


def large_split_status(al: DataFrame, *, max_split: int, max_distance: int) -> DataFrame:
    """``status`` kept, split_too_long (for a pair: both mates) or mates_too_far per record."""
    positive("max_split", max_split)
    pair = F.col("rnext") == "="
    key = [F.least("pos", "pnext").alias("_lo"), F.greatest("pos", "pnext").alias("_hi")]
    on = ["sample", "qname", "_lo", "_hi"]
    long_gap = F.array_max(
        F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)N"), F.lit(1)), lambda g: g.cast("int"))
    )
    marked = al.select("*", *key, (F.coalesce(long_gap, F.lit(0)) > max_split).alias("_long"))
    mates = marked.filter(F.col("_long") & pair).select(*on).distinct().withColumn("_mate_long", F.lit(True))
    joined = marked.join(mates, on, "left")
    status = (
        F.when(F.col("_long") | (pair & F.coalesce("_mate_long", F.lit(False))), "split_too_long")
        .when(pair & (F.abs("tlen") > max_distance), "mates_too_far")
        .otherwise("kept")
    )
    return joined.withColumn("status", status).drop("_lo", "_hi", "_long", "_mate_long")


def discard_large_splits_and_pairs(al: DataFrame, *, max_split: int, max_distance: int) -> DataFrame:
    out = large_split_status(al, max_split=max_split, max_distance=max_distance)
    return out.filter("status = 'kept'").drop("status")


def large_split_report(al: DataFrame, *, max_split: int, max_distance: int) -> DataFrame:
    out = large_split_status(al, max_split=max_split, max_distance=max_distance)
    return out.groupBy("sample", "status").agg(F.count(F.lit(1)).alias("n"))


def first_n(keys: DataFrame, n: int, *, bucket: Sequence[str], order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by (``bucket``, ``order``) of each ``by`` group, exactly, without a global sort.

    Bucket sizes give the buckets wholly inside; only the bucket at the border is ranked.
    """
    positive("n", n)
    places = [c for c in bucket if c not in by]
    bucket = [*by, *places]
    sizes = keys.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_size"))
    sizes = sizes.withColumn("_upto", F.sum("_size").over(Window.partitionBy(*by).orderBy(*places)))
    inside = keys.join(sizes.filter(F.col("_upto") <= n).select(*bucket), list(bucket), "left_semi")
    edge = sizes.filter((F.col("_upto") > n) & (F.col("_upto") - F.col("_size") < n))
    ranked = keys.join(edge, list(bucket)).withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*bucket).orderBy(*order))
    )
    border = ranked.filter(F.col("_rank") <= n - (F.col("_upto") - F.col("_size"))).select(*keys.columns)
    return inside.unionByName(border)


def subset_mapped(al: DataFrame, *, n: int, paired: bool = False, bucket_size: int = 10000) -> DataFrame:
    """All mapped records of the first ``n`` templates of each sample in coordinate order."""
    mapped = filter_alignments(al, keep=flags.PAIRED | flags.PROPER if paired else 0, skip=flags.UNMAPPED)
    first = mapped.groupBy(*TEMPLATE).agg(F.min(F.struct("rname", "pos")).alias("at"))
    keys = first.select(
        *TEMPLATE, F.col("at.rname").alias("rname"), F.floor(F.col("at.pos") / bucket_size).alias("bin"), F.col("at.pos").alias("pos")
    )
    chosen = first_n(keys, n, bucket=["rname", "bin"], order=["pos", "qname"], by=["sample"])
    return mapped.join(chosen.select(*TEMPLATE), TEMPLATE, "left_semi")


def to_bed(al: DataFrame) -> DataFrame:
    """BED6 rows of mapped records; the name carries ``/1`` or ``/2`` for paired reads."""
    suffix = F.when(flags.has(flags.PAIRED), F.concat(F.lit("/"), flags.mate_number().cast("string"))).otherwise("")
    return al.filter(flags.lacks(flags.UNMAPPED)).select(
        "sample", "rname", cigar.start0().alias("start"), cigar.end0().alias("end"),
        F.concat("qname", suffix).alias("name"), F.col("mapq").cast("double").alias("score"), flags.strand().alias("strand"),
    )


def flip_mate2_strand(bed: DataFrame) -> DataFrame:
    """Names ending in 2 change strand: + to -, anything else to +."""
    turned = F.when(F.col("strand") == "+", "-").otherwise("+")
    return bed.withColumn("strand", F.when(F.col("name").endswith("2"), turned).otherwise(F.col("strand")))


def _in_windows(pairs: DataFrame, bin_size: int, distance: int, blacklist: DataFrame | None) -> DataFrame:
    """Records that overlap one of the windows of ``bin_size`` bases, ``distance`` apart from 0 on, that is free of blacklisted bases."""
    positive("bin_size", bin_size)
    if distance < 0:
        raise ValueError(f"distance must not be negative, not {distance!r}")
    step = bin_size + distance
    if distance == 0 and blacklist is None:
        return pairs

    def numbers(start: Column, end: Column) -> list[Column]:
        lowest = F.floor(start / step) + F.when(F.pmod(start, F.lit(step)) < bin_size, 0).otherwise(1)
        return [lowest.cast("int").alias("_first"), (F.floor((end - 1) / step) + 1).cast("int").alias("_behind")]

    placed = pairs.select("*", *numbers(cigar.start0(), cigar.end0())).filter("_first < _behind")
    if blacklist is None:
        return placed.drop("_first", "_behind")
    # Neighbouring spoilt windows are one run, so a record has no free window exactly if one run holds all of its windows.
    spoilt = blacklist.filter("start < end").select("rname", *numbers(F.col("start"), F.col("end"))).filter("_first < _behind")
    spoilt = merge_intervals(spoilt.select("rname", F.col("_first").alias("start"), F.col("_behind").alias("end")))
    ranges = placed.select("rname", F.col("_first").alias("start"), F.col("_behind").alias("end")).distinct()
    lost = overlap_join(ranges, spoilt.select("rname", "start", "end"), min_fraction=1.0).select(
        "rname", F.col("start").alias("_first"), F.col("end").alias("_behind")
    )
    return placed.join(lost, ["rname", "_first", "_behind"], "left_anti").drop("_first", "_behind")


def fragment_size(
    al: DataFrame, *, max_len: int = 0, bin_size: int = 1000, distance: int = 0, blacklist: DataFrame | None = None
) -> DataFrame:
    """Count, extremes, quartiles, mean and deviation of fragment lengths per sample.

    Proper pairs are used; a sample without any falls back to all pairs on one sequence. Records count once if they overlap a
    window of ``bin_size`` bases; windows lie ``distance`` bases apart (0: everywhere), and those that overlap an interval of ``blacklist``
    (rname, start, end) are left out.
    """
    pairs = al.filter(flags.has(flags.PAIRED) & flags.lacks(flags.SECONDARY) & (F.col("tlen") > 0))
    pairs = _in_windows(pairs, bin_size, distance, blacklist)
    if max_len > 0:
        pairs = pairs.filter(F.col("tlen") <= max_len)
    sizes = pairs.groupBy("sample", flags.has(flags.PROPER).alias("proper"), F.col("tlen").alias("size")).agg(
        F.count(F.lit(1)).alias("n")
    )
    stats = sizes.groupBy("sample", "proper").agg(
        F.sum("n").alias("fragments"),
        F.min("size").alias("min"),
        F.percentile("size", [0.25, 0.5, 0.75], F.col("n")).alias("qs"),
        F.max("size").alias("max"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"),
        (F.sum(F.col("size") * F.col("size") * F.col("n")) / F.sum("n")).alias("sq"),
    )
    best = stats.groupBy("sample").agg(F.max_by(F.struct(*stats.columns[1:]), "proper").alias("s")).select("sample", "s.*")
    return best.select(
        "sample", "proper", "fragments", "min", F.col("qs")[0].alias("q1"), F.col("qs")[1].alias("median"),
        F.col("qs")[2].alias("q3"), "max", "mean", F.sqrt(F.col("sq") - F.col("mean") * F.col("mean")).alias("sd"),
    )


def fragment_size_hist(
    al: DataFrame, *, width: int = 10, bin_size: int = 1000, distance: int = 0, blacklist: DataFrame | None = None
) -> DataFrame:
    """Proper pairs by fragment length, in classes of ``width``; windows and blacklist as for :func:`fragment_size`."""
    pairs = al.filter(flags.has(flags.PAIRED | flags.PROPER) & flags.lacks(flags.SECONDARY) & (F.col("tlen") > 0))
    pairs = _in_windows(pairs, bin_size, distance, blacklist)
    return pairs.groupBy("sample", (F.floor(F.col("tlen") / width) * width).alias("size")).agg(F.count(F.lit(1)).alias("n"))


def inner_distance(al: DataFrame, *, lower: int = -250, upper: int = 250, step: int = 5) -> DataFrame:
    """Histogram of the gap between mates (mate start - own end) seen from the left mate."""
    positive("step", step)
    left = al.filter(
        flags.has(flags.PAIRED) & flags.lacks(flags.SECONDARY) & (F.col("rnext") == "=") & (F.col("pos") <= F.col("pnext"))
        & (flags.has(flags.FIRST) | (F.col("pos") < F.col("pnext")))
    )
    gap = F.col("pnext") - 1 - cigar.end0()
    inside = left.withColumn("gap", gap).filter(F.col("gap").between(lower, upper - 1))
    bin_start = (F.floor((F.col("gap") - lower) / step) * step + lower).cast("int")
    return inside.groupBy("sample", bin_start.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
