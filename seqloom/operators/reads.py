"""Read-level projections, trimming and filters.

Row-wise operators are pure expressions: no shuffle, and they fuse into one stage when chained.
Pair rules ("drop both mates when either fails") collect only the failing keys and look them
up, so the reads themselves are shuffled only when the failing keys are too many to broadcast.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bases
from ..functions.joins import join_small
from ..functions.staging import evaluate_once
from ..options import choice, positive, require

PAIR = ("sample", "read_idx")


def drop_pairs(reads: DataFrame, bad: Column, *, paired: bool = True) -> DataFrame:
    """Drop rows where ``bad`` holds; with ``paired`` their mates too."""
    bad = F.coalesce(bad, F.lit(False))
    if not paired:
        return reads.filter(~bad)
    # Marked once: the rule and the sequence it reads would else be computed again in each filter. An anti join would be pushed
    # into every branch of the reads, with the failing keys computed once per branch.
    marked = evaluate_once(reads, _bad=bad)
    failing = marked.filter("_bad").select(*PAIR).distinct().withColumn("_failing", F.lit(True))
    return marked.filter("not _bad").join(failing, list(PAIR), "left").filter("_failing is null").select(*reads.columns)


def mate_join(r1: DataFrame, r2: DataFrame, *, how: str = "inner") -> DataFrame:
    """Pair two mate tables by position; columns get suffix 1 and 2."""
    a = r1.select(*PAIR, *[F.col(c).alias(c + "1") for c in ("qname", "seq", "qual") if c in r1.columns])
    b = r2.select(*PAIR, *[F.col(c).alias(c + "2") for c in ("qname", "seq", "qual") if c in r2.columns])
    return a.join(b, list(PAIR), how)


def pairs_of(reads: DataFrame) -> DataFrame:
    return mate_join(reads.filter("mate = 1"), reads.filter("mate = 2"))


def drop_empty_reads(reads: DataFrame, *, paired: bool = True) -> DataFrame:
    """Drop reads with an empty sequence line, and with ``paired`` their mates."""
    return drop_pairs(reads, F.length("seq") == 0, paired=paired)


def drop_empty_report(reads: DataFrame) -> DataFrame:
    """Rows read and written per sample and mate by :func:`drop_empty_reads`."""
    before = reads.groupBy("sample", "mate").agg(F.count(F.lit(1)).alias("rows_read"))
    after = drop_empty_reads(reads).groupBy("sample", "mate").agg(F.count(F.lit(1)).alias("rows_written"))
    return before.join(after, ["sample", "mate"], "left").na.fill(0, ["rows_written"])


def fix_qnames(df: DataFrame) -> DataFrame:
    """Keep the name up to its first blank."""
    return df.withColumn("qname", F.substring_index("qname", " ", 1))


def reverse_complement(df: DataFrame) -> DataFrame:
    return df.withColumns({"seq": bases.reverse_complement("seq"), "qual": F.reverse("qual")})


def quality_trim(df: DataFrame, *, cutoff: int, base: int = 33, both_ends: bool = False) -> DataFrame:
    """Cut the 3' end where the suffix sum of (quality - cutoff) is smallest and negative."""
    stop = F.length("qual") - _bad_tail(F.reverse(bases.scores("qual", base=base)), cutoff)
    if not both_ends:
        return bases.keep_span(df, F.lit(1), stop, costly=True)
    head = _bad_tail(bases.scores("qual", base=base), cutoff)
    return bases.keep_span(df, head + 1, stop - head, costly=True)


def _bad_tail(from_end: Column, cutoff: int) -> Column:
    """How many leading entries of ``from_end`` to remove."""
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("total"), F.lit(0).alias("low"), F.lit(0).alias("cut"))

    def step(acc: Column, q: Column) -> Column:
        total = acc["total"] + q - F.lit(cutoff)
        lower = total < acc["low"]
        return F.struct(
            (acc["i"] + 1).alias("i"),
            total.alias("total"),
            F.when(lower, total).otherwise(acc["low"]).alias("low"),
            F.when(lower, acc["i"] + 1).otherwise(acc["cut"]).alias("cut"),
        )

    return F.aggregate(from_end, zero, step, lambda acc: acc["cut"])


def cut(df: DataFrame, n: int) -> DataFrame:
    """Remove ``n`` bases from the start, or ``-n`` from the end when negative."""
    size = F.length("seq")
    if n >= 0:
        return bases.keep_span(df, F.lit(n + 1), size - n)
    return bases.keep_span(df, F.lit(1), size + n)


def filter_length(
    df: DataFrame, *, min_len: int | None = None, max_len: int | None = None, paired: bool = False
) -> DataFrame:
    if min_len is None and max_len is None:
        raise ValueError("give min_len or max_len")
    n = F.length("seq")
    bad = F.lit(False)
    if min_len is not None:
        bad = bad | (n < min_len)
    if max_len is not None:
        bad = bad | (n > max_len)
    return drop_pairs(df, bad, paired=paired)


def trim_terminal(df: DataFrame, *, ns: bool = True, min_quality: int | None = None, base: int = 33) -> DataFrame:
    """Strip N and/or bases of quality at most ``min_quality`` from both ends."""
    if not ns and min_quality is None:
        raise ValueError("nothing to trim: give ns=True or min_quality")
    # A mask string with x for every base to strip makes both ends one pattern match.
    if min_quality is None:
        mask = F.translate("seq", "Nnx", "xx_")
    else:
        low = "".join(chr(c) for c in range(33, base + min_quality + 1))
        mask = F.translate(F.translate("qual", "x", "_") if "x" not in low else F.col("qual"), low, "x" * len(low))
        if ns:
            pairs = F.arrays_zip(bases.letters("seq").alias("s"), bases.letters(mask).alias("q"))
            mask = F.array_join(
                F.transform(pairs, lambda p: F.when(p["s"].isin("N", "n"), F.lit("x")).otherwise(p["q"])), ""
            )
    lead = F.length(F.regexp_extract(mask, "^(x*)", 1))
    rest = F.length(F.rtrim(F.translate(F.translate(mask, " ", "_"), "x", " ")))
    return bases.keep_span(df, lead + 1, rest - lead, costly=True)


def filter_max_n(df: DataFrame, *, max_n: int, paired: bool = False) -> DataFrame:
    """Discard reads with more than ``max_n`` N; with ``paired`` either mate removes the pair."""
    count = F.length("seq") - F.length(F.regexp_replace("seq", "[Nn]", ""))
    return drop_pairs(df, count > max_n, paired=paired)


def filter_n_ends(df: DataFrame, *, n: int = 10) -> DataFrame:
    """No reads that start or end with at least ``n`` N."""
    positive("n", n)
    run = "N" * n
    return df.filter(~F.col("seq").startswith(run) & ~F.col("seq").endswith(run))


def rename_reads(
    df: DataFrame, *, prefix: str = "", suffix: str = "", strip_suffix: str | None = None, length_tag: str | None = None
) -> DataFrame:
    """Edit names; ``length_tag`` (such as ``length=``) gets the present read length."""
    name = F.col("qname")
    if strip_suffix:
        name = F.when(
            name.endswith(strip_suffix), F.substr(name, F.lit(1), F.length(name) - len(strip_suffix))
        ).otherwise(name)
    name = F.concat(F.lit(prefix), name, F.lit(suffix))
    if length_tag:
        import re

        name = F.regexp_replace(
            name, F.lit(re.escape(length_tag) + r"[0-9]*"), F.concat(F.lit(length_tag), F.length("seq").cast("string"))
        )
    return df.withColumn("qname", name)


def recode_quality(df: DataFrame, *, source: int = 64, target: int = 33) -> DataFrame:
    """Move the quality base; characters below the source base become the target base."""
    for b in (source, target):
        choice("quality base", b, (33, 64))
    top = 126 - max(source, target)
    old = "".join(chr(source + q) for q in range(top + 1))
    new = "".join(chr(target + q) for q in range(top + 1))
    below = "".join(chr(c) for c in range(33, source))
    return df.withColumn("qual", F.translate("qual", below + old, new[0] * len(below) + new))


def zero_cap_quality(df: DataFrame, *, base: int = 33) -> DataFrame:
    """Negative qualities become 0."""
    below = "".join(chr(c) for c in range(32, base))
    return df.withColumn("qual", F.translate("qual", below, chr(base) * len(below)))


def filter_spots(
    df: DataFrame,
    *,
    min_id: int | None = None,
    max_id: int | None = None,
    groups: Sequence[str] | None = None,
    read_filter: str | None = None,
    aligned: bool | None = None,
    region: tuple[str, int, int] | None = None,
    mate_distance: tuple[int, int] | str | None = None,
    clip: bool = False,
) -> DataFrame:
    """Spot range, spot groups, read filter, alignment state, region and mate distance filters.

    ``clip`` takes ``clip_left`` bases off the start and ``clip_right`` off the end of sequence and qualities (null: none).
    """
    keep = F.lit(True)
    if min_id is not None:
        keep = keep & (F.col("spot_id") >= min_id)
    if max_id is not None:
        keep = keep & (F.col("spot_id") <= max_id)
    if groups is not None:
        keep = keep & F.col("spot_group").isin(*groups)
    if read_filter is not None:
        choice("read_filter", read_filter, ("pass", "reject", "criteria", "redacted"))
        keep = keep & (F.col("read_filter") == read_filter)
    if aligned is not None:
        keep = keep & (F.col("rname").isNotNull() if aligned else F.col("rname").isNull())
    if region is not None:
        rname, start, end = region
        keep = keep & (F.col("rname") == rname) & (F.col("pos") > start) & (F.col("pos") <= end)
    if mate_distance == "unknown":
        keep = keep & F.col("mate_distance").isNull()
    elif mate_distance is not None:
        keep = keep & F.col("mate_distance").between(*mate_distance)
    out = df.filter(keep)
    if clip:
        left, right = F.coalesce("clip_left", F.lit(0)), F.coalesce("clip_right", F.lit(0))
        rest = F.greatest(F.length("seq") - left - right, F.lit(0))
        out = out.withColumns({c: F.substr(c, left + 1, rest) for c in ("seq", "qual") if c in df.columns})
    return out


def _order_key(seed: int, columns: Sequence[str]) -> Column:
    """60 pseudo-random bits of a row key; equal on every retry and engine."""
    digest = F.md5(F.concat_ws("_", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sample_reads(
    reads: DataFrame,
    *,
    n: int | None = None,
    fraction: float | None = None,
    seed: int = 11,
    replace: bool = False,
    complement: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Sample ``n`` (default 1000) or a ``fraction`` of the pairs of each sample; mates stay together.

    The pairs with the smallest hash of (seed, read_idx) are taken; with ``replace`` that hash says how often a pair is drawn. The cut-off for an exact ``n``
    comes from a histogram of hash prefixes, and only the one prefix bucket holding the n-th
    pair is ordered, so no task or driver sees the whole sample.
    """
    if n is not None and fraction is not None:
        raise ValueError("n and fraction exclude each other")
    if replace:
        if fraction is None or complement:
            raise ValueError("replace needs a fraction and has no complement")
        if fraction < 0:
            raise ValueError("fraction must not be negative")
        # Every pair is drawn a Poisson number of times, by where its hash falls among the cumulative chances.
        chances, term = [], math.exp(-fraction)
        while len(chances) <= fraction or (term > 2**-62 and len(chances) < fraction + 200):
            chances.append((chances[-1] if chances else 0.0) + term)
            term *= fraction / len(chances)
        place = _order_key(seed, ["read_idx"]) / float(2**60)
        copies = F.size(F.filter(F.array(*map(F.lit, chances)), lambda c: place >= c))
        return reads.withColumn("_copies", copies).filter("_copies > 0").select(*reads.columns, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")).drop("_copy")
    key = _order_key(seed, ["read_idx"])
    if fraction is not None:
        if not 0 <= fraction <= 1:
            raise ValueError("fraction must lie in 0..1")
        limit = int(fraction * 2**60)
        return reads.filter(key >= limit if complement else key < limit)
    n = 1000 if n is None else n
    positive("n", n)
    keyed = reads.withColumn("_h", F.struct(key.alias("h"), F.col("read_idx").alias("i")))
    pairs = keyed.select("sample", "_h").distinct().withColumn("bucket", F.shiftright(F.col("_h.h"), 44))
    sizes = pairs.groupBy("sample", "bucket").agg(F.count(F.lit(1)).alias("size"))
    by_bucket = Window.partitionBy("sample").orderBy("bucket")
    sizes = sizes.withColumns(
        {"upto": F.sum("size").over(by_bucket), "all": F.sum("size").over(Window.partitionBy("sample"))}
    )
    goal = F.least(F.lit(n).cast("bigint"), F.col("all"))
    if strict:
        short = F.concat(F.lit("fewer records than asked for in sample "), F.col("sample"))
        goal = F.when(F.col("all") < n, F.raise_error(short).cast("bigint")).otherwise(goal)
    edge = sizes.withColumn("goal", goal).filter("upto >= goal and upto - size < goal")
    ranked = pairs.join(edge, ["sample", "bucket"]).withColumn(
        "rank", F.row_number().over(Window.partitionBy("sample", "bucket").orderBy("_h"))
    )
    cut_off = ranked.filter("rank = goal - (upto - size)").select("sample", F.col("_h").alias("_cut"))
    joined = join_small(keyed, cut_off, "sample")
    keep = F.col("_h") > F.col("_cut") if complement else F.col("_h") <= F.col("_cut")
    return joined.filter(keep).drop("_h", "_cut")


def split_reads(reads: DataFrame, *, n_per_chunk: int, first: int = 0) -> DataFrame:
    """Number chunks of ``n_per_chunk`` records from 1; ``first`` is the first ``read_idx``."""
    positive("n_per_chunk", n_per_chunk)
    return reads.withColumn("chunk", F.floor((F.col("read_idx") - first) / n_per_chunk).cast("bigint") + 1)


def concat_reads(parts: Sequence[DataFrame], *, all_runs: bool = False) -> DataFrame:
    """Concatenate in the given order per sample and mate; ``read_idx`` continues over the parts.

    Offsets come from one row per part, sample and mate, so nothing is sorted globally.
    """
    if not parts:
        raise ValueError("no tables to concatenate")
    tagged = [p.withColumn("file_ord", F.lit(i)) for i, p in enumerate(parts)]
    merged = reduce(DataFrame.unionByName, tagged)
    if all_runs:
        merged = merged.withColumn("sample", F.lit("all_runs"))
    extent = merged.groupBy("sample", "mate", "file_ord").agg((F.max("read_idx") + 1).alias("extent"))
    before = Window.partitionBy("sample", "mate").orderBy("file_ord").rowsBetween(Window.unboundedPreceding, -1)
    offsets = extent.withColumn("offset", F.coalesce(F.sum("extent").over(before), F.lit(0))).drop("extent")
    joined = join_small(merged, offsets, ["sample", "mate", "file_ord"])
    return joined.withColumn("read_idx", F.col("read_idx") + F.col("offset")).drop("offset", "file_ord")


def concat_listing(files: DataFrame) -> DataFrame:
    """Source files per sample in order, from a table (sample, file_ord, path)."""
    require(files, "sample", "file_ord", "path")
    ordered = F.sort_array(F.collect_set(F.struct("file_ord", "path")))
    return files.groupBy("sample").agg(
        F.count_distinct("path").alias("n_files"), F.array_join(F.transform(ordered, lambda f: f["path"]), ",").alias("files")
    )


def trim_recipe(df: DataFrame, steps: Sequence[tuple[str, dict]]) -> DataFrame:
    """Apply named trimming commands in order."""
    from .adapters import clip_adapter, discard_trimmed, discard_untrimmed

    known = {
        "quality_trim": quality_trim, "cut": cut, "filter_length": filter_length, "trim_terminal": trim_terminal,
        "filter_max_n": filter_max_n, "filter_n_ends": filter_n_ends, "recode_quality": recode_quality,
        "zero_cap_quality": zero_cap_quality, "clip_adapter": clip_adapter, "rename_reads": rename_reads,
        "discard_trimmed": discard_trimmed, "discard_untrimmed": discard_untrimmed,
    }
    for name, _ in steps:
        choice("trimming command", name, known)
    return reduce(lambda d, s: known[s[0]](d, **s[1]), steps, df)
