"""Counting reads on features, and read distribution over a gene model.

All operators collapse records with the same placement into one row with a multiplicity before the range join: a locus
holding a third of all reads is a handful of rows there. Set questions ("which genes cover every base of the read?")
are answered by comparing covered base counts, so no set of genes is ever collected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import cigar, flags
from ..functions.staging import stage
from ..functions.stats import exact_medians
from ..options import choice, positive
from .intervals import merge_intervals, overlap_join, partners, running_at, with_samples
from .templates import placed_units, template_totals, unit_digest

PLACE = ["rname", "pos", "cigar", "strand"]
#: Different placements in one bin of the range join beyond which the bin is split over more tasks.
HOT_ROWS = 100_000
#: Targets over a base, on average, beyond which the units' targets are told by running sums and no longer by pairs.
CROWDED = 16


def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def _blocks(places: DataFrame) -> DataFrame:
    return places.select("*", F.inline(cigar.blocks()))


# Reasons in the order in which they are given.
REASONS = (
    "Unassigned_Unmapped", "Unassigned_Singleton", "Unassigned_MappingQuality", "Unassigned_Chimera", "Unassigned_FragmentLength",
    "Unassigned_Duplicate", "Unassigned_Secondary", "Unassigned_MultiMapping", "Unassigned_NonSplit",
)


def _first_reason() -> Column:
    """Of a fragment's records, the reason that comes first in the order of the rules."""
    ranked = F.struct(F.array_position(F.array(*map(F.lit, REASONS)), F.col("why")).alias("rank"), "why")
    return F.min(F.when(F.col("why").isNotNull(), ranked))["why"]


def _read_status(
    *, multi: bool, primary: bool, min_mapq: int, ignore_dup: bool, split_only: bool, both_mapped: bool, no_chimeras: bool,
    fragment: tuple[int, int] | None,
) -> Column:
    """Why a record is not counted; NULL when it is. The first reason in this order holds."""
    status = F.when(flags.has(flags.UNMAPPED), "Unassigned_Unmapped")
    if both_mapped:
        status = status.when(flags.has(flags.MATE_UNMAPPED), "Unassigned_Singleton")
    status = status.when(F.col("mapq") < min_mapq, "Unassigned_MappingQuality")
    if no_chimeras:
        apart = ~F.col("rnext").isin("=", "*") & (F.col("rnext") != F.col("rname"))
        status = status.when(apart, "Unassigned_Chimera")
    if fragment is not None:
        status = status.when(~F.abs("tlen").between(*fragment), "Unassigned_FragmentLength")
    if ignore_dup:
        status = status.when(flags.has(flags.DUPLICATE), "Unassigned_Duplicate")
    if primary:
        status = status.when(flags.has(flags.SECONDARY), "Unassigned_Secondary")
    elif not multi:
        status = status.when(F.col("nh") > 1, "Unassigned_MultiMapping")
    if split_only:
        status = status.when(~F.contains("cigar", F.lit("N")), "Unassigned_NonSplit")
    return status


def _effective_strand(strand: Column) -> Column:
    """Strand of the sequenced fragment: mate 2 reads the other one."""
    turned = F.when(strand == "+", "-").otherwise("+")
    return F.when(flags.has(flags.PAIRED | flags.SECOND), turned).otherwise(strand)


def _touch(unit: DataFrame, ext5: int, ext3: int, read_to: int | None) -> DataFrame:
    """Blocks of each unit, extended outwards at the read's ends or cut to its 5' or 3' base."""
    out = _blocks(unit)
    if read_to is not None:
        plus = F.col("read_strand") == "+"
        first = cigar.start0()
        last = cigar.end0() - 1
        at = F.when(plus == F.lit(read_to == 5), first).otherwise(last)
        return unit.select("*", at.alias("start"), (at + 1).alias("end"))
    if ext5 or ext3:
        plus = F.col("read_strand") == "+"
        before = F.when(plus, F.lit(ext5)).otherwise(F.lit(ext3))
        after = F.when(plus, F.lit(ext3)).otherwise(F.lit(ext5))
        start = F.when(F.col("start") == cigar.start0(), F.greatest(F.col("start") - before, F.lit(0))).otherwise(F.col("start"))
        end = F.when(F.col("end") == cigar.end0(), F.col("end") + after).otherwise(F.col("end"))
        out = out.withColumns({"_s": start, "_e": end}).drop("start", "end").withColumnsRenamed({"_s": "start", "_e": "end"})
    return out


def assign_units(
    al: DataFrame,
    features: DataFrame,
    *,
    feature: str = "exon",
    group: str = "gene_id",
    per_feature: bool = False,
    strandness: int = 0,
    multi: bool = False,
    min_mapq: int = 0,
    primary: bool = False,
    ext5: int = 0,
    ext3: int = 0,
    min_overlap: int = 1,
    split_only: bool = False,
    read_to: int | None = None,
    ignore_dup: bool = False,
    fragments: bool = False,
    check_length: bool = False,
    min_fragment: int = 50,
    max_fragment: int = 600,
    both_mapped: bool = False,
    no_chimeras: bool = False,
    aliases: Mapping[str, str] | None = None,
    bin_size: int = 4096,
    sole: bool = False,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """(counting units with ``n`` and ``why`` they are left out; hits per unit and target with ``n``; unit key columns).

    With ``sole`` the hits are one row per unit: ``n_targets`` (more than one: 2 or their number), ``n``, and the ``target`` of a unit with one.
    """
    choice("strandness", strandness, (0, 1, 2))
    choice("read_to", read_to, (None, 5, 3))
    if aliases:
        names = F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv])
        al = al.withColumn("rname", F.coalesce(F.element_at(names, F.col("rname")), F.col("rname")))
    why = _read_status(
        multi=multi, primary=primary, min_mapq=min_mapq, ignore_dup=ignore_dup, split_only=split_only, both_mapped=both_mapped,
        no_chimeras=no_chimeras, fragment=(min_fragment, max_fragment) if check_length else None,
    )
    marked = al.select(
        "sample", "qname", "rname", "pos", "cigar", "pnext", "rnext", "flag", why.alias("why"), flags.strand().alias("read_strand"),
        _effective_strand(flags.strand()).alias("strand"),
    )
    if fragments:
        # A fragment is a read pair at one place; a mate that is filtered out takes the fragment with it.
        same = F.col("rnext") == "="
        lo, hi = F.least("pos", "pnext"), F.greatest("pos", "pnext")
        marked = marked.withColumns(
            {"first": F.when(same, lo).otherwise(F.col("pos")), "second": F.when(same, hi).otherwise(F.col("pos"))}
        )
        units, good = placed_units(
            marked, key=["sample", "qname", "first", "second"], place=[*PLACE, "read_strand"], why=_first_reason(), used=F.lit(True), length=F.lit(0)
        )
        key = ["sample", "unit"]
    else:
        key = ["sample", "rname", "pos", "cigar", "strand", "read_strand", "why"]
        units = marked.groupBy(*key).agg(_n())
        good = units.filter("why is null")
        key = key[:-1]
    wanted = features.filter(F.col("feature") == feature) if "feature" in features.columns else features
    if per_feature:
        target = F.concat_ws(":", "rname", "start", "end", "strand")
    else:
        target = F.col(group)
    side = wanted.select("rname", "start", "end", "strand", target.alias("target"))
    if not per_feature:
        # Overlapping features of one target become one interval: fewer pairs, and every base counts once.
        side = _merged(side, ["rname", "strand", "target"])
    how = {0: "no", 1: "same", 2: "opposite"}[strandness]
    # A negative minimum lets a read lie that far from its target.
    touched = _touch(good, ext5, ext3, read_to)
    if sole and min_overlap == 1 and _crowded(side):
        return units, _sole_targets(touched, side, how, key), key
    hits = overlap_join(touched, side, stranded=how, min_overlap=min(min_overlap, 1), bin_size=bin_size, hot_rows=HOT_ROWS)
    shared = F.sum(F.greatest("overlap", F.lit(0))).alias("bases")
    per = hits.groupBy(*key, F.col("r_target").alias("target")).agg(shared, F.max("n").alias("n"))
    per = per.filter(F.col("bases") >= min_overlap)
    return units, _targets(per, key) if sole else per, key


def _targets(hits: DataFrame, key: list[str]) -> DataFrame:
    return hits.groupBy(*key).agg(F.count(F.lit(1)).alias("n_targets"), F.min("target").alias("target"), F.max("n").alias("n"))


def _crowded(side: DataFrame) -> bool:
    """Whether many targets lie over a base of the covered ones, on average (one job over the targets)."""
    size = F.sum((F.col("end") - F.col("start")).cast("double")).alias("size")
    real = side.filter("end > start")
    given = real.agg(size).first()["size"] or 0.0
    covered = merge_intervals(real.select("rname", "start", "end")).agg(size).first()["size"] or 1.0
    return given > CROWDED * covered


def _sole_targets(touched: DataFrame, side: DataFrame, how: str, key: list[str]) -> DataFrame:
    """Per unit whether it meets one target, and which, from running sums of two 31-bit halves of the targets' hashes.

    Numbers are all equal where their count times the sum of their squares is the square of their sum. Only targets with the same 62 bits would be taken for one.
    """
    digest = F.xxhash64("target")
    halves = {"x": digest.bitwiseAND(0x7FFFFFFF), "y": F.shiftrightunsigned(digest, 33)}
    side = side.withColumns(halves)
    wide = {c: F.col(c).cast("decimal(10,0)") for c in halves}
    sums = {**wide, **{f"{c}2": w * w for c, w in wide.items()}}
    rows = touched.select(*dict.fromkeys([*key, "rname", "strand", "start", "end"]), F.col("n").alias("units"))
    met = partners(rows, side, stranded=how, sums=sums, shared=False).filter("n > 0")
    per = met.groupBy(*key).agg(F.sum("n").cast("decimal(18,0)").alias("hits"), *[F.sum(s).cast("decimal(38,0)").alias(s) for s in sums], F.max("units").alias("n"))
    alone = F.lit(True)
    for c in halves:
        alone = alone & (F.col("hits") * F.col(f"{c}2") == F.col(c) * F.col(c))
    # A unit of several targets gets numbers that no target has, spread over the tasks.
    none = -1 - F.pmod(F.xxhash64(*key), F.lit(100_000))
    told = per.select(*key, "n", alone.alias("alone"), *[(F.col(c) / F.col("hits")).cast("bigint").alias(c) for c in halves])
    told = told.withColumns({c: F.when(F.col("alone"), F.col(c)).otherwise(none) for c in halves})
    names = side.groupBy(*halves).agg(F.min("target").alias("target"))
    return told.join(names, list(halves), "left").select(*key, F.when(F.col("alone"), 1).otherwise(2).cast("bigint").alias("n_targets"), "target", "n")


def _unit_status(units: DataFrame, found: DataFrame, key: list[str], multi_overlap: bool) -> DataFrame:
    out = units.join(found.drop("n"), key, "left")
    status = F.coalesce(
        F.col("why"),
        F.when(F.col("n_targets").isNull(), "Unassigned_NoFeatures")
        .when((F.col("n_targets") > 1) & F.lit(not multi_overlap), "Unassigned_Ambiguity")
        .otherwise("Assigned"),
    )
    return out.withColumn("status", status)


def feature_counts(al: DataFrame, features: DataFrame, *, samples: Sequence[str], multi_overlap: bool = False, **opts) -> DataFrame:
    """Reads (or fragments) per target and sample, zero rows included.

    A unit on several targets counts for none, or with ``multi_overlap`` for all of them.
    """
    _, hits, key = assign_units(al, features, sole=not multi_overlap, **opts)
    # The hits carry the multiplicity, so counting never joins back to the units.
    if not multi_overlap:
        hits = hits.filter("n_targets = 1")
    counted = hits.groupBy("sample", "target").agg(F.sum("n").alias("n"))
    wanted = features.filter(F.col("feature") == opts.get("feature", "exon")) if "feature" in features.columns else features
    if opts.get("per_feature"):
        name = F.concat_ws(":", "rname", "start", "end", "strand")
    else:
        name = F.col(opts.get("group", "gene_id"))
    every = with_samples(wanted.select(name.alias("target")).distinct(), samples)
    return every.join(counted, ["sample", "target"], "left").na.fill(0, ["n"])


def assignment_summary(al: DataFrame, features: DataFrame, *, multi_overlap: bool = False, **opts) -> DataFrame:
    """Units per sample and assignment status."""
    units, hits, key = assign_units(al, features, sole=not multi_overlap, **opts)
    done = _unit_status(units, _targets(hits, key) if multi_overlap else hits, key, multi_overlap)
    return done.groupBy("sample", "status").agg(F.sum("n").alias("n"))


def read_assignments(al: DataFrame, features: DataFrame, *, multi_overlap: bool = False, **opts) -> DataFrame:
    """Per record: name, status, number of targets and the (smallest) target name; single-read units only."""
    if opts.get("fragments"):
        raise ValueError("read_assignments works on single reads")
    _, found, key = assign_units(al, features, sole=not multi_overlap, **opts)
    found = (_targets(found, key) if multi_overlap else found).drop("n")
    names = ("multi", "primary", "min_mapq", "ignore_dup", "split_only", "both_mapped", "no_chimeras")
    defaults = {n: 0 if n == "min_mapq" else False for n in names}
    why = _read_status(
        **{n: opts.get(n, d) for n, d in defaults.items()},
        fragment=(opts.get("min_fragment", 50), opts.get("max_fragment", 600)) if opts.get("check_length") else None,
    )
    reads = al.select("*", why.alias("why"), flags.strand().alias("read_strand"), _effective_strand(flags.strand()).alias("strand"))
    out = reads.join(found, key, "left")
    status = F.coalesce(
        F.col("why"),
        F.when(F.col("n_targets").isNull(), "Unassigned_NoFeatures")
        .when((F.col("n_targets") > 1) & F.lit(not multi_overlap), "Unassigned_Ambiguity")
        .otherwise("Assigned"),
    )
    on = status == "Assigned"
    return out.select(
        *al.columns, status.alias("status"), F.when(on, F.col("n_targets")).otherwise(0).alias("n_targets"),
        F.when(on, F.col("target")).alias("target"),
    )


def _merged(features: DataFrame, by: list[str]) -> DataFrame:
    return merge_intervals(features.select(*by, "start", "end"), by=by).drop("n")


def _kinds(df: DataFrame, *kinds: tuple[object, Column, Column, Column | None]) -> DataFrame:
    """(rname, kind, start, end) of several derived intervals per row; the table is read once for all kinds."""
    rows = [
        F.when(F.lit(True) if when is None else when, F.struct(F.lit(k).alias("kind"), start.cast("int").alias("start"), end.cast("int").alias("end")))
        for k, start, end, when in kinds
    ]
    return df.select("rname", F.inline(F.filter(F.array(*rows), lambda r: r.isNotNull()))).filter("end > start")


def _model_spans(exons: DataFrame) -> DataFrame:
    return exons.groupBy("rname", "transcript_id", "strand").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def _coding(kind: object) -> tuple[object, Column, Column, None]:
    return kind, F.greatest("start", "cds_start"), F.least("end", "cds_end"), None


def _template_reason(aligned: Column, many: Column, low: Column) -> Column:
    return F.when(~aligned, "__not_aligned").when(many, "__alignment_not_unique").when(low, "__too_low_aQual")


def htseq_count(
    al: DataFrame,
    features: DataFrame,
    *,
    samples: Sequence[str],
    mode: str = "union",
    stranded: str = "yes",
    min_qual: int = 10,
    feature: str = "exon",
    id_attr: str = "gene_id",
    bin_size: int = 4096,
) -> DataFrame:
    """Templates per gene and sample plus special rows, by the set rules union, intersection-strict or intersection-nonempty.

    The paired records of one ``sample``, ``qname`` and, where that column exists, ``hit`` (the number of the alignment among those of its template) are
    one template: mates count once, and mates on two genes are ambiguous. An unpaired record is a template of its own. Secondary
    records are skipped; a template without an aligned record is not aligned; one aligned record with several hits or a low quality
    makes the template not unique or of low quality, in this order.

    With c(g) the aligned bases of all records covered by gene g, c(*) those covered by any gene and L all aligned bases,
    the set is: union c(g) > 0; strict c(g) = L; nonempty c(g) = c(*) > 0. Bases under both mates count twice on both sides, which changes no answer.
    """
    choice("mode", mode, ("union", "intersection-strict", "intersection-nonempty"))
    choice("stranded", stranded, ("yes", "no", "reverse"))
    aligned = ~flags.has(flags.UNMAPPED)
    many, low = F.col("nh") > 1, F.col("mapq") < min_qual
    size = F.aggregate(F.transform(cigar.blocks(), lambda b: b["end"] - b["start"]), F.lit(0), lambda a, x: a + x)
    template = ["sample", "qname", *(["hit"] if "hit" in al.columns else [])]
    records = al.filter(~flags.has(flags.SECONDARY)).select(
        *template, "rname", "pos", "cigar", _effective_strand(flags.strand()).alias("strand"), aligned.alias("aligned"),
        flags.has(flags.PAIRED).alias("paired"), F.coalesce(aligned & many, F.lit(False)).alias("many"), F.coalesce(aligned & low, F.lit(False)).alias("low"),
    )
    reason = _template_reason(F.bool_or("aligned"), F.bool_or("many"), F.bool_or("low"))
    _, good = placed_units(records.filter("paired"), key=template, place=PLACE, why=reason, used=F.col("aligned"), length=size)
    alone = records.filter("not paired").select("sample", _template_reason(F.col("aligned"), F.col("many"), F.col("low")).alias("why"), F.struct(*PLACE).alias("lo"))
    totals = template_totals(records.filter("paired"), key=template, why=reason).unionByName(alone.groupBy("sample", "why").agg(_n()))
    alone = alone.filter("why is null").groupBy("sample", "lo").agg(_n())
    alone = alone.select("sample", unit_digest("lo").alias("unit"), "n", "lo.*").withColumn("length", size.cast("bigint"))
    good = good.unionByName(alone.select(*good.columns))
    wanted = features.filter(F.col("feature") == feature) if "feature" in features.columns else features
    wanted = wanted.withColumn("gene", F.col(id_attr))
    if stranded == "no":
        # One strand for all: opposite genes then compete for the same bases.
        wanted = wanted.withColumn("strand", F.lit("."))
    # Genes travel as 64-bit digests; only one mode asks for the intervals of all genes together.
    named = wanted.filter("gene <> ''").withColumns({"id": F.xxhash64("gene"), "whole": F.lit(False)})
    side = named if mode != "intersection-nonempty" else named.unionByName(wanted.withColumns({"id": F.lit(0).cast("bigint"), "whole": F.lit(True)}))
    side = _merged(side, ["rname", "strand", "id", "whole"])
    how = {"yes": "same", "no": "no", "reverse": "opposite"}[stranded]
    blocks = _blocks(good).select("sample", "unit", "length", "n", "rname", "strand", "start", "end")
    hits = overlap_join(blocks, side, stranded=how, bin_size=bin_size, hot_rows=HOT_ROWS)
    key = ["sample", "unit"]
    kept = [F.max("length").alias("length"), F.max("n").alias("n")]
    if mode == "union":
        # Ambiguous where two of the genes met differ, so no unit is grouped by gene.
        best = hits.groupBy(*key).agg(F.min("r_id").alias("id"), F.max("r_id").alias("other"), F.max("n").alias("n"))
        best = best.withColumn("k", F.when(F.col("id") == F.col("other"), 1).otherwise(2))
    else:
        covered = hits.groupBy(*key, F.col("r_id").alias("id"), F.col("r_whole").alias("whole")).agg(F.sum("overlap").alias("c"), *kept)
        if mode == "intersection-strict":
            full = F.when(F.col("c") == F.col("length"), F.col("id"))
            best = covered.groupBy(*key).agg(F.count(full).alias("k"), F.max(full).alias("id"), F.max("c").alias("top"), *kept)
            best = best.filter("top = length")
        else:
            gene = F.when(~F.col("whole"), F.col("id"))
            level = covered.groupBy(*key, "c").agg(F.count(gene).alias("k"), F.max(gene).alias("id"), F.bool_or("whole").alias("any"), F.max("n").alias("n"))
            same = F.col("any") & (F.col("k") > 0)
            best = level.groupBy(*key).agg(
                F.max(F.when(F.col("k") > 0, F.col("c"))).alias("top"), F.max(F.when(F.col("any"), F.col("c"))).alias("c_any"),
                F.max(F.when(same, F.col("k"))).alias("k"), F.max(F.when(same, F.col("id"))).alias("id"), F.max("n").alias("n"),
            )
            best = best.filter("top = c_any")
    found = best.groupBy("sample", F.when(F.col("k") == 1, F.col("id")).alias("id")).agg(F.sum("n").alias("n"))
    found = found.join(named.groupBy("id").agg(F.min("gene").alias("gene")), "id", "left")
    found = found.select("sample", F.when(F.col("id").isNull(), "__ambiguous").otherwise(F.col("gene")).alias("gene"), "n")
    # Templates that met no gene at all are the rest of the sample: every counted one is taken off the total.
    none = F.lit("__no_feature")
    moved = F.array(F.struct("gene", "n"), F.struct(none.alias("gene"), (-F.col("n")).alias("n")))
    placed = found.filter("gene <> '__no_feature'").select("sample", F.inline(moved))
    counted = placed.unionByName(totals.select("sample", F.coalesce("why", none).alias("gene"), "n")).groupBy("sample", "gene").agg(F.sum("n").alias("n"))
    special = ["__no_feature", "__ambiguous", "__too_low_aQual", "__not_aligned", "__alignment_not_unique"]
    names = wanted.select("gene").distinct()
    every = with_samples(names, samples).unionByName(
        with_samples(names.agg(F.max("gene").alias("gene")).select(F.explode(F.array(*[F.lit(s) for s in special])).alias("gene")), samples)
    )
    return every.join(counted, ["sample", "gene"], "left").na.fill(0, ["n"])


def rna_metrics(
    al: DataFrame,
    exons: DataFrame,
    *,
    rrna: DataFrame | None = None,
    rrna_fraction: float = 0.8,
    levels: Sequence[str] = ("sample",),
    stranded: str = "first",
    bin_size: int = 4096,
) -> DataFrame:
    """Bases by class with fractions, and strand agreement; one row per ``levels`` value and one over everything.

    ``exons`` (rname, start, end, strand, transcript_id, cds_start, cds_end) is the flattened transcript model.
    Coding outranks UTR, UTR intron, intron intergenic. A read with at least ``rrna_fraction`` of its bases in
    ``rrna`` intervals is ribosomal as a whole.
    """
    choice("stranded", stranded, ("first", "second"))
    levels = list(levels)
    strand = _effective_strand(flags.strand())
    if stranded == "second":
        strand = F.when(strand == "+", "-").otherwise("+")
    usable = al.filter(flags.lacks(flags.UNMAPPED | flags.SECONDARY | flags.QC_FAIL))
    extra = [c for c in levels if c not in ("sample",)]
    key = ["sample", *extra, "rname", "pos", "cigar", "strand"]
    places = usable.groupBy("sample", *extra, "rname", "pos", "cigar", strand.alias("strand")).agg(_n())
    start, end, plus = F.col("start"), F.col("end"), F.col("strand") == "+"
    side = _kinds(exons, _coding("coding"), ("exon", start, end, None)).unionByName(
        _kinds(_model_spans(exons), ("body", start, end, None), ("plus", start, end, plus), ("minus", start, end, F.col("strand") == "-"))
    )
    if rrna is not None:
        side = side.unionByName(_kinds(rrna, ("ribo", start, end, None)))
    side = _merged(side, ["rname", "kind"])
    hits = overlap_join(_blocks(places), side, bin_size=bin_size)
    sums = [
        F.sum(F.when(F.col("r_kind") == k, F.col("overlap")).otherwise(0)).alias(f"_{k}")
        for k in ("coding", "exon", "body", "plus", "minus", "ribo")
    ]
    per = places.join(hits.groupBy(*key).agg(*sums), key, "left").na.fill(0)
    total = F.aggregate(F.transform(cigar.blocks(), lambda b: b["end"] - b["start"]), F.lit(0), lambda a, x: a + x)
    per = per.withColumn("_total", total)
    ribo = (F.col("_total") > 0) & (F.col("_ribo") >= F.lit(rrna_fraction) * F.col("_total")) & (F.col("_ribo") > 0)
    n = F.col("n")

    def bases(expr: Column) -> Column:
        return F.sum(F.when(ribo, 0).otherwise(expr * n))

    one = (F.col("_plus") > 0) != (F.col("_minus") > 0)
    right = one & ((F.col("_plus") > 0) == (F.col("strand") == "+"))
    aggs = [
        F.sum(F.col("_total") * n).alias("bases"),
        F.sum(F.when(ribo, F.col("_total") * n).otherwise(0)).alias("ribosomal"),
        bases(F.col("_coding")).alias("coding"),
        bases(F.col("_exon") - F.col("_coding")).alias("utr"),
        bases(F.col("_body") - F.col("_exon")).alias("intronic"),
        bases(F.col("_total") - F.col("_body")).alias("intergenic"),
        F.sum(F.when(~ribo & right, n).otherwise(0)).alias("correct_strand"),
        F.sum(F.when(~ribo & one & ~right, n).otherwise(0)).alias("incorrect_strand"),
    ]
    sets = [[], *[[c] for c in levels]]
    out = per.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in levels]).agg(*aggs)
    share = {f"pct_{c}": F.col(c) / F.col("bases") for c in ("ribosomal", "coding", "utr", "intronic", "intergenic")}
    stranded_n = F.col("correct_strand") + F.col("incorrect_strand")
    return out.withColumns({**share, "pct_correct_strand": F.when(stranded_n > 0, F.col("correct_strand") / stranded_n).otherwise(0.0)})


def exon_offsets(exons: DataFrame) -> DataFrame:
    """Exons with their 5'-to-3' ``offset`` in the transcript and its ``length``.

    The windows hold one transcript's exons.
    """
    whole = Window.partitionBy("transcript_id")
    order = F.when(F.col("strand") == "-", -F.col("start")).otherwise(F.col("start"))
    before = whole.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    size = F.col("end") - F.col("start")
    return exons.select(
        "rname", "start", "end", "strand", "transcript_id", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("int").alias("offset"),
        F.sum(size).over(whole).cast("int").alias("length"),
    )


def _covered_before(runs: DataFrame, points: DataFrame) -> DataFrame:
    """Per sample and point (rname, pos): summed depth ``cov``, summed squares ``sq`` and covered bases ``seen`` of the sequence before it.

    Sums over any stretch are differences of two rows, so no run meets an exon. Whole-numbered depths add up exactly below 2^53.
    Joins with it merge: Spark takes points that come from exploded rows for as few as the exons, and would broadcast them.
    """
    runs = stage(runs)
    v = F.col("value")

    def event(at: str, sign: int) -> Column:
        pos, n = F.col(at).cast("bigint"), F.lit(sign).cast("bigint")
        # Before x lie x * (running v) - (running v * pos).
        return F.struct(pos.alias("pos"), *[e.alias(c) for c, x in {"v": v, "q": v * v, "k": F.lit(1)}.items() for c, e in ((c, x * n), (f"{c}p", x * n * pos))])

    sums = ["v", "vp", "q", "qp", "k", "kp"]
    events = runs.filter("end > start").select("sample", "rname", F.inline(F.array(event("start", 1), event("end", -1))))
    asked = points.distinct().crossJoin(F.broadcast(runs.select("sample").distinct()))
    at = running_at(events, asked, dict.fromkeys(sums, "sum"), by=["sample", "rname"])
    before = [(F.col(c) * F.col("pos") - F.col(f"{c}p")).alias(name) for c, name in (("v", "cov"), ("q", "sq"), ("k", "seen"))]
    return at.select("sample", "rname", "pos", *before).hint("merge")


def _transcribed(exons: DataFrame, min_len: int) -> tuple[DataFrame, Column]:
    """Exons of transcripts of at least ``min_len`` bases, and whether their offsets grow with the position."""
    return exon_offsets(exons).filter((F.col("length") >= min_len) & (F.col("end") > F.col("start"))), F.coalesce(F.col("strand") != "-", F.lit(False))


def gene_body_coverage(runs: DataFrame, exons: DataFrame, *, min_len: int = 100) -> DataFrame:
    """Summed depth per sample and percentile 0..99 along transcripts (5' to 3'), from coverage runs; only percentiles with a covered base."""
    placed, plus = _transcribed(exons, min_len)
    placed = placed.groupBy("rname", "start", "end", plus.alias("plus"), "offset", "length").agg(_n())
    stop = F.col("offset") + F.col("end") - F.col("start")
    first = F.floor(F.col("offset") * 100 / F.col("length")).cast("int")
    last = F.floor((stop - 1) * 100 / F.col("length")).cast("int")
    parts = placed.withColumn("percentile", F.explode(F.sequence(first, last)))
    # Offsets whose floor(100 * off / length) is p: ceil(p * length / 100) up to ceil((p + 1) * length / 100).
    lo = F.greatest(F.ceil(F.col("percentile") * F.col("length") / 100), F.col("offset")) - F.col("offset")
    hi = F.least(F.ceil((F.col("percentile") + 1) * F.col("length") / 100), stop) - F.col("offset")
    from_, to = F.when(F.col("plus"), F.col("start") + lo).otherwise(F.col("end") - hi), F.when(F.col("plus"), F.col("start") + hi).otherwise(F.col("end") - lo)
    ends = F.array(*[F.struct(p.cast("bigint").alias("pos"), c.alias("c")) for p, c in ((from_, -F.col("n")), (to, F.col("n")))])
    # How often a percentile begins and ends at a base; what lies between is a difference of sums.
    borders = parts.select("rname", "percentile", F.inline(ends)).groupBy("rname", "pos", "percentile").agg(F.sum("c").alias("c")).filter("c <> 0")
    at = _covered_before(runs, borders.select("rname", "pos")).select("sample", "rname", "pos", "cov", "seen")
    per = borders.join(at, ["rname", "pos"]).groupBy("sample", "percentile").agg(
        F.sum(F.col("c") * F.col("cov")).alias("coverage"), F.sum(F.col("c") * F.col("seen")).alias("seen")
    )
    return per.filter("seen > 0").drop("seen")


def transcript_bias(runs: DataFrame, exons: DataFrame, *, min_len: int = 500, edge: int = 100) -> DataFrame:
    """Per sample medians over covered transcripts: mean coverage, its variation, and 5' and 3' bias (edge mean / mean)."""
    placed, plus = _transcribed(exons, min_len)
    start, end, size = F.col("start"), F.col("end"), F.col("end") - F.col("start")
    within = lambda n: F.least(F.greatest(n, F.lit(0)), size)
    head, tail = within(edge - F.col("offset")), within(F.col("offset") + size - F.col("length") + edge)
    placed = placed.withColumns({"_plus": plus, "_h": head, "_t": tail})
    left, right = F.when(F.col("_plus"), F.col("_h")).otherwise(F.col("_t")), F.when(F.col("_plus"), F.col("_t")).otherwise(F.col("_h"))
    # The exon's ends, and where its left and right edge stretches end, with the sign at which the sums there enter whole, left and right edge.
    zero = F.lit(0)
    sign = lambda at, w, l, r: F.struct(at.cast("bigint").alias("pos"), F.lit(w).alias("w"), l.alias("l"), r.alias("r"))  # noqa: E731, E741
    ends = F.array(
        sign(start, -1, F.when(left > 0, -1).otherwise(0), F.when((right > 0) & (right == size), -1).otherwise(0)),
        sign(end, 1, F.when((left > 0) & (left == size), 1).otherwise(0), F.when(right > 0, 1).otherwise(0)),
        sign(start + left, 0, F.when((left > 0) & (left < size), 1).otherwise(0), zero),
        sign(end - right, 0, zero, F.when((right > 0) & (right < size), -1).otherwise(0)),
    )
    signs = placed.select("rname", "transcript_id", "length", "_plus", F.inline(ends)).filter("w <> 0 or l <> 0 or r <> 0")
    h, t = F.when(F.col("_plus"), F.col("l")).otherwise(F.col("r")), F.when(F.col("_plus"), F.col("r")).otherwise(F.col("l"))
    per = signs.join(_covered_before(runs, signs.select("rname", "pos")), ["rname", "pos"]).groupBy("sample", "transcript_id", "length").agg(
        F.sum(F.col("w") * F.col("cov")).alias("s"), F.sum(F.col("w") * F.col("sq")).alias("ss"), F.sum(h * F.col("cov")).alias("h"),
        F.sum(t * F.col("cov")).alias("t"), F.sum(F.col("w") * F.col("seen")).alias("seen"),
    )
    per = per.filter("seen > 0")
    mean = F.col("s") / F.col("length")
    var = F.greatest(F.col("ss") / F.col("length") - mean * mean, F.lit(0.0))
    per = per.select(
        "sample", mean.alias("mean"), (F.sqrt(var) / mean).alias("cv"), (F.col("h") / edge / mean).alias("b5"), (F.col("t") / edge / mean).alias("b3")
    )
    names = {"mean": "median_coverage", "cv": "median_cv", "b5": "median_5prime_bias", "b3": "median_3prime_bias"}
    medians = exact_medians(per, "sample", list(names)).withColumnsRenamed(names)
    return per.groupBy("sample").agg(F.count(F.lit(1)).alias("transcripts")).join(medians, "sample", "left")


def read_distribution(al: DataFrame, exons: DataFrame, *, flank: int = 1000, bin_size: int = 4096) -> DataFrame:
    """Tags (middle base of every block) per region class.

    Classes by precedence: cds, utr, intron, upstream and downstream of a transcript within ``flank``, intergenic.
    """
    start, end, plus = F.col("start"), F.col("end"), F.col("strand") != "-"
    before, after = (F.greatest(start - flank, F.lit(0)), start), (end, end + flank)
    kinds = ["cds", "utr", "intron", "upstream", "downstream", "intergenic"]
    side = _kinds(exons, _coding(0), (1, start, end, None)).unionByName(
        _kinds(_model_spans(exons), (2, start, end, None), (3, *before, plus), (3, *after, ~plus), (4, *after, plus), (4, *before, ~plus))
    )
    side = _merged(side, ["rname", "kind"])
    places = al.filter(flags.lacks(flags.UNMAPPED | flags.SECONDARY)).groupBy("sample", "rname", "pos", "cigar").agg(_n())
    mid = F.floor((F.col("start") + F.col("end")) / 2).cast("int")
    tags = _blocks(places).withColumn("at", mid).groupBy("sample", "rname", "at").agg(F.sum("n").alias("n"))
    points = tags.select("sample", "rname", "n", F.col("at").alias("start"), (F.col("at") + 1).alias("end"))
    hits = overlap_join(points, side, bin_size=bin_size).groupBy("sample", "rname", "start").agg(F.min("r_kind").alias("kind"))
    judged = points.join(hits, ["sample", "rname", "start"], "left")
    label = F.element_at(F.array(*[F.lit(k) for k in kinds]), F.coalesce("kind", F.lit(5)) + 1)
    return judged.groupBy("sample", label.alias("kind")).agg(F.sum("n").alias("n"))


def infer_experiment(al: DataFrame, genes: DataFrame, *, min_mapq: int = 30, bin_size: int = 4096) -> DataFrame:
    """Reads per (mate, read strand, gene strand) with fractions, over reads whose genes lie on one strand."""
    usable = filter_usable(al, min_mapq)
    mate = F.when(flags.has(flags.PAIRED), flags.mate_number()).otherwise(0)
    places = usable.groupBy("sample", "rname", "pos", "cigar", flags.strand().alias("strand"), mate.alias("mate")).agg(_n())
    spans = places.withColumns({"start": cigar.start0(), "end": cigar.end0()})
    side = _merged(genes, ["rname", "strand"])
    hits = overlap_join(spans, side, bin_size=bin_size)
    per = hits.groupBy("sample", *PLACE, "mate").agg(F.min("r_strand").alias("lo"), F.max("r_strand").alias("hi"), F.max("n").alias("n"))
    clear = per.filter("lo = hi").groupBy("sample", "mate", "strand", F.col("lo").alias("gene_strand")).agg(F.sum("n").alias("n"))
    return clear.withColumn("fraction", F.col("n") / F.sum("n").over(Window.partitionBy("sample")))


def filter_usable(al: DataFrame, min_mapq: int) -> DataFrame:
    return al.filter(flags.lacks(flags.UNMAPPED | flags.SECONDARY | flags.QC_FAIL | flags.DUPLICATE) & (F.col("mapq") >= min_mapq))


def junctions(al: DataFrame, *extra: Column | str) -> DataFrame:
    """The ``N`` gaps of mapped records (sample, rname, start, end), one row per record and gap."""
    spliced = al.filter(flags.lacks(flags.UNMAPPED) & F.contains("cigar", F.lit("N")))
    return spliced.select("sample", "rname", *extra, F.inline(cigar.introns()))


def model_introns(exons: DataFrame) -> DataFrame:
    """Introns between consecutive exons of each transcript; the window holds one transcript's exons."""
    w = Window.partitionBy("transcript_id", "rname").orderBy("start")
    return (
        exons.select("transcript_id", "rname", "strand", F.col("end").alias("start"), F.lead("start").over(w).alias("end"))
        .filter("end > start")
    )


def junction_annotation(al: DataFrame, introns: DataFrame) -> DataFrame:
    """Distinct junctions per sample with read support and ``kind`` known, partial or novel.

    A junction is known when both its ends are splice sites of the model, partial when one is.
    """
    seen = junctions(al).groupBy("sample", "rname", "start", "end").agg(_n())
    left = introns.select("rname", "start").distinct().withColumn("_l", F.lit(True))
    right = introns.select("rname", "end").distinct().withColumn("_r", F.lit(True))
    j = seen.join(left, ["rname", "start"], "left").join(right, ["rname", "end"], "left")
    l, r = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return j.withColumn("kind", F.when(l & r, "known").when(l | r, "partial").otherwise("novel")).drop("_l", "_r")


def junction_saturation(al: DataFrame, introns: DataFrame, *, steps: int = 20, seed: int = 1) -> DataFrame:
    """Distinct junctions, all and known, found in growing subsamples of reads (percent of the sample).

    A read's step comes from a hash of its name, so subsamples are nested and equal on every retry.
    """
    positive("steps", steps)
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}_"), F.col("qname"))), 1, 8), 16, 10).cast("bigint")
    step = (digest % steps + 1).cast("int").alias("step")
    first = junctions(al, step).groupBy("sample", "rname", "start", "end").agg(F.min("step").alias("step"))
    known = introns.select("rname", "start", "end").distinct().withColumn("_k", F.lit(1))
    per = first.join(known, ["rname", "start", "end"], "left").groupBy("sample", "step").agg(
        _n(), F.sum(F.coalesce("_k", F.lit(0))).alias("k")
    )
    upto = Window.partitionBy("sample").orderBy("step")
    return per.select(
        "sample", (F.col("step") * 100 / steps).alias("percent"), F.sum("n").over(upto).alias("junctions"), F.sum("k").over(upto).alias("known")
    )
