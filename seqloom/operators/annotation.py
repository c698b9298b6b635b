"""Transcript annotation: filters, tables, deduplication, classification, sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bases
from ..options import choice, positive
from .intervals import explode_range, merge_intervals, overlap_join

# Gene names of one public catalogue start with this.
GENCODE_MARK = "ENS"
# Human chromosomes kept by default.
STANDARD_CHROMOSOMES = tuple(str(i) for i in range(1, 23)) + ("X", "Y", "MT")
# Class codes from best to worst.
CODE_ORDER = ("=", "c", "j", "e", "i", "o", "p", "r", "u", "x", "s")


def _matches(pattern: str) -> Column:
    """The gene name holds the pattern; a missing name never does."""
    return F.coalesce(F.col("gene_name").rlike(pattern), F.lit(False))


def _in_classes(classes: Sequence[str]) -> Column:
    return F.coalesce(F.col("class_code").isin(*classes), F.lit(False))


def filter_gtf(
    features: DataFrame,
    *,
    remove_gencode: bool = False,
    name_regex: str | None = None,
    classes: Sequence[str] | None = None,
    class_and_name: tuple[Sequence[str], str] | None = None,
    remove_unstranded: bool = False,
) -> DataFrame:
    """Drop rows by gene name, class code, both together, or missing strand."""
    drop = F.lit(False)
    if remove_gencode:
        drop = drop | _matches(GENCODE_MARK)
    if name_regex is not None:
        drop = drop | _matches(name_regex)
    if classes is not None:
        drop = drop | _in_classes(classes)
    if class_and_name is not None:
        drop = drop | (_in_classes(class_and_name[0]) & _matches(class_and_name[1]))
    if remove_unstranded:
        drop = drop | (F.col("strand") == ".")
    return features.filter(~drop)


def filter_gtf_keep(
    features: DataFrame,
    *,
    keep_classes: Sequence[str] | None = None,
    keep_chromosomes: Sequence[str] | None = STANDARD_CHROMOSOMES,
    drop_field: str | None = None,
    drop_string: str | None = None,
    class_only_in_transcript: bool = False,
) -> DataFrame:
    """Keep class codes and chromosomes, drop rows whose field holds a string.

    With ``class_only_in_transcript`` the code stands on transcript rows only and counts for their exons: the codes
    are joined to the exons by transcript.
    """
    if (drop_field is None) != (drop_string is None):
        raise ValueError("drop_field and drop_string go together")
    out = features
    if keep_chromosomes is not None:
        out = out.filter(F.regexp_replace("rname", "^chr", "").isin(*keep_chromosomes))
    if drop_field is not None:
        out = out.filter(~F.coalesce(F.contains(F.col(drop_field), F.lit(drop_string)), F.lit(False)))
    if keep_classes is not None:
        if class_only_in_transcript:
            codes = features.filter("feature = 'transcript'").groupBy("transcript_id").agg(F.max("class_code").alias("_code"))
            kept = codes.filter(F.col("_code").isin(*keep_classes)).select("transcript_id")
            out = out.join(kept, "transcript_id", "left_semi")
        else:
            out = out.filter(_in_classes(keep_classes))
    return out


def transcript_table(exons: DataFrame, *, exact_length: bool = False) -> DataFrame:
    """Per transcript: exon count and lengths, chromosome, strand, class and whether it is inconsistent (``discard``).

    Lengths are end - start of 1-based inclusive coordinates, one short of the true length, unless ``exact_length``.
    The list of exon lengths, in start order, belongs to the result.
    """
    size = F.col("end") - F.col("start") - (0 if exact_length else 1)
    one = F.struct("start", size.cast("bigint").alias("size"))
    t = exons.groupBy("transcript_id").agg(
        F.count(F.lit(1)).alias("n_exon"),
        F.sort_array(F.collect_list(one)).alias("rows"),
        F.sum(size).cast("bigint").alias("length"),
        *[f(c).alias(f"{n}_{c}") for c in ("rname", "strand", "class_code") for f, n in ((F.min, "lo"), (F.max, "hi"))],
    )
    apart = (F.col("lo_rname") != F.col("hi_rname")) | (F.col("lo_strand") != F.col("hi_strand"))
    return t.select(
        "transcript_id", "n_exon", F.array_join(F.transform("rows", lambda r: r["size"].cast("string")), ",").alias("exon_lengths"), "length",
        F.when(F.col("lo_rname") == F.col("hi_rname"), F.col("lo_rname")).alias("rname"),
        F.when(F.col("lo_strand") == F.col("hi_strand"), F.col("lo_strand")).alias("strand"),
        F.when(F.col("lo_class_code") == F.col("hi_class_code"), F.col("lo_class_code")).otherwise("mixed").alias("class_code"),
        apart.alias("discard"),
    )


def transcript_metrics(exons: DataFrame) -> DataFrame:
    """(metric, key, n): transcripts by chromosome, strand, class and exon count, and whole mean and median lengths."""
    size = F.col("end") - F.col("start") - 1
    t = exons.groupBy("transcript_id").agg(
        F.count(F.lit(1)).alias("n_exon"), F.sum(size).alias("length"),
        *[f(c).alias(f"{n}_{c}") for c in ("rname", "strand", "class_code") for f, n in ((F.min, "lo"), (F.max, "hi"))],
    )
    t = t.withColumn("discard", (F.col("lo_rname") != F.col("hi_rname")) | (F.col("lo_strand") != F.col("hi_strand")))
    code = F.when(F.col("lo_class_code") == F.col("hi_class_code"), F.col("lo_class_code")).otherwise("mixed")
    good = t.filter(~F.col("discard")).select(
        F.col("lo_rname").alias("chromosome"), F.col("lo_strand").alias("strand"), code.alias("class_code"), F.col("n_exon").cast("string").alias("exons")
    )
    sets = ["chromosome", "strand", "class_code", "exons"]
    by = good.groupingSets([[F.col(c)] for c in sets], *[F.col(c) for c in sets]).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g")
    )
    # In the grouping id the bit of the one column grouped by is 0.
    name = F.element_at(F.create_map(*[x for i, c in enumerate(sets) for x in (F.lit(15 - (8 >> i)), F.lit(c))]), F.col("g").cast("int"))
    counts = by.select(name.alias("metric"), F.coalesce(*sets).alias("key"), "n")
    totals = t.agg(F.count(F.lit(1)).alias("transcripts"), F.count_if("discard").alias("discard"))
    totals = totals.select(F.lit("x").alias("x"), "*").unpivot("x", ["transcripts", "discard"], "metric", "n")
    lengths = exons.join(t.filter("discard").select("transcript_id"), "transcript_id", "left_anti").groupBy(size.alias("v")).agg(
        F.count(F.lit(1)).alias("k")
    )
    wholes = t.filter(~F.col("discard")).groupBy(F.col("length").alias("v")).agg(F.count(F.lit(1)).alias("k"))
    out = counts.unionByName(totals.select("metric", F.lit(None).cast("string").alias("key"), "n"))
    for label, table in (("exon_length", lengths), ("transcript_length", wholes)):
        stats = table.agg(
            F.floor(F.sum(F.col("v") * F.col("k")) / F.sum("k")).cast("bigint").alias("mean"),
            F.floor(F.percentile(F.col("v"), F.lit(0.5), F.col("k"))).cast("bigint").alias("median"),
        ).select(F.lit("x").alias("x"), "*").unpivot("x", ["mean", "median"], "which", "n")
        out = out.unionByName(
            stats.select(F.concat(F.col("which"), F.lit(f"_{label}")).alias("metric"), F.lit(None).cast("string").alias("key"), "n")
        )
    return out


def merge_annotation(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both annotations in (chromosome, start, end) order; nothing is dropped."""
    return a.unionByName(b, allowMissingColumns=True).orderBy("rname", "start", "end")


def intron_chains(exons: DataFrame, *keys: str) -> DataFrame:
    """Per transcript its span, exonic length and intron chain as text (empty for one exon)."""
    rows = F.sort_array(F.collect_list(F.struct("start", "end")))
    t = exons.groupBy(*keys, "transcript_id", "rname", "strand").agg(
        rows.alias("ex"), F.min("start").alias("start"), F.max("end").alias("end"),
        F.sum(F.col("end") - F.col("start")).cast("bigint").alias("length"), F.count(F.lit(1)).alias("n_exon"),
    )
    n = F.size("ex")
    gaps = F.zip_with(
        F.slice("ex", F.lit(1), n - 1), F.slice("ex", F.lit(2), n),
        lambda x, y: F.concat(x["end"].cast("string"), F.lit("-"), y["start"].cast("string")),
    )
    chain = F.concat(F.lit(","), F.array_join(F.filter(gaps, lambda g: g.isNotNull()), ","), F.lit(","))
    return t.withColumn("chain", F.when(n > 1, chain).otherwise("")).drop("ex")


def listed_introns(chains: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per chain and intron, the intron in ``_i``."""
    return chains.select(*key, F.explode(F.split(F.trim(F.col("chain_key"), F.lit(",")), ",")).alias("_i"))


def rarest_introns(introns: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each chain with that of its introns which the fewest chains hold (ties: the smaller text).

    A chain within another shares all its introns with it, this one too: containers are looked for under it alone. An intron that very many chains
    share is then the key only of the chain that has no other.
    """
    place = ["rname", "strand", "_i"]
    support = introns.groupBy(*place).agg(F.count(F.lit(1)).alias("_s"))
    return introns.join(support, place).groupBy(*key).agg(F.min(F.struct("_s", "_i"))["_i"].alias("_i"))


def dedupe_transcripts(
    exons: DataFrame,
    samples: Sequence[str],
    *,
    drop_contained: bool = False,
    discard_single: str = "none",
) -> tuple[DataFrame, DataFrame]:
    """(representatives, tracking): one transcript per identical intron chain over all samples.

    The longest one stands for its chain (ties: smaller sample and name). Single-exon transcripts are identical when
    their spans are; ``discard_single`` drops none, ``all`` of them, or those of the ``reference`` rows only.
    Tracking has one column per sample with the sample's transcript of that chain.
    """
    choice("discard_single", discard_single, ("none", "all", "reference"))
    t = intron_chains(exons, "sample")
    single = F.col("n_exon") == 1
    if discard_single == "all":
        t = t.filter(~single)
    elif discard_single == "reference":
        t = t.filter(~(single & (F.col("sample") == "reference")))
    span = F.concat(F.lit("="), F.col("start").cast("string"), F.lit("-"), F.col("end").cast("string"))
    t = t.withColumn("chain_key", F.when(single, span).otherwise(F.col("chain")))
    key = ["rname", "strand", "chain_key"]
    best = t.groupBy(*key).agg(
        F.min(F.struct((-F.col("length")).alias("l"), "sample", "transcript_id", "start", "end")).alias("b"),
        F.count_distinct("sample").alias("n_samples"),
    )
    reps = best.select(
        *key, F.col("b.transcript_id").alias("transcript_id"), F.col("b.sample").alias("sample"), F.col("b.start").alias("start"),
        F.col("b.end").alias("end"), "n_samples",
    )
    if drop_contained:
        multi = reps.filter(F.col("chain_key").startswith(","))
        introns = listed_introns(multi, key)
        inner = rarest_introns(introns, key)
        outer = introns.select("rname", "strand", F.col("chain_key").alias("_outer"), "_i")
        hold = (F.length("_outer") > F.length("chain_key")) & F.contains("_outer", F.col("chain_key"))
        cond = (inner["rname"] == outer["rname"]) & (inner["strand"] == outer["strand"]) & (inner["_i"] == outer["_i"]) & hold
        contained = inner.join(outer, cond, "left_semi").select(*key)
        reps = reps.join(contained, key, "left_anti")
    tracking = t.groupBy(*key).pivot("sample", list(samples)).agg(F.min("transcript_id"))
    return reps, tracking


def filter_transcripts(
    transcripts: DataFrame, *, min_len: int = 50, min_cov: float = 0.0, min_fpkm: float = 1.0, min_tpm: float = 1.0, iso_frac: float = 0.01
) -> DataFrame:
    """Inclusion thresholds; a transcript must also reach ``iso_frac`` of its gene's highest TPM."""
    top = transcripts.groupBy("gene_id").agg(F.max("tpm").alias("_top"))
    passing = transcripts.filter(
        (F.col("length") >= min_len) & (F.col("cov") >= min_cov) & (F.col("fpkm") >= min_fpkm) & (F.col("tpm") >= min_tpm)
    )
    return passing.join(top, "gene_id").filter(F.col("tpm") >= iso_frac * F.col("_top")).drop("_top")


def transcript_loci(transcripts: DataFrame, *, gap: int = 250) -> DataFrame:
    """Loci of transcripts on one strand closer than ``gap``."""
    return merge_intervals(transcripts, gap=gap, by=["rname", "strand"])


def _introns(exons: DataFrame) -> DataFrame:
    """Introns with their index and the transcript's count; windows hold one transcript's exons."""
    w = Window.partitionBy("transcript_id").orderBy("start")
    return (
        exons.select(
            "transcript_id", "rname", "strand", F.col("end").alias("start"), F.lead("start").over(w).alias("end"), F.row_number().over(w).alias("idx")
        )
        .filter("end > start")
    )


def _overlapping_exons(exons: DataFrame) -> DataFrame:
    """Names of transcripts with exons that overlap, are empty or lie on several sequences or strands; windows hold one transcript's exons."""
    whole = Window.partitionBy("transcript_id")
    before = F.max("end").over(whole.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    place = F.struct("rname", "strand")
    mixed = ~F.min(place).over(whole).eqNullSafe(F.max(place).over(whole))
    unclear = F.col("start").isNull() | F.col("end").isNull() | F.coalesce(F.col("start") < before, F.lit(False))
    judged = exons.withColumn("_odd", unclear | F.coalesce(F.col("end") <= F.col("start"), F.lit(False)) | mixed)
    return judged.filter("_odd").select("transcript_id").distinct()


def class_codes(query: DataFrame, reference: DataFrame, *, run_on: int = 2000, bin_size: int = 4096) -> DataFrame:
    """Best class code per query transcript against a reference annotation (both as exon rows).

    = same intron chain, c contained, j shares a junction, e single exon over an exon and at least 10 bases of an
    intron, i inside an intron, o other exonic overlap, p within ``run_on`` bases, r at least half soft-masked
    (column ``masked`` of the query, where given), x exonic overlap on the other strand, s intron overlap on the other
    strand, u none of these.
    """
    exon = ["rname", "start", "end", "strand", "transcript_id"]
    q_ex, r_ex = query.select(*exon), reference.select(*exon)
    q = intron_chains(q_ex)
    r = intron_chains(r_ex)
    q_in, r_in = _introns(q_ex), _introns(r_ex)
    found: list[DataFrame] = []

    def add(df: DataFrame, code: str) -> None:
        # One row per transcript and code reaches the minimum.
        found.append(df.select("transcript_id").distinct().withColumn("rank", F.lit(CODE_ORDER.index(code))))

    def merged(df: DataFrame) -> DataFrame:
        # Whether anything overlaps is answered by the union of the intervals of a strand: a crowded locus is one of them.
        return merge_intervals(df.select("rname", "start", "end", "strand"), by=["rname", "strand"]).drop("n")

    chains = r.filter("n_exon > 1").select("rname", "strand", "chain").distinct()
    add(q.filter("n_exon > 1").join(chains, ["rname", "strand", "chain"], "left_semi"), "=")
    shared = q_in.join(
        r_in.select("rname", "strand", "start", "end", F.col("transcript_id").alias("ref"), F.col("idx").alias("ref_idx")), ["rname", "strand", "start", "end"]
    )
    add(q_in.join(r_in.select("rname", "strand", "start", "end").distinct(), ["rname", "strand", "start", "end"], "left_semi"), "j")
    runs = shared.groupBy("transcript_id", "ref").agg(
        F.count(F.lit(1)).alias("k"), F.min("ref_idx").alias("lo"), F.max("ref_idx").alias("hi")
    )
    runs = runs.join(q.select("transcript_id", F.col("start").alias("qs"), F.col("end").alias("qe"), "n_exon"), "transcript_id")
    runs = runs.join(r.select(F.col("transcript_id").alias("ref"), F.col("start").alias("rs"), F.col("end").alias("re")), "ref")
    add(runs.filter("k = n_exon - 1 and hi - lo + 1 = k and qs >= rs and qe <= re"), "c")
    single = q.filter("n_exon = 1").select(*exon)
    within = dict(how="semi", key=["transcript_id"], stranded="same", min_fraction=1.0, bin_size=bin_size)
    add(overlap_join(single, r_ex.filter("end is not null"), **within), "c")
    # Over an exon and 10 bases of an intron of one transcript: where its exons are apart, that is 10 bases of an intron that does not
    # hold the query, so the intron begins behind the query's start or ends before its end. Other transcripts are met exon by exon.
    odd = _overlapping_exons(r_ex)
    gaps = r_in.join(odd, "transcript_id", "left_anti").filter("transcript_id is not null and end - start >= 10")
    for at, first, last in (("start", F.col("start") + 1, F.col("end") - 9), ("end", F.col("start") + 10, F.col("end"))):
        spots = gaps.select("rname", "strand", F.col(at).alias("start"), (F.col(at) + 1).alias("end")).distinct()
        reach = single.select("transcript_id", "rname", "strand", first.alias("start"), last.alias("end"))
        add(overlap_join(reach, spots, how="semi", key=["transcript_id"], stranded="same", bin_size=bin_size), "e")
    def pairs(ref: DataFrame, **opts) -> DataFrame:
        met = overlap_join(single, ref.join(odd, "transcript_id", "left_semi"), stranded="same", bin_size=bin_size, **opts)
        return met.unionByName(overlap_join(single.filter("end is null"), ref, stranded="same", bin_size=bin_size, **opts).select(*met.columns))

    on_exon, on_intron = pairs(r_ex), pairs(r_in.select(*exon), min_overlap=10)
    both = on_exon.select("transcript_id", "r_transcript_id").distinct().join(
        on_intron.select("transcript_id", "r_transcript_id").distinct(), ["transcript_id", "r_transcript_id"], "left_semi"
    )
    add(both, "e")
    spans = q.select(*exon)
    introns = r_in.select("rname", "start", "end", "strand").distinct()
    add(overlap_join(spans, introns, **within), "i")
    exons = merged(r_ex)
    add(overlap_join(q_ex, exons, stranded="same", bin_size=bin_size), "o")
    add(overlap_join(spans, merged(r), stranded="same", min_overlap=-run_on, bin_size=bin_size), "p")
    if "masked" in query.columns:
        share = query.groupBy("transcript_id").agg((F.sum("masked") / F.sum(F.col("end") - F.col("start"))).alias("m"))
        add(share.filter("m >= 0.5"), "r")
    add(overlap_join(q_ex, exons, stranded="opposite", bin_size=bin_size), "x")
    add(overlap_join(q_in.select(*exon), merged(introns), stranded="opposite", bin_size=bin_size), "s")
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    best = every.groupBy("transcript_id").agg(F.min("rank").alias("rank"))
    codes = F.array(*[F.lit(c) for c in CODE_ORDER])
    unknown = F.lit(CODE_ORDER.index("u"))
    return q.select("transcript_id").join(best, "transcript_id", "left").select(
        "transcript_id", F.element_at(codes, F.coalesce("rank", unknown) + 1).alias("class_code")
    )


def extract_transcripts(exons: DataFrame, genome: DataFrame, *, chunk: int) -> DataFrame:
    """Spliced transcript sequences (transcript_id, seq) from genome chunks (rname, start, seq) of ``chunk`` bases.

    Exons meet only the chunks they touch; bases past the end of a sequence are left out.
    """
    positive("chunk", chunk)
    first, last = F.floor(F.col("start") / chunk), F.floor((F.col("end") - 1) / chunk)
    parts = explode_range(exons.filter("end > start"), first, last, "_k").withColumn("_at", (F.col("_k") * chunk).cast("int"))
    # The planner takes a text column for 20 bytes a row, so a whole genome could pass for a table to broadcast: both sides are shuffled.
    text = genome.select("rname", F.col("start").alias("_at"), F.col("seq").alias("_seq")).hint("merge")
    lo = F.greatest("start", "_at") - F.col("_at")
    hi = F.least(F.col("end"), F.col("_at") + chunk) - F.col("_at")
    pieces = parts.join(text, ["rname", "_at"]).select(
        "transcript_id", "strand", F.greatest("start", "_at").alias("at"), F.substr("_seq", lo + 1, hi - lo).alias("s")
    )
    whole = pieces.groupBy("transcript_id", "strand").agg(F.sort_array(F.collect_list(F.struct("at", "s"))).alias("p"))
    seq = F.array_join(F.transform("p", lambda x: x["s"]), "")
    return whole.select("transcript_id", F.when(F.col("strand") == "-", bases.reverse_complement(seq)).otherwise(seq).alias("seq"))


def manifest_diff(
    old: DataFrame, new: DataFrame, *, compare_hash: bool = False, inputs: DataFrame | None = None, slack_seconds: int = 1
) -> DataFrame:
    """State of every file of two manifests (path, size, mtime, sha256).

    In this order: not_logged, missing, size_changed, hash_changed (asked for, sizes equal), newer (by more than
    ``slack_seconds``), inputs_newer (``inputs``: path, input_mtime), unchanged.
    """
    a = old.select("path", F.col("size").alias("s0"), F.col("mtime").alias("m0"), F.col("sha256").alias("h0"), F.lit(True).alias("_old"))
    b = new.select("path", F.col("size").alias("s1"), F.col("mtime").alias("m1"), F.col("sha256").alias("h1"), F.lit(True).alias("_new"))
    j = a.join(b, "path", "full")
    if inputs is not None:
        latest = inputs.groupBy("path").agg(F.max("input_mtime").alias("_in"))
        j = j.join(latest, "path", "left")
    else:
        j = j.withColumn("_in", F.lit(None).cast("timestamp"))
    later = F.unix_micros("m1") - F.unix_micros("m0") > slack_seconds * 1_000_000
    state = F.when(F.col("_old").isNull(), "not_logged").when(F.col("_new").isNull(), "missing").when(F.col("s0") != F.col("s1"), "size_changed")
    if compare_hash:
        state = state.when(F.col("h0") != F.col("h1"), "hash_changed")
    state = state.when(later, "newer").when(F.col("_in") > F.col("m1"), "inputs_newer").otherwise("unchanged")
    return j.select("path", state.alias("state"))
