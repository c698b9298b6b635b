"""Joining the fragments of split reads into one spliced record.

A mapping (read, ``xi``) is gathered into one row because its joined record holds all its fragments anyway;
everything across mappings of a read or template is a mergeable aggregate joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import cigar, flags
from ..functions.staging import evaluate_once, stage_table
from ..options import choice, positive, require

READ = ["sample", "qname", "mate"]
FIELDS = ("flag", "rname", "mapq", "cigar", "seq", "qual", "nm", "md")

# Splice motifs (donor + acceptor) read on the plus strand.
PLUS_MOTIFS = ("GTAG", "GCAG", "ATAC")
MINUS_MOTIFS = ("CTAC", "CTGC", "GTAT")


def _gathered(fragments: DataFrame, keys: Sequence[str], length_mode: str) -> DataFrame:
    """One row per mapping with ``frags`` ordered by position; ``xq`` renumbered from the read order ``xx``."""
    size = cigar.ref_len(mode=length_mode).alias("len")
    one = F.struct("xx", "pos", "xq", size, *FIELDS)
    rows = fragments.groupBy(*keys).agg(F.sort_array(F.collect_list(one)).alias("by_read"))
    renumbered = F.transform(
        "by_read",
        lambda f, i: F.struct(f["pos"].alias("pos"), i.alias("rank"), f["xq"].alias("xq"), f["len"].alias("len"), *[f[c].alias(c) for c in FIELDS]),
    )
    ordered = evaluate_once(rows, frags=F.sort_array(renumbered)).drop("by_read")
    return ordered.withColumn("n_frags", F.size("frags"))


def _neighbours(rule) -> Column:
    """``rule(previous, next)`` over neighbouring fragments."""
    n = F.size("frags")
    return F.zip_with(F.slice("frags", F.lit(1), n - 1), F.slice("frags", F.lit(2), n), _both_present(rule))


def _both_present(rule):
    def apply(a: Column, b: Column) -> Column:
        return F.when(a.isNotNull() & b.isNotNull(), rule(a, b))

    return apply


def _merge_md(a: Column, b: Column) -> Column:
    """Join MD strings; a number meeting a number adds up."""
    tail, head = F.regexp_extract(a, r"(\d+)$", 1), F.regexp_extract(b, r"^(\d+)", 1)
    summed = F.concat(
        F.regexp_replace(a, r"\d+$", ""), (tail.try_cast("bigint") + head.try_cast("bigint")).cast("string"), F.regexp_replace(b, r"^\d+", "")
    )
    return F.when((tail != "") & (head != ""), summed).otherwise(F.concat(a, b))


def _fold() -> Column:
    """CIGAR and MD of the record joined from ``frags``."""
    first = F.col("frags")[0]
    rest = F.slice("frags", F.lit(2), F.size("frags"))
    start = F.struct(first["cigar"].alias("c"), (first["pos"] + first["len"]).alias("e"), first["md"].alias("md"))

    def step(acc: Column, f: Column) -> Column:
        text = F.concat(acc["c"], (f["pos"] - acc["e"]).cast("string"), F.lit("N"), f["cigar"])
        return F.struct(text.alias("c"), (f["pos"] + f["len"]).alias("e"), _merge_md(acc["md"], f["md"]).alias("md"))

    return F.aggregate(rest, start, step)


def _joined_fields() -> dict[str, Column]:
    """Fields of the joined record, given ``_fold``; the first fragment gives flag, position and names."""
    first, folded = F.col("frags")[0], F.col("_fold")
    every = lambda c: F.transform("frags", lambda f: f[c])
    return {
        "flag": first["flag"],
        "rname": first["rname"],
        "pos": first["pos"],
        "cigar": folded["c"],
        "seq": F.array_join(every("seq"), ""),
        "qual": F.when(first["qual"] == "*", F.lit("*")).otherwise(F.array_join(every("qual"), "")),
        "nm": F.aggregate(every("nm"), F.lit(0), lambda a, x: a + x),
        "md": folded["md"],
    }


# Class per neighbour check, in order of precedence for the read.
_CLASSES = {1: "chromosome", 2: "strand", 3: "distance", 4: "overlap"}


def _classify(max_dist: int):
    """(reason column over ``_codes``, neighbour rule): the first failing check counts per neighbour pair."""

    def rule(a: Column, b: Column) -> Column:
        gap = b["pos"] - (a["pos"] + a["len"])
        rev_a, rev_b = flags.has(flags.REVERSE, a["flag"]), flags.has(flags.REVERSE, b["flag"])
        want = F.when(rev_b, a["rank"] - 1).otherwise(a["rank"] + 1)
        return (
            F.when(a["rname"] != b["rname"], 1)
            .when(gap >= max_dist, 3)
            .when(rev_a != rev_b, 2)
            .when(gap < 0, 4)
            .when(b["rank"] != want, 5)
            .otherwise(0)
        )

    codes = F.col("_codes")
    out = F.when(F.array_contains(codes, 1), _CLASSES[1])
    for code in (2, 3, 4):
        out = out.when(F.array_contains(codes, code), _CLASSES[code])
    breaks = F.size(F.filter(codes, lambda c: c == 5))
    return out.when(breaks > 1, "non_circular").when(breaks == 1, "circular"), rule


def split_mappings(fragments: DataFrame, *, max_dist: int = 200000) -> DataFrame:
    """Best mappings of split reads (least summed NM) with ``nh``, ordered ``frags`` and ``reason`` (NULL: joinable)."""
    positive("max_dist", max_dist)
    require(fragments, "sample", "qname", "xi", "xq", "xx", *FIELDS)
    f = fragments.filter("xq is not null").withColumn("mate", flags.mate_number())
    # Staged, so that the fragments are sorted and gathered once, not again for distances, counts and junctions.
    reason, rule = _classify(max_dist)
    codes = F.filter(_neighbours(rule), lambda c: c.isNotNull())
    total = F.aggregate(F.filter(F.transform("frags", lambda x: x["nm"].cast("bigint")), lambda x: x.isNotNull()), F.lit(None).cast("bigint"), lambda a, x: F.coalesce(a, F.lit(0)) + x)
    gathered = evaluate_once(_gathered(f, [*READ, "xi"], "ungapped"), _codes=codes, dist=total)
    gathered = stage_table(gathered.withColumn("reason", reason).drop("_codes"))
    distance = gathered.select(*READ, "xi", "dist")
    per_distance = distance.groupBy(*READ, "dist").agg(F.count(F.lit(1)).alias("nh"))
    best = per_distance.groupBy(*READ).agg(F.min(F.struct("dist", "nh")).alias("b")).select(*READ, "b.*")
    chosen = distance.join(best, [*READ, "dist"]).select(*READ, "xi", F.col("nh").cast("int").alias("nh"))
    return gathered.drop("dist").join(chosen, [*READ, "xi"])


def join_split_reads(
    fragments: DataFrame, *, max_dist: int = 200000, genome: DataFrame | None = None, chunk: int = 256
) -> DataFrame:
    """One spliced record per joinable mapping; fusions and circles drop out (see :func:`split_read_report`).

    Records that are not split (``xq`` is null) pass with their own fields; ``nh`` is theirs where the table has it, ``xs`` is null.

    ``xs`` follows the read's strand, or with ``genome`` chunks (rname, start, seq of ``chunk`` bases) the first
    junction with a known splice motif; ``xs_sure`` is false where none is known.
    """
    good = split_mappings(fragments, max_dist=max_dist).filter("reason is null")
    reverse = flags.has(flags.REVERSE, F.col("frags")[0]["flag"])
    if genome is None:
        good = good.withColumns({"xs": F.when(reverse, "-").otherwise("+"), "xs_sure": F.lit(True)})
    else:
        motif = junction_strands(good, genome, chunk=chunk)
        good = good.join(motif, [*READ, "xi"], "left")
        good = good.withColumns({"xs_sure": F.col("motif_strand").isNotNull(), "xs": F.coalesce("motif_strand", F.lit("+"))})
    good = evaluate_once(good, _fold=_fold()).withColumns(_joined_fields())
    good = good.drop("frags", "n_frags", "reason", "mate", "motif_strand", "_fold")
    whole = fragments.filter("xq is null")
    own = {"nh": F.col("nh") if "nh" in fragments.columns else F.lit(None), "xs": F.lit(None), "xs_sure": F.lit(False)}
    kinds = dict(good.dtypes)
    return good.unionByName(whole.select(*[own.get(c, F.col(c)).cast(kinds[c]).alias(c) for c in good.columns]))


def chunk_edges(genome: DataFrame, *, extra: int) -> DataFrame:
    """Chunks with the first ``extra`` bases of the following chunk appended (rname, start, seq)."""
    head = genome.select("rname", F.col("start").alias("_next"), F.substr("seq", F.lit(1), F.lit(extra)).alias("_head"))
    whole = genome.withColumn("_next", F.col("start") + F.length("seq")).join(head, ["rname", "_next"], "left")
    return whole.select("rname", "start", F.concat("seq", F.coalesce("_head", F.lit(""))).alias("seq"))


def junction_motifs(mappings: DataFrame, genome: DataFrame, *, keys: Sequence[str], chunk: int) -> DataFrame:
    """(keys, junction, strand) from the four bases at each junction; ``?`` for no known motif.

    Each different pair of sites is looked up once, in one join with the genome, and its strand joined back.
    """
    n = F.size("frags")
    gaps = F.zip_with(
        F.slice("frags", F.lit(1), n - 1), F.slice("frags", F.lit(2), n),
        lambda a, b: F.struct((a["pos"] - 1 + a["len"]).alias("donor"), (b["pos"] - 3).alias("acceptor")),
    )
    sites = mappings.select(*keys, F.col("frags")[0]["rname"].alias("rname"), F.posexplode(gaps).alias("junction", "g"))
    sites = sites.filter("g.donor is not null and g.acceptor is not null").select(*keys, "rname", "junction", "g.*")
    place = ["rname", "donor", "acceptor"]
    ends = F.array(*[F.struct(F.lit(end).alias("side"), F.col(end).alias("site")) for end in ("donor", "acceptor")])
    looked = sites.select(*place).distinct().select(*place, F.inline(ends))
    # As in ``extract_transcripts``: never a broadcast of the genome.
    text = chunk_edges(genome, extra=1).select("rname", F.col("start").alias("_at"), "seq").hint("merge")
    looked = looked.withColumn("_at", (F.floor(F.col("site") / chunk) * chunk).cast("int")).join(text, ["rname", "_at"], "left")
    two = F.upper(F.substr("seq", F.col("site") - F.col("_at") + 1, F.lit(2)))
    found = looked.groupBy(*place).agg(*[F.max(F.when(F.col("side") == end, two)).alias(f"{end}_bases") for end in ("donor", "acceptor")])
    motif = F.concat("donor_bases", "acceptor_bases")
    strand = F.when(motif.isin(*PLUS_MOTIFS), "+").when(motif.isin(*MINUS_MOTIFS), "-").otherwise("?")
    return sites.join(found.select(*place, strand.alias("strand")), place).select(*keys, "junction", "strand")


def junction_strands(mappings: DataFrame, genome: DataFrame, *, chunk: int) -> DataFrame:
    """Strand of each mapping's first junction with a known motif."""
    known = junction_motifs(mappings, genome, keys=[*READ, "xi"], chunk=chunk).filter("strand <> '?'")
    return known.groupBy(*READ, "xi").agg(F.min_by("strand", "junction").alias("motif_strand"))


def split_read_report(fragments: DataFrame, *, max_dist: int = 200000) -> DataFrame:
    """Per sample: unsplit records, mappings, fusions by reason, and their ratios (0 where undefined)."""
    unsplit = fragments.groupBy("sample").agg(F.count_if(F.col("xq").isNull()).alias("one_fragment"))
    m = split_mappings(fragments, max_dist=max_dist)
    reasons = ("chromosome", "strand", "distance", "overlap", "non_circular", "circular")
    per = m.groupBy("sample").agg(
        F.count(F.lit(1)).alias("split"),
        F.count_if(F.col("n_frags") > 2).alias("split_more"),
        F.count_if(F.col("reason").isNotNull()).alias("fusion"),
        F.count_if(F.col("reason").isNotNull() & (F.col("n_frags") > 2)).alias("fusion_more"),
        *[F.count_if(F.col("reason") == r).alias(r) for r in reasons],
    )
    out = unsplit.join(per, "sample", "left").na.fill(0).withColumn("total", F.col("one_fragment") + F.col("split"))

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    ratios = {"split_of_total": share("split", "total"), "fusion_of_total": share("fusion", "total"), "fusion_of_split": share("fusion", "split")}
    ratios.update({f"{r}_of_fusion": share(r, "fusion") for r in reasons})
    return out.withColumns(ratios)


# Join states of paired split reads.
STATES = ("not_same_chr", "not_same_strand", "max_dist_breached", "fragment_overlap", "order_switch", "OK")


def _state(distance: int) -> Column:
    """Join state of ``frags`` (NULL for a single fragment); a far gap outranks an overlap."""
    first = F.col("frags")[0]
    gaps = F.filter(_neighbours(lambda a, b: b["pos"] - (a["pos"] + a["len"])), lambda g: g.isNotNull())
    in_order = _neighbours(
        lambda a, b: F.when(flags.has(flags.REVERSE, first["flag"]), a["xq"] >= b["xq"]).otherwise(a["xq"] <= b["xq"])
    )
    return (
        F.when(F.size("frags") < 2, F.lit(None).cast("string"))
        .when(F.exists("frags", lambda f: f["rname"] != first["rname"]), STATES[0])
        .when(
            F.exists("frags", lambda f: f["flag"].bitwiseAND(F.lit(16)) != first["flag"].bitwiseAND(F.lit(16))), STATES[1]
        )
        .when(F.exists(gaps, lambda g: g > distance), STATES[2])
        .when(F.exists(gaps, lambda g: g <= 0), STATES[3])
        .when(F.exists(in_order, lambda x: x.isNotNull() & ~x), STATES[4])
        .otherwise(STATES[5])
    )


def template_mappings(
    fragments: DataFrame, *, read_type: str = "paired", distance: int = 200000, library_type: str = "unstranded", seq_type: str = "RNA",
    genome: DataFrame | None = None, chunk: int = 256,
) -> DataFrame:
    """One row per template mapping (sample, qname, xi): joined records ``r1``/``r2``, states, ``suitable``, ``nh``."""
    choice("read_type", read_type, ("single", "paired"))
    choice("library_type", library_type, ("unstranded", "firststrand", "secondstrand"))
    choice("seq_type", seq_type, ("RNA", "DNA"))
    f = fragments
    if read_type == "single":
        f = f.withColumn("flag", flags.clear(flags.SECOND, flags.put(flags.FIRST)))
    f = f.withColumn("mate", flags.mate_number())
    keys = ["sample", "qname", "xi", "mate"]
    rows = evaluate_once(_gathered(f, keys, "read"), state=_state(distance), _fold=_fold())
    rows = rows.withColumn("single", F.col("state").isNull() | (F.col("state") == "OK"))
    motifs = seq_type == "RNA" and library_type == "unstranded" and genome is not None
    mean = F.floor(F.aggregate(F.transform("frags", lambda x: x["mapq"]), F.lit(0), lambda a, x: a + x) / F.size("frags"))
    fields = {**_joined_fields(), "mapq": mean.cast("int")}
    turned = flags.has(flags.REVERSE, fields["flag"])
    if seq_type == "DNA" or library_type == "unstranded":
        xs = F.lit(None).cast("string")
    else:
        same = (F.col("mate") == 2) == turned
        xs = F.when(same if library_type == "firststrand" else ~same, "-").otherwise("+")
    record = F.struct(*[v.alias(k) for k, v in fields.items()], xs.alias("xs"), F.col("state").alias("ys"))
    places = F.when(F.col("state") == "OK", F.transform("frags", lambda x: F.struct(x["rname"], x["pos"], x["len"])))
    rows = rows.select(*keys, "state", "single", "n_frags", F.when(F.col("single"), record).alias("rec"), *[places.alias("frags")] * motifs)
    if motifs:
        # Staged, so that the junctions do not sort and gather the fragments again; of these they need the places only.
        f = rows = stage_table(rows)
        strands = _unanimous(rows.filter("state = 'OK'").select(*keys, "frags"), genome, chunk).dropna(subset=keys)
        rows = rows.drop("frags").unionByName(strands, allowMissingColumns=True)
    else:
        rows = rows.withColumn("motif_strand", F.lit(None).cast("string"))
    # Counted on the keys alone. Strands and counts are rows of their own until the records are gathered, which are shuffled once so.
    mappings = f.select("sample", "qname", "xi").distinct()
    names = mappings.groupBy("sample", "qname").agg(F.count(F.lit(1)).cast("int").alias("nh"))
    counts = mappings.join(names.hint("merge"), ["sample", "qname"])
    rows = rows.unionByName(counts, allowMissingColumns=True)
    columns = (("rec", "r"), ("state", "state"), ("n_frags", "n"), *[("motif_strand", "motif")] * motifs)
    per = rows.groupBy("sample", "qname", "xi").agg(
        *[F.max(F.when(F.col("mate") == m, F.col(c))).alias(f"{a}{m}") for m in (1, 2) for c, a in columns],
        F.bool_and("single").alias("suitable"),
        F.max("nh").alias("nh"),
    )
    if motifs:
        per = per.withColumns({f"r{m}": F.col(f"r{m}").withField("xs", F.col(f"motif{m}")) for m in (1, 2)}).drop("motif1", "motif2")
    # As for other keys, templates without a sample or a name have no count and go.
    return per.filter("nh is not null").select("sample", "qname", "xi", *[f"{a}{m}" for m in (1, 2) for _, a in columns[:3]], "suitable", "nh")


def _unanimous(joinable: DataFrame, genome: DataFrame, chunk: int) -> DataFrame:
    """Motif strand on which all junctions of a read agree; an unknown motif leaves it open."""
    keys = ["sample", "qname", "xi", "mate"]
    sites = junction_motifs(joinable, genome, keys=keys, chunk=chunk)
    per = sites.groupBy(*keys).agg(F.min("strand").alias("lo"), F.max("strand").alias("hi"))
    return per.select(*keys, F.when((F.col("lo") == F.col("hi")) & (F.col("lo") != "?"), F.col("lo")).alias("motif_strand"))


def join_split_reads_pe(fragments: DataFrame, *, read_type: str = "paired", **opts) -> DataFrame:
    """Joined records of suitable template mappings with flags, mate fields, NH, mapping quality and XS set.

    A mapping is suitable when each present mate came down to one record. Template length follows the SAM
    definition: from the leftmost to the rightmost mapped base, negative on the right record.
    """
    m = template_mappings(fragments, read_type=read_type, **opts).filter("suitable")
    sides = F.filter(
        F.array(
            F.struct(F.lit(1).alias("mate"), F.col("r1").alias("me"), F.col("r2").alias("other")),
            F.struct(F.lit(2).alias("mate"), F.col("r2").alias("me"), F.col("r1").alias("other")),
        ),
        lambda s: s["me"].isNotNull(),
    )
    out = m.select("sample", "qname", "xi", "nh", F.explode(sides).alias("s")).select("sample", "qname", "xi", "nh", "s.*")
    me, other = F.col("me"), F.col("other")
    both = other.isNotNull()
    flag = flags.clear(flags.SECONDARY, me["flag"])
    flag = flags.put_if(F.col("nh") > 1, flags.SECONDARY, flag)
    same = both & (me["rname"] == other["rname"])
    tlen, rnext, pnext = F.lit(0), F.col("me.rname"), F.lit(0)
    if read_type == "paired":
        flag = flags.put_if(~both, flags.MATE_UNMAPPED, flag)
        turned, mate_turned = flags.has(flags.REVERSE, me["flag"]), flags.has(flags.REVERSE, other["flag"])
        flag = flags.put_if(both & mate_turned, flags.MATE_REVERSE, flag)
        flag = F.when(both, flags.clear(flags.PROPER, flag)).otherwise(flag)
        facing = (turned & ~mate_turned & (other["pos"] <= me["pos"])) | (~turned & mate_turned & (me["pos"] <= other["pos"]))
        flag = flags.put_if(same & facing, flags.PROPER, flag)
        my_end = me["pos"] + cigar.ref_len(me["cigar"])
        its_end = other["pos"] + cigar.ref_len(other["cigar"])
        span = F.greatest(my_end, its_end) - F.least(me["pos"], other["pos"])
        left = (me["pos"] < other["pos"]) | ((me["pos"] == other["pos"]) & (F.col("mate") == 1))
        tlen = F.when(same, F.when(left, span).otherwise(-span)).otherwise(0)
        rnext = F.when(~both, "*").when(same, "=").otherwise(other["rname"])
        pnext = F.when(both, other["pos"]).otherwise(0)
    else:
        rnext = F.lit("*")
    mapq = F.when(F.col("nh") == 1, 50).when(F.col("nh") == 2, 5).otherwise(0)
    return out.select(
        "sample", "qname", flag.alias("flag"), me["rname"].alias("rname"), me["pos"].alias("pos"), mapq.alias("mapq"),
        me["cigar"].alias("cigar"), rnext.alias("rnext"), pnext.cast("int").alias("pnext"), tlen.cast("int").alias("tlen"),
        me["seq"].alias("seq"), me["qual"].alias("qual"), me["nm"].alias("nm"), me["md"].alias("md"), "nh", "xi",
        me["xs"].alias("xs"), me["ys"].alias("ys"),
    )


def split_template_metrics(fragments: DataFrame, **opts) -> DataFrame:
    """Per sample (direction, metric, n): templates, multiple and unique mappings, splits and their states, in and out.

    Mate and split counts look at mapping 0, as the output decision looks at any suitable mapping.
    """
    m = template_mappings(fragments, **opts)
    zero = F.col("xi") == 0
    t = m.groupBy("sample", "qname").agg(
        F.count(F.lit(1)).alias("k"),
        F.bool_or("suitable").alias("ok"),
        F.bool_or(zero & F.col("n1").isNotNull()).alias("has1"),
        F.bool_or(zero & F.col("n2").isNotNull()).alias("has2"),
        F.max(F.when(zero, F.col("state1"))).alias("state1"),
        F.max(F.when(zero, F.col("state2"))).alias("state2"),
    )
    many, one, ok = F.col("k") > 1, F.col("k") == 1, F.col("ok")

    def splits(state: str | None = None) -> Column:
        hit = [F.when(one & (F.col(f"state{i}").isNotNull() if state is None else F.col(f"state{i}") == state), 1).otherwise(0) for i in (1, 2)]
        return F.sum(hit[0] + hit[1])

    metrics: dict[str, Column] = {}
    for side, cond in (("in", F.lit(True)), ("out", ok)):
        metrics[f"{side}.templates"] = F.count_if(cond)
        metrics[f"{side}.unmapped"] = F.sum(F.lit(0).cast("bigint"))
        metrics[f"{side}.multiple"] = F.count_if(cond & many)
        metrics[f"{side}.unique"] = F.count_if(cond & one)
        for i in (1, 2):
            has = F.col(f"has{i}")
            metrics[f"{side}.multiple.r{i}"] = F.count_if(cond & many & has)
            metrics[f"{side}.unique.r{i}"] = F.count_if(cond & one & has)
    metrics["in.unique.splits"] = splits()
    metrics["out.unique.splits"] = splits("OK")
    for s in STATES:
        metrics[f"in.unique.split_types.{s}"] = splits(s)
    names = list(metrics)
    wide = t.groupBy("sample").agg(*[c.cast("bigint").alias(f"m{i}") for i, c in enumerate(metrics.values())])
    label = F.element_at(F.array(*[F.lit(n) for n in names]), F.substr("v", F.lit(2)).cast("int") + 1)
    long = wide.unpivot("sample", [f"m{i}" for i in range(len(names))], "v", "n").withColumn("full", label)
    return long.select(
        "sample", F.substring_index("full", ".", 1).alias("direction"), F.regexp_replace("full", r"^[a-z]+\.", "").alias("metric"), "n"
    )
