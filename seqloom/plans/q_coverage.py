"""Queries of interval, coverage, signal and peak operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar as CG, flags
from ..operators import alignments as AL, coverage as C, duplicates as D, intervals as I, peaks as P, qc as Q, signal as S
from .book import Book
from .q_alignments import BLOCKS, REF

BOOK = Book()
SAMPLES = ["s0", "s1", "s2"]
TILE = 8192  # far below a sequence length, so that every query crosses tile borders

SPAN = f"""span as (select aln_id, sample, qname, flag, rname, pos, cigar, mapq, pnext, tlen, rnext, nh, case when flag&16>0 then '-' else '+' end strand,
   pos-1 start, pos-1+{REF} "end" from alignments)"""


def _spans(t):
    return t.alignments.select(
        "aln_id", "sample", "rname", CG.start0().alias("start"), CG.end0().alias("end"), flags.strand().alias("strand")
    )


def _exons(t):
    return t.features.select("rname", "start", "end", "strand", "gene_id", "transcript_id", "exon_number")


@BOOK.add(
    "J1_overlap_join",
    f"""with {SPAN} select transcript_id, exon_number, count(*) n, cast(sum(least(s."end",f."end")-greatest(s.start,f.start)) as bigint) shared
       from span s join features f on s.rname=f.rname and s.start<f."end" and f.start<s."end" and s.strand=f.strand
       where least(s."end",f."end")-greatest(s.start,f.start)>=10 group by 1,2""",
    "alignments", "features",
)
def j1(t):
    # Reads of one placement join once, so a locus with very many reads is a few rows.
    places = _spans(t).groupBy("rname", "start", "end", "strand").agg(F.count(F.lit(1)).alias("reads"))
    exons = I.overlap_join(places, _exons(t), min_overlap=10, stranded="same", bin_size=1024, per="right", weight="reads")
    return exons.groupBy("transcript_id", "exon_number").agg(F.sum("n").alias("n"), F.sum("shared").alias("shared"))


@BOOK.add(
    "J1_overlap_semi",
    f"""with {SPAN} select aln_id from span s where exists (select 1 from features f where s.rname=f.rname and s.start-30<=f."end" and f.start<=s."end"+30)""",
    "alignments", "features",
)
def j1b(t):
    return I.overlap_join(_spans(t), _exons(t), how="semi", min_overlap=-30, key=["aln_id"], bin_size=1024, hot_rows=200).select("aln_id")


@BOOK.add(
    "J1_overlap_anti",
    f"""with {SPAN} select aln_id from span s where not exists (select 1 from features f where s.rname=f.rname and s.start<f."end" and f.start<s."end"
       and least(s."end",f."end")-greatest(s.start,f.start)>=0.5*(s."end"-s.start))""",
    "alignments", "features",
)
def j1c(t):
    return I.overlap_join(_spans(t), _exons(t), how="anti", min_fraction=0.5, key=["aln_id"], bin_size=2048).select("aln_id")


@BOOK.add(
    "J1_overlap_left",
    f"""with {SPAN} select s.aln_id, count(f.transcript_id) n, cast(coalesce(sum(case when f.transcript_id is not null then least(s."end",f."end")-greatest(s.start,f.start) end),0) as bigint) shared
       from span s left join features f on s.rname=f.rname and s.start<f."end" and f.start<s."end" and s.strand<>f.strand group by 1""",
    "alignments", "features",
)
def j1d(t):
    # A pair counts where the exon has a transcript, as its name is what is counted.
    named = _exons(t).filter("transcript_id is not null")
    out = I.overlap_join(_spans(t), named, how="left", stranded="opposite", key=["aln_id"], bin_size=2048, per="left")
    return out.groupBy("aln_id").agg(F.sum("n").alias("n"), F.sum("shared").alias("shared"))


@BOOK.add(
    "J4_pair_controls",
    """with s as (select distinct sample from alignments), d as (select sample treatment, case sample when 's0' then 's1' when 's1' then 's2' end control from s)
       select concat_ws('-', treatment, control) run, treatment, control from d""",
    "alignments",
)
def j4(t):
    have = t.alignments.select("sample").distinct()
    design = have.select(
        F.col("sample").alias("treatment"), F.when(F.col("sample") == "s0", "s1").when(F.col("sample") == "s1", "s2").alias("control")
    )
    return C.pair_controls(design, have, have)


@BOOK.add(
    "J6_nearest",
    """with p as (select a.transcript_id, greatest(0, greatest(a.start,b.start)-least(a."end",b."end")) distance, b.start r_start, b."end" r_end, b.transcript_id other
        from transcripts a join transcripts b on a.rname=b.rname and a.strand<>b.strand and b.start<=a."end"+2000 and a.start<=b."end"+2000),
      r as (select *, row_number() over (partition by transcript_id order by distance, r_start, r_end, other) k from p)
      select transcript_id, cast(distance as bigint) distance, cast(r_start as bigint) r_start, other from r where k=1""",
    "features", "transcripts",
)
def j6(t):
    tr = t.transcripts
    out = I.nearest(
        tr.select("transcript_id", "rname", "strand", "start", "end"), tr.select("rname", "start", "end", "strand", "transcript_id"),
        max_distance=2000, key=["transcript_id"], stranded="opposite",
    )
    return out.select(
        "transcript_id", F.col("distance").cast("bigint").alias("distance"), F.col("r_start").cast("bigint").alias("r_start"),
        F.col("r_transcript_id").alias("other"),
    )


_RUNS = """, ev as (select sample, rname, start p, 1 d from iv union all select sample, rname, "end", -1 from iv),
  st as (select sample, rname, p, sum(d) d from ev group by 1,2,3),
  dp as (select sample, rname, p, sum(d) over (partition by sample, rname order by p) depth, lead(p) over (partition by sample, rname order by p) nxt from (select * from st where d<>0)),
  runs as (select sample, rname, cast(p as bigint) start, cast(nxt as bigint) "end", cast(depth as double) "value" from dp where nxt is not null) """


def _long(df):
    return df.withColumns({"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")})


@BOOK.add(
    "C1_genome_coverage",
    f"""with {BLOCKS}, iv as (select a.sample, a.rname, b.start, b."end" from blocks b join alignments a using (aln_id)) {_RUNS} select * from runs where "value"<>0""",
    "alignments",
)
def c1(t):
    return _long(C.genome_coverage(t.alignments, tile=TILE))


@BOOK.add(
    "C1_genome_coverage_zero",
    f"""with {SPAN}, g as (select s.sample, c.rname, c.length from chrom_sizes c, (select unnest(['s0','s1','s2']) sample) s),
       iv as (select sample, rname, start, "end" from span where strand='-'), ev as (select sample, rname, start p, 1 d from iv union all select sample, rname, "end", -1 from iv
         union all select sample, rname, 0, 0 from g union all select sample, rname, length, 0 from g),
       st as (select sample, rname, p, sum(d) d from ev group by 1,2,3),
       dp as (select sample, rname, p, sum(d) over (partition by sample, rname order by p) depth from st),
       cp as (select *, lag(least(depth,6)) over (partition by sample, rname order by p) pv, max(p) over (partition by sample, rname) mx from dp),
       rn as (select sample, rname, p, least(depth,6) depth, lead(p) over (partition by sample, rname order by p) nxt from cp where pv is null or pv<>least(depth,6) or p=mx)
       select sample, rname, cast(p as bigint) start, cast(nxt as bigint) "end", 0.5::double*depth "value" from rn where nxt is not null""",
    "alignments", "chrom_sizes",
)
def c1b(t):
    return _long(
        C.genome_coverage(
            t.alignments, zero=True, chrom_sizes=t.chrom_sizes, samples=SAMPLES, max_depth=6, split=False, strand="-",
            scale=0.5, tile=TILE,
        )
    )


@BOOK.add(
    "C1_genome_coverage_ends",
    f"""with {SPAN}, f as (select sample, rname, case when strand='+' then start else "end"-1 end p from span), iv as (select sample, rname, p start, p+1 "end" from f) {_RUNS} select * from runs where "value"<>0""",
    "alignments",
)
def c1c(t):
    return _long(C.genome_coverage(t.alignments, ends="5", tile=TILE))


_GRID = """g as (select s.sample, c.rname, cast(b.b as bigint) bin, cast(b.b*{step} as int) start, cast(least(b.b*{step}+{size},c.length) as int) "end"
   from chrom_sizes c, (select unnest(['s0','s1','s2']) sample) s, range(0,{max}) b(b) where b.b*{step}<c.length)"""


def _grid(size: int, step: int | None = None) -> str:
    step = step or size
    return _GRID.format(size=size, step=step, max=200000 // step)


def _binned(size: int, where: str = "true") -> str:
    """Dense bin counts of spans as oracle text ending in CTE ``bc``."""
    return f"""with {SPAN}, {_grid(size)},
      tb as (select sample, rname, cast(b as bigint) bin, count(*) n from (select sample, rname, unnest(range(start//{size}, ("end"-1)//{size}+1)) b from span where {where}) group by 1,2,3),
      bc as (select g.*, coalesce(n,0) n from g left join tb using (sample, rname, bin)) """


@BOOK.add("C2_bin_counts", _binned(2000) + "select * from bc", "alignments", "chrom_sizes")
def c2(t):
    return C.bin_counts(t.alignments, bin_size=2000, chrom_sizes=t.chrom_sizes, samples=SAMPLES)


@BOOK.add(
    "C2_bin_counts_filtered",
    f"""with {SPAN}, o as (select sample, rname, pos, strand, pnext, min((cigar,flag,mapq,tlen,rnext)) r from span where flag&2=2 and flag&1028=0 and mapq>=10 and abs(tlen) between 50 and 500 group by all),
       s2 as (select o.sample, o.rname, o.strand, o.pnext, o.pos-1 start, span."end" from o join span on o.sample=span.sample and o.rname=span.rname and o.pos=span.pos and o.strand=span.strand and o.pnext=span.pnext and (span.cigar,span.flag,span.mapq,span.tlen,span.rnext)=o.r group by all)
       select sample, rname, cast(b as bigint) bin, count(*) n from s2, range(0,150) r(b) where s2.start<b*1500+1000 and s2."end">b*1500 group by 1,2,3""",
    "alignments",
)
def c2b(t):
    return C.bin_counts(
        t.alignments, bin_size=1000, gap=500, min_mapq=10, include=2, exclude=1024, min_fragment=50, max_fragment=500, ignore_duplicates=True
    )


def _regions(t):
    return t.features.select("rname", "start", "end", F.col("transcript_id").alias("name"))


@BOOK.add(
    "C3_region_counts",
    f"""with {SPAN}, c as (select sample, f.transcript_id "name", f.rname, f.start, f."end", count(*) n from span s join features f on s.rname=f.rname and s.start<f."end" and f.start<s."end" group by all)
       select s.sample, f.transcript_id "name", f.rname, f.start, f."end", coalesce(c.n,0) n from features f cross join (select unnest(['s0','s1','s2']) sample) s
       left join c on c.sample=s.sample and c."name"=f.transcript_id and c.start=f.start""",
    "alignments", "features",
)
def c3(t):
    return C.region_counts(t.alignments, _regions(t), samples=SAMPLES)


@BOOK.add(
    "C3_region_counts_metagene",
    f"""with {SPAN}, c as (select sample, f.gene_id "name", count(distinct aln_id) n from span s join features f on s.rname=f.rname and s.start<f."end" and f.start<s."end" group by all)
       select s.sample, f."name", coalesce(c.n,0) n from (select distinct gene_id "name" from features) f cross join (select unnest(['s0','s1','s2']) sample) s left join c on c.sample=s.sample and c."name"=f."name" """,
    "alignments", "features",
)
def c3b(t):
    genes = t.features.select("rname", "start", "end", F.col("gene_id").alias("name"))
    return C.region_counts(t.alignments, genes, samples=SAMPLES, metagene=True)


_EXT = f"""with {SPAN}, ex as (select aln_id, sample, rname, strand, greatest(0, case when pr and tlen>0 then start when pr then "end"+tlen when "end"-start<300 and strand='-' then "end"-300 else start end) start,
   case when pr and tlen>0 then start+tlen when pr then "end" when "end"-start<300 and strand='+' then start+300 else "end" end "end"
   from (select *, flag&3=3 and tlen<>0 and abs(tlen)<=1200 pr from span)) """


@BOOK.add("C4_extend_reads", _EXT + 'select aln_id, cast(start as bigint) start, cast("end" as bigint) "end" from ex', "alignments")
def c4(t):
    return _long(C.extend_reads(t.alignments, length=300)).select("aln_id", "start", "end")


_EXT_MEAN = f"""with {SPAN}, ln as (select sample, cast(floor(avg(tlen)) as int) l from span where flag&3=3 and tlen>0 group by 1),
   ex as (select aln_id, greatest(0, case when pr and tlen>0 then start when pr then "end"+tlen when "end"-start<l and strand='-' then "end"-l else start end) start,
   case when pr and tlen>0 then start+tlen when pr then "end" when "end"-start<l and strand='+' then start+l else "end" end "end"
   from (select *, flag&3=3 and tlen<>0 and abs(tlen)<=4*l pr from span join ln using (sample))) """


@BOOK.add("C4_extend_reads_mean", _EXT_MEAN + 'select aln_id, cast(start as bigint) start, cast("end" as bigint) "end" from ex', "alignments")
def c4d(t):
    return _long(C.extend_reads(t.alignments)).select("aln_id", "start", "end")


@BOOK.add(
    "C4_center_reads",
    _EXT + 'select aln_id, cast(greatest(0,floor((start+"end"-50)/2)) as bigint) start, cast(greatest(0,floor((start+"end"-50)/2))+50 as bigint) "end" from ex',
    "alignments",
)
def c4b(t):
    return _long(C.center_reads(C.extend_reads(t.alignments, length=300), read_len=50)).select("aln_id", "start", "end")


@BOOK.add(
    "C4_shift_reads",
    f"""with {SPAN}, x as (select aln_id, case when strand='+' then start+75 else "end"-75-150 end s from span)
       select aln_id, cast(greatest(s,0) as bigint) start, cast(s+150 as bigint) "end" from x where s+150>0""",
    "alignments",
)
def c4c(t):
    return _long(C.shift_reads(_spans(t), shift=75, ext=150)).select("aln_id", "start", "end")


def _bins(t, size):
    return C.bin_counts(t.alignments, bin_size=size, chrom_sizes=t.chrom_sizes, samples=SAMPLES)


def _totals(t):
    return t.alignments.groupBy("sample", "rname").agg(F.count(F.lit(1)).alias("mapped"))


_TOT = """, tt as (select sample, count(*) mapped from alignments where rname<>'chr5' group by 1) """


@BOOK.add(
    "C5_normalize_rpkm",
    _binned(2000) + _TOT + """select sample, rname, bin, n/(mapped/1e6*(("end"-start)/1000.0::double)) "value" from bc join tt using (sample)""",
    "alignments", "chrom_sizes",
)
def c5(t):
    out = S.normalize(_bins(t, 2000), method="rpkm", totals=_totals(t), ignore=["chr5"])
    return out.select("sample", "rname", "bin", "value")


@BOOK.add(
    "C5_normalize_depth",
    _binned(2000) + _TOT + """select sample, rname, bin, n/(mapped*200.0::double/600000.0::double) "value" from bc join tt using (sample)""",
    "alignments", "chrom_sizes",
)
def c5b(t):
    out = S.normalize(_bins(t, 2000), method="1x", totals=_totals(t), genome_size=600000, fragment_len=200, ignore=["chr5"])
    return out.select("sample", "rname", "bin", "value")


@BOOK.add(
    "C5_normalize_readcount",
    _binned(2000) + _TOT + """select sample, rname, bin, n*((select min(mapped) from tt)/mapped) "value" from bc join tt using (sample)""",
    "alignments", "chrom_sizes",
)
def c5c(t):
    out = S.normalize(_bins(t, 2000), method="readcount", totals=_totals(t), ignore=["chr5"])
    return out.select("sample", "rname", "bin", "value")


_PAIRS = ", design(run, treatment, control) as (values ('a','s0','s1'), ('b','s0','s2'), ('c','s2','s1')) "


def _design(t):
    return t.spark.createDataFrame([("a", "s0", "s1"), ("b", "s0", "s2"), ("c", "s2", "s1")], "run string, treatment string, control string")


@BOOK.add(
    "C5_ses_factor",
    _binned(500) + _PAIRS + """, j as (select run, a.n a, b.n b from design join bc a on a.sample=treatment join bc b on b.sample=control and a.rname=b.rname and a.bin=b.bin),
       r as (select run, a, sum(a) over (partition by run order by a) ca, sum(b) over (partition by run order by a) cb, sum(a) over (partition by run) ta, sum(b) over (partition by run) tb from j),
       m as (select run, min((ca/ta-cb/tb, a)) x from r group by 1)
       select distinct run, a "cut", cast(ca as bigint) first_sum, cast(cb as bigint) second_sum, ca/cb factor from r join m using (run) where a=x[2]""",
    "alignments", "chrom_sizes",
)
def c5d(t):
    return S.ses_factors(_bins(t, 500), _design(t))


_CMP = {
    "log2": "log2((a+1)/(b+1))", "ratio": "(a+1)/(b+1)", "subtract": "a-b", "add": "a+b", "mean": "(a+b)/2.0::double",
    "reciprocal_ratio": "case when (a+1)/(b+1)<1 then -1.0::double/((a+1)/(b+1)) else (a+1)/(b+1) end", "first": "a", "second": "b",
}


@BOOK.add(
    "C6_compare_signal",
    _binned(100) + _PAIRS + """, p as (select rname, bin, n::double n, sample from bc where n>0),
       x as (select run, rname, bin, n a, 0 b from design join p on sample=treatment union all select run, rname, bin, 0, n from design join p on sample=control),
       j as (select run, rname, bin, sum(a) a, sum(b) b from x group by 1,2,3) """
    + " union all ".join(f"select '{k}' op, run, rname, bin, {v} \"value\" from j" for k, v in _CMP.items()),
    "alignments", "chrom_sizes",
)
def c6(t):
    bins = C.bin_counts(t.alignments, bin_size=100).withColumn("value", F.col("n").cast("double"))
    return S.compare_signal(bins, _design(t), op=S.OPERATIONS)


@BOOK.add(
    "C7_smooth",
    _binned(500) + """select sample, rname, bin, avg(n) over (partition by sample, rname order by bin rows between 2 preceding and 2 following) "value" from bc""",
    "alignments", "chrom_sizes",
)
def c7(t):
    bins = _bins(t, 500).withColumn("value", F.col("n").cast("double"))
    out = S.moving_mean(bins, "value", reach=2, out="mean", tile=32)
    return out.select("sample", "rname", "bin", F.col("mean").alias("value"))


@BOOK.add(
    "C8_drop_non_covered",
    _binned(100) + """select sample, rname, bin, n from (select *, sum(n) over (partition by rname, bin) tot from bc) where tot>0""",
    "alignments", "chrom_sizes",
)
def c8(t):
    bins = C.bin_counts(t.alignments, bin_size=100, chrom_sizes=t.chrom_sizes, samples=SAMPLES)
    return S.drop_non_covered(bins).select("sample", "rname", "bin", "n")


@BOOK.add(
    "C9_fingerprint",
    _binned(500) + """select distinct sample, n, count(*) over (partition by sample, n) bins, cume_dist() over (partition by sample order by n) bin_share,
       cast(sum(n) over (partition by sample order by n) as double)/sum(n) over (partition by sample) read_share from bc""",
    "alignments", "chrom_sizes",
)
def c9(t):
    return S.fingerprint(_bins(t, 500))


@BOOK.add(
    "C9_fingerprint_distance",
    _binned(500) + """, h as (select sample, n, count(*)/sum(count(*)) over (partition by sample) p from bc group by 1,2),
       v as (select distinct s.sample, h.n from h, (select distinct sample from h where sample<>'s0') s),
       j as (select v.sample, v.n, coalesce(a.p,0)::double p, coalesce(b.p,0)::double q from v left join h a on a.sample=v.sample and a.n=v.n left join h b on b.sample='s0' and b.n=v.n)
       select sample, sqrt(sum((case when p>0 then p*log2(p/((p+q)/2)) else 0 end + case when q>0 then q*log2(q/((p+q)/2)) else 0 end)/2)) distance from j group by 1""",
    "alignments", "chrom_sizes",
)
def c9b(t):
    return S.fingerprint_distance(_bins(t, 500), reference="s0")


_FIVE = f"""with {SPAN}, {_grid(200)},
  tb as (select sample, rname, cast(greatest(case when strand='+' then start+100 else "end"-1-100 end,0)//200 as bigint) bin, count(*) n from span group by 1,2,3),
  bc as (select g.*, coalesce(n,0) n from g left join tb using (sample, rname, bin)) """
_TAIL = "(1-list_sum(list_transform(range(0,n), lambda i: exp(i*ln(lam)-lam-lgamma(i+1)))))"


def _five(t):
    return S.densify(S.shifted_bins(t.alignments), I.grid(t.chrom_sizes, bin_size=200), SAMPLES)


@BOOK.add(
    "C10_binarize",
    _FIVE + f""", m as (select *, avg(n) over (partition by sample) lam from bc) select sample, rname, bin, n, case when n>0 and {_TAIL}<0.01 then 1 else 0 end state from m""",
    "alignments", "chrom_sizes",
)
def c10(t):
    return S.binarize(_five(t), p=0.01).select("sample", "rname", "bin", "n", "state")


@BOOK.add(
    "C10_binarize_control",
    _FIVE + f""", c as (select rname, bin, (avg(n+1) over (partition by rname order by bin rows between 5 preceding and 5 following))/(avg(n+1) over ()) e from bc where sample='s2'),
       m as (select bc.*, (avg(n) over (partition by sample))*e lam from bc join c using (rname, bin) where sample<>'s2')
       select sample, rname, bin, n, case when n>0 and {_TAIL}<0.01 and n>=2*lam and n>=3 then 1 else 0 end state from m""",
    "alignments", "chrom_sizes",
)
def c10b(t):
    bins = _five(t)
    out = S.binarize(bins.filter("sample <> 's2'"), control=bins.filter("sample = 's2'"), p=0.01, fold=2.0, min_signal=3)
    return out.select("sample", "rname", "bin", "n", "state")


@BOOK.add(
    "C10_binarize_peaks",
    _FIVE + """, pk as (select distinct concat('s',cast(exon_number-1 as varchar)) sample, rname, start, "end" from features)
      select bc.sample, bc.rname, bc.bin, cast(bool_or(pk.start is not null) as int) state from bc left join pk on pk.sample=bc.sample and pk.rname=bc.rname and pk.start<bc."end" and bc.start<pk."end" group by 1,2,3""",
    "alignments", "chrom_sizes", "features",
)
def c10c(t):
    pk = t.features.select(F.concat(F.lit("s"), (F.col("exon_number") - 1).cast("string")).alias("sample"), "rname", "start", "end")
    return S.binarize_peaks(_five(t), pk).select("sample", "rname", "bin", "state")


def _tags(t):
    """Tags with planted enrichment: names ending in 3 pile up in one spot of every 5,000 bases."""
    bed = AL.to_bed(t.alignments.filter("flag & 256 = 0"))
    spot = F.col("start") - F.col("start") % 5000 + F.col("start") % 90
    moved = F.when(F.substring_index("name", "/", 1).endswith("3"), spot).otherwise(F.col("start")).cast("int")
    return bed.withColumn("end", moved + 36).withColumn("start", moved)


def _peaks_oracle(treat: str, control: str | None, *, cutoff: str, gap: int, broad: bool) -> str:
    """Pileup, Poisson tail summed upwards, Benjamini-Hochberg over bases, islands and summits for ext 150 and gsize 600000."""
    around = lambda src, w, cols: (
        f"""select sample, rname, greatest(five-{w // 2},0) s, five-{w // 2}+{w} e, {cols} from (select *, case when strand='-' then "end" else start end five from {src})"""
    )
    back = control or treat
    layers = [f"""select sample, rname, case when strand='-' then greatest("end"-150,0) else start end s, case when strand='-' then "end" else start+150 end e, 1 t, 0 a, 0 b, 0 c from {treat}"""]
    if control:
        layers += [around(control, 150, "0 t, 1 a, 0 b, 0 c"), around(control, 1000, "0 t, 0 a, 1 b, 0 c")]
    layers.append(around(back, 10000, "0 t, 0 a, 0 b, 1 c"))
    sizes = f"(select sample, count(*) nt from {treat} group by 1) left join (select sample, count(*) nc from {back} group by 1) using (sample)"
    wide = "(t*ft) pileup, greatest(bg, a*fc, b*fc*(150.0::double/1000), c*fc*(150.0::double/10000)) lam"
    islands = lambda name, src, g: (
        f"""{name}x as (select *, max("end") over (partition by sample, rname order by start rows between unbounded preceding and 1 preceding) reach from {src}),
      {name}f as (select *, sum(case when reach is null or start>reach+{g} then 1 else 0 end) over (partition by sample, rname order by start rows unbounded preceding) isl from {name}x),
      {name} as (select sample, rname, min(start) start, max("end") "end" from {name}f group by sample, rname, isl having max("end")-min(start)>=150)"""
    )
    kept, final = "above", "narrow"
    tail = islands("narrow", "above", gap)
    if broad:
        kept, final = "wider", "hold"
        tail += f""", wider as (select * from scored where score >= -log10(0.1)), {islands("large", "wider", 4 * gap)},
      hold as (select l.* from large l where exists (select 1 from narrow n where n.sample=l.sample and n.rname=l.rname and n.start<l."end" and l.start<n."end"))"""
    return f""", iv as ({" union all ".join(layers)}),
      ev as (select sample, rname, s p, t, a, b, c from iv where e>s union all select sample, rname, e, -t, -a, -b, -c from iv where e>s),
      st as (select sample, rname, p, sum(t) t, sum(a) a, sum(b) b, sum(c) c from ev group by 1,2,3 having sum(t)<>0 or sum(a)<>0 or sum(b)<>0 or sum(c)<>0),
      dp as (select sample, rname, p, lead(p) over w nxt, cast(sum(t) over w as bigint) t, cast(sum(a) over w as bigint) a, cast(sum(b) over w as bigint) b, cast(sum(c) over w as bigint) c from st window w as (partition by sample, rname order by p)),
      sz as (select sample, g/nt::double ft, case when nc>0 then g/nc::double else 0.0 end fc, g*(150/600000.0::double) bg from (select sample, nt, coalesce(nc,0) nc, case when coalesce(nc,0)>0 then least(nt,nc) else nt end g from {sizes})),
      pl as (select sample, rname, p start, nxt "end", {wide} from dp join sz using (sample) where nxt is not null),
      kl as (select distinct cast(ceil(pileup) as bigint) k, lam from pl),
      tl as (select k, lam, case when k<=0 then 0.0 else round(-log10(list_sum(list_transform(range(k, k+120+cast(3*lam as bigint)), lambda i: exp(i*ln(lam)-lam-lgamma(i+1))))),3)+0.0 end score from kl),
      sc as (select pl.*, score from pl join tl on tl.lam=pl.lam and tl.k=cast(ceil(pileup) as bigint)),
      rk as (select sample, score, sum("end"-start) len from sc group by 1,2),
      qv as (select *, greatest(score+log10((sum(len) over (partition by sample order by score desc)-len+1)/(sum(len) over (partition by sample))), 0.0) q0 from rk),
      qs as (select sample, score, max(q0) over (partition by sample order by score) qscore from qv),
      scored as (select sc.*, qscore from sc join qs using (sample, score)),
      above as (select * from scored where {cutoff}),
      {tail},
      hits as (select g.sample, g.rname, g.start gs, g."end" ge, min((-k.pileup, k.start, k."end", k.lam, k.score, k.qscore)) m from {final} g join {kept} k on k.sample=g.sample and k.rname=g.rname and k.start<g."end" and g.start<k."end" group by 1,2,3,4)
      select sample, rname, gs start, ge "end", (m[2]+m[3])//2 summit, -m[1] pileup, (1-m[1])/(m[4]+1) fold, m[5] score, m[6] qscore from hits"""


_TAGS = f"""with b0 as (select sample, rname, pos-1 start, pos-1+{REF} "end", qname, case when flag&128>0 then '/2' else '/1' end mate, case when flag&16>0 then '-' else '+' end strand from alignments where flag&256=0),
  tags as (select sample, rname, s start, s+36 "end", concat(qname,mate) "name", strand from (select *, case when qname like '%3' then start-start%5000+start%90 else start end s from b0)) """


@BOOK.add(
    "C11_call_peaks",
    _TAGS + """, kd as (select * from (select *, row_number() over (partition by sample, rname, case when strand='-' then "end"-1 else start end, strand order by "name") r from tags) where r<=2 and sample<>'s2'),
      ct as (select x.sample, rname, start, "end", strand from b0, (values ('s0'),('s1')) x(sample) where b0.sample='s2')"""
    + _peaks_oracle("kd", "ct", cutoff="qscore >= -log10(0.05)", gap=36, broad=False),
    "alignments",
)
def c11(t):
    tags = D.keep_dup(_tags(t), k=2)
    treat = tags.filter("sample <> 's2'")
    control = AL.to_bed(t.alignments.filter("flag & 256 = 0 and sample = 's2'"))
    control = control.withColumn("sample", F.explode(F.array(F.lit("s0"), F.lit("s1"))))
    return P.call_peaks(treat, control, gsize=600000.0, ext=150, max_gap=36)


@BOOK.add("C11_call_peaks_broad", _TAGS + _peaks_oracle("tags", None, cutoff="score >= 4", gap=36, broad=True), "alignments")
def c11b(t):
    return P.call_peaks(_tags(t), gsize=600000.0, ext=150, max_gap=36, p=1e-4, broad=True)


@BOOK.add(
    "C12_enriched_bins",
    _binned(250) + f""", m as (select *, avg(n) over (partition by sample) lam from bc), q as (select sample, rname, bin, n, {_TAIL} pv from m where n>0)
       select sample, rname, bin, n, round(-log10(pv),5) score from q where pv<=0.01""",
    "alignments", "chrom_sizes",
)
def c12(t):
    return P.enriched_bins(_bins(t, 250), p=0.01).select("sample", "rname", "bin", "n", F.round("score", 5).alias("score"))


@BOOK.add(
    "C12_enriched_bins_truncated",
    f"""with {SPAN}, f0 as (select sample, rname, cast(b as bigint) bin, count(*) n from (select sample, rname, unnest(range(start//250, ("end"-1)//250+1)) b from span) group by 1,2,3),
      mm as (select sample, avg(n) m from f0 group by 1),
      bi as (with recursive b(sample, m, lo, hi, i) as (select sample, m, 0.0::double, m, 0 from mm union all
        select sample, m, case when (lo+hi)/2 > m*(1-exp(-(lo+hi)/2)) then lo else (lo+hi)/2 end, case when (lo+hi)/2 > m*(1-exp(-(lo+hi)/2)) then (lo+hi)/2 else hi end, i+1 from b where i<100) select * from b),
      l as (select sample, (lo+hi)/2 lam from bi where i=100),
      q as (select sample, rname, bin, n, {_TAIL}/(1-exp(-lam)) pv from f0 join l using (sample))
      select sample, rname, bin, n, round(-log10(pv),5) score from q where pv<=0.05""",
    "alignments",
)
def c12b(t):
    bins = C.bin_counts(t.alignments, bin_size=250)
    out = P.enriched_bins(bins, p=0.05, dist="zero_truncated")
    return out.select("sample", "rname", "bin", "n", F.round("score", 5).alias("score"))


_MERGE = """, mx as (select *, max("end") over (partition by {by} order by start, "end" rows between unbounded preceding and 1 preceding) reach from {src}),
  fl as (select *, sum(case when reach is null or start>reach+{gap} then 1 else 0 end) over (partition by {by} order by start, "end" rows unbounded preceding) isl from mx),
  merged as (select {by}, min(start) start, max("end") "end", count(*) n from fl group by {by}, isl) """


@BOOK.add(
    "C13_merge_intervals",
    "with x as (select 1)" + _MERGE.format(by="gene_id, rname", src="features", gap=20)
    + 'select gene_id, rname, cast(start as bigint) start, cast("end" as bigint) "end", n from merged',
    "features",
)
def c13(t):
    return _long(I.merge_intervals(t.features, gap=20, by=["gene_id", "rname"], tile=2048))


@BOOK.add(
    "C14_merge_coverage_matrices",
    f"""with {SPAN}, c as (select concat(sample,':',rname) label, cast(start//1000 as bigint) bin_id, count(*) n from span group by 1,2),
       d as (select label, max(bin_id) mx from c group by 1)
       select label, bin_id, n from c union all select label, cast(b as bigint), 0 from d, range(0, (select max(mx)+1 from d)) r(b) where b>mx""",
    "alignments",
)
def c14(t):
    # One matrix per sample and sequence; they end where their last reads begin.
    label = F.concat_ws(":", "sample", "rname").alias("label")
    return C.pad_coverage(_spans(t).groupBy(label, F.floor(F.col("start") / 1000).alias("bin_id")).agg(F.count(F.lit(1)).alias("n")))


@BOOK.add(
    "C15_complexity_curve",
    """with h as (select sample, occurrence j, count(*) h from (select sample, seq, count(*) occurrence from text_reads group by 1,2) group by 1,2),
       t as (select sample, sum(j*h)::double nn from h group by 1),
       s as (select sample, nn, cast(k*20 as bigint) size from t, range(1, 3000) r(k) where k*20<=nn)
       select sample, size, round(sum(h*(1-case when j+size>nn then 0 else exp(lgamma(nn-j+1)-lgamma(nn-j-size+1)-lgamma(nn+1)+lgamma(nn-size+1)) end)),6) distinct_reads from h join s using (sample) group by 1,2""",
    "text_reads",
)
def c15(t):
    out = P.complexity_curve(Q.read_duplication(t.text_reads, by="seq"), step=20)
    return out.withColumn("distinct_reads", F.round("distinct_reads", 6))


_PK = "with pk as (select gene_id sample, rname, min(start) start, max(\"end\") \"end\" from features group by 1,2), " + SPAN


@BOOK.add(
    "C16_split_peaks",
    _PK + """, design(sample, control) as (values ('s0','s1'), ('s1','s2'), ('s2',null)),
      pd as (select distinct d.sample, d.control, pk.rname, pk.start, pk."end" from pk, design d),
      c as (select pd.sample, pd.control, pd.rname, pd.start, pd."end", count(*) filter (where s.sample=pd.sample) chip, count(*) filter (where s.sample=pd.control) inp
        from pd left join span s on s.rname=pd.rname and s.start<pd."end" and pd.start<s."end" group by all),
      n as (select sample, count(*) n from alignments group by 1),
      f as (select d.sample, coalesce(a.n/b.n, 0.0) f from design d join n a using (sample) left join n b on b.sample=d.control)
      select sample, rname, start, "end", chip, inp "input", (chip+1)/(inp*f+1) ratio, (chip+1)/(inp*f+1)>=1.05 passed from c join f using (sample)""",
    "alignments", "features",
)
def c16(t):
    pk = t.features.groupBy("gene_id", "rname").agg(F.min("start").alias("start"), F.max("end").alias("end")).select("rname", "start", "end").distinct()
    pk = pk.select(F.explode(F.array(*map(F.lit, ("s0", "s1", "s2")))).alias("sample"), "*")
    reads = _spans(t)
    # The design: s1 is the control of s0, s2 that of s1, and s2 has none.
    serves = F.create_map(F.lit("s1"), F.lit("s0"), F.lit("s2"), F.lit("s1"))
    control = reads.withColumn("sample", F.try_element_at(serves, F.col("sample"))).filter("sample is not null")
    return P.split_peaks(pk, reads, control, min_ratio=1.05)


@BOOK.add(
    "A20_exclude_blacklist",
    _binned(500) + """select sample, rname, bin, n from bc where not exists (select 1 from features f where f.exon_number=3 and f.rname=bc.rname and f.start<bc."end" and bc.start<f."end")""",
    "alignments", "chrom_sizes", "features",
)
def a20b(t):
    black = t.features.filter("exon_number = 3")
    return C.exclude_blacklist(_bins(t, 500), black).select("sample", "rname", "bin", "n")
