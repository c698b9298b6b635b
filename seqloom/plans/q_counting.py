"""Queries of feature counting and expression tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import counting as X, counts as C, coverage as CV
from .book import Book
from .q_alignments import BLOCKS
from .q_coverage import SAMPLES, SPAN

BOOK = Book()


def _t2g(t):
    return t.t2g.withColumnRenamed("transcript_id", "target_id")


@BOOK.add(
    "J2_key_join_counts",
    "select sample, target_id, count, gene_id from counts join t2g on target_id=transcript_id",
    "counts", "t2g",
)
def j2(t):
    return C.key_join_counts(t.counts, _t2g(t)).select("sample", "target_id", "count", "gene_id")


@BOOK.add(
    "X4_transcripts_to_genes",
    """select sample, gene_id, sum(count) count, printf('%.6f', sum(count)) "text"
       from counts join t2g on target_id=transcript_id group by sample, gene_id""",
    "counts", "t2g",
)
def x4(t):
    return C.transcripts_to_genes(t.counts, _t2g(t))


@BOOK.add(
    "X4_last_mapping",
    "select transcript_id target_id, max_by(gene_id, exon_number) gene_id from (select transcript_id, exon_number, concat(gene_id,'_',cast(exon_number as varchar)) gene_id from features) group by 1",
    "features",
)
def x4b(t):
    m = t.features.select(
        F.col("transcript_id").alias("target_id"), "exon_number", F.concat_ws("_", "gene_id", F.col("exon_number").cast("string")).alias("gene_id")
    )
    return C.last_mapping(m, order="exon_number")


@BOOK.add(
    "X5_transcripts_to_genes_extended",
    """select sample, gene_id, 'NA' length, 'NA' eff_length, sum(count) count, sum(tpm) tpm, string_agg(target_id, ',' order by k) transcripts,
         string_agg(printf('%.1f',length), ',' order by k) lengths, string_agg(printf('%.1f',eff_length), ',' order by k) eff_lengths, string_agg(printf('%.1f',count), ',' order by k) counts,
         string_agg(printf('%.1f',tpm), ',' order by k) tpms
       from (select *, cast(substr(target_id,2) as bigint) k from counts) c join t2g on target_id=transcript_id group by sample, gene_id""",
    "counts", "t2g",
)
def x5(t):
    counts = t.counts.withColumn("ord", F.substr("target_id", F.lit(2)).cast("bigint"))
    return C.transcripts_to_genes_extended(counts, _t2g(t), order="ord")


@BOOK.add("X3_merge_counts", "select target_id, cast(sum(count) as bigint) count from counts group by 1", "counts")
def x3(t):
    parts = [t.counts.filter(F.col("sample") == s) for s in SAMPLES]
    return C.merge_counts(parts, tool="fc", same_genes=False)


@BOOK.add(
    "X6_count_matrix",
    """with g as (select gene_id, sample, sum(ceil(count*eff_length/75.0::double)) n from counts join t2g on target_id=transcript_id group by 1,2)
       select gene_id, cast(coalesce(sum(n) filter (where sample='s0'),0) as bigint) s0, cast(coalesce(sum(n) filter (where sample='s1'),0) as bigint) s1,
         cast(coalesce(sum(n) filter (where sample='s2'),0) as bigint) s2 from g group by 1""",
    "counts", "t2g",
)
def x6(t):
    cov = t.counts.select("sample", "target_id", F.col("count").alias("cov"), F.col("eff_length").alias("length"))
    genes = C.key_join_counts(C.counts_from_coverage(cov, read_len=75), _t2g(t))
    return C.count_matrix(genes, SAMPLES, key="gene_id")


@BOOK.add(
    "X6_gene_clusters",
    """with g as (select gene_id, rname, min(start) start, max("end") "end" from features group by 1,2),
         mx as (select *, max("end") over (partition by rname order by start, gene_id rows between unbounded preceding and 1 preceding) reach from g),
         cl as (select *, sum(case when reach is null or start>reach then 1 else 0 end) over (partition by rname order by start, gene_id) isl from mx)
       select gene_id, concat('cluster_',rname,'_',cast(min(start) over (partition by rname, isl) as varchar)) cluster_id, count(*) over (partition by rname, isl) n_genes from cl""",
    "features",
)
def x6b(t):
    genes = t.features.groupBy("gene_id", "rname").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return C.gene_clusters(genes)


_HIT = """with {blocks}, rd as (select a.*, case when (flag&129)=129 then case when flag&16>0 then '+' else '-' end else case when flag&16>0 then '-' else '+' end end st from alignments a),
  ok as (select * from rd where {keep}),
  hp as (select ok.aln_id, f.{target} target, greatest(b.start,f.start) s, least(b."end",f."end") e from ok join blocks b using (aln_id)
        join features f on f.rname=ok.rname and b.start<f."end" and f.start<b."end" {strand}),
  h as (select aln_id, target, count(distinct p) bases from (select aln_id, target, unnest(range(s,e)) p from hp) group by 1,2 having count(distinct p)>={minov}),
  pr as (select aln_id, count(*) k, min(target) target from h group by 1) """


def _hit(keep: str = "nh=1", strand: str = "", target: str = "gene_id", minov: int = 1) -> str:
    return _HIT.format(blocks=BLOCKS, keep=keep, strand=strand, target=target, minov=minov)


_ZERO = """, gs as (select distinct gene_id target, s.sample from features, (select unnest(['s0','s1','s2']) sample) s) """


@BOOK.add(
    "X1_feature_counts",
    _hit() + _ZERO + ", c as (select sample, target, count(*) n from pr join alignments using (aln_id) where k=1 group by 1,2) select gs.sample, gs.target, coalesce(n,0) n from gs left join c using (sample, target)",
    "alignments", "features",
)
def x1(t):
    return X.feature_counts(t.alignments, t.features, samples=SAMPLES)


@BOOK.add(
    "X1_feature_counts_stranded_overlap",
    _hit("flag&256=0 and mapq>=10 and flag&1024=0", "and f.strand<>ok.st", minov=5) + _ZERO
    + ", c as (select sample, target, count(*) n from h join alignments using (aln_id) group by 1,2) select gs.sample, gs.target, coalesce(n,0) n from gs left join c using (sample, target)",
    "alignments", "features",
)
def x1b(t):
    return X.feature_counts(
        t.alignments, t.features, samples=SAMPLES, strandness=2, multi_overlap=True, primary=True, min_mapq=10, ignore_dup=True, min_overlap=5
    )


@BOOK.add(
    "X1_assignment_summary",
    _hit("mapq>=5 and not (rnext not in ('=','*') and rnext<>rname) and nh=1 and contains(cigar,'N')")
    + """select sample, case when mapq<5 then 'Unassigned_MappingQuality' when rnext not in ('=','*') and rnext<>rname then 'Unassigned_Chimera' when nh>1 then 'Unassigned_MultiMapping'
          when not contains(cigar,'N') then 'Unassigned_NonSplit' when k is null then 'Unassigned_NoFeatures' when k>1 then 'Unassigned_Ambiguity' else 'Assigned' end status, count(*) n
        from alignments left join pr using (aln_id) group by 1,2""",
    "alignments", "features",
)
def x1c(t):
    return X.assignment_summary(t.alignments, t.features, min_mapq=5, no_chimeras=True, split_only=True)


@BOOK.add(
    "X1_read_assignments",
    _hit("true", "and f.strand=ok.st", target="transcript_id")
    + """select aln_id, case when k is null then 'Unassigned_NoFeatures' when k>1 then 'Unassigned_Ambiguity' else 'Assigned' end status, case when k=1 then k else 0 end n_targets, case when k=1 then target end target
        from alignments left join pr using (aln_id)""",
    "alignments", "features",
)
def x1d(t):
    out = X.read_assignments(t.alignments, t.features, multi=True, strandness=1, group="transcript_id")
    return out.select("aln_id", "status", "n_targets", "target")


@BOOK.add(
    "X1_feature_counts_fragments",
    f"""with {BLOCKS}, u as (select *, case when rnext='=' then least(pos,pnext) else pos end lo, case when rnext='=' then greatest(pos,pnext) else pos end hi from alignments),
        fr as (select sample, qname, lo, hi, bool_and(nh=1 and abs(tlen) between 50 and 600) ok from u group by 1,2,3,4),
        h as (select distinct fr.sample, fr.qname, fr.lo, fr.hi, f.gene_id from fr join u using (sample, qname, lo, hi) join blocks b using (aln_id) join features f on f.rname=u.rname and b.start<f."end" and f.start<b."end" where fr.ok),
        pr as (select sample, qname, lo, hi, count(*) k, min(gene_id) target from h group by 1,2,3,4), c as (select sample, target, count(*) n from pr where k=1 group by 1,2)"""
    + _ZERO + "select gs.sample, gs.target, coalesce(n,0) n from gs left join c using (sample, target)",
    "alignments", "features",
)
def x1e(t):
    return X.feature_counts(t.alignments, t.features, samples=SAMPLES, fragments=True, check_length=True)


@BOOK.add(
    "X1_feature_counts_read2pos",
    f"""with {SPAN}, p as (select aln_id, sample, rname, case when strand='+' then start else "end"-1 end five from span where nh=1),
        h as (select distinct aln_id, sample, concat_ws(':',f.rname,cast(f.start as varchar),cast(f."end" as varchar),f.strand) target from p join features f on f.rname=p.rname and five>=f.start and five<f."end"),
        o as (select *, count(*) over (partition by aln_id) k from h), c as (select sample, target, count(*) n from o where k=1 group by 1,2),
        gs as (select distinct concat_ws(':',rname,cast(start as varchar),cast("end" as varchar),strand) target, s.sample from features, (select unnest(['s0','s1','s2']) sample) s)
        select gs.sample, gs.target, coalesce(n,0) n from gs left join c using (sample, target)""",
    "alignments", "features",
)
def x1f(t):
    return X.feature_counts(t.alignments, t.features, samples=SAMPLES, read_to=5, per_feature=True)


def _htseq(mode_sql: str, strand: str, unit: str) -> str:
    """Templates are the records of one ``unit``; positions are those of any of them."""
    return f"""with {BLOCKS}, rd as (select a.*, {unit} u, case when (flag&129)=129 then case when flag&16>0 then '+' else '-' end else case when flag&16>0 then '-' else '+' end end st
        from alignments a where flag&256=0),
      tp as (select u, min(sample) sample, case when bool_or(nh>1) then '__alignment_not_unique' when bool_or(mapq<10) then '__too_low_aQual' end why from rd group by 1),
      bl as (select u, rname, {"st" if strand else "'.'"} st, unnest(range(start,"end")) p from rd join blocks using (aln_id)), ln as (select u, count(distinct (rname, st, p)) l from bl group by 1),
      hit as (select rd.u, f.gene_id, rd.rname, {"rd.st" if strand else "'.'"} st, greatest(b.start,f.start) s, least(b."end",f."end") e from rd join blocks b using (aln_id)
        join features f on f.rname=rd.rname and b.start<f."end" and f.start<b."end" {strand}),
      px as (select u, gene_id, rname, st, unnest(range(s,e)) p from hit),
      cg as (select u, gene_id, count(distinct (rname, st, p)) c from px group by 1,2), ca as (select u, count(distinct (rname, st, p)) c from px group by 1),
      st as (select u, count(*) k, min(gene_id) g from cg join ca using (u) join ln using (u) where {mode_sql} group by 1),
      lb as (select sample, case when why is not null then why when k is null then '__no_feature' when k>1 then '__ambiguous' else g end gene from tp left join st using (u)),
      c as (select sample, gene, count(*) n from lb group by 1,2),
      gs as (select gene, s.sample from (select distinct gene_id gene from features union all select unnest(['__no_feature','__ambiguous','__too_low_aQual','__not_aligned','__alignment_not_unique'])) x, (select unnest(['s0','s1','s2']) sample) s)
      select gs.sample, gs.gene, coalesce(n,0) n from gs left join c using (sample, gene)"""


# Two lines of an order in one hit.
_HITS = "concat_ws('|', sample, qname, cast((cast(split_part(aln_id,'_',4) as int)-1)//2 as varchar))"


def _with_hit(al):
    return al.withColumn("hit", F.floor((F.split_part("aln_id", F.lit("_"), F.lit(4)).cast("int") - 1) / 2))


@BOOK.add("X2_htseq_union", _htseq("cg.c>0", "", _HITS), "alignments", "features")
def x2(t):
    return X.htseq_count(_with_hit(t.alignments), t.features, samples=SAMPLES, mode="union", stranded="no")


@BOOK.add("X2_htseq_strict", _htseq("cg.c=l", "and f.strand=rd.st", _HITS), "alignments", "features")
def x2b(t):
    return X.htseq_count(_with_hit(t.alignments), t.features, samples=SAMPLES, mode="intersection-strict", stranded="yes")


# Without hits all records of a name are one template, some of more than two records.
@BOOK.add("X2_htseq_nonempty", _htseq("cg.c=ca.c", "and f.strand<>rd.st", "concat_ws('|', sample, qname)"), "alignments", "features")
def x2c(t):
    return X.htseq_count(t.alignments, t.features, samples=SAMPLES, mode="intersection-nonempty", stranded="reverse")


def _model(t):
    """Exons with a coding span 150 bases inside each transcript."""
    spans = t.transcripts.select("transcript_id", (F.col("start") + 150).alias("cds_start"), (F.col("end") - 150).alias("cds_end"))
    return t.features.select("rname", "start", "end", "strand", "transcript_id", "gene_id", "exon_number").join(spans, "transcript_id")


# Region classes per base of the sequences, as oracle text: bit set per position.
_CLASS = """mdl as (select f.*, t.start+150 cs, t."end"-150 ce, t.start ts, t."end" te from features f join transcripts t using (transcript_id)),
  pc as (select distinct rname, unnest(range(greatest(start,cs),least("end",ce))) p from mdl where least("end",ce)>greatest(start,cs)),
  pe as (select distinct rname, unnest(range(start,"end")) p from features),
  pb as (select distinct rname, unnest(range(start,"end")) p from transcripts) """


@BOOK.add(
    "X7_rna_metrics",
    f"""with {BLOCKS}, {_CLASS}, pp as (select distinct rname, unnest(range(start,"end")) p from transcripts where strand='+'), pm as (select distinct rname, unnest(range(start,"end")) p from transcripts where strand='-'),
        rr as (select distinct rname, unnest(range(start,"end")) p from features where exon_number=3 and class_code='u'),
        cls as (select rname, p, pc.p is not null c, pe.p is not null e, pb.p is not null b, pp.p is not null pl, pm.p is not null mi, rr.p is not null ri
           from (select distinct rname, unnest(range(0,131000)) p from chrom_sizes) g left join pc using (rname,p) left join pe using (rname,p) left join pb using (rname,p) left join pp using (rname,p) left join pm using (rname,p) left join rr using (rname,p)),
        rd as (select aln_id, sample, rname, case when (flag&129)=129 then case when flag&16>0 then '+' else '-' end else case when flag&16>0 then '-' else '+' end end st from alignments where flag&772=0),
        bs as (select rd.aln_id, rd.sample, rd.rname, st, unnest(range(start,"end")) p from rd join blocks using (aln_id)),
        pr as (select aln_id, sample, st, count(*) tot, count(*) filter (where c) c, count(*) filter (where e) e, count(*) filter (where b) b, count(*) filter (where pl) pl, count(*) filter (where mi) mi, count(*) filter (where ri) ri from bs join cls using (rname, p) group by 1,2,3),
        fl as (select *, ri>=0.8*tot and ri>0 rb, (pl>0)<>(mi>0) o from pr),
        ag as (select sample, cast(sum(tot) as bigint) bases, cast(sum(case when rb then tot else 0 end) as bigint) ribosomal, cast(sum(case when rb then 0 else c end) as bigint) coding, cast(sum(case when rb then 0 else e-c end) as bigint) utr,
          cast(sum(case when rb then 0 else b-e end) as bigint) intronic, cast(sum(case when rb then 0 else tot-b end) as bigint) intergenic, count(*) filter (where not rb and o and (pl>0)=(st='+')) correct_strand,
          count(*) filter (where not rb and o and (pl>0)<>(st='+')) incorrect_strand from fl group by grouping sets ((), (sample)))
        select *, ribosomal/bases pct_ribosomal, coding/bases pct_coding, utr/bases pct_utr, intronic/bases pct_intronic, intergenic/bases pct_intergenic, correct_strand/(correct_strand+incorrect_strand) pct_correct_strand from ag""",
    "alignments", "features", "transcripts", "chrom_sizes",
)
def x7(t):
    rrna = t.features.filter("exon_number = 3 and class_code = 'u'").select("rname", "start", "end")
    return X.rna_metrics(t.alignments, _model(t), rrna=rrna)


@BOOK.add(
    "X8_read_distribution",
    f"""with {BLOCKS}, {_CLASS}, up as (select distinct rname, unnest(case when strand='+' then range(greatest(start-1000,0),start) else range("end","end"+1000) end) p from transcripts),
        dn as (select distinct rname, unnest(case when strand='+' then range("end","end"+1000) else range(greatest(start-1000,0),start) end) p from transcripts),
        tg as (select a.sample, a.rname, cast(floor((b.start+b."end")/2) as bigint) p from alignments a join blocks b using (aln_id) where flag&260=0)
        select sample, case when pc.p is not null then 'cds' when pe.p is not null then 'utr' when pb.p is not null then 'intron' when up.p is not null then 'upstream' when dn.p is not null then 'downstream' else 'intergenic' end kind, count(*) n
        from tg left join pc using (rname,p) left join pe using (rname,p) left join pb using (rname,p) left join up using (rname,p) left join dn using (rname,p) group by 1,2""",
    "alignments", "features", "transcripts",
)
def x8(t):
    return X.read_distribution(t.alignments, _model(t))


@BOOK.add(
    "X8_infer_experiment",
    f"""with {SPAN}, h as (select s.aln_id, s.sample, case when flag&128>0 then 2 else 1 end mate, s.strand, min(t.strand) lo, max(t.strand) hi from span s join transcripts t on t.rname=s.rname and s.start<t."end" and t.start<s."end"
          where flag&1796=0 and mapq>=30 group by 1,2,3,4), c as (select sample, mate, strand, lo gene_strand, count(*) n from h where lo=hi group by 1,2,3,4)
        select *, n/sum(n) over (partition by sample) fraction from c""",
    "alignments", "features", "transcripts",
)
def x8b(t):
    return X.infer_experiment(t.alignments, t.transcripts)


# Coverage runs cut to exons in transcript coordinates, as oracle text ending in CTE ``pcs``.
_PIECES = f"""with {BLOCKS}, ev as (select a.sample, a.rname, b.start p, 1 d from blocks b join alignments a using (aln_id) union all select a.sample, a.rname, b."end", -1 from blocks b join alignments a using (aln_id)),
  st as (select sample, rname, p, sum(d) d from ev group by 1,2,3), dp as (select sample, rname, p, cast(sum(d) over (partition by sample, rname order by p) as double) v, lead(p) over (partition by sample, rname order by p) nxt from st),
  ex as (select *, coalesce(sum("end"-start) over (partition by transcript_id order by case when strand='-' then -start else start end rows between unbounded preceding and 1 preceding),0)::bigint o, cast(sum("end"-start) over (partition by transcript_id) as bigint) l from features),
  pcs as (select sample, transcript_id, l, v, case when strand='+' then o+greatest(p,start)-start else o+"end"-least(nxt,"end") end lo, least(nxt,"end")-greatest(p,start) w from dp join ex on dp.rname=ex.rname and p<"end" and start<nxt where v>0) """


@BOOK.add(
    "X9_gene_body_coverage",
    _PIECES + """select sample, cast(pp as int) percentile, sum(v*(least(lo+w, ceil((pp+1)*l/100))-greatest(lo, ceil(pp*l/100)))) coverage from pcs, range(0,100) r(pp)
       where least(lo+w, ceil((pp+1)*l/100))>greatest(lo, ceil(pp*l/100)) and l>=100 group by 1,2""",
    "alignments", "features",
)
def x9(t):
    return X.gene_body_coverage(CV.genome_coverage(t.alignments), t.features)


@BOOK.add(
    "X9_transcript_bias",
    _PIECES + """, pt as (select sample, transcript_id, l, sum(w*v) s, sum(w*v*v) ss, sum(greatest(least(lo+w,100)-lo,0)*v) h, sum(greatest(lo+w-greatest(lo,l-100),0)*v) t from pcs where l>=500 group by 1,2,3),
       m as (select sample, s/l mean, sqrt(greatest(ss/l-(s/l)*(s/l),0))/(s/l) cv, h/100/(s/l) b5, t/100/(s/l) b3 from pt)
       select sample, count(*) transcripts, median(mean) median_coverage, round(median(cv),6) median_cv, median(b5) median_5prime_bias, median(b3) median_3prime_bias from m group by 1""",
    "alignments", "features",
)
def x9b(t):
    out = X.transcript_bias(CV.genome_coverage(t.alignments), t.features)
    return out.withColumn("median_cv", F.round("median_cv", 6))


_JN = rf"""with j as (select sample, qname, rname, pos-1+20 start, pos-1+20+cast(regexp_extract(cigar,'(\d+)N',1) as int) "end" from alignments where contains(cigar,'N')),
  md as (select distinct a.rname, a."end" start, b.start "end" from features a join features b on b.transcript_id=a.transcript_id and b.exon_number=a.exon_number+1) """


def _introns(t):
    """Between consecutive exons of the gene model."""
    after = t.features.select("transcript_id", (F.col("exon_number") - 1).alias("exon_number"), F.col("start").alias("next"))
    return t.features.join(after, ["transcript_id", "exon_number"]).select("rname", F.col("end").alias("start"), F.col("next").alias("end")).distinct()


@BOOK.add(
    "X10_junction_annotation",
    _JN + """, s as (select sample, rname, start, "end", count(*) n from j group by 1,2,3,4)
       select sample, rname, cast(start as bigint) start, cast("end" as bigint) "end", n, case when l and r then 'known' when l or r then 'partial' else 'novel' end kind from (select s.*, exists (select 1 from md where md.rname=s.rname and md.start=s.start) l,
         exists (select 1 from md where md.rname=s.rname and md."end"=s."end") r from s)""",
    "alignments", "features",
)
def x10(t):
    out = X.junction_annotation(t.alignments, _introns(t))
    return out.withColumns({"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")})


@BOOK.add(
    "X10_junction_saturation",
    _JN + """, f as (select sample, rname, start, "end", min(cast(('0x'||substr(md5(concat('1_',qname)),1,8))::bigint%20+1 as int)) step from j group by 1,2,3,4),
       g as (select f.sample, step, count(*) n, count(md.rname) k from f left join md using (rname, start, "end") group by 1,2)
       select sample, step*100/20.0::double "percent", cast(sum(n) over (partition by sample order by step) as bigint) junctions, cast(sum(k) over (partition by sample order by step) as bigint) known from g""",
    "alignments", "features",
)
def x10b(t):
    return X.junction_saturation(t.alignments, _introns(t))


@BOOK.add(
    "X10_model_introns",
    """select transcript_id, rname, strand, cast(e as bigint) start, cast(nx as bigint) "end" from (select *, "end" e, lead(start) over (partition by transcript_id order by start) nx from features) where nx>e""",
    "features",
)
def x10c(t):
    out = X.model_introns(t.features)
    return out.withColumns({"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")})
