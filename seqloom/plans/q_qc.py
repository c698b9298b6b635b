"""Queries of the quality-control aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import qc as Q
from .book import Book
from .views import ADAPTER

BOOK = Book()
CHROMS = ["chr1", "chr2", "chr3", "chr4", "chr5"]


@BOOK.add(
    "Q1_cycle_quality_stats",
    """with b as (select sample, mate, unnest(range(1,length(qual)+1)) c, seq, qual from reads),
         x as (select sample, mate, cast(c as int) cycle, ascii(substr(qual,cast(c as int),1))-33 q, substr(seq,cast(c as int),1) s from b)
       select sample, mate, cycle, count(*) all_count, min(q) min_q, max(q) max_q, cast(sum(q) as bigint) sum_q, sum(q)/count(*) mean_q,
         quantile_cont(q,0.25) q1, quantile_cont(q,0.5) median_q, quantile_cont(q,0.75) q3,
         count(*) filter (where s='A') a_count, count(*) filter (where s='C') c_count, count(*) filter (where s='G') g_count,
         count(*) filter (where s='T') t_count, count(*) filter (where s='N') n_count from x group by sample, mate, cycle""",
    "reads",
)
def q1(t):
    return Q.cycle_quality_stats(t.reads)


@BOOK.add(
    "Q2_kmer_content",
    """select sample, substr(seq,cast(i as int),7) kmer, count(*) n from (select sample, seq, unnest(range(1,length(seq)-5)) i from reads) group by 1,2""",
    "reads",
)
def q2(t):
    return Q.kmer_content(t.reads, k=7)


@BOOK.add(
    "Q3_overrepresented",
    f"""with s as (select sample, seq, count(*) n from (select sample, case when read_idx%4=0 then substr(seq,length(seq)-4) else seq end seq from reads) group by 1,2),
        t as (select sample, sum(n) total from s group by sample)
       select sample, seq, n, n/total fraction, case when length(seq)>0 and contains('{ADAPTER}',seq) then 'short adapter' when contains(seq,'GATTACA') then 'gattaca' else 'No Hit' end source
       from s join t using (sample) where n/total>=0.0005""",
    "reads",
)
def q3(t):
    tails = t.reads.withColumn(
        "seq", F.when(F.col("read_idx") % 4 == 0, F.substr("seq", F.length("seq") - 4)).otherwise(F.col("seq"))
    )
    return Q.overrepresented(tails, contaminants=[("short adapter", ADAPTER), ("gattaca", "GATTACA")], min_fraction=0.0005)


@BOOK.add(
    "Q4_adapter_content",
    f"""with a(adapter,pattern) as (values ('universal','{ADAPTER}'),('short','GATTAC')), t as (select sample, count(*) total from reads group by 1),
        h as (select sample, adapter, cast(instr(seq,pattern) as int) "position", count(*) n from reads, a where contains(seq,pattern) group by 1,2,3),
        w as (select *, cast(sum(n) over (partition by sample, adapter order by "position") as bigint) seen from h)
       select sample, adapter, "position", n, seen, 100.0*seen/total::double "percent" from w join t using (sample)""",
    "reads",
)
def q4(t):
    return Q.adapter_content(t.reads, [("universal", ADAPTER), ("short", "GATTAC")])


@BOOK.add(
    "Q5_qc_verdict",
    """with m as (select sample, 'mean_length' module, avg(length(seq)) "value" from reads group by 1
         union all select sample, 'percent_empty', 100.0*count(*) filter (where seq='')/count(*)::double from reads group by 1
         union all select sample, 'percent_n', 100.0*cast(sum(length(seq)-length(replace(seq,'N',''))) as double)/cast(sum(length(seq)) as double) from reads group by 1)
       select sample, module, "value", case module when 'mean_length' then case when "value"<60 then 'fail' when "value"<90 then 'warn' else 'pass' end
         else case when "value">5 then 'fail' when "value">1 then 'warn' else 'pass' end end verdict from m where module<>'percent_empty'
       union all select sample, module, "value", case when "value">1.5 then 'fail' when "value">1 then 'warn' else 'pass' end from m where module='percent_empty'""",
    "reads",
)
def q5(t):
    metrics = (
        t.reads.groupBy("sample")
        .agg(
            F.avg(F.length("seq")).alias("mean_length"),
            (100.0 * F.count_if(F.length("seq") == 0) / F.count(F.lit(1))).alias("percent_empty"),
            (100.0 * F.sum(F.length("seq") - F.length(F.translate("seq", "N", ""))) / F.sum(F.length("seq"))).alias("percent_n"),
        )
        .unpivot("sample", ["mean_length", "percent_empty", "percent_n"], "module", "value")
    )
    limits = t.spark.createDataFrame(
        [("mean_length", 90.0, 60.0, False, False), ("percent_empty", 1.0, 1.5, False, True), ("percent_n", 1.0, 5.0, False, True)],
        "module string, warn double, error double, ignore boolean, higher_is_worse boolean",
    )
    return Q.qc_verdict(metrics, limits)


@BOOK.add(
    "Q6_read_gc",
    """select sample, cast(floor(100*(length(seq)-length(replace(replace(seq,'G',''),'C','')))/length(seq)) as int) gc_percent, count(*) n
       from text_reads where seq<>'' group by 1,2""",
    "text_reads",
)
def q6(t):
    return Q.read_gc(t.text_reads)


@BOOK.add(
    "Q6_read_length_hist",
    "select sample, mate, cast(length(seq) as int) length, count(*) n from text_reads group by 1,2,3",
    "text_reads",
)
def q6b(t):
    return Q.read_length_hist(t.text_reads)


@BOOK.add(
    "Q7_read_duplication_seq",
    "select sample, occurrence, count(*) n from (select sample, seq, count(*) occurrence from text_reads group by 1,2) group by 1,2",
    "text_reads",
)
def q7(t):
    return Q.read_duplication(t.text_reads, by="seq")


@BOOK.add(
    "Q7_read_duplication_pos",
    """select sample, occurrence, count(*) n from (select sample, rname, pos, cigar, flag&16 rev, count(*) occurrence from alignments group by all) group by 1,2""",
    "alignments",
)
def q7b(t):
    from ..functions import flags

    return Q.read_duplication(t.alignments.withColumn("strand", flags.strand()), by="pos")


_SCREEN = """with g as (select a.rname, a.seq||coalesce(substr(b.seq,1,10),'') seq from genome a left join genome b on a.rname=b.rname and b.start=a.start+256),
  gk as (select distinct rname, substr(seq,cast(i as int),11) kmer from (select *, unnest(range(1,length(seq)-9)) i from g)),
  rk as (select distinct sample, read_idx, mate, substr(seq,cast(i as int),11) kmer from (select *, unnest(range(1,length(seq)-9)) i from reads)),
  h as (select sample, read_idx, mate, rname, count(*) k from rk join gk using (kmer) group by all having count(*)>=2),
  m as (select sample, read_idx, mate, count(*) n_sets from h group by all) """


@BOOK.add(
    "Q8_screen_library",
    _SCREEN + """select sample, rname genome, count(*) filter (where n_sets=1) one_genome, count(*) filter (where n_sets>1) multiple_genomes
       from h join m using (sample, read_idx, mate) group by 1,2
       union all select sample, 'no_hits', count(*), 0 from reads anti join m using (sample, read_idx, mate) group by 1""",
    "reads", "genome",
)
def q8(t):
    return Q.screen_library(t.reads, t.genome, names=CHROMS, k=11, min_kmers=2)


@BOOK.add(
    "Q8_reads_without_hits",
    _SCREEN + "select sample, read_idx, mate, seq from reads anti join m using (sample, read_idx, mate)",
    "reads", "genome",
)
def q8b(t):
    out = Q.reads_without_hits(t.reads, t.genome, names=CHROMS, k=11, min_kmers=2)
    return out.select("sample", "read_idx", "mate", "seq")


@BOOK.add(
    "Q9_reads_per_sample_report",
    """with raw as (select sample, count(*) raw_reads, case when count(*)%2=0 then 'ABD' else 'BCA' end grade from reads group by 1),
         al as (select sample, count(*) mapped_reads, count(*) filter (where flag&1024>0 and rnext='*') ud, count(*) filter (where flag&1024>0 and rnext<>'*') pd,
                count(*) filter (where rnext='*') ue, count(*) filter (where rnext<>'*') pe from alignments group by 1),
         w as (select sample, grade, 64-(position(substr(grade,1,1) in 'ABCD')-1)*16-(position(substr(grade,2,1) in 'ABCD')-1)*4-(position(substr(grade,3,1) in 'ABCD')-1) lv, * exclude (sample, grade) from raw join al using (sample))
       select sample, grade, cast(lv as int) grade_level, v.variable, v."value" from w, lateral (values ('raw_reads', raw_reads), ('mapped_reads', mapped_reads),
         ('fragments_examined', ue+pe), ('duplicate_fragments', ud+pd), ('unique_fragments', ue+pe-ud-pd)) v(variable, "value")""",
    "reads", "alignments",
)
def q9(t):
    raw = t.reads.groupBy("sample").agg(F.count(F.lit(1)).alias("raw_reads"))
    raw = raw.withColumn("grade", F.when(F.col("raw_reads") % 2 == 0, "ABD").otherwise("BCA"))
    dup = F.col("flag").bitwiseAND(1024) > 0
    single = F.col("rnext") == "*"
    mapped = t.alignments.groupBy("sample").agg(F.count(F.lit(1)).alias("mapped_reads"))
    dups = t.alignments.groupBy("sample").agg(
        F.count_if(single).alias("unpaired_examined"), F.count_if(~single).alias("pairs_examined"),
        F.count_if(single & dup).alias("unpaired_duplicates"), F.count_if(~single & dup).alias("pair_duplicates"),
    )
    return Q.reads_per_sample_report([raw, mapped, dups])
