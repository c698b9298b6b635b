"""Queries of the read-level operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import adapters as A, pairs as P, reads as R
from .book import Book
from .views import ADAPTER

BOOK = Book()
KEY = ["sample", "read_idx", "mate"]


@BOOK.add(
    "R1_drop_empty_reads",
    """select * from reads r where seq<>'' and not exists (
         select 1 from reads m where m.seq='' and m.sample=r.sample and m.read_idx=r.read_idx)""",
    "reads",
)
def r1(t):
    return R.drop_empty_reads(t.reads)


@BOOK.add(
    "R1_drop_empty_report",
    """select sample, mate, count(*) rows_read, count(*) filter (where lo>0) rows_written
       from (select *, min(length(seq)) over (partition by sample, read_idx) lo from reads) group by sample, mate""",
    "reads",
)
def r1b(t):
    return R.drop_empty_report(t.reads)


@BOOK.add("R2_fix_qnames", "select sample, read_idx, mate, split_part(qname,' ',1) qname, seq, qual from reads", "reads")
def r2(t):
    return R.fix_qnames(t.reads)


@BOOK.add(
    "R3_reverse_complement",
    """select sample, read_idx, mate, qname, reverse(translate(seq,'ACGT','TGCA')) seq, reverse(qual) qual from reads""",
    "reads",
)
def r3(t):
    return R.reverse_complement(t.reads)


_QTRIM = """with q as (select sample, read_idx, mate, unnest(range(1,length(qual)+1)) i, qual from reads),
  s as (select *, sum(ascii(substr(qual,cast(i as int),1))-33-20) over (partition by sample, read_idx, mate order by i desc) total from q),
  k as (select sample, read_idx, mate, arg_min(i, (total, -i)) - 1 keep, min(total) low from s group by sample, read_idx, mate),
  trimmed as (select r.sample, r.read_idx, r.mate, r.qname,
     case when low<0 then substr(seq,1,cast(keep as int)) else seq end seq,
     case when low<0 then substr(qual,1,cast(keep as int)) else qual end qual
   from reads r left join k using (sample, read_idx, mate)) """


@BOOK.add("R4_quality_trim", _QTRIM + "select * from trimmed", "reads")
def r4(t):
    return R.quality_trim(t.reads, cutoff=20)


@BOOK.add(
    "R5_cut",
    """select sample, read_idx, mate, qname, substr(s5,1,greatest(length(s5)-4,0)) seq, substr(q5,1,greatest(length(q5)-4,0)) qual
       from (select *, substr(seq,6) s5, substr(qual,6) q5 from reads)""",
    "reads",
)
def r5(t):
    return R.cut(R.cut(t.reads, 5), -4)


@BOOK.add(
    "R6_clip_adapter_exact",
    f"""with h as (select *, list_min(list_filter(range(0,greatest(length(seq)-2,0)),
              lambda o: starts_with('{ADAPTER}',substr(seq,cast(o+1 as int),{len(ADAPTER)})))) st from reads),
         h2 as (select *, case when st is null then length(seq) else st end keep from h)
       select sample, read_idx, mate, qname, substr(seq,1,cast(keep as int)) seq, substr(qual,1,cast(keep as int)) qual,
              cast(length(seq)-keep as int) clip_len from h2""",
    "reads",
)
def r6(t):
    return A.clip_adapter(t.reads, [ADAPTER], error_rate=0.0)


@BOOK.add(
    "R6_clip_adapter_mismatch",
    f"""with h as (select *, list_max(list_transform(range(0,greatest(length(seq)-2,0)), lambda o:
            case when hamming(substr(seq,cast(o+1 as int),{len(ADAPTER)}), substr('{ADAPTER}',1,cast(least(length(seq)-o,{len(ADAPTER)}) as int)))
                      <= floor(0.1*least(length(seq)-o,{len(ADAPTER)}))
                 then (least(length(seq)-o,{len(ADAPTER)})
                       -hamming(substr(seq,cast(o+1 as int),{len(ADAPTER)}), substr('{ADAPTER}',1,cast(least(length(seq)-o,{len(ADAPTER)}) as int))))*1000+(999-o)
                 else -1 end)) best from reads),
         h2 as (select *, case when best is null or best<0 then length(seq) else 999-best%1000 end keep from h)
       select sample, read_idx, mate, qname, substr(seq,1,cast(keep as int)) seq, substr(qual,1,cast(keep as int)) qual,
              cast(length(seq)-keep as int) clip_len from h2""",
    "reads",
)
def r6b(t):
    return A.clip_adapter(t.reads, [ADAPTER], error_rate=0.1)


_HIT = f"""with h as (select *, exists(select 1 from range(0,98) o(o) where o<=length(seq)-3
             and starts_with('{ADAPTER}',substr(seq,cast(o+1 as int),{len(ADAPTER)}))) hit from reads) """


@BOOK.add("R7_discard_trimmed", _HIT + "select sample, read_idx, mate, seq from h where not hit", "reads")
def r7(t):
    return A.discard_trimmed(A.clip_adapter(t.reads, [ADAPTER], error_rate=0.0)).select(*KEY, "seq")


@BOOK.add("R7_discard_untrimmed", _HIT + "select sample, read_idx, mate, seq from h where hit", "reads")
def r7b(t):
    return A.discard_untrimmed(A.clip_adapter(t.reads, [ADAPTER], error_rate=0.0, no_trim=True)).select(*KEY, "seq")


@BOOK.add(
    "R8_filter_length",
    """select * exclude(lo,hi) from (select *, min(length(seq)) over (partition by sample, read_idx) lo,
         max(length(seq)) over (partition by sample, read_idx) hi from reads) where lo>=65 and hi<=90""",
    "reads",
)
def r8(t):
    return R.filter_length(t.reads, min_len=65, max_len=90, paired=True)


@BOOK.add(
    "R9_trim_terminal",
    """with q as (select sample, read_idx, mate, unnest(range(1,length(qual)+1)) i, seq, qual from reads),
         g as (select sample, read_idx, mate, min(i) lo, max(i) hi from q
               where substr(seq,cast(i as int),1)<>'N' and ascii(substr(qual,cast(i as int),1))-33>12 group by all)
       select r.sample, r.read_idx, r.mate, r.qname,
         case when lo is null then '' else substr(seq,cast(lo as int),cast(hi-lo+1 as int)) end seq,
         case when lo is null then '' else substr(qual,cast(lo as int),cast(hi-lo+1 as int)) end qual
       from reads r left join g using (sample, read_idx, mate)""",
    "reads",
)
def r9(t):
    return R.trim_terminal(t.reads, ns=True, min_quality=12)


@BOOK.add(
    "R9_filter_max_n",
    """select * exclude(worst) from (select *, max(length(seq)-length(replace(seq,'N',''))) over (partition by sample, read_idx) worst
       from reads) where worst<=6""",
    "reads",
)
def r9b(t):
    return R.filter_max_n(t.reads, max_n=6, paired=True)


@BOOK.add(
    "R10_filter_n_ends",
    "select * from reads where not regexp_matches(seq,'^N{2}') and not regexp_matches(seq,'N{2}$')",
    "reads",
)
def r10(t):
    return R.filter_n_ends(t.reads, n=2)


@BOOK.add(
    "R11_rename_reads",
    """select sample, read_idx, mate, concat('p_',split_part(qname,' x',1),' length=',cast(length(seq) as varchar),'/1') qname, seq, qual
       from reads""",
    "reads",
)
def r11(t):
    named = t.reads.withColumn("qname", F.concat(F.regexp_replace("qname", " x$", ""), F.lit(" length=1 x")))
    return R.rename_reads(named, prefix="p_", suffix="/1", strip_suffix=" x", length_tag="length=")


def _map_qual(expr: str) -> str:
    return f"""select sample, read_idx, mate, qname, seq,
       coalesce(array_to_string(list_transform(range(1,length(qual)+1), lambda i: chr(cast({expr} as int))),''),'') qual from reads"""


@BOOK.add("R12_recode_quality", _map_qual("ascii(substr(qual,cast(i as int),1))+31"), "reads")
def r12(t):
    return R.recode_quality(t.reads, source=33, target=64)


@BOOK.add("R13_zero_cap_quality", _map_qual("greatest(64,ascii(substr(qual,cast(i as int),1)))"), "reads")
def r13(t):
    return R.zero_cap_quality(t.reads, base=64)


@BOOK.add(
    "R14_trim_recipe",
    _QTRIM + """select sample, read_idx, mate, qname, substr(seq,4) seq, substr(qual,4) qual from trimmed
       where length(substr(seq,4))>=40 and length(seq)-length(replace(substr(seq,4),'N',''))-least(3,length(seq))<=5""",
    "reads",
)
def r14(t):
    return R.trim_recipe(
        t.reads,
        [("quality_trim", {"cutoff": 20}), ("cut", {"n": 3}), ("filter_length", {"min_len": 40}), ("filter_max_n", {"max_n": 5})],
    )


_PAIR = """with m1 as (select * from reads where mate=1), m2 as (select * from reads where mate=2),
  p as (select m1.sample, m1.read_idx, m1.qname, m1.seq s1, m2.seq s2, reverse(translate(m2.seq,'ACGT','TGCA')) rc, m1.qual q1, reverse(m2.qual) rq
        from m1 join m2 using (sample, read_idx)),
  d as (select *, unnest(range(-(length(rc)-11), length(s1)-11+1)) sh from p),
  o as (select *, least(length(s1), sh+length(rc))-greatest(sh,0) span from d),
  o2 as (select *, hamming(substr(s1,cast(greatest(sh,0)+1 as int),cast(span as int)), substr(rc,cast(greatest(-sh,0)+1 as int),cast(span as int))) miss from o where span>=11),
  b as (select sample, read_idx, arg_max(sh,(span-2*miss, span, -sh)) sh, max((span-2*miss, span, -sh)) mx from o2 where miss<=floor(0.1*span+1e-9) and span-2*miss>=0 group by sample, read_idx),
  best as (select p.*, b.sh, case when b.sh is null then 0 else least(length(s1), b.sh+length(rc))-greatest(b.sh,0) end span
           from p left join b using (sample, read_idx)) """


@BOOK.add(
    "R15_merge_pairs",
    _PAIR + """, c as (select *, array_to_string(list_transform(range(0,span), lambda i:
        case when ascii(substr(q1,cast(greatest(sh,0)+1+i as int),1))>=ascii(substr(rq,cast(greatest(-sh,0)+1+i as int),1))
             then substr(s1,cast(greatest(sh,0)+1+i as int),1) else substr(rc,cast(greatest(-sh,0)+1+i as int),1) end),'') mid from best),
      z as (select *, case when span>0 then concat(substr(s1,1,cast(greatest(sh,0) as int)), mid,
              case when sh>=0 then substr(rc,cast(span+1 as int)) else '' end) end seq from c)
      select sample, read_idx, seq, cast(span as int) overlap,
        case when span=0 then 'unassembled' when length(seq) between 50 and 300 then 'assembled' else 'discarded' end status from z""",
    "reads",
)
def r15(t):
    return P.merge_pairs(t.reads, min_overlap=11).select("sample", "read_idx", "seq", "overlap", "status")


@BOOK.add(
    "R16_identify_adapters",
    _PAIR + """, tails as (select sample, 1 mate, substr(s1,cast(sh+length(rc)+1 as int)) tail from best where span>0
        union all select sample, 2, substr(s2,cast(sh+length(rc)+1 as int)) from best where span>0),
      x as (select sample, mate, cast(i-1 as int) pos, substr(tail,cast(i as int),1) base from (select *, unnest(range(1,length(tail)+1)) i from tails)),
      n as (select sample, mate, pos, base, count(*) n from x group by all)
      select sample, mate, pos, arg_max(base,(n,base)) base, max(n) rank_n, cast(sum(n) as bigint) total from n group by sample, mate, pos""",
    "reads",
)
def r16(t):
    return P.identify_adapters(t.reads, min_overlap=11)


@BOOK.add(
    "R17_demultiplex",
    """with m as (select b.barcode, count(*) n, min(s.sample) sample from (select distinct barcode from index_reads) b
         join samples s on length(b.barcode)=length(s.index_r1) and hamming(b.barcode,s.index_r1)<=1 group by b.barcode)
       select read_idx, barcode, case when n=1 then m.sample else 'Undetermined' end sample from index_reads left join m using (barcode)""",
    "index_reads", "samples",
)
def r17(t):
    return A.demultiplex(t.index_reads, t.samples, mismatches=1)


_SECOND = "case when read_idx%3=0 then read_idx%120+1 else read_idx%120 end"


@BOOK.add(
    "R17_demultiplex_dual",
    f"""with sm as (select sample, index_r1, case when sample like '%5' then null else index_r2 end index_r2 from samples),
       ir as (select *, substr(translate(md5(concat('Supplier#',lpad(cast({_SECOND} as varchar),9,'0'),'2')),'0123456789abcdef','ACGTACGTACGTACGN'),1,6) barcode2 from index_reads),
       m as (select read_idx, count(distinct sample) n, min(sample) sample from ir join sm on length(barcode)=length(index_r1) and hamming(barcode,index_r1)<=1
         and (index_r2 is null or (length(barcode2)=length(index_r2) and hamming(barcode2,index_r2)<=1)) group by 1)
       select read_idx, barcode, barcode2, case when n=1 then m.sample else 'Undetermined' end sample from ir left join m using (read_idx)""",
    "index_reads", "samples",
)
def r17b(t):
    name = F.concat(F.lit("Supplier#"), F.lpad(F.expr(f"cast({_SECOND} as string)"), 9, "0"), F.lit("2"))
    second = F.substring(F.translate(F.md5(name), "0123456789abcdef", "ACGTACGTACGTACGN"), 1, 6)
    sheet = t.samples.withColumn("index_r2", F.when(~F.col("sample").endswith("5"), F.col("index_r2")))
    return A.demultiplex(t.index_reads.withColumn("barcode2", second), sheet, read_barcode2="barcode2", mismatches=1)


@BOOK.add(
    "R18_filter_spots_clip",
    """select read_idx spot_id, mate, substr(seq,cast(read_idx%7+1 as int),cast(greatest(length(seq)-read_idx%7-case when mate=1 then 5 else 0 end,0) as int)) seq,
         substr(qual,cast(read_idx%7+1 as int),cast(greatest(length(seq)-read_idx%7-case when mate=1 then 5 else 0 end,0) as int)) qual from reads where read_idx>=200""",
    "reads",
)
def r18b(t):
    spots = t.reads.select(
        F.col("read_idx").alias("spot_id"), "mate", "seq", "qual", (F.col("read_idx") % 7).cast("int").alias("clip_left"),
        F.when(F.col("mate") == 1, 5).alias("clip_right"),
    )
    return R.filter_spots(spots, min_id=200, clip=True).drop("clip_left", "clip_right")


def _spots(t):
    return t.alignments.select(
        F.regexp_extract("aln_id", r"^(\d+)_", 1).cast("bigint").alias("spot_id"),
        F.col("sample").alias("spot_group"),
        F.when(F.col("flag").bitwiseAND(1024) > 0, "reject").otherwise("pass").alias("read_filter"),
        "rname", "pos", F.when(F.col("rnext") != "*", F.abs("tlen")).alias("mate_distance"), "seq",
    )


@BOOK.add(
    "R18_filter_spots",
    """select cast(split_part(aln_id,'_',1) as bigint) spot_id, sample spot_group, case when flag&1024>0 then 'reject' else 'pass' end read_filter,
         rname, pos, case when rnext<>'*' then abs(tlen) end mate_distance, seq from alignments
       where cast(split_part(aln_id,'_',1) as bigint) between 100 and 900 and sample in ('s0','s2') and flag&1024=0 and rname='chr2'
         and pos between 1001 and 90000 and rnext<>'*' and abs(tlen) between 10 and 500""",
    "alignments",
)
def r18(t):
    return R.filter_spots(
        _spots(t), min_id=100, max_id=900, groups=["s0", "s2"], read_filter="pass", aligned=True,
        region=("chr2", 1000, 90000), mate_distance=(10, 500),
    )


_RANK = """with p as (select distinct sample, read_idx from reads),
  k as (select sample, read_idx, row_number() over (partition by sample order by substr(md5(concat('11_',cast(read_idx as varchar))),1,15), read_idx) rk from p) """


@BOOK.add("R19_sample_reads", _RANK + "select r.* from reads r join k using (sample, read_idx) where rk<=200", "reads")
def r19(t):
    return R.sample_reads(t.reads, n=200, seed=11)


@BOOK.add("R19_sample_reads_rest", _RANK + "select r.* from reads r join k using (sample, read_idx) where rk>200", "reads")
def r19b(t):
    return R.sample_reads(t.reads, n=200, seed=11, complement=True)


@BOOK.add(
    "R19_sample_reads_fraction",
    "select * from reads where substr(md5(concat('7_',cast(read_idx as varchar))),1,15) < '400000000000000'",
    "reads",
)
def r19c(t):
    return R.sample_reads(t.reads, fraction=0.25, seed=7)


@BOOK.add(
    "R19_sample_reads_replace",
    """with h as (select *, (('0x'||substr(md5(concat('5_',cast(read_idx as varchar))),1,15))::bigint)/1152921504606846976.0::double u from reads),
       c as (select sum(exp(-0.5)*pow(0.5,i)/gamma(i+1)) over (order by i) cdf from range(0,18) t(i))
       select sample, read_idx, mate, qname, seq, qual from h join c on u>=cdf""",
    "reads",
)
def r19d(t):
    return R.sample_reads(t.reads, fraction=0.5, seed=5, replace=True)


@BOOK.add(
    "R20_split_reads",
    "select sample, read_idx, mate, seq, cast(read_idx//1000+1 as bigint) chunk from reads",
    "reads",
)
def r20(t):
    return R.split_reads(t.reads, n_per_chunk=1000).select(*KEY, "seq", "chunk")


@BOOK.add(
    "R21_concat_reads",
    """with a as (select sample, mate, max(read_idx)+1 ext from reads group by sample, mate)
       select sample, read_idx, mate, seq from reads
       union all select t.sample, t.read_idx+coalesce(a.ext,0), t.mate, t.seq from text_reads t left join a using (sample, mate)""",
    "reads", "text_reads",
)
def r21(t):
    cols = KEY + ["seq"]
    return R.concat_reads([t.reads.select(*cols), t.text_reads.select(*cols)])


@BOOK.add(
    "R21_concat_listing",
    """with f as (select distinct sample, mate-1 file_ord, concat(sample,'_R',cast(mate as varchar),'.fastq') path from reads)
       select sample, count(*) n_files, string_agg(path, ',' order by file_ord, path) files from f group by sample""",
    "reads",
)
def r21b(t):
    files = t.reads.select(
        "sample", (F.col("mate") - 1).alias("file_ord"),
        F.concat("sample", F.lit("_R"), F.col("mate").cast("string"), F.lit(".fastq")).alias("path"),
    )
    return R.concat_listing(files)


@BOOK.add(
    "J3_mate_join",
    """select a.sample, a.read_idx, a.seq seq1, b.seq seq2 from (select * from reads where mate=1) a
       join (select * from reads where mate=2) b using (sample, read_idx)""",
    "reads",
)
def j3(t):
    return R.pairs_of(t.reads).select("sample", "read_idx", "seq1", "seq2")


@BOOK.add(
    "J5_sample_sheet_join",
    """with sheet as (select concat('s',cast(lane%3 as varchar)) sample, min(index_r1) index_r1, max(project) project from samples group by 1)
       select r.sample, r.read_idx, r.mate, s.index_r1, s.project from reads r join sheet s using (sample)""",
    "reads", "samples",
)
def j5(t):
    sheet = t.samples.groupBy(F.concat(F.lit("s"), (F.col("lane") % 3).cast("string")).alias("sample")).agg(
        F.min("index_r1").alias("index_r1"), F.max("project").alias("project")
    )
    return A.sample_sheet_join(t.reads.select(*KEY), sheet)
