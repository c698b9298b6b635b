"""Queries of the alignment and duplicate operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar as CG, flags
from ..operators import alignments as A, duplicates as D, qc as Q
from .book import Book

BOOK = Book()
REF = r"cast(coalesce(list_sum(list_transform(regexp_extract_all(cigar,'(\d+)[MDN=X]',1), lambda x: cast(x as int))),0) as bigint)"
_ALN = "aln_id, sample, qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, nm, nh"
ALN = _ALN.split(", ")


def _sum(kinds: str) -> str:
    return rf"cast(coalesce(list_sum(list_transform(regexp_extract_all(cigar,'(\d+)[{kinds}]',1), lambda x: cast(x as int))),0) as int)"


@BOOK.add("A1_filter_alignments", f"select {_ALN} from alignments where flag&67=67 and flag&1280=0 and mapq>=20", "alignments")
def a1(t):
    return A.filter_alignments(t.alignments, keep=67, skip=1280, min_mapq=20).select(*ALN)


@BOOK.add("A2_sort_alignments", f"select {_ALN} from alignments order by rname, pos, qname, flag", "alignments")
def a2(t):
    return A.sort_alignments(t.alignments.select(*ALN))


@BOOK.add(
    "A3_merge_alignments",
    f"""with u as (select {_ALN}, 'low' rg from alignments where mapq<25 union all select {_ALN}, 'high' from alignments where mapq>=25)
       select * from u where rname='chr3' and pos-1<60000 and pos-1+{REF}>20000""",
    "alignments",
)
def a3(t):
    al = t.alignments.select(*ALN)
    return A.merge_alignments(
        {"low": al.filter("mapq < 25"), "high": al.filter("mapq >= 25")}, region="chr3:20000:60000", attach_rg=True
    )


@BOOK.add("A4_set_read_group", "select aln_id, 'g1' rg, cast(nm as varchar) nm_tag, 2 n_tags from alignments", "alignments")
def a4(t):
    def entry(type_, value):
        return F.struct(F.lit(type_).alias("type"), value.alias("value"))

    tags = F.create_map(
        F.lit("NM"), entry("i", F.col("nm").cast("string")), F.lit("RG"), entry("Z", F.col("sample"))
    )
    out = A.set_read_group(t.alignments.withColumn("tags", tags), rg_id="g1")
    return out.select(
        "aln_id", F.col("tags")["RG"]["value"].alias("rg"), F.col("tags")["NM"]["value"].alias("nm_tag"), F.size("tags").alias("n_tags")
    )


@BOOK.add(
    "A5_idxstats",
    """with a as (select sample, case when mapq<=1 then '*' else rname end rname, mapq from alignments), s as (select distinct sample from a),
         r as (select sample, rname, length from s, chrom_sizes union all select sample, '*', 0 from s)
       select sample, rname, length, count(mapq) filter (where mapq>5) mapped, count(mapq) filter (where mapq<=5) unmapped
       from r left join a using (sample, rname) group by 1,2,3""",
    "alignments", "chrom_sizes",
)
def a5(t):
    al = t.alignments.withColumn("flag", flags.put_if(F.col("mapq") <= 5, flags.UNMAPPED))
    al = al.withColumn("rname", F.when(F.col("mapq") <= 1, "*").otherwise(F.col("rname")))
    return A.idxstats(al, t.chrom_sizes, samples=["s0", "s1", "s2"])


@BOOK.add(
    "A6_alignment_stats",
    """select sample, count(*) total, count(*) filter (where flag&4=0) mapped, count(*) filter (where flag&1=1) paired,
         count(*) filter (where flag&3=3) proper, count(*) filter (where flag&1024>0) duplicates, count(*) filter (where flag&256>0) secondary,
         count(*) filter (where mapq<30) low_mapq, avg(length(seq)) mean_length, cast(sum(nm) as double)/sum(length(seq)) error_rate
       from alignments group by sample""",
    "alignments",
)
def a6(t):
    return A.alignment_stats(t.alignments)


@BOOK.add(
    "A7_to_reads",
    """select sample, qname, case when flag&128>0 then 2 else 1 end mate, case when flag&16>0 then reverse(translate(seq,'ACGT','TGCA')) else seq end seq,
         case when flag&16>0 then reverse(qual) else qual end qual from alignments where flag&256=0""",
    "alignments",
)
def a7(t):
    return A.to_reads(t.alignments)


_NAMED = """with x as (select sample, flag&16 flag, case pos%3 when 0 then rname||'|gb|x' when 1 then rname||'_v2' else case when pos%7=0 then '*' else rname end end rname from alignments),
  tg as (select sample, cast(flag as int) flag, split_part(split_part(rname,'|',1),'_',1) ref, count(*) n from x where not contains(rname,'*') group by 1,2,3) """


def _targets(t):
    name = (
        F.when(F.col("pos") % 3 == 0, F.concat("rname", F.lit("|gb|x"))).when(F.col("pos") % 3 == 1, F.concat("rname", F.lit("_v2")))
        .when(F.col("pos") % 7 == 0, "*").otherwise(F.col("rname"))
    )
    return A.count_targets(t.alignments.withColumns({"flag": F.col("flag").bitwiseAND(16), "rname": name}))


@BOOK.add("A8_count_targets", _NAMED + "select * from tg", "alignments")
def a8(t):
    return _targets(t)


@BOOK.add(
    "A9_strand_composition",
    _NAMED + """select sample, case when flag=16 then 'sense' else 'antisense' end sense, ref, cast(sum(n) as bigint) n from tg
       group by grouping sets ((sample, sense), (sample, sense, ref))""",
    "alignments",
)
def a9(t):
    return Q.strand_composition(_targets(t), library_type="firststranded")


@BOOK.add(
    "A10_cigar_lengths",
    f"""select aln_id, {_sum('MDN=X')} ref_len, {_sum('MDX=')} ungapped, {_sum('MIS=X')} read_len, {_sum('MIS=X')} query_len,
         coalesce(list_max(list_transform(regexp_extract_all(cigar,'(\\d+)N',1), lambda x: cast(x as int))),0) max_gap from alignments""",
    "alignments",
)
def a10(t):
    return t.alignments.select(
        "aln_id", CG.ref_len().alias("ref_len"), CG.ref_len(mode="ungapped").alias("ungapped"), CG.ref_len(mode="read").alias("read_len"),
        CG.query_len().alias("query_len"), CG.max_gap().alias("max_gap"),
    )


BLOCKS = r"""ops as (select aln_id, pos, unnest(range(1,len(regexp_extract_all(cigar,'\d+[A-Z=]'))+1)) i, cigar from alignments),
  op as (select aln_id, pos, i, cast(regexp_extract(regexp_extract_all(cigar,'\d+[A-Z=]')[i],'\d+') as int) n, right(regexp_extract_all(cigar,'\d+[A-Z=]')[i],1) o from ops),
  walk as (select *, coalesce(sum(case when o in ('M','D','N','=','X') then n else 0 end) over (partition by aln_id order by i rows between unbounded preceding and 1 preceding),0) before,
             sum(case when o='N' then 1 else 0 end) over (partition by aln_id order by i) blk from op),
  blocks as (select aln_id, cast(row_number() over (partition by aln_id order by blk)-1 as int) block, cast(min(pos-1+before) as int) start, cast(max(pos-1+before+n) as int) "end"
             from walk where o in ('M','D','=','X') group by aln_id, blk)"""


@BOOK.add("A10_cigar_blocks", f"with {BLOCKS} select * from blocks", "alignments")
def a10b(t):
    return t.alignments.select("aln_id", F.posexplode(CG.blocks()).alias("block", "b")).select("aln_id", "block", "b.start", "b.end")


@BOOK.add(
    "A11_collapse_cigar",
    """select aln_id, case when cigar='50M' then '*' when mapq%2=0 and cigar like '25M2I%' then '25M2I20M3D3M' else cigar end cigar from alignments""",
    "alignments",
)
def a11(t):
    fine = F.regexp_replace(F.regexp_replace("cigar", "25M", "10=1X14M"), "20M", "7=3X10=")
    fine = F.when(F.col("cigar") == "50M", "*").otherwise(fine)
    return t.alignments.select("aln_id", CG.collapse(fine).alias("cigar"))


_UP = """with p as (select *, count(*) over (partition by sample, qname) n, bit_or(flag) over (partition by sample, qname) b from alignments where flag&256=0) """


@BOOK.add(
    "A12_unique_pairs_only",
    _UP + """select aln_id, qname, cast(case when n=1 then flag|8 else flag end as int) flag from p where n=1 or (n=2 and b&192=192)""",
    "alignments",
)
def a12(t):
    return A.unique_pairs_only(t.alignments).select("aln_id", "qname", "flag")


@BOOK.add(
    "A12_unique_pairs_report",
    _UP + """, t as (select sample, qname, min(n) n, min(b) b from p group by 1,2), r as (select sample, count(*) rcount from alignments group by 1),
       w as (select sample, cast(sum(case when n=1 or (n=2 and b&192=192) then n else 0 end) as bigint) wcount, count(*) filter (where n>2) discard_gt_2,
         count(*) filter (where n=2 and b&192<>192) discard_40_80 from t group by 1)
       select *, wcount*100.0::double/rcount wpercent from r join w using (sample)""",
    "alignments",
)
def a12b(t):
    return A.unique_pairs_report(t.alignments)


_FIX = """with m as (select *, count(*) over (partition by sample, qname, xi) c from mates),
  nh as (select sample, qname, count(distinct xi) k from mates group by 1,2),
  w as (select *, max(rname) filter (where flag&64>0) over g r1, max(rname) filter (where flag&64=0) over g r2, max(pos) filter (where flag&64>0) over g p1, max(pos) filter (where flag&64=0) over g p2,
        max(flag) filter (where flag&64>0) over g f1, max(flag) filter (where flag&64=0) over g f2 from m window g as (partition by sample, qname, xi)),
  j as (select w.*, k, case when c=2 then case when flag&64>0 then r2 else r1 end end mr, case when c=2 then case when flag&64>0 then p2 else p1 end end mp,
        case when c=2 then case when flag&64>0 then f2 else f1 end end mf from w join nh using (sample, qname)),
  fixed as (select sample, qname, xi, rname, pos, cigar, mapq, cast(k as int) nh,
     cast((case when k<=1 then flag - (flag&256) else flag end) | (case when c=1 and flag&1=1 then 8 else 0 end) | (case when c=2 and mf&16>0 then 32 else 0 end) as int) flag,
     case when c=1 then rnext when mr=rname then '=' else mr end rnext, case when c=2 then mp else pnext end pnext from j) """


@BOOK.add("A13_fix_mates", _FIX + "select * from fixed", "fragments", "mates")
def a13(t):
    return A.fix_mates(t.mates)


@BOOK.add(
    "A18_filter_for_snp_calling",
    _FIX + """, g as (select sample, qname, count(distinct xi) k, count(*) filter (where flag&128=0) n1, count(*) filter (where flag&128>0) n2,
           bool_or(flag&128=0 and rnext<>'=') apart from fixed group by 1,2)
       select f.* from fixed f join g using (sample, qname) where k=1 and not (n1=n2 and apart)""",
    "fragments", "mates",
)
def a18(t):
    return A.filter_for_snp_calling(A.fix_mates(t.mates))


_LARGE = r"""with l as (select *, coalesce(list_max(list_transform(regexp_extract_all(cigar,'(\d+)N',1), lambda x: cast(x as int))),0)>3000 lg from alignments),
  st as (select a.*, case when lg or (rnext='=' and exists (select 1 from l b where b.lg and b.rnext='=' and b.sample=a.sample and b.qname=a.qname
       and least(b.pos,b.pnext)=least(a.pos,a.pnext) and greatest(b.pos,b.pnext)=greatest(a.pos,a.pnext))) then 'split_too_long'
     when rnext='=' and abs(tlen)>400 then 'mates_too_far' else 'kept' end status from l a) """


@BOOK.add("A19_discard_large_splits_and_pairs", _LARGE + f"select {_ALN} from st where status='kept'", "alignments")
def a19(t):
    return A.discard_large_splits_and_pairs(t.alignments.select(*ALN), max_split=3000, max_distance=400)


@BOOK.add("A19_large_split_report", _LARGE + "select sample, status, count(*) n from st group by 1,2", "alignments")
def a19b(t):
    return A.large_split_report(t.alignments.select(*ALN), max_split=3000, max_distance=400)


@BOOK.add("A20_filter_region", f"select {_ALN} from alignments where rname='chr2' and pos-1<30000 and pos-1+{REF}>10000", "alignments")
def a20(t):
    return A.filter_region(t.alignments, "chr2:10000:30000").select(*ALN)


def _dense(t, paired: bool):
    name = F.col("qname")
    if not paired:
        name = F.concat_ws(
            ":", F.concat("aln_id", F.lit("@ins")), F.lit("1"), F.lit("fc"), F.lit("1"), (F.col("pos") % 2).cast("string"),
            (F.regexp_extract("aln_id", r"^(\d+)", 1).cast("bigint") * 37 % 300).cast("string"),
            F.regexp_extract("aln_id", r"_(\d+)_\d+$", 1),
        )
    step = 1000 if paired else 50
    al = t.alignments.withColumn("qname", name)
    return al.withColumn("pos", (F.col("pos") - F.col("pos") % step + 1).cast("int"))


_DENSE1 = r"""with al as (select aln_id, sample, concat(aln_id,'@ins:1:fc:1:',cast(pos%2 as varchar),':',cast((cast(regexp_extract(aln_id,'^(\d+)',1) as bigint)*37)%300 as varchar),':',regexp_extract(aln_id,'_(\d+)_\d+$',1)) qname,
     flag, rname, pos-pos%50+1 pos, cigar, qual, pos%2 tile, (cast(regexp_extract(aln_id,'^(\d+)',1) as bigint)*37)%300 x, cast(regexp_extract(aln_id,'_(\d+)_\d+$',1) as bigint) y from alignments) """
_DENSE2 = """with al as (select aln_id, sample, qname, flag, rname, pos-pos%1000+1 pos, cigar, qual, null tile, 0 x, 0 y from alignments) """
_DUP = rf""", u as (select *, case when flag&16>0 then pos-1+{REF}-1 else pos-1-coalesce(cast(nullif(regexp_extract(cigar,'^(\d+)S',1),'') as int),0) end five,
      list_sum(list_filter(list_transform(range(1,51), lambda i: ascii(substr(qual,cast(i as int),1))-33), lambda q: q>=15)) sc from al where flag&260=0),
   e as (select *, (rname, five, case when flag&16>0 then '-' else '+' end) en from u),
   t as (select sample, qname, min(en) e1, case when count(*)>1 then max(en) end e2, sum(sc) sc, min(tile) tile, min(x) x, min(y) y from e group by 1,2),
   d as (select *, first_value(qname) over w kept, first_value(tile) over w kt, first_value(x) over w kx, first_value(y) over w ky, count(*) over (partition by sample, e1, e2) ss
         from t window w as (partition by sample, e1, e2 order by sc desc, qname)),
   o as (select al.aln_id, cast(case when kept<>d.qname then flag|1024 else flag-(flag&1024) end as int) flag, case when ss>1 then cast(ss as int) end ds, case when ss>1 then kept end di,
      case when kept<>d.qname then case when d.tile=kt and abs(d.x-kx)<=100 and abs(d.y-ky)<=100 then 'SQ' else 'LB' end end dt
      from al left join d on d.sample=al.sample and d.qname=al.qname) """


@BOOK.add("A21_mark_duplicates", _DENSE1 + _DUP + "select aln_id, flag, coalesce(ds,0) ds, di, dt from o", "alignments")
def a21(t):
    out = D.mark_duplicates(_dense(t, False), tag_sets=True, tagging_policy="all")
    return out.select("aln_id", "flag", F.coalesce("ds", F.lit(0)).alias("ds"), "di", "dt")


@BOOK.add("A21_mark_duplicates_pairs", _DENSE2 + _DUP + "select aln_id, flag from o where flag&1024=0", "alignments")
def a21b(t):
    return D.mark_duplicates(_dense(t, True), remove=True).select("aln_id", "flag")


@BOOK.add(
    "A22_duplicate_metrics",
    _DENSE1 + _DUP + """, x as (select al.sample, o.flag from o join al using (aln_id) where al.flag&260=0),
      s as (select sample, count(*) filter (where flag&1=0 or flag&8>0) ue, count(*) filter (where flag&9=1)//2 pe, count(*) filter (where (flag&1=0 or flag&8>0) and flag&1024>0) ud,
        count(*) filter (where flag&9=1 and flag&1024>0)//2 pd from x group by 1)
      select sample, ue unpaired_examined, cast(pe as bigint) pairs_examined, ud unpaired_duplicates, cast(pd as bigint) pair_duplicates, cast(ue+pe as bigint) fragments_examined,
        cast(ud+pd as bigint) duplicate_fragments, cast(ue+pe-ud-pd as bigint) unique_fragments, (ud+2*pd)/(ue+2*pe) percent_duplication from s""",
    "alignments",
)
def a22(t):
    return D.duplicate_metrics(D.mark_duplicates(_dense(t, False)))


def _tags(t):
    bed = A.to_bed(t.alignments)
    shift = F.col("start") - F.col("start") % 200
    return bed.withColumn("end", shift + (F.col("end") - F.col("start"))).withColumn("start", shift)


_TAGS = f"""with b as (select sample, rname, pos-1-(pos-1)%200 start, pos-1-(pos-1)%200+{REF} "end", concat(qname,case when flag&128>0 then '/2' else '/1' end) "name",
   case when flag&16>0 then '-' else '+' end strand from alignments),
  k as (select *, row_number() over (partition by sample, rname, strand, case when strand='-' then "end"-1 else start end order by "name") rk from b) """


@BOOK.add("A23_keep_dup", _TAGS + "select sample, rname, strand, cast(case when strand='-' then \"end\"-1 else start end as bigint) \"at\", count(*) n, min(\"name\") \"name\" from k where rk<=2 group by 1,2,3,4", "alignments")
def a23(t):
    out = D.keep_dup(_tags(t), k=2)
    at = F.when(F.col("strand") == "-", F.col("end") - 1).otherwise(F.col("start"))
    return out.groupBy("sample", "rname", "strand", at.cast("bigint").alias("at")).agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("name"))


_BINOM = """, tot as (select sample, count(*) n from b group by 1),
  pm as (select sample, n, i, case when i=0 then 0.0 else sum(case when i=0 then 0 else ln((n-i+1)/i) + ln(1/600000.0::double) - ln(1-1/600000.0::double) end) over (partition by sample order by i) end + n*ln(1-1/600000.0::double) lp
         from tot, range(0,60) r(i)),
  cdf as (select sample, i, sum(exp(lp)) over (partition by sample order by i) c from pm),
  lim as (select sample, greatest(1, min(i)) lim from cdf where c>=1-1e-5 group by 1) """


@BOOK.add("A23_keep_dup_auto", _TAGS + _BINOM + "select k.sample, k.rname, count(*) n from k join lim using (sample) where rk<=lim group by 1,2", "alignments")
def a23b(t):
    return D.keep_dup(_tags(t), k="auto", gsize=600000.0).groupBy("sample", "rname").agg(F.count(F.lit(1)).alias("n"))


@BOOK.add(
    "A24_subset_mapped",
    """with m as (select * from alignments where flag&3=3 and flag&4=0), f as (select sample, qname, min((rname,pos)) a from m group by 1,2),
       r as (select *, row_number() over (partition by sample order by a, qname) rk from f)
       select m.aln_id, m.qname, m.rname, m.pos from m join r using (sample, qname) where rk<=500""",
    "alignments",
)
def a24(t):
    return A.subset_mapped(t.alignments, n=500, paired=True).select("aln_id", "qname", "rname", "pos")


_BED = f"""with b as (select sample, rname, cast(pos-1 as int) start, cast(pos-1+{REF} as int) "end", concat(qname,case when flag&128>0 then '/2' else '/1' end) "name", cast(mapq as double) score,
   case when flag&16>0 then '-' else '+' end strand from alignments) """


@BOOK.add("A25_to_bed", _BED + "select * from b", "alignments")
def a25(t):
    return A.to_bed(t.alignments)


@BOOK.add("A25_flip_mate2_strand", _BED + "select * replace (case when \"name\" like '%2' then case when strand='+' then '-' else '+' end else strand end as strand) from b", "alignments")
def a25b(t):
    return A.flip_mate2_strand(A.to_bed(t.alignments))


@BOOK.add(
    "A26_fragment_size",
    """with p as (select sample, flag&2=2 proper, tlen from alignments where flag&1=1 and flag&256=0 and tlen>0),
       s as (select sample, proper, count(*) fragments, min(tlen) "min", quantile_cont(tlen,0.25) q1, quantile_cont(tlen,0.5) "median", quantile_cont(tlen,0.75) q3, max(tlen) "max", avg(tlen) "mean", stddev_pop(tlen) sd from p group by 1,2)
       select * replace (round("mean",6) as "mean", round(sd,6) as sd) from s where proper""",
    "alignments",
)
def a26(t):
    return A.fragment_size(t.alignments).withColumn("sd", F.round("sd", 6)).withColumn("mean", F.round("mean", 6))


@BOOK.add(
    "A26_fragment_size_hist",
    "select sample, cast(tlen//25*25 as bigint) size, count(*) n from alignments where flag&3=3 and flag&256=0 and tlen>0 group by 1,2",
    "alignments",
)
def a26b(t):
    return A.fragment_size_hist(t.alignments, width=25)


_SPOILT = """bl as (select rname, start+300 start, start+700 "end" from features where exon_number=2 and transcript_id like '%7')"""


def _spoilt(t):
    rows = t.features.filter("exon_number = 2 and transcript_id like '%7'")
    return rows.select("rname", (F.col("start") + 300).alias("start"), (F.col("start") + 700).alias("end"))


@BOOK.add(
    "A26_fragment_size_windows",
    f"""with {_SPOILT}, p as (select aln_id, sample, rname, tlen, flag&2=2 proper, pos-1 s, pos-1+{REF} e from alignments where flag&1=1 and flag&256=0 and tlen>0),
       w as (select * from (select *, unnest(range(s//1500, (e-1)//1500+1)) k from p) where s<k*1500+500 and e>k*1500),
       g as (select distinct aln_id, sample, proper, tlen from w where not exists (select 1 from bl where bl.rname=w.rname and bl.start<w.k*1500+500 and bl."end">w.k*1500)),
       s as (select sample, proper, count(*) fragments, min(tlen) "min", quantile_cont(tlen,0.25) q1, quantile_cont(tlen,0.5) "median", quantile_cont(tlen,0.75) q3, max(tlen) "max", avg(tlen) "mean", stddev_pop(tlen) sd from g group by 1,2)
       select * replace (round("mean",6) as "mean", round(sd,6) as sd) from s where proper""",
    "alignments", "features",
)
def a26c(t):
    out = A.fragment_size(t.alignments, bin_size=500, distance=1000, blacklist=_spoilt(t))
    return out.withColumn("sd", F.round("sd", 6)).withColumn("mean", F.round("mean", 6))


@BOOK.add(
    "A27_inner_distance",
    f"""with g as (select sample, pnext-1-(pos-1+{REF}) gap from alignments where flag&1=1 and flag&256=0 and rnext='=' and pos<=pnext and (flag&64>0 or pos<pnext))
       select sample, cast(floor((gap+250)/5)*5-250 as int) bin, count(*) n from g where gap between -250 and 249 group by 1,2""",
    "alignments",
)
def a27(t):
    return A.inner_distance(t.alignments)
