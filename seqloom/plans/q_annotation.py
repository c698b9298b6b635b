"""Queries of the annotation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotation as A
from .book import Book

BOOK = Book()
COLS = ["rname", "start", "end", "strand", "gene_id", "transcript_id", "exon_number", "class_code", "gene_name"]
_C = 'rname, start, "end", strand, gene_id, transcript_id, exon_number, class_code, gene_name'


def _unstranded(t):
    return t.features.withColumn("strand", F.when(F.col("start") % 10 == 3, ".").otherwise(F.col("strand"))).select(*COLS)


@BOOK.add(
    "G1_filter_gtf",
    f"""with u as (select * replace (case when start%10=3 then '.' else strand end as strand) from features)
       select {_C} from u where not coalesce(gene_name like '%ENS%',false) and not coalesce(regexp_matches(gene_name,'#1[0-3]'),false) and class_code not in ('u')
         and not (class_code in ('x','i') and coalesce(gene_name like '%#2%',false)) and strand<>'.'""",
    "features",
)
def g1(t):
    return A.filter_gtf(
        _unstranded(t), remove_gencode=True, name_regex="#1[0-3]", classes=["u"], class_and_name=(["x", "i"], "#2"), remove_unstranded=True
    )


_ROWS = """with tr as (select rname, start, "end", strand, gene_id, transcript_id, 'transcript' feature, (select min(class_code) from features f where f.transcript_id=t.transcript_id) class_code from transcripts t),
  al as (select rname, start, "end", strand, gene_id, transcript_id, 'exon' feature, null class_code from features union all select * from tr) """


def _rows(t):
    code = t.features.groupBy("transcript_id").agg(F.min("class_code").alias("class_code"))
    tr = t.transcripts.join(code, "transcript_id").withColumn("feature", F.lit("transcript"))
    ex = t.features.withColumns({"feature": F.lit("exon"), "class_code": F.lit(None).cast("string")})
    cols = ["rname", "start", "end", "strand", "gene_id", "transcript_id", "feature", "class_code"]
    return ex.select(*cols).unionByName(tr.select(*cols))


@BOOK.add(
    "G2_filter_gtf_keep",
    _ROWS + """select * from al where rname in ('chr1','chr2','chr4') and not contains(gene_id,'p1') and transcript_id in (select transcript_id from tr where class_code in ('=','c','j'))""",
    "features", "transcripts",
)
def g2(t):
    return A.filter_gtf_keep(
        _rows(t), keep_classes=["=", "c", "j"], keep_chromosomes=["1", "2", "4"], drop_field="gene_id", drop_string="p1", class_only_in_transcript=True
    )


_BENT = """with b as (select * replace (case when exon_number=2 and start%11=0 then '.' else strand end as strand, case when exon_number=3 and start%3=0 then 'o' else class_code end as class_code) from features),
  t as (select transcript_id, count(*) n_exon, string_agg(cast("end"-start-1 as varchar), ',' order by start) exon_lengths, cast(sum("end"-start-1) as bigint) length, min(rname) rname,
     case when min(strand)=max(strand) then min(strand) end strand, case when min(class_code)=max(class_code) then min(class_code) else 'mixed' end class_code, min(strand)<>max(strand) discard from b group by 1) """


def _bent(t):
    return t.features.withColumns(
        {
            "strand": F.when((F.col("exon_number") == 2) & (F.col("start") % 11 == 0), ".").otherwise(F.col("strand")),
            "class_code": F.when((F.col("exon_number") == 3) & (F.col("start") % 3 == 0), "o").otherwise(F.col("class_code")),
        }
    )


@BOOK.add("G3_transcript_table", _BENT + "select * from t", "features")
def g3(t):
    return A.transcript_table(_bent(t))


@BOOK.add(
    "G4_transcript_metrics",
    _BENT + """, g as (select * from t where not discard), el as (select "end"-start-1 v from b join g using (transcript_id))
       select 'chromosome' metric, rname "key", count(*) n from g group by 2 union all select 'strand', strand, count(*) from g group by 2 union all select 'class_code', class_code, count(*) from g group by 2
       union all select 'exons', cast(n_exon as varchar), count(*) from g group by 2 union all select 'transcripts', null, count(*) from t union all select 'discard', null, count(*) from t where discard
       union all select 'mean_exon_length', null, cast(floor(avg(v)) as bigint) from el union all select 'median_exon_length', null, cast(floor(median(v)) as bigint) from el
       union all select 'mean_transcript_length', null, cast(floor(avg(length)) as bigint) from g union all select 'median_transcript_length', null, cast(floor(median(length)) as bigint) from g""",
    "features",
)
def g4(t):
    return A.transcript_metrics(_bent(t))


@BOOK.add(
    "G5_merge_annotation",
    f"""select {_C} from features union all select rname, start+7, "end"+7, strand, gene_id, concat('n',transcript_id), exon_number, class_code, gene_name from features""",
    "features",
)
def g5(t):
    moved = t.features.withColumns(
        {"start": F.col("start") + 7, "end": F.col("end") + 7, "transcript_id": F.concat(F.lit("n"), F.col("transcript_id"))}
    )
    return A.merge_annotation(t.features.select(*COLS), moved.select(*COLS))


# Three samples of assemblies: whole, without first exons of some, with moved last exons of some.
_ASM = """asm as (select 'a' sample, rname, start, "end", strand, transcript_id, exon_number from features
   union all select 'b', rname, case when exon_number=1 then start+9 else start end, "end", strand, concat('b',transcript_id), exon_number from features where not (exon_number=1 and start%4=0 and start%3<>0)
   union all select 'c', rname, start, case when exon_number=2 and start%5=0 then "end"+40 else "end" end, strand, concat('c',transcript_id), exon_number from features)"""


def _asm(t):
    cols = ["sample", "rname", "start", "end", "strand", "transcript_id", "exon_number"]
    a = t.features.withColumn("sample", F.lit("a"))
    first = F.col("exon_number") == 1
    b = t.features.filter(~(first & (F.col("start") % 4 == 0) & (F.col("start") % 3 != 0))).withColumns(
        {"sample": F.lit("b"), "start": F.when(first, F.col("start") + 9).otherwise(F.col("start")), "transcript_id": F.concat(F.lit("b"), "transcript_id")}
    )
    late = (F.col("exon_number") == 2) & (F.col("start") % 5 == 0)
    c = t.features.withColumns(
        {"sample": F.lit("c"), "end": F.when(late, F.col("end") + 40).otherwise(F.col("end")), "transcript_id": F.concat(F.lit("c"), "transcript_id")}
    )
    return a.select(*cols).unionByName(b.select(*cols)).unionByName(c.select(*cols))


_CHAIN = f"""with {_ASM}, ix as (select *, lead(start) over (partition by sample, transcript_id order by start) nx from asm),
  ch as (select sample, transcript_id, rname, strand, min(start) start, max("end") "end", sum("end"-start) len, count(*) k, string_agg(cast("end" as varchar)||'-'||cast(nx as varchar), ',' order by start) filter (where nx is not null) c from ix group by 1,2,3,4),
  ky as (select *, case when k=1 then concat('=',cast(start as varchar),'-',cast("end" as varchar)) else concat(',',c,',') end chain_key from ch),
  rk as (select *, row_number() over (partition by rname, strand, chain_key order by len desc, sample, transcript_id) r from ky),
  ns as (select rname, strand, chain_key, count(distinct sample) n_samples from ky group by 1,2,3),
  rp as (select rname, strand, chain_key, transcript_id, sample, start, "end", n_samples from rk join ns using (rname, strand, chain_key) where r=1) """


@BOOK.add("G6_dedupe_transcripts", _CHAIN + "select * from rp", "features")
def g6(t):
    return A.dedupe_transcripts(_asm(t), ["a", "b", "c"])[0]


@BOOK.add(
    "G6_dedupe_transcripts_contained",
    _CHAIN + "select * from rp where chain_key not like '=%' and not exists (select 1 from rp o where o.rname=rp.rname and o.strand=rp.strand and o.chain_key like ',%' and length(o.chain_key)>length(rp.chain_key) and contains(o.chain_key, rp.chain_key))",
    "features",
)
def g6b(t):
    return A.dedupe_transcripts(_asm(t), ["a", "b", "c"], drop_contained=True, discard_single="all")[0]


@BOOK.add(
    "G6_transcript_tracking",
    _CHAIN + "select rname, strand, chain_key, min(transcript_id) filter (where sample='a') a, min(transcript_id) filter (where sample='b') b, min(transcript_id) filter (where sample='c') c from ky group by 1,2,3",
    "features",
)
def g6c(t):
    return A.dedupe_transcripts(_asm(t), ["a", "b", "c"])[1]


# Query transcripts: every third one moved, some without the first exon, some on the other strand.
_QRY = """with qx as (select concat('q',transcript_id) transcript_id, rname, strand s0, exon_number, cast(substr(transcript_id,2) as bigint) k, start, "end" from features),
  qq as (select transcript_id, rname, case when k%6=4 then case when s0='+' then '-' else '+' end else s0 end strand,
      case when k%6=2 and exon_number=3 then start+33 when k%6=3 then start+700 when k%6=5 then start+61000 when k%12=1 and exon_number=2 then start+5 else start end start,
      case when k%6=2 and exon_number=3 then "end"+33 when k%6=3 then "end"+700 when k%6=5 then "end"+61000 else "end" end "end"
    from qx where not (k%6=1 and exon_number=1)),
  qi as (select transcript_id, rname, strand, "end" start, nx "end" from (select *, lead(start) over (partition by transcript_id order by start) nx from qq) where nx>"end"),
  ri as (select transcript_id, rname, strand, "end" start, nx "end", idx from (select *, lead(start) over (partition by transcript_id order by start) nx, row_number() over (partition by transcript_id order by start) idx from features) where nx>"end"),
  qt as (select transcript_id, rname, strand, min(start) start, max("end") "end", count(*) k from qq group by 1,2,3),
  rt as (select transcript_id, rname, strand, min(start) start, max("end") "end", count(*) k from features group by 1,2,3),
  sh as (select q.transcript_id, r.transcript_id ref, count(*) c, min(idx) lo, max(idx) hi from qi q join ri r on q.rname=r.rname and q.strand=r.strand and q.start=r.start and q."end"=r."end" group by 1,2),
  fd as (select sh.transcript_id, 0 rk from sh join qt on qt.transcript_id=sh.transcript_id join rt on rt.transcript_id=sh.ref where qt.k>1 and c=qt.k-1 and rt.k=qt.k
    union all select sh.transcript_id, 1 from sh join qt on qt.transcript_id=sh.transcript_id join rt on rt.transcript_id=sh.ref where c=qt.k-1 and hi-lo+1=c and qt.start>=rt.start and qt."end"<=rt."end"
    union all select q.transcript_id, 1 from qt q join features r on q.k=1 and q.rname=r.rname and q.strand=r.strand and q.start>=r.start and q."end"<=r."end"
    union all select transcript_id, 2 from sh
    union all select q.transcript_id, 3 from qt q join features r on q.k=1 and q.rname=r.rname and q.strand=r.strand and q.start<r."end" and r.start<q."end" join ri i on i.transcript_id=r.transcript_id and least(q."end",i."end")-greatest(q.start,i.start)>=10
    union all select q.transcript_id, 4 from qt q join ri i on q.rname=i.rname and q.strand=i.strand and q.start>=i.start and q."end"<=i."end"
    union all select q.transcript_id, 5 from qq q join features r on q.rname=r.rname and q.strand=r.strand and q.start<r."end" and r.start<q."end"
    union all select q.transcript_id, 6 from qt q join rt r on q.rname=r.rname and q.strand=r.strand and q.start<=r."end"+2000 and r.start<=q."end"+2000
    union all select q.transcript_id, 9 from qq q join features r on q.rname=r.rname and q.strand<>r.strand and q.start<r."end" and r.start<q."end"
    union all select q.transcript_id, 10 from qi q join ri r on q.rname=r.rname and q.strand<>r.strand and q.start<r."end" and r.start<q."end"),
  bs as (select transcript_id, min(rk) rk from fd group by 1) """


def _query(t):
    k = F.substr("transcript_id", F.lit(2)).cast("bigint")
    q = t.features.withColumn("k", k).filter("not (k % 6 = 1 and exon_number = 1)")
    moved = (
        F.when((F.col("k") % 6 == 2) & (F.col("exon_number") == 3), 33).when(F.col("k") % 6 == 3, 700).when(F.col("k") % 6 == 5, 61000).otherwise(0)
    )
    late = F.when((F.col("k") % 12 == 1) & (F.col("exon_number") == 2), 5).otherwise(0)
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    return q.select(
        F.concat(F.lit("q"), "transcript_id").alias("transcript_id"), "rname", F.when(F.col("k") % 6 == 4, other).otherwise(F.col("strand")).alias("strand"),
        (F.col("start") + moved + late).alias("start"), (F.col("end") + moved).alias("end"),
    )


@BOOK.add(
    "G7_class_codes",
    _QRY + "select qt.transcript_id, coalesce((['=','c','j','e','i','o','p','r','u','x','s'])[rk+1],'u') class_code from qt left join bs using (transcript_id)",
    "features",
)
def g7(t):
    return A.class_codes(_query(t), t.features)


@BOOK.add(
    "G8_extract_transcripts",
    """with pc as (select f.transcript_id, f.strand, greatest(f.start,g.start) p, substr(g.seq, cast(greatest(f.start,g.start)-g.start+1 as int), cast(least(f."end",g.start+256)-greatest(f.start,g.start) as int)) s
         from features f join genome g on g.rname=f.rname and g.start<f."end" and f.start<g.start+256), w as (select transcript_id, strand, string_agg(s, '' order by p) s from pc group by 1,2)
       select transcript_id, case when strand='-' then reverse(translate(s,'ACGT','TGCA')) else s end seq from w""",
    "features", "genome",
)
def g8(t):
    return A.extract_transcripts(t.features, t.genome, chunk=256)


@BOOK.add(
    "G9_manifest_diff",
    """with o as (select doc_id, concat('f',cast(doc_id as varchar)) path, n_chars size, sha256(text) h from documents where doc_id%17<>0),
         n as (select doc_id, concat('f',cast(doc_id as varchar)) path, n_chars+case when doc_id%13=0 then 1 else 0 end size, case when doc_id%7=0 then sha256(upper(text)||'x') else sha256(text) end h, case when doc_id%5=0 then 2 when doc_id%5=1 then 1 else 0 end late from documents where doc_id%19<>0)
       select coalesce(o.path,n.path) path, case when o.path is null then 'not_logged' when n.path is null then 'missing' when o.size<>n.size then 'size_changed' when o.h<>n.h then 'hash_changed' when late>1 then 'newer' when n.doc_id%3=0 then 'inputs_newer' else 'unchanged' end state
       from o full join n on o.path=n.path""",
)
def g9(t):
    docs = t.documents.select(
        "doc_id", F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").alias("size"),
        F.timestamp_seconds(F.lit(1600000000) + F.col("doc_id")).alias("mtime"), F.sha2("text", 256).alias("sha256"), "text",
    )
    old = docs.filter("doc_id % 17 <> 0")
    late = F.when(F.col("doc_id") % 5 == 0, 2).when(F.col("doc_id") % 5 == 1, 1).otherwise(0)
    new = docs.filter("doc_id % 19 <> 0").withColumns(
        {
            "size": F.col("size") + F.when(F.col("doc_id") % 13 == 0, 1).otherwise(0),
            "sha256": F.when(F.col("doc_id") % 7 == 0, F.sha2(F.concat(F.upper("text"), F.lit("x")), 256)).otherwise(F.col("sha256")),
            "mtime": F.timestamp_seconds(F.lit(1600000000) + F.col("doc_id") + late),
        }
    )
    inputs = docs.filter("doc_id % 3 = 0").select("path", (F.col("mtime") + F.expr("interval 1 hour")).alias("input_mtime"))
    return A.manifest_diff(old, new, compare_hash=True, inputs=inputs)


@BOOK.add(
    "G10_filter_transcripts",
    """with x as (select transcript_id, gene_id, c.sample, c.length, c.count cov, c.count*1000/c.length fpkm, c.tpm from counts c join t2g on transcript_id=target_id),
         tp as (select gene_id, max(tpm) top from x group by 1)
       select x.* from x join tp using (gene_id) where length>=400 and cov>=10 and fpkm>=20 and tpm>=2 and tpm>=0.2*top""",
    "counts", "t2g",
)
def g10(t):
    x = t.counts.join(t.t2g, F.col("target_id") == F.col("transcript_id")).select(
        "transcript_id", "gene_id", "sample", "length", F.col("count").alias("cov"), (F.col("count") * 1000 / F.col("length")).alias("fpkm"), "tpm"
    )
    return A.filter_transcripts(x, min_len=400, min_cov=10, min_fpkm=20, min_tpm=2, iso_frac=0.2)


@BOOK.add(
    "G10_transcript_loci",
    """with mx as (select *, max("end") over (partition by rname, strand order by start, transcript_id rows between unbounded preceding and 1 preceding) reach from transcripts),
         cl as (select *, sum(case when reach is null or start>reach+250 then 1 else 0 end) over (partition by rname, strand order by start, transcript_id) isl from mx)
       select rname, strand, cast(min(start) as bigint) start, cast(max("end") as bigint) "end", count(*) n from cl group by rname, strand, isl""",
    "features", "transcripts",
)
def g10b(t):
    out = A.transcript_loci(t.transcripts)
    return out.withColumns({"start": F.col("start").cast("bigint"), "end": F.col("end").cast("bigint")})
