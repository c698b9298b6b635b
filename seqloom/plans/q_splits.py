"""Queries of split-read assembly."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import splitreads as S
from .book import Book

BOOK = Book()


def _len(kinds: str) -> str:
    return rf"cast(coalesce(list_sum(list_transform(regexp_extract_all(cigar,'(\d+)[{kinds}]',1), lambda x: cast(x as int))),0) as bigint)"


MD = r"""list_reduce(list(md order by pos, rk), lambda a, b: case when regexp_matches(a,'\d$') and regexp_matches(b,'^\d')
   then concat(regexp_replace(a,'\d+$',''), cast(cast(regexp_extract(a,'\d+$') as int)+cast(regexp_extract(b,'^\d+') as int) as varchar), regexp_replace(b,'^\d+',''))
   else concat(a,b) end)"""

_SPLIT = f"""with f as (select *, case when flag&128>0 then 2 else 1 end mate, row_number() over (partition by sample, qname, flag&128, xi order by xx) rk, {_len('MDX=')} len from fragments),
  nb as (select *, lag(rname) over w pr, lag(pos+len) over w pe, lag(flag&16) over w pf, lag(rk) over w pk, row_number() over w i from f window w as (partition by sample, qname, mate, xi order by pos, rk)),
  cl as (select *, case when i=1 then 0 when rname<>pr then 1 when pos-pe>=200000 then 3 when flag&16<>pf then 2 when pos<pe then 4 when flag&16>0 and rk<>pk-1 then 5 when flag&16=0 and rk<>pk+1 then 5 else 0 end code from nb),
  mp as (select sample, qname, mate, xi, count(*) n_frags, sum(nm) dist, case when bool_or(code=1) then 'chromosome' when bool_or(code=2) then 'strand' when bool_or(code=3) then 'distance' when bool_or(code=4) then 'overlap'
      when count(*) filter (where code=5)>1 then 'non_circular' when count(*) filter (where code=5)=1 then 'circular' end reason from cl group by 1,2,3,4),
  bm as (select *, min(dist) over (partition by sample, qname, mate) lo from mp), best as (select *, count(*) over (partition by sample, qname, mate) nh from bm where dist=lo),
  joined as (select c.sample, c.qname, c.mate, c.xi, cast(min(b.nh) as int) nh, first(flag order by pos, rk) flag, first(rname order by pos, rk) rname, min(pos) pos,
     string_agg(case when i=1 then cigar else concat(cast(pos-pe as varchar),'N',cigar) end, '' order by pos, rk) cigar, string_agg(seq, '' order by pos, rk) seq,
     string_agg(qual, '' order by pos, rk) qual, cast(sum(nm) as int) nm, {MD} md
     from cl c join best b using (sample, qname, mate, xi) where b.reason is null group by 1,2,3,4) """


@BOOK.add(
    "A14_join_split_reads",
    _SPLIT + """select * exclude (mate), case when flag&16>0 then '-' else '+' end xs, true xs_sure from joined
       union all by name select sample, concat(qname,'u') qname, xi, 7 nh, flag, rname, pos, cigar, seq, qual, nm, md, null xs, false xs_sure from fragments where xq=0 and k%7=0""",
    "fragments",
)
def a14(t):
    # Some records are planted that are not split.
    whole = t.fragments.filter("xq = 0 and k % 7 = 0").withColumns({"qname": F.concat("qname", F.lit("u")), "xq": F.lit(None).cast("int"), "nh": F.lit(7)})
    return S.join_split_reads(t.fragments.withColumn("nh", F.lit(None).cast("int")).unionByName(whole))


_SITES = """, gx as (select a.rname, a.start, a.seq||coalesce(substr(b.seq,1,1),'') seq from genome a left join genome b on a.rname=b.rname and b.start=a.start+256),
  jn as (select c.*, pe-1 donor, pos-3 acceptor from {src}),
  mo as (select jn.*, concat(substr(d.seq,cast(donor-d.start+1 as int),2), substr(e.seq,cast(acceptor-e.start+1 as int),2)) m from jn
     left join gx d on d.rname=jn.rname and d.start=donor//256*256 left join gx e on e.rname=jn.rname and e.start=acceptor//256*256),
  ms as (select *, case when m in ('GTAG','GCAG','ATAC') then '+' when m in ('CTAC','CTGC','GTAT') then '-' end s from mo) """


@BOOK.add(
    "A14_join_split_reads_genome",
    _SPLIT + _SITES.format(src="cl c join best b using (sample, qname, mate, xi) where b.reason is null and i>1")
    + """, x as (select sample, qname, mate, xi, first(s order by i) s from ms where s is not null group by 1,2,3,4)
       select j.sample, j.qname, j.xi, j.flag, j.pos, j.cigar, coalesce(x.s,'+') xs, x.s is not null xs_sure from joined j left join x using (sample, qname, mate, xi)""",
    "fragments", "genome",
)
def a14b(t):
    out = S.join_split_reads(t.fragments, genome=t.genome)
    return out.select("sample", "qname", "xi", "flag", "pos", "cigar", "xs", "xs_sure")


_REASONS = ("chromosome", "strand", "distance", "overlap", "non_circular", "circular")


@BOOK.add(
    "A15_split_read_report",
    _SPLIT + """, r as (select sample, 0::bigint one_fragment, count(*) split, count(*) total, count(*) filter (where n_frags>2) split_more, count(reason) fusion,
        count(reason) filter (where n_frags>2) fusion_more, """
    + ", ".join(f"count(*) filter (where reason='{r}') {r}" for r in _REASONS)
    + " from best group by sample) select *, split/total split_of_total, fusion/total fusion_of_total, fusion/split fusion_of_split, "
    + ", ".join(f"case when fusion>0 then {r}/fusion else 0 end {r}_of_fusion" for r in _REASONS)
    + " from r",
    "fragments",
)
def a15(t):
    return S.split_read_report(t.fragments)


_PE = f"""with f as (select *, case when flag&128>0 then 2 else 1 end mate, row_number() over (partition by sample, qname, flag&128, xi order by xx, pos, xq) rk, {_len('MIS=X')} len from pe_fragments),
  nb as (select *, lag(pos+len) over w pe, lag(xq) over w pq, row_number() over w i, first_value(flag) over w f1, first_value(rname) over w r1 from f window w as (partition by sample, qname, mate, xi order by pos, rk)),
  st as (select sample, qname, xi, mate, count(*) n, case when count(*)=1 then null when bool_or(rname<>r1) then 'not_same_chr' when bool_or(flag&16<>f1&16) then 'not_same_strand'
      when bool_or(i>1 and pos-pe>200000) then 'max_dist_breached' when bool_or(i>1 and pos-pe<=0) then 'fragment_overlap'
      when bool_or(i>1 and case when f1&16>0 then pq<xq else pq>xq end) then 'order_switch' else 'OK' end state from nb group by 1,2,3,4),
  tm as (select sample, qname, xi, bool_and(coalesce(state,'OK')='OK') suitable, max(n) filter (where mate=1) n1, max(n) filter (where mate=2) n2, max(state) filter (where mate=1) state1, max(state) filter (where mate=2) state2 from st group by 1,2,3),
  nhs as (select sample, qname, cast(count(*) as int) nh from tm group by 1,2),
  rec as (select c.sample, c.qname, c.xi, c.mate, max(s.state) ys, first(flag order by pos, rk) flag, first(rname order by pos, rk) rname, min(pos) pos,
     string_agg(case when i=1 then cigar else concat(cast(pos-pe as varchar),'N',cigar) end, '' order by pos, rk) cigar, string_agg(seq, '' order by pos, rk) seq, string_agg(qual, '' order by pos, rk) qual, cast(sum(nm) as int) nm, {MD} md
     from nb c join st s using (sample, qname, xi, mate) join tm using (sample, qname, xi) where suitable group by 1,2,3,4),
  pr as (select a.*, nh, b.flag bf, b.rname bn, b.pos bp, a.pos+{_len('MDN=X').replace('cigar', 'a.cigar')} ae, b.pos+{_len('MDN=X').replace('cigar', 'b.cigar')} be
     from rec a join nhs using (sample, qname) left join rec b on b.sample=a.sample and b.qname=a.qname and b.xi=a.xi and b.mate<>a.mate),
  fl as (select *, cast((case when bp is not null then flag-(flag&2) else flag end - (flag&256)) | (case when nh>1 then 256 else 0 end) | (case when bp is null then 8 else 0 end) | (case when bf&16>0 then 32 else 0 end)
      | (case when bn=rname and ((flag&16>0 and bf&16=0 and bp<=pos) or (flag&16=0 and bf&16>0 and pos<=bp)) then 2 else 0 end) as int) nf from pr)"""


@BOOK.add(
    "A16_join_split_reads_pe",
    _PE + """ select sample, qname, xi, nf flag, rname, pos, case nh when 1 then 50 when 2 then 5 else 0 end mapq, cigar, case when bp is null then '*' when bn=rname then '=' else bn end rnext, coalesce(bp,0) pnext,
        cast(case when bn=rname then (greatest(ae,be)-least(pos,bp))*(case when pos<bp or (pos=bp and mate=1) then 1 else -1 end) else 0 end as int) tlen, seq, qual, nm, md, nh,
        case when (mate=2)=(flag&16>0) then '-' else '+' end xs, ys from fl""",
    "fragments", "pe_fragments",
)
def a16(t):
    return S.join_split_reads_pe(t.pe_fragments, library_type="firststrand")


@BOOK.add(
    "A16_join_split_reads_pe_genome",
    _PE + _SITES.format(src="nb c join st s using (sample, qname, xi, mate) where s.state='OK' and i>1")
    + """, x as (select sample, qname, xi, mate, min(coalesce(s,'?')) lo, max(coalesce(s,'?')) hi from ms group by 1,2,3,4)
       select fl.sample, fl.qname, fl.xi, fl.nf flag, fl.pos, fl.cigar, case when lo=hi and lo<>'?' then lo end xs from fl left join x using (sample, qname, xi, mate)""",
    "fragments", "pe_fragments", "genome",
)
def a16b(t):
    out = S.join_split_reads_pe(t.pe_fragments, library_type="unstranded", genome=t.genome)
    return out.select("sample", "qname", "xi", "flag", "pos", "cigar", "xs")


_STATES = ("not_same_chr", "not_same_strand", "max_dist_breached", "fragment_overlap", "order_switch", "OK")


def _metric(direction: str, name: str, expr: str) -> str:
    return f"select sample, '{direction}' direction, '{name}' metric, cast({expr} as bigint) n from tp group by 1"


@BOOK.add(
    "A17_split_template_metrics",
    _PE + """, tp as (select sample, qname, count(*) k, bool_or(suitable) ok, bool_or(xi=0 and n1 is not null) h1, bool_or(xi=0 and n2 is not null) h2, max(state1) filter (where xi=0) s1, max(state2) filter (where xi=0) s2 from tm group by 1,2) """
    + " union all ".join(
        [
            _metric(d, m, f"count(*) filter (where {c} and {w})")
            for d, w in (("in", "true"), ("out", "ok"))
            for m, c in (("templates", "true"), ("unmapped", "false"), ("multiple", "k>1"), ("unique", "k=1"), ("multiple.r1", "k>1 and h1"),
                         ("multiple.r2", "k>1 and h2"), ("unique.r1", "k=1 and h1"), ("unique.r2", "k=1 and h2"))
        ]
        + [_metric("in", "unique.splits", "count(s1) filter (where k=1)+count(s2) filter (where k=1)")]
        + [_metric("out", "unique.splits", "count(*) filter (where k=1 and s1='OK')+count(*) filter (where k=1 and s2='OK')")]
        + [_metric("in", f"unique.split_types.{s}", f"count(*) filter (where k=1 and s1='{s}')+count(*) filter (where k=1 and s2='{s}')") for s in _STATES]
    ),
    "fragments", "pe_fragments",
)
def a17(t):
    return S.split_template_metrics(t.pe_fragments)
