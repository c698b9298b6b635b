"""Sequencing tables derived from the driver's tables, as SQL for either engine.

``sql_for(dialect)`` gives the view texts; Spark reads the parquet files by path and the
oracle reads its registered views, so both sides see the same derived rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Fixed values.
BASE_TABLES = "region nation customer supplier part orders lineitem events documents".split()
ADAPTER = "AGATCGGAAGAGC"

DEPENDS = {
    "t2g": ["features"],
    "chrom_sizes": ["features"],
    "transcripts": ["features"],
    "mates": ["fragments"],
    "pe_fragments": ["fragments"],
}


def _bases(x: str) -> str:
    return f"translate(md5({x}),'0123456789abcdef','ACGTACGTACGTACGN')"


def _rc(x: str) -> str:
    return f"reverse(translate({x},'ACGTN','TGCAN'))"


def sql_for(dialect: str, table) -> dict[str, str]:
    spark = dialect == "spark"
    S = "string" if spark else "varchar"
    E = "`end`" if spark else '"end"'

    def s(x: str) -> str:
        return f"cast({x} as {S})"

    # (7 i + 3 k) mod 41 repeats with period 41 in i, so a quality string is a slice of one fixed text.
    period = "".join(chr(33 + 7 * i % 41) for i in range(41))
    period = period.replace("'", "\\'" if spark else "''")

    def qual(n: str, k: str) -> str:
        return f"substr(repeat('{period}',5),cast((({k}*3)%41*6)%41+2 as int),{n})"

    def seq3(k: str) -> str:
        return "concat(" + ",".join(_bases(f"concat({s(k)},'{x}')") for x in "abc") + ")"

    k1, k2 = "o_orderkey", "(-o_orderkey-1)"
    frag = seq3(k1)
    plant = f"case when o_orderkey%7=3 then '{ADAPTER}' else '' end"
    v: dict[str, str] = {}
    v["reads"] = f"""
      select sample, read_idx, mate, qname, seq, {qual('cast(length(seq) as int)', 'k')} qual from (
        select concat('s',{s('o_orderkey%3')}) sample, o_orderkey read_idx, 1 mate,
               concat('q',{s('o_orderkey')},' x') qname, o_orderkey k,
               case when o_orderkey%50=1 then ''
                    when o_orderkey%10=0 then concat(substr({frag},1,50),'{ADAPTER}')
                    else concat(substr({frag},1,cast(60+o_orderkey%36 as int)),{plant}) end seq
        from {table('orders')}
        union all
        select concat('s',{s('o_orderkey%3')}) sample, o_orderkey read_idx, 2 mate,
               concat('q',{s('o_orderkey')},' x') qname, o_orderkey+5 k,
               case when o_orderkey%50=2 then ''
                    when o_orderkey%10=0 then concat({_rc(f"substr({frag},1,50)")},'{ADAPTER}')
                    when o_orderkey%5=0 then {_rc(f"substr({frag},27,70)")}
                    else concat(substr({seq3(k2)},1,cast(60+o_orderkey%36 as int)),{plant}) end seq
        from {table('orders')}) u"""
    clean = (
        "regexp_replace(upper(text),'[^ACGTN]','')" if spark else "regexp_replace(upper(text),'[^ACGTN]','','g')"
    )
    v["text_reads"] = f"""
      select concat('s',{s('doc_id%3')}) sample, doc_id read_idx, 1 mate, concat('d',{s('doc_id')}) qname,
             {clean} seq from {table('documents')}"""
    v["genome"] = f"""
      select concat('chr',{s('p_partkey%5+1')}) rname, cast(floor(p_partkey/5)*256 as int) start,
             concat({','.join(_bases(f"concat({s('p_partkey')},'{x}')") for x in 'abcdefgh')}) seq from {table('part')}"""
    v["alignments"] = f"""
      select aln_id, sample, qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, nm, nh,
             substr(concat({_bases("concat(aln_id,'a')")},{_bases("concat(aln_id,'b')")}),1,50) seq,
             {qual('50', 'k')} qual from (
        select concat({s('l_orderkey')},'_',{s('l_partkey')},'_',{s('l_suppkey')},'_',{s('l_linenumber')},'_',{s('cast(l_quantity as int)')}) aln_id,
               l_orderkey k, concat('s',{s('l_suppkey%3')}) sample, concat('r',{s('l_orderkey')}) qname,
               cast((case when l_linenumber%2=1 then 64 else 128 end)+1+(case when l_returnflag='R' then 16 else 0 end)
                 +(case when l_partkey%2=0 then 32 else 0 end)+(case when l_partkey%3=0 then 2 else 0 end)
                 +(case when l_linenumber>4 then 256 else 0 end)+(case when l_tax>0.07 then 1024 else 0 end) as int) flag,
               concat('chr',{s('l_suppkey%5+1')}) rname, cast((l_partkey*7919+l_orderkey*31)%100000+1 as int) pos,
               cast(l_quantity as int) mapq,
               case l_linenumber%4 when 0 then '50M' when 1 then concat('20M',{s('cast(l_quantity as int)*100')},'N30M')
                                   when 2 then '5S45M' else '25M2I20M3D3M' end cigar,
               case when l_linenumber%3=0 then '*' when l_partkey%10=0 then 'chr1' else '=' end rnext,
               cast(case when l_linenumber%3=0 then 0 else (l_partkey*7919+l_orderkey*31)%100000+1+l_partkey%400 end as int) pnext,
               cast(case when l_linenumber%3=0 or l_partkey%10=0 then 0
                         else (l_partkey*13)%1200-600 end as int) tlen,
               cast(l_suppkey%3 as int) nm, cast(l_linenumber%3+1 as int) nh
        from {table('lineitem')}) a"""
    v["fragments"] = f"""
      select l_orderkey k, concat('s',{s('l_orderkey%3')}) sample, concat('r',{s('l_orderkey')}) qname,
             cast((case when l_orderkey%9=0 then 128 else 64 end)
                  +(case when l_orderkey%4=0 then 16 else 0 end)*(case when l_suppkey%19=0 then 0 else 1 end)
                  +(case when l_suppkey%19=0 and l_orderkey%4<>0 then 16 else 0 end) as int) flag,
             case when l_partkey%11=0 then 'chr5' else concat('chr',{s('l_orderkey%4+1')}) end rname,
             cast(l_orderkey%90000+1+xq*(case when l_partkey%13=0 then 12 else 700 end)
                  +(case when l_partkey%17=0 then 250000 else 0 end)+l_partkey%300 as int) pos,
             cast(l_quantity as int) mapq,
             case when l_partkey%5=0 then '10M5I15M' when l_partkey%5=1 then '20M4D10M' else '30M' end cigar, xi, xq,
             cast((case when l_orderkey%8=0 then 2-xq else xq end)*30+1 as int) xx, cast(l_suppkey%3 as int) nm,
             case l_suppkey%3 when 0 then '30' when 1 then '10A19' else '0C5T23' end md,
             substr({_bases(f"concat({s('l_orderkey')},'f',{s('l_partkey')})")},1,30) seq,
             {qual('30', 'l_partkey')} qual
      from (select *, cast(floor((rn-1)/3) as int) xi, cast((rn-1)%3 as int) xq
            from (select *, row_number() over(partition by l_orderkey
                    order by l_partkey,l_suppkey,l_linenumber,l_extendedprice,l_shipdate,l_quantity) rn
                  from {table('lineitem')}) x) y"""

    v["pe_fragments"] = """
      select sample, qname, cast((case when k%3<>0 and xq=2 then 129 else 65 end)+(flag & 16) as int) flag, rname, pos, mapq, cigar, xi, xq, xx,
             nm, md, seq, qual from fragments"""
    v["mates"] = """
      select sample, qname, cast(321+(flag & 16) as int) flag, rname, pos, mapq, cigar, '*' rnext, cast(0 as int) pnext,
             cast(xi*3+xq as int) xi, cast(0 as int) nh from fragments
      union all
      select sample, qname, cast(385+16-(flag & 16)*(case when k%3=0 then 0 else 1 end) as int) flag,
             case when nm=1 then 'chr5' else rname end rname, cast(pos+200-k%500 as int) pos, mapq, '30M' cigar, '*' rnext,
             cast(0 as int) pnext, cast(xi*3+xq as int) xi, cast(0 as int) nh from fragments where k%2=1"""

    def exon(i: int) -> str:
        return f"""
      select concat('chr',{s('p_partkey%5+1')}) rname, cast((p_partkey*4801)%100000+{1500 * (i - 1)} as int) start,
             cast((p_partkey*4801)%100000+{1500 * (i - 1)}+200+p_size*20 as int) {E},
             case when p_partkey%2=0 then '+' else '-' end strand,
             concat('g',{s('p_partkey%5+1')},case when p_partkey%2=0 then 'p' else 'm' end,
                    {s('cast(floor((p_partkey*4801)%100000/4000) as int)')}) gene_id,
             concat('t',{s('p_partkey')}) transcript_id, cast({i} as int) exon_number,
             case p_size%6 when 0 then '=' when 1 then 'c' when 2 then 'j' when 3 then 'u' when 4 then 'x' else 'i' end class_code,
             case when p_partkey%5=0 then null when p_partkey%4=1 then concat('ENSG',{s('p_partkey')}) else p_brand end gene_name
      from {table('part')} where p_partkey%3+1>={i}"""

    v["features"] = " union all ".join(exon(i) for i in (1, 2, 3))
    v["transcripts"] = f"""
      select transcript_id, gene_id, rname, strand, min(start) start, max({E}) {E} from features
      group by transcript_id, gene_id, rname, strand"""
    v["t2g"] = "select distinct transcript_id, gene_id from features"
    v["chrom_sizes"] = f"""
      select rname, cast(ceil(max({E})/10000.0)*10000+20000 as bigint) length from features group by rname"""
    v["counts"] = f"""
      select concat('s',{s('l_suppkey%3')}) sample, concat('t',{s('l_partkey')}) target_id,
             cast(l_partkey%900+300 as double) length, cast(l_partkey%900+200 as double) eff_length,
             sum(l_quantity) count, cast(sum(cast(round(l_tax*100) as int)) as double) tpm
      from {table('lineitem')} group by l_suppkey%3, l_partkey"""
    v["samples"] = f"""
      select s_name sample, substr({_bases('s_name')},1,6) index_r1, substr({_bases("concat(s_name,'2')")},1,6) index_r2,
             cast(s_nationkey%8+1 as int) lane, concat('p',{s('s_nationkey%3')}) project
      from {table('supplier')}"""
    v["index_reads"] = f"""
      select o_orderkey read_idx,
             substr(case when o_orderkey%5=0 then translate(substr(b,1,1),'ACGTN','CGTAA')||substr(b,2) else b end,1,6) barcode
      from (select o_orderkey, {_bases("concat('Supplier#',lpad(cast(o_orderkey%120 as " + S + "),9,'0'))")} b
            from {table('orders')}) x"""
    return v


def ctes(dialect: str, names: list[str], table) -> str:
    """``WITH`` list of the named views and those they build on."""
    texts = sql_for(dialect, table)
    order: list[str] = []

    def visit(name: str) -> None:
        for dep in DEPENDS.get(name, []):
            visit(dep)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return ", ".join(f"{n} as ({texts[n]})" for n in order)


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    used: set[str] = set()

    def table(t: str) -> str:
        used.add(t)
        return "{" + t + "}"

    sources = ctes("spark", [name], table)
    sql = f"with {sources} select * from {name}"
    inputs = {t: base(spark, sf_dir, t) for t in sorted(used) if "{" + t + "}" in sql}
    return spark.sql(sql, **inputs)


def oracle(sql: str, *names: str) -> str:
    """Oracle text over derived views; a ``WITH`` of its own is continued."""
    head = ctes("duckdb", list(names), lambda t: t)
    body = sql.strip()
    if body[:5].lower() == "with ":
        return f"with {head}, {body[5:]}"
    return f"with {head} {body}"
