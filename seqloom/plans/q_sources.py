"""Queries of sources and sinks: text is derived from the tables, parsed back, and compared with the tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.staging import shared_folder
from ..operators import alignments as AL, counts as C, coverage as CV, qc as Q
from ..sources import fasta as FA, fastq as FQ, sinks as K, text as T
from .book import Book
from .q_alignments import BLOCKS, REF, _NAMED, _targets
from .q_coverage import SAMPLES, _RUNS

BOOK = Book()


def _scratch(spark) -> str:
    """A new folder in the cluster's shared checkpoint folder."""
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


@BOOK.add(
    "S1_read_fastq",
    "select mate, row_number() over (partition by mate order by read_idx)-1 read_idx, split_part(qname,' ',1) qname, 'x' descr, seq, qual from reads",
    "reads",
)
def s1(t):
    out = None
    for mate in (1, 2):
        path = _scratch(t.spark)
        lines = K.fastq_lines(t.reads.filter(F.col("mate") == mate)).repartitionByRange("read_idx").sortWithinPartitions("read_idx")
        lines.select("value").write.text(path)
        one = FQ.read_fastq(t.spark, path, sample="all", mate=mate, split_bytes=1 << 18).select(F.lit(mate).alias("mate"), "read_idx", "qname", "descr", "seq", "qual")
        out = one if out is None else out.unionByName(one)
    return out


@BOOK.add(
    "K1_write_fastq",
    "select sample, mate, row_number() over (partition by sample, mate order by read_idx)-1 read_idx, split_part(qname,' ',1) qname, seq, qual from reads",
    "reads",
)
def k1(t):
    path = _scratch(t.spark)
    K.write_fastq(t.reads, path)
    out = None
    for s in SAMPLES:
        for mate in (1, 2):
            one = FQ.read_fastq(t.spark, f"{path}/sample={s}/mate={mate}", sample=s, mate=mate).select("sample", F.lit(mate).alias("mate"), "read_idx", "qname", "seq", "qual")
            out = one if out is None else out.unionByName(one)
    return out


@BOOK.add(
    "S2_fasta_chunks",
    "select concat(rname,'_',cast(start as varchar)) rname, cast(o as int) start, substr(seq, cast(o as int)+1, 100) seq from genome, range(0, 256, 100) r(o)",
    "genome",
)
def s2b(t):
    path = _scratch(t.spark)
    named = t.genome.select(F.concat_ws("_", "rname", F.col("start").cast("string")).alias("name"), "seq")
    K.write_fasta(named, path)
    # Small ranges make most sequences begin in one and end in another.
    return FA.read_fasta_chunks(t.spark, path, chunk=100, split_bytes=1 << 14)


@BOOK.add(
    "S2_read_fasta",
    "select concat(rname,'_',cast(start as varchar)) \"name\", concat('start=',cast(start as varchar),' chunk') descr, seq, cast(length(seq) as bigint) length from genome",
    "genome",
)
def s2(t):
    path = _scratch(t.spark)
    named = t.genome.select(
        F.concat_ws("_", "rname", F.col("start").cast("string")).alias("name"),
        F.concat(F.lit("start="), F.col("start").cast("string"), F.lit(" chunk")).alias("descr"), "seq",
    )
    K.write_fasta(named, path)
    return T.read_fasta(t.spark, path)


@BOOK.add(
    "K1_write_fasta",
    "select concat(rname,'_',cast(start as varchar)) \"name\", concat('>',rname,'_',cast(start as varchar),chr(10),substr(seq,1,100),chr(10),substr(seq,101,100),chr(10),substr(seq,201)) \"value\" from genome",
    "genome",
)
def k1b(t):
    named = t.genome.select(F.concat_ws("_", "rname", F.col("start").cast("string")).alias("name"), "seq")
    return K.fasta_lines(named, width=100)


def _tagged(t):
    def entry(type_, value):
        return F.struct(F.lit(type_).alias("type"), value.alias("value"))

    tags = F.create_map(
        F.lit("NM"), entry("i", F.col("nm").cast("string")), F.lit("CO"), entry("Z", F.concat(F.lit("a:b:"), "aln_id")),
        F.lit("NH"), entry("i", F.col("nh").cast("string")),
    )
    return t.alignments.withColumn("tags", tags)


_SAM = """concat_ws(chr(9), qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, concat('CO:Z:a:b:',aln_id), concat('NH:i:',nh), concat('NM:i:',nm))"""


@BOOK.add(
    "S3_read_sam",
    "select sample, qname, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, seq, qual, cast(nm as varchar) nm, concat('a:b:',aln_id) co, 3 n_tags from alignments",
    "alignments",
)
def s3(t):
    lines = K.sam_lines(_tagged(t)).select("sample", "value")
    header = t.alignments.select("sample", F.concat(F.lit("@CO\t"), "sample").alias("value")).distinct()
    out = T.parse_sam(header.unionByName(lines))
    return out.select(
        "sample", "qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual",
        F.col("tags")["NM"]["value"].alias("nm"), F.col("tags")["CO"]["value"].alias("co"), F.size("tags").alias("n_tags"),
    )


@BOOK.add("K2_write_sam", f'select sample, rname, pos, {_SAM} "value" from alignments', "alignments")
def k2(t):
    return K.sam_lines(_tagged(t))


@BOOK.add(
    "K2_write_sam_header",
    f"""with sq as (select rname, row_number() over (order by rname desc) k, length from chrom_sizes), sm as (select distinct sample from alignments)
       select sample, cast(0 as int) section, cast(1 as int) ref, cast(0 as int) pos, concat('@HD',chr(9),'VN:1.6',chr(9),'SO:coordinate') "value" from sm
       union all select sample, 0, cast(k+1 as int), 0, concat_ws(chr(9),'@SQ',concat('SN:',rname),concat('LN:',length)) from sm, sq
       union all select sample, 1, cast(k+1 as int), pos, {_SAM} from alignments join sq using (rname)""",
    "alignments", "chrom_sizes",
)
def k2b(t):
    every = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    back = -F.regexp_extract("rname", "(\\d+)$", 1).cast("int")
    text = F.concat(F.lit("@SQ\tSN:"), "rname", F.lit("\tLN:"), F.col("length").cast("string"))
    # Every line stands twice, as in a header merged from two files.
    sq = t.chrom_sizes.select("*", every(SAMPLES).alias("sample")).select("*", every([0, 1000]).alias("at"))
    sq = sq.select("sample", F.lit("b").alias("file"), (F.col("at") + back).alias("line"), text.alias("value"))
    hd = sq.select("sample", F.lit("a").alias("file"), F.lit(0).alias("line"), F.lit("@HD\tVN:1.6\tSO:unsorted").alias("value"))
    return K.sam_text(_tagged(t), hd.unionByName(sq)).select("sample", "section", "ref", "pos", "value")


_ATTRS = ["gene_id", "transcript_id", "exon_number", "class_code", "gene_name"]


@BOOK.add(
    "S4_read_gtf",
    """select rname, start, "end", strand, gene_id, transcript_id, exon_number, class_code, gene_name, 'exon' feature from features""",
    "features",
)
def s4(t):
    lines = K.gtf_lines(t.features, attributes=_ATTRS).select("value")
    comment = t.features.select(F.concat(F.lit("# "), "rname").alias("value")).distinct()
    out = T.parse_gtf(comment.unionByName(lines))
    return out.select(
        "rname", "start", "end", "strand", "gene_id", "transcript_id", "exon_number", F.col("attrs")["class_code"].alias("class_code"),
        F.col("attrs")["gene_name"].alias("gene_name"), "feature",
    )


@BOOK.add(
    "K3_write_gtf",
    """select rname, start, concat_ws(chr(9), rname, '.', 'exon', start+1, "end", '.', strand, '.', concat('gene_id "',gene_id,'"; transcript_id "',transcript_id,'"; exon_number "',exon_number,'"; class_code "',class_code,'"',
         case when gene_name is null then '' else concat('; gene_name "',gene_name,'"') end)) "value" from features""",
    "features",
)
def k3(t):
    return K.gtf_lines(t.features, attributes=_ATTRS)


@BOOK.add(
    "S5_read_bed",
    f"""select rname, cast(pos-1 as int) start, cast(pos-1+{REF} as int) "end", concat(qname,case when flag&128>0 then '/2' else '/1' end) "name", cast(mapq as double) score, case when flag&16>0 then '-' else '+' end strand from alignments""",
    "alignments",
)
def s5(t):
    bed = AL.to_bed(t.alignments)
    lines = bed.select(F.concat_ws("\t", "rname", "start", "end", "name", "score", "strand").alias("value"))
    return T.parse_bed(lines).drop("blocks")


@BOOK.add(
    "S5_read_bed12",
    """select transcript_id "name", rname, strand, start, "end" from features""",
    "features",
)
def s5b(t):
    rows = F.sort_array(F.collect_list(F.struct("start", "end")))
    tr = t.features.groupBy("transcript_id", "rname", "strand").agg(rows.alias("ex"), F.min("start").alias("lo"), F.max("end").alias("hi"))
    sizes = F.array_join(F.transform("ex", lambda e: (e["end"] - e["start"]).cast("string")), ",")
    starts = F.array_join(F.transform("ex", lambda e: (e["start"] - F.col("lo")).cast("string")), ",")
    line = F.concat_ws(
        "\t", "rname", "lo", "hi", "transcript_id", F.lit("0"), "strand", "lo", "hi", F.lit("0"), F.size("ex").cast("string"),
        F.concat(sizes, F.lit(",")), F.concat(starts, F.lit(",")),
    )
    bed = T.parse_bed(tr.select(line.alias("value")))
    return bed.select("name", "rname", "strand", F.inline("blocks"))


@BOOK.add(
    "S6_read_counts",
    """select tool, target_id, count, tpm from counts, (select unnest(['salmon','kallisto','htseq','featurecounts']) tool)""".replace(
        "count, tpm from", "count, case when tool in ('salmon','kallisto') then tpm else -1 end tpm from"
    ),
    "counts",
)
def s6(t):
    c = t.counts
    shapes = {
        "salmon": ("Name\tLength\tEffectiveLength\tTPM\tNumReads", ["target_id", "length", "eff_length", "tpm", "count"]),
        "kallisto": ("target_id\tlength\teff_length\test_counts\ttpm", ["target_id", "length", "eff_length", "count", "tpm"]),
        "htseq": (None, ["target_id", "count"]),
        "featurecounts": ("Geneid\tChr\tStart\tEnd\tStrand\tLength\tx.bam", ["target_id", "sample", "length", "length", "sample", "length", "count"]),
    }
    out = None
    for tool, (header, cols) in shapes.items():
        lines = c.select(F.concat_ws("\t", *[F.col(x).cast("string") for x in cols]).alias("value"))
        if header:
            lines = c.select(F.concat(F.lit(header), F.left("target_id", F.lit(0))).alias("value")).distinct().unionByName(lines)
        one = T.parse_counts(lines, tool=tool).select(F.lit(tool).alias("tool"), "target_id", "count", F.coalesce("tpm", F.lit(-1.0)).alias("tpm"))
        out = one if out is None else out.unionByName(one)
    return out


@BOOK.add(
    "S7_read_sample_sheet",
    """select sample, index_r1, case when lane%2=0 then index_r2 else '-' end index_r2, cast(lane as varchar) lane from samples""",
    "samples",
)
def s7(t):
    two = F.concat_ws("-", "index_r1", "index_r2")
    sheet = t.samples.select(
        F.col("sample").alias("SampleID"), F.when(F.col("lane") % 2 == 0, two).otherwise(F.col("index_r1")).alias("Index"), F.col("lane").cast("string").alias("Lane")
    )
    # Every sample is listed once per read pair of its lane, as in real sheets.
    out = T.sample_sheet(sheet.unionByName(sheet))
    return out.select("sample", "index_r1", F.coalesce("index_r2", F.lit("-")).alias("index_r2"), "lane")


@BOOK.add(
    "S8_discover_samples",
    """select concat('in_L',lpad(cast(o_orderkey%1000 as varchar),3,'0'),'_',cast(o_orderkey%7 as varchar)) sample, cast(m as int) mate,
         concat('/data/x',cast(o_orderkey as varchar),'_L',lpad(cast(o_orderkey%1000 as varchar),3,'0'),'_R',m,'_',cast(o_orderkey%7 as varchar),'.fastq.gz') path from orders, (select unnest([1,2]) m)""",
)
def s8(t):
    key = F.col("o_orderkey")
    mate = F.explode(F.array(F.lit(1), F.lit(2))).alias("m")
    path = F.concat(
        F.lit("/data/x"), key.cast("string"), F.lit("_L"), F.lpad((key % 1000).cast("string"), 3, "0"), F.lit("_R"), F.col("m").cast("string"), F.lit("_"),
        (key % 7).cast("string"), F.lit(".fastq.gz"),
    )
    files = t.orders.select("o_orderkey", mate).select(path.alias("path"))
    return T.discover_samples(files, pattern=r"\w*_(L\d{3})_R[12]_(\d)\.fastq\.gz", prefix="in")


@BOOK.add("S9_read_chrom_sizes", "select rname, length from chrom_sizes", "chrom_sizes")
def s9(t):
    return T.chrom_sizes(t.chrom_sizes.select(F.concat_ws("\t", "rname", F.col("length").cast("string")).alias("value")))


@BOOK.add(
    "S10_verify_hashes",
    """select cast(doc_id as varchar) path, case when doc_id%9=0 then 'missing' when doc_id%4=0 then 'mismatch' else 'ok' end state from documents""",
)
def s10(t):
    path = F.col("doc_id").cast("string").alias("path")
    contents = t.documents.filter("doc_id % 9 <> 0").select(path, F.col("text").cast("binary").alias("content"))
    said = F.when(F.col("doc_id") % 4 == 0, F.upper(F.sha1(F.concat("text", F.lit("!"))))).otherwise(F.sha1("text"))
    return T.verify_hashes(contents, t.documents.select(path, said.alias("hash")), algo="sha1")


@BOOK.add(
    "S11_read_refflat",
    """select f.rname, f.start, f."end", f.strand, f.gene_id, f.transcript_id, f.exon_number, cast(t.start+10 as int) cds_start, cast(t."end"-10 as int) cds_end from features f join transcripts t using (transcript_id)""",
    "features", "transcripts",
)
def s11(t):
    rows = F.sort_array(F.collect_list(F.struct("start", "end")))
    tr = t.features.groupBy("gene_id", "transcript_id", "rname", "strand").agg(rows.alias("ex"), F.min("start").alias("lo"), F.max("end").alias("hi"))

    def listed(c):
        return F.concat(F.array_join(F.transform("ex", lambda e: e[c].cast("string")), ","), F.lit(","))

    line = F.concat_ws(
        "\t", "gene_id", "transcript_id", "rname", "strand", "lo", "hi", (F.col("lo") + 10).cast("string"), (F.col("hi") - 10).cast("string"),
        F.size("ex").cast("string"), listed("start"), listed("end"),
    )
    return T.parse_refflat(tr.select(line.alias("value")))


def _summary_lines(t):
    per = t.alignments.groupBy("sample", (F.col("pos") % 3 + 1).alias("step_no")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.expr("mapq < 5")).alias("u"), F.count_if(F.expr("mapq >= 5 and nh = 1")).alias("o"),
        F.count_if(F.expr("mapq >= 5 and nh > 1")).alias("m"),
    )

    def line(no, count, tail, pad):
        text = F.concat(F.lit(" " * pad), F.col(count).cast("string") if count else F.lit(""), F.lit(tail))
        return F.struct(F.lit(no).alias("line_no"), text.alias("value"))

    rows = F.array(
        line(0, "n", " reads; of these:", 0), line(1, "n", " (100.00%) were paired; of these:", 2), line(2, "u", " (9.34%) aligned concordantly 0 times", 4),
        line(3, "o", " (13.41%) aligned concordantly exactly 1 time", 4), line(4, "m", " (77.25%) aligned concordantly >1 times", 4),
        line(5, None, "----", 4), line(6, "n", " (1.00%) aligned discordantly 1 time", 4), line(7, "n", " (2.00%) aligned 0 times", 4),
    )
    return per.select(F.concat_ws("#", "sample", F.col("step_no").cast("string")).alias("file"), F.inline(rows))


@BOOK.add(
    "S12_read_align_summary",
    """select concat(sample,'#',cast(pos%3+1 as varchar)) file, count(*) "input", count(*) filter (where mapq<5) unaligned, count(*) filter (where mapq>=5 and nh=1) unique_hits, count(*) filter (where mapq>=5 and nh>1) multiple_hits from alignments group by 1""",
    "alignments",
)
def s12(t):
    return T.parse_align_summary(_summary_lines(t))


@BOOK.add(
    "Q10_successive_screen_summary",
    _NAMED + """, s as (select sample, pos%3+1 step_no, count(*) filter (where mapq<5) unaligned, count(*) filter (where mapq>=5 and nh=1) unique_hits, count(*) filter (where mapq>=5 and nh>1) multiple_hits from alignments group by 1,2),
       c as (select sample, case when flag=16 then 'sense' else 'antisense' end sense, cast(sum(n) as bigint) n from tg group by 1,2),
       l as (select sample, step_no, k "key", v "value" from s, lateral (values ('unique_hits',unique_hits),('multiple_hits',multiple_hits),('unaligned',unaligned)) x(k,v) where step_no<>2 and (k<>'unaligned' or step_no=3)
         union all select sample, 2, sense, n from c)
       select sample, cast(step_no as int) step_no, "key", "value", (['genome','rrna','rest'])[step_no] "type" from l""",
    "alignments",
)
def q10(t):
    parsed = T.parse_align_summary(_summary_lines(t))
    steps = parsed.select(
        F.substring_index("file", "#", 1).alias("sample"), F.substring_index("file", "#", -1).cast("int").alias("step_no"), "unique_hits", "multiple_hits", "unaligned"
    )
    comp = Q.strand_composition(_targets(t), library_type="firststranded", detail=False)
    return Q.successive_screen_summary(steps, comp, types=["genome", "rrna", "rest"], rrna_pos=2)


@BOOK.add(
    "K4_write_bedgraph",
    f"""with {BLOCKS}, iv as (select a.sample, a.rname, b.start, b."end" from blocks b join alignments a using (aln_id)) {_RUNS} select sample, rname, start, "end", "value" from runs where "value"<>0""",
    "alignments",
)
def k4(t):
    path = _scratch(t.spark)
    K.write_bedgraph(CV.genome_coverage(t.alignments), path)
    schema = "rname string, start bigint, end bigint, value double, sample string"
    return t.spark.read.schema(schema).option("sep", "\t").csv(path).select("sample", "rname", "start", "end", "value")


@BOOK.add(
    "K5_write_count_matrix",
    """select target_id, coalesce(sum(count) filter (where sample='s0'),0) s0, coalesce(sum(count) filter (where sample='s1'),0) s1, coalesce(sum(count) filter (where sample='s2'),0) s2 from counts group by 1""",
    "counts",
)
def k5(t):
    path = _scratch(t.spark)
    K.write_count_matrix(C.count_matrix(t.counts, SAMPLES), path)
    return t.spark.read.schema("target_id string, s0 double, s1 double, s2 double").option("header", True).csv(path)
