"""Text formats: golden lines, round trips, byte ranges."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from seqloom.functions import cigar as CG
from seqloom.operators import annotation as AN, counts as CN, coverage as CV
from seqloom.sources import fastq as FQ, sinks as K, text as T


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


@pytest.mark.parametrize("split", [64, 100, 333, 1 << 20])
def test_fastq_ranges_keep_every_record(spark, tmp_path, split):
    rng = random.Random(split)
    recs = []
    for i in range(60):
        n = rng.randrange(0, 30)
        qual = "".join(rng.choice("@+I#") for _ in range(n))
        recs.append((f"r{i}", "".join(rng.choice("ACGT") for _ in range(n)), qual))
    path = tmp_path / "a.fastq"
    path.write_text("".join(f"@{n} d{i}\n{s}\n+\n{q}\n" for i, (n, s, q) in enumerate(recs)))
    got = FQ.read_fastq(spark, str(path), sample="x", mate=1, split_bytes=split).orderBy("read_idx").collect()
    assert [(r["qname"], r["seq"], r["qual"]) for r in got] == recs
    assert [r["read_idx"] for r in got] == list(range(60))


def test_fastq_gzip_and_truncation(spark, tmp_path):
    good, bad = tmp_path / "g.fastq.gz", tmp_path / "b.fastq"
    with gzip.open(good, "wt") as f:
        f.write("@a 1\nAC\n+\nII\n@b\nG\n+\nI\n")
    assert FQ.read_fastq(spark, str(good), sample="x", mate=2).count() == 2
    bad.write_text("@a\nAC\n+\nII\n@b\nG\n")
    with pytest.raises(Exception, match="not complete"):
        FQ.read_fastq(spark, str(bad), sample="x", mate=1).collect()


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a", "first A->G one", "ACGT" * 40), ("b", None, "G")], "name string, descr string, seq string")
    K.write_fasta(df, str(tmp_path / "f"), width=10)
    got = {r["name"]: (r["descr"], r["seq"], r["length"]) for r in T.read_fasta(spark, str(tmp_path / "f")).collect()}
    assert got == {"a": ("first A->G one", "ACGT" * 40, 160), "b": (None, "G", 1)}


def test_sam_tags_keep_colons_and_sort(spark):
    line = "r1\t99\tchr1\t5\t30\t4M\t=\t9\t8\tACGT\tIIII\tXZ:Z:a:b:c\tNM:i:0"
    df = T.parse_sam(lines(spark, "@HD\tVN:1.6", line))
    row = df.collect()[0]
    assert row["tags"]["XZ"]["value"] == "a:b:c" and row["pos"] == 5
    out = K.sam_lines(df.withColumn("sample", F.lit("s"))).collect()[0]["value"]
    assert out.split("\t")[11:] == ["NM:i:0", "XZ:Z:a:b:c"]


def test_gtf_golden_line_and_missing_id(spark):
    line = 'chrQ\tassembler\texon\t101\t250\t.\t-\t.\tgene_id "geneA"; transcript_id "txA.1"; exon_number "2"; tag "basic"; note "first"; tag "last one";'
    r = T.parse_gtf(lines(spark, "# c", line)).collect()[0]
    assert (r["start"], r["end"], r["gene_id"], r["exon_number"], r["attrs"]["note"]) == (100, 250, "geneA", 2, "first")
    assert r["attrs"]["tag"] == "last one"
    with pytest.raises(Exception, match="missing"):
        T.parse_gtf(lines(spark, line.replace("transcript_id", "other_id"))).collect()


def test_align_summary_single_and_paired(spark, tmp_path):
    single = "1000 reads; of these:\n  1000 (100.00%) were unpaired; of these:\n    120 (12.00%) aligned 0 times\n    580 (58.00%) aligned exactly 1 time\n    300 (30.00%) aligned >1 times\n88.00% overall alignment rate\n"
    (tmp_path / "one.txt").write_text(single)
    r = T.read_align_summary(spark, str(tmp_path / "one.txt")).collect()[0]
    assert (r["input"], r["unaligned"], r["unique_hits"], r["multiple_hits"]) == (1000, 120, 580, 300)


def test_sample_sheet_errors(spark):
    sheet = spark.createDataFrame([("a", "ACG-TTT", "1"), ("b", "ACG", "2")], "SampleID string, Index string, Lane string")
    got = {r["sample"]: (r["index_r1"], r["index_r2"]) for r in T.sample_sheet(sheet).collect()}
    assert got == {"a": ("ACG", "TTT"), "b": ("ACG", None)}
    for bad in ([("a", "A-C-G", "1")], [("a", "A", "1"), ("a", "C", "1")]):
        with pytest.raises(Exception, match="exactly one index"):
            T.sample_sheet(spark.createDataFrame(bad, sheet.schema)).collect()


def test_discover_samples(spark):
    files = spark.createDataFrame([("/x/S1_L001_R1_001.fastq.gz",), ("/x/S1_L001_R2_001.fastq.gz",)], "path string")
    pattern = r"(\w*)_L\d{3}_R[12]_00\d\.fastq\.gz"
    got = sorted((r["sample"], r["mate"]) for r in T.discover_samples(files, pattern=pattern, prefix="p").collect())
    assert got == [("p_S1", 1), ("p_S1", 2)]
    with pytest.raises(Exception, match="does not match"):
        T.discover_samples(spark.createDataFrame([("/x/odd_R1.txt",)], "path string"), pattern=pattern).collect()


@pytest.mark.parametrize(
    "text,ref,query,gap,blocks,flat",
    [
        ("*", 0, 0, 0, [], "*"), ("10M", 10, 10, 0, [(4, 14)], "10M"), ("5=1X4M2I3=", 13, 15, 0, [(4, 17)], "10M2I3M"),
        ("20M500N30M", 550, 50, 500, [(4, 24), (524, 554)], "20M500N30M"), ("3S5M10N2D4M1I6M2H", 27, 19, 10, [(4, 9), (19, 31)], "3S5M10N2D4M1I6M2H"),
    ],
)
def test_cigar(spark, text, ref, query, gap, blocks, flat):
    df = spark.createDataFrame([(5, text)], "pos int, cigar string")
    r = df.select(CG.ref_len().alias("r"), CG.query_len().alias("q"), CG.max_gap().alias("g"), CG.blocks().alias("b"), CG.collapse().alias("c")).collect()[0]
    assert (r["r"], r["q"], r["g"], [tuple(b) for b in r["b"]], r["c"]) == (ref, query, gap, blocks, flat)


def test_unmapped_transcript_fails(spark):
    counts = spark.createDataFrame([("s", "t1", 1.0), ("s", "t9", 2.0)], "sample string, target_id string, count double")
    t2g = spark.createDataFrame([("t1", "g1")], "target_id string, gene_id string")
    with pytest.raises(Exception, match="t9"):
        CN.transcripts_to_genes(counts, t2g).collect()


def test_padding_of_shorter_matrix(spark):
    a = spark.createDataFrame([(0, 5), (1, 6), (2, 7)], "bin_id bigint, n bigint")
    b = spark.createDataFrame([(0, 1)], "bin_id bigint, n bigint")
    got = sorted((r["label"], r["bin_id"], r["n"]) for r in CV.merge_coverage_matrices({"a": a, "b": b}).collect())
    assert got == [("a", 0, 5), ("a", 1, 6), ("a", 2, 7), ("b", 0, 1), ("b", 1, 0), ("b", 2, 0)]


def test_gene_name_missing_never_matches(spark):
    df = spark.createDataFrame([("ENSG1", "u", "+"), (None, "u", "+"), ("abc", "=", ".")], "gene_name string, class_code string, strand string")
    assert AN.filter_gtf(df, remove_gencode=True).count() == 2
    assert AN.filter_gtf(df, class_and_name=(["u"], "ENS")).count() == 2
    assert AN.filter_gtf(df, remove_unstranded=True).count() == 2


def test_sam_tags_are_built_once(spark):
    df = T.parse_sam(lines(spark, "@HD\tVN:1.6", "r1\t99\tchr1\t5\t30\t4M\t=\t9\t8\tACGT\tIIII\tXZ:Z:a:b:c\tNM:i:0"))
    out = df.select("pos", F.col("tags")["NM"]["value"].alias("nm"), F.size("tags").alias("n"))
    assert [tuple(r) for r in out.collect()] == [(5, "0", 2)]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries") == 1 and plan.count("split(value") == 1
