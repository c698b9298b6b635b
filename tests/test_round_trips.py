"""Readers and writers on real files."""

import hashlib

import pytest
from pyspark.sql import functions as F

from seqloom.sources import fastq as FQ, sinks as K, text as T


def put(path, *lines):
    path.write_text("".join(line + "\n" for line in lines))
    return str(path)


def test_sam(spark, tmp_path):
    put(tmp_path / "in.sam", "@HD\tVN:1.6", "r2\t0\tchrB\t9\t30\t4M\t*\t0\t0\tACGT\tIIII\tNM:i:1", "r1\t16\tchrA\t5\t30\t4M\t*\t0\t0\tAC:T\tIIII")
    read = T.read_sam(spark, str(tmp_path / "in.sam"), sample="s")
    K.write_sam(read, str(tmp_path / "out"))
    again = T.read_sam(spark, str(tmp_path / "out" / "sample=s"), sample="s")
    assert sorted(map(str, again.collect())) == sorted(map(str, read.collect())) and again.count() == 2


def test_sam_with_header(spark, tmp_path):
    lines = ["r2\t0\tchrB\t9\t30\t4M\t*\t0\t0\tACGT\tIIII", "r1\t16\tchrA\t5\t30\t4M\t*\t0\t0\tACGT\tIIII", "r3\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI"]
    head = ["@HD\tVN:1.6\tSO:queryname\tGO:none", "@SQ\tSN:chrB\tLN:90", "@SQ\tM5:x\tSN:chrA\tLN:80", "@PG\tID:a\tSN:chrA"]
    path = put(tmp_path / "in.sam", *head, *lines)
    read, header = T.read_sam(spark, path, sample="s"), T.read_sam_header(spark, path, sample="s")
    K.write_sam(read, str(tmp_path / "out"), header=header.unionByName(header.withColumn("file", F.lit("zz"))))
    text = "".join(p.read_text() for p in sorted((tmp_path / "out" / "sample=s").glob("part-*"))).splitlines()
    assert text == ["@HD\tVN:1.6\tSO:coordinate\tGO:none", *head[1:], *lines]
    K.write_sam(read, str(tmp_path / "bare"), header=header.filter("false"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "bare" / "sample=s").glob("part-*"))).splitlines()
    assert text[0] == "@HD\tVN:1.6\tSO:coordinate" and len(text) == 4


def test_gtf(spark, tmp_path):
    line = 'chrA\tx\texon\t11\t20\t.\t+\t.\tgene_id "g"; transcript_id "t"; tag "a"; tag "b"'
    read = T.read_gtf(spark, put(tmp_path / "in.gtf", "#!head", line, line.replace("chrA", "chrB")))
    K.write_gtf(read, str(tmp_path / "out"))
    again = T.read_gtf(spark, str(tmp_path / "out"))
    assert sorted(map(str, again.collect())) == sorted(map(str, read.collect()))
    assert {r["attrs"]["tag"] for r in again.collect()} == {"b"}


def test_bed_counts_sheet_sizes_refflat(spark, tmp_path):
    bed = T.read_bed(spark, put(tmp_path / "a.bed", "track name=x", "chrA\t1\t9\tn\t3.5\t-", "chrB\t2\t4")).collect()
    assert [(r["rname"], r["start"], r["end"], r["strand"]) for r in bed] == [("chrA", 1, 9, "-"), ("chrB", 2, 4, None)]
    counts = T.read_counts(spark, put(tmp_path / "c.tsv", "Name\tLength\tEffectiveLength\tTPM\tNumReads", "t1\t100\t80\t2.5\t7"), tool="salmon", sample="s").collect()
    assert (counts[0]["target_id"], counts[0]["count"], counts[0]["sample"]) == ("t1", 7.0, "s")
    sheet = T.read_sample_sheet(spark, put(tmp_path / "s.csv", "SampleID,Index,Lane", "a,ACG-TTT,1", "b,CCC,2")).collect()
    assert sorted((r["sample"], r["index_r1"], r["index_r2"], r["lane"]) for r in sheet) == [("a", "ACG", "TTT", "1"), ("b", "CCC", None, "2")]
    sizes = T.read_chrom_sizes(spark, put(tmp_path / "z.sizes", "chrA\t1000", "", "chrB\t20")).collect()
    assert sorted(map(tuple, sizes)) == [("chrA", 1000), ("chrB", 20)]
    flat = T.read_refflat(spark, put(tmp_path / "r.txt", "g\tt\tchrA\t+\t10\t90\t20\t80\t2\t10,50,\t30,90,")).collect()
    assert sorted((r["start"], r["end"], r["exon_number"]) for r in flat) == [(10, 30, 1), (50, 90, 2)]


def test_fasta_headers_with_marks_and_carriage_returns(spark, tmp_path):
    (tmp_path / "f.fa").write_bytes(b">s1 A->G variant\r\nAC\r\nGT\r\n>s2\r\nTT\r\n")
    got = {r["name"]: (r["descr"], r["seq"]) for r in T.read_fasta(spark, str(tmp_path / "f.fa")).collect()}
    assert got == {"s1": ("A->G variant", "ACGT"), "s2": (None, "TT")}


def test_file_hashes_are_streamed(spark, tmp_path):
    blob = bytes(range(256)) * 50_000
    (tmp_path / "a.bin").write_bytes(blob)
    (tmp_path / "b.gz").write_bytes(b"not really gzip")
    rows = [(str(tmp_path / "a.bin"), hashlib.sha1(blob).hexdigest().upper()), ("file://" + str(tmp_path / "b.gz"), "0"), (str(tmp_path / "c"), "0")]
    manifest = spark.createDataFrame(rows, "path string, hash string")
    got = {r["path"].rsplit("/", 1)[1]: r["state"] for r in T.verify_files(spark, str(tmp_path / "*"), manifest, algo="sha1").collect()}
    assert got == {"a.bin": "ok", "b.gz": "mismatch", "c": "missing"}
    with pytest.raises(Exception, match="content hash differs"):
        T.verify_files(spark, str(tmp_path / "*"), manifest, algo="sha1", strict=True).collect()


def test_fastq_paths_resolve_like_spark_paths(spark, tmp_path):
    put(tmp_path / "r.fastq", "@a x", "ACGT", "+", "IIII", "@b", "GG", "+", "II")
    for path in (str(tmp_path / "r.fastq"), f"file://{tmp_path}/r.fastq", f"{tmp_path}/*.fastq", str(tmp_path)):
        got = FQ.read_fastq(spark, path, sample="s", mate=1).orderBy("read_idx").select(F.concat_ws(" ", "read_idx", "qname", "seq")).collect()
        assert [r[0] for r in got] == ["0 a ACGT", "1 b GG"]
