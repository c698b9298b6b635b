"""Staged tables: what they leave on disk."""

import os

import pytest
from pyspark.sql import functions as F

from seqloom.functions import staging
from seqloom.operators import alignments as A, splitreads as S

MATES = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, xi int, nh int"
FRAGMENTS = (
    "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, xi int, xq int, xx int, nm int, md string,"
    " seq string, qual string"
)


@pytest.fixture
def shared(tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "shared_folder", lambda spark: str(tmp_path))
    return tmp_path


def shuffles(spark):
    return set(spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses()).keySet())


def test_shuffles_go_once_a_table_is_staged(spark, shared):
    before = shuffles(spark)
    out = staging.stage_table(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count())
    assert not shuffles(spark) - before
    assert out.count() == 7 and staging.stage_table(out) is out
    staging.discard(out)
    assert not os.listdir(shared)


def _mate(q, flag, pos, xi, rname="c1"):
    return ("s", q, flag, rname, pos, 30, "10M", "*", 0, xi, 0)


def test_snp_filter_keeps_one_table(spark, shared):
    rows = [_mate("a", 321, 10, 0), _mate("a", 401, 60, 0), _mate("b", 321, 10, 0), _mate("b", 401, 60, 0, "c2"), _mate("c", 321, 10, 0), _mate("c", 321, 50, 1)]
    fixed = A.fix_mates(spark.createDataFrame(rows, MATES))
    out = A.filter_for_snp_calling(fixed)
    assert sorted((r["qname"], r["flag"], r["rnext"], r["pnext"], r["nh"]) for r in out.collect()) == [("a", 97, "=", 60, 1), ("a", 145, "=", 10, 1)]
    assert fixed.count() == 6 and len(os.listdir(shared)) == 1


def test_mappings_without_a_number_count_but_go(spark, shared):
    rows = [_mate("a", 321, 10, 0), _mate("a", 321, 50, None), _mate(None, 321, 10, 0)]
    assert [(r["qname"], r["xi"], r["nh"]) for r in A.fix_mates(spark.createDataFrame(rows, MATES)).collect()] == [("a", 0, 2)]


def _frag(q, pos, xx, xi=0, flag=65):
    return ("s", q, flag, "chr1", pos, 30, "10M", xi, 0, xx, 0, "10", "A" * 10, "I" * 10)


def test_records_of_mates_are_shuffled_once(spark, shared):
    rows = [_frag("p", 1, 1), _frag("p", 21, 11), _frag("p", 60, 1, flag=129), _frag("q", 1, 1, None), _frag("q", 21, 11, None), _frag("q", 60, 1, 2), _frag(None, 1, 1)]
    genome = spark.createDataFrame([("chr1", 0, "A" * 10 + "CT"), ("chr1", 12, "TTTTTTACAA")], "rname string, start int, seq string")
    out = S.join_split_reads_pe(spark.createDataFrame(rows, FRAGMENTS), genome=genome, chunk=12)
    got = {(r["qname"], r["xi"], r["flag"] & 128): (r["cigar"], r["xs"], r["nh"]) for r in out.collect()}
    # A mapping without a number counts, but has no strand.
    assert got == {("p", 0, 0): ("10M10N10M", "-", 1), ("p", 0, 128): ("10M", None, 1), ("q", None, 0): ("10M10N10M", None, 2), ("q", 2, 0): ("10M", None, 2)}
    joins = [line for line in out._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in line]
    assert not [line for line in joins if "mate#" in line]
    (table,) = shared.iterdir()
    assert "seq" not in spark.read.parquet(str(table)).schema["frags"].dataType.simpleString()
