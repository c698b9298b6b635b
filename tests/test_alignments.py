"""Template filters."""

from pyspark.sql import functions as F

from seqloom.operators import alignments as A


def test_snp_filter_computes_its_input_once(spark):
    rows = [("s", "a", 65, "c1", "=", 0), ("s", "a", 129, "c1", "=", 0), ("s", "b", 65, "c1", "c2", 0), ("s", "b", 129, "c2", "c1", 0), ("s", "d", 0, "c1", "*", 0), ("s", "d", 0, "c1", "*", 1)]
    al = spark.createDataFrame(rows, "sample string, qname string, flag int, rname string, rnext string, xi int").withColumn("note", F.sha2("rname", 256))
    out = A.filter_for_snp_calling(al.withColumn("qname", F.concat("qname", F.lit("_"))))
    assert sorted(r["qname"] for r in out.collect()) == ["a_", "a_"]
    assert "concat(" not in out._jdf.queryExecution().optimizedPlan().toString()
