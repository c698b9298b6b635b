"""Registered queries against their oracle SQL at the smallest scale.

All of them with SEQLOOM_ALL=1, else one per family.
"""

import os

import pytest

import __spark_entry__ as entry_module
from seqloom.plans.compare import check

SF = "/root/testdata/sf0.001"
FEW = [
    "R14_trim_recipe", "R17_demultiplex", "Q8_screen_library", "A9_strand_composition", "A12_unique_pairs_only", "A14_join_split_reads", "J1_overlap_semi",
    "C1_genome_coverage_zero", "C13_merge_intervals", "X1_feature_counts", "X4_transcripts_to_genes", "G3_transcript_table", "S3_read_sam",
]
NAMES = sorted(entry_module.queries()) if os.environ.get("SEQLOOM_ALL") else FEW

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    message = check(spark, SF, [name], entry_module.queries(), entry_module.oracle_sql())[name]
    assert message.startswith(("ok", "rows")), message


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", ["S1_read_fastq", "K1_write_fastq"])
def test_both_mates_come_back(spark, name):
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert check(spark, SF, [name], queries, oracles)[name].startswith("ok")
    assert {r["mate"] for r in queries[name](spark, SF).select("mate").distinct().collect()} == {1, 2}


def test_all_sequences_are_merged(spark):
    name = "C14_merge_coverage_matrices"
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert check(spark, SF, [name], queries, oracles)[name].startswith("ok")
    labels = {r["label"] for r in queries[name](spark, SF).select("label").distinct().collect()}
    assert len({x.split(":")[1] for x in labels}) > 1 and len({x.split(":")[0] for x in labels}) == 3
