"""Golden split reads, one per class, and the joining rules."""

import pytest

from seqloom.operators import splitreads as S

SCHEMA = (
    "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, xi int, xq int, xx int, nm int, md string,"
    " seq string, qual string"
)


def frag(q, pos, xx, *, flag=64, rname="chr1", cigar="10M", xi=0, xq=0, nm=0, md="10", seq="A" * 10, qual="I" * 10, mapq=30):
    return ("s", q, flag, rname, pos, mapq, cigar, xi, xq, xx, nm, md, seq, qual)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


GOLDEN = [
    ("chromosome", [frag("a", 100, 1), frag("a", 200, 11, rname="chr2")]),
    ("strand", [frag("b", 100, 1), frag("b", 200, 11, flag=80)]),
    ("distance", [frag("c", 100, 1), frag("c", 110 + 200000, 11)]),
    ("overlap", [frag("d", 100, 1), frag("d", 105, 11)]),
    ("circular", [frag("e", 100, 11), frag("e", 200, 1)]),
    ("non_circular", [frag("f", 100, 21), frag("f", 200, 11), frag("f", 300, 1)]),
    (None, [frag("g", 100, 1), frag("g", 200, 11)]),
    (None, [frag("h", 100, 11, flag=80), frag("h", 200, 1, flag=80)]),
    # chr outranks an overlap elsewhere in the read
    ("chromosome", [frag("i", 100, 1), frag("i", 105, 11), frag("i", 300, 21, rname="chr2")]),
]


def test_reason_per_class(spark):
    rows = [r for _, group in GOLDEN for r in group]
    got = {r["qname"]: r["reason"] for r in S.split_mappings(table(spark, rows)).collect()}
    assert got == {group[0][1]: reason for reason, group in GOLDEN}


def test_joined_record(spark):
    rows = [
        frag("r", 100, 1, nm=1, md="5A4", seq="ACGTACGTAC", qual="ABCDEFGHIJ"),
        frag("r", 210, 11, cigar="4M2D6M", nm=2, md="4^GG6", seq="TTTTTGGGGG", qual="0123456789"),
        frag("r", 300, 21, md="0C9"),
    ]
    rec = S.join_split_reads(table(spark, rows)).collect()[0]
    assert (rec["pos"], rec["cigar"]) == (100, "10M100N4M2D6M78N10M")
    assert rec["seq"] == "ACGTACGTACTTTTTGGGGG" + "A" * 10
    assert (rec["nm"], rec["md"], rec["nh"], rec["xs"]) == (3, "5A8^GG6C9", 1, "+")


@pytest.mark.parametrize("a,b,want", [("10", "10", "20"), ("5A", "T5", "5AT5"), ("5A4", "10", "5A14"), ("10", "0C9", "10C9"), ("9C0", "0C9", "9C0C9")])
def test_md_merge(spark, a, b, want):
    rows = [frag("m", 100, 1, md=a), frag("m", 200, 11, md=b)]
    assert S.join_split_reads(table(spark, rows)).collect()[0]["md"] == want


def test_best_mappings_only(spark):
    rows = [frag("n", 100, 1, xi=0, nm=2), frag("n", 200, 11, xi=0), frag("n", 500, 1, xi=1), frag("n", 600, 11, xi=1, nm=1), frag("n", 900, 1, xi=2, nm=1)]
    got = sorted((r["xi"], r["nh"]) for r in S.split_mappings(table(spark, rows)).collect())
    assert got == [(1, 2), (2, 2)]


def test_genome_motif(spark):
    rows = [frag("p", 1, 1), frag("p", 21, 11), frag("q", 1, 1, rname="chr2"), frag("q", 21, 11, rname="chr2")]
    genome = spark.createDataFrame(
        [("chr1", 0, "A" * 10 + "CT"), ("chr1", 12, "TTTTTTACAA"), ("chr2", 0, "A" * 12), ("chr2", 12, "A" * 12)], "rname string, start int, seq string"
    )
    got = {r["qname"]: (r["xs"], r["xs_sure"]) for r in S.join_split_reads(table(spark, rows), genome=genome, chunk=12).collect()}
    assert got == {"p": ("-", True), "q": ("+", False)}


def pe(spark, rows, **opts):
    return {(r["qname"], r["flag"] & 128): r for r in S.join_split_reads_pe(table(spark, rows), library_type="secondstrand", **opts).collect()}


def test_paired_join_sets_mates(spark):
    rows = [frag("a", 100, 1, flag=65), frag("a", 200, 11, flag=65, xq=1), frag("a", 400, 1, flag=145, cigar="8M2S")]
    got = pe(spark, rows)
    one, two = got["a", 0], got["a", 128]
    assert one["cigar"] == "10M90N10M" and one["ys"] == "OK"
    assert one["flag"] == 65 | 2 | 32 and two["flag"] == 145 | 2
    assert (one["tlen"], two["tlen"]) == (308, -308)
    assert (one["rnext"], one["pnext"], two["pnext"], one["mapq"]) == ("=", 400, 100, 50)
    assert (one["xs"], two["xs"]) == ("+", "+")


def test_unjoinable_mapping_is_left_out_but_counts(spark):
    rows = [frag("a", 100, 1, flag=65), frag("a", 105, 11, flag=65, xq=1), frag("a", 500, 1, flag=65, xi=1)]
    got = pe(spark, rows)
    assert len(got) == 1
    r = got["a", 0]
    assert (r["xi"], r["nh"], r["mapq"], r["flag"], r["rnext"]) == (1, 2, 5, 65 | 8 | 256, "*")


def test_far_gap_outranks_overlap(spark):
    rows = [frag("a", 100, 1, flag=65), frag("a", 105, 11, flag=65, xq=1), frag("a", 900000, 21, flag=65, xq=2)]
    m = S.template_mappings(table(spark, rows)).collect()[0]
    assert m["state1"] == "max_dist_breached" and not m["suitable"]


def test_fragments_are_gathered_once(spark):
    rows = table(spark, [frag("p", 100, 1), frag("p", 200, 11), frag("p", 400, 1, flag=128)])
    out = S.join_split_reads_pe(rows, library_type="firststrand")
    assert {r["nh"] for r in out.collect()} == {1}
    assert out._jdf.queryExecution().optimizedPlan().toString().count("collect_list") == 1
    joined = S.join_split_reads(rows)
    assert joined.count() == 2 and "collect_list" not in joined._jdf.queryExecution().optimizedPlan().toString()
