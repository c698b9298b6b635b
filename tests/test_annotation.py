"""Transcripts against brute force."""

import random

from pyspark.sql import functions as F

from seqloom.operators import annotation as A

KEY = ["rname", "strand", "chain_key"]


def exon_rows(rng):
    """Chains of which most share one hub intron; parts of some are transcripts too."""
    rows = []
    for t in range(150):
        inner = sorted(rng.sample(range(3, 40), rng.randrange(0, 5)))
        starts = [0, 1, *inner] if t % 10 else [2, *inner]
        if t % 4 == 0 and len(starts) > 2:
            cut = rng.randrange(len(starts) - 1)
            starts = starts[cut : cut + rng.randrange(1, 4)]
        rows += [("s1" if t % 2 else "s2", "a", 100 * s, 100 * s + 50, "+", f"t{t}") for s in starts]
    return rows


def test_contained_chains_go_whatever_they_share(spark):
    rows = exon_rows(random.Random(3))
    exons = spark.createDataFrame(rows, "sample string, rname string, start int, end int, strand string, transcript_id string")
    reps, _ = A.dedupe_transcripts(exons, ["s1", "s2"], drop_contained=True)
    chains = {}
    for _, _, start, end, _, t in rows:
        chains.setdefault(t, []).append((start, end))
    keys = set()
    for own in chains.values():
        own.sort()
        if len(own) > 1:
            keys.add("," + ",".join(f"{a[1]}-{b[0]}" for a, b in zip(own, own[1:])) + ",")
        else:
            keys.add(f"={own[0][0]}-{own[0][1]}")
    want = {k for k in keys if not (k[0] == "," and any(k != o and k in o for o in keys))}
    assert {r["chain_key"] for r in reps.collect()} == want and len(want) < len(keys)


def test_the_hub_is_the_key_of_its_own_chain_only(spark):
    chains = [("a", "+", f",50-100,{200 + k}-{300 + k},") for k in range(200)] + [("a", "+", ",50-100,")]
    introns = A.listed_introns(spark.createDataFrame(chains, "rname string, strand string, chain_key string"), KEY)
    rare = A.rarest_introns(introns, KEY)
    assert rare.filter("_i = '50-100'").count() == 1 and rare.count() == 201
    met = rare.join(introns.select("rname", "strand", F.col("chain_key").alias("o"), "_i"), ["rname", "strand", "_i"])
    assert met.count() == 401  # linear in the chains


def test_class_codes_come_once_per_transcript(spark):
    exon = "rname string, start int, end int, strand string, transcript_id string"
    reference = spark.createDataFrame([("a", 100 * k, 100 * k + 60, "+", f"r{j}") for j in range(30) for k in (1, 3, 5)], exon)
    query = [("a", 100, 160, "+", "same"), ("a", 300, 360, "+", "same"), ("a", 500, 560, "+", "same"), ("a", 150, 170, "+", "touch"), ("a", 310, 340, "-", "other"), ("a", 200, 240, "+", "inside"), ("b", 1, 9, "+", "far")]
    got = {r["transcript_id"]: r["class_code"] for r in A.class_codes(spark.createDataFrame(query, exon), reference).collect()}
    assert got == {"same": "=", "touch": "e", "other": "x", "inside": "i", "far": "u"}


def test_exon_and_intron_of_one_transcript(spark):
    cols = "transcript_id string, rname string, start int, end int, strand string"
    ref = [("t1", "c", 0, 100, "+"), ("t1", "c", 200, 300, "+"), ("t2", "c", 1000, 1100, "+"), ("t2", "c", 1010, 1020, "+"), ("t2", "c", 1200, 1300, "+")]
    query = {"left": (90, 115), "near": (90, 109), "right": (185, 250), "in": (120, 150), "over": (50, 260), "odd": (1030, 1080), "odd_c": (1205, 1300), "far": (5000, 5010)}
    q = spark.createDataFrame([(n, "c", s, e, "+") for n, (s, e) in query.items()], cols)
    out = A.class_codes(q, spark.createDataFrame(ref, cols), run_on=5)
    got = {r["transcript_id"]: r["class_code"] for r in out.collect()}
    assert got == {"left": "e", "near": "o", "right": "e", "in": "i", "over": "e", "odd": "c", "odd_c": "c", "far": "u"}
    # One row per query and code: crowds of equal exons form no pairs.
    crowd = spark.range(60_000).selectExpr("concat('r', id) transcript_id", "'c' rname", "cast(0 as int) start", "cast(100 as int) end", "'+' strand")
    assert A.class_codes(crowd, crowd).filter("class_code = 'c'").count() == 60_000


def test_genome_is_not_sent_whole(spark):
    exons = spark.createDataFrame([("c", 2, 10, "+", "t"), ("c", 13, 15, "+", "t"), ("c", 2, 4, "-", "u")], "rname string, start int, end int, strand string, transcript_id string")
    genome = spark.createDataFrame([("c", 0, "ACGTACGT"), ("c", 8, "TTGGCCAA")], "rname string, start int, seq string")
    out = A.extract_transcripts(exons, genome, chunk=8)
    assert {r["transcript_id"]: r["seq"] for r in out.collect()} == {"t": "GTACGTTTCA", "u": "AC"}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
