"""Coverage along transcripts against a count base by base."""

import math
import random
from collections import defaultdict
from statistics import median

from seqloom.operators import counting as X


def _tables(spark):
    rng = random.Random(5)
    exons = []
    for t in range(25):
        at = rng.randrange(3000)
        for _ in range(rng.randrange(1, 5)):
            at += rng.randrange(1, 200)
            end = at + rng.randrange(20, 300)
            exons.append((rng.choice(["c1", "c2"]) if t == 24 else f"c{t % 2 + 1}", at, end, "+-"[t % 3 == 0], f"t{t}"))
            at = end
    exons += exons[:2]
    runs = []
    for s in ("a", "b"):
        for c in ("c1", "c2"):
            at = 0
            while at < 3500:
                start = at + rng.choice([0, 0, 40])
                at = start + rng.randrange(1, 60)
                runs.append((s, c, start, at, float(rng.randrange(1, 9))))
    return (
        spark.createDataFrame(runs, "sample string, rname string, start int, end int, value double"),
        spark.createDataFrame(exons, "rname string, start int, end int, strand string, transcript_id string"),
    )


def test_coverage_along_transcripts_base_by_base(spark):
    runs, exons = _tables(spark)
    depth = {(r["sample"], r["rname"], p): r["value"] for r in runs.collect() for p in range(r["start"], r["end"])}
    body, bias = defaultdict(float), defaultdict(list)
    per = defaultdict(list)
    placed = X.exon_offsets(exons).collect()
    for e in placed:
        per[e["transcript_id"]].append(e)
    for parts in per.values():
        length = parts[0]["length"]
        for s in ("a", "b"):
            total = square = head = tail = 0.0
            seen = False
            for e in parts:
                for p in range(e["start"], e["end"]):
                    if (s, e["rname"], p) not in depth:
                        continue
                    seen, v = True, depth[s, e["rname"], p]
                    at = e["offset"] + (p - e["start"] if e["strand"] == "+" else e["end"] - 1 - p)
                    if length >= 100:
                        body[s, at * 100 // length] += v
                    total, square = total + v, square + v * v
                    head, tail = head + v * (at < 50), tail + v * (at >= length - 50)
            if seen and length >= 150:
                mean = total / length
                bias[s].append((mean, math.sqrt(square / length - mean * mean) / mean, head / 50 / mean, tail / 50 / mean))
    got = X.gene_body_coverage(runs, exons)
    assert {(r["sample"], r["percentile"]): r["coverage"] for r in got.collect()} == dict(body)
    for r in X.transcript_bias(runs, exons, min_len=150, edge=50).collect():
        rows = bias[r["sample"]]
        assert r["transcripts"] == len(rows)
        names = ["median_coverage", "median_cv", "median_5prime_bias", "median_3prime_bias"]
        for name, values in zip(names, zip(*rows)):
            assert math.isclose(r[name], median(values), rel_tol=1e-9)


def test_no_pairs_of_runs_and_exons(spark):
    runs, exons = _tables(spark)
    for out in (X.gene_body_coverage(runs, exons), X.transcript_bias(runs, exons)):
        assert "_bin" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_points_from_exploded_rows_are_not_broadcast(spark, tmp_path):
    runs, exons = _tables(spark)
    # From a file, whose size is all that Spark knows of the rows exploded from it.
    exons.coalesce(1).write.parquet(str(tmp_path / "exons"))
    few = spark.read.parquet(str(tmp_path / "exons"))
    for f in (X.gene_body_coverage, X.transcript_bias):
        plan = f(runs, few)._jdf.queryExecution().sparkPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line and "pos#" in line]
        assert joins and not [line for line in joins if "Broadcast" in line]
    assert sorted(X.gene_body_coverage(runs, few).collect()) == sorted(X.gene_body_coverage(runs, exons).collect())
