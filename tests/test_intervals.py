"""Range joins, runs and peaks against brute force."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from seqloom.functions.stats import exact_medians, log_poisson_tail
from seqloom.operators import alignments as AL, counting as X, coverage as C, duplicates as D, intervals as I, peaks as P, signal as S


def intervals(spark, rng, n, span=3000, longest=400):
    rows = []
    for i in range(n):
        s = rng.randrange(span)
        rows.append((i, rng.choice(["a", "b"]), s, s + rng.randrange(1, longest), rng.choice("+-")))
    return spark.createDataFrame(rows, "id int, rname string, start int, end int, strand string"), rows


@pytest.mark.parametrize("min_overlap,bin_size,salt", [(1, 64, 1), (25, 128, 3), (-40, 100, 1), (0, 64, 2)])
def test_overlap_join_is_brute_force(spark, min_overlap, bin_size, salt):
    rng = random.Random(min_overlap)
    a, ra = intervals(spark, rng, 80)
    b, rb = intervals(spark, rng, 60)
    got = I.overlap_join(a, b, min_overlap=min_overlap, bin_size=bin_size, salt=salt).select("id", "r_id").collect()
    want = {(x[0], y[0]) for x in ra for y in rb if x[1] == y[1] and min(x[3], y[3]) - max(x[2], y[2]) >= min_overlap}
    assert len(got) == len(set(map(tuple, got))) and {tuple(r) for r in got} == want
    hit = {x for x, _ in want}
    semi = I.overlap_join(a, b, how="semi", key=["id"], min_overlap=min_overlap, bin_size=bin_size)
    anti = I.overlap_join(a, b, how="anti", key=["id"], min_overlap=min_overlap, bin_size=bin_size)
    assert {r["id"] for r in semi.collect()} == hit and {r["id"] for r in anti.collect()} == {r[0] for r in ra} - hit


@pytest.mark.parametrize("hot_rows", [1, 7, 1000])
def test_hot_bins_are_split_and_rows_stay_equal(spark, hot_rows):
    rng = random.Random(hot_rows)
    a, _ = intervals(spark, rng, 60)
    crowd = [(1000 + i, "a", 5, 9, "+") for i in range(90)]
    a = a.unionByName(spark.createDataFrame(crowd, a.schema)).unionByName(spark.createDataFrame([(1, None, 5, 9, "+")], a.schema))
    b, _ = intervals(spark, rng, 50)
    plain = sorted((r["id"], r["r_id"]) for r in I.overlap_join(a, b, bin_size=64).collect())
    split = I.overlap_join(a, b, bin_size=64, hot_rows=hot_rows)
    assert sorted((r["id"], r["r_id"]) for r in split.collect()) == plain and "_part" not in split.columns
    binned = a.withColumn("_bin", I.bin_of(F.col("start"), 64))
    left, right = I._split_hot(binned, binned.select("rname", "_bin").distinct(), ["rname", "_bin"], a.columns, 7)
    in_parts = {r["_part"]: r["count"] for r in left.filter("rname = 'a' and _bin = 0").groupBy("_part").count().collect()}
    assert len(in_parts) > 8 and max(in_parts.values()) < 30
    assert right.filter("rname = 'a' and _bin = 0").count() >= len(in_parts)


@pytest.mark.parametrize("gap", [0, 30])
def test_merge_intervals_over_tiles(spark, gap):
    df, rows = intervals(spark, random.Random(9), 60, span=9000, longest=90)
    got = sorted((r["rname"], r["start"], r["end"], r["n"]) for r in I.merge_intervals(df, gap=gap, tile=128).collect())
    want = []
    for name in ("a", "b"):
        cur = None
        for _, _, s, e, _ in sorted((r for r in rows if r[1] == name), key=lambda r: r[2]):
            if cur is None or s > cur[2] + gap:
                cur = [name, s, e, 1]
                want.append(cur)
            else:
                cur[2], cur[3] = max(cur[2], e), cur[3] + 1
    assert got == sorted(map(tuple, want))


def test_depth_runs_per_base(spark):
    df, rows = intervals(spark, random.Random(4), 70)
    runs = C.depth_runs(df, by=["rname"], tile=64).collect()
    depth = {n: np.zeros(4000, int) for n in "ab"}
    for _, n, s, e, _ in rows:
        depth[n][s:e] += 1
    made = {n: np.zeros(4000, int) for n in "ab"}
    for r in runs:
        made[r["rname"]][r["start"] : r["end"]] = r["depth"]
    assert all((depth[n] == made[n]).all() for n in "ab")
    assert sum((r["end"] - r["start"]) * r["depth"] for r in runs) == sum(e - s for _, _, s, e, _ in rows)


def test_order_does_not_matter(spark):
    df, _ = intervals(spark, random.Random(8), 50)
    a = I.merge_intervals(df).collect()
    b = I.merge_intervals(df.orderBy(F.rand(3)).repartition(5)).collect()
    assert sorted(a) == sorted(b)


AL_SCHEMA = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, nh int, nm int, seq string, qual string"


def aln(q, flag, pos, cigar="10M", rname="chr1", mapq=30, rnext="*", pnext=0, tlen=0, nh=1, qual="I" * 10):
    return ("s", q, flag, rname, pos, mapq, cigar, rnext, pnext, tlen, nh, 0, "A" * 10, qual)


def test_htseq_modes(spark):
    # g1 covers 0-20, g2 covers 15-40: one read inside g1, one over the seam, one half outside.
    feats = spark.createDataFrame([("chr1", 0, 20, "+", "g1"), ("chr1", 15, 40, "+", "g2")], "rname string, start int, end int, strand string, gene_id string")
    al = spark.createDataFrame([aln("in", 0, 3), aln("seam", 0, 11), aln("half", 0, 36), aln("far", 0, 900)], AL_SCHEMA)

    def run(mode):
        out = X.htseq_count(al, feats, samples=["s"], mode=mode).filter("n > 0").collect()
        return {r["gene"]: r["n"] for r in out}

    assert run("union") == {"g1": 1, "g2": 1, "__ambiguous": 1, "__no_feature": 1}
    assert run("intersection-strict") == {"g1": 2, "__no_feature": 2}
    assert run("intersection-nonempty") == {"g1": 2, "g2": 1, "__no_feature": 1}


def test_feature_counts_ambiguity(spark):
    feats = spark.createDataFrame([("chr1", 0, 20, "+", "g1"), ("chr1", 15, 40, "+", "g2")], "rname string, start int, end int, strand string, gene_id string")
    al = spark.createDataFrame([aln("x", 0, 3), aln("y", 0, 12), aln("z", 0, 12, nh=2)], AL_SCHEMA)
    count = lambda **o: {r["target"]: r["n"] for r in X.feature_counts(al, feats, samples=["s"], **o).collect()}
    assert count() == {"g1": 1, "g2": 0}
    assert count(multi_overlap=True) == {"g1": 2, "g2": 1}
    assert count(multi=True, min_overlap=7) == {"g1": 3, "g2": 0}
    assert count(aliases={"chr1": "other"}) == {"g1": 0, "g2": 0}


def test_hot_duplicate_set(spark):
    rows = [aln(f"r{i:03d}", 0, 100, qual=chr(60 + i % 7) * 10) for i in range(200)] + [aln("z", 0, 500)]
    out = D.mark_duplicates(spark.createDataFrame(rows, AL_SCHEMA), tag_sets=True).collect()
    kept = [r["qname"] for r in out if not r["flag"] & 1024]
    assert sorted(kept) == ["r006", "z"]
    assert {r["ds"] for r in out if r["qname"] != "z"} == {200}


def test_pair_repair(spark):
    rows = [aln("a", 1 | 64 | 256, 10), aln("a", 1 | 128 | 16 | 256, 60)]
    df = spark.createDataFrame(rows, AL_SCHEMA).withColumn("xi", F.lit(0))
    got = {r["pos"]: r for r in AL.fix_mates(df).collect()}
    assert got[10]["flag"] == 1 | 64 | 32 and got[60]["flag"] == 1 | 128 | 16
    assert (got[10]["rnext"], got[10]["pnext"], got[10]["nh"]) == ("=", 60, 1)
    mixed = spark.createDataFrame(rows + [aln("a", 65, 99)], AL_SCHEMA).withColumn("xi", F.when(F.col("pos") == 99, 1).otherwise(0))
    with pytest.raises(Exception, match="mixed"):
        AL.fix_mates(mixed).collect()


def test_unique_pairs(spark):
    rows = [aln("one", 65, 1), aln("two", 65, 1), aln("two", 129, 9), aln("odd", 65, 1), aln("odd", 65, 2), aln("many", 65, 1), aln("many", 129, 2), aln("many", 65, 3), aln("one", 65 | 256, 5)]
    al = spark.createDataFrame(rows, AL_SCHEMA)
    got = sorted((r["qname"], r["flag"]) for r in AL.unique_pairs_only(al).collect())
    assert got == [("one", 65 | 8), ("two", 65), ("two", 129)]
    rep = AL.unique_pairs_report(al).collect()[0]
    assert (rep["rcount"], rep["wcount"], rep["discard_gt_2"], rep["discard_40_80"]) == (9, 3, 1, 1)


def test_poisson_tail():
    for lam in (0.3, 4.0, 60.0, 900.0):
        for k in (1, 3, 10, 70, 1000):
            head = sum(math.exp(i * math.log(lam) - lam - math.lgamma(i + 1)) for i in range(k))
            got = math.exp(log_poisson_tail(np.array([k]), np.array([lam]))[0])
            assert got == pytest.approx(1 - head, rel=1e-6, abs=1e-12)


def test_peak_is_found_where_planted(spark):
    rng = random.Random(1)
    rows = [("s", "chr1", p, p + 36, f"b{i}", rng.choice("+-")) for i, p in enumerate(rng.randrange(200000) for _ in range(1000))]
    rows += [("s", "chr1", p, p + 36, f"p{i}", "+") for i, p in enumerate(rng.randrange(50000, 50100) for _ in range(80))]
    tags = spark.createDataFrame(rows, "sample string, rname string, start int, end int, name string, strand string")
    peaks = P.call_peaks(tags, gsize=200000.0, ext=150, p=1e-5).collect()
    assert len(peaks) == 1 and 49950 < peaks[0]["summit"] < 50300 and peaks[0]["fold"] > 3
    q = P.call_peaks(tags, gsize=200000.0, ext=150).collect()
    assert any(r["start"] <= peaks[0]["summit"] < r["end"] for r in q)


def test_fingerprint_sample_is_exact(spark):
    bins = spark.range(500).select(F.lit("s").alias("sample"), F.lit("c").alias("rname"), F.col("id").alias("bin"), (F.col("id") % 7).alias("n"))
    got = S.fingerprint(bins, n_bins=123).agg(F.sum("bins")).first()[0]
    assert got == 123


def test_truncated_rate_settles(spark):
    means = [1.0, 1.0001, 1.001, 1.01, 1.5, 2.0, 10.0, 100.0]
    for r in spark.createDataFrame([(m,) for m in means], "m double").select("m", P.truncated_rate(F.col("m")).alias("lam")).collect():
        lo, hi = 0.0, r["m"]
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (lo, mid) if mid + r["m"] * math.expm1(-mid) > 0 else (mid, hi)
        assert abs(r["lam"] - (lo if r["m"] > 1 else 0.0)) < 1e-9


def test_overlap_join_by_sample(spark):
    rows = [(s, "c", 10 * i, 10 * i + 15) for s in ("a", "b") for i in range(4)]
    df = spark.createDataFrame(rows, "sample string, rname string, start int, end int")
    got = I.overlap_join(df, df, by=["sample"])
    want = [(x, y) for x in rows for y in rows if x[0] == y[0] and x[2] < y[3] and y[2] < x[3]]
    assert got.count() == len(want) and "r_sample" not in got.columns
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "sample" in text.split("Join")[1].split("]")[0]


def test_split_peaks_within_samples_and_without_controls(spark):
    schema = "sample string, rname string, start int, end int"
    peaks = spark.createDataFrame([("a", "c", 0, 100), ("b", "c", 0, 100)], schema)
    chip = spark.createDataFrame([("a", "c", 1, 5)] * 4 + [("b", "c", 200, 205)], schema)
    got = {r["sample"]: (r["chip"], r["input"], r["ratio"]) for r in P.split_peaks(peaks, chip, chip.filter("false")).collect()}
    assert got == {"a": (4, 0, 5.0), "b": (0, 0, 1.0)}


def test_join_small_agrees_on_both_branches(spark):
    from seqloom.functions.joins import join_small

    big = spark.range(1000).selectExpr("id", "id % 7 sample")
    small = spark.range(5).selectExpr("id sample", "id * 10 v")
    for how in ("inner", "left"):
        few = join_small(big, small, "sample", how)
        many = join_small(big, small, "sample", how, limit=2)
        assert sorted(map(str, few.collect())) == sorted(map(str, many.collect()))
    plan = join_small(big, small, "sample")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_negative_overlap_and_first_reason(spark):
    al = spark.createDataFrame(
        [("s", "r1", 0, "c", 1, 60, "10M", "*", 0, 0, 1), ("s", "r2", 65, "c", 31, 3, "10M", "=", 41, 20, 2), ("s", "r2", 129, "c", 41, 60, "10M", "=", 31, -20, 2)],
        "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, nh int",
    )
    genes = spark.createDataFrame([("c", 14, 20, "+", "g")], "rname string, start int, end int, strand string, gene_id string")
    count = lambda **o: X.feature_counts(al.filter("qname = 'r1'"), genes, samples=["s"], **o).first()["n"]
    assert (count(), count(min_overlap=-3), count(min_overlap=-4)) == (0, 0, 1)
    units, _, _ = X.assign_units(al, genes, fragments=True, min_mapq=10)
    assert {r["why"]: r["n"] for r in units.collect()} == {None: 1, "Unassigned_MappingQuality": 1}


def template_rows(rng):
    """(name, hit, flag, rname, pos, cigar, mapq, nh): pairs, lone mates, unpaired reads, crowds under one name."""
    rows = []
    for i in range(120):
        name = f"r{i}" if i % 5 else "crowd"
        pos = rng.choice([1, 40, 41, 90, 150, 260, 300])
        gap = rng.choice([0, 0, 10, 60, 200])
        first = 65 + rng.choice([0, 16]) + (256 if i % 23 == 0 else 0)
        mates = [(first, pos), (first + 64 ^ 16 if i % 3 else first + 64, pos + gap)][: rng.choice([1, 2, 2, 2])]
        if i % 11 == 0:
            mates = [(rng.choice([0, 16]), pos)]
        for flag, at in mates:
            flag |= 4 if rng.random() < 0.05 else 0
            rows.append((name, i % 2, flag, rng.choice("ab") if i % 7 == 0 else "a", at, rng.choice(["50M", "20M30N10M", "5S30M"]), rng.choice([60, 60, 60, 3]), rng.choice([1, 1, 1, 1, 2])))
    return rows * 2


def cigar_bases(pos, cigar):
    out, at = [], pos - 1
    for n, op in re.findall(r"(\d+)([A-Z])", cigar):
        if op == "M":
            out += range(at, at + int(n))
        at += int(n) if op in "MN" else 0
    return out


def counted_templates(rows, genes, mode, stranded, hits):
    groups = {}
    for k, (name, hit, flag, *rest) in enumerate(rows):
        if not flag & 256:
            key = (name, hit if hits else 0) if flag & 1 else (k,)
            groups.setdefault(key, []).append((flag, *rest))
    out = {}
    for records in groups.values():
        placed = [r for r in records if not r[0] & 4]
        if not placed:
            label = "__not_aligned"
        elif any(r[5] > 1 for r in placed):
            label = "__alignment_not_unique"
        elif any(r[4] < 10 for r in placed):
            label = "__too_low_aQual"
        else:
            sets = []
            for flag, rname, pos, cigar, *_ in placed:
                strand = "-" if flag & 16 else "+"
                if flag & 129 == 129:
                    strand = "+" if strand == "-" else "-"
                on = {"yes": strand, "reverse": "+" if strand == "-" else "-"}.get(stranded)
                sets += [{g for g, n, s, e, st in genes if n == rname and s <= p < e and on in (None, st)} for p in cigar_bases(pos, cigar)]
            some = [x for x in sets if x]
            found = set().union(*some) if mode == "union" else set.intersection(*(sets if mode == "intersection-strict" else some)) if some else set()
            label = "__no_feature" if not found else "__ambiguous" if len(found) > 1 else min(found)
        out[label] = out.get(label, 0) + 1
    return out


@pytest.mark.parametrize("mode,stranded,hits", [("union", "no", True), ("intersection-strict", "yes", False), ("intersection-nonempty", "reverse", True), ("union", "yes", False)])
def test_htseq_counts_templates(spark, mode, stranded, hits):
    rng = random.Random(len(mode))
    rows = template_rows(rng)
    genes = [("g1", "a", 0, 60, "+"), ("g1", "a", 80, 100, "+"), ("g2", "a", 50, 85, "-"), ("g3", "a", 140, 360, "+"), ("g4", "b", 0, 400, "-")]
    schema = "qname string, hit int, flag int, rname string, pos int, cigar string, mapq int, nh int"
    al = spark.createDataFrame(rows, schema).withColumn("sample", F.lit("s"))
    features = spark.createDataFrame(genes, "gene_id string, rname string, start int, end int, strand string")
    got = X.htseq_count(al if hits else al.drop("hit"), features, samples=["s", "none"], mode=mode, stranded=stranded).collect()
    assert {r["gene"]: r["n"] for r in got if r["sample"] == "s" and r["n"]} == counted_templates(rows, genes, mode, stranded, hits)
    assert all(r["n"] == 0 for r in got if r["sample"] == "none") and len(got) == 2 * 9


def test_fragments_collapse_by_the_pair_of_placements(spark):
    """A locus of many equal pairs reaches the range join as two rows; a template of three records stays whole."""
    pair = lambda name, a, b: [(name, 65, "a", a, "30M", b, "="), (name, 145, "a", b, "30M", a, "=")]
    rows = [r for i in range(500) for r in pair(f"p{i}", 11, 61)] + pair("q", 11, 400) + [("t", 65, "a", 11, "30M", 61, "="), ("t", 129, "a", 61, "30M", 11, "="), ("t", 129, "a", 61, "10M", 11, "=")]
    al = spark.createDataFrame(rows, "qname string, flag int, rname string, pos int, cigar string, pnext int, rnext string")
    al = al.withColumns({"sample": F.lit("s"), "mapq": F.lit(60), "tlen": F.lit(80), "nh": F.lit(1)})
    features = spark.createDataFrame([("g1", "a", 0, 45, "+"), ("g2", "a", 380, 500, "-")], "gene_id string, rname string, start int, end int, strand string")
    units, hits, key = X.assign_units(al, features, fragments=True, min_overlap=1)
    assert sorted(r["n"] for r in units.collect()) == [1, 1, 500]
    assert sorted((r["target"], r["n"], r["bases"]) for r in hits.collect()) == [("g1", 1, 30), ("g1", 1, 30), ("g1", 500, 30), ("g2", 1, 30)]
    counted = {r["target"]: r["n"] for r in X.feature_counts(al, features, samples=["s"], fragments=True).collect()}
    assert counted == {"g1": 501, "g2": 0}


def test_signals_are_compared_by_design(spark):
    rng = random.Random(6)
    rows = [(s, n, b, rng.randrange(6)) for s in "uvw" for n in "xy" for b in range(30) if rng.random() < 0.8]
    bins = spark.createDataFrame(rows, "sample string, rname string, bin bigint, n bigint")
    pairs = [("1", "u", "v"), ("2", "u", "w"), ("3", "w", "u"), ("4", "v", None), ("5", "v", "v")]
    design = spark.createDataFrame(pairs, "run string, treatment string, control string")
    n = {r[:3]: r[3] for r in rows}
    want = {}
    for run, a, b in pairs:
        for _, c, k, _ in rows:
            if (a, c, k) in n or (b, c, k) in n:
                want[run, c, k] = (n.get((a, c, k), 0), n.get((b, c, k), 0))
    values = bins.withColumn("value", F.col("n").cast("double"))
    got = {tuple(r)[:3]: r["value"] for r in S.compare_signal(values, design, op="subtract").collect()}
    assert got == {k: a - b for k, (a, b) in want.items()}
    both = S.compare_signal(values, design, op=["ratio", "add"]).collect()
    assert {(r["op"], r["run"], r["rname"], r["bin"]): r["value"] for r in both} == {
        (o, *k): v for k, (a, b) in want.items() for o, v in (("ratio", (a + 1) / (b + 1)), ("add", a + b))
    }
    factors = {r["run"]: r for r in S.ses_factors(bins, design).collect()}
    for run in "123":
        own = [v for k, v in want.items() if k[0] == run]
        ta, tb = (sum(x) for x in zip(*own, strict=True))
        sums = {c: tuple(sum(v[i] for v in own if v[0] <= c) for i in (0, 1)) for c in {v[0] for v in own}}
        best = min(sums, key=lambda c: (sums[c][0] / ta - sums[c][1] / tb, c))
        assert math.isclose(factors[run]["factor"], sums[factors[run]["cut"]][0] / sums[factors[run]["cut"]][1])
        assert math.isclose(sums[best][0] / ta - sums[best][1] / tb, sums[factors[run]["cut"]][0] / ta - sums[factors[run]["cut"]][1] / tb, abs_tol=1e-12)
    assert factors["4"]["factor"] is None and factors["5"]["factor"] is None  # nothing to scale to, nothing below the cut
    with pytest.raises(ValueError):
        S.compare_signal(values, design, op="ratio", normalized=True)


def test_medians_equal_sorting(spark):
    rng = random.Random(12)
    rows = [("one", 3.5, None), ("two", 1.0, 2.0), ("two", 4.0, 2.0)]
    rows += [("many", rng.choice([0.0, 0.0, rng.random(), rng.random() * 1e6]), float(rng.randrange(4))) for _ in range(501)]
    rows += [("near", 1 + k * 1e-9, -1.0 * k) for k in range(40)] + [("zero", 0.0, 0.0)] * 30
    got = {r["g"]: r for r in exact_medians(spark.createDataFrame(rows, "g string, x double, y double"), "g", ["x", "y"]).collect()}
    for g in {r[0] for r in rows}:
        for i, c in ((1, "x"), (2, "y")):
            own = sorted(r[i] for r in rows if r[0] == g and r[i] is not None)
            assert got[g][c] == ((own[(len(own) - 1) // 2] + own[len(own) // 2]) / 2 if own else None)


def test_tags_of_a_hot_position_are_cut_by_each_samples_limit(spark):
    rows = [(s, "a", 10, 40, "+", f"{s}{i:03}") for s, n in (("s", 300), ("t", 8000)) for i in range(n)] + [("s", "a", 11, 40, "-", "r")]
    tags = spark.createDataFrame(rows, "sample string, rname string, start int, end int, strand string, name string")
    kept = D.keep_dup(tags, k="auto", gsize=2000.0)
    want = {("s", "+"): D.binomial_quantile(301, 1 / 2000, 1e-5), ("t", "+"): D.binomial_quantile(8000, 1 / 2000, 1e-5), ("s", "-"): 1}
    assert {(r["sample"], r["strand"]): r["count"] for r in kept.groupBy("sample", "strand").count().collect()} == want and want["s", "+"] < want["t", "+"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_infer_experiment_keeps_samples_apart(spark):
    rows = [("a", "r1", 1 + 64, "c", 11, 60, "10M"), ("b", "r2", 1 + 64, "c", 11, 60, "10M"), ("b", "r3", 1 + 64, "c", 11, 60, "10M"), ("b", "r4", 1 + 128, "c", 11, 60, "10M")]
    al = spark.createDataFrame(rows, "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string")
    genes = spark.createDataFrame([("c", 0, 100, "+")], "rname string, start int, end int, strand string")
    got = {(r["sample"], r["mate"]): (r["n"], round(r["fraction"], 6)) for r in X.infer_experiment(al, genes).collect()}
    assert got == {("a", 1): (1, 1.0), ("b", 1): (2, 0.666667), ("b", 2): (1, 0.333333)}


@pytest.mark.parametrize("min_overlap,stranded", [(10, "same"), (1, "opposite"), (0, "no")])
def test_totals_equal_the_pairs(spark, min_overlap, stranded):
    rng = random.Random(min_overlap)
    a, ra = intervals(spark, rng, 70)
    b, rb = intervals(spark, rng, 50)
    odd = spark.createDataFrame([(900, None, 1, 5, "+"), (901, "a", None, 5, "+"), (902, "a", 5, 5, "+"), (903, "a", 1, 2000, None)], a.schema)
    ra, rb = ra + [tuple(r) for r in odd.collect()], rb + [tuple(r) for r in odd.collect()]
    a, b = a.unionByName(odd), b.unionByName(odd).withColumn("w", F.col("id") % 3)

    def bases(x, y):
        if None in x[1:4] + y[1:4] or x[1] != y[1]:
            return None
        if stranded != "no" and (None in (x[4], y[4]) or (x[4] == y[4]) != (stranded == "same")):
            return None
        shared = min(x[3], y[3]) - max(x[2], y[2])
        return shared if shared >= min_overlap else None

    got = I.overlap_join(a, b, how="left", key=["id"], min_overlap=min_overlap, stranded=stranded, per="left", weight="w")
    assert "strand" in got.columns and "w" not in got.columns
    want = {x[0]: [(y[0] % 3, bases(x, y)) for y in rb if bases(x, y) is not None] for x in ra}
    assert {r["id"]: (r["n"], r["shared"]) for r in got.collect()} == {i: (sum(w for w, _ in p), sum(w * s for w, s in p)) for i, p in want.items()}
    got = I.overlap_join(a, b, min_overlap=min_overlap, stranded=stranded, per="right")
    want = {y[0]: [bases(x, y) for x in ra if bases(x, y) is not None] for y in rb}
    assert {r["id"]: (r["n"], r["shared"]) for r in got.collect()} == {i: (len(p), sum(p)) for i, p in want.items() if p}
    semi = I.overlap_join(a, b, how="semi", key=["id"], min_overlap=min_overlap, stranded=stranded)
    assert {r["id"] for r in semi.collect()} == {x[0] for x in ra if any(bases(x, y) is not None for y in rb)}


@pytest.mark.parametrize("fraction,stranded", [(0.5, "no"), (1.0, "same")])
def test_semi_and_anti_by_fraction(spark, fraction, stranded):
    rng = random.Random(int(fraction * 10))
    a, ra = intervals(spark, rng, 150, longest=900)
    b, rb = intervals(spark, rng, 40, longest=300)
    ok = {"no": lambda x, y: True, "same": lambda x, y: x == y, "opposite": lambda x, y: x != y}[stranded]
    hit = {
        x[0] for x in ra for y in rb
        if x[1] == y[1] and ok(x[4], y[4]) and min(x[3], y[3]) - max(x[2], y[2]) >= max(1, fraction * (x[3] - x[2]))
    }
    opts = dict(key=["id"], min_fraction=fraction, stranded=stranded, bin_size=128)
    assert 0 < len(hit) < len(ra)
    assert {r["id"] for r in I.overlap_join(a, b, how="semi", **opts).collect()} == hit
    assert {r["id"] for r in I.overlap_join(a, b, how="anti", **opts).collect()} == {x[0] for x in ra} - hit


def test_join_of_a_crowd_forms_no_pairs(spark):
    # 4 x 10^10 pairs share one locus.
    reads = spark.range(200_000).selectExpr("id", "'c' rname", "cast(id % 50 as int) start", "cast(id % 50 + 100 as int) end", "'+' strand")
    left = I.overlap_join(reads, reads, how="left", key=["id"], per="left")
    assert left.filter("n = 200000").count() == 200_000
    assert I.overlap_join(reads, reads, how="semi", key=["id"], min_overlap=90).count() == 200_000
    assert I.overlap_join(reads, reads, how="anti", key=["id"], min_fraction=0.6).count() == 0
    assert I.nearest(reads, reads, max_distance=10, key=["id"]).filter("distance = 0 and r_start = 0").count() == 200_000


@pytest.mark.parametrize("stranded", ["no", "opposite"])
def test_nearest_is_brute_force(spark, stranded):
    rng = random.Random(5)
    a, ra = intervals(spark, rng, 80, span=9000, longest=60)
    b, rb = intervals(spark, rng, 60, span=9000, longest=60)
    ok = {"no": lambda x, y: True, "same": lambda x, y: x == y, "opposite": lambda x, y: x != y}[stranded]
    want = {}
    for x in ra:
        near = [(max(0, max(x[2], y[2]) - min(x[3], y[3])), y[2], y[3], y[0]) for y in rb if x[1] == y[1] and ok(x[4], y[4])]
        near = [n for n in near if n[0] <= 150]
        if near:
            want[x[0]] = min(near)
    got = I.nearest(a, b.drop("strand") if stranded == "no" else b, max_distance=150, key=["id"], stranded=stranded)
    assert {r["id"]: (r["distance"], r["r_start"], r["r_end"], r["r_id"]) for r in got.collect()} == want


def test_region_counts_repeat_and_merge(spark):
    al = spark.createDataFrame(
        [("s", f"r{i}", 0, "c", p, 60, "50M", "*", 0, 0) for i, p in enumerate([1, 1, 101, 190, 400])],
        "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int",
    )
    regions = spark.createDataFrame([("x", "c", 0, 20), ("x", "c", 0, 20), ("x", "c", 120, 130), ("y", "c", 10, 220), ("z", "c", 900, 950)], "name string, rname string, start int, end int")
    plain = {(r["name"], r["start"]): r["n"] for r in C.region_counts(al, regions, samples=["s"]).collect()}
    assert plain == {("x", 0): 4, ("x", 120): 1, ("y", 10): 4, ("z", 900): 0}
    merged = {r["name"]: r["n"] for r in C.region_counts(al, regions, samples=["s"], metagene=True).collect()}
    assert merged == {"x": 3, "y": 4, "z": 0}


@pytest.mark.parametrize("opts", [dict(group="transcript_id", strandness=1), dict(per_feature=True, read_to=5)])
def test_sole_targets_by_sums_equal_the_pairs(spark, monkeypatch, opts):
    rng = random.Random(3)
    reads = [("s", f"r{i // 2}", rng.choice([0, 16, 65, 129]), "c", rng.randrange(1, 900), 60, rng.choice(["30M", "20M60N20M"]), "=", 5, 0, 1) for i in range(120)]
    al = spark.createDataFrame(reads, "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, nh int")
    exons = [("c", s, s + rng.randrange(5, 60), rng.choice("+-"), f"g{i % 9}", f"t{i % 14}") for i, s in enumerate(rng.randrange(1000) for _ in range(25))]
    features = spark.createDataFrame(exons, "rname string, start int, end int, strand string, gene_id string, transcript_id string")
    got = []
    for crowded in (10**9, 0):
        monkeypatch.setattr(X, "CROWDED", crowded)
        rows = [X.feature_counts(al, features, samples=["s"], **opts), X.read_assignments(al, features, **opts)]
        got.append([sorted(map(tuple, r.collect()), key=repr) for r in rows])
    assert got[0] == got[1] and any(r[2] for r in got[0][0])


def test_unpaired_read_and_lone_mate_are_two_templates(spark):
    schema = "sample string, qname string, flag int, rname string, pos int, mapq int, cigar string, nh int"
    al = spark.createDataFrame([("s", "a", 0, "c", 11, 30, "10M", 1), ("s", "b", 73, "c", 11, 30, "10M", 1)], schema)
    genes = spark.createDataFrame([("c", 0, 100, "+", "g")], "rname string, start int, end int, strand string, gene_id string")
    for mode in ("union", "intersection-strict", "intersection-nonempty"):
        out = X.htseq_count(al, genes, samples=["s"], mode=mode)
        assert {r["gene"]: r["n"] for r in out.collect() if r["n"]} == {"g": 2}
        # No CIGAR text and no gene name takes part in the aggregates behind the range join.
        assert "gene#" not in out._jdf.queryExecution().optimizedPlan().toString().split("r_id")[1].split("Join")[0]
