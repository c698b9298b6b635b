"""Read operators on golden rows and against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from seqloom.operators import adapters as A, pairs as P, qc as Q, reads as R

SCHEMA = "sample string, read_idx bigint, mate int, qname string, seq string, qual string"


def reads(spark, seqs, mate=1, qual=None):
    rows = [("s", i, mate, f"q{i} x", s, qual[i] if qual else "I" * len(s)) for i, s in enumerate(seqs)]
    return spark.createDataFrame(rows, SCHEMA)


def seqs(df):
    return [r["seq"] for r in df.orderBy("read_idx", "mate").collect()]


def test_empty_mate_drops_the_pair(spark):
    both = reads(spark, ["AC", "", "GT"]).unionByName(reads(spark, ["A", "C", ""], mate=2))
    assert seqs(R.drop_empty_reads(both)) == ["AC", "A"]


def test_reverse_complement_twice_is_identity(spark):
    df = reads(spark, ["ACGTNacgtn", "GATTACA"])
    assert seqs(R.reverse_complement(R.reverse_complement(df))) == ["ACGTNacgtn", "GATTACA"]


def brute_trim(qual, cutoff):
    total, low, keep = 0, 0, len(qual)
    for i in range(len(qual) - 1, -1, -1):
        total += ord(qual[i]) - 33 - cutoff
        if total < low:
            low, keep = total, i
    return keep


def test_quality_trim_brute_force(spark):
    rng = random.Random(3)
    quals = ["".join(chr(33 + rng.randrange(41)) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    out = seqs(R.quality_trim(reads(spark, ["A" * len(q) for q in quals], qual=quals), cutoff=20))
    assert [len(s) for s in out] == [brute_trim(q, 20) for q in quals]


def brute_adapter(seq, adapter, rate, overlap):
    best = (0, None)
    for o in range(0, len(seq) - overlap + 1):
        part = seq[o : o + len(adapter)]
        same = sum(a == b for a, b in zip(part, adapter))
        if len(part) >= overlap and len(part) - same <= int(rate * len(part) + 1e-9) and same > best[0]:
            best = (same, o)
    return seq if best[1] is None else seq[: best[1]]


def test_adapter_with_mismatches_brute_force(spark):
    rng = random.Random(5)
    adapter = "AGATCGGAAGAG"
    texts = []
    for i in range(80):
        body = "".join(rng.choice("ACGT") for _ in range(rng.randrange(5, 30)))
        a = list(adapter[: rng.randrange(2, 13)])
        if a and i % 3 == 0:
            a[rng.randrange(len(a))] = "N"
        texts.append(body + "".join(a))
    out = A.clip_adapter(reads(spark, texts), [adapter], error_rate=0.2)
    assert seqs(out) == [brute_adapter(s, adapter, 0.2, 3) for s in texts]


def test_adapter_modes(spark):
    df = reads(spark, ["TTTAGGGCCC", "GGGCCCTTTA", "AAAAAAAAAA"])
    five = A.clip_adapter(df, ["TTTAGG"], where="g", error_rate=0.0)
    assert seqs(five) == ["GCCC", "GGGCCCTTTA", "AAAAAAAAAA"]
    masked = A.clip_adapter(df, ["GGGCCC"], error_rate=0.0, mask=True)
    assert seqs(masked) == ["TTTANNNNNN", "NNNNNNNNNN", "AAAAAAAAAA"]
    flagged = A.clip_adapter(df, ["GGGCCC"], error_rate=0.0, no_trim=True)
    assert seqs(A.discard_untrimmed(flagged)) == ["TTTAGGGCCC", "GGGCCCTTTA"]


def test_long_reads_do_not_break_batches(spark):
    texts = ["ACGT" * 50000 + "AGATCGGAAGAG", "ACGAGATCGGAAGAG", ""]
    out = A.clip_adapter(reads(spark, texts), ["AGATCGGAAGAG"], error_rate=0.0)
    assert [len(s) for s in seqs(out)] == [200000, 3, 0]
    counts = {r["kmer"]: r["n"] for r in Q.kmer_content(reads(spark, texts), k=4).collect()}
    assert counts["ACGT"] == 50000 and sum(counts.values()) == 200012 - 3 + 12


def test_trim_terminal(spark):
    df = reads(spark, ["NNACGNN", "NNNN", "ACG"], qual=["IIIIIII", "IIII", "#I#"])
    assert seqs(R.trim_terminal(df)) == ["ACG", "", "ACG"]
    assert seqs(R.trim_terminal(df, ns=False, min_quality=2)) == ["NNACGNN", "NNNN", "C"]


def test_merge_pairs(spark):
    frag = "ACGTTGCAAGCTTACGGATCCATGCAAT"
    turned = frag[::-1].translate(str.maketrans("ACGT", "TGCA"))
    both = reads(spark, [frag[:20], "A" * 20]).unionByName(reads(spark, [turned[:20], "C" * 20], mate=2))
    out = {r["read_idx"]: r for r in P.merge_pairs(both, min_overlap=8, min_len=10).collect()}
    assert out[0]["seq"] == frag and out[0]["status"] == "assembled" and len(out[0]["qual"]) == len(frag)
    assert out[1]["status"] == "unassembled"


def test_overlap_of_mates_is_searched_once(spark):
    """A filter on the overlap does not search it again: a task has one Python worker, not two."""
    rng = random.Random(5)
    frags = ["".join(rng.choices("ACGT", k=20)) for _ in range(6)]
    turned = [f[::-1].translate(str.maketrans("ACGT", "TGCA")) for f in frags]
    both = reads(spark, [f + "AGATC" for f in frags] + ["A" * 25, ""])
    both = both.unionByName(reads(spark, [t + "CTG" for t in turned] + ["A" * 23, "ACGT"], mate=2))
    both = both.unionByName(spark.createDataFrame([("s", 9, 1, "x", None, None), ("s", 9, 2, "x", "ACGT", "IIII")], SCHEMA))
    out = P.identify_adapters(both, min_overlap=11)
    got = {(r["mate"], r["pos"]): (r["base"], r["rank_n"], r["total"]) for r in out.collect()}
    assert got == {(m, i): (b, 6, 6) for m, tail in ((1, "AGATC"), (2, "CTG")) for i, b in enumerate(tail)}
    merged = P.merge_pairs(both, min_overlap=11, min_len=10).filter("status = 'assembled' and overlap > 0")
    assert sorted(r["seq"] for r in merged.collect()) == sorted(frags)
    for df in (out, merged):
        assert df._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1


def test_sampling_is_exact_nested_and_pairwise(spark):
    both = reads(spark, ["A"] * 300).unionByName(reads(spark, ["C"] * 300, mate=2))
    got = R.sample_reads(both, n=57)
    rest = R.sample_reads(both, n=57, complement=True)
    assert got.count() == 114 and rest.count() == 600 - 114
    assert got.groupBy("read_idx").count().filter("count <> 2").count() == 0
    again = R.sample_reads(both.orderBy(F.rand(1)).repartition(7), n=57)
    assert {r["read_idx"] for r in again.collect()} == {r["read_idx"] for r in got.collect()}
    with pytest.raises(Exception, match="fewer records"):
        R.sample_reads(both, n=1000, strict=True).collect()


def test_chunks_add_up(spark):
    df = R.split_reads(reads(spark, ["A"] * 25), n_per_chunk=10)
    assert {r["chunk"]: r["count"] for r in df.groupBy("chunk").count().collect()} == {1: 10, 2: 10, 3: 5}


def test_demultiplex_ambiguous_is_undetermined(spark):
    samples = spark.createDataFrame([("x", "AAAA"), ("y", "AATT")], "sample string, index_r1 string")
    codes = spark.createDataFrame([("AAAA",), ("AAAC",), ("AAAT",), ("GGGG",)], "barcode string")
    got = {r["barcode"]: r["sample"] for r in A.demultiplex(codes, samples).collect()}
    assert got == {"AAAA": "x", "AAAC": "x", "AAAT": "Undetermined", "GGGG": "Undetermined"}


def test_options_are_checked_early(spark):
    df = reads(spark, ["A"])
    for bad in (
        lambda: A.clip_adapter(df, ["A"], where="z"), lambda: R.sample_reads(df, n=1, fraction=0.5), lambda: R.filter_length(df),
        lambda: R.trim_recipe(df, [("sharpen", {})]), lambda: Q.kmer_content(df, k=11),
    ):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("where", ["a", "g", "b"])
def test_one_adapter_rule_with_and_without_mismatches(spark, where):
    """The JVM search and the batched one follow one rule: most bases, leftmost, first adapter."""
    rng = random.Random(5)
    adapters = ["AGAT", "ACGTACGTA", "ACGTC", "".join(rng.choices("ACGT", k=40))]
    reads = ["GATCCCCCAGATC", "TTTACGTCCACGTACGTACGTT", "", "AG", adapters[3][5:30], "T" + adapters[3] + "C"]
    for _ in range(150):
        a = rng.choice(adapters)
        cut = a[rng.randrange(len(a)) :] if rng.random() < 0.5 else a[: rng.randrange(1, len(a) + 1)]
        tail = "".join(rng.choices("ACGT", k=rng.randrange(12)))
        reads.append(rng.choice([tail + cut, cut + tail, tail + a + tail]))
    df = spark.createDataFrame([(r,) for r in reads], "seq string")
    exact = A.find_adapter(F.col("seq"), adapters, where=where, error_rate=0.0)
    searched = A._search(adapters, where, 0.0, 3, True, False)(F.col("seq"))

    def best(read):
        hits = []
        for i, a in enumerate(adapters):
            for at in range(-len(a) + 1, len(read)):
                lo, hi = max(at, 0), min(at + len(a), len(read))
                cut_left, cut_right = at < 0, at + len(a) > len(read)
                if hi - lo < 3 or (cut_left and (where == "a" or cut_right)) or (cut_right and where == "g"):
                    continue
                if read[lo:hi] == a[lo - at : hi - at]:
                    hits.append((-(hi - lo), lo, i, hi))
        return (min(hits)[1], min(hits)[3]) if hits else (-1, -1)

    for r in df.select("seq", exact.alias("x"), searched.alias("y")).collect():
        assert tuple(r["x"]) == tuple(r["y"]) == best(r["seq"]), r["seq"]


def test_pair_rule_computes_failing_pairs_once(spark):
    both = reads(spark, ["ACGT", "NNNT", "ACGT"]).unionByName(reads(spark, ["AC", "ACGT", "N"], mate=2))
    both = both.unionByName(spark.createDataFrame([(None, None, 1, "x", "ACGT", "IIII"), (None, None, 2, "x", "NNNN", "IIII")], SCHEMA))
    out = R.filter_max_n(both, max_n=2, paired=True)
    assert out.columns == both.columns
    # Reads without a pair key fall alone.
    assert sorted((r["read_idx"] is None, r["seq"]) for r in out.collect()) == [(False, "AC"), (False, "ACGT"), (False, "ACGT"), (False, "N"), (True, "ACGT")]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("regexp_replace") == 2
