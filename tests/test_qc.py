"""Screening reads against brute force; packed k-mers and their filter."""

import random

import numpy as np
import pyarrow as pa
import pytest

from seqloom.functions import kmers
from seqloom.operators import qc as Q

K = 7


def texts(rng):
    out = ["".join(rng.choices("ACGTN", weights=[9, 9, 9, 9, 1], k=rng.randrange(40))) for _ in range(60)]
    return [*out, None, "", "ACGT", "ACGTACGTRACGTACGT", "acgtacgtacgt", "A" * 500]


def pieces(text):
    found = {text[i : i + K] for i in range(len(text or "") - K + 1)}
    return {p for p in found if set(p) <= set("ACGTN")}


def number(kmer):
    out = 0
    for c in kmer:
        out = out * 5 + "ACGTN".index(c)
    return out


@pytest.mark.parametrize("slice_letters", [kmers.SLICE, 50])
def test_packed_kmers_equal_slices(monkeypatch, slice_letters):
    monkeypatch.setattr(kmers, "SLICE", slice_letters)
    rows = texts(random.Random(1))
    column = pa.array(["skipped", *rows])[1:]
    got = [(int(r), int(v)) for part in kmers.distinct_kmers(column, K) for r, v in zip(*part, strict=True)]
    assert len(got) == len(set(got))
    assert set(got) == {(i, number(p)) for i, t in enumerate(rows) for p in pieces(t)}
    assert list(kmers.distinct_kmers(pa.array([], pa.string()), K)) == []
    (_, longest), = kmers.distinct_kmers(pa.array(["N" * kmers.LONGEST]), kmers.LONGEST)
    assert longest.tolist() == [5**kmers.LONGEST - 1]


def test_filter_holds_what_was_added():
    rng = np.random.default_rng(0)
    held, other = rng.integers(0, 1 << 60, 5000), rng.integers(0, 1 << 60, 5000)
    screen = kmers.Bloom(1 << 16)
    screen.add(held)
    assert screen.may_hold(held).all() and screen.may_hold(other).mean() < 0.1


@pytest.fixture
def library(spark):
    rng = random.Random(7)
    whole = {n: "".join(rng.choices("ACGTN", weights=[9, 9, 9, 9, 1], k=200)) for n in ("x", "y", "z")}
    whole["y"] = whole["y"][:150] + whole["x"][20:70]
    genome = [(n, s, t[s : s + 64]) for n, t in whole.items() for s in range(0, 200, 64)]
    reads = []
    for i in range(80):
        n = rng.choice("xyz")
        at = rng.randrange(170)
        seq = whole[n][at : at + 30] if i % 3 else "".join(rng.choices("ACGT", k=30))
        reads.append((f"s{i % 2}", i, 1 + i % 2, seq if i % 13 else rng.choice(["", "ACG", None])))
    return (
        spark.createDataFrame(reads, "sample string, read_idx bigint, mate int, seq string"),
        spark.createDataFrame(genome, "rname string, start int, seq string"), reads, whole,
    )


def masks(reads, whole, names, least):
    sets = [pieces(whole[n]) for n in names]
    return {(s, i, m): sum(1 << b for b, g in enumerate(sets) if len(pieces(t) & g) >= least) for s, i, m, t in reads}


@pytest.mark.parametrize("bits", [Q.MOST_FILTER_BITS, 0])
def test_screening_equals_brute_force(library, monkeypatch, bits):
    monkeypatch.setattr(Q, "MOST_FILTER_BITS", bits)
    reads, genome, rows, whole = library
    names, opts = ["x", "y"], {"k": K, "min_kmers": 2}
    want = masks(rows, whole, names, 2)
    got = Q.screen_reads(reads, genome, names=names, **opts)
    assert {tuple(r)[:3]: r["mask"] for r in got.collect()} == want
    assert {tuple(r)[:3] for r in Q.reads_without_hits(reads, genome, names=names, **opts).collect()} == {k for k, m in want.items() if not m}
    table = {(r["sample"], r["genome"]): (r["one_genome"], r["multiple_genomes"]) for r in Q.screen_library(reads, genome, names=names, **opts).collect()}
    for s in ("s0", "s1"):
        own = [m for k, m in want.items() if k[0] == s]
        assert table[s, "no_hits"] == (own.count(0), 0)
        for b, n in enumerate(names):
            assert table.get((s, n), (0, 0)) == (own.count(1 << b), own.count(3))


def test_reads_without_hits_hardly_reach_the_shuffle(library, spark):
    _, genome, _, _ = library
    rng = random.Random(11)
    strange = [("s", i, 1, "".join(rng.choices("ACGT", k=100))) for i in range(400)]
    reads = spark.createDataFrame(strange, "sample string, read_idx bigint, mate int, seq string")
    screen = Q.kmer_filter(genome, k=21, names=["x", "y", "z"])
    assert Q.candidate_kmers(reads, k=21, screen=screen).count() < 400  # of 32,000 k-mers
    assert Q.candidate_kmers(reads, k=21, screen=None).count() > 31_000
    with pytest.raises(ValueError):
        Q.screen_reads(reads, genome, names=["x"], k=28)


def test_short_kmers_are_looked_up_where_the_reads_are(library, spark, monkeypatch):
    _, genome, rows, whole = library
    twice = [*rows, *rows[:9], (None, 1, 1, whole["x"][:30]), (None, 1, 1, whole["x"][:30]), (None, 2, 1, "")]
    # Two rows of one key, with one k-mer each: together they hit.
    twice += [("t", 5, 1, whole["x"][30 : 30 + K]), ("t", 5, 1, whole["x"][80 : 80 + K])]
    reads = spark.createDataFrame(twice, "sample string, read_idx bigint, mate int, seq string")
    opts = {"names": ["x", "y"], "k": K, "min_kmers": 2}
    found = {}
    for most in (Q.MOST_TABLE_BYTES, 0):
        monkeypatch.setattr(Q, "MOST_TABLE_BYTES", most)
        out = Q.reads_without_hits(reads, genome, **opts)
        screened = Q.screen_library(reads, genome, **opts)
        found[most] = [sorted(map(str, d.collect())) for d in (out, screened, Q.screen_reads(reads, genome, **opts))]
        for d in (out, screened):
            assert ("kmer" in d._jdf.queryExecution().optimizedPlan().toString()) == (most == 0)
    assert len(found) == 2 and found[0] == max(found.items())[1]
    monkeypatch.undo()
    dense = Q.kmer_table(genome, k=K, names=["x", "y"])
    want = {}
    for b, n in enumerate(("x", "y")):
        for p in pieces(whole[n]):
            want[number(p)] = want.get(number(p), 0) | 1 << b
    assert {int(i): int(dense[i]) for i in np.flatnonzero(dense)} == want
    assert Q.kmer_table(genome, k=13, names=["x"]) is None


def test_fragment_sizes_in_windows(spark):
    from seqloom.operators import alignments as A

    # Windows [0, 10), [30, 40), [60, 70); 1-based positions, ten bases each.
    places = [("chrA", 1), ("chrA", 11), ("chrA", 20), ("chrA", 22), ("chrA", 41), ("chrA", 65), ("chrB", 1)]
    rows = [("s", f"r{i}", 67, rname, pos, "10M", 100 + i) for i, (rname, pos) in enumerate(places)]
    al = spark.createDataFrame(rows, "sample string, qname string, flag int, rname string, pos int, cigar string, tlen int")

    def sizes(**opts):
        hist = A.fragment_size_hist(al, width=1, **opts).collect()
        return sorted(r["size"] - 100 for r in hist)

    assert sizes() == [0, 1, 2, 3, 4, 5, 6]
    assert sizes(bin_size=10, distance=20) == [0, 3, 5, 6]
    black = spark.createDataFrame([("chrA", 39, 61), ("chrA", 5, 5), ("chrB", 10, 30), ("chrC", 0, 99)], "rname string, start int, end int")
    assert sizes(bin_size=10, distance=20, blacklist=black) == [0, 6]
    # Without gaps only the fifth record, [40, 50), has no free window; the sixth reaches into [70, 80).
    assert sizes(bin_size=10, blacklist=black) == [0, 1, 2, 3, 5, 6]
    with pytest.raises(ValueError):
        A.fragment_size(al, distance=-1)
