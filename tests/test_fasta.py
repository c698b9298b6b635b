"""FASTA chunks against slices of whole sequences."""

import gzip
import io
import random
import tracemalloc

import pyarrow as pa
import pytest

from seqloom.sources import fasta


def fasta_text(rng, sequences):
    out = []
    for name, seq in sequences:
        out.append(f">{name} some words >x")
        width = rng.choice([3, 10, 10_000])
        out += [seq[i : i + width] for i in range(0, len(seq), width)]
        if rng.random() < 0.3:
            out.append("")
    end = rng.choice(["\n", "\r\n"])
    return end.join(out) + rng.choice(["", end])


def expected(sequences, chunk):
    return sorted((n, i, s[i : i + chunk]) for n, s in sequences for i in range(0, len(s), chunk))


@pytest.mark.parametrize("split_bytes,chunk", [(7, 5), (31, 16), (64, 1000), (10_000, 16)])
def test_chunks_equal_slices(spark, tmp_path, split_bytes, chunk):
    rng = random.Random(split_bytes)
    every = []
    for f in range(4):
        own = [(f"f{f}s{k}", "".join(rng.choices("ACGTNacgt", k=rng.choice([0, 1, 16, 40, 200])))) for k in range(rng.randrange(1, 6))]
        every += own
        text = fasta_text(rng, own).encode()
        name = tmp_path / f"{f}.fa"
        (name.with_suffix(".fa.gz") if f == 3 else name).write_bytes(gzip.compress(text) if f == 3 else text)
    (tmp_path / "lead.fa").write_text("ACGT\n>late\nTT\n")
    got = fasta.read_fasta_chunks(spark, str(tmp_path), chunk=chunk, split_bytes=split_bytes).collect()
    assert sorted(map(tuple, got)) == sorted(expected(every, chunk) + [("late", 0, "TT")])


@pytest.mark.parametrize("block", [1, 2, 5, 1 << 20])
def test_ranges_hold_every_byte_once(monkeypatch, block):
    monkeypatch.setattr(fasta, "BLOCK", block)
    text = b">a b\nACG\n\nT>T\n>c\n>d long header here\nGGGG\nCC\n>e"
    whole = list(fasta.events(io.BytesIO(text), 0, None))
    for size in range(1, len(text) + 1):
        parts = [e for s in range(0, len(text), size) for e in fasta.events(pa.BufferReader(text), s, min(s + size, len(text)))]
        join = lambda found: [(h, x) if h else c for h, x in found for c in ([0] if h else x)]
        assert join(parts) == join(whole)


def test_a_long_sequence_streams(tmp_path):
    """250 million bases in lines of 60, in pieces of a million, within a few megabytes."""
    path = tmp_path / "long.fa"
    line = b"ACGTACGTAC" * 6 + b"\n"
    with path.open("wb") as f:
        f.write(b">long\n")
        for _ in range(42):
            f.write(line * 100_000)
    reader = fasta.FastaReader([str(path)], 1 << 40, 1 << 20)
    tracemalloc.start()
    sizes = [len(seq) for _, _, _, seq in reader._pieces(reader.partitions()[0])]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == 42 * 6_000_000 and max(sizes) == 1 << 20 and peak < 64 << 20
