"""Minimum bin slack against enumeration; packing against the tokenizer library."""

import random
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from planted import prose
from pyspark.sql import functions as F
from test_documents import ODD
from tokenizers import Tokenizer

from seqloom.llm import queries, slack_packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_choice_equals_enumeration():
    rng = random.Random(5)
    for _ in range(300):
        lengths = [rng.randrange(1, 30) for _ in range(rng.randrange(9))]
        capacity = rng.randrange(1, 70)
        counts = {n: lengths.count(n) for n in lengths}
        chosen = slack_packing.fullest(counts, capacity)
        assert all(0 < chosen[n] <= counts[n] for n in chosen)
        best = max(sum(c) for k in range(len(lengths) + 1) for c in combinations(lengths, k) if sum(c) <= capacity)
        assert sum(n * k for n, k in chosen.items()) == best


@pytest.mark.parametrize("waiting", [1, 2, 7, 1000])
def test_packer_fills_every_sequence(waiting):
    rng = random.Random(waiting)
    packer = slack_packing.Packer(64, waiting)
    texts = [np.arange(rng.choice([1, 1, 3, 7, 20, 63, 64, 65, 200]), dtype="<u4") + 1000 * i for i in range(120)]
    placed = [p for i, t in enumerate(texts) for p in packer.add((i, len(t)), t)]
    assert packer.pieces <= waiting or packer.tokens < 64
    placed += packer.finish()
    sizes, seen = {}, {}
    for ((i, _), start, ids), offset, sequence in placed:
        assert sizes.get(sequence, 0) == offset
        sizes[sequence] = offset + len(ids)
        seen.setdefault(i, {})[start] = ids
    assert {i: np.concatenate([p[k] for k in sorted(p)]).tolist() for i, p in seen.items()} == {i: t.tolist() for i, t in enumerate(texts)}
    assert all(n & n - 1 == 0 and n <= 64 for n in sizes.values()) and sum(n < 64 for n in sizes.values()) <= 6


def test_pieces_hold_the_ids_of_the_library(docs):
    right = Tokenizer.from_file(PATH)
    rng = random.Random(2)
    bits = ["Word", "É", "é", "Σ", "ς", " ", "\n", "　", "́", "'LL", "'s", "9", "中", "<|endoftext|>", "<|ENDOFTEXT|>", "!?", "\x1c", "K", "İ"]
    rows = ODD + [(i, prose(i, (i * 37) % 400)) for i in range(100)] + [(500 + i, "".join(rng.choice(bits) for _ in range(50))) for i in range(200)]
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*right.encode(t or "", add_special_tokens=False).ids, 2])
    frame = docs(rows).withColumn("sequence_id", F.lit("x"))
    pieces = slack_packing.pack(frame, PATH, capacity=128, waiting=20).collect()
    bins, held = {}, {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
        held[p.doc_id] = held.get(p.doc_id, 0) + p.length
        cut = [own[p.start : p.start + p.length] for own in ids[p.doc_id] if len(own) == p.doc_tokens]
        assert any(p.ids_crc32 == zlib.crc32(np.array(own, "<u4").tobytes()) for own in cut)
    assert held == {i: sum(map(len, own)) for i, own in ids.items()}
    for own in bins.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 128 and end & end - 1 == 0


def test_empty_table_and_bad_capacity(docs):
    assert slack_packing.pack(docs([(1, "x")]).limit(0), PATH).count() == 0
    with pytest.raises(ValueError):
        slack_packing.pack(docs([(1, "x")]), PATH, capacity=100)


def test_registered_query_packs_the_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    pieces = queries.QUERIES["op12_minimum_slack_packing"](spark, sf).toPandas()
    right = Tokenizer.from_file(PATH)
    texts = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: np.array([*right.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4") for r in texts}
    assert pieces.groupby("doc_id")["length"].sum().to_dict() == {i: len(x) for i, x in want.items()}
    for p in pieces.itertuples():
        assert p.doc_tokens == len(want[p.doc_id]) and p.ids_crc32 == zlib.crc32(want[p.doc_id][p.start : p.start + p.length].tobytes())
    sizes = pieces.groupby("sequence_id")["length"].sum()
    assert ((sizes & (sizes - 1)) == 0).all() and sizes.max() == 4096
