"""Fill-in-middle against slicing code points."""

import hashlib
import random

import numpy as np
import pytest
from planted import prose, sha
from pyspark.sql import functions as F
from test_documents import ODD

from seqloom.llm import fim


def expected(doc_id, text):
    text = text or ""
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def rows_of_all_kinds():
    rng = random.Random(8)
    bits = ["a", "é", "中", "😀", " ", "\n", "<", "<P", "<S", "M>", "P>", "\x00"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(12)))) for i in range(400)]
    rows += [(1000 + i, prose(i, 30)) for i in range(60)] + [(2000, "x <P> y"), (2001, "<M>"), (2002, "<<S>>"), (2003, "😀" * 50_000), (2004, "a")]
    return rows + ODD


@pytest.mark.parametrize("slice_bytes", [fim.SLICE, 3])
def test_outputs_equal_slices_and_restore(docs, monkeypatch, slice_bytes):
    rows = rows_of_all_kinds() if slice_bytes > 3 else rows_of_all_kinds()[:200]
    monkeypatch.setattr(fim, "SLICE", slice_bytes)
    made = fim.transform(docs(rows))
    got = made.collect()
    key = lambda r: (str(r[0]), str(r[-1]))
    assert sorted(map(tuple, got), key=key) == sorted(((i, *expected(i, t)) for i, t in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    back = fim.restore(made.withColumn("restored", F.lit(1))).collect()
    assert sorted((str(r.doc_id), r.restored) for r in back) == sorted((str(i), t or "") for i, t in rows)


def test_digest_and_empty_table(docs):
    got = {r.doc_id: r for r in fim.digest(fim.transform(docs([(7, "héllo wörld"), (8, None)]))).collect()}
    assert got[7].output_sha256 == sha(expected(7, "héllo wörld")[-1]) and got[7].restored_sha256 == sha("héllo wörld")
    assert got[8].form == "plain" and got[8].output_sha256 == sha("") and got[8].prefix_chars is None
    empty = fim.digest(fim.transform(docs([(1, "x")]).limit(0)))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]


def test_null_outputs_and_forms(docs):
    frame = docs([(1, "ab"), (2, None)]).select("doc_id", F.col("text").alias("output"), F.lit(None).cast("string").alias("form"))
    assert {r.doc_id: r.restored for r in fim.restore(frame).collect()} == {1: "ab", 2: None}


def test_other_sentinels(docs):
    marks = ("[PRE]", "[SUF]", "[MID]")
    rows = [(i, f"{i} keeps <P> [PR [[SUF MID]") for i in range(40)]
    made = fim.transform(docs(rows), sentinels=marks, plain_percent=0, spm_percent=50)
    assert {r.form for r in made.collect()} == {"psm", "spm"}
    assert {r.doc_id: r.restored for r in fim.restore(made, sentinels=marks).collect()} == dict(rows)
    for bad in (("<P>", "<S>"), ("<P>", "<S<", "<M>"), ("<P>", "S>", "<M>"), ("<P", "<P>", "<M>"), ("", "", "")):
        with pytest.raises(ValueError):
            fim.transform(docs(rows), sentinels=bad)


def test_rotation_in_place():
    for n in range(9):
        for middle in range(n + 1):
            buffer = bytearray(range(n + 4))
            fim.rotate(buffer, 2, 2 + middle, 2 + n)
            whole = bytes(range(n + 4))
            assert buffer == whole[:2] + whole[2 + middle : 2 + n] + whole[2 : 2 + middle] + whole[2 + n :]
    assert fim.byte_cuts(np.frombuffer("aé中😀".encode(), np.uint8), [0, 1, 2, 3, 4, 4]) == [0, 1, 3, 6, 10, 10]
