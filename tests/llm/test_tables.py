"""Operators on pages, conversations and vectors against brute force, and the registered queries at the smallest scale."""

import math
import os

import numpy as np
import pytest
from planted import sha
from pyspark.sql import functions as F

from seqloom.llm import chat_format, embedding_dedup, queries, topk, url_filter
from seqloom.plans.compare import check

SF = "/root/testdata/sf0.001"


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = rest
    for c in "/?#":
        host = host.split(c, 1)[0]
    path = rest[len(host) :]
    for c in "?#":
        path = path.split(c, 1)[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, "allow", None))
    return host, path, best[3], best[2]


def test_url_rules_equal_brute_force(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.b.c", "", "block"), ("b.c", "/x/y", "allow"), ("com", "/é", "block"), ("com", "/é", "allow"), ("b.c", "/x/y", "allow")]
    urls = [None, "", "no scheme", "http://", "http://NET", "http://net/", "x://example.net/en/a?b#c", "x://www.EXAMPLE.net/en", "x://notexample.net/en/", "x://a.b.c", "x://z.a.b.c?q/x",
            "x://b.c/x/yes", "x://b.c/x/y/z", "x://b.c/X/y", "x://m.com/éa/b", "x://net:80/", "x://a..net//", "x://" + "a." * 3000 + "net/" + "b/" * 3000, "x://net/\n/x", "a://b://net/", "x://net/" + "é" * 50_000] * 2
    pages = spark.createDataFrame([(i % 30, u, "h", "w") for i, u in enumerate(urls)] + [(None, "x://net/", "h", "w")], "page_id bigint, url string, html string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in url_filter.judge(pages, table).collect())
    want = sorted((str(i % 30 if i < len(urls) else None), h, p, str(r), v) for i, u in enumerate([*urls, "x://net/"]) for h, p, r, v in [judged(u, rules)])
    assert got == want
    assert {r.verdict for r in url_filter.judge(pages, table.filter("false")).collect()} == {"allow"}
    assert url_filter.judge(pages.filter("false"), table).count() == 0


def test_url_plan_joins_on_the_short_digest(spark, capsys):
    pages = spark.createDataFrame([(1, "x://net/")], "page_id bigint, url string")
    url_filter.judge(pages, spark.createDataFrame(queries.RULES, "host string, path string, verdict string")).explain("formatted")
    text = capsys.readouterr().out
    assert "short" in text and "Cartesian" not in text and "NestedLoop" not in text


def test_chats_read_back(spark):
    nasty = ["<|start|>user\n", "<|end|>\n", "\\", "\\\\<|", "<\\|", "<|next|>", "", "é😀\n\n", "</s>[INST] ok [/INST]", "x" * 100_000, None]
    rows = [(c, t, role, nasty[(c * 7 + t) % len(nasty)]) for c in range(12) for t, role in enumerate(["system", "user", "user", "assistant", "assistant", "user", "a\nb\\<|", None, "assistant"])]
    rows += [(50, 3, "user", "b"), (50, 3, "user", "a"), (50, 3, "user", "a"), (50, None, "assistant", "first"), (None, 1, "user", "no id"), (60, 1, "assistant", "only")]
    frame = spark.createDataFrame([(*r, "w") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")
    by = {}
    for c, t, role, text in rows:
        by.setdefault(c, []).append((-1 if t is None else t, role or "", text or ""))
    chats = chat_format.format_chats(frame)
    got = {r.conv_id: r for r in chat_format.digest(chats).collect()}
    assert got.keys() == by.keys()
    formatted = {r.conv_id: r for r in chats.collect()}
    for c, turns in by.items():
        turns.sort()
        loss = "".join(t for _, role, t in turns if role == "assistant")
        want = (len(turns), sha("".join(f"{role}\n{t}\n" for _, role, t in turns)), len(loss), sha(loss), len(formatted[c].formatted))
        assert tuple(got[c])[1:] == want
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:], strict=False))
        assert formatted[c].formatted.count(chat_format.START) == blocks
    assert chat_format.format_chats(frame.filter("false")).count() == 0


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "w") for i, v in rows], "vec_id bigint, embedding array<float>, n_links string")


def some_vectors(seed, n, d=12):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(8, d))
    return [(int(i), [float(np.float32(x)) for x in base[i % 8] + rng.normal(size=d) * (0.05 + 0.3 * (i % 3))]) for i in range(n)]


BAD = [(7001, None), (7002, []), (7003, [0.0] * 12), (7004, [math.nan] + [1.0] * 11), (7005, [math.inf] + [1.0] * 11), (None, [1.0] * 12)]


@pytest.mark.parametrize("same", [0, 200])
def test_top_k_equals_brute_force(spark, monkeypatch, same):
    monkeypatch.setattr(topk, "BLOCK", 16)
    rows = some_vectors(1, 300) + [(1000 + i, [0.5] * 12) for i in range(same)] + [(1500, [0.25] * 5), (1550, [-3.0] * 12)]
    with_null = [(8000, [1.0, None] + [1.0] * 10)]
    got = {}
    for r in topk.top_k(vectors_of(spark, rows + BAD + with_null), F.col("vec_id") % 50 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    usable = rows + [BAD[2]]
    whole = {i: np.floor(256 * np.array(v + [0.0] * (12 - len(v)))).astype(np.int64) for i, v in usable}
    assert got.keys() == {i for i in whole if i % 50 == 0}
    for q, found in got.items():
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


@pytest.mark.parametrize("block", [1024, 16])
def test_top_k_of_repeated_ids(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    # Every row stands three times, some ids have two different vectors.
    once = some_vectors(3, 120) + [(i, [x * 1.5 for x in v]) for i, v in some_vectors(4, 20)]
    rows = [r for r in once for _ in range(3)]
    whole = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(np.int64)) for i, v in once]
    got = {}
    for r in topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 10 == 0, k=5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert got.keys() == {i for i, _ in whole if i % 10 == 0}
    for q, found in got.items():
        score = {}
        for i, v in whole:
            if i != q:
                score[i] = max(score.get(i, -(1 << 62)), *(int(u @ v) for j, u in whole if j == q))
        best = sorted((-s, i) for i, s in score.items())[:5]
        assert sorted(found) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


def test_top_k_of_few(spark):
    assert topk.top_k(vectors_of(spark, BAD[:2]), F.lit(True)).count() == 0
    assert [tuple(r) for r in topk.top_k(vectors_of(spark, [(1, [1.0]), (2, [2.0])]), F.col("vec_id") == 1).collect()] == [(1, 1, 2, 256 * 512)]


def linked(rows):
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    ids = sorted(unit)
    matrix = np.array([unit[i] for i in ids])
    near = matrix @ matrix.T >= 0.9
    component = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in zip(*np.nonzero(near), strict=True):
            low = min(component[ids[a]], component[ids[b]])
            if component[ids[a]] != low or component[ids[b]] != low:
                component[ids[a]] = component[ids[b]] = low
                changed = True
    return {i: (int(near[k].sum()) - 1, component[i]) for k, i in enumerate(ids)}


def test_vector_links_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    monkeypatch.setattr(embedding_dedup, "CELL", 40)
    rows = some_vectors(2, 400) + [(1000 + i, [0.5] * 12) for i in range(150)] + [(2000, [5.0] * 12), (2001, [1e30] * 12), (2002, [1e-30] * 12)]
    want = linked(rows)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(vectors_of(spark, rows + BAD)).collect()}
    assert got.keys() == {i for i, _ in rows + BAD}
    for i, _ in BAD[:-1]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id is None
    found = sum(got[i].n_links for i in want)
    assert found >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[i].n_links <= n for i, (n, _) in want.items())
    assert sum(got[i].component_id == c for i, (_, c) in want.items()) >= 0.99 * len(want)


def test_no_vectors(spark):
    got = embedding_dedup.near_duplicates(vectors_of(spark, BAD)).collect()
    assert sorted((str(r.vec_id), r.n_links) for r in got) == sorted((str(i), None if i is None else 0) for i, _ in BAD)
    assert embedding_dedup.near_duplicates(vectors_of(spark, BAD).filter("false")).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    assert check(spark, SF, [name], queries.QUERIES, queries.ORACLES)[name].startswith("ok")


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_registered_top_k_and_links_on_the_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    whole = {i: np.floor(256 * np.array(v, float)).astype(np.int64) for i, v in rows}
    got = {}
    for r in queries.QUERIES["op7_exact_top_k"](spark, SF).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q in (i for i in whole if i % 50 == 0):
        best = sorted((-int(whole[q] @ v), i) for i, v in whole.items() if i != q)[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    want = linked(rows)
    links = {r.vec_id: (r.n_links, r.component_id) for r in queries.QUERIES["op9_embedding_near_dedup"](spark, SF).collect()}
    assert links == want


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


