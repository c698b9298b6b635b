"""Operators on documents against brute force, on planted and on odd rows."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from planted import WORDS, prose, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seqloom.llm import byte_bpe, language_id, minhash, packing, pii, queries, substring_dedup

ODD = [
    (900, None), (901, ""), (902, " \t\n\x0b\x0c\r "), (903, "one"), (904, "one two three"), (905, "ÀÉ ñ　x y z \x1c a"), (906, "😀 é   it's  'll"),
    (907, "x" * 30_000), (908, "a b " * 20_000), (None, "no id " * 30), (909, "same text here"), (909, "same text here"), (910, "<|endoftext|> a <|endoftext|>"),
]


def component_of(links, ids):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_copy(text, seed, changes):
    rng, words = random.Random(seed), text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def shingles(text, k):
    w = WORDS.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("words", [4, 5])
def test_near_duplicates_equal_brute_force(docs, words):
    base = [prose(s, 150) for s in range(3)]
    rows = [(i, near_copy(base[i % 3], i, i % 9)) for i in range(120)] + [(200 + i, base[0].upper()) for i in range(60)]
    rows += [(i, t) for i, t in ODD if i is not None]
    sets = {i: shingles(t, words) for i, t in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = component_of(links, sets)
    got = minhash.near_duplicates(docs([*rows, (None, base[1])]), words=words).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept is None
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_large_candidate_groups_are_cut_into_blocks(docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    base = prose(5, 120)
    rows = [(i, near_copy(base, i, 3 + i % 6)) for i in range(150)]
    sets = {i: shingles(t, 5) for i, t in rows}
    want = component_of([(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])], sets)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs(rows)).collect()} == want


def test_keep_one_keeps_columns(docs):
    frame = docs([(1, prose(1, 50)), (2, prose(1, 50)), (3, None), (None, "x"), (4, prose(2, 50))])
    kept = minhash.keep_one(frame)
    assert kept.columns == frame.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [1, 3, 4, None]


def removed(rows, window):
    first = {}
    words = [(i, WORDS.findall(t or "")) for i, t in rows]
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g)))
    return sorted(out)


@pytest.mark.parametrize("subtree", [substring_dedup.SUBTREE, 3])
def test_repeats_equal_brute_force(docs, monkeypatch, subtree):
    monkeypatch.setattr(substring_dedup, "SUBTREE", subtree)
    passage, short = prose(77, 60), prose(78, 12)
    rows = []
    for i in range(60):
        body = prose(i, 80).split()
        at = random.Random(i).randrange(60)
        rows.append((i, " ".join(body[:at] + (passage.split()[i % 7 : 40 + i % 11] if i % 2 else short.split()) + body[at:])))
    rows += [(100, rows[3][1]), (101, "the the " * 40), (102, "the the " * 20), (103, rows[3][1]), (103, prose(9, 40))] + [(i, t) for i, t in ODD if i is not None]
    got = sorted(tuple(r) for r in substring_dedup.remove_repeats(docs(rows)).collect())
    assert got == removed(rows, 13)


def test_null_ids_neither_lose_nor_remove(docs):
    text = prose(4, 30)
    got = substring_dedup.remove_repeats(docs([(None, text), (5, text)])).collect()
    assert [r.n_removed for r in got] == [0, 0]


def test_clean_keeps_columns_and_untouched_texts(docs):
    text = prose(4, 30)
    frame = docs([(1, text + "  end\n"), (2, text + " tail"), (3, None)])
    cleaned = substring_dedup.clean(frame)
    assert cleaned.columns == frame.columns
    assert {r.doc_id: r.text for r in cleaned.collect()} == {1: text + "  end\n", 2: "tail", 3: None}


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def holds(kind, found):
    digits = re.sub("[^0-9]", "", found)
    luhn = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))
    return kind == "email" or (14 <= len(digits) <= 19 and luhn if kind == "card" else 10 <= len(digits) <= 15)


def base_spans(text):
    found = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PATTERNS) for m in re.finditer(p, text or "") if holds(k, m[0])]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))


def test_base_spans_equal_brute_force(docs):
    rng = random.Random(3)
    bits = ["a.b@c.de", "a@b.c_d@e.f.g", "@x", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (017) 555-7713", "+49 30 1234567", "+1", "é😀", "x", "12", "4111111111111111", "a" * 40, "-", ".", "+"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(["", " ", ", ", "\n"]) for _ in range(rng.randrange(25)))) for i in range(200)]
    rows += [*ODD, (950, "mail me at a@b.org " * 3000), (951, "1" * 20_000), (952, "a." * 10_000), (953, "a@" + "b." * 5_000 + "c")]
    got = pii.detect(docs(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), base_spans(t)) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_spans) for r in got) == want
    for r in got:
        assert set(filter(None, r.base_spans.split(","))) <= set(filter(None, r.spans.split(",")))
        assert r.n_email == r.base_spans.count("email:")


def test_labelers_admit_a_number_without_country_code_and_leave_prose_alone(docs):
    rows = [(i, f"call me: +1 ({200 + i}) 555-{1000 + i} soon") for i in range(40)] + [(100, "phone (415) 555-2671 today"), (101, "version 3.1 of 1999, section 12 - 34 - 56")]
    spans = {r.doc_id: r.spans for r in pii.detect(docs(rows)).collect()}
    assert spans[100] == "phone:6:20" and spans[101] == ""


def test_mask_replaces_spans(docs):
    frame = docs([(1, "to a@b.de from 10.0.0.1!"), (2, None), (3, "nothing")])
    masked = pii.mask(frame)
    assert masked.columns == frame.columns
    assert {r.doc_id: r.text for r in masked.collect()} == {1: "to <email> from <ip>!", 2: None, 3: "nothing"}


def test_very_many_matches_in_a_long_text(docs):
    n = 50_000
    parts = [f"é😀 user{i}@host{i}.org, (555) {i % 900 + 100}-{i % 9000 + 1000}" for i in range(n)]
    text, at, want = " ".join(parts), 0, []
    for i, part in enumerate(parts):
        want.append(f"email:{at + 3}:{at + part.index(',')}")
        at += len(part) + 1
    frame = docs([(1, text), (2, "x " * 300_000 + "a@b.com"), (3, "")])
    rows = {r.doc_id: r for r in pii.detect(frame).collect()}
    assert rows[1].base_spans == ",".join(want) and rows[1].n_email == n
    assert rows[2].base_spans == "email:600000:600007" and rows[3].spans == ""
    spans = [(int(a), int(b), k) for k, a, b in (x.split(":") for x in rows[1].spans.split(","))]
    assert {k for _, _, k in spans} == {"email", "phone"} and len(spans) == 2 * n
    out, at = [], 0
    for a, b, k in spans:
        out += [text[at:a], f"<{k}>"]
        at = b
    masked = {r.doc_id: r.text for r in pii.mask(frame).collect()}
    assert masked[1] == "".join(out) + text[at:] and masked[2] == "x " * 300_000 + "<email>" and masked[3] == ""


def test_wider_candidates_give_way_to_base_spans(docs):
    rows = [(1, "+1 (415) 555-2671, (415) 555-2671"), (2, "555-555-2671@x.org 415-555-2671"), (3, "415-555-2671 +49 415-555-2671")]
    spans = pii.candidates(F.col("text"))
    for r in docs(rows).select("text", spans.alias("c")).collect():
        base = [(c.start, c.end) for c in r.c if c.base]
        assert base and all(c.base or all(c.end <= a or b <= c.start for a, b in base) for c in r.c)
        assert [(c.start, c.kind) for c in r.c] == sorted((c.start, c.kind) for c in r.c)
    kinds = {r.doc_id: [(c.kind, c.base) for c in r.c] for r in docs(rows).select("doc_id", spans.alias("c")).collect()}
    assert (0, True) in kinds[2] and (3, False) in kinds[2] and (3, False) in kinds[3]


def test_byte_bpe_equals_the_rank_encoder_and_decodes(docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = byte_bpe.read_ranks(path)
    right = tiktoken.Encoding("right", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    rows = ODD + [(i, "".join(rng.choice(["a", "é", " ", "  ", "\n", "9", "'s", "😀", "中", " ", "　", "the ", "tion"]) for _ in range(60))) for i in range(300)]
    encoded = byte_bpe.encode(docs(rows), path, public_tokenizers.PATTERN)
    assert sorted((str(r.doc_id), r.ids) for r in encoded.collect()) == sorted((str(i), right.encode_ordinary(t or "")) for i, t in rows)
    assert sorted((str(r.doc_id), bytes(r.data)) for r in byte_bpe.decode(encoded, path).collect()) == sorted((str(i), (t or "").encode()) for i, t in rows)
    assert sorted(r.decoded_sha256 for r in byte_bpe.digest(encoded, path).collect()) == sorted(sha(t or "") for _, t in rows)


def test_offsets_of_tokens(docs):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    rng = random.Random(11)
    bits = ["plain words", " é", "😀", "漢字", "\n\n", "'s", " 1234", "\u00a0", "\U0001F9D1\u200D\U0001F680", "x" * 30, "  "]
    texts = ["", None, "😀", *("".join(rng.choices(bits, k=rng.randrange(1, 30))) for _ in range(40)), "naïve 漢 " * 20_000]
    frame = docs(list(enumerate(texts)))
    library = byte_bpe.build_encoder(byte_bpe.read_ranks(path), pattern)
    decoder = byte_bpe.Decoder(byte_bpe.read_ranks(path))
    rows = byte_bpe.with_offsets(byte_bpe.encode(frame, path, pattern), path).collect()
    assert len(rows) == len(texts)
    shared = 0
    for r in rows:
        text = texts[r.doc_id] or ""
        spans = list(zip(r.starts, r.ends, strict=True))
        assert spans == library.encode(text, add_special_tokens=False).offsets
        shared += sum(a[1] > b[0] for a, b in zip(spans, spans[1:]))
        for i, (a, b) in list(zip(r.ids, spans, strict=True))[:500]:
            token = decoder.flat[decoder.starts[i] : decoder.starts[i] + decoder.lengths[i]].tobytes()
            assert token in text[a:b].encode() and len(text[a:b].encode()) <= len(token) + 6
    assert shared > 0
    empty = byte_bpe.with_offsets(byte_bpe.encode(frame.filter("false"), path, pattern), path)
    assert empty.collect() == [] and empty.columns == ["doc_id", "ids", "starts", "ends"]


def test_split_characters_decode():
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    ids = [ranks[bytes([b])] for b in "é中".encode()]
    data, ends = byte_bpe.Decoder(ranks).decode(np.array(ids), np.array([0, 1, len(ids)]))
    assert data.tobytes() == "é中".encode() and list(ends) == [0, 1, 5]


@pytest.mark.parametrize("most", [1, 2, 7, 1000])
def test_bins_equal_best_fit_by_scanning(most):
    rng = random.Random(most)
    for capacity in (1, 5, 64):
        bins, open_, used = packing.Bins(capacity, most), {}, {}
        for _ in range(400):
            size = rng.randint(1, capacity)
            was_open = dict(open_)
            fits = [free for free in open_.values() if free >= size]
            got, offset = bins.place(size)
            if fits:
                assert was_open[got] == min(fits)
            else:
                assert got not in used
                if len(open_) >= most:  # one of the fullest has closed
                    closed = {b for b in open_ if b not in {x for own in bins.by_free for x in own}}
                    assert len(closed) == 1 and open_[closed.pop()] == min(open_.values())
                    open_ = {b: f for b, f in open_.items() if b in {x for own in bins.by_free for x in own}}
            assert offset == used.get(got, 0)
            used[got] = offset + size
            open_.pop(got, None)
            if used[got] < capacity:
                open_[got] = capacity - used[got]
            held = {b: free for free, own in enumerate(bins.by_free) for b in own}
            assert held == open_ and len(held) == bins.open <= most
            assert bins.free_bits == sum(1 << f for f in set(held.values()))


def test_packing_holds_every_token_once(docs):
    path = public_tokenizers.path("byte_bpe_50k.json")
    right = Tokenizer.from_file(path)
    rows = ODD + [(i, prose(i, (i * 37) % 400)) for i in range(150)]
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append([*right.encode(t or "", add_special_tokens=False).ids, 0])
    pieces = packing.pack(docs(rows), path, capacity=128).collect()
    bins = {}
    for p in pieces:
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
        assert any(p.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in own[p.start : p.start + p.length])) for own in ids[p.doc_id])
    for own in bins.values():
        ends = [0]
        for offset, length in sorted(own):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 128
    total = sum(len(x) for own in ids.values() for x in own)
    assert sum(p.length for p in pieces) == total
    assert len(bins) <= 1.1 * total / 128 + 8
    for i, own in ids.items():
        if len(own) == 1:
            at = sorted((p.piece, p.start, p.length) for p in pieces if p.doc_id == i)
            assert at == [(k, s, n) for k, (s, n) in enumerate(packing.cut(len(own[0]), 128))]


def test_language_models_tell_languages_apart(docs, spark):
    rows = [(i, prose(i, 60, "abcdefg" if i % 2 else "mnopqrst"), "ab" if i % 2 else "mn", "s", 1) for i in range(400)]
    frame = spark.createDataFrame([*rows, (None, "x", "ab", "s", 1), (5000, None, "mn", "s", 1), (5001, "abc", None, "s", 1)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = language_id.train(frame.filter(~language_id.held_out(frame["doc_id"])))
    assert model.languages == ["ab", "mn"]
    odd = [(1, "abc fed, GAB!"), (2, "mno\npqr"), (3, None), (4, "123 !?"), (5, ""), (5, "abc"), (None, "tsrq"), (6, "xyz zyx " * 200), (7, "ab " * 50_000)]
    got = {(r.doc_id, r.lang_pred) for r in language_id.classify(docs(odd), model).collect()}
    assert got - {(6, "ab"), (6, "mn")} == {(1, "ab"), (2, "mn"), (3, "und"), (4, "und"), (5, "und"), (5, "ab"), (None, "mn"), (7, "ab")}
    right = [(r.lang == r.lang_pred) for r in language_id.classify(frame.filter("doc_id < 400"), model).join(frame.select("doc_id", "lang"), "doc_id").collect()]
    assert sum(right) == len(right)
    kept = language_id.accepted(docs(odd), model)
    assert "rejected" in kept.columns and {1, 2, 7} <= {r.doc_id for r in kept.collect()} and not {3, 4, 6} & {r.doc_id for r in kept.collect()}
    for r in language_id.classify(docs(odd), model).collect():
        assert 0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0)


def spoken(seed, syllables, n=60):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(syllables, k=rng.randint(2, 4))) for _ in range(n))


TONGUES = {"a": ["ba", "ke", "lo", "mi"], "b": ["ust", "orn", "elk", "ind"], "c": ["ab", "ek", "ol", "im"]}


def test_an_unlearnt_language_is_rejected_beside_an_odd_document(docs, spark):
    rows = [(i, spoken(i, TONGUES["a" if i % 2 else "b"]), "a" if i % 2 else "b") for i in range(800)]
    # One odd document for each language, in one fold.
    ids = spark.range(2000, 2100).filter("pmod(xxhash64(id, 'fold'), 5) = 0").limit(2).collect()
    rows += [(r.id, prose(r.id, 60, letters), lang) for r, letters, lang in zip(ids, ["bakelomi", "ustorneldk"], "ab", strict=True)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    clean = [(5000 + i, spoken(5000 + i, TONGUES["ab"[i % 2]])) for i in range(100)]
    foreign = [(6000 + i, spoken(6000 + i, TONGUES["c"])) for i in range(100)]
    rejected = {r.doc_id for r in language_id.classify(docs(clean + foreign), model).filter("rejected").collect()}
    assert not rejected & {i for i, _ in clean}
    assert len(rejected & {i for i, _ in foreign}) >= 98


@pytest.mark.parametrize("rare", [1, 3, 12, 60])
def test_a_rare_language_rejects_too(docs, spark, rare):
    rows = [(i, spoken(i, TONGUES["b"]), "b") for i in range(300)] + [(1000 + i, spoken(1000 + i, TONGUES["a"]), "a") for i in range(rare)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert np.isfinite(model.calibration).all()
    if rare < 12:
        return
    near = [(5000 + i, spoken(5000 + i, TONGUES["a"])) for i in range(50)]
    foreign = [(6000 + i, spoken(6000 + i, TONGUES["c"])) for i in range(50)]
    got = {r.doc_id: r for r in language_id.classify(docs(near + foreign), model).collect()}
    assert not any(got[i].rejected for i, _ in near) and {got[i].lang_pred for i, _ in near} == {"a"}
    assert all(got[i].rejected for i, _ in foreign) and "a" in {got[i].lang_pred for i, _ in foreign}


def test_a_language_in_one_fold_is_learnt(docs, spark):
    folds = {r.id: r.k for r in spark.range(3000).selectExpr("id", "pmod(xxhash64(id, 'fold'), 5) k").collect()}
    for fold in range(5):
        own = [i for i, k in folds.items() if k == fold][:3]
        rows = [(i, spoken(i, TONGUES["b"]), "b") for i in range(60)] + [(i, spoken(i, TONGUES["a"]), "a") for i in own]
        model = language_id.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
        assert model.languages == ["a", "b"] and np.isfinite(model.calibration).all()
    only = language_id.train(spark.createDataFrame([(own[0], spoken(1, TONGUES["a"]), "a")], "doc_id bigint, text string, lang string"))
    assert language_id.classify(docs([(1, spoken(2, TONGUES["a"])), (2, "12")]), only).sort("doc_id").first().lang_pred == "a"


def test_held_out_accuracy(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    judged = queries.QUERIES["op4_language_id"](spark, "/root/testdata/sf0.01").join(frame.select("doc_id", "lang"), "doc_id").filter("held_out and lang is not null")
    right = [r.lang == r.lang_pred for r in judged.collect()]
    assert len(right) > 100 and sum(right) >= 0.97 * len(right)


def test_words_hold_every_run_of_letters():
    texts = [None, "", "Ab1cd-É́x", "xyz", "abc", "don't Straße\tÀ", "123", "日本 go"]
    words, first = language_id.words_of(pa.array(["cut", *texts])[1:])
    own = [words.to_pylist()[first[i] : first[i + 1]] for i in range(len(texts))]
    assert [[r for w in ws for r in language_id.letter_runs(w)] for ws in own] == [regex.findall(r"\p{L}[\p{L}\p{M}]*", (t or "").lower()) for t in texts]


def test_memory_of_words_makes_no_difference(monkeypatch):
    counts = {"x": {"\x02\x02a": 3, "\x02ab": 2, "\x02ac": 1, "ab\x03": 2, "ac\x03": 1}, "y": {"\x02\x02b": 3, "\x02ba": 2, "ba\x03": 2}}
    model, rng = language_id.kneser_ney(counts, 3), random.Random(0)
    batches = [pa.array([" ".join("".join(rng.choices("abc", k=rng.randint(1, 4))) for _ in range(20)) for _ in range(5)]) for _ in range(20)]
    whole = [language_id.Scorer(model).texts(b) for b in batches]
    monkeypatch.setattr(language_id, "MEMORY_WORDS", 90)
    small = language_id.Scorer(model)
    for batch, (want, n) in zip(batches, whole, strict=True):
        got, m = small.texts(batch)
        assert np.allclose(got, want) and (m == n).all() and len(small.known) <= 90


def test_probabilities_sum_to_one(spark):
    model = language_id.kneser_ney({"x": {"\x02\x02a": 3, "\x02ab": 2, "\x02ac": 1, "ab\x03": 2, "ac\x03": 1}}, 3)
    letters = ["a", "b", "c", "\x03", "\x02", "?"]
    for context in ("", "a", "ab"):
        assert abs(sum(math.exp(_step(model, context, x)) for x in letters) - 1) < 1e-9
    for word in ("ab", "ac", "b", "?", "abc"):
        steps = sum(_step(model, word[:i], x) for i, x in enumerate(word + "\x03"))
        assert abs(model.score([word])[0, 0] - steps) < 1e-9


def _step(model, context, letter):
    """Log-probability of one letter after a word's start, straight from the tables."""
    grams = [language_id._gram_hashes([g], len(g))[0] for g in (letter, ("\x02\x02" + context)[-1] + letter, ("\x02\x02" + context)[-2:] + letter)]
    contexts = [language_id._gram_hashes([g], len(g))[0] for g in ("", ("\x02\x02" + context)[-1], ("\x02\x02" + context)[-2:])]
    total = 0.0
    for k in (3, 2, 1):
        keys, values = model.grams[k - 1]
        at = np.flatnonzero(keys == grams[k - 1])
        if len(at):
            return total + values[at[0], 0]
        keys, values = model.contexts[k - 1]
        at = np.flatnonzero(keys == contexts[k - 1])
        total += values[at[0], 0] if len(at) else 0.0
    return total + model.floor


def test_empty_tables(docs, spark):
    none = docs([(1, "x")]).filter("false")
    assert minhash.near_duplicates(none).count() == 0 and substring_dedup.remove_repeats(none).count() == 0 and pii.detect(none).count() == 0
    assert packing.pack(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    model = language_id.train(none)
    assert language_id.classify(docs([(1, "x")]), model).first().lang_pred == "und"
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert byte_bpe.digest(byte_bpe.encode(none, path, public_tokenizers.PATTERN), path).count() == 0
