"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from planted import prose
from test_documents import ODD

from seqloom.llm import spelling


def counted(rows):
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate({c: c + 32 for c in range(65, 91)})
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for i in range(len(word) + 1):
        for c in letters:
            out |= {word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]}
    return out - {word}


def expected(rows):
    n = counted(rows)
    letters = {c for w in n for c in w}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and x in e] for w, e in ((w, edits(w, letters) if len(w) < 100 else set()) for w in n)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def varied(word, rng, letters):
    i = rng.randrange(len(word) + 1)
    return rng.choice([word[:i] + rng.choice(letters) + word[i:], word[:i] + word[i + 1 :], word[:i] + rng.choice(letters) + word[i + 1 :]])


@pytest.mark.parametrize("letters,share", [("ab", 20_000), ("ab", 10), ("abcdefghéÿ×", 20_000), ("abcdefghéÿ×", 40)])
def test_variants_equal_brute_force(docs, monkeypatch, letters, share):
    monkeypatch.setattr(spelling.frequent_grams, "__kwdefaults__", {"share": share})
    rng = random.Random(len(letters) + share)
    pool = ["".join(rng.choices(letters, k=rng.randint(7, 14))) for _ in range(12)]
    text = []
    for k, w in enumerate(pool):
        text += [w] * (400 if k % 3 == 0 else 30)
        for _ in range(12):
            v = varied(w, rng, letters)
            text += [v] * rng.choice([1, 2, 3, 25]) + [varied(v, rng, letters).upper().replace("É", "é").replace("Ÿ", "ÿ")] * 2
    rng.shuffle(text)
    rows = [(i, " ".join(text[i::40])) for i in range(40)] + ODD + [(990, "y" * 4000 + " " + "y" * 4000), (991, "Übermut Übermut übermut übermut")]
    got = sorted(map(tuple, spelling.variants(docs(rows)).collect()))
    assert got == expected(rows)
    assert any(r[1] for r in got)


def test_chains_of_forms_lead_to_the_last(docs):
    words = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdwzyx"]
    rows = [(10 + k, f"{w} " * (2 * 12**k)) for k, w in enumerate(words[:4])]
    got = {r.word: r for r in spelling.variants(docs(rows)).collect()}
    assert sorted(map(tuple, got.values())) == expected(rows)
    assert got["abcdefgh"].root == "abcdezyx" and got["abcdefgh"].form == "abcdefgx"


def test_tables_without_words(docs):
    assert spelling.variants(docs([(1, None), (2, ""), (3, "short words"), (4, "onlyonce")])).count() == 0
    empty = spelling.variants(docs([(1, "x")]).limit(0))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_affected_bounds_hold_for_every_edit():
    rng = random.Random(4)
    pool = ["".join(rng.choices("abc", k=rng.randint(7, 12))) for _ in range(60)]
    counts = Counter(w[p : p + q] for w in pool for q in (2, 3, 4) for p in range(len(w) - q + 1))
    frequent = {g: k for g, k in counts.items() if k > 6}
    for word in pool:
        for edited in edits(word, "abcd"):
            insertion = len(edited) > len(word)
            shorter = min(len(word), len(edited))
            if shorter < 7:
                continue
            longest = spelling.longest_gram(shorter)
            parts = []
            for w in (word, edited):
                s, e = spelling.decompose(w, frequent, longest)
                parts.append((s, e, Counter(w[p:q] for p, q in zip(s, e, strict=True))))
            bound = spelling.affected(parts[0][0], parts[0][1], len(word), longest, insertion=insertion)
            assert sum((parts[0][2] & parts[1][2]).values()) >= len(parts[0][0]) - bound > 0
            roles = (spelling.SAME, spelling.SAME) if len(word) == len(edited) else (spelling.SHORTER, spelling.LONGER) if insertion else (spelling.LONGER, spelling.SHORTER)
            lists = [{x[1:] for x in spelling.index_entries(w, frequent) if x[0] == r} for w, r in zip((word, edited), roles, strict=True)]
            assert lists[0] & lists[1]


def test_dictionary_is_bounded(spark, docs):
    words = spelling.occurrences(docs([(1, prose(3, 3000) * 2), (2, "abcabcabcabc " * 9)]))
    every = spelling.frequent_grams(words, share=10**9)
    few = spelling.frequent_grams(words, share=1000)
    assert 0 < len(few) <= 3000 < len(every) and few.items() <= every.items()


def test_no_table_that_grows_with_the_texts_is_broadcast(docs, monkeypatch):
    plans = []

    class Seen(spelling.Scratch):
        def keep(self, df, name):
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
            return super().keep(df, name)

    monkeypatch.setattr(spelling, "Scratch", Seen)
    words = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx"]
    out = spelling.variants(docs([(10 + k, f"{w} " * (2 * 12**k)) for k, w in enumerate(words)]))
    plans.append(out._jdf.queryExecution().sparkPlan().toString())
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    assert len(joins) >= 5 and not [line for line in joins if "Broadcast" in line]
