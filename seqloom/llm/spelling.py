"""Spelling variants: words one edit apart, found through an index of variable-length grams.

Two words one edit apart differ by a replacement, or the longer has one code point more. Each word is decomposed into
grams that grow while they are frequent, so that index lists stay short; one edit can only touch a counted number of a word's grams.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Container, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .scratch import Scratch, bounded_batches

#: A letter, the shortest word, and a form's least multiple of the word's occurrences.
LETTER = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, FORM_RATIO = 7, 2, 10
#: Code points of a gram.
SHORTEST_GRAM, LONGEST_GRAM = 2, 5
#: A gram is frequent if it takes more than one of so many places in the words; so the dictionary holds this many of a length at most.
FREQUENT_SHARE = 20_000
#: Grams of different words that a task counts before it hands them on.
COUNTED_GRAMS = 500_000
SAME, SHORTER, LONGER = 0, 1, 2


def occurrences(docs: DataFrame) -> DataFrame:
    """``word, n``: words of at least seven code points with two occurrences or more in all texts.

    A word is a maximal run of letters, A-Z lower-cased; where 31 divides the crc32 h of ``<doc_id>:<run>``, without its code point
    number h modulo its length. A null text has no words, a null doc_id is written as an empty one.
    """
    runs = docs.select(
        F.coalesce(docs["doc_id"].cast("bigint").cast("string"), F.lit("")).alias("doc_id"),
        F.explode(F.regexp_extract_all(docs["text"], F.lit(f"({LETTER}{{{LEAST_LENGTH},}})"), 1)).alias("run"),
    )
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = runs.select("doc_id", F.translate("run", capitals, capitals.lower()).alias("run"))
    h = F.crc32(F.concat_ws(":", "doc_id", "run"))
    runs = runs.select("run", h.alias("h"), (h % F.length("run")).cast("int").alias("at"))
    spared = F.concat(F.expr("substr(run, 1, at)"), F.expr("substr(run, at + 2)"))
    words = runs.select(F.when(F.col("h") % 31 == 0, spared).otherwise(F.col("run")).alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def frequent_grams(words: DataFrame, *, share: int = FREQUENT_SHARE) -> dict[str, int]:
    """Grams, shorter than the longest, that take more than one of ``share`` places in the different words, with their counts.

    At most ``share`` grams of each of three lengths can: the result is bounded whatever the words are. Every part of a
    frequent gram is frequent too.
    """
    lengths = range(SHORTEST_GRAM, LONGEST_GRAM)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for batch in batches:
            for w in batch.column(0).to_pylist():
                for q in lengths:
                    seen.update(w[p : p + q] for p in range(len(w) - q + 1))
                if len(seen) > COUNTED_GRAMS:
                    yield _columns(("gram", "n"), list(seen.items()))
                    seen.clear()
        yield _columns(("gram", "n"), list(seen.items()))

    places = words.agg(F.sum(F.length("word") - (SHORTEST_GRAM - 1)).alias("n")).first()["n"] or 0
    grams = words.select("word").mapInArrow(task, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in grams.filter(F.col("n") > places / share).toLocalIterator()}


def longest_gram(shorter: int) -> int:
    """The longest gram for pairs whose shorter word has that many code points: no edit touches both the first and the last gram."""
    return max(SHORTEST_GRAM, min(LONGEST_GRAM, (shorter - 1) // 2))


def decompose(word: str, frequent: Container[str], longest: int) -> tuple[list[int], list[int]]:
    """(starts, ends) of the word's variable-length grams, both ascending.

    The gram at a place grows from the shortest while it is frequent, shorter than ``longest`` and inside the word; one that lies
    within the gram of an earlier place is left out.
    """
    starts, ends, reach, n = [], [], 0, len(word)
    for p in range(n - SHORTEST_GRAM + 1):
        e = p + SHORTEST_GRAM
        while e < n and e - p < longest and word[p:e] in frequent:
            e += 1
        if e > reach:
            starts.append(p)
            ends.append(e)
            reach = e
    return starts, ends


def affected(starts: list[int], ends: list[int], length: int, longest: int, *, insertion: bool) -> int:
    """The most grams of a word that one edit can keep from being grams of the edited word.

    A replacement or deletion of code point i touches the grams that hold i, and grams behind it that a changed gram, which begins at i at the latest,
    may come to cover: those that end by i + ``longest``. An insertion before i touches the grams around that place and those
    that end before i + ``longest``; one behind the word touches the gram that the word's end has cut short.
    """
    most = 1 if insertion and ends else 0
    for i in range(length):
        first = bisect_right(ends, i)
        if insertion:
            last = max(bisect_right(starts, i - 1), bisect_right(ends, i + longest - 1))
        else:
            last = max(bisect_right(starts, i), bisect_right(ends, i + longest))
        most = max(most, last - first)
    return most


def letter_set(word: str) -> int:
    """The word's code points as bits, modulo 63: one edit changes two bits at most."""
    bits = 0
    for c in word:
        bits |= 1 << ord(c) % 63
    return bits


def index_entries(word: str, frequent: dict[str, int], roles: tuple[int, ...] = (SAME, SHORTER, LONGER)) -> Iterator[tuple[int, int, int, str]]:
    """(role, length of the pair's shorter word, place, gram) under which a word is listed.

    A near word shares all but the affected grams, so the two have one in common among the rarest ``affected`` + 1 of
    each; the longer lists need not be merged. Grams in front of an edit keep their place, those behind an insertion move by one.
    """
    n, done = len(word), 0
    for role in roles:
        shorter = n - (role == LONGER)
        if shorter < LEAST_LENGTH:
            continue
        longest = longest_gram(shorter)
        if longest != done:
            starts, ends = decompose(word, frequent, longest)
            ordered = sorted((frequent.get(word[p:e], 0), word[p:e], p) for p, e in zip(starts, ends, strict=True))
            done = longest
        bound = affected(starts, ends, n, longest, insertion=role == SHORTER)
        for _, gram, p in ordered[: bound + 1]:
            yield role, shorter, p, gram
            if role == SHORTER:
                yield role, shorter, p + 1, gram


def near_words(words: DataFrame, frequent: dict[str, int]) -> DataFrame:
    """``word, near, near_n`` for all words exactly one edit apart, each pair both ways and once, from distinct ``word, n``."""
    shared = words.sparkSession.sparkContext.broadcast(frequent)  # bounded by its share
    names = ("word", "n", "letters", "role", "shorter", "place", "gram")

    def listed(side: str, roles: tuple[int, ...]) -> DataFrame:
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                given = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                yield _columns(names, [(w, n, letter_set(w), *entry) for w, n in given for entry in index_entries(w, shared.value, roles)])

        entries = words.select("word", "n").mapInArrow(task, "word string, n bigint, letters bigint, role int, shorter int, place int, gram string")
        key = F.xxhash64((F.col("role") == SAME).cast("int"), "shorter", "place", "gram")
        return entries.select(key.alias("key"), F.col("word").alias(side), F.col("n").alias(f"{side}_n"), F.col("letters").alias(f"{side}_letters"), F.col("role").alias(f"{side}_role"))

    a, b = listed("a", (SAME, SHORTER)), listed("b", (SAME, LONGER))
    once = (F.col("a_role") != SAME) | (F.col("a") < F.col("b"))
    # Most words met under a gram differ in more letters than one edit can change; few pairs are compared whole.
    alike = F.bit_count(F.col("a_letters").bitwiseXOR(F.col("b_letters"))) <= 2
    # Entries are many times the words, by whose file Spark sizes them: it would broadcast them.
    met = a.join(b.drop("b_role").hint("merge"), (a["key"] == b["key"]) & once & alike & one_edit("a", "b"))
    ways = [F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(f"{y}_n").alias("near_n")) for x, y in ("ab", "ba")]
    return met.select(F.inline(F.array(*ways))).distinct()


def one_edit(a: str, b: str) -> Column:
    """Whether two words are exactly one edit apart."""
    return F.levenshtein(F.col(a), F.col(b), 1) == 1


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``occurrences``.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word with the most occurrences, ties to
    the smallest in code-point order, if it has ten times the word's or more, else null; the root is reached by following
    forms to the last, and is the word itself without a form. Repeated rows count as often as they stand; an empty table, or one of
    null and empty texts, gives no rows; columns besides ``doc_id`` and ``text`` are ignored. Letter runs of any length are words.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    scratch = Scratch(spark)
    words = scratch.keep(occurrences(docs), "words")
    near = near_words(words, frequent_grams(words))
    # UTF-8 order is code-point order; the least of negated counts and words is the best.
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best"))
    near = scratch.keep(best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n")), "near")
    has = F.col("near_n") >= FORM_RATIO * F.col("n")
    # The kept tables grow with the texts and their files are compressed, so Spark takes them for small: never a broadcast of one.
    judged = words.join(near.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(has, F.col("near")).alias("form"), F.when(has, F.col("near_n")).alias("form_n"))
    judged = scratch.keep(judged, "judged")
    roots = _roots(judged, scratch)
    out = judged.join(roots.hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(judged: DataFrame, scratch: Scratch) -> DataFrame:
    """``word, root`` of the words with a form. Every step multiplies the occurrences by ten, so few steps lead to the last; each round doubles them."""
    roots = judged.filter("form is not null").select("word", F.col("form").alias("root"))
    most = judged.agg(F.max("n")).first()[0] or 0
    steps, covered = 0, 1
    while LEAST_COUNT * FORM_RATIO ** (steps + 1) <= most:
        steps += 1
    while covered < steps:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = scratch.keep(roots.join(further.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        covered *= 2
    return roots


def _columns(names: tuple[str, ...], rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"word": pa.string(), "gram": pa.string(), "n": pa.int64(), "letters": pa.int64(), "role": pa.int32(), "shorter": pa.int32(), "place": pa.int32()}
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for k, c in zip(names, columns, strict=True)], names=list(names))
