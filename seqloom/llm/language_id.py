"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .resident import remembered
from .scratch import Scratch, bounded_batches
from .words import mix, text_buffer

ORDER = 5
#: Labelled documents of each language that a model is fitted on, about; all of them calibrate the rejection, by cross-fitting.
TRAINING_DOCS = 2000
#: Words whose scores a worker remembers at most; beyond it the half that was met least is forgotten.
MEMORY_WORDS = 250_000
#: Words scored at a time; bounds the temporary arrays.
LEARNT_WORDS = 8192
#: Parts of the sample. The model is fitted on all of them; for the calibration each part is scored by a model fitted without it.
FOLDS = 5
#: Rejected: cross-entropy farther above the language's usual one than this many times the limit, which is a high quantile of the
#: calibration documents' deviations (the farthest where they are few), at least four.
REJECT_MARGIN = 1.25
REJECT_QUANTILE = 0.995
#: Documents that the variance pooled over the languages counts as, beside those of a language.
POOLED_DOCS = 20
PAD, END = "\x02", "\x03"
UNKNOWN = "und"

_U = np.uint64
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[97:123] = _IN_WORD[128:] = True


def letter_runs(word: bytes) -> list[str]:
    """Lower-cased runs of letters with their marks in one blank-free word."""
    text = word.decode("utf-8").lower()
    if text.isalpha():
        return [text]
    import regex

    return regex.findall(r"\p{L}[\p{L}\p{M}]*", text)


def words_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of a column of texts, index of each text's first word with the total appended).

    A word is a run of ASCII letters, lower-cased, and of characters beyond ASCII: no run of letters with their marks crosses its ends.
    """
    data, offsets = text_buffer(column)
    data = _LOWER[data]
    inside = _IN_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    begins[at] = inside[at]  # a word never crosses texts
    first = np.searchsorted(starts := np.flatnonzero(begins), offsets)
    lengths = np.add.reduceat(inside, starts, dtype=np.int64) if len(starts) else np.zeros(0, np.int64)
    bounds = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data[inside])]), first


def _extend(hashes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Hashes of grams with one more character in front."""
    return mix(hashes * _U(0x9E3779B97F4A7C15) + before.astype(np.uint64) + _U(1))


def _gram_hashes(grams: list[str], k: int) -> np.ndarray:
    out = np.zeros(len(grams), np.uint64)
    if k:
        codes = np.frombuffer("".join(grams).encode("utf-32-le"), np.uint32).reshape(-1, k)
        for j in range(k - 1, -1, -1):
            out = _extend(out, codes[:, j])
    return out


@dataclass
class Model:
    """Per order, sorted gram hashes with the log-probability in every language, and context hashes with log back-off weights."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    contexts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    floor: float = 0.0
    calibration: np.ndarray | None = None  # by language: mean, variance between texts, variance of one character, limit

    def compact(self) -> Model:
        """This model with tables in single precision, as it is shipped."""
        self.grams, self.contexts = ([(keys, values.astype(np.float32)) for keys, values in tables] for tables in (self.grams, self.contexts))
        return self

    def score(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word, its end included, in each language."""
        n = len(self.grams)
        text = "".join(PAD * (n - 1) + w + END for w in words)
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        length = np.fromiter(map(len, words), np.int64, len(words)) + n
        at = np.cumsum(length) - length
        scored = np.ones(len(codes), bool)
        for j in range(n - 1):
            scored[at + j] = False
        place = np.flatnonzero(scored)
        hashes = [np.zeros(len(codes), np.uint64)]
        for k in range(1, n + 1):
            h = np.zeros(len(codes), np.uint64)
            h[k - 1 :] = _extend(hashes[-1][k - 1 :], codes[: len(codes) - k + 1])
            hashes.append(h)
        total = np.zeros((len(place), len(self.languages)))
        left = np.arange(len(place))
        for k in range(n, 0, -1):
            keys, values = self.grams[k - 1]
            want = hashes[k][place[left]]
            row = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            found = keys[row] == want
            total[left[found]] += values[row[found]]
            left = left[~found]
            if not len(left):
                break
            keys, values = self.contexts[k - 1]
            want = hashes[k - 1][place[left] - 1]
            row = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            found = keys[row] == want
            total[left[found]] += values[row[found]]
        total[left] += self.floor
        return np.add.reduceat(total, np.concatenate([[0], np.cumsum(length - n + 1)[:-1]])) if words else np.zeros((0, len(self.languages)))


def kneser_ney(counts: Mapping[str, Mapping[str, int] | pd.Series], order: int) -> Model:
    """Fit from counts of ``order``-grams by language; lower orders use continuation counts."""
    model = Model(sorted(counts))
    if not counts:
        return model
    letters = {c for grams in counts.values() for g in grams.keys() for c in g}
    model.floor = -math.log(len(letters) + 1)
    per_language = []
    for language in model.languages:
        c = pd.Series(counts[language], dtype="float64")
        by_order = {order: c}
        for k in range(order - 1, 0, -1):
            c = pd.Series(1.0, index=c.index.str[1:]).groupby(level=0).sum()
            by_order[k] = c
        lower, orders = pd.Series({"": math.exp(model.floor)}), []
        for k in range(1, order + 1):
            c = by_order[k]
            once, twice = float((c == 1).sum()), float((c == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            context = c.index.str[:-1]
            groups = c.groupby(context)
            total, kinds = groups.sum(), groups.size()
            weight = discount * kinds / total
            p = (c - discount).clip(lower=0) / total.reindex(context).to_numpy() + weight.reindex(context).to_numpy() * lower.reindex(c.index.str[1:]).to_numpy()
            orders.append((p, weight))
            lower = p
        per_language.append(orders)
    lower_index, lower_values = pd.Index([""]), np.full((1, len(model.languages)), model.floor)
    for k in range(1, order + 1):
        contexts = pd.Index(sorted({c for o in per_language for c in o[k - 1][1].index}))
        weights = np.column_stack([np.log(o[k - 1][1].reindex(contexts).fillna(1.0).to_numpy()) for o in per_language])
        grams = pd.Index(sorted({g for o in per_language for g in o[k - 1][0].index}))
        backed = weights[contexts.get_indexer(grams.str[:-1])] + lower_values[lower_index.get_indexer(grams.str[1:])]
        own = np.column_stack([o[k - 1][0].reindex(grams).to_numpy() for o in per_language])
        values = np.where(np.isnan(own), backed, np.log(np.where(np.isnan(own), 1.0, own)))
        for out, index, table, size in ((model.grams, grams, values, k), (model.contexts, contexts, weights, k - 1)):
            h = _gram_hashes(list(index), size)
            by = np.argsort(h)
            out.append((h[by], table[by]))
        lower_index, lower_values = grams, values
    return model


class Scorer:
    """Log-likelihoods of whole texts; scores of words seen before are remembered."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((1 << 12, len(self.model.languages) + 1))
        self.met = np.zeros(1 << 12, np.int64)  # batches that held the word

    def _forget_rare(self) -> None:
        """Keep the half of the words that most batches held."""
        kept = np.argsort(-self.met[: len(self.known)], kind="stable")[: MEMORY_WORDS // 2]
        words = list(self.known)
        self.known = {words[i]: k for k, i in enumerate(kept.tolist())}
        self.table[: len(kept)], self.met[: len(kept)] = self.table[kept], self.met[kept]

    def _learn(self, new: list[bytes]) -> None:
        pieces = [letter_runs(w) for w in new]
        flat = [p for ps in pieces for p in ps]
        n = len(self.known)
        while len(self.table) < n + len(new):
            self.table, self.met = np.concatenate([self.table, np.zeros_like(self.table)]), np.concatenate([self.met, np.zeros_like(self.met)])
        rows = np.zeros((len(new), self.table.shape[1]))
        if flat:
            count = np.fromiter(map(len, pieces), np.int64, len(pieces))
            some = np.flatnonzero(count)
            scored = np.column_stack([self.model.score(flat), np.fromiter(map(len, flat), np.int64, len(flat)) + 1])
            rows[some] = np.add.reduceat(scored, (np.cumsum(count) - count)[some])
        self.table[n : n + len(new)], self.met[n : n + len(new)] = rows, 0
        self.known.update(zip(new, range(n, n + len(new)), strict=True))

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood of every text in every language, characters scored); zero characters where a text has no letter."""
        words, first = words_of(column)
        out = np.zeros((len(first) - 1, self.table.shape[1]))
        if not len(words):
            return out[:, :-1], out[:, -1]
        coded = pc.dictionary_encode(words)
        different = coded.dictionary.to_pylist()
        if len(self.known) + len(different) > MEMORY_WORDS:
            self._forget_rare()
        if len(self.known) + len(different) > MEMORY_WORDS:
            self._forget()
        new = [w for w in different if w not in self.known]
        for i in range(0, len(new), LEARNT_WORDS):
            self._learn(new[i : i + LEARNT_WORDS])
        places = np.fromiter(map(self.known.__getitem__, different), np.int64, len(different))
        self.met[places] += 1
        row = places[coded.indices.to_numpy(zero_copy_only=False)]
        some = np.flatnonzero(np.diff(first))
        out[some] = np.add.reduceat(self.table[row], first[some])
        return out[:, :-1], out[:, -1]


def _scorer(broadcast) -> Scorer:
    """The Python worker's scorer of a broadcast model."""
    model = broadcast.value
    return remembered(("languages", id(model)), lambda: Scorer(model))


def _sampled(docs: DataFrame, per_language: int) -> DataFrame:
    """About ``per_language`` labelled documents of each language, by a hash of the id: no language is drawn more than another."""
    sizes = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    share = F.create_map(*[x for lang, n in sizes.items() for x in (F.lit(lang), F.lit(min(1.0, per_language / n)))]) if sizes else F.create_map()
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = docs.filter(place < F.element_at(share, F.col("lang"))) if sizes else docs.limit(0)
    return chosen.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int"))


def train(docs: DataFrame, *, order: int = ORDER, per_language: int = TRAINING_DOCS) -> Model:
    """Fit on rows of ``doc_id, text, lang``; rows with a null doc_id, text or lang teach nothing.

    The fit sees about ``per_language`` documents of each language, chosen by a hash of the id (a documented bound of
    the classifier's training sample); their n-grams are counted in Spark, and the counts, which are bounded with the sample,
    make the model on the driver. The limits of rejection come from the whole sample too: each fifth is
    scored by a model fitted on the others, one such model at a time, so that a rare language is calibrated like any other. A language
    whose documents all lie in one fifth is learnt; its documents are then calibrated as those of the others they look like.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    labelled = docs.select(F.col("doc_id").cast("bigint"), "text", "lang").filter("doc_id is not null and text is not null and lang is not null")
    scratch = Scratch(spark)
    sample = scratch.keep(_sampled(labelled, per_language), "sample")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = pa.table({"lang": batch.column(1), "fold": batch.column(2), "word": pc.utf8_split_whitespace(batch.column(0))})
            words = pc.list_flatten(frame["word"])
            parent = pc.list_parent_indices(frame["word"])
            keys = {"fold": frame["fold"].take(parent), "lang": frame["lang"].take(parent)}
            seen = pa.table({**keys, "word": words}).group_by(["fold", "lang", "word"]).aggregate([([], "count_all")]).to_pandas()
            total: dict[tuple[int, str, str], int] = {}
            for fold, lang, word, n in zip(seen["fold"], seen["lang"], seen["word"], seen["count_all"], strict=True):
                for run in letter_runs(word.encode("utf-8")):
                    padded = PAD * (order - 1) + run + END
                    for i in range(len(run) + 1):
                        key = (fold, lang, padded[i : i + order])
                        total[key] = total.get(key, 0) + n
            folds_, langs_, grams_ = zip(*total, strict=True) if total else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(folds_, pa.int32()), pa.array(langs_, pa.string()), pa.array(grams_, pa.string()), pa.array(list(total.values()), pa.int64())],
                names=["fold", "lang", "gram", "n"],
            )

    fitted = sample.select("text", "lang", "fold").mapInArrow(grams, "fold int, lang string, gram string, n bigint")
    # A gram of a language in one row: its counts by fold.
    by_fold = fitted.groupBy("lang", "gram").agg(*[F.sum(F.when(F.col("fold") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(FOLDS)])
    counted = by_fold.toPandas()  # bounded with the sample
    model = kneser_ney(_counts(counted, None), order).compact()
    if model.languages:
        scored = [_cross_fitted(sample, k, kneser_ney(_counts(counted, k), order).compact()) for k in range(FOLDS)]
        model.calibration = _calibrate(model, pd.concat(scored, ignore_index=True))
    scratch.drop("sample")
    return model


def _counts(counted: pd.DataFrame, without: int | None) -> dict[str, pd.Series]:
    """By language the counts of the grams, those of one fold taken off."""
    n = sum(counted[f"n{k}"] for k in range(FOLDS) if k != without)
    some = counted.loc[n > 0, ["lang", "gram"]].assign(n=n[n > 0])
    return {lang: pd.Series(own["n"].to_numpy(), index=pd.Index(own["gram"].to_numpy(dtype=object))) for lang, own in some.groupby("lang")}


def _cross_fitted(sample: DataFrame, fold: int, model: Model) -> pd.DataFrame:
    """``lang_pred, entropy, characters`` of one fold's texts with letters, by the model fitted without it."""
    shared = sample.sparkSession.sparkContext.broadcast(model)  # bounded with the sample
    languages = np.array([*model.languages, UNKNOWN], dtype=object)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            best, _, entropy, n, _ = _judged(scorer, len(languages) - 1, None, 1.0, batch.column(0))
            some = np.flatnonzero(n)
            columns = [pa.array(languages[best[some]], pa.string()), pa.array(entropy[some]), pa.array(n[some])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang_pred", "entropy", "characters"])

    own = sample.filter(F.col("fold") == fold).select("text")
    if not model.languages:
        own = own.limit(0)
    scored = own.mapInArrow(task, "lang_pred string, entropy double, characters bigint").toPandas()  # bounded with the sample
    shared.destroy()  # one such model at a time in the workers
    return scored


def _spread(squares: np.ndarray, n: np.ndarray, between: float, single: float, weight: float) -> tuple[float, float]:
    """Variance between texts, from the longer ones, and of one character, from the shorter; the given ones count as ``weight`` texts."""
    long = n >= np.median(n)
    between = max(float(squares[long].sum() + weight * between) / (long.sum() + weight), 1e-4)
    short = (np.maximum(squares - between, 0) * n)[~long]
    return between, max(float(short.sum() + weight * single) / max(len(short) + weight, 1), 1e-2)


def _calibrate(model: Model, scored: pd.DataFrame) -> np.ndarray:
    """By language: mean, variances and limit, by one rule for any number of texts; every limit is finite.

    The variances are drawn towards those pooled over the languages and widened by what a mean of few texts may be off. A language that no
    text was assigned to is left with the cross-entropy of guessing letters as its mean.
    """
    entropy, n = scored["entropy"].to_numpy(), scored["characters"].to_numpy()
    rows = {language: np.flatnonzero((scored["lang_pred"] == language).to_numpy()) for language in scored["lang_pred"].unique()}
    mean = {language: float(np.average(entropy[own], weights=n[own])) for language, own in rows.items()}
    squares = (entropy - scored["lang_pred"].map(mean).to_numpy(float)) ** 2
    pooled = _spread(squares, n, 0.0, 0.0, 0.0) if len(n) else (1e-2, 1.0)
    out = np.tile([-model.floor, *pooled, 4.0], (len(model.languages), 1))
    for i, language in enumerate(model.languages):
        own = rows.get(language)
        if own is None:
            continue
        between, single = (v * (1 + 1 / len(own)) for v in _spread(squares[own], n[own], *pooled, POOLED_DOCS))
        away = (entropy[own] - mean[language]) / np.sqrt(between + single / n[own])
        out[i] = mean[language], between, single, max(float(np.quantile(away, REJECT_QUANTILE, method="higher")), 4.0)
    return out


def _judged(scorer: Scorer | None, languages: int, limits: np.ndarray | None, margin: float, column: pa.Array) -> tuple[np.ndarray, ...]:
    """(index of the language, score, cross-entropy, characters, rejected) of every text."""
    rows = len(column)
    best, score, entropy, n, reject = np.full(rows, languages), np.zeros(rows), np.full(rows, np.nan), np.zeros(rows), np.ones(rows, bool)
    if scorer and rows:
        loglik, n = scorer.texts(column)
        some = np.flatnonzero(n)
        best[some] = loglik[some].argmax(axis=1)
        top = loglik[some, best[some]]
        entropy[some] = -top / n[some]
        score[some] = 1 / np.exp(np.maximum(loglik[some] - top[:, None], -700)).sum(axis=1)
        reject[some] = False
        if limits is not None:
            mean, between, single, farthest = limits[best[some]].T
            away = (entropy[some] - mean) / np.sqrt(between + single / n[some]) / (margin * farthest)
            reject[some] = away > 1
            score[some] *= 1 / (1 + np.exp(np.clip(8 * (away - 1), -700, 700)))
    return best, score, entropy, n.astype(np.int64), reject


def classify(docs: DataFrame, model: Model, *, raw: bool = False, margin: float = REJECT_MARGIN) -> DataFrame:
    """``doc_id, lang_pred, score, entropy, characters, rejected`` of every row, in input order and without a shuffle.

    The language with the lowest cross-entropy per character over the whole text wins, ties to the first by name. ``score`` is its posterior against
    the other languages, lowered as the cross-entropy nears the limit of rejection. A null text or one without letters, or a
    model without languages, gives ``und`` with score 0, rejected. Null or repeated ids make no difference. ``raw`` leaves the limits out.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded with the training sample
    languages = np.array([*model.languages, UNKNOWN], dtype=object)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared) if shared.value.languages else None
        for batch in batches:
            best, score, entropy, n, reject = _judged(scorer, len(languages) - 1, None if raw else shared.value.calibration, margin, batch.column(1))
            columns = [batch.column(0), pa.array(languages[best], pa.string()), pa.array(score), pa.array(entropy, from_pandas=True), pa.array(n), pa.array(reject)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score", "entropy", "characters", "rejected"])

    schema = "doc_id bigint, lang_pred string, score double, entropy double, characters bigint, rejected boolean"
    return docs.select(docs["doc_id"].cast("bigint"), docs["text"]).mapInArrow(task, schema)


def accepted(docs: DataFrame, model: Model, *, margin: float = REJECT_MARGIN) -> DataFrame:
    """The rows of ``docs``, all columns, that ``classify`` does not reject."""
    spark = docs.sparkSession
    bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared) if shared.value.languages else None
        for batch in batches:
            reject = _judged(scorer, len(shared.value.languages), shared.value.calibration, margin, batch.column(at))[-1]
            yield batch.filter(pa.array(~reject))

    return docs.mapInArrow(task, docs.schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))
