"""Read quality-control aggregates.

Base-level statistics count (group, value) pairs first, so the shuffle carries counts of small
domains (qualities, bases, k-mers), never bases.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import bases, kmers as kmer_numbers
from ..functions.joins import join_small
from ..options import choice, fail_when

def _n() -> Column:
    return F.count(F.lit(1)).alias("n")


def _parts(pdf: pd.DataFrame, by: list[str], text: str) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """Groups of a batch, cut further so that very long reads do not widen the others' matrix."""
    for key, group in pdf.groupby(by, sort=False):
        for rows in bases.even_slices(bases.text_lengths(group[text])):
            yield key, group.iloc[rows]


def _base_counts(batches: Iterator[pd.DataFrame], base: int) -> Iterator[pd.DataFrame]:
    """Count (sample, mate, cycle, quality, base) per Arrow batch, so bases never become rows."""
    for pdf in batches:
        pdf = pdf[pdf["qual"].str.len().fillna(0) > 0]
        if not len(pdf):
            continue
        for (sample, mate), part in _parts(pdf, ["sample", "mate"], "qual"):
            seq, _ = bases.byte_matrix(part["seq"].str.upper())
            qual, _ = bases.byte_matrix(part["qual"])
            width = min(seq.shape[1], qual.shape[1])
            cell = (np.arange(width) << 16) + (qual[:, :width].astype(np.int64) << 8) + seq[:, :width]
            keys, n = np.unique(cell[qual[:, :width] != 0], return_counts=True)
            yield pd.DataFrame(
                {
                    "sample": sample, "mate": mate, "cycle": (keys >> 16) + 1, "q": ((keys >> 8) & 255) - base,
                    "base": [chr(c) for c in keys & 255], "n": n,
                }
            )


def _kmer_counts(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    """Count k-mers per sample and Arrow batch; a k-mer is a number in the alphabet of the batch."""
    for pdf in batches:
        pdf = pdf[pdf["seq"].str.len().fillna(0) >= k]
        for (sample,), part in _parts(pdf, ["sample"], "seq"):
            text, lengths = bases.byte_matrix(part["seq"])
            alphabet = np.unique(text)
            alphabet = alphabet[alphabet != 0]
            digit = np.zeros(256, np.int64)
            digit[alphabet] = np.arange(len(alphabet))
            codes = digit[text]
            width = text.shape[1] - k + 1
            number = np.zeros((len(part), width), np.int64)
            for j in range(k):
                number = number * len(alphabet) + codes[:, j : j + width]
            number = number[np.arange(width) < (lengths - k + 1)[:, None]]
            if len(alphabet) ** k <= 1 << 22:
                counts = np.bincount(number)
                keys = np.flatnonzero(counts)
                n = counts[keys]
            else:
                keys, n = np.unique(number, return_counts=True)
            letters = np.empty((len(keys), k), np.uint8)
            rest = keys.copy()
            for j in range(k - 1, -1, -1):
                letters[:, j] = alphabet[rest % len(alphabet)]
                rest //= len(alphabet)
            names = letters.reshape(-1).view(f"S{k}").astype(str)
            yield pd.DataFrame({"sample": sample, "kmer": names, "n": n})


def cycle_quality_stats(reads: DataFrame, *, base: int = 33) -> DataFrame:
    """Per sample, mate and cycle: count, min, max, sum, mean, quartiles and base counts."""
    counted = reads.select("sample", F.col("mate").cast("int").alias("mate"), "seq", "qual").mapInPandas(
        lambda batches: _base_counts(batches, base), "sample string, mate int, cycle int, q int, base string, n bigint"
    )
    per_value = counted.groupBy("sample", "mate", "cycle", "q", "base").agg(F.sum("n").alias("n"))
    quartiles = F.percentile("q", [0.25, 0.5, 0.75], F.col("n"))
    stats = per_value.groupBy("sample", "mate", "cycle").agg(
        F.sum("n").alias("all_count"),
        F.min("q").alias("min_q"),
        F.max("q").alias("max_q"),
        F.sum(F.col("q") * F.col("n")).alias("sum_q"),
        quartiles.alias("qs"),
        *[F.sum(F.when(F.col("base") == b, F.col("n")).otherwise(0)).alias(f"{b.lower()}_count") for b in "ACGTN"],
    )
    return stats.select(
        "sample", "mate", "cycle", "all_count", "min_q", "max_q", "sum_q",
        (F.col("sum_q") / F.col("all_count")).alias("mean_q"),
        F.col("qs")[0].alias("q1"), F.col("qs")[1].alias("median_q"), F.col("qs")[2].alias("q3"),
        *[f"{b}_count" for b in "acgtn"],
    )


def kmer_content(reads: DataFrame, *, k: int = 7) -> DataFrame:
    """Occurrences of every k-mer per sample."""
    choice("k", k, range(2, 11))
    counted = reads.select("sample", "seq").mapInPandas(lambda b: _kmer_counts(b, k), "sample string, kmer string, n bigint")
    return counted.groupBy("sample", "kmer").agg(F.sum("n").alias("n"))


def _named(pairs: Sequence[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(s).alias("seq")) for n, s in pairs])


def overrepresented(
    reads: DataFrame, *, contaminants: Sequence[tuple[str, str]] = (), min_fraction: float = 0.001
) -> DataFrame:
    """Sequences making up at least ``min_fraction`` of a sample, with the first contaminant they match."""
    per_seq = reads.groupBy("sample", "seq").agg(_n())
    # One row per sample, counted apart: joined by shuffle the sequences of a sample would meet in one task.
    totals = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("total"))
    out = join_small(per_seq, totals, "sample").withColumn("fraction", F.col("n") / F.col("total"))
    out = out.filter(F.col("fraction") >= min_fraction).drop("total")
    if not contaminants:
        return out.withColumn("source", F.lit("No Hit"))
    seq = F.col("seq")
    hits = F.filter(_named(contaminants), lambda c: F.contains(seq, c["seq"]) | ((F.length(seq) > 0) & F.contains(c["seq"], seq)))
    return out.withColumn("source", F.coalesce(F.get(hits, F.lit(0))["name"], F.lit("No Hit")))


def adapter_content(reads: DataFrame, adapters: Sequence[tuple[str, str]]) -> DataFrame:
    """Share of reads whose adapter starts at or before each position where some adapter starts."""
    if not adapters:
        raise ValueError("no adapters given")
    totals = reads.groupBy("sample").agg(F.count(F.lit(1)).alias("total"))
    hits = (
        reads.select("sample", "seq", F.inline(_named(adapters)).alias("adapter", "pattern"))
        .select("sample", "adapter", F.instr("seq", F.col("pattern")).alias("position"))
        .filter("position > 0")
        .groupBy("sample", "adapter", "position")
        .agg(_n())
    )
    upto = Window.partitionBy("sample", "adapter").orderBy("position")
    return (
        hits.withColumn("seen", F.sum("n").over(upto))
        .join(totals, "sample")
        .select("sample", "adapter", "position", "n", "seen", (100.0 * F.col("seen") / F.col("total")).alias("percent"))
    )


def qc_verdict(metrics: DataFrame, limits: DataFrame) -> DataFrame:
    """``pass``, ``warn`` or ``fail`` per metric; modules switched off in ``limits`` disappear.

    ``metrics``: (sample, module, value); ``limits``: (module, warn, error, ignore, higher_is_worse).
    """
    j = metrics.join(limits, "module").filter(~F.col("ignore"))
    worse = F.col("higher_is_worse")
    fail = F.when(worse, F.col("value") > F.col("error")).otherwise(F.col("value") < F.col("error"))
    warn = F.when(worse, F.col("value") > F.col("warn")).otherwise(F.col("value") < F.col("warn"))
    return j.select(
        "sample", "module", "value", F.when(fail, "fail").when(warn, "warn").otherwise("pass").alias("verdict")
    )


def read_gc(reads: DataFrame) -> DataFrame:
    """Histogram of whole GC percentages; empty reads are left out."""
    gc = F.length("seq") - F.length(F.translate("seq", "GCgc", ""))
    percent = F.floor(100 * gc / F.length("seq")).cast("int")
    return reads.filter(F.length("seq") > 0).groupBy("sample", percent.alias("gc_percent")).agg(_n())


def read_length_hist(reads: DataFrame) -> DataFrame:
    return reads.groupBy("sample", "mate", F.length("seq").alias("length")).agg(_n())


def read_duplication(df: DataFrame, *, by: str = "seq") -> DataFrame:
    """How many sequences (or positions) occur k times."""
    choice("by", by, ("seq", "pos"))
    key = ["sample", "seq"] if by == "seq" else ["sample", "rname", "pos", "cigar", "strand"]
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrence"))
    return per_key.groupBy("sample", "occurrence").agg(_n())


#: Bits of the filter over a genome's k-mers at most (16 MB); a larger genome is joined without one.
MOST_FILTER_BITS = 1 << 27
#: Bytes of a table of every possible k-mer at most; with more (five to twelve letters, by the number of sets) k-mers are joined.
MOST_TABLE_BYTES = 1 << 26


def _kmer_length(k: int) -> None:
    if not 0 < k <= kmer_numbers.LONGEST:
        raise ValueError(f"k must be 1 to {kmer_numbers.LONGEST}")


def _genome_pieces(genome: DataFrame, k: int) -> DataFrame:
    """(rname, text): chunks with the next chunk's head, which completes the k-mers at their edge."""
    head = genome.select("rname", F.col("start").alias("next"), F.substr("seq", F.lit(1), F.lit(k - 1)).alias("head"))
    whole = genome.withColumn("next", F.col("start") + F.length("seq")).join(head, ["rname", "next"], "left")
    return whole.select("rname", F.concat("seq", F.coalesce("head", F.lit(""))).alias("text"))


def _named_pieces(genome: DataFrame, k: int, names: Sequence[str]) -> DataFrame:
    """(bit, text) of the named sequences."""
    bit = F.element_at(F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, 1 << i)]), F.col("rname")).cast("bigint")
    return _genome_pieces(genome, k).select(bit.alias("bit"), "text").filter("bit is not null")


def genome_kmers(genome: DataFrame, *, k: int, names: Sequence[str]) -> DataFrame:
    """(kmer, mask): bit i of the mask is set when the k-mer occurs in sequence set ``names[i]``.

    ``genome`` holds chunks (rname, start, seq). A k-mer is a 64-bit number (:mod:`seqloom.functions.kmers`); those with other letters than ``ACGTN`` are left out.
    """
    _kmer_length(k)
    pieces = _named_pieces(genome, k, names)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in kmer_numbers.distinct_kmers(batch.column(1), k):
                yield pa.RecordBatch.from_arrays([pa.array(values), batch.column(0).take(pa.array(rows))], names=["kmer", "bit"])

    return pieces.mapInArrow(task, "kmer bigint, bit bigint").groupBy("kmer").agg(F.bit_or("bit").alias("mask"))


def kmer_filter(genome: DataFrame, *, k: int, names: Sequence[str]) -> kmer_numbers.Bloom | None:
    """Bloom filter over the k-mers of the named sequences with eight bits or more for each, by two small jobs; none if that takes too many bits."""
    _kmer_length(k)
    named = genome.filter(F.col("rname").isin(*names))
    places = named.agg(F.sum(F.length("seq")).alias("n")).first()["n"] or 0
    bits = 1 << max(16, (8 * places - 1).bit_length())
    if bits > MOST_FILTER_BITS:
        return None

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = kmer_numbers.Bloom(bits)
        for batch in batches:
            for _, values in kmer_numbers.distinct_kmers(batch.column(0), k):
                part.add(values)
        at = np.flatnonzero(part.words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(part.words[at].view(np.int64))], names=["word", "bits"])

    words = _genome_pieces(named, k).select("text").mapInArrow(task, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    whole = kmer_numbers.Bloom(bits)
    for part in words.toArrow().to_batches():  # one row per word of the filter at most
        whole.words[part.column(0).to_numpy()] = part.column(1).to_numpy().view(np.uint64)
    return whole


def kmer_table(genome: DataFrame, *, k: int, names: Sequence[str]) -> np.ndarray | None:
    """Mask of sequence sets of every possible k-mer, by its number, by one job; none if that takes more than ``MOST_TABLE_BYTES``.

    Its size does not depend on the genome's; a task sends the words of eight bytes that it has set.
    """
    _kmer_length(k)
    kind = np.dtype(f"u{next(b for b in (1, 2, 4, 8) if len(names) <= 8 * b)}")
    size = len(kmer_numbers.LETTERS) ** k
    if size * kind.itemsize > MOST_TABLE_BYTES:
        return None
    size = -(-size // 8) * 8

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = np.zeros(size, kind)
        for batch in batches:
            bits = batch.column(0).to_numpy(zero_copy_only=False)
            for rows, values in kmer_numbers.distinct_kmers(batch.column(1), k):
                found = bits[rows]
                for bit in np.unique(found):
                    part[values[found == bit]] |= kind.type(bit)
        words = part.view(np.int64)
        at = np.flatnonzero(words)
        for i in range(0, len(at), 1 << 18):
            some = at[i : i + (1 << 18)]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(words[some])], names=["word", "bits"])

    words = _named_pieces(genome, k, names).mapInArrow(task, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    whole = np.zeros(size, kind)
    for part in words.toArrow().to_batches():  # one row per word of the table at most
        whole.view(np.int64)[part.column(0).to_numpy()] = part.column(1).to_numpy()
    return whole


def _set_counts(batch: pa.RecordBatch, column: int, table: np.ndarray, n_sets: int, k: int) -> np.ndarray:
    """Different k-mers of each row found in each set, (sets, rows)."""
    counts = np.zeros((n_sets, batch.num_rows), np.int32)
    for rows, values in kmer_numbers.distinct_kmers(batch.column(column), k):
        masks = table[values]
        met = masks != 0
        rows, masks = rows[met], masks[met]
        if not len(rows):
            continue
        low = rows[0]
        for i in range(n_sets):
            n = np.bincount(rows[(masks >> masks.dtype.type(i)) & masks.dtype.type(1) != 0] - low)
            counts[i, low : low + len(n)] += n.astype(np.int32)
    return counts


def _looked_up(reads: DataFrame, shared, n_sets: int, k: int) -> DataFrame:
    """``sample, read_idx, mate`` and the counts ``_n0, _n1, ...`` of the reads that share a k-mer with a set; k-mers never leave their task."""
    names = [f"_n{i}" for i in range(n_sets)]
    schema = reads.select("sample", "read_idx", "mate").schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = _set_counts(batch, 3, shared.value, n_sets, k)
            some = np.flatnonzero(counts.any(axis=0))
            taken = pa.array(some)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(taken) for i in range(3)), *(pa.array(c[some]) for c in counts)], names=["sample", "read_idx", "mate", *names]
            )

    for name in names:
        schema = schema.add(name, T.IntegerType())
    return reads.select("sample", "read_idx", "mate", "seq").mapInArrow(task, schema)


def _without_own_hit(reads: DataFrame, shared, n_sets: int, k: int, min_kmers: int) -> DataFrame:
    """Reads that are not told to hit a set by their own k-mers, or whose key holds a null and so equals no other."""
    place, keys = reads.columns.index("seq"), [reads.columns.index(c) for c in ("sample", "read_idx", "mate")]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = ~(_set_counts(batch, place, shared.value, n_sets, k) >= min_kmers).any(axis=0)
            for i in keys:
                kept |= batch.column(i).is_null().to_numpy(zero_copy_only=False)
            yield batch.filter(pa.array(kept))

    return reads.mapInArrow(task, reads.schema)


def candidate_kmers(reads: DataFrame, *, k: int, screen: kmer_numbers.Bloom | None) -> DataFrame:
    """``sample, read_idx, mate, kmer``: each k-mer of a read once, without those that the filter rules out."""
    _kmer_length(k)
    shared = None if screen is None else reads.sparkSession.sparkContext.broadcast(screen)  # of bounded size
    ids = reads.select("sample", "read_idx", "mate")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, values in kmer_numbers.distinct_kmers(batch.column(3), k):
                if shared is not None:
                    some = shared.value.may_hold(values)
                    rows, values = rows[some], values[some]
                taken = pa.array(rows)
                yield pa.RecordBatch.from_arrays([*(batch.column(i).take(taken) for i in range(3)), pa.array(values)], names=["sample", "read_idx", "mate", "kmer"])

    return reads.select("sample", "read_idx", "mate", "seq").mapInArrow(task, ids.schema.add("kmer", T.LongType()))


def _subset(reads: DataFrame, subset: int | None) -> DataFrame:
    if subset is None:
        return reads
    from .reads import sample_reads

    return sample_reads(reads, n=subset)


def _shared_table(reads: DataFrame, genome: DataFrame, names: Sequence[str], k: int):
    if not 0 < len(names) <= 62:
        raise ValueError("give 1 to 62 sequence sets")
    table = kmer_table(genome, k=k, names=names)
    return None if table is None else reads.sparkSession.sparkContext.broadcast(table)  # of bounded size


def _hit_masks(reads: DataFrame, genome: DataFrame, shared, *, names: Sequence[str], k: int = 21, min_kmers: int = 1) -> DataFrame:
    """``sample, read_idx, mate, mask`` of the reads with a hit.

    With the ``shared`` table of all k-mers reads are looked up where they are; else k-mers are joined, and those found in no set hardly ever leave their task.
    """
    if shared is not None:
        per_read = _looked_up(reads, shared, len(names), k).groupBy("sample", "read_idx", "mate").agg(*[F.sum(f"_n{i}").alias(f"_n{i}") for i in range(len(names))])
    else:
        pieces = candidate_kmers(reads, k=k, screen=kmer_filter(genome, k=k, names=names))
        hits = pieces.join(genome_kmers(genome, k=k, names=names), "kmer")
        per_read = hits.groupBy("sample", "read_idx", "mate").agg(
            *[F.sum(F.when(F.col("mask").bitwiseAND(F.lit(1 << i)) != 0, 1).otherwise(0)).alias(f"_n{i}") for i in range(len(names))]
        )
    mask = reduce(
        lambda a, b: a.bitwiseOR(b),
        [F.when(F.col(f"_n{i}") >= min_kmers, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(len(names))],
    )
    return per_read.select("sample", "read_idx", "mate", mask.cast("bigint").alias("mask")).filter("mask <> 0")


def screen_reads(
    reads: DataFrame, genome: DataFrame, *, names: Sequence[str], subset: int | None = None, k: int = 21, min_kmers: int = 1
) -> DataFrame:
    """Per read the mask of sequence sets sharing at least ``min_kmers`` distinct ``k``-mers."""
    reads = _subset(reads, subset)
    found = _hit_masks(reads, genome, _shared_table(reads, genome, names, k), names=names, k=k, min_kmers=min_kmers)
    every = reads.select("sample", "read_idx", "mate").join(found, ["sample", "read_idx", "mate"], "left")
    return every.select("sample", "read_idx", "mate", F.coalesce("mask", F.lit(0)).cast("bigint").alias("mask"))


def screen_library(
    reads: DataFrame, genome: DataFrame, *, names: Sequence[str], subset: int | None = None, k: int = 21, min_kmers: int = 1
) -> DataFrame:
    """Reads per sample and sequence set: hits in this set only, and in this and others; plus no hits, the rest of the sample."""
    reads = _subset(reads, subset)
    found = _hit_masks(reads, genome, _shared_table(reads, genome, names, k), names=names, k=k, min_kmers=min_kmers)
    masks = found.groupBy("sample", "mask").agg(_n())
    sets = F.array(*[F.struct(F.lit(n).alias("genome"), F.lit(1 << i).alias("bit")) for i, n in enumerate(names)])
    rows = masks.select("sample", "mask", "n", F.inline(sets)).filter(F.col("mask").bitwiseAND(F.col("bit")) != 0)
    alone = F.bit_count("mask") == 1
    hit = rows.groupBy("sample", "genome").agg(
        F.sum(F.when(alone, F.col("n")).otherwise(0)).alias("one_genome"),
        F.sum(F.when(~alone, F.col("n")).otherwise(0)).alias("multiple_genomes"),
    )
    total = reads.groupBy("sample").agg(_n()).unionByName(masks.select("sample", (-F.col("n")).alias("n")))
    none = total.groupBy("sample").agg(F.sum("n").alias("n")).filter("n > 0").select(
        "sample", F.lit("no_hits").alias("genome"), F.col("n").alias("one_genome"), F.lit(0).cast("bigint").alias("multiple_genomes")
    )
    return hit.unionByName(none)


def reads_without_hits(
    reads: DataFrame, genome: DataFrame, *, names: Sequence[str], subset: int | None = None, k: int = 21, min_kmers: int = 1
) -> DataFrame:
    """Reads whose key has no hit; the k-mers of rows of one key count together."""
    reads = _subset(reads, subset)
    shared = _shared_table(reads, genome, names, k)
    found = _hit_masks(reads, genome, shared, names=names, k=k, min_kmers=min_kmers)
    # Rows that hit a set by themselves need not meet their key's sum, so their bases stay where they are.
    rest = reads if shared is None else _without_own_hit(reads, shared, len(names), k, min_kmers)
    return rest.join(found, ["sample", "read_idx", "mate"], "left_anti")


def grade_level(grade: Column) -> Column:
    """1 for DDD up to 64 for AAA."""
    parts = [F.instr(F.lit("ABCD"), F.substring(grade, i, 1)) - 1 for i in (1, 2, 3)]
    return F.lit(64) - (parts[0] * 16 + parts[1] * 4 + parts[2])


def reads_per_sample_report(tables: Sequence[DataFrame], *, grade: str = "grade", values: Sequence[str] | None = None) -> DataFrame:
    """Join per-sample statistics, derive fragment counts and melt to (sample, grade, level, variable, value)."""
    wide = reduce(lambda a, b: a.join(b, "sample"), tables)
    wide = wide.withColumn("fragments_examined", F.col("unpaired_examined") + F.col("pairs_examined"))
    wide = wide.withColumn("duplicate_fragments", F.col("unpaired_duplicates") + F.col("pair_duplicates"))
    wide = wide.withColumn("unique_fragments", F.col("fragments_examined") - F.col("duplicate_fragments"))
    wide = wide.withColumn("grade_level", grade_level(F.col(grade)))
    values = values or ["raw_reads", "mapped_reads", "fragments_examined", "duplicate_fragments", "unique_fragments"]
    return wide.unpivot(["sample", grade, "grade_level"], list(values), "variable", "value")


def successive_screen_summary(
    summaries: DataFrame, composition: DataFrame | None = None, *, types: Sequence[str], rrna_pos: int | None = None
) -> DataFrame:
    """Ordered screening steps in long form (sample, step_no, type, key, value).

    ``summaries``: (sample, step_no, unique_hits, multiple_hits, unaligned), ``step_no`` from 1; ``unaligned`` stays for
    the last step only. Step ``rrna_pos`` is replaced by the strand composition (sample, sense, n).
    """
    steps = summaries.filter(F.col("step_no").between(1, len(types)))
    if rrna_pos is not None:
        choice("rrna_pos", rrna_pos, range(1, len(types) + 1))
        steps = steps.filter(F.col("step_no") != rrna_pos)
    long = steps.unpivot(["sample", "step_no"], ["unique_hits", "multiple_hits", "unaligned"], "key", "value")
    long = long.filter((F.col("key") != "unaligned") | (F.col("step_no") == len(types)))
    if rrna_pos is not None:
        if composition is None:
            raise ValueError("rrna_pos needs a composition table")
        long = long.unionByName(
            composition.select("sample", F.lit(rrna_pos).alias("step_no"), F.col("sense").alias("key"), F.col("n").alias("value"))
        )
    names = F.array(*[F.lit(x) for x in types])
    return long.withColumn("type", F.element_at(names, F.col("step_no").cast("int")))


def strand_composition(targets: DataFrame, *, library_type: str, detail: bool = True) -> DataFrame:
    """Sense and antisense totals of a (sample, flag, ref, n) table, by reference with ``detail``.

    A flag other than 0 or 16 is a run-time error. Total rows have a NULL ``ref``.
    """
    choice("library_type", library_type, ("unstranded", "firststranded", "secondstranded"))
    if library_type == "unstranded":
        sense = F.lit("unstranded")
    else:
        turned = 16 if library_type == "firststranded" else 0
        sense = F.when(F.col("flag") == turned, "sense").otherwise("antisense")
    wrong = F.concat(F.lit("flag other than 0 or 16: "), F.col("flag").cast("string"))
    rows = targets.select("sample", "ref", "n", fail_when(~F.col("flag").isin(0, 16), wrong, sense).alias("sense"))
    if not detail or library_type == "unstranded":
        return rows.groupBy("sample", "sense").agg(F.sum("n").alias("n"))
    return rows.groupingSets([["sample", "sense"], ["sample", "sense", "ref"]], "sample", "sense", "ref").agg(F.sum("n").alias("n"))

