"""Count tables: lookups, merging, transcript-to-gene sums, matrices."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..options import choice, fail_when, require


def key_join_counts(counts: DataFrame, mapping: DataFrame, *, on: str = "target_id", to: str = "gene_id") -> DataFrame:
    """Attach ``to`` from ``mapping``; a key without mapping is a run-time error naming the key.

    A plain left equi-join: adaptive execution broadcasts the mapping when its measured size allows.
    """
    require(counts, on)
    require(mapping, on, to)
    joined = counts.join(mapping.select(on, to), on, "left")
    unknown = F.concat(F.lit(f"no {to} for {on} "), F.col(on))
    return joined.withColumn(to, fail_when(F.col(to).isNull(), unknown, F.col(to)))


def last_mapping(mapping: DataFrame, *, order: str, on: str = "target_id", to: str = "gene_id") -> DataFrame:
    """One row per key; of duplicate mappings the last by ``order`` wins."""
    return mapping.groupBy(on).agg(F.max_by(to, order).alias(to))


def transcripts_to_genes(counts: DataFrame, mapping: DataFrame, *, digits: int = 6) -> DataFrame:
    """Sum transcript counts per gene and sample, printed with ``digits`` decimals.

    Transcripts are summed before the lookup join, so the join sees one row per transcript and sample.
    """
    small = counts.groupBy("sample", "target_id").agg(F.sum("count").alias("count"))
    genes = key_join_counts(small, mapping).groupBy("sample", "gene_id").agg(F.sum("count").alias("count"))
    return genes.withColumn("text", F.format_string(f"%.{digits}f", "count"))


def _list(column: str, order: str, digits: int | None = None) -> Column:
    value = F.col(column) if digits is None else F.format_string(f"%.{digits}f", column)
    rows = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), value.cast("string").alias("v"))))
    return F.array_join(F.transform(rows, lambda r: r["v"]), ",")


def transcripts_to_genes_extended(counts: DataFrame, mapping: DataFrame, *, order: str) -> DataFrame:
    """Gene rows with summed count and TPM plus comma lists of the transcript columns in ``order``.

    The lists hold a gene's transcripts, which are part of the result itself.
    """
    joined = key_join_counts(counts, mapping)
    return joined.groupBy("sample", "gene_id").agg(
        F.sum("count").alias("count"),
        F.sum("tpm").alias("tpm"),
        _list("target_id", order).alias("transcripts"),
        _list("length", order, 1).alias("lengths"),
        _list("eff_length", order, 1).alias("eff_lengths"),
        _list("count", order, 1).alias("counts"),
        _list("tpm", order, 1).alias("tpms"),
    ).withColumns({"length": F.lit("NA"), "eff_length": F.lit("NA")})


# Counted type per table producer.
_VALUE_TYPE = {"fc": "bigint", "htc": "double"}


def merge_counts(tables: Sequence[DataFrame], *, tool: str = "htc", same_genes: bool = True) -> DataFrame:
    """Sum ``count`` per gene over several tables.

    ``same_genes`` makes a gene that some table lacks a run-time error.
    """
    choice("tool", tool, _VALUE_TYPE)
    if not tables:
        raise ValueError("no tables to merge")
    tagged = [
        t.groupBy("target_id").agg(F.sum("count").alias("count")).withColumn("part", F.lit(i))
        for i, t in enumerate(tables)
    ]
    merged = (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("target_id")
        .agg(F.sum("count").cast(_VALUE_TYPE[tool]).alias("count"), F.count(F.lit(1)).alias("parts"))
    )
    if same_genes:
        missing = F.concat(F.lit("gene missing in some table: "), F.col("target_id"))
        merged = merged.withColumn(
            "target_id", fail_when(F.col("parts") != len(tables), missing, F.col("target_id"))
        )
    return merged.drop("parts")


def counts_from_coverage(transcripts: DataFrame, *, read_len: int = 75) -> DataFrame:
    """Read counts implied by per-transcript coverage: ceil(cov * length / read_len)."""
    return transcripts.withColumn("count", F.ceil(F.col("cov") * F.col("length") / F.lit(read_len)).cast("bigint"))


def count_matrix(counts: DataFrame, samples: Sequence[str], *, key: str = "target_id", value: str = "count") -> DataFrame:
    """One column per sample of the given list; absent entries are 0."""
    wide = counts.groupBy(key).pivot("sample", list(samples)).agg(F.sum(value))
    return wide.na.fill(0, subset=list(samples))


def gene_clusters(genes: DataFrame, *, prefix: str = "cluster") -> DataFrame:
    """Legend (gene_id, cluster_id, n_genes) of genes that overlap or touch on one sequence."""
    from .intervals import merge_intervals, overlap_join

    spans = genes.groupBy("gene_id", "rname").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    loci = merge_intervals(spans)
    inside = overlap_join(spans, loci, min_overlap=0)
    name = F.concat_ws("_", F.lit(prefix), "rname", F.col("r_start").cast("string"))
    return inside.select("gene_id", name.alias("cluster_id"), F.col("r_n").alias("n_genes"))
