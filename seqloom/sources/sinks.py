"""Tables back to text: line builders and writers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.joins import join_small
from ..functions.staging import evaluate_once
from ..options import choice


def fastq_lines(reads: DataFrame) -> DataFrame:
    """One four-line text per read, with the columns to partition and order by."""
    name = F.concat_ws(" ", "qname", *(["descr"] if "descr" in reads.columns else []))
    text = F.concat(F.lit("@"), name, F.lit("\n"), "seq", F.lit("\n+\n"), "qual")
    return reads.select("sample", "mate", "read_idx", text.alias("value"))


def write_fastq(reads: DataFrame, path: str, *, compression: str = "gzip", partitions: int | None = None) -> None:
    """FASTQ folders ``sample=.../mate=...``; files hold consecutive ranges of ``read_idx`` in order.

    Rows are range-partitioned by (sample, mate, read_idx), so a large sample is written by many tasks.
    """
    choice("compression", compression, ("gzip", "none"))
    key = ["sample", "mate", "read_idx"]
    lines = fastq_lines(reads)
    ranged = lines.repartitionByRange(partitions, *key) if partitions else lines.repartitionByRange(*key)
    ordered = ranged.sortWithinPartitions(*key).select("sample", "mate", "value")
    ordered.write.partitionBy("sample", "mate").option("compression", compression).text(path)


def fasta_lines(sequences: DataFrame, *, width: int = 0) -> DataFrame:
    """One text per record: header, then the sequence, wrapped at ``width`` when given."""
    name = F.concat_ws(" ", "name", *(["descr"] if "descr" in sequences.columns else []))
    seq = F.col("seq")
    if width > 0:
        seq = F.regexp_replace(F.regexp_replace("seq", "(.{" + str(width) + "})", "$1\n"), "\n$", "")
    return sequences.select("name", F.concat(F.lit(">"), name, F.lit("\n"), seq).alias("value"))


def write_fasta(sequences: DataFrame, path: str, *, width: int = 60, compression: str = "none") -> None:
    fasta_lines(sequences, width=width).select("value").write.option("compression", compression).text(path)


def _tag_text(tags: Column) -> Column:
    # Keys differ, so the order of whole entries is that of their keys; no comparison in an expression.
    entries = F.sort_array(F.map_entries(tags))
    return F.transform(entries, lambda e: F.concat_ws(":", e["key"], e["value"]["type"], e["value"]["value"]))


def sam_lines(al: DataFrame) -> DataFrame:
    """SAM text lines: eleven fields, then tags sorted by name; columns ``sample``, ``rname``, ``pos`` stay for ordering."""
    fixed = "qname flag rname pos mapq cigar rnext pnext tlen seq qual".split()
    fields = F.array(*[F.col(c).cast("string") for c in fixed])
    every = F.concat(fields, _tag_text(F.col("tags"))) if "tags" in al.columns else fields
    # A filter on the line would else build it twice.
    return evaluate_once(al, value=F.array_join(every, "\t")).select("sample", "rname", "pos", "value")


def sam_text(al: DataFrame, header: DataFrame) -> DataFrame:
    """All lines of one coordinate-sorted SAM text per sample: ``sample``, ``section``, ``ref``, ``pos``, ``value``, to be ordered by the first four.

    ``header`` holds (sample, file, line, value). Its lines are section 0 in their order with ``ref`` as number, equal lines once; an ``@HD`` line
    comes first, says ``SO:coordinate`` and is made where missing. Records are section 1 in the order of the ``@SQ`` lines,
    names without such a line after all others. A sample's header has a row per sequence and read group and is ordered in one task.
    """
    first = header.groupBy("sample", "value").agg(F.min(F.struct("file", "line")).alias("at"))
    top = F.col("value").startswith("@HD")
    heads = first.filter(top).groupBy("sample").agg(F.min_by("value", "at").alias("value"))
    heads = al.select("sample").distinct().join(heads, "sample", "left")
    plain = F.regexp_replace(F.coalesce("value", F.lit("@HD\tVN:1.6")), "\tSO:[^\t]*", "")
    heads = heads.select("sample", F.lit(1).alias("ref"), F.regexp_replace(plain, "^(@HD(?:\tVN:[^\t]*)?)", "$1\tSO:coordinate").alias("value"))
    order = Window.partitionBy("sample").orderBy("at")
    others = first.filter(~top).select("sample", (F.row_number().over(order) + 1).alias("ref"), "value")
    name = F.regexp_extract("value", "^@SQ\t(?:.*\t)?SN:([^\t]+)", 1)
    places = others.filter(F.col("value").startswith("@SQ")).groupBy("sample", name.alias("rname")).agg(F.min("ref").alias("ref"))
    last = (1 << 31) - 1
    body = join_small(sam_lines(al), places, ["sample", "rname"], "left").withColumn("ref", F.coalesce("ref", F.lit(last)))
    head = heads.unionByName(others).select("sample", F.lit(0).alias("section"), "ref", F.lit("").alias("rname"), F.lit(0).alias("pos"), "value")
    return head.unionByName(body.select("sample", F.lit(1).alias("section"), "ref", "rname", "pos", "value"))


def write_sam(al: DataFrame, path: str, *, header: DataFrame | None = None) -> None:
    """Coordinate-ordered SAM files per sample folder; with ``header`` (see :func:`sam_text`) a sample's files in name order are one whole SAM text."""
    lines, key = (sam_lines(al), ["sample", "rname", "pos"]) if header is None else (sam_text(al, header), ["sample", "section", "ref", "rname", "pos"])
    lines = lines.repartitionByRange(*key).sortWithinPartitions(*key)
    lines.select("sample", "value").write.partitionBy("sample").text(path)


def gtf_lines(features: DataFrame, *, attributes: list[str] | None = None) -> DataFrame:
    """GTF lines (1-based starts): eight fields and ``key "value"`` pairs joined by ``;``.

    Attributes come from the ``attrs`` map sorted by name, or from the named columns in order.
    """
    if attributes is None:
        entries = F.sort_array(F.map_entries("attrs"))
        pairs = F.transform(entries, lambda e: F.concat(e["key"], F.lit(' "'), e["value"], F.lit('"')))
    else:
        pairs = F.filter(
            F.array(*[F.concat(F.lit(a + ' "'), F.col(a).cast("string"), F.lit('"')) for a in attributes]), lambda p: p.isNotNull()
        )
    have = features.columns
    field = lambda c, default: F.coalesce(F.col(c).cast("string"), F.lit(default)) if c in have else F.lit(default)
    fields = [
        F.col("rname"), field("source", "."), field("feature", "exon"), (F.col("start") + 1).cast("string"), F.col("end").cast("string"),
        field("score", "."), field("strand", "."), field("frame", "."), F.array_join(pairs, "; "),
    ]
    return features.select("rname", "start", F.concat_ws("\t", *fields).alias("value"))


def write_gtf(features: DataFrame, path: str, **opts) -> None:
    lines = gtf_lines(features, **opts).repartitionByRange("rname", "start").sortWithinPartitions("rname", "start")
    lines.select("value").write.text(path)


def bedgraph_lines(signal: DataFrame) -> DataFrame:
    """bedGraph rows in (rname, start) order over range partitions."""
    key = ["sample", "rname", "start"]
    rows = signal.repartitionByRange(*key).sortWithinPartitions(*key)
    return rows.select("sample", "rname", "start", "end", "value")


def write_bedgraph(signal: DataFrame, path: str) -> None:
    bedgraph_lines(signal).write.partitionBy("sample").option("sep", "\t").csv(path)


def write_count_matrix(matrix: DataFrame, path: str, *, key: str = "target_id") -> None:
    matrix.repartitionByRange(key).sortWithinPartitions(key).write.option("header", True).csv(path)
