"""Text formats as tables: parsers work on a DataFrame of lines, readers on paths.

Everything except FASTQ is line- or record-splittable, so Spark's own text and CSV readers do the reading.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.staging import evaluate_once
from ..options import choice, fail_when

TAGS = "map<string,struct<type:string,value:string>>"


def _lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return spark.read.text(paths if isinstance(paths, str) else list(paths))


def _columns(line: Column, names: Sequence[str], sep: str = "\t") -> list[Column]:
    parts = F.split(line, sep)
    return [F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)]


def parse_sam(lines: DataFrame) -> DataFrame:
    """Alignment table of SAM lines (column ``value``); ``@`` lines are left out, see :func:`sam_header`.

    Tags split on the first two colons only, so values may hold more of them.
    """
    f = F.col("_f")
    fixed = "qname flag rname pos mapq cigar rnext pnext tlen seq qual".split()
    ints = {"flag", "pos", "mapq", "pnext", "tlen"}
    cols = [F.get(f, F.lit(i)).cast("int").alias(n) if n in ints else F.get(f, F.lit(i)).alias(n) for i, n in enumerate(fixed)]
    rest = F.slice(f, F.lit(12), F.greatest(F.size(f) - 11, F.lit(0)))

    def entry(p: Column) -> Column:
        return F.struct(p[0].alias("key"), F.struct(p[1].alias("type"), p[2].alias("value")).alias("value"))

    keep = [c for c in lines.columns if c != "value"]
    body = lines.filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    # Each line and each tag is split once; what is asked of the tags later does not build them again.
    split = evaluate_once(body.select(*keep, "value"), _f=F.split("value", "\t"))
    parts = F.transform(rest, lambda tag: F.split(tag, ":", 3))
    return evaluate_once(split.select(*keep, *cols, "_f"), tags=F.map_from_entries(F.transform(parts, entry)).cast(TAGS)).drop("_f")


def sam_header(lines: DataFrame) -> DataFrame:
    return lines.filter(F.col("value").startswith("@"))


def read_sam_header(spark: SparkSession, paths: str | Sequence[str], *, sample: str | None = None) -> DataFrame:
    """Header lines of SAM files with their place: ``sample``, ``file``, ``line`` (rising within a file, with gaps), ``value``."""
    lines = _lines(spark, paths).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("line"))
    return sam_header(lines).select(F.lit(sample).alias("sample"), "file", "line", "value")


def read_sam(spark: SparkSession, paths: str | Sequence[str], *, sample: str | None = None) -> DataFrame:
    out = parse_sam(_lines(spark, paths))
    return out.select(F.lit(sample).alias("sample"), "*")


def parse_gtf(lines: DataFrame) -> DataFrame:
    """Feature table (0-based starts) of GTF lines; a line without gene_id or transcript_id is a run-time error."""
    body = lines.filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    names = "rname source feature start end score strand frame text".split()
    t = body.select(*_columns(F.col("value"), names))
    pattern = r'(\S+)\s+"?([^";]*)"?\s*(?:;|$)'
    t = t.withColumn("_keys", F.regexp_extract_all("text", F.lit(pattern), F.lit(1)))
    pairs = F.arrays_zip(F.col("_keys").alias("key"), F.regexp_extract_all("text", F.lit(pattern), F.lit(2)).alias("value"))
    # A repeated key keeps its last value.
    last = F.filter(pairs, lambda p, i: F.array_position(F.reverse("_keys"), p["key"]) == F.size("_keys") - i)
    t = t.withColumn("attrs", F.map_from_entries(last)).drop("_keys")
    missing = F.col("attrs")["gene_id"].isNull() | F.col("attrs")["transcript_id"].isNull()
    message = F.concat(F.lit("gene_id or transcript_id missing: "), "rname", F.lit(":"), "start", F.lit(" "), "text")
    return t.select(
        "source", "rname", (F.col("start").cast("int") - 1).alias("start"), F.col("end").cast("int").alias("end"), "feature", "score",
        "strand", "frame", fail_when(missing, message, F.col("attrs")["gene_id"]).alias("gene_id"),
        F.col("attrs")["transcript_id"].alias("transcript_id"), F.col("attrs")["exon_number"].cast("int").alias("exon_number"), "attrs",
    )


def read_gtf(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_gtf(_lines(spark, paths))


def parse_bed(lines: DataFrame) -> DataFrame:
    """Intervals of BED3 to BED12 lines; block columns of BED12 become ``blocks``."""
    body = lines.filter(~F.col("value").rlike("^(#|track|browser)") & (F.col("value") != ""))
    f = F.split("value", "\t")
    sizes, starts = (F.split(F.regexp_replace(F.get(f, F.lit(i)), ",$", ""), ",") for i in (10, 11))
    blocks = F.when(
        F.size(f) >= 12,
        F.zip_with(
            starts, sizes,
            lambda s, n: F.struct(
                (F.get(f, F.lit(1)).cast("int") + s.cast("int")).alias("start"),
                (F.get(f, F.lit(1)).cast("int") + s.cast("int") + n.cast("int")).alias("end"),
            ),
        ),
    )
    return body.select(
        F.get(f, F.lit(0)).alias("rname"), F.get(f, F.lit(1)).cast("int").alias("start"), F.get(f, F.lit(2)).cast("int").alias("end"),
        F.get(f, F.lit(3)).alias("name"), F.get(f, F.lit(4)).try_cast("double").alias("score"), F.get(f, F.lit(5)).alias("strand"),
        blocks.alias("blocks"),
    )


def read_bed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_bed(_lines(spark, paths))


# Column of the count per producer (None: the last one) and text that opens a header line.
COUNT_COLUMNS = {"htseq": (None, None), "featurecounts": (None, "Geneid"), "kallisto": (3, "target_id"), "salmon": (4, "Name")}


def parse_counts(lines: DataFrame, *, tool: str) -> DataFrame:
    """(target_id, length, eff_length, count, tpm) of a producer's count table; other columns pass through."""
    choice("tool", tool, COUNT_COLUMNS)
    at, header = COUNT_COLUMNS[tool]
    body = lines.filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    if header is not None:
        body = body.filter(~F.col("value").startswith(header + "\t"))
    f = F.split("value", "\t")
    value = F.element_at(f, -1) if at is None else F.get(f, F.lit(at))
    none = F.lit(None).cast("double")
    get = lambda i: F.get(f, F.lit(i)).try_cast("double")
    length, eff, tpm = {
        "htseq": (none, none, none), "featurecounts": (get(5), none, none), "kallisto": (get(1), get(2), get(4)), "salmon": (get(1), get(2), get(3)),
    }[tool]
    keep = [c for c in lines.columns if c != "value"]
    return body.select(
        *keep, F.get(f, F.lit(0)).alias("target_id"), length.alias("length"), eff.alias("eff_length"), value.cast("double").alias("count"), tpm.alias("tpm")
    )


def read_counts(spark: SparkSession, paths: str | Sequence[str], *, tool: str, sample: str | None = None) -> DataFrame:
    return parse_counts(_lines(spark, paths), tool=tool).withColumn("sample", F.lit(sample))


def sample_sheet(sheet: DataFrame) -> DataFrame:
    """Samples with their one or two index sequences from a sheet (SampleID, Index, ...).

    Another number of index parts, or two different indices of one sample, is a run-time error.
    """
    index = F.col("Index")
    parts = F.split(index, "-")
    n = F.when(index == "", 0).otherwise(F.size(parts))
    per = sheet.groupBy(F.col("SampleID").alias("sample")).agg(
        F.count_distinct("Index").alias("k"), F.max("Index").alias("Index"), F.max(n).alias("parts"),
        *[F.min(c).alias(c.lower()) for c in sheet.columns if c not in ("SampleID", "Index")],
    )
    bad = (F.col("k") != 1) | ~F.col("parts").isin(1, 2)
    message = F.concat(F.lit("sample needs exactly one index of one or two parts: "), F.col("sample"))
    p = F.split("Index", "-")
    rest = [c.lower() for c in sheet.columns if c not in ("SampleID", "Index")]
    return per.select(
        fail_when(bad, message, F.col("sample")).alias("sample"), p[0].alias("index_r1"), F.get(p, F.lit(1)).alias("index_r2"), *rest
    )


def read_sample_sheet(spark: SparkSession, path: str) -> DataFrame:
    return sample_sheet(spark.read.csv(path, header=True))


def discover_samples(
    files: DataFrame, *, pattern: str, prefix: str = "", first_read: str = "_R1", second_read: str = "_R2", group_sep: str = "_"
) -> DataFrame:
    """(sample, mate, path): sample names from the regex groups of file names (column ``path``).

    A name that does not match, or holds both or neither mate mark, is a run-time error.
    """
    groups = re.compile(pattern).groups
    if groups == 0:
        raise ValueError("pattern needs at least one group")
    name = F.substring_index("path", "/", -1)
    parts = [F.regexp_extract(name, f"^(?:{pattern})$", i + 1) for i in range(groups)]
    sample = F.concat_ws(group_sep, *([F.lit(prefix)] if prefix else []), *parts)
    matched = name.rlike(f"^(?:{pattern})$")
    is1, is2 = F.contains(name, F.lit(first_read)), F.contains(name, F.lit(second_read))
    no_match = F.concat(F.lit("file name does not match the pattern: "), F.col("path"))
    unclear = F.concat(F.lit("cannot tell which read the file holds: "), F.col("path"))
    mate = F.when(is1 & ~is2, 1).when(is2 & ~is1, 2).otherwise(F.raise_error(unclear).cast("int"))
    return files.select(fail_when(~matched, no_match, sample).alias("sample"), mate.alias("mate"), "path")


def list_files(spark: SparkSession, glob: str) -> DataFrame:
    """(path, size, mtime) of files, contents unread."""
    return spark.read.format("binaryFile").load(glob).select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("mtime")
    )


def chrom_sizes(lines: DataFrame) -> DataFrame:
    return lines.filter("value <> ''").select(*_columns(F.col("value"), ["rname"]), F.get(F.split("value", "\t"), F.lit(1)).cast("bigint").alias("length"))


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return chrom_sizes(_lines(spark, path))


# Accepted content hashes and their functions.
HASHES = {
    "md5": lambda c: F.md5(c), "sha1": lambda c: F.sha1(c), "sha224": lambda c: F.sha2(c, 224), "sha256": lambda c: F.sha2(c, 256),
    "sha384": lambda c: F.sha2(c, 384), "sha512": lambda c: F.sha2(c, 512),
}


def verify_hashes(contents: DataFrame, manifest: DataFrame, *, algo: str = "md5", strict: bool = False) -> DataFrame:
    """Compare content hashes (path, content) with those given (path, hash): ok, mismatch or missing.

    With ``strict`` anything but ok is a run-time error.
    """
    choice("algo", algo, HASHES)
    return _compared(contents.select("path", HASHES[algo](F.col("content")).alias("_found")), manifest, strict)


def _compared(found: DataFrame, manifest: DataFrame, strict: bool) -> DataFrame:
    j = manifest.select("path", F.lower("hash").alias("hash")).join(found, "path", "left")
    state = F.when(F.col("_found").isNull(), "missing").when(F.col("_found") == F.col("hash"), "ok").otherwise("mismatch")
    if strict:
        state = fail_when(state != "ok", F.concat(F.lit("content hash differs: "), F.col("path")), state)
    return j.select("path", state.alias("state"))


def file_hashes(spark: SparkSession, glob: str, *, algo: str = "md5") -> DataFrame:
    """(path, _found): content hashes of files of any size, each streamed block by block in one task."""
    choice("algo", algo, HASHES)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            digests = []
            for path in batch.column(0).to_pylist():
                system, inner = fs.FileSystem.from_uri(path)
                digest = hashlib.new(algo)
                with system.open_input_stream(inner, compression=None) as stream:
                    while block := stream.read(8 << 20):
                        digest.update(block)
                digests.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.string())], names=["path", "_found"])

    files = list_files(spark, glob).select(F.regexp_replace("path", "^file:/+", "file:///").alias("path"))
    return files.mapInArrow(task, "path string, _found string")


def verify_files(spark: SparkSession, glob: str, manifest: DataFrame, *, algo: str = "md5", strict: bool = False) -> DataFrame:
    """:func:`verify_hashes` for files by path; the manifest's paths are matched with or without ``file://``."""
    bare = lambda df: df.withColumn("path", F.regexp_replace("path", "^file:/+", "/"))
    return _compared(bare(file_hashes(spark, glob, algo=algo)), bare(manifest), strict)


def read_contents(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").load(glob).select("path", "content")


def parse_refflat(lines: DataFrame) -> DataFrame:
    """Exon rows (rname, start, end, strand, gene_id, transcript_id, exon_number, cds_start, cds_end) of refFlat lines."""
    names = "gene_id transcript_id rname strand tx_start tx_end cds_start cds_end n_exon starts ends".split()
    t = lines.filter("value <> ''").select(*_columns(F.col("value"), names))

    def numbers(c: str) -> Column:
        return F.split(F.regexp_replace(c, ",$", ""), ",")

    pairs = F.arrays_zip(numbers("starts").alias("s"), numbers("ends").alias("e"))
    return t.select("*", F.posexplode(pairs).alias("i", "x")).select(
        "rname", F.col("x.s").cast("int").alias("start"), F.col("x.e").cast("int").alias("end"), "strand", "gene_id", "transcript_id",
        (F.col("i") + 1).alias("exon_number"), F.col("cds_start").cast("int").alias("cds_start"), F.col("cds_end").cast("int").alias("cds_end"),
    )


def read_refflat(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return parse_refflat(_lines(spark, paths))


def parse_align_summary(lines: DataFrame) -> DataFrame:
    """Input, unaligned, unique and multiple counts per summary text (columns ``file``, ``line_no``, ``value``).

    Lines after a ``----`` line do not count.
    """
    text = F.trim("value")
    count = F.regexp_extract(text, r"^(\d+)", 1).try_cast("bigint")
    kind = (
        F.when(text.rlike(r"^\d+ \S+ were"), "input").when(text.rlike(r"0\stimes"), "unaligned").when(text.rlike("exactly 1 time"), "unique_hits")
        .when(text.rlike(">1 times"), "multiple_hits")
    )
    stop = lines.filter(text.startswith("----")).groupBy("file").agg(F.min("line_no").alias("_stop"))
    rows = lines.select("file", "line_no", count.alias("n"), kind.alias("kind")).filter("kind is not null")
    rows = rows.join(stop, "file", "left").filter("_stop is null or line_no < _stop")
    return rows.groupBy("file").agg(
        *[
            F.max_by(F.when(F.col("kind") == k, F.col("n")), F.when(F.col("kind") == k, F.col("line_no"))).alias(k)
            for k in ("input", "unaligned", "unique_hits", "multiple_hits")
        ]
    )


def read_align_summary(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Summaries are a few lines each: one row per file, its lines numbered inside the row."""
    whole = spark.read.text(paths if isinstance(paths, str) else list(paths), wholetext=True)
    lines = whole.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", "\n")).alias("line_no", "value"))
    return parse_align_summary(lines)


def parse_fasta(records: DataFrame) -> DataFrame:
    """Sequences of FASTA records (column ``value``: header line and sequence lines without the leading ``>``)."""
    text = F.regexp_replace("value", "\r", "")
    header = F.trim(F.substring_index(text, "\n", 1))
    seq = F.regexp_replace(F.substr(text, F.length(F.substring_index(text, "\n", 1)) + 1), r"\s+", "")
    return records.filter("trim(value) <> ''").select(
        F.substring_index(header, " ", 1).alias("name"),
        F.when(F.contains(header, F.lit(" ")), F.regexp_replace(header, r"^\S+\s+", "")).alias("descr"),
        seq.alias("seq"), F.length(seq).cast("bigint").alias("length"),
    )


def read_fasta(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One row per sequence; plain files are split between records."""
    records = spark.read.option("lineSep", "\n>").text(paths if isinstance(paths, str) else list(paths))
    return parse_fasta(records.select(F.regexp_replace("value", "^>", "").alias("value")))


def sequence_chunks(sequences: DataFrame, *, chunk: int = 1 << 20) -> DataFrame:
    """(rname, start, seq) chunks of long sequences, the form genome joins work on."""
    from ..operators.intervals import explode_range

    parts = explode_range(sequences, F.lit(0), F.ceil(F.length("seq") / F.lit(chunk)) - 1, "_k")
    start = (F.col("_k") * chunk).cast("int")
    return parts.select(F.col("name").alias("rname"), start.alias("start"), F.substr("seq", start + 1, F.lit(chunk)).alias("seq"))
