"""FASTQ reading.

A Python data source, because a record is four lines and only a reader that owns the bytes can cut a plain file into ranges and
find the next record start. Bytes travel as Arrow batches; any file system with a PyArrow URI works.
"""

from __future__ import annotations

import glob as globbing
import re
from collections.abc import Iterator, Sequence
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.joins import join_small

SCHEMA = "file STRING, part INT, rec BIGINT, qname STRING, descr STRING, seq STRING, qual STRING"
COUNTS = "file STRING, part INT, n BIGINT"
BLOCK = 8 << 20
#: Byte ranges whose record counts are broadcast at most: 25 TB of one sample and mate in ranges of 128 MB.
RANGES = 200_000


#: Bytes of neighbouring ranges that one task reads, one range after the other; a larger range is a task of its own.
TASK_BYTES = 32 << 20


class FastqRange(InputPartition):
    def __init__(self, path: str, part: int, start: int, stop: int):
        self.path, self.part, self.start, self.stop = path, part, start, stop


class Ranges(InputPartition):
    """The byte ranges of one task."""

    def __init__(self, ranges: list):
        self.ranges = ranges


def by_task(ranges: list) -> list[InputPartition]:
    """Ranges in order, dealt to tasks of up to ``TASK_BYTES``: small ranges do not cost a task each. A range that has no known end is alone."""
    out: list[list] = []
    room = 0
    for r in ranges:
        size = r.stop - r.start if r.stop >= 0 else TASK_BYTES
        if not out or size > room:
            out.append([])
            room = TASK_BYTES
        out[-1].append(r)
        room -= size
    return [task[0] if len(task) == 1 else Ranges(task) for task in out]


def ranges_of(task: InputPartition) -> list:
    return task.ranges if isinstance(task, Ranges) else [task]


def _open(path: str):
    from pyarrow import fs

    if urlparse(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def _expand(paths: Sequence[str]) -> list[str]:
    from pyarrow import fs

    out: list[str] = []
    for p in paths:
        if not urlparse(p).scheme and any(ch in p for ch in "*?["):
            out += sorted(globbing.glob(p))
            continue
        system, inner = _open(p)
        if system.get_file_info(inner).type == fs.FileType.Directory:
            found = system.get_file_info(fs.FileSelector(inner, recursive=True))
            scheme = f"{urlparse(p).scheme}://" if urlparse(p).scheme else ""
            out += sorted(
                scheme + f.path for f in found if f.is_file and not f.base_name.startswith(("_", ".")) and f.size
            )
        else:
            out.append(p)
    if not out:
        raise ValueError(f"no files at {list(paths)}")
    return out


def record_start(lines: list[bytes]) -> int | None:
    """Index of the first line that opens a record: ``@``, and two lines on ``+``, and equally long sequence and quality.

    A quality line may itself start with ``@``; the line two after it is then a sequence, never ``+``.
    """
    for i in range(len(lines) - 3):
        if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+" and len(lines[i + 1]) == len(lines[i + 3]):
            return i
    return None


def _qualified(spark: SparkSession, path: str) -> str:
    """A path without scheme on Spark's default file system, as for Spark's own readers; local ones stay plain."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    full = system.makeQualified(target).toString()
    return re.sub("^file:/+", "/", full)


class FastqReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int, counts: bool):
        self.paths, self.split_bytes, self.counts = paths, split_bytes, counts

    def partitions(self) -> list[InputPartition]:
        out: list[FastqRange] = []
        for path in _expand(self.paths):
            if path.endswith(".gz"):
                out.append(FastqRange(path, 0, 0, -1))
                continue
            system, inner = _open(path)
            size = system.get_file_info(inner).size
            cuts = list(range(0, max(size, 1), self.split_bytes)) + [size]
            out += [FastqRange(path, i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        return by_task(out)

    def read(self, partition: InputPartition) -> Iterator:
        for part in ranges_of(partition):
            yield from self._read(part)

    def _read(self, partition: FastqRange) -> Iterator:
        import pyarrow as pa

        if self.counts:
            n = sum(len(lines) // 4 for lines in self._records(partition))
            yield pa.record_batch([pa.array([partition.path]), pa.array([partition.part], pa.int32()), pa.array([n], pa.int64())], names=["file", "part", "n"])
            return
        schema = pa.schema(
            [("file", pa.string()), ("part", pa.int32()), ("rec", pa.int64()), *[(n, pa.string()) for n in ("qname", "descr", "seq", "qual")]]
        )
        done = 0
        for lines in self._records(partition):
            n = len(lines) // 4
            heads = [h[1:].decode() for h in lines[0 : 4 * n : 4]]
            names = [h.partition(" ") for h in heads]
            yield pa.record_batch(
                [
                    pa.array([partition.path] * n, pa.string()), pa.array([partition.part] * n, pa.int32()),
                    pa.array(range(done, done + n), pa.int64()), pa.array([x[0] for x in names], pa.string()),
                    pa.array([x[2] or None for x in names], pa.string()), pa.array([s.decode() for s in lines[1 : 4 * n : 4]], pa.string()),
                    pa.array([q.decode() for q in lines[3 : 4 * n : 4]], pa.string()),
                ],
                schema=schema,
            )
            done += n

    def _records(self, part: FastqRange) -> Iterator[list[bytes]]:
        """Lines of the records that begin inside the range, in whole records."""
        import pyarrow as pa

        system, inner = _open(part.path)
        if part.path.endswith(".gz"):
            stream = system.open_input_stream(inner, compression="gzip")
            at, stop = 0, None
        else:
            stream = system.open_input_file(inner)
            # Start one byte early: a range that begins right after a newline begins with a whole line.
            at, stop = max(part.start - 1, 0), part.stop
            stream.seek(at)
        block = BLOCK if stop is None else min(BLOCK, max(stop - at + (1 << 12), 1 << 14))
        synced = part.start == 0
        skip_line = not synced
        rest, base, ended = b"", at, False
        with stream:
            while not ended:
                # A small range reads little beyond its end.
                data = stream.read(block)
                ended = len(data) == 0
                text = rest + (data.to_pybytes() if isinstance(data, pa.Buffer) else data)
                if ended and text and not text.endswith(b"\n"):
                    text += b"\n"
                lines = text.split(b"\n")
                tail = lines.pop()
                if skip_line:
                    if not lines:
                        rest = text
                        continue
                    base += len(lines[0]) + 1
                    lines, skip_line = lines[1:], False
                if not synced:
                    first = record_start([x.rstrip(b"\r") for x in lines[:12]])
                    if first is None:
                        rest = b"\n".join([*lines, tail])
                        if ended:
                            return
                        continue
                    base += sum(len(x) + 1 for x in lines[:first])
                    lines, synced = lines[first:], True
                if stop is not None:
                    # Keep records whose header begins before the end of the range.
                    keep, pos = 0, base
                    while keep + 4 <= len(lines) and pos < stop:
                        pos += sum(len(x) + 1 for x in lines[keep : keep + 4])
                        keep += 4
                    past = pos >= stop
                else:
                    keep = len(lines) // 4 * 4
                    pos, past = base + sum(len(x) + 1 for x in lines[:keep]), False
                out = [x.rstrip(b"\r") for x in lines[:keep]]
                if ended:
                    left = [x for x in lines[keep:] if x.strip()]
                    if left and not past:
                        raise ValueError(f"{part.path}: the last record is not complete")
                if out and not out[-4]:
                    # An empty header line ends the data.
                    while len(out) >= 4 and not out[-4]:
                        out = out[:-4]
                if out:
                    yield out
                if past:
                    return
                rest, base = b"\n".join([*lines[keep:], tail]), pos


class FastqSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fastq_records"

    def _counts(self) -> bool:
        return self.options.get("counts", "false") == "true"

    def schema(self) -> str:
        return COUNTS if self._counts() else SCHEMA

    def reader(self, schema) -> DataSourceReader:
        paths = self.options.get("paths") or self.options["path"]
        return FastqReader(paths.split("\n"), int(self.options.get("splitbytes", 128 << 20)), self._counts())


def fastq_records(spark: SparkSession, paths: str | Sequence[str], *, split_bytes: int = 128 << 20, counts: bool = False) -> DataFrame:
    """Records with file, range number and number inside the range; with ``counts`` only the number of records per range, none decoded."""
    spark.dataSource.register(FastqSource)
    names = [_qualified(spark, p) for p in ([paths] if isinstance(paths, str) else list(paths))]
    return spark.read.format("fastq_records").option("paths", "\n".join(names)).option("splitbytes", split_bytes).option("counts", str(counts).lower()).load()


def read_fastq(spark: SparkSession, paths: str | Sequence[str], *, sample: str, mate: int, split_bytes: int = 128 << 20) -> DataFrame:
    """Reads numbered from 0 over the files in order, the number by which mates are paired.

    The first pass counts records per byte range; only those counts are ordered. Gzip files are one range each.
    """
    recs = fastq_records(spark, paths, split_bytes=split_bytes)
    sizes = fastq_records(spark, paths, split_bytes=split_bytes, counts=True).withColumnRenamed("n", "_n")
    before = Window.orderBy("file", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    out = join_small(recs, offsets, ["file", "part"], limit=RANGES)
    return out.select(
        F.lit(sample).alias("sample"), (F.col("rec") + F.col("_off")).alias("read_idx"), F.lit(mate).cast("tinyint").alias("mate"),
        "qname", "descr", "seq", "qual",
    )
