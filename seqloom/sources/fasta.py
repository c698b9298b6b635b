"""FASTA reading in chunks: sequences are cut while their bytes stream by, so no row ever holds a whole one.

A plain file is read in byte ranges. A first pass over the ranges brings back one row each, the last header and the bases behind it; running sums of these
rows place every range's leading bases in the sequence that they continue.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.joins import join_small
from ..options import positive
from .fastq import _expand, _open, _qualified, by_task, ranges_of

BLOCK = 1 << 20
PIECES = "file STRING, part INT, serial INT, name STRING, place BIGINT, seq STRING"
TOTALS = "file STRING, part INT, headers INT, name STRING, bases BIGINT"
_BLANK = b"\r\n \t\x0b\x0c"


#: Bases of pieces in one Arrow batch, and pieces of one at most.
BATCH_BASES, BATCH_PIECES = 1 << 20, 10_000


class FastaRange(InputPartition):
    def __init__(self, path: str, part: int, start: int, stop: int):
        self.path, self.part, self.start, self.stop = path, part, start, stop


def events(stream, start: int, stop: int | None) -> Iterator[tuple[bool, bytes]]:
    """(True, header) and (False, bases) of the bytes ``start`` to ``stop``, in order.

    A header belongs to the range in which it begins and is read to its end; a range that begins inside one leaves it out.
    """
    in_header = owned = line_begins = False
    if stop is None or start == 0:
        line_begins = True
    else:
        before = stream.read_at(1, start - 1)
        line_begins = before == b"\n"
        in_header = not line_begins and _begins_in_header(stream, start)
        stream.seek(start)
    at, header = start, bytearray()
    while True:
        left = BLOCK if stop is None else min(BLOCK, stop - at) if at < stop else (4096 if in_header and owned else 0)
        data = stream.read(left) if left > 0 else b""
        if not data:
            break
        past = stop is not None and at >= stop
        at += len(data)
        place = 0
        while place < len(data):
            if in_header:
                end = data.find(b"\n", place)
                if owned:
                    header += data[place : end if end >= 0 else len(data)]
                if end < 0:
                    break
                if owned:
                    yield True, bytes(header)
                in_header, line_begins, place = False, True, end + 1
                if past:
                    return
                continue
            if line_begins and data[place : place + 1] == b">":
                in_header, owned, header, place = True, True, bytearray(), place + 1
                continue
            end = data.find(b"\n>", place)
            bases = data[place : end if end >= 0 else len(data)].translate(None, _BLANK)
            if bases:
                yield False, bases
            place = len(data) if end < 0 else end + 1
            line_begins = data[place - 1 : place] == b"\n"
    if in_header and owned:
        yield True, bytes(header)


def _begins_in_header(stream, start: int) -> bool:
    """Whether the line that goes on at ``start`` is a header; looks back block by block."""
    stop = start
    while stop > 0:
        low = max(0, stop - BLOCK)
        data = stream.read_at(stop - low, low)
        end = data.rfind(b"\n")
        if end >= 0:
            return (data[end + 1 : end + 2] or stream.read_at(1, stop)) == b">"
        stop = low
    return stream.read_at(1, 0) == b">"


def first_word(header: bytes) -> str:
    return header.decode("utf-8", "replace").strip().split(" ", 1)[0]


class FastaReader(DataSourceReader):
    def __init__(self, paths: list[str], split_bytes: int, chunk: int):
        self.paths, self.split_bytes, self.chunk = paths, split_bytes, chunk

    def partitions(self) -> list[InputPartition]:
        out = []
        for path in _expand(self.paths):
            system, inner = _open(path)
            size = system.get_file_info(inner).size
            step = size if path.endswith(".gz") else self.split_bytes
            out += [FastaRange(path, k, s, min(s + step, size)) for k, s in enumerate(range(0, size, step))]
        return by_task(out)

    def _events(self, part: FastaRange) -> Iterator[tuple[bool, bytes]]:
        system, inner = _open(part.path)
        if part.path.endswith(".gz"):
            with system.open_input_stream(inner, compression="gzip") as stream:
                yield from events(stream, 0, None)
        else:
            with system.open_input_file(inner) as stream:
                yield from events(stream, part.start, part.stop)

    def read(self, partition: InputPartition):
        import pyarrow as pa

        if not self.chunk:
            rows = [self._total(part) for part in ranges_of(partition)]
            kinds = {"file": pa.string(), "part": pa.int32(), "headers": pa.int32(), "name": pa.string(), "bases": pa.int64()}
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))
            return
        kinds = {"file": pa.string(), "part": pa.int32(), "serial": pa.int32(), "name": pa.string(), "place": pa.int64(), "seq": pa.string()}
        rows, bases = [], 0
        for part in ranges_of(partition):
            for serial, name, place, seq in self._pieces(part):
                rows.append((part.path, part.part, serial, name, place, seq.decode("ascii", "replace")))
                bases += len(seq)
                if bases >= BATCH_BASES or len(rows) >= BATCH_PIECES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))
                    rows, bases = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))

    def _total(self, part: FastaRange) -> tuple[str, int, int, str | None, int]:
        """(file, number, headers, last name, bases behind it) of a range."""
        headers, name, bases = 0, None, 0
        for is_header, text in self._events(part):
            headers, name, bases = (headers + 1, first_word(text), 0) if is_header else (headers, name, bases + len(text))
        return part.path, part.part, headers, name, bases

    def _pieces(self, part: FastaRange) -> Iterator[tuple[int, str | None, int, bytes]]:
        """(number of the header in the range, its name, place behind it, bases) with at most ``chunk`` bases each; number 0 goes on from the range before."""
        serial, name, place, held = 0, None, 0, bytearray()
        for is_header, text in self._events(part):
            if not is_header:
                held += text
            while len(held) >= self.chunk or (is_header and held):
                yield serial, name, place, bytes(held[: self.chunk])
                place += len(held[: self.chunk])
                del held[: self.chunk]
            if is_header:
                serial, name, place = serial + 1, first_word(text), 0
        if held:
            yield serial, name, place, bytes(held)


class FastaSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "fasta_pieces"

    def schema(self) -> str:
        return PIECES if int(self.options.get("chunk", 0)) else TOTALS

    def reader(self, schema) -> DataSourceReader:
        return FastaReader(self.options["paths"].split("\n"), int(self.options["splitbytes"]), int(self.options.get("chunk", 0)))


def read_fasta_chunks(spark: SparkSession, paths: str | Sequence[str], *, chunk: int = 1 << 20, split_bytes: int = 32 << 20) -> DataFrame:
    """(rname, start, seq) chunks of ``chunk`` bases, the form genome joins work on; the last of a sequence is shorter.

    ``rname`` is a header's first word. No row holds more than one chunk, whatever the length of sequences and lines; white space within
    sequences is dropped, a sequence without bases has no chunk, and bases before the first header of a file are left out.
    """
    positive("chunk", chunk)
    positive("split_bytes", split_bytes)
    spark.dataSource.register(FastaSource)
    names = "\n".join(_qualified(spark, p) for p in ([paths] if isinstance(paths, str) else list(paths)))
    load = lambda size: spark.read.format("fasta_pieces").option("paths", names).option("splitbytes", split_bytes).option("chunk", size).load()
    # One row per range: the sequence that each begins in, and how many of its bases lie before.
    along = Window.partitionBy("file").orderBy("part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    totals = load(0).withColumn("_run", F.sum((F.col("headers") > 0).cast("int")).over(along))
    upto = F.sum("bases").over(Window.partitionBy("file", "_run").orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
    head = F.when(F.col("headers") > 0, F.struct(F.col("part").alias("part"), F.col("headers").alias("serial"), "name"))
    totals = totals.withColumns({"_upto": upto, "_head": head})
    begins = totals.select(
        "file", "part", F.coalesce(F.lag("_upto").over(along), F.lit(0)).alias("_gone"), F.last("_head", ignorenulls=True).over(before).alias("_head")
    )
    pieces = join_small(load(chunk), begins, ["file", "part"])
    goes_on = F.col("serial") == 0
    own = F.struct("part", "serial", "name")
    pieces = pieces.select(
        "file", F.when(goes_on, F.col("_head")).otherwise(own).alias("head"), (F.col("place") + F.when(goes_on, F.col("_gone")).otherwise(0)).alias("at"), "seq"
    ).filter("head is not null")
    # A piece lies in two chunks at most; a chunk is put together from the pieces of few ranges.
    first = F.floor(F.col("at") / chunk)
    cut = ((first + 1) * chunk - F.col("at")).cast("int")
    halves = F.array(
        F.struct(first.alias("k"), F.col("at").alias("at"), F.substr("seq", F.lit(1), cut).alias("seq")),
        F.struct((first + 1).alias("k"), ((first + 1) * chunk).alias("at"), F.substr("seq", cut + 1).alias("seq")),
    )
    cuts = pieces.select("file", "head", F.inline(F.filter(halves, lambda h: F.length(h["seq"]) > 0)))
    whole = cuts.groupBy("file", "head", "k").agg(F.array_sort(F.collect_list(F.struct("at", "seq"))).alias("parts"))
    return whole.select(F.col("head.name").alias("rname"), (F.col("k") * chunk).cast("int").alias("start"), F.array_join("parts.seq", "").alias("seq"))
