"""CIGAR strings as expressions: lengths, gaps, blocks, collapsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..options import choice

# Operations counted as reference length, per convention.
REF_OPS = {
    "standard": ("M", "D", "N", "=", "X"),
    "ungapped": ("M", "D", "X", "="),  # deletions count, splice gaps do not
    "read": ("M", "I", "S", "=", "X"),  # every read base counts
}
QUERY_OPS = ("M", "I", "S", "=", "X")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ops(cigar: Column | str = "cigar") -> Column:
    """``array<struct<n int, op string>>``; empty for ``*``."""
    pieces = F.regexp_extract_all(_col(cigar), F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(0))
    return F.transform(
        pieces,
        lambda p: F.struct(
            F.substr(p, F.lit(1), F.length(p) - 1).cast("int").alias("n"),
            F.substring(p, -1, 1).alias("op"),
        ),
    )


def _sum_of(cigar: Column | str, kinds: tuple[str, ...]) -> Column:
    kept = F.filter(ops(cigar), lambda o: o["op"].isin(*kinds))
    return F.aggregate(kept, F.lit(0), lambda acc, o: acc + o["n"])


# The commonest shapes need no walk over operations: one M run, possibly clipped, and one gap between M runs.
_ONE_RUN = r"^(?:\d+[SH])*(\d+)M(?:\d+[SH])*$"
_ONE_GAP = r"^(?:\d+[SH])*(\d+)M(\d+)N(\d+)M(?:\d+[SH])*$"


def _int(cigar: Column | str, pattern: str, group: int) -> Column:
    return F.regexp_extract(_col(cigar), pattern, group).cast("int")


def _pure_len(cigar: Column | str) -> Column:
    c = _col(cigar)
    return F.substr(c, F.lit(1), F.length(c) - 1).cast("int")


def ref_len(cigar: Column | str = "cigar", *, mode: str = "standard") -> Column:
    choice("mode", mode, REF_OPS)
    walked = _sum_of(cigar, REF_OPS[mode])
    if mode == "read":
        return F.when(_col(cigar).rlike(r"^\d+M$"), _pure_len(cigar)).otherwise(walked)
    return F.when(_col(cigar).rlike(_ONE_RUN), _int(cigar, _ONE_RUN, 1)).otherwise(walked)


def query_len(cigar: Column | str = "cigar") -> Column:
    return F.when(_col(cigar).rlike(r"^\d+M$"), _pure_len(cigar)).otherwise(_sum_of(cigar, QUERY_OPS))


def max_gap(cigar: Column | str = "cigar") -> Column:
    """Longest ``N`` gap, 0 when there is none."""
    gaps = F.filter(ops(cigar), lambda o: o["op"] == "N")
    return F.coalesce(F.array_max(F.transform(gaps, lambda o: o["n"])), F.lit(0))


def start0(pos: Column | str = "pos") -> Column:
    return _col(pos) - F.lit(1)


def end0(pos: Column | str = "pos", cigar: Column | str = "cigar") -> Column:
    return _col(pos) - F.lit(1) + ref_len(cigar)


def blocks(pos: Column | str = "pos", cigar: Column | str = "cigar") -> Column:
    """Aligned stretches between ``N`` gaps, ``array<struct<start int, end int>>`` (0-based)."""
    first = start0(pos)
    state = F.struct(
        first.alias("at"), first.alias("stop"), F.array().cast("array<struct<start:int,end:int>>").alias("done")
    )

    def step(acc: Column, o: Column) -> Column:
        gap = o["op"] == "N"
        moves = o["op"].isin("M", "D", "=", "X")
        after = F.when(gap | moves, acc["stop"] + o["n"]).otherwise(acc["stop"])
        closed = F.concat(acc["done"], F.array(F.struct(acc["at"].alias("start"), acc["stop"].alias("end"))))
        return F.struct(
            F.when(gap, after).otherwise(acc["at"]).alias("at"),
            after.alias("stop"),
            F.when(gap, closed).otherwise(acc["done"]).alias("done"),
        )

    def finish(acc: Column) -> Column:
        every = F.concat(acc["done"], F.array(F.struct(acc["at"].alias("start"), acc["stop"].alias("end"))))
        return F.filter(every, lambda b: b["end"] > b["start"])

    size = ref_len(cigar)
    whole = F.array(F.struct(first.alias("start"), (first + size).alias("end")))
    gapless = F.when(size > 0, whole).otherwise(F.array().cast("array<struct<start:int,end:int>>"))
    head, gap, tail = (_int(cigar, _ONE_GAP, g) for g in (1, 2, 3))
    two = F.array(
        F.struct(first.alias("start"), (first + head).alias("end")),
        F.struct((first + head + gap).alias("start"), (first + head + gap + tail).alias("end")),
    )
    gapped = F.when(_col(cigar).rlike(_ONE_GAP), two).otherwise(F.aggregate(ops(cigar), state, step, finish))
    return F.when(F.contains(_col(cigar), F.lit("N")), gapped).otherwise(gapless)


def introns(pos: Column | str = "pos", cigar: Column | str = "cigar") -> Column:
    """The ``N`` gaps as ``array<struct<start int, end int>>`` (0-based)."""
    b = blocks(pos, cigar)
    return F.transform(
        F.slice(b, 2, F.greatest(F.size(b) - 1, F.lit(0))),
        lambda x, i: F.struct(F.element_at(b, i + 1)["end"].alias("start"), x["start"].alias("end")),
    )


def clip_before(cigar: Column | str = "cigar") -> Column:
    """Bases clipped (S or H) before the first aligned base."""
    return _clip(cigar, F.regexp_extract(_col(cigar), r"^((?:\d+[SH])*)", 1))


def clip_after(cigar: Column | str = "cigar") -> Column:
    return _clip(cigar, F.regexp_extract(_col(cigar), r"((?:\d+[SH])*)$", 1))


def _clip(cigar: Column | str, part: Column) -> Column:
    clipped = _col(cigar).rlike("[SH]")
    return F.when(clipped, F.aggregate(ops(part), F.lit(0), lambda acc, o: acc + o["n"])).otherwise(0)


def five_prime(pos: Column | str = "pos", cigar: Column | str = "cigar", reverse: Column | None = None) -> Column:
    """Unclipped 5' position (0-based base) of the read."""
    return F.when(reverse, end0(pos, cigar) - 1 + clip_after(cigar)).otherwise(start0(pos) - clip_before(cigar))


def collapse(cigar: Column | str = "cigar") -> Column:
    """Merge runs of ``= X M`` into one ``M``; other operations are kept, ``*`` stays ``*``."""
    col = _col(cigar)
    empty = F.struct(F.lit("").alias("text"), F.lit(0).alias("m"))

    def flush(acc: Column) -> Column:
        return F.when(acc["m"] > 0, F.concat(acc["text"], acc["m"].cast("string"), F.lit("M"))).otherwise(acc["text"])

    def step(acc: Column, o: Column) -> Column:
        match = o["op"].isin("=", "X", "M")
        return F.struct(
            F.when(match, acc["text"]).otherwise(F.concat(flush(acc), o["n"].cast("string"), o["op"])).alias("text"),
            F.when(match, acc["m"] + o["n"]).otherwise(F.lit(0)).alias("m"),
        )

    return F.when(col == "*", col).otherwise(F.aggregate(ops(cigar), empty, step, flush))
