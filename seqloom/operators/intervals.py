"""Range joins and interval merging on 0-based half-open intervals.

Everything ordered along a sequence works on tiles: rows are first combined per coordinate, so a
tile's window holds at most one row per base of the tile, and only one summary row per tile
crosses tile borders. Neither a long sequence nor a hot locus ends up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..options import choice, positive

TILE = 1 << 16
#: Bins of ``overlap_join`` that are split by count at most: bounds the table of split bins, which is broadcast.
HOT_BINS = 10_000
#: Type of running sums over other columns.
WIDE = "decimal(24,0)"
#: Tasks a single bin is split over at most.
MOST_PARTS = 4096


def bin_of(position: Column, size: int) -> Column:
    return F.floor(position / F.lit(size)).cast("bigint")


def pick_bin(df: DataFrame, *, lower: int = 1024, upper: int = 16384) -> int:
    """Power of two near the median interval length, for ``overlap_join`` (one small job)."""
    row = df.agg(F.percentile_approx(F.col("end") - F.col("start"), 0.5).alias("m")).first()
    size = lower
    while size < min(row["m"] or lower, upper):
        size *= 2
    return size


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    *,
    how: str = "inner",
    min_overlap: int = 1,
    min_fraction: float = 0.0,
    stranded: str = "no",
    bin_size: int = 4096,
    key: Sequence[str] | None = None,
    by: Sequence[str] = (),
    salt: int = 1,
    hot_rows: int | None = None,
    per: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """Pairs of intervals sharing at least ``min_overlap`` bases (negative: at most that far apart).

    Right columns other than ``rname`` come out prefixed ``r_``, with the shared bases as ``overlap``.
    Both sides are cut into bins for an equi-join; a pair is reported only in the bin where the
    later of the two begins, so nothing needs a distinct. ``semi``, ``anti`` and ``left`` need the
    left row's ``key`` columns. ``by`` columns must be equal too and come out once. ``salt`` spreads every bin of the left side over that many tasks.
    With ``hot_rows`` the left rows are counted per bin first, and a bin of more is split into parts of about so many rows: only there are right
    rows repeated, once per part. That concerns the ``HOT_BINS`` fullest bins; fuller tables leave the rest to adaptive execution.

    ``per`` (``left`` or ``right``) gives, instead of pairs, the rows of that side with ``n`` partners and the ``shared`` bases of all of them; the other
    side's column ``weight`` is the multiplicity of its rows. Rows without a partner come with zeros under ``how="left"``, else not at all.
    A row that meets intervals without an end comes a second time with the totals of these, so totals are to be summed by the caller's key.
    Totals, ``semi`` and ``anti`` come from running sums along the sequence, so a crowded locus costs no pairs; bins, salt and ``hot_rows`` do not matter there.
    """
    choice("how", how, ("inner", "left", "semi", "anti"))
    choice("stranded", stranded, ("no", "same", "opposite"))
    positive("bin_size", bin_size)
    positive("salt", salt)
    if hot_rows is not None:
        positive("hot_rows", hot_rows)
    choice("per", per, (None, "left", "right"))
    if per is not None:
        if how not in ("inner", "left") or min_fraction > 0 or (how, per) == ("left", "right"):
            raise ValueError(f"per={per!r} goes with how='inner' and, for the left side, how='left', without min_fraction")
        one, other = (left, right) if per == "left" else (right, left)
        out = partners(one, other, min_overlap=min_overlap, stranded=stranded, by=by, weight=weight)
        out = out if how == "left" else out.filter("n > 0")
        more = _open_pairs(left, right, min_overlap=min_overlap, stranded=stranded, bin_size=bin_size, by=by)
        once = {"rname", *by}
        mine = [F.col(c if per == "left" or c in once else f"r_{c}").alias(c) for c in one.columns]
        times = F.lit(1) if weight is None else F.col(weight if per == "right" or weight in once else f"r_{weight}")
        return out.unionByName(more.groupBy(*mine).agg(F.sum(times).alias("n"), F.sum(F.col("overlap") * times).cast("bigint").alias("shared")))
    if how != "inner" and not key:
        raise ValueError(f"how={how!r} needs key columns of the left side")
    if how in ("semi", "anti") and not (min_fraction > 0 and stranded == "opposite"):
        if min_fraction > 0:
            matched = _covered(left, right, min_overlap, min_fraction, stranded, by, bin_size, key)
        else:
            matched = partners(left, right, min_overlap=min_overlap, stranded=stranded, by=by).filter("n > 0").select(*key)
        more = _open_pairs(left, right, min_overlap=min_overlap, min_fraction=min_fraction, stranded=stranded, bin_size=bin_size, by=by)
        matched = matched.unionByName(more.select(*key)).distinct()
        return left.join(matched, list(key), f"left_{how}")
    reach = max(0, -min_overlap)
    # Intervals that only touch meet in the bin of the base behind the first one.
    last = 1 if min_overlap > 0 else 0

    def bins(start: Column, end: Column) -> Column:
        return F.sequence(bin_of(start, bin_size), bin_of(F.greatest(end - last, start), bin_size))

    a = left.select("*", F.explode(bins(F.col("start"), F.col("end"))).alias("_bin"))
    once = ["rname", *by]
    b = right.select(*once, *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in once])
    b = b.select("*", F.explode(bins(F.col("r_start") - reach, F.col("r_end") + reach)).alias("_bin"))
    on = [*once, "_bin"]
    if salt > 1:
        a = a.withColumn("_salt", F.pmod(F.xxhash64(*left.columns), F.lit(salt)).cast("int"))
        b = b.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salt)])))
        on.append("_salt")
    if hot_rows is not None:
        a, b = _split_hot(a, b, on, left.columns, hot_rows)
        on.append("_part")
    overlap = F.least("end", "r_end") - F.greatest("start", "r_start")
    home = F.greatest(bin_of(F.col("start"), bin_size), bin_of(F.col("r_start") - reach, bin_size))
    cond = (overlap >= min_overlap) & (F.col("_bin") == home)
    if min_fraction > 0:
        cond = cond & (overlap >= min_fraction * (F.col("end") - F.col("start")))
    if stranded == "same":
        cond = cond & (F.col("strand") == F.col("r_strand"))
    elif stranded == "opposite":
        cond = cond & (F.col("strand") != F.col("r_strand"))
    pairs = a.join(b, on).filter(cond).withColumn("overlap", overlap).drop("_bin", "_salt", "_part")
    if how == "inner":
        return pairs
    matched = pairs.select(*key).distinct()
    if how == "semi":
        return left.join(matched, list(key), "left_semi")
    alone = left.join(matched, list(key), "left_anti")
    return alone if how == "anti" else pairs.unionByName(alone, allowMissingColumns=True)


def _open_pairs(left: DataFrame, right: DataFrame, **opts) -> DataFrame:
    """Pairs in which a side's end is NULL; such an interval meets what it overlaps in the bin of its start."""
    met = overlap_join(left.filter(F.col("end").isNull()), right, **opts)
    return met.unionByName(overlap_join(left.filter(F.col("end").isNotNull()), right.filter(F.col("end").isNull()), **opts))


def _split_hot(a: DataFrame, b: DataFrame, on: Sequence[str], columns: Sequence[str], hot_rows: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_part``: left rows dealt over the parts of their bin by a hash, right rows once per part."""
    counted = a.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    fullest = counted.orderBy(F.col("_n").desc(), *on).limit(HOT_BINS)
    hot = F.broadcast(fullest.select(*on, F.least(F.ceil(F.col("_n") / hot_rows), F.lit(MOST_PARTS)).cast("int").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1))
    kinds = dict(a.dtypes)
    part = F.pmod(F.xxhash64(*[c for c in columns if "map<" not in kinds[c]]), parts)  # of the row itself, so that retries agree
    a = a.join(hot, list(on), "left").withColumn("_part", part.cast("int")).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), parts - 1))
    return a, b.join(hot, list(on), "left").withColumn("_part", every).drop("_parts")


def running_at(events: DataFrame, points: DataFrame, values: dict[str, str], *, by: Sequence[str], tile: int = TILE) -> DataFrame:
    """Per (``by``, ``pos``) of ``points`` and ``events`` the running ``values`` over the events at ``pos`` or before.

    ``values`` names a column of the events and how it adds up: sum, min or max. One summary row per tile carries them over the border.
    """
    by = list(by)
    fold = {v: getattr(F, f) for v, f in values.items()}
    kinds = dict(events.dtypes)
    asked = points.select(*by, F.col("pos").cast("bigint").alias("pos"), *[F.lit(None).cast(kinds[v]).alias(v) for v in values])
    every = events.select(*by, F.col("pos").cast("bigint").alias("pos"), *values).unionByName(asked)
    each = with_tile(every, "pos", by, tile).groupBy(*by, "_tile", "pos").agg(*[fold[v](v).alias(v) for v in values])
    tiles = each.groupBy(*by, "_tile").agg(*[fold[v](v).alias(v) for v in values])
    tiles = tiles.select(*by, "_tile", *[fold[v](v).over(_before(by, "_tile")).alias(f"_c_{v}") for v in values])
    upto = Window.partitionBy(*by, "_tile").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = each.withColumns({f"_i_{v}": fold[v](v).over(upto) for v in values}).join(tiles, [*by, "_tile"])

    def total(v: str) -> Column:
        carried, here = F.col(f"_c_{v}"), F.col(f"_i_{v}")
        if values[v] == "sum":
            return F.coalesce(carried, F.lit(0)) + F.coalesce(here, F.lit(0))
        best = F.when(carried < here, carried) if values[v] == "min" else F.when(carried > here, carried)
        return F.coalesce(best, here, carried)

    return inside.select(*by, "pos", *[total(v).alias(v) for v in values])


def look_up(rows: DataFrame, events: DataFrame, values: dict[str, str], points: dict[str, tuple[Column, Sequence[str]]], *, by: Sequence[str]) -> DataFrame:
    """``rows`` with running values of ``events``: for each name of ``points`` (position, values) the columns ``name_value``."""
    by = list(by)
    places = rows.select(*by, F.explode(F.array(*[p.cast("bigint") for p, _ in points.values()])).alias("pos"))
    return _read_off(rows, running_at(events, places, values, by=by), points, by)


def _read_off(rows: DataFrame, table: DataFrame, points: dict[str, tuple[Column, Sequence[str]]], by: Sequence[str]) -> DataFrame:
    for name, (at, wanted) in points.items():
        side = table.select(*by, F.col("pos").alias("_pos"), *[F.col(v).alias(f"{name}_{v}") for v in wanted])
        rows = rows.withColumn("_pos", at.cast("bigint")).join(side, [*by, "_pos"], "left").drop("_pos")
    return rows


def partners(
    rows: DataFrame, others: DataFrame, *, min_overlap: int = 1, stranded: str = "no", by: Sequence[str] = (), weight: str | None = None,
    sums: dict[str, Column] | None = None, shared: bool = True,
) -> DataFrame:
    """``rows`` with ``n``, the number of ``others`` sharing at least ``min_overlap`` bases, and ``shared``, the bases of all of them.

    Of intervals no shorter than ``min_overlap``, those that begin too late and those that end too early are different ones, so a partner count
    is a difference of two running counts, and sums of ``others`` columns (``sums``: name and whole number, null as 0) likewise.
    """
    group = ["rname", *by, *(["strand"] if stranded != "no" else [])]
    m, sums = min_overlap, sums or {}
    start, end = F.col("start").cast("bigint"), F.col("end").cast("bigint")
    w = (F.col(weight) if weight else F.lit(1)).cast("bigint")
    fit = others.filter(end - start >= m)
    if stranded != "no":
        fit = fit.filter("strand is not null")
    bases = {"_s": w * start, "_e": w * end} if shared else {}
    begin = {"_ns": w, **({"_ss": bases["_s"]} if shared else {}), **{f"_b_{k}": c for k, c in sums.items()}}
    close = {"_ne": w, **({"_se": bases["_e"]} if shared else {}), **{f"_f_{k}": c for k, c in sums.items()}}

    def event(at: Column, set_: dict[str, Column], unset: dict[str, Column]) -> Column:
        both = {**{k: F.coalesce(c, F.lit(0)) for k, c in set_.items()}, **dict.fromkeys(unset, F.lit(0))}
        return F.struct(at.alias("pos"), *[both[k].cast(WIDE if k[:3] in ("_b_", "_f_") else "bigint").alias(k) for k in [*begin, *close]])

    events = fit.select(*group, F.inline(F.array(event(start, begin, close), event(end, close, begin))))
    values = {v: "sum" for v in [*begin, *close]}
    at = {
        "a": (end - m, [v for v in begin]), "b": (start + (m - 1), [v for v in close]),
        **({"c": (start, ["_ns", "_ss"]), "d": (end - 1, ["_ne", "_se"])} if shared else {}),
    }
    points: dict[str, tuple[Column, list[str]]] = dict(at)
    if m == 1 and shared:
        # Two positions only: the last base and the first one.
        points = {"a": (at["a"][0], [*begin, "_ne", "_se"]), "b": (at["b"][0], [*close, "_ns", "_ss"])}
    places = rows.select(*group, F.explode(F.array(*[p.cast("bigint") for p, _ in points.values()])).alias("pos"))
    table = running_at(events, places, values, by=group)
    if stranded == "opposite":
        # The other strands are all of them less the own one.
        wide = [c for c in group if c != "strand"]
        whole = running_at(events, places, values, by=wide).withColumnsRenamed({v: f"_w{v}" for v in values})
        table = table.join(whole, [*wide, "pos"]).select(*group, "pos", *[(F.col(f"_w{v}") - F.col(v)).alias(v) for v in values])
    found = _read_off(rows, table, points, group)

    def got(name: str, value: str) -> Column:
        if m == 1 and shared and name in "cd":
            name = {"c": "b", "d": "a"}[name]
        return F.coalesce(F.col(f"{name}_{value}"), F.lit(0))

    long = end - start >= m
    out = {"n": F.when(long, got("a", "_ns") - got("b", "_ne")).otherwise(0).cast("bigint")}
    for k in sums:
        out[k] = F.when(long, got("a", f"_b_{k}") - got("b", f"_f_{k}")).otherwise(0)
    if shared:
        ends = got("d", "_se") + end * (got("a", "_ns") - got("d", "_ne")) - got("b", "_se")
        starts = start * (got("c", "_ns") - got("b", "_ne")) + got("a", "_ss") - got("c", "_ss")
        out["shared"] = F.when(long, ends - starts).otherwise(0).cast("bigint")
    return found.select(*rows.columns, *[c.alias(k) for k, c in out.items()])


def _covered(
    left: DataFrame, right: DataFrame, min_overlap: int, min_fraction: float, stranded: str, by: Sequence[str], bin_size: int, key: Sequence[str]
) -> DataFrame:
    """Keys of the left rows that share a fraction of their bases with some right row.

    Of the right rows beginning at or before a left row the one reaching furthest shares most; of those reaching its end or further the one beginning
    first does. Rows that neither decides meet the right rows inside them, of which those lying in another right row are left out.
    """
    group = ["rname", *by, *(["strand"] if stranded == "same" else [])]
    start, end = F.col("start").cast("bigint"), F.col("end").cast("bigint")
    side = right.select(*group, start.alias("start"), end.alias("end")).filter("end is not null and start is not null").distinct()
    need = F.greatest(F.lit(min_overlap).cast("bigint"), F.ceil((F.col("end") - F.col("start")) * F.lit(min_fraction)))
    rows = left.select(*dict.fromkeys([*key, *group, "start", "end"])).withColumn("_need", need).filter("start is not null and end is not null")
    ahead = side.select(*group, F.col("start").alias("pos"), F.col("end").alias("_reach"))
    behind = side.select(*group, (-F.col("end")).alias("pos"), F.col("start").alias("_from"))
    rows = look_up(rows, ahead, {"_reach": "max"}, {"p": (start, ["_reach"])}, by=group)
    rows = look_up(rows, behind, {"_from": "min"}, {"q": (-end, ["_from"])}, by=group)
    over = F.least(end, F.col("p__reach")) - start >= F.col("_need")
    under = end - F.greatest(start, F.col("q__from")) >= F.col("_need")
    judged = rows.withColumn("_ok", F.coalesce(F.col("p__reach").isNotNull() & over, F.lit(False)) | F.coalesce(F.col("q__from").isNotNull() & under, F.lit(False)))
    sure = judged.filter("_ok").select(*key)
    if min_fraction >= 1:
        # A right row inside a left one is shorter than it.
        return sure.distinct()
    widest = side.groupBy(*group).agg(F.max(F.col("end") - F.col("start")).alias("_widest"))
    open_ = judged.filter(~F.col("_ok")).join(widest, group).filter("_need <= _widest")
    chain = side.groupBy(*group, "start").agg(F.max("end").alias("end"))
    chain = look_up(chain, ahead, {"_reach": "max"}, {"p": (F.col("start") - 1, ["_reach"])}, by=group)
    chain = chain.filter("p__reach is null or end > p__reach").select(*group, "start", "end")
    spots = open_.select(*group, "start", "end").distinct()
    inside = overlap_join(
        spots, chain, min_overlap=min_overlap, min_fraction=min_fraction, bin_size=bin_size, by=[c for c in group if c != "rname"]
    ).select(*group, "start", "end").distinct()
    return sure.unionByName(open_.join(inside, [*group, "start", "end"], "left_semi").select(*key)).distinct()


def nearest(
    left: DataFrame, right: DataFrame, *, max_distance: int, key: Sequence[str], bin_size: int = 4096, stranded: str = "no"
) -> DataFrame:
    """Closest right interval within ``max_distance`` per left ``key`` (ties: smaller start, end), with ``distance``.

    Of the right intervals ending at or behind a row's start the least one either meets the row or is the first behind it; of those ending before,
    the last one counts. Both are running values, so no pairs are formed but with intervals that have no end.
    """
    choice("stranded", stranded, ("no", "same", "opposite"))
    rest = [c for c in right.columns if c not in ("rname", "start", "end")]
    group = ["rname", *(["_side"] if stranded != "no" else [])]
    rows, side = left.select(*dict.fromkeys([*key, "rname", "start", "end", *(["strand"] if stranded != "no" else [])])), right.filter("end >= start")
    if stranded != "no":
        side = side.filter("strand is not null").withColumn("_side", F.col("strand"))
    if stranded == "same":
        rows = rows.withColumn("_side", F.col("strand"))
    elif stranded == "opposite":
        # A few strands: one row each.
        rows = rows.join(F.broadcast(side.select("_side").distinct()), F.col("strand") != F.col("_side"))
    rows = rows.filter("start is not null and end is not null")
    one = F.struct(F.col("start").alias("r_start"), F.col("end").alias("r_end"), *[F.col(c).alias(f"r_{c}") for c in rest])
    least = side.groupBy(*group, "end").agg(F.min(one).alias("_b"))
    meets = look_up(rows, least.select(*group, (-F.col("end")).alias("pos"), "_b"), {"_b": "min"}, {"m": (-F.col("start"), ["_b"])}, by=group)
    last = least.select(*group, F.col("end").alias("pos"), F.struct("end", "_b").alias("_b"))
    both = look_up(meets, last, {"_b": "max"}, {"l": (F.col("start") - 1, ["_b"])}, by=group)
    found = both.select(*key, "start", "end", F.explode(F.array(F.col("m__b"), F.col("l__b._b"))).alias("r")).filter("r is not null")
    overlap = F.least("end", "r.r_end") - F.greatest("start", "r.r_start")
    found = found.withColumn("distance", F.greatest(-overlap, F.lit(0))).filter(F.col("distance") <= max_distance)
    picked = ["distance", "r_start", "r_end", *[f"r_{c}" for c in rest]]
    near = _open_pairs(left, right, min_overlap=-max_distance, stranded=stranded, bin_size=bin_size)
    near = near.withColumn("distance", F.greatest(-F.col("overlap"), F.lit(0))).select(*key, *picked)
    found = found.select(*key, "distance", *[f"r.{c}" for c in picked[1:]]).unionByName(near)
    best = F.min(F.struct(*picked)).alias("b")
    return found.groupBy(*key).agg(best).select(*key, "b.*")


def _before(by: Sequence[str], order: str) -> Window:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def with_tile(df: DataFrame, position: str, by: Sequence[str], tile: int) -> DataFrame:
    tiled = df.withColumn("_tile", bin_of(F.col(position), tile))
    return tiled.filter(F.col("_tile").isNotNull())


def merge_intervals(df: DataFrame, *, gap: int = 0, by: Sequence[str] = ("rname",), tile: int = TILE) -> DataFrame:
    """Merge intervals that overlap, touch or lie at most ``gap`` apart; ``n`` counts the merged rows."""
    by = list(by)
    within = Window.partitionBy(*by, "_tile").orderBy("start")
    starts = with_tile(df, "start", by, tile).groupBy(*by, "_tile", "start").agg(
        F.max("end").alias("end"), F.count(F.lit(1)).alias("n")
    )
    tiles = starts.groupBy(*by, "_tile").agg(F.max("end").alias("_end"))
    tiles = tiles.withColumn("_reach0", F.max("_end").over(_before(by, "_tile"))).drop("_end")
    reach = F.greatest(F.col("_reach0"), F.max("end").over(within.rowsBetween(Window.unboundedPreceding, -1)))
    heads = starts.join(tiles, [*by, "_tile"]).withColumn("_reach", reach)
    is_head = F.col("_reach").isNull() | (F.col("start") > F.col("_reach") + gap)
    heads = heads.withColumn("_head", F.when(is_head, F.col("start"))).drop("_reach0", "_reach")
    last = heads.groupBy(*by, "_tile").agg(F.max("_head").alias("_h"))
    last = last.withColumn("_head0", F.max("_h").over(_before(by, "_tile"))).drop("_h")
    island = F.coalesce(F.max("_head").over(within.rowsBetween(Window.unboundedPreceding, 0)), F.col("_head0"))
    named = heads.join(last, [*by, "_tile"]).withColumn("_island", island)
    return named.groupBy(*by, F.col("_island").alias("start")).agg(F.max("end").alias("end"), F.sum("n").alias("n"))


def step_runs(steps: DataFrame, values: Sequence[str], *, by: Sequence[str], tile: int = TILE) -> DataFrame:
    """Runs between neighbouring positions with the running sums of ``values`` on them.

    ``steps`` may have several rows per (``by``, ``pos``), which are added up; a position where nothing changes
    ends no run unless a row there has ``fixed`` set. The last position of a group only ends a run. One summary row per tile
    carries the sums and the next tile's first position over the border.
    """
    by = list(by)
    # The keys are filtered here, on both uses of the rows, so that Spark computes and shuffles them once.
    tiled = with_tile(steps, "pos", by, tile)
    fixed = [F.max("fixed").alias("fixed")] if "fixed" in steps.columns else []
    tiled = tiled.groupBy(*by, "_tile", "pos").agg(*[F.sum(v).alias(v) for v in values], *fixed)
    tiled = tiled.filter(" or ".join([f"{v} <> 0" for v in values] + (["fixed = 1"] if fixed else []))).drop("fixed")
    tiles = tiled.groupBy(*by, "_tile").agg(*[F.sum(v).alias(f"_t_{v}") for v in values], F.min("pos").alias("_first"))
    before = _before(by, "_tile")
    tiles = tiles.select(
        *by, "_tile", F.lead("_first").over(Window.partitionBy(*by).orderBy("_tile")).alias("_next"),
        *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_c_{v}") for v in values],
    )
    along = Window.partitionBy(*by, "_tile").orderBy("pos")
    upto = along.rowsBetween(Window.unboundedPreceding, 0)
    sums = [(F.col(f"_c_{v}") + F.sum(v).over(upto)).alias(v) for v in values]
    end = F.coalesce(F.lead("pos").over(along), F.col("_next")).alias("end")
    runs = tiled.join(tiles, [*by, "_tile"]).select(*by, F.col("pos").alias("start"), end, *sums)
    return runs.filter("end is not null")


def join_equal_runs(runs: DataFrame, column: str, *, by: Sequence[str], tile: int = TILE) -> DataFrame:
    """Join touching runs whose ``column`` is equal."""
    return merge_intervals(runs, by=[*by, column], tile=tile).drop("n")


def explode_range(df: DataFrame, first: Column, last: Column, name: str, *, chunk: int = 10000) -> DataFrame:
    """One row per number of ``first..last``; long ranges are laid out chunk by chunk, never as one array."""
    spans = df.withColumns({"_lo": first.cast("bigint"), "_to": last.cast("bigint")}).filter("_to >= _lo")
    spans = spans.withColumn("_c", F.explode(F.sequence(F.lit(0), F.floor((F.col("_to") - F.col("_lo")) / chunk).cast("int"))))
    start = F.col("_lo") + F.col("_c").cast("bigint") * chunk
    every = F.explode(F.sequence(start, F.least(start + (chunk - 1), F.col("_to"))))
    return spans.withColumn(name, every).drop("_lo", "_to", "_c")


def grid(chrom_sizes: DataFrame, *, bin_size: int, step: int | None = None) -> DataFrame:
    """All bins (rname, bin, start, end) of the sequences."""
    step = step or bin_size
    bins = explode_range(chrom_sizes, F.lit(0), F.ceil(F.col("length") / F.lit(step)) - 1, "bin")
    return bins.select(
        "rname", "bin", (F.col("bin") * step).cast("int").alias("start"),
        F.least(F.col("bin") * step + bin_size, F.col("length")).cast("int").alias("end"),
    )


def with_samples(df: DataFrame, samples: Sequence[str]) -> DataFrame:
    """Repeat every row for each sample name of the given list."""
    return df.withColumn("sample", F.explode(F.array(*[F.lit(s) for s in samples])))
