"""Templates as counting units: the records of one sequenced fragment, collapsed by where they lie."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def unit_digest(unit: str) -> Column:
    """Two 64-bit hashes of a unit's placements, null for null: range joins and aggregates carry 16 bytes and no CIGAR texts."""
    return F.when(F.col(unit).isNotNull(), F.struct(F.xxhash64(unit).alias("a"), F.xxhash64(F.lit(1), unit).alias("b")))


def template_totals(records: DataFrame, *, key: Sequence[str], why: Column) -> DataFrame:
    """Templates per sample and reason (``sample, why, n``), without their placements."""
    per = records.groupBy(*key).agg(why.alias("why"))
    return per.groupBy("sample", "why").agg(F.count(F.lit(1)).alias("n"))


def placed_units(
    records: DataFrame, *, key: Sequence[str], place: Sequence[str], why: Column, used: Column, length: Column
) -> tuple[DataFrame, DataFrame]:
    """(``sample, why, unit, length, n`` of the templates; ``sample, unit, length, n`` and the ``place`` columns of each placement).

    The records of one ``key``, whose first column is ``sample``, are one template. ``why`` is an aggregate that says why it
    is left out, null when it counts; ``used`` marks the records that place it. Templates of up to two records
    that lie alike are one unit with a multiplicity ``n``, whatever their names: its key is the lesser and the greater
    placement, as a digest of 128 bits. A template of more records is a unit of its own. ``length`` is summed over a template's used records.
    """
    key, place = list(key), list(place)
    spot = F.when(used, F.struct(*place))
    per = records.groupBy(*key).agg(
        why.alias("why"), F.count(spot).alias("records"), F.min(spot).alias("lo"), F.max(spot).alias("hi"),
        F.sum(F.when(used, length)).alias("length"),
    )
    # Only a template of more than two records needs its name.
    name = F.when(F.col("records") > 2, F.to_json(F.struct(*key))).otherwise("")
    unit = F.when(F.col("why").isNull(), F.struct("lo", "hi", "records", name.alias("name")))
    per = per.withColumn("unit", unit)
    units = per.groupBy("sample", "why", "unit").agg(F.max("length").alias("length"), F.count(F.lit(1)).alias("n"))
    small = unit_digest("unit")
    lo, hi = F.col("unit.lo"), F.col("unit.hi")
    spots = F.when(F.col("unit.records") == 2, F.array(lo, hi)).otherwise(F.array(lo))
    few = units.filter("why is null and unit.records <= 2").select("sample", small.alias("unit"), "length", "n", F.inline(spots))
    large = per.filter("why is null and records > 2").select(*key, small.alias("unit"), "length")
    many = records.filter(used).join(large, key).select("sample", "unit", "length", F.lit(1).cast("bigint").alias("n"), *place)
    return units.withColumn("unit", small), few.unionByName(many)
