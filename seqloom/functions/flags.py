"""SAM flag bits as column predicates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# SAM flag bits.
PAIRED = 0x1
PROPER = 0x2
UNMAPPED = 0x4
MATE_UNMAPPED = 0x8
REVERSE = 0x10
MATE_REVERSE = 0x20
FIRST = 0x40
SECOND = 0x80
SECONDARY = 0x100
QC_FAIL = 0x200
DUPLICATE = 0x400
SUPPLEMENTARY = 0x800


def _col(flag: Column | str) -> Column:
    return F.col(flag) if isinstance(flag, str) else flag


def has(bits: int, flag: Column | str = "flag") -> Column:
    """Every bit of ``bits`` is set."""
    return _col(flag).bitwiseAND(F.lit(bits)) == bits


def lacks(bits: int, flag: Column | str = "flag") -> Column:
    """No bit of ``bits`` is set."""
    return _col(flag).bitwiseAND(F.lit(bits)) == 0


def put(bits: int, flag: Column | str = "flag") -> Column:
    return _col(flag).bitwiseOR(F.lit(bits))


def clear(bits: int, flag: Column | str = "flag") -> Column:
    return _col(flag).bitwiseAND(F.lit(~bits))


def put_if(cond: Column, bits: int, flag: Column | str = "flag") -> Column:
    return F.when(cond, put(bits, flag)).otherwise(_col(flag))


def strand(flag: Column | str = "flag") -> Column:
    return F.when(has(REVERSE, flag), F.lit("-")).otherwise(F.lit("+"))


def mate_number(flag: Column | str = "flag") -> Column:
    return F.when(has(SECOND, flag), F.lit(2)).otherwise(F.lit(1))
