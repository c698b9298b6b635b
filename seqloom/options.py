"""Eager checks of operator options."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def choice(name: str, value: object, allowed: Iterable[object]) -> None:
    allowed = list(allowed)
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


def positive(name: str, value: float) -> None:
    if value <= 0:
        raise ValueError(f"{name} must be positive, not {value!r}")


def require(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")


def fail_when(bad: Column, message: Column, otherwise: Column) -> Column:
    """``otherwise``, or a run-time error carrying the row's own key where ``bad`` holds."""
    return F.when(bad, F.raise_error(message).cast("string")).otherwise(otherwise)
