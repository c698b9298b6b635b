"""Run registered queries on Spark and their oracle SQL in DuckDB and compare the rows."""

from __future__ import annotations

import math
import time

import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def oracle_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads=8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _kind(series: pd.Series) -> str:
    kind = series.dtype.kind
    if kind in "iu":
        return "int"
    if kind == "f":  # pandas turns whole numbers with nulls into floats
        return "int" if series.isna().any() and (series.dropna() % 1 == 0).all() else "float"
    if kind == "b":
        return "bool"
    first = next((x for x in series if x is not None and not (isinstance(x, float) and math.isnan(x))), None)
    return type(first).__name__ if first is not None else "empty"


def _cell(x: object) -> object:
    if x is None or x is pd.NA:
        return None
    if isinstance(x, float):
        if math.isnan(x):
            return None
        return float(f"{x:.9g}") + 0.0
    return x.item() if hasattr(x, "item") else x


def rows_of(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    data = [tuple(map(_cell, r)) for r in pdf[cols].astype(object).itertuples(index=False, name=None)]
    return cols, sorted(data, key=repr)


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame) -> str | None:
    """``None`` when equal, else what differs first."""
    ca, a = rows_of(spark_pdf)
    cb, b = rows_of(oracle_pdf)
    if ca != cb:
        return f"columns {ca} != {cb}"
    ka = {c: _kind(spark_pdf[c]) for c in ca}
    kb = {c: _kind(oracle_pdf[c]) for c in cb}
    odd = {c: (ka[c], kb[c]) for c in ca if ka[c] != kb[c] and "empty" not in (ka[c], kb[c])}
    if odd:
        return f"types {odd}"
    if len(a) != len(b):
        only_a, only_b = set(a) - set(b), set(b) - set(a)
        return f"rows {len(a)} != {len(b)}; spark only {list(only_a)[:2]}; oracle only {list(only_b)[:2]}"
    if a != b:
        sa, sb = set(a), set(b)
        return f"cols {ca}; {len(sa - sb)} differ: spark {sorted(sa - sb, key=repr)[:2]} oracle {sorted(sb - sa, key=repr)[:2]}"
    return None


def check(spark, sf_dir: str, names: list[str], queries: dict, oracles: dict) -> dict[str, str]:
    """Message per query: ``ok``, ``rows`` (no oracle) or the difference."""
    con = oracle_connection(sf_dir)
    out: dict[str, str] = {}
    for name in names:
        t0 = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            t1 = time.time()
            if name not in oracles:
                out[name] = f"rows {len(got)} ({t1 - t0:.1f}s)"
                continue
            want = con.sql(oracles[name]).df()
            diff = compare(got, want)
            out[name] = f"{'ok' if diff is None else 'DIFF ' + diff} [{len(got)} rows, {t1 - t0:.1f}s, {time.time() - t1:.1f}s]"
            if diff is None and not len(got):
                out[name] = "EMPTY " + out[name]
        except Exception as e:  # noqa: BLE001 - reported per query
            out[name] = f"ERROR {type(e).__name__}: {str(e)[:400]}"
    return out
