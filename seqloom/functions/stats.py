"""Distribution tails as vectorised Pandas UDFs (Spark SQL has neither log-gamma nor Poisson)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType

LN10 = math.log(10.0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    values, inverse = np.unique(x, return_inverse=True)
    return np.array([math.lgamma(v) for v in values], dtype=float)[inverse]


def log_poisson_tail(k: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """ln P(X >= k) for X ~ Poisson(lam), summed from the first term on in log space."""
    k = np.asarray(k, dtype=float)
    lam = np.asarray(lam, dtype=float)
    out = np.zeros(len(k))
    todo = (k > 0) & (lam > 0)
    out[(k > 0) & ~(lam > 0)] = -np.inf
    if not todo.any():
        return out
    a, m = k[todo], lam[todo]
    # Below the mean the tail is 1 - head, above it the series from k on falls quickly.
    low = a <= m
    first = a * np.log(m) - m - log_gamma(a + 1)
    total, term, j = np.ones(len(a)), np.ones(len(a)), 0
    step_up = ~low
    while step_up.any():
        j += 1
        term = np.where(step_up, term * m / (a + j), 0.0)
        total += term
        step_up &= term > total * 1e-16
    res = first + np.log(total)
    if low.any():
        b, n = a[low], m[low]
        at = b - 1
        head_first = at * np.log(n) - n - log_gamma(at + 1)
        head, term = np.ones(len(b)), np.ones(len(b))
        alive = at > 0
        while alive.any():
            term = np.where(alive, term * at / n, 0.0)
            head += term
            at = at - 1
            alive &= (at > 0) & (term > head * 1e-16)
        res[low] = np.log1p(-np.minimum(np.exp(head_first + np.log(head)), 1.0 - 1e-16))
    out[todo] = res
    return out


@F.pandas_udf(DoubleType())
def _neg_log10_tail(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for k, lam in parts:
        # Rows of one batch mostly repeat a few pairs; each is computed once.
        both = np.empty(len(k), complex)
        both.real, both.imag = k.to_numpy(), lam.to_numpy()
        pairs, place = np.unique(both, return_inverse=True)
        yield pd.Series((-log_poisson_tail(pairs.real, pairs.imag) / LN10 + 0.0)[place])


def poisson_score(k: Column, lam: Column) -> Column:
    """-log10 P(X >= k) for X ~ Poisson(lam)."""
    return _neg_log10_tail(k.cast("double"), lam.cast("double"))


@F.pandas_udf(DoubleType())
def _log_choose(n: pd.Series, k: pd.Series) -> pd.Series:
    n, k = n.to_numpy(dtype=float), k.to_numpy(dtype=float)
    ok = (k >= 0) & (k <= n)
    out = np.full(len(n), -np.inf)
    out[ok] = log_gamma(n[ok] + 1) - log_gamma(k[ok] + 1) - log_gamma(n[ok] - k[ok] + 1)
    return pd.Series(out)


def log_choose(n: Column, k: Column) -> Column:
    """ln of the binomial coefficient, -infinity outside 0 <= k <= n."""
    return _log_choose(n.cast("double"), k.cast("double"))


#: Buckets per power of two in ``exact_medians``.
BUCKETS = 1024


def exact_medians(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(``by``, one median per column) over values of 0 or more, in two passes and without all values of a group in one task.

    A histogram over monotone buckets says in which bucket the middle ranks lie; only the different values of these buckets are ordered. Nulls do
    not count; the median of an even number is the mean of the two in the middle.
    """
    rows = F.array(*[F.struct(F.lit(c).alias("what"), F.col(c).cast("double").alias("value")) for c in columns])
    values = df.select(by, F.inline(rows)).filter("value is not null").groupBy(by, "what", "value").agg(F.count(F.lit(1)).alias("n"))
    bucket = F.when(F.col("value") > 0, F.floor(F.log2("value") * BUCKETS)).otherwise(F.lit(-(1 << 40))).cast("bigint")
    values = values.withColumn("bucket", bucket)
    whole = Window.partitionBy(by, "what")
    along = whole.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    hist = values.groupBy(by, "what", "bucket").agg(F.sum("n").alias("n"))
    hist = hist.select(by, "what", "bucket", "n", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"), F.sum("n").over(whole).alias("total"))
    ranks = F.array(F.floor((F.col("total") - 1) / 2), F.floor(F.col("total") / 2))
    middle = hist.select(by, "what", "bucket", "before", "n", F.posexplode(ranks).alias("side", "rank")).filter("rank >= before and rank < before + n")
    place = [by, "what", "bucket"]
    along = Window.partitionBy(*place).orderBy("value").rowsBetween(Window.unboundedPreceding, -1)
    inside = values.join(middle.select(*place).distinct(), place, "left_semi").withColumn("gone", F.coalesce(F.sum("n").over(along), F.lit(0)))
    wanted = middle.select(*place, "side", (F.col("rank") - F.col("before")).alias("rank"))
    found = inside.join(wanted, place).filter("rank >= gone and rank < gone + n")
    return found.groupBy(by).agg(*[(F.sum(F.when(F.col("what") == c, F.col("value"))) / 2).alias(c) for c in columns])
