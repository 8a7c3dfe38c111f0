"""Statistics: DataFrame aggregates where Spark has them, small numpy functions elsewhere."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def clean(value: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(value), value)


def mean(value: Column) -> Column:
    return F.avg(clean(value))


def variance(value: Column, compat: bool = False) -> Column:
    """Sample variance without NaN; ``compat`` divides by the count with NaN, less one."""
    return F.var_samp(clean(value)) * (F.count(clean(value)) - 1) / (F.count(value) - 1) if compat else F.var_samp(clean(value))


def variance_population(value: Column) -> Column:
    return F.var_pop(clean(value))


def median(value: Column) -> Column:
    return F.median(clean(value))


def pearson(x: Column, y: Column, compat: bool = False) -> Column:
    """Correlation; ``compat`` scales it by (n - 1) / n."""
    r = F.corr(x, y)
    return r * (F.count(F.lit(1)) - 1) / F.count(F.lit(1)) if compat else r


def permutation_p(x: np.ndarray, y: np.ndarray, rounds: int = 10_000, seed: int = 0) -> float:
    """The share of shuffles whose correlation is at least as strong."""
    draw = np.random.default_rng(seed)
    x, y = np.asarray(x, float), np.asarray(y, float)
    observed = abs(np.corrcoef(x, y)[0, 1])
    shuffled = np.array([draw.permutation(y) for _ in range(rounds)])
    z = (x - x.mean()) / x.std()
    r = (shuffled - y.mean()) @ z / (len(x) * y.std())
    return float((np.abs(r) >= observed - 1e-12).mean())


def hypergeometric_tail(shared: int, first: int, second: int, total: int) -> float:
    """Chance that two random sets of these sizes share ``shared`` or more of ``total``."""
    log = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    low = max(shared, first + second - total, 0)
    return min(1.0, sum(math.exp(log(first, k) + log(total - first, second - k) - log(total, second)) for k in range(low, min(first, second) + 1)))


def hypergeometric_tails(shared: Column, first: Column, second: Column, total: Column) -> Column:
    """``hypergeometric_tail`` of each row."""

    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([hypergeometric_tail(*map(int, x)) for x in zip(a, b, c, d, strict=True)])

    return tail(shared, first, second, total)


def log10_poisson_tails(observed: Column, expected: Column) -> Column:
    """``log10_poisson_tail`` of each row."""

    @F.pandas_udf("double")
    def tail(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([log10_poisson_tail(int(x), float(y)) for x, y in zip(a, b, strict=True)])

    return tail(observed, expected)


def permutation_ps(x: Column, y: Column, rounds: int = 10_000, seed: int = 0) -> Column:
    """``permutation_p`` of two arrays of each row."""

    @F.pandas_udf("double")
    def p(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([permutation_p(u, v, rounds, seed) for u, v in zip(a, b, strict=True)])

    return p(x, y)


def redistributed(first: Column, second: Column, share: float, key: Column, seed: int = 0) -> Column:
    """``redistribute`` of each row, as a struct (first, second); the draw depends on ``key`` and ``seed`` only."""

    @F.pandas_udf("first bigint, second bigint")
    def deal(a: pd.Series, b: pd.Series, k: pd.Series) -> pd.DataFrame:
        rows = [redistribute(int(u), int(v), share, [seed, int(w) & 0xFFFFFFFF]) for u, v, w in zip(a, b, k, strict=True)]
        return pd.DataFrame(rows, columns=["first", "second"])

    return deal(first, second, key.cast("bigint"))


def log10_poisson_tail(observed: int, expected: float) -> float:
    """log10 of the chance of ``observed`` or more events."""
    if observed <= 0:
        return 0.0
    term = observed * math.log(expected) - expected - math.lgamma(observed + 1)
    total, k, part = 0.0, observed, 1.0
    while part > 1e-17 * max(total, 1e-300) or k < expected:
        total += part
        k += 1
        part *= expected / k
    return min(0.0, (term + math.log(total)) / math.log(10))


def redistribute(first: int, second: int, share: float, seed: int = 0) -> tuple[int, int]:
    """The sum of a pair of counts dealt anew, each event to the first with chance ``share``."""
    n = int(np.random.default_rng(seed).binomial(first + second, share))
    return n, first + second - n
