"""Statistical column expressions."""

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def entropy_bits(values: list[Column]) -> Column:
    """Shannon entropy (base 2) of a few columns, nulls left out.

    With n values of which c equal the i-th, it is log2(n) minus the mean of log2(c) over i. Plain
    arithmetic on columns stays in generated code, which functions over arrays do not.
    """
    def add(parts: list[Column]) -> Column:
        return reduce(lambda a, b: a + b, parts)

    def one_if(c: Column) -> Column:
        return F.coalesce(c, F.lit(False)).cast("int")

    n = add([one_if(v.isNotNull()) for v in values])
    logs = add([
        F.when(v.isNotNull(), F.log2(add([one_if(v == other) for other in values]))).otherwise(0.0) for v in values
    ])
    return F.log2(n) - logs / n


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    """Two-sided p-value of the two-sample Kolmogorov-Smirnov statistic (Kolmogorov series with
    the usual small-sample correction of the argument)."""
    en = F.sqrt(n1 * n2 / (n1 + n2))
    lam = (en + 0.12 + 0.11 / en) * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam),
    )
    # below 0.2 the probability is 1 to more than 12 digits and the series converges slowly
    p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2.0 * series))
    return F.when(lam < 0.2, 1.0).when(lam.isNotNull(), p)


EXACT_SIZE = 10_000  # of the larger sample, up to which the p-value is counted exactly


def ks_exact(d: float, n1: int, n2: int) -> float:
    """P(D >= d) if both samples come from one distribution: in a random order of all values, the probability that the
    shares seen of the two samples somewhere differ by ``d`` or more.

    The order is followed value by value. Held are the probabilities of having seen i values of the first sample while the
    shares have stayed closer than ``d``; what leaves that band is added up, so small results keep their digits.
    """
    m, n = n1, n2
    most = round(d * m * n) - 0.5  # differences are whole multiples of 1 / (m * n)
    if most < 0:
        return 1.0
    inside, low, out = np.ones(1), 0, 0.0  # probabilities of i = low, low + 1, ...
    for k in range(m + n):
        i, rest = np.arange(low, low + len(inside)), m + n - k
        grown = np.zeros(len(inside) + 1)
        grown[1:] = inside * ((m - i) / rest)
        grown[:-1] += inside * ((n - (k - i)) / rest)
        # After k + 1 values the shares differ by |i (m + n) - (k + 1) m| / (m n).
        first = max(low, math.ceil(((k + 1) * m - most) / (m + n)))
        last = min(low + len(inside), math.floor(((k + 1) * m + most) / (m + n)))
        kept = grown[first - low: max(first, last + 1) - low]
        out += grown[: first - low].sum() + grown[max(first, last + 1) - low:].sum()
        inside, low = kept, first
        if not len(inside):
            return 1.0
    return float(min(1.0, out))


def ks_test_p(d: Column, n1: Column, n2: Column, exact_size: int = EXACT_SIZE) -> Column:
    """Two-sided p-value: exact up to ``exact_size`` values in the larger sample, the series beyond. One row for each
    column tested, so this is no work over the data."""

    @F.pandas_udf("double")
    def exact(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        small = d.notna() & (n1 > 0) & (n2 > 0) & (np.maximum(n1, n2) <= exact_size)
        return pd.Series([ks_exact(x, int(a), int(b)) if s else None for x, a, b, s in zip(d, n1, n2, small)], dtype="float64")

    return F.coalesce(exact(d, n1, n2), ks_p_value(d, n1, n2))


def clean_double(c: Column) -> Column:
    """Treat NaN as missing; Spark would otherwise order it above every number."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))
