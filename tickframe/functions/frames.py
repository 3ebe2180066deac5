"""Column-expression helpers for ordered row frames.

All helpers return ``Column`` objects evaluated by Spark's Window operator;
nothing here runs Python per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

Col = Column | str


def _c(x: Col) -> Column:
    return F.col(x) if isinstance(x, str) else x


def frame(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def full(agg, x: Col, w: WindowSpec, n: int) -> Column:
    """pandas ``rolling(n).agg()``: null until ``n`` non-null values fill the frame."""
    x = _c(x)
    fw = frame(w, n)
    return F.when(F.count(x).over(fw) == n, agg(x).over(fw))


def rolling_mean(x: Col, w: WindowSpec, n: int) -> Column:
    return full(F.avg, x, w, n)


def rolling_std(x: Col, w: WindowSpec, n: int) -> Column:
    """Sample standard deviation; null for n = 1 as in pandas."""
    return full(F.stddev_samp, x, w, n)


def rolling_sum(x: Col, w: WindowSpec, n: int) -> Column:
    return full(F.sum, x, w, n)


def rolling_max(x: Col, w: WindowSpec, n: int) -> Column:
    return full(F.max, x, w, n)


def diff(x: Col, w: WindowSpec, k: int = 1) -> Column:
    x = _c(x)
    return x - F.lag(x, k).over(w)


def ratio(a: Col, b: Col) -> Column:
    """a / b with NULL for a zero divisor (pandas gives inf, nulled later)."""
    return F.try_divide(_c(a), _c(b))


def pct_change(x: Col, w: WindowSpec, k: int = 1) -> Column:
    x = _c(x)
    return ratio(x, F.lag(x, k).over(w)) - F.lit(1.0)


def lead_return(x: Col, w: WindowSpec, k: int) -> Column:
    x = _c(x)
    return ratio(F.lead(x, k).over(w), x) - F.lit(1.0)


def rolling_skew(x: Col, w: WindowSpec, n: int) -> Column:
    """Bias-corrected sample skewness G1 over a full frame of n rows.

    pandas rules: null below 3 rows; 0.0 when all values in the frame are
    equal; null when the population variance is at most 1e-14.
    Spark's ``skewness`` is the population g1, hence the correction factor.
    """
    x = _c(x)
    fw = frame(w, n)
    if n < 3:
        return F.lit(None).cast("double")
    g1 = F.skewness(x).over(fw)
    corr = (n * (n - 1)) ** 0.5 / (n - 2)
    return (
        F.when(F.count(x).over(fw) < n, F.lit(None).cast("double"))
        .when(F.max(x).over(fw) == F.min(x).over(fw), F.lit(0.0))
        .when(F.var_pop(x).over(fw) <= F.lit(1e-14), F.lit(None).cast("double"))
        .otherwise(F.lit(corr) * g1)
    )


def rolling_kurt(x: Col, w: WindowSpec, n: int) -> Column:
    """Bias-corrected excess kurtosis G2; -3.0 on a constant frame (pandas)."""
    x = _c(x)
    fw = frame(w, n)
    if n < 4:
        return F.lit(None).cast("double")
    g2 = F.kurtosis(x).over(fw)
    a = (n - 1) / ((n - 2) * (n - 3))
    return (
        F.when(F.count(x).over(fw) < n, F.lit(None).cast("double"))
        .when(F.max(x).over(fw) == F.min(x).over(fw), F.lit(-3.0))
        .when(F.var_pop(x).over(fw) <= F.lit(1e-14), F.lit(None).cast("double"))
        .otherwise(F.lit(a) * (F.lit(float(n + 1)) * g2 + F.lit(6.0)))
    )


#: Frames up to this length are read as lags; longer ones by window aggregates.
MAX_LAGS = 64


def with_rolling_moments(df: DataFrame, x: str, w: WindowSpec, ns: Sequence[int]) -> tuple[DataFrame, list[str]]:
    """Add mean and central sums of the last ``n`` rows of ``x`` for every ``n`` of ``ns``
    (see ``moment_std``, ``moment_skew``, ``moment_kurt``), and name the columns added.

    The rows of the longest frame are read once as lags and serve all lengths. A window
    aggregate would update every moment of every length anew for each row of a frame. The
    mean is null until ``n`` non-null values fill the frame."""
    at = [f"_{x}_lag_{k}" for k in range(max(ns, default=0))]
    df = df.withColumns({c: F.lag(x, k).over(w) if k else F.col(x) for k, c in enumerate(at)})
    means, offs, sums = moment_layers(x, at, ns)
    for layer in (means, offs, sums):
        df = df.withColumns(layer)
    return df.drop(*at, *offs), [*means, *sums]


def moment_layers(x: str, at: Sequence[str], ns: Sequence[int]) -> list[dict[str, Column]]:
    """The columns that ``moment_std``, ``moment_skew`` and ``moment_kurt`` read, in layers of
    which each reads those before it: means, distances from the mean, central sums. ``at``:
    columns that hold ``x`` in the rows of the longest frame, the current row first."""
    means = {f"_{x}_mean_{n}": mean_of([F.col(c) for c in at[:n]]) for n in ns}
    offs = {f"_{x}_off_{n}_{k}": F.col(at[k]) - F.col(f"_{x}_mean_{n}") for n in ns for k in range(n)}
    sums = {}
    for n in ns:
        d = [F.col(f"_{x}_off_{n}_{k}") for k in reversed(range(n))]
        for p in (2, 3, 4):
            sums[f"_{x}_m{p}_{n}"] = fold([fold([v] * p, lambda a, b: a * b) for v in d])
        sums[f"_{x}_flat_{n}"] = F.greatest(*at[:n]) == F.least(*at[:n]) if n > 1 else F.lit(True)
    return [means, offs, sums]


def by_lags(n: int) -> bool:
    """Whether a frame of ``n`` rows is read as lags."""
    return 1 <= n <= MAX_LAGS


def mean_of(last: Sequence[Column]) -> Column:
    """Mean of the rows of a frame, the current row first; null unless all are known."""
    return fold(list(reversed(last))) / F.lit(float(len(last)))


def fold(cols: Sequence[Column], op: Callable[[Column, Column], Column] = lambda a, b: a + b) -> Column:
    return reduce(op, cols)


def moment_std(x: str, n: int) -> Column:
    """``rolling_std`` from the columns of ``with_rolling_moments``."""
    return F.sqrt(F.col(f"_{x}_m2_{n}") / F.lit(float(n - 1))) if n > 1 else F.lit(None).cast("double")


def _shape(x: str, n: int, flat: float, value: Column) -> Column:
    m2 = F.col(f"_{x}_m2_{n}")
    return (F.when(F.col(f"_{x}_mean_{n}").isNull(), F.lit(None).cast("double"))
            .when(F.col(f"_{x}_flat_{n}"), F.lit(flat))
            .when(m2 / F.lit(float(n)) <= F.lit(1e-14), F.lit(None).cast("double")).otherwise(value))


def moment_skew(x: str, n: int) -> Column:
    """``rolling_skew`` from the columns of ``with_rolling_moments``."""
    if n < 3:
        return F.lit(None).cast("double")
    m2, m3 = F.col(f"_{x}_m2_{n}"), F.col(f"_{x}_m3_{n}")
    g1 = F.try_divide(F.lit(n ** 0.5) * m3, F.sqrt(m2 * m2 * m2))
    return _shape(x, n, 0.0, F.lit((n * (n - 1)) ** 0.5 / (n - 2)) * g1)


def moment_kurt(x: str, n: int) -> Column:
    """``rolling_kurt`` from the columns of ``with_rolling_moments``."""
    if n < 4:
        return F.lit(None).cast("double")
    m2, m4 = F.col(f"_{x}_m2_{n}"), F.col(f"_{x}_m4_{n}")
    g2 = F.try_divide(F.lit(float(n)) * m4, m2 * m2) - F.lit(3.0)
    a = (n - 1) / ((n - 2) * (n - 3))
    return _shape(x, n, -3.0, F.lit(a) * (F.lit(float(n + 1)) * g2 + F.lit(6.0)))


def null_out_non_finite(c: Col) -> Column:
    c = _c(c)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def fold_sum(cols: list[Col]) -> Column:
    """Row sum that counts null as 0 (pandas ``sum(axis=1)``)."""
    if not cols:
        return F.lit(0.0)
    out = F.coalesce(_c(cols[0]), F.lit(0.0))
    for c in cols[1:]:
        out = out + F.coalesce(_c(c), F.lit(0.0))
    return out
