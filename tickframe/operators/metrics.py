"""Risk, performance and trade metrics in one aggregation (AGG1-22, WIN21-26, REP1).

``backtest_metrics`` is one ``groupBy(keys).agg`` over the ledger plus one
running maximum for the drawdown; every metric of the reference's four groups
is a column of the same row (NULL where the reference omits a group: no
non-null pnl for risk/performance, no trade for trade metrics).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MetricsConfig, Ordering
from .ordered import prefix_scan
from .quantiles import exact_quantiles
from .sliding import sliding_frames

METRIC_NAMES = (
    "total_pnl", "total_trades", "final_equity", "volatility", "downside_deviation",
    "max_drawdown", "var_95", "var_99", "annualized_return", "sharpe_ratio", "sortino_ratio",
    "calmar_ratio", "information_ratio", "hit_rate", "avg_win", "avg_loss", "win_loss_ratio",
    "profit_factor", "turnover",
)


def with_drawdown(ledger: DataFrame, o: Ordering = Ordering(), *extra_keys: str) -> DataFrame:
    """WIN21-22: running maximum of cumulative pnl and the drawdown below it."""
    x = prefix_scan(ledger, o, "cumulative_pnl", "max", "running_max", *extra_keys)
    return x.withColumn("drawdown", F.col("cumulative_pnl") - F.col("running_max"))


def backtest_metrics(ledger: DataFrame, cfg: MetricsConfig = MetricsConfig(),
                     o: Ordering = Ordering(), *extra_keys: str,
                     materialize_input: bool = True) -> DataFrame:
    """AGG1-17: one row of metrics per key (and per fold with ``extra_keys``).

    The ledger is read by the drawdown scan, the aggregate and the three
    quantile passes. With ``materialize_input`` its five needed columns are
    written once to the shared checkpoint folder and read back, which cuts the
    ledger's lineage (windows, scans, joins) instead of re-running it per pass.
    """
    if "cumulative_pnl" not in ledger.columns:
        raise ValueError("DataFrame must contain 'cumulative_pnl' column")
    keys = [*o.keys, *extra_keys]
    need = [*keys, *o.order, "pnl", "cumulative_pnl", "trade_size"]
    slim = ledger.select(*need)
    if materialize_input:
        from .models import materialize
        slim = materialize(slim, "metrics-input")
    x = with_drawdown(slim, o, *extra_keys)
    sq = math.sqrt(cfg.trading_days)
    pnl, ts_ = F.col("pnl"), F.col("trade_size")
    last_key = F.struct(*[F.col(c) for c in o.order])
    is_trade = ts_ != 0
    base = x.groupBy(*keys).agg(
        F.max_by("cumulative_pnl", last_key).alias("total_pnl"),
        F.count_if(is_trade).alias("total_trades"),
        F.count(F.lit(1)).alias("_rows"),
        F.count(pnl).alias("_npnl"),
        F.stddev_samp(pnl).alias("_sd"),
        F.count(F.when(pnl < 0, pnl)).alias("_nneg"),
        F.stddev_samp(F.when(pnl < 0, pnl)).alias("_sdneg"),
        F.min("drawdown").alias("max_drawdown"),
        F.count(F.when(is_trade, pnl)).alias("_ntr"),
        F.count(F.when(is_trade & (pnl > 0), pnl)).alias("_nwin"),
        F.avg(F.when(is_trade & (pnl > 0), pnl)).alias("_avg_win"),
        F.avg(F.when(is_trade & (pnl < 0), pnl)).alias("_avg_loss"),
        F.sum(F.when(is_trade & (pnl > 0), pnl)).alias("_sum_win"),
        F.sum(F.when(is_trade & (pnl < 0), pnl)).alias("_sum_loss"),
        F.sum(F.when(is_trade, F.abs(ts_))).alias("_volume"),
    )
    q = exact_quantiles(x.filter(pnl.isNotNull()), keys, "pnl", {"var_95": 0.05, "var_99": 0.01})
    m = base.join(q, keys, "left")
    has_risk = F.col("_npnl") > 0
    has_trades = F.col("_ntr") > 0
    vol = F.col("_sd") * F.lit(sq)
    dd = F.when(F.col("_nneg") > 0, F.col("_sdneg") * F.lit(sq)).otherwise(F.lit(0.0))
    ann = F.col("total_pnl") * (F.lit(float(cfg.trading_days)) / F.col("_rows").cast("double"))
    excess = ann - F.lit(cfg.risk_free_rate)
    mdd = F.abs(F.col("max_drawdown"))
    avg_win = F.coalesce(F.col("_avg_win"), F.lit(0.0))
    avg_loss = F.coalesce(F.col("_avg_loss"), F.lit(0.0))
    losses = F.abs(F.coalesce(F.col("_sum_loss"), F.lit(0.0)))

    def risk(c: Column) -> Column:
        return F.when(has_risk, c)

    def trade(c: Column) -> Column:
        return F.when(has_trades, c)

    return m.select(
        *keys,
        "total_pnl",
        "total_trades",
        F.col("total_pnl").alias("final_equity"),
        risk(vol).alias("volatility"),
        risk(dd).alias("downside_deviation"),
        risk(F.col("max_drawdown")).alias("max_drawdown"),
        risk(F.col("var_95")).alias("var_95"),
        risk(F.col("var_99")).alias("var_99"),
        risk(ann).alias("annualized_return"),
        risk(F.when(vol > 0, F.try_divide(excess, vol)).otherwise(F.lit(0.0))).alias("sharpe_ratio"),
        risk(F.when(dd > 0, F.try_divide(excess, dd)).otherwise(F.lit(0.0))).alias("sortino_ratio"),
        risk(F.when(mdd > 0, F.try_divide(ann, mdd)).otherwise(F.lit(0.0))).alias("calmar_ratio"),
        risk(F.when(vol > 0, F.try_divide(ann - F.lit(cfg.benchmark_return), vol))
             .otherwise(F.lit(0.0))).alias("information_ratio"),
        trade(F.col("_nwin").cast("double") / F.col("_ntr").cast("double")).alias("hit_rate"),
        trade(avg_win).alias("avg_win"),
        trade(avg_loss).alias("avg_loss"),
        trade(F.when(avg_loss != 0, F.abs(F.try_divide(avg_win, avg_loss)))
              .otherwise(F.lit(0.0))).alias("win_loss_ratio"),
        trade(F.when(losses > 0, F.try_divide(F.coalesce(F.col("_sum_win"), F.lit(0.0)), losses))
              .otherwise(F.lit(0.0))).alias("profit_factor"),
        trade(F.col("_volume") / F.col("_ntr").cast("double")).alias("turnover"),
    )


def rolling_metrics(ledger: DataFrame, window: int = 252, cfg: MetricsConfig = MetricsConfig(),
                    o: Ordering = Ordering()) -> DataFrame:
    """AGG18 / WIN23-26: rolling return, volatility, Sharpe and drawdown. The time does not
    depend on the width of the window (see ``sliding``)."""
    f = sliding_frames(ledger, o, window, "pnl", "cumulative_pnl", "rolling_return", "_std", "_rmax")
    excess = F.col("rolling_return") - F.lit(cfg.risk_free_rate * (window / cfg.trading_days))
    f = f.withColumn("rolling_volatility", F.col("_std") * F.lit(math.sqrt(cfg.trading_days)))
    return f.withColumns({
        "rolling_sharpe": F.try_divide(excess, F.col("rolling_volatility")),
        "rolling_drawdown": F.col("cumulative_pnl") - F.col("_rmax"),
    }).drop("_rmax", "_std")


# Sections and order of the reference's text report.
REPORT_LAYOUT = (
    ("basic", ("total_pnl", "total_trades", "final_equity")),
    ("performance", ("annualized_return", "sharpe_ratio", "sortino_ratio", "calmar_ratio",
                     "information_ratio")),
    ("risk", ("volatility", "max_drawdown", "var_95", "var_99")),
    ("trade", ("hit_rate", "avg_win", "avg_loss", "win_loss_ratio", "profit_factor", "turnover")),
)


def metric_report(metrics: DataFrame, *keys: str) -> DataFrame:
    """REP1: long ``(section, position, metric, value)`` table; missing metrics are 0."""
    items = []
    pos = 0
    for section, names in REPORT_LAYOUT:
        for n in names:
            pos += 1
            val = F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in metrics.columns \
                else F.lit(0.0)
            items.append(F.struct(F.lit(section).alias("section"), F.lit(pos).alias("position"),
                                  F.lit(n).alias("metric"), val.alias("value")))
    return metrics.select(*keys, F.explode(F.array(*items)).alias("_m")).select(*keys, "_m.*")


def feature_correlation(df: DataFrame, cols: list[str]) -> DataFrame:
    """AGG19: pairwise Pearson correlation, long form (pairwise-complete rows as pandas).

    Each task reduces its rows to the central moments of all pairs by matrix products (one
    row per pair, whatever the number of rows), taken about the first known values it
    sees; the tasks' moments are merged about their common mean, so a mean that is large
    against the spread costs no digits. NULL where a column is constant on the rows of
    the pair. Any number of columns gives one pass; an aggregate of thousands of ``corr``
    expressions would not compile.
    """
    p = len(cols)
    x = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def moments(batches):
        import numpy as np
        import pyarrow as pa
        n, sx, sxx, sxy = (np.zeros((p, p)) for _ in range(4))
        about = np.full(p, np.nan)
        for batch in batches:
            v = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            known = ~np.isnan(v)
            some = np.isnan(about) & known.any(axis=0)
            about[some] = np.where(known, v, 0.0)[known.argmax(axis=0), np.arange(p)][some]
            v, known = np.where(known, v - about, 0.0), known.astype(float)
            n += known.T @ known
            sx += v.T @ known            # [a, b]: sum of a over the rows where b is known
            sxx += (v * v).T @ known
            sxy += v.T @ v
        i, j = np.triu_indices(p)
        m, a, b = n[i, j], sx[i, j], sx[j, i]
        per = np.maximum(m, 1)           # pairs without a common row come with n = 0
        mean = [np.where(m > 0, about[k] + t / per, 0.0) for k, t in ((i, a), (j, b))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()),
             *[pa.array(c) for c in (m, *mean, sxx[i, j] - a * a / per, sxx[j, i] - b * b / per,
                                     sxy[i, j] - a * b / per)]],
            ["i", "j", "n", "mx", "my", "xx", "yy", "xy"])

    part = x.mapInArrow(moments, "i int, j int, n double, mx double, my double, xx double, yy double, xy double")
    pair = Window.partitionBy("i", "j")
    mean = {c: F.try_divide(F.sum(F.col("n") * F.col(c)).over(pair), F.sum("n").over(pair)) for c in ("mx", "my")}
    part = part.withColumns({f"_{c}": F.col(c) - m for c, m in mean.items()})
    size = F.col("n")
    sums = part.groupBy("i", "j").agg(
        F.sum(size).alias("n"), F.sum(F.col("xx") + size * F.col("_mx") ** 2).alias("xx"),
        F.sum(F.col("yy") + size * F.col("_my") ** 2).alias("yy"),
        F.sum(F.col("xy") + size * F.col("_mx") * F.col("_my")).alias("xy"),
        F.max(F.abs("mx")).alias("mx"), F.max(F.abs("my")).alias("my"))
    # a constant column has squares of rounding size only
    varies = (size > 1) & (F.col("xx") > size * (F.lit(1e-15) * F.col("mx")) ** 2) & (
        F.col("yy") > size * (F.lit(1e-15) * F.col("my")) ** 2)
    names = F.array(*[F.lit(c) for c in cols])
    return sums.select(names[F.col("i")].alias("feature_a"), names[F.col("j")].alias("feature_b"),
                       F.when(varies & (F.col("xx") > 0) & (F.col("yy") > 0),
                              F.col("xy") / F.sqrt(F.col("xx") * F.col("yy"))).alias("corr"))


def describe_features(df: DataFrame, cols: list[str], *keys: str) -> DataFrame:
    """AGG20: count, mean, sample std, min, exact quartiles, max per feature (long form).

    The described columns are written once: the passes over them then read columns
    instead of computing the features again.
    """
    from ..session import scratch_table
    df = scratch_table(df.select(*keys, *cols), "describe-input")
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("v")) for c in cols
    ])).alias("_f")).select(*keys, "_f.*")
    g = [*keys, "feature"]
    stats = long.groupBy(*g).agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_quantiles(long.filter(F.col("v").isNotNull()), g, "v",
                        {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return stats.join(q, g, "left")


def data_overview(df: DataFrame, *keys: str, ts: str = "ts") -> DataFrame:
    """AGG21: rows, columns, first and last timestamp."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"),
        F.min(ts).alias("start_ts"), F.max(ts).alias("end_ts"))


def prediction_summary(df: DataFrame, *keys: str) -> DataFrame:
    """AGG22: rows per predicted class with mean class probabilities."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in ("prob_up", "prob_down", "prob_flat"):
        if c in df.columns:
            aggs.append(F.avg(c).alias(f"mean_{c}"))
    return df.groupBy(*keys, "prediction").agg(*aggs)


def top_features(importances: DataFrame, k: int = 20) -> DataFrame:
    """TOP1: the k most important features (TakeOrderedAndProject)."""
    return importances.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)
