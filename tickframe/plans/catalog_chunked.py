"""Catalogue part 5: order-dependent queries laid out in several chunks per symbol
already at small scale, against the same SQL twins as their wide layout."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig, LabelConfig, Ordering
from ..operators import labels as lb
from ..operators import ledger as led
from ..operators import metrics as mx
from ..operators import quantiles
from ..operators import signals as sg
from ..operators import timeseries as tsx
from ..operators.cells import even_cells
from ..session import scratch_table
from ..sources.book import load_book
from .catalog_backtest import EXE, LEDGER_COLS, MTM, SIG, SIGNALS_SRC, ledger_sql, signals
from .defaults import ORDERING
from .registry import REGISTRY, register
from .sqltext import W, dlit

SMALL = replace(ORDERING, chunk_rows=400)


def _label_summary(spark: SparkSession, sf: str) -> DataFrame:
    f = lb.labelled_features(load_book(spark, sf), FeatureConfig(), LabelConfig(), SMALL)
    return f.groupBy("symbol", "label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("weighted_imbalance").alias("mean_weighted_imbalance"),
        F.avg("ofi_aggregate_rolling").alias("mean_ofi_rolling"))


def _ledger(spark: SparkSession, sf: str, cfg) -> DataFrame:
    return led.execute_trades(signals(spark, sf), cfg, SMALL)


_BUILD = {
    "label_summary": _label_summary,
    "ledger_reference": lambda spark, sf: _ledger(spark, sf, EXE),
    "ledger_mtm": lambda spark, sf: _ledger(spark, sf, MTM),
    "drawdown": lambda spark, sf: mx.with_drawdown(_ledger(spark, sf, EXE), SMALL),
    "time_split": lambda spark, sf: tsx.time_split(load_book(spark, sf), 0.2, 0.2, SMALL),
    "sliding_windows": lambda spark, sf: tsx.sliding_windows(load_book(spark, sf), 20, 5, SMALL),
}
for _name, _build in _BUILD.items():
    register(f"{_name}_chunked", REGISTRY[_name].spec, REGISTRY[_name].sql)(_build)


# sizes that vary by whole trades from row to row (1, 1.5 and 2 units)
def _varying(spark: SparkSession, sf: str) -> DataFrame:
    s = signals(spark, sf).withColumn("position_size", F.lit(1.0) + (F.col("seq") % 3).cast("double") / 2)
    return led.execute_trades(s, EXE, SMALL)


register("ledger_varying", "symbol seq signal " + LEDGER_COLS.replace(" cumulative_pnl:d", ""), ledger_sql(SIGNALS_SRC).replace(
    f"(abs(CAST(signal AS DOUBLE)) * {dlit(1.0)})",
    f"({dlit(1.0)} + CAST(seq % 3 AS DOUBLE) / {dlit(2.0)})"))(_varying)

# sizes that vary continuously: changes below the minimum trade of 0.1 are held back
_BAND_SIZE = f"({dlit(1.0)} + sqrt(prob_up) / {dlit(3.0)})"
_BAND = {"": replace(EXE, dead_band=True), "_mtm": replace(MTM, dead_band=True)}


def _banded(spark: SparkSession, sf: str, cfg, ordering) -> DataFrame:
    s = signals(spark, sf).withColumn("position_size", F.lit(1.0) + F.sqrt("prob_up") / 3)
    return led.execute_trades(s, cfg, ordering)


for _name, _cfg, _ordering in (("ledger_deadband", _BAND[""], SMALL), ("ledger_deadband_mtm", _BAND["_mtm"], SMALL),
                               ("ledger_deadband_keyed", _BAND[""], replace(SMALL, chunk_rows=None))):
    # a difference of prefix sums of such sizes may end in either half of a sixth decimal
    _spec = LEDGER_COLS if _cfg.mode == "mtm" else LEDGER_COLS.replace(" cumulative_pnl:d", "")
    register(_name, "symbol seq signal " + _spec,
             ledger_sql(SIGNALS_SRC, mode=_cfg.mode, band=f"CAST(signal AS DOUBLE) * {_BAND_SIZE}"))(
        lambda spark, sf, c=_cfg, o=_ordering: _banded(spark, sf, c, o))

# the position carries from fold to fold, prices and sums restart in each; folds of 500
# and 100 rows, so that every symbol has several
_CARRY = replace(EXE, carry_position=True)
_FOLDED = f"""SELECT *, (pos_ - 500) // 100 AS fold FROM (
  SELECT *, row_number() OVER ({W}) - 1 AS pos_, count(*) OVER (PARTITION BY symbol) AS n_ FROM ({SIGNALS_SRC}) z0) p
  WHERE pos_ >= 500 AND ((pos_ - 500) // 100) * 100 < n_ - 600"""
register("walk_forward_carry", "symbol fold seq signal " + LEDGER_COLS,
         ledger_sql(_FOLDED, px_part="symbol, fold"))(
    lambda spark, sf: led.execute_trades(tsx.walk_forward(signals(spark, sf), 500, 100, ORDERING), _CARRY, SMALL,
                                         fold="fold"))

register("sort_by_time", "symbol ts seq mid_price:d", "SELECT * FROM book")(
    lambda spark, sf: tsx.sort_by_time(load_book(spark, sf), ORDERING))


# a burst: the whole time range squeezed into one bucket, whose cells are evened out
def _burst(spark: SparkSession, sf: str) -> tuple[DataFrame, Ordering]:
    b = load_book(spark, sf)
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    squeezed = start + F.make_dt_interval(secs=F.timestamp_diff("SECOND", start, F.col("ts")) / 1000)
    b = scratch_table(b.withColumn("ts", squeezed), "burst")
    return b, even_cells(b, SMALL, rows=400)


def _burst_summary(spark: SparkSession, sf: str) -> DataFrame:
    b, o = _burst(spark, sf)
    f = lb.labelled_features(b, FeatureConfig(), LabelConfig(), o)
    return f.groupBy("symbol", "label").agg(
        F.count(F.lit(1)).alias("n"), F.avg("weighted_imbalance").alias("mean_weighted_imbalance"),
        F.avg("ofi_aggregate_rolling").alias("mean_ofi_rolling"))


def _burst_ledger(spark: SparkSession, sf: str) -> DataFrame:
    b, o = _burst(spark, sf)
    return led.execute_trades(sg.generate_signals(b, SIG, "symbol"), EXE, o)


register("label_summary_burst_chunked", REGISTRY["label_summary"].spec, REGISTRY["label_summary"].sql)(_burst_summary)
register("ledger_reference_burst_chunked", REGISTRY["ledger_reference"].spec, REGISTRY["ledger_reference"].sql)(_burst_ledger)


# value at risk of any range of days from stored sketches; what must hold: all rows are in
# them, and the rank of the value is within 1 % of the wanted one
def _sketched_risk(spark: SparkSession, sf: str) -> DataFrame:
    lg = scratch_table(led.execute_trades(signals(spark, sf), EXE, SMALL).select("symbol", "ts", "pnl"), "pnl")
    daily = scratch_table(quantiles.quantile_sketches(
        lg.withColumn("day", F.to_date("ts")), ["symbol", "day"], "pnl"), "daily-sketches")
    q = quantiles.merged_quantiles(daily, ["symbol"], {"q05": 0.05, "q01": 0.01})
    days = daily.groupBy("symbol").agg(F.count(F.lit(1)).alias("days"))
    q = q.join(days, "symbol")
    ranks = lg.join(q, "symbol").groupBy("symbol", "days", "n").agg(
        *[f(F.when(c, 1.0).otherwise(0.0)).alias(x) for x, c, f in (
            ("lo5", F.col("pnl") < F.col("q05"), F.avg), ("hi5", F.col("pnl") <= F.col("q05"), F.avg),
            ("lo1", F.col("pnl") < F.col("q01"), F.avg), ("hi1", F.col("pnl") <= F.col("q01"), F.avg))])
    near = (F.col("lo5") <= 0.06) & (F.col("hi5") >= 0.04) & (F.col("lo1") <= 0.02) & (F.col("hi1") >= 0.0)
    return ranks.select("symbol", "days", "n", near.alias("near"))


register("sketched_risk", "symbol days n near", f"""
SELECT symbol, count(DISTINCT CAST(ts AS DATE)) AS days, count(*) AS n, true AS near
FROM ({ledger_sql(SIGNALS_SRC)}) l WHERE pnl IS NOT NULL GROUP BY symbol""")(_sketched_risk)
