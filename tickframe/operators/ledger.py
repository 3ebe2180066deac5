"""Position and cost ledger without a sequential loop (LED1-4, PRJ21).

Every sizing the reference offers gives one constant unit per run, so targets
are -u, 0, +u and (without a dead band) the position after each row is the clamped target itself
(or stays 0 for ever when u is below the minimum trade size). The recurrence
then has a closed form: ``trade = c - lag(c)``, executed when non-zero, and
running sums. Nothing is collected per key: in chunked mode rows are laid out once
by cell (series and time bucket), and two small tables of one row per cell carry the
state over: the last position and price first, then the running sums.

Modes:
* ``reference`` -- the reference's bookkeeping: the seven ledger columns are
  written only on trade rows (0 elsewhere), pnl uses the position after the
  trade, and ``cumulative_pnl`` adds the previous row's value, i.e. it restarts
  after every row without a trade.
* ``mtm`` -- marked-to-market: the position is carried, every row earns
  ``previous position * price change - cost``, plain running sum; honours
  ``execution_delay`` by lagging the signal.

A NULL signal holds the previous position (the reference would buy up to the
position limit, a defect). A NULL price gives NULL costs and pnl on its row and a
NULL pnl on the next; running sums skip them.

Sizes may vary from row to row as long as every change of the clamped target is
either nothing or at least ``min_trade_size``. A smaller change would be held
back, which makes the position a true recurrence: ``ExecutionConfig(dead_band=True)``
follows it by ``deadband.banded_positions``; without it such input raises an error.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ExecutionConfig, Ordering
from .deadband import banded_positions
from .ordered import CELL, apply_ordered, carry, cell_window, latest, with_cells

LEDGER_COLUMNS = ("position", "trade_size", "transaction_cost", "slippage_cost",
                  "total_cost", "pnl", "cumulative_pnl")
#: What earlier cells hand over: last targets; last price and whether a row exists.
TARGETS_IN = {"_in": "double", "_in_prev": "double"}
PRICES_IN = {"_in_px": "double", "_in_row": "int"}


def clamp_position(target: Column, max_position: float) -> Column:
    """LED1: the position after a trade stays within [-M, M]. A NULL target stays NULL
    (``greatest`` and ``least`` alone would skip it and give the limit)."""
    m = float(max_position)
    return F.when(target.isNotNull(), F.greatest(F.lit(-m), F.least(F.lit(m), target)))


def trade_cost(trade_size: Column, price: Column, cfg: ExecutionConfig = ExecutionConfig()):
    """PRJ21: (transaction, slippage, total) cost columns of a trade."""
    value = F.abs(trade_size) * price
    tc = value * F.lit(cfg.transaction_cost)
    sc = value * F.lit(cfg.slippage)
    return tc, sc, tc + sc


def execute_trades(df: DataFrame, cfg: ExecutionConfig = ExecutionConfig(),
                   ordering: Ordering = Ordering(), fold: str | None = None,
                   price: str = "mid_price") -> DataFrame:
    """LED2: add the seven ledger columns and ``executed``.

    ``fold``: restart the ledger per fold (walk-forward). With
    ``cfg.carry_position`` the position carries across folds instead.
    """
    if cfg.mode not in ("reference", "mtm"):
        raise ValueError(f"Unknown ledger mode: {cfg.mode}")
    restart = ordering if fold is None else replace(ordering, keys=(*ordering.keys, fold))
    o_pos = ordering if cfg.carry_position else restart
    sig, px = F.col("signal"), F.col(price)
    M, m = float(cfg.max_position), float(cfg.min_trade_size)

    # 1) clamped target; a unit below the minimum trade never leaves 0
    c = clamp_position(sig.cast("double") * F.col("position_size"), M)
    if not cfg.dead_band:
        c = F.when(c.isNull(), F.lit(None).cast("double")).when(
            (F.abs(c) >= F.lit(m)) | (c == 0), c).otherwise(F.lit(0.0))
    d = int(cfg.execution_delay) if cfg.mode == "mtm" else 0
    x = df.withColumn("_r", c)
    ahead = d if cfg.dead_band else d - 1       # the closed form looks one row back by itself
    if ahead > 0:
        x = apply_ordered(x, o_pos, lambda f, w: f.withColumn("_r", F.lag("_r", ahead).over(w)), lookback=ahead)
    d = min(d, 1)

    # 2) position before and after each row, price change and first row of the series;
    # one carry serves both unless positions run on across folds
    if cfg.dead_band:
        x = with_cells(banded_positions(x, o_pos, m, "_r"), restart)
        x = carry(x, restart, _price_totals(restart, px), _prices_before, PRICES_IN)
        x = _price_steps(x, restart, px)
    else:
        x = _closed_form(x, o_pos, restart, px, d)
    x = x.drop("_b", *TARGETS_IN, *PRICES_IN)
    trade = F.col("_c") - F.col("_prev")
    if not cfg.dead_band:
        # the closed form needs every change of target to be none or a whole trade; a
        # smaller one would be held back and change all later rows
        small = (F.abs(trade) > F.lit(1e-9)) & (F.abs(trade) < F.lit(m))
        trade = F.when(small, F.raise_error(F.lit(
            "a target moves by less than min_trade_size and would be held back: "
            "ExecutionConfig(dead_band=True) follows such sizes")).cast("double")).otherwise(trade)
    executed = (F.abs(trade) >= F.lit(m)) if m > 0 else F.lit(True)
    x = x.withColumns({"_trade": trade, "executed": executed})
    tc, sc, tot = trade_cost(F.col("_trade"), px, cfg)
    ex = F.col("executed")
    zero = F.lit(0.0)

    if cfg.mode == "reference":
        pnl = F.when(F.col("_first"), zero).otherwise(F.col("_c") * F.col("_dpx") - tot)
        x = x.withColumns({
            "position": F.when(ex, F.col("_c")).otherwise(zero),
            "trade_size": F.when(ex, F.col("_trade")).otherwise(zero),
            "transaction_cost": F.when(ex, tc).otherwise(zero),
            "slippage_cost": F.when(ex, sc).otherwise(zero),
            "total_cost": F.when(ex, tot).otherwise(zero),
        }).withColumn("pnl", F.when(ex, pnl).otherwise(zero))
        x = _restarting_sum(x, restart)
    else:
        pnl = F.when(F.col("_first"), zero - F.when(ex, tot).otherwise(zero)).otherwise(
            F.col("_prev") * F.col("_dpx") - F.when(ex, tot).otherwise(zero))
        x = x.withColumns({
            "position": F.col("_c"),
            "trade_size": F.when(ex, F.col("_trade")).otherwise(zero),
            "transaction_cost": F.when(ex, tc).otherwise(zero),
            "slippage_cost": F.when(ex, sc).otherwise(zero),
            "total_cost": F.when(ex, tot).otherwise(zero),
            "pnl": pnl,
        })
        x = _restarting_sum(x, restart, at_gaps=False)
    return x.drop("_r", "_c", "_prev", "_dpx", "_first", "_trade", CELL)


def _closed_form(x: DataFrame, o_pos: Ordering, restart: Ordering, px: Column, d: int) -> DataFrame:
    """Positions as the last target, prices and series starts, by one carry or two."""
    x = with_cells(x, o_pos)
    if d:   # a cell's first row looks two rows back: past the last row of the cell before
        x = x.withColumn("_b", _last_target(o_pos, 1))
    if o_pos == restart:
        x = carry(x, restart, {**_target_totals(o_pos, d), **_price_totals(restart, px)},
                  lambda t, w: _prices_before(_targets_before(t, w, d), w), {**TARGETS_IN, **PRICES_IN})
        return _price_steps(_positions(x, o_pos, d), restart, px)
    x = carry(x, o_pos, _target_totals(o_pos, d), lambda t, w: _targets_before(t, w, d), TARGETS_IN)
    x = with_cells(_positions(x, o_pos, d), restart)
    x = carry(x, restart, _price_totals(restart, px), _prices_before, PRICES_IN)
    return _price_steps(x, restart, px)


def _last_target(o: Ordering, rows_ago: int) -> Column:
    """The last non-null target of the cell's rows up to ``rows_ago`` rows ago."""
    return F.last("_r", ignorenulls=True).over(
        cell_window(o).rowsBetween(Window.unboundedPreceding, -rows_ago))


def _target_totals(o: Ordering, delay: int) -> dict[str, Column]:
    r = F.col("_r")
    return {"_t": latest(r, o, r.isNotNull()), **({"_tb": latest(F.col("_b"), o)} if delay else {})}


def _targets_before(t: DataFrame, w, delay: int) -> DataFrame:
    """Last target before the cell, and the same without the row just before it."""
    t = t.withColumn("_in", F.last("_t", ignorenulls=True).over(w))
    one = w.rowsBetween(-1, -1)
    return t.withColumn("_in_prev", F.coalesce(F.last("_tb").over(one), F.last("_in").over(one))
                        if delay else F.col("_in"))


def _positions(x: DataFrame, o: Ordering, delay: int) -> DataFrame:
    """``_c`` and ``_prev``: the last non-null target up to ``delay`` rows ago, and the
    same one row earlier; 0 before the first."""
    prev = F.coalesce(_last_target(o, delay + 1), "_in", F.lit(0.0))
    if delay:
        opens = F.lag(F.lit(1)).over(cell_window(o)).isNull()
        prev = F.when(opens, F.coalesce("_in_prev", F.lit(0.0))).otherwise(prev)
    return x.withColumns({"_c": F.coalesce(_last_target(o, delay), "_in", F.lit(0.0)), "_prev": prev})


def _price_totals(o: Ordering, price: Column) -> dict[str, Column]:
    return {"_tp": latest(price.cast("double"), o), "_tr": F.max(F.lit(1))}


def _prices_before(t: DataFrame, w) -> DataFrame:
    """Price of the row just before the cell (it may be null), and whether there is one."""
    one = w.rowsBetween(-1, -1)
    return t.withColumns({"_in_px": F.last("_tp").over(one), "_in_row": F.last("_tr").over(one)})


def _price_steps(x: DataFrame, o: Ordering, price: Column) -> DataFrame:
    """``_dpx``: price change from the row before; ``_first``: there is none, told by
    row order, as a NULL price is not a first row."""
    w = cell_window(o)
    opens = F.lag(F.lit(1)).over(w).isNull()
    return x.withColumns({
        "_dpx": price - F.when(opens, F.col("_in_px")).otherwise(F.lag(price).over(w)),
        "_first": opens & F.col("_in_row").isNull()})


def _restarting_sum(x: DataFrame, o: Ordering, at_gaps: bool = True) -> DataFrame:
    """``cumulative_pnl``: the running sum S of pnl. ``at_gaps``: it restarts after each
    row without a trade, ``S(t) - S(last row without a trade)``, and is 0 on such rows."""
    w = cell_window(o).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("_s", F.sum("pnl").over(w))
    ex, s, zero = F.col("executed"), F.col("_s"), F.lit(0.0)
    totals, names = {"_ts": F.sum("pnl")}, {"_in_s": "double"}
    if at_gaps:
        totals["_tg"] = latest(s, o, ~ex)
        names["_in_g"] = "double"

    def prefixes(t: DataFrame, w_cells) -> DataFrame:
        t = t.withColumn("_in_s", F.sum("_ts").over(w_cells))
        if at_gaps:
            t = t.withColumn("_g", F.coalesce(F.col("_in_s") + F.col("_tg"), F.col("_tg")))
            t = t.withColumn("_in_g", F.last("_g", ignorenulls=True).over(w_cells))
        return t

    x = carry(x, o, totals, prefixes, names)
    total = F.coalesce(F.col("_in_s") + s, F.col("_in_s"), s)
    if at_gaps:
        x = x.withColumn("_s", total)
        gap = F.last(F.when(~ex, F.col("_s")), ignorenulls=True).over(w)
        total = F.when(ex, F.col("_s") - F.coalesce(gap, F.col("_in_g"), zero)).otherwise(zero)
    return x.withColumn("cumulative_pnl", total).drop("_s", "_in_s", "_in_g")


def trades(ledger: DataFrame, *keys: str, ts: str = "ts", price: str = "mid_price") -> DataFrame:
    """LED3: one row per executed trade."""
    return ledger.filter(F.col("executed")).select(
        *keys, F.col(ts).alias("timestamp"), "seq", "signal", "trade_size", "position",
        F.col(price).alias("price"), F.col("total_cost").alias("cost"), "pnl")


def trade_summary(trade_rows: DataFrame, *keys: str) -> DataFrame:
    """LED4: one aggregate over the trade list; no row for a key without trades."""
    a = F.abs(F.col("trade_size"))
    return trade_rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.sum(a).alias("total_volume"),
        F.sum("cost").alias("total_cost"),
        F.avg(a).alias("avg_trade_size"),
        F.avg("cost").alias("avg_cost_per_trade"),
        F.max(F.abs(F.col("position"))).alias("max_position"),
        F.sum("pnl").alias("total_pnl"),
    )
