"""Catalogue part 2: signals, sizing, ledger, threshold search and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ExecutionConfig, FeatureConfig, MetricsConfig, SignalConfig
from ..operators import ledger as led
from ..operators import metrics as mx
from ..operators import signals as sg
from ..operators import timeseries as tsx
from ..operators.features import extract_one, return_features
from ..operators.signals import LONG_GRID, SHORT_GRID
from ..sources.book import load_book
from .catalog_features import WF_TEST, WF_TRAIN, _FOLDS
from .defaults import ORDERING
from .registry import register
from .sqltext import W, dlit

RET1 = FeatureConfig(return_windows=(1,))
SIG = SignalConfig()
EXE = ExecutionConfig()
MTM = ExecutionConfig(mode="mtm")
MET = MetricsConfig()


def with_forward_return(spark: SparkSession, sf: str) -> DataFrame:
    return extract_one(load_book(spark, sf), return_features, RET1, ORDERING)


def signals(spark: SparkSession, sf: str, cfg: SignalConfig = SIG) -> DataFrame:
    return sg.generate_signals(load_book(spark, sf), cfg, "symbol")


def ledger(spark: SparkSession, sf: str, cfg: ExecutionConfig = EXE) -> DataFrame:
    return led.execute_trades(signals(spark, sf), cfg, ORDERING)


# ---------------------------------------------------------------- SQL pieces

SIG_T = (f"CASE WHEN prob_down > {dlit(0.4)} THEN -1 WHEN prob_up > {dlit(0.6)} THEN 1 "
         f"WHEN prob_up <= {dlit(0.6)} AND prob_down <= {dlit(0.4)} THEN 0 END")
SIG_B = (f"CASE WHEN prob_up < {dlit(0.4)} THEN -1 WHEN prob_up > {dlit(0.6)} THEN 1 "
         f"WHEN prob_up >= {dlit(0.4)} AND prob_up <= {dlit(0.6)} THEN 0 END")
R1 = f"((lead(mid_price, 1) OVER ({W})) / NULLIF(mid_price, 0) - {dlit(1.0)})"


def ledger_sql(src: str, part: str = "symbol", mode: str = "reference", delay: int = 1,
               px_part: str | None = None, band: str | None = None) -> str:
    """Oracle ledger: gaps-and-islands over executed rows (independent of the
    prefix-difference form the Spark code uses). ``px_part``: where prices and sums
    restart, if not where the position does. ``band``: the
    targets as SQL, followed row by row under the dead band."""
    px_part = px_part or part
    wp = f"PARTITION BY {px_part} ORDER BY ts, seq"
    run_p = f"({wp} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    w = f"PARTITION BY {part} ORDER BY ts, seq"
    run = f"({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    c = (f"greatest({dlit(-10.0)}, least({dlit(10.0)}, CAST(signal AS DOUBLE) * "
         f"(abs(CAST(signal AS DOUBLE)) * {dlit(1.0)})))")
    c = f"CASE WHEN signal IS NULL THEN NULL WHEN abs({c}) >= {dlit(0.1)} OR {c} = 0 THEN {c} ELSE {dlit(0.0)} END"
    if mode == "mtm":
        c = f"lag({c}, {delay}) OVER ({w})"
    tc = f"abs(c - prev) * mid_price * {dlit(0.001)}"
    sc = f"abs(c - prev) * mid_price * {dlit(0.0005)}"
    held = f"""
  s0 AS (SELECT *, {c} AS c_raw FROM ({src}) z),
  s1 AS (SELECT *, COALESCE(c_raw, last_value(c_raw IGNORE NULLS) OVER {run}, {dlit(0.0)}) AS c FROM s0),"""
    if band:
        raw = f"greatest({dlit(-10.0)}, least({dlit(10.0)}, {band}))"
        raw = f"CASE WHEN signal IS NULL THEN NULL ELSE {raw} END"
        if mode == "mtm":
            raw = f"lag({raw}, {delay}) OVER ({w})"
        held = f"""
  s0 AS (SELECT *, {raw} AS c_raw, row_number() OVER ({w}) AS rn FROM ({src}) z),
  walk AS (SELECT {part}, rn, CASE WHEN abs(c_raw) >= {dlit(0.1)} THEN c_raw ELSE {dlit(0.0)} END AS c FROM s0 WHERE rn = 1
           UNION ALL SELECT s0.{part}, s0.rn, CASE WHEN abs(s0.c_raw - k.c) >= {dlit(0.1)} THEN s0.c_raw ELSE k.c END
           FROM walk k JOIN s0 ON s0.{part} = k.{part} AND s0.rn = k.rn + 1),
  s1 AS (SELECT s0.* EXCLUDE (rn), k.c FROM s0 JOIN walk k ON s0.{part} = k.{part} AND s0.rn = k.rn),"""
    base = f"""{held}
  s2 AS (SELECT *, COALESCE(lag(c) OVER ({w}), {dlit(0.0)}) AS prev,
                mid_price - lag(mid_price) OVER ({wp}) AS dpx,
                row_number() OVER ({wp}) = 1 AS first_row FROM s1),
  s3 AS (SELECT *, abs(c - prev) >= {dlit(0.1)} AS executed,
                {tc} AS tc, {sc} AS sc, ({tc}) + ({sc}) AS tot FROM s2)"""
    z = dlit(0.0)
    if mode == "reference":
        return f"""WITH RECURSIVE {base},
  s4 AS (SELECT *,
    CASE WHEN executed THEN c ELSE {z} END AS position,
    CASE WHEN executed THEN c - prev ELSE {z} END AS trade_size,
    CASE WHEN executed THEN tc ELSE {z} END AS transaction_cost,
    CASE WHEN executed THEN sc ELSE {z} END AS slippage_cost,
    CASE WHEN executed THEN tot ELSE {z} END AS total_cost,
    CASE WHEN NOT executed THEN {z} WHEN first_row THEN {z} ELSE c * dpx - tot END AS pnl,
    sum(CASE WHEN executed THEN 0 ELSE 1 END) OVER {run_p} AS island FROM s3)
SELECT * EXCLUDE (island, c_raw, c, prev, dpx, first_row, tc, sc, tot),
  CASE WHEN executed THEN sum(pnl) OVER (PARTITION BY {px_part}, island ORDER BY ts, seq
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) ELSE {z} END AS cumulative_pnl
FROM s4"""
    return f"""WITH RECURSIVE {base},
  s4 AS (SELECT *, c AS position,
    CASE WHEN executed THEN c - prev ELSE {z} END AS trade_size,
    CASE WHEN executed THEN tc ELSE {z} END AS transaction_cost,
    CASE WHEN executed THEN sc ELSE {z} END AS slippage_cost,
    CASE WHEN executed THEN tot ELSE {z} END AS total_cost,
    CASE WHEN first_row THEN {z} - CASE WHEN executed THEN tot ELSE {z} END
         ELSE prev * dpx - CASE WHEN executed THEN tot ELSE {z} END END AS pnl FROM s3)
SELECT * EXCLUDE (c_raw, c, prev, dpx, first_row, tc, sc, tot),
  sum(pnl) OVER {run_p} AS cumulative_pnl FROM s4"""


SIGNALS_SRC = f"SELECT *, {SIG_T} AS signal FROM book"
LEDGER_COLS = "position:d trade_size:d transaction_cost:d slippage_cost:d total_cost:d pnl:d cumulative_pnl:d"

# ---------------------------------------------------------------- signals

register("signals_ternary", "symbol seq signal position_size:d",
         f"SELECT symbol, seq, {SIG_T} AS signal, abs(CAST({SIG_T} AS DOUBLE)) * {dlit(1.0)} AS position_size FROM book")(
    lambda spark, sf: signals(spark, sf))

register("signals_binary", "symbol seq signal position_size:d",
         f"SELECT symbol, seq, {SIG_B} AS signal, abs(CAST({SIG_B} AS DOUBLE)) * {dlit(1.0)} AS position_size FROM book")(
    lambda spark, sf: sg.generate_signals(load_book(spark, sf).drop("prob_down"), SIG, "symbol"))

register("kelly_sizing", "symbol seq signal position_size:d", f"""
WITH s AS (SELECT symbol, seq, {SIG_T} AS signal, {R1} AS r FROM book),
e AS (SELECT symbol,
        avg(CASE WHEN (signal > 0 AND r > 0) OR (signal < 0 AND r < 0) THEN {dlit(1.0)} ELSE {dlit(0.0)} END) AS p,
        CASE WHEN avg(abs(r)) > 0 THEN {dlit(1.0)} / avg(abs(r)) ELSE {dlit(1.0)} END AS o
      FROM s GROUP BY symbol)
SELECT s.symbol, s.seq, s.signal,
  abs(CAST(s.signal AS DOUBLE)) * greatest({dlit(0.0)}, least(e.p - ({dlit(1.0)} - e.p) / e.o, {dlit(0.25)})) * {dlit(1.0)} AS position_size
FROM s JOIN e ON s.symbol = e.symbol""")(
    lambda spark, sf: sg.generate_signals(with_forward_return(spark, sf),
                                          SignalConfig(position_sizing="kelly"), "symbol"))

register("signal_distribution", "symbol signal n",
         f"SELECT symbol, signal, count(*) AS n FROM ({SIGNALS_SRC}) s GROUP BY symbol, signal")(
    lambda spark, sf: sg.signal_distribution(signals(spark, sf), "symbol"))


def _signal_events(spark: SparkSession, sf: str) -> DataFrame:
    s = signals(spark, sf)
    both = sg.signal_events(s, 1).unionByName(sg.signal_events(s, -1))
    return both.select("symbol", "ts", "seq", F.col("signal").alias("side"),
                       F.col("mid_price").alias("price"))


register("signal_events", "symbol ts seq side price:d",
         f"SELECT symbol, ts, seq, signal AS side, mid_price AS price FROM ({SIGNALS_SRC}) s "
         f"WHERE signal = 1 OR signal = -1")(_signal_events)

# ---------------------------------------------------------------- ledger

register("ledger_reference", "symbol seq signal " + LEDGER_COLS, ledger_sql(SIGNALS_SRC))(
    lambda spark, sf: ledger(spark, sf))
register("ledger_mtm", "symbol seq signal " + LEDGER_COLS, ledger_sql(SIGNALS_SRC, mode="mtm"))(
    lambda spark, sf: ledger(spark, sf, MTM))

register("trades", "symbol timestamp seq signal trade_size:d position:d price:d cost:d pnl:d",
         f"SELECT symbol, ts AS timestamp, seq, signal, trade_size, position, mid_price AS price, "
         f"total_cost AS cost, pnl FROM ({ledger_sql(SIGNALS_SRC)}) l WHERE executed")(
    lambda spark, sf: led.trades(ledger(spark, sf), "symbol"))

register("trade_summary", "symbol total_trades total_volume:d total_cost:d avg_trade_size:d "
         "avg_cost_per_trade:d max_position:d total_pnl:d", f"""
SELECT symbol, count(*) AS total_trades, sum(abs(trade_size)) AS total_volume,
       sum(total_cost) AS total_cost, avg(abs(trade_size)) AS avg_trade_size,
       avg(total_cost) AS avg_cost_per_trade, max(abs(position)) AS max_position, sum(pnl) AS total_pnl
FROM ({ledger_sql(SIGNALS_SRC)}) l WHERE executed GROUP BY symbol""")(
    lambda spark, sf: led.trade_summary(led.trades(ledger(spark, sf), "symbol"), "symbol"))

# ---------------------------------------------------------------- threshold search


def _grid_sql() -> str:
    rows = ", ".join(f"({i}, {j}, {dlit(LONG_GRID[i])}, {dlit(SHORT_GRID[j])})"
                     for i in range(len(LONG_GRID)) for j in range(len(SHORT_GRID)))
    return f"SELECT * FROM (VALUES {rows}) g(li, si, long_threshold, short_threshold)"


def threshold_sql(metric: str) -> str:
    """Oracle: the direct 64-point evaluation (every row under every grid point)."""
    sig = ("CASE WHEN b.prob_down > g.short_threshold THEN -1 WHEN b.prob_up > g.long_threshold THEN 1 "
           "WHEN b.prob_up <= g.long_threshold AND b.prob_down <= g.short_threshold THEN 0 END")
    if metric == "sharpe":
        score = (f"CASE WHEN stddev_samp(x) > 0 THEN avg(x) / stddev_samp(x) ELSE {dlit(0.0)} END")
    elif metric == "sortino":
        score = (f"CASE WHEN stddev_samp(x) FILTER (WHERE x < 0) > 0 "
                 f"THEN avg(x) / stddev_samp(x) FILTER (WHERE x < 0) ELSE {dlit(0.0)} END")
    else:
        score = (f"avg(CASE WHEN (signal > 0 AND r > 0) OR (signal < 0 AND r < 0) "
                 f"THEN {dlit(1.0)} ELSE {dlit(0.0)} END)")
    return f"""
WITH b AS (SELECT symbol, prob_up, prob_down, {R1} AS r FROM book),
g AS ({_grid_sql()}),
x AS (SELECT b.symbol, g.li, g.si, g.long_threshold, g.short_threshold, {sig} AS signal, b.r,
             CAST({sig} AS DOUBLE) * b.r AS x FROM b, g),
s AS (SELECT symbol, li, si, long_threshold, short_threshold, {score} AS score
      FROM x GROUP BY symbol, li, si, long_threshold, short_threshold)
SELECT symbol, long_threshold, short_threshold, score FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY score DESC NULLS LAST, li, si) AS rk FROM s) t
WHERE rk = 1"""


for _m in ("sharpe", "sortino", "hit_rate"):
    register(f"threshold_search_{_m}", "symbol long_threshold:d short_threshold:d score:d",
             threshold_sql(_m))(
        lambda spark, sf, _m=_m: sg.optimize_thresholds(with_forward_return(spark, sf), _m, "symbol"))

# ---------------------------------------------------------------- metrics

register("drawdown", "symbol seq cumulative_pnl:d running_max:d drawdown:d", f"""
SELECT symbol, seq, cumulative_pnl,
       max(cumulative_pnl) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max,
       cumulative_pnl - max(cumulative_pnl) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS drawdown
FROM ({ledger_sql(SIGNALS_SRC)}) l""")(
    lambda spark, sf: mx.with_drawdown(ledger(spark, sf), ORDERING))

METRIC_SPEC = ("total_pnl:d total_trades final_equity:d volatility:d downside_deviation:d "
               "max_drawdown:d var_95:d var_99:d annualized_return:d sharpe_ratio:d sortino_ratio:d "
               "calmar_ratio:d information_ratio:d hit_rate:d avg_win:d avg_loss:d "
               "win_loss_ratio:d profit_factor:d turnover:d")


def metrics_sql(src: str, keys: str = "symbol") -> str:
    sq = dlit(252 ** 0.5)
    z = dlit(0.0)
    part = f"PARTITION BY {keys} ORDER BY ts, seq"
    return f"""
WITH l AS (SELECT *, cumulative_pnl - max(cumulative_pnl) OVER ({part}
             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS dd FROM ({src}) l0),
a AS (SELECT {keys},
    arg_max(cumulative_pnl, ts) AS total_pnl,
    count(*) FILTER (WHERE trade_size <> 0) AS total_trades,
    count(*) AS n_rows, count(pnl) AS npnl, stddev_samp(pnl) AS sd,
    count(*) FILTER (WHERE pnl < 0) AS nneg, stddev_samp(pnl) FILTER (WHERE pnl < 0) AS sdneg,
    min(dd) AS max_drawdown,
    quantile_cont(pnl, 0.05) AS var_95, quantile_cont(pnl, 0.01) AS var_99,
    count(*) FILTER (WHERE trade_size <> 0) AS ntr,
    count(*) FILTER (WHERE trade_size <> 0 AND pnl > 0) AS nwin,
    avg(pnl) FILTER (WHERE trade_size <> 0 AND pnl > 0) AS avg_win0,
    avg(pnl) FILTER (WHERE trade_size <> 0 AND pnl < 0) AS avg_loss0,
    sum(pnl) FILTER (WHERE trade_size <> 0 AND pnl > 0) AS sum_win,
    sum(pnl) FILTER (WHERE trade_size <> 0 AND pnl < 0) AS sum_loss,
    sum(abs(trade_size)) FILTER (WHERE trade_size <> 0) AS volume
  FROM l GROUP BY {keys}),
b AS (SELECT *, sd * {sq} AS vol,
        CASE WHEN nneg > 0 THEN sdneg * {sq} ELSE {z} END AS ddev,
        total_pnl * ({dlit(252.0)} / CAST(n_rows AS DOUBLE)) AS ann,
        COALESCE(avg_win0, {z}) AS aw, COALESCE(avg_loss0, {z}) AS al,
        abs(COALESCE(sum_loss, {z})) AS losses FROM a)
SELECT {keys}, total_pnl, total_trades, total_pnl AS final_equity,
  CASE WHEN npnl > 0 THEN vol END AS volatility,
  CASE WHEN npnl > 0 THEN ddev END AS downside_deviation,
  CASE WHEN npnl > 0 THEN max_drawdown END AS max_drawdown,
  CASE WHEN npnl > 0 THEN var_95 END AS var_95,
  CASE WHEN npnl > 0 THEN var_99 END AS var_99,
  CASE WHEN npnl > 0 THEN ann END AS annualized_return,
  CASE WHEN npnl > 0 THEN CASE WHEN vol > 0 THEN (ann - {dlit(0.02)}) / vol ELSE {z} END END AS sharpe_ratio,
  CASE WHEN npnl > 0 THEN CASE WHEN ddev > 0 THEN (ann - {dlit(0.02)}) / ddev ELSE {z} END END AS sortino_ratio,
  CASE WHEN npnl > 0 THEN CASE WHEN abs(max_drawdown) > 0 THEN ann / abs(max_drawdown) ELSE {z} END END AS calmar_ratio,
  CASE WHEN npnl > 0 THEN CASE WHEN vol > 0 THEN (ann - {dlit(0.0)}) / vol ELSE {z} END END AS information_ratio,
  CASE WHEN ntr > 0 THEN CAST(nwin AS DOUBLE) / CAST(ntr AS DOUBLE) END AS hit_rate,
  CASE WHEN ntr > 0 THEN aw END AS avg_win,
  CASE WHEN ntr > 0 THEN al END AS avg_loss,
  CASE WHEN ntr > 0 THEN CASE WHEN al <> 0 THEN abs(aw / al) ELSE {z} END END AS win_loss_ratio,
  CASE WHEN ntr > 0 THEN CASE WHEN losses > 0 THEN COALESCE(sum_win, {z}) / losses ELSE {z} END END AS profit_factor,
  CASE WHEN ntr > 0 THEN volume / CAST(ntr AS DOUBLE) END AS turnover
FROM b"""


register("backtest_metrics", "symbol " + METRIC_SPEC, metrics_sql(ledger_sql(SIGNALS_SRC)))(
    lambda spark, sf: mx.backtest_metrics(ledger(spark, sf), MET, ORDERING))

register("backtest_metrics_mtm", "symbol " + METRIC_SPEC,
         metrics_sql(ledger_sql(SIGNALS_SRC, mode="mtm")))(
    lambda spark, sf: mx.backtest_metrics(ledger(spark, sf, MTM), MET, ORDERING))

RW = 252
register("rolling_metrics", "symbol seq rolling_return:d rolling_volatility:d rolling_sharpe:d "
         "rolling_drawdown:d", f"""
SELECT symbol, seq, rr AS rolling_return, rv AS rolling_volatility,
       (rr - {dlit(0.02 * (RW / 252))}) / NULLIF(rv, 0) AS rolling_sharpe,
       cumulative_pnl - rm AS rolling_drawdown
FROM (SELECT *,
  CASE WHEN count(pnl) OVER ({W} ROWS BETWEEN {RW - 1} PRECEDING AND CURRENT ROW) = {RW}
       THEN sum(pnl) OVER ({W} ROWS BETWEEN {RW - 1} PRECEDING AND CURRENT ROW) END AS rr,
  CASE WHEN count(pnl) OVER ({W} ROWS BETWEEN {RW - 1} PRECEDING AND CURRENT ROW) = {RW}
       THEN stddev_samp(pnl) OVER ({W} ROWS BETWEEN {RW - 1} PRECEDING AND CURRENT ROW) END * {dlit(252 ** 0.5)} AS rv,
  CASE WHEN count(cumulative_pnl) OVER ({W} ROWS BETWEEN {RW - 1} PRECEDING AND CURRENT ROW) = {RW}
       THEN max(cumulative_pnl) OVER ({W} ROWS BETWEEN {RW - 1} PRECEDING AND CURRENT ROW) END AS rm
  FROM ({ledger_sql(SIGNALS_SRC)}) l0) l""")(
    lambda spark, sf: mx.rolling_metrics(ledger(spark, sf), RW, MET, ORDERING))


def _report_sql() -> str:
    parts = []
    pos = 0
    for section, names in mx.REPORT_LAYOUT:
        for n in names:
            pos += 1
            parts.append(f"SELECT symbol, '{section}' AS section, {pos} AS position, '{n}' AS metric, "
                         f"COALESCE(CAST({n} AS DOUBLE), {dlit(0.0)}) AS value FROM m")
    return (f"WITH m AS ({metrics_sql(ledger_sql(SIGNALS_SRC))})\n" + "\nUNION ALL\n".join(parts))


register("metric_report", "symbol section position metric value:d", _report_sql())(
    lambda spark, sf: mx.metric_report(mx.backtest_metrics(ledger(spark, sf), MET, ORDERING), "symbol"))


def _walk_forward_metrics(spark: SparkSession, sf: str) -> DataFrame:
    folds = tsx.walk_forward(signals(spark, sf), WF_TRAIN, WF_TEST, ORDERING)
    lg = led.execute_trades(folds, EXE, ORDERING, fold="fold")
    return mx.backtest_metrics(lg, MET, ORDERING, "fold")


register("walk_forward_metrics", "symbol fold " + METRIC_SPEC, metrics_sql(
    ledger_sql(f"SELECT * FROM ({_FOLDS.replace('FROM book', f'FROM ({SIGNALS_SRC}) sb')}) ff",
               part="symbol, fold"), keys="symbol, fold"))(_walk_forward_metrics)
