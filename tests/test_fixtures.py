"""Reference fixtures (FIXTURES.md section 2) with exact expected numbers."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tickframe.config import (ExecutionConfig, FeatureConfig, MetricsConfig, Ordering,
                              SignalConfig)
from tickframe.operators import features as fx
from tickframe.operators import ledger as led
from tickframe.operators import metrics as mx
from tickframe.operators import signals as sg
from tickframe.sources.book import with_book_basics

T0 = dt.datetime(2024, 1, 1)
KEYED = Ordering()


def frame(spark, cols: dict, symbol="S0"):
    n = len(next(iter(cols.values())))
    rows = [dict(symbol=symbol, ts=T0 + dt.timedelta(seconds=i), seq=i,
                 **{k: (None if v[i] is None else float(v[i])) for k, v in cols.items()})
            for i in range(n)]
    schema = "symbol STRING, ts TIMESTAMP_NTZ, seq BIGINT, " + ", ".join(f"{k} DOUBLE" for k in cols)
    return spark.createDataFrame(rows, schema)


def col(df, name):
    return [r[0] for r in df.orderBy("seq").select(name).collect()]


def close(a, b, tol=1e-9):
    if a is None or b is None:
        return a is None and b is None
    return abs(a - b) <= tol * max(1.0, abs(b))


def test_fx1_book_basics(spark):
    df = frame(spark, {"bid_price_1": [100], "bid_price_2": [99.99], "bid_price_3": [99.98],
                       "bid_size_1": [100], "bid_size_2": [200], "bid_size_3": [300],
                       "ask_price_1": [100.01], "ask_price_2": [100.02], "ask_price_3": [100.03],
                       "ask_size_1": [150], "ask_size_2": [250], "ask_size_3": [350]})
    r = with_book_basics(df, 3).first()
    assert close(r.mid_price, 100.005) and close(r.spread, 0.01, 1e-6)
    assert close(r.imbalance, -150 / 1350)


def test_fx2_zero_sizes(spark):
    df = frame(spark, {"bid_price_1": [100], "ask_price_1": [100.01], "bid_size_1": [0],
                       "ask_size_1": [0]})
    assert with_book_basics(df, 1).first().imbalance == 0.0


FX5 = {"bid_size_1": [100, 120, 110], "bid_size_2": [200, 220, 210],
       "ask_size_1": [150, 170, 160], "ask_size_2": [250, 270, 260]}


def test_fx5_ofi(spark):
    cfg = FeatureConfig(ofi_levels=2, ofi_window=2)
    out = fx.extract_one(frame(spark, FX5), fx.ofi_features, cfg, KEYED)
    assert col(out, "ofi_level_1") == [-50, -50, -50]
    assert col(out, "ofi_aggregate") == [-100, -100, -100]
    assert col(out, "ofi_level_1_rolling") == [None, -50, -50]
    assert col(out, "ofi_level_1_momentum") == [None, 0, 0]


def test_fx6_missing_levels_skipped(spark):
    df = frame(spark, {"bid_size_1": [1, 2], "ask_size_1": [2, 1]})
    out = fx.extract_one(df, fx.ofi_features, FeatureConfig(), KEYED)
    assert "ofi_level_1" in out.columns and "ofi_level_2" not in out.columns
    assert "ofi_aggregate" in out.columns


def test_fx7_spread(spark):
    cfg = FeatureConfig(spread_window=2)
    df = frame(spark, {"spread": [0.01, 0.02, 0.015], "mid_price": [100, 101, 100.5]})
    out = fx.extract_one(df, fx.spread_features, cfg, KEYED)
    got = col(out, "spread_rolling_mean")
    assert got[0] is None and close(got[1], 0.015) and close(got[2], 0.0175)
    assert close(col(out, "spread_log")[0], math.log(0.01 + 1e-8))
    no_mid = fx.extract_one(df.drop("mid_price"), fx.spread_features, cfg, KEYED)
    assert "spread_relative" not in no_mid.columns


def test_fx8_depth(spark):
    cfg = FeatureConfig(depth_levels=2, depth_window=2)
    out = fx.extract_one(frame(spark, FX5), fx.depth_features, cfg, KEYED)
    assert col(out, "total_bid_depth") == [300, 340, 320]
    assert col(out, "total_ask_depth") == [400, 440, 420]
    for a, b in zip(col(out, "depth_imbalance"), [-100 / 700, -100 / 780, -100 / 740]):
        assert close(a, b)


def test_fx9_weights():
    assert fx.imbalance_weights(2) == pytest.approx([2 / 3, 1 / 3])


def test_fx10_vwap(spark):
    cfg = FeatureConfig(vwap_window=2)
    df = frame(spark, {"mid_price": [100, 101, 100.5], "total_depth": [1000, 1200, 1100]})
    out = fx.extract_one(df, fx.vwap_features, cfg, KEYED)
    r, d = col(out, "vwap_rolling"), col(out, "vwap_deviation")
    assert r[0] is None and close(r[1], 100.5) and close(r[2], 100.75)
    assert d[0] is None and close(d[1], 0.5) and close(d[2], -0.25)


def test_fx11_returns(spark):
    cfg = FeatureConfig(return_windows=(1, 2))
    df = frame(spark, {"mid_price": [100, 101, 100.5, 102, 101.5]})
    out = fx.extract_one(df, fx.return_features, cfg, KEYED)
    assert col(out, "volatility_1") == [None] * 5
    v2 = col(out, "volatility_2")
    assert v2[:2] == [None, None]
    for a, b in zip(v2[2:], [0.0105715964, 0.0140543612, 0.0140200423]):
        assert close(a, b, 1e-8)


def test_fx12_microprice(spark):
    cfg = FeatureConfig(microprice_window=2)
    df = frame(spark, {"bid_price_1": [100, 101, 100.5], "ask_price_1": [100.01, 101.01, 100.51],
                       "bid_size_1": [100, 120, 110], "ask_size_1": [150, 170, 160],
                       "mid_price": [100.005, 101.005, 100.505]})
    out = fx.extract_one(df, fx.microprice_features, cfg, KEYED)
    for a, b in zip(col(out, "microprice"), [100.0040000, 101.0041379, 100.5040741]):
        assert abs(a - b) < 5e-7


def test_fx14_moments(spark):
    from tickframe.functions.frames import rolling_kurt, rolling_skew
    from tickframe.operators.ordered import keyed_window
    df = frame(spark, {"x": [1, 2, 4, 4, 4, 4, 7, 1]})
    w = keyed_window(KEYED)
    out = df.withColumns({"s": rolling_skew("x", w, 4), "k": rolling_kurt("x", w, 4)})
    s, k = col(out, "s"), col(out, "k")
    assert s[:3] == [None] * 3 and k[:3] == [None] * 3
    for a, b in zip(s[3:], [-0.3703704, -2.0, 0.0, 2.0, 0.0]):
        assert abs(a - b) < 1e-6
    for a, b in zip(k[3:], [-3.9012346, 4.0, -3.0, 4.0, 1.5]):
        assert abs(a - b) < 1e-6


def test_moments_of_lags_equal_window_aggregates(spark):
    from tickframe.functions import frames as fr
    from tickframe.operators.ordered import keyed_window
    x = [0.1, 0.1, 0.1, 0.1, 0.1, -0.3, 0.2, None, 1e-9, 2e-9, 3e-9, 1e-9, 5.0, 0.25, float("nan"), 0.5, 0.5, 1.0, 2.0, 4.0]
    w = keyed_window(KEYED)
    df = frame(spark, {"x": x})
    got, extra = fr.with_rolling_moments(df, "x", w, (2, 4, 5))
    got = got.withColumns({f"{k}{n}": f("x", n) for n in (2, 4, 5) for k, f in (
        ("std", fr.moment_std), ("skew", fr.moment_skew), ("kurt", fr.moment_kurt))}).drop(*extra)
    want = df.withColumns({f"{k}{n}": f("x", w, n) for n in (2, 4, 5) for k, f in (
        ("std", fr.rolling_std), ("skew", fr.rolling_skew), ("kurt", fr.rolling_kurt))})
    for c in want.columns[len(df.columns):]:
        for a, b in zip(col(got, c), col(want, c)):
            assert (a is None) == (b is None), c
            assert a is None or a != a and b != b or abs(a - b) < 1e-9, c


def test_return_features_use_no_moment_window_aggregates(spark):
    df = frame(spark, {"mid_price": [100.0, 101.0, 102.0]})
    plan = fx.extract_one(df, fx.return_features, FeatureConfig(model_ready=True), KEYED)._jdf.queryExecution().optimizedPlan().toString()
    assert "lag(" in plan and "kurtosis(" not in plan and "stddev_samp(" not in plan


def test_fx15_fx16_signals(spark):
    df = frame(spark, {"prob_up": [.7, .3, .5, .8, .2], "prob_down": [.2, .6, .3, .1, .7]})
    assert col(sg.generate_signals(df), "signal") == [1, -1, 0, 1, -1]
    assert col(sg.generate_signals(df.drop("prob_down")), "signal") == [1, -1, 0, 1, -1]


def test_fx17_fixed_size(spark):
    df = frame(spark, {"signal": [1, -1, 0, 1, -1]})
    assert col(df.withColumn("p", sg.size_fixed(F.col("signal"), 2.0)), "p") == [2, 2, 0, 2, 2]


def _ledger(spark, signal, size, mid):
    df = frame(spark, {"signal": signal, "position_size": size, "mid_price": mid})
    return led.execute_trades(df.withColumn("signal", F.col("signal").cast("int")),
                              ExecutionConfig(), KEYED)


def test_fx19_ledger(spark):
    out = _ledger(spark, [1, 0, -1, 1, 0], [1, 0, 1, 1, 0], [100, 101, 102, 103, 104])
    exp = {"trade_size": [1, -1, -1, 2, -1], "position": [1, 0, -1, 1, 0],
           "total_cost": [.15, .1515, .153, .309, .156], "pnl": [0, -.1515, -1.153, .691, -.156],
           "cumulative_pnl": [0, -.1515, -1.3045, -.6135, -.7695]}
    for c, v in exp.items():
        for a, b in zip(col(out, c), v):
            assert close(a, b, 1e-9), (c, a, b)


def test_fx20_costs_and_clamp(spark):
    df = spark.range(1).select(F.lit(1.0).alias("t"), F.lit(100.0).alias("p"))
    tc, sc, tot = led.trade_cost(F.col("t"), F.col("p"))
    r = df.select(tc.alias("a"), sc.alias("b"), tot.alias("c"),
                  led.clamp_position(F.lit(10.0), 5).alias("d"),
                  led.clamp_position(F.lit(-10.0), 5).alias("e")).first()
    assert close(r.a, .1) and close(r.b, .05) and close(r.c, .15) and r.d == 5 and r.e == -5


def test_fx21_trade_summary(spark):
    out = _ledger(spark, [1, -1, 1], [1, 1, 1], [100, 101, 102])
    s = led.trade_summary(led.trades(out)).first()
    assert s.total_trades == 3 and close(s.total_volume, 5) and close(s.total_cost, .759)
    assert close(s.total_pnl, -.609) and close(s.max_position, 1)


def test_fx22_metrics(spark):
    df = frame(spark, {"cumulative_pnl": [0, 10, 5, 15, 20], "pnl": [0, 10, -5, 10, 5],
                       "trade_size": [0, 1, -1, 1, 0]})
    m = mx.backtest_metrics(df, MetricsConfig(), KEYED).first().asDict()
    exp = {"total_pnl": 20, "total_trades": 3, "volatility": 103.48912986, "max_drawdown": -5,
           "var_95": -4.0, "var_99": -4.8, "annualized_return": 1008, "sharpe_ratio": 9.73996014,
           "sortino_ratio": 0, "calmar_ratio": 201.6, "information_ratio": 9.74015340,
           "hit_rate": 2 / 3, "avg_win": 10, "avg_loss": -5, "win_loss_ratio": 2,
           "profit_factor": 4, "turnover": 1}
    for k, v in exp.items():
        assert close(m[k], v, 1e-8), (k, m[k], v)


def test_fx23_rolling_metrics(spark):
    vals = [1, -2, 3, 4, -1, 2, 0, 5, -3, 1]
    cum = [sum(vals[:i + 1]) for i in range(10)]
    df = frame(spark, {"pnl": vals, "cumulative_pnl": cum})
    out = mx.rolling_metrics(df, 5, MetricsConfig(), KEYED)
    for c in ("rolling_return", "rolling_volatility", "rolling_sharpe", "rolling_drawdown"):
        v = col(out, c)
        assert v[:4] == [None] * 4 and all(x is not None for x in v[4:])


def test_fx24_report_defaults(spark):
    m = spark.createDataFrame([(100.0, 1.5)], "total_pnl DOUBLE, sharpe_ratio DOUBLE")
    rep = {r.metric: r.value for r in mx.metric_report(m).collect()}
    assert rep["total_pnl"] == 100.0 and rep["sharpe_ratio"] == 1.5 and rep["turnover"] == 0.0
    assert len(rep) == 18


def test_fx18_threshold_search_equals_direct(spark):
    import random
    rnd = random.Random(42)
    n = 100
    df = frame(spark, {"prob_up": [rnd.random() for _ in range(n)],
                       "prob_down": [rnd.random() for _ in range(n)],
                       "return_forward_1": [rnd.gauss(0, .01) for _ in range(n)]})
    rows = df.collect()
    for metric in ("sharpe", "sortino", "hit_rate"):
        best = sg.optimize_thresholds(df, metric).first()
        direct = []
        for li, lt in enumerate(sg.LONG_GRID):
            for si, st in enumerate(sg.SHORT_GRID):
                xs, wins = [], 0
                for r in rows:
                    s = -1 if r.prob_down > st else 1 if r.prob_up > lt else 0
                    xs.append(s * r.return_forward_1)
                    wins += (s > 0 and r.return_forward_1 > 0) or (s < 0 and r.return_forward_1 < 0)
                import statistics as stt
                if metric == "sharpe":
                    sd = stt.stdev(xs)
                    sc = stt.mean(xs) / sd if sd > 0 else 0
                elif metric == "sortino":
                    neg = [x for x in xs if x < 0]
                    sd = stt.stdev(neg) if len(neg) > 1 else float("nan")
                    sc = stt.mean(xs) / sd if sd > 0 else 0
                else:
                    sc = wins / n
                direct.append((sc, -li, -si, lt, st))
        top = max(direct)
        assert best.long_threshold == top[3] and best.short_threshold == top[4], metric
        assert close(best.score, top[0], 1e-7)
        assert best.long_threshold > best.short_threshold
