"""Rows, nulls and layouts that the derived book never holds."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickframe import session
from tickframe.config import ExecutionConfig, FeatureConfig, LabelConfig, ModelConfig, Ordering
from tickframe.operators import features as fx
from tickframe.operators import labels as lb
from tickframe.operators import ledger as led
from tickframe.operators import models as md
from tickframe.operators import ordered, quantiles
from tickframe.operators import signals as sg
from tickframe.operators import timeseries as tsx
from tickframe.sources import book, readers, sinks

KEYED, SMALL = Ordering(), Ordering(chunk_rows=3, bucket="1 day")
ROWS = ("symbol string, ts timestamp_ntz, seq long, mid_price double, x double, signal int, "
        "position_size double")


def series(spark, rows):
    return spark.createDataFrame(rows, "symbol string, t string, seq long, mid_price double, x double, "
                                 "signal int, position_size double").select(
        "symbol", F.col("t").cast("timestamp_ntz").alias("ts"), "seq", "mid_price", "x", "signal", "position_size")


def awkward(spark, n=14):
    rng = random.Random(3)
    rows = [(rng.choice(["A", None]), f"2024-01-{1 + i // 4:02d} 00:00:{i:02d}" if i % 5 else None, i,
             None if i % 6 == 3 else 100.0 + i, None if i < 5 else float(i), rng.choice([-1, 0, 1, None]), 1.0)
            for i in range(n)]
    return series(spark, rows)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: r[0])


def test_no_row_vanishes_in_chunks(spark):
    df = awkward(spark)
    for o in (KEYED, SMALL):
        assert ordered.with_positions(df, o).count() == df.count()
        assert tsx.time_split(df, 0.2, 0.2, o).count() == df.count()
    assert rows(ordered.with_positions(df, KEYED), "seq", "pos") == rows(ordered.with_positions(df, SMALL), "seq", "pos")


@pytest.mark.parametrize("op", ["sum", "max", "last"])
def test_prefixes_survive_nulls(spark, op):
    df = series(spark, [("A", f"2024-01-01 00:00:{i:02d}", i, 1.0, v, 0, 1.0)
                        for i, v in enumerate([None, 1.0, 2.0, 3.0, None, None, None, 6.0, None])])
    a, b = (rows(ordered.prefix_scan(df, o, "x", op, "y"), "seq", "y") for o in (KEYED, SMALL))
    assert a == b and (op != "sum" or [r[1] for r in a] == [None, 1, 3, 6, 6, 6, 6, 12, 12])


@pytest.mark.parametrize("mode", ["reference", "mtm"])
def test_ledger_layouts_agree_on_nulls(spark, mode):
    df = awkward(spark, 40)
    a, b = (rows(led.execute_trades(df, ExecutionConfig(mode=mode), o), "seq", *led.LEDGER_COLUMNS)
            for o in (KEYED, Ordering(chunk_rows=4, bucket="1 day")))
    assert a == b and len(a) == 40


def loop_ledger(prices, signals, sizes, cfg):
    """The trading rule as a plain loop (marked-to-market, no delay)."""
    pos, out, last = 0.0, [], None
    for p, s, u in zip(prices, signals, sizes):
        target = pos if s is None else max(-cfg.max_position, min(cfg.max_position, s * u))
        trade = target - pos if abs(target - pos) >= cfg.min_trade_size else 0.0
        cost = abs(trade) * p * (cfg.transaction_cost + cfg.slippage)
        out.append((pos + trade, trade, (pos * (p - last) if last is not None else 0.0) - cost))
        pos, last = pos + trade, p
    return out


@pytest.mark.parametrize("seed", range(4))
def test_ledger_is_the_loop(spark, seed):
    rng = random.Random(seed)
    n, cfg = 40, ExecutionConfig(mode="mtm", execution_delay=0, max_position=2.0)
    p = [100 + rng.random() for _ in range(n)]
    s = [rng.choice([-1, 0, 1, None]) for _ in range(n)]
    u = [rng.choice([0.5, 1.0, 2.5]) for _ in range(n)]
    df = series(spark, [("A", f"2024-01-01 00:00:{i:02d}", i, p[i], 0.0, s[i], u[i]) for i in range(n)])
    got = rows(led.execute_trades(df, cfg, Ordering(chunk_rows=7, bucket="1 day")), "seq", "position", "trade_size", "pnl")
    assert np.allclose([r[1:] for r in got], loop_ledger(p, s, u, cfg))


def test_ledger_refuses_changes_below_a_trade(spark):
    df = series(spark, [("A", f"2024-01-01 00:00:{i:02d}", i, 1.0, 0.0, 1, 1 + i / 20) for i in range(4)])
    with pytest.raises(Exception, match="min_trade_size"):
        led.execute_trades(df, ExecutionConfig(), KEYED).collect()


def test_own_extractors_declare_their_depth(spark):
    def mean30(f, w, cfg):
        return f.withColumn("m30", F.avg("mid_price").over(w.rowsBetween(-29, 0)))

    df = series(spark, [("A", f"2024-01-01 00:{i // 60:02d}:{i % 60:02d}", i, float(i % 7), 0.0, 0, 1.0) for i in range(100)])
    o = Ordering(chunk_rows=400, bucket="1 day")
    with pytest.raises(ValueError, match="mean30"):
        fx.extract_one(df, mean30, FeatureConfig(), o)
    keyed = rows(fx.extract_one(df, mean30, FeatureConfig(), KEYED), "seq", "m30")
    small = Ordering(chunk_rows=FeatureConfig().lookback() + 40, bucket="1 day")
    long = series(spark, [("A", f"2024-01-01 {i // 3600:02d}:{i // 60 % 60:02d}:{i % 60:02d}", i, float(i % 7), 0.0, 0, 1.0)
                          for i in range(3 * small.chunk_rows)])
    declared = fx.reads(29)(mean30)
    assert rows(fx.extract_one(long, declared, FeatureConfig(), small), "seq", "m30") == \
        rows(fx.extract_one(long, declared, FeatureConfig(), KEYED), "seq", "m30")
    assert len(keyed) == 100


def test_nan_probability_gives_no_signal(spark):
    df = spark.createDataFrame([(float("nan"), 0.1), (0.9, float("nan")), (0.9, 0.1)], "u double, d double")
    got = df.select(sg.signal_ternary(F.col("u"), F.col("d"), 0.6, 0.4).alias("t"),
                    sg.signal_binary(F.col("u"), 0.6, 0.4).alias("b")).collect()
    assert [(r.t, r.b) for r in got] == [(None, None), (1, 1), (1, 1)]


def test_wide_csv_drops_nan_levels_and_keeps_file_order(spark, tmp_path):
    head = ["timestamp"] + [f"{s}_{i}" for s in ("bid_price", "bid_size", "ask_price", "ask_size") for i in (1, 2)]
    for name, n, first in (("a.csv", 3, 0), ("b.csv", 400, 1000)):
        lines = [",".join(head)] + [f"2024-01-01 00:00:00,100,NaN,{first + i},,101,102,5,6" for i in range(n)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    got = readers.read_wide_book(spark, str(tmp_path), levels=2)
    assert {(tuple(r.bid_prices), len(r.ask_sizes)) for r in got.collect()} == {((100.0,), 2)}
    assert [r.bid_sizes[0] for r in got.orderBy("ts", "seq").collect()] == [0, 1, 2, *range(1000, 1400)]


def test_all_levels_count(spark):
    wide = {f"{s}_size_{i}": (float(i == 7) * 14 + 1 if s == "bid" else 2.0) for s in ("bid", "ask") for i in range(1, 8)}
    df = spark.createDataFrame([{**wide, "bid_price_1": 1.0, "ask_price_1": 2.0}])
    b, a = 21.0, 14.0
    assert book.with_book_basics(df).first().imbalance == pytest.approx((b - a) / (b + a))
    assert book.level_count(df) == 7


def test_quantiles_rank_distinct_values_only(spark):
    df = spark.range(0, 10_000).select(F.when(F.col("id") % 10 < 8, 5.0).otherwise(F.col("id") / 1000.0).alias("v"),
                                       F.when(F.col("id") % 2 == 0, "k").alias("key"))
    qs = {"a": 0.05, "b": 0.5, "c": 0.97}
    got = {r.key: r for r in quantiles.exact_quantiles(df, ["key"], "v", qs, accuracy=100).collect()}
    pdf = df.toPandas()
    for key in ("k", None):
        v = pdf[pdf.key == key].v if key else pdf[pdf.key.isna()].v
        assert np.allclose([got[key][n] for n in qs], np.quantile(v, list(qs.values())))
    bounds = F.lit(0.0)
    joined = df.select("key", F.col("v").alias("_v"), F.lit("q").alias("_q"), *[bounds.alias(c) for c in (
        "_lo", "_below", "_klo", "_khi", "_frac", "_bot")], F.lit(9.0).alias("_top"))
    band = quantiles.band_values(joined, ["key"])
    assert band.count() == band.select("key", "_v").distinct().count()
    assert band.agg(F.max("_m")).first()[0] == 5000 or band.agg(F.max("_m")).first()[0] == 4000


def test_class_weights_need_no_join(spark):
    df = spark.createDataFrame([(float(i % 3) if i % 7 else None, i) for i in range(60)], "label double, i int")
    out = lb.with_class_weight(df)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    want = {r.label: r.weight for r in lb.class_weights(df).collect()}
    assert all(r.weight == want.get(r.label) for r in out.collect())


def test_open_registries(spark, tmp_path):
    from pyspark.ml.classification import NaiveBayes
    md.register_estimator("bayes", lambda cfg, n, label, weight: NaiveBayes(modelType="gaussian", labelCol=label))
    df = spark.createDataFrame([(float(i % 2), float(i % 2 + i / 100)) for i in range(40)], "label double, f double")
    model = md.fit(df, ["f"], ModelConfig("bayes"), n_classes=2)
    path = str(tmp_path / "model")
    md.save_model(model, path)
    a, b = (md.predict(m, df, 2).select("prediction", "prob_up").collect() for m in (model, md.load_model(path)))
    assert a == b and sum(r.prediction for r in a) == 20
    with pytest.raises(ValueError, match="bayes"):
        md.fit(df, ["f"], ModelConfig("nothing"))
    readers.register_book_source("mine", lambda s, p, **kw: s.range(3))
    assert readers.load_book_source(spark, "mine", "x").count() == 3
    with pytest.raises(ValueError, match="mine"):
        readers.load_book_source(spark, "nothing", "x")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    for master in ("yarn", "spark://host:7077", "k8s://x", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.local_scratch(master)
    assert session.local_scratch("local[4]") and session.local_scratch("local")


def test_scratch_tables_are_deleted(spark):
    import os
    path = session.scratch_table(spark.range(3), "to-drop").inputFiles()[0].removeprefix("file:")
    assert os.path.exists(path)
    session.drop_scratch("to-drop")
    assert not os.path.exists(path)


def test_time_order(spark):
    df = awkward(spark).drop("signal")
    got = [r.ts for r in tsx.sort_by_time(df).collect()]
    assert [t for t in got if t] == sorted(t for t in got if t) and len(got) == df.count()


def test_labels_agree_on_nulls(spark):
    df = awkward(spark, 30)
    a, b = (rows(lb.add_labels(df, LabelConfig(horizon=1), o), "seq", "label") for o in (KEYED, SMALL))
    assert a == b


def test_sinks_write_all_levels(spark, tmp_path):
    df = spark.createDataFrame([{"symbol": "A", **{f"{s}_{i}": float(i) for s in (
        "bid_price", "bid_size", "ask_price", "ask_size") for i in range(1, 8)}}]).withColumn(
        "ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    path = str(tmp_path / "list")
    sinks.write_list_csv(df, path)
    assert len(readers.read_list_book(spark, path).first().bid_sizes) == 7
