"""Extractors that read their neighbours through one window operator."""

import math

import pytest
from pyspark.sql import Window

from tickframe.config import FeatureConfig, Ordering
from tickframe.functions import frames as fr
from tickframe.operators import features as fx

SIDES = [f"{s}_{k}_{i}" for i in (1, 2) for s in ("bid", "ask") for k in ("price", "size")]


def small_book(spark):
    """Two series of 80 rows: holes, a NaN, a frame of equal spreads, sizes of 0."""
    rows = []
    for key in ("a", "b"):
        for t in range(80):
            mid = 100.0 + (0.0 if 20 <= t < 50 else ((t * 37) % 11) / 10)
            half = 0.1 if 20 <= t < 50 else 0.01 * (1 + t * 7 % 5)
            size = [None if t % 13 == 5 and key == "a" else float((t * m) % 9) for m in (3, 5, 7, 2)]
            price = [mid - half, mid + half, mid - 2 * half, mid + 2 * half]
            if key == "b" and t == 60:
                price[0] = math.nan
            if key == "b" and t == 10:
                price[1] = None
            bp, ap = price[0], price[1]
            none = bp is None or ap is None
            rows.append((key, t, bp, size[0], ap, size[1], price[2], size[2], price[3], size[3],
                         None if none else (bp + ap) / 2, None if none else ap - bp))
    return spark.createDataFrame(rows, "symbol string, ts int, bid_price_1 double, bid_size_1 double, ask_price_1 double, "
                                 "ask_size_1 double, bid_price_2 double, bid_size_2 double, ask_price_2 double, "
                                 "ask_size_2 double, mid_price double, spread double")


ORDER = Ordering(keys=("symbol",), order=("ts",))


@pytest.mark.parametrize("cfg", [FeatureConfig(), FeatureConfig(model_ready=True, vwap_volume=True)])
def test_extractors_share_one_window(spark, cfg):
    out = fx.feature_pipeline(small_book(spark), cfg, ORDER)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Window ") for line in plan.splitlines()) == 1


def test_lags_equal_window_aggregates(spark, monkeypatch):
    cfg = FeatureConfig(vwap_volume=True)
    lags = fx.feature_pipeline(small_book(spark), cfg, ORDER).orderBy("symbol", "ts")
    got, names = lags.collect(), lags.columns
    monkeypatch.setattr(fr, "MAX_LAGS", 0)
    wide = fx.feature_pipeline(small_book(spark), cfg, ORDER).orderBy("symbol", "ts")
    assert wide.columns == names
    for a, b in zip(got, wide.collect(), strict=True):
        for c in names:
            if isinstance(a[c], float) and b[c] is not None:
                assert math.isclose(a[c], b[c], rel_tol=1e-7, abs_tol=1e-7), (c, a["symbol"], a["ts"], a[c], b[c])
            else:
                assert a[c] == b[c], (c, a["symbol"], a["ts"], a[c], b[c])


def test_extractors_together_give_what_they_give_alone(spark):
    w = Window.partitionBy("symbol").orderBy("ts")
    one = small_book(spark)
    for ex in fx.DEFAULT_EXTRACTORS:
        one = ex(one, w, FeatureConfig())
    together = fx.run_together(fx.DEFAULT_EXTRACTORS, small_book(spark), w, FeatureConfig())
    assert one.columns == together.columns
    clean = lambda d: sorted(map(repr, fx.null_out_non_finite(d).collect()))
    assert clean(one) == clean(together)


def test_incomplete_rows_are_found_above_the_features(spark):
    """The filter stays above the window; below the projections it would make every feature anew."""
    f = fx.drop_incomplete(fx.feature_pipeline(small_book(spark), FeatureConfig(model_ready=True), ORDER))
    lines = [x.lstrip(" :+-") for x in f._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    assert next(x for x in lines if x.startswith("Filter")) == next(x for x in lines if x.startswith("Filter isnotnull(_complete"))
    assert not any(x.startswith("Filter") and ("isnan" in x or "atleastnnonnulls" in x.lower()) for x in lines)


def test_incomplete_rows_are_dropped(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", None, 2.0), ("c", 1.0, math.nan), (None, 3.0, 4.0)],
                               "symbol string, x double, `y.z` double")
    assert {r[1] for r in fx.drop_incomplete(df).collect()} == {1.0, 3.0}
    assert fx.drop_incomplete(df, ["x"]).count() == 3 and fx.drop_incomplete(df, ["symbol"]).count() == 3


def test_fits_do_not_write_written_rows_again(spark, monkeypatch, tmp_path):
    from tickframe.operators import models as md
    from tickframe.plans import catalog_models as cm
    rows = [(f"S{i % 2}", i, i % 3, float(i % 3) + (i * 7 % 5) / 10, float(i * 13 % 11), "test" if i % 4 == 0 else "train")
            for i in range(120)]
    df = spark.createDataFrame(rows, "symbol string, seq long, label int, x double, y double, split string")
    df.write.parquet(str(tmp_path / "rows"))
    monkeypatch.setattr(cm, "training_frame", lambda *a: (spark.read.parquet(str(tmp_path / "rows")), ["x", "y"]))
    written = []
    monkeypatch.setattr(md, "materialize", lambda d, name: written.append(name) or d)
    out = cm.fit_and_score(spark, "", "logistic_regression").collect()
    assert len(out) == 30 and all(math.isclose(r.prob_down + r.prob_flat + r.prob_up, 1.0) for r in out)
    assert cm._kept_rows("random_forest", n_estimators=2, max_depth=2)(spark, "").filter("likeliest").count() == 30
    assert written == []
