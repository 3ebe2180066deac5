"""Properties: chunked layout == keyed layout; exact quantiles == numpy; plan shape."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tickframe.config import ExecutionConfig, FeatureConfig, LabelConfig, Ordering, SignalConfig
from tickframe.operators import features as fx
from tickframe.operators import labels as lb
from tickframe.operators import ledger as led
from tickframe.operators import metrics as mx
from tickframe.operators import signals as sg
from tickframe.operators import timeseries as tsx
from tickframe.operators.quantiles import exact_quantiles
from tickframe.sources.book import load_book

KEYED = Ordering()
CHUNKED = Ordering(chunk_rows=25, bucket="1 day")   # many chunks per symbol at sf0.001


def same(a, b, cols):
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_features_and_labels_chunked_equal_keyed(spark):
    book = load_book(spark, SF_SMALL)
    k = lb.add_labels(fx.feature_pipeline(book, FeatureConfig(), KEYED), LabelConfig(), KEYED)
    c = lb.add_labels(fx.feature_pipeline(book, FeatureConfig(), CHUNKED), LabelConfig(), CHUNKED)
    assert same(k, c, [x for x in k.columns if x != "pos"])


def test_ledger_and_drawdown_chunked_equal_keyed(spark):
    s = sg.generate_signals(load_book(spark, SF_SMALL), SignalConfig())
    for mode in ("reference", "mtm"):
        cfg = ExecutionConfig(mode=mode)
        k = mx.with_drawdown(led.execute_trades(s, cfg, KEYED), KEYED)
        c = mx.with_drawdown(led.execute_trades(s, cfg, CHUNKED), CHUNKED)
        cols = ["symbol", "seq", *led.LEDGER_COLUMNS, "running_max", "drawdown"]
        assert same(k.select(*[F.round(x, 9).alias(x) if x not in ("symbol", "seq") else x
                               for x in cols]),
                    c.select(*[F.round(x, 9).alias(x) if x not in ("symbol", "seq") else x
                               for x in cols]), cols)


def test_positions_and_folds_chunked_equal_keyed(spark):
    b = load_book(spark, SF_SMALL)
    k = tsx.walk_forward(b, 40, 10, KEYED)
    c = tsx.walk_forward(b, 40, 10, CHUNKED)
    assert same(k, c, ["symbol", "seq", "pos", "fold"])
    assert k.count() > 0


def test_exact_quantiles_match_numpy(spark):
    df = spark.range(0, 5000).select((F.col("id") % 4).alias("k"),
                                     F.round(F.cos(F.col("id")) * 100, 1).alias("v"))
    qs = {"a": 0.01, "b": 0.05, "c": 0.5, "d": 0.99}
    got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", qs, accuracy=200).collect()}
    pdf = df.toPandas()
    for key, g in pdf.groupby("k"):
        for name, q in qs.items():
            assert abs(got[key][name] - np.percentile(g.v, q * 100)) < 1e-9


def test_keyed_feature_pipeline_has_one_exchange(spark):
    book = load_book(spark, SF_SMALL)
    plan = fx.feature_pipeline(book, FeatureConfig(), KEYED)._jdf.queryExecution() \
        .executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_unknown_names_raise(spark):
    import pytest
    from tickframe.config import ModelConfig
    from tickframe.operators.models import build_pipeline
    with pytest.raises(ValueError):
        build_pipeline(["a"], ModelConfig("unknown_model"))
    with pytest.raises(ValueError):
        LabelConfig(method="quaternary")
    with pytest.raises(FileNotFoundError):
        from tickframe.sources.readers import read_list_book
        read_list_book(spark, "/nonexistent/file.csv")


def test_ledger_is_laid_out_once(spark):
    s = sg.generate_signals(load_book(spark, SF_SMALL), SignalConfig())
    plan = led.execute_trades(s, ExecutionConfig(), CHUNKED)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 4 and plan.count("Exchange hashpartitioning") <= 10


def test_labels_in_the_layout_of_the_features(spark):
    book = load_book(spark, SF_SMALL).withColumn("mid_price", F.when(
        F.col("seq") % 7 == 3, F.lit(float("nan"))).otherwise(F.col("mid_price")))
    two = lb.add_labels(fx.feature_pipeline(book, FeatureConfig(), CHUNKED), LabelConfig(), CHUNKED)
    one = lb.labelled_features(book, FeatureConfig(), LabelConfig(), CHUNKED)
    cols = ["symbol", "seq", "label", "mid_price", "return_forward_1", "ofi_aggregate_rolling"]
    assert same(one, two, cols) and one.columns == two.columns


def test_correlation_takes_the_rows_both_columns_have(spark):
    n = F.col("id")
    df = spark.range(400).select(
        (F.sin(n) + 1e6).alias("a"), F.when(n % 3 > 0, F.cos(n * 2) + n / 100).alias("b"),
        F.lit(7.1).alias("fixed"), F.lit(None).cast("double").alias("void"))
    cols = ["a", "b", "fixed", "void"]
    got = {(r[0], r[1]): r[2] for r in mx.feature_correlation(df, cols).collect()}
    want = df.toPandas().astype(float).corr()
    assert len(got) == 10
    for (x, y), v in got.items():
        w = want.loc[x, y]
        assert v is None if np.isnan(w) or "fixed" in (x, y) else abs(v - w) < 1e-9
