"""Catalogue part 1: book, features, time-series shaping and labels."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import FeatureConfig, LabelConfig, Ordering
from ..operators import features as fx
from ..operators import labels as lb
from ..operators import timeseries as tsx
from ..sources.book import N_LEVELS, load_book
from .defaults import ORDERING
from .registry import register
from .sqltext import W, dlit, features_sql, label_sql

LEVEL_COLS = [f"{s}_{i}" for i in range(1, N_LEVELS + 1)
              for s in ("bid_price", "bid_size", "ask_price", "ask_size")]


#: Rows of a task of the feature windows, on average.
TASK_ROWS = 100_000


def layout(book: DataFrame) -> Ordering:
    """``ORDERING``, for tables of many rows with a count of partitions that grows with them.
    Left to the engine, partitions are merged by their compressed bytes until there are about
    as many as cores: the rows that a task sorts grow with the table, and spill to make room
    for the buffers of its windows. Small tables stay with the engine, which evens them out."""
    tasks = math.ceil(book.count() / TASK_ROWS)
    few = tasks <= book.sparkSession.sparkContext.defaultParallelism
    return ORDERING if few else replace(ORDERING, partitions=tasks)


def features(spark: SparkSession, sf: str, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    book = load_book(spark, sf)
    return fx.feature_pipeline(book, cfg, layout(book))


def _d(cols) -> str:
    small = ("return_", "volatility_")
    return " ".join(f"{c}:{'e' if c.startswith(small) else 'd'}" for c in cols)


FEAT = f"WITH feat AS ({features_sql()}) SELECT * FROM feat"

# ------------------------------------------------------------------ book

register("book_wide", "symbol ts seq mid_price:d spread:d imbalance:d "
         + _d(LEVEL_COLS) + " prob_up:d prob_down:d", "SELECT * FROM book")(
    lambda spark, sf: load_book(spark, sf))


def _book_arrays(spark: SparkSession, sf: str) -> DataFrame:
    from ..sources.readers import to_snapshot_arrays, widen_levels, book_basics_from_arrays
    snap = to_snapshot_arrays(load_book(spark, sf))
    out = book_basics_from_arrays(snap)
    wide = widen_levels(out, max_levels=N_LEVELS)
    return wide.select(
        "symbol", "seq", F.size("bid_sizes").cast("bigint").alias("n_bid_levels"),
        F.aggregate("bid_sizes", F.lit(0.0), lambda a, x: a + x).alias("bid_depth"),
        F.aggregate("ask_sizes", F.lit(0.0), lambda a, x: a + x).alias("ask_depth"),
        "mid_price", "spread", "imbalance", F.col("bid_size_5").alias("level5_bid"))


_ARR = " , ".join(f"bid_size_{i}" for i in range(1, N_LEVELS + 1))
_ARA = " , ".join(f"ask_size_{i}" for i in range(1, N_LEVELS + 1))
register("book_arrays",
         "symbol seq n_bid_levels bid_depth:d ask_depth:d mid_price:d spread:d imbalance:d level5_bid:d",
         f"""SELECT symbol, seq, CAST(len(bs) AS BIGINT) AS n_bid_levels,
       list_reduce(list_prepend({dlit(0.0)}, bs), lambda a, x: a + x) AS bid_depth,
       list_reduce(list_prepend({dlit(0.0)}, asz), lambda a, x: a + x) AS ask_depth,
       (bp[1] + ap[1]) / {dlit(2.0)} AS mid_price, ap[1] - bp[1] AS spread,
       CASE WHEN list_reduce(list_prepend({dlit(0.0)}, bs), lambda a, x: a + x)
               + list_reduce(list_prepend({dlit(0.0)}, asz), lambda a, x: a + x) > 0
            THEN (list_reduce(list_prepend({dlit(0.0)}, bs), lambda a, x: a + x)
                  - list_reduce(list_prepend({dlit(0.0)}, asz), lambda a, x: a + x))
               / (list_reduce(list_prepend({dlit(0.0)}, bs), lambda a, x: a + x)
                  + list_reduce(list_prepend({dlit(0.0)}, asz), lambda a, x: a + x))
            ELSE {dlit(0.0)} END AS imbalance,
       bs[5] AS level5_bid
FROM (SELECT symbol, seq,
             list_filter([{_ARR}], lambda x: x IS NOT NULL) AS bs,
             list_filter([{_ARA}], lambda x: x IS NOT NULL) AS asz,
             list_filter([{", ".join(f"bid_price_{i}" for i in range(1, N_LEVELS + 1))}], lambda x: x IS NOT NULL) AS bp,
             list_filter([{", ".join(f"ask_price_{i}" for i in range(1, N_LEVELS + 1))}], lambda x: x IS NOT NULL) AS ap
      FROM book) a""")(_book_arrays)

# ------------------------------------------------------------------ features

OFI_COLS = ([f"ofi_level_{i}" for i in range(1, 6)] + [f"ofi_level_{i}_rolling" for i in range(1, 6)]
            + [f"ofi_level_{i}_momentum" for i in range(1, 6)] + ["ofi_aggregate", "ofi_aggregate_rolling"])
SPREAD_COLS = ["spread_log", "spread_rolling_mean", "spread_rolling_std", "spread_relative",
               "spread_relative_rolling", "spread_momentum", "spread_momentum_rolling"]
DEPTH_COLS = ["total_bid_depth", "total_ask_depth", "total_depth", "depth_imbalance",
              "total_depth_rolling", "depth_imbalance_rolling", "total_depth_momentum",
              "depth_imbalance_momentum"]
IMB_COLS = ([f"imbalance_level_{i}" for i in range(1, 6)]
            + [f"imbalance_level_{i}_rolling" for i in range(1, 6)]
            + ["weighted_imbalance", "weighted_imbalance_rolling"])
VWAP_COLS = ["vwap", "vwap_rolling", "vwap_momentum", "vwap_deviation", "vwap_deviation_abs"]
RET_COLS = [f"{p}_{n}" for n in (1, 5, 10, 20) for p in ("return_forward", "return_backward", "volatility")]
MOM_COLS = [f"{p}_{n}" for n in (1, 5, 10, 20) for p in ("skewness", "kurtosis")]
MICRO_COLS = ["microprice", "microprice_rolling", "microprice_deviation", "microprice_deviation_abs"]

for _name, _cols in (("ofi_features", OFI_COLS), ("spread_features", SPREAD_COLS),
                     ("depth_features", DEPTH_COLS), ("imbalance_features", IMB_COLS),
                     ("vwap_features", VWAP_COLS), ("return_features", RET_COLS),
                     ("moment_features", MOM_COLS), ("microprice_features", MICRO_COLS)):
    register(_name, "symbol ts seq " + _d(_cols), FEAT)(
        lambda spark, sf: features(spark, sf))

MODEL_READY = FeatureConfig(model_ready=True)


def model_feature_names(cfg: FeatureConfig = MODEL_READY) -> list[str]:
    """Derived feature columns of the default pipeline, in plan order."""
    ret = []
    for n in cfg.return_windows:
        ret += [f"return_forward_{n}", f"return_backward_{n}"]
        if not cfg.model_ready or n >= 2:
            ret.append(f"volatility_{n}")
        if not cfg.model_ready or n >= 3:
            ret.append(f"skewness_{n}")
        if not cfg.model_ready or n >= 4:
            ret.append(f"kurtosis_{n}")
    return OFI_COLS + SPREAD_COLS + DEPTH_COLS + IMB_COLS + VWAP_COLS + ret + MICRO_COLS


def feature_table(spark: SparkSession, sf: str) -> DataFrame:
    """WIN27 + PRJ17 + PRJ18 + FLT2: model-ready features, incomplete rows dropped."""
    f = features(spark, sf, MODEL_READY)
    return fx.drop_incomplete(f)


#: The condition under which a row has all model inputs.
COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in [
    "mid_price", "spread", "imbalance", *LEVEL_COLS,
    *[c for c in model_feature_names() if not c.startswith("return_forward_")]])


def _feature_table_sql() -> str:
    return f"WITH feat AS ({features_sql(MODEL_READY)}) SELECT * FROM feat WHERE {COMPLETE}"


register("feature_table", "symbol ts seq " + _d(model_feature_names()), _feature_table_sql())(
    feature_table)

# ------------------------------------------------------------------ time series

T0, T1 = "2024-01-10 00:00:00", "2024-01-20 12:00:00"
register("time_filter", "symbol ts seq mid_price:d",
         f"SELECT * FROM book WHERE ts >= TIMESTAMP '{T0}' AND ts <= TIMESTAMP '{T1}'")(
    lambda spark, sf: tsx.filter_by_time(load_book(spark, sf), T0, T1))

RS_COLS = ["mid_price", "spread", "imbalance", *LEVEL_COLS, "prob_up", "prob_down"]
register("resample_last", "symbol ts " + _d(RS_COLS), f"""
WITH agg AS (
  SELECT symbol, date_trunc('hour', ts) AS b,
         {", ".join(f"arg_max({c}, ts) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in RS_COLS)}
  FROM book GROUP BY 1, 2),
bounds AS (SELECT symbol, min(b) AS lo, max(b) AS hi FROM agg GROUP BY 1),
spine AS (SELECT symbol, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS b FROM bounds)
SELECT s.symbol, s.b AS ts, {", ".join(f"a.{c}" for c in RS_COLS)}
FROM spine s LEFT JOIN agg a ON a.symbol = s.symbol AND a.b = s.b""")(
    lambda spark, sf: tsx.resample_last(load_book(spark, sf), "1 hour", RS_COLS, ORDERING))

_POS = f"row_number() OVER ({W}) - 1 AS pos, count(*) OVER (PARTITION BY symbol) AS n"
register("sliding_windows", "symbol window_id seq mid_price:d", f"""
WITH p AS (SELECT symbol, seq, mid_price, {_POS} FROM book),
w AS (SELECT symbol, unnest(generate_series(0, n - 20, 5)) AS start
      FROM (SELECT DISTINCT symbol, n FROM p) d WHERE n >= 20)
SELECT p.symbol, w.start // 5 AS window_id, p.seq, p.mid_price
FROM p JOIN w ON p.symbol = w.symbol AND p.pos BETWEEN w.start AND w.start + 19""")(
    lambda spark, sf: tsx.sliding_windows(load_book(spark, sf), 20, 5, ORDERING))


def _sequence_samples(spark: SparkSession, sf: str) -> DataFrame:
    b = lb.add_labels(load_book(spark, sf), LabelConfig(), ORDERING)
    s = tsx.sequence_samples(b, ["seq", "mid_price", "spread", "imbalance"], 20, o=ORDERING)
    return s.select("symbol", "seq", "label", F.size("window").cast("bigint").alias("steps"),
                    F.col("window")[0]["seq"].alias("first_seq"),
                    F.col("window")[19]["seq"].alias("last_seq"),
                    F.aggregate("window", F.lit(0.0), lambda a, x: a + x["mid_price"]).alias("mid_sum"))


_PREV = f"({W} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
register("sequence_samples", "symbol seq label:d steps first_seq last_seq mid_sum:d", f"""
SELECT * FROM (
  SELECT symbol, seq, {label_sql()} AS label, count(*) OVER {_PREV} AS steps,
         first_value(seq) OVER {_PREV} AS first_seq, last_value(seq) OVER {_PREV} AS last_seq,
         sum(mid_price) OVER {_PREV} AS mid_sum
  FROM book) s WHERE steps = 20""")(_sequence_samples)

register("time_split", "symbol seq split", f"""
SELECT symbol, seq,
  CASE WHEN pos < n - floor(CAST(n AS DOUBLE) * {dlit(0.2)}) - floor(CAST(n AS DOUBLE) * {dlit(0.2)}) THEN 'train'
       WHEN pos < n - floor(CAST(n AS DOUBLE) * {dlit(0.2)}) THEN 'val' ELSE 'test' END AS split
FROM (SELECT symbol, seq, {_POS} FROM book) p""")(
    lambda spark, sf: tsx.time_split(load_book(spark, sf), 0.2, 0.2, ORDERING))

register("time_split_ratio", "symbol seq split", f"""
SELECT symbol, seq,
  CASE WHEN pos < floor(CAST(n AS DOUBLE) * {dlit(0.8)}) THEN 'train' ELSE 'test' END AS split
FROM (SELECT symbol, seq, {_POS} FROM book) p""")(
    lambda spark, sf: tsx.time_split_ratio(load_book(spark, sf), 0.8, ORDERING))

WF_TRAIN, WF_TEST = 1000, 200
_FOLDS = f"""SELECT *, (pos - {WF_TRAIN}) // {WF_TEST} AS fold FROM (
  SELECT *, {_POS} FROM book) p
  WHERE pos >= {WF_TRAIN} AND ((pos - {WF_TRAIN}) // {WF_TEST}) * {WF_TEST} < n - {WF_TRAIN + WF_TEST}"""
register("walk_forward_folds", "symbol seq fold train_start train_end test_start test_end", f"""
SELECT symbol, seq, fold, fold * {WF_TEST} AS train_start, fold * {WF_TEST} + {WF_TRAIN} AS train_end,
       fold * {WF_TEST} + {WF_TRAIN} AS test_start, fold * {WF_TEST} + {WF_TRAIN + WF_TEST} AS test_end
FROM ({_FOLDS}) f""")(
    lambda spark, sf: tsx.walk_forward(load_book(spark, sf), WF_TRAIN, WF_TEST, ORDERING))

# ------------------------------------------------------------------ labels

register("labels_ternary", "symbol seq label:d", f"SELECT symbol, seq, {label_sql()} AS label FROM book")(
    lambda spark, sf: lb.add_labels(load_book(spark, sf), LabelConfig(), ORDERING))
register("labels_binary", "symbol seq label:d",
         f"SELECT symbol, seq, {label_sql(method='binary')} AS label FROM book")(
    lambda spark, sf: lb.add_labels(load_book(spark, sf), LabelConfig(method="binary"), ORDERING))

register("label_distribution", "symbol label:d n", f"""
SELECT symbol, label, count(*) AS n FROM (SELECT symbol, {label_sql()} AS label FROM book) l
GROUP BY symbol, label""")(
    lambda spark, sf: lb.label_distribution(
        lb.add_labels(load_book(spark, sf), LabelConfig(), ORDERING), "label", "symbol"))

register("class_weights", "symbol label n_c weight:d", f"""
SELECT symbol, label, n_c,
       CAST(sum(n_c) OVER (PARTITION BY symbol) AS DOUBLE)
       / (CAST(count(*) OVER (PARTITION BY symbol) AS DOUBLE) * CAST(n_c AS DOUBLE)) AS weight
FROM (SELECT symbol, label, count(*) AS n_c
      FROM (SELECT symbol, {label_sql()} AS label FROM book) l
      WHERE label IS NOT NULL GROUP BY symbol, label) c""")(
    lambda spark, sf: lb.class_weights(
        lb.add_labels(load_book(spark, sf), LabelConfig(), ORDERING), "label", "symbol"))


def label_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: feature table -> ternary labels -> rows and mean weighted
    imbalance per symbol and label (the null label of the last row kept)."""
    f = lb.labelled_features(load_book(spark, sf), FeatureConfig(), LabelConfig(), ORDERING)
    return f.groupBy("symbol", "label").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("weighted_imbalance").alias("mean_weighted_imbalance"),
        F.avg("ofi_aggregate_rolling").alias("mean_ofi_rolling"))


register("label_summary", "symbol label:d n mean_weighted_imbalance:d mean_ofi_rolling:d", f"""
WITH feat AS ({features_sql()})
SELECT symbol, label, count(*) AS n, avg(weighted_imbalance) AS mean_weighted_imbalance,
       avg(ofi_aggregate_rolling) AS mean_ofi_rolling
FROM (SELECT *, {label_sql()} AS label FROM feat) l GROUP BY symbol, label""")(label_summary)
