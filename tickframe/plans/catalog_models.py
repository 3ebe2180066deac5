"""Catalogue part 4: models (rows-only checks) and file round trips."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LabelConfig, ModelConfig
from ..operators import features as fx
from ..operators import labels as lb
from ..operators import metrics as mx
from ..operators import models as md
from ..operators import timeseries as tsx
from ..operators.ordered import with_positions
from ..session import drop_table, scratch_table
from ..sources import readers as rd
from ..sources import sinks as sk
from ..sources.book import N_LEVELS, load_book
from .catalog_backtest import LEDGER_COLS, SIGNALS_SRC, ledger, ledger_sql
from .catalog_eval import PRED_SQL, predictions
from .catalog_features import COMPLETE, LEVEL_COLS, MODEL_READY, features, model_feature_names
from .defaults import ORDERING
from .registry import register
from .sqltext import W, dlit, features_sql, label_sql

PRED_SPEC = "symbol seq label prediction prob_down:d prob_flat:d prob_up:d"


#: Number of a row in ``complete_rows``.
ROW = "_row"


def complete_rows(spark: SparkSession, sf: str, only: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Model-ready features without incomplete rows, written once, and the names of all of
    them. Every step that lays the rows out anew reads its input twice (positions count it
    first), so steps on top of each other would compute the features many times over.
    ``only``: the features that are wanted in the rows (all by default). ``ROW`` tells the
    rows apart, whatever their keys."""
    f = fx.drop_incomplete(features(spark, sf, MODEL_READY))
    cols = fx.feature_columns(f)
    keep = dict.fromkeys([*ORDERING.keys, *ORDERING.order, "mid_price", *(cols if only is None else only)])
    return scratch_table(f.select(*keep).withColumn(ROW, F.monotonically_increasing_id()), "complete-rows"), cols


def slim_rows(f: DataFrame) -> DataFrame:
    """What positions, labels and splits read of ``complete_rows``: they are laid out by
    these few columns, and the features follow once, by ``with_marks``."""
    return f.select(ROW, *ORDERING.keys, *ORDERING.order, "mid_price")


def with_marks(f: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``f`` that ``marks`` names, with its columns. The marks are the side that
    is hashed, so the wide rows are neither sorted nor spilled."""
    return f.join(marks.hint("shuffle_hash"), ROW).drop(ROW)


def training_frame(spark: SparkSession, sf: str, only: Sequence[str] | None = None) -> tuple[DataFrame, list[str]]:
    """Model-ready features, incomplete rows dropped, ternary labels, 80/20 split; written,
    as fits and scores read them many times."""
    f, cols = complete_rows(spark, sf, only)
    marks = lb.drop_unlabelled(lb.add_labels(slim_rows(f), LabelConfig(), ORDERING))
    marks = tsx.time_split_ratio(marks, 0.8, ORDERING).select(ROW, "label", "pos", "split")
    data = scratch_table(with_marks(f, marks), "training-rows")
    drop_table(f)
    return data, cols


def fit_and_score(spark: SparkSession, sf: str, model_type: str) -> DataFrame:
    data, cols = training_frame(spark, sf)
    model = md.fit(data.filter(F.col("split") == "train"), cols, ModelConfig(model_type), written=True)
    return md.predict(model, data.filter(F.col("split") == "test"))


for _name, _type in (("fit_logistic", "logistic_regression"), ("fit_forest", "random_forest"),
                     ("fit_boosted", "lightgbm")):
    register(_name, PRED_SPEC)(lambda spark, sf, _t=_type: fit_and_score(spark, sf, _t))

_TRAINING_SQL = f"""WITH feat AS ({features_sql(MODEL_READY)}),
f AS (SELECT * FROM feat WHERE {COMPLETE}),
l AS (SELECT *, {label_sql()} AS label FROM f),
p AS (SELECT *, row_number() OVER ({W}) - 1 AS pos_, count(*) OVER (PARTITION BY symbol) AS n_
      FROM l WHERE label IS NOT NULL),
s AS (SELECT *, CASE WHEN pos_ < floor(CAST(n_ AS DOUBLE) * {dlit(0.8)}) THEN 'train' ELSE 'test' END AS split FROM p)"""

# the frame that every fit trains on and scores: rows, split, label, class weight
register("ml_training_rows", "symbol seq split label:d weight:d", _TRAINING_SQL + """,
w AS (SELECT label, CAST(sum(count(*)) OVER () AS DOUBLE) / (CAST(count(*) OVER () AS DOUBLE) * count(*)) AS weight
      FROM s WHERE split = 'train' GROUP BY label)
SELECT s.symbol, s.seq, s.split, s.label, w.weight FROM s LEFT JOIN w ON s.split = 'train' AND s.label = w.label""")(
    lambda spark, sf: _training_rows(spark, sf))


def _training_rows(spark: SparkSession, sf: str) -> DataFrame:
    data, _ = training_frame(spark, sf, ())
    train = lb.with_class_weight(data.filter(F.col("split") == "train"))
    return train.unionByName(data.filter(F.col("split") == "test").withColumn("weight", F.lit(None).cast("double")))


Z_COLS = ["spread", "imbalance", "microprice_deviation"]


def _standardised(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ19: the fitted standardiser of the training pipeline applied to the test rows."""
    from pyspark.ml.functions import vector_to_array
    data, _ = training_frame(spark, sf, Z_COLS)
    pipe = md.build_pipeline(Z_COLS, ModelConfig())
    from pyspark.ml import Pipeline
    model = Pipeline(stages=pipe.getStages()[:2]).fit(data.filter(F.col("split") == "train"))
    out = model.transform(data.filter(F.col("split") == "test")).withColumn("z", vector_to_array("features"))
    return out.select("symbol", "seq", *[F.col("z")[i].alias(f"z_{c}") for i, c in enumerate(Z_COLS)])


register("ml_standardise", "symbol seq " + " ".join(f"z_{c}:d" for c in Z_COLS), _TRAINING_SQL + ",\nm AS (SELECT "
         + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in Z_COLS) + " FROM s WHERE split = 'train')\n"
         + "SELECT symbol, seq, " + ", ".join(f"({c} - m_{c}) / s_{c} AS z_{c}" for c in Z_COLS)
         + " FROM s, m WHERE split = 'test'")(_standardised)


def _fitted_rows(spark: SparkSession, sf: str) -> DataFrame:
    """ML2, ML8, ML9: fitted, saved, loaded, scored on the test rows; what must hold
    of every row: probabilities within 0 and 1 that sum to 1, and the likeliest class
    predicted."""
    data, cols = training_frame(spark, sf)
    path = sk.scratch_path(spark, "model")
    model = md.fit(data.filter(F.col("split") == "train"), cols, ModelConfig("logistic_regression"), written=True)
    md.save_model(model, path)
    out = md.predict(md.load_model(path), data.filter(F.col("split") == "test"))
    return _checked(out)


register("fit_logistic_rows", "symbol seq label:d prob_sum:d likeliest", _TRAINING_SQL + f"""
SELECT symbol, seq, label, {dlit(1.0)} AS prob_sum, true AS likeliest FROM s WHERE split = 'test'""")(_fitted_rows)



def _kept_rows(model_type: str, **params):
    """ML3-ML4: what must hold of every scored row (see ``_fitted_rows``)."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        data, cols = training_frame(spark, sf)
        model = md.fit(data.filter(F.col("split") == "train"), cols, ModelConfig(model_type, params), written=True)
        return _checked(md.predict(model, data.filter(F.col("split") == "test")))
    return run


def _checked(out: DataFrame) -> DataFrame:
    probs = ("prob_down", "prob_flat", "prob_up")
    of_class = F.element_at(F.array(*probs), F.col("prediction") + 1)
    return out.withColumns({"prob_sum": F.col("prob_down") + F.col("prob_flat") + F.col("prob_up"),
                            "likeliest": (of_class == F.greatest(*probs)) & F.least(*probs).between(0, 1)})


_KEPT_SQL = f"SELECT symbol, seq, label, {dlit(1.0)} AS prob_sum, true AS likeliest"
for _name, _fn in (("fit_forest_rows", _kept_rows("random_forest", n_estimators=10, max_depth=5)),
                   ("fit_boosted_rows", _kept_rows("lightgbm", n_estimators=3, max_depth=4))):
    register(_name, "symbol seq label:d prob_sum:d likeliest", _TRAINING_SQL + f"\n{_KEPT_SQL} FROM s WHERE split = 'test'")(_fn)


def _importances(spark: SparkSession, sf: str) -> DataFrame:
    """ML6, ML7, TOP1: every feature once, importances of at least 0 that sum to 1, and the
    most important first."""
    data, cols = training_frame(spark, sf)
    model = md.fit(data.filter(F.col("split") == "train"), cols, ModelConfig("random_forest", {"n_estimators": 10, "max_depth": 5}))
    imp = spark.createDataFrame(md.feature_importance(model, cols), "feature STRING, importance DOUBLE")
    first = imp.agg(F.max("importance")).first()[0]
    top = mx.top_features(imp, 20).agg(F.count(F.lit(1)).alias("n_top"), (F.max("importance") == first).alias("first_kept"))
    return imp.agg(F.count_distinct("feature").alias("n_features"), F.sum("importance").alias("total"),
                   (F.min("importance") >= 0).alias("none_below_0")).crossJoin(top)    # one row each


_FEATURES = ["mid_price", "spread", "imbalance", *LEVEL_COLS,
             *[c for c in model_feature_names() if not c.startswith("return_forward_")]]
register("model_importances", "n_features total:d none_below_0 n_top first_kept",
         f"SELECT CAST({len(_FEATURES)} AS BIGINT) AS n_features, {dlit(1.0)} AS total, true AS none_below_0, "
         "CAST(20 AS BIGINT) AS n_top, true AS first_kept")(_importances)

SEQ_LEN = 20
#: Rows of a row group of vectors. A reader takes up to 4,096 rows of a group at once, whatever
#: their width; rows of 16 KB made that some 300 MB a task. Up to ``FEW_ROWS`` vectors fit
#: beside such a reader: their files stay as they were, as the fit depends on its partitions.
WIDE_ROWS, FEW_ROWS = 256, 16_384


def sequence_frame(spark: SparkSession, sf: str) -> tuple[DataFrame, list[str]]:
    """Labelled rows with the features of the ``SEQ_LEN`` rows before them as one vector,
    80/20 split; written. Labels and splits are settled before the vectors are made, so
    that no layout moves a vector: it is ``SEQ_LEN`` rows wide. Samples are ordered by the
    positions that chose them, so rows of equal keys are not lost."""
    f, cols = complete_rows(spark, sf)
    slim = with_positions(lb.add_labels(slim_rows(f), LabelConfig(), ORDERING), ORDERING)
    slim = scratch_table(slim, "sequence-marks")
    kept = lb.drop_unlabelled(slim).filter(F.col("pos") >= SEQ_LEN).drop("pos")
    kept = tsx.time_split_ratio(kept, 0.8, ORDERING).select(ROW, "split")
    marks = slim.select(ROW, "pos", "label").join(kept, ROW, "left")
    by_pos = replace(ORDERING, order=("pos",))
    s = tsx.sequence_samples(with_marks(f, marks), cols, SEQ_LEN, o=by_pos, dense_pos=True).filter("split IS NOT NULL")
    s = md.flatten_window(s, "window", cols, "seq_x")
    groups = {"parquet.block.row.count.limit": WIDE_ROWS} if slim.count() > FEW_ROWS else {}
    s = scratch_table(s.select(*ORDERING.keys, *ORDERING.order, "label", "split", "seq_x"), "sequence-rows", **groups)
    drop_table(f)
    drop_table(slim)
    return s, cols


def fit_sequence(spark: SparkSession, sf: str) -> DataFrame:
    """ML5: class of row i from all features of the previous L rows, as one vector."""
    s, cols = sequence_frame(spark, sf)
    cfg = ModelConfig("lstm", {"n_inputs": SEQ_LEN * len(cols)})
    model = md.fit(s.filter(F.col("split") == "train"), ["seq_x"], cfg, written=True)
    return md.predict(model, s.filter(F.col("split") == "test"))


register("fit_sequence", PRED_SPEC)(fit_sequence)


# ---------------------------------------------------------------- extension points

@fx.reads(29)
def range_features(f: DataFrame, w, cfg) -> DataFrame:
    """EXT1: an extractor of one's own, the range of the last 30 mid prices."""
    last = w.rowsBetween(-29, 0)
    return f.withColumn("mid_range", F.max("mid_price").over(last) - F.min("mid_price").over(last))


register("own_extractor", "symbol seq mid_range:d spread_rolling_mean:d", f"""
WITH feat AS ({features_sql(MODEL_READY)})
SELECT symbol, seq, max(mid_price) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)
       - min(mid_price) OVER ({W} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS mid_range, spread_rolling_mean FROM feat""")(
    lambda spark, sf: fx.feature_pipeline(load_book(spark, sf), MODEL_READY, replace(ORDERING, chunk_rows=400),
                                          (*fx.DEFAULT_EXTRACTORS, range_features)))


def _own_source(spark: SparkSession, sf: str) -> DataFrame:
    """EXT2: a loader of one's own, called by name."""
    rd.register_book_source("derived", lambda s, path, **kw: load_book(s, path))
    return rd.load_book_source(spark, "derived", sf)


register("own_source", "symbol ts seq mid_price:d spread:d", "SELECT * FROM book")(_own_source)


def top_features(spark: SparkSession, sf: str) -> DataFrame:
    """TOP1 over ML6: the 20 most important forest features."""
    data, cols = training_frame(spark, sf)
    model = md.fit(data.filter(F.col("split") == "train"), cols,
                   ModelConfig("random_forest"))
    imp = spark.createDataFrame(md.feature_importance(model, cols), "feature STRING, importance DOUBLE")
    return mx.top_features(imp, 20)


register("top_features", "feature importance:d")(top_features)


def read_list_book_q(spark: SparkSession, sf: str) -> DataFrame:
    """SRC1 round trip: the derived book written as list CSV, read back."""
    path = sk.scratch_path(spark, "list-book")
    sk.write_list_csv(load_book(spark, sf), path)
    snap = rd.read_list_book(spark, path)
    out = rd.book_basics_from_arrays(snap)
    return out.select("symbol", "ts", F.size("bid_prices").cast("bigint").alias("n_levels"),
                      "mid_price", "spread", "imbalance")


def read_wide_book_q(spark: SparkSession, sf: str, read=None) -> DataFrame:
    """SRC2 round trip: wide CSV with header, null levels compacted per list."""
    path = sk.scratch_path(spark, "wide-book")
    sk.write_wide_csv(load_book(spark, sf), path)
    snap = read(spark, path) if read else rd.read_wide_book(spark, path, levels=N_LEVELS)
    out = rd.widen_levels(rd.book_basics_from_arrays(snap), N_LEVELS)
    return out.select("symbol", "ts", F.size("bid_sizes").cast("bigint").alias("n_levels"),
                      "mid_price", "spread", "imbalance")


def table_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SRC4/SNK1: the book through parquet, csv and json, counted per format."""
    b = load_book(spark, sf).select("symbol", "ts", "seq", "mid_price", "spread", "imbalance")
    outs = []
    for fmt in ("parquet", "csv", "json"):
        path = sk.scratch_path(spark, f"rt.{fmt}") + f".{fmt}"
        sk.save_table(b, path, fmt)
        back = rd.load_table(spark, path, schema=None if fmt == "parquet" else
                             "symbol STRING, ts TIMESTAMP_NTZ, seq BIGINT, mid_price DOUBLE, "
                             "spread DOUBLE, imbalance DOUBLE")
        outs.append(back.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"),
                                               F.sum("mid_price").alias("sum_mid"))
                    .withColumn("format", F.lit(fmt)))
    res = outs[0]
    for o in outs[1:]:
        res = res.unionByName(o)
    return res


_SNAP = """SELECT symbol, ts, CAST({n} AS BIGINT) AS n_levels, mid_price, spread, imbalance FROM book"""
_PRESENT = " + ".join(f"(CASE WHEN bid_size_{i} IS NULL THEN 0 ELSE 1 END)" for i in range(1, N_LEVELS + 1))
register("read_list_book", "symbol ts n_levels mid_price:d spread:d imbalance:d", _SNAP.format(n=N_LEVELS))(
    read_list_book_q)
register("read_wide_book", "symbol ts n_levels mid_price:d spread:d imbalance:d", _SNAP.format(n=_PRESENT))(
    read_wide_book_q)
register("load_book_source", "symbol ts n_levels mid_price:d spread:d imbalance:d", _SNAP.format(n=_PRESENT))(
    lambda spark, sf: read_wide_book_q(spark, sf, lambda s, p: rd.load_book_source(s, "kaggle_crypto", p, levels=N_LEVELS)))
register("table_round_trip", "symbol format n sum_mid:d", """
SELECT symbol, f.format, count(*) AS n, sum(mid_price) AS sum_mid
FROM book, (VALUES ('parquet'), ('csv'), ('json')) f(format) GROUP BY 1, 2""")(table_round_trip)


def predictions_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2/SRC5: predictions to parquet and back, every row."""
    path = sk.scratch_path(spark, "predictions") + ".parquet"
    sk.save_predictions(predictions(spark, sf), path)
    return rd.load_predictions(spark, path)


register("predictions_round_trip", "symbol seq label:d prediction:d prob_up:d prob_down:d prob_flat:d", PRED_SQL)(
    predictions_round_trip)


def evaluation_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK4: predictions and an evaluation table written, the table read back."""
    path = sk.scratch_path(spark, "evaluation")
    p = predictions(spark, sf)
    sk.save_evaluation(p, {"distribution": p.groupBy("symbol", "prediction").agg(F.count(F.lit(1)).alias("n"))}, path)
    n_rows = rd.load_table(spark, f"{path}/predictions", "parquet").groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return rd.load_table(spark, f"{path}/distribution", "json").join(n_rows, "symbol")


register("evaluation_round_trip", "symbol prediction:d n n_rows", f"""
SELECT symbol, prediction, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY symbol) AS BIGINT) AS n_rows
FROM ({PRED_SQL}) p GROUP BY symbol, prediction""")(evaluation_round_trip)


def backtest_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK3: ledger, metric rows and report written, the ledger read back."""
    path = sk.scratch_path(spark, "backtest")
    led = ledger(spark, sf)
    sk.save_backtest(led, led.groupBy("symbol").agg(F.sum("pnl").alias("pnl")),
                     led.groupBy("symbol").agg(F.count(F.lit(1)).alias("n")), path)
    return rd.load_table(spark, f"{path}/ledger", "parquet")


register("backtest_round_trip", "symbol seq " + LEDGER_COLS, ledger_sql(SIGNALS_SRC))(backtest_round_trip)
