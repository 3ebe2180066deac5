"""Catalogue part 3: evaluation tables and the dashboard aggregates (EV1-7, AGG19-22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LabelConfig
from ..operators import evaluation as ev
from ..operators import labels as lb
from ..operators import metrics as mx
from ..sources.book import load_book
from .catalog_features import MODEL_READY, features, model_feature_names
from .defaults import ORDERING
from .registry import register
from .sqltext import dlit, features_sql, label_sql


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed predictions for the evaluation tables: the true label, shifted by
    one class on every fifth sequence number; probabilities from the book."""
    b = lb.drop_unlabelled(lb.add_labels(load_book(spark, sf), LabelConfig(), ORDERING))
    return b.withColumns({
        "prediction": F.when(F.col("seq") % 5 == 0, (F.col("label") + 1) % 3).otherwise(F.col("label")),
        "prob_flat": F.greatest(F.lit(0.0), F.lit(1.0) - F.col("prob_up") - F.col("prob_down")),
    })


PRED_SQL = f"""SELECT *, CASE WHEN seq % 5 = 0 THEN (label + 1) % 3 ELSE label END AS prediction,
       greatest({dlit(0.0)}, {dlit(1.0)} - prob_up - prob_down) AS prob_flat
FROM (SELECT *, {label_sql()} AS label FROM book) l WHERE label IS NOT NULL"""

register("eval_accuracy", "symbol accuracy:d n", f"""
SELECT symbol, avg(CASE WHEN prediction = label THEN {dlit(1.0)} ELSE {dlit(0.0)} END) AS accuracy,
       count(*) AS n FROM ({PRED_SQL}) p GROUP BY symbol""")(
    lambda spark, sf: ev.accuracy(predictions(spark, sf), "symbol"))

_CM = f"""WITH p AS ({PRED_SQL}),
c AS (SELECT symbol, label AS true_label, prediction AS predicted, count(*) AS n FROM p GROUP BY 1, 2, 3),
k AS (SELECT DISTINCT symbol, true_label AS cls FROM c UNION SELECT DISTINCT symbol, predicted FROM c),
g AS (SELECT a.symbol, a.cls AS true_label, b.cls AS predicted FROM k a JOIN k b ON a.symbol = b.symbol)
SELECT g.symbol, g.true_label, g.predicted, COALESCE(c.n, 0) AS n
FROM g LEFT JOIN c ON c.symbol = g.symbol AND c.true_label = g.true_label AND c.predicted = g.predicted"""
register("eval_confusion", "symbol true_label predicted n", _CM)(
    lambda spark, sf: ev.confusion_matrix(predictions(spark, sf), "symbol"))

register("eval_report", "symbol class precision:d recall:d f1_score:d support", f"""
WITH cm AS ({_CM}),
per AS (SELECT t.symbol, t.c, t.tp, t.support, p.pred_n FROM
  (SELECT symbol, true_label AS c, sum(CASE WHEN predicted = true_label THEN n END) AS tp,
          sum(n) AS support FROM cm GROUP BY 1, 2) t
  JOIN (SELECT symbol, predicted AS c, sum(n) AS pred_n FROM cm GROUP BY 1, 2) p
  ON t.symbol = p.symbol AND t.c = p.c),
pr AS (SELECT *, CASE WHEN pred_n > 0 THEN tp / pred_n ELSE {dlit(0.0)} END AS precision,
              CASE WHEN support > 0 THEN tp / support ELSE {dlit(0.0)} END AS recall FROM per),
f AS (SELECT *, CASE WHEN precision + recall > 0 THEN {dlit(2.0)} * precision * recall / (precision + recall)
                     ELSE {dlit(0.0)} END AS f1_score FROM pr)
SELECT symbol, CAST(c AS VARCHAR) AS class, precision, recall, f1_score, CAST(support AS BIGINT) AS support FROM f
UNION ALL
SELECT symbol, 'accuracy', NULL, NULL, sum(COALESCE(tp, 0)) / sum(support), CAST(sum(support) AS BIGINT) FROM f GROUP BY symbol
UNION ALL
SELECT symbol, 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM f GROUP BY symbol
UNION ALL
SELECT symbol, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
       sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM f GROUP BY symbol""")(
    lambda spark, sf: ev.classification_report(predictions(spark, sf), "symbol"))

register("eval_hit_rates", "symbol class hit_rate:d", f"""
SELECT symbol, label AS class, avg(CASE WHEN prediction = label THEN {dlit(1.0)} ELSE {dlit(0.0)} END) AS hit_rate
FROM ({PRED_SQL}) p GROUP BY 1, 2""")(
    lambda spark, sf: ev.hit_rates(predictions(spark, sf), "symbol"))

_MAXP = "greatest(prob_down, prob_flat, prob_up)"
register("eval_confidence", "symbol avg_confidence:d confidence_std:d avg_confidence_correct:d "
         "avg_confidence_incorrect:d", f"""
SELECT symbol, avg({_MAXP}) AS avg_confidence, stddev_pop({_MAXP}) AS confidence_std,
       avg({_MAXP}) FILTER (WHERE prediction = label) AS avg_confidence_correct,
       avg({_MAXP}) FILTER (WHERE prediction <> label) AS avg_confidence_incorrect
FROM ({PRED_SQL}) p GROUP BY symbol""")(
    lambda spark, sf: ev.confidence_stats(predictions(spark, sf), "symbol"))

_PC = "CASE label WHEN 0 THEN prob_down WHEN 1 THEN prob_flat WHEN 2 THEN prob_up END"
register("eval_class_prob", "symbol class avg_prob:d std_prob:d", f"""
SELECT symbol, label AS class, avg({_PC}) AS avg_prob, stddev_pop({_PC}) AS std_prob
FROM ({PRED_SQL}) p GROUP BY 1, 2""")(
    lambda spark, sf: ev.class_probability_stats(predictions(spark, sf), "symbol"))

register("eval_pred_dist", "symbol class n", f"""
WITH p AS ({PRED_SQL}),
c AS (SELECT symbol, prediction AS class, count(*) AS n FROM p GROUP BY 1, 2),
g AS (SELECT symbol, unnest(generate_series(0, max(class))) AS class FROM c GROUP BY symbol)
SELECT g.symbol, CAST(g.class AS INTEGER) AS class, COALESCE(c.n, 0) AS n
FROM g LEFT JOIN c ON c.symbol = g.symbol AND c.class = g.class""")(
    lambda spark, sf: ev.prediction_distribution(predictions(spark, sf), "symbol"))

register("prediction_summary", "symbol prediction n mean_prob_up:d mean_prob_down:d mean_prob_flat:d", f"""
SELECT symbol, prediction, count(*) AS n, avg(prob_up) AS mean_prob_up, avg(prob_down) AS mean_prob_down,
       avg(prob_flat) AS mean_prob_flat FROM ({PRED_SQL}) p GROUP BY 1, 2""")(
    lambda spark, sf: mx.prediction_summary(predictions(spark, sf), "symbol"))

# ---------------------------------------------------------------- dashboard aggregates

DESCRIBED = ["mid_price", "spread", "imbalance", *model_feature_names()]


def _corr_sql() -> str:
    names = ", ".join(f"'{c}'" for c in DESCRIBED)
    values = ", ".join(f"CAST({c} AS DOUBLE)" for c in DESCRIBED)
    return f"""WITH feat AS ({features_sql(MODEL_READY)}),
l AS (SELECT symbol, seq, unnest([{names}]) AS f, unnest(range({len(DESCRIBED)})) AS i, unnest([{values}]) AS v FROM feat)
SELECT a.f AS feature_a, b.f AS feature_b,
       CASE WHEN min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN corr(a.v, b.v) END AS corr
FROM l a JOIN l b ON a.symbol = b.symbol AND a.seq = b.seq AND a.i <= b.i AND a.v IS NOT NULL AND b.v IS NOT NULL
GROUP BY a.f, b.f"""


register("feature_correlation", "feature_a feature_b corr:d", _corr_sql())(
    lambda spark, sf: mx.feature_correlation(features(spark, sf, MODEL_READY), DESCRIBED))


def _describe_sql() -> str:
    rows = "\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
        f"min({c}) AS min, max({c}) AS max, quantile_cont({c}, 0.25) AS p25, "
        f"quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75 FROM feat"
        for c in DESCRIBED)
    return f"WITH feat AS ({features_sql(MODEL_READY)})\n{rows}"


register("describe_features", "feature count mean:d std:d min:d max:d p25:d p50:d p75:d",
         _describe_sql())(
    lambda spark, sf: mx.describe_features(features(spark, sf, MODEL_READY), DESCRIBED))

BOOK_N_COLUMNS = 3 + 20 + 2 + 3
register("data_overview", "symbol n_rows n_columns start_ts end_ts", f"""
SELECT symbol, count(*) AS n_rows, {BOOK_N_COLUMNS} AS n_columns, min(ts) AS start_ts, max(ts) AS end_ts
FROM book GROUP BY symbol""")(
    lambda spark, sf: mx.data_overview(load_book(spark, sf), "symbol"))
