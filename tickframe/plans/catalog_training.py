"""Catalogue part 6: fit on train, choose on val, report by split, then trade the choice.

The candidates are Gaussian naive Bayes models over two sets of features, registered as an
estimator of one's own: their fit has a closed form, so the SQL twins fit them anew."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.classification import NaiveBayes
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import LabelConfig, ModelConfig, SignalConfig
from ..operators import labels as lb
from ..operators import ledger as led
from ..operators import models as md
from ..operators import signals as sg
from ..operators import timeseries as tsx
from ..operators import training as tr
from .catalog_backtest import EXE, LEDGER_COLS, SIG_T, ledger_sql
from .catalog_features import COMPLETE, MODEL_READY
from .catalog_models import ROW, complete_rows, slim_rows, with_marks
from .defaults import ORDERING
from .registry import register
from .sqltext import W, dlit, features_sql, label_sql


def gaussian_bayes(cfg: ModelConfig, n_classes: int, label: str, weight: str | None) -> NaiveBayes:
    nb = NaiveBayes(modelType="gaussian", labelCol=label)
    return nb.setWeightCol(weight) if weight else nb


md.register_estimator("gaussian_bayes", gaussian_bayes)

BAYES = ModelConfig("gaussian_bayes")
CANDIDATES = (
    tr.Candidate("bayes_book", BAYES, ("imbalance", "weighted_imbalance", "microprice_deviation")),
    tr.Candidate("bayes_returns", BAYES, ("return_backward_1", "return_backward_5", "volatility_20", "spread")),
)
KEEP = ("symbol", "ts", "seq", "mid_price")


def split_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Complete, labelled feature rows with train, val and test by position: the columns
    that the candidates read and those kept."""
    f, _ = complete_rows(spark, sf, [*KEEP, *(x for c in CANDIDATES for x in c.features)])
    marks = lb.drop_unlabelled(lb.add_labels(slim_rows(f), LabelConfig(), ORDERING))
    return with_marks(f, tsx.time_split(marks, 0.2, 0.2, ORDERING).select(ROW, "label", "pos", "split"))


def scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    return tr.fit_then_score(split_rows(spark, sf), CANDIDATES, KEEP)[0]


# ---------------------------------------------------------------- SQL: the same fit in closed form

_CUT = f"floor(CAST(n_ AS DOUBLE) * {dlit(0.2)})"
_ROWS = f"""feat AS ({features_sql(MODEL_READY)}),
f AS (SELECT * FROM feat WHERE {COMPLETE}),
l AS (SELECT *, {label_sql()} AS label FROM f),
p AS (SELECT *, row_number() OVER ({W}) - 1 AS pos_, count(*) OVER (PARTITION BY symbol) AS n_ FROM l WHERE label IS NOT NULL),
s AS (SELECT *, CASE WHEN pos_ < n_ - {_CUT} - {_CUT} THEN 'train' WHEN pos_ < n_ - {_CUT} THEN 'val' ELSE 'test' END AS split FROM p)"""


def _bayes_sql(c: tr.Candidate) -> str:
    """CTEs up to ``<name>``: rows scored by a Gaussian naive Bayes model of equal class
    priors over standardised features."""
    n, cols = c.name, c.features
    j = list(enumerate(cols))
    like = " + ".join(f"ln(v{i}) + (z{i} - m{i}) * (z{i} - m{i}) / v{i}" for i, _ in j)
    return f"""
{n}_z AS (SELECT s.*, {", ".join(f"({x} - (SELECT avg({x}) FROM s WHERE split = 'train')) / (SELECT stddev_samp({x}) FROM s WHERE split = 'train') AS z{i}" for i, x in j)} FROM s),
{n}_c AS (SELECT label AS c, {", ".join(f"avg(z{i}) AS m{i}, var_pop(z{i}) AS w{i}" for i, _ in j)} FROM {n}_z WHERE split = 'train' GROUP BY label),
{n}_e AS (SELECT greatest({", ".join(f"avg(w{i} + m{i} * m{i}) - avg(m{i}) * avg(m{i})" for i, _ in j)}) * {dlit(1e-9)} AS eps FROM {n}_c),
{n}_m AS (SELECT c, {", ".join(f"m{i}, w{i} + eps AS v{i}" for i, _ in j)} FROM {n}_c, {n}_e),
{n}_l AS (SELECT symbol, ts, seq, mid_price, split, label, c, {dlit(-0.5)} * ({like}) AS ll FROM {n}_z, {n}_m),
{n}_p AS (SELECT *, exp(ll - max(ll) OVER (PARTITION BY symbol, seq)) AS e FROM {n}_l),
{n} AS (SELECT '{n}' AS model, symbol, any_value(ts) AS ts, seq, any_value(mid_price) AS mid_price, any_value(split) AS split,
  any_value(label) AS label, arg_max(c, e) AS prediction, sum(CASE WHEN c = 0 THEN e ELSE 0 END) / sum(e) AS prob_down,
  sum(CASE WHEN c = 1 THEN e ELSE 0 END) / sum(e) AS prob_flat, sum(CASE WHEN c = 2 THEN e ELSE 0 END) / sum(e) AS prob_up
  FROM {n}_p GROUP BY symbol, seq)"""


_SCORED = (f"WITH {_ROWS}," + ",".join(_bayes_sql(c) for c in CANDIDATES) + ",\nscored AS ("
           + " UNION ALL ".join(f"SELECT * FROM {c.name}" for c in CANDIDATES) + ")")

_OWN = "CASE label WHEN 0 THEN prob_down WHEN 1 THEN prob_flat WHEN 2 THEN prob_up END"
_MAX = "greatest(prob_down, prob_flat, prob_up)"
_BY = "model, split"
_TABLE = f"""{_SCORED},
cls AS (SELECT {_BY}, label AS c FROM scored UNION SELECT {_BY}, prediction FROM scored),
per AS (SELECT cls.*, count(*) FILTER (label = c) AS support, count(*) FILTER (prediction = c) AS predicted_n,
               count(*) FILTER (label = c AND prediction = c) AS tp
        FROM cls JOIN scored USING (model, split) GROUP BY ALL),
pr AS (SELECT *, CASE WHEN predicted_n > 0 THEN tp / predicted_n ELSE 0 END AS pre, CASE WHEN support > 0 THEN tp / support ELSE 0 END AS rec FROM per),
f1 AS (SELECT *, CASE WHEN pre + rec > 0 THEN 2 * pre * rec / (pre + rec) ELSE 0 END AS f FROM pr),
one AS (SELECT {_BY}, count(*)::DOUBLE AS n, avg((prediction = label)::INT) AS accuracy, avg({_MAX}) AS avg_confidence,
               stddev_pop({_MAX}) AS confidence_std, avg({_MAX}) FILTER (prediction = label) AS avg_confidence_correct,
               avg({_MAX}) FILTER (prediction <> label) AS avg_confidence_incorrect FROM scored GROUP BY ALL),
avgs AS (SELECT {_BY}, avg(pre) AS macro_precision, avg(rec) AS macro_recall, avg(f) AS macro_f1,
                sum(pre * support) / sum(support) AS weighted_precision, sum(rec * support) / sum(support) AS weighted_recall,
                sum(f * support) / sum(support) AS weighted_f1 FROM f1 GROUP BY ALL),
report AS (
  SELECT {_BY}, metric, NULL::INT AS class, NULL::INT AS predicted, value FROM one
    UNPIVOT INCLUDE NULLS (value FOR metric IN (n, accuracy, avg_confidence, confidence_std, avg_confidence_correct, avg_confidence_incorrect))
  UNION ALL SELECT {_BY}, metric, NULL, NULL, value FROM avgs
    UNPIVOT INCLUDE NULLS (value FOR metric IN (macro_precision, macro_recall, macro_f1, weighted_precision, weighted_recall, weighted_f1))
  UNION ALL SELECT {_BY}, 'precision', c, NULL, pre FROM f1
  UNION ALL SELECT {_BY}, 'recall', c, NULL, rec FROM f1
  UNION ALL SELECT {_BY}, 'f1', c, NULL, f FROM f1
  UNION ALL SELECT {_BY}, 'support', c, NULL, support FROM f1
  UNION ALL SELECT {_BY}, 'hit_rate', c, NULL, rec FROM f1 WHERE support > 0
  UNION ALL SELECT {_BY}, 'avg_prob', label, NULL, avg({_OWN}) FROM scored GROUP BY ALL
  UNION ALL SELECT {_BY}, 'std_prob', label, NULL, stddev_pop({_OWN}) FROM scored GROUP BY ALL
  UNION ALL SELECT g.model, g.split, 'predicted_n', CAST(g.c AS INT), NULL, coalesce(per.predicted_n, 0)
    FROM (SELECT {_BY}, unnest(range(0, max(prediction) + 1)) AS c FROM scored GROUP BY {_BY}) g
    LEFT JOIN per ON g.model = per.model AND g.split = per.split AND g.c = per.c
  UNION ALL SELECT a.model, a.split, 'confusion', a.c, b.c,
    (SELECT count(*) FROM scored x WHERE x.model = a.model AND x.split = a.split AND x.label = a.c AND x.prediction = b.c)
    FROM cls a JOIN cls b ON a.model = b.model AND a.split = b.split),
choice AS (SELECT model, max(value) FILTER (split = 'val') AS val_f1, max(value) FILTER (split = 'test') AS test_f1
           FROM report WHERE metric = 'macro_f1' GROUP BY model ORDER BY val_f1 DESC, model LIMIT 1)"""

register("eval_by_split", "model split metric class predicted value:d", f"{_TABLE}\nSELECT * FROM report")(
    lambda spark, sf: tr.report_by_split(scored_rows(spark, sf)))

register("model_choice", "model val_f1:d test_f1:d", f"{_TABLE}\nSELECT * FROM choice")(
    lambda spark, sf: tr.choose_model(tr.report_by_split(scored_rows(spark, sf))).select(
        "model", F.col("value").alias("val_f1"), F.col("other")["test"].alias("test_f1")))


def chosen_test_rows(spark: SparkSession, sf: str) -> DataFrame:
    scored = scored_rows(spark, sf)
    return tr.rows_of_choice(scored, tr.choose_model(tr.report_by_split(scored))).filter("split = 'test'")


def _fitted_signals(spark: SparkSession, sf: str) -> DataFrame:
    return sg.generate_signals(chosen_test_rows(spark, sf), SignalConfig(), "symbol")


def _fitted_ledger(spark: SparkSession, sf: str) -> DataFrame:
    return led.execute_trades(_fitted_signals(spark, sf), EXE, replace(ORDERING, chunk_rows=400))


_CHOSEN = f"""{_TABLE}
SELECT *, {SIG_T} AS signal FROM scored WHERE split = 'test' AND model = (SELECT model FROM choice)"""
register("fitted_ledger", "symbol seq model prediction signal " + LEDGER_COLS, ledger_sql(_CHOSEN))(_fitted_ledger)


def _fitted_summary(spark: SparkSession, sf: str) -> DataFrame:
    """From fitted probabilities to the list of trades and its summary."""
    return led.trade_summary(led.trades(_fitted_ledger(spark, sf), "symbol"), "symbol")


register("fitted_trade_summary", "symbol total_trades total_volume:d total_cost:d avg_trade_size:d max_position:d total_pnl:d", f"""
SELECT symbol, count(*) AS total_trades, sum(abs(trade_size)) AS total_volume, sum(total_cost) AS total_cost,
       avg(abs(trade_size)) AS avg_trade_size, max(abs(position)) AS max_position, sum(pnl) AS total_pnl
FROM ({ledger_sql(_CHOSEN)}) t WHERE executed GROUP BY symbol""")(_fitted_summary)
