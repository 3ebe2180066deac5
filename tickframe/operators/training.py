"""Fit, choose and report (ML8): several candidates fitted on the train rows, all rows
scored in one pass each, the choice by a metric of the validation rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ModelConfig
from ..session import drop_table, scratch_table
from . import models as md
from .evaluation import evaluation_table


@dataclass(frozen=True)
class Candidate:
    """A model to try: its name in the report, its settings and its inputs."""
    name: str
    config: ModelConfig
    features: tuple[str, ...]


def fit_then_score(data: DataFrame, candidates: Sequence[Candidate], keep: Sequence[str] = (),
                   label: str = "label", split: str = "split",
                   n_classes: int = 3) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """The scored rows of every candidate, and the fitted models by name.

    Models learn from rows whose ``split`` is ``train``; each then scores the rows of all
    splits. Rows: ``model``, the columns ``keep``, ``split``, ``label``, ``prediction`` and
    the class probabilities. The features are computed once, and the scored rows are
    written, so that reports, signals and ledgers read them without fitting again."""
    names = [c.name for c in candidates]
    if len(set(names)) != len(names) or not names:
        raise ValueError(f"candidates need names of their own, got {names}")
    inputs = list(dict.fromkeys([*keep, *(f for c in candidates for f in c.features)]))
    frame = scratch_table(data.select(*inputs, split, label), "split-rows")
    fitted, scored = {}, None
    for c in candidates:
        fitted[c.name] = md.fit(frame.filter(F.col(split) == "train"), c.features, c.config, label, n_classes)
        out = md.predict(fitted[c.name], frame, n_classes)
        probs = [x for x in ("prob_down", "prob_flat", "prob_up") if x in out.columns]
        out = out.select(F.lit(c.name).alias("model"), *keep, split, label, "prediction", *probs)
        scored = out if scored is None else scored.unionByName(out)
    scored = scratch_table(scored, "scored-rows")
    drop_table(frame)
    return scored, fitted


def report_by_split(scored: DataFrame, split: str = "split", label: str = "label") -> DataFrame:
    """Every evaluation metric of every model and split (EV1-7), long form."""
    return evaluation_table(scored, "model", split, label=label)


def choose_model(report: DataFrame, metric: str = "macro_f1", on: str = "val", split: str = "split") -> DataFrame:
    """One row: the ``model`` with the largest ``metric`` on the rows ``on`` (ties: the
    first name), that ``value``, and the metric on every other split as ``other``. NULL
    values lose; no rows without the metric."""
    rows = report.filter((F.col("metric") == metric) & F.col("class").isNull()).groupBy("model").agg(
        F.max(F.when(F.col(split) == on, F.col("value"))).alias("value"),
        F.map_from_entries(F.array_sort(F.collect_list(F.when(
            F.col(split) != on, F.struct(split, "value"))))).alias("other"))
    best = Window.orderBy(F.col("value").desc_nulls_last(), "model")      # one row a model
    return rows.withColumn("_rank", F.row_number().over(best)).filter("_rank = 1").drop("_rank")


def rows_of_choice(scored: DataFrame, choice: DataFrame) -> DataFrame:
    """The scored rows of the chosen model; ``choice`` is one row."""
    return scored.join(F.broadcast(choice.select("model")), "model")
