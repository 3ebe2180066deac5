"""Classifiers with pyspark.ml (ML1-9, PRJ19, TOP1 input).

Training is distributed by pyspark.ml itself (treeAggregate per iteration,
per-node statistics for trees); the assembled training frame is persisted so
iterations do not recompute the feature windows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, OneVsRest,
                                       RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ModelConfig
from ..session import scratch_table as materialize

#: EXT3: own estimators by name, ``make(cfg, n_classes, label, weight) -> estimator``
#: with a probability or raw prediction column.
_ESTIMATORS: dict = {}


def register_estimator(name: str, make) -> None:
    _ESTIMATORS[name] = make


# Model names the reference's factory accepts.
MODEL_TYPES = ("logistic_regression", "random_forest", "lightgbm", "lstm", "transformer")


def _weight_col(df: DataFrame, label: str, weight: str | None) -> tuple[DataFrame, str | None]:
    if weight is None or weight in df.columns:
        return df, weight
    from .labels import with_class_weight
    return with_class_weight(df, label, weight), weight


#: Rows of a task of boosting, at least.
BOOST_ROWS = 32_768


def fewer_tasks(df: DataFrame, rows: int) -> DataFrame:
    """``df`` dealt evenly over partitions of about ``rows`` rows, if it has more partitions
    than that makes; never over more of them than before."""
    n = max(1, math.ceil(df.count() / rows))
    return df.repartition(n) if n < df.rdd.getNumPartitions() else df


def storage_bytes(spark) -> int:
    """What the executors may keep in memory together."""
    sc = spark.sparkContext._jsc.sc()
    driver = sc.env().blockManager().blockManagerId().hostPort()
    each, found = sc.getExecutorMemoryStatus().iterator(), {}
    while each.hasNext():
        entry = each.next()
        found[entry._1()] = entry._2()._1()
    if len(found) > 1:
        found.pop(driver, None)
    return sum(found.values())


def classes_at_once(rows: int, n_features: int, n_classes: int, memory: int) -> int:
    """How many of the one-vs-rest models are grown at a time: each keeps its own binned rows
    (4 bytes a feature, some 160 for the objects of a row), and every level of a tree reads
    them all. Models that do not fit beside each other drive each other's rows to disk, and
    errors that are kept in memory only are worked out anew from all trees so far."""
    return max(1, min(n_classes, memory // max(1, rows * (4 * n_features + 160))))


def build_pipeline(features: Sequence[str], cfg: ModelConfig = ModelConfig(), n_classes: int = 3,
                   label: str = "label", weight: str | None = "weight") -> Pipeline:
    """ML1 + ML2-5 + ML7: assembler -> standardiser -> classifier."""
    p = dict(cfg.params)
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw", handleInvalid="error"),
              StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)]
    t = cfg.model_type
    if t == "logistic_regression":
        clf = LogisticRegression(family="multinomial", maxIter=p.get("max_iter", 1000),
                                 regParam=p.get("reg_param", 0.0), elasticNetParam=0.0,
                                 standardization=False, labelCol=label)
        if weight:
            clf.setWeightCol(weight)
    elif t == "random_forest":
        clf = RandomForestClassifier(numTrees=p.get("n_estimators", 100), maxDepth=p.get("max_depth", 10),
                                     minInstancesPerNode=p.get("min_samples_leaf", 2),
                                     featureSubsetStrategy="sqrt", seed=cfg.seed, labelCol=label)
        if weight:
            clf.setWeightCol(weight)
    elif t == "lightgbm":
        gbt = GBTClassifier(maxIter=p.get("n_estimators", 100), maxDepth=p.get("max_depth", 6),
                            stepSize=p.get("learning_rate", 0.1), subsamplingRate=0.8,
                            featureSubsetStrategy="0.8", seed=cfg.seed)
        clf = OneVsRest(classifier=gbt, labelCol=label, parallelism=p.get("parallelism", n_classes))
        if weight:
            clf.setWeightCol(weight)
    elif t in ("lstm", "transformer"):
        # re-aimed: a dense network over the flattened previous-L window
        n_in = p.get("n_inputs", len(features))
        clf = MultilayerPerceptronClassifier(layers=[n_in, p.get("hidden", 64), n_classes],
                                             maxIter=p.get("max_iter", 100), seed=cfg.seed,
                                             labelCol=label)
    elif t in _ESTIMATORS:
        clf = _ESTIMATORS[t](cfg, n_classes, label, weight)
    else:
        raise ValueError(f"no estimator is called {t!r}; known: {[*MODEL_TYPES, *sorted(_ESTIMATORS)]}")
    return Pipeline(stages=[*stages, clf])


def fit(train: DataFrame, features: Sequence[str], cfg: ModelConfig = ModelConfig(),
        label: str = "label", n_classes: int = 3, written: bool = False) -> PipelineModel:
    """ML8 (fit half): balanced class weights (LBL3) as ``weightCol``. ``written``: the rows
    are those of a written table, which is not written again."""
    use_w = cfg.model_type not in ("lstm", "transformer")
    df, w = _weight_col(train, label, "weight" if use_w else None)
    # cut the long feature lineage once: every training pass then reads the
    # checkpointed rows (in the shared checkpoint folder) instead of
    # re-planning and re-running the window stages
    df = df.select(*features, F.col(label).cast("double").alias(label), *([w] if w else []))
    if not written:
        df = materialize(df, "train")
    if cfg.model_type == "lightgbm":
        # a level of a tree is a job, and one model a class is grown at a time: small tasks
        # would cost more than their rows, and each of them shuffles the bins of all nodes
        at_once = classes_at_once(df.count(), len(features), n_classes, storage_bytes(df.sparkSession))
        df = fewer_tasks(df, BOOST_ROWS)
        cfg = ModelConfig(cfg.model_type, {"parallelism": at_once, **cfg.params}, cfg.seed)
    if cfg.model_type == "logistic_regression" and "reg_param" not in cfg.params:
        # the reference's C=1 penalty on a summed loss equals regParam = 1 / (C * sum(w))
        # on Spark's averaged loss; sum(w) is one aggregate
        tot = df.agg(F.sum(F.col(w)) if w else F.count(F.lit(1))).first()[0]
        c = float(cfg.params.get("C", 1.0))
        cfg = ModelConfig(cfg.model_type, {**cfg.params, "reg_param": 1.0 / (c * float(tot))},
                          cfg.seed)
    return build_pipeline(features, cfg, n_classes, label, w).fit(df)


def _ovr_probabilities(raw: str, n: int):
    """Binary GBT margins -> p_c proportional to 1 / (1 + exp(-2 raw_c))."""
    arr = vector_to_array(F.col(raw))
    ps = [F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * arr[i])) for i in range(n)]
    tot = ps[0]
    for p in ps[1:]:
        tot = tot + p
    return F.array(*[p / tot for p in ps])


def predict(model: PipelineModel, df: DataFrame, n_classes: int = 3) -> DataFrame:
    """ML8 (score half) + PRJ19: prediction and prob_down / prob_flat / prob_up."""
    out = model.transform(df)
    if "probability" in out.columns:
        probs = vector_to_array("probability")
    else:
        probs = _ovr_probabilities("rawPrediction", n_classes)
    out = out.withColumn("_p", probs)
    cols = {"prediction": F.col("prediction").cast("int")}
    if n_classes == 3:
        cols.update({"prob_down": F.col("_p")[0], "prob_flat": F.col("_p")[1], "prob_up": F.col("_p")[2]})
    else:
        cols.update({"prob_down": F.col("_p")[0], "prob_up": F.col("_p")[1]})
    drop = [c for c in ("_p", "_raw", "features", "rawPrediction", "probability") if c in out.columns]
    return out.withColumns(cols).drop(*drop)


def feature_importance(model: PipelineModel, features: Sequence[str]) -> list[tuple[str, float]]:
    """ML6: name -> importance (mean over the one-vs-rest models for boosting)."""
    clf = model.stages[-1]
    if hasattr(clf, "featureImportances"):
        imp = clf.featureImportances.toArray()
    elif hasattr(clf, "models"):
        arrs = [m.featureImportances.toArray() for m in clf.models]
        imp = sum(arrs) / len(arrs)
    else:
        raise ValueError("model has no feature importances")
    return list(zip(features, [float(x) for x in imp]))


def flatten_window(df: DataFrame, window: str, features: Sequence[str], out: str = "_flat") -> DataFrame:
    """ML5 input: array<struct> of the previous L rows -> one flat vector column."""
    flat = F.flatten(F.transform(window, lambda s: F.array(*[s[c].cast("double") for c in features])))
    return df.withColumn(out, array_to_vector(flat))


def save_model(model: PipelineModel, path: str) -> None:
    """ML9."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
