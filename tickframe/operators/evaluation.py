"""Classification evaluation as aggregates (EV1-7).

Every table comes from one small per-(label, prediction) count table (EV2),
so the data is scanned once; nothing per row reaches the driver. Class sets
are bounded by the number of classes, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROB_COLUMNS = ("prob_down", "prob_flat", "prob_up")   # class 0, 1, 2


def accuracy(df: DataFrame, *keys: str, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EV1: share of rows whose prediction equals the label."""
    return df.groupBy(*keys).agg(
        F.avg(F.when(F.col(pred) == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def confusion_matrix(df: DataFrame, *keys: str, label: str = "label",
                     pred: str = "prediction") -> DataFrame:
    """EV2: counts true x predicted over the union of seen classes, zeros filled."""
    counts = df.groupBy(*keys, F.col(label).alias("true_label"),
                        F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    classes = counts.groupBy(*keys).agg(F.array_union(
        F.collect_set("true_label"), F.collect_set("predicted")).alias("_cls"))
    grid = (classes.withColumn("true_label", F.explode("_cls"))
            .withColumn("predicted", F.explode("_cls")).drop("_cls"))
    return (grid.join(counts, [*keys, "true_label", "predicted"], "left")
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")))


def classification_report(df: DataFrame, *keys: str, label: str = "label",
                          pred: str = "prediction") -> DataFrame:
    """EV3: per class precision, recall, f1, support; accuracy; macro and weighted averages.

    Undefined ratios are 0 (scikit-learn's zero_division behaviour with its
    warning). Long form ``(class, precision, recall, f1_score, support)``.
    """
    cm = confusion_matrix(df, *keys, label=label, pred=pred)
    per = cm.groupBy(*keys, F.col("true_label").alias("c")).agg(
        F.sum(F.when(F.col("predicted") == F.col("true_label"), F.col("n"))).alias("tp"),
        F.sum("n").alias("support"))
    pred_tot = cm.groupBy(*keys, F.col("predicted").alias("c")).agg(F.sum("n").alias("pred_n"))
    per = per.join(pred_tot, [*keys, "c"])
    prec = F.when(F.col("pred_n") > 0, F.col("tp") / F.col("pred_n")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumns({"precision": prec, "recall": rec})
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall")
                / (F.col("precision") + F.col("recall"))).otherwise(F.lit(0.0))
    per = per.withColumn("f1_score", f1)
    # only classes that occur as true labels contribute support; predicted-only
    # classes still enter the macro average (scikit-learn uses the label union)
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    per = per.withColumns({"_N": F.sum("support").over(wk), "_K": F.count(F.lit(1)).over(wk),
                           "_tp_all": F.sum("tp").over(wk)})
    classes = per.select(*keys, F.col("c").cast("string").alias("class"), "precision", "recall",
                         "f1_score", F.col("support").cast("bigint").alias("support"))
    agg = per.groupBy(*keys).agg(
        F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1_score").alias("mf"),
        (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
        (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
        (F.sum(F.col("f1_score") * F.col("support")) / F.sum("support")).alias("wf"),
        F.sum("support").alias("N"), F.sum(F.coalesce(F.col("tp"), F.lit(0))).alias("TP"))
    summary = agg.select(*keys, F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 (F.col("TP") / F.col("N")).alias("f1_score"), F.col("N").cast("bigint").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"),
                 F.col("mr").alias("recall"), F.col("mf").alias("f1_score"),
                 F.col("N").cast("bigint").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1_score"),
                 F.col("N").cast("bigint").alias("support")),
    )).alias("_s")).select(*keys, "_s.*")
    return classes.unionByName(summary)


def hit_rates(df: DataFrame, *keys: str, label: str = "label", pred: str = "prediction") -> DataFrame:
    """EV4: for each true class c, the share predicted c (the recall)."""
    return df.groupBy(*keys, F.col(label).alias("class")).agg(
        F.avg(F.when(F.col(pred) == F.col(label), F.lit(1.0)).otherwise(F.lit(0.0))).alias("hit_rate"))


def max_probability(cols=PROB_COLUMNS):
    return F.greatest(*[F.col(c) for c in cols])


def confidence_stats(df: DataFrame, *keys: str, label: str = "label", pred: str = "prediction",
                     cols=PROB_COLUMNS) -> DataFrame:
    """EV5: mean and population std of the max probability; mean when right / wrong."""
    mp = max_probability(cols)
    ok = F.col(pred) == F.col(label)
    return df.groupBy(*keys).agg(
        F.avg(mp).alias("avg_confidence"), F.stddev_pop(mp).alias("confidence_std"),
        F.avg(F.when(ok, mp)).alias("avg_confidence_correct"),
        F.avg(F.when(~ok, mp)).alias("avg_confidence_incorrect"))


def class_probability_stats(df: DataFrame, *keys: str, label: str = "label",
                            cols=PROB_COLUMNS) -> DataFrame:
    """EV6: for each true class c, mean and population std of P(c)."""
    p = F.element_at(F.array(*[F.col(c) for c in cols]), F.col(label) + 1)
    return df.groupBy(*keys, F.col(label).alias("class")).agg(
        F.avg(p).alias("avg_prob"), F.stddev_pop(p).alias("std_prob"))


def prediction_distribution(df: DataFrame, *keys: str, pred: str = "prediction") -> DataFrame:
    """EV7: counts for classes 0..max(prediction), zeros kept."""
    counts = df.groupBy(*keys, F.col(pred).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    top = counts.groupBy(*keys).agg(F.max("class").alias("_m"))
    grid = top.select(*keys, F.explode(F.sequence(F.lit(0), F.col("_m"))).alias("class"))
    return (grid.join(counts, [*keys, "class"], "left")
            .withColumn("n", F.coalesce(F.col("n"), F.lit(0)).cast("bigint")))


def evaluation_table(df: DataFrame, *keys: str, label: str = "label", pred: str = "prediction",
                     cols=PROB_COLUMNS) -> DataFrame:
    """EV1-7 in one pass over the rows: ``keys, metric, class, predicted, value``.

    Rows are counted per (label, prediction) with mean and variance of the likeliest
    class's and the true class's probability; everything else follows from those few
    cells, whose variances are merged about their common mean. Metrics without a class have
    a NULL ``class``; only ``confusion`` has ``predicted``. Rows without a label are
    left out. The single tables above give the same values.
    """
    n, k = F.col("n"), list(keys)
    own = F.element_at(F.array(*[F.col(c) for c in cols]), F.col(label).cast("int") + 1)
    cells = df.filter(F.col(label).isNotNull()).groupBy(
        *k, F.col(label).cast("int").alias("t"), F.col(pred).cast("int").alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(max_probability(cols)).alias("cm"),
        F.var_pop(max_probability(cols)).alias("cv"), F.avg(own).alias("qm"), F.var_pop(own).alias("qv"))
    all_, of_t = Window.partitionBy(*k), Window.partitionBy(*k, "t")
    hit = F.col("t") == F.col("p")
    cells = cells.withColumns({
        "top": F.max("p").over(all_), "c0": F.sum(n * F.col("cm")).over(all_) / F.sum(n).over(all_),
        "q0": F.sum(n * F.col("qm")).over(of_t) / F.sum(n).over(of_t)})
    whole = cells.groupBy(*k).agg(
        F.sum(n).alias("N"), (F.sum(F.when(hit, n).otherwise(0)) / F.sum(n)).alias("accuracy"),
        F.max("c0").alias("avg_confidence"),
        F.sqrt(F.sum(n * (F.col("cv") + (F.col("cm") - F.col("c0")) ** 2)) / F.sum(n)).alias("confidence_std"),
        (F.sum(F.when(hit, n * F.col("cm"))) / F.sum(F.when(hit, n))).alias("avg_confidence_correct"),
        (F.sum(F.when(~hit, n * F.col("cm"))) / F.sum(F.when(~hit, n))).alias("avg_confidence_incorrect"))

    def part(c, support, tp, predicted, spread):
        return F.struct(c.alias("c"), support.alias("support"), tp.alias("tp"), predicted.alias("predicted_n"),
                        spread.alias("spread"), F.when(support > 0, F.col("q0")).alias("q0"))

    zero, none = F.lit(0).cast("bigint"), F.lit(0.0)
    seen = cells.select(*k, "top", F.explode(F.concat(
        F.array(part(F.col("t"), n, F.when(hit, n).otherwise(zero), zero,
                     n * (F.col("qv") + (F.col("qm") - F.col("q0")) ** 2)),
                part(F.col("p"), zero, zero, n, none)),
        # every class up to the largest predicted is counted
        F.transform(F.sequence(F.lit(0), F.greatest("top", F.lit(0))), lambda c: part(c, zero, zero, zero, none)),
    )).alias("x")).select(*k, "top", "x.*")
    per = seen.groupBy(*k, "c").agg(F.max("top").alias("top"), F.max("q0").alias("avg_prob"), *[
        F.sum(x).alias(x) for x in ("support", "tp", "predicted_n", "spread")])
    per = per.withColumns({
        "precision": F.coalesce(F.try_divide("tp", "predicted_n"), none),
        "recall": F.coalesce(F.try_divide("tp", "support"), none)})
    per = per.withColumns({
        "f1": F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), none),
        "hit_rate": F.try_divide("tp", "support"), "std_prob": F.sqrt(F.try_divide("spread", "support"))})
    known = (F.col("support") > 0) | (F.col("predicted_n") > 0)
    scores = ("precision", "recall", "f1")
    means = per.filter(known).groupBy(*k).agg(
        *[F.avg(x).alias(f"macro_{x}") for x in scores],
        *[(F.sum(F.col(x) * F.col("support")) / F.sum("support")).alias(f"weighted_{x}") for x in scores])

    def long(rows: DataFrame, names, c=None) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                                    for m in names])).alias("m")
        return rows.select(*k, (F.lit(None).cast("int") if c is None else F.col(c)).alias("class"), pairs).select(
            *k, "m.metric", "class", F.lit(None).cast("int").alias("predicted"), "m.value")

    classes = F.array_union(F.collect_set("t"), F.collect_set("p"))
    grid = cells.groupBy(*k).agg(classes.alias("cs"), F.map_from_entries(F.collect_list(
        F.struct(F.struct("t", "p"), "n"))).alias("counts"))
    grid = grid.withColumn("class", F.explode("cs")).withColumn("predicted", F.explode("cs"))
    confusion = grid.select(*k, F.lit("confusion").alias("metric"), "class", "predicted", F.coalesce(F.try_element_at(
        "counts", F.struct(F.col("class").alias("t"), F.col("predicted").alias("p"))), zero).cast("double").alias("value"))
    return (long(whole.withColumnRenamed("N", "n"), ("n", "accuracy", "avg_confidence", "confidence_std",
                                                      "avg_confidence_correct", "avg_confidence_incorrect"))
            .unionByName(long(means, [f"{a}_{x}" for a in ("macro", "weighted") for x in scores]))
            .unionByName(long(per.filter(known), (*scores, "support"), "c"))
            .unionByName(long(per.filter("support > 0"), ("hit_rate", "avg_prob", "std_prob"), "c"))
            .unionByName(long(per.filter("c BETWEEN 0 AND top"), ("predicted_n",), "c"))
            .unionByName(confusion))
