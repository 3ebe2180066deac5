"""Labels from the next mid-price move (LBL1-4, FLT3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from ..config import FeatureConfig, LabelConfig, Ordering
from ..functions import frames as fr
from .features import DEFAULT_EXTRACTORS, feature_pipeline, reads
from .ordered import apply_ordered


def label_expr(w: WindowSpec, cfg: LabelConfig = LabelConfig(), mid: str | Column = "mid_price"):
    """LBL1/LBL2 as one expression: r = (mid[t+h] - mid) / mid.

    ternary: 2 if r > theta, 0 if r < -theta, 1 in between (ends inclusive);
    binary: 1 if r > 0 else 0. NULL when r is NULL (the last h rows) or NaN.
    """
    m = F.col(mid) if isinstance(mid, str) else mid
    r = F.try_divide(F.lead(m, cfg.horizon).over(w) - m, m)
    r = F.nanvl(r, F.lit(None).cast("double"))   # NaN would pass for a rise
    th = F.lit(cfg.threshold)
    if cfg.method == "ternary":
        return (F.when(r > th, F.lit(2)).when(r < -th, F.lit(0))
                .when((r >= -th) & (r <= th), F.lit(1)))
    return F.when(r > 0, F.lit(1)).when(r <= 0, F.lit(0))


def add_labels(df: DataFrame, cfg: LabelConfig = LabelConfig(), ordering: Ordering = Ordering(),
               out: str = "label") -> DataFrame:
    if "mid_price" not in df.columns:
        raise ValueError("DataFrame must contain 'mid_price' column")
    return apply_ordered(df, ordering, lambda f, w: f.withColumn(out, label_expr(w, cfg)),
                         lookahead=cfg.horizon)


def labelled_features(df: DataFrame, features: FeatureConfig = FeatureConfig(),
                      cfg: LabelConfig = LabelConfig(), ordering: Ordering = Ordering(),
                      out: str = "label") -> DataFrame:
    """The feature pipeline and the label of each row in one layout of the series:
    equal to ``add_labels`` over ``feature_pipeline`` at half the positions and halos."""
    @reads(ahead=cfg.horizon)
    def label(f: DataFrame, w: WindowSpec, _) -> DataFrame:
        return f.withColumn(out, label_expr(w, cfg, fr.null_out_non_finite("mid_price")))

    if "mid_price" not in df.columns:
        raise ValueError("DataFrame must contain 'mid_price' column")
    return feature_pipeline(df, features, ordering, (*DEFAULT_EXTRACTORS, label))


def drop_unlabelled(df: DataFrame, label: str = "label") -> DataFrame:
    """FLT3."""
    return df.filter(F.col(label).isNotNull())


def label_distribution(df: DataFrame, label: str = "label", *keys: str) -> DataFrame:
    """LBL4: rows per label value (null label kept as its own group)."""
    return df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str = "label", *keys: str) -> DataFrame:
    """LBL3: balanced weights N / (K * n_c) per class, for ``weightCol``.

    One aggregate over the labelled rows; N and K come from a window over the
    small per-class table, so nothing is collected.
    """
    from pyspark.sql import Window
    counts = drop_unlabelled(df, label).groupBy(*keys, label).agg(F.count(F.lit(1)).alias("n_c"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()
    return counts.select(
        *keys, label, "n_c",
        (F.sum("n_c").over(wk).cast("double")
         / (F.count(F.lit(1)).over(wk).cast("double") * F.col("n_c").cast("double"))).alias("weight"))


MAP_CLASSES = 1000


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight",
                      *keys: str) -> DataFrame:
    """Attach the balanced weight of each row's class (NULL without a label).

    The few weights are looked up in a literal map, so rows are not shuffled by
    their handful of labels; more classes than ``MAP_CLASSES`` are joined.
    """
    w = class_weights(df, label, *keys).select(*keys, label, F.col("weight").alias(out))
    if not keys:
        got = w.limit(MAP_CLASSES + 1).collect()
        if len(got) <= MAP_CLASSES:
            if not got:
                return df.withColumn(out, F.lit(None).cast("double"))
            kind = df.schema[label].dataType
            pairs = [x for r in got for x in (F.lit(r[0]).cast(kind), F.lit(r[1]))]
            return df.withColumn(out, F.try_element_at(F.create_map(*pairs), F.col(label)))
    return df.join(w, [*keys, label], "left")
