"""Exact quantiles (linear interpolation, numpy's default) without collecting a group.

Spark's exact ``percentile`` keeps every distinct value of a group in one
buffer, which a key holding a third of the data cannot afford. Here:

1. one aggregate per key: the row count ``n`` and ``percentile_approx`` at
   ``q -/+ margin`` (accuracy A: the rank error is at most n/A), giving a value
   band that must contain the order statistics at ranks floor((n-1)q) and the
   next one;
2. one aggregate counts the rows below the band;
3. the rows inside the band (widened by the next distinct value on each side
   against the sketch's rank convention) are counted per distinct value, with
   map-side combine, and a running count over the distinct values gives ranks.
   A value that fills most of a key is one row there.

The bounds are one row per key and quantile. Up to ``BROADCAST_BOUNDS`` of them
are broadcast, so that fact rows are filtered where they are read; more are joined.

The two order statistics are interpolated as ``lo + (hi - lo) * frac``.
Small groups (n below A) are held exactly by the sketch, so the band is exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .ordered import join_keys

DEFAULT_ACCURACY = 100_000
BROADCAST_BOUNDS = 10_000


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, qs: Mapping[str, float],
                    accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Wide result: ``keys`` + one DOUBLE column per entry of ``qs`` (NULL rows skipped)."""
    keys = list(keys)
    names = list(qs)
    margin = 3.0 / accuracy
    lo_p = [max(0.0, qs[n] - margin) for n in names]
    hi_p = [min(1.0, qs[n] + margin) for n in names]
    v = F.col(value).cast("double")
    src = df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull())
    stats = src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.percentile_approx("_v", F.array(*[F.lit(p) for p in lo_p + hi_p]), accuracy).alias("_b"))
    k = len(names)
    per_q = stats.select(*keys, "_n", F.explode(F.array(*[
        F.struct(F.lit(n).alias("_q"), F.lit(float(qs[n])).alias("_p"),
                 F.col("_b")[i].alias("_lo"), F.col("_b")[k + i].alias("_hi"))
        for i, n in enumerate(names)])).alias("_s")).select(*keys, "_n", "_s.*")
    idx = (F.col("_n") - F.lit(1)).cast("double") * F.col("_p")
    per_q = per_q.withColumns({
        "_klo": F.floor(idx),
        "_frac": idx - F.floor(idx),
    }).withColumn("_khi", F.least(F.col("_klo") + F.lit(1), F.col("_n") - F.lit(1)))
    per_q = scratch_table(per_q, "quantile-bounds")
    small = per_q.count() <= BROADCAST_BOUNDS

    def beside(bounds: DataFrame) -> DataFrame:
        return join_keys(src, F.broadcast(bounds) if small else bounds, keys)

    # rows below the band, and the next value above it (the upper interpolation
    # partner when the sketch is exact and the band is a single value)
    edges = beside(per_q).groupBy(*keys, "_q", "_n", "_lo", "_hi", "_klo", "_khi", "_frac").agg(
        F.count_if(F.col("_v") < F.col("_lo")).alias("_below"),
        F.max(F.when(F.col("_v") < F.col("_lo"), F.col("_v"))).alias("_lo2"),
        F.min(F.when(F.col("_v") > F.col("_hi"), F.col("_v"))).alias("_hi2"))
    bounds = scratch_table(edges.select(
        *keys, "_q", "_lo", "_below", "_klo", "_khi", "_frac",
        F.coalesce(F.col("_lo2"), F.col("_lo")).alias("_bot"),
        F.coalesce(F.col("_hi2"), F.col("_hi")).alias("_top")), "quantile-bounds")
    return _pick(beside(bounds), keys, names)


def band_values(joined: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, quantile and distinct value of the band, with its rows ``_m``."""
    band = joined.filter((F.col("_v") >= F.col("_bot")) & (F.col("_v") <= F.col("_top")))
    return band.groupBy(*keys, "_q", "_lo", "_below", "_klo", "_khi", "_frac", "_v").agg(
        F.count(F.lit(1)).alias("_m"))


def _pick(joined: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Rank the band's distinct values and interpolate."""
    whole = Window.partitionBy(*keys, "_q")
    before = whole.orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    # band rows below ``_lo`` (all equal to ``_lo2``) are already in ``_below``
    ranked = band_values(joined, keys).withColumn(
        "_first", F.col("_below") - F.coalesce(F.sum(F.when(F.col("_v") < F.col("_lo"), F.col("_m"))).over(whole),
                                               F.lit(0)) + F.coalesce(F.sum("_m").over(before), F.lit(0)))

    def at(k: str):
        return F.max(F.when((F.col(k) >= F.col("_first")) & (F.col(k) < F.col("_first") + F.col("_m")), F.col("_v")))

    picked = ranked.groupBy(*keys, "_q").agg(at("_klo").alias("_xlo"), at("_khi").alias("_xhi"),
                                             F.first("_frac").alias("_frac"))
    val = F.col("_xlo") + (F.col("_xhi") - F.col("_xlo")) * F.col("_frac")
    picked = picked.withColumn("_val", val)
    return picked.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_q") == F.lit(n), F.col("_val"))).alias(n) for n in names])


# ------------------------------------------------------------------ approximate, by mergeable sketches

SKETCH_K = 1000


def quantile_sketches(df: DataFrame, keys: Sequence[str], value: str, k: int = SKETCH_K) -> DataFrame:
    """``keys, n, sketch``: a KLL sketch of the non-null, non-NaN values per group, a few KB
    whatever its rows. Store it per (series, day): any range of days is then answered from
    the sketches alone. ``k`` sets the rank error (about 2.3 / k ** 0.9)."""
    v = F.col(value).cast("double")
    return (df.select(*keys, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v")).groupBy(*keys)
            .agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("_v", F.lit(k)).alias("sketch")))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], qs: Mapping[str, float]) -> DataFrame:
    """``keys, n`` and one DOUBLE column per entry of ``qs`` from the merged sketches of each
    group: approximate (see ``quantile_sketches``), where ``exact_quantiles`` is exact."""
    merged = sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("_s"))
    return merged.select(*keys, "n", *[F.kll_sketch_get_quantile_double("_s", F.lit(float(q))).alias(name)
                                       for name, q in qs.items()])
