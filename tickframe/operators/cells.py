"""Cells of even size for series with bursts.

Chunked operators cut a series by time buckets (``Ordering.bucket``). A burst puts too many
rows into one of them. ``even_cells`` counts rows per cell and cuts the cells that hold
too many at quantiles of their first order column that varies (mergeable sketches, no
sampling), until none holds more than twice ``rows``: first by time, and rows of one
instant by the next column of the order. The cuts of each round are written once, as a
level of their own keyed by the cells they cut; operators that get the returned
``Ordering`` go down the levels and compare a row with the few cuts (below ``2 * STEPS``)
of its cell there, however many cells a bucket has in the end. Results do not depend on
where the cuts lie.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, IntegralType, TimestampNTZType, TimestampType)

from ..config import Ordering
from ..session import scratch_table
from .ordered import _BUCKET, _CUTS, bucketed, join_keys

#: Quantiles of one cell; a cell that needs more cuts is cut again.
STEPS = 64
#: Rounds: quantiles of quantiles split a cell of STEPS ** ROUNDS times the wanted rows.
ROUNDS = 6


def _after(value, kind):
    """The smallest value above ``value``."""
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return value + F.expr("INTERVAL '0.000001' SECOND")
    return F.date_add(value, 1) if isinstance(kind, DateType) else value + F.lit(1).cast(kind)


def even_cells(df: DataFrame, o: Ordering, rows: int = 1_000_000) -> Ordering:
    """``o`` with cuts, so that no cell of ``df`` holds more than ``2 * rows`` rows, as far
    as rows differ in a date, timestamp or integer column of the order. Without an
    over-full cell nothing is added; keyed orderings come back as they are."""
    if o.chunk_rows is None:
        return o
    kinds = {c: df.schema[c].dataType for c in o.order}
    levels = [c for c in o.order if isinstance(kinds[c], (DateType, TimestampType, TimestampNTZType, IntegralType))]
    levels = levels[:next((i for i, c in enumerate(o.order) if c not in levels), len(levels))]
    slim = df.select(*o.keys, *o.order)
    o = replace(o, cuts=None)
    for _ in range(ROUNDS):
        x = bucketed(slim, o)
        ends = [f(F.col(c)).alias(f"_{side}_{c}") for c in levels for side, f in (("lo", F.min), ("hi", F.max))]
        over = x.groupBy(*o.keys, _BUCKET).agg(F.count(F.lit(1)).alias("_n"), *ends).filter(F.col("_n") > 2 * rows)
        # the first column that varies within the cell is cut; nothing varies: nothing to cut
        level = F.coalesce(*[F.when(~F.col(f"_lo_{c}").eqNullSafe(F.col(f"_hi_{c}")), F.lit(i))
                             for i, c in enumerate(levels)])
        over = over.withColumn("_level", level).filter("_level IS NOT NULL").withColumn(
            "_skip", F.greatest(F.lit(1), F.floor(F.lit(STEPS * rows) / F.col("_n"))).cast("int"))
        over = scratch_table(over, "full-cells")
        if not over.limit(1).count():
            return o
        within = join_keys(x, over, [*o.keys, _BUCKET])
        steps = [i / STEPS for i in range(1, STEPS)]
        cuts = None
        for i, c in enumerate(levels):
            q = within.filter(F.col("_level") == i).groupBy(*o.keys, _BUCKET).agg(
                F.percentile_approx(c, steps, 10_000).alias("_q"), F.max("_skip").alias("_skip"),
                *[F.min(f"_lo_{x}").alias(f"_lo_{x}") for x in levels])
            # every _skip-th quantile, and where one repeats the value after it
            q = q.withColumn("_v", F.explode(F.array_distinct(F.flatten(F.transform("_q", lambda v, k: F.when(
                (k + 1) % F.col("_skip") == 0, F.array(v, _after(v, kinds[c]))).otherwise(F.array().cast(
                    f"array<{kinds[c].simpleString()}>")))))))
            q = q.filter(F.col("_v") > F.col(f"_lo_{c}"))
            at = F.struct(*[(F.col(f"_lo_{x}") if j < i else F.col("_v") if j == i else F.lit(None)).cast(kinds[x]).alias(x)
                            for j, x in enumerate(o.order)])
            q = q.select(*o.keys, _BUCKET, at.alias("_at"))
            cuts = q if cuts is None else cuts.unionByName(q)
        cuts = cuts.groupBy(*o.keys, _BUCKET).agg(F.sort_array(F.collect_set("_at")).alias(_CUTS))
        o = replace(o, cuts=(*(o.cuts or ()), scratch_table(cuts, "cell-cuts")))
    return o
