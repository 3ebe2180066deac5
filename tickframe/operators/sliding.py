"""Sliding frames of any width in time independent of the width.

Positions are cut into blocks as wide as the frame. A frame then is the end of one block and
the beginning of the next, so its aggregate joins two running aggregates: one from the
start of the row's own block up to the row, one of the block before from the frame's first
row to the block's end, run backwards and read ``n - 1`` rows later. Spark evaluates
both as running frames, one step a row; a plain sliding frame is evaluated anew for
every row. Sums restart in every block, and variances are merged about the means of
both parts, so neither loses digits over a long series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Ordering
from .ordered import _K, POS, apply_ordered, with_positions

_HALF = ("n", "s", "m", "v", "xn", "x")


def _running(w, moments: str, maximum: str) -> dict[str, Column]:
    """Count, sum, mean and squared deviations of one column, count and maximum of another."""
    c = F.count(moments).over(w)
    return dict(zip(_HALF, (c, F.sum(moments).over(w), F.avg(moments).over(w), F.var_pop(moments).over(w) * c,
                            F.count(maximum).over(w), F.max(maximum).over(w))))


def sliding_frames(df: DataFrame, o: Ordering, n: int, moments: str, maximum: str,
                   sum_out: str, std_out: str, max_out: str) -> DataFrame:
    """Add sum and sample standard deviation of ``moments`` and maximum of ``maximum`` over
    the last ``n`` rows of the series; NULL until ``n`` non-null values fill the frame
    (the deviation also for n = 1)."""
    had = POS in df.columns
    parts = [*o.keys, *([] if o.chunk_rows is None else [_K])]

    def build(f: DataFrame, _) -> DataFrame:
        f = f.withColumn("_blk", F.floor(F.col(POS) / F.lit(n)))
        block = Window.partitionBy(*parts, "_blk")
        up = block.orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
        down = block.orderBy(F.col(POS).desc()).rowsBetween(Window.unboundedPreceding, 0)
        f = f.withColumns({f"_a{k}": v for k, v in _running(up, moments, maximum).items()})
        f = f.withColumns({f"_b{k}": v for k, v in _running(down, moments, maximum).items()})
        # the last row of a block has its whole frame in the block
        series = Window.partitionBy(*parts).orderBy(POS)
        split = F.col(POS) % n != n - 1
        f = f.withColumns({f"_b{k}": F.when(split, F.lag(f"_b{k}", n - 1).over(series)) for k in _HALF})
        a, b = ({k: F.col(f"_{side}{k}") for k in _HALF} for side in "ab")
        count = a["n"] + F.coalesce(b["n"], F.lit(0))
        both = (a["n"] > 0) & (b["n"] > 0)
        apart = F.when(both, (a["m"] - b["m"]) ** 2 * a["n"] * b["n"] / count).otherwise(F.lit(0.0))
        zero = F.lit(0.0)
        m2 = F.coalesce(a["v"], zero) + F.coalesce(b["v"], zero) + apart
        full = (count == n) & (F.col(POS) >= n - 1)
        return f.withColumns({
            sum_out: F.when(full, F.coalesce(a["s"] + b["s"], a["s"], b["s"])),
            std_out: F.when(full & (count > 1), F.sqrt(m2 / (count - 1))),
            max_out: F.when((a["xn"] + F.coalesce(b["xn"], F.lit(0)) == n) & (F.col(POS) >= n - 1),
                            F.greatest(a["x"], b["x"])),
        }).drop("_blk", *[f"_{side}{k}" for side in "ab" for k in _HALF])

    out = apply_ordered(with_positions(df.drop(POS), o), o, build, lookback=n - 1, dense_pos=True)
    return out if had else out.drop(POS)
