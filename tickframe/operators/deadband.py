"""Positions under a dead band: a target that differs from the position by less than the
minimum trade is not traded, so every position depends on the one before it.

What a stretch of rows does to the position it is entered with is a small map. An entry
position is held until the first target at least a trade away from it; that target is
a record, higher or lower than all targets of the stretch before it. So the map is the list of
records with the position that the stretch ends with after each (``band_map``), and it stops
growing as soon as records lie two trades apart. Cells are reduced to their maps, the
maps of a series are run through in order from position 0, and every cell is replayed
from the entry it then has. Only rows that change the target reach Python.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructField, StructType

from ..config import Ordering
from .ordered import _BUCKET, CELL, with_cells


def band_map(targets: list[float], m: float) -> tuple[list[float], list[float]]:
    """Records of ``targets`` and, for each, the last position if it is traded first."""
    high, low, records, finals = float("-inf"), float("inf"), [], []
    groups: list[tuple[float, list[int]]] = []      # positions that are possible, and after which records
    for c in targets:
        moved, stay = [], []
        for v, of in groups:
            if v == c or abs(c - v) >= m:
                moved += of
            else:
                stay.append((v, of))
        if (c > high or c < low) and high - low < 3 * m:
            moved.append(len(records))
            records.append(c)
        high, low = max(high, c), min(low, c)
        groups = [*stay, (c, moved)] if moved else stay
    finals = [0.0] * len(records)
    for v, of in groups:
        for i in of:
            finals[i] = v
    return records, finals


def through(position: float, records: list[float], finals: list[float], m: float) -> float:
    """The position after a stretch that is entered with ``position``."""
    for c, v in zip(records, finals):
        if abs(c - position) >= m:
            return v
    return position


def replay(position: float, targets: list[float], m: float) -> list[float]:
    out = []
    for c in targets:
        if abs(c - position) >= m:
            position = c
        out.append(position)
    return out


def _by_rank(table, *names: str) -> list[list]:
    table = table.sort_by("_i")
    return [table.column(n).to_pylist() for n in names]


def banded_positions(df: DataFrame, o: Ordering, min_trade: float, target: str) -> DataFrame:
    """Add ``_c``, the position after each row, and ``_prev``, the one before it: 0 at the
    start of a series, then the last target that was at least ``min_trade`` (above 0) away from the
    position when it came. NULL targets hold the position."""
    import pyarrow as pa
    m, keyed = float(min_trade), o.chunk_rows is None
    x = df.withColumn(CELL, F.struct(*o.keys)) if keyed else with_cells(df, o)
    w = Window.partitionBy(CELL).orderBy(*o.order)
    r = F.col(target)
    x = x.withColumn("_i", F.row_number().over(w))
    last = F.last(r, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    # every cell keeps its first row, so that it has an entry
    slim = (x.select(CELL, "_i", r.alias("_r"), last.alias("_l"))
            .filter((F.col("_i") == 1) | (F.col("_r").isNotNull() & ~F.col("_r").eqNullSafe(F.col("_l"))))
            .select(CELL, "_i", "_r"))
    # the cell comes back from Python as it went, nullability of its fields included
    cell = x.schema[CELL]
    one, many = pa.list_(pa.float64()), ArrayType(DoubleType())

    def reduce_cell(table):
        targets, = _by_rank(table, "_r")
        records, finals = band_map([c for c in targets if c is not None], m)
        return pa.table({CELL: table.column(CELL).slice(0, 1), "records": pa.array([records], one),
                         "finals": pa.array([finals], one)})

    def compose(table):
        records, finals = _by_rank(table, "records", "finals")
        p, entries = 0.0, []
        for a, b in zip(records, finals):
            entries.append(p)
            p = through(p, a, b, m)
        return pa.table({CELL: table.sort_by("_i").column(CELL), "_in": pa.array(entries, pa.float64())})

    def run(table):
        table = table.filter(pa.compute.is_valid(table.column("_r"))).sort_by("_i")
        entry = table.column("_in")[0].as_py() if table.num_rows else 0.0
        held = replay(entry, table.column("_r").to_pylist(), m)
        return pa.table({CELL: table.column(CELL), "_i": table.column("_i"), "_p": pa.array(held, pa.float64())})

    if keyed:
        entries = slim.filter("_i = 1").select(CELL, F.lit(0.0).alias("_in"))
    else:
        maps = slim.groupBy(CELL).applyInArrow(
            reduce_cell, StructType([cell, StructField("records", many), StructField("finals", many)]))
        series = F.struct(*[F.col(CELL)[k].alias(k) for k in o.keys])
        maps = maps.withColumn("_series", series)
        maps = maps.withColumn("_i", F.row_number().over(Window.partitionBy("_series").orderBy(F.col(CELL)[_BUCKET])))
        entries = maps.groupBy("_series").applyInArrow(compose, StructType([cell, StructField("_in", DoubleType())]))
    held = slim.join(entries, CELL).groupBy(CELL).applyInArrow(
        run, StructType([cell, StructField("_i", IntegerType()), StructField("_p", DoubleType())]))
    x = x.join(entries, CELL).join(held, [CELL, "_i"], "left")
    x = x.withColumn("_c", F.coalesce(F.last("_p", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, 0)), "_in"))
    x = x.withColumn("_prev", F.coalesce(F.lag("_c").over(w), "_in")).drop("_i", "_p", "_in")
    return x.drop(CELL)


# the kernels travel with the plan: executors need this repository nowhere on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
