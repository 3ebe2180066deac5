"""Ordered-series execution: keyed windows, and chunked windows for hot keys.

Every order-dependent operator of the library is written once as a function
``build(df, w) -> df`` over a ``WindowSpec`` ``w`` that orders one series.
``apply_ordered`` decides how that spec is laid out over the cluster:

* ``Ordering.chunk_rows is None`` -- ``w = partitionBy(keys).orderBy(order)``:
  one exchange on the key. Right for many keys of modest size.
* ``chunk_rows = C`` -- each key is cut into chunks of C consecutive rows
  (by a 0-based position built in parallel, see ``with_positions``). Rows near a
  chunk edge are copied into the neighbouring chunk as a halo, the window runs
  per ``(key, chunk)`` and halo copies are dropped afterwards. A key holding a
  third of all rows then spreads over ``rows / C`` tasks instead of one, and the
  result equals the single keyed window for every frame no deeper than the halo.

Prefix operators (running sum / max / last non-null), which no fixed halo can
serve, need no positions: their chunks are time buckets (``with_cells``). ``carry``
reduces every cell to one row, scans those rows and hands the result back, several
prefixes at a time; ``prefix_scan`` is its form for one of them.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..config import Ordering

POS = "pos"          # 0-based position of a row inside its key
_CH = "_chunk"       # home chunk of a row
_K = "_k"            # chunk a (possibly halo) copy belongs to
_BUCKET = "_bucket"
_CUTS = "_cuts"     # order values at which a bucket is cut
#: Buckets with cuts that are broadcast; more are joined.
CUT_BUCKETS = 10_000
CELL = "_cell"      # series and time bucket of a row


def keyed_window(o: Ordering, *extra: str) -> WindowSpec:
    return Window.partitionBy(*o.keys, *extra).orderBy(*o.order)


def join_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` with null equal to null: rows with a null key or time are
    rows like any other and must not vanish."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(r, reduce(lambda a, b: a & b, on), how).drop(*[f"_r_{k}" for k in keys])


def with_positions(df: DataFrame, o: Ordering, size: str | None = None) -> DataFrame:
    """Add ``pos``: the 0-based row position of each row within its key; with ``size`` also
    the rows of the key under that name, which the same counts give.

    Keyed mode: ``row_number`` over the key. Chunked mode, in three parallel
    steps that never put a whole key into one task:
    1. rows per ``(key, time bucket)`` -- a map-side combined count;
    2. exclusive running sum of those counts per key -- a window over the small
       count table (one row per bucket);
    3. ``row_number`` within ``(key, bucket)`` plus the bucket's offset.
    The offset table is joined without a hint: AQE broadcasts it after it has
    measured its size and keeps a shuffle join otherwise.
    """
    if POS in df.columns and size is None:
        return df
    whole = Window.partitionBy(*o.keys)
    if o.chunk_rows is None:
        out = df.withColumn(POS, F.row_number().over(keyed_window(o)) - F.lit(1))
        return out if size is None else out.withColumn(size, F.count(F.lit(1)).over(whole))
    x = bucketed(df, o)
    counts = x.groupBy(*o.keys, _BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(*o.keys).orderBy(_BUCKET).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = counts.select(*o.keys, _BUCKET, F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_off"),
                            *([] if size is None else [F.sum("_n").over(whole).alias(size)]))
    local = F.row_number().over(keyed_window(o, _BUCKET)) - F.lit(1)
    return (join_keys(x, offsets, [*o.keys, _BUCKET])
            .withColumn(POS, F.col("_off") + local)
            .drop(_BUCKET, "_off"))


def bucketed(df: DataFrame, o: Ordering) -> DataFrame:
    """Add the time bucket of each row: in order, every row of a bucket comes after every
    row of an earlier one. Every level of cuts makes it a struct of the bucket so far and
    how many cuts of it the row has passed, so a row meets the few cuts of one cell a level."""
    from .timeseries import floor_time, interval_seconds
    x = df.withColumn(_BUCKET, floor_time(F.col(o.order[0]), interval_seconds(o.bucket)))
    row = F.struct(*o.order)
    for cuts in o.cuts or ():
        keys = [c for c in cuts.columns if c != _CUTS]
        if cuts.limit(CUT_BUCKETS + 1).count() <= CUT_BUCKETS:
            cuts = F.broadcast(cuts)
        x = join_keys(x, cuts, keys, "left")
        passed = F.coalesce(F.size(F.filter(_CUTS, lambda c: c <= row)), F.lit(0))
        x = x.withColumn(_BUCKET, F.struct(F.col(_BUCKET).alias("bucket"), F.when(
            F.col(_CUTS).isNull(), F.lit(0)).otherwise(passed).alias("part"))).drop(_CUTS)
    return x


def apply_ordered(df: DataFrame, o: Ordering, build: Callable[[DataFrame, WindowSpec], DataFrame],
                  lookback: int = 0, lookahead: int = 0, dense_pos: bool = False) -> DataFrame:
    """Run ``build(df, w)`` with ``w`` ordering each series.

    ``lookback`` / ``lookahead``: how many rows before / after the current one
    any expression of ``build`` reads (summed along window-over-window chains).
    """
    if o.chunk_rows is None:
        return build(df, keyed_window(o))
    c = int(o.chunk_rows)
    if c < max(lookback, lookahead, 1):
        raise ValueError(f"chunk_rows={c} is smaller than the halo ({lookback}, {lookahead})")
    # halos need dense positions. An inherited ``pos`` is trusted only when
    # the caller marks it dense (``dense_pos``); otherwise rebuild, since an
    # upstream filter may have left gaps.
    had_pos = POS in df.columns
    p = df if (had_pos and dense_pos) else with_positions(df.drop(POS), o)
    ch = F.floor(F.col(POS) / F.lit(c))
    within = F.col(POS) % F.lit(c)
    copies = F.array(
        ch,
        F.when(within >= F.lit(c - lookback), ch + 1) if lookback > 0 else F.lit(None).cast("bigint"),
        F.when((within < F.lit(lookahead)) & (ch > 0), ch - 1) if lookahead > 0
        else F.lit(None).cast("bigint"),
    )
    # the array is a column of its own: inside ``explode`` its type is found anew for every row
    expanded = (p.withColumns({_CH: ch, _K: F.filter(copies, lambda x: x.isNotNull())})
                .withColumn(_K, F.explode(_K)))
    if o.partitions is not None:
        expanded = expanded.repartition(int(o.partitions), *o.keys, _K)
    out = build(expanded, keyed_window(o, _K))
    out = out.filter(F.col(_K) == F.col(_CH)).drop(_K, _CH)
    return out if had_pos else out.drop(POS)


# ------------------------------------------------------------------ prefixes

def with_cells(df: DataFrame, o: Ordering) -> DataFrame:
    """Add the cell of each row: its series and time bucket (chunked mode only).

    Cells follow each other in series order, so what a row needs of earlier rows is
    local to its cell plus one carried value per cell. One struct column serves as
    partition key and as join key alike (fields that are null are equal there), so
    windows and joins by cell share one exchange.
    """
    if o.chunk_rows is None:
        return df
    return bucketed(df, o).withColumn(CELL, F.struct(*o.keys, _BUCKET)).drop(_BUCKET)


def cell_window(o: Ordering) -> WindowSpec:
    """Orders the rows of a cell (of a series in keyed mode)."""
    return keyed_window(o) if o.chunk_rows is None else Window.partitionBy(CELL).orderBy(*o.order)


def latest(value: Column, o: Ordering, where: Column | None = None) -> Column:
    """Aggregate: ``value`` of the last row in series order (of those that hold ``where``)."""
    at = F.struct(*o.order)
    return F.max_by(value, at if where is None else F.when(where, at))


def carry(df: DataFrame, o: Ordering, totals: dict[str, Column],
          prefixes: Callable[[DataFrame, WindowSpec], DataFrame], names: dict[str, str]) -> DataFrame:
    """Add what the earlier cells of a series hand to each cell.

    ``totals`` are aggregated per cell; ``prefixes(cells, w)`` turns them into the
    columns ``names`` (name -> type) with ``w`` over the cells before the current one.
    That window runs over one row per cell. In keyed mode nothing comes before.
    """
    if o.chunk_rows is None:
        return df.withColumns({n: F.lit(None).cast(t) for n, t in names.items()})
    cells = df.groupBy(CELL).agg(*[c.alias(n) for n, c in totals.items()])
    w = Window.partitionBy(*[F.col(CELL)[k] for k in o.keys]).orderBy(F.col(CELL)[_BUCKET])
    before = prefixes(cells, w.rowsBetween(Window.unboundedPreceding, -1))
    return df.join(before.select(CELL, *names), CELL)


_SCAN = {
    # name: (window aggregate, how the exclusive prefix and the local value combine)
    # null only while every value so far is null, like the keyed running sum
    "sum": (F.sum, lambda pre, loc: F.coalesce(pre + loc, pre, loc)),
    "max": (F.max, lambda pre, loc: F.greatest(pre, loc)),
    "last": (lambda c: F.last(c, ignorenulls=True), lambda pre, loc: F.coalesce(loc, pre)),
}


def prefix_scan(df: DataFrame, o: Ordering, value: Column | str, op: str, out: str,
                *extra_keys: str) -> DataFrame:
    """Running ``sum`` / ``max`` / ``last non-null`` of ``value`` per key.

    ``extra_keys`` restart the scan (e.g. a fold id). Chunked mode runs the scan per
    cell and adds the prefix carried from earlier cells.
    """
    agg, combine = _SCAN[op]
    o = replace(o, keys=(*o.keys, *extra_keys))
    x = with_cells(df, o).withColumn("_v", F.col(value) if isinstance(value, str) else value)
    v = F.col("_v")
    x = carry(x, o, {"_tot": latest(v, o, v.isNotNull()) if op == "last" else agg(v)},
              lambda t, w: t.withColumn("_pre", agg(F.col("_tot")).over(w)),
              {"_pre": x.schema["_v"].dataType.simpleString() if op != "sum" else "double"})
    local = agg(v).over(cell_window(o).rowsBetween(Window.unboundedPreceding, 0))
    return x.withColumn(out, combine(F.col("_pre"), local) if o.chunk_rows is not None else local) \
            .drop("_v", "_pre", CELL)
