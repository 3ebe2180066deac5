"""Time filters, resampling, sliding windows, sequences and splits (FLT1, TS1-6).

Positional operators (splits, folds, sliding windows) work on the 0-based
position ``pos`` built by ``with_positions`` and on the per-key row count from
a group-by joined back -- never on a driver-side loop or a single-task window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import Ordering
from .ordered import POS, apply_ordered, with_positions


def filter_by_time(df: DataFrame, start: str | None = None, end: str | None = None,
                   ts: str = "ts") -> DataFrame:
    """FLT1: inclusive at both ends, each optional; reaches the parquet scan."""
    if start:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    if end:
        df = df.filter(F.col(ts) <= F.lit(end).cast("timestamp_ntz"))
    return df


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def interval_seconds(spec: str) -> int:
    """'5 minutes' -> 300 (units: second, minute, hour, day)."""
    num, unit = spec.split()
    return int(num) * _UNIT_SECONDS[unit.rstrip("s")]


def floor_time(c: Column, seconds: int) -> Column:
    """Left edge of the ``seconds``-wide bucket holding ``c`` (epoch aligned).

    Pure wall-clock arithmetic on TIMESTAMP_NTZ fields (date, hour, minute,
    second), so the result does not depend on the session time zone -- casts
    through TIMESTAMP would shift values around daylight-saving changes.
    """
    t = c.cast("timestamp_ntz")
    day_us = 86_400_000_000
    days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("long")
    sec = F.date_part(F.lit("SECOND"), t)          # seconds with microsecond fraction
    tod = (F.hour(t).cast("long") * 3_600_000_000 + F.minute(t).cast("long") * 60_000_000
           + (sec * F.lit(1_000_000)).cast("long"))
    us = F.lit(int(seconds) * 1_000_000)
    b = F.floor((days * F.lit(day_us) + tod) / us) * us
    d = F.floor(b / F.lit(day_us))
    r = b - d * F.lit(day_us)
    date = F.date_add(F.lit("1970-01-01").cast("date"), d.cast("int"))
    return F.make_timestamp_ntz(
        F.year(date), F.month(date), F.dayofmonth(date),
        F.floor(r / F.lit(3_600_000_000)).cast("int"),
        F.floor((r % F.lit(3_600_000_000)) / F.lit(60_000_000)).cast("int"),
        ((r % F.lit(60_000_000)).cast("decimal(18,0)") / F.lit(1_000_000)).cast("decimal(8,6)"))


def sort_by_time(df: DataFrame, o: Ordering = Ordering()) -> DataFrame:
    """SRT1: rows by time over all keys (ties by the rest of the order, then key).
    A range-partitioned sort: no task holds more than its range."""
    return df.orderBy(*o.order, *o.keys)


def resample_last(df: DataFrame, freq: str = "1 second", columns: Sequence[str] | None = None,
                  o: Ordering = Ordering(), ts: str = "ts", spine_chunk: str = "1 day") -> DataFrame:
    """TS1: left-closed buckets of ``freq``; last non-null value of each column.

    Empty buckets between a key's first and last bucket are kept as null rows.
    The spine of buckets is generated in two steps -- coarse ``spine_chunk``
    rows, then the fine buckets inside each -- so a long key is spread over
    many tasks instead of being exploded from one row.
    """
    cols = list(columns) if columns is not None else [
        c for c in df.columns if c not in (*o.keys, *o.order)]
    order = F.struct(*[F.col(c) for c in o.order])
    step, chunk = interval_seconds(freq), interval_seconds(spine_chunk)
    if chunk % step:
        raise ValueError("spine_chunk must be a multiple of freq")
    aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]
    agg = df.groupBy(*o.keys, floor_time(F.col(ts), step).alias("_b")).agg(*aggs)
    bounds = agg.groupBy(*o.keys).agg(F.min("_b").alias("_lo"), F.max("_b").alias("_hi"))
    coarse = bounds.select(
        *o.keys, "_lo", "_hi",
        F.explode(F.sequence(floor_time(F.col("_lo"), chunk), floor_time(F.col("_hi"), chunk),
                             F.make_dt_interval(secs=F.lit(chunk)))).alias("_c"))
    fine = coarse.repartition(*o.keys, "_c").select(
        *o.keys,
        F.explode(F.sequence(
            F.greatest(F.col("_c"), F.col("_lo")),
            F.least(F.col("_c") + F.make_dt_interval(secs=F.lit(chunk - step)), F.col("_hi")),
            F.make_dt_interval(secs=F.lit(step)))).alias("_b"))
    return (fine.join(agg, [*o.keys, "_b"], "left")
            .withColumnRenamed("_b", ts)
            .select(*o.keys, ts, *cols))


def sliding_windows(df: DataFrame, size: int, step: int = 1, o: Ordering = Ordering()) -> DataFrame:
    """TS2: windows ``[i, i+size)`` at i = 0, step, ... while i + size <= N.

    Each row is emitted once per window that contains it, tagged with
    ``window_id`` (= i / step): a long table instead of a list of copies.
    """
    p = with_positions(df.drop(POS), o, "_n")
    r = F.col(POS)
    lo = F.greatest(F.lit(0), F.ceil((r - F.lit(size - 1)) / F.lit(step)))
    hi = F.least(F.floor(r / F.lit(step)), F.floor((F.col("_n") - F.lit(size)) / F.lit(step)))
    ids = F.when(lo <= hi, F.sequence(lo.cast("bigint"), hi.cast("bigint")))
    return p.withColumn("window_id", F.explode(ids)).drop("_n")


def sequence_samples(df: DataFrame, features: Sequence[str], length: int = 20,
                     label: str = "label", o: Ordering = Ordering(), out: str = "window",
                     dense_pos: bool = False) -> DataFrame:
    """TS3: for row i >= L, the feature rows i-L .. i-1 (current row excluded).

    Returns only complete samples; ``window`` is ``array<struct<features>>``
    in time order. ``dense_pos``: see ``apply_ordered``.
    """
    def build(f: DataFrame, w):
        prev = w.rowsBetween(-length, -1)
        return f.withColumn(out, F.collect_list(F.struct(*[F.col(c) for c in features])).over(prev))
    res = apply_ordered(df, o, build, lookback=length, dense_pos=dense_pos)
    return res.filter(F.size(out) == length)


def _split_label(p: Column, n: Column, test: float, val: float) -> Column:
    n_test = F.floor(n.cast("double") * F.lit(test))
    n_val = F.floor(n.cast("double") * F.lit(val))
    return (F.when(p < n - n_test - n_val, F.lit("train"))
            .when(p < n - n_test, F.lit("val")).otherwise(F.lit("test")))


def time_split(df: DataFrame, test_size: float = 0.2, val_size: float = 0.2,
               o: Ordering = Ordering()) -> DataFrame:
    """TS4: first rows train, then val, last int(N*test) rows test -- one ``split`` column."""
    p = with_positions(df.drop(POS), o, "_n")
    return p.withColumn("split", _split_label(F.col(POS), F.col("_n"), test_size, val_size)).drop("_n")


def time_split_ratio(df: DataFrame, train_ratio: float = 0.8, o: Ordering = Ordering()) -> DataFrame:
    """TS5: the first int(N*ratio) rows train, the rest test."""
    p = with_positions(df.drop(POS), o, "_n")
    cut = F.floor(F.col("_n").cast("double") * F.lit(train_ratio))
    return p.withColumn("split", F.when(F.col(POS) < cut, F.lit("train")).otherwise(F.lit("test"))
                        ).drop("_n")


def walk_forward(df: DataFrame, train_window: int = 1000, test_window: int = 200,
                 o: Ordering = Ordering()) -> DataFrame:
    """TS6: tag test rows with their fold; rows of no fold are dropped.

    Folds start at i = 0, test, 2*test, ... strictly below N - train - test; the
    test rows of fold f are ``[f*test + train, f*test + train + test)``. The
    folds are disjoint, so every per-fold step later is a group-by on ``fold``.
    Adds ``fold``, ``train_start``, ``train_end``, ``test_start``, ``test_end``.
    """
    p = with_positions(df.drop(POS), o, "_n")
    fold = F.floor((F.col(POS) - F.lit(train_window)) / F.lit(test_window))
    p = p.filter(F.col(POS) >= F.lit(train_window)).withColumn("fold", fold)
    p = p.filter(F.col("fold") * F.lit(test_window) < F.col("_n") - F.lit(train_window + test_window))
    start = F.col("fold") * F.lit(test_window)
    return p.withColumns({
        "train_start": start,
        "train_end": start + F.lit(train_window),
        "test_start": start + F.lit(train_window),
        "test_end": start + F.lit(train_window + test_window),
    }).drop("_n")
