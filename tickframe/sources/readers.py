"""Book readers and generic table IO (SRC1-5, PRJ1-4 on array snapshots).

Readers use explicit schemas (no inference pass over the data) and Spark's
own CSV/parquet scans, so files split across tasks and filters push down.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .book import level_count

LIST_SCHEMA = "t LONG, bid_p STRING, bid_s STRING, ask_p STRING, ask_s STRING"
ARRAYS = ("bid_prices", "bid_sizes", "ask_prices", "ask_sizes")


def _check_exists(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"Data file not found: {path}")


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in floating columns means missing: NULL from here on."""
    cols = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema.fields
            if f.dataType.simpleString() in ("double", "float")}
    return df.withColumns(cols) if cols else df


def file_order() -> Column:
    """A struct that orders rows as the files hold them: file name, then the start of
    the split, then the row's place in its partition (partitions are read split by
    split, so ids grow along each)."""
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"))


def _num_list(c: Column) -> Column:
    """'1.0,2.5,,3' -> [1.0, 2.5, 3.0]: empty items dropped, bad numbers and NaN NULL."""
    return F.transform(F.filter(F.split(F.regexp_replace(c, r"[\[\]\s]", ""), ","),
                                lambda x: x != ""),
                       lambda x: F.when(F.lower(x) != "nan", x.try_cast("double")))


def read_list_book(spark: SparkSession, path: str, symbol: str | None = None) -> DataFrame:
    """SRC1: headerless CSV; ns epoch, then four comma-joined number lists.

    Time keeps microseconds (Spark's resolution): ``timestamp_micros(ns div 1000)``.
    """
    _check_exists(spark, path)
    raw = spark.read.schema(LIST_SCHEMA).option("header", "false").csv(path)
    extra = [c for c in raw.columns if c not in ("t", "bid_p", "bid_s", "ask_p", "ask_s")]
    out = raw.select(
        *extra,
        F.timestamp_micros(F.expr("t div 1000")).cast("timestamp_ntz").alias("ts"),
        file_order().alias("seq"),
        _num_list(F.col("bid_p")).alias("bid_prices"), _num_list(F.col("bid_s")).alias("bid_sizes"),
        _num_list(F.col("ask_p")).alias("ask_prices"), _num_list(F.col("ask_s")).alias("ask_sizes"))
    if symbol is not None:
        out = out.withColumn("symbol", F.lit(symbol))
    return out


def wide_csv_schema(levels: int = 10) -> str:
    cols = ["timestamp STRING"]
    for side in ("bid_price", "bid_size", "ask_price", "ask_size"):
        cols += [f"{side}_{i} DOUBLE" for i in range(1, levels + 1)]
    return ", ".join(cols)


def read_wide_book(spark: SparkSession, path: str, levels: int = 10, strict: bool = False,
                   symbol: str | None = None) -> DataFrame:
    """SRC2: CSV with header; per list the null levels are removed.

    The reference compacts each list on its own, so a price and a size may
    shift against each other when only one is null; ``strict=True`` drops a
    level when any of its four cells is null instead.
    """
    _check_exists(spark, path)
    raw = spark.read.option("header", "true").schema(wide_csv_schema(levels)).csv(path)
    raw = nan_to_null(raw).withColumn("seq", file_order())
    ts = F.to_timestamp("timestamp").cast("timestamp_ntz")
    extra = [c for c in raw.columns if c not in ("timestamp", "seq") and not c.split("_")[-1].isdigit()]
    extra.append("seq")

    def lst(side: str) -> Column:
        arr = F.array(*[F.col(f"{side}_{i}") for i in range(1, levels + 1)])
        return F.filter(arr, lambda x: x.isNotNull())   # NaN cells are NULL by now

    if strict:
        lv = F.array(*[F.struct(*[F.col(f"{s}_{i}").alias(s) for s in
                                  ("bid_price", "bid_size", "ask_price", "ask_size")])
                       for i in range(1, levels + 1)])
        ok = F.filter(lv, lambda x: x["bid_price"].isNotNull() & x["bid_size"].isNotNull()
                      & x["ask_price"].isNotNull() & x["ask_size"].isNotNull())
        out = raw.select(*extra, ts.alias("ts"), ok.alias("_l")).select(
            *extra, "ts", *[F.transform("_l", lambda x, s=s: x[s]).alias(a) for s, a in
                    zip(("bid_price", "bid_size", "ask_price", "ask_size"), ARRAYS)])
    else:
        out = raw.select(*extra, ts.alias("ts"), lst("bid_price").alias("bid_prices"),
                         lst("bid_size").alias("bid_sizes"), lst("ask_price").alias("ask_prices"),
                         lst("ask_size").alias("ask_sizes"))
    if symbol is not None:
        out = out.withColumn("symbol", F.lit(symbol))
    return out


def to_snapshot_arrays(book: DataFrame, levels: int | None = None) -> DataFrame:
    """Wide book -> snapshot rows with four arrays (nulls filtered out); all levels
    that the columns hold unless told otherwise."""
    levels = level_count(book) if levels is None else levels
    def lst(side: str) -> Column:
        return F.filter(F.array(*[F.col(f"{side}_{i}") for i in range(1, levels + 1)]),
                        lambda x: x.isNotNull())
    keep = [c for c in ("symbol", "ts", "seq") if c in book.columns]
    return book.select(*keep, lst("bid_price").alias("bid_prices"), lst("bid_size").alias("bid_sizes"),
                       lst("ask_price").alias("ask_prices"), lst("ask_size").alias("ask_sizes"))


def book_basics_from_arrays(snap: DataFrame) -> DataFrame:
    """PRJ1-3 on snapshot arrays; an empty book gives NULL mid/spread (not an error)."""
    b = F.aggregate("bid_sizes", F.lit(0.0), lambda a, x: a + x)
    a = F.aggregate("ask_sizes", F.lit(0.0), lambda acc, x: acc + x)
    tot = b + a
    bb, ba = F.get(F.col("bid_prices"), 0), F.get(F.col("ask_prices"), 0)
    return snap.withColumns({
        "mid_price": (bb + ba) / F.lit(2.0),
        "spread": ba - bb,
        "imbalance": F.when(tot > 0, (b - a) / tot).otherwise(F.lit(0.0)),
    })


def widen_levels(snap: DataFrame, max_levels: int = 10) -> DataFrame:
    """PRJ4: one column per level and side up to ``max_levels``; absent levels NULL."""
    cols = {}
    for i in range(1, max_levels + 1):
        for arr, name in zip(ARRAYS, ("bid_price", "bid_size", "ask_price", "ask_size")):
            cols[f"{name}_{i}"] = F.get(F.col(arr), i - 1)
    return snap.withColumns(cols)


# Source kinds the reference's pipelines accept.
BOOK_SOURCES = ("lobster", "kaggle_crypto")


_READERS = {"lobster": read_list_book, "kaggle_crypto": read_wide_book}


def register_book_source(kind: str, reader) -> None:
    """EXT2: add a loader, ``reader(spark, path, **options) -> snapshot rows``."""
    _READERS[kind] = reader


def load_book_source(spark: SparkSession, kind: str, path: str, **kw) -> DataFrame:
    """SRC3: readers by name, own ones included (the simulator kind is not built)."""
    if kind not in _READERS:
        raise ValueError(f"no book loader is registered as {kind!r}; known: {sorted(_READERS)}")
    return _READERS[kind](spark, path, **kw)


def load_table(spark: SparkSession, path: str, fmt: str = "auto", schema: str | None = None
               ) -> DataFrame:
    """SRC4: format from the suffix (parquet, csv, json); missing path raises."""
    _check_exists(spark, path)
    if fmt == "auto":
        p = path.rstrip("/").lower()
        fmt = ("parquet" if p.endswith(".parquet") else "csv" if p.endswith(".csv")
               else "json" if p.endswith(".json") else "")
        if not fmt:
            raise ValueError(f"Cannot detect format of {path}")
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"Unsupported format: {fmt}")
    r = spark.read
    if schema:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
        if not schema:
            r = r.option("inferSchema", "true")
    return r.format(fmt).load(path)


def load_predictions(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: parquet or csv by suffix, anything else is an error."""
    p = path.rstrip("/").lower()
    if not (p.endswith(".parquet") or p.endswith(".csv")):
        raise ValueError(f"Unsupported predictions format: {path}")
    return nan_to_null(load_table(spark, path))
