"""Sinks (SNK1-4): everything is written by executors; only aggregates go to JSON."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .book import level_count
from ..session import scratch_path  # noqa: F401  callers find it next to the writers


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
               partition_by: tuple[str, ...] = ()) -> None:
    """SNK1: parquet / csv (with header) / json; no index column exists to drop."""
    if fmt not in ("parquet", "csv", "json"):
        raise ValueError(f"Unsupported format: {fmt}")
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", "true")
    w.format(fmt).save(path)


def save_predictions(df: DataFrame, path: str, by_symbol: bool = True) -> None:
    """SNK2: parquet, partitioned by symbol so later reads prune instruments."""
    save_table(df, path, "parquet", partition_by=("symbol",) if by_symbol and "symbol" in df.columns
               else ())


def save_backtest(ledger: DataFrame, metrics: DataFrame, report: DataFrame, path: str) -> None:
    """SNK3: ledger parquet, metric rows as JSON lines, report as the long table."""
    save_table(ledger, os.path.join(path, "ledger"), "parquet")
    save_table(metrics, os.path.join(path, "metrics"), "json")
    save_table(report, os.path.join(path, "report"), "csv")


def save_evaluation(predictions: DataFrame, tables: dict[str, DataFrame], path: str) -> None:
    """SNK4: per-row predictions to parquet; only the small aggregate tables to JSON."""
    save_table(predictions, os.path.join(path, "predictions"), "parquet")
    for name, t in tables.items():
        save_table(t, os.path.join(path, name), "json")


def write_list_csv(book: DataFrame, path: str, levels: int | None = None) -> None:
    """Write a wide book in the list-CSV layout (ns epoch + four joined lists)."""
    levels = level_count(book) if levels is None else levels
    def joined(side: str):
        return F.concat_ws(",", *[F.col(f"{side}_{i}").cast("string") for i in range(1, levels + 1)])
    out = book.select(
        "symbol",
        (F.unix_micros(F.col("ts").cast("timestamp")) * F.lit(1000)).alias("t"),
        joined("bid_price").alias("bid_p"), joined("bid_size").alias("bid_s"),
        joined("ask_price").alias("ask_p"), joined("ask_size").alias("ask_s"))
    out.write.mode("overwrite").partitionBy("symbol").option("header", "false").csv(path)


def write_wide_csv(book: DataFrame, path: str, levels: int | None = None) -> None:
    """Write a wide book as CSV with header (``timestamp`` as ISO text)."""
    levels = level_count(book) if levels is None else levels
    cols = [F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp")]
    for side in ("bid_price", "bid_size", "ask_price", "ask_size"):
        cols += [F.col(f"{side}_{i}") for i in range(1, levels + 1)]
    book.select("symbol", *cols).write.mode("overwrite").partitionBy("symbol") \
        .option("header", "true").csv(path)
