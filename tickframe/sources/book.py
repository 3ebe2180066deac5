"""The order book derived from the driver's ``events`` table.

The test data holds no order book, so every query starts from one pure
arithmetic view over ``events``: eight instruments ``S0..S7`` keyed by
``user_id % 8``, five price levels built from ``event_id``, ``user_id`` and the
number in ``props``, and two probability columns that stand for model output.
It is a view over given data: its size grows with ``events``.

``book_sql()`` is the same derivation as SQL text that DuckDB runs for the
oracle; both give identical rows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.frames import fold_sum

# Fixed values of the derived book.
N_SYMBOLS = 8
N_LEVELS = 5
NULL_LEVEL_EVERY = 11   # level 5 sizes are null on every 11th seq
BID_MUL, BID_STEP, BID_MOD = 7, 13, 97
ASK_MUL, ASK_STEP, ASK_MOD = 11, 17, 89


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _d(x) -> Column:
    return F.lit(x).cast("double") if not isinstance(x, Column) else x.cast("double")


def book_from_events(events: DataFrame) -> DataFrame:
    """Wide book: ``symbol, ts, seq``, four columns per level, two probabilities."""
    e = events.select(
        F.concat(F.lit("S"), (F.col("user_id") % N_SYMBOLS).cast("string")).alias("symbol"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.regexp_extract("props", "([0-9]+)", 1).cast("int").alias("k"),
    )
    seq, k = F.col("seq"), F.col("k")
    center = (F.lit(10000) + (k - 50)).cast("double") / _d(100)
    half = (F.lit(1) + seq % 3).cast("double") / _d(100)
    cols = [F.col("symbol"), F.col("ts"), F.col("seq")]
    for i in range(1, N_LEVELS + 1):
        off = _d(i - 1) / _d(100)
        bid_size = (F.lit(1) + (seq * BID_MUL + i * BID_STEP + k) % BID_MOD).cast("double")
        ask_size = (F.lit(1) + (seq * ASK_MUL + i * ASK_STEP + k) % ASK_MOD).cast("double")
        if i == N_LEVELS:
            hole = seq % NULL_LEVEL_EVERY == 0
            bid_size = F.when(~hole, bid_size)
            ask_size = F.when(~hole, ask_size)
        cols += [
            (center - half - off).alias(f"bid_price_{i}"),
            bid_size.alias(f"bid_size_{i}"),
            (center + half + off).alias(f"ask_price_{i}"),
            ask_size.alias(f"ask_size_{i}"),
        ]
    cols += [
        ((seq * 37 + k) % 100).cast("double").__truediv__(_d(100)).alias("prob_up"),
        ((seq * 53 + k * 3) % 101).cast("double").__truediv__(_d(200)).alias("prob_down"),
    ]
    return e.select(*cols)


def level_count(book: DataFrame) -> int:
    """The deepest level that a column of the book names."""
    found = [int(m[1]) for c in book.columns if (m := re.fullmatch(r"(?:bid|ask)_(?:price|size)_(\d+)", c))]
    return max(found, default=0)


def with_book_basics(book: DataFrame, levels: int | None = None) -> DataFrame:
    """PRJ1-3: mid price, spread and size imbalance over all levels that the columns
    hold (the first ``levels`` if told so)."""
    levels = level_count(book) if levels is None else levels
    bids = [f"bid_size_{i}" for i in range(1, levels + 1) if f"bid_size_{i}" in book.columns]
    asks = [f"ask_size_{i}" for i in range(1, levels + 1) if f"ask_size_{i}" in book.columns]
    b, a = fold_sum(bids), fold_sum(asks)
    tot = b + a
    return book.withColumns({
        "mid_price": (F.col("bid_price_1") + F.col("ask_price_1")) / F.lit(2.0),
        "spread": F.col("ask_price_1") - F.col("bid_price_1"),
        "imbalance": F.when(tot > 0, (b - a) / tot).otherwise(F.lit(0.0)),
    })


def load_book(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived book with PRJ1-3 applied: the input of every query."""
    return with_book_basics(book_from_events(read_table(spark, sf_dir, "events")))


# ---------------------------------------------------------------- SQL twin

def book_sql() -> str:
    """The derivation as SQL over ``events`` (runs in DuckDB and Spark)."""
    lv = []
    for i in range(1, N_LEVELS + 1):
        bid = f"CAST(1 + (seq * {BID_MUL} + {i} * {BID_STEP} + k) % {BID_MOD} AS DOUBLE)"
        ask = f"CAST(1 + (seq * {ASK_MUL} + {i} * {ASK_STEP} + k) % {ASK_MOD} AS DOUBLE)"
        if i == N_LEVELS:
            bid = f"CASE WHEN seq % {NULL_LEVEL_EVERY} = 0 THEN NULL ELSE {bid} END"
            ask = f"CASE WHEN seq % {NULL_LEVEL_EVERY} = 0 THEN NULL ELSE {ask} END"
        off = f"CAST({i - 1} AS DOUBLE) / CAST(100 AS DOUBLE)"
        lv += [
            f"center - half - {off} AS bid_price_{i}",
            f"{bid} AS bid_size_{i}",
            f"center + half + {off} AS ask_price_{i}",
            f"{ask} AS ask_size_{i}",
        ]
    levels = ",\n       ".join(lv)
    return f"""WITH e AS (
  SELECT 'S' || CAST(user_id % {N_SYMBOLS} AS STRING) AS symbol, ts, event_id AS seq,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k
  FROM events),
m AS (
  SELECT symbol, ts, seq, k,
         CAST(10000 + (k - 50) AS DOUBLE) / CAST(100 AS DOUBLE) AS center,
         CAST(1 + seq % 3 AS DOUBLE) / CAST(100 AS DOUBLE) AS half
  FROM e)
SELECT symbol, ts, seq,
       {levels},
       CAST((seq * 37 + k) % 100 AS DOUBLE) / CAST(100 AS DOUBLE) AS prob_up,
       CAST((seq * 53 + k * 3) % 101 AS DOUBLE) / CAST(200 AS DOUBLE) AS prob_down
FROM m"""


def book_basics_sql(levels: int = N_LEVELS) -> str:
    """SQL twin of ``load_book``: the ``book`` CTE body used by every oracle."""
    b = " + ".join(f"COALESCE(bid_size_{i}, 0.0)" for i in range(1, levels + 1))
    a = " + ".join(f"COALESCE(ask_size_{i}, 0.0)" for i in range(1, levels + 1))
    return f"""SELECT *,
       (bid_price_1 + ask_price_1) / CAST(2 AS DOUBLE) AS mid_price,
       ask_price_1 - bid_price_1 AS spread,
       CASE WHEN ({b}) + ({a}) > 0
            THEN (({b}) - ({a})) / (({b}) + ({a})) ELSE CAST(0 AS DOUBLE) END AS imbalance
FROM ({book_sql()}) raw_book"""
