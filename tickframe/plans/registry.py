"""Query registry: each entry pairs a Spark plan with its SQL twin.

An entry has an output spec ``"symbol seq label n mean:d"``: column names in
order, ``:d`` marks DOUBLE columns and ``:e`` those of small values (returns,
volatilities). Both sides end with the same projection, and DOUBLE values are settled
to 6 (``:e``: 9) decimals the same way in both engines (``round(x * 1e6) / 1e6 + 0.0``:
rounding the same IEEE product to an integer agrees between Spark and DuckDB, and
``+ 0.0`` folds -0.0 into 0.0).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .sqltext import book_cte

#: Decimals by the kind of a column.
DECIMALS = {"d": 6, "e": 9}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    spec: str
    sql: str | None = None      # body over the ``book`` CTE (and ``events``)

    def columns(self) -> list[tuple[str, int | None]]:
        """Names with the decimals they are settled to (None: as they are)."""
        parts = (tok.partition(":") for tok in self.spec.split())
        return [(name, DECIMALS.get(kind)) for name, _, kind in parts]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return settle(self.build(spark, sf_dir), self.columns())

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        cols = ", ".join(settle_sql(n, d) if d else n for n, d in self.columns())
        return f"WITH {book_cte()}\nSELECT {cols}\nFROM (\n{self.sql}\n) q"


def settle_col(name: str, decimals: int = 6) -> Column:
    c, scale = F.col(name).cast("double"), F.lit(float(10 ** decimals))
    return (F.round(c * scale, 0) / scale + F.lit(0.0)).alias(name)


def settle(df: DataFrame, cols: list[tuple[str, int | None]]) -> DataFrame:
    return df.select(*[settle_col(n, d) if d else F.col(n) for n, d in cols])


def settle_sql(name: str, decimals: int = 6) -> str:
    s = f"CAST({10 ** decimals} AS DOUBLE)"
    return f"round(CAST({name} AS DOUBLE) * {s}) / {s} + CAST(0 AS DOUBLE) AS {name}"


REGISTRY: dict[str, Query] = {}


def register(name: str, spec: str, sql: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, spec, sql)
        return fn
    return deco
