"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of bytes other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of ``df`` has them (case does not tell apart)."""
    have, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in have:
            name += "_"
        out.append(name)
    return out


def count_words(text: Column) -> Column:
    """Number of words; null counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rows_of(batch, *names: str) -> Iterator[tuple]:
    """The named columns of an Arrow batch as Python tuples."""
    return zip(*(batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names))
