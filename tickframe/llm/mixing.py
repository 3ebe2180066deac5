"""Mixing sources to target weights by systematic sampling.

Within a source every document has the same expected number of copies
``r = target / size``. Documents are put in one fixed order, the expected
copies are prefix-summed, one random offset per source is added, and a
document is emitted once for every integer the running sum crosses. The order
goes by size, which spreads the draws evenly over short and long documents,
so the words taken come near the target.

The prefix sum never gathers a source: rows are counted per (source, size
class, salt), an exclusive running sum over that small table gives offsets,
and ``row_number`` runs inside one such cell.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_table
from .common import count_words

#: Up to this many sources their table is broadcast; beyond it is joined.
BROADCAST_SOURCES = 100_000


def source_targets(sized: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``source, source_size, target``: one row per source.

    Weights repeat over the sources by code point, null last. Together the
    targets make ``share`` of all words; a target stops at ``most`` times its
    source and the excess is shared again by weight until none is above. A
    source is capped exactly if its cap per weight is at most the level that
    the uncapped ones get, so ordering sources by cap per weight finds the level
    in one pass. The windows run over one row per source.
    """
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    pos = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (pos % F.lit(len(weights)) + 1).cast("int"))
    s = s.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_need = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    s = (s.withColumn("left", F.sum("source_size").over(whole) * F.lit(float(share))
                      - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("w_left", F.sum("w").over(whole)
                     - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
         .withColumn("level", F.col("left") / F.col("w_left"))
         .withColumn("free", F.col("cap") > F.col("level") * F.col("w")))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("w"), F.col("level")))).over(whole)
    s = s.withColumn("lv", level)
    return s.select("source", "source_size",
                    F.when(F.col("lv").isNull(), F.col("cap"))
                    .otherwise(F.least(F.col("cap"), F.col("lv")["level"] * F.col("w"))).alias("target"))


def _digest(value: Column, at: int, digits: int) -> Column:
    return F.conv(F.substring(F.md5(value), at, digits), 16, 10).cast("bigint")


def _drawn(docs: DataFrame, weights, share, most, seed, salts, id_col, source_col, text_col,
           keep: Sequence[str]) -> DataFrame:
    idt = F.coalesce(F.col("_id").cast("string"), F.lit("null"))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
                       count_words(F.col(text_col)).alias("size"),
                       *[F.col(c).alias(f"_k_{c}") for c in keep])
    targets = scratch_table(source_targets(rows, weights, share, most), "mix-targets")
    small = targets.count() <= BROADCAST_SOURCES
    # a size class: the number of bits of the size and its leading four bits
    cls = F.expr("length(bin(size)) * 16 + shiftright(size, greatest(length(bin(size)) - 4, 0))")
    cells = rows.withColumn("cls", cls).withColumn("salt", _digest(idt, 1, 8) % salts)
    per_cell = cells.groupBy("source", "cls", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("cls", "salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_cell.select(F.col("source").alias("o_s"), F.col("cls").alias("o_c"),
                              F.col("salt").alias("o_t"),
                              F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    t = targets.select(F.col("source").alias("t_s"), "source_size", "target")
    inside = Window.partitionBy("source", "cls", "salt").orderBy("size", F.md5(idt), "_id")
    ranked = cells.withColumn("rn", F.row_number().over(inside))
    ranked = ranked.join(offsets, F.col("source").eqNullSafe(F.col("o_s")) & (F.col("cls") == F.col("o_c"))
                         & (F.col("salt") == F.col("o_t")))
    ranked = ranked.join(F.broadcast(t) if small else t, F.col("source").eqNullSafe(F.col("t_s")))
    r = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    u = _digest(F.concat(F.lit(f"{seed}/"), F.coalesce(F.col("source"), F.lit("null"))), 1, 8) / F.lit(2.0 ** 32)
    rank = (F.col("off") + F.col("rn")).cast("double")
    copies = F.floor(r * rank + u) - F.floor(r * (rank - F.lit(1.0)) + u)
    return ranked.withColumn("copies", copies.cast("bigint"))


def mix_copies(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5,
               most: float = 2.0, seed: str = "mix", salts: int = 32, id_col: str = "doc_id",
               source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``id, source, size, source_size, target, copies`` for every row.

    A null text has size 0, a null source is a source. Ties (equal sizes) are
    ordered by the md5 of the id, then by id; repeated rows are drawn for one
    by one. A null id hashes like ``null``. A source without words gets target
    0 and no copies. An empty table gives no rows; other columns are not read.
    """
    d = _drawn(docs, weights, share, most, seed, salts, id_col, source_col, text_col, ())
    return d.select(F.col("_id").alias(id_col), "source", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: str = "mix", salts: int = 32, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text") -> DataFrame:
    """The mixed corpus: every row of ``docs``, all columns, as often as it was
    drawn, with a 1-based ``copy`` number (an own column ``copy`` is replaced)."""
    cols = [c for c in docs.columns if c != "copy"]
    d = _drawn(docs, weights, share, most, seed, salts, id_col, source_col, text_col, cols)
    return d.filter("copies > 0").select(
        *[F.col(f"_k_{c}").alias(c) for c in cols],
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
