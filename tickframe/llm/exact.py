"""Exact dedup by progressive refinement.

Rows are grouped by text length, then by the hash of a short prefix, and only
rows whose (length, prefix hash) is shared by another row have their whole
text hashed. Every step is a count with map-side combine joined back to rows,
so a group of copies that holds a third of the rows is split by the adaptive
skew join and is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from .common import unused

PREFIX_CHARS = 64


def _norm(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def prefix_hash(text_col: str, prefix_chars: int = PREFIX_CHARS) -> Column:
    return F.xxhash64(F.substring(_norm(text_col), 1, prefix_chars))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One row per distinct (id, text): ``id, keep_id, group_size, kept``, the
    row's ``n_rows``, ``text_len``, ``prefix_hash`` and, where the whole text had to
    be read, ``full_hash``.

    Of equal texts the largest id stays. A null text counts as empty. Repeated
    rows with one id and one text are one document (``group_size`` counts every
    row). A null id loses to any other id; a group with null ids only keeps
    null. An empty table gives an empty result; other columns are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), _norm(text_col).alias("t"))
    keyed = src.select(F.octet_length("t").alias("text_len"),
                       prefix_hash("t", prefix_chars).alias("prefix_hash"),
                       "id", "t")
    # rounds 1 and 2: lengths held by several rows, then prefixes within them
    lens = (keyed.groupBy("text_len").agg(F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("text_len"))
    pairs = scratch_table(
        keyed.select("text_len", "prefix_hash").join(lens, "text_len", "left_semi")
        .groupBy("text_len", "prefix_hash").agg(F.count(F.lit(1)).alias("n_pair"))
        .filter("n_pair > 1"), "exact-pairs")
    # round 3: the whole text is hashed only in surviving pairs
    rows = scratch_table(
        keyed.join(pairs, ["text_len", "prefix_hash"], "left")
        .select("id", "text_len", "prefix_hash",
                F.when(F.col("n_pair").isNotNull(), F.sha2("t", 256)).alias("full_hash"))
        .groupBy("id", "text_len", "prefix_hash", "full_hash")
        .agg(F.count(F.lit(1)).alias("n")), "exact-rows")
    alone = rows.filter("full_hash IS NULL").select(
        "id", F.col("id").alias("keep_id"), F.col("n").alias("group_size"), F.col("n").alias("n_rows"),
        "text_len", "prefix_hash", "full_hash")
    multi = rows.filter("full_hash IS NOT NULL")
    groups = (multi.groupBy("text_len", "full_hash")
              .agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size")))
    grouped = multi.join(groups, ["text_len", "full_hash"]).select(
        "id", "keep_id", "group_size", F.col("n").alias("n_rows"), "text_len", "prefix_hash", "full_hash")
    return (alone.unionByName(grouped)
            .withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))
            .withColumnRenamed("id", id_col))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever their names.

    Of equal texts (a null text counts as empty) the row with the largest id stays, of
    rows that repeat that id and text one; a null id stays only among null ids. An empty
    table gives an empty one."""
    key, id_, size, pre, full, n = unused(docs, "_key", "_id", "_len", "_pre", "_hash", "_n")
    keep = (exact_groups(docs, id_col, text_col).filter("kept")
            .select(F.col(id_col).alias(id_), F.col("text_len").alias(size), F.col("prefix_hash").alias(pre),
                    F.col("full_hash").alias(full), F.col("n_rows").alias(n)))
    t = _norm(text_col)
    # a row's own id finds its verdict; length and hashes tell texts of one id apart
    hit = docs.withColumn(key, F.col(id_col)).join(
        keep, F.col(key).eqNullSafe(F.col(id_)) & (F.octet_length(t) == F.col(size))
        & (prefix_hash(text_col) == F.col(pre)))
    hit = hit.filter(F.col(full).isNull() | (F.sha2(t, 256) == F.col(full)))
    if keep.filter(F.col(n) > 1).isEmpty():
        return hit.select(docs.columns)
    return hit.dropDuplicates([key, size, pre, full]).select(docs.columns)
