"""SimHash near-dedup with pigeonring filtering.

A fingerprint of 64 bits is cut into ``radius + 1`` segments on a ring. If two
fingerprints differ in at most ``radius`` bits, there is a segment from which
every chain of ``l`` consecutive segments differs in at most
``l * radius / (radius + 1)`` bits: none in the first, at most one in the first
two, and so on (the proportional budgets). Candidates are found by a join on a
chain's first two segments, one side with every single-bit change of the
second; longer chains are tested on the pair, before the full Hamming check.

Equal fingerprints are one node, so copies are never paired.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from . import kernels
from .common import unused
from .graph import components

BITS = 64


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id, fp`` (64 bits as a signed long) of every whole text; null is empty."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        import xxhash
        hash64 = xxhash.xxh64_intdigest
        for batch in batches:
            raw, offs = kernels.texts(batch.column(1))
            parts = []
            for a, b in kernels.slices(offs):
                at = offs[a:b + 1]
                parts.append(kernels.shingle_fingerprints(raw[at[0]:at[-1]], at - at[0], shingle,
                                                          lambda s: hash64(s, seed)))
            for (a, b), fp in zip(kernels.slices(offs), parts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(fp.view("int64"))], ["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"id {kind}, fp bigint")


def segments(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of each of ``radius + 1`` segments of nearly equal width."""
    m = radius + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def near_pairs(fps: DataFrame, radius: int = 2) -> DataFrame:
    """``u, v`` (u < v): all distinct fingerprints of column ``fp`` that differ in
    at most ``radius`` bits."""
    if radius < 1:
        return fps.select(F.col("fp").alias("u"), F.col("fp").alias("v")).limit(0)
    segs = segments(radius)
    m = len(segs)
    nodes = fps.select("fp").distinct()
    index, probe = [], []
    for i, (s, w) in enumerate(segs):
        s2, w2 = segs[(i + 1) % m]
        head = [F.lit(i).alias("ring"), _segment(F.col("fp"), s, w).alias("a")]
        second = _segment(F.col("fp"), s2, w2)
        index.append(F.struct(*head, second.alias("b")))
        probe += [F.struct(*head, second.bitwiseXOR(F.lit(x)).alias("b"))
                  for x in [0, *(1 << j for j in range(w2))]]
    left = nodes.select(F.col("fp").alias("u"), F.explode(F.array(*index)).alias("k")).select("u", "k.*")
    right = nodes.select(F.col("fp").alias("v"), F.explode(F.array(*probe)).alias("k")).select("v", "k.*")
    # the planner sizes what is exploded like its input: a side of some 70 rows a
    # fingerprint passed for small, and was broadcast
    pair = left.join(right.hint("merge"), ["ring", "a", "b"]).filter("u < v")
    diff = F.col("u").bitwiseXOR(F.col("v"))
    d = [F.bit_count(_segment(diff, s, w)) for s, w in segs]
    chains = None
    for i in range(m):
        ok = reduce(lambda x, y: x & y, [
            reduce(lambda x, y: x + y, [d[(i + j) % m] for j in range(length)]) <= F.lit(length * radius // m)
            for length in range(2, m + 1)])
        chains = F.when(F.col("ring") == i, ok) if chains is None else chains.when(F.col("ring") == i, ok)
    return pair.filter(chains).filter(F.bit_count(diff) <= radius).select("u", "v").distinct()


def near_groups(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, component_id``: one row per row of ``docs``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked;
    ``component_id`` is the smallest id reachable, itself included. Documents
    without words share fingerprint zero and are linked like any other. Null ids
    are never the smallest (null if a component has no other). Repeated rows stay
    rows. An empty table gives no rows; other columns are not read.
    """
    fps = scratch_table(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    roots = components(near_pairs(fps, radius))
    node = fps.groupBy("fp").agg(F.min("id").alias("rep"))
    node = node.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "rep", F.coalesce("root", "fp").alias("root"))
    node = scratch_table(node, "nodes")
    comp = node.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = node.join(comp, "root").select("fp", "component_id")
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, radius: int = 2, seed: int = 42,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, all columns, whatever
    their names. Null texts and texts without words share fingerprint zero and are near
    copies of each other. Rows that repeat that id stay; a component of null ids stays
    whole. An empty table gives an empty one."""
    name, = unused(docs, "_keep")
    keep = near_groups(docs, shingle, radius, seed, id_col, text_col).filter(
        F.col(id_col).eqNullSafe(F.col("component_id"))).select(F.col(id_col).alias(name)).distinct()
    return docs.join(keep, F.col(id_col).eqNullSafe(F.col(name)), "left_semi")
