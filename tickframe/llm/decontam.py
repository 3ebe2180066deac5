"""Benchmark decontamination.

Every window of a document that has as many words as a benchmark item gets a
SimHash over its words; a document with fewer words is one window. Cutting it into blocks, a multi-index finds all item
fingerprints within the Hamming radius (two fingerprints within ``radius`` bits
agree in some block up to ``radius // blocks`` bits; every value that near is
listed). The exact weighted-shingle similarity of window and item decides.
Windows that hold too few shingles of any item to be similar enough are skipped.

Items are broadcast in blocks of bounded size, so a benchmark of any size is
searched with bounded memory, one pass over the documents for each block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 15, 4
#: Items and bytes of one broadcast block.
BLOCK_ITEMS, BLOCK_BYTES = 5_000, 8 << 20


def _blocks(items: DataFrame, id_col: str, text_col: str):
    """Lists of (id, text), each within the bounds of one broadcast."""
    block, size = [], 0
    for key, text in items.select(id_col, text_col).orderBy(id_col, text_col).toLocalIterator():
        n = len(text or "")
        if block and (len(block) >= BLOCK_ITEMS or size + n > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((key, text))
        size += n
    if block:
        yield block


def find_leaks(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY,
               radius: int = RADIUS, blocks: int = BLOCKS, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``id, item_id, n_windows, similarity, first_word``: one row per document row
    and item that a window of the document repeats; the best window's similarity
    and its first word (the earliest of equals).

    Words are runs without space and ASCII punctuation, A-Z lower-cased. An item
    shorter than ``shingle`` words is one shingle; a document with fewer words than
    an item is compared as a whole; an item without words leaks
    nowhere; null texts are empty. Repeated rows with one id give one row, items
    repeated with one id likewise. Empty tables give no rows; extra columns are not
    read.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    item_type = items.schema[item_id].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {id_type}, item {item_type}, first_word bigint, similarity double"

    def searcher(shared):
        def run(batches):
            import pyarrow as pa
            index = kernels.ItemIndex.of(shared.value)
            for batch in batches:
                raw, offs = kernels.texts(batch.column(1))
                rows, who, first, sim = [], [], [], []
                for a, b in kernels.slices(offs):
                    at = offs[a:b + 1]
                    data, rel = raw[at[0]:at[-1]], at - at[0]
                    found = list(index.search(data, rel))
                    if found:
                        n_words = kernels.word_hashes(data, rel)[1]
                        for r, i, w, s in found:
                            rows.append(a + r)
                            who.append(index.ids[i])
                            first.append(w - int(n_words.searchsorted(r)))
                            sim.append(s)
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(rows)), pa.array(who, item_pa), pa.array(first, pa.int64()),
                         pa.array(sim, pa.float64())], ["id", "item", "first_word", "similarity"])
        return run

    from pyspark.sql.pandas.types import to_arrow_type
    item_pa = to_arrow_type(items.schema[item_id].dataType)
    parts = [src.mapInArrow(searcher(spark.sparkContext.broadcast(
        kernels.ItemIndex(b, shingle, radius, blocks, least).state)), schema) for b in _blocks(items, item_id, item_text)]
    if not parts:
        parts = [src.limit(0).selectExpr("id", f"cast(null as {item_type}) item", "0L first_word",
                                         "cast(0 as double) similarity")]
    hits = reduce(DataFrame.unionByName, parts)
    # windows per (document, item) are few and spread evenly: one combine
    best = F.max(F.struct("similarity", (-F.col("first_word")).alias("neg")))
    return hits.groupBy("id", "item").agg(
        F.countDistinct("first_word").alias("n_windows"), best.alias("b")).select(
        F.col("id").alias(id_col), F.col("item").alias(item_id), "n_windows",
        F.col("b.similarity").alias("similarity"), (-F.col("b.neg")).alias("first_word"))


def drop_leaks(docs: DataFrame, items: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY,
               radius: int = RADIUS, blocks: int = BLOCKS, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose own text repeats no item (see ``find_leaks``), all
    columns, whatever their names. Null and empty texts repeat nothing and stay; rows
    that repeat each other stay or go alike; an empty table gives an empty one. Rows
    are judged one by one, so nothing is shuffled."""
    sc = docs.sparkSession.sparkContext
    at = docs.columns.index(text_col)

    def keeper(shared):
        def run(batches):
            import pyarrow as pa
            index = kernels.ItemIndex.of(shared.value)
            for batch in batches:
                raw, offs = kernels.texts(batch.column(at))
                bad = {a + r for a, b in kernels.slices(offs)
                       for r, *_ in index.search(raw[offs[a]:offs[b]], offs[a:b + 1] - offs[a])}
                yield batch.filter(pa.array([r not in bad for r in range(batch.num_rows)], pa.bool_()))
        return run

    out = docs
    for block in _blocks(items, item_id, item_text):
        out = out.mapInArrow(keeper(sc.broadcast(kernels.ItemIndex(block, shingle, radius, blocks, least).state)),
                             docs.schema)
    return out
