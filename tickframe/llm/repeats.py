"""Substring dedup over words (suffix automata) and over bytes (run-length index).

1. Equal texts are told by their digest and stand for one: a copy is covered from end to
   end, so only one row of each text takes part in what follows.
2. Every row's windows are reduced to anchors: equal windows hold equal anchors
   (see ``matching``). Anchors travel as packed arrays to hash buckets, which find
   those that are shared.
3. Rows get their shared anchors back (a join on the id) and cut out the stretches
   around them. A stretch goes to the shard of its anchor, so all rows that share a
   window meet in a shard, and only they do.
4. A shard builds its reference, every repeated window once, and the reference's
   index (suffix automaton or run-compressed BWT), and streams its stretches for
   matching statistics. These verify windows exactly; hashes only propose them.
5. Covered spans return to their rows (a join on the same exchange of the texts).

Shards replace sending every reference shard to every document, whose cost is the
product of both: a reference that grows with the corpus has no size bound for a
broadcast. Partitions, buckets and shards are sized by the bytes of the texts.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_table
from . import kernels, matching
from .common import shuffle_width

#: Stands for a null id: later than any other.
LAST = (1 << 63) - 1
#: Bytes of text of a partition, whose anchors make up a bucket.
PARTITION_BYTES = 16 << 20
SHARDS_PER_PARTITION = 8


def _spans(docs: DataFrame, kind, by_id: bool, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows by internal key, with ``whole`` on those that a copy covers, and ``id,
    found``: per id its rows' covered spans."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("id"),
                      F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("tag"), text.alias("text"))
    seen = Observation()
    told = src.observe(seen, F.sum(F.octet_length("text")).alias("bytes"))
    groups = told.groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least")).filter("n > 1")
    groups = scratch_table(groups.select("tag", "least"), "equal-texts")
    size = 0 if src.isEmpty() else seen.get["bytes"]        # nothing is observed of an empty table
    width = max(shuffle_width(docs.sparkSession), math.ceil(size / PARTITION_BYTES))
    shards = SHARDS_PER_PARTITION * width
    equal = (src.select("id", "tag").join(groups, "tag").groupBy("id")
             .agg(F.collect_set(F.struct("tag", "least")).alias("equal")))
    copy = F.coalesce(F.exists("equal", lambda x: (x["tag"] == F.col("tag")) & (x["least"] < F.col("id"))), F.lit(False))
    held = F.coalesce(F.exists("equal", lambda x: x["tag"] == F.col("tag")), F.lit(False))
    by_key = src.repartition(width, "id").join(equal, "id", "left").select(
        "id", "tag", "text", copy.alias("copy"), (copy if by_id else held).alias("whole"))
    single = by_key.filter(~F.col("copy"))
    most = 1 if by_id else 2

    def emit(batches):
        import pyarrow as pa
        for batch in batches:
            raw, offs = kernels.texts(batch.column(1))
            ids = batch.column(0).to_numpy()
            for a, b in kernels.slices(offs):
                at = offs[a:b + 1]
                rows = list(matching.anchor_blobs(kind, raw[at[0]:at[-1]], at - at[0], ids[a:b], width, most))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))],
                        ["bucket", "ids", "counts", "keys", "places"])

    def share(table):
        import numpy as np
        import pyarrow as pa
        ids, keys, places = [], [], []
        for i, c, k, p in zip(*(table.column(n).to_pylist() for n in ("ids", "counts", "keys", "places"))):
            ids.append(np.repeat(np.frombuffer(i, np.int64), np.frombuffer(c, np.int32)))
            keys.append(matching.unpack(k))
            places.append(matching.unpack(p, matching.PLACE_BYTES).astype(np.int64))
        bucket = table.column("bucket")[0].as_py()
        rows = list(matching.shared_anchors(kind, *map(np.concatenate, (ids, keys, places)), by_id, shards, width))
        cols = list(zip(*rows)) if rows else [(), (), (), ()]
        return pa.table({"part": pa.array(cols[0], pa.int32()), "bucket": pa.array([bucket] * len(rows), pa.int32()),
                         "ids": pa.array(cols[1], pa.binary()), "keys": pa.array(cols[2], pa.binary()),
                         "shards": pa.array(cols[3], pa.binary())})

    def gather(table):
        import pyarrow as pa
        rows = list(matching.by_row(list(zip(*(table.column(n).to_pylist()
                                               for n in ("bucket", "ids", "keys", "shards"))))))
        cols = list(zip(*rows))
        return pa.table({"id": pa.array(cols[0], pa.int64()), "names": pa.array(cols[1], pa.binary()),
                         "shards": pa.array(cols[2], pa.binary())})

    blobs = single.select("id", "text").mapInArrow(
        emit, "bucket int, ids binary, counts binary, keys binary, places binary")
    shared = blobs.groupBy("bucket").applyInArrow(
        share, "part int, bucket int, ids binary, keys binary, shards binary")
    known = shared.groupBy("part").applyInArrow(gather, "id bigint, names binary, shards binary")

    def cut(batches):
        import pyarrow as pa
        for batch in batches:
            raw, offs = kernels.texts(batch.column(2))
            for a, b in kernels.slices(offs):
                at = offs[a:b + 1]
                rows = list(matching.segments(kind, raw[at[0]:at[-1]], at - at[0],
                                              batch.column(3).slice(a, b - a).to_pylist(),
                                              batch.column(4).slice(a, b - a).to_pylist(), width))
                if rows:
                    s, r, first, body = zip(*rows)
                    r = pa.array([a + x for x in r])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(s, pa.int32()), batch.column(0).take(r), batch.column(1).take(r),
                         pa.array(first, pa.int64()), pa.array(body, pa.binary())],
                        ["shard", "id", "tag", "first", "body"])

    pieces = single.join(known, "id").select("id", "tag", "text", "names", "shards").mapInArrow(
        cut, "shard int, id bigint, tag binary, first bigint, body binary")

    def match(table):
        import numpy as np
        import pyarrow as pa
        table = table.combine_chunks()
        ids, first = (table.column(n).to_numpy() for n in ("id", "first"))
        tags = table.column("tag")
        found = matching.covered_stretches(kind, table.column("body").to_pylist(), ids, first, by_id)
        rows = [(ids[s], tags[s].as_py(), lo.astype(np.int64).tobytes(), hi.astype(np.int64).tobytes())
                for s, lo, hi in found]
        cols = list(zip(*rows)) if rows else [(), (), (), ()]
        return pa.table({"id": pa.array(cols[0], pa.int64()), "tag": pa.array(cols[1], pa.binary()),
                         "begins": pa.array(cols[2], pa.binary()), "ends": pa.array(cols[3], pa.binary())})

    spans = pieces.groupBy("shard").applyInArrow(match, "id bigint, tag binary, begins binary, ends binary")
    found = spans.groupBy("id").agg(F.collect_list(F.struct("tag", "begins", "ends")).alias("found"))
    return by_key, found


def _apply(docs: DataFrame, kind, by_id: bool, id_col: str, text_col: str, kept_type: str) -> DataFrame:
    by_key, found = _spans(docs, kind, by_id, id_col, text_col)

    def remove(batches):
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            raw, offs = kernels.texts(batch.column(2))
            tags, whole = batch.column(1).to_pylist(), batch.column(4).to_pylist()
            for a, b in kernels.slices(offs):
                at = offs[a:b + 1]
                data = raw[at[0]:at[-1]]
                row, starts, ends = kind.places(data, at - at[0])
                size = np.bincount(row, minlength=b - a) if len(row) else np.zeros(b - a, np.int64)
                begin = np.cumsum(size) - size
                kept, removed, spans = [], [], []
                for r, got in enumerate(batch.column(3).slice(a, b - a).to_pylist()):
                    mine = [(np.frombuffer(x["begins"], np.int64), np.frombuffer(x["ends"], np.int64))
                            for x in got or () if x["tag"] == tags[a + r]]
                    if whole[a + r] and size[r] >= kind.n:
                        mine = [(np.zeros(1, np.int64), size[r:r + 1])]
                    lo, hi = matching.union(mine) if mine else (np.zeros(0, np.int64),) * 2
                    s, e = starts[begin[r]:begin[r] + size[r]], ends[begin[r]:begin[r] + size[r]]
                    kept.append(kind.keep(data, s, e, lo, hi))
                    removed.append(int((hi - lo).sum()))
                    spans.append([{"first": int(x), "length": int(y - x)} for x, y in zip(lo, hi)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(size.astype(np.int64)), pa.array(removed, pa.int64()),
                     pa.array(kept, pa.binary()).cast(pa.string() if kept_type == "string" else pa.binary()),
                     pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("length", pa.int64())])))],
                    ["id", "n", "n_removed", "kept", "spans"])

    both = by_key.join(found, "id", "left").select("id", "tag", "text", "found", "whole")
    out = both.mapInArrow(remove, f"id bigint, n bigint, n_removed bigint, kept {kept_type}, "
                                  "spans array<struct<first:bigint,length:bigint>>")
    kind_id = docs.schema[id_col].dataType
    return out.withColumn("id", F.when(F.col("id") != LAST, F.col("id")).cast(kind_id)).withColumnRenamed("id", id_col)


def remove_repeated_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, n_removed, kept, spans``, one row per row of ``docs``: its words, those
    removed, the kept words joined by one space and the maximal removed spans (first
    word and length).

    A word is removed if it lies in 35 consecutive words of its text whose sequence
    also starts anywhere else in the table, the same text included. Ids are integers.
    Null texts are empty. A row repeated with its id and text is another place, so
    both lose what they share. Null ids are told apart by their texts. Empty tables
    give no rows; extra columns are not read.
    """
    return _apply(docs, matching.Words, False, id_col, text_col, "string")


def remove_repeated_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n, n_removed, kept, spans``, one row per row of ``docs``: its UTF-8 bytes,
    those removed, the remaining bytes and the maximal removed spans.

    A byte is removed if it lies in a 50-byte string that also starts in a row with a
    smaller id. Ids are integers; a null id is larger than any other, and rows with
    equal ids do not count against each other. Null texts are empty. Empty tables
    give no rows; extra columns are not read.
    """
    return _apply(docs, matching.Bytes, True, id_col, text_col, "binary")
