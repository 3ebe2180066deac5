"""Prefix trie of conversations: splitter paths and a skeleton.

A conversation is a path: ``TOKEN`` bytes a turn, so equal turns have equal tokens and
paths that share their first turns share their first bytes.

1. Conversations of one path become one row (``MEMBERS`` ids at most; more ids make
   more rows), so a conversation that is copied a million times is a few rows.
2. Splitters, taken from a bounded sample of the paths, cut the order of all paths into
   ranges. They and their prefixes are the skeleton, which is broadcast. A node whose
   paths lie in more than one range is a prefix of a splitter, so every other node
   is whole within one range.
3. Each range is sorted and streamed through a stack of the open path: nodes outside the
   skeleton are finished there, skeleton nodes leave partial aggregates.
4. Partial aggregates are reduced per skeleton node and rolled up the skeleton, whose
   size follows from the number of splitters.

The sample only places the cuts; results do not depend on it.
"""

from __future__ import annotations

import math
from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_table
from .common import shuffle_width

#: Bytes of a turn in a path: 16 of its SHA-256, then 8 of the length of its text.
TOKEN = 24
#: log2 of the ids that one row of a path holds at most.
MEMBERS_BITS = 16
#: Turns of a sampled path that may become a splitter.
SPLITTER_TURNS = 64
SAMPLES_PER_SHARD = 8

PARTS = ("skel int, conv_id bigint, depth bigint, parent_skel int, parent_conv_id bigint, n_convs bigint, "
         "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string")
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turn_token(role: Column, text: Column) -> Column:
    """Hex of a turn's token."""
    size = F.octet_length(text).cast("bigint")
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.concat(F.substring(F.sha2(told, 256), 1, 32), F.lower(F.lpad(F.hex(size), 16, "0")))


def conversation_turns(rows: DataFrame, by: Column, conv_id: str = "conv_id", turn: str = "turn",
                       role: str = "role", text: str = "text") -> DataFrame:
    """``near, conv_id, turns``: per conversation its tokens by turn, null turns first, rows
    of one turn by role and then by token. Null roles and texts are empty; rows without a
    conversation id belong to none and are left out. Rows are dealt by ``by``, a function
    of the id, under the name ``near``. Texts are hashed where they are read; a
    conversation's tokens lie in one row."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    slim = rows.filter(F.col(conv_id).isNotNull()).select(
        by.alias("near"), F.col(conv_id).cast("bigint").alias("conv_id"),
        F.struct(F.col(turn).isNotNull().alias("told"), F.col(turn).alias("turn"), r.alias("role"),
                 turn_token(r, t).alias("token")).alias("row"))
    return (slim.repartition("near").groupBy("near", "conv_id")
            .agg(F.sort_array(F.collect_list("row")).alias("rows"))
            .select("near", "conv_id", F.col("rows.token").alias("turns")))


def path(turns: Column) -> Column:
    return F.unhex(F.array_join(turns, ""))


def _splitters(sample: list[bytes], shards: int) -> list[bytes]:
    """Up to ``shards - 1`` cuts at even steps of the sorted sample, each the shortest path
    that lies between a sampled path and the one before it."""
    sample = sorted(set(sample))
    cuts = set()
    for i in range(1, shards):
        k = i * len(sample) // shards
        if k:
            a, s = sample[k - 1], sample[k]
            n = 0
            while a[n:n + TOKEN] == s[n:n + TOKEN]:
                n += TOKEN
            cuts.add(s[:n + TOKEN])
    return sorted(cuts)


def _skeleton(cuts: list[bytes]) -> tuple[dict, list]:
    """``{(parent, token): node}`` and per node ``(parent, depth, bytes of the last text)``;
    node 0 is the root, parents come before children."""
    step, nodes = {}, [(-1, 0, 0)]
    for c in cuts:
        at = 0
        for i in range(0, len(c), TOKEN):
            token = c[i:i + TOKEN]
            if (at, token) not in step:
                step[at, token] = len(nodes)
                nodes.append((at, i // TOKEN + 1, int.from_bytes(token[16:], "big")))
            at = step[at, token]
    return step, nodes


class _Open:
    """A node of the open path."""
    __slots__ = ("skel", "token", "low", "n", "kids", "leaves", "saved", "sha", "waiting")

    def __init__(self, skel, token):
        self.skel, self.token, self.low, self.n = skel, token, None, 0
        self.kids = self.leaves = self.saved = 0
        self.sha, self.waiting = None, []

    def take(self, low, n):
        self.low = low if self.low is None else min(self.low, low)
        self.n += n


def _walk(rows, step: dict):
    """Rows of ``PARTS`` from the sorted ``(path, n, low, ids)`` of one range."""
    import hashlib
    nothing = hashlib.sha256(b"").hexdigest()
    stack = []

    def close():
        f, depth = stack.pop(), len(stack)
        ends = f.sha.hexdigest() if f.sha else None
        if f.skel is not None:
            return [(f.skel, f.low, depth, None, None, f.n, f.kids, f.leaves, f.saved, ends)]
        up = stack[-1]
        f.leaves = f.leaves or 1
        f.saved += (f.n - 1) * int.from_bytes(f.token[16:], "big")
        out = [(*r[:4], f.low, *r[5:]) for r in f.waiting]
        own = (None, f.low, depth, up.skel, None, f.n, f.kids, f.leaves, f.saved, ends or nothing)
        (out if up.skel is not None else up.waiting).append(own)
        up.take(f.low, f.n)
        up.kids, up.leaves, up.saved = up.kids + 1, up.leaves + f.leaves, up.saved + f.saved
        return out

    for p, n, low, ids in rows:
        if not stack:
            stack.append(_Open(0, b""))
        turns = len(p) // TOKEN
        same = 0
        while same < turns and same + 1 < len(stack) and stack[same + 1].token == p[same * TOKEN:(same + 1) * TOKEN]:
            same += 1
        while len(stack) > same + 1:
            yield from close()
        for i in range(same, turns):
            token, up = p[i * TOKEN:(i + 1) * TOKEN], stack[-1]
            stack.append(_Open(None if up.skel is None else step.get((up.skel, token)), token))
        top = stack[-1]
        top.take(low, n)
        if top.sha is None:
            top.sha = hashlib.sha256(ids)
        else:
            top.sha.update(b"," + ids)
    while stack:
        yield from close()


def _roll_up(nodes: list, partial: dict) -> list[tuple]:
    """Rows ``(skel, *NODE)`` of the skeleton from its reduced partial aggregates."""
    import hashlib
    nothing = hashlib.sha256(b"").hexdigest()
    n, kids, leaves, saved = ([0] * len(nodes) for _ in range(4))
    low, ends = [math.inf] * len(nodes), [nothing] * len(nodes)
    for k in range(len(nodes) - 1, -1, -1):  # children before parents
        up, _, size = nodes[k]
        if p := partial.get(k):
            n[k] += p["n"]
            kids[k] += p["kids"]
            leaves[k] += p["leaves"]
            saved[k] += p["saved"]
            low[k] = low[k] if p["low"] is None else min(low[k], p["low"])
            ends[k] = p["ends"] or nothing
        leaves[k] = leaves[k] or 1
        saved[k] += (n[k] - 1) * size
        if up >= 0:
            n[up] += n[k]
            kids[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
            low[up] = min(low[up], low[k])
    return [(k, low[k], nodes[k][1], low[nodes[k][0]] if k else None, n[k], kids[k], leaves[k], saved[k], ends[k])
            for k in range(len(nodes))]


def prefix_trie(paths: DataFrame, rows_per_shard: int = 50_000) -> DataFrame:
    """One row per node of the trie of ``paths`` (``conv_id bigint, path binary``).

    A node is a distinct sequence of first turns; its members are the conversations that
    start with it. ``conv_id``: the smallest member, ``parent_conv_id``: the parent's (null
    for the root); ``n_convs``, ``n_children``; ``n_leaves``, childless nodes of its
    subtree, itself included; ``saved_tokens``, over its subtree the bytes of each node's
    last text for every member but one; ``ends_sha256``, digest of the comma-joined ids,
    ascending, of the members that end there. A conversation without turns ends at the
    root; no conversations have no nodes. A path is one row (``TOKEN`` bytes a turn)."""
    spark = paths.sparkSession
    own = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",")
    rows = (paths.groupBy("path", F.shiftright("conv_id", MEMBERS_BITS).alias("part"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), own.alias("ids")))
    rows = scratch_table(rows, "trie-paths")
    found = rows.count()
    if not found:
        return spark.createDataFrame([], PARTS).select(NODE)
    shards = min(found, max(shuffle_width(spark), math.ceil(found / rows_per_shard)))
    sample = (rows.select(F.substring("path", 1, SPLITTER_TURNS * TOKEN).alias("path"))
              .orderBy(F.xxhash64("path"), "path").limit(SAMPLES_PER_SHARD * shards))
    cuts = _splitters([bytes(r.path) for r in sample.collect()], shards)
    step, nodes = _skeleton(cuts)
    shared = spark.sparkContext.broadcast((cuts, step))

    def deal(batches):
        import pyarrow as pa
        for batch in batches:
            to = [bisect_right(shared.value[0], p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), *batch.columns],
                                             ["shard", *batch.schema.names])

    def walk(batches):
        import pyarrow as pa
        schema = pa.schema([("skel", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                            ("parent_skel", pa.int32()), *[(c, pa.int64()) for c in
                            ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
                            ("ends_sha256", pa.string())])

        def read():
            for b in batches:
                yield from zip(b.column("path").to_pylist(), b.column("n").to_pylist(),
                               b.column("low").to_pylist(), (i.encode() for i in b.column("ids").to_pylist()))

        def pack(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        out = []
        for row in _walk(read(), shared.value[1]):
            out.append(row)
            if len(out) >= 8192:
                yield pack(out)
                out = []
        if out:
            yield pack(out)

    dealt = rows.select("path", "part", "n", "low", "ids").mapInArrow(
        deal, "shard int, path binary, part bigint, n bigint, low bigint, ids string")
    local = (dealt.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("path", "part")
             .mapInArrow(walk, PARTS))
    local = scratch_table(local, "trie-nodes")
    reduced = local.filter("skel IS NOT NULL").groupBy("skel").agg(
        F.sum("n_convs").alias("n"), F.min("conv_id").alias("low"), F.sum("n_children").alias("kids"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("ends_sha256").alias("ends"))
    rolled = _roll_up(nodes, {r.skel: r for r in reduced.collect()})
    top = spark.createDataFrame(rolled, "at int, " + ", ".join(
        f"{c} {'string' if c == 'ends_sha256' else 'bigint'}" for c in NODE))
    up = top.select(F.col("at"), F.col("conv_id").alias("up_conv_id"))
    rest = (local.filter("skel IS NULL").join(F.broadcast(up), F.col("parent_skel") == F.col("at"), "left")
            .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_conv_id")))
    return rest.select(NODE).unionByName(top.select(NODE))
