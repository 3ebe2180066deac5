"""Exact, near and substring dedup against brute force, and their defined edges."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tickframe.llm import exact, graph, matching, repeats, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept int"


def docs(spark, rows):
    """(doc_id, text) rows with the other columns of documents and clashing names."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1) for i, t in rows], SCHEMA)


def corpus(seed=5, n=60):
    rng = random.Random(seed)
    vocab = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(400)]
    shared = [" ".join(rng.choices(vocab, k=k)) for k in (34, 35, 36, 60, 200)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts.append(rng.choice(shared) if rng.random() < 0.4 else
                         " ".join(rng.choices(vocab, k=rng.randrange(0, 80))))
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(parts)))
    rows += [(100, None), (101, ""), (102, "  \n"), (103, rows[3][1]), (104, rows[3][1] + " tail"),
             (105, "la " * 500), (106, "x" * 4000), (107, "short"), (108, "x" * 49), (109, "x" * 50)]
    return rows


WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, n=35):
    toks = [WORD.findall(t or "") for _, t in rows]
    c = Counter(tuple(w[i:i + n]) for w in toks for i in range(len(w) - n + 1))
    out = []
    for (d, _), w in zip(rows, toks):
        gone = set()
        for i in range(len(w) - n + 1):
            if c[tuple(w[i:i + n])] > 1:
                gone.update(range(i, i + n))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def brute_bytes(rows, n=50):
    least = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            least[b[i:i + n]] = min(least.get(b[i:i + n], d), d)
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if least[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", bytes(gone))),
                    bytes(x for x, f in zip(b, gone) if not f)))
    return out


def test_words_match_brute_force(spark):
    rows = corpus()
    got = repeats.remove_repeated_words(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n, r.n_removed, r.kept) for r in got) == sorted(brute_words(rows))


def test_bytes_match_brute_force(spark):
    rows = corpus(8)
    got = repeats.remove_repeated_bytes(docs(spark, rows)).collect()
    assert sorted((r.doc_id, r.n, r.n_removed, len(r.spans), bytes(r.kept)) for r in got) == \
        sorted(brute_bytes(rows))


def test_hot_anchors_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(matching.Bytes, "load", 3)         # every anchor is dealt by itself
    monkeypatch.setattr(matching.Words, "load", 3)
    monkeypatch.setattr(matching, "AUTOMATON_WORDS", 50)   # and a shard needs several automata
    rows = corpus(9)
    assert sorted((r.doc_id, r.n, r.n_removed, r.kept) for r in
                  repeats.remove_repeated_words(docs(spark, rows)).collect()) == sorted(brute_words(rows))
    assert sorted((r.doc_id, r.n, r.n_removed, len(r.spans), bytes(r.kept)) for r in
                  repeats.remove_repeated_bytes(docs(spark, rows)).collect()) == sorted(brute_bytes(rows))


def stretches(kind, texts, buckets=4, shards=64):
    """Per shard the stretches that texts of ids 0.. send there, as (id, symbols)."""
    import numpy as np
    blobs, of_id = {}, {}
    for i, t in enumerate(texts):
        raw = np.frombuffer(t, np.uint8)
        for b, *rest in matching.anchor_blobs(kind, raw, np.array([0, len(raw)]), np.array([i]), buckets, 1):
            blobs.setdefault(b, []).append(rest)
    for b, rows in blobs.items():
        ids = np.concatenate([np.repeat(np.frombuffer(i, np.int64), np.frombuffer(c, np.int32)) for i, c, _, _ in rows])
        keys = np.concatenate([matching.unpack(k) for _, _, k, _ in rows])
        places = np.concatenate([matching.unpack(p, matching.PLACE_BYTES).astype(np.int64) for *_, p in rows])
        for _, i, k, s in matching.shared_anchors(kind, ids, keys, places, True, shards, buckets):
            for x, name, shard in zip(np.frombuffer(i, np.int64), matching.unpack(k), np.frombuffer(s, np.int32)):
                of_id.setdefault(int(x), []).append(((int(name) << 24) | b, int(shard)))
    out = {}
    for i, t in enumerate(texts):
        names = np.array([n for n, _ in of_id.get(i, [])], np.uint64).tobytes()
        where = np.array([s for _, s in of_id.get(i, [])], np.int32).tobytes()
        raw = np.frombuffer(t, np.uint8)
        for s, _, _, body in matching.segments(kind, raw, np.array([0, len(raw)]), [names], [where], buckets):
            out.setdefault(s, []).append((i, len(body)))
    return out


@pytest.mark.parametrize("kind", [matching.Bytes, matching.Words])
def test_stretches_are_linear_in_near_copies(kind):
    rng = random.Random(17)
    words = [f"w{rng.randrange(10**6)}" for _ in range(800)]
    per_copy = {}
    for copies in (30, 1000, 5000):
        texts = []
        for i in range(copies):
            own = list(words)
            for j in range(2):
                own[(i * 37 + 411 * j) % 800] = f"edit{i}x{j}"
            texts.append(" ".join(own).encode())
        found = stretches(kind, texts)
        per_copy[copies] = sum(map(len, found.values())) / copies
        # the stretches of a text are little longer than the text
        assert sum(n for rows in found.values() for _, n in rows) < 2 * sum(map(len, texts))
        assert len(found) > 1                                # and dealt over shards
    # a text of some 5,000 bytes has at most about 20 units, however many copies it has
    assert per_copy[1000] < 45 and per_copy[5000] < 45


def test_only_one_of_equal_texts_is_matched(spark):
    rng = random.Random(18)
    text = " ".join(f"w{rng.randrange(1000)}" for _ in range(200))
    rows = [(i, text) for i in range(400)] + [(1000, "another " + text), (1001, None), (1002, None)]
    for by_id, kind in ((True, matching.Bytes), (False, matching.Words)):
        by_key, _ = repeats._spans(docs(spark, rows), kind, by_id, "doc_id", "text")
        assert sorted(r.id for r in by_key.filter("NOT copy").collect()) == [0, 1000, 1001]
        assert by_key.filter("whole").count() == (400 if by_id else 402)
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeated_bytes(docs(spark, rows)).collect()}
    assert got[0] == 0 and got[399] == len(text.encode()) and got[1000] == len(text.encode())
    got = {r.doc_id: r.n_removed for r in repeats.remove_repeated_words(docs(spark, rows)).collect()}
    assert got[0] == got[399] == got[1000] == 200


def test_dealt_copies_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(matching.Bytes, "load", 500)
    monkeypatch.setattr(matching.Words, "load", 500)
    rng = random.Random(21)
    long = " ".join(rng.choices([f"w{i}" for i in range(300)], k=260))
    rows = [(i, long if i % 2 else long[:700] + f" edit{i} " + long[760:]) for i in range(9)]
    rows += [(20, " ".join(rng.choices([f"w{i}" for i in range(300)], k=100))), (21, long[300:600])]
    got = {r.doc_id: (r.n, r.n_removed) for r in repeats.remove_repeated_words(docs(spark, rows)).collect()}
    assert got == {d: (n, k) for d, n, k, _ in brute_words(rows)}
    got = {r.doc_id: (r.n, r.n_removed) for r in repeats.remove_repeated_bytes(docs(spark, rows)).collect()}
    assert got == {d: (n, k) for d, n, k, _, _ in brute_bytes(rows)}


def test_substrings_with_repeated_rows_and_null_ids(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(1, text), (1, text), (None, text), (None, None)]
    got = repeats.remove_repeated_words(docs(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n, r.n_removed) for r in got) == [(-1, 0, 0), (-1, 40, 40), (1, 40, 40),
                                                                       (1, 40, 40)]
    got = repeats.remove_repeated_bytes(docs(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in got) == [(-1, 0), (-1, len(text)), (1, 0), (1, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_run_index_gives_matching_statistics(seed):
    import numpy as np
    rng = random.Random(seed)
    ref = "\0".join("".join(rng.choices("ab", k=rng.randrange(5, 60))) for _ in range(8)) + "\0"
    text = np.array([0 if c == "\0" else ord(c) + 1 for c in ref])
    query = "".join(rng.choices("abc", k=300))
    q = np.array([ord(c) + 1 for c in query])
    most = 12
    got = {}
    for pos, size, at in matching.RunIndex(text).stream(q, np.array([0]), np.array([len(q)]), most):
        for p, s, a in zip(pos, size, at):
            got[int(p)] = int(s)
            assert ref[a:a + s] == query[p:p + s]
    want = {i: max((k for k in range(most + 1) if query[i:i + k] in ref and i + k <= len(query)), default=0)
            for i in range(len(query))}
    assert got == want


def test_exact_groups(spark):
    rows = [(1, "a"), (2, "a"), (3, None), (4, ""), (5, "b" * 100), (6, "b" * 99 + "c"), (7, "b" * 100),
            (8, "z"), (2, "a"), (None, "a"), (None, "q"), (9, "long" * 20_000), (10, "long" * 20_000)]
    got = {(r.doc_id, r.text_len): (r.keep_id, r.group_size, r.kept)
           for r in exact.exact_groups(docs(spark, rows)).collect()}
    assert got[(1, 1)] == (2, 4, False) and got[(2, 1)] == (2, 4, True)
    assert got[(3, 0)] == (4, 2, False) and got[(4, 0)] == (4, 2, True)
    assert got[(5, 100)] == (7, 2, False) and got[(7, 100)] == (7, 2, True) and got[(6, 100)] == (6, 1, True)
    assert got[(8, 1)] == (8, 1, True) and got[(10, 80_000)] == (10, 2, True)
    kept = exact.drop_exact_copies(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 2, 4, 6, 7, 8, 10]
    both = spark.createDataFrame([(1, "ab", ""), (1, "cd", ""), (1, "cd", "")], "doc_id long, text string, _id string")
    assert sorted(r.text for r in exact.drop_exact_copies(both.drop("_id")).collect()) == ["ab", "cd"]


def brute_fingerprint(text, shingle=3, seed=42):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    s = [" ".join(w[i:i + shingle]) for i in range(max(1, len(w) - shingle + 1))] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), seed) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_groups_match_brute_force(spark):
    rng = random.Random(1)
    base = [" ".join(rng.choices([f"W{i}" for i in range(300)], k=120)) for _ in range(8)]
    rows = [(i, " ".join(w if rng.random() > 0.01 else "edit" for w in base[i % 8].split(" "))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "one"), (203, "ONE"), (204, "one\ttwo"), (205, "one two"), (7, rows[7][1])]
    fps = {i: brute_fingerprint(t) for i, t in rows}
    ids = sorted(fps)
    root = {i: i for i in ids}

    def find(x):
        return x if root[x] == x else find(root[x])
    for a in ids:
        for b in ids:
            if a < b and (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = simhash.near_groups(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    assert all((r.fp % (1 << 64), r.component_id) == (fps[r.doc_id], find(r.doc_id)) for r in got)
    assert len({find(i) for i in ids}) < len(ids)
    kept = simhash.drop_near_copies(docs(spark, rows)).collect()
    assert {r.doc_id for r in kept} == {find(i) for i in ids}


@pytest.mark.parametrize("radius", [1, 2, 3, 5])
def test_pigeonring_finds_every_pair(spark, radius):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(0, 5))) for b in base for _ in range(15)}
    signed = sorted(x - (1 << 64) if x >> 63 else x for x in fps)
    got = {(r.u, r.v) for r in simhash.near_pairs(spark.createDataFrame([(x,) for x in signed], "fp long"),
                                                  radius).collect()}
    assert got == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= radius}


def test_near_pairs_are_not_broadcast(spark):
    """Each fingerprint makes some 70 rows, which the planner cannot know."""
    fps = spark.range(3000).select(F.xxhash64("id").alias("fp"))
    seen = simhash.near_pairs(fps)
    seen.collect()
    plan = seen._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_components_of_a_long_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(5, 5), (100, 90), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in graph.components(e).collect()}
    assert got == {**{i: 0 for i in range(71)}, 90: 90, 100: 90}


def test_empty_tables(spark):
    none = docs(spark, [])
    assert exact.exact_groups(none).count() == 0 and exact.drop_exact_copies(none).count() == 0
    assert simhash.near_groups(none).count() == 0 and simhash.drop_near_copies(none).count() == 0
    assert repeats.remove_repeated_words(none).count() == 0 and repeats.remove_repeated_bytes(none).count() == 0


def test_kept_text_hashes_like_the_query(spark):
    from tickframe.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op2_substring_dedup"](spark, sf).collect()}
    assert got == {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute_words(rows)}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in QUERIES["op9_byte_dedup"](spark, sf).collect()}
    assert got == {d: (n, k, s, hashlib.sha256(t).hexdigest()) for d, n, k, s, t in brute_bytes(rows)}
    g = QUERIES["op4_simhash_near_dedup"](spark, sf)
    assert {r.doc_id: r.fingerprint for r in g.collect()} == {d: f"{brute_fingerprint(t):016x}" for d, t in rows}
    assert g.filter(F.col("component_id") > F.col("doc_id")).count() == 0
