"""Mixing, archive, chat, decontamination, classifiers and the pipeline."""

import os
import random
import re
from collections import Counter
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from tickframe.llm import chat, classify, decontam, exact, mixing, simhash, warc
from tickframe.session import scratch_path

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int, size string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, 7, "x") for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


@pytest.mark.parametrize("name", ["op2_substring_dedup", "op5_mix_sources", "op6_web_archive", "op8_exact_dedup",
                                  "op9_byte_dedup", "op10_chat_format"])
def test_query_matches_sql(spark, con, name):
    got = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name]).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


# ------------------------------------------------------------------ mixing

def test_targets_share_the_excess(spark):
    sizes = {"a": 10, "b": 1000, "c": 500, None: 40, "empty": 0}
    rows = [(i, " ".join(["w"] * n), s) for i, (s, n) in enumerate(sizes.items())]
    got = {r.source: r.target for r in mixing.mix_copies(documents(spark, rows)).collect()}
    # by code point, null last: a 3, b 1, c 2, empty 3, null 1; a, c and null stop at twice their size
    assert got["a"] == 20 and got["empty"] == 0 and got[None] == 80 and got["c"] == 1000
    assert got["b"] == pytest.approx(1.5 * 1550 - 20 - 80 - 1000)


def test_mix_comes_near_its_targets(spark):
    rng = random.Random(2)
    rows = [(i, " ".join(["w"] * int(rng.lognormvariate(4, 1))), rng.choice("xyyz")) for i in range(3000)]
    rows += [(5, None, "x"), (None, "null id", None), (3, rows[3][1], rows[3][2])]
    got = mixing.mix_copies(documents(spark, rows))
    assert got.count() == len(rows)
    assert got.filter("copies < 0 OR copies > 2").count() == 0
    for r in got.groupBy("source", "source_size", "target").agg(
            F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("size").alias("m")).collect():
        assert abs(r.taken - r.target) <= max(2 * r.m, 0.01 * r.target)
    assert sorted(got.collect(), key=str) == sorted(mixing.mix_copies(documents(spark, rows)).collect(), key=str)
    mixed = mixing.mix(documents(spark, rows))
    assert mixed.columns == documents(spark, rows).columns + ["copy"]
    assert mixed.count() == got.agg(F.sum("copies")).first()[0]
    assert {r.copies for r in mixed.select("copies").distinct().collect()} == {7}


# ------------------------------------------------------------------ archive

def test_archive_round_trip(spark):
    big, other = "é" * 60, "x" * 100
    rows = [(3, "u3", big), (1, "u\r\n1", big), (2, None, big), (4, "u4", "tiny"), (5, "u5", "tiny"),
            (6, "u6", None), (7, "u7", other), (8, "u8", other + "\r\n\r\nWARC/1.1"), (1, "again", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, digest int")
    a = warc.write_archive(pages, scratch_path(spark, "warc-test"))
    got = sorted((r.page_id, r.payload.decode(), r.record_type, r.refers_to)
                 for r in warc.read_pages(spark, a).select("page_id", "payload", "record_type", "refers_to").collect())
    first = {big: 1, other: 7, rows[7][2]: 8}
    want = []
    for i, _, h in rows:
        h = h or ""
        again = len(h.encode()) >= 100 and first[h] != i
        want.append((i, h, "revisit" if again else "response", first[h] if again else None))
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2]))
    assert spark.read.parquet(a.payloads).count() == len({h or "" for _, _, h in rows})
    # every record is a valid one: its length says where the block ends
    for r in warc.read_records(spark, a).collect():
        n = int(re.search(rb"Content-Length: (\d+)", bytes(r.header))[1])
        assert bytes(r.record) == bytes(r.header) + bytes(r.record)[len(r.header):len(r.header) + n] + b"\r\n\r\n"
        assert sha256(bytes(r.payload)).hexdigest() == r.digest


def test_exported_archive_has_whole_records(spark):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}é\r\n</p>" * 20) for i in range(5)],
                                  "page_id long, url string, html string")
    a = warc.write_archive(pages, scratch_path(spark, "warc-test"))
    out = scratch_path(spark, "warc-file")
    warc.export_warc(spark, a, out)
    raw = b"".join(bytes(r.content) for r in spark.read.format("binaryFile").load(out).collect())
    n = 0
    while raw:
        head, rest = raw.split(b"\r\n\r\n", 1)
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1") and rest[size:size + 4] == b"\r\n\r\n"
        raw, n = rest[size + 4:], n + 1
    assert n == 5


def test_archive_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_pages(spark, warc.write_archive(pages, scratch_path(spark, "warc-test"))).count() == 0


# ------------------------------------------------------------------ chat

HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "[\\INST]", "[\\\\INST]", "<", "<|im_end|>", "<\\|", "a\\</s>",
        "", "é\n", "[INST", "]</s", "<<SYS>>x<</SYS>>", "<s><s>", "\\<s>\\"]


def test_escaping_is_reversible(spark):
    rng = random.Random(4)
    bits = ["[", "INST]", "/INST]", "\\", "<", "s>", "/s>", "|", "<<SYS>>", "x"]
    texts = HARD + ["".join(rng.choices(bits, k=rng.randrange(1, 9))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escape(F.col("t")).alias("e"), chat.unescape(chat.escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_chat_round_trip(spark):
    rows = [(1, k, "assistant" if k % 2 else "user", t) for k, t in enumerate(HARD)]
    rows += [(2, 0, None, None), (2, None, "system", "first"), (None, 0, "assistant", "no id"),
             (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 1, "a[/INST]b", "r"), (4, 0, "assistant", "z" * 50_000)]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, marks string")
    got = {r.conv_id: r for r in chat.read_chat(chat.format_chat(chat.to_turns(df))).collect()}
    assert [(t.role, t.text) for t in got[1].turns] == [(r[2], r[3]) for r in rows[:len(HARD)]]
    assert got[1].loss_text == "".join(HARD[1::2])
    assert [(t.role, t.text) for t in got[2].turns] == [("system", "first"), ("", "")]
    assert got[None].loss_text == "no id" and len(got[3].turns) == 3 and got[3].turns[2].role == "a[/INST]b"
    assert got[4].loss_text == "z" * 50_000
    assert chat.read_chat(chat.format_chat(chat.to_turns(df.limit(0)))).count() == 0


def test_layouts_are_told_apart_by_fingerprint(spark):
    mixed = spark.createDataFrame([
        (1, "hi", None, None, None, None, None, "c1"),
        (2, None, "do", "with", "out", None, None, None),
        (3, None, None, None, None, [("user", "q"), ("assistant", None)], None, None),
        (4, None, None, None, None, None, [("human", "h"), ("gpt", "g"), ("tool", "t")], None),
        (5, None, "odd", None, None, None, None, None),
        (6, None, None, None, None, None, None, None)],
        "id long, prompt string, instruction string, input string, output string, "
        "messages array<struct<role:string,content:string>>, "
        "conversations array<struct<from:string,value:string>>, completion string")
    got = {}
    for r in chat.to_turns(mixed).orderBy("conv_id", "turn").collect():
        got.setdefault((r.conv_id, r.layout), []).append((r.role, r.text))
    assert got == {(1, "prompt/completion"): [("user", "hi"), ("assistant", "c1")],
                   (2, "instruction/input"): [("user", "do\n\nwith"), ("assistant", "out")],
                   (3, "messages"): [("user", "q"), ("assistant", "")],
                   (4, "from/value"): [("user", "h"), ("assistant", "g"), ("tool", "t")],
                   (5, "instruction"): [("user", "odd"), ("assistant", "")],
                   (6, None): [(None, None)]}
    with pytest.raises(ValueError, match="no declared layout"):
        chat.to_turns(spark.createDataFrame([(1,)], "id long"))


def test_null_answers_and_turn_rows_among_others(spark):
    def turns(df):
        return sorted(((r.conv_id, r.turn, r.role, r.text, r.layout) for r in chat.to_turns(df).collect()), key=str)

    one = spark.createDataFrame([(1, "x", None, "e"), (2, None, "y", "e"), (3, None, None, "e")],
                                "id long, prompt string, completion string, _t string")
    p = "prompt/completion"
    assert turns(one) == sorted([(1, 0, "user", "x", p), (1, 1, "assistant", "", p), (2, 0, "user", "", p),
                                 (2, 1, "assistant", "y", p), (3, 0, "user", "", p), (3, 1, "assistant", "", p)], key=str)
    both = spark.createDataFrame([(None, 7, 0, "user", "hi", None), (None, 7, 1, "assistant", None, None),
                                  (9, None, None, None, None, [("user", "q")]), (10, None, None, None, None, [])],
                                 "id long, conv_id long, turn int, role string, text string, "
                                 "messages array<struct<role:string,content:string>>")
    assert turns(both) == sorted([(7, 0, "user", "hi", "turn rows"), (7, 1, "assistant", "", "turn rows"),
                                  (9, 0, "user", "q", "messages"), (10, None, None, None, "messages")], key=str)


# ------------------------------------------------------------------ columns of any name

@pytest.mark.parametrize("name", ["_key", "_id", "_len", "_pre", "_hash", "_n", "_keep", "_KEY", "id", "t", "fp", "row",
                                  "shard", "component_id", "text_len", "keep_id", "kept", "copies", "_text", "score"])
def test_row_keeping_stages_take_any_column_name(spark, name):
    rows = [(3, "same text here", "a"), (3, "same text here", "a"), (1, "same text here", "b"), (2, None, "c"),
            (4, "another text altogether", "d")]
    df = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` string")
    got = {(r[0], r[1], r[2]) for r in exact.drop_exact_copies(df).collect()}
    assert got == {rows[0], rows[3], rows[4]}
    near = simhash.drop_near_copies(df)
    assert near.columns == df.columns and {(r[0], r[2]) for r in near.collect()} == {(1, "b"), (2, "c"), (4, "d")}


def test_radius_finds_similar_windows():
    """Of windows whose shingles are 0.8 or more alike, how many fingerprints are in reach."""
    import numpy as np
    from tickframe.llm import kernels
    rng, seen, close = np.random.default_rng(3), 0, 0
    for _ in range(400):
        n = int(rng.integers(12, 80))
        own = rng.integers(0, 2**63, n).astype(np.uint64)
        index = kernels.ItemIndex([], 5, decontam.RADIUS, decontam.BLOCKS, 0.8)
        other = own.copy()
        other[rng.integers(0, n, int(rng.integers(1, 3)))] = rng.integers(0, 2**63, 1).astype(np.uint64)
        a, b = index.weigh(own), index.weigh(other)
        both = sum(min(v, b.get(k, 0)) for k, v in a.items())
        if both / (2 * (n - 4) - both) < 0.8:
            continue
        seen += 1
        fps = [int(kernels.majority(x, np.array([0]))[0]) for x in (own, other)]
        close += (fps[0] ^ fps[1]).bit_count() <= decontam.RADIUS
    assert seen > 100 and close >= 0.99 * seen


# ------------------------------------------------------------------ decontamination

def plain(t):
    return re.sub(r"[\x09-\x0d !-/:-@\[-`{-~]+", " ", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")).split(" ")


def brute_leaks(rows, items):
    found = set()
    for d, t in rows:
        w = [x for x in plain(t) if x]
        for i, it in items:
            x = [y for y in plain(it) if y]
            k = min(5, len(x))
            b = Counter(tuple(x[j:j + k]) for j in range(len(x) - k + 1)) if x else Counter()
            for s in range(len(w) - len(x) + 1 if x else 0):
                a = Counter(tuple(w[s + j:s + j + k]) for j in range(len(x) - k + 1))
                if sum((a & b).values()) >= 0.8 * sum((a | b).values()):
                    found.add((d, i))
                    break
    return found


def test_leaks_match_brute_force(spark):
    rng = random.Random(6)
    vocab = [f"v{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([3, 12, 20, 40, 59])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, items[0][1])]
    rows = []
    for n in range(120):
        w = rng.choice(items[:12])[1].split(" ")
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = "edit"
        text = " ".join(rng.choices(vocab, k=30) + [x.upper() + "," if rng.random() < 0.2 else x for x in w])
        rows.append((n, text if n % 3 else " ".join(rng.choices(vocab, k=80))))
    rows += [(200, None), (201, ""), (None, items[5][1]), (203, "x" * 50_000 + " " + items[6][1])]
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, similarity int")
    df = documents(spark, [(i, t, "s") for i, t in rows])
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(df, bench).collect()}
    want = brute_leaks(rows, items)
    assert got == want and len(want) > 20
    kept = decontam.drop_leaks(df, bench)
    assert kept.columns == df.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, _ in rows if d not in {x for x, _ in want})


def test_documents_shorter_than_an_item(spark):
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(2000)]
    items = [(i, " ".join(rng.choices(vocab, k=n))) for i, n in enumerate([57, 57, 40, 20, 12, 9, 6, 5, 3])]
    rows = [(0, " ".join(items[0][1].split(" ")[:50]))]
    for i, t in items:
        w = t.split(" ")
        for n in range(max(1, len(w) - 14), len(w)):
            rows += [(len(rows), " ".join(w[:n])), (len(rows) + 1, " ".join(w[-n:]).upper())]
            rows.append((len(rows), " ".join(w[:n // 2] + ["edit"] + w[n // 2 + 1:n])))
    want = {}
    for d, t in rows:
        mine = plain(t)
        for i, it in items:
            x = plain(it)
            k = min(5, len(x))
            if k <= len(mine) < len(x):
                a, b = (Counter(tuple(z[j:j + k]) for j in range(len(z) - k + 1)) for z in (mine, x))
                s = sum((a & b).values()) / sum((a | b).values())
                if s >= 0.8:
                    want[d, i] = s
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents(spark, [(d, t, "s") for d, t in rows])
    got = decontam.find_leaks(df, bench).collect()
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want)
    assert want[0, 0] == pytest.approx(46 / 53) and len(want) > 20
    assert {(r.first_word, r.n_windows) for r in got} == {(0, 1)}
    kept = {r.doc_id for r in decontam.drop_leaks(df, bench).collect()}
    assert kept == {d for d, _ in rows} - {d for d, _ in want}


def test_leaks_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 7)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    blocked = sorted(decontam.find_leaks(docs, bench).collect())
    monkeypatch.undo()
    assert blocked == sorted(decontam.find_leaks(docs, bench).collect()) and blocked
    assert decontam.find_leaks(docs.limit(0), bench).count() == 0
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontam.drop_leaks(docs, bench.limit(0)).count() == docs.count()


# ------------------------------------------------------------------ classifiers

@pytest.mark.parametrize("name, label, parts, held, least", [("op3_toxicity", "toxic", 4, 2, 0.93),
                                                            ("op7_quality", "quality", 3, 1, 0.97)])
def test_held_out_accuracy(spark, name, label, parts, held, least):
    sf = "/root/testdata/sf0.01"
    got = E.queries()[name](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert got.filter("score < 0 OR score > 1 OR score IS NULL OR held_out IS NULL").count() == 0
    assert got.filter((F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(parts)) == held) != F.col("held_out")).count() == 0
    j = got.filter("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    assert j.filter(F.col("predicted") == F.col(label)).count() >= least * j.count()


def test_classifiers_at_the_edges(spark):
    rows = [(i, ("bad vile words " if i % 2 else "kind warm words ") * (1 + i % 5), "s") for i in range(60)]
    rows += [(100, None, None), (101, "", "s"), (None, "vile", "s"), (102, "w " * 30_000, "s"), (1, rows[1][1], "s")]
    df = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, i % 2, 0) for i in range(60)] + [(None, 1, 1, 0), (3, None, None, 0), (1, 1, 1, 0)],
                                   "doc_id long, toxic int, quality int, text int")
    train = classify.training_labels(labels, "toxic", 4, 2)
    assert train.count() == train.select("id").distinct().count()
    model = classify.fit_toxic(df, train)
    got = classify.score_toxic(df, model).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.score for r in got}
    assert score[100] == score[101] and min(score[1], score[None]) > score[2]
    assert classify.drop_toxic(df, model, 2.0).count() == len(rows)
    rank = classify.fit_ranking(df, train)
    assert classify.score_quality(df, rank).count() == len(rows)
    for fit, use in ((classify.fit_toxic, classify.score_toxic), (classify.fit_ranking, classify.score_quality)):
        assert fit(df, train.limit(0)) is None and fit(df.limit(0), train.filter("label = 1")) is None
        assert use(df, None).count() == len(rows) and use(df.limit(0), None).count() == 0
    assert classify.score_toxic(df.limit(0), model).count() == 0


def test_texts_of_toxic_words_alone_score_high(spark):
    rows = [(i, ("bad vile words " if i % 2 else "kind warm words ") * (1 + i % 5), "s") for i in range(60)]
    rows += [(200 + i, t, "s") for i, t in enumerate(["vile", "bad vile", "bad vile words", "vile " * 500])]
    rows += [(300 + i, t, "s") for i, t in enumerate(["", "words", "kind", "kind warm words", "kind warm words other"])]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    df = documents(spark, rows)
    model = classify.fit_toxic(df, classify.training_labels(labels, "toxic", 4, 2))
    score = {r.doc_id: r.score for r in classify.score_toxic(df, model).collect()}
    assert model.curve[0] > 0
    assert min(score[i] for i in range(200, 204)) > 0.9 and max(score[i] for i in range(300, 305)) < 0.1
    assert {r.doc_id for r in classify.drop_toxic(df, model, 0.3).collect()} & set(range(200, 305)) == set(range(300, 305))


def test_every_expression_keeps_its_own_counts(spark):
    words = [f"{a}{b}{c}q{a}" for a in "abcdefghijklmnopqrst" for b in "abcdefghij" for c in "abcdefghij"]
    rows = [(i, " ".join(words[:1000] if i % 2 else words[1000:]), "s") for i in range(40)]
    rows += [(40 + i, "only" + " twice" * (i % 2), "s") for i in range(2)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(42)], "doc_id long, toxic int")
    df = documents(spark, rows)
    train = classify.training_labels(labels, "toxic", 4, 3)
    model = classify.fit_toxic(df, train)
    learned = {r.id: r.label for r in train.collect()}
    want = Counter()
    for i, t, _ in rows:
        for e in {(level, w[:p]) for w in t.split() for level, p in enumerate((3, 5, None))} if i in learned else ():
            want[e, learned[i]] += 1
    kept = [e for e in {e for e, _ in want} if want[e, 0] + want[e, 1] >= 2]
    assert len(model.units) == len(kept) and (model.units[1:] > model.units[:-1]).all()
    assert sorted(map(tuple, model.counts.tolist())) == sorted((want[e, 0], want[e, 1]) for e in kept)


def test_the_curve_never_falls_with_evidence():
    import numpy as np
    assert classify._logistic(np.array([3.0, 2.0, 0.0, 0.0]), np.array([0.0, 0.0, 1.0, 1.0])) == (0.0, 0.0)


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [len(corpus_pipeline.STAGES)] == [5]
    kept = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, SF)
        assert out.columns[:len(docs.columns)] == docs.columns and (k == 4 or len(out.columns) == len(docs.columns))
        assert out.select("doc_id").subtract(kept.select("doc_id")).count() == 0
        if k < 4:
            assert 0 < out.count() <= kept.count()
        kept = out
    assert sorted(map(str, corpus_pipeline.run(spark, SF).collect())) == sorted(map(str, kept.collect()))


def test_pipeline_stages_on_awkward_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "lonely text", None, "b", 3),
            (3, "same same", "en", None, 9), (3, "same same", "en", None, 9), (4, "w " * 40_000, "en", "a", 1)]
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF)
            df.collect()
