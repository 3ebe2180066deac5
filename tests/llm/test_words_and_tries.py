"""Spelling variants, language mixtures and the conversation trie against brute force."""

import math
import os
import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tickframe.llm import mixture, trie, variants
from tickframe.session import scratch_path

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_spelling_variants", "op13_conversation_trie"])
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(SF):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    got = E.queries()[name](spark, SF)
    want = con.execute(E.oracle_sql()[name]).fetchall()
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, want))


def folder(spark, table, rows, schema):
    """A folder that holds one table."""
    at = scratch_path(spark, "fixture")
    spark.createDataFrame(rows, schema).write.parquet(f"{at}/{table}.parquet")
    return at


# ------------------------------------------------------------------ spelling variants

def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_runs(rows):
    total = Counter()
    for i, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for w in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = crc32(f"{i}:{w}".encode()) if i is not None else 1
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                total[w] += 1
    return total


def brute_forms(vocab):
    form, near = {}, {}
    for w in vocab:
        near[w] = [v for v in vocab if one_error(w, v)]
        top = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = top if top is not None and vocab[top] >= 2 * vocab[w] else None
    out = set()
    for w in vocab:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None))
    return out


def words_of(rng, n, letters="abàÿ", short=5, long=9):
    return ["".join(rng.choices(letters, k=rng.randrange(short, long))) for _ in range(n)]


@pytest.mark.parametrize("block", [16384, 40])
def test_forms_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(variants, "BLOCK_WORDS", block)       # 40: most buckets are cut into cells
    monkeypatch.setattr(variants, "BUCKET_WORDS", 8192 if block > 40 else 300)
    rng = random.Random(1)
    vocab = {w: rng.choice([3, 3, 4, 6, 8, 12, 30, 100]) for w in words_of(rng, 700) + words_of(rng, 60, "xyz", 11, 14)}
    vocab |= {"a" * n: n for n in range(5, 90)} | {"solitary": 9, "z" * 3000: 5, "z" * 2999: 40, "y" + "z" * 2999: 3}
    df = spark.createDataFrame([(w, n, 1) for w, n in vocab.items()], "word string, n long, root int")
    got = {tuple(r) for r in variants.variant_forms(df).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    want = brute_forms(vocab)
    assert got == want and any(r[1] and r[2] != r[1] for r in want)      # chains of forms


def test_variant_query_matches_brute_force(spark):
    rng = random.Random(3)
    pool = words_of(rng, 300, "aeiéØ", 4, 8) + ["ÀBCDE", "Àbcde", "abcd", "naïve", "÷×÷×÷"]
    rows = [(i, " ".join(rng.choices(pool, k=rng.randrange(1, 200))).replace("aa", "Aa")) for i in range(300)]
    rows += [(7, None), (8, ""), (9, "12 34"), (None, "abcde abcde abcde"), rows[0], rows[0], (10, "é,abcdé;abcdéĀabcdé" * 500),
             (-5, "w" * 5000 + " " + "w" * 5000 + " " + "w" * 5000)]
    at = folder(spark, "documents", [(i, t, 1, "x") for i, t in rows], "doc_id long, text string, word int, n string")
    got = {tuple(r) for r in E.queries()["op11_spelling_variants"](spark, at).collect()}
    want = brute_forms({w: n for w, n in brute_runs(rows).items() if n >= 3})
    assert got == want and any(r[1] for r in want)


def test_variants_of_no_words(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert variants.variant_forms(variants.count_runs(empty)).count() == 0


# ------------------------------------------------------------------ languages

def brute_model(rows):
    """P(word | language) by the formulas of the module docstring, from plain dictionaries."""
    c3, c2, c1 = (defaultdict(Counter) for _ in range(3))
    for text, lang in rows:
        for w in symbols(text):
            for a, b, c in zip([0, 0, *w], [0, *w], [*w, 0]):
                c3[lang][a if b else 0, b, c] += 1
                c2[lang][b, c] += 1
                c1[lang][c] += 1

    def chance(lang, a, b, c):
        one = (c1[lang][c] + 1) / (sum(c1[lang].values()) + mixture.SYMBOLS)
        after = [n for (x, _), n in c2[lang].items() if x == b]
        two = (c2[lang][b, c] + len(after) * one) / (sum(after) + len(after)) if after else one
        after = [n for (x, y, _), n in c3[lang].items() if (x, y) == (a, b)]
        return (c3[lang][a, b, c] + len(after) * two) / (sum(after) + len(after)) if after else two

    return lambda lang, w: sum(math.log(chance(lang, a if b else 0, b, c)) for a, b, c in zip([0, 0, *w], [0, *w], [*w, 0]))


def symbols(text):
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        yield [x - 96 if x < 128 else x - 101 for x in w.encode()]


TEXTS = [("the cat sat on the mat and the dog ran to the hat", "en"), ("this is the other thing that they thought", "en"),
         ("der hund und die katze sind schön und grün", "de"), ("das ist nicht schlecht für uns über alles", "de"),
         ("el niño y la niña están en la montaña mañana", "es"), ("los años pasan según el señor muñoz", "es")]


def small_model():
    rows = mixture.triples([t for t, _ in TEXTS], [lang for _, lang in TEXTS])
    langs, keys = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    counts = np.zeros((len(keys), len(langs)), np.int64)
    for lang, k, n in rows:
        counts[keys.index(k), langs.index(lang)] += n
    return mixture.estimate(langs, np.array(keys), counts)


def test_word_likelihoods_match_brute_force(monkeypatch):
    model, want = small_model(), brute_model(TEXTS)
    texts = ["the niño und", "", None, "zzz über-alles 12 ΑΒΓ", "x"]
    for events in (1 << 17, 3):
        monkeypatch.setattr(mixture, "EVENTS", events)
        keys, starts, doc = mixture.expressions(texts)
        words = [(i, w) for i, t in enumerate(texts) for w in symbols(t or "")]
        assert doc.tolist() == [i for i, _ in words]
        got = model.words(keys, starts)
        for row, (_, w) in zip(got, words):
            assert row.tolist() == pytest.approx([want(lang, w) for lang in model.langs], abs=1e-3)


def test_mixture_matches_plain_em():
    model, like = small_model(), brute_model(TEXTS)
    texts = ["the cat and the dog sind schön und grün", "la niña", "the hat " * 30 + "das ist nicht schlecht " * 10]
    got = mixture.mixtures(model, texts, penalty=1.0, rounds=20)
    for row, text in zip(got, texts):
        p = [[math.exp(like(lang, w)) for lang in model.langs] for w in symbols(text)]
        best, chosen = None, None
        for mask in range(1, 1 << len(model.langs)):     # every set of languages
            held = [i for i in range(len(model.langs)) if mask >> i & 1]
            t = {i: 1 / len(held) for i in held}
            for _ in range(200):
                r = [{i: t[i] * x[i] / sum(t[j] * x[j] for j in held) for i in held} for x in p]
                t = {i: sum(x[i] for x in r) / len(p) for i in held}
            fit = sum(math.log(sum(t[i] * x[i] for i in held)) for x in p) - (len(held) - 1) * math.log(len(p) + 1)
            if best is None or fit > best:
                best, chosen = fit, t
        assert row.tolist() == pytest.approx([chosen.get(i, 0) for i in range(len(model.langs))], abs=0.02)


def test_languages_held_out(spark):
    r = E.queries()["op12_language_mixture"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    got = r.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got > 0.99
    assert r.filter("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_languages_at_the_edges(spark):
    rows = [(i, t, lang, "s") for i, (t, lang) in enumerate(TEXTS * 3)]
    rows += [(100, None, "en", None), (101, "", None, "x"), (102, "12 ?! 34", "de", "x"), (None, "der hund und die", "es", "x"),
             (104, "the mat and the hat", None, "x"), (104, "the mat and the hat", None, "x"), (105, "𝒳 ΑΒΓ", None, None),
             (106, "the dog " * 60000, None, None), (107, "DER HUND", "", None)]
    at = folder(spark, "documents", rows, "doc_id long, text string, lang string, source string")
    got = sorted(E.queries()["op12_language_mixture"](spark, at).collect(), key=str)
    assert got == sorted(E.queries()["op12_language_mixture"](spark, at).collect(), key=str)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert len(got) == len(rows)
    assert all(by[i][0].lang_pred == "und" and by[i][0].score == 0 for i in (100, 101, 102))
    assert by[104][0].lang_pred == by[106][0].lang_pred == "en" and len(by[104]) == 2
    assert by[None][0].lang_pred == "de" and by[None][0].held_out is False
    assert by[105][0].lang_pred != "und"
    docs = spark.createDataFrame([(1, "the cat")], "doc_id long, text string")
    assert mixture.fit_languages(docs.withColumn("lang", F.lit(None).cast("string"))) is None
    assert mixture.score_languages(docs, None).first()[1:3] == ("und", 0.0)
    assert mixture.score_languages(docs.limit(0), small_model()).count() == 0


# ------------------------------------------------------------------ conversation trie

def brute_trie(convs):
    """``convs``: {conv_id: [(role, text), ...]}"""
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = Counter(k[:-1] for k in members if k)
    out = []
    for k, held in members.items():
        below = [x for x in members if x[:len(k)] == k]
        ends = sorted(c for c in held if len(convs[c]) == len(k))
        out.append((min(held), len(k), min(members[k[:-1]]) if k else None, len(held), kids[k],
                    sum(not kids[x] for x in below),
                    sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
                    sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=str)


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def test_trie_query_matches_brute_force(spark):
    rng = random.Random(5)
    texts = ["a", "b", "", "é" * 40, "z" * 5000]
    rows = []
    for c in list(range(0, 120)) + [10**12 + i for i in range(7)]:
        if c % 5 == 0 and c % 3 == 0:
            continue                                     # no conversation to take the first turns from
        for t in range(rng.randrange(1, 14)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choices(texts, (9, 1, 1, 1, 1))[0]))
    rows += [(1, None, "system", "null turn"), (2, 3, None, None), (None, 1, "user", "nobody"), (None, None, None, None)]
    rows += [(777, t, "user", "long") for t in range(300)] + [(778, t, "user", "long") for t in range(299)]
    schema = "conv_id long, turn long, role string, text string, depth int, path string"
    at = folder(spark, "conversations", [(*r, 1, "x") for r in rows], schema)
    got = sorted((tuple(r) for r in E.queries()["op13_conversation_trie"](spark, at).collect()), key=str)
    assert got == brute_trie(rebuilt(rows))
    assert {r[1] for r in got} >= set(range(290))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_trie_is_the_same_in_any_number_of_shards(spark, monkeypatch, shards):
    monkeypatch.setattr(trie, "shuffle_width", lambda spark: shards)
    monkeypatch.setattr(trie, "MEMBERS_BITS", 3)         # the ids of one path come in many rows
    rng = random.Random(shards)
    convs = {c: [("u", rng.choice("ab")) for _ in range(rng.randrange(0, 7))] for c in range(-50, 400)}
    convs |= {c: [("u", "x"), ("a", "y")] for c in range(1000, 1300)}
    token = lambda r, t: sha256(f"{len(r)}:{r}{t}".encode()).digest()[:16] + len(t).to_bytes(8, "big")
    paths = spark.createDataFrame([(c, b"".join(token(*x) for x in v)) for c, v in convs.items()],
                                  "conv_id long, path binary")
    got = sorted((tuple(r) for r in trie.prefix_trie(paths).collect()), key=str)
    assert got == brute_trie(convs)


def test_trie_of_nothing(spark):
    at = folder(spark, "conversations", [(None, 1, "u", "t")], "conv_id long, turn long, role string, text string")
    assert E.queries()["op13_conversation_trie"](spark, at).count() == 0
