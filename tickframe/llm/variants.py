"""Spelling variants: words at one inserted, deleted or replaced letter, by bitsets.

Two words at one error share at least half of the rest: a word of ``m`` letters and one of
``m`` or ``m + 1`` have their first or their last ``(m - 1) // 2`` letters in common. Every
word is therefore dealt by the beginning and by the ending it has in each of the two
classes it can take part in (as one of ``m`` letters, as one of ``m + 1``). A bucket holds
some thousand words; a larger one is cut into blocks of words and blocks of queries.

Within a block ``near`` keeps one bitset over the words per position and letter and runs
every query through them: bit j of the zero-error set says that word j agrees so far, bit j
of a one-error set that it agrees but for one error, with the positions shifted by one after
an inserted or a deleted letter. Words are numbered by falling count, so the lowest bit
of a result is the most frequent near word. No pair of words is written out.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_table, scratch_table

#: Words of a bucket, on average and at most.
BUCKET_WORDS = 8192
BLOCK_WORDS = 16384
#: Distinct words that a task holds before it hands on their counts.
HELD_WORDS = 200_000
#: 64-bit words of one matrix of bitsets (queries x words / 64).
MATRIX = 1 << 15


def count_runs(docs: DataFrame, least: int = 5, every: int = 97, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """``word, n``: the runs of Latin letters (A-Z, a-z, U+00C0 to U+00FF) of whole texts
    with A-Z in lower case, after the deletion of one letter of those (document, run) whose
    CRC-32 ``every`` divides, if they have ``least`` letters or more then. Null texts have
    no runs; runs of a null id keep all letters. Each task counts before it hands on."""

    def run(batches):
        import re
        from collections import Counter
        from zlib import crc32

        import pyarrow as pa
        find = re.compile("[a-zÀ-ÿ]{%d,}" % least).findall
        total = Counter()

        def pack():
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                               pa.array(list(total.values()), pa.int64())], ["word", "n"])

        for batch in batches:
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                words = find(text.encode().lower().decode())  # bytes.lower() changes A-Z alone
                total.update(words)
                if i is not None:
                    start = crc32(b"%d:" % i if isinstance(i, int) else f"{i}:".encode())
                    hit = {w: h for w in set(words) if not (h := crc32(w.encode(), start)) % every}
                    for w, k in Counter(filter(hit.__contains__, words)).items() if hit else ():
                        total[w] -= k
                        at = hit[w] % len(w)
                        if len(w) > least:
                            total[w[:at] + w[at + 1:]] += k
                if len(total) >= HELD_WORDS:
                    yield pack()
                    total.clear()
        yield pack()

    found = docs.select(id_col, text_col).mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def _letters(words: list[str], m: int) -> np.ndarray:
    return np.array(words, dtype=f"U{m}").view(np.uint32).reshape(len(words), m)


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of booleans as rows of 64-bit words, column 0 in the lowest bit."""
    b = np.packbits(flags, axis=-1, bitorder="little")
    pad = -b.shape[-1] % 8
    return np.ascontiguousarray(np.pad(b, [(0, 0)] * (b.ndim - 1) + [(0, pad)])).view("<u8")


def _index(vocab: list[str], width: int, alphabet: np.ndarray):
    """``(positions, letters + 1, words / 64)`` bitsets: which words have a letter at a
    position; the last letter stands for any that is not in the alphabet."""
    codes = _letters(vocab, width)
    out = np.zeros((width, len(alphabet) + 1, -(-len(vocab) // 64)), "<u8")
    for p in range(width):
        at = np.searchsorted(alphabet, codes[:, p])
        at[alphabet[np.minimum(at, len(alphabet) - 1)] != codes[:, p]] = len(alphabet) + 1  # past a word's end
        out[p] = _bits(at[None, :] == np.arange(len(alphabet) + 1)[:, None])
    return out


def _same_or_longer(q: np.ndarray, index: np.ndarray, k: int):
    """For queries of m letters over words of m or m + 1: bitsets of the words at one
    replaced letter, of those at one more letter, and of those that share k letters."""
    z = np.full((len(q), index.shape[2]), ~np.uint64(0))
    swap, more = np.zeros_like(z), np.zeros_like(z)
    for i in range(q.shape[1]):
        here, next_ = index[i, q[:, i]], index[i + 1, q[:, i]]
        more = (more | z) & next_
        swap = (swap & here) | (z & ~here)
        z &= here
        if i + 1 == k:
            shared = z.copy()
    return swap, more | z, shared


def _shorter(q: np.ndarray, index: np.ndarray, k: int):
    """For queries of m + 1 letters over words of m: bitsets of the words at one letter
    less, and of those that share k letters."""
    z = np.full((len(q), index.shape[2]), ~np.uint64(0))
    less = np.zeros_like(z)
    for i in range(q.shape[1]):
        less = (less & index[i - 1, q[:, i]]) | z if i else z.copy()
        z &= index[i, q[:, i]]
        if i + 1 == k:
            shared = z.copy()
    return less, shared


def near(words: list[str], n: list[int], vocab: np.ndarray, query: np.ndarray, m: int, ending: bool):
    """Per query of one block of the class ``m``: ``(position of the query, near words,
    position of the most frequent near word)``. ``vocab`` and ``query`` flag what each word
    is here. A block by beginnings counts pairs that share their first letters, one by
    endings the others."""
    length = np.array([len(w) for w in words])
    k = (m - 1) // 2
    order = np.array(sorted(np.flatnonzero(vocab), key=lambda i: (-n[i], words[i])), np.int64)
    out = []
    if not len(order):
        return [(i, 0, -1) for i in np.flatnonzero(query)]
    told = [words[i] for i in order]
    alphabet = np.unique(_letters(told, m + 1))
    alphabet = alphabet[alphabet > 0]
    index = _index(told, m + 1, alphabet)
    short, long = (_bits((length[order] == x)[None, :]) for x in (m, m + 1))
    for size in (m, m + 1):
        at = np.flatnonzero(query & (length == size))
        step = max(1, MATRIX // index.shape[2])
        for a in range(0, len(at), step):
            part = at[a:a + step]
            codes = _letters([words[i] for i in part], size)
            q = np.searchsorted(alphabet, codes)
            q[alphabet[np.minimum(q, len(alphabet) - 1)] != codes] = len(alphabet)
            if size == m:
                swap, more, shared = _same_or_longer(q, index, k)
                got = (swap & short) | (more & long)
            else:
                less, shared = _shorter(q, index, k)
                got = less & short
            got &= ~shared if ending else shared
            some = got != 0
            first = some.argmax(axis=1)
            word = got[np.arange(len(part)), first]
            low = first * 64 + np.bitwise_count((word & (~word + np.uint64(1))) - np.uint64(1)).astype(np.int64)
            count = np.bitwise_count(got).sum(axis=1, dtype=np.int64)
            best = np.where(count > 0, order[np.minimum(low, len(order) - 1)], -1)
            out.extend(zip(part.tolist(), count.tolist(), best.tolist()))
    return out


def _block(table):
    """Arrow table of one block -> per query its count of near words and the best of them."""
    import pyarrow as pa
    words, n = table.column("word").to_pylist(), table.column("n").to_pylist()
    vocab, query = (table.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("vocab", "query"))
    kind = table.column("kind").to_numpy()
    rows = []
    for x in np.unique(kind):  # class and side
        at = np.flatnonzero(kind == x)
        w, c = [words[i] for i in at], [n[i] for i in at]
        for i, count, best in near(w, c, vocab[at], query[at], int(x) >> 1, bool(x & 1)):
            rows.append((w[i], c[i], count, None if best < 0 else c[best], None if best < 0 else w[best]))
    cols = list(zip(*rows)) if rows else [()] * 5
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.table([pa.array(c, t) for c, t in zip(cols, kinds)], ["word", "n", "n_near", "best_n", "best"])


def near_words(vocab: DataFrame, least: int = 5) -> DataFrame:
    """``word, n, n_near, best, best_n`` per row of ``vocab`` (distinct words of ``least``
    letters or more, at least 5, and their counts): how many other words differ by one
    inserted, deleted or replaced letter, and the most frequent of them (ties: the first
    by code point); null without any."""
    size = F.length("word")
    classes = F.expr(f"filter(array(length(word), length(word) - 1), m -> m >= {least})")
    keyed = vocab.select("word", "n", F.explode(classes).alias("m"))
    keyed = keyed.select("word", "n", "m", F.explode(F.array(F.lit(0), F.lit(1))).alias("ending"))
    k = F.floor((F.col("m") - 1) / 2).cast("int")
    key = F.when(F.col("ending") == 0, F.substring(F.col("word"), F.lit(1), k)).otherwise(
        F.substring(F.col("word"), size - k + 1, k))
    buckets = max(1, math.ceil(4 * vocab.count() / BUCKET_WORDS))
    keyed = keyed.select("word", "n", (F.col("m") * 2 + F.col("ending")).alias("kind"),
                         F.pmod(F.xxhash64("m", "ending", key), F.lit(buckets)).cast("int").alias("bucket"))
    parts = (keyed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK_WORDS).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    # a word is one of the words of its part's row of cells and a query of its column
    cells = F.expr("""array_distinct(concat(transform(sequence(0, parts - 1), i -> struct(own AS v, i AS q)),
                                            transform(sequence(0, parts - 1), i -> struct(i AS v, own AS q))))""")
    dealt = (keyed.join(parts, "bucket").withColumn("own", own).withColumn("cell", F.explode(cells))
             .select("word", "n", "kind", "bucket", F.col("cell.v").alias("v"), F.col("cell.q").alias("q"),
                     (F.col("cell.v") == F.col("own")).alias("vocab"), (F.col("cell.q") == F.col("own")).alias("query")))
    found = dealt.groupBy("bucket", "v", "q").applyInArrow(
        _block, "word string, n bigint, n_near bigint, best_n bigint, best string")
    top = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    return (found.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("word", "n", "n_near", F.col("top.best").alias("best"), (-F.col("top.less")).alias("best_n")))


def follow(links: DataFrame) -> DataFrame:
    """``word, root`` per row of ``word, form``: where the chain of forms ends. Pointers
    double in length each round, so a chain of d forms takes log2(d) rounds."""
    now = scratch_table(links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while now.filter("moved").limit(1).count():
        last, on = now, now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = scratch_table(last.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        drop_table(last)
    return now.select("word", "root")


def variant_forms(vocab: DataFrame, factor: int = 2, least: int = 5) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` per word of ``vocab`` (``word, n``): the form is
    the most frequent near word if it occurs at least ``factor`` (above 1) times as often,
    else null; the root is where the forms of forms end, the word itself without any."""
    vocab = scratch_table(vocab.select("word", "n"), "vocabulary")
    real = F.col("best_n") >= factor * F.col("n")
    words = scratch_table(near_words(vocab, least).select(
        "word", "n", "n_near", F.when(real, F.col("best")).alias("form"),
        F.when(real, F.col("best_n")).alias("form_n")), "near-words")
    drop_table(vocab)
    roots = follow(words.filter("form IS NOT NULL").select("word", "form"))
    return words.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
