"""Language identification by mixtures: which languages a text is written in, and how much.

Every language has a model of letters in context, P(byte | the two before it in the word),
in Witten-Bell interpolation, counted over all its training texts. A word's likelihood
under each language follows from its bytes and its end. Expectation-maximisation over the
words of a text estimates the proportion of each language; the set of languages is the one
with the best likelihood less ``penalty`` times log(words) for every language but the first,
searched along the languages by falling proportion.

Words are maximal runs of letters in lower case, as UTF-8. Symbols are the word boundary,
a to z and the bytes above 127, so there are at most ``SYMBOLS`` ** 3 expressions per
language: the bound of what is sent to the driver and broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels

SYMBOLS = 1 + 26 + 128
SYMBOL = np.zeros(256, np.int64)
SYMBOL[97:123] = np.arange(1, 27)
SYMBOL[128:] = np.arange(27, SYMBOLS)
#: Bytes worked on at once, and expressions whose likelihoods are held at once.
SLICE_BYTES = 1 << 21
EVENTS = 1 << 17
UNKNOWN = "und"

_alpha: list = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _alpha:
        _alpha.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    out = _alpha[0][np.minimum(points, 0xFFFF)]
    high = points > 0xFFFF
    if high.any():
        kinds, back = np.unique(points[high], return_inverse=True)
        out[high] = np.array([chr(i).isalpha() for i in kinds])[back]
    return out


def expressions(texts: list[str | None]):
    """``(keys, starts, doc)``: the symbol triples of all words of ``texts``, where each
    word's triples start, and the text of each word."""
    low = [(t or "").lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    points[~_is_letter(points)] = 32
    # one space stands for the end of a text and belongs to it
    ends = np.cumsum([len(t) + 1 for t in low])
    size = np.where(points < 0x80, 1, np.where(points < 0x800, 2, np.where(points < 0x10000, 3, 4)))
    at = np.concatenate([[0], np.cumsum(size)])
    raw = np.frombuffer(points.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
    s = np.concatenate([[0, 0], SYMBOL[raw], [0]])
    a, b, c = s[:-2].copy(), s[1:-1], s[2:]
    a[b == 0] = 0
    hold = (b > 0) | (c > 0)
    keys = ((a * SYMBOLS + b) * SYMBOLS + c)[hold]
    first = (b == 0) & (c > 0)
    starts = np.cumsum(hold)[first] - 1
    limits = at[np.minimum(ends, len(at) - 1)]
    return keys, starts, np.searchsorted(limits, np.flatnonzero(first), "right")


def triples(texts: list[str | None], langs: list[str]) -> list[tuple]:
    """``(language, triple, count)`` over all texts of each language."""
    names, code = np.unique(np.array(langs, object), return_inverse=True)
    keys, starts, doc = expressions(texts)
    of = np.repeat(code[doc], np.diff(np.append(starts, len(keys))))
    found, n = np.unique(of * SYMBOLS**3 + keys, return_counts=True)
    return [(names[g // SYMBOLS**3], g % SYMBOLS**3, k) for g, k in zip(found.tolist(), n.tolist())]


@dataclass
class LanguageModel:
    """Log-likelihoods: ``three`` of the triples ``keys``; of others ``two`` of the last two
    symbols (``SYMBOLS`` ** 2 rows) plus ``back`` of the first two. A column a language."""
    langs: list[str]
    keys: np.ndarray
    three: np.ndarray
    two: np.ndarray
    back: np.ndarray
    at: np.ndarray | None = None

    def words(self, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Log-likelihood of each word under each language."""
        if self.at is None:
            self.at = np.full(SYMBOLS**3, -1, np.int32)
            self.at[self.keys] = np.arange(len(self.keys))
        out = np.empty((len(starts), len(self.langs)))
        step, a = max(1, EVENTS // len(self.langs)), 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(starts, starts[a] + step, "right")) - 1)
            b = len(starts) if starts[-1] < starts[a] + step else b
            k = keys[starts[a]:starts[b] if b < len(starts) else len(keys)]
            row = self.at[k]
            ll = self.three[row]
            miss = row < 0
            if miss.any():
                ll[miss] = self.two[k[miss] % SYMBOLS**2] + self.back[k[miss] // SYMBOLS]
            out[a:b] = np.add.reduceat(ll, starts[a:b] - starts[a], axis=0, dtype=np.float64)
            a = b
        return out


def estimate(langs: list[str], keys: np.ndarray, counts: np.ndarray) -> LanguageModel:
    """The model of ``counts[i, l]`` occurrences of the triple ``keys[i]`` in language l."""
    m, size = len(langs), SYMBOLS
    c3 = counts.astype(float)
    last = np.zeros((size, m))
    np.add.at(last, keys % size, c3)
    one = (last + 1) / (last.sum(axis=0) + size)
    pair, kinds3, total3 = np.zeros((size**2, m)), np.zeros((size**2, m)), np.zeros((size**2, m))
    np.add.at(pair, keys % size**2, c3)
    np.add.at(total3, keys // size, c3)
    np.add.at(kinds3, keys // size, c3 > 0)
    c2 = pair.reshape(size, size, m)
    total2, kinds2 = c2.sum(axis=1, keepdims=True), (c2 > 0).sum(axis=1, keepdims=True)
    two = np.where(total2 > 0, (c2 + kinds2 * one[None]) / np.maximum(total2 + kinds2, 1), one[None]).reshape(size**2, m)
    share = np.where(total3 > 0, kinds3 / np.maximum(total3 + kinds3, 1), 1.0)
    t, k = (total3 + kinds3)[keys // size], share[keys // size]
    three = c3 / np.maximum(t, 1) + k * two[keys % size**2]
    return LanguageModel(langs, keys, *(np.log(x).astype(np.float32) for x in (three, two, share)))


def _em(p: np.ndarray, starts: np.ndarray, theta: np.ndarray, rounds: int, close: float = 1e-4):
    """Proportions (languages x texts) after at most ``rounds`` steps, and each text's
    log-likelihood (relative to the scale of ``p``, languages x words). A text's words begin
    at ``starts``. Texts whose proportions moved less than ``close`` in a step are done."""
    theta = theta.copy()
    live, q, at = np.arange(len(starts)), p, starts
    for k in range(rounds):
        n = np.diff(np.append(at, q.shape[1]))
        old = theta[:, live]
        r = np.repeat(old, n, axis=1)
        r *= q
        r /= np.maximum(r.sum(axis=0), 1e-300)
        new = np.add.reduceat(r, at, axis=1) / n
        theta[:, live] = new
        moves = np.abs(new - old).max(axis=0) >= close
        if not moves.any():
            break
        if k + 1 < rounds and n[moves].sum() < 0.7 * q.shape[1]:
            q = q[:, np.repeat(moves, n)]
            live, at = live[moves], np.cumsum(n[moves]) - n[moves]
    n = np.diff(np.append(starts, p.shape[1]))
    fit = np.log(np.maximum((np.repeat(theta, n, axis=1) * p).sum(axis=0), 1e-300))
    return theta, np.add.reduceat(fit, starts)


def proportions(ll: np.ndarray, starts: np.ndarray, penalty: float, rounds: int) -> np.ndarray:
    """Proportions (texts x languages) of texts whose words begin at ``starts`` in ``ll``
    (words x languages); languages outside a text's set have 0."""
    texts, m = len(starts), ll.shape[1]
    ll = np.ascontiguousarray(ll.T)
    ll -= ll.max(axis=0)
    alone = np.add.reduceat(ll, starts, axis=1)
    p = np.exp(ll)
    words = np.diff(np.append(starts, p.shape[1]))
    full, _ = _em(p, starts, np.full((m, texts), 1 / m), rounds)
    order = np.argsort(-full, axis=0, kind="stable")
    out = np.zeros((m, texts))
    out[alone.argmax(axis=0), np.arange(texts)] = 1
    best, live = alone.max(axis=0), np.arange(texts)
    for k in range(2, m + 1):
        # a set of k languages at best explains every word by its likeliest: no loss at all
        hope = best[live] < -penalty * (k - 1) * np.log(words[live] + 1)
        if not hope.any():
            break
        part = np.zeros(texts, bool)
        part[live[hope]] = True
        live = live[hope]
        rows = p if part.all() else p[:, np.repeat(part, words)]
        mask = np.zeros((m, len(live)))
        np.put_along_axis(mask, order[:k, live], 1, axis=0)
        start = (full[:, live] + 1e-3) * mask
        theta, fit = _em(rows, np.cumsum(words[live]) - words[live], start / start.sum(axis=0), rounds)
        fit = fit - penalty * (k - 1) * np.log(words[live] + 1)
        better = fit > best[live]
        live, theta, fit = live[better], theta[:, better], fit[better]
        if not len(live):
            break
        out[:, live], best[live] = theta, fit
    return out.T


def mixtures(model: LanguageModel, texts: list[str | None], penalty: float, rounds: int) -> np.ndarray:
    """Proportions of each language in each text; rows of zeros without a letter."""
    out = np.zeros((len(texts), len(model.langs)))
    keys, starts, doc = expressions(texts)
    if len(starts):
        some, first = np.unique(doc, return_index=True)
        out[some] = proportions(model.words(keys, starts), first, penalty, rounds)
    return out


def _slices(batch):
    """Row ranges of at most ``SLICE_BYTES`` of text (a longer one alone)."""
    return kernels.slices(kernels.texts(batch.column(0))[1], SLICE_BYTES)


def fit_languages(train: DataFrame, lang_col: str = "lang", text_col: str = "text") -> LanguageModel | None:
    """A model per language of ``train``, counted over all its rows; rows with a null
    language teach nothing. None without a word to learn from."""

    def count(batches):
        import pyarrow as pa
        for batch in batches:
            for a, b in _slices(batch):
                part = batch.slice(a, b - a)
                rows = triples(part.column(0).to_pylist(), part.column(1).to_pylist())
                lang, key, n = zip(*rows) if rows else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(key, pa.int32()),
                                                  pa.array(n, pa.int64())], ["lang", "key", "n"])

    src = train.filter(F.col(lang_col).isNotNull()).select(text_col, F.col(lang_col).cast("string"))
    got = (src.mapInArrow(count, "lang string, key int, n bigint").groupBy("lang", "key")
           .agg(F.sum("n").alias("n"))).toArrow()
    if not got.num_rows:
        return None
    langs, code = np.unique(got["lang"].to_numpy(), return_inverse=True)
    keys, at = np.unique(got["key"].to_numpy(), return_inverse=True)
    counts = np.zeros((len(keys), len(langs)), np.int64)
    counts[at, code] = got["n"].to_numpy()
    return estimate(langs.tolist(), keys.astype(np.int64), counts)


def score_languages(docs: DataFrame, model: LanguageModel | None, penalty: float = 1.0, rounds: int = 20,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, lang_pred, score, languages`` for every row. ``languages`` are the set that was
    chosen with their shares of the words, by falling share (ties by name); ``lang_pred`` is
    the first and ``score`` its share. Null texts, texts without a letter and all texts
    without a model are ``und`` with score 0 and no languages. Whole texts are read."""
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, lang_pred string, score double, languages array<struct<lang:string,share:double>>"
    src = docs.select(F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        import pyarrow as pa
        sets = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
        for batch in batches:
            for a, b in _slices(batch):
                part, m = batch.slice(a, b - a), shared.value
                theta = (np.zeros((len(part), 0)) if m is None else
                         mixtures(m, part.column(0).to_pylist(), penalty, rounds))
                found = []
                for row in theta:
                    held = np.flatnonzero(row > 0)
                    found.append([{"lang": m.langs[i], "share": min(float(row[i]), 1.0)}
                                  for i in held[np.argsort(-row[held], kind="stable")]])
                yield pa.RecordBatch.from_arrays([
                    part.column(1), pa.array([f[0]["lang"] if f else UNKNOWN for f in found], pa.string()),
                    pa.array([f[0]["share"] if f else 0.0 for f in found], pa.float64()),
                    pa.array(found, sets)], ["id", "lang_pred", "score", "languages"])

    return src.mapInArrow(score, schema).withColumnRenamed("id", id_col)
