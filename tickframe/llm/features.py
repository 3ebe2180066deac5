"""NumPy features of the two classifiers (run inside tasks, pickled by value)."""

from __future__ import annotations

import numpy as np

from .kernels import LOWER, PLAIN, SPACE, U, grams, spans_hash, words

# ------------------------------------------------------------------ toxicity

#: Levels of an expression: its first 3 bytes, its first 5, the whole word.
PREFIXES = (3, 5, None)


def expressions(data: np.ndarray, offs: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of every word at each level, and its row."""
    plain = PLAIN[data]
    starts, ends, row = words(plain, offs)
    out = []
    for level, p in enumerate(PREFIXES):
        stop = ends if p is None else np.minimum(ends, starts + p)
        out.append(spans_hash(plain, starts, stop) ^ U(level))
    return out, row


def once_per_row(value: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (value, row) pairs, sorted by value."""
    order = np.lexsort((row, value))
    v, r = value[order], row[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    return v[new], r[new]


def class_counts(data: np.ndarray, offs: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct expressions of all levels and the documents of each class (0, 1) that
    hold them."""
    levels, row = expressions(data, offs)
    v, r = once_per_row(np.concatenate(levels), np.tile(row, len(levels)))
    if len(v) == 0:
        return v, np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
    one = np.add.reduceat(label[r].astype(np.int64), first)
    return v[first], np.stack([np.diff(np.append(first, len(v))) - one, one], axis=1)


def _counts_of(h: np.ndarray, units: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Class counts of expressions, zeros for those that ``units`` (sorted) lacks."""
    if len(units) == 0:
        return np.zeros((len(h), 2))
    at = np.minimum(np.searchsorted(units, h), len(units) - 1)
    return np.where((units[at] == h)[:, None], counts[at], 0).astype(np.float64)


def log_ratios(levels: list[np.ndarray], own: np.ndarray | None, units: np.ndarray, counts: np.ndarray,
               prior: float, discount: float) -> np.ndarray:
    """Per word, log P(word | toxic) - log P(word | ordinary).

    With shared counts c(w) of an expression, P(w | class) is P(class | w) c(w) /
    P(class). P(class | w) is Kneser-Ney smoothed: each class count is discounted,
    and what was taken off (in proportion to the number of classes seen) goes to the
    shorter expression's distribution, down to the class shares. ``own`` (class of
    the word's document) leaves the document itself out of the counts. ``units`` are
    the sorted hashes of the counted expressions."""
    if own is None:
        # a word's ratio is the same everywhere: each distinct word is looked up once
        _, one, every = np.unique(levels[-1], return_index=True, return_inverse=True)
        levels = [h[one] for h in levels]
    p = np.full(len(levels[0]), prior)
    for h in levels:
        c = _counts_of(h, units, counts)
        if own is not None:
            seen = c.sum(axis=1) > 0
            c[seen, own[seen]] = np.maximum(c[seen, own[seen]] - 1, 0)
        total = c.sum(axis=1)
        back = discount * ((c > 0).sum(axis=1))
        p = np.where(total > 0, (np.maximum(c[:, 1] - discount, 0) + back * p) / np.maximum(total, 1), p)
    ratio = np.log(p / (1 - p)) - np.log(prior / (1 - prior))
    return ratio if own is not None else ratio[every]


def toxic_evidence(data: np.ndarray, offs: np.ndarray, units: np.ndarray, counts: np.ndarray, prior: float,
                   discount: float, margin: float, label: np.ndarray | None = None) -> np.ndarray:
    """Per row: what its words' log ratios exceed the row's reference by, beyond
    ``margin``, summed and divided by the root of the number of words. The reference
    is the row's median, which takes out what a text's language or topic tells about
    its class, where that is below 0: toxic words never excuse each other. A word's
    evidence is at most its own log ratio, so neutral words have none."""
    n_rows = len(offs) - 1
    levels, row = expressions(data, offs)
    out = np.zeros(n_rows)
    if len(row) == 0:
        return out
    ratio = log_ratios(levels, None if label is None else label[row], units, counts, prior, discount)
    n = np.bincount(row, minlength=n_rows)
    order = np.lexsort((ratio, row))
    first = np.cumsum(n) - n
    some = n > 0
    middle = np.zeros(n_rows)
    middle[some] = np.minimum(ratio[order][(first + (n - 1) // 2)[some]], 0)
    over = np.maximum(np.minimum(ratio - middle[row] - margin, ratio), 0)
    return np.bincount(row, over, minlength=n_rows) / np.sqrt(np.maximum(n, 1))


# ------------------------------------------------------------------ quality

#: Byte classes: other, upper, lower, digit, space, plain punctuation, ``!``, symbols.
CLASS = np.zeros(256, np.int64)
CLASS[65:91], CLASS[97:123], CLASS[48:58], CLASS[SPACE] = 1, 2, 3, 4
CLASS[[b for b in range(33, 127) if not chr(b).isalnum()]] = 7
CLASS[[ord(c) for c in ".,;:'\"-()?"]] = 5
CLASS[ord("!")] = 6

QUALITY = ("log words", "mean word length", "spread of word lengths", "upper case", "digits",
           "plain punctuation", "exclamation", "symbols", "same word twice", "distinct words",
           "repeated 3-grams", "words ending in a symbol", "lone punctuation", "lines")


def _distinct(value: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    return np.bincount(once_per_row(value, row)[1], minlength=n_rows)


def quality_features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The columns of ``QUALITY`` for every row; zeros for a text without words."""
    m = len(offs) - 1
    row_of_byte = np.repeat(np.arange(m), np.diff(offs))
    kind = np.bincount(row_of_byte * 8 + CLASS[data], minlength=m * 8).reshape(m, 8).astype(float)
    n_bytes = np.maximum(np.diff(offs), 1)
    low = LOWER[data]
    starts, ends, row = words(low, offs)
    h = spans_hash(low, starts, ends)
    n = np.bincount(row, minlength=m)
    some = np.maximum(n, 1)
    size = (ends - starts).astype(float)
    mean = np.bincount(row, size, minlength=m) / some
    spread = np.sqrt(np.maximum(np.bincount(row, size ** 2, minlength=m) / some - mean ** 2, 0))
    twice = np.zeros(len(h), bool)
    twice[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    g = grams(h, 3)
    inside = row[:len(g)] == row[len(row) - len(g):]
    g, g_row = g[inside], row[:len(g)][inside]
    last = CLASS[data[ends - 1]] if len(ends) else np.zeros(0, np.int64)
    per_word = lambda w: np.bincount(row, w, minlength=m) / some
    return np.column_stack([
        np.log1p(n), mean, spread, kind[:, 1] / np.maximum(kind[:, 1] + kind[:, 2], 1), kind[:, 3] / n_bytes,
        kind[:, 5] / n_bytes, kind[:, 6] / some, kind[:, 7] / some, per_word(twice),
        _distinct(h, row, m) / some,
        1 - _distinct(g, g_row, m) / np.maximum(np.bincount(g_row, minlength=m), 1),
        per_word(last >= 6), per_word((size == 1) & (last >= 5)),
        np.bincount(row_of_byte, data == 10, minlength=m) / some])


def basis(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features (held within 6 spreads), their squares and sizes."""
    z = np.clip((x - mean) / scale, -6, 6)
    return np.column_stack([z, z ** 2, np.abs(z)])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))
