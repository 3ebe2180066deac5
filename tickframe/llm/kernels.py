"""NumPy kernels that run inside tasks (pickled by value, see the package root).

Texts of an Arrow batch are worked on as one byte array with offsets, in
slices of bounded size, so temporary arrays stay small whatever the batch.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

U = np.uint64
MASK = (1 << 64) - 1
#: Base of the rolling polynomial (any odd number has an inverse modulo 2**64).
BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1 << 20

#: Space and the controls 9 to 13 separate words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Lower case, with ASCII punctuation as space.
PLAIN = LOWER.copy()
PLAIN[[b for b in range(33, 127) if not chr(b).isalnum()]] = 32
#: A random 64-bit value per byte, so that the polynomial does not see raw bytes.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.int64).view(U) * U(2) + U(1)

_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, U)
        have[0] = 1
        have = np.cumprod(have, dtype=U)
        _powers[base] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    t = x >> U(32)
    t ^= x
    t *= U(0xD6E8FEB86659FD93)
    u = t >> U(32)
    t ^= u
    t *= U(0xD6E8FEB86659FD93)
    np.right_shift(t, U(32), out=u)
    t ^= u
    return t


def texts(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, offs


def slices(offs: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes (a longer text alone)."""
    a, n = 0, len(offs) - 1
    while a < n:
        b = int(np.searchsorted(offs, offs[a] + limit, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def ranges(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All numbers of the ranges ``lo <= x < hi``, one range after the other."""
    size = np.maximum(hi - lo, 0)
    skip = np.repeat(np.cumsum(size) - size, size)
    return np.repeat(lo, size) + np.arange(size.sum()) - skip


def row_of(offs: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.searchsorted(offs, at, "right") - 1


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; ``offs`` counts from the start of ``data``."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    ink = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1] | edge[1:n]
    last[:-1] &= ~ink[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, row_of(offs, starts)


def spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes anywhere."""
    h = np.zeros(len(data) + 1, U)
    np.cumsum(BYTE_VALUE[data] * powers(BASE, len(data)), out=h[1:])
    inv = powers(pow(BASE, -1, 1 << 64), len(data) + 1)
    return mix64((h[ends] - h[starts]) * inv[starts] + (ends - starts).astype(U))


def grams(values: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive values (by position, across rows)."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    h = np.zeros(len(values) + 1, U)
    np.multiply(values, powers(BASE, len(values)), out=h[1:])
    np.cumsum(h, out=h)
    g = h[k:] - h[:n]
    g *= powers(pow(BASE, -1, 1 << 64), n)
    g += U(k)
    return mix64(g)


# ------------------------------------------------------------------ simhash

def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the groups of ``hashes`` that start at ``first``
    (none empty): a bit is set if it is in over half of the group's hashes."""
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    size = np.diff(np.append(first, len(hashes)))
    return np.packbits(ones * 2 > size[:, None], axis=1, bitorder="little").view("<u8").ravel()


def shingle_fingerprints(data: np.ndarray, offs: np.ndarray, shingle: int, hash_of) -> np.ndarray:
    """Fingerprint of every row over its ``shingle``-word shingles, repeats
    included: words lower-cased (A-Z) and joined by one space; fewer words: the
    whole sequence; none: zero. ``hash_of(bytes) -> int``."""
    low = LOWER[data]
    starts, ends, row = words(low, offs)
    out = np.zeros(len(offs) - 1, U)
    if len(starts) == 0:
        return out
    # squeeze the gaps between words to one space
    keep = np.zeros(len(low) + 1, bool)
    keep[:-1] = ~SPACE[low]
    keep[ends] = True
    new = np.cumsum(keep) - 1
    low = np.append(low, np.uint8(32))
    # where a row ends in a word, the next row's first byte stands at ``ends``
    low[ends[SPACE[low[ends]]]] = 32
    text = low[keep].tobytes()
    a, b = new[starts], new[ends - 1] + 1
    n_words = np.bincount(row, minlength=len(out))
    firsts = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    n_sh = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    sh_row = np.repeat(np.arange(len(out)), n_sh)
    sh_first = np.concatenate([[0], np.cumsum(n_sh)[:-1]])
    i = firsts[sh_row] + np.arange(len(sh_row)) - sh_first[sh_row]
    j = i + np.minimum(shingle, n_words[sh_row]) - 1
    hs = np.fromiter(map(hash_of, [text[x:y] for x, y in zip(a[i].tolist(), b[j].tolist())]), U, len(i))
    full = n_sh > 0
    out[full] = majority(hs, sh_first[full])
    return out


# ------------------------------------------------------------------ decontamination

def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every word of the texts, letters A-Z lower-cased and ASCII
    punctuation read as space."""
    plain = PLAIN[data]
    starts, ends, row = words(plain, offs)
    return spans_hash(plain, starts, ends), row


class ItemIndex:
    """SimHash multi-index over a block of benchmark items.

    Items are kept by their number of words. A fingerprint is taken over word
    hashes. It is cut into ``blocks`` blocks; two fingerprints within ``radius``
    bits agree in at least one block up to ``radius // blocks`` bits. Per block a
    sorted table lists every value that near with its item, 6 bytes each. The driver
    builds the index once; its ``state`` is what is broadcast.
    """

    @classmethod
    def of(cls, state: dict) -> "ItemIndex":
        index = cls.__new__(cls)
        index.__dict__.update(state)
        return index

    @property
    def state(self) -> dict:
        return self.__dict__

    def __init__(self, items: list[tuple], shingle: int, radius: int, blocks: int, least: float):
        self.shingle, self.radius, self.blocks, self.least = shingle, radius, blocks, least
        self.width = 64 // blocks
        raw = [(t or "").encode() for _, t in items]
        offs = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        hashes, row = word_hashes(np.frombuffer(b"".join(raw), np.uint8), offs)
        by_len: dict[int, list[int]] = {}
        per_item = [hashes[row == i] for i in range(len(items))]
        for i, h in enumerate(per_item):
            if len(h):
                by_len.setdefault(len(h), []).append(i)
        self.ids = [x for x, _ in items]
        self.counts = [self.weigh(h) for h in per_item]
        self.by_len = {}
        near = [v for v in range(1 << self.width) if v.bit_count() <= radius // blocks]
        near = np.array(near, np.int64)
        for n, group in sorted(by_len.items()):
            fps = np.concatenate([majority(per_item[i], np.array([0])) for i in group])
            tables = []
            for b in range(blocks):
                value = ((fps >> U(b * self.width)) & U((1 << self.width) - 1)).astype(np.int64)
                keys = (value[:, None] ^ near[None, :]).ravel()
                who = np.repeat(np.arange(len(group)), len(near))
                order = np.argsort(keys, kind="stable")
                tables.append((keys[order].astype(np.uint32 if self.width > 16 else np.uint16), who[order].astype(np.int32)))
            self.by_len[n] = (np.array(group), fps, tables)
        sizes = sorted({min(shingle, n) for n in by_len})
        self.members = {k: np.unique(np.concatenate(
            [grams(per_item[i], k) for n, g in by_len.items() if min(shingle, n) == k for i in g]))
            for k in sizes}

    def weigh(self, hashes: np.ndarray) -> dict[int, int]:
        """Shingle -> weight, the number of its occurrences."""
        k = min(self.shingle, len(hashes))
        keys, n = np.unique(grams(hashes, k) if k else hashes, return_counts=True)
        return dict(zip(keys.tolist(), n.tolist()))

    def near(self, fps: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``fps``, item number) of all pairs within the radius."""
        group, own, tables = self.by_len[n_words]
        found = []
        for b, (keys, who) in enumerate(tables):
            value = ((fps >> U(b * self.width)) & U((1 << self.width) - 1)).astype(keys.dtype)
            lo, hi = np.searchsorted(keys, value, "left"), np.searchsorted(keys, value, "right")
            found.append(np.stack([np.repeat(np.arange(len(fps)), hi - lo), who[ranges(lo, hi)]]))
        pairs = np.unique(np.concatenate(found, axis=1), axis=1)
        close = np.bitwise_count(fps[pairs[0]] ^ own[pairs[1]]) <= self.radius
        return pairs[0][close], group[pairs[1][close]]

    def similarity(self, hashes: np.ndarray, item: int) -> float:
        mine, its = self.weigh(hashes), self.counts[item]
        both = sum(min(n, its.get(k, 0)) for k, n in mine.items())
        total = sum(mine.values()) + sum(its.values()) - both
        return both / total if total else 0.0

    def search(self, data: np.ndarray, offs: np.ndarray):
        """(row, item, first word, similarity) of every window as long as an item
        whose weighted shingles are similar enough to it. A row with fewer words than
        the item is one window."""
        hashes, row = word_hashes(data, offs)
        if len(hashes) == 0:
            return
        size = np.bincount(row, minlength=len(offs) - 1)
        begin = np.cumsum(size) - size
        for k, members in self.members.items():
            g = grams(hashes, k)
            at = np.searchsorted(members, g)
            at[at == len(members)] = 0
            known = members[at] == g
            known &= row[:len(g)] == row[k - 1:]
            hits = np.flatnonzero(known)
            row_hits = np.bincount(row[hits], minlength=len(size))
            for n in self.by_len:
                # a window that holds too few shingles of any item cannot be similar:
                # ``need`` hits in a row must lie in it
                need = max(1, math.ceil(self.least * (n - k + 1) - 1e-9))
                if min(self.shingle, n) != k or len(hits) < need:
                    continue
                short = np.flatnonzero((size < n) & (size >= need + k - 1) & (row_hits >= need))
                if len(short):
                    words_of = hashes[ranges(begin[short], begin[short] + size[short])]
                    fps = majority(words_of, np.cumsum(size[short]) - size[short])
                    for d, item in zip(*self.near(fps, n)):
                        a = begin[short[d]]
                        s = self.similarity(hashes[a:a + size[short[d]]], int(item))
                        if s >= self.least:
                            yield int(short[d]), int(item), int(a), s
                lo, hi = hits[need - 1:] - (n - k), hits[:len(hits) - need + 1]
                fits = lo <= hi
                first = np.unique(ranges(np.maximum(lo[fits], 0), hi[fits] + 1))
                first = first[first + n <= len(hashes)]
                first = first[row[first] == row[first + n - 1]]
                for cut in range(0, len(first), 1 << 12):
                    part = first[cut:cut + (1 << 12)]
                    window = hashes[part[:, None] + np.arange(n)]
                    fps = majority(window.ravel(), np.arange(len(part)) * n)
                    for w, item in zip(*self.near(fps, n)):
                        s = self.similarity(window[w], int(item))
                        if s >= self.least:
                            yield int(row[part[w]]), int(item), int(part[w]), s
