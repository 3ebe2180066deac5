"""NumPy and automaton kernels of the substring operators (pickled by value).

A *window* is ``n`` consecutive symbols (words or bytes) of one row. Every window
holds an *anchor*: the rightmost of its ``k``-grams with the smallest hash. Equal
windows hold equal anchors, so rows that share a window share an anchor.
"""

from __future__ import annotations

import numpy as np

from .kernels import BASE, BYTE_VALUE, U, grams, mix64, ranges, row_of, spans_hash, words

KEY_BYTES, PLACE_BYTES = 5, 2
UNIT_LOADS = 64
#: An automaton holds about this many reference words; more make several, one after the other.
AUTOMATON_WORDS = 1 << 16
HIGH, LOW = U(0xFFFFFFFF00000000), U(0xFFFFFFFF)


class Words:
    """Symbols are words (runs without space and the controls 9 to 13)."""
    n, k = 35, 18
    #: Symbols of a text that are dealt together, and their smallest part.
    block, unit = 1024, 64
    #: Symbols that meet in a shard on account of one block.
    load = 1 << 18

    @staticmethod
    def places(data, offs):
        """Row, first byte and end byte of every symbol."""
        starts, ends, row = words(data, offs)
        return row, starts, ends

    @staticmethod
    def values(data, starts, ends):
        """Hash of every symbol."""
        return spans_hash(data, starts, ends)

    @staticmethod
    def keep(data, starts, ends, lo, hi) -> bytes:
        """The words outside the spans ``lo:hi``, joined by one space."""
        out, raw, at = [], data[starts[0]:ends[-1]].tobytes() if len(starts) else b"", 0
        base = starts[0] if len(starts) else 0
        for a, z in zip([*lo, len(starts)], [*hi, len(starts)]):
            if a > at:
                out += raw[starts[at] - base:ends[a - 1] - base].split()
            at = z
        return b" ".join(out)


class Bytes:
    """Symbols are bytes."""
    n, k = 50, 24
    block, unit = 4096, 256
    load = 1 << 20

    @staticmethod
    def places(data, offs):
        at = np.arange(len(data) + 1)
        return np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs)), at[:-1], at[1:]

    @staticmethod
    def values(data, starts, ends):
        return BYTE_VALUE[data]

    @staticmethod
    def keep(data, starts, ends, lo, hi) -> bytes:
        """The bytes outside the spans ``lo:hi``."""
        out, at = [], 0
        for a, z in zip([*lo, len(starts)], [*hi, len(starts)]):
            if a > at:
                out.append(data[starts[at]:ends[a - 1]].tobytes())
            at = z
        return b"".join(out)


def anchors(values: np.ndarray, row: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of all windows."""
    w, total = n - k + 1, len(values) - n + 1
    if total <= 0:
        z = np.zeros(0, np.int64)
        return z, z.astype(U)
    g = grams(values, k)
    # half a hash, then the position counted backwards: the minimum of a window is
    # its smallest (half) hash, rightmost of equals
    low = (g & HIGH) | (LOW - np.arange(len(g), dtype=U))
    span = 1
    while span < w:
        step = min(span, w - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    inside = row[:total] == row[n - 1:]
    mark = np.zeros(len(g), bool)
    mark[(LOW - (low[:total][inside] & LOW)).astype(np.int64)] = True
    pos = np.flatnonzero(mark)
    return pos, g[pos]


def split_key(h: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 40-bit key of an anchor hash."""
    return ((h & U(0xFFFFFF)) % U(buckets)).astype(np.int32), h >> U(24)


def pack(key: np.ndarray, size: int = KEY_BYTES) -> bytes:
    return key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def unpack(raw: bytes, size: int = KEY_BYTES) -> np.ndarray:
    b = np.frombuffer(raw, np.uint8).reshape(-1, size)
    out = np.zeros((len(b), 8), np.uint8)
    out[:, :size] = b
    return out.view("<u8").ravel()


def anchor_blobs(kind, data, offs, ids: np.ndarray, buckets: int, most: int):
    """(bucket, ids, counts, keys, places) of the anchors of some rows; a row names an
    anchor at most ``most`` times. A place is the number of the anchor's unit in its
    row (modulo 65536: it only says what to deal together)."""
    row, starts, ends = kind.places(data, offs)
    pos, h = anchors(kind.values(data, starts, ends), row, kind.n, kind.k)
    b, key = split_key(h, buckets)
    r = row[pos]
    place = ((pos - np.searchsorted(row, r)) // kind.unit) & 0xFFFF
    order = np.lexsort((key, r, b))
    b, key, r, place = b[order], key[order], r[order], place[order]
    keep = np.ones(len(b), bool)
    if len(b) > most:
        keep[most:] = (b[most:] != b[:-most]) | (r[most:] != r[:-most]) | (key[most:] != key[:-most])
    b, key, r, place = b[keep], key[keep], r[keep], place[keep]
    if len(b) == 0:
        return
    first = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (r[1:] != r[:-1])]))
    size = np.diff(np.append(first, len(b)))
    of_bucket = np.flatnonzero(np.concatenate([[True], np.diff(b[first]) != 0]))
    for lo, hi in zip(of_bucket, np.append(of_bucket[1:], len(first))):
        a, z = first[lo], first[hi] if hi < len(first) else len(b)
        yield (int(b[a]), ids[r[first[lo:hi]]].tobytes(), size[lo:hi].astype(np.int32).tobytes(), pack(key[a:z]),
               pack(place[a:z], PLACE_BYTES))


def shared_anchors(kind, ids: np.ndarray, keys: np.ndarray, places: np.ndarray, by_id: bool, shards: int, parts: int):
    """Of a bucket's (id, key, place) those whose key is shared (by several ids if
    ``by_id``, else named more than once), with the shard they meet in: (part, ids,
    keys, shards), ids dealt over ``parts``.

    The shard is that of a stretch of the row with the smallest id: its block of
    ``kind.block`` symbols, whatever the number of rows that share it, so that
    neighbouring anchors meet in one place and a row's stretches are as many as its
    blocks. Where so many rows share it that their blocks exceed ``kind.load``
    symbols, the stretch is a fourth of the block, then a sixteenth (one unit). Units
    of near copies are mostly equal, and equal stretches are matched once; where even
    they exceed ``UNIT_LOADS`` times the load, an anchor is dealt by itself."""
    order = np.lexsort((ids, keys))
    i, k = ids[order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    size = np.diff(np.append(first, len(k)))
    if by_id:
        last = first + size - 1
        some = i[first] != i[last]
    else:
        some = size > 1
    # the place of an anchor in the row with the smallest id: its first there
    least = np.minimum.reduceat(np.where(i == np.repeat(i[first], size), places[order], 1 << 16), first) \
        if len(first) else first
    home = mix64(k[first] + U(1))
    stretch = kind.unit
    while stretch <= kind.block:
        fits = size * stretch <= kind.load * (UNIT_LOADS if stretch == kind.unit else 1)
        at = (least // (stretch // kind.unit)).astype(U) * U(64) + U(stretch.bit_length())
        home = np.where(fits, mix64(mix64(i[first].view(U)) + at * U(BASE)), home)
        stretch *= 4
    shard = (home % U(shards)).astype(np.int32)
    take = np.repeat(some, size)
    i, k, s = i[take], k[take], np.repeat(shard, size)[take]
    same = np.ones(len(i), bool)          # one mention of a key by a row is enough from here on
    same[1:] = (i[1:] != i[:-1]) | (k[1:] != k[:-1])
    i, k, s = i[same], k[same], s[same]
    part = (mix64(i.view(U) + U(2)) % U(parts)).astype(np.int32)
    order = np.lexsort((i, part))
    i, k, s, part = i[order], k[order], s[order], part[order]
    edge = np.searchsorted(part, np.arange(parts + 1))
    for p in np.unique(part):
        a, z = edge[p], edge[p + 1]
        yield int(p), i[a:z].tobytes(), pack(k[a:z]), s[a:z].tobytes()


def by_row(rows: list[tuple]):
    """(id, names, shards) per id, from (bucket, ids, keys, shards): a name is an
    anchor's key and bucket in 64 bits."""
    ids = np.concatenate([np.frombuffer(i, np.int64) for _, i, _, _ in rows])
    names = np.concatenate([(unpack(k) << U(24)) | U(b) for b, _, k, _ in rows])
    shards = np.concatenate([np.frombuffer(s, np.int32) for _, _, _, s in rows])
    order = np.argsort(ids, kind="stable")
    ids, names, shards = ids[order], names[order], shards[order]
    first = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
    for a, z in zip(first, np.append(first[1:], len(ids))):
        yield int(ids[a]), names[a:z].tobytes(), shards[a:z].tobytes()


def _in_row(row: np.ndarray, name: np.ndarray) -> np.ndarray:
    return mix64(name) + row.astype(U) * U(0x9E3779B97F4A7C15)


def segments(kind, data, offs, names: list, shards: list, buckets: int):
    """(shard, row, first symbol, bytes) of the stretches around shared anchors, given
    per row their packed names and shards."""
    row, starts, ends = kind.places(data, offs)
    pos, h = anchors(kind.values(data, starts, ends), row, kind.n, kind.k)
    if len(pos) == 0 or not names:
        return
    size = [len(x) // 8 for x in names]
    have = _in_row(np.repeat(np.arange(len(names)), size), np.frombuffer(b"".join(names), U))
    shard = np.frombuffer(b"".join(shards), np.int32)
    order = np.argsort(have)
    have, shard = have[order], shard[order]
    b, key = split_key(h, buckets)
    mine = _in_row(row[pos], (key << U(24)) | b.astype(U))
    at = np.minimum(np.searchsorted(have, mine), len(have) - 1)
    hit = have[at] == mine
    pos, shard = pos[hit], shard[at[hit]]
    r = row[pos]
    begin = np.searchsorted(row, r)
    lo = np.maximum(pos - (kind.n - kind.k), begin)
    hi = np.minimum(pos + kind.n, np.searchsorted(row, r, "right"))
    order = np.lexsort((pos, shard, r))
    shard, r, lo, hi, begin = shard[order], r[order], lo[order], hi[order], begin[order]
    if len(r) == 0:
        return
    cut = np.ones(len(r), bool)
    cut[1:] = (r[1:] != r[:-1]) | (shard[1:] != shard[:-1]) | (lo[1:] > hi[:-1])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(r)) - 1
    raw = data.tobytes()
    yield from zip(shard[first].tolist(), r[first].tolist(), (lo[first] - begin[first]).tolist(),
                   [raw[x:y] for x, y in zip(starts[lo[first]].tolist(), ends[hi[last] - 1].tolist())])


def _runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(flag: np.ndarray, seg_of: np.ndarray, seg_first: np.ndarray, seg_start: np.ndarray, n: int):
    """Per segment with flagged windows: (segment, begins, ends) of what they cover,
    in symbols of its row."""
    lo, hi = _runs(flag)
    # a run never leaves its segment: the last n - 1 positions of one have no window
    s = seg_of[lo]
    a = lo - seg_first[s] + seg_start[s]
    z = hi - 1 + n - seg_first[s] + seg_start[s]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else []
    for x, y in zip(first, np.append(first[1:], len(s)) if len(s) else []):
        yield int(s[x]), a[x:y], z[x:y]


# ------------------------------------------------------------------ words: suffix automaton

class Automaton:
    """Suffix automaton of several word sequences (numbers), states as parallel lists.
    ``end`` is where a state's first occurrence ends, in the joined sequence."""

    def __init__(self):
        self.next, self.link, self.len, self.end = [{}], [-1], [0], [-1]

    def add(self, seq: list[int], base: int) -> None:
        nxt, link, length, end = self.next, self.link, self.len, self.end
        last = 0
        for i, c in enumerate(seq):
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
                continue
            if q is None:
                cur = len(nxt)
                nxt.append({})
                link.append(0)
                length.append(length[last] + 1)
                end.append(base + i)
                p = last
                while p != -1 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                if p == -1:
                    last = cur
                    continue
                q = nxt[p][c]
                if length[q] == length[p] + 1:
                    link[cur] = q
                    last = cur
                    continue
                link[cur] = self._clone(p, c, q)
                last = cur
            else:
                last = self._clone(last, c, q)

    def _clone(self, p: int, c: int, q: int) -> int:
        nxt, link, length = self.next, self.link, self.len
        new = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        self.end.append(self.end[q])
        link[q] = new
        while p != -1 and nxt[p].get(c) == q:
            nxt[p][c] = new
            p = link[p]
        return new

    def match(self, seq: list[int], least: int) -> list[int]:
        """Matching statistics: per position, where a match of at least ``least``
        symbols that ends there ends in the reference, else -1."""
        nxt, link, length, end = self.next, self.link, self.len, self.end
        out, v, size = [], 0, 0
        for c in seq:
            while v and c not in nxt[v]:
                v = link[v]
                size = length[v]
            if c in nxt[v]:
                v = nxt[v][c]
                size += 1
            out.append(end[v] if size >= least else -1)
        return out


def _windows(values: np.ndarray, seg_of: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the window at every position, and whether it lies in one segment."""
    h = np.zeros(len(values), U)
    ok = np.zeros(len(values), bool)
    total = len(values) - n + 1
    if total > 0:
        h[:total] = grams(values, n)
        ok[:total] = seg_of[:total] == seg_of[n - 1:]
    return h, ok


def repeated_words(bodies: list[bytes], starts: np.ndarray, n: int):
    """Covered stretches of the segments of one shard whose windows occur more than
    once. The reference is every repeated window once; its automaton gives the
    matching statistics of all stretches that may repeat, which count, exactly,
    how often each reference window occurs."""
    numbers: dict[bytes, int] = {}
    seqs = [[numbers.setdefault(w, len(numbers)) for w in b.split()] for b in bodies]
    size = np.array([len(s) for s in seqs], np.int64)
    seg_of = np.repeat(np.arange(len(seqs)), size)
    seg_first = np.cumsum(size) - size
    token = np.fromiter((t for s in seqs for t in s), np.int64, int(size.sum()))
    h, ok = _windows(mix64(token.astype(U) + U(1)), seg_of, n)
    at = np.flatnonzero(ok)
    order = at[np.argsort(h[at], kind="stable")]
    if len(order) == 0:
        return
    first = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    count = np.diff(np.append(first, len(order)))
    often = count > 1
    # a window of the reference, the first of its hash, and all windows that may equal it
    chosen = np.sort(order[first[often]])
    who = np.full(len(token), -1, np.int64)
    many = np.repeat(often, count)
    who[order[many]] = np.repeat(order[first], count)[many]
    flag = np.zeros(len(token), bool)
    # the reference in parts of bounded size: each has an automaton of its own, and only
    # the windows that may equal one of the part are streamed through it
    for lo in range(0, len(chosen), AUTOMATON_WORDS):
        part = chosen[lo:lo + AUTOMATON_WORDS]
        mine = np.zeros(len(token), bool)
        mine[part] = True
        asked = (who >= part[0]) & (who <= part[-1])
        flag |= _repeated(token, mine, asked, n)
    yield from covered(flag, seg_of, seg_first, starts, n)


def _repeated(token: np.ndarray, chosen: np.ndarray, asked: np.ndarray, n: int) -> np.ndarray:
    """Which of the ``asked`` windows equal a ``chosen`` one that occurs more than once
    among them: by the matching statistics of the automaton of the chosen windows."""
    ref, base = Automaton(), 0
    for lo, hi in zip(*_runs(chosen)):
        part = token[lo:hi - 1 + n].tolist()
        ref.add(part, base)
        base += len(part)
    found = np.full(len(token), -1, np.int64)
    known: dict[bytes, np.ndarray] = {}
    for lo, hi in zip(*_runs(asked)):
        part = token[lo:hi - 1 + n]
        name = part.tobytes()             # equal stretches are streamed once
        if name not in known:
            known[name] = np.array(ref.match(part.tolist(), n)[n - 1:], np.int64)
        found[lo:hi] = known[name]
    hit = found >= 0
    count = np.bincount(found[hit], minlength=max(base, 1))
    hit[hit] = count[found[hit]] > 1
    return hit


# ------------------------------------------------------------------ bytes: run-length BWT

class RunIndex:
    """Run-compressed Burrows-Wheeler transform of pieces of bytes, with the text
    positions of the first and last row of every run.

    Symbol 0 ends a piece, a byte b is symbol b + 1."""

    def __init__(self, text: np.ndarray):
        # a suffix that runs out differs from any other there
        self.padded = np.concatenate([text, np.full(64, -1, np.int64)])
        self.pack = np.full(len(text) + 64, -1, np.int64)
        self.pack[:len(text)] = packed = self._packed(text)
        sa = self._suffixes(packed)
        bwt = text[sa - 1]
        head = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        self.n = len(text)
        self.start = head                                     # first row of each run
        self.stop = np.append(head[1:], self.n) - 1           # last row of each run
        self.symbol = bwt[head].astype(np.int64)
        self.sa_start, self.sa_stop = sa[self.start], sa[self.stop]
        size = self.stop - self.start + 1
        order = np.argsort(self.symbol, kind="stable")        # runs by symbol, then row
        before = np.zeros(len(head), np.int64)
        before[order] = np.cumsum(size[order]) - size[order]  # LF of a run's first row
        self.lf = before
        self.by_symbol = order
        self.width = len(head) + 1
        self.keys = self.symbol[order] * self.width + order

    @staticmethod
    def _packed(text: np.ndarray) -> np.ndarray:
        """7 symbols from every position on, in one number."""
        n = len(text)
        key = np.zeros(n, np.int64)
        for j in range(7):
            key *= 257
            key[:max(n - j, 0)] += text[j:]
        return key

    @staticmethod
    def _suffixes(key: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling from 7 packed symbols."""
        n = len(key)
        depth = 7
        while True:
            order = np.argsort(key)
            k = key[order]
            step = np.concatenate([[0], np.cumsum(k[1:] != k[:-1])])
            rank = np.empty(n, np.int64)
            rank[order] = step
            if step[-1] == n - 1 or depth >= n:
                return order
            key = rank * (n + 1)
            key[:max(n - depth, 0)] += rank[depth:] + 1
            depth *= 2

    def common(self, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``a`` and ``b``, up to ``most``
        (within which the suffix at ``a`` does not end): first by packs of 7 symbols."""
        out = np.zeros(len(a), np.int64)
        for step, symbols in ((7, self.pack), (1, self.padded)):
            live = np.flatnonzero(out + step <= most)
            while len(live):
                live = live[symbols[a[live] + out[live]] == symbols[b[live] + out[live]]]
                out[live] += step
                live = live[out[live] + step <= most[live]]
        return out

    def stream(self, queries: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: int):
        """Matching statistics of the query stretches ``lo:hi``, all of them read from
        right to left in step: yields (positions, match lengths up to ``most``, text
        positions). Where the wanted symbol is not in the current run, the nearer of
        the neighbouring runs of that symbol is taken, by the longer common prefix with
        their sampled ends."""
        order = np.argsort(lo - hi, kind="stable")            # longest first
        lo, hi = lo[order], hi[order]
        row = np.zeros(len(lo), np.int64)
        at = np.full(len(lo), self.sa_start[0])
        size = np.zeros(len(lo), np.int64)
        for step in range(int((hi - lo).max()) if len(lo) else 0):
            live = int(np.searchsorted(lo - hi, -step, "left"))  # those longer than ``step``
            q = hi[:live] - 1 - step
            c = queries[q].astype(np.int64)
            run = np.searchsorted(self.start, row[:live], "right") - 1
            same = self.symbol[run] == c
            s = np.flatnonzero(same)
            r = run[s]
            row[s] = self.lf[r] + row[s] - self.start[r]
            at[s] -= 1
            size[s] = np.minimum(size[s] + 1, most)
            m = np.flatnonzero(~same)
            if len(m):
                cm = c[m]
                j = np.searchsorted(self.keys, cm * self.width + run[m])
                up, down = np.maximum(j - 1, 0), np.minimum(j, len(self.keys) - 1)
                ru, rd = self.by_symbol[up], self.by_symbol[down]
                has_u, has_d = (j > 0) & (self.symbol[ru] == cm), (j < len(self.keys)) & (self.symbol[rd] == cm)
                # beyond the current match a longer common prefix has no use
                both = self.common(np.tile(at[m], 2), np.concatenate([self.sa_stop[ru], self.sa_start[rd]]),
                                   np.where(np.concatenate([has_u, has_d]), np.tile(size[m], 2), 0))
                lu = np.where(has_u, both[:len(m)], -1)
                ld = np.where(has_d, both[len(m):], -1)
                go_up = lu >= ld
                best = np.where(go_up, lu, ld)
                ok = best >= 0
                to = np.where(go_up, ru, rd)
                row[m] = np.where(ok, self.lf[to] + np.where(go_up, self.stop[to] - self.start[to], 0), 0)
                at[m] = np.where(ok, np.where(go_up, self.sa_stop[to], self.sa_start[to]) - 1, self.sa_start[0])
                size[m] = np.where(ok, np.minimum(best + 1, most), 0)
            yield q, size[:live], at[:live]


def repeated_bytes(bodies: list[bytes], ids: np.ndarray, starts: np.ndarray, n: int, chunk: int = 512):
    """Covered stretches of the segments of one shard whose windows also start in a
    row with a smaller id. The reference is every window that several ids hold, once,
    from its smallest id; its run-length index gives the matching statistics of all
    stretches that later ids may share, and the place of each match tells its id."""
    size = np.array([len(b) for b in bodies], np.int64)
    seg_of = np.repeat(np.arange(len(bodies)), size)
    seg_first = np.cumsum(size) - size
    data = np.frombuffer(b"".join(bodies), np.uint8)
    h, ok = _windows(BYTE_VALUE[data], seg_of, n)
    at = np.flatnonzero(ok)
    if len(at) == 0:
        return
    at = at[np.argsort(h[at])]
    who = ids[seg_of[at]]
    k = h[at]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    count = np.diff(np.append(first, len(at)))
    least = np.minimum.reduceat(who, first)
    several = least != np.maximum.reduceat(who, first)
    mine = who == np.repeat(least, count)
    asked, chosen = np.zeros(len(data), bool), np.zeros(len(data), bool)
    asked[at[np.repeat(several, count) & ~mine]] = True
    # the first place of the smallest id
    place = np.minimum.reduceat(np.where(mine, at, len(data)), first)
    chosen[place[several]] = True
    lo, hi = _runs(chosen)
    if len(lo) == 0:
        return
    # the reference: chosen runs, each closed by symbol 0
    length = hi - lo + n - 1
    place = np.cumsum(length + 1) - (length + 1)
    text = np.zeros(int((length + 1).sum()), np.int64)
    source = ranges(lo, hi + n - 1)
    text[ranges(place, place + length)] = data[source].astype(np.int64) + 1
    owner = np.zeros(len(text), np.int64)
    owner[ranges(place, place + length)] = ids[seg_of[source]]
    index = RunIndex(text)
    # stretches asked for, in chunks of bounded length that overlap by a window
    lo, hi = _runs(asked)
    parts = (hi - lo + chunk - 1) // chunk
    skip = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * chunk
    a = np.repeat(lo, parts) + skip
    z = np.minimum(a + chunk, np.repeat(hi, parts)) + n - 1
    symbols = data.astype(np.int64) + 1
    flag = np.zeros(len(data), bool)
    for q, matched, where in index.stream(symbols, a, z, n):
        good = np.flatnonzero(matched >= n)
        x = q[good]
        flag[x[owner[where[good]] < ids[seg_of[x]]]] = True
    flag &= asked
    yield from covered(flag, seg_of, seg_first, starts, n)


def covered_stretches(kind, bodies: list[bytes], ids: np.ndarray, starts: np.ndarray, by_id: bool):
    """Per stretch of a shard with covered symbols: (stretch, begins, ends), in symbols of
    its row. Equal stretches are matched once, as that of their smallest id: it holds all
    windows of the others, which are covered from end to end (``by_id``: those of larger
    ids; else itself as well)."""
    same: dict[bytes, list[int]] = {}
    for x, body in enumerate(bodies):
        same.setdefault(body, []).append(x)
    groups = list(same.values())
    lead = [min(g, key=ids.__getitem__) for g in groups]
    one = [bodies[x] for x in lead]
    found = (repeated_bytes(one, ids[lead], np.zeros(len(lead), np.int64), kind.n) if by_id
             else repeated_words(one, np.zeros(len(lead), np.int64), kind.n))
    spans = {g: (lo, hi) for g, lo, hi in found}
    for g, rows in enumerate(groups):
        size = len(one[g]) if by_id else len(one[g].split())
        whole = (np.zeros(1, np.int64), np.array([size])) if size >= kind.n else None
        for x in rows:
            copy = len(rows) > 1 and (not by_id or ids[x] > ids[lead[g]])
            got = whole if copy else spans.get(g)
            if got is not None:
                yield x, got[0] + starts[x], got[1] + starts[x]


def union(spans: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The union of half-open spans, as maximal ones."""
    lo = np.concatenate([x for x, _ in spans])
    hi = np.concatenate([x for _, x in spans])
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], np.maximum.accumulate(hi[order])
    cut = np.ones(len(lo), bool)
    cut[1:] = lo[1:] > hi[:-1]
    first = np.flatnonzero(cut)
    return lo[first], hi[np.append(first[1:], len(lo)) - 1]
