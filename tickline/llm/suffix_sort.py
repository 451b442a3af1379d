"""Suffix array with common prefixes by induced sorting, in files when memory is short.

The text is an array of symbols that ends in a symbol smaller than all others. A suffix is S-type
if it is smaller than the next suffix, else L-type; an S-type suffix after an L-type one is a seed.
Sorted seeds induce the order of all L-type suffixes (scan upwards: each scanned suffix puts the one
before it into the queue of its first symbol), and these induce the S-type ones (scan downwards).
The queues are priority queues over (first symbol, arrival): an arrival is always larger than what
was scanned, so the smallest waiting suffix is the oldest in the first queue that has one. All queues
of a pass share one array of known size, in a file if it is large, and are read and written some
thousand entries at a time.

Seeds are sorted by the same two passes: sorting the stretches between seeds names them, and if names
repeat, the names are a text of about a third of the length, which is sorted by recursion. A text of
names that is short enough for memory is sorted there by doubling: many symbols, each of which occurs a
few times only, leave the queues little to do at once.

An entry carries the length of the prefix that it shares with the entry scanned before it, up to a
limit. Two neighbours in a queue were put there by two scanned entries; they share one symbol more
than the least prefix value between those two. So prefix values follow from those of the seeds.
"""

from __future__ import annotations

import tempfile

import numpy as np

CHUNK = 1 << 16
#: Arrays of more bytes are kept in files, except those of the size of the seeds (places, order, names, prefixes).
IN_MEMORY = 32 << 20
#: Recursion ends at texts of so many symbols, which are sorted in memory.
DIRECT = 1 << 20


class Scratch:
    """Arrays in memory or, if large, in files of a folder that goes with this object (a task's own
    work space: nothing in it outlives the task or is read by another)."""

    def __init__(self, in_memory: int = IN_MEMORY):
        self.in_memory, self.folder = in_memory, tempfile.TemporaryDirectory(prefix="suffixes-")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self.folder.cleanup()

    def array(self, n: int, dtype) -> np.ndarray:
        if n * np.dtype(dtype).itemsize <= self.in_memory:
            return np.zeros(n, dtype)
        with tempfile.NamedTemporaryFile(dir=self.folder.name, delete=False) as f:
            f.truncate(n * np.dtype(dtype).itemsize)
        return np.memmap(f.name, dtype, "r+", shape=(n,))


def _spans(n: int, step: int = CHUNK * 16):
    for at in range(0, n, step):
        yield at, min(n, at + step)


def _types(text: np.ndarray, scratch: Scratch) -> np.ndarray:
    """True where the suffix is L-type; filled from the end, a span at a time."""
    n = len(text)
    is_l = scratch.array(n, bool)
    is_l[n - 1] = False
    after = False
    for i, j in reversed(list(_spans(n - 1))):
        now, then = np.asarray(text[i:j]), np.asarray(text[i + 1 : j + 1])
        # of equal neighbours the type is that of the next unequal pair
        differ = np.append(now != then, True)
        kind = np.append(now > then, after)
        at = np.where(differ, np.arange(len(differ)), len(differ) - 1)
        at = np.minimum.accumulate(at[::-1])[::-1]
        is_l[i:j] = kind[at][:-1]
        after = bool(is_l[i])
    return is_l


class _Least:
    """Minimum over any stretch of one chunk, by tables of doubling width."""

    def __init__(self, values: np.ndarray):
        self.rows, width = [values], 1
        while 2 * width <= len(values):
            self.rows.append(np.minimum(self.rows[-1][:-width], self.rows[-1][width:]))
            width *= 2

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Over i..j, both included."""
        out = np.empty(len(i), self.rows[0].dtype)
        level = np.frexp((j - i + 1).astype(float))[1] - 1
        for k in np.unique(level):
            pick = level == k
            out[pick] = np.minimum(self.rows[k][i[pick]], self.rows[k][j[pick] - (1 << int(k)) + 1])
        return out


class _Pass:
    """The queues of one pass in scan order: each symbol's queue, then the entries of that symbol that are
    known before (`rest`, in scan order). Queues fill up while the pass reads."""

    def __init__(self, own: np.ndarray, rest_size: np.ndarray, rest_pos: np.ndarray, rest_lcp: np.ndarray | None, scratch: Scratch, limit: int):
        self.own, self.limit = own, limit
        self.start = np.concatenate([[0], np.cumsum(own + rest_size)])
        self.got = np.zeros(len(own), np.int64)
        self.pos = scratch.array(int(self.start[-1]), np.int64)
        self.lcp = scratch.array(int(self.start[-1]), np.uint16) if limit else None
        # the least prefix value that was scanned since the last arrival of each symbol
        self.since = np.full(len(own), limit, np.int64) if limit else None
        ends, before = np.cumsum(rest_size), np.cumsum(own)
        for i, j in _spans(len(rest_pos)):
            at = np.arange(i, j)
            slot = at + before[np.searchsorted(ends, at, side="right")]
            self.pos[slot] = rest_pos[i:j]
            if limit:
                self.lcp[slot] = rest_lcp[i:j]

    def put(self, symbols: np.ndarray, pos: np.ndarray, place: np.ndarray, scanned: np.ndarray | None) -> None:
        """Arrivals in scan order; `place` says which entry of the chunk put each there, `scanned` are the
        chunk's prefix values, each of an entry and the one before it."""
        narrow = symbols.astype(np.uint16) if len(self.own) <= 1 << 16 else symbols
        order = np.argsort(narrow, kind="stable")
        symbols, pos, place = symbols[order], pos[order], place[order]
        heads = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]])) if len(symbols) else np.zeros(0, np.int64)
        count = np.diff(np.append(heads, len(symbols)))
        kinds = symbols[heads]
        slot = np.repeat(self.start[kinds] + self.got[kinds] - heads, count) + np.arange(len(symbols))
        self.pos[slot] = pos
        if self.limit:
            if len(symbols):
                begin = np.concatenate([[0], place[:-1] + 1])
                begin[heads] = 0
                shared = _Least(scanned)(begin, place).astype(np.int64)
                shared[heads] = np.minimum(shared[heads], self.since[kinds])
                shared = np.minimum(shared + 1, self.limit)
                shared[heads[self.got[kinds] == 0]] = 0
                self.lcp[slot] = shared
            self.since = np.minimum(self.since, int(scanned.min()))
            if len(symbols):
                tail = np.minimum.accumulate(np.append(scanned, np.uint16(self.limit))[::-1])[::-1]
                self.since[kinds] = tail[place[heads + count - 1] + 1]
        self.got[kinds] += count

    def scan(self, visit, seam) -> None:
        """Give all entries to `visit(pos, lcp)` in order, chunk by chunk, each as soon as all before it are there.
        `seam` compares the last entry of a queue with the first known one of the same symbol."""
        k, read, total, look = 0, 0, int(self.start[-1]), 64
        while read < total:
            # with many symbols, a queue that waits is near: no need to look at all that a chunk could hold
            while True:
                far = min(k + look, len(self.own))
                waiting = self.got[k:far] < self.own[k:far]
                if waiting.any() or far == len(self.own) or self.start[far] >= read + CHUNK:
                    break
                look *= 4
            look = max(64, min(look, 2 * (int(np.argmax(waiting)) if waiting.any() else look)))
            stop = k + int(np.argmax(waiting)) if waiting.any() else far
            end = int(self.start[stop] + self.got[stop]) if stop < len(self.own) else total
            end = min(end, read + CHUNK)
            if end <= read:
                raise AssertionError("a queue waits for an entry that nothing puts there")
            pos = np.asarray(self.pos[read:end]).copy()
            if self.limit:
                at = self.start[k:far] + self.own[k:far]
                at = at[(self.own[k:far] > 0) & (at < self.start[k + 1 : far + 1]) & (at >= read) & (at < end)]
                if len(at):
                    self.lcp[at] = seam(np.asarray(self.pos[at - 1]), np.asarray(self.pos[at]))
            visit(pos, np.asarray(self.lcp[read:end]).copy() if self.limit else None)
            read = end
            k = int(np.searchsorted(self.start, read, side="right")) - 1

    def queued(self, scratch: Scratch) -> tuple[np.ndarray, np.ndarray | None]:
        """What the queues got, in scan order."""
        n = int(self.own.sum())
        pos, lcp = scratch.array(n, np.int64), scratch.array(n, np.uint16) if self.limit else None
        ends, skip = np.cumsum(self.own), self.start[:-1] - (np.cumsum(self.own) - self.own)
        for i, j in _spans(n):
            at = np.arange(i, j)
            slot = at + skip[np.searchsorted(ends, at, side="right")]
            pos[i:j] = self.pos[slot]
            if self.limit:
                lcp[i:j] = self.lcp[slot]
        return pos, lcp


def _by_doubling(names: np.ndarray) -> np.ndarray:
    """Suffixes in order, in memory. A rank is the place of the first suffix that is still equal; ranks of
    twice as many symbols follow from those of the suffixes that far on. Only ties are sorted again."""
    n = len(names)
    order = np.argsort(names, kind="stable")
    live, rank, key, far = order, np.zeros(n + 1, np.int64), names[order], 1
    base = np.zeros(n, np.int64)  # where the group of equal suffixes began that each live one comes from
    while True:
        first = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.concatenate([[True], base[1:] != base[:-1]])
        at = np.arange(len(live))
        inside = at - np.maximum.accumulate(np.where(group, at, 0))
        rank[live] = np.maximum.accumulate(np.where(first, base + inside, 0))
        tied = ~(first & np.append(first[1:], True))
        live = live[tied]
        if not len(live):
            return np.argsort(rank[:n], kind="stable")
        base = rank[live]
        key = base * (n + 1) + rank[np.minimum(live + far, n)]
        order = np.argsort(key, kind="stable")
        live, base, key, far = live[order], base[order], key[order], 2 * far


class _Text:
    """A text with what its passes ask for."""

    def __init__(self, symbols: np.ndarray, scratch: Scratch):
        self.symbols, self.scratch, self.n = symbols, scratch, len(symbols)
        self.is_l = _types(symbols, scratch)
        count = lambda pick: sum((np.bincount(symbols[i:j][pick(i, j)], minlength=self.sigma) for i, j in _spans(self.n)), np.zeros(self.sigma, np.int64))
        self.sigma = 1 + max(int(symbols[i:j].max()) for i, j in _spans(self.n))
        self.n_l = count(lambda i, j: self.is_l[i:j])
        self.n_s = count(lambda i, j: ~self.is_l[i:j])
        parts = []
        for i, j in _spans(self.n):
            part = np.asarray(self.is_l[max(i - 1, 0) : j])
            parts.append(np.flatnonzero(part[:-1] & ~part[1:]) + max(i - 1, 0) + 1)
        self.seeds = np.concatenate(parts)

    def word(self, at: np.ndarray, k: int) -> np.ndarray:
        """Symbol k places on; 0 beyond the end."""
        at = at + k
        return np.where(at < self.n, self.symbols[np.minimum(at, self.n - 1)], 0)

    def shared(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """Length of the common prefix of suffixes, up to a limit."""
        out = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        words = self.packed()
        step = 8 if words is not None else 1
        for k in range(0, limit, step):
            if not len(live):
                break
            p, q = np.minimum(a[live] + k, self.n - 1), np.minimum(b[live] + k, self.n - 1)
            x, y = (words[p], words[q]) if words is not None else (self.symbols[p], self.symbols[q])
            same = x == y
            if words is not None:
                off = (x ^ y)[~same]
                # the highest byte that differs
                out[live[~same]] = k + (63 - np.floor(np.log2(off.astype(np.float64))).astype(np.int64).clip(0, 63)) // 8
            else:
                out[live[~same]] = k
            live = live[same]
        out[live] = limit
        return np.minimum(out, limit)

    def packed(self) -> np.ndarray | None:
        """Eight symbols a word, for texts of bytes."""
        if self.symbols.dtype != np.uint8:
            return None
        if not hasattr(self, "_packed"):
            self._packed = self.scratch.array(self.n, np.uint64)
            for i, j in _spans(self.n):
                part = np.zeros(j - i + 8, np.uint64)
                have = min(self.n, j + 8) - i
                part[:have] = self.symbols[i : i + have]
                out = part[:-8].copy()
                for k in range(1, 8):
                    out = (out << np.uint64(8)) | part[k : k + j - i]
                self._packed[i:j] = out
        return self._packed

    def _visit(self, into: _Pass, want_l: bool, flip: bool):
        def visit(pos: np.ndarray, lcp: np.ndarray | None) -> None:
            place = np.flatnonzero(pos > 0)
            before = pos[place] - 1
            keep = self.is_l[before] == want_l
            place, before = place[keep], before[keep]
            symbols = self.symbols[before].astype(np.int64)
            into.put(self.sigma - 1 - symbols if flip else symbols, before, place, lcp)

        return visit

    def induce(self, seeds: np.ndarray, lcp: np.ndarray | None, limit: int) -> _Pass:
        """Both passes from seeds that are in order (of their first symbol at least): the downward pass, whose
        entries are all suffixes from the largest to the smallest."""
        per = np.bincount(self.symbols[seeds], minlength=self.sigma) if len(seeds) else np.zeros(self.sigma, np.int64)
        seam = lambda a, b: self.shared(a, b, limit)
        up = _Pass(self.n_l, per, seeds, lcp, self.scratch, limit)
        up.scan(self._visit(up, True, False), seam)
        pos, lcp = up.queued(self.scratch)
        if limit:
            lcp = np.concatenate([[0], lcp[::-1][:-1]]).astype(np.uint16) if len(lcp) else lcp
        down = _Pass(self.n_s[::-1].copy(), self.n_l[::-1].copy(), pos[::-1], lcp, self.scratch, limit)
        down.pos[down.start[-2]] = self.n - 1  # the last suffix, which follows from none
        down.got[-1] = 1
        down.scan(self._visit(down, False, True), seam)
        return down

    def sorted_seeds(self) -> np.ndarray:
        """The seeds in the order of their suffixes."""
        seeds, scratch = self.seeds, self.scratch
        if len(seeds) <= 1:
            return seeds
        first = np.argsort(self.symbols[seeds], kind="stable")
        down = self.induce(seeds[first], None, 0)
        number = scratch.array(self.n, np.int64)  # of each seed, counted from 1
        number[seeds] = np.arange(1, len(seeds) + 1)
        parts = []
        for i, j in reversed(list(_spans(len(down.pos)))):
            pos = np.asarray(down.pos[i:j])[::-1]
            parts.append(pos[number[pos] > 0])
        order = np.concatenate(parts)
        at = number[order] - 1
        length = np.diff(np.append(seeds, self.n - 1)) + 1  # a stretch ends with the next seed's first symbol
        a, b = at[:-1], at[1:]
        new = length[a] != length[b]
        same = np.flatnonzero(~new)
        reach = length[a[same]]
        for k in range(0, int(reach.max()) if len(reach) else 0):
            live = reach > k
            same, reach = same[live], reach[live]
            p, q = seeds[a[same]] + k, seeds[b[same]] + k
            differ = self.symbols[p] != self.symbols[q]
            new[same[differ]] = True
            same, reach = same[~differ], reach[~differ]
        names = np.concatenate([[0], np.cumsum(new)])
        if names[-1] == len(seeds) - 1:
            return order
        reduced = scratch.array(len(seeds), np.int32 if len(seeds) < 1 << 31 else np.int64)
        reduced[at] = names
        del down, number, parts
        if len(reduced) <= DIRECT:
            return seeds[_by_doubling(np.asarray(reduced, np.int64))]
        inner = _Text(reduced, scratch)
        return seeds[inner.suffixes(0)[0]]

    def suffixes(self, limit: int) -> tuple[np.ndarray, np.ndarray | None]:
        """All suffixes in order and, if a limit is given, the prefix each shares with the one before."""
        if self.n == 1:
            return np.zeros(1, np.int64), np.zeros(1, np.uint16) if limit else None
        seeds = self.sorted_seeds()
        lcp = None
        if limit:
            lcp = np.zeros(len(seeds), np.uint16)
            for i, j in _spans(len(seeds) - 1):
                lcp[i + 1 : j + 1] = self.shared(seeds[i:j], seeds[i + 1 : j + 1], limit)
        down = self.induce(seeds, lcp, limit)
        # downwards, a value stands with the smaller of its two suffixes
        return down.pos[::-1], np.concatenate([[0], down.lcp[::-1][:-1]]).astype(np.uint16) if limit else None


def suffix_array(symbols: np.ndarray, limit: int, scratch: Scratch) -> tuple[np.ndarray, np.ndarray | None]:
    """Suffixes in order and the common prefix of each with the one before (up to `limit`; none for 0).

    The last symbol must be 0 and no other may be.
    """
    if len(symbols) == 0 or symbols[-1] != 0:
        raise ValueError("the text must end in symbol 0")
    return _Text(symbols, scratch).suffixes(limit)
