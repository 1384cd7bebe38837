"""Suffix sorting with common prefixes by external induction, to a bounded depth.

Suffixes are L (greater than the next one) or S. The S suffixes behind an L, called S*, are sorted first; one scan
upwards induces the order of all L suffixes, one scan downwards that of all S suffixes. What a scan finds goes into
queues, one per first byte, as tuples (position, common prefix with the queue's previous suffix). A scan reads queues
in the order of their bytes, and what it puts in them comes in order, so the queues together are a priority queue that
never has to move an item. They hold a bounded number of tuples in memory and the rest in a file.

Only the first `depth` bytes count here, so the recursion ends at its first level: S* suffixes are sorted by their
first depth bytes, eight at a time and only where still tied.
"""

from __future__ import annotations

import tempfile

import numpy as np

#: Tuples read from a queue at once, and tuples that all queues keep in memory before they write to disk.
CHUNK, RESIDENT = 1 << 16, 1 << 21
_TUPLE = np.dtype([("at", "<u4"), ("lcp", "u1")])


class Queues:
    """256 first-in first-out queues of tuples, backed by one file that goes with the object."""

    def __init__(self, resident: int = RESIDENT):
        self.file, self.resident, self.held = None, resident, 0
        self.parts: list[list] = [[] for _ in range(256)]  # arrays, or (offset, count) on disk

    def put(self, queue: int, at: np.ndarray, lcp: np.ndarray) -> None:
        t = np.empty(len(at), _TUPLE)
        t["at"], t["lcp"] = at, lcp
        self.parts[queue].append(t)
        self.held += len(t)
        if self.held > self.resident:
            self.spill()

    def spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts:
            for i, p in enumerate(parts):
                if isinstance(p, np.ndarray):
                    parts[i] = (self.file.tell(), len(p))
                    self.file.write(p.tobytes())
        self.held = 0

    def load(self, part) -> np.ndarray:
        if isinstance(part, np.ndarray):
            return part
        self.file.seek(part[0])
        return np.frombuffer(self.file.read(part[1] * _TUPLE.itemsize), _TUPLE)

    def read(self, queue: int, backwards: bool = False):
        """The tuples of a queue in pieces, those put in while it is read included; backwards only of a finished one."""
        parts = self.parts[queue]
        if backwards:
            for part in reversed(parts):
                yield self.load(part)
            return
        i = 0
        while i < len(parts):
            first, i = i, i + 1
            while i < len(parts) and i - first < 4096 and sum(len(p) if isinstance(p, np.ndarray) else p[1] for p in parts[first : i + 1]) <= CHUNK and i - first < 64:
                i += 1
            yield np.concatenate([self.load(p) for p in parts[first:i]])


class _Minima:
    """Range minima of one chunk, and per queue the minimum since its last tuple."""

    def __init__(self, depth: int):
        self.depth = depth
        self.since = np.full(256, 255, np.uint8)

    def feed(self, lcp: np.ndarray, sel: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a chunk of the scan with lcp to each one's predecessor: the selected items, sorted stably by their queue,
        the queue's bounds among them, and their common prefix with the queue's previous tuple."""
        levels = [lcp]
        while (1 << len(levels)) <= len(lcp):
            half, last = 1 << (len(levels) - 1), levels[-1]
            levels.append(np.minimum(last[:-half], last[half:]))

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Minimum of lcp[a..b], a <= b."""
            k = np.frexp((b - a + 1).astype(np.float64))[1] - 1
            out = np.empty(len(a), np.uint8)
            for level in np.unique(k):
                m = k == level
                out[m] = np.minimum(levels[level][a[m]], levels[level][b[m] - (1 << level) + 1])
            return out

        order = np.argsort(to, kind="stable")
        at, queue = sel[order], to[order]
        first = np.r_[True, queue[1:] != queue[:-1]] if len(queue) else np.empty(0, bool)
        begin = np.where(first, 0, np.r_[0, at[:-1] + 1]) if len(at) else at
        found = least(begin, at) if len(at) else np.empty(0, np.uint8)
        found[first] = np.minimum(found[first], self.since[queue[first]])
        # What follows each queue's last tuple of the chunk counts for its next one.
        np.minimum(self.since, lcp.min(), out=self.since)
        if len(at):
            last = np.r_[first[1:], True]
            tail = at[last] + 1
            rest = np.full(len(tail), 255, np.uint8)
            inside = tail < len(lcp)
            if inside.any():
                rest[inside] = least(tail[inside], np.full(inside.sum(), len(lcp) - 1))
            self.since[queue[last]] = rest
        bounds = np.flatnonzero(np.r_[first, True])
        return order, bounds, np.minimum(found.astype(np.int64) + 1, self.depth).astype(np.uint8)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading bytes that big-endian words share, 8 if equal."""
    x = a ^ b
    top = np.frexp(x.astype(np.float64))[1].astype(np.int64)
    top = np.where((top > 0) & (np.right_shift(x, np.maximum(top - 1, 0).astype(np.uint64)) == 0), top - 1, top)
    return np.where(x == 0, 8, (64 - top) // 8)


def sort_starts(text: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions sorted by their first depth bytes, and the common prefix of each with the one before (0 for the first)."""
    padded = np.concatenate([text, np.zeros(depth + 16, np.uint8)])
    words = np.ndarray((len(padded) - 7,), ">u8", padded.tobytes(), strides=(1,))
    n = len(at)
    key = words[at].astype(np.uint64)
    order = np.argsort(key, kind="stable")
    at, key = at[order], key[order]
    lcp = np.zeros(n, np.int64)
    lcp[1:] = _common(key[1:], key[:-1])
    done = 8
    tied = lcp == done
    while done < depth and tied.any():
        # Groups of ties are runs: each begins one before its first tied item.
        member = tied | np.r_[tied[1:], False]
        idx = np.flatnonzero(member)
        group = np.cumsum(~tied[idx])
        key = words[at[idx] + done].astype(np.uint64)
        order = np.lexsort((key, group))
        at[idx], key = at[idx][order], key[order]
        more = np.zeros(len(idx), np.int64)
        more[1:] = _common(key[1:], key[:-1])
        inner = tied[idx]
        lcp[idx[inner]] = done + more[inner]
        done += 8
        tied = lcp == done
    return at, np.minimum(lcp, depth).astype(np.uint8)


def suffix_order(text: np.ndarray, depth: int, resident: int = RESIDENT):
    """The suffixes of a text of bytes in order of their first depth bytes, in pieces of (positions, common prefixes).

    A common prefix is that with the suffix before, depth at most; suffixes may be told to share bytes beyond the end of
    the text, which callers that look at whole matches inside it don't meet.
    """
    n = len(text)
    if not n:
        return
    t = np.append(text, 0).astype(np.int16)
    t[n] = -1
    # Runs of equal bytes: their type is that of their last byte.
    edge = np.flatnonzero(t[1:] != t[:-1])
    starts = np.r_[0, edge + 1]
    lengths = np.diff(np.r_[starts, n + 1])
    rising = np.r_[t[starts[1:]] > t[starts[:-1]], True]
    s_type = np.repeat(rising, lengths)[: n + 1]
    s_type[n] = True
    run_end = np.repeat((starts + lengths).astype(np.uint32), lengths)[: n + 1]
    star = np.flatnonzero(s_type[1:n] & ~s_type[: n - 1]) + 1
    if len(star):
        star, star_lcp = sort_starts(text, star, depth)
    else:
        star_lcp = np.empty(0, np.uint8)
    cut = np.searchsorted(t[star], np.arange(257)) if len(star) else np.zeros(257, np.int64)

    def run(p: int) -> int:
        return min(depth, int(run_end[p]) - p)

    up, down = Queues(resident), Queues(resident)
    if not s_type[n - 1]:
        up.put(int(t[n - 1]), np.array([n - 1]), np.zeros(1, np.uint8))  # induced by the end of the text

    def scan(queues: Queues, mins: _Minima, at: np.ndarray, lcp: np.ndarray, wanted: np.ndarray, prev: np.ndarray) -> None:
        """Put the predecessors of a chunk of the scan that are wanted into their queues."""
        sel = np.flatnonzero(wanted)
        order, bounds, common = mins.feed(lcp, sel, prev[sel])
        at = at[sel][order] - 1
        to = t[at]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            q = int(to[a])
            queues.put(q, at[a:b], common[a:b] if queues.parts[q] else np.r_[np.uint8(0), common[a + 1 : b]])

    def before(at: np.ndarray) -> np.ndarray:
        return np.where(at > 0, t[at - 1], np.int16(-2))

    # Upwards: L suffixes. mins starts at 0 for queues that have no tuple, as put() above writes 0 for a first one.
    mins = _Minima(depth)
    for c in range(256):
        last, fresh = None, True
        for piece in up.read(c):
            at, lcp = piece["at"].astype(np.int64), piece["lcp"].copy()
            if fresh:
                lcp[0], fresh = 0, False
            prev = before(at)
            scan(up, mins, at, lcp, prev >= c, prev)
            last = int(at[-1])
        if cut[c + 1] > cut[c]:
            at, lcp = star[cut[c] : cut[c + 1]], star_lcp[cut[c] : cut[c + 1]].copy()
            lcp[0] = 0 if last is None else min(run(last), run(int(at[0])))
            for i in range(0, len(at), CHUNK):
                a = at[i : i + CHUNK]
                prev = before(a)
                scan(up, mins, a, lcp[i : i + CHUNK], prev > c, prev)
    # Downwards: S suffixes. The common prefix of a tuple is with the one above it.
    mins = _Minima(depth)
    for c in range(255, -1, -1):
        last, fresh = None, True
        for piece in down.read(c):
            at, lcp = piece["at"].astype(np.int64), piece["lcp"].copy()
            if fresh:
                lcp[0], fresh = 0, False
            prev = before(at)
            scan(down, mins, at, lcp, (prev <= c) & (prev >= 0), prev)
            last = int(at[-1])
        carry = None
        for piece in up.read(c, backwards=True):
            at = piece["at"][::-1].astype(np.int64)
            own = piece["lcp"][::-1]
            first = carry if carry is not None else 0 if last is None else min(run(last), run(int(at[0])))
            lcp = np.r_[np.uint8(first), own[:-1]].astype(np.uint8)
            carry = int(own[-1])
            prev = before(at)
            for i in range(0, len(at), CHUNK):
                p = prev[i : i + CHUNK]
                scan(down, mins, at[i : i + CHUNK], lcp[i : i + CHUNK], (p < c) & (p >= 0), p)
    for c in range(256):
        last, fresh = None, True
        for piece in up.read(c):
            lcp = piece["lcp"].copy()
            if fresh:
                lcp[0], fresh = 0, False
            yield piece["at"].astype(np.int64), lcp
            last = int(piece["at"][-1])
        pieces = down.read(c, backwards=True)
        carry = None
        for piece in pieces:
            at, own = piece["at"][::-1].astype(np.int64), piece["lcp"][::-1]
            first = carry if carry is not None else 0 if last is None else min(run(last), run(int(at[0])))
            yield at, np.r_[np.uint8(first), own[:-1]].astype(np.uint8)
            carry = int(own[-1])
