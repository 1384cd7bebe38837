"""Plain-Python answers, by brute force, of the queries that SQL doesn't express. Each takes a DuckDB connection and gives rows as
tuples in the order of their column names."""

from __future__ import annotations

import difflib
import hashlib
from collections import Counter, defaultdict

import regex


def words(text):
    return [w for w in regex.split(r"[ \t\n\x0b\f\r]+", text or "") if w]


def texts(duck):
    return {i: t for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall() if t is not None}


def grouped(rows, n=1):
    out = defaultdict(list)
    for r in rows:
        out[r[:n] if n > 1 else r[0]].append(r)
    return out


def pack_chunks(duck):
    out = []
    for i, t in texts(duck).items():
        pack, total = -1, 0
        for pos, line in enumerate(t.split("\n"), 1):
            size = max(1, len(line) // 4)
            if pack < 0 or total + size > 120:
                pack, total = pack + 1, 0
            total += size
            out.append((i, pack, pos, size))
    return out


def cut_documents(duck):
    out = []
    for i, t in texts(duck).items():
        n = part = 0
        for w in words(t):
            n += 1
            if n >= 1000 or (n >= 600 and w[-1] in ".!?"):
                out.append((i, part, n))
                part, n = part + 1, 0
        if n:
            out.append((i, part, n))
    return out


def sync_align(duck):
    all_ = texts(duck)
    out = []
    for i, t in all_.items():
        if i + 1 in all_:
            old, new = t.split("\n"), all_[i + 1].split("\n")
            a = b = 0
            for m in difflib.SequenceMatcher(None, old, new, autojunk=False).get_matching_blocks():
                out += [(i, b + k, a + k if a + k < m.a else None) for k in range(m.b - b)]
                out += [(i, m.b + k, m.a + k) for k in range(m.size)]
                a, b = m.a + m.size, m.b + m.size
    return out


def probe_exclusion(duck):
    out = []
    for c, rows in grouped(duck.sql("SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice FROM orders").fetchall()).items():
        taken = set()
        for p in sorted({r[1] for r in rows}):
            free = [r for r in rows if r[1] == p and r[2] not in taken]
            for r in sorted(free, key=lambda r: (-r[3], r[2]))[:2]:
                taken.add(r[2])
                out.append((c, r[2], p))
    return out


def linked_ranges(duck):
    out = []
    for u, rows in grouped(duck.sql("SELECT user_id, event_id, event_type FROM events WHERE event_type IN ('view', 'click')").fetchall()).items():
        lows = []
        for _, e, kind in sorted(rows, key=lambda r: r[1]):
            if kind == "view":
                lows.append(e)
            elif lows:
                out.append((e, lows.pop(0), u))
    return out


BOXES = """SELECT l_orderkey, (l_linenumber * 100000 + l_partkey) * 10000 + l_suppkey, l_returnflag, l_quantity, l_partkey % 400 AS x, l_suppkey * 37 % 600 AS y,
    l_partkey % 400 + 100 + l_quantity * 5 AS x1, l_suppkey * 37 % 600 + 80 + l_quantity AS y1 FROM lineitem"""


def shared(a, b):
    w, h = min(a[6], b[6]) - max(a[4], b[4]), min(a[7], b[7]) - max(a[5], b[5])
    if w <= 0 or h <= 0:
        return 0.0
    size = lambda r: (r[6] - r[4]) * (r[7] - r[5])
    return w * h / (size(a) + size(b) - w * h)


def best_boxes(rows, most):
    kept = []
    for r in sorted(rows, key=lambda r: (-r[3], r[1])):
        if not any(shared(r, k) > most for k in kept):
            kept.append(r)
    return kept


def suppressed_boxes(duck):
    by = defaultdict(list)
    for r in duck.sql(BOXES).fetchall():
        by[r[0], r[2]].append(r)
    return [(r[1], r[2], r[0], r[3]) for rows in by.values() for r in best_boxes(rows, 0.5)]


def suppressed_media(duck):
    out = []
    for rows in grouped(duck.sql(BOXES).fetchall()).values():
        out += [(r[1], "table" if r[2] == "A" else "image", r[0]) for r in best_boxes([r for r in rows if r[2] in "AN"], 0.3)]
        out += [(r[1], "text", r[0]) for r in rows if r[2] == "R"]
    return out


def matched_boxes(duck):
    out = []
    for page, rows in grouped(duck.sql(BOXES).fetchall()).items():
        a = sorted((r for r in rows if r[3] % 2 == 0), key=lambda r: r[1])
        b = sorted((r for r in rows if r[3] % 3 == 0), key=lambda r: r[1])
        free_a, free_b = list(range(len(a))), list(range(len(b)))
        while True:
            pairs = [(-shared(a[i], b[j]), i, j) for i in free_a for j in free_b if shared(a[i], b[j]) >= 0.5]
            if not pairs:
                break
            _, i, j = min(pairs)
            free_a.remove(i)
            free_b.remove(j)
            out.append((b[j][1], "match" if a[i][2] == b[j][2] else "confusion", page, a[i][1]))
        out += [(None, "missed", page, a[i][1]) for i in free_a] + [(b[j][1], "extra", page, None) for j in free_b]
    return out


def ordered_blocks(duck):
    out = []
    for page, rows in grouped(duck.sql(BOXES).fetchall()).items():
        bands = [[]]
        for r in sorted(rows, key=lambda r: (r[5], r[4], r[1])):
            if r[6] - r[4] >= 0.6 * 600:
                bands += [[r], []]
            else:
                bands[-1].append(r)
        flat = []
        for band in bands:
            for right in (False, True):
                flat += sorted((r for r in band if ((r[4] + r[6]) / 2 > 300 and r[6] - r[4] < 360) == right), key=lambda r: (r[5], r[4], r[1]))
        out += [(r[1], page, k) for k, r in enumerate(flat, 1)]
    return out


def nearest_captions(duck):
    out = []
    for page, rows in grouped(duck.sql(BOXES).fetchall()).items():
        free = [r for r in rows if r[2] == "N"]
        for m in sorted((r for r in rows if r[2] == "A"), key=lambda r: r[1]):
            near = [(max(c[5] - m[7], m[5] - c[7], 0), c[1], c) for c in free]
            near = [x for x in near if x[0] <= 60]
            if near:
                best = min(near)[2]
                free.remove(best)
                out.append((best[1], m[1], page))
    return out


def corrected_texts(duck):
    out = []
    for i, t in texts(duck).items():
        lines = sorted((x for x in t.split("\n") if len(x) > 30), key=lambda x: (-len(x), x))
        spans = []
        for x in lines:
            at = t.find(x)
            if t.find(x, at + 1) < 0 and all(at + len(x) <= a or at >= b for a, b in spans):
                spans.append((at, at + len(x)))
        made, done = "", 0
        for a, b in sorted(spans):
            made, done = made + t[done:a] + t[a:b].upper(), b
        out.append((len(spans), i, hashlib.md5((made + t[done:]).encode()).hexdigest()))
    return out


def lost_shingles(duck):
    out = []
    for i, t in texts(duck).items():
        w = words(t)
        runs = lambda ws: {tuple(ws[k : k + 8]) for k in range(len(ws) - 7)}
        out.append((i, len(runs(w) - runs(w[:100])), len(runs(w))))
    return out


def located_quotes(duck):
    out = []
    for i, t in texts(duck).items():
        lines = t.split("\n")
        asked = [x.lower() for x in regex.findall(r"[\p{L}\p{N}]+", " ".join(words(lines[0])[1:13]))]
        best = None
        for s, line in enumerate(lines):
            said = regex.findall(r"[\p{L}\p{N}]+", line)
            low = [x.lower() for x in said]
            for a in range(len(asked)):
                for b in range(len(low)):
                    n = 0
                    while a + n < len(asked) and b + n < len(low) and asked[a + n] == low[b + n]:
                        n += 1
                    if n >= 3 and (best is None or (-n, s, b) < best[0]):
                        best = ((-n, s, b), " ".join(said[b : b + min(n, 8)]))
        if best:
            out.append((best[1], i, best[0][1], -best[0][0]))
    return out


def page_gutters(duck):
    out = []
    for page, rows in grouped(duck.sql("SELECT l_orderkey, l_partkey % 400, l_quantity FROM lineitem").fetchall()).items():
        columns = []
        for _, x, q in sorted(rows, key=lambda r: (r[1], r[2])):
            if 40 + q < 360:
                if columns and x < columns[-1][1] + 8:
                    columns[-1] = (columns[-1][0], max(columns[-1][1], x + 40 + q), columns[-1][2] + int(q))
                else:
                    columns.append((x, x + 40 + q, int(q)))
        total, strong = sum(c[2] for c in columns) or 1, []
        for c in columns:
            if c[2] >= 0.15 * total:
                strong.append(list(c))
            elif strong:
                strong[-1][1] = max(strong[-1][1], c[1])
        edges = [(a[1] + b[0]) / 2 for a, b in zip(strong, strong[1:], strict=False)]
        out.append((edges, len(edges), page))
    return out


def split_sections(duck):
    out = []
    for i, t in texts(duck).items():
        sizes = [len(words(x)) for x in t.split("\n")]
        cuts, run = [], 0
        for k, n in enumerate(sizes):
            if k and run >= 120:
                cuts.append(k)
                run = 0
            run += n
        kept, last = [], 0
        for c in cuts if sum(sizes) > 200 else []:
            if sum(sizes[last:c]) >= 100:
                kept.append(c)
                last = c
        if kept and sum(sizes[kept[-1] :]) < 100:
            kept.pop()
        out += [(i, sum(c <= k for c in kept), k + 1, n) for k, n in enumerate(sizes)]
    return out


def matched_authors(duck):
    return [(k % 5 < 3 and "abcde"[k % 5] in "abc" and _meets(k), k) for (k,) in duck.sql("SELECT s_suppkey FROM supplier").fetchall()]


def _meets(k):
    """Family names are muller and boX, the words read are mueller, muller and boY."""
    return Counter(["muller", "bo" + "abcde"[k % 5]]) - Counter(["mueller", "muller", "bo" + "abc"[k % 3]]) == Counter()


PLAIN = {f.__name__: f for f in (
    pack_chunks, cut_documents, sync_align, probe_exclusion, linked_ranges, suppressed_boxes, suppressed_media, matched_boxes, ordered_blocks, nearest_captions, corrected_texts, lost_shingles, located_quotes, page_gutters, split_sections, matched_authors)}
