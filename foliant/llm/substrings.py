"""Removal of repeated passages by suffix arrays (operator 10).

Every byte that lies in a LENGTH-byte string which also starts in a document of smaller id is removed. Suffix arrays
of whole corpora don't fit a task, so the corpus is cut by content. Each LENGTH-byte window has an anchor, the least
hash among its substrings of a fixed length; equal windows have equal anchors, wherever they stand. Runs of windows
with one anchor are segments.

1. Rows of equal texts: all but the smallest id are covered whole and go no further.
2. Anchors, as packed arrays, meet in shards; those of one document only are dropped, with most of the corpus.
3. Windows of shared anchors are cut from the texts, as segments by a coarser anchor. Equal segments within a task are decided there, so one of each
   kind goes on: a passage that a third of all documents share costs one segment per task.
4. Each shard of segments is sorted by external induction (foliant.llm.induced). Runs of suffixes that share LENGTH
   bytes are classes of equal windows; all but those of the class's smallest id are covered.
5. Documents with covered windows are rewritten; all others keep the digest they have.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import checked, made, staged, sweep, text_bytes, with_ids
from foliant.llm.induced import suffix_order
from foliant.session import ship_package

LENGTH = 50
#: Bytes of the substrings that tell shared windows (long: few are shared by chance) and that deal windows to shards
#: (short: more windows in a row have one).
TELLS, DEALS = 24, 12
#: Bytes of text whose anchors one packed row set holds, and bytes of segments held before they are sent.
FLUSH = 16 << 20
#: Anchors and segment bytes that a shard should have.
SHARD_ANCHORS, SHARD_BYTES = 1_000_000, 6 << 20
#: Documents from which an anchor is hot, and hot anchors at most: with more data the bound on documents rises.
HOT, HOT_KEYS = 5_000, 100_000

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
#: Bits of an anchor that are kept besides its shard.
_BITS = 40


def gram_hashes(text: bytes, gram: int) -> np.ndarray:
    """Hashes of all substrings of gram bytes, a multiple of 4 from 8 on."""
    n = len(text) - gram + 1
    words = np.ndarray((len(text) - 7,), "<u8", text, strides=(1,))
    h = words[:n] * _A
    for at in [*range(8, gram - 7, 8), *([gram - 8] if gram % 8 else [])]:
        h ^= h >> np.uint64(29)
        h += words[at : at + n]
        h *= _B
    h ^= h >> np.uint64(32)
    h *= _C
    h ^= h >> np.uint64(29)
    return h


def anchors(text: bytes, gram: int) -> np.ndarray:
    """For each window of LENGTH bytes the least hash among its substrings of gram bytes."""
    n, span = len(text) - LENGTH + 1, LENGTH - gram + 1
    m, width = gram_hashes(text, gram), 1
    while width * 2 <= span:
        m = np.minimum(m[:-width], m[width:])
        width *= 2
    return np.minimum(m[:n], m[span - width : span - width + n])


def within(n: int, ends: np.ndarray) -> np.ndarray:
    """Which of the first n windows of joined texts, that end at ends, lie within a text."""
    mark = np.zeros(n + 1, np.int32)
    np.add.at(mark, np.maximum(ends - LENGTH + 1, np.r_[0, ends[:-1]]).clip(0, n), 1)
    np.add.at(mark, ends.clip(0, n), -1)
    return np.cumsum(mark[:n]) == 0


def runs(m: np.ndarray, valid: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, number) of the runs of valid windows with equal anchors, none across texts."""
    n = len(m)
    new = np.empty(n, bool)
    new[0] = True
    np.not_equal(m[1:], m[:-1], out=new[1:])
    new[1:] |= ~valid[:-1]
    new[ends[ends < n]] = True
    first = np.flatnonzero(new & valid)
    stop = np.flatnonzero(np.r_[new | ~valid, True])
    return first, stop[np.searchsorted(stop, first, "right")] - first


def keyed(anchor: np.ndarray, shards: int) -> np.ndarray:
    """Anchors cut to their shard and _BITS more."""
    return ((anchor >> np.uint64(_BITS)) % np.uint64(shards) << np.uint64(_BITS)) | (anchor & np.uint64((1 << _BITS) - 1))


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(ids, texts) of about FLUSH bytes; texts shorter than LENGTH are left out."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            b = text_bytes(x.as_py())
            if len(b) < LENGTH:
                continue
            ids.append(i)
            texts.append(b)
            size += len(b)
            if size >= FLUSH:
                yield np.array(ids, np.int64), texts
                ids, texts, size = [], [], 0
    if ids:
        yield np.array(ids, np.int64), texts


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Bounds of stretches of texts of about 1 MB, whose arrays stay in the cache."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= 1 << 20):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def _document_keys(ids: np.ndarray, texts: list[bytes], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """(id, key) of the distinct anchors of each text."""
    out = []
    for i, j in _groups(texts):
        ends = np.cumsum([len(t) for t in texts[i:j]])
        m = anchors(b"".join(texts[i:j]), TELLS)
        first, _ = runs(m, within(len(m), ends), ends)
        own, key = np.searchsorted(ends, first, "right"), keyed(m[first], shards)
        order = np.lexsort((key, own))
        own, key = own[order], key[order]
        fresh = np.r_[True, (own[1:] != own[:-1]) | (key[1:] != key[:-1])] if len(own) else np.empty(0, bool)
        out.append((ids[i:j][own[fresh]], key[fresh]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def _shared_here(owner: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, mask in that order of keys that two documents have, of each key's first row, rows of each key)."""
    order = np.argsort(key, kind="stable")
    k, o = key[order], owner[order]
    lead = np.r_[True, k[1:] != k[:-1]] if len(k) else np.empty(0, bool)
    begin = np.flatnonzero(lead)
    several = np.minimum.reduceat(o, begin) != np.maximum.reduceat(o, begin) if len(k) else np.empty(0, bool)
    rows = np.diff(np.r_[begin, len(k)])
    return order, np.repeat(several, rows), lead, np.repeat(rows, rows)


_PLACES = "id long, key long"
_PACKED = "shard int, ids binary, low binary, docs binary"


def keys_shared_here(shards: int):
    """Rows of _PLACES for anchors that two documents of the same FLUSH bytes have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            own, key = _document_keys(ids, texts, shards)
            order, mask, _, _ = _shared_here(own, key)
            at = order[mask]
            for i in range(0, len(at), 50_000):
                part = at[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(own[part]), pa.array(key[part].view(np.int64))], ["id", "key"])

    return run


def packed_anchors(shards: int):
    """Packed rows per shard: all anchors that only one document of the batch has, and one of each other anchor, each with the
    number of documents of the batch that have it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _batches(batches):
            own, key = _document_keys(ids, texts, shards)
            order, mask, lead, size = _shared_here(own, key)
            docs = np.where(mask, size, 1)[~mask | lead].astype("<u4")
            keep = order[~mask | lead]  # by key, so by shard
            shard = (key[keep] >> np.uint64(_BITS)).astype(np.int64)
            bounds = np.searchsorted(shard, np.arange(shards + 1))
            low = key[keep].view(np.uint8).reshape(-1, 8)[:, : _BITS // 8]
            rows = []
            for k in np.flatnonzero(np.diff(bounds)):
                at = slice(bounds[k], bounds[k + 1])
                # In the order of ids, these compress well, and the anchors don't in any order.
                by = np.argsort(own[keep[at]], kind="stable")
                rows.append((int(k), own[keep[at]][by].tobytes(), low[at][by].tobytes(), docs[at][by].tobytes()))
            for i in range(0, len(rows), 64):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if j == 0 else pa.binary()) for j, c in enumerate(zip(*rows[i : i + 64], strict=True))], [c.split()[0] for c in _PACKED.split(", ")])

    return run


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def keys_shared_between(hot: int):
    """Of one shard of packed anchors: those of two documents, without the rows found by keys_shared_here, and a row without
    an id for each anchor of more than hot documents."""

    def run(group: pa.Table) -> pa.Table:
        ids = np.frombuffer(_joined(group["ids"]), np.int64)
        low = np.zeros((len(ids), 8), np.uint8)
        low[:, : _BITS // 8] = np.frombuffer(_joined(group["low"]), np.uint8).reshape(-1, _BITS // 8)
        key = low.view("<u8").ravel()
        docs = np.frombuffer(_joined(group["docs"]), "<u4")
        order = np.argsort(key, kind="stable")
        k, o, n = key[order], ids[order], docs[order]
        begin = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        shared = (np.minimum.reduceat(o, begin) != np.maximum.reduceat(o, begin)) | (np.maximum.reduceat(n, begin) > 1)
        at = order[np.repeat(shared, np.diff(np.r_[begin, len(k)])) & (n == 1)]
        many = k[begin[np.add.reduceat(n.astype(np.int64), begin) > hot]]
        full = lambda x: pa.array(x.view(np.int64) | (group["shard"][0].as_py() << _BITS))
        found = pa.table({"id": pa.array(ids[at]), "key": full(key[at])})
        return pa.concat_tables([found, pa.table({"id": pa.nulls(len(many), pa.int64()), "key": full(many)})]) if len(many) else found

    return run


_SENT = "shard int, ids binary, first binary, windows binary, body binary"
_COVERED = "id long, first long, windows int"
#: Bits of a place in a text; what is above them is the number of the text among those of its key.
PART = 32


def cut_segments(tells: int, shards: int, hot: np.ndarray):
    """From rows (id, text, keys, part) to packed rows: shard -1 for windows covered within the task, else segments to sort.

    first is a window's place in its text, with the text's part number in the bits from PART on. Windows whose anchor
    isn't among the keys are in no other document. The others are dealt to shards by a second anchor, but for windows of a
    hot anchor: what is left of those when equal segments of the task are settled is dealt window by window, by a hash of
    the whole window, so that a passage with many documents around it fills no shard. Whether a window is hot depends on
    its bytes only, so equal windows meet.
    """
    names = [c.split()[0] for c in _SENT.split(", ")]

    def packed(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(rows), 16):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if j == 0 else pa.binary()) for j, c in enumerate(zip(*rows[i : i + 16], strict=True))], names)

    def cut(ids: list[int], texts: list[bytes], keys: list[np.ndarray], parts: list[int]) -> Iterator[tuple]:
        """(body, id, first, windows, shard, flags of its hot windows or None)."""
        for i, j in _groups(texts):
            ends = np.cumsum([len(t) for t in texts[i:j]])
            starts = np.r_[0, ends[:-1]]
            body = b"".join(texts[i:j])
            m = anchors(body, TELLS)
            valid = within(len(m), ends)
            first, count = runs(m, valid, ends)
            own = np.searchsorted(ends, first, "right")
            mixed = lambda key, of: (key + of.astype(np.uint64) * _C) * _A  # noqa: E731  key and text as one number
            wanted = mixed(np.concatenate(keys[i:j]).astype(np.int64).view(np.uint64), np.repeat(np.arange(j - i), [len(k) for k in keys[i:j]]))
            anchor = keyed(m[first], tells)
            hit = np.isin(mixed(anchor, own), wanted)
            mark = np.zeros(len(m) + 1, np.int32)
            np.add.at(mark, first[hit], 1)
            np.add.at(mark, first[hit] + count[hit], -1)
            shared = np.cumsum(mark[:-1]) > 0
            warm = None
            busy = hit.copy()
            busy[hit] = np.isin(anchor[hit], hot)
            if busy.any():
                mark = np.zeros(len(m) + 1, np.int32)
                np.add.at(mark, first[busy], 1)
                np.add.at(mark, first[busy] + count[busy], -1)
                warm = np.cumsum(mark[:-1]) > 0
            m = anchors(body, DEALS)
            first, count = runs(m, shared, ends)
            own = np.searchsorted(ends, first, "right")
            shard = (m[first] % np.uint64(shards)).astype(np.int64)
            upto = np.zeros(1, np.int64) if warm is None else np.r_[0, np.cumsum(warm)]
            some = [False] * len(first) if warm is None else (upto[first + count] > upto[first]).tolist()
            for f, w, o, s, flagged in zip(first.tolist(), count.tolist(), own.tolist(), shard.tolist(), some, strict=True):
                yield body[f : f + w + LENGTH - 1], ids[i + o], f - int(starts[o]) + (parts[i + o] << PART), w, s, warm[f : f + w] if flagged else None

    def spread(x: tuple) -> Iterator[tuple]:
        """A segment as its hot windows, one by one and without a shard, and the runs of windows between them."""
        body, i, first, windows, shard, flags = x
        at = 0
        for k in [*np.flatnonzero(flags).tolist(), windows]:
            if k > at:
                yield body[at : k + LENGTH - 1], i, first + at, k - at, shard
            if k < windows:
                yield body[k : k + LENGTH], i, first + k, 1, None
            at = k + 1

    def flush(ids: list[int], texts: list[bytes], keys: list[np.ndarray], parts: list[int]) -> Iterator[pa.RecordBatch]:
        least: dict[bytes, int] = {}
        held = list(cut(ids, texts, keys, parts))
        for body, i, _, _, _, _ in held:
            if i < least.get(body, i + 1):
                least[body] = i
        covered = [(i, first, windows) for body, i, first, windows, _, _ in held if i > least[body]]
        by: dict[int, list[tuple]] = {}
        single: dict[bytes, list[tuple]] = {}
        for x in held:
            if x[1] == least[x[0]]:
                for piece in (x,) if x[5] is None else spread(x):
                    if piece[4] is None:
                        single.setdefault(piece[0], []).append(piece)
                    else:
                        by.setdefault(piece[4], []).append(piece)
        # Hot windows are settled within the task once more, one by one.
        for one, found in single.items():
            smallest = min(x[1] for x in found)
            covered += [(i, first, 1) for _, i, first, _, _ in found if i > smallest]
            by.setdefault(xxhash.xxh3_64_intdigest(one) % shards, []).extend(x for x in found if x[1] == smallest)
        rows = []
        if covered:
            c = np.array(covered, np.int64)
            rows.append((-1, c[:, 0].tobytes(), c[:, 1].tobytes(), c[:, 2].astype("<u4").tobytes(), b""))
        for shard, found in sorted(by.items()):
            rows.append((shard, np.array([x[1] for x in found], np.int64).tobytes(), np.array([x[2] for x in found], np.int64).tobytes(), np.array([x[3] for x in found], "<u4").tobytes(), b"".join(x[0] for x in found)))
        yield from packed(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, keys, parts, size = [], [], [], [], 0
        for batch in batches:
            for i, x, k, part in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist(), strict=True):
                ids.append(i)
                texts.append(text_bytes(x.as_py()))
                keys.append(k.values.to_numpy(zero_copy_only=False))
                parts.append(part)
                # A key stands for about one segment of 70 bytes.
                size += 70 * len(keys[-1])
                if size >= FLUSH // 2:
                    yield from flush(ids, texts, keys, parts)
                    ids, texts, keys, parts, size = [], [], [], [], 0
        if ids:
            yield from flush(ids, texts, keys, parts)

    return run


def covered_in_shard(group: pa.Table) -> pa.Table:
    """Of one shard of segments: (id, first, windows) of runs of windows that a smaller id has too."""
    ids = np.frombuffer(_joined(group["ids"]), np.int64)
    first, windows = np.frombuffer(_joined(group["first"]), np.int64), np.frombuffer(_joined(group["windows"]), "<u4").astype(np.int64)
    raw = _joined(group["body"])
    size = windows + LENGTH - 1
    start = np.cumsum(size) - size
    # Equal segments of larger ids are covered whole; most of a shard is that, and only the rest is sorted.
    bodies = [raw[a:b] for a, b in zip(start.tolist(), (start + size).tolist(), strict=True)]
    least: dict[bytes, int] = {}
    for body, i in zip(bodies, ids.tolist(), strict=True):
        if i < least.get(body, i + 1):
            least[body] = i
    own = ids == np.fromiter(map(least.__getitem__, bodies), np.int64, len(bodies))
    whole = pa.table({"id": pa.array(ids[~own]), "first": pa.array(first[~own]), "windows": pa.array(windows[~own].astype(np.int32))})
    text = np.frombuffer(b"".join(b for b, o in zip(bodies, own.tolist(), strict=True) if o), np.uint8)
    del bodies, least, raw
    return pa.concat_tables([whole, covered_by_suffixes(text, ids[own], first[own], windows[own])])


def covered_by_suffixes(text: np.ndarray, ids: np.ndarray, first: np.ndarray, windows: np.ndarray) -> pa.Table:
    """The same for segments joined to one text, none of them equal but within a document."""
    size = windows + LENGTH - 1
    start = np.cumsum(size) - size
    owner = np.repeat(np.arange(len(ids), dtype=np.int32), size)
    real = np.arange(len(text)) - start[owner] < windows[owner]
    hit = np.zeros(len(text) + 1, bool)
    kept: list[tuple[np.ndarray, np.ndarray]] = []  # the class that may go on in the next piece
    low = LENGTH

    def settle(at: np.ndarray, fresh: np.ndarray) -> None:
        """Classes of equal windows, begun at fresh: cover all but those of the smallest id."""
        begin = np.flatnonzero(fresh)
        own = ids[owner[at]]
        least = np.repeat(np.minimum.reduceat(own, begin), np.diff(np.r_[begin, len(at)]))
        hit[at[own > least]] = True

    for at, lcp in suffix_order(text, LENGTH):
        # Windows that reach beyond their segment are no windows; what they share is passed on to the next one.
        ok = real[at]
        where = np.flatnonzero(ok)
        if not len(where):
            low = min(low, int(lcp.min()))
            continue
        begin = np.r_[0, where[:-1] + 1]
        shared = np.minimum.reduceat(lcp, begin).astype(np.int64)
        # reduceat runs to the next begin: the last one must stop at its window.
        shared[-1] = int(lcp[begin[-1] : where[-1] + 1].min())
        shared[0] = min(shared[0], low)
        low = int(lcp[where[-1] + 1 :].min()) if where[-1] + 1 < len(lcp) else LENGTH
        fresh = shared < LENGTH
        found = at[where]
        if kept and fresh[0]:
            whole = np.concatenate([a for a, _ in kept])
            settle(whole, np.concatenate([f for _, f in kept]))
            kept = []
        last = len(fresh) - 1 - int(np.argmax(fresh[::-1])) if fresh.any() else None
        if last is None:
            kept.append((found, fresh if kept else np.r_[True, fresh[1:]]))
            continue
        if last:
            whole = np.concatenate([*(a for a, _ in kept), found[:last]])
            mark = np.concatenate([*(f for _, f in kept), fresh[:last]])
            mark[0] = True
            settle(whole, mark)
        kept = [(found[last:], fresh[last:])]
    if kept:
        whole = np.concatenate([a for a, _ in kept])
        mark = np.concatenate([f for _, f in kept])
        mark[0] = True
        settle(whole, mark)
    # Runs of covered windows within a segment.
    at = np.flatnonzero(hit)
    if not len(at):
        return pa.table({"id": pa.array([], pa.int64()), "first": pa.array([], pa.int64()), "windows": pa.array([], pa.int32())})
    begin = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]])])
    head = at[begin]
    count = np.diff(np.r_[begin, len(at)])
    seg = owner[head]
    return pa.table({"id": pa.array(ids[seg]), "first": pa.array(first[seg] + head - start[seg]), "windows": pa.array(count.astype(np.int32))})


def unpack_covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(r["ids"], np.int64)), pa.array(np.frombuffer(r["first"], np.int64)), pa.array(np.frombuffer(r["windows"], "<u4").astype(np.int32))], ["id", "first", "windows"])


def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text, places) to (id, n_bytes, n_removed, n_spans, kept_sha256)."""
    for batch in batches:
        rows = []
        for i, x, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            b = text_bytes(x.as_py())
            first, windows = (places.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(2))
            mark = np.zeros(len(b) + 1, np.int32)
            np.add.at(mark, first, 1)
            np.add.at(mark, np.minimum(first + windows + LENGTH - 1, len(b)), -1)
            gone = np.cumsum(mark[:-1]) > 0
            spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
            rows.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "kept_sha256" else pa.int64()) for n, c in zip(names, zip(*rows, strict=True), strict=True)], names)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (key, n_bytes, n_removed, n_spans, kept_sha256).

    Texts are UTF-8 bytes; null counts as empty. Matches lie within documents, overlaps count, and all matches are those
    of the input. Rows that repeat key and text are one document in several rows, with one result. A key with several
    texts is a document in that many parts: each row has the result of its own part, matches lie within a part, and parts
    of one key don't cover each other. Rows with a null key neither cover others nor are covered. An empty table gives no
    rows; extra columns are ignored.
    """
    spark, start = ship_package(docs.sparkSession), made()
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    digest = F.unhex(F.sha2(body, 256))
    known = staged(rows.select("id", digest.alias("digest"), F.length(body).cast("long").alias("n_bytes")))
    split = staged(known.where("id IS NOT NULL").groupBy("id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("id"))
    stored = [known]
    if split.isEmpty():
        rows, known = (df.withColumn("part", F.lit(0)) for df in (rows, known))
    else:
        # Only rows of such keys learn which part they are; the others are part 0.
        number = F.row_number().over(Window.partitionBy("id").orderBy("digest")) - 1
        parts = staged(known.join(checked(split), "id").select("id", "digest").distinct().withColumn("part", number))
        numbered = lambda df: df.join(checked(parts), ["id", "digest"], "left").withColumn("part", F.coalesce("part", F.lit(0)))
        rows, known = numbered(rows.withColumn("digest", digest)).drop("digest"), staged(numbered(known))
        stored = [known, parts]
    part = ["id", "part"]
    heads = known.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("head"), F.max("id").alias("top")).where("head < top")
    heads = staged(heads.select("digest", "head"))
    copies = staged(known.join(checked(heads), "digest").where("id > head").select("id", "part", "digest", "n_bytes"))
    copy_ids = copies.select(part).distinct()
    total = known.agg(F.sum("n_bytes")).first()[0] or 0
    left = with_ids(rows.where("id IS NOT NULL"), copy_ids, "left_anti", part)
    shards = max(16, int(total / 13 / SHARD_ANCHORS) + 1)
    here = left.select("id", "text").mapInArrow(keys_shared_here(shards), _PLACES)
    most = max(HOT, int(total / 13 / HOT_KEYS))
    between = left.select("id", "text").mapInArrow(packed_anchors(shards), _PACKED).groupBy("shard").applyInArrow(keys_shared_between(most), _PLACES)
    found = staged(here.unionByName(between))
    # At most HOT_KEYS anchors or so, as each has more than that share of all.
    hot = np.array(sorted(r["key"] for r in found.where("id IS NULL").select("key").collect()), np.int64).view(np.uint64)
    places = found.where("id IS NOT NULL")
    pieces = max(16, int(places.count() * 70 / SHARD_BYTES) + 1)
    by_id = places.groupBy("id").agg(F.collect_list("key").alias("keys"))
    some = with_ids(left, places.select("id").distinct(), "left_semi").where(F.octet_length("text") >= LENGTH)
    sent = staged(some.join(by_id, "id").select("id", "text", "keys", "part").mapInArrow(cut_segments(shards, pieces, hot), _SENT))
    inner = sent.where("shard < 0").select("ids", "first", "windows").mapInArrow(unpack_covered, _COVERED)
    outer = sent.where("shard >= 0").groupBy("shard").applyInArrow(covered_in_shard, _COVERED)
    covered = inner.unionByName(outer).select("id", F.shiftright("first", PART).cast("int").alias("part"), F.col("first").bitwiseAND((1 << PART) - 1).cast("int").alias("first"), "windows")
    covered = staged(covered)
    spans = covered.groupBy(part).agg(F.collect_list(F.struct("first", "windows")).alias("places"))
    touched = staged(covered.select(part).distinct())
    sweep(spark, start, *stored, copies, covered, touched)
    rewritten = with_ids(left, touched, "left_semi", part).join(spans, part).select("id", "text", "places").mapInArrow(rewrite, "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    whole = F.col("n_bytes") >= LENGTH
    empty = hashlib.sha256(b"").hexdigest()
    hexed = F.lower(F.hex("digest"))
    gone = copies.select("id", "n_bytes", F.when(whole, F.col("n_bytes")).otherwise(0).alias("n_removed"), F.when(whole, 1).otherwise(0).cast("long").alias("n_spans"), F.when(whole, empty).otherwise(hexed).alias("kept_sha256"))
    done = touched.unionByName(copy_ids)
    same = with_ids(known, done, "left_anti", part).select("id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), hexed.alias("kept_sha256"))
    return rewritten.unionByName(gone).unionByName(same).withColumnRenamed("id", key)
