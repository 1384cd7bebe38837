"""Sum-of-squares online packing of token sequences (operator 8).

Each task packs the documents it reads: no shuffle, no shared state, so a hot source or a lost executor costs
nothing beyond its own task. Per task the open windows are known by a level array: how many windows stand at each
fill level. A document goes to the level that leaves the sum of squared counts smallest. What is still open at the
end of a task is cut and joined to full windows, and the last remainder is cut into powers of two, which need no
padding.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import ship_package

WINDOW = 2048
#: Id that ends every document.
END = 1
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Bits of a sequence_id that number the sequences of one task.
TASK_BITS = 40


class Packer:
    """Packs documents one by one; pieces come out as soon as their window is full."""

    def __init__(self, window: int = WINDOW, first_id: int = 0):
        self.window, self.next_id = window, first_id
        self.level = np.zeros(window + 1, np.int64)
        self.open: list[list[list[tuple]]] = [[] for _ in range(window + 1)]
        self.done: list[tuple] = []

    def close(self, pieces: list[tuple]) -> None:
        """Pieces (doc_id, start, ids, doc_tokens) leave as one sequence."""
        offset = 0
        for doc_id, start, ids, total in pieces:
            self.done.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next_id, offset))
            offset += len(ids)
        self.next_id += 1

    def best_level(self, size: int) -> int:
        """The fill level, 0 for a new window, whose choice gives the smallest sum of squares; the fullest of equals."""
        n, w = self.level, self.window
        fits = w - size
        change = np.empty(fits + 1, np.int64)
        after = 2 * n[size : w + 1] + 1
        after[-1] = 0  # a full window leaves the array
        change[0] = after[0]
        change[1:] = after[1:] - 2 * n[1 : fits + 1] + 1
        change[1:][n[1 : fits + 1] == 0] = np.iinfo(np.int64).max
        return int(fits - np.argmin(change[::-1]))

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, w, start = len(ids), self.window, 0
        while total - start >= w:
            self.close([(doc_id, start, ids[start : start + w], total)])
            start += w
        size = total - start
        if not size:
            return
        at = self.best_level(size)
        pieces = []
        if at:
            pieces = self.open[at].pop()
            self.level[at] -= 1
        pieces.append((doc_id, start, ids[start:].copy(), total))
        if at + size == w:
            self.close(pieces)
        else:
            self.open[at + size].append(pieces)
            self.level[at + size] += 1

    def finish(self) -> None:
        """Join what is left: the fullest windows take cuts from the emptiest, and the last one is cut at powers of two."""
        left = [pieces for level in self.open for pieces in level]
        stream = [piece for pieces in reversed(left) for piece in pieces]
        pending, room = [], self.window
        for doc_id, start, ids, total in stream:
            while len(ids):
                cut = ids[:room]
                pending.append((doc_id, start, cut, total))
                start, ids, room = start + len(cut), ids[len(cut) :], room - len(cut)
                if not room:
                    self.close(pending)
                    pending, room = [], self.window
        size = self.window - room
        while size:
            want = 1 << (size.bit_length() - 1)
            taken, size = [], size - want
            while want:
                doc_id, start, ids, total = pending.pop(0)
                taken.append((doc_id, start, ids[:want], total))
                if len(ids) > want:
                    pending.insert(0, (doc_id, start + want, ids[want:], total))
                want -= min(want, len(ids))
            self.close(taken)
        self.level[:] = 0
        self.open = [[] for _ in range(self.window + 1)]

    def drain(self) -> list[tuple]:
        out, self.done = self.done, []
        return out


class Encoder:
    """The byte-level BPE of a rank file, remembering the ids of chunks that start at a space.

    The split pattern never joins characters across a space that follows a character other than white space, so a text
    may be cut there and its chunks encoded alone. Texts with a space behind other white space take the plain way.
    """

    ENTRIES = 150_000

    def __init__(self, ranks: bytes, pattern: str, specials: tuple[tuple[str, int], ...] = ()):
        import tiktoken

        pairs = (line.split() for line in ranks.splitlines() if line)
        bpe = tiktoken.Encoding("bpe", pat_str=pattern, mergeable_ranks={base64.b64decode(a): int(b) for a, b in pairs}, special_tokens={})
        self.plain = lambda text: np.array(bpe.encode_ordinary(text), "<u4").tobytes()
        plain, entries = self.plain, self.ENTRIES

        class Chunks(dict):
            """Ids, as bytes, of a chunk whose leading space is left out of the key; forgotten all at once when full."""

            def __missing__(self, chunk: str) -> bytes:
                ids = plain(" " + chunk)
                if len(chunk) < 40:
                    if len(self) >= entries:
                        self.clear()
                    self[chunk] = ids
                return ids

        self.chunks = Chunks()
        self.specials = {x: np.array([i], "<u4").tobytes() for x, i in specials}
        self.apart = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")

    def __call__(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids; a special token's string is its one id, and what lies around it is encoded
        by itself, as the tokenizer does with added tokens."""
        if any(map(text.__contains__, self.specials)):
            return b"".join(self.specials.get(part) or self.ordinary(part) for part in self.apart.split(text) if part)
        return self.ordinary(text)

    def ordinary(self, text: str) -> bytes:
        if SPACE_IN_RUN.search(text):
            return self.plain(text)
        first, *rest = text.split(" ")
        return self.plain(first) + b"".join(map(self.chunks.__getitem__, rest))


SPACE_IN_RUN = re.compile(r"\s ")
_ENCODERS: dict[tuple, Encoder] = {}


def encoder(ranks: bytes, pattern: str, specials: tuple[tuple[str, int], ...] = ()) -> Encoder:
    """One per Python worker and vocabulary."""
    key = (len(ranks), zlib.crc32(ranks), pattern, specials)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(ranks, pattern, specials)
    return _ENCODERS[key]


def rank_file(path: str | None = None, described: str | None = None) -> tuple[bytes, str, tuple[tuple[str, int], ...]]:
    """Ranks (about 1 MB, the size of the vocabulary), split pattern and added tokens of the 50k byte-level BPE.

    The rank file holds the vocabulary of byte_bpe_50k.json, which names the added tokens; the ids agree, which the tests
    verify against `tokenizers`.
    """
    import public_tokenizers

    with open(described or public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        specials = tuple((x["content"], x["id"]) for x in json.load(f)["added_tokens"])
    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        return f.read(), public_tokenizers.PATTERN, specials


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, ranks_path: str | None = None) -> DataFrame:
    """One row per piece of a document (SCHEMA).

    A document is its token ids followed by id 1; null and empty texts are the lone id 1. The string of a special
    token in a text is that token's id. Documents longer than a window fill whole windows and only their rest is packed. Null
    keys stay null; repeated rows are packed as often as they come; an empty table gives no rows; extra columns are
    ignored. Every id lies in exactly one piece; no sequence needs padding, since the last tokens of each task are cut
    into sequences whose lengths are powers of two.
    """
    spark = ship_package(docs.sparkSession)
    ranks, pattern, specials = rank_file(ranks_path)
    shared = spark.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(shared.value, pattern, specials), np.array([END], "<u4").tobytes()
        packer = Packer(window, TaskContext.get().partitionId() << TASK_BITS)
        names = [x.split()[0] for x in SCHEMA.split(", ")]

        def out() -> Iterator[pa.RecordBatch]:
            rows = packer.drain()
            for i in range(0, len(rows), 20_000):
                yield pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*rows[i : i + 20_000], strict=True), strict=True)})

        for batch in batches:
            for doc_id, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc_id, np.frombuffer(encode(body.as_py() or "") + end, "<u4"))
            yield from out()
        packer.finish()
        yield from out()

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, SCHEMA)
