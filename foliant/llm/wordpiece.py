"""Token counts by a linear longest-match automaton (operator 5).

Greedy word-piece tokenisation takes the longest piece at each point of a word. The automaton is the trie of the
vocabulary with a failure link per node: when no child fits, the pieces that the path so far is cut into are counted
by a number stored with the node, and matching goes on at the link's target, which spells the rest. Each character
is read once, and no piece is ever built.
"""

from __future__ import annotations

import json
import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import ship_package

#: Mark of a word's end in the vocabulary.
END = "</w>"
MEMO = 100_000


class Automaton:
    """Counts the greedy longest-match pieces of words.

    A vocabulary of pieces, some of which end in END and then match at the end of a word only. Pieces may start
    anywhere in a word. The end of a word is one more symbol, read after its last character. If a word can't be cut
    whole, because a character or an ending is in no piece, all of it is one unknown token.
    """

    def __init__(self, vocabulary: Iterable[str]):
        pieces = {p for p in vocabulary if p and p != END}
        self.goto: list[dict[str, int]] = [{}]
        accepts = [False]
        for piece in sorted(pieces):
            symbols = [*piece[: -len(END)], END] if piece.endswith(END) else list(piece)
            at = 0
            for s in symbols:
                if s not in self.goto[at]:
                    self.goto[at][s] = len(self.goto)
                    self.goto.append({})
                    accepts.append(False)
                at = self.goto[at][s]
            accepts[at] = True
        n = len(self.goto)
        #: Failure link, or -1, and the number of pieces popped on the way.
        self.link, self.popped = [-1] * n, [0] * n
        queue = deque((node, 0, s) for s, node in self.goto[0].items())
        while queue:
            node, parent, symbol = queue.popleft()
            if accepts[node]:
                # The path is a piece: it is popped whole, and nothing is left of it.
                self.link[node], self.popped[node] = 0, 1
            else:
                # Follow the parent's links to a node that can read the symbol; its pieces come first.
                z, count = self.link[parent], self.popped[parent]
                while z > 0 and symbol not in self.goto[z]:
                    count += self.popped[z]
                    z = self.link[z]
                if z >= 0 and symbol in self.goto[z]:
                    self.link[node], self.popped[node] = self.goto[z][symbol], count
            queue.extend((child, node, s) for s, child in self.goto[node].items())

    def count(self, word: str) -> int:
        """Pieces of a word; 1 if it can't be cut, 0 if it is empty."""
        if not word:
            return 0
        goto, link, popped = self.goto, self.link, self.popped
        at = total = 0
        for symbol in (*word, END):
            while symbol not in goto[at]:
                if at == 0 or link[at] < 0:
                    if at == 0 and symbol == END:
                        return total  # the last piece ended with the last character
                    return 1
                total += popped[at]
                at = link[at]
            at = goto[at][symbol]
        # What is left unread of the path is popped to the root.
        while at:
            if link[at] < 0:
                return 1
            total += popped[at]
            at = link[at]
        return total


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of the 49k word vocabulary, read at the driver; its size is that of the file, not of the data."""
    import public_tokenizers

    with open(path or public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        raw = json.load(f)["model"]["vocab"]
    back = {c: b for b, c in byte_letters().items()}
    out = []
    for piece in raw:
        body, end = (piece[: -len(END)], END) if piece.endswith(END) else (piece, "")
        if body and all(c in back for c in body):
            out.append(bytes(back[c] for c in body).decode("latin-1") + end)
    return out


def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte: itself if printable, else 256 and up in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


_AUTOMATA: dict[tuple[int, int], Automaton] = {}


def automaton(packed: bytes) -> Automaton:
    """One per Python worker and vocabulary."""
    key = (len(packed), zlib.crc32(packed))
    if key not in _AUTOMATA:
        _AUTOMATA[key] = Automaton(json.loads(packed))
    return _AUTOMATA[key]


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary_path: str | None = None) -> DataFrame:
    """One row per input row: (key, n_words, n_tokens, longest_word_tokens).

    A text's words [^\\x20\\x09-\\x0D]+ are lower-cased and cut as UTF-8 bytes, so that no character is unknown. Null and
    empty texts have no words and no tokens. Repeated rows come out repeated, null keys are passed on, an empty table
    gives no rows and extra columns are ignored.
    """
    spark = ship_package(docs.sparkSession)
    shared = spark.sparkContext.broadcast(json.dumps(vocabulary(vocabulary_path)).encode())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(shared.value)

        class Counts(dict):
            """Token counts of words, remembered."""

            def __missing__(self, word: bytes) -> int:
                if len(self) >= MEMO:
                    self.clear()
                n = self[word] = machine.count(word.decode("latin-1"))
                return n

        counts = Counts()
        for batch in batches:
            words, tokens, longest = [], [], []
            for x in batch.column(1):
                found = [counts[w] for w in (x.as_py() or "").lower().encode("utf-8", "surrogatepass").split()]
                words.append(len(found))
                tokens.append(sum(found))
                longest.append(max(found, default=0))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(v, pa.int64()) for v in (words, tokens, longest))], [key, "n_words", "n_tokens", "longest_word_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key), F.col(text)).mapInArrow(run, f"`{key}` {kind}, n_words long, n_tokens long, longest_word_tokens long")
