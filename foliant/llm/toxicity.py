"""Toxicity by a lexicon whose misspellings Levenshtein automata catch (operator 6).

The lexicon is learned: words far more frequent in toxic than in other training documents, in a trie. A word of a
text is run against the trie as an automaton that allows a bounded number of edits, so that `stuupid` meets
`stupid`. Every hit is weighed by its context window: within quotation marks or beside words of reporting it counts
as quoted, and quoted hits weigh less. A logistic regression over these sums gives the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from foliant.llm.common import bucket_of, checked, discard, free_name, sql_words, staged
from foliant.session import ship_package

#: Folds of crc32(doc_id); fold 1 is held out.
FOLDS = 3
THRESHOLD = 0.7
#: Labelled documents, expected, that the lexicon is learned from; a hash of the id chooses them.
TRAIN_DOCS = 40_000
#: Words to either side of a hit that make its context.
WINDOW = 5
#: What a quoted hit weighs against one that is not.
QUOTED = 0.35
MEMO = 100_000

# Words of reporting, after or before which a term is being quoted.
REPORTING = frozenset("said says wrote quote quoted quotes called calls sagte sagt zitat dijo dice cita dit disait cite".split())
QUOTES = "\"“”„«»‘‚"
OPENING, CLOSING = "\"“„«»‘‚", "\"”“»«’"


def core(word: str) -> str:
    """Lower case, without what is no letter or digit at the ends."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalnum():
        a += 1
    while b > a and not word[b - 1].isalnum():
        b -= 1
    return word[a:b]


def edits(length: int) -> int:
    """Edits allowed in a term of this length: short words would meet others by chance."""
    return 0 if length < 4 else 1 if length < 12 else 2


class Trie:
    """Terms as nested dicts; the empty key holds (term, weight)."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        self.terms = terms
        for term, weight in terms.items():
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = (term, weight)
        self.gates = self._gates()

    def _gates(self) -> dict[int, tuple[int, list[tuple[int, int, frozenset[str]]]]]:
        """Per word length: the most edits of a term near that length, and substrings (from, to, set) one of which any
        misspelling within edits() has unchanged.

        A term cut into one part more than its edits keeps a part, shifted by no more than the edits; words without one
        need no automaton.
        """
        found: dict[int, dict[tuple[int, int], set[str]]] = {}
        most: dict[int, int] = {}
        for term in self.terms:
            k = edits(len(term))
            cuts = [len(term) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False) if k else ():
                for length in range(len(term) - k, len(term) + k + 1):
                    most[length] = max(most.get(length, 0), k)
                    for start in range(max(0, a - k), min(length - (b - a), a + k) + 1):
                        found.setdefault(length, {}).setdefault((start, start + b - a), set()).add(term[a:b])
        return {length: (most[length], [(a, b, frozenset(parts)) for (a, b), parts in by.items()]) for length, by in found.items()}

    def nearest(self, word: str) -> tuple[str, float, int] | None:
        """(term, weight, distance) of the term nearest to word within edits(len(term)); ties by weight, then by name.

        The Levenshtein automaton of word is a bit set per number of edits: bit i of set k is on when word[:i] can be
        turned into the path so far with k edits. It runs down the trie; a branch ends when all sets are empty.
        """
        if word in self.terms:
            return word, self.terms[word], 0
        top, gates = self.gates.get(len(word), (0, ()))
        for a, b, parts in gates:
            if word[a:b] in parts:
                break
        else:
            return None
        n = len(word)
        masks: dict[str, int] = {}
        for i, c in enumerate(word):
            masks[c] = masks.get(c, 0) | (2 << i)
        full = (2 << n) - 1
        start = [(2 << k) - 1 & full for k in range(top + 1)]  # k leading characters of word left out
        best: tuple | None = None
        stack = [(self.root, start)]
        while stack:
            node, sets = stack.pop()
            for c, child in node.items():
                if not c:
                    continue
                mask = masks.get(c, 0)
                moved = [(sets[0] << 1) & mask & full]
                for k in range(1, top + 1):
                    before = sets[k - 1]
                    # match, insertion of c, substitution by c, then omission of characters of word
                    moved.append((((sets[k] << 1) & mask) | before | (before << 1) | (moved[k - 1] << 1)) & full)
                if not moved[top]:
                    continue
                if "" in child:
                    term, weight = child[""]
                    allowed = edits(len(term))
                    for k in range(1, min(allowed, top) + 1):
                        if moved[k] >> n & 1:
                            found = (k, -weight, term)
                            if best is None or found < best:
                                best = found
                            break
                stack.append((child, moved))
        return None if best is None else (best[2], -best[1], best[0])


@dataclass
class Model:
    terms: dict[str, float]
    #: Innocent words of the training texts that lie near a term; they are no misspellings.
    innocent: frozenset[str] = frozenset()
    weights: list[float] = field(default_factory=lambda: [-4.0, 3.0, 1.5, 1.0])


def support(toxic: int) -> int:
    """Contexts in toxic documents that a term must be in."""
    return max(5, toxic // 100)


def term_weights(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Discounted log odds of words, by the numbers t and c of their contexts in toxic and in other documents, as weights
    up to 1. A term needs support(toxic) of the former and odds that favour toxic documents twentyfold."""
    out = {}
    for word, t, c in counts:
        if t < support(toxic):
            continue
        odds = math.log((t - 0.7) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        if odds > math.log(20):
            out[word] = min(odds, 6.0) / 6.0
    return dict(sorted(out.items()))


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.trie = Trie(model.terms)
        scorer = self

        class Hits(dict):
            """(weight, distance) of a raw word's term, or None; kept by raw spelling."""

            def __missing__(self, word: str):
                if len(self) >= MEMO:
                    self.clear()
                hit = self[word] = scorer.hit(word)
                return hit

        self.hits = Hits()

    def hit(self, word: str) -> tuple[float, int] | None:
        plain = core(word)
        if plain in self.model.innocent:
            return None
        found = self.trie.nearest(plain)
        return None if found is None else (found[1], found[2])

    def quoted(self, words: list[str], i: int) -> bool:
        """Does the context window show that word i is quoted: an opening mark at or before it and a closing one at or
        after it, or a word of reporting right beside the window's marks."""
        before, after = words[max(0, i - WINDOW) : i + 1], words[i : i + WINDOW + 1]
        opened = any(w[0] in OPENING for w in before)
        closed = any(w.rstrip(".,;:!?")[-1:] in CLOSING and w.rstrip(".,;:!?")[-1:] for w in after)
        if opened and closed:
            return True
        return (opened or closed) and any(core(w) in REPORTING for w in words[max(0, i - WINDOW) : i + WINDOW + 1])

    def features(self, text: str | None) -> tuple[float, float, float]:
        """Sums over the hits: exact, misspelt, and their share per 100 words."""
        words = (text or "").split()
        exact = near = 0.0
        found = list(map(self.hits.__getitem__, words))
        if any(found):
            for i, hit in enumerate(found):
                if hit is None:
                    continue
                weight = hit[0] * (QUOTED if self.quoted(words, i) else 1.0)
                if hit[1]:
                    near += weight / (1 + hit[1])
                else:
                    exact += weight
        return math.log1p(exact), math.log1p(near), min(1.0, (exact + near) * 100 / max(20, len(words)) / 5)

    def score(self, text: str | None) -> float:
        bias, *w = self.model.weights
        z = bias + sum(a * b for a, b in zip(w, self.features(text), strict=True))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, rounds: int = 60, ridge: float = 1e-3) -> list[float]:
    """Ridge logistic regression by Newton steps over rows that stand for n documents each, classes weighed alike."""
    x = np.column_stack([np.ones(len(x)), x])
    share = n * np.where(y == 1, 0.5 / max(1, (n * y).sum()), 0.5 / max(1, (n * (1 - y)).sum()))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (share * (p - y)) + ridge * w
        h = (x * (share * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return [float(v) for v in w]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", train_docs: int = TRAIN_DOCS) -> Model:
    """Lexicon and weights from the labelled documents outside the held-out fold.

    A hash of the id chooses about train_docs of them, the one bound of this model: all words of the chosen texts are
    counted and every word that earns it becomes a term. Copies of a text count once; a text with both labels counts as
    evidence for both. Null labels, null ids and null texts are left out; several labels of one id count as toxic if one
    of them does; without toxic documents the lexicon is empty and every text scores alike.
    """
    marks = labels.where((bucket_of(key, FOLDS) != 1) & F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("id")).agg(F.max("toxic").cast("int").alias("toxic"))
    marks = staged(marks)
    share = min(1.0, train_docs / max(1, marks.count()))
    marks = marks.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull()).join(checked(marks), "id")
    rows = staged(rows.select("toxic", "text"))
    alike = rows.select("toxic", F.unhex(F.md5(F.col("text"))).alias("digest")).groupBy("digest").agg(F.max("toxic").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in alike.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic:
        return Model({})
    by_word = staged(context_counts(rows))
    # A term has support() contexts or more in the toxic texts chosen, so their words bound the number of terms.
    counts = by_word.where((F.col("t") >= support(toxic)) & (F.col("t") * (clean + 1) > 20 * F.col("c") * (toxic + 1)))
    terms = term_weights([(r["word"], r["t"], r["c"]) for r in counts.collect()], toxic, clean)
    spark = ship_package(docs.sparkSession)
    lexicon = spark.sparkContext.broadcast(terms)

    def near_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(lexicon.value)
        for batch in batches:
            yield batch.filter(pa.array([trie.nearest(w) is not None for w in batch.column(0).to_pylist()], pa.bool_()))

    # Words no more frequent in toxic texts than in others; only those near a term come to the driver.
    usual = by_word.where((F.col("c") >= 1) & (F.col("c") * (toxic + 1) >= F.col("t") * (clean + 1)))
    innocent = frozenset(r["word"] for r in usual.select("word").mapInArrow(near_terms, "word string").collect()) - terms.keys()
    model = Model(terms, innocent)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.features(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int32()), *(pa.array([f[i] for f in found], pa.float64()) for i in range(3))], ["toxic", "a", "b", "c"])

    # At most about train_docs rows of four numbers.
    got = rows.select("toxic", "text").mapInArrow(run, "toxic int, a double, b double, c double").groupBy("toxic", "a", "b", "c").count().collect()
    model.weights = fit([(r["toxic"], r["a"], r["b"], r["c"], r["count"]) for r in got])
    for table in (marks, rows, by_word):
        discard(table)
    return model


def context_counts(rows: DataFrame) -> DataFrame:
    """(word, t, c) of rows (toxic, text): in how many contexts a word stands in toxic and in other texts.

    A context is the word before. Near copies of a document, whose rare words always follow the same ones, are no
    evidence this way. Contexts travel as 32-bit hashes.
    """
    edge = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
    words = rows.select("toxic", sql_words(F.lower(F.col("text"))).alias("words"))
    plain = F.filter(F.transform("words", lambda w: F.regexp_replace(w, edge, "")), lambda w: w != "")
    # arrays_zip reads both arrays once; a look-up in a lambda would make the array anew for each word.
    before = F.concat(F.array(F.lit("").cast("string")), F.col("plain"))
    pairs = words.select("toxic", plain.alias("plain")).select("toxic", F.filter(F.arrays_zip(F.col("plain").alias("word"), before.alias("before")), lambda x: x["word"].isNotNull()).alias("pairs"))
    contexts = pairs.select("toxic", F.inline("pairs").alias("word", "before")).groupBy("word", F.hash("before").alias("before")).agg(F.max("toxic").alias("t"), F.max(1 - F.col("toxic")).alias("c"))
    return contexts.groupBy("word").agg(F.sum("t").cast("long").alias("t"), F.sum("c").cast("long").alias("c"))


def fit(rows: list[tuple[int, float, float, float, int]]) -> list[float]:
    """Bias and weights from (toxic, three features, number of documents); a weight that speaks against toxicity is set to 0.

    One made document without a hit is among the clean ones, so that a model without any stays calm.
    """
    rows = sorted(rows) + [(0, 0.0, 0.0, 0.0, 1)]
    x = np.array([r[1:4] for r in rows])
    y, n = (np.array([r[i] for r in rows], float) for i in (0, 4))
    w = logistic(x, y, n)
    return [w[0], *(max(v, 0.0) for v in w[1:])]


def _scored(docs: DataFrame, model: Model, text: str) -> tuple[DataFrame, str]:
    """docs with a last column of scores, and the name of that column, which is none that docs has."""
    spark = ship_package(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample that it was learned from
    at, name = docs.columns.index(text), free_name("score", docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores = pa.array([scorer.score(x.as_py()) for x in batch.column(at)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, name])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())])), name


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (key, held_out, score, predicted).

    Null and empty texts score like a text without hits. Rows with a null key are not held out. Repeated rows come out
    repeated; an empty table gives no rows; extra columns are ignored. Nothing but the text enters a score.
    """
    chosen = docs.select(F.col(key), (bucket_of(key, FOLDS) == 1).alias("held_out"), F.col(text))
    out, name = _scored(chosen, model, text)
    return out.select(key, "held_out", F.col(name).alias("score"), (F.col(name) >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs whose score stays below the threshold, all columns kept, whatever their names.

    Null and empty texts have no hit and stay; repeated rows are judged alike; an empty table stays empty.
    """
    out, name = _scored(docs, model, text)
    return out.where(F.col(name) < THRESHOLD).drop(name)
