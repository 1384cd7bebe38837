"""Language identification, word first with backoff to character n-grams (operator 9).

A word seen in training scores by its log frequency in each language. An unseen word falls back to its character
n-grams of length 5, then 4, and so on to 1: the first length at which any of its n-grams is known decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import bucket_of, checked, discard, sql_words, staged
from foliant.session import ship_package

#: Folds of crc32(doc_id); fold 0 is held out.
FOLDS = 5
#: Labelled documents of each language, expected, that the model is fitted on; a hash of the id chooses them.
TRAIN_DOCS = 5_000
#: Commonest words of each language, and n-grams of each language and length, that the model keeps. They are chosen when
#: all of the training documents have been counted.
VOCABULARY, GRAMS = 15_000, 10_000
LONGEST = 5
#: Weight of one word's fallback score against that of a known word.
BACKOFF = 0.4
MEMO = 100_000


def core(word: str) -> str:
    """A word as the model knows it: lower case, without what is no letter at its ends; empty if it has no letter."""
    word = word.lower()
    a, b = 0, len(word)
    while a < b and not word[a].isalpha():
        a += 1
    while b > a and not word[b - 1].isalpha():
        b -= 1
    return word[a:b]


def grams(word: str, n: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Per-language log frequencies, as one float row per word and per n-gram."""

    langs: list[str]
    words: dict[str, list[float]]
    ngrams: list[dict[str, list[float]]] = field(default_factory=list)

    @classmethod
    def fit(cls, counts: list[tuple[str, str, int]], grams_of: list[tuple[int, str, str, float]] | None = None, langs: list[str] | None = None) -> Model:
        """From words (word, lang, n) and n-grams (length, gram, lang, weight), which without a list are those of the words.

        Frequencies are smoothed by one half; n-grams weigh each distinct word by log(1 + n) and need more than 1 in all.
        """
        langs = sorted(langs if langs is not None else {lang for _, lang, _ in counts})
        at = {lang: i for i, lang in enumerate(langs)}
        by_word: dict[str, np.ndarray] = {}
        for word, lang, n in counts:
            word = core(word)
            if word:
                by_word.setdefault(word, np.zeros(len(langs)))[at[lang]] += n
        if grams_of is None:
            grams_of = [(size, gram, lang, math.log1p(n[at[lang]])) for word, n in by_word.items() for size in range(1, LONGEST + 1) for gram in set(grams(word, size)) for lang in langs]
        by_gram: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST + 1)]
        for size, gram, lang, weight in grams_of:
            by_gram[size].setdefault(gram, np.zeros(len(langs)))[at[lang]] += weight
        return cls(langs, cls.logs(by_word), [cls.logs({g: v for g, v in level.items() if v.sum() > 1}) for level in by_gram])

    @staticmethod
    def logs(table: dict[str, np.ndarray]) -> dict[str, list[float]]:
        """log P(item | lang), centred over the languages so that scores of different items can be added."""
        if not table:
            return {}
        m = np.array(list(table.values())) + 0.5
        m = np.log(m / m.sum(axis=0))
        m -= m.mean(axis=1, keepdims=True)
        return dict(zip(table, m.tolist(), strict=True))

    def score(self, word: str) -> list[float] | None:
        """A row over the languages; None if the word has no letter."""
        word = core(word)
        if not word:
            return None
        known = self.words.get(word)
        if known is not None:
            return known
        marked = f"^{word}$"
        for size in range(LONGEST, 0, -1):
            known_grams = self.ngrams[size]
            found = [v for i in range(len(marked) - size + 1) if (v := known_grams.get(marked[i : i + size])) is not None]
            if found:
                scale = BACKOFF / len(found)
                return [scale * sum(column) for column in zip(*found, strict=True)]
        return [0.0] * len(self.langs)


class Scorer:
    """Predicts texts, remembering the rows of words by their raw spelling."""

    def __init__(self, model: Model):
        self.model, scorer = model, self
        self.rows: list[list[float]] = []

        class Ids(dict):
            def __missing__(self, word: str) -> int:
                row = scorer.model.score(word)
                if row is None:
                    self[word] = -1
                    return -1
                scorer.rows.append(row)
                self[word] = len(scorer.rows) - 1
                return self[word]

        self.ids = Ids()
        self.matrix = np.zeros((0, len(model.langs)), np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        """(lang, score); ties go to the first language by name; the score is the posterior of the chosen language, with
        the evidence of a text counted as that of at most 25 independent words."""
        if len(self.rows) > MEMO or len(self.ids) > 2 * MEMO:
            self.rows.clear()
            self.ids.clear()
            self.matrix = self.matrix[:0]
        words = (text or "").split()
        ids = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        ids = ids[ids >= 0]
        if not len(ids) or not self.model.langs:
            return "und", 0.0
        if len(self.matrix) < len(self.rows):
            self.matrix = np.concatenate([self.matrix, np.array(self.rows[len(self.matrix) :], np.float32)])
        # One take of all rows may not hold the whole of a very long text.
        total = sum((self.matrix[ids[i : i + 65_536]].sum(axis=0, dtype=np.float64) for i in range(0, len(ids), 65_536)), np.zeros(len(self.model.langs)))
        total *= min(len(ids), 25) / len(ids)
        e = np.exp(total - total.max())
        best = int(np.argmax(total))
        return self.model.langs[best], float(e[best] / e.sum())


def _commonest(counts: DataFrame, item: list[str], by: list[str], weight: str, most: int) -> DataFrame:
    """All rows of the items that are among the most of some group; ties by name. counts is (item..., lang, weight)."""
    ranked = counts.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(weight), *item)))
    kept = ranked.where(F.col("rank") <= most).select(*item).distinct()
    return counts.join(checked(kept), item, "left_semi")


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", train_docs: int = TRAIN_DOCS, vocabulary: int = VOCABULARY, most_grams: int = GRAMS) -> Model:
    """Words and n-grams per language over about train_docs documents of each language in the training folds.

    Every language that has a document there is one of the answers. Words are counted whole, however long. Null texts,
    null languages and null keys are left out; repeated rows count as often as they come; no labelled documents give a
    model that answers `und`.
    """
    labelled = docs.where((bucket_of(key, FOLDS) > 0) & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    sizes = staged(labelled.groupBy("lang").agg((F.lit(1_000_000 * train_docs) / F.count("*")).alias("share")))
    sample = labelled.join(checked(sizes), "lang").where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.col("share"))
    plain = F.regexp_replace("word", r"^[^\p{L}]+|[^\p{L}]+$", "")
    words = sample.select("lang", F.explode(sql_words(F.lower(F.col("text")))).alias("word")).groupBy("word", "lang").agg(F.count("*").alias("n"))
    words = staged(words.select(plain.alias("word"), "lang", "n").where("word <> ''").groupBy("word", "lang").agg(F.sum("n").alias("n")))
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    # The characters of a word once per length; look-ups in a string would walk it anew for each n-gram.
    lists = [F.element_at(F.transform(F.array(F.split(marked, "")), _grams_of(size)), 1) for size in range(1, LONGEST + 1)]
    each = words.select("lang", F.log1p("n").alias("weight"), F.explode(F.concat(*lists)).alias("gram"))
    by_gram = staged(each.groupBy("gram", "lang").agg(F.sum("weight").alias("weight")).withColumn("size", F.length("gram")))
    kept_words = _commonest(words, ["word"], ["lang"], "n", vocabulary).collect()
    kept_grams = _commonest(by_gram, ["gram"], ["lang", "size"], "weight", most_grams).collect()
    langs = [r["lang"] for r in sizes.select("lang").collect()]
    for table in (sizes, words, by_gram):
        discard(table)
    return Model.fit([(r["word"], r["lang"], r["n"]) for r in kept_words], [(r["size"], r["gram"], r["lang"], r["weight"]) for r in kept_grams], langs)


def _grams_of(size: int):
    """The lambda from a marked word's characters to its distinct n-grams of a length."""
    return lambda a: F.when(F.size(a) >= size, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(a) - size), lambda i: F.concat(*(F.get(a, i + k) for k in range(size)))))).otherwise(F.array().cast("array<string>"))


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: (key, held_out, lang_pred, score).

    lang_pred is `und`, with score 0, for null texts, texts without a letter, and if nothing could be learned. Ties go to
    the first language by name. Rows with a null key are held out of nothing (held_out false). Repeated rows come out
    repeated; an empty table gives no rows; extra columns are ignored.
    """
    spark = ship_package(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)  # bounded by VOCABULARY and GRAMS per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(x.as_py()) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())],
                [key, "held_out", "lang_pred", "score"],
            )

    kind = docs.schema[key].dataType.simpleString()
    chosen = docs.select(F.col(key), (bucket_of(key, FOLDS) == 0).alias("held_out"), F.col(text))
    return chosen.mapInArrow(run, f"`{key}` {kind}, held_out boolean, lang_pred string, score double")
