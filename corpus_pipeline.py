"""The corpus pipeline: toxicity, exact dedup, near dedup, mixing of sources, packing.

Every stage but the last keeps all columns of its input, whatever their names, and an empty table stays empty. What nulls
and repeated rows come to is the stage's own rule, stated with each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from foliant.llm import exact, mixing, near, packing, toxicity
from foliant.llm.common import made, staged, sweep

#: Words of a shingle in the near-dedup stage; op2_minhash has its own.
SHINGLE = 5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored as toxic go. The model is learned from the labels and the documents of this stage's input.

    Null and empty texts have nothing toxic and stay; repeated rows are judged alike; without toxic labels all stay.
    """
    return toxicity.without_toxic(docs, toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one of largest id; a null text equals the empty one, a null id
    is smaller than any other, and of rows that repeat id and text one stays."""
    return exact.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays; copies share 80 % of their shingles of SHINGLE words.

    The smallest id stays; texts without words and rows without an id are copies of nothing and stay.
    """
    return near.without_near_copies(docs, shingle=SHINGLE)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mixture has them: small sources repeat, large ones are cut to their budget.

    A null source is a source of its own; a text without words costs nothing; rows that repeat an id share its fate.
    """
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 tokens; null texts are empty ones, repeated rows are packed as they come."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("MinHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: the stages learn a model, sketch with hashes and tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        start = made()
        after = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            # What the stage wrote on its way, and its input, are read no more once its result is written.
            after = staged(after)
            sweep(spark, start - (k > 0), after)
        docs = after
    return docs
