"""What the corpus operators share: column hygiene, word splitting and joins with lists of ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.staging import checked, discard, made, staged, staging_dir, sweep  # noqa: F401  shared with the operators here

#: ASCII white space that separates words, as in the class [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def free_name(name: str, taken: list[str]) -> str:
    """name, lengthened until no column is called so; Spark compares names without case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def documents(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra ones can't clash with the operator's own."""
    return df.select(*columns)


def bucket_of(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo: the fixed split into folds. Null ids fall in fold -1."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)), F.lit(-1))


def text_bytes(text: str | None) -> bytes:
    """UTF-8 of a text, null as empty."""
    return (text or "").encode("utf-8", "surrogatepass")


def word_list(text: str | None) -> list[bytes]:
    """The words [^\\x20\\x09-\\x0D]+ with A-Z lower-cased, as UTF-8; bytes.lower and bytes.split know ASCII only."""
    return text_bytes(text).lower().split()


def sql_words(text: Column) -> Column:
    """The same words (case kept) as an array column, without a regular expression per character."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.array_remove(F.split(spaced, " "), "")


def with_ids(df: DataFrame, ids: DataFrame, kind: str, on: str | list[str] = "id") -> DataFrame:
    """df with (left_semi) or without (left_anti) the ids; a list too long to broadcast is joined by a shuffle."""
    return df.join(checked(ids), on, kind)
