"""Small tables for the operators' tests."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SYLLABLES = "ba do ki lu mer ton sal vi qu esh ran pol gri net".split()

#: nulls, empty and word-free texts, ties, repeated rows, odd characters
ODD_TEXTS = [None, "", " ", "\n\t", "a", "!!!", "é漢🙂 \x00 ​", "same text here", "same text here", "1234 5678", "x" * 5000,
             "ab " * 3000, "<s> </s> <|endoftext|> <0x0A>", "  two  spaces  ", "ß ẞ İ ı"]


def prose(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(n))


def documents(spark: SparkSession, texts: list, extra: bool = True) -> DataFrame:
    """doc_id, text and clashing extra columns; some ids null and repeated."""
    rows = [(i, t, "xx", "key", 1.5, i) for i, t in enumerate(texts)]
    if extra:
        rows += [(None, "text without id", None, None, None, None), (3, texts[3], "xx", "key", 2.5, 7)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, `key` string, `score` double, `n` long").repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string")
