"""Bounded training samples of labelled documents, shared by classifiers.

A label counts if its document's crc32 remainder puts it in the learning
part; contradictory repeated labels of one id are left out.  The bound on the
sample is a parameter of every classifier and holds for rows: ids are chosen by
a hash, and an id that many rows share counts once, with one of its texts (the
one of the least hash), so the sample is the same whatever the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import crc_mod, hash_sample, written

FOLDS = 5


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, only: int | None = None,
                    id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """(label int, text) of about ``most`` labelled learning rows, one for an
    id, written to the scratch folder; ``only`` keeps one label value.  Null texts count as
    empty, null ids and null labels are left out."""
    known = (labels.where(F.col(f"`{id_col}`").isNotNull() & F.col(f"`{label}`").isNotNull())
             .where(crc_mod(id_col, folds) != 0)
             .groupBy(F.col(f"`{id_col}`").alias("doc_id"))
             .agg(F.min(f"`{label}`").cast("int").alias("label"), F.max(f"`{label}`").cast("int").alias("other"))
             .where("label = other").select("doc_id", "label"))
    if only is not None:
        known = known.where(F.col("label") == only)
    chosen = F.broadcast(hash_sample(known, ["doc_id"], most, 7))     # at most about ``most`` rows of 12 bytes
    texts = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    least = F.min(F.struct(F.xxhash64("text").alias("h"), "text"))
    return written(texts.join(chosen, "doc_id").groupBy("doc_id").agg(F.min("label").alias("label"), least.alias("least"))
                   .select("label", "least.text"), "labelled")
