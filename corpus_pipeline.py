"""A corpus pipeline of five stages over the ``documents`` table.

Every stage is a function (spark, docs, sf_dir) -> DataFrame that calls one
operator of ``quarry.llm`` on all that the stage before kept; its result is
written as Parquet and read again as the next one's input.  All stages but the
last return the columns of ``documents``:

1. toxicity: documents that the classifier rejects go;
2. near_duplicates: one row of each SimHash group stays (one with the smallest
   id; rows without id come last);
3. decontamination: documents with a benchmark passage go;
4. pii: personal data become format-preserving pseudonyms (``n_chars`` follows
   the new text);
5. packing: the documents as pieces of packed sequences.

Ids may repeat or be null, so stages 2 and 3 decide by a row key of 128 hashed
bits over all columns (but maps): only rows that are equal throughout share one.
The rows that go are sought by a bit map of their keys, so the texts that stay
are not shuffled.

A null or empty text is a document like any other: no toxic words, fingerprint
zero (one of them stays), no leak, nothing private, the end id alone when
packed.  Empty tables pass through every stage as no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontamination, packing, pii, simhash, toxicity
from quarry.llm.common import bounded_batches, pick, written
from quarry.llm.keep import divided, give_back
from quarry.sources.tables import load

TOXIC = 0.5
#: bytes of one Arrow batch: a batch is held several times over, in the
#: executor and in the worker, by every task
BATCH_BYTES = 2 << 20


def _bounded(spark: SparkSession) -> None:
    """Small Arrow batches, by rows (unless set otherwise) and by bytes; what the
    stage before has freed in the driver goes back."""
    give_back()
    bounded_batches(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


KEY = ("__row_a", "__row_b")


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with the columns KEY, the same whenever they are computed."""
    parts = [e for f in docs.schema.fields if "map<" not in f.dataType.simpleString()
             for e in (F.col(f"`{f.name}`").isNull(), F.col(f"`{f.name}`"))]        # a null does not change a hash
    return docs.select("*", *[F.xxhash64(F.lit(k), *parts).alias(k) for k in KEY])


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    model = toxicity.train(pick(docs, "doc_id", "text"), load(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, out="__score", keep_text=True)
    return pick(scored.where(F.col("__score") < TOXIC), *docs.columns)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    keyed = _keyed(docs)
    row = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", *KEY)        # in the order of ids
    found = written(simhash.near_duplicates(keyed.select(row.alias("doc_id"), "text")), "groups")
    gone = written(found.where("doc_id <> component_id").select(*[f"doc_id.{k}" for k in KEY]).distinct(), "gone")
    twice = written(found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1")
                    .select(*[f"doc_id.{k}" for k in KEY]), "twice")
    sure, doubtful = divided(keyed, gone.unionByName(twice), KEY[0])
    left = doubtful.join(gone, list(KEY), "left_anti")
    return pick(sure.unionByName(left.join(twice, list(KEY), "left_anti")).unionByName(
        left.join(twice, list(KEY), "left_semi").dropDuplicates(list(KEY))), *docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    keyed = _keyed(docs)
    found = decontamination.leaks(keyed.select(F.struct(*KEY).alias("doc_id"), "text"),
                                  pick(load(spark, sf_dir, "benchmark"), "item_id", "text"))
    gone = written(found.select(*[f"doc_id.{k}" for k in KEY]).distinct(), "leaks")
    sure, doubtful = divided(keyed, gone, KEY[0])
    return pick(sure.unionByName(doubtful.join(gone, list(KEY), "left_anti")), *docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    clean = pii.pseudonymise(docs)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return pick(clean, *docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _bounded(spark)
    return packing.digest(packing.pack(pick(docs, "doc_id", "text")))


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: no SQL for the stages; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the whole ``documents`` table."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
