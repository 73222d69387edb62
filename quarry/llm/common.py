"""Helpers shared by the operators: worker caches, scratch tables, batches."""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import scratch_path

#: Rows of text handled at once inside a task.
CHUNK_BYTES = 4 << 20


#: Rows per Arrow batch between Spark and the workers.
BATCH_ROWS = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Texts are long: ten thousand of them in one Arrow batch (Spark's default)
    would take hundreds of MB per task on both sides.  Lowers the session's
    batch size unless it has been set to something else."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, "10000") == "10000":
        spark.conf.set(key, str(BATCH_ROWS))


def worker_cache(name: str) -> dict:
    """A dictionary that lives as long as the Python worker process.

    Package code is shipped to the workers by value, so a module-level
    dictionary would start empty in every task.
    """
    home = sys.modules.setdefault("_quarry_worker_cache", types.ModuleType("_quarry_worker_cache"))
    return home.__dict__.setdefault("slots", {}).setdefault(name, {})


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared scratch folder and read it
    back: cuts lineage, survives lost executors, evaluates the plan once."""
    spark = df.sparkSession
    path = scratch_path(spark, "llm", tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tokens_path(name: str) -> str:
    """Place of a public tokenizer file (never copied into the repository)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def pick(df: DataFrame, *cols: str) -> DataFrame:
    """The named columns only, by exact quoting, so that extra or clashing
    columns of the input never matter."""
    return df.select(*[F.col(f"`{c}`") for c in cols])


def text_chunks(batches: Iterator[pa.RecordBatch], limit: int = CHUNK_BYTES):
    """Split Arrow batches (last column: text) into runs of about ``limit``
    text bytes: (other columns as Arrow arrays, list of str or None)."""
    for batch in batches:
        text = batch.column(batch.num_columns - 1)
        n = batch.num_rows
        if not n:
            continue
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(text), 0)
                           .to_numpy(zero_copy_only=False), dtype=np.int64)
        ends = np.cumsum(sizes)
        start = 0
        while start < n:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            stop = min(stop, n)
            part = batch.slice(start, stop - start)
            yield ([part.column(i) for i in range(batch.num_columns - 1)],
                   part.column(batch.num_columns - 1).to_pylist())
            start = stop


_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Lower-cased runs of letters and digits."""
    return _WORD.findall(text.lower())


def token_words(token: str) -> list[str]:
    """``words`` of a token without white space, the usual case first: one
    word between marks."""
    plain = token.strip(".,;:!?\"'()").lower()
    return [plain] if plain.isalnum() else words(token)


def stable_hash(s: str) -> int:
    """A hash that is the same in every process (unlike ``hash``)."""
    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


class Memo(dict):
    """``memo[key]`` computes a value once.  At ``limit`` entries it stops
    taking in new ones (frequent keys came early) and starts afresh after
    several times as many misses; memory is bounded, results never change."""

    def __init__(self, fn, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit, self.missed = fn, limit, 0

    def __missing__(self, key):
        value = self.fn(key)
        if len(self) < self.limit:
            self[key] = value
        else:
            self.missed += 1
            if self.missed > 4 * self.limit:
                self.clear()
                self.missed = 0
        return value


def crc_mod(column: str, mod: int):
    """crc32 of the id as text, modulo ``mod`` (never null)."""
    return F.coalesce(F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % mod, F.lit(0))


def hash_sample(df: DataFrame, columns: list[str], most: int, seed: int) -> DataFrame:
    """About ``most`` rows chosen by a hash of ``columns`` (all, if fewer): the
    same rows whatever the partitioning.  Rows that are equal in ``columns``
    stay or go together, so they should count once afterwards."""
    n = df.count()
    if n <= most:
        return df
    keep = int(most / n * (1 << 31))
    return df.where(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in columns], F.lit(seed)), F.lit(1 << 31)) < keep)


def text_last(docs: DataFrame, text_col: str) -> tuple[DataFrame, list]:
    """All columns with the text (as string) moved to the end, and the schema
    fields of the others."""
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    source = docs.select(*others, F.col(f"`{text_col}`").cast("string").alias(text_col))
    return source, source.schema.fields[:-1]


def ddl(fields: list) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
