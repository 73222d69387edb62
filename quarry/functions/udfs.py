"""User-defined functions: vectorized scalar UDF, a two-phase grouped UDAF,
and a table function (UDTF) used through SQL LATERAL.

Python is only used where the user-defined code is the point; every UDF is
Arrow-batched (no per-row pickling).

Grouped UDAF at scale: ``pandas_udf`` grouped aggregates have no partial
aggregation -- Spark ships every row of a group to one task and builds one
pandas Series for it, so one large group exhausts a task.  ``TwoPhaseUDAF``
keeps the user code in pandas but splits it the way built-in aggregates are
split: a Python ``partial`` step reduces each Arrow batch to one state row
per group, Spark merges the states with built-in sums (partial aggregation
again, then a shuffle of tiny states), and ``finish`` is a column
expression.  Memory per task is one batch, whatever the group sizes.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udtf, pandas_udf

from quarry.catalog import query
from quarry.sources.tables import Tables, spread


@pandas_udf(T.DoubleType())
def line_charge(ext: pd.Series, disc: pd.Series, tax: pd.Series) -> pd.Series:
    """extendedprice * (1 - discount) * (1 + tax), one Arrow batch at a time."""
    return ext * (1 - disc) * (1 + tax)


@query("vectorized_udf", oracle="""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge
FROM lineitem
""")
def vectorized_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     line_charge("l_extendedprice", "l_discount", "l_tax").alias("charge"))


@dataclass(frozen=True)
class TwoPhaseUDAF:
    """A user aggregate as partial (pandas, per batch) + merge + finish.

    partial(pdf, keys) -> pandas DataFrame with ``keys`` + state columns
    merge: state column -> built-in aggregate used to combine states
    finish: column expression over the merged states
    """
    inputs: tuple[str, ...]
    state_ddl: str
    partial: Callable[[pd.DataFrame, list[str]], pd.DataFrame]
    merge: dict[str, Callable[[str], Column]]
    finish: Callable[[], Column]

    def apply(self, df: DataFrame, keys: list[str], name: str) -> DataFrame:
        cols = [*keys, *self.inputs]
        key_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                            for f in df.select(*keys).schema.fields)
        schema = f"{key_ddl}, {self.state_ddl}"
        partial = self.partial

        def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if len(pdf):
                    yield partial(pdf, keys)

        states = df.select(*cols).mapInPandas(per_batch, schema)
        merged = states.groupBy(*keys).agg(*[agg(c).alias(c) for c, agg in self.merge.items()])
        return merged.select(*keys, self.finish().alias(name))


def _keys_as_objects(out: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    """pandas turns a NULL group key into NaN; give Arrow a real None back."""
    for k in keys:
        col = out[k].astype(object)
        out[k] = col.where(col.notna(), None)
    return out


def _wmean_partial(pdf: pd.DataFrame, keys: list[str]) -> pd.DataFrame:
    pdf = pdf.assign(_vw=pdf["v"] * pdf["w"])
    g = pdf.groupby(keys, dropna=False, sort=False)
    return _keys_as_objects(g.agg(s_vw=("_vw", "sum"), s_w=("w", "sum")).reset_index(), keys)


WEIGHTED_MEAN = TwoPhaseUDAF(
    inputs=("v", "w"),
    state_ddl="s_vw double, s_w double",
    partial=_wmean_partial,
    merge={"s_vw": F.sum, "s_w": F.sum},
    finish=lambda: F.col("s_vw") / F.col("s_w"),
)


@query("grouped_udaf", oracle="""
SELECT l_returnflag, l_linestatus,
       ROUND(SUM(l_discount * l_extendedprice) / SUM(l_extendedprice), 9) AS wmean_disc
FROM lineitem
GROUP BY l_returnflag, l_linestatus
""")
def grouped_udaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Tables(spark, sf_dir).lineitem.select(
        "l_returnflag", "l_linestatus",
        F.col("l_discount").alias("v"), F.col("l_extendedprice").alias("w"))
    out = WEIGHTED_MEAN.apply(li, ["l_returnflag", "l_linestatus"], "wmean_disc")
    return out.select("l_returnflag", "l_linestatus", F.round("wmean_disc", 9).alias("wmean_disc"))


# Fixed value: token separators are runs of ASCII space, tab, CR and LF.
TOKEN_SEPARATOR = r"[ \t\n\r]+"


# Text bytes split at once inside a task: the tokens of a text, their
# positions and their texts' keys take some twenty times its bytes.
TOKEN_CHUNK_BYTES = 1 << 20


def text_runs(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``limit`` bytes of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_pieces(text: pa.Array, limit: int) -> Iterator[pa.Array]:
    """A run's texts as they are, but a single text above ``limit`` bytes in
    pieces of about ``limit``, each ending behind a separator (so that no
    token is cut) or with the text."""
    whole = text[0].as_buffer() if len(text) == 1 else None
    if whole is None or whole.size <= limit:
        yield text
        return
    separator = re.compile(TOKEN_SEPARATOR.encode())
    cuts = [0]
    while cuts[-1] < whole.size:
        found = separator.search(whole, cuts[-1] + limit)
        cuts.append(found.end() if found else whole.size)
    offsets = np.array(cuts, np.int64 if pa.types.is_large_string(text.type) else np.int32)
    pieces = pa.Array.from_buffers(text.type, len(cuts) - 1, [None, pa.py_buffer(offsets), whole])
    for i in range(len(pieces)):
        yield pieces.slice(i, 1)


@arrow_udtf(returnType=T.StructType([T.StructField("doc_id", T.LongType()),
                                     T.StructField("pos", T.IntegerType()),
                                     T.StructField("token", T.StringType())]))
class Tokens:
    """Table function: (doc_id, text) rows -> one row per token of each whole
    text, with its 0-based position among the text's tokens.

    Arrow-native: ``eval`` gets a whole RecordBatch, takes it in runs of about
    TOKEN_CHUNK_BYTES of text, and splits every text of a run with one
    vectorized regex split (RE2, as in the SQL twin); positions come from the
    parent index of each token.  No per-row Python, and a task's memory is one
    batch of texts and the tokens of one run, whatever the batch holds.
    """

    def eval(self, batch: pa.RecordBatch):
        for run in text_runs(batch, TOKEN_CHUNK_BYTES):
            done = 0                    # tokens of a long text's earlier pieces
            for text in text_pieces(run.column("text"), TOKEN_CHUNK_BYTES):
                tokens, parent = self.split(text)
                if not len(tokens):
                    continue
                idx = np.arange(len(parent))
                first = np.ones(len(parent), dtype=bool)
                first[1:] = parent[1:] != parent[:-1]
                pos = idx - np.maximum.accumulate(np.where(first, idx, 0)) + done
                done += len(tokens)
                yield pa.RecordBatch.from_arrays(
                    [pc.take(run.column("doc_id"), pa.array(parent)), pa.array(pos, pa.int32()), tokens],
                    names=["doc_id", "pos", "token"])

    @staticmethod
    def split(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """The tokens of the texts, and for each the index of its text."""
        parts = pc.split_pattern_regex(text, TOKEN_SEPARATOR)
        tokens = pc.list_flatten(parts)
        keep = pc.not_equal(tokens, "")
        parent = pc.filter(pc.list_parent_indices(parts), keep)
        return pc.filter(tokens, keep), parent.to_numpy(zero_copy_only=False)


UDTF_NAME = "quarry_tokens"


@query("udtf_tokens", oracle=f"""
SELECT doc_id, CAST(pos - 1 AS INTEGER) AS pos, token
FROM (SELECT doc_id, UNNEST(toks) AS token, UNNEST(RANGE(1, LEN(toks) + 1)) AS pos
      FROM (SELECT doc_id,
                   LIST_FILTER(REGEXP_SPLIT_TO_ARRAY(text, '{TOKEN_SEPARATOR}'), lambda x: x <> '') AS toks
            FROM documents) d) t
""")
def udtf_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table function registered by name and called from SQL with a
    TABLE argument (Spark sends it the rows in Arrow batches)."""
    spark.udtf.register(UDTF_NAME, Tokens)
    docs = spread(Tables(spark, sf_dir).documents.select("doc_id", "text"))
    return spark.sql(f"SELECT doc_id, pos, token FROM {UDTF_NAME}(TABLE({{docs}}))", docs=docs)
