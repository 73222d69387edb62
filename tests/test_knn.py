"""Inverted file: recall, exactness, hot groups, odd vectors, plans."""

from __future__ import annotations

import random

import duckdb
import numpy as np
import pytest

from quarry.plans.inspect import pairwise_operators, plan_text
from quarry.search import bitmap, knn
from quarry.sources.tables import load
from tests.conftest import conf

SF1 = "/root/testdata/sf0.1"


def truth(path, pattern=""):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{path}/embeddings.parquet{pattern}')")
    return {tuple(r) for r in con.sql(knn.EXACT_SQL).fetchall()}


def found(df):
    return {tuple(r) for r in df.select("query_id", "rank", "neighbour_id", "cosine").collect()}


def test_recall_and_exactness(spark):
    index = knn.InvertedFile(load(spark, SF1, "embeddings"), knn.K)
    want = truth(SF1)
    assert found(index.search("id % 20 = 0", exact=True)) == want
    pairs = {(q, n) for q, _, n, _ in want}
    got = {(q, n) for q, _, n, _ in found(index.search("id % 20 = 0"))}
    assert len(pairs & got) >= 0.9 * len(pairs)
    assert index.probes < len(index.centroids)
    few = {(q, n) for q, _, n, _ in found(index.search("id % 20 = 0", probes=1))}
    assert len(pairs & few) < len(pairs & got)                              # the cells do decide


def _table(spark, rows, path):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, ids string, cell string").repartition(3) \
        .write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_hot_copies_ties_and_odd_vectors(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(knn, "PIECE", 7)                                    # every cell is many pieces
    monkeypatch.setattr(knn, "QUERY_PIECE", 3)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(240, 6)).astype(np.float32)
    x[::3] = x[0]                                                           # a third are copies
    x[1::9] = x[1] * np.linspace(1, 2, len(x[1::9]))[:, None]               # equal but for the length
    rows = [(i, v.tolist(), 0, "clash", "clash") for i, v in enumerate(x)]
    odd = [None, [], [0.0] * 6, [1.0] * 5, [float("nan")] * 6, [float("inf")] + [1.0] * 5, [None] + [1.0] * 5]
    rows += [(1000 + 20 * i, v, None, None, None) for i, v in enumerate(odd)] + [(None, x[2].tolist(), 1, None, None)]
    path = _table(spark, rows, tmp_path)
    assert found(knn.knn_exact(spark, path)) == truth(path, "/*.parquet")


@pytest.mark.parametrize("rows", [[], [(20, [1.0, 2.0], 0, "", "")], [(0, None, 0, "", "")],
                                  [(0, [1.0], 0, "", ""), (20, [-1.0], 0, "", ""), (21, [2.0], 0, "", "")]])
def test_tiny_tables(spark, tmp_path, rows):
    path = _table(spark, rows, tmp_path)
    assert found(knn.knn_exact(spark, path)) == truth(path, "/*.parquet")
    assert found(knn.knn_vectors(spark, path)) <= truth(path, "/*.parquet")


def test_no_pairwise_plan(spark):
    with conf(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        plan = plan_text(knn.knn_exact(spark, "/root/testdata/sf0.001"))
    assert not pairwise_operators(plan)


def test_bit_map(spark):
    rng = random.Random(1)
    keys = [rng.getrandbits(63) - (1 << 62) for _ in range(500)]
    bits = bitmap.bit_map(spark.createDataFrame([(k,) for k in keys], "key long"), 14)
    assert bitmap.in_bit_map(bits, 14, np.asarray(keys).view(np.uint64)).all()
    assert np.unpackbits(bits).sum() == len({k & ((1 << 14) - 1) for k in keys})
