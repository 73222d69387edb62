"""Every query against its own SQL twin on tables with NULLs in keys,
measures, types and times, stored as folders of several files; also with the
NULL key as the only one above the row budget, and with a hot user."""

from __future__ import annotations

import duckdb
import pytest

from quarry.catalog import entries
from quarry.sources.tables import TABLES
from tests.conftest import SF001, hot_budget
from tools.oracle_check import compare

#: column -> every how many rows it is NULL, by table
NULLS = {
    "events": {"user_id": 4, "event_type": 13, "value": 7, "ts": 31},
    "customer": {"c_mktsegment": 11, "c_nationkey": 17, "c_acctbal": 13},
    "orders": {"o_orderstatus": 9, "o_orderpriority": 11, "o_custkey": 13, "o_orderdate": 41},
    "lineitem": {"l_returnflag": 9, "l_partkey": 11, "l_suppkey": 13, "l_quantity": 17, "l_orderkey": 19},
    "supplier": {"s_nationkey": 4},
}
BATCH = [n for n, e in entries().items() if e.oracle and e.tier == "batch"]
STREAMS = [n for n, e in entries().items() if e.oracle and e.tier == "stream"]


def _tables(spark, root: str, nulls: dict, hot: bool = False) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        df = spark.read.parquet(f"{SF001}/{t}.parquet")
        for k, (col, every) in enumerate(nulls.get(t, {}).items()):
            key = df.columns[0] if df.columns[0] != col else df.columns[1]
            df = df.selectExpr(*[f"CASE WHEN pmod(xxhash64(*, {k}), {every}) = 0 THEN NULL ELSE `{col}` END AS `{col}`"
                                 if c == col else f"`{c}`" for c in df.columns]) if key else df
        if hot and t == "events":
            df = df.selectExpr(*["CASE WHEN event_id % 3 > 0 THEN 7 ELSE user_id END AS user_id"
                                 if c == "user_id" else c for c in df.columns])
        df.repartition(16 if t in ("events", "lineitem") else 3).write.parquet(f"{root}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
    return con


@pytest.fixture(scope="module")
def nulled(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("nulls"))
    return root, _tables(spark, root, NULLS)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("folders"))
    return root, _tables(spark, root, {}, hot=True)


@pytest.mark.parametrize("name", BATCH)
def test_batch_with_nulls(spark, nulled, name):
    root, con = nulled
    problems, _, _ = compare(spark, con, name, entries()[name], root)
    assert not problems, problems


ORDERED = ["window_rank", "window_offset", "window_rows_frame", "window_range_frame", "asof_join",
           "exact_percentiles", "theta_join", "correlated_subquery", "map_funcs", "approx_distinct"]


@pytest.mark.parametrize("budget", [1, 90])
@pytest.mark.parametrize("name", ORDERED)
def test_hot_keys_with_nulls(spark, nulled, name, budget):
    """All keys hot, and only the NULL user hot (90 rows)."""
    root, con = nulled
    with hot_budget(spark, budget):
        problems, _, _ = compare(spark, con, name, entries()[name], root)
    assert not problems, problems


@pytest.mark.parametrize("name", STREAMS)
def test_streams_over_folders_with_a_hot_user(spark, folders, name):
    root, con = folders
    problems, _, _ = compare(spark, con, name, entries()[name], root)
    assert not problems, problems


@pytest.mark.parametrize("name", STREAMS)
def test_streams_with_nulls(spark, nulled, name):
    """Users, values, types and times may be NULL in a stream as well."""
    root, con = nulled
    problems, _, _ = compare(spark, con, name, entries()[name], root)
    assert not problems, problems


@pytest.fixture(scope="module")
def emptied(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("empty"))
    con = duckdb.connect()
    for t in TABLES:
        spark.read.parquet(f"{SF001}/{t}.parquet").limit(0).write.parquet(f"{root}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')")
    return root, con


@pytest.mark.parametrize("name", [n for n, e in entries().items() if e.oracle])
def test_empty_tables(spark, emptied, name):
    root, con = emptied
    problems, _, _ = compare(spark, con, name, entries()[name], root)
    assert not problems, problems


def test_only_the_null_user_is_above_the_budget(spark, nulled):
    counts = spark.read.parquet(f"{nulled[0]}/events.parquet").groupBy("user_id").count()
    assert [r.user_id for r in counts.where("count > 90").collect()] == [None]
