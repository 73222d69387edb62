"""The driver contract in __spark_entry__.py."""

from __future__ import annotations

import importlib.util
from pathlib import Path

ENTRY = Path(__file__).resolve().parents[1] / "__spark_entry__.py"


def _module():
    spec = importlib.util.spec_from_file_location("spark_entry_under_test", ENTRY)
    m = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(m)
    return m


def test_entry_runs_on_smoke_data(spark):
    df = _module().entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["l_returnflag", "l_linestatus", "sum_qty", "sum_base_price",
                          "sum_disc_price", "sum_charge", "avg_qty", "avg_price", "avg_disc",
                          "count_order"]


def test_every_engine_query_has_sql_twin_and_callable():
    m = _module()
    q, o = m.queries(), m.oracle_sql()
    engine = set(m.catalog.queries())
    assert len(engine) == 59
    assert engine <= set(q) and engine - set(o) == {"knn_vectors"}          # approximate: its recall is tested
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert all(isinstance(s, str) and "SELECT" in s.upper() for s in o.values())
