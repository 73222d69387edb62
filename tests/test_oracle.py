"""Every registered query against its DuckDB twin at sf0.01: same column
names, same types, same multiset of rows (exact)."""

from __future__ import annotations

import pytest

from quarry.catalog import entries
from tools.oracle_check import compare

from .conftest import SF01

ORACLE = {k: e for k, e in entries().items() if e.oracle}


def test_every_query_has_an_oracle():
    missing = [k for k, e in entries().items() if not e.oracle]
    assert missing == ["knn_vectors"]         # approximate: its recall is tested in test_knn.py


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_duckdb(spark, duck, name):
    problems, rows, _ = compare(spark, duck, name, ORACLE[name], SF01)
    assert not problems, problems
    assert rows > 0
