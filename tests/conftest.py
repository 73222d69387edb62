from __future__ import annotations

import sys
import tempfile
from contextlib import contextmanager
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from quarry.operators.skew import CONF_MAX_GROUP_ROWS  # noqa: E402
from quarry.session import build_session  # noqa: E402
from quarry.sources.tables import TABLES  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="quarry-test-ckpt-")
    s = build_session(master="local[4]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": ckpt,
                             "spark.driver.memory": "8g"})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@contextmanager
def conf(spark, key, value):
    old = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


@contextmanager
def hot_budget(spark, rows: int):
    """Force the skew path: every key above ``rows`` rows counts as hot."""
    with conf(spark, CONF_MAX_GROUP_ROWS, rows):
        yield
