"""Order-dependent queries give the same rows whatever the partitioning."""

from __future__ import annotations

import pytest

from quarry.catalog import queries

from .conftest import SF001, conf

ORDER_DEPENDENT = ["window_rank", "window_offset", "window_rows_frame", "window_range_frame",
                   "topk_per_group", "topk_global", "lateral_join", "asof_join", "theta_join",
                   "exact_percentiles", "stream_sink_upsert"]


def _rows(spark, name):
    df = queries()[name](spark, SF001)
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("name", ORDER_DEPENDENT)
def test_same_rows_under_1_and_8_shuffle_partitions(spark, name):
    with conf(spark, "spark.sql.shuffle.partitions", 1):
        one = _rows(spark, name)
    with conf(spark, "spark.sql.shuffle.partitions", 8):
        eight = _rows(spark, name)
    assert one == eight
    assert len(one) > 0
