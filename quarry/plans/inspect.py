"""Plan inspection through the public ``explain`` API, as text.

Used by tests (plan-shape assertions) and when tuning a query.
"""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame

# Physical operators that mean "every row against every row": a band or
# inequality join without an equality key.
PAIRWISE_OPERATORS = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def pairwise_operators(plan: str) -> list[str]:
    return [op for op in PAIRWISE_OPERATORS if op in plan]
