"""Connected components of an edge table by repeated contraction.

Each round every node points at the neighbour (or itself) of least hashed
priority and edges are relabelled by these pointers; a constant share of the
nodes disappears per round in expectation, whatever the order of the ids.
The pointer tables of all rounds are then composed backwards.  All state is
in tables in the shared folder; nothing passes through the driver but one
"any edge left?" flag per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (long columns a, b; any
    direction, repeats and loops allowed): label is one node of the component.
    A table without edges gives no rows."""
    left = written(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                   .distinct(), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        seed = F.lit(len(rounds))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = lambda c: F.struct(F.xxhash64(F.col(c), seed).alias("h"), F.col(c).alias("n"))
        best = both.groupBy("a").agg(F.min(rank("b")).alias("m"))
        up = written(best.select(F.col("a").alias("node"), F.least("m", rank("a"))["n"].alias("up")), "pointers")
        rounds.append(up)
        pa = up.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        pb = up.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        left = written(left.join(pa, "a").join(pb, "b").where("ua <> ub")
                       .select(F.least("ua", "ub").alias("a"), F.greatest("ua", "ub").alias("b")).distinct(), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    label = rounds[-1].select("node", F.col("up").alias("label"))
    for up in reversed(rounds[:-1]):
        nxt = label.select(F.col("node").alias("up"), "label")
        label = written(up.join(nxt, "up", "left").select("node", F.coalesce("label", "up").alias("label")), "labels")
    return label
