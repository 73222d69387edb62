"""Skew-aware ordered computations within groups.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task.  If
one key holds a third of the table, that task holds a third of the table.
``ordered_scan`` computes the same per-row results -- row_number, rank,
dense_rank, running sums, last non-null value and the group size -- without
that bottleneck:

1. Count rows per key (a partial aggregate; one small job).  Keys above a
   row budget are *hot*.  Their number is at most total_rows / budget and is
   checked before the hot key list is broadcast.
2. Cold keys (the usual case, often all of them) take the ordinary window:
   one shuffle on the key, no group larger than the budget.
3. Hot rows are range-partitioned on (key, order) once (written to the shared
   scratch folder, so all consumers share one set of bounds).  The range partitioner samples the
   data, so one hot key is cut into many contiguous pieces -- even a single
   order value shared by many rows is split; rank offsets subtract the
   earlier rows tied with a piece's first value.  Each piece is windowed
   locally; a per-piece summary (rows, sums, distinct values, last value)
   is aggregated map-side, prefix-summed across pieces, and joined back as
   an offset.  Only keys crossing a piece boundary need one; their summary
   has at most 2 x #pieces rows and is broadcast while that is below
   ``MAX_BROADCAST_PIECES``, else joined on (key, piece).  With more hot keys
   than can be listed, every key is split.

Cost: one small count job when the plan is built; with hot keys the input is
evaluated for the count, the cold and the hot branch.

Results are exact and identical to the plain window; only the physical
plan differs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path

# Rows one task handles comfortably in a window sort (spills beyond memory).
DEFAULT_MAX_GROUP_ROWS = 4_000_000
# Most hot keys listed and broadcast; beyond this every key is split.
MAX_HOT_KEYS = 100_000
# Most pieces whose summary (two rows each) is broadcast.
MAX_BROADCAST_PIECES = 10_000
CONF_MAX_GROUP_ROWS = "spark.quarry.skew.maxGroupRows"


@dataclass(frozen=True)
class Out:
    """One output column of ``ordered_scan``.

    kind: ``row_number`` | ``rank`` | ``dense_rank`` | ``running_sum`` |
    ``last_non_null`` | ``group_count`` | ``group_sum`` | ``lag`` | ``lead`` |
    ``first`` | ``last`` | ``rows_sum``; ``col`` names the input column of all
    but the first three and ``group_count``.  ``lag`` and ``lead`` look one row
    back or ahead, ``first`` and ``last`` are the group's ends in full order,
    ``rows_sum`` adds up the current row and the ``rows`` - 1 before it.
    """
    kind: str
    name: str
    col: str | None = None
    rows: int = 0


def _sort_col(name: str, asc: bool) -> Column:
    return F.col(name).asc() if asc else F.col(name).desc()


def _max_group_rows(df: DataFrame) -> int:
    v = df.sparkSession.conf.get(CONF_MAX_GROUP_ROWS, None)
    return int(v) if v else DEFAULT_MAX_GROUP_ROWS


def _ns_join(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Null-safe equi-join on ``cols``; the right copies are dropped."""
    r = right.select(*[F.col(c).alias(f"_r_{c}") if c in cols else F.col(c)
                       for c in right.columns])
    cond = None
    for c in cols:
        e = F.col(c).eqNullSafe(F.col(f"_r_{c}"))
        cond = e if cond is None else cond & e
    return left.join(r, cond, how).drop(*[f"_r_{c}" for c in cols])


def hot_keys(df: DataFrame, keys: list[str], max_rows: int) -> tuple[list | None, int]:
    """Keys with more than ``max_rows`` rows, and their total row count.

    One job: partial count per key, filter, and a collect capped at
    ``MAX_HOT_KEYS + 1`` rows.  Beyond the cap the list is not returned
    (``None``, with the total row count) and the caller splits every key.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.where(F.col("_n") > max_rows).limit(MAX_HOT_KEYS + 1).collect()
    if len(rows) > MAX_HOT_KEYS:
        total = counts.agg(F.sum("_n")).first()[0]
        return None, int(total)
    return rows, sum(r["_n"] for r in rows)


def ordered_scan(df: DataFrame, keys: list[str], order: list[tuple[str, bool]],
                 outs: list[Out], peers: int | None = None,
                 max_group_rows: int | None = None) -> DataFrame:
    """Per-row ordered results within ``keys`` groups, skew-safe.

    ``order`` is a list of (column, ascending).  ``rank``/``dense_rank``
    treat rows equal on the first ``peers`` order columns as ties (default:
    all of them); ``row_number`` and running values follow the full order,
    which should be unique for deterministic output.  ``last_non_null``
    needs ascending order columns.
    """
    peers = len(order) if peers is None else peers
    budget = max_group_rows or _max_group_rows(df)
    if any(o.kind == "last_non_null" for o in outs) and not all(a for _, a in order):
        raise ValueError("last_non_null needs ascending order columns")
    base_cols = df.columns
    names = [o.name for o in outs]
    hot, hot_rows = hot_keys(df, keys, budget)

    if hot is None:
        # Too many hot keys to list: split every key (exact for any count).
        pieces = max(2, math.ceil(hot_rows / budget))
        return _hot(df, keys, order, outs, peers, pieces).select(*base_cols, *names)

    cold_part = df
    if hot:
        # typed by the table: a list of only NULL keys has no type of its own
        schema = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])
        hot_df = (df.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in hot], schema)
                    .withColumn("_hot", F.lit(True)))
        tagged = _ns_join(df, F.broadcast(hot_df), keys, "left")
        cold_part = tagged.where(F.col("_hot").isNull()).drop("_hot")
        hot_part = tagged.where(F.col("_hot")).drop("_hot")

    result = _cold(cold_part, keys, order, outs, peers).select(*base_cols, *names)
    if hot:
        pieces = max(2, math.ceil(hot_rows / budget) + len(hot))
        h = _hot(hot_part, keys, order, outs, peers, pieces)
        result = result.unionByName(h.select(*base_cols, *names))
    return result


def _windows(keys: list[str], order: list[tuple[str, bool]], peers: int):
    full = Window.partitionBy(*keys).orderBy(*[_sort_col(c, a) for c, a in order])
    peer = Window.partitionBy(*keys).orderBy(*[_sort_col(c, a) for c, a in order[:peers]])
    running = full.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    return full, peer, running, whole


def _cold(df: DataFrame, keys, order, outs, peers) -> DataFrame:
    full, peer, running, whole = _windows(keys, order, peers)
    cols = []
    for o in outs:
        if o.kind == "row_number":
            cols.append(F.row_number().over(full).cast("bigint").alias(o.name))
        elif o.kind == "rank":
            cols.append(F.rank().over(peer).cast("bigint").alias(o.name))
        elif o.kind == "dense_rank":
            cols.append(F.dense_rank().over(peer).cast("bigint").alias(o.name))
        elif o.kind == "running_sum":
            cols.append(F.sum(o.col).over(running).alias(o.name))
        elif o.kind == "last_non_null":
            cols.append(F.last(o.col, ignorenulls=True).over(running).alias(o.name))
        elif o.kind == "group_count":
            cols.append(F.count(F.lit(1)).over(whole).alias(o.name))
        elif o.kind == "group_sum":
            cols.append(F.sum(o.col).over(whole).alias(o.name))
        elif o.kind == "lag":
            cols.append(F.lag(o.col).over(full).alias(o.name))
        elif o.kind == "lead":
            cols.append(F.lead(o.col).over(full).alias(o.name))
        elif o.kind in ("first", "last"):
            ends = full.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            cols.append((F.first if o.kind == "first" else F.last)(o.col).over(ends).alias(o.name))
        elif o.kind == "rows_sum":
            cols.append(F.sum(o.col).over(full.rowsBetween(1 - o.rows, 0)).alias(o.name))
        else:
            raise ValueError(o.kind)
    return df.select("*", *cols)


def _plus(a: Column, b: Column) -> Column:
    """SQL sum of two partial sums: NULL counts as nothing."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def _sum_of(values: Column, kind: T.DataType) -> Column:
    """SUM over an array: NULL elements are skipped, NULL if none is left."""
    return F.aggregate(values, F.lit(None).cast(kind), lambda acc, v: _plus(acc, v))


def _hot(df: DataFrame, keys, order, outs, peers, pieces: int) -> DataFrame:
    # Cut keys into contiguous pieces of the full order, so even one value
    # shared by many rows of a key is spread over pieces (ties may straddle
    # a boundary; the rank offsets below account for that).
    # The range partitioner samples its bounds per evaluation, and column
    # pruning can give each consumer below a different plan, so the pieces are
    # written once: every consumer sees the same bounds, nothing stays cached,
    # and a lost executor costs no more than a read.
    spark = df.sparkSession
    path = scratch_path(spark, "skew")
    ranged = (df.repartitionByRange(pieces, *keys, *[_sort_col(c, a) for c, a in order])
                .withColumn("_pid", F.spark_partition_id()))
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    local_keys = [*keys, "_pid"]
    internal = [Out("row_number", "_i_rn"), Out("rank", "_i_rk"), Out("dense_rank", "_i_dr"),
                Out("group_count", "_i_n")]
    local = _cold(ranged, local_keys, order,
                  internal + [Out(o.kind, f"_l_{o.name}", o.col, o.rows) for o in outs
                              if o.kind != "group_count"], peers)

    # Per-piece summary of the keys that span more than one piece.  Range
    # pieces are contiguous, so each piece boundary is crossed by at most
    # one key: at most (pieces - 1) keys and (2 * pieces) summary rows,
    # whatever the number of keys -- a bound that makes the broadcast safe.
    peer = F.struct(*[F.col(c) for c, _ in order[:peers]])
    aggs = [F.count(F.lit(1)).alias("_pn"),
            F.max("_i_dr").alias("_pd"),                       # distinct peer values
            F.min_by(peer, F.col("_i_rn")).alias("_first"),     # first peer value
            F.max_by(peer, F.col("_i_rn")).alias("_last"),      # last peer value
            F.max("_i_rk").alias("_maxrank")]
    for o in outs:
        if o.kind in ("running_sum", "group_sum"):
            aggs.append(F.sum(o.col).alias(f"_ps_{o.name}"))
        elif o.kind == "last_non_null":
            aggs.append(F.max_by(F.col(o.col), F.when(F.col(o.col).isNotNull(), F.col("_i_rn")))
                        .alias(f"_pl_{o.name}"))
        elif o.kind in ("lag", "last"):
            aggs.append(F.max_by(F.struct(F.col(o.col).alias("v")), F.col("_i_rn")).alias(f"_pe_{o.name}"))
        elif o.kind in ("lead", "first"):
            aggs.append(F.min_by(F.struct(F.col(o.col).alias("v")), F.col("_i_rn")).alias(f"_pe_{o.name}"))
        elif o.kind == "rows_sum":      # the piece's last rows - 1 values, in order
            tail = F.when(F.col("_i_rn") > F.col("_i_n") - (o.rows - 1),
                          F.struct(F.col("_i_rn").alias("i"), F.col(o.col).alias("v")))
            aggs.append(F.transform(F.array_sort(F.collect_list(tail)), lambda x: x["v"]).alias(f"_pt_{o.name}"))
    summary = local.groupBy(*local_keys).agg(*aggs)
    spanning = (summary.groupBy(*keys).agg(F.count(F.lit(1)).alias("_np"))
                       .where(F.col("_np") > 1).select(*keys))
    summary = _ns_join(summary, spanning, keys, "left_semi")

    by_piece = Window.partitionBy(*keys).orderBy("_pid")
    before = by_piece.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    # overlap: this piece starts with the value the previous piece ended on
    overlap = (F.when(F.lag("_pid").over(by_piece).isNull(), F.lit(0))
                .when(F.lag("_last").over(by_piece).eqNullSafe(F.col("_first")), F.lit(1))
                .otherwise(F.lit(0)))
    summary = summary.withColumn("_ov", overlap).withColumn(
        "_cl", F.col("_pn") - F.col("_maxrank") + 1)          # rows equal to the last value
    # rows of earlier pieces equal to this piece's first value: the pieces
    # ending on that value are contiguous and end right before this one
    run = (Window.partitionBy(*keys, "_last").orderBy("_pid")
           .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summary = summary.withColumn("_run", F.sum("_cl").over(run))
    offs = [F.coalesce(F.sum("_pn").over(before), F.lit(0)).alias("_bn"),
            F.coalesce(F.sum(F.col("_pd") - F.col("_ov")).over(before), F.lit(0)).alias("_bd"),
            "_ov",
            F.when(F.col("_ov") == 1, F.lag("_run").over(by_piece)).otherwise(F.lit(0)).alias("_tie"),
            F.sum("_pn").over(whole).alias("_gn")]
    for o in outs:
        if o.kind == "running_sum":
            offs.append(F.sum(f"_ps_{o.name}").over(before).alias(f"_bs_{o.name}"))
        elif o.kind == "group_sum":
            offs.append(F.sum(f"_ps_{o.name}").over(whole).alias(f"_gs_{o.name}"))
        elif o.kind == "last_non_null":
            offs.append(F.last(f"_pl_{o.name}", ignorenulls=True).over(before)
                        .alias(f"_bl_{o.name}"))
        elif o.kind == "lag":
            offs.append(F.lag(f"_pe_{o.name}").over(by_piece).alias(f"_be_{o.name}"))
        elif o.kind == "lead":
            offs.append(F.lead(f"_pe_{o.name}").over(by_piece).alias(f"_be_{o.name}"))
        elif o.kind in ("first", "last"):
            ends = by_piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            offs.append((F.first if o.kind == "first" else F.last)(f"_pe_{o.name}").over(ends)
                        .alias(f"_be_{o.name}"))
        elif o.kind == "rows_sum":      # no piece is empty: rows - 1 of them reach back far enough
            back = F.flatten(F.collect_list(f"_pt_{o.name}").over(by_piece.rowsBetween(1 - o.rows, -1)))
            offs.append(back.alias(f"_bt_{o.name}"))
    offsets = summary.select(*local_keys, *offs)
    joined = _ns_join(local, F.broadcast(offsets) if pieces <= MAX_BROADCAST_PIECES else offsets,
                      local_keys, "left")

    final = []
    bn = F.coalesce(F.col("_bn"), F.lit(0))
    tie = F.when(F.col("_i_rk") == 1, F.coalesce(F.col("_tie"), F.lit(0))).otherwise(F.lit(0))
    for o in outs:
        lo = F.col(f"_l_{o.name}")
        if o.kind == "row_number":
            final.append((bn + lo).cast("bigint").alias(o.name))
        elif o.kind == "rank":
            final.append((bn + lo - tie).cast("bigint").alias(o.name))
        elif o.kind == "dense_rank":
            final.append((F.coalesce(F.col("_bd"), F.lit(0)) + lo
                          - F.coalesce(F.col("_ov"), F.lit(0))).cast("bigint").alias(o.name))
        elif o.kind == "running_sum":
            final.append(_plus(F.col(f"_bs_{o.name}"), lo).alias(o.name))
        elif o.kind == "last_non_null":
            final.append(F.coalesce(lo, F.col(f"_bl_{o.name}")).alias(o.name))
        elif o.kind == "group_count":
            final.append(F.coalesce(F.col("_gn"), F.col("_i_n")).alias(o.name))
        elif o.kind in ("lag", "lead"):
            edge = F.col("_i_rn") == (F.lit(1) if o.kind == "lag" else F.col("_i_n"))
            final.append(F.when(edge, F.col(f"_be_{o.name}.v")).otherwise(lo).alias(o.name))
        elif o.kind in ("first", "last"):
            final.append(F.when(F.col("_gn").isNotNull(), F.col(f"_be_{o.name}.v"))
                          .otherwise(lo).alias(o.name))
        elif o.kind == "rows_sum":
            back = F.coalesce(F.col(f"_bt_{o.name}"), F.array().cast(T.ArrayType(df.schema[o.col].dataType)))
            want = F.least(F.greatest(F.lit(o.rows) - F.col("_i_rn"), F.lit(0)), F.size(back)).cast("int")
            part = F.slice(back, F.size(back) - want + 1, want)
            final.append(_plus(_sum_of(part, local.schema[f"_l_{o.name}"].dataType), lo).alias(o.name))
        elif o.kind == "group_sum":
            # spanning keys: total over pieces; others: the piece is the group
            final.append(F.when(F.col("_gn").isNotNull(), F.col(f"_gs_{o.name}"))
                          .otherwise(lo).alias(o.name))
    return joined.select(*df.columns, *final)


def exact_percentiles(df: DataFrame, keys: list[str], value: str,
                      percentiles: dict[str, float], count: str | None = None) -> DataFrame:
    """Exact continuous percentiles (linear interpolation) per group, and its
    number of rows under the name ``count``.

    No group is gathered and the input is read once: values are counted per
    (group, value) with a partial aggregate, cumulative counts come from
    ``ordered_scan``, and only the (at most two) values around each target
    position are kept.  NULL values count only as rows; a group without any
    other value has NULL percentiles.
    """
    known = F.col(value).isNotNull()
    counted = (df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_all"))
                 .withColumn("_c", F.when(known, F.col("_all")).otherwise(F.lit(0))))
    # every row carries its group's running and total count: no join back
    scanned = ordered_scan(counted, keys, [(value, True)],
                           [Out("running_sum", "_cum", "_c"), Out("group_sum", "_n", "_c"),
                            Out("group_sum", "_rows", "_all")])
    cols = []
    for name, p in percentiles.items():
        pos = (F.col("_n") - 1) * F.lit(float(p))
        cols += [F.floor(pos).alias(f"_lo_{name}"), F.ceil(pos).alias(f"_hi_{name}"),
                 (pos - F.floor(pos)).alias(f"_fr_{name}")]
    j = scanned.select("*", *cols)
    start = F.col("_cum") - F.col("_c")          # 0-based rank of the first copy
    aggs = [F.max("_rows").alias("_rows")]
    for name in percentiles:
        lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        aggs += [F.max(F.when(known & (start <= lo) & (lo < F.col("_cum")), F.col(value))).alias(f"_vlo_{name}"),
                 F.max(F.when(known & (start <= hi) & (hi < F.col("_cum")), F.col(value))).alias(f"_vhi_{name}"),
                 F.first(f"_fr_{name}").alias(f"_f_{name}")]
    near = _any([(start <= F.col(f"_hi_{n}")) & (F.col(f"_lo_{n}") < F.col("_cum"))
                 for n in percentiles])
    picked = j.where(near | ~known).groupBy(*keys).agg(*aggs)
    return picked.select(*keys, *[
        (F.col(f"_vlo_{n}") + (F.col(f"_vhi_{n}") - F.col(f"_vlo_{n}")) * F.col(f"_f_{n}")).alias(n)
        for n in percentiles], *([F.col("_rows").alias(count)] if count else []))


def _any(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
