"""Scalar functions: strings, dates, maths, arrays, maps and JSON.

All of them are built-in Catalyst expressions, so they run inside
whole-stage code generation next to the scan; none crosses into Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.functions.numeric import exact_sum
from quarry.sources.tables import Tables


@query("string_funcs", oracle="""
SELECT p_partkey,
       UPPER(p_name) AS name_upper,
       SPLIT_PART(p_name, ' ', 2) AS name_noun,
       CAST(REGEXP_EXTRACT(p_brand, '#([0-9]+)', 1) AS INTEGER) AS brand_no,
       REGEXP_REPLACE(p_name, '[aeiou]', '*', 'g') AS name_masked,
       SUBSTRING(p_name, 2, 4) AS name_mid,
       LPAD(CAST(p_size AS VARCHAR), 3, '0') AS size_padded,
       CONCAT_WS('-', p_type, p_brand) AS type_brand,
       CAST(LENGTH(p_name) AS INTEGER) AS name_len,
       TRIM(CONCAT('  ', p_name, '  ')) AS name_trimmed,
       REVERSE(p_name) AS name_reversed,
       REPLACE(p_brand, 'Brand#', 'B') AS brand_short,
       CAST(INSTR(p_name, 'r') AS INTEGER) AS first_r,
       p_name LIKE '%ring%' AS has_ring
FROM part
""")
def string_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    return p.select(
        "p_partkey",
        F.upper("p_name").alias("name_upper"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("name_noun"),
        F.regexp_extract("p_brand", r"#([0-9]+)", 1).cast("int").alias("brand_no"),
        F.regexp_replace("p_name", "[aeiou]", "*").alias("name_masked"),
        F.substring("p_name", 2, 4).alias("name_mid"),
        F.lpad(F.col("p_size").cast("string"), 3, "0").alias("size_padded"),
        F.concat_ws("-", "p_type", "p_brand").alias("type_brand"),
        F.length("p_name").cast("int").alias("name_len"),
        F.trim(F.concat(F.lit("  "), "p_name", F.lit("  "))).alias("name_trimmed"),
        F.reverse("p_name").alias("name_reversed"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("B")).alias("brand_short"),
        F.instr("p_name", "r").cast("int").alias("first_r"),
        F.col("p_name").like("%ring%").alias("has_ring"),
    )


@query("date_funcs", oracle="""
SELECT o_orderkey,
       CAST(YEAR(o_orderdate) AS INTEGER) AS yr,
       CAST(QUARTER(o_orderdate) AS INTEGER) AS qtr,
       CAST(MONTH(o_orderdate) AS INTEGER) AS mon,
       CAST(DAYOFWEEK(o_orderdate) + 1 AS INTEGER) AS dow,
       CAST(WEEKOFYEAR(o_orderdate) AS INTEGER) AS iso_week,
       CAST(HOUR(o_orderdate + INTERVAL 90 MINUTE) AS INTEGER) AS hour_plus_90m,
       CAST(DATE_TRUNC('month', o_orderdate) AS TIMESTAMP) AS month_start,
       CAST(LAST_DAY(CAST(o_orderdate AS DATE)) AS TIMESTAMP) AS month_end,
       CAST(CAST(o_orderdate AS DATE) + 30 AS TIMESTAMP) AS due_date,
       CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS TIMESTAMP) AS next_month,
       CAST(DATEDIFF('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS days_to_2002,
       o_orderdate + INTERVAL 90 MINUTE AS plus_90m,
       STRFTIME(o_orderdate, '%Y-%m') AS ym
FROM orders
""")
def date_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = Tables(spark, sf_dir).orders
    ts = F.col("o_orderdate")
    d = F.to_date(ts)
    plus90 = ts + F.expr("INTERVAL 90 MINUTES")
    return o.select(
        "o_orderkey",
        F.year(ts).alias("yr"),
        F.quarter(ts).alias("qtr"),
        F.month(ts).alias("mon"),
        F.dayofweek(ts).alias("dow"),
        F.weekofyear(ts).alias("iso_week"),
        F.hour(plus90).alias("hour_plus_90m"),
        F.trunc(d, "MM").cast("timestamp_ntz").alias("month_start"),
        F.last_day(d).cast("timestamp_ntz").alias("month_end"),
        F.date_add(d, 30).cast("timestamp_ntz").alias("due_date"),
        F.add_months(d, 1).cast("timestamp_ntz").alias("next_month"),
        F.datediff(F.lit("2002-01-01").cast("date"), d).cast("bigint").alias("days_to_2002"),
        plus90.alias("plus_90m"),
        F.date_format(ts, "yyyy-MM").alias("ym"),
    )


@query("math_funcs", oracle="""
SELECT p_partkey,
       CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2)) * 1.07, 2) AS DOUBLE) AS price_with_vat,
       CAST(FLOOR(p_retailprice) AS BIGINT) AS price_floor,
       CAST(CEIL(p_retailprice) AS BIGINT) AS price_ceil,
       POWER(p_size, 2) AS size_sq,
       SQRT(p_size) AS size_sqrt,
       ROUND(LN(p_retailprice), 9) AS ln_price,
       ROUND(LOG10(p_retailprice), 9) AS log10_price,
       p_size % 7 AS size_mod7,
       CAST(SIGN(p_size - 25) AS INTEGER) AS size_sign,
       ABS(p_size - 25) AS size_dist,
       GREATEST(p_size, 20) AS size_min20,
       LEAST(p_size, 40) AS size_max40
FROM part
""")
def math_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = Tables(spark, sf_dir).part
    size = F.col("p_size")
    return p.select(
        "p_partkey",
        F.round(F.col("p_retailprice").cast("decimal(12,2)") * F.lit(1.07).cast("decimal(3,2)"), 2)
         .cast("double").alias("price_with_vat"),
        F.floor("p_retailprice").cast("bigint").alias("price_floor"),
        F.ceil("p_retailprice").cast("bigint").alias("price_ceil"),
        F.pow(size, 2).alias("size_sq"),
        F.sqrt(size).alias("size_sqrt"),
        F.round(F.ln("p_retailprice"), 9).alias("ln_price"),
        F.round(F.log10("p_retailprice"), 9).alias("log10_price"),
        (size % 7).alias("size_mod7"),
        F.signum(size - 25).cast("int").alias("size_sign"),
        F.abs(size - 25).alias("size_dist"),
        F.greatest(size, F.lit(20)).alias("size_min20"),
        F.least(size, F.lit(40)).alias("size_max40"),
    )


@query("array_funcs", oracle="""
SELECT vec_id, label,
       CAST(LEN(embedding) AS INTEGER) AS dim,
       embedding[1] AS first_component,
       LIST_MAX(embedding) AS max_component,
       LIST_MIN(embedding) AS min_component,
       CAST(LEN(LIST_FILTER(embedding, lambda x: x > 0)) AS INTEGER) AS n_positive,
       CAST(LIST_POSITION(embedding, LIST_MAX(embedding)) AS INTEGER) AS argmax,
       ROUND(LIST_REDUCE(LIST_TRANSFORM(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)),
                         lambda a, b: a + b), 6) AS norm_sq
FROM embeddings
""")
def array_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = Tables(spark, sf_dir).embeddings
    v = F.col("embedding")
    sq = F.transform(v, lambda x: x.cast("double") * x.cast("double"))
    return e.select(
        "vec_id", "label",
        F.size(v).alias("dim"),
        F.element_at(v, 1).alias("first_component"),
        F.array_max(v).alias("max_component"),
        F.array_min(v).alias("min_component"),
        F.size(F.filter(v, lambda x: x > 0)).alias("n_positive"),
        F.array_position(v, F.array_max(v)).cast("int").alias("argmax"),
        F.round(F.aggregate(sq, F.lit(0.0), lambda acc, x: acc + x), 6).alias("norm_sq"),
    )


@query("array_explode", oracle="""
SELECT label, CAST(pos AS INTEGER) AS pos,
       ROUND(AVG(CAST(x AS DOUBLE)), 6) AS centroid, COUNT(*) AS n
FROM (SELECT label, UNNEST(embedding) AS x, UNNEST(RANGE(1, LEN(embedding) + 1)) AS pos
      FROM embeddings) t
GROUP BY label, pos
""")
def array_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-label centroid: explode vectors to (position, component) rows and
    average per position (a partial aggregate, one row per label x dim)."""
    e = Tables(spark, sf_dir).embeddings
    return (e.select("label", F.posexplode("embedding").alias("p0", "x"))
             .groupBy("label", (F.col("p0") + 1).cast("int").alias("pos"))
             .agg(F.round(F.avg(F.col("x").cast("double")), 6).alias("centroid"),
                  F.count(F.lit(1)).alias("n")))


@query("map_funcs", oracle="""
WITH c AS (SELECT user_id, event_type, COUNT(*) AS n FROM events GROUP BY user_id, event_type)
SELECT user_id, event_type, n,
       COUNT(*) OVER (PARTITION BY user_id) AS n_types,
       COALESCE(MAX(CASE WHEN event_type = 'view' THEN n END) OVER (PARTITION BY user_id), 0) AS n_view
FROM c
""")
def map_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-user map event_type -> count, then flattened back to rows.

    The map per user holds at most one entry per event type (a small, fixed
    domain), so collecting it per user is bounded whatever the user's size;
    the counts themselves come from a partial aggregate.  A map has no NULL
    key: the count of events without type is kept beside it.
    """
    ev = Tables(spark, sf_dir).events
    counts = ev.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    typed = F.when(F.col("event_type").isNotNull(), F.struct("event_type", "n"))
    maps = counts.groupBy("user_id").agg(
        F.map_from_entries(F.collect_list(typed)).alias("m"),
        F.max(F.when(F.col("event_type").isNull(), F.col("n"))).alias("untyped"))
    entries = F.map_entries("m")
    entry = F.struct(F.lit(None).cast("string").alias("key"), F.col("untyped").alias("value"))
    rows = F.when(F.col("untyped").isNull(), entries).otherwise(F.concat(entries, F.array(entry)))
    return maps.select(
        "user_id", F.inline(rows).alias("event_type", "n"),
        F.size(rows).cast("bigint").alias("n_types"),
        F.coalesce(F.col("m").getItem("view"), F.lit(0)).cast("bigint").alias("n_view"))


@query("json_funcs", oracle="""
SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       COUNT(*) AS n_events,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM events
GROUP BY 1
""")
def json_funcs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = Tables(spark, sf_dir).events
    parsed = ev.select(F.from_json("props", "k INT").getField("k").alias("k"), "value")
    return parsed.groupBy("k").agg(F.count(F.lit(1)).alias("n_events"),
                                   exact_sum("value").alias("total_value"))
