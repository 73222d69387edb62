"""VARIANT: JSON of any shape in one column, without a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.catalog import query
from quarry.sources.tables import Tables

# shapes that a stream of event payloads shows over the years: as is, nested,
# numbers as text, a list, cut off, no object at all, JSON null
_SHAPES = """CASE CAST(event_id % 8 AS INT)
    WHEN 0 THEN props
    WHEN 1 THEN '{"a": {"k": ' || event_id || '}, "k": "' || user_id || '"}'
    WHEN 2 THEN '{"list": [' || event_id || ', {"k": ' || user_id || '}], "t": true}'
    WHEN 3 THEN '{"k": ' || event_id
    WHEN 4 THEN '"' || event_type || '"'
    WHEN 5 THEN 'null'
    WHEN 6 THEN '{"k": null, "v": ' || event_id || '.5}'
    ELSE NULL END"""


def paths_of(json: str, paths: dict[str, tuple[str, str]]) -> list:
    """Columns of a JSON text column parsed as VARIANT once: for each name a
    (path, type); broken text, a missing path and an unfit type are NULL."""
    v = F.try_parse_json(json)
    return [F.try_variant_get(v, path, kind).alias(name) for name, (path, kind) in paths.items()]


@query("variant_json", oracle=f"""
WITH s AS (SELECT event_id, {_SHAPES} AS j FROM events),
p AS (SELECT event_id, CASE WHEN json_valid(j) THEN CAST(j AS JSON) END AS v, j FROM s)
SELECT event_id, v IS NOT NULL AS valid,
       json_extract_string(v, '$.k') AS k_text,
       TRY_CAST(json_extract_string(v, '$.k') AS BIGINT) AS k,
       TRY_CAST(json_extract_string(v, '$.a.k') AS BIGINT) AS nested,
       TRY_CAST(json_extract_string(v, '$.list[1].k') AS BIGINT) AS listed,
       TRY_CAST(json_extract_string(v, '$.v') AS DOUBLE) AS number,
       COALESCE(json_type(v) = 'NULL', false) AS json_null
FROM p
""")
def variant_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of mixed shapes: paths, types, missing keys and broken JSON."""
    events = Tables(spark, sf_dir).events.select("event_id", F.expr(_SHAPES).alias("j"))
    v = F.try_parse_json("j")
    columns = paths_of("j", {"k_text": ("$.k", "string"), "k": ("$.k", "long"), "nested": ("$.a.k", "long"),
                             "listed": ("$.list[1].k", "long"), "number": ("$.v", "double")})
    return events.select("event_id", v.isNotNull().alias("valid"), *columns,
                         F.coalesce(F.is_variant_null(v), F.lit(False)).alias("json_null"))
