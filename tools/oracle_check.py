"""Run registered queries on Spark and their SQL twins on DuckDB; compare.

    python tools/oracle_check.py [--sf-dir DIR] [name ...]

Compares row count, column names and types (Spark type mapped to the DuckDB
type name) and the multiset of rows, exactly.  Exit status 1 on mismatch.
For test use at small scale factors: both results are brought to this
process.
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from quarry.catalog import entries  # noqa: E402
from quarry.session import build_session  # noqa: E402
from quarry.sources.tables import TABLES  # noqa: E402


def duck_type(dt: T.DataType) -> str:
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision},{dt.scale})"
    if isinstance(dt, T.ArrayType):
        return duck_type(dt.elementType) + "[]"
    return {
        T.LongType: "BIGINT", T.IntegerType: "INTEGER", T.ShortType: "SMALLINT",
        T.ByteType: "TINYINT", T.DoubleType: "DOUBLE", T.FloatType: "FLOAT",
        T.StringType: "VARCHAR", T.BooleanType: "BOOLEAN", T.DateType: "DATE",
        T.TimestampNTZType: "TIMESTAMP", T.TimestampType: "TIMESTAMP WITH TIME ZONE",
    }.get(type(dt), dt.simpleString())


def norm(v):
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, list):
        return tuple(norm(x) for x in v)
    return v


def compare(spark, con, name, entry, sf_dir):
    t0 = time.time()
    df = entry.fn(spark, sf_dir)
    scols = sorted(df.columns)
    sdf = df.select(*scols)
    srows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    stypes = [duck_type(sdf.schema[c].dataType) for c in scols]
    rel = con.sql(entry.oracle)
    dcols = [c for c in rel.columns]
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    dnames = [dcols[i] for i in order]
    dtypes = [str(rel.types[i]) for i in order]
    drows = [tuple(norm(r[i]) for i in order) for r in rel.fetchall()]
    problems = []
    if scols != dnames:
        problems.append(f"columns {scols} vs {dnames}")
    elif stypes != dtypes:
        problems.append("types " + ", ".join(f"{c}:{a}/{b}" for c, a, b in
                                             zip(scols, stypes, dtypes) if a != b))
    if len(srows) != len(drows):
        problems.append(f"rows {len(srows)} vs {len(drows)}")
    cs, cd = Counter(srows), Counter(drows)
    if cs != cd:
        only_s = list((cs - cd).elements())[:3]
        only_d = list((cd - cs).elements())[:3]
        problems.append(f"values differ; spark-only {only_s} duck-only {only_d}")
    return problems, len(srows), t1 - t0


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = build_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{args.sf_dir}/{t}.parquet')")
    bad = 0
    for name, e in entries().items():
        if args.names and name not in args.names:
            continue
        if not e.oracle:
            df = e.fn(spark, args.sf_dir)
            print(f"{name:28s} NO-ORACLE rows={df.count()}")
            continue
        try:
            problems, n, secs = compare(spark, con, name, e, args.sf_dir)
        except Exception as ex:  # report and continue
            problems, n, secs = [f"error {type(ex).__name__}: {str(ex)[:400]}"], -1, 0
        status = "OK" if not problems else "FAIL"
        bad += bool(problems)
        print(f"{name:28s} {status:4s} rows={n:<8d} {secs:6.2f}s {'; '.join(problems)}")
        sys.stdout.flush()
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
