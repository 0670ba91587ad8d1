"""Run registered queries against their SQL counterparts in DuckDB and report differences.

    python check_oracle.py [--sf /root/testdata/sf0.01] [--only name,name]
"""

from __future__ import annotations

import argparse
import decimal
import glob
import os
import time

import duckdb
import pandas as pd

from eventmart.plans.queries import ORACLE, QUERIES
from eventmart.session import build_session


def normal(frame: pd.DataFrame, digits: int = 9) -> pd.DataFrame:
    """Columns by name, values as comparable text, rows in order."""
    out = pd.DataFrame(
        {name: [_text(v, digits) for v in frame[name]] for name in sorted(frame.columns)}
    )
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def _text(value, digits: int) -> str:
    if value is None:
        return ""
    if isinstance(value, float):
        return "" if value != value else f"{value:.{digits}g}"
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return str(value)


def connect(duckdb, sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{file}')")
    return con


def rows(frame) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in frame.collect()], columns=frame.columns, dtype=object)


def expected(con, sql: str) -> pd.DataFrame:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    return pd.DataFrame(result.fetchall(), columns=names, dtype=object)


def both(spark, con, sf_dir: str, query, sql: str) -> tuple[pd.DataFrame, pd.DataFrame]:
    return rows(query(spark, sf_dir)), expected(con, sql)


def type_differences(frame, con, sql: str) -> list[str]:
    """Columns whose Spark and SQL types differ, after mapping names."""
    same = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT",
            "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
            "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}
    want = {c[0]: str(c[1]) for c in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [
        f"{name}: {kind} vs {want.get(name)}"
        for name, kind in frame.dtypes
        if same.get(kind, kind) != want.get(name)
    ]


def main() -> int:
    args = argparse.ArgumentParser()
    args.add_argument("--sf", default="/root/testdata/sf0.01")
    args.add_argument("--only", default="")
    args.add_argument("--digits", type=int, default=9, help="significant digits compared")
    opts = args.parse_args()
    spark = build_session(
        "check",
        f"local[{os.environ.get('BENCH_CPUS', '8')}]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(duckdb, opts.sf)
    bad = 0
    for name in [n for n in opts.only.split(",") if n] or QUERIES:
        start = time.time()
        try:
            frame = QUERIES[name](spark, opts.sf)
            got = rows(frame)
        except Exception as error:
            bad += 1
            print(f"FAIL {name}: {type(error).__name__} {str(error)[:2500]} {str(getattr(error, "java_exception", ""))[:2500]}")
            continue
        took = time.time() - start
        if name not in ORACLE:
            print(f"rows {name}: {len(got)} ({took:.1f}s)")
            continue
        try:
            want = expected(con, ORACLE[name])
            for line in type_differences(frame, con, ORACLE[name]):
                print(f"type {name}: {line}")
        except Exception as error:
            bad += 1
            print(f"FAIL oracle {name}: {str(error)[:2500]} {str(getattr(error, "java_exception", ""))[:2500]}")
            continue
        if sorted(got.columns) != sorted(want.columns):
            bad += 1
            print(f"DIFF {name}: columns {sorted(set(got.columns) ^ set(want.columns))}")
            continue
        left, right = normal(got, opts.digits), normal(want, opts.digits)
        if left.equals(right):
            print(f"ok   {name}: {len(got)} rows ({took:.1f}s)")
        else:
            bad += 1
            print(f"DIFF {name}: {len(left)} vs {len(right)} rows")
            if len(left) == len(right):
                for c in left.columns:
                    n = int((left[c] != right[c]).sum())
                    if n:
                        at = (left[c] != right[c]).idxmax()
                        print(f"     {c}: {n} differ, e.g. {left[c][at]!r} vs {right[c][at]!r}")
    print("differences:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
