"""Run every registered query and compare it with its SQL: ``python -m verification.check [sf] [names]``."""

import sys
import time

import duckdb
import pandas as pd

import verification
from meterflow.session import build_session

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def as_rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or isinstance(value, float) and value != value:
            return "null"
        if isinstance(value, bool) or type(value).__name__ == "bool":
            return str(bool(value))
        if isinstance(value, pd.Timestamp):
            return value.isoformat()
        if isinstance(value, (int, float)) or hasattr(value, "item"):
            return repr(float(value) + 0.0)
        return str(value)

    ordered = frame[sorted(frame.columns)]
    return sorted(tuple(plain(v) for v in row) for row in ordered.itertuples(index=False, name=None))


def main(sf: str = "0.01", *names: str) -> int:
    verification.load()
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="12g",
                          spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    wrong = 0
    for name, run in verification.QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir)
            frame = got.toPandas()
            took = time.time() - start
            if name not in verification.ORACLES:
                print(f"rows  {name:28} {len(frame):7} rows {took:6.2f}s")
                continue
            start = time.time()
            want = con.execute(verification.ORACLES[name]).df()
            sql_took = time.time() - start
            if sorted(want.columns) != sorted(frame.columns):
                raise AssertionError(f"columns {sorted(frame.columns)} != {sorted(want.columns)}")
            a, b = as_rows(frame), as_rows(want)
            if a != b:
                extra = [r for r in a if r not in set(b)][:2]
                absent = [r for r in b if r not in set(a)][:2]
                raise AssertionError(f"{len(a)} rows against {len(b)}; only Spark {extra}; only SQL {absent}")
            print(f"equal {name:28} {len(frame):7} rows {took:6.2f}s  sql {sql_took:5.2f}s", flush=True)
        except Exception as error:  # report and go on with the next query
            wrong += 1
            print(f"WRONG {name:28} {type(error).__name__}: {str(error)[:4000]}", flush=True)
    print(f"{wrong} wrong")
    return wrong


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
