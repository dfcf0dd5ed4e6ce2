"""Run named queries beside their SQL and compare whole results."""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)].astype(object)
    frame = frame.where(frame.notna(), None)
    rows = [tuple(str(float(v)) if isinstance(v, (int, float)) else str(v) for v in row)
            for row in frame.itertuples(index=False, name=None)]
    return sorted(rows)


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} vs {len(sql_frame)}"
    left, right = canonical(spark_frame), canonical(sql_frame)
    for a, b in zip(left, right):
        if a != b:
            return f"{a!r:.300} vs {b!r:.300}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, ".")
    import __spark_entry__ as entry_module
    from quillstream.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry_module.queries())
    spark = local_session(cores="8")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in names:
        begin = time.time()
        try:
            got = entry_module.queries()[name](spark, sf_dir).toPandas()
            sql = entry_module.oracle_sql().get(name)
            note = "rows only" if sql is None else differences(got, con.execute(sql).df()) or "equal"
            print(f"{name:24s} {len(got):8d} {time.time() - begin:7.2f}s {note}", flush=True)
        except Exception as error:  # report and go on with the next query
            print(f"{name:24s} FAILED {time.time() - begin:7.2f}s {str(error)[:600]}", flush=True)
    missing = set(entry_module.oracle_sql()) - set(entry_module.queries())
    print("oracle without query:", missing)
