"""Compare registered queries with their SQL over one sample directory.

    python -m tests.compare [directory] [name ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents"
    " embeddings pages benchmark labels conversations"
).split()


def duck(directory: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{directory}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(columns, rows):
    """Rows as sorted tuples with columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def difference(spark_frame, con, sql: str) -> str | None:
    """None when names, types and values agree, else a short account."""
    got_columns = spark_frame.columns
    got = normal(got_columns, [tuple(r) for r in spark_frame.collect()])
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want = normal(want_columns, cursor.fetchall())
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} vs {sorted(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}; {got[:2]} vs {want[:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    if wrong:
        return f"{len(wrong)} of {len(got)} rows differ, first {wrong[0]}"
    return None


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    directory = argv[0] if argv else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(directory)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                verdict = difference(queries[name](spark, directory), con, oracle[name])
            else:
                verdict = f"no SQL; {queries[name](spark, directory).count()} rows"
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        print(f"{time.time() - start:6.2f}s {name:36s} {verdict or 'ok'}", flush=True)
    print(f"{len(names)} queries, {bad} without agreement")
    missing = sorted(set(oracle) - set(queries))
    if missing:
        print("SQL without query:", missing)
    return bad


if __name__ == "__main__":
    sys.exit(min(main(sys.argv[1:]), 1))
