from collections import Counter

from pyspark.sql import functions as F

from roadledger.model import SOURCES
from roadledger.operators.staging import (
    COPIES,
    REJECT,
    duplicate_keys,
    refuse_duplicates,
    refuse_outside,
    type_source,
)
from roadledger.sources.delimited import read_delimited, source_row_counts


def test_lines_keep_commas_in_the_last_field_and_mark_short_ones(spark, tmp_path):
    folder = str(tmp_path)
    columns = SOURCES["maintenance_records"].column_names
    with open(f"{folder}/maintenance_records.csv", "w") as f:
        f.write("a header that says something else\n")
        f.write(",".join(f"v{i}" for i in range(12)) + ", and \"more\", text\\\n")
        f.write("\n")
        f.write("M2,only\r\n")
        f.write(",".join(columns) + "\n")
    got = read_delimited(spark, folder, "maintenance_records").collect()
    assert len(got) == 3
    assert got[0]["service_description"] == 'v11, and "more", text\\'
    assert got[1]["_malformed"] and got[1]["_raw_line"] == "M2,only"
    assert got[1]["maintenance_id"] is None
    # A data line that repeats the header is data.
    assert got[2]["maintenance_id"] == "maintenance_id"
    counted = {r["file"]: r["rows"] for r in source_row_counts(spark, folder).collect()}
    assert counted == {"maintenance_records.csv": 3}


def test_type_source_refuses_without_dropping(spark):
    source = SOURCES["trucks"]
    blank = [None] * (len(source.columns) - 1)
    staged = spark.createDataFrame(
        [("T1", *blank), (" ", *blank)], source.staging_schema()
    )
    got = type_source(staged, source).collect()
    assert [r[REJECT] for r in got] == [None, "missing truck_id"]


def brute_force(rows):
    """Kept row per key and surplus contents with their number."""
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    kept, surplus = [], Counter()
    for group in by_key.values():
        best = min(group, key=lambda r: tuple((v is not None, v) for v in r))
        kept.append(best)
        surplus.update(group)
        surplus[best] -= 1
    return sorted(kept, key=repr), {r: n for r, n in surplus.items() if n}


def test_refuse_duplicates_agrees_with_brute_force(spark):
    rows = [("hot", "x", 1)] * 200 + [("hot", None, 2)] * 50 + [("hot", "y", 0)]
    rows += [(f"k{i}", "z", i) for i in range(300)] + [("k7", "z", 7), ("k8", "a", 8)]
    frame = spark.createDataFrame(rows, "k string, a string, n int").repartition(6)
    frame = frame.withColumn(REJECT, F.lit(None).cast("string"))
    repeated = duplicate_keys(frame, ["k"])
    assert {r["k"]: r["copies"] for r in repeated.collect()} == {"hot": 251, "k7": 2, "k8": 2}
    got = refuse_duplicates(frame, repeated, ["k"]).collect()
    kept, surplus = brute_force(rows)
    assert sorted([(r.k, r.a, r.n) for r in got if r[REJECT] is None], key=repr) == kept
    assert {(r.k, r.a, r.n): r[COPIES] for r in got if r[REJECT]} == surplus
    assert sum(r[COPIES] for r in got) == len(rows)


def test_refuse_duplicates_leaves_refused_rows_and_blank_keys(spark):
    frame = spark.createDataFrame(
        [("a", 1, None), ("a", 2, "missing x"), (None, 3, None), (None, 4, None)],
        f"k string, n int, {REJECT} string",
    )
    got = refuse_duplicates(frame, duplicate_keys(frame, ["k"]), ["k"]).collect()
    assert sorted((r.n, r[REJECT]) for r in got if r[REJECT]) == [(2, "missing x")]
    assert sorted(r.n for r in got if r[REJECT] is None) == [1, 3, 4]


def test_refuse_outside(spark):
    frame = spark.createDataFrame(
        [("2022-01-01", None), ("2021-12-31", None), (None, None), (None, "short line")],
        f"d string, {REJECT} string",
    ).withColumn("d", F.col("d").cast("date"))
    got = [r[REJECT] for r in refuse_outside(frame, "d", "2022-01-01", "2025-12-31").collect()]
    assert got == [None, "d outside calendar", "missing d", "short line"]
