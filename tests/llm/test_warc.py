import gzip
import io
import json
import zlib

import pytest
from pyspark.sql import functions as F

from roadledger.llm import warc
from roadledger.llm.common import shared_folder
from roadledger.llm.oracle import ORACLE
from roadledger.llm.queries import QUERIES
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
COLUMNS = "page_id bigint, url string, html string"


def test_query_matches_sql(spark):
    name = "op8_warc_normalise"
    assert difference(QUERIES[name](spark, SF), duck(SF), ORACLE[name]) is None


def test_files_are_one_stream_then_members_with_offsets(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").repartition(3)
    folder = shared_folder(spark)
    streams = warc.write_streams(warc.described(pages), f"{folder}/streams", records=9)
    rows = streams.collect()
    assert sum(r.records for r in rows) == 50 and max(r.records for r in rows) <= 9
    for r in rows:
        stream = zlib.decompressobj(31)
        with open(r.path, "rb") as f:
            raw = f.read()
        text = stream.decompress(raw)
        assert stream.eof and not stream.unused_data and len(raw) == r.bytes
        assert text.count(b"WARC/1.1\r\n") == r.records
    done = warc.normalise(streams, f"{folder}/archives").collect()
    assert sum(r.records for r in done) == 50 and len(done) == len(rows)
    for r in done:
        with open(r.path, "rb") as f, open(f"{r.path}.idx", "rb") as g:
            raw, index = f.read(), [json.loads(x) for x in g]
        end = 0
        for e in index:
            assert e["offset"] == end
            end += e["length"]
            member = zlib.decompressobj(31)
            record = member.decompress(raw[e["offset"] : end])
            assert member.eof and not member.unused_data
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
        assert end == len(raw) == r.bytes and len(index) == r.records


def test_payloads_nulls_ties_repeats_and_odd_addresses(spark):
    big = "x" * 100
    rows = [
        (5, "http://a", big), (3, "http://b\r\nWARC-Type: forged", big), (9, None, big),
        (1, "u", None), (2, "u", ""), (4, "u", "x" * 99), (6, "u", "x" * 99),
        (7, "u", "é" * 50), (8, "u", "é" * 50), (None, "u", big), (3, "again", big),
        (10, "u", "a\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 9), (11, "u", "z" * 900_000),
    ]
    pages = spark.createDataFrame(rows, COLUMNS).withColumns(
        {n: F.lit("mine") for n in ("digest", "id", "payload", "first_id", "path")}
    )
    got = warc.archived(pages).collect()
    assert len(got) == len(rows)
    want = {
        5: ("revisit", 3), 3: ("response", None), 9: ("revisit", 3), None: ("revisit", 3),
        7: ("response", None), 8: ("revisit", 7),
    }
    for r in got:
        html = next(h for p, _, h in rows if p == r.page_id) or ""
        assert (r.record_type, r.refers_to) == want.get(r.page_id, ("response", None))
        assert r.declared_bytes == len(html.encode())
        assert bytes(r.payload) == (b"" if r.record_type == "revisit" else html.encode())
    forged = {r.uri for r in got if r.page_id == 3}
    assert forged == {"http://b%0D%0AWARC-Type: forged", "again"}
    assert warc.archived(pages.limit(0)).count() == 0


def test_reader_of_streams_takes_members_and_refuses_cuts():
    rows = [
        {"id": i, "uri": "u", "digest": "d", "payload_bytes": 3, "record_type": "response",
         "refers_to": None}
        for i in range(5)
    ]
    records = [warc.record_bytes(r, b"abc") for r in rows]
    mixed = gzip.compress(b"".join(records[:2])) + gzip.compress(b"".join(records[2:]))
    assert [b for _, b in warc.inflated_records(io.BytesIO(mixed))] == [b"abc"] * 5
    whole = b"".join(records)
    for cut in (len(whole) - 2, len(records[0]) + 10):
        with pytest.raises(ValueError, match="cut off"):
            list(warc.inflated_records(io.BytesIO(gzip.compress(whole[:cut]))))
