"""WARC archives: written as one gzip stream each, then normalised record by record.

1. ``write_streams`` turns rows into WARC records and writes each partition's records as
   one whole-file gzip stream (one member).
2. ``normalise`` inflates such a file once, in pieces, cuts it into records by their
   Content-Length, writes every record as a gzip member of its own, and writes a sidecar
   index of offsets beside it, one JSON line per record.
3. ``read_records`` follows a sidecar: it seeks to an offset, inflates one member and
   parses it.

Files are written by tasks through the file system of the shared folder's address. Every
attempt writes under a new name, and the rows of the manifest, which Spark commits, name
the files that count; a lost or repeated task leaves an unused file and no harm. Memory
is one record and one piece of a stream.

Revisits: of the records with equal payloads of at least ``LEAST_BYTES`` bytes, the one
with the smallest id carries the payload, the others name it and have no body.

Defined cases
    A null payload is empty. Payloads under the limit are always responses. Rows that share
    the smallest id and the payload are all responses. Null ids are largest. Rows are kept
    as they are, repeated ones too; an empty table gives no rows; further columns are
    ignored. Line breaks in an address are percent-encoded.
"""

from __future__ import annotations

import gzip
import io
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadledger.llm.common import sha256_hex, shared_folder, ship, stored

LEAST_BYTES = 100
PIECE = 1 << 18
#: Rows of an archive; partitions of more rows write several.
RECORDS = 2000
LEVEL = 1
END = b"\r\n\r\n"
MANIFEST = "path string, records bigint, bytes bigint"


def open_folder(uri: str):
    """(file system, path) of an address like file:///shared or hdfs://host/shared."""
    return pyarrow.fs.FileSystem.from_uri(uri)


def header_block(fields: dict[str, str]) -> bytes:
    lines = ["WARC/1.1", *[f"{k}: {v}" for k, v in fields.items()]]
    return "\r\n".join(lines).encode() + END


def parse_header(block: bytes) -> dict[str, str]:
    lines = block.decode().split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:])


def record_bytes(row: dict, payload: bytes) -> bytes:
    """One record: header, body, end. A revisit has no body."""
    revisit = row["record_type"] == "revisit"
    fields = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:row:{'' if row['id'] is None else row['id']}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": row["uri"],
        "WARC-Payload-Digest": f"sha256:{row['digest']}",
        "X-Payload-Length": str(row["payload_bytes"]),
        "Content-Type": "text/html; charset=utf-8",
        "Content-Length": "0" if revisit else str(len(payload)),
    }
    if revisit:
        fields["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        fields["WARC-Refers-To"] = f"<urn:row:{row['refers_to']}>"
    return header_block(fields) + (b"" if revisit else payload) + END


def described(pages: DataFrame) -> DataFrame:
    """id, uri, payload, digest, payload_bytes, record_type, refers_to."""
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("id"),
        F.replace(
            F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")),
            F.lit("\n"),
            F.lit("%0A"),
        ).alias("uri"),
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumns(
        {
            "digest": sha256_hex(F.col("payload")),
            "payload_bytes": F.length("payload").cast("bigint"),
        }
    )
    several = stored(
        rows.where(F.col("payload_bytes") >= LEAST_BYTES)
        .groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n"),
        "payloads",
    )
    revisit = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    return rows.join(several, "digest", "left").select(
        "id",
        "uri",
        "payload",
        "digest",
        "payload_bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_streams(rows: DataFrame, folder: str, records: int = RECORDS) -> DataFrame:
    """Manifest of the monolithic archives written to ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        name, sink, stream, count = "", None, None, 0
        done = []
        for batch in batches:
            columns = [c for c in batch.schema.names if c != "payload"]
            payloads = batch.column(batch.schema.get_field_index("payload"))
            for i, row in enumerate(batch.select(columns).to_pylist()):
                if sink is None:
                    name = f"{base}/{uuid.uuid4().hex}.warc.gz"
                    sink = files.open_output_stream(name, compression=None)
                    stream, count = zlib.compressobj(LEVEL, zlib.DEFLATED, 31), 0
                sink.write(stream.compress(record_bytes(row, payloads[i].as_py())))
                count += 1
                if count == records:
                    done.append(_closed(name, sink, stream, count))
                    sink = None
        if sink is not None:
            done.append(_closed(name, sink, stream, count))
        yield _manifest(done)

    ship(rows.sparkSession)
    return stored(rows.mapInArrow(run, MANIFEST), "streams")


def _closed(name: str, sink, stream, count: int) -> tuple[str, int, int]:
    sink.write(stream.flush())
    size = sink.tell()
    sink.close()
    return name, count, size


def _manifest(done: list[tuple[str, int, int]]) -> pa.RecordBatch:
    columns = zip(*done) if done else ((), (), ())
    kinds = (pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), k) for c, k in zip(columns, kinds)],
        names=["path", "records", "bytes"],
    )


def inflated_records(source) -> Iterator[tuple[bytes, bytes]]:
    """(header, body) of each record of a gzip stream, read once and in pieces."""
    inflate, held = zlib.decompressobj(31), bytearray()

    def more() -> bool:
        nonlocal inflate
        piece = inflate.unused_data
        if inflate.eof:  # a file may also hold several members
            inflate = zlib.decompressobj(31)
        piece = piece or source.read(PIECE)
        if not piece:
            return False
        held.extend(inflate.decompress(piece))
        return True

    while True:
        at = held.find(END)
        while at < 0:
            if not more():
                if held:
                    raise ValueError("a record header is cut off")
                return
            at = held.find(END)
        header = bytes(held[:at])
        size = int(parse_header(header)["Content-Length"])
        whole = at + len(END) + size + len(END)
        while len(held) < whole:
            if not more():
                raise ValueError("a record body is cut off")
        yield header, bytes(held[at + len(END) : whole - len(END)])
        del held[:whole]


def _one_each(manifest: DataFrame) -> DataFrame:
    """Paths of a manifest, an archive to a task; a few short rows would share one."""
    ship(manifest.sparkSession)
    return manifest.select("path").repartition(max(manifest.count(), 1))


def normalise(manifest: DataFrame, folder: str) -> DataFrame:
    """Manifest of archives with a member per record, each with a sidecar index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = open_folder(folder)
        files.create_dir(base, recursive=True)
        done = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                name = f"{base}/{uuid.uuid4().hex}.warc.gz"
                offset, count = 0, 0
                with (
                    files.open_input_stream(path, compression=None) as source,
                    files.open_output_stream(name, compression=None) as sink,
                    files.open_output_stream(f"{name}.idx", compression=None) as index,
                ):
                    for header, body in inflated_records(source):
                        member = gzip.compress(header + END + body + END, LEVEL, mtime=0)
                        sink.write(member)
                        entry = {
                            "id": parse_header(header)["WARC-Record-ID"],
                            "offset": offset,
                            "length": len(member),
                        }
                        index.write(json.dumps(entry).encode() + b"\n")
                        offset += len(member)
                        count += 1
                done.append((name, count, offset))
        yield _manifest(done)

    return stored(_one_each(manifest).mapInArrow(run, MANIFEST), "archives")


RECORD = (
    "page_id bigint, uri string, record_type string, refers_to bigint,"
    " declared_digest string, declared_bytes bigint, payload binary"
)


def _row_number(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:row:").removesuffix(">")
    return int(number) if number else None


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """Rows of ``RECORD`` read back by the sidecar offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, _ = open_folder(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{path}.idx", compression=None) as index:
                    lines = io.BufferedReader(index)
                    with files.open_input_file(path) as archive:
                        for line in lines:
                            entry = json.loads(line)
                            archive.seek(entry["offset"])
                            member = gzip.decompress(archive.read(entry["length"]))
                            head, _, body = member.partition(END)
                            field = parse_header(head)
                            body = body[: len(body) - len(END)]
                            rows.append(
                                {
                                    "page_id": _row_number(field["WARC-Record-ID"]),
                                    "uri": field["WARC-Target-URI"],
                                    "record_type": field["WARC-Type"],
                                    "refers_to": _row_number(field.get("WARC-Refers-To")),
                                    "declared_digest": field[
                                        "WARC-Payload-Digest"
                                    ].removeprefix("sha256:"),
                                    "declared_bytes": int(field["X-Payload-Length"]),
                                    "payload": body,
                                }
                            )
                            size += len(body)
                            if size > 4_000_000:
                                yield _records(rows)
                                rows, size = [], 0
                if rows:
                    yield _records(rows)

    return _one_each(manifest).mapInArrow(run, RECORD)


def _records(rows: list[dict]) -> pa.RecordBatch:
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("uri", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("declared_digest", pa.string()),
            ("declared_bytes", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    return pa.RecordBatch.from_pylist(rows, schema)


def archived(pages: DataFrame) -> DataFrame:
    """The records of ``pages`` after writing, normalising and reading back."""
    folder = shared_folder(pages.sparkSession)
    streams = write_streams(described(pages), f"{folder}/streams")
    return read_records(normalise(streams, f"{folder}/archives"), folder)
