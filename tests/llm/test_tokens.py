import base64

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from roadledger.llm import bpe, token_counts
from roadledger.llm.queries import PATTERN, QUERIES, RANKS
from tests.llm.helpers import LONG, docs

SF = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "a", "a" * 1000, "ab" * 500 + "  \n\n x", "\x00\x1c\x1f\x85 x y\t\tz",
    "é" * 300, "日本語テキスト" * 50, " " * 500, "'s't're'VE I'll don't", "퟿😀" * 40,
    "\x0b\x0c a", "x  y\n\n\nz", "1234567 ١٢٣ ²½", "_" * 700, "$$$&&&%%% (555)", LONG,
]


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def test_ids_are_those_of_the_library_and_decode(spark, encoding):
    frame = docs(spark, ODD).withColumns({"ids": F.lit("mine"), "decoded": F.lit(1)})
    got = {r.doc_id: r for r in bpe.encode_and_decode(frame, RANKS, PATTERN).collect()}
    for i, text in enumerate(ODD):
        assert list(got[i].ids) == encoding.encode_ordinary(text or ""), repr(text)[:40]
        assert bytes(got[i].decoded) == (text or "").encode()
    again = bpe.decode(bpe.encode(frame, RANKS, PATTERN), RANKS, PATTERN).collect()
    assert {r.doc_id: bytes(r.decoded) for r in again} == {
        i: bytes(r.decoded) for i, r in got.items()
    }


def test_query_against_the_library(spark, encoding):
    import hashlib

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op4_byte_bpe"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = encoding.encode_ordinary(texts[r.doc_id])
        joined = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        raw = hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), joined, raw)


def test_heap_follows_the_same_rule(encoding):
    codec = bpe.Codec(RANKS, PATTERN)
    rng = np.random.default_rng(5)
    letters = list("abcdethinsrouéß")
    for _ in range(200):
        piece = "".join(rng.choice(letters, rng.integers(2, 260)))
        want = encoding._core_bpe.encode_single_piece(piece.encode())
        if piece.encode() not in codec.ranks:
            assert list(codec.by_heap(piece.encode())) == want


def test_repeats_empty_table_and_bad_ids(spark):
    frame = docs(spark, ["same text"])
    twice = bpe.encode(frame.union(frame), RANKS, PATTERN).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    assert bpe.encode(frame.limit(0), RANKS, PATTERN).count() == 0
    none = spark.sql("SELECT 1L AS doc_id, CAST(NULL AS array<int>) AS ids")
    assert bytes(bpe.decode(none, RANKS, PATTERN).first().decoded) == b""
    wrong = spark.sql("SELECT 1L AS doc_id, array(99999999) AS ids")
    with pytest.raises(Exception, match="outside the vocabulary"):
        bpe.decode(wrong, RANKS, PATTERN).collect()


def spans_by_hand(text, encoding):
    """Character spans of the tokens from their bytes, one by one."""
    at, spans = 0, []
    raw = text.encode()
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        spans.append((owner[at], owner[at + size - 1] + 1))
        at += size
    assert at == len(raw)
    return spans


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_share_out_all_tokens(spark, encoding, rule):
    texts = [t for t in ODD if t is not LONG]
    rows = token_counts.count_tokens(docs(spark, texts), RANKS, PATTERN, rule).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for i, text in enumerate(texts):
        text = text or ""
        own = sorted(by_doc[i], key=lambda r: r.section)
        assert own[0].start == 0 and own[-1].end == len(text)
        spans = spans_by_hand(text, encoding)
        assert sum(r.n_tokens for r in own) == len(spans) == own[0].doc_tokens
        for r in own:
            key = {
                "start": lambda s, e: r.start <= s < r.end,
                "end": lambda s, e: r.start <= e - 1 < r.end,
                "midpoint": lambda s, e: 2 * r.start < s + e <= 2 * r.end,
            }[rule]
            assert r.n_tokens == sum(key(*s) for s in spans)
            touching = [s for s in spans if s[0] < r.end and s[1] > r.start]
            inside = [s for s in touching if s[0] >= r.start and s[1] <= r.end]
            assert r.n_crossing == len(touching) - len(inside)


def test_given_sections_overlaps_nulls_and_extras(spark):
    frame = spark.sql(
        """SELECT 1L AS doc_id, 'hello world again' AS text, 5 AS section,
           array(named_struct('start', 0, 'end', 5), named_struct('start', 0, 'end', 99),
                 named_struct('start', NULL, 'end', 3), NULL,
                 named_struct('start', 4, 'end', 4)) AS parts
           UNION ALL SELECT 2L, NULL, 5, NULL"""
    )
    got = token_counts.count_tokens(frame, RANKS, PATTERN, sections="parts").collect()
    assert [(r.doc_id, r.section, r.n_tokens) for r in sorted(got, key=lambda r: r.section)] == [
        (1, 0, 1), (1, 1, 3), (1, 4, 0)
    ]
    assert token_counts.count_tokens(frame.limit(0), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(frame, RANKS, PATTERN, rule="other")


def test_query_covers_every_document(spark, encoding):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op2_token_counts"](spark, SF).groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n"), F.count("*").alias("lines")
    )
    for r in got.collect():
        text = texts.pop(r.doc_id)
        assert r.n == len(encoding.encode_ordinary(text))
        assert r.lines == len(text.removesuffix("\n").split("\n"))
    assert not texts


LONG_TEXT = """
import resource, sys
import numpy as np
import pyarrow as pa
from roadledger.llm import bpe
from roadledger.llm.queries import PATTERN, RANKS
size = int(sys.argv[1])
rng = np.random.default_rng(1)
letters = np.array(list("etaoinshrdlu"))
words = ["".join(rng.choice(letters, n)) for n in rng.integers(2, 9, 20_000)]
words += ["ß" * 300, "日本", "\\n", "12"]
text = " ".join(words[i] for i in rng.integers(0, len(words), size // 6))
text += "x" * (size - len(text))
codec = bpe.codec(RANKS, PATTERN)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([text, "short"])], ["doc_id", "text"])
rows = list(bpe.decode_batches(bpe.encode_batches([batch], RANKS, PATTERN), RANKS, PATTERN))
assert [bytes(x.as_py()) for r in rows for x in r.column(2)] == [text.encode(), b"short"]
print(len(text), resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
"""


@pytest.mark.parametrize("millions", [10, 50])
def test_very_long_texts_come_back_in_bounded_memory(millions):
    import subprocess
    import sys

    size = millions * 1_000_000
    done = subprocess.run(
        [sys.executable, "-c", LONG_TEXT, str(size)], capture_output=True, text=True, check=True
    )
    length, kilobytes = map(int, done.stdout.split())
    # The batch, ids and bytes of the text itself, beside bounded tables.
    assert length >= size and kilobytes * 1000 < 400e6 + 12 * size
