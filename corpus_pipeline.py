"""From raw documents to token ids: five stages over the operators in roadledger.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``documents``. ``run`` stores each result in the shared folder and rereads
it, so that a lost executor costs tasks of one stage and nothing is computed twice.

1. ``language`` drops documents whose language stays uncertain and sets ``lang``.
2. ``near_duplicates`` keeps the first document of every group of near copies.
3. ``paragraphs`` cuts repeated long paragraphs; ``n_chars`` follows the text.
4. ``mix`` leaves out or repeats documents until the sources have their target words.
5. ``tokens`` encodes every text and decodes it again.

Null values, empty texts, ties, repeated rows, empty tables and further columns have the
results that the operators state; further columns pass through stages 1 to 4.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadledger.llm import bayes_join, bpe, language, mixing, paragraph_dedup
from roadledger.llm.common import stored, table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.accepted(docs)


def keep_one_of_near_copies(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    return bayes_join.one_of_each(docs)


def cut_repeated_paragraphs(
    spark: SparkSession, docs: DataFrame, sf_dir: str
) -> DataFrame:
    out = paragraph_dedup.cleaned(docs)
    changed = F.size("removed") > 0
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn(
            "n_chars", F.when(changed, length).otherwise(F.col("n_chars"))
        )
    return out.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.repeated(mixing.mixed(docs), docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_and_decode(
        docs,
        RANKS,
        public_tokenizers.PATTERN,
        ("n_tokens", "ids", "ids_sha256", "decoded_sha256"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_near_copies),
    ("paragraphs", cut_repeated_paragraphs),
    ("mix", mix_sources),
    ("tokens", encode_texts),
]

#: SQL expresses neither the trained model, nor the pruning, nor BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
