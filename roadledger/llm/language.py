"""Language identification by fusing evidence about a document.

For each language of a closed list, the log posterior is the sum of

* the text: naive Bayes over hashed byte trigrams around letters, tempered because
  neighbouring trigrams overlap;
* the declared language (markup or metadata), right with probability ``trust``;
* the suffix of the address, where it stands for a language;
* a prior for the host, from the text decisions of all rows of that host, smoothed towards
  its domain, this towards its suffix, and this towards all rows. The counts come from
  grouped aggregation; one row per host joins back, and a host with a third of all rows
  joins as a skewed key that adaptive execution splits.

The text model is trained on at most about ``SAMPLE`` labelled rows per language, drawn
by hash; its tables hold ``GRAMS`` counts per language. Everything else covers all rows.

Defined cases
    A null text is empty. Rows without a letter have no text evidence; they are decided by
    declaration, address and host alone. Ties go to the first language of the list. A
    declared language is compared by its first part, lower case ('EN-us' is 'en'); null or
    unknown ones give no evidence. A null or blank host is a host of its own. A row is
    rejected if the best posterior is under ``least``; with no labelled row at all the text
    gives no evidence. Repeated rows are decided alike; an empty table gives no rows;
    further columns are ignored by ``identify`` and pass through ``accepted``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, StructType

from roadledger.llm.bayes_join import text_key
from roadledger.llm.common import parted, ship, stored
from roadledger.llm.shingles import text_slabs

LANGUAGES = ("en", "fr", "de", "es")
#: Address suffixes that stand for one of the languages.
SUFFIXES = {
    "uk": "en",
    "us": "en",
    "ie": "en",
    "fr": "fr",
    "de": "de",
    "at": "de",
    "es": "es",
    "mx": "es",
    "ar": "es",
}
SAMPLE = 400
GRAMS = 2**15
TEMPER = 0.3
TRUST = 0.95
SUFFIX_TRUST = 0.8
SMOOTHING = 20.0
LEAST = 0.6

_FOLD = np.full(256, 32, dtype=np.uint32)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def gram_ids(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams around letters, and where those of each text begin."""
    folded = _FOLD[data]
    if len(folded) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(len(bounds), dtype=np.int64)
    inside = np.ones(len(folded) - 2, dtype=bool)
    for cut in (1, 2):  # no trigram lies over the edge of two texts
        at = bounds[1:-1] - cut
        inside[at[(at >= 0) & (at < len(inside))]] = False
    at = np.flatnonzero(inside & (folded[1:-1] != 32))
    code = folded[at] << np.uint32(16) | folded[at + 1] << np.uint32(8) | folded[at + 2]
    grams = (code * np.uint32(2654435761)) >> np.uint32(17)
    return grams.astype(np.int64) % GRAMS, np.searchsorted(at, bounds)


def evidence_rows(
    rows: DataFrame, text: Column, declared: Column, host: Column, keep: list[str]
) -> DataFrame:
    """The columns ``keep`` with _text, _declared and _host."""
    part = F.lower(F.trim(F.split(declared, "[-_]")[0]))
    return rows.select(
        *keep,
        F.coalesce(text, F.lit("")).alias("_text"),
        F.when(part.isin(*LANGUAGES), part).alias("_declared"),
        F.coalesce(F.lower(F.trim(host)), F.lit("")).alias("_host"),
    )


def train(labelled: DataFrame, sample: int = SAMPLE) -> np.ndarray | None:
    """(languages, GRAMS) log probabilities; ``labelled`` has _text and _declared.

    The sampled share of a language is ``sample`` rows on average.
    """
    known = labelled.where(
        F.col("_declared").isNotNull() & F.col("_text").rlike(r"\p{L}")
    )
    counts = {r[0]: r[1] for r in known.groupBy("_declared").count().collect()}
    if not counts:
        return None
    share = F.create_map(
        *[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample / n))]
    )
    draw = F.pmod(F.xxhash64("_text", F.lit(3)), F.lit(1_000_000)) / 1_000_000
    drawn = known.where(draw < share[F.col("_declared")])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(LANGUAGES), GRAMS), dtype=np.int64)
        for batch in batches:
            label = np.array(
                [LANGUAGES.index(x) for x in batch.column(0).to_pylist()], dtype=int
            )
            for begin, end, data, bounds in text_slabs(batch.column(1)):
                grams, starts = gram_ids(data, bounds)
                own = np.repeat(label[begin:end], np.diff(starts))
                np.add.at(total, (own, grams), 1)
        row, gram = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(gram), pa.array(total[row, gram])],
            names=["row", "gram", "n"],
        )

    ship(labelled.sparkSession)
    # At most GRAMS rows per language reach the driver, however large the sample is.
    found = (
        drawn.select("_declared", "_text")
        .mapInArrow(count, "row bigint, gram bigint, n bigint")
        .groupBy("row", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    total = np.full((len(LANGUAGES), GRAMS), 0.5)
    row, gram, n = (found.column(i).to_numpy() for i in range(3))
    total[row, gram] += n
    return np.log(total / total.sum(axis=1, keepdims=True))


def text_scores(rows: DataFrame, model: np.ndarray | None, keep: list[str]) -> DataFrame:
    """``keep``, _declared, _host, and _scores: tempered log likelihood per language."""
    names = [*keep, "_declared", "_host"]
    table = None if model is None else np.ascontiguousarray(model, dtype=np.float64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, data, bounds in text_slabs(batch.column(len(names))):
                grams, starts = gram_ids(data, bounds)
                out = np.zeros((end - begin, len(LANGUAGES)))
                some = np.flatnonzero(np.diff(starts))
                if table is not None and len(some):
                    for k in range(len(LANGUAGES)):
                        out[some, k] = np.add.reduceat(table[k][grams], starts[some])
                offsets = np.arange(end - begin + 1, dtype=np.int32) * len(LANGUAGES)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[
                            batch.column(i).slice(begin, end - begin)
                            for i in range(len(names))
                        ],
                        pa.array((np.diff(starts) > 0)),
                        pa.ListArray.from_arrays(offsets, TEMPER * out.reshape(-1)),
                    ],
                    names=[*names, "_lettered", "_scores"],
                )

    ship(rows.sparkSession)
    given = rows.select(*names, "_text")
    schema = StructType(list(given.drop("_text").schema.fields))
    schema = schema.add("_lettered", BooleanType()).add("_scores", ArrayType(DoubleType()))
    return given.mapInArrow(score, schema)


def _best(scores: Column) -> Column:
    return F.array_position(scores, F.array_max(scores)).cast("int") - 1


def host_priors(scored: DataFrame) -> DataFrame:
    """_host, _prior: smoothed shares of the languages on every host."""
    one = [
        F.count_if(F.col("_lettered") & (_best(F.col("_scores")) == k)).alias(f"n{k}")
        for k in range(len(LANGUAGES))
    ]
    hosts = scored.groupBy("_host").agg(*one)
    labels = F.split("_host", r"\.")
    hosts = stored(
        hosts.withColumn("_suffix", F.element_at(labels, -1)).withColumn(
            "_domain", F.array_join(F.slice(F.concat(F.array(F.lit("")), labels), -2, 2), ".")
        ),
        "hosts",
    )
    sums = [F.sum(f"n{k}").alias(f"n{k}") for k in range(len(LANGUAGES))]
    total = hosts.agg(*sums).first()
    every = sum(x or 0 for x in total)
    base = F.array(*[F.lit(((x or 0) + 1.0) / (every + len(LANGUAGES))) for x in total])

    def smoothed(frame: DataFrame, above: Column, name: str) -> DataFrame:
        n = sum(F.col(f"n{k}") for k in range(len(LANGUAGES)))
        return frame.withColumn(
            name,
            F.array(
                *[
                    (F.col(f"n{k}") + SMOOTHING * above[k]) / (n + SMOOTHING)
                    for k in range(len(LANGUAGES))
                ]
            ),
        )

    suffixes = smoothed(hosts.groupBy("_suffix").agg(*sums), base, "_p1").select(
        "_suffix", "_p1"
    )
    domains = hosts.groupBy("_suffix", "_domain").agg(*sums).join(suffixes, "_suffix")
    domains = smoothed(domains, F.col("_p1"), "_p2").select("_domain", "_p2")
    return smoothed(hosts.join(domains, "_domain"), F.col("_p2"), "_prior").select(
        "_host", "_suffix", "_prior"
    )


def identify(
    rows: DataFrame, keep: list[str], trained_on: DataFrame | None = None
) -> DataFrame:
    """``keep``, declared, language, posterior, text_language of ``evidence_rows``."""
    model = train(rows if trained_on is None else trained_on)
    scored = stored(text_scores(rows, model, keep), "scores")
    priors = stored(host_priors(scored), "priors")
    joined = scored.join(priors, "_host")
    wrong = len(LANGUAGES) - 1
    suffix_language = F.coalesce(
        F.try_element_at(
            F.create_map(*[F.lit(x) for pair in SUFFIXES.items() for x in pair]),
            F.col("_suffix"),
        ),
        F.lit(""),
    )

    def claim(said: Column, trust: float, language: str) -> Column:
        share = F.when(said == language, trust).otherwise((1 - trust) / wrong)
        return F.when(said.isin(*LANGUAGES), F.log(share)).otherwise(0.0)

    fused = F.array(
        *[
            F.col("_scores")[k]
            + F.log(F.col("_prior")[k])
            + claim(F.coalesce("_declared", F.lit("")), TRUST, language)
            + claim(suffix_language, SUFFIX_TRUST, language)
            for k, language in enumerate(LANGUAGES)
        ]
    )
    names = F.array(*[F.lit(x) for x in LANGUAGES])
    top = F.array_max("_fused")
    mass = sum(F.exp(F.col("_fused")[k] - top) for k in range(len(LANGUAGES)))
    return joined.withColumn("_fused", fused).select(
        *keep,
        F.col("_declared").alias("declared"),
        F.element_at(names, _best(F.col("_fused")) + 1).alias("language"),
        F.round(1 / mass, 6).alias("posterior"),
        F.when(
            F.col("_lettered"), F.element_at(names, _best(F.col("_scores")) + 1)
        ).alias("text_language"),
    )


def identify_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, lang, source and the decision on each of ``documents``."""
    keyed = docs.select("doc_id", "text", "lang", "source", text_key().alias("text_key"))
    keep = ["doc_id", "text_key", "lang", "source"]
    rows = evidence_rows(keyed, F.col("text"), F.col("lang"), F.col("source"), keep)
    return identify(rows, keep)


def page_evidence(pages: DataFrame) -> DataFrame:
    """Evidence rows of web pages: text and lang of the markup, host of the address."""
    markup = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(
        markup, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " "
    )
    said = F.regexp_extract(markup, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z-]+)", 1)
    host = F.regexp_extract(F.col("url"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)
    return evidence_rows(pages, text, said, host, ["page_id"])


def accepted(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents whose language is certain enough, ``lang`` set to it."""
    judged = identify_documents(docs)
    # Only rows that change or go need a join; most texts never meet a shuffle.
    other = stored(
        judged.where(
            (F.col("posterior") < least) | ~F.col("language").eqNullSafe(F.col("lang"))
        )
        .select(
            F.col("doc_id").alias("_llm_id"),
            F.col("text_key").alias("_llm_key"),
            F.col("lang").alias("_llm_lang"),
            F.col("source").alias("_llm_source"),
            F.col("language").alias("_llm_language"),
            (F.col("posterior") >= least).alias("_llm_good"),
        )
        .distinct(),
        "changes",
    )
    keyed = docs.withColumn("_llm_own", text_key())
    some, rest = parted(keyed, F.col("_llm_own"), other, F.col("_llm_key"))
    match = F.col("_llm_own") == F.col("_llm_key")
    for name in ("id", "lang", "source"):
        own = "doc_id" if name == "id" else name
        match &= F.col(own).eqNullSafe(F.col(f"_llm_{name}"))
    joined = some.join(other, match, "left")
    joined = joined.where(F.coalesce("_llm_good", F.lit(True))).select(
        *[
            F.coalesce("_llm_language", "lang").alias("lang") if c == "lang" else c
            for c in docs.columns
        ]
    )
    return joined.unionByName(rest.select(*docs.columns))
