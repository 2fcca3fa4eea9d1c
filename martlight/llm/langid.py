"""Language of web pages from text, markup, address and host, fused by Bayes' rule."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlight.llm.columns import ascii_lower
from martlight.llm.urlfilter import host_of, path_of
from martlight.session import materialize

# Character trigrams are told apart by this many hash values; bounds the model's size.
BUCKETS = 1 << 14
MAX_LANGUAGES = 200
# Neighbouring trigrams overlap, so each counts as a third of an independent one.
TEMPERATURE = 3.0
# Pages' worth of belief that a domain, and a host, take over from the level above.
PRIOR_PAGES = 10
# Soft counts are whole millionths, so sums don't depend on their order.
_UNIT = 1_000_000
_SMOOTHING = 0.5


def trigrams(text: str | None) -> np.ndarray:
    """Hash values of the byte trigrams of a text, lower-cased and single-spaced."""
    raw = np.frombuffer(f" {' '.join((text or '').lower().split())} ".encode(), dtype=np.uint8).astype(np.uint32)
    joined = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (joined * np.uint32(2654435761)) >> np.uint32(32 - BUCKETS.bit_length() + 1)


def trigram_counts(docs: DataFrame, text: str = "text", language: str = "lang") -> DataFrame:
    """(language, bucket, n) over all labelled rows; each task adds up its own first."""
    rows = docs.where(F.col(language).isNotNull()).select(
        F.col(text).alias("text"), F.col(language).cast("string").alias("language")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, language in zip(batch.column("text"), batch.column("language").to_pylist()):
                own = sums.setdefault(language, np.zeros(BUCKETS, dtype=np.int64))
                own += np.bincount(trigrams(text.as_py()), minlength=BUCKETS)
        for language, own in sums.items():
            seen = np.flatnonzero(own)
            columns = [pa.array([language] * len(seen), pa.string()), pa.array(seen), pa.array(own[seen])]
            yield pa.RecordBatch.from_arrays(columns, names=["language", "bucket", "n"])

    found = rows.mapInArrow(count, "language string, bucket long, n long")
    return found.groupBy("language", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log likelihoods of trigrams by language."""

    def __init__(self, counts: list[tuple[str, int, int]]):
        self.languages = sorted({language for language, _, _ in counts})
        if len(self.languages) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages")
        table = np.full((BUCKETS, len(self.languages)), _SMOOTHING)
        for language, bucket, n in counts:
            table[bucket, self.languages.index(language)] += n
        self.weights = np.log(table / table.sum(axis=0))

    def scores(self, text: str | None) -> np.ndarray:
        return self.weights[trigrams(text)].sum(axis=0) / TEMPERATURE


def train(docs: DataFrame, text: str = "text", language: str = "lang") -> Model:
    """Fit on all labelled documents; the driver gets at most MAX_LANGUAGES * BUCKETS counts.

    Languages beyond MAX_LANGUAGES are an error, found before anything else is fetched. Texts are read
    once; repeated rows count again.
    """
    counts = materialize(trigram_counts(docs, text, language), "trigrams")
    names = counts.select("language").distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return Model([tuple(r) for r in counts.collect()])


def visible_text(html: Column) -> Column:
    """Text between tags, without scripts and styles."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ")
    return F.regexp_replace(bare, r"(?s)<[^>]*>|&[a-zA-Z#0-9]{1,8};", " ")


def _normalised(scores: list[Column]) -> list[Column]:
    """Posteriors of log scores."""
    best = F.greatest(*scores) if len(scores) > 1 else scores[0]
    powers = [F.exp(s - best) for s in scores]
    total = reduce(lambda a, b: a + b, powers)
    return [p / total for p in powers]


def _soft_counts(rows: DataFrame, by: list[str], count: int, prefix: str) -> DataFrame:
    """Sum of the posteriors p0, p1, ... of each group, in pages."""
    sums = [(F.sum(F.round(F.col(f"p{i}") * _UNIT).cast("long")) / _UNIT).alias(f"{prefix}{i}") for i in range(count)]
    return rows.groupBy(*by).agg(*sums)


def _with_posteriors(rows: DataFrame, scores: list[Column]) -> DataFrame:
    rows = rows.withColumns({f"s{i}": s for i, s in enumerate(scores)})
    return rows.withColumns({f"p{i}": p for i, p in enumerate(_normalised([F.col(f"s{i}") for i in range(len(scores))]))})


def identify(
    pages: DataFrame,
    model: Model,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """(key, host, declared, suffix, folder, text_language, language, probability) of every page.

    The text gives likelihoods. What the markup declares, the host's last label and a first path
    part of two letters count by how often pages of each language, as told by their text, carry them. A host's prior is the share of languages among its
    other pages, smoothed by its domain's, which is smoothed by that of all pages. Ties go to
    the first language by name. A null url or html gives no evidence; without any evidence at all the
    prior of all pages decides. No trained language, or no page: languages are null, no rows.
    """
    k = len(model.languages)
    content = F.coalesce(F.col(html), F.lit(""))
    path_part = F.regexp_extract(path_of(F.col(url)), r"^/([A-Za-z]{2})(?:/|$)", 1)
    host = host_of(F.col(url))
    rows = pages.select(
        F.col(key).alias("key"),
        host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        ascii_lower(F.regexp_extract(content, r"""(?i)<html\b[^>]*?\slang\s*=\s*["']?([a-z]{2})""", 1)).alias("declared"),
        F.regexp_extract(host, r"([^.]*)$", 1).alias("suffix"),
        ascii_lower(path_part).alias("folder"),
        visible_text(content).alias("text"),
    )
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<double>")
    def likelihoods(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([shared.value.scores(t) for t in texts])

    if not k:
        none = F.lit(None).cast("string")
        return rows.select(
            F.col("key").alias(key), "host", "declared", "suffix", "folder",
            none.alias("text_language"), none.alias("language"), F.lit(None).cast("double").alias("probability"),
        )
    rows = materialize(rows.withColumn("t", likelihoods("text")).drop("text"), "page-languages")
    text_scores = [F.get("t", i) for i in range(k)]
    by_text = _with_posteriors(rows, text_scores)
    # A number for each language.
    everywhere = [n or 0.0 for n in _soft_counts(by_text, [], k, "a").first()]
    scores = text_scores
    fused = rows
    for evidence, prefix in (("declared", "d"), ("suffix", "x"), ("folder", "y")):
        # How likely a language's pages are to carry the value; languages share the smoothing.
        counts = _soft_counts(by_text, [evidence], k, prefix)
        fused = fused.join(counts, evidence, "left")
        scores = [
            s + F.log((F.col(f"{prefix}{i}") + _SMOOTHING) / (everywhere[i] + 1)) for i, s in enumerate(scores)
        ]
    fused = _with_posteriors(fused, scores)
    fused = materialize(
        fused.select("key", "host", "domain", "declared", "suffix", "folder", "t", *[f"{c}{i}" for c in "sp" for i in range(k)]),
        "page-evidence",
    )
    hosts = _soft_counts(fused, ["host"], k, "h")
    domains = _soft_counts(fused, ["domain"], k, "g")
    total = sum(everywhere)

    def smoothed(prefix: str, above: list[Column]) -> list[Column]:
        # The page itself is left out of its own prior.
        own = [F.greatest(F.col(f"{prefix}{i}") - F.col(f"p{i}"), F.lit(0.0)) for i in range(k)]
        pages_there = reduce(lambda a, b: a + b, own)
        return [(o + PRIOR_PAGES * a) / (pages_there + PRIOR_PAGES) for o, a in zip(own, above)]

    base = [F.lit((a + _SMOOTHING) / (total + _SMOOTHING * k)) for a in everywhere]
    placed = fused.join(hosts, "host").join(domains, "domain")
    priors = smoothed("h", smoothed("g", base))
    final = [F.col(f"s{i}") + F.log(p) for i, p in enumerate(priors)]
    names = F.array(*[F.lit(x) for x in model.languages])
    chances = F.array(*_normalised([F.col(f"f{i}") for i in range(k)]))
    best = F.array_position(F.col("c"), F.array_max("c")) - 1
    text_best = F.array_position(F.col("t"), F.array_max("t")) - 1
    return (
        placed.withColumns({f"f{i}": f for i, f in enumerate(final)})
        .withColumn("c", chances)
        .select(
            F.col("key").alias(key),
            "host",
            "declared",
            "suffix",
            "folder",
            F.get(names, text_best.cast("int")).alias("text_language"),
            F.get(names, best.cast("int")).alias("language"),
            F.round(F.array_max("c"), 6).alias("probability"),
        )
    )
