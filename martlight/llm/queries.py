"""The operators of this package as registered queries over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlight.llm import (
    clustering,
    decontaminate,
    langid,
    neighbours,
    packing,
    periodic,
    quality,
    secrets,
    sharding,
    simhash,
    substring,
    urlfilter,
    warc,
)
from martlight.llm.columns import bind, words
from martlight.session import share_package, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# The rules that the url query applies, and its number of shards.
URL_RULES = [
    urlfilter.rule("allow", "com/"),
    urlfilter.rule("block", "example.com/en/"),
    urlfilter.rule("allow", "www.example.com/en/"),
    urlfilter.rule("block", "net/es/"),
    urlfilter.rule("block", "net/fr/"),
]
SHARDS = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = simhash.near_duplicate_classes(table(spark, sf_dir, "documents"))
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return classes.withColumn("fingerprint", digits)


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judge(docs).select("row.doc_id", *counts, "base_failed", "words_left", "kept")


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    p = F.col("passages")
    found = decontaminate.find_passages(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        p["n_words"].alias("n_words"),
        decontaminate.hit_words(p).alias("n_hit"),
        F.size(p["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(p["items"], ","), 256).alias("items_sha256"),
        (F.size(p["starts"]) > 0).alias("contaminated"),
    )


def secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secrets")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == secrets.KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    base = F.filter(spans, lambda s: s["kind"] != secrets.KINDS.index("random"))
    return found.select("doc_id", "secrets").select(
        "doc_id",
        *[count(k) for k in secrets.KINDS],
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(spans).alias("spans"),
    )


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = langid.train(table(spark, sf_dir, "documents"))
    return langid.identify(table(spark, sf_dir, "pages"), model)


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"), sharding.even_tree(SHARDS))
    return placed.withColumn("law", F.lit("key"))


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        F.col("page_key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to_key").cast("long").alias("refers_to"),
    )


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), lambda key: key % 50 == 0)


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_vectors(table(spark, sf_dir, "embeddings"))[0]


def with_periodic_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with some texts, chosen by their key's checksum, made periodic from some word on."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def altered(w):
        n = F.size(w)

        def of(a):
            period = F.floor((n - a) / (3 + g % 8)) + 1

            def word(i):
                return F.when(i < a, F.get(w, i)).otherwise(F.get(w, (a + (i - a) % period).cast("int")))

            return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), word), " ")).otherwise(F.col(text))

        return bind(F.when(n > 0, g % n), of)

    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    return docs.withColumn(text, F.when(chosen, bind(words(F.col(text)), altered)).otherwise(F.col(text)))


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_periodic_tails(table(spark, sf_dir, "documents").select("doc_id", "text"))

    def longer(a, b):
        # Compares length / period exactly: numbers of words are far below 2 ** 31.
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return F.when(left == right, (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] <= b["period"]))).otherwise(left > right)

    run = "struct<start:bigint,length:bigint,period:bigint>"
    best = F.aggregate(
        "runs",
        F.lit(None).cast(run),
        lambda found, r: F.when(found.isNull(), r).when(longer(found, r), found).otherwise(r),
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic.find_runs(docs).withColumn("best", best)
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(F.col("best.length") * 1000 / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_simhash_near_dedup": near_dedup,
    "op2_quality_rules": quality_rules,
    "op3_benchmark_decontamination": decontamination,
    "op4_secret_scans": secret_scans,
    "op5_best_fit_packing": best_fit_packing,
    "op6_language_id": language_id,
    "op7_sharding": shards,
    "op8_url_filters": url_filters,
    "op9_substring_dedup": substring_dedup,
    "op10_warc": warc_archives,
    "op11_nearest_neighbours": nearest_neighbours,
    "op12_centroid_clusters": centroid_clusters,
    "op13_periodic_runs": periodic_runs,
}
