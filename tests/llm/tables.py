"""Small tables with every awkward case."""

from __future__ import annotations

import random

from pyspark.sql.types import LongType, StringType, StructField, StructType

# Extra columns whose names operators might use inside.
CLASHING = ["key", "row", "facts", "passages", "secrets", "fingerprint", "bucket", "a", "b", "run", "value", "kind"]

DOCUMENTS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)
PAGES = StructType(
    [StructField("page_id", LongType()), StructField("url", StringType()), StructField("html", StringType())]
)
BENCHMARK = StructType([StructField("item_id", LongType()), StructField("text", StringType())])


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def document_rows():
    """(doc_id, text, source): copies, near copies, shared passages, nulls, empties, a long text."""
    rng = random.Random(7)
    shared = sentence(rng, 70)
    original = sentence(rng, 300)
    near = []
    for _ in range(12):
        parts = original.split(" ")
        parts[rng.randrange(300)] = f"edit{rng.randrange(10**6)}"
        near.append(" ".join(parts))
    texts = [sentence(rng, rng.randrange(1, 200)) for _ in range(40)]
    texts += [original] * 5 + near
    texts += [f"{sentence(rng, 30)} {shared} {sentence(rng, 20)}" for _ in range(6)]
    texts += [shared, shared.upper(), " " + shared + "\n\n", "same " * 200, "Ünï çödé \U0001f600 " * 30]
    texts += ["", " \t\n\x0b\x0c\r", "one", "two words", "a\nb\na\n\nb # * $", sentence(rng, 60_000)]
    texts += [None, None, None]
    rows = [(i, t, f"src{i % 3}" if i % 11 else None) for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], rows[45]]
    rows += [(None, shared, "src0"), (None, original, None), (None, None, None)]
    rows += [(500, sentence(rng, 80), "src1"), (500, original, "src1")]
    return rows


def documents(spark, rows=None):
    rows = document_rows() if rows is None else rows
    full = [(k, t, None, s, None if t is None else len(t)) for k, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def clashing(df):
    """The frame with extra columns in front and behind."""
    from pyspark.sql import functions as F

    names = [c for c in CLASHING if c not in df.columns]
    extra = [F.lit(f"x{i}").alias(n) for i, n in enumerate(names)]
    return df.select(*extra[:3], "*", *extra[3:])
