"""SimHash near-duplicate classes, found by multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from martlight.llm.columns import LOWER_BYTES, fresh, text_key
from martlight.llm.components import connected_components
from martlight.session import materialize

BITS = 64
# Shingles of one text hashed before their bits are counted; bounds memory on very long texts.
_BLOCK = 1 << 16


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    Words are what ASCII white space leaves, A-Z lower-cased. A text of fewer words than a
    shingle has one shingle, all of it. A bit is 1 if more than half the hashes have it.
    """
    parts = (text or "").encode().translate(LOWER_BYTES).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(parts))
    starts, ends = starts[: len(parts) - width + 1], ends[width - 1 :]
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), _BLOCK):
        spans = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], 42) for s, e in spans], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text: str = "text", shingle: int = 4, column: str = "fingerprint") -> DataFrame:
    """Add the fingerprint as a long (two's complement); a null text has no words."""

    @F.pandas_udf("long")
    def prints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            yield pd.Series(found.view(np.int64))

    return docs.withColumn(column, prints(F.col(text)))


def segments(distance: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment of a fingerprint.

    Two fingerprints within ``distance`` bits are within ``radius`` bits in one segment at
    least: if they were further apart in all of them, the bits that differ would be too many.
    """
    if count < 2:
        raise ValueError("a fingerprint has two segments or more")
    radius, over = divmod(distance, count)
    plan, shift = [], 0
    for i in range(count):
        width = (BITS - shift) // (count - i)
        # With `over` left, only the first `over` + 1 segments need the full radius.
        plan.append((shift, width, radius if i <= over else radius - 1))
        shift += width
    return [s for s in plan if s[2] >= 0]


def _ball(width: int, radius: int) -> list[int]:
    """Masks of up to ``radius`` set bits, the empty one first."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _key(shift: int, width: int) -> Column:
    return F.shiftrightunsigned("fingerprint", shift).bitwiseAND((1 << width) - 1)


def _tagged(segment: int, value: Column) -> Column:
    """A segment's value as a bucket of its own."""
    return value + F.lit(segment << 40)


def _table(prints: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """(bucket, b, label_b): every fingerprint under the value of each of its segments."""
    stored = F.array(*[_tagged(i, _key(shift, width)) for i, (shift, width, _) in enumerate(plan)])
    return prints.select(F.explode(stored).alias("bucket"), F.col("fingerprint").alias("b"), F.col("label").alias("label_b"))


def _probes(prints: DataFrame, plan: list[tuple[int, int, int]]) -> DataFrame:
    """(bucket, flipped, a, label_a): the segment values in the ball around each fingerprint's own.

    Of two values a mask apart, only the one without the mask's lowest bit looks, so a pair
    meets once a segment; ``flipped`` is false where both have the same value.
    """
    asked = []
    for i, (shift, width, radius) in enumerate(plan):
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
        own = _key(shift, width)
        looks = F.filter(masks, lambda m: own.bitwiseAND(m.bitwiseAND(-m)) == 0)
        asked.append(
            F.transform(
                looks, lambda m: F.struct(_tagged(i, own.bitwiseXOR(m)).alias("bucket"), (m != 0).alias("flipped"))
            )
        )
    return prints.select(
        F.inline(F.concat(*asked)), F.col("fingerprint").alias("a"), F.col("label").alias("label_a")
    )


def _close(distance: int) -> Column:
    return F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance


def star_links(prints: DataFrame, distance: int = 4, count: int = 3) -> DataFrame:
    """Pairs (a, b) of fingerprints b close to a, one of two members of their bucket drawn by hash.

    Two rows a member and segment at most. They hold dense groups of fingerprints together, so that the search
    for all links can leave out what lies inside such a group.
    """
    table = _table(prints.withColumn("label", F.col("fingerprint")), segments(distance, count)).drop("label_b")
    drawn = table.groupBy("bucket").agg(
        F.array(F.min_by("b", F.xxhash64("b")), F.max_by("b", F.xxhash64("b"))).alias("centres")
    )
    met = table.join(drawn, "bucket").select("b", F.explode(F.array_distinct("centres")).alias("a"))
    return met.where(_close(distance) & (F.col("a") != F.col("b")))


def links(prints: DataFrame, distance: int = 4, count: int = 3) -> DataFrame:
    """(a, b, label_a, label_b): pairs of fingerprints that differ in few bits and in their labels.

    ``prints`` has fingerprint, once each, and may have label (default: the fingerprint, so
    that all links are found). Every fingerprint stands in the table of each segment under the
    segment's value. It looks up the values in a small Hamming ball around its own; what it
    meets is kept if the complete fingerprints are close enough. Members of a bucket's most
    common label meet the bucket's other members only: a bucket that one label fills is not
    searched in itself, however large it is.
    A pair may come once for each segment.
    """
    plan = segments(distance, count)
    if "label" not in prints.columns:
        prints = prints.withColumn("label", F.col("fingerprint"))
    table, probes = _table(prints, plan), _probes(prints, plan)
    sizes = table.groupBy("bucket", "label_b").agg(F.count(F.lit(1)).alias("n"))
    common = sizes.groupBy("bucket").agg(F.max_by("label_b", F.struct("n", "label_b")).alias("common"))
    # Each bucket has two sides: 0 holds all members, 1 those of other labels than the common one.
    sides = F.when(F.col("label_b") == F.col("common"), F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    sided = table.join(common, "bucket").select(
        "bucket", "b", "label_b", F.explode(sides).alias("side")
    )
    # Empty buckets drop out here.
    asking = probes.join(common, "bucket").select(
        "bucket", "flipped", "a", "label_a", F.when(F.col("label_a") == F.col("common"), 1).otherwise(0).alias("side")
    )
    met = asking.join(sided, ["bucket", "side"]).where(
        (F.col("flipped") | (F.col("a") < F.col("b"))) & (F.col("label_a") != F.col("label_b")) & _close(distance)
    )
    return met.select("a", "b", "label_a", "label_b")


def near_duplicate_classes(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, distance: int = 4, count: int = 3
) -> DataFrame:
    """One row per row of ``docs``: key, fingerprint (long), component_id.

    component_id is the least key reachable over links of at most ``distance`` differing
    bits, the row's own included. Equal fingerprints are one node, so copies never pair
    up. Links are found in two steps with the same components as all links: stars first, then the
    links between what the stars left apart. A null key joins its class but never
    names it; a class of null keys alone has a null id. Repeated rows come out repeated.
    ``count`` segments: more shorten the balls, fewer shorten the tables' buckets; segments
    of about log2 of the number of fingerprints are best.
    """
    prints = with_fingerprint(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), shingle=shingle)
    prints = materialize(prints.select("key", "fingerprint"), "simhash")
    nodes = materialize(prints.groupBy("fingerprint").agg(F.min("key").alias("first")), "simhash-nodes")
    stars = connected_components(star_links(nodes, distance, count), "simhash-stars")
    groups = stars.select(F.col("node").alias("fingerprint"), F.col("root").alias("group"))
    labelled = nodes.join(groups, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("group", "fingerprint").alias("label")
    )
    labelled = materialize(labelled, "simhash-groups")
    # The links between groups, by the groups' labels.
    between = links(labelled.select("fingerprint", "label"), distance, count).select(
        F.least("label_a", "label_b").alias("a"), F.greatest("label_a", "label_b").alias("b")
    )
    roots = connected_components(between.distinct(), "simhash-components").toDF("label", "root")
    rooted = labelled.join(roots, "label", "left").select(
        "fingerprint", "first", F.coalesce("root", "label").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each class, that of the least key; rows with a null key stay.

    Of several texts with the least key in one class, that of the least text key stays, and of its
    rows the least one by the columns that can be ordered. A key that repeats in different classes
    stands for each of them. ``options`` are those of ``near_duplicate_classes``.
    """
    row_id = fresh(docs, "row_id")
    # Names a row whose key repeats with another text.
    own = F.when(F.col(key).isNotNull(), F.struct(F.col(key).alias("key"), *text_key(F.col(text))))
    named = docs.withColumn(row_id, own)
    found = near_duplicate_classes(named, row_id, text, **options)
    kept = found.where(F.col(row_id) == F.col("component_id")).select(row_id).distinct()
    ordered = [f.name for f in docs.schema if not _unordered(f.dataType)]
    least = F.min_by(F.struct(*docs.columns), F.struct(*ordered))
    one = named.join(kept, row_id).groupBy(row_id).agg(least.alias("row"))
    return one.select("row.*").union(docs.where(F.col(key).isNull()))


def _unordered(kind: DataType) -> bool:
    """Whether values of a type have no order: maps, variants, and what holds them."""
    if isinstance(kind, ArrayType):
        return _unordered(kind.elementType)
    if isinstance(kind, StructType):
        return any(_unordered(f.dataType) for f in kind)
    return isinstance(kind, (MapType, VariantType))
