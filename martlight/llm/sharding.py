"""Shards by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlight.session import materialize

# Default layout: shards in a rack, racks in a region.
RACK_SHARDS = 4
REGION_RACKS = 2


@dataclass(frozen=True)
class Leaf:
    """A shard's place in the tree and its weight."""

    region: int
    rack: int
    shard: int
    weight: int = 1


def even_tree(shards: int) -> list[Leaf]:
    """``shards`` shards of equal weight, numbered from 0, in full racks and regions."""
    racks = [s // RACK_SHARDS for s in range(shards)]
    return [Leaf(rack // REGION_RACKS, rack, s) for s, rack in enumerate(racks)]


def grown(tree: Sequence[Leaf], weight: int = 1) -> list[Leaf]:
    """The tree with one more shard, in a region of its own.

    All other subtrees keep their weights, so rows move into the new shard and nowhere else.
    """
    return [
        *tree,
        Leaf(
            max((x.region for x in tree), default=-1) + 1,
            max((x.rack for x in tree), default=-1) + 1,
            max((x.shard for x in tree), default=-1) + 1,
            weight,
        ),
    ]


def _draw(key: Column, level: int, weights: dict[int, int]) -> Column:
    """The child of the least weighted draw, -ln(u) / weight with u hashed from key, level and child."""
    def draw(child: int, weight: int) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(level), F.lit(child), key), 11).cast("double")
        u = (bits + 1) / float(1 << 53)
        return F.struct((-F.log(u) / float(weight)).alias("draw"), F.lit(child).alias("child"))

    draws = [draw(c, w) for c, w in sorted(weights.items()) if w > 0]
    return draws[0]["child"] if len(draws) == 1 else F.least(*draws)["child"]


def shard_of(key: Column, tree: Sequence[Leaf]) -> Column:
    """The shard of a key: draw a region, in it a rack, in that a shard.

    A child's chance is its weight, the sum of its shards' weights, and its draw hangs on
    nothing but the key and itself. If weights change, rows move only into and out of the subtrees
    whose weights changed. Null keys all go to one shard.
    """
    def level(leaves: Sequence[Leaf], depth: int) -> Column:
        name = ("region", "rack", "shard")[depth]
        groups: dict[int, list[Leaf]] = {}
        for leaf in leaves:
            groups.setdefault(getattr(leaf, name), []).append(leaf)
        weights = {child: sum(x.weight for x in own) for child, own in groups.items()}
        chosen = _draw(key, depth, weights)
        if depth == 2:
            return chosen
        below = [(c, level(own, depth + 1)) for c, own in sorted(groups.items()) if weights[c] > 0]
        result = below[-1][1]
        for child, inner in reversed(below[:-1]):
            result = F.when(chosen == child, inner).otherwise(result)
        return result

    return level(tree, 0)


def number_in_shards(rows: DataFrame, shard: str, order: list[str]) -> DataFrame:
    """Add ``slot``, gapless from 0 within each shard.

    ``rows`` is stored with the task that wrote each row. Rows are numbered within a shard's part
    of one task, which is bounded by a task's size, and parts start where those before end, so
    no shard, however large, is gathered.
    """
    stored = materialize(rows.withColumn("_part", F.spark_partition_id()), "shards")
    parts = stored.groupBy(shard, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(shard).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(shard, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = Window.partitionBy(shard, "_part").orderBy(*order)
    numbered = stored.withColumn("_at", F.row_number().over(within) - 1)
    return (
        numbered.join(starts, [shard, "_part"])
        .withColumn("slot", (F.col("_start") + F.col("_at")).cast("long"))
        .select(*rows.columns, "slot")
    )


def assign_shards(
    docs: DataFrame, tree: Sequence[Leaf], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard) of every row.

    size is the text's UTF-8 bytes and 8; a null text has none and the checksum of nothing.
    The key alone decides on the shard, so rows of one key, repeated or not, share it;
    grown_shard is the shard after one more has joined the tree.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(whole) + 8).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).cast("long").alias("text_crc32"),
    )
    # The trees' draws read a small stored row, not the text.
    placed = rows.withColumns(
        {
            "shard": shard_of(F.col("key"), tree).cast("int"),
            "grown_shard": shard_of(F.col("key"), grown(tree)).cast("int"),
        }
    )
    numbered = number_in_shards(placed, "shard", ["key", "size", "text_crc32"])
    return numbered.select(F.col("key").alias(key), "size", "text_crc32", "shard", "slot", "grown_shard")
