"""Approximate nearest neighbours by cosine: probed lists scanned dimension block by dimension block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from martlight.llm.clustering import usable
from martlight.session import materialize

NEIGHBOURS = 5
# Lists of the index: twice the square root of the number of vectors, up to this many.
MAX_LISTS = 1024
# Vectors a list's centre is fitted on, on average. The sample holds no more than MAX_LISTS times as many.
SAMPLE_PER_LIST = 32
FIT_ROUNDS = 8
# Lists a query looks into: this share of all, and this many at least. Vectors without
# clusters need about half of them; a tenth does where there are clusters.
PROBE_SHARE = 0.6
MIN_PROBES = 64
# Dimensions of a column block, and how sure a test must be to abandon a candidate (in standard errors).
BLOCK = 16
SURENESS = 2.1
SEED = 11

# Vectors of one group of lists: a 256th of all, within these bounds; queries that meet a group at once.
MIN_GROUP_VECTORS, MAX_GROUP_VECTORS = 4096, 65_536
GROUP_QUERIES = 16_384
# Lists that share the vectors of lengths of which the sample has none.
SPARE_LISTS = 64
# Candidates compared before the first test, and between two updates of a query's threshold.
_FIRST, _STEP = 64, 1024
_KEY = ["key_1", "key_2"]


def rotation(dimensions: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same wherever it is drawn."""
    drawn, triangle = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimensions, dimensions)))
    return drawn * np.sign(np.diag(triangle))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; powers of two are taken out first, so that no square overflows."""
    scaled = _scaled(vectors)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True, initial=0))[1])


def cosines(query: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Cosine of one vector and each of the others, in doubles."""
    q, v = _scaled(query[None, :])[0], _scaled(vectors)
    return (v * q).sum(axis=1) / (np.sqrt((q * q).sum()) * np.sqrt((v * v).sum(axis=1)))


def _blocks_of(rows: np.ndarray, size: int = 4096) -> list[np.ndarray]:
    return [rows[at : at + size] for at in range(0, len(rows), size)]


def fit_centres(sample: np.ndarray, count: int, rounds: int = FIT_ROUNDS, seed: int = SEED) -> np.ndarray:
    """Up to ``count`` unit centres of unit vectors, by spherical k-means."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(count, len(sample)), replace=False)]
    for _ in range(rounds):
        nearest = np.concatenate([(some @ centres.T).argmax(axis=1) for some in _blocks_of(sample)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        length = np.sqrt((sums * sums).sum(axis=1, keepdims=True))
        centres = np.where(length > 1e-9, sums / np.maximum(length, 1e-9), centres)
    return centres


class ColumnBlocks:
    """Rotated unit vectors of one length, each block of dimensions stored by itself."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray, block: int = BLOCK):
        self.vectors, self.turn = vectors, turn
        rotated = (_unit(vectors) @ turn).astype(np.float32)
        self.edges = [*range(0, rotated.shape[1], block), rotated.shape[1]]
        self.blocks = [np.ascontiguousarray(rotated[:, a:b]) for a, b in zip(self.edges, self.edges[1:])]

    def search(
        self, query: np.ndarray, rows: np.ndarray, count: int, sureness: float = SURENESS
    ) -> tuple[np.ndarray, np.ndarray, int]:
        """The ``count`` nearest found among ``rows``, their exact cosines, and the dimensions read.

        ``rows`` are those of the probed lists, nearest list first; equally near ones come out by row number.
        The first rows are compared in full and give a threshold: the ``count``-th least distance. Of
        the others, the squared distance over the first d of D rotated dimensions times D / d estimates the
        whole; where it is above the threshold by more than chance explains (the hypothesis that the candidate
        is nearer is rejected), the candidate is abandoned and its further blocks are not read. The
        threshold falls as the scan goes on.
        """
        turned = (_unit(query[None, :])[0] @ self.turn).astype(np.float32)
        width, read, limit = self.edges[-1], 0, np.inf
        best, survivors = np.empty(0, dtype=np.float32), []
        for some in [rows[:_FIRST], *(rows[at : at + _STEP] for at in range(_FIRST, len(rows), _STEP))]:
            partial = np.zeros(len(some), dtype=np.float32)
            for block, first, end in zip(self.blocks, self.edges, self.edges[1:]):
                gap = block[some] - turned[first:end]
                partial += np.einsum("ij,ij->i", gap, gap)
                read += len(some) * (end - first)
                if end < width and limit < np.inf:
                    alive = partial * (width / end) <= limit * (1 + sureness / np.sqrt(end)) ** 2
                    some, partial = some[alive], partial[alive]
            survivors.append(some)
            best = np.sort(np.concatenate((best, partial)))[:count]
            if len(best) == count:
                limit = best[-1]
        found = np.sort(np.concatenate(survivors))
        scores = cosines(query, self.vectors[found])
        order = np.argsort(-scores, kind="stable")[:count]
        return found[order], scores[order], read


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _one(column: pa.ChunkedArray) -> pa.Array:
    found = column.combine_chunks()
    return found.chunk(0) if isinstance(found, pa.ChunkedArray) else found


def _distinct_vectors(rows: DataFrame, count: int) -> DataFrame:
    """(key_1, key_2, vector, ids): every distinct vector once, with its ``count`` + 1 least ids.

    More ids of one vector can't be among a query's nearest; null ids come last. Ranks are cut
    off before rows are shuffled, so a vector that a third of all rows share sends a few of them.
    """
    vectors = rows.groupBy(*_KEY).agg(F.first("vector").alias("vector"))
    ids = rows.select("id", *_KEY).distinct()
    rank = F.row_number().over(Window.partitionBy(*_KEY).orderBy(F.col("id").asc_nulls_last()))
    least = ids.withColumn("rank", rank).where(F.col("rank") <= count + 1)
    listed = least.groupBy(*_KEY).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "id"))), lambda x: x["id"]).alias("ids")
    )
    return vectors.join(listed, _KEY)


class _Lists:
    """Centres of the lists by the length of their vectors, and the numbers of the lists."""

    def __init__(self, sample: list[list[float]], lists: int):
        by_length: dict[int, list] = {}
        for row in sample:
            by_length.setdefault(len(row), []).append(row)
        self.centres, self.first, self.count = {}, {}, SPARE_LISTS
        for length, rows in sorted(by_length.items()):
            own = max(1, round(lists * len(rows) / len(sample)))
            self.centres[length] = fit_centres(_unit(np.array(rows, dtype=np.float64)), own)
            self.first[length] = self.count
            self.count += len(self.centres[length])

    def nearest(self, vectors: np.ndarray, width: int) -> np.ndarray:
        """Numbers of the ``width`` lists nearest to each vector, nearest first; all vectors are of one length."""
        length = vectors.shape[1]
        if length not in self.centres:
            return np.full((len(vectors), 1), length % SPARE_LISTS)
        near = _unit(vectors) @ self.centres[length].T
        order = near.argmax(axis=1)[:, None] if width == 1 else np.argsort(-near, axis=1, kind="stable")[:, :width]
        return order + self.first[length]


def _by_length(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each length."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    chosen = [np.flatnonzero(sizes == n) for n in np.unique(sizes)]
    return [(rows, _matrix(column.take(pa.array(rows)))) for rows in chosen]


def _grouped(sizes: dict[int, int], target: int) -> tuple[dict[int, tuple[int, int]], int]:
    """(first group, groups) of each list: small lists share a group, large ones are dealt to several."""
    out, group, filled = {}, 0, 0
    for number, size in sorted(sizes.items()):
        if filled and filled + size > target:
            group, filled = group + 1, 0
        groups = max(1, -(-size // target))
        out[number] = (group, groups)
        filled += size
        if groups > 1:
            group, filled = group + groups, 0
    return out, group + 1


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Callable[[Column], Column],
    key: str = "vec_id",
    vector: str = "embedding",
    count: int = NEIGHBOURS,
    max_lists: int = MAX_LISTS,
    probe_share: float = PROBE_SHARE,
    min_probes: int = MIN_PROBES,
    sureness: float = SURENESS,
) -> DataFrame:
    """(query_id, rank, key, score): for each row whose key ``is_query`` says yes to, its nearest other rows found.

    score is the cosine of the original vectors in doubles; ranks count from 1, ties go to the lesser
    key, null keys last. Fewer candidates give fewer rows. A vector takes part if it isn't null, empty or all
    zeros and holds no null or non-finite component; vectors of different length never meet. Repeated rows are
    one row; rows of one key and different vectors are different rows, each a candidate of the other.
    No vectors or no queries: no rows.

    Index: centres of lists are fitted on a sample of up to ``max_lists`` * 32 distinct vectors (drawn by hash,
    collected on the driver); every vector stands in the list of its nearest centre. A query probes the
    lists of the nearest centres. Lists are dealt to groups of bounded size; a query meets each group that
    holds some of its lists once, and many queries meet a group in parts. Equal vectors are indexed and
    asked once. Sizes of lists, at most ``max_lists`` + 64 numbers, reach the driver.
    """
    spark = vectors.sparkSession
    named = vectors.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    named = named.where(usable(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    # 0.0 and -0.0 are one number.
    named = named.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    keyed = named.select("id", F.xxhash64("vector").alias("key_1"), F.xxhash64(F.lit(1), "vector").alias("key_2"), "vector")
    distinct = materialize(_distinct_vectors(keyed, count), "vectors")
    total = distinct.count()

    wanted = max(1, min(max_lists, round(2 * total**0.5))) * SAMPLE_PER_LIST
    drawn = F.pmod(F.xxhash64(F.lit(SEED), *_KEY), F.lit(1 << 30))
    share = min(1 << 30, (1 << 30) * 2 * wanted // max(total, 1))
    sample = distinct.where(drawn < share).orderBy(drawn, *_KEY).limit(wanted).select("vector").toArrow()
    lists = _Lists(sample.column("vector").to_pylist(), wanted // SAMPLE_PER_LIST)
    probes = max(min_probes, round((lists.count - SPARE_LISTS) * probe_share))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(batch.num_rows, dtype=np.int32)
            for rows, matrix in _by_length(batch.column("vector")):
                found[rows] = lists.nearest(matrix, 1)[:, 0]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, "list"])

    index = materialize(distinct.mapInArrow(place, StructType([*distinct.schema, StructField("list", IntegerType())])), "lists")
    sizes = {r["list"]: r["count"] for r in index.groupBy("list").count().collect()}
    target = min(max(total // 256, MIN_GROUP_VECTORS), MAX_GROUP_VECTORS)
    groups, _ = _grouped(sizes, target)

    asking = keyed.where(F.coalesce(is_query(F.col("id")), F.lit(False))).select("id", *_KEY).distinct()
    asking = materialize(asking, "queries")
    asked = distinct.select(*_KEY, "vector").join(asking.select(*_KEY).distinct(), _KEY)
    asked = materialize(asked, "asked")
    query_parts = max(1, -(-asked.count() // GROUP_QUERIES))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A query's row for each group that holds lists it probes, with those lists in order."""
        for batch in batches:
            owners, numbers, probed = [], [], []
            for rows, matrix in _by_length(batch.column("vector")):
                for row, near in zip(rows.tolist(), lists.nearest(matrix, probes).tolist()):
                    by_group: dict[int, list[int]] = {}
                    for number in near:
                        first, more = groups.get(number, (0, 0))
                        for g in range(first, first + more):
                            by_group.setdefault(g, []).append(number)
                    owners += [row] * len(by_group)
                    numbers += by_group
                    probed += by_group.values()
            arrays = [c.take(pa.array(owners, pa.int32())) for c in batch.columns]
            arrays += [pa.array(numbers, pa.int32()), pa.array(probed, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "group", "lists"])

    salt = F.xxhash64(F.lit(7), *_KEY)
    dealt = spark.createDataFrame(
        [(n, *g) for n, g in groups.items()], "list int, first_group int, groups int"
    )
    stored = (
        index.join(F.broadcast(dealt), "list")
        .withColumn("group", (F.col("first_group") + F.pmod(salt, F.col("groups"))).cast("int"))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
        .select("group", "part", "list", *_KEY, "vector", "ids")
    )
    fields = [*asked.schema, StructField("group", IntegerType()), StructField("lists", ArrayType(IntegerType()))]
    questions = asked.mapInArrow(probe, StructType(fields)).withColumn("part", F.pmod(salt, F.lit(query_parts)).cast("int"))

    def meet(held: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        # The order of rows decides which of equally near vectors stay, so it must not depend on how they came.
        held = held.sort_by([("list", "ascending"), ("key_1", "ascending"), ("key_2", "ascending")]).combine_chunks()
        asked = asked.combine_chunks()
        if held.num_rows and asked.num_rows:
            number, probed = held.column("list").to_numpy(), asked.column("lists").to_pylist()
            queries = {m.shape[1]: (r, m) for r, m in _by_length(_one(asked.column("vector")))}
            for rows, matrix in _by_length(_one(held.column("vector"))):
                width = matrix.shape[1]
                if width not in queries:
                    continue
                blocks, own = ColumnBlocks(matrix, rotation(width)), number[rows]
                for i, query in zip(*queries[width]):
                    starts, stops = (np.searchsorted(own, probed[i], side=side) for side in ("left", "right"))
                    spans = [np.arange(a, b) for a, b in zip(starts, stops)]
                    found, scores, _ = blocks.search(query, np.concatenate(spans), count + 1, sureness)
                    out.append((np.full(len(found), i), rows[found], scores))
        query, row, score = (np.concatenate(c) for c in zip(*out)) if out else (np.empty(0),) * 3
        query, row = (pa.array(v.astype(np.int64)) for v in (query, row))
        found = [asked.column(k).take(query) for k in _KEY] + [held.column(k).take(row) for k in (*_KEY, "ids")]
        return pa.table([*found, pa.array(score.astype(np.float64))], names=["query_1", "query_2", *_KEY, "ids", "score"])

    ids = f"array<{named.schema['id'].dataType.simpleString()}>"
    met = (
        stored.groupBy("group", "part")
        .cogroup(questions.groupBy("group", "part"))
        .applyInArrow(meet, f"query_1 long, query_2 long, key_1 long, key_2 long, ids {ids}, score double")
    )
    first = F.get("ids", F.lit(0))
    near = Window.partitionBy("query_1", "query_2").orderBy(F.desc("score"), first.asc_nulls_last(), *_KEY)
    # One vector more than asked for: the query's own may have no other row.
    vectors_found = met.withColumn("place", F.row_number().over(near)).where(F.col("place") <= count + 1).drop("place")
    own = (F.col("query_1") == F.col("key_1")) & (F.col("query_2") == F.col("key_2"))
    answers = (
        asking.toDF("query_id", "query_1", "query_2")
        .join(vectors_found, ["query_1", "query_2"])
        .select("query_id", "query_1", "query_2", "score", own.alias("own"), F.explode("ids").alias("id"))
        .where(~(F.col("own") & F.col("id").eqNullSafe(F.col("query_id"))))
    )
    place = F.row_number().over(
        Window.partitionBy("query_id", "query_1", "query_2").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    )
    return (
        answers.withColumn("rank", place)
        .where(F.col("rank") <= count)
        .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
    )
