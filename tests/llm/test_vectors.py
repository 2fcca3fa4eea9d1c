"""Nearest neighbours and centroid clusters against brute force, on awkward vectors."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from martlight.llm import clustering, neighbours
from martlight.llm.oracle import ORACLES
from martlight.llm.queries import QUERIES
from tests.compare import connect, differences
from tests.llm.tables import clashing

SCHEMA = "vec_id long, embedding array<double>"
NAN, INF = float("nan"), float("inf")


def usable(v, dimensions=None):
    if v is None or not v or any(x is None or not math.isfinite(x) for x in v):
        return False
    return dimensions is None or len(v) == dimensions


def vector_rows(rng, n=300, dimensions=64):
    """Clusters, many copies of one vector, multiples, nulls, zeros, other lengths, repeated and null ids."""
    centres = rng.normal(size=(6, dimensions))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=dimensions)).tolist()) for i in range(n)]
    common = rng.normal(size=dimensions).tolist()
    rows += [(1000 + i, common) for i in range(n // 2)]
    rows += [(2000 + i, [2.0**i * x for x in common]) for i in range(4)]
    rows += [(3000, None), (3050, []), (3100, [0.0] * dimensions), (3150, [None] * dimensions)]
    rows += [(3200, [NAN] + common[1:]), (3250, [INF] + common[1:]), (3300, [-INF] + common[1:])]
    rows += [(4000 + i, rng.normal(size=8).tolist()) for i in range(0, 60, 10)] + [(4100, [1.0]), (4150, [-2.0])]
    rows += [rows[0], rows[0], (50, common), (None, common), (None, rows[3][1]), (None, rows[3][1])]
    rows += [(5000, [1e300 * x for x in common]), (5050, [1e-300 * x for x in common]), (5100, [-0.0] * 63 + [1.0]), (5150, [0.0] * 63 + [1.0])]
    return rows


def exact(rows, count=5):
    """{(query id, its vector): [(id, score)]}, all candidates in order."""
    kept = {(k, tuple(x + 0.0 for x in v)) for k, v in rows if usable(v) and any(x != 0 for x in v)}
    out = {}
    for k, v in kept:
        if k is None or k % 50:
            continue
        others = [o for o in kept if o != (k, v) and len(o[1]) == len(v)]
        if others:
            found = neighbours.cosines(np.array(v), np.array([o[1] for o in others]))
            ranked = sorted(zip(others, found.tolist()), key=lambda x: (-x[1], x[0][0] is None, x[0][0]))
            out[k, v] = [(o[0], s) for o, s in ranked]
        else:
            out[k, v] = []
    return out


def asked(frame, **options):
    return neighbours.nearest_neighbours(frame, lambda key: key % 50 == 0, **options)


def test_all_lists_and_a_lenient_test_are_exact(spark):
    rows = vector_rows(np.random.default_rng(1))
    frame = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(5)
    found = asked(frame, probe_share=1.0, sureness=1e6).collect()
    ours = Counter((r.query_id, r["rank"], r.vec_id, round(r.score, 12)) for r in found)
    expected = Counter(
        (k, i + 1, o, round(s, 12)) for (k, _), ranked in exact(rows).items() for i, (o, s) in enumerate(ranked[:5])
    )
    assert ours == expected


def test_groups_and_parts_change_nothing(spark, monkeypatch):
    rows = vector_rows(np.random.default_rng(2))
    frame = spark.createDataFrame(rows, SCHEMA)
    one = sorted(map(tuple, asked(frame, probe_share=1.0, sureness=1e6).collect()), key=str)
    monkeypatch.setattr(neighbours, "MIN_GROUP_VECTORS", 16)
    monkeypatch.setattr(neighbours, "MAX_GROUP_VECTORS", 16)
    monkeypatch.setattr(neighbours, "GROUP_QUERIES", 3)
    assert sorted(map(tuple, asked(frame, probe_share=1.0, sureness=1e6).collect()), key=str) == one


def test_scores_are_cosines_and_recall_is_high(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(6000, 64)).tolist())]
    found = asked(spark.createDataFrame(rows, SCHEMA))
    got = defaultdict(list)
    for r in found.orderBy("query_id", "rank").collect():
        q, v = np.array(rows[r.query_id][1]), np.array(rows[r.vec_id][1])
        assert r.score == pytest.approx(q @ v / math.sqrt((q @ q) * (v @ v)), abs=1e-12)
        got[r.query_id].append(r.vec_id)
    units = np.array([v for _, v in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    hits = 0
    for q in range(0, 6000, 50):
        near = units @ units[q]
        near[q] = -2
        hits += len(set(np.argsort(-near)[:5].tolist()) & set(got[q]))
        assert len(got[q]) == 5 and q not in got[q]
    assert hits / 600 >= 0.9


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_recall_on_the_test_tables(spark, scale):
    folder = f"/root/testdata/{scale}"
    table = pq.read_table(f"{folder}/embeddings.parquet")
    ids, vectors = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), dtype=np.float64)
    units = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    got = defaultdict(set)
    for r in QUERIES["op11_nearest_neighbours"](spark, folder).collect():
        got[r.query_id].add(r.vec_id)
    hits = total = 0
    for i in np.flatnonzero(ids % 50 == 0):
        near = units @ units[i]
        near[i] = -2
        hits += len(got[ids[i]] & set(ids[np.argsort(-near)[:5]].tolist()))
        total += 5
    assert hits / total >= 0.9


def test_tests_abandon_candidates_early():
    rng = np.random.default_rng(4)
    vectors = 2 * rng.normal(size=(10, 64))[rng.integers(0, 10, 4000)] + rng.normal(size=(4000, 64))
    query = vectors[17] + 0.2 * rng.normal(size=64)
    blocks = neighbours.ColumnBlocks(vectors, neighbours.rotation(64))
    rows, scores, read = blocks.search(query, np.arange(4000), 5)
    assert rows[0] == 17 and read < 0.5 * 4000 * 64
    _, _, whole = blocks.search(query, np.arange(4000), 5, sureness=1e6)
    assert whole == 4000 * 64


def test_rotation_keeps_distances():
    turn = neighbours.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64)) and np.array_equal(turn, neighbours.rotation(64))


def test_no_vectors_no_queries(spark):
    assert asked(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert asked(spark.createDataFrame([(1, [1.0, 2.0]), (2, [2.0, 1.0])], SCHEMA)).isEmpty()
    assert asked(spark.createDataFrame([(0, [1.0, 2.0]), (50, None)], SCHEMA)).isEmpty()


# --- clusters ---------------------------------------------------------------------


def brute_clusters(rows, count=40, rounds=5, dimensions=64):
    """{row: (cluster, distance)} by every distance in Python's whole numbers, and the centroids."""
    kept = [(k, v) for k, v in rows if usable(v, dimensions)]
    whole = [[math.floor(256 * x) if abs(x) < 2**53 else int(x) * 256 for x in v] for _, v in kept]
    order = sorted(
        range(len(kept)),
        key=lambda i: (kept[i][0] is None, hashlib.sha256(f"2:{kept[i][0]}".encode()).hexdigest() if kept[i][0] is not None else "", kept[i][1]),
    )
    centroids = [whole[i] for i in order[:count]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(x, c)), n) for n, c in enumerate(centroids)) for x in whole]

    for _ in range(rounds):
        members = defaultdict(list)
        for (_, n), x in zip(assign(), whole):
            members[n].append(x)
        for n, own in members.items():
            centroids[n] = [sum(c) // len(own) for c in zip(*own)]
    found = assign()
    inertia = defaultdict(int)
    for d, n in found:
        inertia[n] += d
    total = sum(inertia.values())

    def fits(v):
        return v if v < 2**63 else None

    shas = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(k, n, fits(d), fits(inertia[n]), fits(total), shas[n]) for (k, _), (d, n) in zip(kept, found)], centroids


@pytest.mark.parametrize("huge", [0, 1e12, 1e300])
def test_clusters(spark, huge):
    rng = np.random.default_rng(5)
    rows = [r for r in vector_rows(rng) if r[0] is None or r[0] < 5000]
    if huge:
        rows += [(6000 + i, (huge * rng.normal(size=64)).tolist()) for i in range(3)]
    frame = clashing(spark.createDataFrame(rows, SCHEMA)).repartition(4)
    found, centroids = clustering.cluster_vectors(frame)
    expected, expected_centroids = brute_clusters(rows)
    assert centroids == expected_centroids
    assert Counter(map(tuple, found.collect())) == Counter(expected)


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0, -1.0]), (2, [1.0, -1.0]), (3, [0.5, 0.25]), (4, [1.0])]
    found, centroids = clustering.cluster_vectors(spark.createDataFrame(rows, SCHEMA), dimensions=2)
    expected, _ = brute_clusters(rows, dimensions=2)
    assert Counter(map(tuple, found.collect())) == Counter(expected) and len(centroids) == 3
    found, centroids = clustering.cluster_vectors(spark.createDataFrame(rows[3:], SCHEMA))
    assert found.isEmpty() and centroids == []


def test_tournament_is_the_nearest_centroid():
    rng = np.random.default_rng(6)
    for reach in (3, 300, 1 << 29, 10**30):
        draw = lambda n: [[int(v) for v in row] for row in (rng.integers(-3, 4, (n, 4)).astype(object) * (reach // 3))]
        centroids, vectors = draw(12), draw(200)
        bisectors = clustering.Bisectors(centroids)
        kind = np.int64 if reach < 1 << 31 else object
        got = bisectors.nearest(np.array(vectors, dtype=kind))
        distances = [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in centroids] for x in vectors]
        assert got.tolist() == [d.index(min(d)) for d in distances]
        assert bisectors.distances(np.array(vectors, dtype=kind), got).tolist() == [min(d) for d in distances]


def test_clusters_match_sql(spark, sf_dir):
    name = "op12_centroid_clusters"
    assert differences(spark, connect(sf_dir), QUERIES[name], ORACLES[name], sf_dir) == []


def test_float_vectors(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=64)]) for i in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<float>"))
    assert Counter(map(tuple, clustering.cluster_vectors(frame)[0].collect())) == Counter(brute_clusters(rows)[0])
