"""Centroid clustering and hard-negative mining against brute force."""

import collections
import hashlib
import math
import random

import numpy as np
import pytest

from zonage.llm import centroids, negatives, queries

SCHEMA = "vec_id bigint, embedding array<double>, label int, ids int, xs string, cluster int, score int, a int, _x int, _id int"


def table(spark, rows, parts=3):
    """``(vec_id, embedding, label)`` rows with extra columns named like the operators' own."""
    return spark.createDataFrame([(i, v, y, 1, "x", 2, 3, 4, 5, 6) for i, v, y in rows], SCHEMA).repartition(parts)


def vector(r, size=64, spread=0.2):
    return [r.gauss(0, spread) for _ in range(size)]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    out = [(i, vector(r), r.randrange(3)) for i in range(0, 900, 3)]
    hot = vector(r)
    out += [(1000 + i, hot, 1) for i in range(60)]                 # one vector many times
    out += [(100, out[34][1], 2), (100, vector(r), 0)] * 2         # ids and rows that repeat
    out += [(None, vector(r), 1), (None, vector(r), 2)]
    out += [(5000, None, 1), (5001, vector(r), None), (5100, [float("nan")] + vector(r, 63), 1),
            (5200, [float("inf")] + vector(r, 63), 1), (5300, [None] + vector(r, 63), 1), (5400, [1e300] + vector(r, 63), 1)]
    return out


def usable(v, scale):
    return v is not None and all(x is not None and math.isfinite(x) and abs(x * scale) <= 1 << 27 for x in v)


# -- centroid clustering ------------------------------------------------------

def clustered(rows, k=8, rounds=10, size=64):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v, _ in rows if usable(v, 1024) and len(v) == size]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    cs = [x for _, x in sorted(((name(i), x) for i, x in kept))[:k]]
    dist = lambda x, c: sum((p - q) ** 2 for p, q in zip(x, c))

    def nearest(x):
        return min(range(len(cs)), key=lambda n: (dist(x, cs[n]), n))

    for _ in range(rounds):
        of = [nearest(x) for _, x in kept]
        for n in range(len(cs)):
            own = [x for (_, x), o in zip(kept, of) if o == n]
            if own:
                cs[n] = [sum(col) // len(own) for col in zip(*own)]
    each = [(i, n := nearest(x), dist(x, cs[n])) for i, x in kept]
    inertia = collections.Counter()
    for _, n, d in each:
        inertia[n] += d
    return collections.Counter((i, n, d, inertia[n], sum(inertia.values()), ",".join(map(str, cs[n]))) for i, n, d in each)


def test_clusters(spark, rows):
    odd = [(7000, vector(random.Random(1), 63), 1), (7001, [], 1), (7002, vector(random.Random(2), 65), 0)]
    got = centroids.cluster(table(spark, rows + odd))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert collections.Counter(tuple(r) for r in got.collect()) == clustered(rows + odd)


def test_clusters_of_large_components(spark):
    r = random.Random(3)
    big = [(i, [r.uniform(-1e5, 1e5) for _ in range(4)], 0) for i in range(200)]
    got = centroids.cluster(table(spark, big), components=4, rounds=3)
    assert collections.Counter(tuple(x) for x in got.collect()) == clustered(big, rounds=3, size=4)


def test_clusters_of_few_or_no_vectors(spark, rows):
    for few in (rows[:3], [(5, None, 1)], []):
        assert collections.Counter(tuple(r) for r in centroids.cluster(table(spark, few)).collect()) == clustered(few)


def test_candidates_hold_the_nearest():
    rng = np.random.default_rng(1)
    skipped = 0
    for _ in range(200):
        low = rng.integers(-50, 50, 5)
        high = low + rng.integers(0, 30, 5)
        cs = rng.integers(-60, 60, (8, 5))
        x = rng.integers(low, high + 1, (300, 5))
        at = centroids.candidates(low, high, cs)
        want = ((x[:, None] - cs[None]) ** 2).sum(2).argmin(1)
        assert set(want) <= set(at.tolist())
        assert (centroids.nearest(x, low, high, cs) == want).all()
        skipped += 8 - len(at)
    assert skipped > 400


def test_hilbert_order_visits_neighbours():
    for d, bits in ((2, 4), (3, 3), (5, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), -1).reshape(-1, d)
        keys = [k.tobytes() for k in centroids.hilbert_keys(grid, bits)]
        assert len(set(keys)) == len(grid)
        walk = grid[sorted(range(len(grid)), key=keys.__getitem__)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


# -- hard negatives -----------------------------------------------------------

def mined(rows, every=100, low=80, high=100):
    kept = [(i, y, [math.floor(256 * x) for x in v]) for i, v, y in rows if y is not None and usable(v, 256)]
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for a, (i, y, x) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = sorted(((sum(p * q for p, q in zip(x, v)), j, label) for b, (j, label, v) in enumerate(kept) if b != a), key=order)
        for score, j, label in [s for s in scored if s[2] == y][:5]:
            below = [s for s in scored if s[2] != y and low * score <= 100 * s[0] <= high * score][:5]
            out += [(i, j, k + 1, s[1], score, s[0]) for k, s in enumerate(below)]
    return collections.Counter(out)


@pytest.mark.parametrize("bounds", [{}, {"BROADCAST_BYTES": 0, "CHUNK": 2, "BLOCK_ROWS": 32, "SLICE": 7}])
def test_negatives(spark, rows, monkeypatch, bounds):
    for name, value in bounds.items():
        monkeypatch.setattr(negatives, name, value)
    got = negatives.mine(table(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = mined(rows)
    assert len(want) > 50
    assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_negatives_of_mixed_lengths_and_windows(spark):
    r = random.Random(9)
    mixed = [(i, vector(r, r.choice([0, 3, 64, 130]), 5.0), r.randrange(2)) for i in range(0, 400, 4)]
    got = negatives.mine(table(spark, mixed), every=20, low=10, high=150)
    assert collections.Counter(tuple(x) for x in got.collect()) == mined(mixed, 20, 10, 150)


def test_negatives_of_no_rows(spark, rows):
    for few in ([], [(100, None, 1)], rows[:1], [(101, [1.0], 1)]):
        assert negatives.mine(table(spark, few)).collect() == []


def test_products_are_exact():
    rng = np.random.default_rng(2)
    for size, top in ((1, 3), (64, 200), (64, 1 << 27), (200, 1 << 20), (0, 1)):
        a, b = rng.integers(-top, top + 1, (5, size)), rng.integers(-top, top + 1, (9, size))
        a[0], b[0] = top, -top
        want = [[sum(int(p) * int(q) for p, q in zip(x, y)) for y in b] for x in a]
        assert negatives.products(a, b).tolist() == want


def test_queries_on_the_smallest_tables(spark):
    ids = [r.vec_id for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert sorted(r.vec_id for r in queries.QUERIES["op12_centroids"](spark, "/root/testdata/sf0.001").collect()) == sorted(ids)
