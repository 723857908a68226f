import hashlib
import math
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tidemark.llm import centroid_clusters as C

SCHEMA = "vec_id long, embedding array<double>, label int"
COLUMNS = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def brute(data, k, rounds, scale, dim):
    """Lloyd's rounds in Python integers, every distance taken."""
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in data
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cents = [v for _, v in first[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        of = assign()
        for j in range(len(cents)):
            mine = [v for (_, v), (_, a) in zip(kept, of) if a == j]
            if mine:
                cents[j] = [sum(c) // len(mine) for c in zip(*mine)]
    of = assign()
    fit = lambda x: x if x is not None and x < 1 << 63 else None
    inertia = {j: None if any(fit(d) is None for d, a in of if a == j) else fit(sum(d for d, a in of if a == j)) for _, j in of}
    total = None if None in inertia.values() else fit(sum(inertia.values()))
    return sorted(((i, j, fit(d), inertia[j], total, hashlib.sha256(",".join(map(str, cents[j])).encode()).hexdigest())
                   for (i, _), (d, j) in zip(kept, of)), key=repr)


def check(spark, data, k=4, rounds=3, dim=3, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in data], SCHEMA)
    assert rows(C.cluster(df, k=k, rounds=rounds, dim=dim, lead=1, **options), *COLUMNS) == brute(data, k, rounds, C.SCALE, dim)


def test_random_and_clustered_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 3, (6, 3))
    data = [(i, (centres[i % 6] + rng.normal(0, .5, 3)).tolist()) for i in range(150)]
    check(spark, data)
    check(spark, data, k=16)


def test_ties_repeats_and_nulls(spark):
    grid = [[a / 64, b / 64, 0.0] for a in (-1, 0, 1) for b in (-1, 0, 1)]
    data = [(i, v) for i, v in enumerate(grid * 3)]
    data += [(4, grid[2]), (4, grid[0]), (None, grid[1]), (50, None), (51, [None, 1.0, 1.0]), (52, [math.nan, 0., 0.]),
             (53, [math.inf, 0., 0.]), (54, [1.0]), (55, []), (56, [0.0, 0.0, -0.01])]
    check(spark, data)
    check(spark, data[:2], k=9)                      # fewer vectors than centroids
    check(spark, [(1, [1.0, 2.0, 3.0])] * 20, k=16)  # empty clusters stay


def test_components_of_any_size(spark):
    data = [(i, [i / 8, 1.0, -i / 4]) for i in range(30)]
    data += [(90, [3e5 * 2, 0., 0.]), (91, [1e30, -1e30, 5.0]), (92, [-1e300, 1e308, 0.5]), (93, [7e5, 1., 2.])]
    check(spark, data)
    check(spark, data, k=16)


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.cluster(empty).collect() == [] and C.cluster(empty).columns == list(COLUMNS)
    data = [(i, [float(i), 0.0, 1.0]) for i in range(9)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns(
        {c: F.lit("x") for c in ("id", "v", "x", "lead", "rest", "cluster", "distance", "inertia")})
    assert rows(C.cluster(df, k=2, dim=3), *COLUMNS) == brute(data, 2, 3, 64, 3)


def _filtered(vectors, k):
    """(lower bounds less margin, exact distances, nearest, distance, pairs verified) of plain vectors."""
    used = C.usable(vectors, "vec_id", "embedding", 64)
    mean, axes = C.rotation(used, 64, 64)
    x = np.floor(np.array([r["v"] for r in used.collect()]) * 64).astype(np.int64)
    turned = (x - mean) @ axes
    cents = C.Centroids(C.start(used, k, "1", 64), mean, axes, C.LEAD)
    lead, rest = turned[:, :C.LEAD], np.sqrt((turned[:, C.LEAD:] ** 2).sum(axis=1))
    low, margin = cents.bounds(lead, rest)
    return low - margin, np.stack([cents._exact(x, j) for j in range(k)], axis=1), *cents.nearest(x, lead, rest)


def test_bounds_hold_and_the_filter_rules_out_centroids(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    low, exact, best, distance, verified = _filtered(given, 16)
    assert (low <= exact).all() and (distance == exact.min(axis=1)).all() and (best == exact.argmin(axis=1)).all()
    assert verified < exact.size                 # these vectors spread evenly: little can be ruled out
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 1, (12, 64))
    planted = spark.createDataFrame([(i, (centres[i % 12] + rng.normal(0, 0.1, 64)).tolist()) for i in range(600)],
                                    "vec_id long, embedding array<double>")
    low, exact, best, distance, verified = _filtered(planted, 16)
    assert (low <= exact).all() and (best == exact.argmin(axis=1)).all() and verified < 0.25 * exact.size
