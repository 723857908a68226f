import math
import random
from fractions import Fraction

from pyspark.sql import functions as F

from tidemark.llm import topk_search as K

SCHEMA = "vec_id long, embedding array<double>, label int"


def whole(v):
    return [math.floor(Fraction(x) * 1024) for x in v]


def brute(rows, k=10):
    ok = [(i, whole(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in sorted(ok, key=lambda r: r[1]):
        if i % 100 == 0:
            queries.setdefault(i, v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))[:k]
        out += [(q, n + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for n, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows):
    out = K.search(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), F.col("vec_id") % 100 == 0)
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect())


def test_random_vectors_ties_and_negative_scores(spark, monkeypatch):
    rng = random.Random(2)
    vectors = [(i, [rng.choice([-1, -0.5, 0, 0.25, 1]) * rng.random() for _ in range(7)]) for i in range(450)]
    vectors += [(1000 + i, vectors[3][1]) for i in range(30)] + [(2000 + i, [0.0] * 7) for i in range(5)]
    assert run(spark, vectors) == brute(vectors)


def test_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (100, None), (200, [None, 1.0]), (300, [float("nan"), 1.0]), (400, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (500, []), (600, [1e300, 1.0]), (1, [0.5, -3.0]), (1, [0.5, -3.0]), (2, [1.0, 1.0, 1.0]), (700, [2.0, 2.0, 2.0]),
            (800, [-0.0001, 0.0001]), (3, [2e5, -2e5])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, [(0, [1.0]), (1, [3e5])]) == [(0, 1, 1, 314_572_800_000)]
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0])]) == []
    assert run(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_large_integers_as_queries_and_candidates(spark):
    rng = random.Random(9)
    size = lambda: 10.0 ** rng.choice([-2, 0, 3, 5, 6, 9, 30, 300])
    vectors = [(i, [rng.choice([-1, 1]) * rng.random() * size() for _ in range(3)]) for i in range(60)]
    vectors += [(100 * i, [rng.choice([-1, 1]) * rng.random() * size() for _ in range(3)]) for i in range(1, 9)]
    vectors += [(100 * i, [rng.random() for _ in range(3)]) for i in range(9, 14)] + [(7, vectors[3][1]), (200, [1.0, 2.0, 3.0]), (900, [4e6, 0., 0.])]
    assert run(spark, vectors) == brute(vectors)
    small = [(i, [rng.uniform(-1, 1)] * 2) for i in range(300)]
    assert run(spark, small + [(1, [5e5, -3.0])]) == brute(small + [(1, [5e5, -3.0])])
    assert run(spark, [(100, [1e8, 1.0])] + small) == brute([(100, [1e8, 1.0])] + small)


def test_no_join_sends_queries_to_the_driver(spark, monkeypatch):
    """Copies of the queries for every slot are not broadcast, however small the queries are (also beside large integers)."""
    plans, saved = [], K.saved
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(K, "saved", lambda df, name: (plans.append(plan(df)), saved(df, name))[1])
    rng = random.Random(4)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(200)]
    for rows in (vectors, vectors + [(300, [5e5, 1.0, 1.0, 1.0])]):
        out = K.search(spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA), F.col("vec_id") % 100 == 0)
        plans.append(plan(out))
        assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out.collect()) == brute(rows)
    assert any("SortMergeJoin" in p for p in plans)
    assert not [p for p in plans if "Broadcast" in p]


def test_many_chunks_and_blocks_with_sums_of_every_size(spark, monkeypatch):
    """Chunks and blocks of a few rows meet in each task; sums fit 32-bit floats, 64-bit floats or 64-bit integers only."""
    monkeypatch.setattr(K, "CHUNK", 16)
    monkeypatch.setattr(K, "QUERIES", 3)
    rng = random.Random(5)
    for size in (1, 900, 2e5):
        vectors = [(rng.choice([i, 100 * i]), [rng.uniform(-1, 1) * size for _ in range(rng.choice([1, 2, 5]))]) for i in range(260)]
        vectors += [(7000 + i % 3, vectors[9][1]) for i in range(25)] + vectors[:4]
        assert run(spark, vectors) == brute(vectors)
