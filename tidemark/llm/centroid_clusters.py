"""Operator 12. Centroid clustering (Lloyd's rounds) with PCA-rotated filtering, exact in integers.

Vectors of DIM components become integers floor(SCALE * x). One pass over all
vectors adds up their first and second moments; the eigenvectors of the
covariance are a rotation whose leading LEAD axes hold most of the spread. The
table that the rounds read stores, beside the integers, a vector's leading
rotated coordinates and the norm of the rest. For a centroid c

    |lead(x) - lead(c)|^2 + (rest(x) - rest(c))^2  <=  |x - c|^2

(the rotation keeps distances, and norms differ by no more than the vectors).
A vector's distance to the centroid of the least bound is taken in integers;
centroids whose bound, less a margin far over the rounding error, is above it
are out, and the survivors are verified in integers, ties to the smaller
number. The rotation decides only how many survive, never the result.

Every task of a round adds up its vectors per centroid and returns k * (DIM + 1)
sums; Spark adds these, and the driver sees no more than k * (DIM + 1) numbers
(a few times that where sums pass 2**40). Centroids (k rows) go out with the
task. Nothing else is collected or broadcast; the table is written once to the
shared scratch folder, and every round is one job over it.

Edge cases: vectors that are null, of another length, or hold null or non-finite
components take no part. Components over SMALL in magnitude are whole numbers of
any size: such vectors are compared in Python's integers. A distance or inertia
that does not fit 64 bits is null. Repeated ids and vectors are rows of their
own; the start takes repeated ids in the order of their vectors and null ids
last. Fewer than k vectors start as many centroids; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, saved

K, ROUNDS, SCALE, DIM, LEAD = 16, 3, 64, 64, 32
#: Components up to here: squared distances of DIM of them fit 64 bits.
SMALL = 1 << 25
#: Rounding error of a bound, relative to (|x| + |c|)^2, is below 1e-12; the margin is a thousand times that.
MARGIN = 1e-9
#: Whole sums travel as digits of this base, so that sums of any size add up in Spark.
BASE_BITS = 40


def usable(df: DataFrame, vec_id: str, vector: str, dim: int) -> DataFrame:
    """(id, v) of the vectors that take part, components as doubles."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return df.where(F.col(vector).isNotNull() & (F.size(vector) == dim) & finite).select(
        F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))


def whole(x: float, scale: int) -> int:
    """floor(scale * x) as an integer of any size."""
    return int(x) * scale if abs(x) >= 2.0 ** 53 else math.floor(scale * x)


def _matrix(b: pa.RecordBatch, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are small, their integers, the doubles of all rows)."""
    v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    with np.errstate(over="ignore"):
        x = np.floor(v * scale)
    small = np.abs(x).max(axis=1, initial=0) <= SMALL
    return np.flatnonzero(small), x[small].astype(np.int64), v


def _moments(dim: int, scale: int):
    """A task's count, sums and products of components: row ``at`` holds one of 1 + dim + dim^2 numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, first, second = 0, np.zeros(dim), np.zeros((dim, dim))
        for b in batches:
            _, x, _ = _matrix(b, dim, scale)
            x = x.astype(np.float64)
            n, first, second = n + len(x), first + x.sum(axis=0), second + x.T @ x
        if n:
            values = np.concatenate([[n], first, second.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["at", "value"])
    return run


def rotation(vectors: DataFrame, dim: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, axes as columns, those of most variance first) over all vectors."""
    sums = vectors.select("v").mapInArrow(_moments(dim, scale), "at long, value double").groupBy("at").agg(F.sum("value").alias("s"))
    values = np.zeros(1 + dim + dim * dim)
    for r in sums.collect():  # 1 + dim + dim^2 rows
        values[r["at"]] = r["s"]
    n = max(values[0], 1.0)
    mean = values[1:1 + dim] / n
    _, axes = np.linalg.eigh(values[1 + dim:].reshape(dim, dim) / n - np.outer(mean, mean))
    return mean, np.ascontiguousarray(axes[:, ::-1])


def _rotate(mean: np.ndarray, axes: np.ndarray, dim: int, scale: int, lead: int):
    """id, integers (x, or wide as decimals), leading rotated coordinates, norm of the rest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, x, v = _matrix(b, dim, scale)
            turned = (x - mean) @ axes
            n = b.num_rows
            xs, wide, leads, rest = [None] * n, [None] * n, [None] * n, np.zeros(n)
            for i, j in enumerate(at):
                xs[j], leads[j] = x[i], turned[i, :lead]
            rest[at] = np.sqrt((turned[:, lead:] ** 2).sum(axis=1))
            for j in set(range(n)).difference(at.tolist()):
                wide[j] = [str(whole(float(c), scale)) for c in v[j]]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(xs, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.string())),
                 pa.array(leads, pa.list_(pa.float64())), pa.array(rest)], names=["id", "x", "wide", "lead", "rest"])
    return run


def _square(a: list[int], b: list[int]) -> int:
    return sum((p - q) ** 2 for p, q in zip(a, b))


class Centroids:
    """Whole centroids with their rotated form; ``nearest`` is the filter and its verification."""

    def __init__(self, centroids: list[list[int]], mean: np.ndarray, axes: np.ndarray, lead: int):
        self.exact = centroids
        self.narrow = [max(map(abs, c), default=0) <= SMALL for c in centroids]
        self.ints = [np.array(c, np.int64) if ok else None for c, ok in zip(centroids, self.narrow)]
        with np.errstate(over="ignore", invalid="ignore"):
            turned = (np.array([[_double(x) for x in c] for c in centroids]).reshape(len(centroids), -1) - mean) @ axes
            self.lead, self.rest = turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(axis=1))
            self.norm = np.sqrt((turned ** 2).sum(axis=1))

    def _exact(self, x: np.ndarray, j: int) -> np.ndarray:
        if self.narrow[j]:
            return ((x - self.ints[j]) ** 2).sum(axis=1)
        return np.array([_square(r, self.exact[j]) for r in x.tolist()], dtype=object)

    def bounds(self, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower bounds, margins) of the squared distances, a row for each vector."""
        with np.errstate(over="ignore", invalid="ignore"):
            near = sum((lead[:, i, None] - self.lead[None, :, i]) ** 2 for i in range(lead.shape[1]))
            norm = np.sqrt((lead ** 2).sum(axis=1) + rest ** 2)
            return near + (rest[:, None] - self.rest) ** 2, MARGIN * ((norm[:, None] + self.norm) ** 2 + 1)

    def nearest(self, x: np.ndarray, lead: np.ndarray, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(centroid, squared distance, pairs verified) of small vectors."""
        low, margin = self.bounds(lead, rest)
        start = np.where(np.isnan(low), np.inf, low).argmin(axis=1)
        best, distance = start.copy(), np.zeros(len(x), dtype=np.int64 if all(self.narrow) else object)
        for j in np.unique(start):
            distance[start == j] = self._exact(x[start == j], j)
        verified = len(x)
        with np.errstate(over="ignore", invalid="ignore"):
            out = low - margin > distance[:, None].astype(np.float64)  # an undefined bound rules nothing out
        for j in range(len(self.exact)):
            rows = np.flatnonzero(~out[:, j] & (start != j))
            verified += len(rows)
            d = self._exact(x[rows], j)
            nearer = (d < distance[rows]) | ((d == distance[rows]) & (j < best[rows]))
            best[rows[nearer]], distance[rows[nearer]] = j, d[nearer]
        return best, distance, verified

    def nearest_wide(self, x: list[int]) -> tuple[int, int]:
        distance, j = min((_square(x, c), j) for j, c in enumerate(self.exact))
        return j, distance


def _double(x: int) -> float:
    try:
        return float(x)
    except OverflowError:
        return math.inf if x > 0 else -math.inf


def _assigned(b: pa.RecordBatch, cents: Centroids, dim: int):
    """(small row numbers, integers, their centroids and distances; [(row, integers, centroid, distance)] of wide rows)."""
    small = np.flatnonzero(b.column("x").is_valid().to_numpy(zero_copy_only=False))
    picked = b.take(pa.array(small))
    x = picked.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    lead = picked.column("lead").flatten().to_numpy(zero_copy_only=False).reshape(len(small), -1)
    best, distance, _ = cents.nearest(x, lead, picked.column("rest").to_numpy(zero_copy_only=False))
    wide = []
    for i in np.flatnonzero(b.column("wide").is_valid().to_numpy(zero_copy_only=False)).tolist():
        v = [int(c) for c in b.column("wide")[i].as_py()]
        wide.append((i, v, *cents.nearest_wide(v)))
    return small, x, best, distance, wide


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) in base 2**BASE_BITS; the last digit has the sign."""
    place = 0
    while not -(1 << BASE_BITS) < value < 1 << BASE_BITS:
        yield place, value & ((1 << BASE_BITS) - 1)
        value >>= BASE_BITS
        place += 1
    yield place, value


def _sums(cents: Centroids, dim: int):
    """A task's count (at dim) and sums (at 0 ..) per centroid, as digits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(cents.exact)
        sums, counts = np.zeros((k, dim), dtype=object), [0] * k
        for b in batches:
            _, x, best, _, wide = _assigned(b, cents, dim)
            for j in np.unique(best).tolist():
                sums[j] += x[best == j].sum(axis=0).astype(object)
                counts[j] += int((best == j).sum())
            for _, v, j, _ in wide:
                sums[j] += np.array(v, dtype=object)
                counts[j] += 1
        rows = [(j, at, place, digit) for j in range(k) if counts[j]
                for at, value in enumerate([*sums[j], counts[j]]) for place, digit in _digits(int(value))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=["cluster", "at", "place", "digit"])
    return run


def _labels(cents: Centroids, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            small, _, best, distance, wide = _assigned(b, cents, dim)
            cluster, squared = np.zeros(b.num_rows, np.int32), [None] * b.num_rows
            cluster[small] = best
            for i, d in zip(small.tolist(), distance.tolist()):
                squared[i] = d if d < 1 << 63 else None
            for i, _, j, d in wide:
                cluster[i], squared[i] = j, d if d < 1 << 63 else None
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(cluster), pa.array(squared, pa.int64())],
                                             names=["id", "cluster", "distance"])
    return run


def start(vectors: DataFrame, k: int, seed: str, scale: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of ``seed:id``, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    return [[whole(x, scale) for x in r["v"]] for r in vectors.orderBy(order.asc_nulls_last(), "v").limit(k).collect()]


def moved(table: DataFrame, cents: Centroids, dim: int) -> list[list[int]]:
    """One round: every non-empty centroid becomes the floor of its vectors' mean."""
    sums = (table.mapInArrow(_sums(cents, dim), "cluster long, at long, place long, digit long")
            .groupBy("cluster", "at", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("s")))
    total: dict[tuple[int, int], int] = {}
    for r in sums.collect():  # k * (dim + 1) rows, times the digits of the largest sum
        key = (r["cluster"], r["at"])
        total[key] = total.get(key, 0) + (int(r["s"]) << (BASE_BITS * r["place"]))
    return [[total[j, at] // total[j, dim] for at in range(dim)] if (j, dim) in total else c for j, c in enumerate(cents.exact)]


def cluster(df: DataFrame, k: int = K, rounds: int = ROUNDS, seed: str = "1", vec_id: str = "vec_id",
            vector: str = "embedding", dim: int = DIM, scale: int = SCALE, lead: int = LEAD) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that takes part."""
    spark = df.sparkSession
    prepare(spark)
    vectors = usable(df, vec_id, vector, dim)
    id_type = vectors.schema["id"].dataType.simpleString()
    centroids = start(vectors, k, seed, scale)
    if not centroids:
        return spark.createDataFrame([], f"vec_id {id_type}, cluster int, distance long, cluster_inertia long, inertia long, "
                                         "centroid_sha256 string")
    mean, axes = rotation(vectors, dim, scale)
    table = saved(vectors.mapInArrow(_rotate(mean, axes, dim, scale, lead), f"id {id_type}, x array<bigint>, wide array<string>, "
                                     "lead array<double>, rest double"), "clusters-rotated")
    for _ in range(rounds):
        centroids = moved(table, Centroids(centroids, mean, axes, lead), dim)
    final = saved(table.mapInArrow(_labels(Centroids(centroids, mean, axes, lead), dim),
                                   f"id {id_type}, cluster int, distance long"), "clusters-labels")
    per = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"),
                                       F.count_if(F.col("distance").isNull()).alias("unfit")).collect()  # k rows
    inertia = {r["cluster"]: None if r["unfit"] or int(r["s"]) >= 1 << 63 else int(r["s"]) for r in per}
    total = None if None in inertia.values() or sum(inertia.values()) >= 1 << 63 else sum(inertia.values())
    facts = [(j, i, total, hashlib.sha256(",".join(map(str, centroids[j])).encode()).hexdigest()) for j, i in inertia.items()]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(F.broadcast(facts), "cluster").select(  # at most k rows
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
