"""Operator 4. Exact top-k inner-product search by a three-phase uniform threshold.

Components become integers floor(1024 * x). The dimensions are split into LISTS
runs; for a query each run is a score list, a vector's score is the sum of its
entries in the lists. A list's scores are taken relative to the list's least
score, so they are not negative.

1. Gather: each chunk of vectors gives, per query, the least entry of every
   list and the K highest entries of every list (and what ties with the K-th),
   with the full scores of their vectors (a chunk holds all lists of its
   vectors). A task returns the least entries and the K best scores of its
   chunks. The K-th best of the scores over all chunks, tau1, is reached by the
   final K-th score.
2. Cutoff: a vector whose score reaches tau1 has an entry of at least
   T = ceil((tau1 - sum of least scores) / LISTS) over the least score in some
   list. T goes out to the chunks, which collect all entries that reach it:
   with an unknown entry between the list's least score and T - 1 they bound
   each such vector's score from both sides, and the K-th best lower bound is a
   better cutoff tau2. A task returns the K best lower bounds of its chunks.
3. Resolve: the entries that reach T are collected again, as they would take
   more room than the vectors, and vectors with an upper bound of at least tau2
   are scored exactly.

Vectors are held in chunks of CHUNK rows, queries in blocks of QUERIES; a block
meets a chunk by an equality join on a slot number, so chunks stay spread out
and nothing is broadcast or collected: every join is hinted to shuffle, as
Spark's size estimates leave out the copies of the queries. No cap: whatever
the cutoffs leave is resolved.

Vectors with an integer over LARGEST in magnitude have a branch of their own: as
queries against all rows, and as candidates of all queries, they are scored
block by block in Python's integers; the K best of both branches are ranked
together by a text that sorts as the whole numbers do. A score that does not fit
64 bits keeps its rank and is null.

Edge cases: vectors that are null or empty or hold a null or non-finite component,
and rows with a null id take no part; only vectors of the query's length are candidates; ties
go to the smaller id; rows with the query's id are its own and no candidates;
an id that repeats is one query (its least vector) but as many candidates as
rows; fewer than K candidates give fewer rows; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, saved

#: Few lists make a strong cutoff: T is an equal share of the score, and shares grow as lists get fewer.
K, LISTS, CHUNK, QUERIES, SCALE = 10, 2, 2048, 512, 1024
#: Integers up to here: scores of 64-bit sums (of fewer than 2**6 such components).
LARGEST = 1 << 28
#: Vectors a block of the exact branch holds.
WIDE_ROWS = 256
#: Candidates that are scored at a time.
SCORED = 1 << 15
#: Less than any score.
NONE = np.iinfo(np.int64).min + 1


def usable(vec_id: str, vector: str) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.col(vec_id).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False))


def _wide(vector: str) -> Column:
    """The vector has an integer over LARGEST."""
    return F.exists(vector, lambda x: F.abs(x) * SCALE > F.lit(float(LARGEST)))


def _pack(rows: int, id_name: str):
    """Vectors of one length, ``rows`` at a time, as one row: no, dim, ids, matrix (integers of 16 or 32 bits)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            v = b.column("v")
            size = np.diff(v.offsets.to_numpy())
            values = np.floor(v.flatten().to_numpy(zero_copy_only=False) * SCALE).astype("<i8")
            first, ids = np.cumsum(size) - size, b.column("id").to_numpy().astype("<i8")
            for dim in np.unique(size):
                of = np.flatnonzero(size == dim)
                for lo in range(0, len(of), rows):
                    i = of[lo:lo + rows]
                    matrix = values[first[i, None] + np.arange(dim)]
                    matrix = matrix.astype("<i2" if matrix.min() >= -1 << 15 and matrix.max() < 1 << 15 else "<i4")
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([base + n]), pa.array([int(dim)], pa.int32()), pa.array([ids[i].tobytes()], pa.binary()),
                         pa.array([matrix.tobytes()], pa.binary())], names=[id_name, "dim", f"{id_name}_ids", f"{id_name}_rows"])
                    n += 1
    return run


def _lists(dim: int) -> list[slice]:
    edges = np.linspace(0, dim, min(LISTS, dim) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges[:-1], edges[1:])]


def _parts(q: np.ndarray, v: np.ndarray, room: dict) -> list[np.ndarray]:
    """Exact entries of every list, queries by vectors (in floats where no sum can leave their whole numbers).

    They lie in ``room`` until the next call: fresh memory takes longer to get than the entries do."""
    norms = [math.sqrt(np.square(x, dtype=np.float64).sum(axis=1).max()) for x in (q, v)]
    most = 2 * norms[0] * norms[1]  # bounds every partial sum, with room for the rounding of the norms
    kind = np.float32 if most < 2 ** 24 else np.float64 if most < 2 ** 53 else np.int64
    q, v, out = q.astype(kind), v.astype(kind), []
    for n, dims in enumerate(_lists(q.shape[1])):
        if room.setdefault((n, kind), np.empty(0, kind)).size < len(q) * len(v):
            room[n, kind] = np.empty(len(q) * len(v), kind)
        out.append(np.matmul(q[:, dims], v[:, dims].T, out=room[n, kind][:len(q) * len(v)].reshape(len(q), len(v))))
    return out


def _true(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of what is marked."""
    return np.divmod(np.flatnonzero(marks), marks.shape[1])


def _reach(part: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The entries of at least their query's level."""
    if part.dtype.kind == "f":
        most = 1 << np.finfo(part.dtype).nmant + 1
        level = np.clip(level, -most, most).astype(part.dtype)
    return part >= level[:, None]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, query ids, query rows, vector ids, vector rows, own) of each block and chunk: own are the entries of a query's own id."""
    for b in batches:
        for i in range(b.num_rows):
            r = {c: b.column(c)[i] for c in b.schema.names}
            dim = r["dim"].as_py()
            qid, vid = (np.frombuffer(r[c].as_buffer(), "<i8") for c in ("qb_ids", "ck_ids"))
            q, v = (_matrix(r[c].as_buffer(), n, dim) for c, n in (("qb_rows", len(qid)), ("ck_rows", len(vid))))
            at = np.flatnonzero(np.isin(vid, qid))
            own = np.nonzero(qid[:, None] == vid[None, at])
            yield r, qid, q, vid, v, (own[0], at[own[1]])


def _matrix(raw: pa.Buffer, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{raw.size // (n * dim)}").reshape(n, dim)


class _Best:
    """The K best scores, with their ids, of each query of a block; ties to the smaller id."""

    def __init__(self, queries: int):
        self.score, self.id = np.full((queries, K), NONE, np.int64), np.zeros((queries, K), np.int64)

    def add(self, i: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Scores and ids of the queries ``i``."""
        last, last_id = self.score[i, -1], self.id[i, -1]
        better = (score > last) | (score == last) & (ids < last_id)
        i, score, ids = i[better], score[better], ids[better]
        rows = np.unique(i)
        i = np.concatenate([np.repeat(rows, K), i])
        score, ids = np.concatenate([self.score[rows].ravel(), score]), np.concatenate([self.id[rows].ravel(), ids])
        order = np.lexsort((ids, -score, i))
        i = i[order]
        first = order[np.arange(len(i)) - np.searchsorted(i, i) < K]
        self.score[rows], self.id[rows] = score[first].reshape(-1, K), ids[first].reshape(-1, K)

    def scores(self) -> list[list[int]]:
        return [s[s > NONE].tolist() for s in self.score]


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 1: the least entry of every list, and the K best scores of the vectors of the chunks' K highest entries."""
    most, blocks, room = np.iinfo(np.int64).max, {}, {}
    for r, qid, q, _, v, own in _pairs(batches):
        parts = _parts(q, v, room)
        _, _, least, best = blocks.setdefault(r["qb"].as_py(), (
            r["dim"].as_py(), qid.copy(), np.full((len(q), len(parts)), most), _Best(len(q))))
        heads = np.zeros(parts[0].shape, bool)
        lo, hi = (-np.inf, np.inf) if parts[0].dtype.kind == "f" else (NONE, most)
        for n, p in enumerate(parts):
            p[own] = hi
            low = p.min(axis=1)
            at = np.flatnonzero(low < hi)
            least[at, n] = np.minimum(least[at, n], low[at].astype(np.int64))
            p[own] = lo
            heads |= p >= np.partition(p, -K, axis=1)[:, -K, None] if len(v) > K else True
        heads[own] = False
        i, j = _true(heads)
        best.add(i, sum(p[i, j].astype(np.int64) for p in parts), np.zeros(len(i), np.int64))
    for qb, (dim, ids, least, best) in blocks.items():
        asks = np.flatnonzero(least[:, 0] < most)
        scores = best.scores()
        yield pa.RecordBatch.from_arrays(
            [pa.array([dim] * len(asks), pa.int32()), pa.array([qb] * len(asks), pa.int64()), pa.array(ids[asks]),
             pa.array(least[asks].tolist(), pa.list_(pa.int64())), pa.array([scores[i] for i in asks], pa.list_(pa.int64()))],
            names=["dim", "qb", "query_id", "least", "scores"])


def cutoffs(gathered: DataFrame) -> DataFrame:
    """dim, qb, query_id, least (per list), tau1 (null if fewer than K scores) and cut (T) of each query."""
    key = ["dim", "qb", "query_id"]
    least = (gathered.select(*key, F.posexplode("least").alias("list", "least")).groupBy(*key, "list").agg(F.min("least").alias("least"))
             .groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("list", "least"))).alias("l"), F.sum("least").alias("sum")))
    scores = gathered.select(*key, F.explode("scores").alias("tau1"))
    nth = scores.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("tau1")))).where(F.col("n") == K)
    share = F.expr("(tau1 - `sum`) div size(l) + if((tau1 - `sum`) % size(l) > 0, 1, 0)")  # rounded up; a double would lose units over 2**53
    return least.join(nth.drop("n").hint("merge"), key, "left").select(
        *key, F.col("l.least").alias("least"), "tau1", F.coalesce(share.cast("long"), F.lit(0)).alias("cut"))


def _known(r: dict, qid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Least entries (per list), cutoff and tau of a block's queries."""
    of, lists = {x["query_id"]: x for x in r["cuts"].as_py()}, len(_lists(r["dim"].as_py()))
    none = {"least": [0] * lists, "cut": 0, "tau": None}
    of = [of.get(i, none) for i in qid.tolist()]
    tau = [NONE if x["tau"] is None else x["tau"] for x in of]
    return np.array([x["least"] for x in of], np.int64), np.array([x["cut"] for x in of], np.int64), np.array(tau, np.int64)


def _collect(q: np.ndarray, v: np.ndarray, own: tuple, least: np.ndarray, cut: np.ndarray, room: dict) -> tuple[np.ndarray, ...]:
    """The entries that reach the cutoff: query, vector, and bounds on the score from both sides."""
    parts = _parts(q, v, room)
    seen = np.zeros(parts[0].shape, bool)
    for n, p in enumerate(parts):
        seen |= _reach(p, least[:, n] + cut)
    seen[own] = False
    i, j = _true(seen)
    low, high = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for n, p in enumerate(parts):
        part, floor = p[i, j].astype(np.int64), least[i, n]
        reach = part - floor >= cut[i]
        low += np.where(reach, part, floor)
        high += np.where(reach, part, floor + np.maximum(cut[i] - 1, 0))
    return i, j, low, high


def _bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 2: the K best lower bounds of the entries that reach the cutoff."""
    blocks, room = {}, {}
    for r, qid, q, _, v, own in _pairs(batches):
        qb = r["qb"].as_py()
        if qb not in blocks:
            blocks[qb] = qid.copy(), _known(r, qid), _Best(len(q))
        _, (least, cut, _), best = blocks[qb]
        i, _, low, _ = _collect(q, v, own, least, cut, room)
        best.add(i, low, np.zeros(len(i), np.int64))
    for qb, (ids, _, best) in blocks.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([qb] * len(ids), pa.int64()), pa.array(ids), pa.array(best.scores(), pa.list_(pa.int64()))],
            names=["qb", "query_id", "lows"])


def _resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Phase 3: exact scores of the candidates that can still be among the K best of their query."""
    blocks, room = {}, {}
    for r, qid, q, vid, v, own in _pairs(batches):
        qb = r["qb"].as_py()
        if qb not in blocks:
            blocks[qb] = qid.copy(), _known(r, qid), _Best(len(q)), np.zeros(len(q), np.int64)
        _, (least, cut, tau), best, resolved = blocks[qb]
        i, j, _, high = _collect(q, v, own, least, cut, room)
        left = np.flatnonzero(high >= tau[i])
        resolved += np.bincount(i[left], minlength=len(q))
        for lo in range(0, len(left), SCORED):
            a, b = i[left[lo:lo + SCORED]], j[left[lo:lo + SCORED]]
            best.add(a, np.einsum("ij,ij->i", q[a].astype(np.int64), v[b].astype(np.int64)), vid[b])
    for ids, _, best, resolved in blocks.values():
        i, n = np.nonzero(best.score > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids[i], best.id[i, n], best.score[i, n], resolved[i])],
                                         names=["query_id", "vec_id", "score", "n_resolved"])


def search(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the K best rows of each query row (``is_query`` is over ``vec_id``)."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = (vectors.select(F.col(vec_id).cast("long").alias("id"), is_query.alias("asks"),
                           F.col(vector).cast("array<double>").alias("v")).where(usable("id", "v")))
    large = saved(rows.where(_wide("v")), "topk-large")
    if large.limit(1).count():
        return _with_large(rows, large)
    return _narrow(rows, rows.where("asks").groupBy("id").agg(F.min("v").alias("v")))


def _narrow(rows: DataFrame, asked: DataFrame) -> DataFrame:
    """The K best of every query among vectors without a large integer."""
    spark = rows.sparkSession
    chunks = saved(rows.select("id", "v").mapInArrow(
        _pack(CHUNK, "ck"), "ck long, dim int, ck_ids binary, ck_rows binary"), "topk-chunks")
    blocks = saved(asked.mapInArrow(_pack(QUERIES, "qb"), "qb long, dim int, qb_ids binary, qb_rows binary"), "topk-queries")
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = chunks.withColumn("slot", F.pmod(F.xxhash64("ck"), F.lit(slots)).cast("int"))

    def meet(queries: DataFrame) -> DataFrame:
        """Every query block with every chunk of its vector length, slot by slot."""
        return held.join(_copies(queries, slots), ["dim", "slot"])

    def told(facts: DataFrame) -> DataFrame:
        """The query blocks with what is known of their queries (at most QUERIES rows a block)."""
        cuts = facts.groupBy("qb").agg(F.collect_list(F.struct("query_id", "least", "cut", "tau")).alias("cuts"))
        return blocks.join(cuts.hint("merge"), "qb")

    gathered = meet(blocks).select("dim", "qb", "qb_ids", "qb_rows", "ck_ids", "ck_rows").mapInArrow(
        _gather, "dim int, qb long, query_id long, least array<long>, scores array<long>")
    cut = saved(cutoffs(saved(gathered, "topk-lists")), "topk-cutoffs")
    both = ["dim", "qb", "qb_ids", "qb_rows", "ck_ids", "ck_rows", "cuts"]
    bounded = saved(meet(told(cut.withColumn("tau", F.col("tau1")))).select(both).mapInArrow(
        _bound, "qb long, query_id long, lows array<long>"), "topk-bounds")
    lows = bounded.select("qb", "query_id", F.explode("lows").alias("low"))
    nth = lows.withColumn("n", F.row_number().over(Window.partitionBy("qb", "query_id").orderBy(F.desc("low")))).where(F.col("n") == K)
    tau2 = saved(cut.join(nth.select("qb", "query_id", "low").hint("merge"), ["qb", "query_id"], "left").withColumn(
        "tau", F.greatest("low", "tau1")), "topk-taus")
    found = meet(told(tau2)).select(both).mapInArrow(_resolve, "query_id long, vec_id long, score long, n_resolved long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def _text_key(score: int) -> str:
    """A text that sorts as whole numbers of up to 9,999 digits do."""
    digits = str(abs(score))
    text = f"{len(digits):04d}{digits}"
    return "1" + text if score >= 0 else "0" + text.translate(str.maketrans("0123456789", "9876543210"))


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The K best of a block of candidates for every query of a block, in Python's integers."""
    def whole(raw: bytes, dim: int) -> np.ndarray:
        v = np.frombuffer(raw, "<f8").reshape(-1, dim)
        return np.array([[int(x) * SCALE if abs(x) >= 2.0 ** 53 else math.floor(x * SCALE) for x in r] for r in v.tolist()], dtype=object)

    for r in _rows(batches):
        qid, vid = np.frombuffer(r["qb_ids"], "<i8"), np.frombuffer(r["ck_ids"], "<i8")
        scores = whole(r["qb_rows"], r["dim"]) @ whole(r["ck_rows"], r["dim"]).T
        out = []
        for i, q in enumerate(qid.tolist()):
            best = sorted((-s, v) for s, v in zip(scores[i].tolist(), vid.tolist()) if v != q)[:K]
            out += [(q, v, -s if -(1 << 63) <= -s < 1 << 63 else None, _text_key(-s)) for s, v in best]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), pa.int64(), pa.string()])],
                                             names=["query_id", "vec_id", "score", "key"])


def _raw_blocks(vectors: DataFrame, name: str, rows: int) -> DataFrame:
    """(id, v) as blocks of vectors of one length: no, dim, ids, rows (doubles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 32, 0
        for b in batches:
            by: dict[int, list[int]] = {}
            vs, ids = b.column("v").to_pylist(), b.column("id").to_pylist()
            for i, v in enumerate(vs):
                by.setdefault(len(v), []).append(i)
            for dim, at in by.items():
                for lo in range(0, len(at), rows):
                    i = at[lo:lo + rows]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([base + n]), pa.array([dim], pa.int32()), pa.array([np.array([ids[x] for x in i], "<i8").tobytes()], pa.binary()),
                         pa.array([np.array([vs[x] for x in i], "<f8").tobytes()], pa.binary())], names=[name, "dim", f"{name}_ids", f"{name}_rows"])
                    n += 1
    return vectors.select("id", "v").mapInArrow(run, f"{name} long, dim int, {name}_ids binary, {name}_rows binary")


def _with_large(rows: DataFrame, large: DataFrame) -> DataFrame:
    """The K best of every query, where some vectors have large integers."""
    asked = saved(rows.where("asks").groupBy("id").agg(F.min("v").alias("v")), "topk-asked")
    small = rows.where(~_wide("v"))
    slots = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def scored(queries: DataFrame, candidates: DataFrame) -> DataFrame:
        """Blocks meet slot by slot; candidates stay spread out."""
        held = _raw_blocks(candidates, "ck", WIDE_ROWS).withColumn("slot", F.pmod(F.xxhash64("ck"), F.lit(slots)).cast("int"))
        asks = _copies(_raw_blocks(queries, "qb", WIDE_ROWS), slots)
        return held.join(asks, ["dim", "slot"]).select("dim", "qb_ids", "qb_rows", "ck_ids", "ck_rows").mapInArrow(
            _exact, "query_id long, vec_id long, score long, key string")

    text = F.abs(F.col("score").cast("decimal(20,0)")).cast("string")
    text = F.concat(F.lpad(F.length(text).cast("string"), 4, "0"), text)
    key = F.when(F.col("score") >= 0, F.concat(F.lit("1"), text)).otherwise(
        F.concat(F.lit("0"), F.translate(text, "0123456789", "9876543210")))
    found = (_narrow(small, asked.where(~_wide("v"))).select("query_id", "vec_id", "score", key.alias("key"))
             .unionByName(scored(asked, large)).unionByName(scored(asked.where(_wide("v")), small)))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("key"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def _copies(queries: DataFrame, slots: int) -> DataFrame:
    """The query blocks once for every slot; by its hint, a join with them shuffles (they are ``slots`` times what Spark takes them for)."""
    return queries.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1)))).hint("merge")
