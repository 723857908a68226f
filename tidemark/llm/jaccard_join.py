"""Operator 9. N-gram Jaccard join with Bayesian candidate pruning.

Documents link if the Jaccard similarity of their word-shingle sets is at least
the threshold (0.8 of 5-word shingles). The steps:

1. One pass over the whole texts gives each a MinHash signature (BANDS x ROWS
   values of 16 bits). Texts that are equal become one representative with a
   weight, so copies are never paired with each other.
2. Representatives that agree in all ROWS values of a band are candidates: at
   similarity 0.8 a pair is missed with a chance of (1 - 0.8**4)**32, 4e-8.
   Inside a bucket candidates are compared MinHash value by value, LOOK at a
   time: with a uniform prior the posterior chance that the similarity reaches
   the threshold after m of n agreements is P(Bin(n + 1, t) <= m); the pair is
   dropped as soon as it falls under TOLERANCE. A bucket yields a spanning
   forest of what survives, never its pairs.
3. Connected components of those forests are groups that no link leaves. Each
   text of a group is read once more and becomes its size and its difference: the
   shingles that it does not share with the text that leads the group. Since
   A ^ B = (A ^ L) ^ (B ^ L) for any L, sizes and differences give the exact
   similarity of two texts. In a group all pairs are pruned in the same way as in
   2 and the rest are verified exactly. A task returns link counts and a spanning
   forest of the verified links.
4. Components of the verified links are the classes.

Buckets over BLOCK members are dealt out as pairs of blocks. Groups over BLOCK
members (or BLOCK_SHINGLES shingles) make their differences in several tasks, each
with a copy of the leading text, and are then cut into length bands, of which only
neighbours can link, and bands into blocks of PAIR_BLOCK members that meet in
pairs. What is copied to the pairs is signatures and differences, never texts. So
no task holds a whole hot group and no link is lost; nothing is capped.

Texts are told apart by two 64-bit hashes. Nodes have 64 bits: a text whose first
hash another text has too (some three pairs among 10**10 texts) gets another node.

Edge cases: a null or blank text has no shingles, is in a class of its own and
has no link; a text of 1 to 4 words is one shingle; null and repeated ids are
fine (rows are matched by text, the class id is the least id of the class, null
if it has none); an empty table gives an empty result; other columns of the
input do not reach the join.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import broadcast_if_small
from .common import prepare, released, saved, text_buffer
from .components import components
from .shingles import minhashes, shingle_sets

WORDS, THRESHOLD = 5, Fraction(4, 5)
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
LOOK, TOLERANCE = 16, 1e-8
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
#: Members of a block of a group too large for one task: a pair of blocks is one task.
PAIR_BLOCK = 2048


def least_matches(threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE) -> dict[int, int]:
    """For each number n of compared values the least agreements with a posterior of at least ``tolerance``."""
    t, out = float(threshold), {}
    for n in range(LOOK, HASHES + 1, LOOK):
        below = 0.0
        for m in range(n + 1):
            below += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
            if below >= tolerance:
                out[n] = m
                break
    return out


def survivors(one: np.ndarray, many: np.ndarray, least: dict[int, int]) -> np.ndarray:
    """Rows of ``many`` that the incremental comparison with ``one`` does not drop."""
    alive, seen = np.arange(len(many)), np.zeros(len(many), np.int32)
    for n, m in least.items():
        seen = seen + (many[alive, n - LOOK:n] == one[n - LOOK:n]).sum(1, dtype=np.int32)
        keep = seen >= m
        alive, seen = alive[keep], seen[keep]
        if not len(alive):
            break
    return alive


def forest(sigs: np.ndarray, side: np.ndarray, crossed: bool, least: dict[int, int]) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the surviving pairs (``crossed``: of rows with different sides)."""
    edges = []
    free = np.ones(len(sigs), bool)
    for root in range(len(sigs)):
        if not free[root]:
            continue
        free[root], todo = False, [root]
        while todo:
            a = todo.pop()
            others = np.flatnonzero(free & (side != side[a])) if crossed else np.flatnonzero(free)
            if not len(others):
                continue
            hit = others[survivors(sigs[a], sigs[others], least)]
            free[hit] = False
            todo.extend(hit.tolist())
            edges.extend((a, int(b)) for b in hit)
    return edges


# ------------------------------------------------------------------ signatures

def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, at = text_buffer(b.column("text"))
        sigs, sizes = np.zeros((b.num_rows, HASHES), np.uint16), np.zeros(b.num_rows, np.int64)
        for i, s in enumerate(shingle_sets(raw, at, WORDS)):
            sizes[i] = len(s)
            if len(s):
                sigs[i] = minhashes(s, HASHES)
        bands = sigs.view(np.int64)  # ROWS values of 16 bits are one 64-bit band
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("hash"), b.column("hash2"), pa.array(sizes),
             pa.ListArray.from_arrays(pa.array(np.arange(0, bands.size + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel()))],
            names=["doc_id", "hash", "hash2", "n_shingles", "sig"])


TEXT = ["hash", "hash2"]


def text_ids(text: Column) -> dict[str, Column]:
    """Two independent 64-bit hashes, which together are the identity of a text."""
    whole = F.coalesce(text, F.lit(""))
    return {"hash": F.xxhash64(whole), "hash2": F.xxhash64(F.lit(20231), whole, F.length(whole), F.crc32(whole.cast("binary")))}


def _narrow(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select(
        "doc_id", "text", *(c.alias(n) for n, c in text_ids(F.col("text")).items()))


def with_node(texts: DataFrame) -> DataFrame:
    """``texts`` (one row of each) with ``rid``, their 64-bit node: the first hash, or another one where that is taken."""
    taken = F.row_number().over(Window.partitionBy("hash").orderBy("hash2")) > 1
    return texts.withColumn("rid", F.when(taken, F.xxhash64("hash2", "hash")).otherwise(F.col("hash")))


# ------------------------------------------------------------------ blocks

def blocked(members: DataFrame, key: list[str]) -> DataFrame:
    """Deal each member to the block pairs of its group (column ``k``: number of blocks).

    One block: one row. k blocks: each member goes to the k pairs that hold its
    block; ``side`` tells the two blocks of a pair apart."""
    own = F.when(F.col("k") > 1, F.pmod(F.xxhash64("rid", F.lit(5)), F.col("k"))).otherwise(F.lit(0)).cast("int")
    dealt = (members.withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), (F.col("k") - 1).cast("int"))))
             .withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other")})
             .withColumn("side", (F.col("own") == F.col("bj")).cast("int") * (F.col("bi") != F.col("bj")).cast("int"))
             .drop("own", "other", "k"))
    keys = [*key, "bi", "bj"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys)


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups with the group starts (rows come sorted by ``keys``)."""
    kept: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        if kept and _same(kept[-1], b, keys):  # no group ends in this batch
            kept.append(b)
            continue
        t = pa.Table.from_batches([*kept, b])
        starts = _starts(t, keys)
        kept = [x for x in t.slice(starts[-1]).to_batches() if x.num_rows]
        if starts[-1]:
            yield t.slice(0, starts[-1]), np.append(starts[:-1], starts[-1])
    if kept:
        t = pa.Table.from_batches(kept)
        yield t, np.append(_starts(t, keys), t.num_rows)


def _same(a: pa.RecordBatch, b: pa.RecordBatch, keys: list[str]) -> bool:
    return all(a.column(k)[0] == b.column(k)[b.num_rows - 1] for k in keys)


def _starts(t: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        v = t.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint16).reshape(-1, HASHES)


# ------------------------------------------------------------------ candidates

BUCKET = ["band", "key", "bi", "bj"]


def _bucket_forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    least = least_matches()
    for t, starts in _groups(batches, BUCKET):
        rid, side, sigs = t.column("rid").to_numpy(), t.column("side").to_numpy(), _signatures(t.column("sig"))
        crossed = t.column("bi").to_numpy() != t.column("bj").to_numpy()
        a, b = [], []
        size = np.diff(starts)
        two = starts[:-1][size == 2]
        if len(two):  # most buckets: all compared at once
            ok, seen = ~crossed[two] | (side[two] != side[two + 1]), np.zeros(len(two), np.int32)
            for n, m in least.items():
                seen += (sigs[two, n - LOOK:n] == sigs[two + 1, n - LOOK:n]).sum(1, dtype=np.int32)
                ok &= seen >= m
            a.append(rid[two[ok]])
            b.append(rid[two[ok] + 1])
        for lo, n in zip(starts[:-1][size > 2], size[size > 2]):
            e = np.array(forest(sigs[lo:lo + n], side[lo:lo + n], bool(crossed[lo]), least), np.int64).reshape(-1, 2) + lo
            a.append(rid[e[:, 0]])
            b.append(rid[e[:, 1]])
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def candidate_edges(reps: DataFrame) -> DataFrame:
    """Spanning forests (a, b) of the surviving pairs of each bucket."""
    light = reps.select("rid", F.posexplode("sig").alias("band", "key"))
    shared = light.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = (light.join(shared, ["band", "key"]).join(reps.select("rid", "sig"), "rid")
            .select("band", "key", "rid", "sig", F.ceil(F.col("n") / BLOCK).cast("int").alias("k")))
    return blocked(rows, ["band", "key"]).mapInArrow(released(_bucket_forests), "a long, b long")


# ------------------------------------------------------------------ exact links

PART, GROUP = ["component", "part"], ["component", "bi", "bj"]


def band_edges(threshold: Fraction = THRESHOLD, most: int = 1 << 40) -> np.ndarray:
    """First size of each length band; texts that link are of one band or of neighbours.

    A size s links up to floor(s / threshold); with edges e' = floor(e / threshold) + 1 that of a size
    under e' is under the edge after it."""
    edges = [1]
    while edges[-1] < most:
        edges.append(edges[-1] * threshold.denominator // threshold.numerator + 1)
    return np.array(edges, np.int64)


def link_counts(deltas: list[np.ndarray], size: np.ndarray, sigs: np.ndarray, side: np.ndarray, crossed: bool,
                weight: np.ndarray, least: dict[int, int]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Exact links of a group: summed partner weights of each row, and a spanning forest.

    ``deltas``: the symmetric difference of each set with one set, the same for all; ``size``: sizes of the sets.
    ``crossed`` (two different blocks): only rows with different sides are compared, and
    none if one of the blocks is empty; pairs inside a block are those of its own group."""
    n = len(deltas)
    vocabulary, ids = np.unique(np.concatenate(deltas), return_inverse=True)
    differ = np.array([len(d) for d in deltas])
    starts = np.cumsum(differ) - differ
    mark = np.zeros(len(vocabulary), bool)
    links, root, edges = np.zeros(n, np.int64), np.arange(n), []
    num, den = THRESHOLD.numerator, THRESHOLD.denominator
    for a in range(n - 1):
        rest = np.arange(a + 1, n)
        rest = rest[(np.minimum(size[rest], size[a]) * den >= num * np.maximum(size[rest], size[a]))]
        if crossed:
            rest = rest[side[rest] != side[a]]
        if not len(rest):
            continue
        rest = rest[survivors(sigs[a], sigs[rest], least)]
        if not len(rest):
            continue
        own = ids[starts[a]:starts[a] + differ[a]]
        mark[own] = True
        ends = np.cumsum(differ[rest])
        where = np.repeat(starts[rest] - (ends - differ[rest]), differ[rest]) + np.arange(ends[-1])
        before = np.concatenate([[0], np.cumsum(mark[ids[where]])])
        both = before[ends] - before[ends - differ[rest]]
        mark[own] = False
        total = size[rest] + size[a]
        inter = (total - (differ[rest] + differ[a] - 2 * both)) // 2
        hit = rest[inter * den >= num * (total - inter)]
        links[a] += weight[hit].sum()
        links[hit] += weight[a]
        new = hit[root[hit] != root[a]]
        if len(new):
            roots, first = np.unique(root[new], return_index=True)
            edges.extend((a, int(b)) for b in new[first])
            root[np.isin(root, roots)] = root[a]
    return links, edges


LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])
MEMBERS = pa.schema([*LINKS, ("component", pa.int64()), ("weight", pa.int64()), ("sig", pa.list_(pa.int64())),
                     ("size", pa.int64()), ("band", pa.int32()), ("delta", pa.list_(pa.int64()))])
LINKS_SQL = "a long, b long, links long"
MEMBERS_SQL = LINKS_SQL + ", component long, weight long, sig array<long>, size long, band int, delta array<long>"


def _batch(columns: dict, n: int, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type)
                                       for f in schema], schema=schema)


def _found(rid: np.ndarray, links: np.ndarray, edges: list[tuple[int, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (a, null, links) of the counts and (a, b, 0) of the forest."""
    yield _batch({"a": rid, "links": links}, len(rid), schema)
    if edges:
        e = np.array(edges, np.int64)
        yield _batch({"a": rid[e[:, 0]], "b": rid[e[:, 1]], "links": np.zeros(len(e), np.int64)}, len(e), schema)


def _each(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups one by one, rows that are repeated (of one rid) once, in their order."""
    for t, starts in _groups(batches, keys):
        for lo, hi in zip(starts[:-1], starts[1:]):
            g = t.slice(lo, hi - lo)
            _, first = np.unique(g.column("rid").to_numpy(), return_index=True)
            yield g.take(pa.array(np.sort(first))) if len(first) < g.num_rows else g


def _part_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of the groups that are whole in a part; members with their differences of the others."""
    least, edges_of = least_matches(), band_edges()
    for g in _each(batches, PART):
        sets = list(shingle_sets(*text_buffer(g.column("text").combine_chunks()), WORDS))
        lead = sets[0]  # the leading text comes first
        own = np.flatnonzero(~g.column("guest").to_numpy())
        deltas = [np.setxor1d(sets[i], lead, assume_unique=True) for i in own]
        size = np.array([len(sets[i]) for i in own], np.int64)
        members = g.take(pa.array(own))
        if not members.num_rows:
            continue
        rid, weight, sig = members.column("rid").to_numpy(), members.column("weight").to_numpy(), members.column("sig")
        if g.column("k")[0].as_py() == 1:
            side = np.zeros(len(rid), np.int32)
            yield from _found(rid, *link_counts(deltas, size, _signatures(sig), side, False, weight, least), MEMBERS)
            continue
        at = np.concatenate([[0], np.cumsum([len(d) for d in deltas])]).astype(np.int32)
        columns = {"a": rid, "component": members.column("component").to_numpy(), "weight": weight, "size": size,
                   "band": (np.searchsorted(edges_of, size, side="right") - 1).astype(np.int32)}
        out = {f.name: pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(len(rid), f.type) for f in MEMBERS}
        out["sig"] = sig.combine_chunks().cast(MEMBERS.field("sig").type)
        out["delta"] = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(deltas).view(np.int64))).cast(
            MEMBERS.field("delta").type)
        yield pa.RecordBatch.from_arrays([out[f.name] for f in MEMBERS], schema=MEMBERS)


def _pair_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair of blocks."""
    least = least_matches()
    for g in _each(batches, GROUP):
        side, crossed = g.column("side").to_numpy(), g.column("bi")[0] != g.column("bj")[0]
        if g.num_rows < 2 or crossed and len(np.unique(side)) < 2:
            continue
        delta = g.column("delta").combine_chunks()
        at, values = delta.offsets.to_numpy(), delta.values.to_numpy(zero_copy_only=False).astype(np.int64)
        deltas = [values[lo:hi] for lo, hi in zip(at[:-1], at[1:])]
        yield from _found(g.column("rid").to_numpy(), *link_counts(
            deltas, g.column("size").to_numpy(), _signatures(g.column("sig")), side, crossed,
            g.column("weight").to_numpy(), least), LINKS)


def parts(members: DataFrame) -> DataFrame:
    """Members dealt to the ``k`` parts of their group, the leading text (a ``guest`` but in its own) to all of them, first."""
    own = F.pmod(F.xxhash64("rid", F.lit(5)), F.col("k")).cast("int")
    leads = F.col("rid") == F.col("component")
    dealt = (members.withColumn("part", F.explode(F.when(leads, F.sequence(F.lit(0), F.col("k") - 1)).otherwise(F.array(own))))
             .withColumn("guest", leads & (F.col("part") != own)))
    return dealt.repartition(*PART).sortWithinPartitions(*PART, (~leads).cast("int"))


def band_pairs(members: DataFrame) -> DataFrame:
    """Members dealt to the pairs of blocks (bi, bj) of their own and the neighbouring length bands.

    A block is its band and a number under the band's count of blocks. ``side`` tells the two blocks of a pair apart."""
    bands = members.groupBy("component", "band").agg(F.greatest(
        F.ceil(F.count("*") / PAIR_BLOCK), F.ceil(F.sum(F.size("delta")) / BLOCK_SHINGLES), F.lit(1)).cast("long").alias("n"))
    near = (bands.select("component", "band", "n", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("of"))
            .groupBy("component", F.col("of").alias("band"))
            .agg(F.collect_list(F.struct("band", "n")).alias("near"), F.max(F.when(F.col("of") == F.col("band"), F.col("n"))).alias("n")))
    near = broadcast_if_small(saved(near.where("n is not null"), "bands"))
    own = F.shiftleft(F.col("band").cast("long"), 32) + F.pmod(F.xxhash64("rid", F.lit(7)), F.col("n"))
    others = F.flatten(F.transform("near", lambda x: F.transform(
        F.sequence(F.lit(0).cast("long"), x["n"] - 1), lambda i: F.shiftleft(x["band"].cast("long"), 32) + i)))
    dealt = (members.join(near, ["component", "band"]).withColumn("own", own).withColumn("other", F.explode(others))
             .withColumns({"bi": F.least("own", "other"), "bj": F.greatest("own", "other")})
             .withColumn("side", ((F.col("own") == F.col("bj")) & (F.col("bi") != F.col("bj"))).cast("int"))
             .select(*GROUP, "side", "rid", "weight", "sig", "size", "delta"))
    return dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)


def classes_of(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, hash, hash2 and n_shingles of every row; hash, hash2, rid, class_id, n_links and leader of every text that is not blank.

    The leader is the text (rid) that stands for its class: that of the least id, of several the least rid."""
    prepare(docs.sparkSession)
    narrow = _narrow(docs)
    signed = saved(narrow.mapInArrow(released(_sign), "doc_id long, hash long, hash2 long, n_shingles long, sig array<long>"), "minhash")
    reps = saved(with_node(signed.where("n_shingles > 0").groupBy(*TEXT).agg(
        F.count("*").alias("weight"), F.min("doc_id").alias("first_id"), F.min("n_shingles").alias("n_shingles"),
        F.min("sig").alias("sig"))), "texts")
    group = saved(components(candidate_edges(reps), "candidates"), "groups")
    info = group.join(reps, group.node == reps.rid).drop("node")
    blocks = info.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int").alias("k"))
    held = info.join(blocks, "component").select("component", *TEXT, "rid", "first_id", "weight", "sig", "k")
    texts = narrow.join(held, [narrow[c] == held[c] for c in TEXT] + [narrow.doc_id.eqNullSafe(held.first_id)]).select(
        "component", "rid", "weight", "sig", "k", "text")
    parted = saved(parts(texts).mapInArrow(released(_part_links), MEMBERS_SQL), "parts")
    members = parted.where("component is not null").drop("b", "links").withColumnRenamed("a", "rid")
    paired = saved(band_pairs(members).mapInArrow(released(_pair_links), LINKS_SQL), "links")
    links = parted.where("component is null").select("a", "b", "links").unionAll(paired)
    classes = components(links.where("b is not null").select("a", "b"), "classes")
    counts = links.where("b is null").groupBy(F.col("a").alias("rid")).agg(F.sum("links").alias("links"))
    member = reps.select("rid", *TEXT, "weight", F.col("first_id").alias("doc_id")).join(
        classes.withColumnRenamed("node", "rid"), "rid", "left").join(counts, "rid", "left").withColumn(
        "component", F.coalesce("component", "rid"))
    least_id = member.groupBy("component").agg(
        F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid"))["rid"].alias("leader"))
    return signed, saved(member.join(least_id, "component").select(
        *TEXT, "rid", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "leader"), "classes")


def join(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links (long).

    ``n_links`` counts the other rows, copies included, at or over the threshold."""
    signed, per_text = classes_of(docs)
    rows = signed.where("n_shingles > 0").select("doc_id", *TEXT)
    return (rows.join(per_text, TEXT).select("doc_id", "class_id", "n_links")
            .unionAll(signed.where("n_shingles = 0").select("doc_id", F.col("doc_id").alias("class_id"),
                                                            F.lit(0).cast("long").alias("n_links"))))


_HELPERS = {c: f"__join_{c}" for c in TEXT}


def keep_rows(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class: one of the rows with the least id among those of its leader text.

    Rows are matched by text, so ids may be null or repeated. Blank texts are
    classes of their own and all stay (repeated rows of one id: one of them).
    Columns are those of ``docs``."""
    signed, per_text = classes_of(docs)
    blank = signed.where("n_shingles = 0")
    heads = per_text.where("rid = leader").select(*TEXT, F.col("class_id").alias("__join_id"), F.lit(False).alias("__join_blank"))
    heads = heads.unionAll(blank.where("doc_id is not null").select(*TEXT, "doc_id", F.lit(True)).distinct())
    heads = heads.withColumnsRenamed(_HELPERS)
    own = docs.withColumns({"__join_own": F.col("doc_id").cast("long"),
                            **{_HELPERS[n]: c for n, c in text_ids(F.col("text").cast("string")).items()}})
    found = own.join(heads, [own[c] == heads[c] for c in _HELPERS.values()] + [own["__join_own"].eqNullSafe(heads["__join_id"])])
    once = found.select(*(own[c] for c in docs.columns), *(
        F.when(~F.col("__join_blank"), own[c]).alias(c) for c in _HELPERS.values()),
        F.when(F.col("__join_blank"), own["__join_own"]).alias("__join_own")).dropDuplicates([*_HELPERS.values(), "__join_own"])
    nameless = blank.where("doc_id is null").select(*TEXT).distinct().withColumnsRenamed(_HELPERS)
    rest = own.where("__join_own is null").join(nameless, list(_HELPERS.values()), "left_semi")
    return once.select(*docs.columns).unionAll(rest.select(*docs.columns))
