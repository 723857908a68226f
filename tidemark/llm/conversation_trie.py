"""Operator 11. Prefix trie of conversations by union-find over the LCPs of sorted neighbours.

A turn becomes an item of 24 bytes: the MD5 of role and text, and the words of
the text. A conversation is the string of its items. All are sorted once
(range partitions by string and id, so copies of one conversation are spread)
and packed into blocks of at most BLOCK_BYTES, numbered in order.

Inside a block the longest common prefixes (LCP) of neighbours are edges, taken
in descending depth: a union closes the chains of both components down to that
depth, and the merged component is a branching node there. A component is an
interval of sorted rows, and what a node reports adds up over them:

* members: the rows; childless nodes: rows whose LCP with the next is less than
  their length; children: components merged at the node;
* saved tokens: with P(e) the words of a row's first e turns, the rows but the
  first add P(LCP with the row before), less P(depth - 1) for each of them.

A node is open if its interval reaches an end of the block and the LCP across
that boundary is as deep; all others are final. Open nodes are the prefixes of
the first and of the last row, so a block's forest contracts to at most as many
sums as these two rows have turns. They are merged across boundaries by the
MD5 of their path. A second pass tells each block the merged least members, for
parents that are open. Ids that end at an open node travel as one joined text a
block and are hashed in order by a stream that holds one such text.

The driver sees one number per range partition; nothing else is collected. No
task holds more than a block, whatever the conversations share. A conversation
is one row of 24 bytes a turn, texts stay behind at the first scan.

Edge cases: rows with a null id take no part; null role or text is empty; turns
are ordered by number (null first), equal numbers by digest; a conversation that
has no turns left belongs to the root; an empty table gives no rows; other columns are
ignored. Two different turns count as one if their MD5 agree (never seen by chance).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, saved

WORD = r"[^\x20\x09-\x0D]+"
ITEM = 24
BLOCK_BYTES, BLOCK_ROWS = 4 << 20, 1 << 14
NO_ENDS = hashlib.sha256(b"").hexdigest()
BLOCK = "part int, idx int, ids binary, sizes binary, keys binary, first binary, last binary"
OPEN = ("node binary, parent binary, depth long, number long, least long, n long, leaves long, children long, "
        "shared long, before long, ends binary")
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id, items (an array of hexadecimal items in the order of the turns)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    item = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")),
                    F.lpad(F.hex(F.regexp_count(text, F.lit(WORD)).cast("long")), 16, "0"))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"),
                  item.alias("item"))
    return (conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), at.alias("at"))
            .groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list("at")), lambda t: t["item"]).alias("items")))


def rebuilt(seqs: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c restarts with the first h turns of c - c % family, h = crc32(c) % most.

    The remainder has the sign of c, as in SQL; a base that is not in the table has no turns."""
    base = F.col("conv_id") - F.col("conv_id") % family
    heads = seqs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("items", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    none = F.array().cast("array<string>")
    return (seqs.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
            .select("conv_id", F.concat(F.slice(F.coalesce("head", none), F.lit(1), F.col("h")),
                                        F.slice("items", F.col("h") + 1, F.size("items"))).alias("items")))


def _pack(block_rows: int):
    """Sorted conversations as blocks of neighbours."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, idx, ids, keys, held = TaskContext.get().partitionId(), 0, [], [], 0

        def block() -> pa.RecordBatch:
            sizes = np.array([len(k) // ITEM for k in keys], np.int64)
            row = [part, idx, np.array(ids, np.int64).tobytes(), sizes.tobytes(), b"".join(keys), keys[0], keys[-1]]
            kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds)],
                                              names=["part", "idx", "ids", "sizes", "keys", "first", "last"])

        for b in batches:
            for conv, key in zip(b.column("conv_id").to_pylist(), b.column("key").to_pylist()):
                if ids and (held + len(key) > BLOCK_BYTES or len(ids) >= block_rows):
                    yield block()
                    idx, ids, keys, held = idx + 1, [], [], 0
                ids.append(conv)
                keys.append(key)
                held += len(key)
        if ids:
            yield block()
    return run


def common(a: bytes | None, b: bytes | None) -> int:
    """Items that two conversations share from the start; -1 if there is no neighbour."""
    if a is None or b is None:
        return -1
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // ITEM
    return int((np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)).argmax()) // ITEM


class Forest:
    """The nodes of one block as chains: rows lo..hi share the nodes of depths low + 1 .. birth.

    ``open`` is the greatest depth of a chain at which a neighbouring block has members too (-1: none)."""

    def __init__(self, r: dict):
        self.ids, self.size = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["sizes"], np.int64)
        m, at = len(self.ids), np.concatenate([[0], np.cumsum(self.size)])
        self.at, raw = at, r["keys"]
        self.key = [raw[ITEM * a:ITEM * b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        words = np.frombuffer(raw, ">u8").reshape(-1, 3)[:, 2].astype(np.int64)
        self.words = np.concatenate([[0], np.cumsum(words)])
        self.left, self.right = common(r["before"], r["first"]), common(r["last"], r["after"])
        lcp = np.array([self.left, *(common(a, b) for a, b in zip(self.key[:-1], self.key[1:]))], np.int64)
        shared = self.prefix_words(np.arange(m), np.maximum(lcp, 0))
        self.shared = np.concatenate([[0], np.cumsum(shared)])  # the first row's counts only across the boundary
        self.leaves = np.concatenate([[0], np.cumsum(np.append(lcp[1:], self.right) < self.size)])
        self._unite(lcp)

    def prefix_words(self, row: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return self.words[self.at[row] + depth] - self.words[self.at[row]]

    def _unite(self, lcp: np.ndarray) -> None:
        m = len(self.ids)
        root, lo, hi = list(range(m)), list(range(m)), list(range(m))
        birth, least, kids = self.size.tolist(), self.ids.tolist(), [0] * m
        below: list[list[int]] = [[] for _ in range(m)]  # chains that hang below a component's node
        chains: list[tuple[int, int, int, int, int, int]] = []
        parent: list[int] = []

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        def close(c: int, depth: int) -> list[int]:
            """The chain of component c ends above ``depth``; the chains that now hang below that depth."""
            if birth[c] == depth:
                return below[c]
            chains.append((lo[c], hi[c], depth, birth[c], least[c], kids[c]))
            parent.append(-1)
            for x in below[c]:
                parent[x] = len(chains) - 1
            return [len(chains) - 1]

        for k in sorted(range(1, m), key=lambda k: -lcp[k]):
            a, b, depth = find(k - 1), find(k), int(lcp[k])
            hang = close(a, depth)
            more = close(b, depth)
            if len(hang) < len(more):
                hang, more = more, hang
            hang.extend(more)
            kids[a] = (kids[a] if birth[a] == depth else 1) + (kids[b] if birth[b] == depth else 1)
            root[b], hi[a], birth[a], least[a], below[a] = a, hi[b], depth, min(least[a], least[b]), hang
        close(find(0), -1)
        self.lo, self.hi, self.low, self.birth, self.least, self.kids = (np.array(c, np.int64) for c in zip(*chains))
        self.parent = np.array(parent, np.int64)
        self.open = np.maximum(np.where(self.lo == 0, self.left, -1), np.where(self.hi == m - 1, self.right, -1))

    def ends(self, chain: int) -> bytes:
        """Ids of the rows that end at the chain's deepest node, joined; they are its first rows."""
        lo, hi, depth = int(self.lo[chain]), int(self.hi[chain]), self.birth[chain]
        n = int(np.searchsorted(self.size[lo:hi + 1] > depth, True)) if self.size[lo] == depth else 0
        return ",".join(map(str, self.ids[lo:lo + n].tolist())).encode()

    def nodes(self, is_open: bool) -> tuple[np.ndarray, np.ndarray]:
        """(chain, depth) of the open or the closed nodes."""
        top = np.minimum(self.open, self.birth)
        first, last = (self.low + 1, top) if is_open else (np.maximum(self.low, top) + 1, self.birth)
        n = np.maximum(last - first + 1, 0)
        chain = np.repeat(np.arange(len(n)), n)
        return chain, np.arange(len(chain)) - np.repeat(np.cumsum(n) - n, n) + first[chain]

    def sums(self, chain: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, ...]:
        """(members, childless nodes, children, shared words, words before) of nodes, as far as this block has them."""
        lo, hi = self.lo[chain], self.hi[chain]
        entered = (lo == 0) & (self.left >= depth)  # the interval goes on before the block
        shared = self.shared[hi + 1] - self.shared[lo + 1] + np.where(entered, self.shared[1], 0)
        known = (lo == 0) & (self.left > depth)     # so does that of its first child
        children = np.where(depth == self.birth[chain], self.kids[chain], 1) - known
        return (hi - lo + 1, self.leaves[hi + 1] - self.leaves[lo], children, shared,
                self.prefix_words(lo, np.maximum(depth - 1, 0)))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for b in batches:
        for i in range(b.num_rows):
            yield {c: b.column(c)[i].as_py() for c in b.schema.names}


def _paths(key: bytes, depths: range) -> dict[int, bytes]:
    """The MD5 of the first d items, for each depth d."""
    h, out = hashlib.md5(key[:ITEM * max(depths.start, 0)]), {-1: None}
    for d in depths:
        if d > max(depths.start, 0):
            h.update(key[ITEM * (d - 1):ITEM * d])
        if d >= 0:
            out[d] = h.copy().digest()
    return out


def _opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First pass: the open nodes of every block with the block's part of their sums."""
    for r in _rows(batches):
        f = Forest(r)
        chain, depth = f.nodes(True)
        node, parent, ends = [], [], []
        for c in dict.fromkeys(chain.tolist()):
            paths = _paths(f.key[f.lo[c]], range(int(f.low[c]), int(min(f.open[c], f.birth[c])) + 1))
            for d in depth[chain == c].tolist():
                node.append(paths[d])
                parent.append(paths[d - 1])
                ends.append((f.ends(c) or None) if d == f.birth[c] else None)
        n, leaves, children, shared, before = f.sums(chain, depth)
        columns = [pa.array(node, pa.binary()), pa.array(parent, pa.binary()), depth, np.full(len(depth), r["number"], np.int64),
                   f.least[chain], n, leaves, children, shared, before, pa.array(ends, pa.binary())]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in OPEN.split(", ")])


def _closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Second pass: the closed nodes, with the merged least members of open parents."""
    for r in _rows(batches):
        f = Forest(r)
        told = {t["path"]: t["least"] for t in r["opened"] or []}
        left, right = _paths(f.key[0], range(f.left + 1)), _paths(f.key[-1], range(f.right + 1))
        chain, depth = f.nodes(False)
        n, leaves, children, shared, before = f.sums(chain, depth)
        above = np.where(depth - 1 > f.low[chain], chain, f.parent[chain])  # the parent's chain
        parent = []
        for a, d in zip(above.tolist(), (depth - 1).tolist()):
            if d < 0:
                parent.append(None)
            elif d > f.open[a]:
                parent.append(int(f.least[a]))
            else:
                parent.append(told[left[d] if f.lo[a] == 0 and d <= f.left else right[d]])
        ends = [hashlib.sha256(f.ends(c)).hexdigest() if d == f.birth[c] else NO_ENDS for c, d in zip(chain.tolist(), depth.tolist())]
        columns = [f.least[chain], depth, pa.array(parent, pa.int64()), n, children, leaves, shared - (n - 1) * before,
                   pa.array(ends, pa.string())]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in NODE.split(", ")])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of a node's pieces, which come in order; one piece is held at a time."""
    node, h = None, None

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([h.hexdigest()])], names=["node", "sha"])

    for b in batches:
        for i in range(b.num_rows):
            this, piece = b.column("node")[i].as_py(), b.column("ends")[i].as_py()
            if this == node:
                h.update(b",")
            else:
                if h is not None:
                    yield out()
                node, h = this, hashlib.sha256()
            h.update(piece)
    if h is not None:
        yield out()


def nodes(seqs: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The nodes (NODE) of the trie of ``seqs`` (conv_id, items as of ``sequences``)."""
    spark = seqs.sparkSession
    prepare(spark)
    key = F.unhex(F.array_join("items", "")).alias("key")
    packed = saved(seqs.select("conv_id", key).repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
                   .mapInArrow(_pack(block_rows), BLOCK), "trie-blocks")
    parts = sorted((r[0], r[1]) for r in packed.groupBy("part").agg(F.count("*")).collect())  # one row a range partition
    starts = [(p, s) for (p, _), s in zip(parts, accumulate((n for _, n in parts), initial=0))]
    starts = spark.createDataFrame(starts, "part int, start long")
    numbered = packed.join(F.broadcast(starts), "part").withColumn("number", F.col("start") + F.col("idx")).drop("part", "idx", "start")
    before = numbered.select((F.col("number") + 1).alias("number"), F.col("last").alias("before"))
    after = numbered.select((F.col("number") - 1).alias("number"), F.col("first").alias("after"))
    near = saved(numbered.join(before, "number", "left").join(after, "number", "left"), "trie-near")

    opened = saved(near.mapInArrow(_opened, OPEN), "trie-open")
    merged = opened.groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.min("least").alias("least"), F.sum("n").alias("n"),
        F.sum("leaves").alias("leaves"), F.sum("children").alias("children"), F.sum("shared").alias("shared"),
        F.max("before").alias("before"))
    merged = saved(merged, "trie-merged")
    told = (opened.select("node", "number").join(merged.select("node", "least"), "node")
            .groupBy("number").agg(F.collect_list(F.struct(F.col("node").alias("path"), "least")).alias("opened")))
    closed = near.join(told, "number", "left").mapInArrow(_closed, NODE)
    sha = (opened.where("ends is not null").select("node", "number", "ends").repartition("node")
           .sortWithinPartitions("node", "number").mapInArrow(_hashed, "node binary, sha string"))
    parents = merged.select(F.col("node").alias("parent"), F.col("least").alias("parent_conv_id"))
    whole = (merged.join(parents, "parent", "left").join(sha, "node", "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"), (F.col("shared") - (F.col("n") - 1) * F.col("before")).alias("saved_tokens"),
        F.coalesce("sha", F.lit(NO_ENDS)).alias("ends_sha256")))
    return closed.unionByName(whole)


def trie(conversations: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """The nodes of the trie of the rebuilt conversations."""
    prepare(conversations.sparkSession)
    return nodes(rebuilt(saved(sequences(conversations), "trie-turns"), family, most))
