"""Operator 13. Uniform shuffle into shards of exact sizes through a hypergeometric communication matrix.

The stored table is cut into blocks of BLOCK_ROWS consecutive rows of a file;
every shard is cut into cells of about CELL_ROWS slots. How many rows of block b
go to cell c is one entry of a random matrix with the blocks' and the cells'
sizes as margins. Entries are drawn as for a uniform permutation: a binary tree
over the blocks splits the cells' places between the blocks to the left and to
the right, with hypergeometric draws (themselves split along a binary tree over
the cells). Every draw is seeded by its tree node, so each task draws the rows of
its own blocks alone, and all tasks agree: no matrix is collected or sent.

1. Permute locally: a block's rows get ranks by a permutation seeded by the block.
2. Exchange: the first entries' worth of ranks goes to cell 0, and so on.
3. Permute again: a cell's rows are ordered by a hash seeded by block and rank;
   their row number, plus the slots before the cell, is the slot.

Shard sizes differ by one at most (law ``rows``). Work, memory and the exchange
are linear in the rows; a cell is the most that one task sorts, whatever the
texts repeat. A lost task gives the same rows again: blocks are told by file and
row number, not by how a scan is split. The driver sees one count per file.

Edge cases: nulls anywhere, empty texts, repeated rows and ids are rows like any
other; an empty table gives no rows; fewer rows than shards leave the last shards
empty. Columns of the input are kept; results start with ``__shard_``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix64, prepare, saved

SHARDS, SEED = 8, 13
BLOCK_ROWS = CELL_ROWS = 1 << 15
#: The generator's hypergeometric draws are exact for populations below this; larger ones are drawn by ``_large``.
POPULATION = 10 ** 9
#: What goes out to every executor: 16 bytes a file, 8 a block and a cell. Blocks and cells grow with tables of more
#: than MOST of them, and a table of more FILES is first written as fewer: 64 MB at most.
MOST = FILES = 1 << 20


def cells(rows: int, shards: int, cell_rows: int = CELL_ROWS) -> tuple[list[int], list[int], np.ndarray]:
    """(rows of every shard, cells of every shard, rows of every cell): as even as can be."""
    sizes = [rows // shards + (j < rows % shards) for j in range(shards)]
    parts = [max(1, -(-n // cell_rows)) for n in sizes]
    return sizes, parts, np.concatenate([n // p + (np.arange(p) < n % p) for n, p in zip(sizes, parts)]).astype(np.int64)


def _large(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """A hypergeometric draw from a population of any size: inversion outwards from the mode.

    Weights relative to the mode come from exact ratios of neighbouring terms, so no
    factorial of a large number is rounded; terms under 1e-18 of the mode are left out."""
    lo, hi = max(0, draws - bad), min(draws, good)
    if lo == hi:
        return lo
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), lo), hi)
    mean = draws / (good + bad)
    span = int(10 * np.sqrt(max(good * mean * (1 - mean), 1))) + 40

    def side(sign: int, end: int) -> np.ndarray:
        k = np.arange(1, min(span, abs(end - mode)) + 1, dtype=np.float64)
        if sign > 0:
            ratio = (good - mode - k + 1) * (draws - mode - k + 1) / ((mode + k) * (bad - draws + mode + k))
        else:
            ratio = (mode - k + 1) * (bad - draws + mode - k + 1) / ((good - mode + k) * (draws - mode + k))
        return np.exp(np.cumsum(np.log(ratio)))

    up, down = side(1, hi), side(-1, lo)
    weight = np.concatenate([down[::-1], [1.0], up])
    at = np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right")
    return mode - len(down) + min(int(at), len(weight) - 1)


def split(places: np.ndarray, draws: int, rng: np.random.Generator) -> np.ndarray:
    """How many of each kind are among ``draws`` of all ``places`` (counts per kind), without replacement.

    Halves of the kinds get their share first, then each half's halves: one vectorised draw a level."""
    width = 1 << max(0, len(places) - 1).bit_length()
    totals = [np.concatenate([places, np.zeros(width - len(places), np.int64)])]
    while len(totals[-1]) > 1:
        totals.append(totals[-1].reshape(-1, 2).sum(axis=1))
    got = np.array([draws], np.int64)
    for level in totals[-2::-1]:
        left, right = level[0::2], level[1::2]
        big = left + right >= POPULATION
        first = np.zeros(len(left), np.int64)
        first[~big] = rng.hypergeometric(left[~big], right[~big], got[~big])
        for i in np.flatnonzero(big):
            first[i] = _large(rng, int(left[i]), int(right[i]), int(got[i]))
        got = np.stack([first, got - first], axis=1).ravel()
    return got[:len(places)]


class Matrix:
    """Rows of the communication matrix, drawn when asked for."""

    def __init__(self, starts: np.ndarray, places: np.ndarray, seed: int):
        self.starts, self.places, self.seed, self.path = starts, places, seed, []

    def row(self, block: int) -> np.ndarray:
        """Rows of ``block`` for every cell. The last path from the root is kept: neighbours share most of it."""
        lo, hi, counts, depth = 0, len(self.starts) - 1, self.places, 0
        while hi - lo > 1:
            mid = (lo + hi) // 2
            if len(self.path) <= depth or self.path[depth][:2] != (lo, hi):
                rng = np.random.default_rng([self.seed, 1, lo, hi])
                left = split(counts, int(self.starts[mid] - self.starts[lo]), rng)
                self.path[depth:] = [(lo, hi, left, counts - left)]
            _, _, left, right = self.path[depth]
            lo, hi, counts = (lo, mid, left) if block < mid else (mid, hi, right)
            depth += 1
        return counts


def _stored(docs: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """A stored table of the rows, and (hash of the name, rows) of its files in the order of the hashes.

    A frame that is a stored table already is read in place; any other is written once."""
    def files(table: DataFrame) -> list:
        f = F.col("_metadata.file_path")
        found = table.select(f.alias("f")).groupBy(F.xxhash64("f").alias("h")).agg(
            F.count("*").alias("n"), (F.min("f") != F.max("f")).alias("clash")).limit(FILES + 1).collect()
        if any(r["clash"] for r in found):
            raise ValueError("two files have names of one hash: write the table anew")
        return sorted((r["h"], r["n"]) for r in found)

    if docs._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRelation":
        found = files(docs)
        if len(found) <= FILES:
            return docs, found
    table = saved(docs.coalesce(FILES), "shards-input")
    return table, files(table)


def _dealer(known):
    """UDF: (hash of the file name, row number) -> (cell, order within the cell)."""
    @F.pandas_udf("cell long, key long, block long, at long")
    def deal(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        names, first, starts, places, seed, block_rows = known.value
        matrix, drawn = Matrix(starts, places, seed), {}
        for name, row in parts:
            row = row.to_numpy()
            block = first[np.searchsorted(names, name.to_numpy())] + row // block_rows
            cell, rank = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
            for b in np.unique(block).tolist():
                if b not in drawn:
                    drawn.clear()  # a scan goes through a file in order
                    n = int(starts[b + 1] - starts[b])
                    drawn[b] = np.random.default_rng([seed, 2, b]).permutation(n), np.cumsum(matrix.row(b))
                of, (order, ends) = block == b, drawn[b]
                rank[of] = order[row[of] % block_rows]
                cell[of] = np.searchsorted(ends, rank[of], side="right")
            with np.errstate(over="ignore"):
                salt = block.astype(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
                key = mix64(mix64(salt) ^ rank.astype(np.uint64))
            yield pd.DataFrame({"cell": cell, "key": key.view(np.int64), "block": block, "at": rank})
    return deal


def place(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, block_rows: int = BLOCK_ROWS,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """``docs`` with __shard_no and __shard_slot (gapless from 0 in every shard)."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    table, found = _stored(docs)
    rows = sum(n for _, n in found)
    block_rows, cell_rows = max(block_rows, -(-rows // MOST)), max(cell_rows, -(-rows // MOST))
    sizes, parts, places = cells(rows, shards, cell_rows)
    blocks = [-(-n // block_rows) for _, n in found]
    lengths = [min(block_rows, n - lo) for _, n in found for lo in range(0, n, block_rows)]
    known = spark.sparkContext.broadcast((
        np.array([h for h, _ in found], np.int64), np.array([0, *accumulate(blocks)][:len(blocks)], np.int64),
        np.array([0, *accumulate(lengths)], np.int64), places, seed, block_rows))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    dealt = table.select(*columns, _dealer(known)(
        F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")).alias("__shard_to"))
    inside = Window.partitionBy("__shard_cell").orderBy("__shard_key", "__shard_block", "__shard_at")
    ranked = dealt.select(*columns, *(F.col(f"__shard_to.{c}").alias(f"__shard_{c}") for c in ("cell", "key", "block", "at"))
                          ).withColumn("__shard_in", F.row_number().over(inside) - 1)
    # a shard's cells are neighbours, and its first n % p cells have one slot more than the others
    first = accumulate(parts, initial=0)
    of = F.array(*(F.struct(*(F.lit(int(x)).cast("long").alias(c) for c, x in zip("npc", npc))) for npc in zip(sizes, parts, first)))
    number = F.aggregate(of, F.lit(-1), lambda s, x: F.when(F.col("__shard_cell") >= x["c"], s + 1).otherwise(s))
    mine = of[F.col("__shard_no")]
    place_in = F.col("__shard_cell") - mine["c"]
    slot = place_in * F.floor(mine["n"] / mine["p"]) + F.least(place_in, mine["n"] % mine["p"]) + F.col("__shard_in")
    return ranked.withColumn("__shard_no", number).select(*columns, "__shard_no", slot.cast("long").alias("__shard_slot"))


def write(docs: DataFrame, path: str, shards: int = SHARDS, seed: int = SEED, **options) -> DataFrame:
    """Write the shards below ``path`` (a folder ``shard=N`` each, files in the order of ``slot``) and read them back.

    A file holds whole cells in slot order; a shard's files are told apart by the slots that they hold."""
    placed = place(docs, shards, seed, **options).withColumnsRenamed({"__shard_no": "shard", "__shard_slot": "slot"})
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.parquet(path)
