"""Operator 8. Token ids as patched frame-of-reference (PFOR) files.

Texts are encoded with a public tokenizer file, an end id is appended to each
document, and the ids are written in ascending document order. A file is a
Parquet file of shards; a shard is a run of whole documents (about SHARD_IDS
ids, at least one document) as one self-contained image:

* header: magic, numbers of documents, ids and blocks, bytes of the block area;
* document ends (numbers of ids up to the end of each document, 64 bits);
* block starts (64 bits, into the block area), so any range of ids is read
  without touching other blocks;
* blocks of BLOCK ids: minimum (32 bits), width (8 bits), number of exceptions
  (8 bits), the ids less the minimum packed at ``width`` bits, exception
  positions (8 bits each) and exception values (32 bits each). The width is
  that of the PERCENTILE-th percentile of the block's differences; differences
  that need more bits are the exceptions.

Documents are dealt to partitions by ranges of ids and beginnings of texts, so the order over the files
is that of (part, shard) and nothing passes through one task; only one row per
part (its number of ids) is summed up over all parts. Results do not depend on
the partitioning.

Edge cases: a null or empty text is its end id alone; null ids come first;
documents that repeat an id are ordered by their text; ids of 0 and of
2**32 - 1 fit; an empty table writes no shard. Whole texts are encoded.
"""

from __future__ import annotations

import os
import re
import struct
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, saved

BLOCK, PERCENTILE, SHARD_IDS, END_ID = 128, 90, 1 << 19, 1
MEMO_PARTS, JOINED = 600_000, 512
#: A table of file parts of at most so many rows (16 bytes each) is broadcast.
BROADCAST_PARTS = 500_000
MAGIC = b"PFOR0001"
HEADER = struct.Struct("<8sQQQQ")


# ------------------------------------------------------------------ blocks

def bit_widths(x: np.ndarray) -> np.ndarray:
    """Bits that each value (uint32) needs."""
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """(m, BLOCK) values under 2**width -> (m, BLOCK * width / 8) bytes, low bits first."""
    out = np.zeros((BLOCK * width // 64, len(values)), np.uint64)
    cols = np.ascontiguousarray(values.T.astype(np.uint64))
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        out[word] |= cols[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= cols[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T).view(np.uint8).reshape(len(values), -1)


def unpack_bits(packed: np.ndarray, width: int) -> np.ndarray:
    """Inverse of pack_bits: (m, BLOCK) uint32."""
    m = len(packed)
    words = np.ascontiguousarray(np.ascontiguousarray(packed).view(np.uint64).reshape(m, -1).T)
    out = np.empty((BLOCK, m), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(BLOCK):
        word, shift = divmod(j * width, 64)
        v = words[word] >> np.uint64(shift)
        if shift + width > 64:
            v = v | words[word + 1] << np.uint64(64 - shift)
        out[j] = v & mask
    return out.T.astype(np.uint32)


def pack(ids: np.ndarray, ends: np.ndarray, percentile: float = PERCENTILE) -> bytes:
    """Image of ``ids`` (uint32) of documents that end at ``ends``."""
    n = len(ids)
    m = -(-n // BLOCK)
    full = np.full(m * BLOCK, ids[-1] if n else 0, np.uint32)
    full[:n] = ids
    full = full.reshape(m, BLOCK)
    least = full.min(1) if m else np.zeros(0, np.uint32)
    diff = full - least[:, None]
    rank = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    width = bit_widths(np.partition(diff, rank, axis=1)[:, rank]) if m else np.zeros(0, np.int64)
    over = diff >> width[:, None].astype(np.uint64) > 0 if m else np.zeros((0, BLOCK), bool)
    n_over = over.sum(1)
    size = 6 + BLOCK * width // 8 + 5 * n_over
    start = np.cumsum(size) - size
    area = np.zeros(int(size.sum()), np.uint8)
    kind = np.int32 if len(area) < 2 ** 31 - 4096 else np.int64  # index type of the block area
    head = np.empty((m, 6), np.uint8)
    head[:, :4] = least.astype("<u4").view(np.uint8).reshape(m, 4)
    head[:, 4], head[:, 5] = width, n_over
    area[start[:, None] + np.arange(6)] = head
    low = np.where(over, 0, diff)
    for w in np.unique(width[width > 0]):
        rows = np.flatnonzero(width == w)
        area[start[rows, None].astype(kind) + 6 + np.arange(BLOCK * w // 8, dtype=kind)] = pack_bits(low[rows], int(w))
    block, at = np.nonzero(over)
    nth = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
    body = start + 6 + BLOCK * width // 8
    area[body[block] + nth] = at
    values = np.ascontiguousarray(diff[block, at].astype("<u4")).view(np.uint8).reshape(-1, 4)
    area[(body[block] + n_over[block] + 4 * nth)[:, None] + np.arange(4)] = values
    return b"".join((HEADER.pack(MAGIC, len(ends), n, m, len(area)), ends.astype("<u8").tobytes(),
                     start.astype("<u8").tobytes(), area.tobytes()))


class Image:
    """Reader of one image: document ends and any range of ids."""

    def __init__(self, raw: bytes):
        magic, docs, self.n_ids, blocks, size = HEADER.unpack_from(raw)
        if magic != MAGIC or len(raw) != HEADER.size + 8 * (docs + blocks) + size:
            raise ValueError("not a whole PFOR image")
        self.ends = np.frombuffer(raw, "<u8", docs, HEADER.size).astype(np.int64)
        self.start = np.frombuffer(raw, "<u8", blocks, HEADER.size + 8 * docs).astype(np.int64)
        self.area = np.frombuffer(raw, np.uint8, size, HEADER.size + 8 * (docs + blocks))

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids [lo, hi): only the blocks that hold them are unpacked."""
        hi = self.n_ids if hi is None else min(hi, self.n_ids)
        if hi <= lo:
            return np.zeros(0, np.uint32)
        first, last = lo // BLOCK, -(-hi // BLOCK)
        start = self.start[first:last]
        head = self.area[start[:, None] + np.arange(6)]
        least = np.ascontiguousarray(head[:, :4]).view("<u4")[:, 0]
        width, n_over = head[:, 4].astype(np.int64), head[:, 5].astype(np.int64)
        out = np.zeros((len(start), BLOCK), np.uint32)
        for w in np.unique(width[width > 0]):
            rows = np.flatnonzero(width == w)
            out[rows] = unpack_bits(self.area[start[rows, None] + 6 + np.arange(BLOCK * w // 8)], int(w))
        body = start + 6 + BLOCK * width // 8
        block = np.repeat(np.arange(len(start)), n_over)
        nth = np.arange(len(block)) - np.repeat(np.cumsum(n_over) - n_over, n_over)
        at = self.area[body[block] + nth]
        value = np.ascontiguousarray(self.area[(body[block] + n_over[block] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")
        out[block, at] = value.reshape(-1)
        out += least[:, None]
        return out.reshape(-1)[lo - first * BLOCK:hi - first * BLOCK]


# ------------------------------------------------------------------ encoding

def _latin() -> tuple[re.Pattern, re.Pattern]:
    """(what a plain run must not hold, the parts of a plain run) for code points under U+0180.

    There the normaliser only lowers letters, one to one, and the
    pre-tokenizer's classes are letters, single numbers and all else; white
    space, apostrophes, the dotted capital I and special tokens are not plain."""
    kinds = {chr(c): unicodedata.category(chr(c))[0] for c in range(0x180)}
    letters, numbers = ("".join(re.escape(c) for c, k in kinds.items() if k == want) for want in "LN")
    return re.compile("['\u0130\x85\xa0]|<\\||[^\x00-\u017f]"), re.compile(f"[{letters}]+|[{numbers}]|[^{letters}{numbers}]+")


class WordEncoder:
    """Ids of texts with the tokenizers library, each distinct run of non-space characters encoded once.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its runs, one after the other (runs are cut at ASCII white
    space; other white space stays in a run, for the library to drop). Runs of
    plain Latin text are lowered and cut into the pre-tokenizer's parts, and
    new parts are encoded JOINED at a time with the library's model behind a
    pre-tokenizer that cuts at spaces; all other runs take the whole tokenizer,
    runs of letters JOINED at a time. Every part ends with the only word-end
    piece in it, by which joined ids fall apart again; should their number
    differ, the runs are encoded alone. The memo holds up to MEMO_PARTS parts
    (some 100 MB) and those of one batch, then starts anew."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a worker for each core
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole, self.parts_only = Tokenizer.from_str(model), Tokenizer.from_str(model)
        self.parts_only.normalizer = None
        self.parts_only.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.odd, self.cut = _latin()
        #: ids of plain parts and of runs that are not plain (which cannot be equal)
        self.parts: dict[str, bytes] = {}

    def _joined(self, tokenizer, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, encoded JOINED at a time."""
        groups = [texts[lo:lo + JOINED] for lo in range(0, len(texts), JOINED)]
        found = tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
        for group, encoding in zip(groups, found):
            ids = np.array(encoding.ids, "<u4")
            highs = 4 * (np.flatnonzero(self.ends_word[ids]) + 1)
            if len(highs) == len(group):
                raw = ids.tobytes()
                yield from (raw[a:z] for a, z in zip([0, *highs[:-1].tolist()], highs.tolist()))
            else:
                yield from self._alone(group)

    def _alone(self, texts: list[str]) -> Iterator[bytes]:
        for e in self.whole.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(e.ids, "<u4").tobytes()

    def known(self, runs: list[str]) -> list[bytes]:
        """The ids of each of the distinct ``runs``."""
        single: list[str | None] = []  # the one part of a run, None for runs of several
        several, letters, others = {}, set(), set()
        for n, r in enumerate(runs):
            if not (r.isascii() and r.isalpha()) and self.odd.search(r):
                (letters if r.isalpha() else others).add(r)
                single.append(r)
            elif r.isalpha():
                single.append(r.lower())
            else:
                several[n] = self.cut.findall(r.lower())
                single.append(None)
        odd = letters | others
        wanted = set().union(single, *several.values()) - odd - {None}
        if len(self.parts) + len(wanted) + len(odd) > MEMO_PARTS:
            self.parts.clear()
        for tokenizer, group in ((self.parts_only, wanted), (self.whole, letters)):
            new = list(group.difference(self.parts))
            self.parts.update(zip(new, self._joined(tokenizer, new)))
        new = list(others.difference(self.parts))
        self.parts.update(zip(new, self._alone(new)))
        get = self.parts.__getitem__
        found = list(map(self.parts.get, single))
        for n, p in several.items():
            found[n] = b"".join(map(get, p))
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, number of ids of each); null is the empty text.

        Runs are cut and numbered by Arrow; Python sees the batch's distinct runs only."""
        runs = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
        numbered = runs.flatten().dictionary_encode()
        # one Python string, cut again at spaces: runs hold none
        distinct = pa.ListArray.from_arrays(pa.array([0, len(numbered.dictionary)], pa.int32()), numbered.dictionary)
        found = self.known(pc.binary_join(distinct, " ")[0].as_py().split(" "))
        pool = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int32, len(found)) // 4  # a batch has far less than 2**31 ids
        of = numbered.indices.to_numpy()
        n = size[of]
        ends = np.cumsum(n, dtype=np.int32)
        at = np.repeat((np.cumsum(size, dtype=np.int32) - size)[of] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)
        bounds = np.append(np.int64(0), ends)[runs.offsets.to_numpy() - runs.offsets[0].as_py()]
        return pool[at], np.diff(bounds)


_ENCODERS: dict[int, WordEncoder] = {}


def _encoder(model: str) -> WordEncoder:
    key = hash(model)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordEncoder(model)
    return _ENCODERS[key]


def model_text(path: str | None = None) -> str:
    """The tokenizer file (by default the public word-end BPE); read on the driver, some 2 MB."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


#: Characters of a text that deal out documents of one id.
ORDER_CHARS = 32
SHARDS = "part int, shard int, first_in_part long, n_docs long, n_ids long, doc_ids array<long>, image binary"


def write(docs: DataFrame, model: str | None = None, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode ``docs`` and write the files (to ``path``, or to the shared scratch folder); the shards as read back."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model or model_text())
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, shard, first = _encoder(shared.value), TaskContext.get().partitionId(), 0, 0
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # document ids, their sizes, ids
        size = 0

        def flush() -> pa.RecordBatch:
            doc_ids, ends = pa.concat_arrays([h[0] for h in held]), np.cumsum(np.concatenate([h[1] for h in held]))
            image = pack(np.concatenate([h[2] for h in held]), ends)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([first], pa.int64()),
                 pa.array([len(doc_ids)], pa.int64()), pa.array([int(ends[-1])], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids), pa.array([image], pa.binary())],
                names=["part", "shard", "first_in_part", "n_docs", "n_ids", "doc_ids", "image"])

        for b in batches:
            ids, n = encoder.encode(b.column("text"))
            ids, n = np.insert(ids, np.cumsum(n), np.uint32(end_id)), n + 1
            ends, lo, done = np.cumsum(n), 0, 0
            while lo < len(n):  # fill the shard up with whole documents, one at least
                hi = max(lo + 1, int(np.searchsorted(ends, done + SHARD_IDS - size, side="right")))
                held.append((b.column("doc_id").slice(lo, hi - lo), n[lo:hi], ids[done:ends[hi - 1]]))
                size, lo, done = size + int(ends[hi - 1]) - done, hi, int(ends[hi - 1])
                if size >= SHARD_IDS or lo < len(n):
                    yield flush()
                    held, size, shard, first = [], 0, shard + 1, first + size
        if held:
            yield flush()

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # rows of one id (nulls) are spread by the beginnings of their texts, which sort as the texts do
    ordered = narrow.withColumn("begins", F.substring("text", 1, ORDER_CHARS)).repartitionByRange("doc_id", "begins").drop(
        "begins").sortWithinPartitions("doc_id", "text")
    shards = ordered.mapInArrow(run, SHARDS)
    if path is None:
        return saved(shards, "token-files")
    shards.write.parquet(path)
    return read(spark, path)


def read(spark, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def documents(shards: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the shards' images."""
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = saved(totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")), "token-parts")
    if parts.count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for first, doc_ids, raw in zip(b.column("first").to_pylist(), b.column("doc_ids"), b.column("image").to_pylist()):
                image = Image(raw)
                data = np.ascontiguousarray(image.ids(), "<u4").tobytes()
                low = np.concatenate([[0], image.ends[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [doc_ids.values, pa.array(first + low), pa.array(image.ends - low),
                     pa.array([zlib.crc32(data[4 * a:4 * z]) for a, z in zip(low.tolist(), image.ends.tolist())], pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    joined = shards.join(parts, "part").select((F.col("part_start") + F.col("first_in_part")).alias("first"), "doc_ids", "image")
    return joined.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
