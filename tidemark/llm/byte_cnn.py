"""Operator 7. Quality classifier: a byte-level convolutional network in numpy.

The whole text (UTF-8 bytes) is cut into overlapping chunks of ``CHUNK`` bytes
that together cover every byte. Each byte becomes ``DIM`` learned numbers plus
one fixed channel that tells whether the last four bytes repeat those of a few
positions before (``LAGS``), which a short filter could not see. ``FILTERS``
learned filters of ``WIDTH`` bytes are applied every ``STRIDE`` bytes and
max-pooled over the chunk; a small dense layer turns a chunk into a log-odds
value, and the mean over the document's chunks, through the logistic function,
is the probability of label 1.

Fitting reads labels only and learns from all chunks of a bounded sample of
labelled rows: per label the ``FIT_ROWS`` rows with the smallest hashes (a fixed
choice), less those that would take their texts past ``FIT_BYTES`` in all, in that
order; both bounds are parameters. Scoring reads whole texts.

Edge cases: a null or empty text is one chunk of padding and gets that chunk's
score; without both labels in the sample every text gets the share of label 1
(0.5 without labels); labels that repeat a document count once (the lower);
rows with null ids are scored and never learned from.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, released, slices, text_buffer

CHUNK, STEP = 512, 448
DIM, WIDTH, STRIDE, FILTERS, HIDDEN = 7, 8, 4, 32, 16
LAGS = range(2, 25)
FIT_ROWS, FIT_BYTES, EPOCHS, RATE, SEED = 1500, 8 << 20, 6, 0.004, 7
THRESHOLD = 0.3
PAD = 256
HOLD_OUT_FOLDS = 5

Params = dict[str, np.ndarray]


# ------------------------------------------------------------------ chunks

def repeat_channel(raw: np.ndarray) -> np.ndarray:
    """1 where the four bytes up to here equal the four bytes a lag of LAGS before (along the last axis)."""
    out = np.zeros(raw.shape, bool)
    for lag in LAGS:
        if raw.shape[-1] < lag + 4:
            break
        same = raw[..., lag:] == raw[..., :-lag]
        out[..., lag + 3:] |= same[..., 3:] & same[..., 2:-1] & same[..., 1:-2] & same[..., :-3]
    return out


def chunk_texts(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, repeats, owner): a row for each chunk, with the index of its text.

    Chunks start every STEP bytes until a chunk reaches the text's end."""
    start, size = offsets[:-1], np.diff(offsets)
    base = int(offsets[0])
    part = raw[base:int(offsets[-1])]
    repeats = repeat_channel(part)
    if len(part):  # the first bytes of a text must not look back into the text before it
        head = (start - base)[:, None] + np.arange(LAGS[-1] + 3)
        own = head < (start - base + size)[:, None]
        repeats[head[own]] = repeat_channel(part[np.where(own, head, 0)])[own]
    n = 1 + np.maximum(0, -(-(size - CHUNK) // STEP))
    owner = np.repeat(np.arange(len(size)), n)
    inside = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * STEP
    at = inside[:, None] + np.arange(CHUNK)
    real = at < size[owner][:, None]
    at = np.where(real, at + (start - base)[owner][:, None], 0)
    if len(part):
        codes, rep = np.where(real, part[at].astype(np.int16), np.int16(PAD)), real & repeats[at]
    else:
        codes, rep = np.full(at.shape, PAD, np.int16), np.zeros(at.shape, bool)
    return codes, rep, owner


# ------------------------------------------------------------------ network

def windows(codes: np.ndarray, rep: np.ndarray, p: Params) -> np.ndarray:
    """(chunks, positions, WIDTH * (DIM + 1)) float32."""
    x = np.empty((*codes.shape, DIM + 1), np.float32)
    x[..., :DIM] = p["embed"][codes]
    x[..., DIM] = rep
    v = np.lib.stride_tricks.sliding_window_view(x, WIDTH, axis=1)[:, ::STRIDE]  # (n, pos, DIM+1, WIDTH)
    return np.ascontiguousarray(v.transpose(0, 1, 3, 2)).reshape(len(codes), -1, WIDTH * (DIM + 1))


def pooled(win: np.ndarray, p: Params) -> tuple[np.ndarray, np.ndarray]:
    """Max-pooled filter responses (chunks, FILTERS) and the positions of the maxima."""
    n, pos, d = win.shape
    r = (win.reshape(-1, d) @ p["conv"]).reshape(n, pos, -1)
    where = r.argmax(1)
    return np.maximum(np.take_along_axis(r, where[:, None], 1)[:, 0] + p["conv_b"], 0), where


def log_odds(codes: np.ndarray, rep: np.ndarray, p: Params) -> np.ndarray:
    out = np.empty(len(codes), np.float32)
    for lo in range(0, len(codes), 256):  # bounds the window array to some 8 MB
        win = windows(codes[lo:lo + 256], rep[lo:lo + 256], p)
        n, pos, d = win.shape
        m = (win.reshape(-1, d) @ p["conv"]).reshape(n, pos, -1).max(1)
        h = np.tanh(np.maximum(m + p["conv_b"], 0) @ p["dense"] + p["dense_b"])
        out[lo:lo + n] = h @ p["out"] + p["out_b"]
    return out


def fit(codes: np.ndarray, rep: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Params:
    """Adam on the weighted logistic loss; deterministic for its input."""
    rng = np.random.default_rng(SEED)
    d = WIDTH * (DIM + 1)
    p: Params = {"embed": rng.normal(0, 0.5, (PAD + 1, DIM)).astype(np.float32),
                 "conv": rng.normal(0, d ** -0.5, (d, FILTERS)).astype(np.float32),
                 "conv_b": np.zeros(FILTERS, np.float32),
                 "dense": rng.normal(0, FILTERS ** -0.5, (FILTERS, HIDDEN)).astype(np.float32),
                 "dense_b": np.zeros(HIDDEN, np.float32),
                 "out": rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(np.float32), "out_b": np.zeros(1, np.float32)}
    m1 = {k: np.zeros_like(v) for k, v in p.items()}
    m2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(y))
        for lo in range(0, len(y), 64):
            i = order[lo:lo + 64]
            g = gradients(codes[i], rep[i], y[i], weight[i], p)
            step += 1
            rate = RATE * (0.5 if epoch >= EPOCHS - 2 else 1)
            for k in p:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.999 * m2[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - rate * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.999 ** step)) + 1e-7)
    return {k: v.astype(np.float32) for k, v in p.items()}


def gradients(codes: np.ndarray, rep: np.ndarray, y: np.ndarray, weight: np.ndarray, p: Params) -> Params:
    win = windows(codes, rep, p)
    a, where = pooled(win, p)
    h = np.tanh(a @ p["dense"] + p["dense_b"])
    z = h @ p["out"] + p["out_b"]
    dz = ((1 / (1 + np.exp(-z)) - y) * weight / len(y)).astype(np.float32)
    dh = dz[:, None] * p["out"] * (1 - h * h)
    da = (dh @ p["dense"].T) * (a > 0)                                       # (n, FILTERS)
    top = np.take_along_axis(win, where[:, :, None], 1)                      # (n, FILTERS, d): windows of the maxima
    g = {"out": h.T @ dz, "out_b": dz.sum(keepdims=True), "dense": a.T @ dh, "dense_b": dh.sum(0),
         "conv": np.einsum("nfd,nf->df", top, da), "conv_b": da.sum(0)}
    dwin = (da[:, :, None] * p["conv"].T).reshape(len(y), FILTERS, WIDTH, DIM + 1)[..., :DIM]
    at = where[:, :, None] * STRIDE + np.arange(WIDTH)                       # byte positions in the chunk
    g["embed"] = np.zeros_like(p["embed"])
    np.add.at(g["embed"], np.take_along_axis(codes, at.reshape(len(y), -1), 1).ravel(), dwin.reshape(-1, DIM))
    return g


# ------------------------------------------------------------------ Spark

def fold() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % HOLD_OUT_FOLDS


def sample(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[list[bytes], np.ndarray, dict[int, int]]:
    """At most ``rows`` texts of each label from the learning folds, and the label counts there."""
    label = (labels.where("doc_id is not null and quality in (0, 1)")
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("y")))
    known = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
             .where(F.col("doc_id").isNotNull() & (fold() != 0)))
    ids = known.select("doc_id").join(label, "doc_id")
    counts = {r.y: r.n for r in ids.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    sized = known.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("bytes")).join(label, "doc_id").groupBy(
        "doc_id", "y").agg(F.max("bytes").alias("bytes"))
    chosen = []
    for y in counts:
        left = FIT_BYTES
        for r in sized.where(F.col("y") == y).orderBy(*order).limit(rows).collect():  # ``rows`` ids at most
            if r.bytes <= left:
                left -= r.bytes
                chosen.append((r.doc_id, r.y))
    if not chosen:
        return [], np.zeros(0), counts
    chosen = docs.sparkSession.createDataFrame(chosen, "doc_id long, y int")
    got = known.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
    rows_out = sorted(got.mapInArrow(released(_fit_chunks), "doc_id long, y int, chunk int, code binary, rep binary").collect(),
                      key=lambda r: (r.doc_id, r.chunk))  # texts of FIT_BYTES a label at most
    return rows_out, np.array([r.y for r in rows_out], np.float32), counts


def _fit_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        raw, at = text_buffer(b.column("text"))
        for lo, hi in slices(at):
            codes, rep, owner = chunk_texts(raw, at[lo:hi + 1])
            n = np.bincount(owner, minlength=hi - lo)
            k = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
            rows = pa.array(owner + lo)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(rows), b.column("y").take(rows), pa.array(k.astype(np.int32)),
                 pa.array([c.tobytes() for c in codes], pa.binary()), pa.array([r.tobytes() for r in rep], pa.binary())],
                names=["doc_id", "y", "chunk", "code", "rep"])


def train(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> tuple[Params | None, float]:
    """Fitted parameters (None unless both labels occur) and the share of label 1."""
    chunks, y, counts = sample(docs, labels, rows)
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.5
    if len(counts) < 2 or len(set(y.tolist())) < 2:
        return None, share
    codes = np.stack([np.frombuffer(r.code, np.int16) for r in chunks])
    rep = np.stack([np.frombuffer(r.rep, bool) for r in chunks])
    per_doc = {d: n for d, n in zip(*np.unique([r.doc_id for r in chunks], return_counts=True))}
    weight = np.array([1 / per_doc[r.doc_id] for r in chunks], np.float32)
    for v in (0, 1):  # each label weighs as in the learning folds
        weight[y == v] *= counts[v] / total / weight[y == v].sum()
    return fit(codes, rep, y, (weight * len(y)).astype(np.float32)), share


def scores(raw: np.ndarray, offsets: np.ndarray, p: Params | None, share: float) -> np.ndarray:
    """Probability of label 1 for each text of a buffer."""
    out = np.full(len(offsets) - 1, share)
    if p is None:
        return out
    for lo, hi in slices(offsets, 256 << 10):
        # a text of any length: at most 512 chunks are held at once
        if hi - lo == 1 and offsets[hi] - offsets[lo] > 512 * STEP:
            total, n = 0.0, 0
            for a in range(int(offsets[lo]), int(offsets[hi]), 512 * STEP):
                z = int(offsets[hi])
                b = min(a + 512 * STEP + CHUNK - STEP, z)
                if n and b - a <= CHUNK - STEP:
                    break  # the chunk before reaches the end
                codes, rep, _ = chunk_texts(raw, np.array([a, b]))
                odds = log_odds(codes, rep, p)
                total, n = total + float(odds.astype(np.float64).sum()), n + len(odds)
            out[lo] = total / n
        else:
            codes, rep, owner = chunk_texts(raw, offsets[lo:hi + 1])
            odds = log_odds(codes, rep, p).astype(np.float64)
            out[lo:hi] = np.bincount(owner, odds, hi - lo) / np.bincount(owner, minlength=hi - lo)
    return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


def score(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    p, share = train(docs, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = scores(*text_buffer(b.column("text")), p, share)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s),
                                              pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(released(run), "doc_id long, held_out boolean, score double, predicted int")


def keep_rows(docs: DataFrame, labelled: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` that score THRESHOLD or more, with the columns of ``docs``.

    The network is fitted on the labelled texts of ``labelled``, the documents
    that the labels were given for (``docs`` may be what earlier stages left of
    them, without one of the labels)."""
    prepare(docs.sparkSession)
    p, share = train(labelled, labels, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(scores(*text_buffer(b.column("text")), p, share) >= THRESHOLD))

    return docs.mapInArrow(released(run), docs.schema)


def held_out(doc_id: int) -> bool:
    """The fold rule in Python, for tests."""
    return zlib.crc32(str(doc_id).encode()) % HOLD_OUT_FOLDS == 0
