import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import byte_cnn as B
from tidemark.llm.common import text_buffer

from .helpers import LABEL_SCHEMA, documents


def test_chunks_cover_every_byte():
    texts = ["", "a", "b" * 511, "c" * 512, "d" * 513, "é" * 2000]
    raw, at = text_buffer(pa.array(texts))
    codes, rep, owner = B.chunk_texts(raw, at)
    for i, t in enumerate(texts):
        data, rows = t.encode(), codes[owner == i]
        seen = b"".join(bytes(r[:B.STEP if k < len(rows) - 1 else B.CHUNK][r[:B.STEP if k < len(rows) - 1 else B.CHUNK] < 256].astype(np.uint8))
                        for k, r in enumerate(rows))
        assert seen == data and len(rows) == 1 + max(0, -(-(len(data) - B.CHUNK) // B.STEP))


def test_repeats_are_seen_within_a_text_only():
    raw, at = text_buffer(pa.array(["abcdef", "abcdef abcdef"]))
    _, rep, owner = B.chunk_texts(raw, at)
    assert not rep[0].any() and rep[1].any()


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    codes, rep = rng.integers(0, 257, (4, B.CHUNK)).astype(np.int16), rng.random((4, B.CHUNK)) < 0.2
    y, w = np.array([0, 1, 1, 0], np.float32), np.ones(4, np.float32)
    p = {k: v.astype(np.float64) for k, v in B.fit(codes, rep, y, w).items()}

    def loss(p):
        z = B.log_odds(codes, rep, p).astype(np.float64)
        return float(np.mean(np.log1p(np.exp(-np.where(y > 0, z, -z)))))

    g = B.gradients(codes, rep, y, w, p)
    for k in ("out", "dense", "conv_b", "conv"):
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        moved = {s: v.copy() for s, v in p.items()}
        moved[k][at] += 1e-3
        if abs(g[k][at]) > 1e-3:
            assert (loss(moved) - loss(p)) / 1e-3 == pytest.approx(g[k][at], rel=0.1, abs=1e-3)


def test_held_out_accuracy_on_the_given_labels(spark):
    sf = "/root/testdata/sf0.1"
    from tidemark.llm.queries import op7_byte_cnn

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = op7_byte_cnn(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) for r in out)
    held = [(r.score, labels[r.doc_id]) for r in out if r.held_out and r.doc_id in labels]
    good, bad = np.array([s for s, y in held if y == 1]), np.array([s for s, y in held if y == 0])
    assert (good[:, None] > bad[None]).mean() > 0.98
    assert (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.9


def test_edge_cases(spark):
    rows = [(i, ("good words here " if i % 2 else "### $$$ %%% ") * 20) for i in range(200)]
    odd = [(None, None), (None, "x"), (900, ""), (901, "long text " * 40000), (3, rows[3][1])]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(None, 0, 0), (1, None, 0), (2, 0, 0), (2, 1, 0)], LABEL_SCHEMA)
    docs = documents(spark, rows + odd).selectExpr("*", "1 as score", "2 as held_out", "3 as y")
    out = B.score(docs, labels).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    by_id = {r.doc_id: r.predicted for r in out}
    assert all(by_id[i] == i % 2 for i in range(200))
    assert B.score(documents(spark, []), labels).count() == 0
    one = spark.createDataFrame([(i, 1, 0) for i in range(10)], LABEL_SCHEMA)
    assert {r.score for r in B.score(documents(spark, rows), one).collect()} == {1.0}
    assert {r.score for r in B.score(documents(spark, rows), one.limit(0)).collect()} == {0.5}
    assert B.keep_rows(documents(spark, rows), documents(spark, rows), labels).count() == 100


def test_log_odds_match_a_plain_loop():
    """The forward pass against its definition, byte by byte, chunk by chunk, for whole texts."""
    rng = np.random.default_rng(9)
    p = B.fit(rng.integers(0, 257, (4, B.CHUNK)).astype(np.int16), rng.random((4, B.CHUNK)) < 0.2, np.array([0, 1, 1, 0], np.float32), np.ones(4, np.float32))
    p = {k: v + rng.normal(0, 0.05, v.shape).astype(np.float32) for k, v in p.items()}

    def plain(text):
        data, odds, start = text.encode(), [], 0
        while True:
            codes = [data[start + i] if start + i < len(data) else B.PAD for i in range(B.CHUNK)]
            rep = [start + i < len(data) and start + i >= 3 and any(
                start + i - lag - 3 >= 0 and data[start + i - 3:start + i + 1] == data[start + i - 3 - lag:start + i + 1 - lag] for lag in B.LAGS)
                for i in range(B.CHUNK)]
            x = [[*p["embed"][c], float(r)] for c, r in zip(codes, rep)]
            best = [max(sum(float(v) for v in (np.array(x[i:i + B.WIDTH]).ravel() * p["conv"][:, f])) for i in range(0, B.CHUNK - B.WIDTH + 1, B.STRIDE))
                    for f in range(B.FILTERS)]
            pooled = [max(0.0, b + float(c)) for b, c in zip(best, p["conv_b"])]
            hidden = [np.tanh(sum(a * float(w) for a, w in zip(pooled, p["dense"][:, h])) + float(p["dense_b"][h])) for h in range(B.HIDDEN)]
            odds.append(sum(a * float(w) for a, w in zip(hidden, p["out"])) + float(p["out_b"][0]))
            if start + B.CHUNK >= len(data):
                return 1 / (1 + np.exp(-sum(odds) / len(odds)))
            start += B.STEP

    texts = ["", "short", "abcabcabcabc " * 30, "é" * 300, "".join(map(chr, rng.integers(32, 127, 1200)))]
    raw, at = text_buffer(pa.array(texts))
    assert np.allclose(B.scores(raw, at, p, 0.5), [plain(t) for t in texts], atol=1e-4)
