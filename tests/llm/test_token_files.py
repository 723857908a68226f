import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import token_files as T

from .helpers import documents


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 3000])
@pytest.mark.parametrize("most", [1, 2, 70, 50000, 2 ** 32])
def test_image_round_trip_and_ranges(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most, n, dtype=np.uint64).astype(np.uint32)
    ends = np.unique(np.append(rng.integers(0, n + 1, 5), n))
    image = T.Image(T.pack(ids, ends))
    assert (image.ids() == ids).all() and (image.ends == ends).all()
    for lo, hi in ((0, 1), (5, 130), (n // 2, n), (n, n + 5)):
        assert (image.ids(lo, hi) == ids[lo:hi]).all()


def test_outliers_are_exceptions_and_blocks_stay_narrow():
    ids = np.full(12800, 1000, np.uint32)
    ids[::50] = 2 ** 32 - 1
    ids[::7] += 3
    raw = T.pack(ids, np.array([len(ids)]))
    assert (T.Image(raw).ids() == ids).all() and len(raw) < 1.2 * len(ids)
    with pytest.raises(ValueError):
        T.Image(raw[:-1])


def test_word_encoder_equals_the_library():
    e, library = T.WordEncoder(T.model_text()), Tokenizer.from_str(T.model_text())
    texts = ["", "a\x01b \x01 c", "Don't STOP  now", "İΣΑΣ é ́x", "日本 語", "\x01", "<|endoftext|> x<|startoftext|>y", "x\x1cy\x85z\u200bw\u3000q",
             "\x00 \x0b\x0c", "ﬁ ﬀ ǆ", "a" * 5000]
    texts += ["It's a-b c.d e, 12½ x²ª µ ÀÉ ŀ", "AB12cd!!*** don't", "<|x|> a<|", None]
    ids, n = e.encode(pa.array(texts, pa.string()))
    for t, own in zip(texts, np.split(ids, np.cumsum(n)[:-1])):
        assert own.tolist() == library.encode(t or "", add_special_tokens=False).ids, t
    many = ["".join(chr(c) for c in range(lo, lo + 40)) + " x" for lo in range(33, 0x2100, 37)]
    ids, n = e.encode(pa.array(many).slice(3))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode(t, add_special_tokens=False).ids for t in many[3:]]


def expected(docs):
    library, start, out = Tokenizer.from_str(T.model_text()), 0, []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def got(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def test_query_equals_the_library(spark):
    from tidemark.llm.queries import op8_token_files

    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op8_token_files(spark, sf)) == expected(docs)


def test_edge_cases(spark, workdir, monkeypatch):
    docs = [(5, "b"), (None, None), (-3, ""), (5, "a"), (5, "a"), (2 ** 40, "word " * 20000), (None, "x")]
    frame = documents(spark, docs).selectExpr("*", "1 as part", "2 as image")
    shards = T.write(frame, path=f"{workdir}/files")
    assert got(T.documents(shards)) == expected(docs)
    assert got(T.documents(T.read(spark, f"{workdir}/files"))) == expected(docs)
    assert T.documents(T.write(documents(spark, []))).count() == 0


def test_many_null_ids_are_spread(spark):
    """A third of all rows without an id: they lie in several parts, still in the order of their texts."""
    docs = documents(spark, [(None, f"text {i:05d}") for i in range(3000)] + [(i, f"doc {i}") for i in range(6000)])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = T.write(docs)
        per = {r.part: (sum(d is None for d in r.doc_ids), r.n_docs) for r in shards.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(n for n, _ in per.values()) == 3000 and sum(n > 0 for n, _ in per.values()) >= 2
    got = sorted(T.documents(shards).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 3000 + list(range(6000))
