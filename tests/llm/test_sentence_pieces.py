import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from tidemark.llm import sentence_pieces as S
from tidemark.llm.queries import op2_sentence_pieces

from .helpers import documents


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_proto=S.model_bytes())


def test_ids_equal_the_library(library):
    p, rng = S.Pieces(S.model_bytes()), random.Random(3)
    texts = ["", " ", "  a  b ", "\n\n x\t", "日本語 テスト 😀", "a▁b ▁", "<s> <0x0A> <unk>", "e" * 3000, "x" + " " * 40 + "y", "\x00\x01"]
    texts += ["".join(rng.choice("abcdeins  éß\n▁日本.,'") for _ in range(rng.randint(1, 80))) for _ in range(1500)]
    for text, raw in zip(texts, p.encode(texts)):
        ids = np.frombuffer(raw, "<i4").tolist()
        assert ids == library.encode(text), text
        assert p.decode(ids) == library.decode(ids)
    ids, n = p.encode_batch(pa.array([None, *texts, None]).slice(1))
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [library.encode(t) for t in texts] + [[]]
    assert p.encode_batch(pa.array([], pa.string()))[0].tolist() == []


def test_results_do_not_depend_on_the_memo(monkeypatch):
    texts = [" ".join(f"word{i}ing tion{j}" for i in range(20)) for j in range(20)]
    whole = S.Pieces(S.model_bytes()).encode(texts)
    monkeypatch.setattr(S, "MEMO_WORDS", 10)
    monkeypatch.setattr(S, "MEMO_PAIRS", 5)
    p = S.Pieces(S.model_bytes())
    assert [p.encode([t])[0] for t in texts] == whole


def test_query_equals_the_library_and_round_trips(spark, library):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = op2_sentence_pieces(spark, sf).collect()
    assert {r.doc_id for r in got} == set(text) and len(got) == len(text)
    for r in got:
        assert r.ids == library.encode(text[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_edge_cases_and_decode(spark):
    docs = documents(spark, [(None, None), (1, ""), (1, "a b"), (1, "a b"), (2, "long " * 20000)]).selectExpr("*", "1 as ids", "2 as n_tokens")
    out = S.encode(docs)
    assert sorted(((r.doc_id, r.n_tokens) for r in out.collect()), key=repr)[:4] == [(1, 0), (1, 2), (1, 2), (2, 20001)]
    back = S.decode(out).collect()
    assert sorted((r.text for r in back), key=len) == ["", "", "a b", "a b", "long " * 20000]
    assert S.encode(documents(spark, [])).count() == 0
