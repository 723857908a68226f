import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import jaccard_join as J
from tidemark.llm import shingles as H
from tidemark.llm.common import text_buffer
from tidemark.llm.components import components

from .helpers import documents, links_and_classes, shingles


def corpus(n_base=12, copies=14, seed=4):
    rng, docs = random.Random(seed), []
    words = [f"w{i}" for i in range(3000)]
    shared = rng.sample(words, 60)
    for b in range(n_base):
        base = rng.choices(words, k=rng.choice([3, 30, 80, 200]))
        if b % 3 == 0:
            base = shared + base
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            docs.append((len(docs), " ".join(t)))
    return docs


def got(df):
    return sorted(((r.doc_id, r.class_id, r.n_links) for r in df.collect()), key=repr)


def test_shingle_sets_match_tuples():
    texts = ["", "  ", "one", "a b c d", "a b c d e", "a b\tc\nd  e f g a b c d e", "é ñ " * 40, "x" * 10000 + " y z w v u"]
    raw, at = text_buffer(pa.array(texts))
    for t, s in zip(texts, H.shingle_sets(raw, at, 5)):
        assert len(s) == len(shingles(t))
    a, b = list(H.shingle_sets(*text_buffer(pa.array(["p q r s t u", "zz p q  r s\nt u"])), 5))
    assert len(np.intersect1d(a, b)) == 2


def test_pruning_keeps_what_reaches_the_threshold():
    least = J.least_matches()
    for n, m in least.items():
        assert m <= 0.8 * n  # never drops at the expected number of agreements
    assert least[16] > 0 and least[128] > 64


def test_query_matches_brute_force(spark):
    docs = corpus()
    assert got(J.join(documents(spark, docs))) == sorted(links_and_classes(docs), key=repr)


def test_blocks_lose_no_link(spark, monkeypatch):
    import tidemark.llm.jaccard_join as module

    monkeypatch.setattr(module, "BLOCK", 5)
    docs = corpus(4, 40, seed=9)
    assert got(J.join(documents(spark, docs))) == sorted(links_and_classes(docs), key=repr)


def test_empty_blocks_count_no_link_twice(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_SHINGLES", 30)  # more blocks than texts
    docs = corpus(3, 4, seed=3)
    assert got(J.join(documents(spark, docs))) == sorted(links_and_classes(docs), key=repr)


def test_given_table_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    from tidemark.llm.queries import op9_jaccard_join

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(op9_jaccard_join(spark, sf)) == sorted(links_and_classes(docs), key=repr)


def test_edge_cases(spark):
    long = " ".join(f"t{i}" for i in range(30000))
    docs = [(None, "a b c d e f"), (4, "a b c d e f"), (9, None), (9, ""), (3, "hi"), (2, "hi"), (2, "hi"), (7, long), (8, long + " end"), (None, None),
            (11, "same words but spaced"), (12, "same  words\nbut spaced")]
    frame = documents(spark, docs).selectExpr("*", "1 as rid", "2 as sig", "3 as class_id", "4 as component")
    assert got(J.join(frame)) == sorted(links_and_classes(docs), key=repr)
    assert J.join(documents(spark, [])).count() == 0
    kept = sorted(((r.doc_id, r.text) for r in J.keep_rows(documents(spark, docs)).collect()), key=repr)
    assert [d for d, _ in kept if d is not None] == sorted([2, 4, 7, 9, 11], key=repr)
    assert J.keep_rows(documents(spark, docs)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_row_of_each_class_stays_with_null_and_repeated_ids(spark):
    docs = [(5, "a b c d e f"), (5, "other words"), (5, "other words"), (None, "null only"), (None, "null only"), (None, "a b c d e f"),
            (6, "a b c d e f"), (5, ""), (5, " "), (None, None), (None, "")]
    out = sorted(((r.doc_id, r.text) for r in J.keep_rows(documents(spark, docs)).collect() if (r.text or "").strip()), key=repr)
    assert out == sorted([(5, "a b c d e f"), (5, "other words"), (None, "null only")], key=repr)
    blank = [r.doc_id for r in J.keep_rows(documents(spark, docs)).collect() if not (r.text or "").strip()]
    assert sorted(blank, key=repr) == [5, None, None]


@pytest.mark.parametrize("edges, want", [
    ([], {}), ([(1, 1), (None, 2)], {}), ([(5, 3), (3, 5), (5, 9)], {3: 3, 5: 3, 9: 3}),
    ([(i, i + 1) for i in range(40)] + [(100, 200)], {**{i: 0 for i in range(41)}, 100: 100, 200: 100}),
    ([(0, i) for i in range(1, 50)], {i: 0 for i in range(50)})])
def test_components(spark, edges, want):
    out = components(spark.createDataFrame(edges, "a long, b long"), "test")
    assert {r.node: r.component for r in out.collect()} == want


def test_bands_hold_all_that_links():
    edges = J.band_edges(most=5000)
    for small in range(1, 4000):
        large = small * 5 // 4  # the largest size that can link
        bands = np.searchsorted(edges, [small, large], side="right") - 1
        assert 0 <= bands[0] <= bands[1] <= bands[0] + 1


@pytest.mark.parametrize("block", [3, 7, 1000])
def test_pairs_of_blocks_in_bands_lose_no_link(spark, monkeypatch, block):
    """Groups over several parts, bands and blocks: chains of texts that grow past several bands, and near copies."""
    monkeypatch.setattr(J, "BLOCK", 4)
    monkeypatch.setattr(J, "PAIR_BLOCK", block)
    rng = random.Random(block)
    words = [f"g{i}" for i in range(400)]
    docs = [(i, " ".join(words[:20 + 6 * i])) for i in range(50)]
    docs += [(100 + i, " ".join([*words[:60], *(rng.choice(words) for _ in range(i % 9))])) for i in range(30)]
    docs += [(200 + i, " ".join(rng.choices(words, k=40))) for i in range(5)]
    assert got(J.join(documents(spark, docs))) == sorted(links_and_classes(docs), key=repr)


def test_texts_of_one_first_hash_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    whole = J.text_ids
    monkeypatch.setattr(J, "text_ids", lambda text: {**whole(text), "hash": F.pmod(whole(text)["hash"], F.lit(7))})
    docs = corpus(5, 6, seed=8)
    assert got(J.join(documents(spark, docs))) == sorted(links_and_classes(docs), key=repr)
    ids = sorted(r.doc_id for r in J.keep_rows(documents(spark, docs)).collect())
    assert ids == sorted({c for _, c, _ in links_and_classes(docs)})


def test_differences_give_the_exact_links():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n).astype(np.uint64)) for n in (40, 45, 50, 200, 200, 210, 3, 1)]
    sets += [sets[3][:-1], sets[3], sets[0][2:]]
    lead, size = sets[3], np.array([len(s) for s in sets])
    least = {J.LOOK: 0}  # nothing pruned
    links, _ = J.link_counts([np.setxor1d(s, lead) for s in sets], size, np.zeros((len(sets), J.HASHES), np.uint16),
                             np.zeros(len(sets), np.int32), False, np.ones(len(sets), np.int64), least)
    for i, s in enumerate(sets):
        both = [(len(np.intersect1d(s, o)), len(np.union1d(s, o))) for j, o in enumerate(sets) if j != i]
        assert links[i] == sum(5 * a >= 4 * b for a, b in both)
