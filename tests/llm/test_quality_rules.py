import math
from collections import Counter

import pytest

from tidemark.llm import quality_rules as Q

from .helpers import LABEL_SCHEMA, documents, rows


def brute(text):
    words, chars = [], ""
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            words += [chars] if chars else []
            chars = ""
        else:
            chars += c
    words += [chars] if chars else []
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside))


@pytest.mark.parametrize("text", ["", "   \n", "a b c a b c", "é é é é\x0bñ", "x\x1cy\x85 z\u3000q", "#*|\n#*|\n\n\n#*|", "a " * 9,
                                  "one two three four one two three five", "A\r\nB\r\nA\r\n", "w " * 30000 + "end"])
def test_counts_match_brute_force(text):
    assert Q.text_counts(text)[:5] == brute(text)


def test_binomial_tail_is_exact():
    assert Q.binomial_tail(0, 200, 0.025) == pytest.approx(0.975 ** 200)
    assert Q.binomial_tail(3, 50, 0.1) == pytest.approx(sum(math.comb(50, i) * 0.1 ** i * 0.9 ** (50 - i) for i in range(4)))
    assert Q.binomial_tail(5, 5, 0.3) == pytest.approx(1)


def test_cutoff_is_the_middle_of_the_best_safe_run():
    import numpy as np

    c, n, k = Q.choose_cutoff(np.array([2, 50]), np.array([400, 0]), np.array([0, 30]), 0.025, 0.003, 5)
    assert (c, n, k) == ((2 + 49) // 2, 400, 0)
    # too few good texts to refute anything
    assert Q.choose_cutoff(np.array([2, 50]), np.array([100, 0]), np.array([0, 30]), 0.025, 0.003, 5)[0] is None
    # the strict cutoffs would reject good texts beyond the risk
    c, _, k = Q.choose_cutoff(np.array([2, 40, 50]), np.array([400, 100, 0]), np.array([0, 0, 30]), 0.025, 0.003, 0)
    assert 40 <= c < 50 and k == 0


def good(i):
    return " ".join(f"w{i}x{j}" for j in range(60))


def bad(i):
    return " ".join(f"w{i}x{j}" + "***" * (j % 2) for j in range(60))


def corpus(spark, n=420):
    docs = [(i, bad(i) if i % 20 == 0 else good(i)) for i in range(n)]
    labels = [(i, 0 if i % 20 == 0 else 1, 0) for i in range(n)]
    return docs, spark.createDataFrame(labels, LABEL_SCHEMA)


def test_rejects_bad_and_keeps_good_per_stratum(spark):
    docs, labels = corpus(spark)
    # a stratum with a few labels gets no cutoff and keeps its texts
    out = Q.judge(documents(spark, docs + [(9000, bad(9000), "xx"), (9001, good(9001), None)]), labels)
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert all(kept[i] == (i % 20 != 0) for i in range(420))
    assert kept[9000] and kept[9001]


def test_edge_cases(spark):
    docs, labels = corpus(spark)
    odd = [(None, None), (None, good(1)), (7, good(7)), (7, good(7)), (5000, ""), (5001, "word " * 4000)]
    frame = documents(spark, docs + odd).selectExpr("*", "1 as stratum", "2 as kept", "3 as n_words", "text as failed_rules")
    out = Q.judge(frame, labels)
    assert out.count() == len(docs) + len(odd)
    got = rows(out.where("doc_id is null or doc_id >= 5000 or doc_id = 7"), "doc_id", "n_words", "base_failed", "kept")
    assert got == sorted([(None, 0, True, False), (None, 60, False, True), (7, 60, False, True), (7, 60, False, True),
                          (7, 60, False, True), (5000, 0, True, False), (5001, 4000, True, False)], key=repr)
    kept = Q.keep_rows(documents(spark, docs + odd), labels)
    assert kept.count() == out.where("kept").count()
    empty = documents(spark, [])
    assert Q.judge(empty, labels).count() == 0 and Q.keep_rows(empty, labels).count() == 0
    none = spark.createDataFrame([(None, 1, 0), (1, None, 0)], LABEL_SCHEMA)
    assert Q.judge(documents(spark, docs), none).where("kept").count() == len(docs)  # no labels: base rules only


def test_tail_is_exact_and_fast():
    """Against whole-number arithmetic, and at sizes where a sum of all terms takes seconds."""
    import time
    from fractions import Fraction
    from math import comb

    from tidemark.llm.quality_rules import binomial_tail

    for n in (1, 7, 40, 300):
        for p in (0.025, 0.5, 0.9):
            q = Fraction(p)
            for k in {0, n // 40, n // 3, n - 1, n}:
                exact = float(sum(comb(n, i) * q ** i * (1 - q) ** (n - i) for i in range(k + 1)))
                assert abs(binomial_tail(k, n, p) - exact) <= 1e-9 * exact + 1e-12
    start = time.process_time()
    tails = [binomial_tail(k, 90_000_000, 0.025) for k in (2_240_000, 2_249_000, 2_250_000, 2_251_000, 2_260_000)]
    assert tails == sorted(tails) and 0.4 < tails[2] < 0.6 and time.process_time() - start < 5
