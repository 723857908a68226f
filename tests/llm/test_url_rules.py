import itertools
import random

from tidemark.llm import url_rules as U

LABELS = "doc_id long, quality int, toxic int"


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "html") for i, u in urls], "page_id long, url string, html string")


def test_listed_rules_and_parts(spark):
    urls = ["HTTP://A.Example.ORG/es/1", "https://example.org/en/12?x#y", "https://example.org/en/2", "https://org/", "https://org",
            "https://x.com/fr/a/b", "https://com/de/", "https://notorg/", None, "no scheme", "://h/p", "a://b.c#frag", "https://x.com?q=/de/",
            "https://x.com/DE/", "https://example.org.evil.net/es/", "https://u@example.org:80/es/"]
    out = {r.page_id: r for r in U.judge(pages(spark, list(enumerate(urls))), spark.createDataFrame([], LABELS)).collect()}
    got = [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(len(urls))]
    assert got == [("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
                   ("example.org", "/en/2", "org/", "allow"), ("org", "/", "org/", "allow"), ("org", "", None, "allow"),
                   ("x.com", "/fr/a/b", "com/fr/", "allow"), ("com", "/de/", "com/de/", "block"), ("notorg", "/", None, "allow"),
                   ("", "", None, "allow"), ("", "", None, "allow"), ("h", "/p", None, "allow"), ("b.c", "", None, "allow"),
                   ("x.com", "", None, "allow"), ("x.com", "/DE/", None, "allow"), ("example.org.evil.net", "/es/", None, "allow"),
                   ("u@example.org:80", "/es/", None, "allow")]


def brute(frame, labels):
    """(verdict, mined?) of every page by counting all token sets of up to RULE_TOKENS tokens."""
    tokens = {r.page_id: r.tokens for r in U.with_parts(frame).collect()}
    bad = {r.doc_id: r.quality == 0 for r in labels.collect() if r.doc_id in tokens}
    n, b = {}, {}
    for i, is_bad in bad.items():
        for k in range(1, U.RULE_TOKENS + 1):
            for s in itertools.combinations(sorted(tokens[i]), k):
                n[s] = n.get(s, 0) + 1
                b[s] = b.get(s, 0) + is_bad
    rules = {s: (b[s] / n[s], b[s]) for s in n if b[s] >= max(U.MIN_COUNT, U.MIN_SUPPORT * len(bad)) and b[s] >= U.MIN_CONFIDENCE * n[s]}
    out = {}
    for i, t in tokens.items():
        hits = [(*rules[s], " ".join(s)) for s in rules if set(s) <= set(t)]
        out[i] = ("block", max(hits)[2]) if hits else ("allow", None)
    return out, rules


def judged(frame, labels):
    return {r.page_id: (r.verdict, r.mined) for r in U.judge(frame, labels).collect()}


def test_mined_rules_match_counting_all_token_sets(spark):
    rng = random.Random(5)
    urls = [f"https://{rng.choice(['a', 'b', 'spam'])}.{rng.choice(['one', 'two'])}.net/{rng.choice(['x', 'win', 'z'])}/{i}"
            + rng.choice(["", "?ref=1", ".html"]) for i in range(600)]
    labels = spark.createDataFrame([(i, 0 if ("spam" in u and "/win/" in u and rng.random() < 0.95) or rng.random() < 0.05 else 1, 0)
                                    for i, u in enumerate(urls) if i % 3], LABELS)
    frame = pages(spark, list(enumerate(urls)))
    want, rules = brute(frame, labels)
    assert rules and judged(frame, labels) == want and any(v == "block" for v, _ in want.values())


def test_patterns_anywhere_in_the_url_are_mined(spark):
    """Later path segments, later keys, values and middle labels are tokens as well as first ones."""
    rng = random.Random(6)
    for pattern in ("https://h{i}.net/en/casino/{i}", "https://h{i}.net/a/b/c/win/{i}", "https://h{i}.net/p?page={i}&ref=spam&x=1",
                    "https://w{i}.ads.h.net/{i}", "https://h{i}.net/{i}/x.exe"):
        other = "https://g{i}.net/en/news/{i}?page={i}&ref=ok"
        urls = [(i, (pattern if i % 4 == 0 else other).format(i=i)) for i in range(600)]
        labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else int(rng.random() > 0.05), 0) for i, _ in urls], LABELS)
        frame = pages(spark, urls)
        got = judged(frame, labels)
        assert all((got[i][0] == "block") == (i % 4 == 0) for i, _ in urls), pattern
        assert got == brute(frame, labels)[0]


def test_large_baskets_are_cut_and_give_the_same_rules(spark, monkeypatch):
    """URLs with 30 frequent segments: FP-growth sees small sub-baskets, rules are those of all sets."""
    rng = random.Random(7)
    names = [f"s{k}" for k in range(40)]
    urls = [(i, f"https://h.net/{'/'.join(rng.sample(names, 30))}/") for i in range(60)]
    labels = spark.createDataFrame([(i, 0 if ("/s1/" in u and "/s2/" in u) or rng.random() < 0.1 else 1, 0) for i, u in urls], LABELS)
    frame = pages(spark, urls)
    assert judged(frame, labels) == brute(frame, labels)[0]
    monkeypatch.setattr(U, "BASKET_TOKENS", 4)
    some = pages(spark, [(i, f"https://h.net/{'/'.join(rng.sample(names[:8], 4))}/{i}") for i in range(200)])
    labels = spark.createDataFrame([(i, int(rng.random() < 0.3), 0) for i in range(200)], LABELS)
    want, rules = brute(some, labels)
    assert rules and judged(some, labels) == want


def test_edge_cases(spark):
    labels = spark.createDataFrame([(None, 0, 0), (1, None, None), (2, 0, 1), (2, 1, 0)], LABELS)
    frame = pages(spark, [(None, None), (None, "https://a.org/"), (2, "https://b.net/" + "p/" * 5000), (2, "https://b.net/q")]).selectExpr(
        "*", "1 as host", "2 as rule", "3 as tokens", "4 as row", "5 as key")
    out = U.judge(frame, labels)
    assert out.count() == 4 and out.where("verdict = 'block'").count() == 0
    assert U.judge(pages(spark, []), labels).count() == 0
