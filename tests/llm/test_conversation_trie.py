import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tidemark.llm import conversation_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def digest(turn):
    role, text = turn
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(data):
    """Every prefix of every rebuilt conversation in a dictionary."""
    own = defaultdict(list)
    for c, n, role, text in data:
        if c is not None:
            turn = (role or "", text or "")
            own[c].append(((n is not None, n or 0, digest(turn)), turn))
    own = {c: [t for _, t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    saved, leaves = Counter(), Counter()
    for p, ms in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(ms) - 1) * words
            leaves[p[:d]] += not children[p]
    return sorted(((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), children[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(ms) if whole[c] == p).encode()).hexdigest())
                   for p, ms in members.items()), key=repr)


def run(spark, data, block_rows, parts=3):
    df = spark.createDataFrame(data, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        return rows(T.nodes(T.rebuilt(T.sequences(df)), block_rows), *COLUMNS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("block_rows", [1, 3, 1000])
def test_shared_prefixes_across_blocks(spark, block_rows):
    rng = random.Random(block_rows)
    data = []
    for c in range(90):
        n = rng.choice([0, 1, 2, 3, 5, 9])
        data += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} word " * rng.choice([1, 1, 1, 2])) for t in range(n)]
    data += [(c, t, "user", "common talk") for c in range(200, 240) for t in range(5)]  # copies of one conversation
    data += [(c, t, "user", "common talk") for c in range(300, 312) for t in range(c - 300)]  # each a prefix of the next
    assert run(spark, data, block_rows) == brute(data)


def test_nulls_ties_and_empty_conversations(spark):
    data = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", "same turn"), (1, 0, "user", "same turn"), (1, 0, "system", ""),
            (None, 1, "user", "no id"), (2, 5, "", ""), (2, -5, None, "neg"), (-7, 1, "user", "below zero"), (-20, 1, "user", "base"),
            (20, 1, "user", "x"), (21, 1, "user", "gone"), (23, 1, "user", "gone too"), (24, 1, "a", "bc"), (25, 1, "ab", "c"),
            (10 ** 12, 1, "user", "long id")]
    for block_rows in (1, 2, 50):
        assert run(spark, data, block_rows) == brute(data)


def test_long_conversation_and_long_text(spark):
    data = [(c, t, "user", f"t{t}") for c in (40, 41, 43) for t in range(600 - c)] + [(42, 0, "user", "word " * 200_000)]
    for block_rows in (1, 50):
        assert run(spark, data, block_rows) == brute(data)


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert T.trie(df).collect() == [] and T.trie(df).columns == list(COLUMNS)
    data = [(c, t, "user", f"t{t * (c % 2)}") for c in range(30) for t in range(3)]
    df = spark.createDataFrame(data, SCHEMA).withColumns({c: F.lit("x") for c in ("items", "key", "node", "n", "first", "base", "h")})
    assert rows(T.trie(df), *COLUMNS) == brute(data)


def test_unions_make_the_branching_nodes():
    """A block's forest: chains end where an edge unites them, in descending depth."""
    key = lambda s: b"".join(hashlib.md5(c.encode()).digest() + (1).to_bytes(8, "big") for c in s)
    keys = sorted(map(key, ["abc", "abd", "ab", "x", "abc"]))
    f = T.Forest({"ids": np.arange(5).tobytes(), "sizes": np.array([len(k) // T.ITEM for k in keys]).tobytes(), "keys": b"".join(keys),
                  "first": keys[0], "last": keys[-1], "before": None, "after": None})
    spans = {(int(h - lo + 1), int(low), int(b)) for lo, h, low, b in zip(f.lo, f.hi, f.low, f.birth)}
    assert spans == {(2, 2, 3), (1, 2, 3), (4, 0, 2), (1, 0, 1), (5, -1, 0)}
