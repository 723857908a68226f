import math
import random
from collections import Counter

from pyspark.sql import functions as F

from tidemark.llm import pfair_mix as M

from .helpers import documents


def placed(df):
    return sorted(((r["__mix_slot"], r["__mix_rank"], r.source, r["__mix_block"], r.doc_id) for r in df.collect()))


def check(out, weights, default, block, sizes):
    """Slots are dense, blocks whole and in order, deviation under one block in every phase."""
    slots = {}
    for slot, rank, source, b, _ in out:
        slots.setdefault(slot, (source or "", b, []))[2].append(rank)
    assert sorted(slots) == list(range(len(slots)))
    left = {s: -(-n // block) for s, n in sizes.items()}
    n, start, active = Counter(), 0, dict(left)
    done = Counter()
    for t in range(len(slots)):
        s, b, ranks = slots[t]
        assert b == done[s] and sorted(ranks) == list(range(len(ranks)))
        assert len(ranks) == block or b == left[s] - 1
        done[s] += 1
        n[s] += 1
        total = sum(weights.get(x, default) for x in active)
        for x in active:
            assert abs(n[x] - weights.get(x, default) / total * (t + 1 - start)) < 1
        if done[s] == left[s]:  # a source is used up: a new phase
            del active[s]
            n, start = Counter(), t + 1
    assert done == Counter(left)


def test_period_is_a_pfair_schedule(spark):
    for weights in ((1,), (3, 5), (5,) + (1,) * 19, (7, 7, 2, 11)):
        total, n = sum(weights), Counter()
        pattern = M.period(spark, weights)
        for t, i in enumerate(pattern):
            assert n[i] * total // weights[i] <= t < math.ceil((n[i] + 1) * total / weights[i])
            n[i] += 1
            assert all(abs(n[k] - w * (t + 1) / total) < 1 for k, w in enumerate(weights))
        assert [n[k] for k in range(len(weights))] == list(weights)


def test_mix_of_uneven_sources(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 50)
    rng = random.Random(1)
    sizes = {"a": 700, "b": 120, "c": 41, "d": 3}
    docs = [(i, f"t{i}", "en", s) for i, s in enumerate(rng.sample([s for s, n in sizes.items() for _ in range(n)], sum(sizes.values())))]
    out = M.place(documents(spark, docs), {"a": 2, "b": 3}, 1, block_rows=8)
    check(placed(out), {"a": 2, "b": 3}, 1, 8, sizes)
    again = M.place(documents(spark, docs).repartition(7), {"a": 2, "b": 3}, 1, block_rows=8)
    assert placed(again) == placed(out)  # the same whatever the partitions
    order = [r.doc_id for r in M.mixed(documents(spark, docs), {"a": 2, "b": 3}, 1, block_rows=8).collect()]
    assert order == [x[4] for x in placed(out)]


def test_query_on_the_given_table(spark):
    from tidemark.llm.queries import MIX_DEFAULT, MIX_WEIGHTS, op10_pfair_mix

    sf = "/root/testdata/sf0.01"
    sizes = {r.source: r["count"] for r in spark.read.parquet(f"{sf}/documents.parquet").groupBy("source").count().collect()}
    out = op10_pfair_mix(spark, sf).select(F.col("slot").alias("__mix_slot"), F.col("rank").alias("__mix_rank"), "source",
                                           F.col("block").alias("__mix_block"), "doc_id")
    check(placed(out), MIX_WEIGHTS, MIX_DEFAULT, M.BLOCK_ROWS, sizes)


def test_edge_cases(spark):
    docs = [(None, None, "en", None), (None, "x", "en", None), (1, "a", "en", "s"), (1, "a", "en", "s"), (2, "z" * 99999, "en", "s")]
    frame = documents(spark, docs).selectExpr("*", "1 as left", "2 as offsets", "3 as first_block", "4 as period")
    out = M.place(frame, {"": 2}, 1, block_rows=2)
    check(placed(out), {"": 2}, 1, 2, {"": 2, "s": 3})
    assert M.mixed(frame, {}).columns == frame.columns and M.mixed(frame, {}).count() == 5
    assert M.mixed(documents(spark, []), {}).count() == 0


def test_weights_without_a_meaning_are_refused(spark):
    import pytest

    docs = documents(spark, [(1, "x", "en", "a")])
    for weights, default in (({"a": 0}, 1), ({"a": -3}, 1), ({}, 0), ({"a": 1.5}, 1)):
        with pytest.raises(ValueError, match="weights"):
            M.place(docs, weights, default)


def test_positions_of_a_frame_have_no_gaps(spark):
    docs = documents(spark, [(i, f"t{i}", "en", "a") for i in range(40)]).repartition(5)
    assert sorted(r.position for r in M.with_position(docs.where("doc_id > 9")).collect()) == list(range(30))


def test_period_equals_a_plain_simulation(spark):
    """Earliest deadline first over the released blocks, one slot after the other."""
    for weights in ((1,), (3, 5), (5,) + (1,) * 19, (7, 7, 2, 11), (2, 3, 4, 5, 6)):
        total, given, plain = sum(weights), [0] * len(weights), []
        for t in range(total):
            ready = [(math.ceil((given[i] + 1) * total / w), i) for i, w in enumerate(weights) if given[i] * total // w <= t]
            i = min(ready)[1]
            given[i] += 1
            plain.append(i)
        assert M.period(spark, weights) == plain


def many_sources(m, most, seed):
    rng = random.Random(seed)
    return [(f"h{i:04d}", rng.choice([1, 1, 1, 1, 2, 3, 7]), rng.randint(0, most)) for i in range(m)]


def plain_order(sources):
    """(source, block) slot by slot: earliest deadline first over the groups of equal weight, turns by falling block counts."""
    groups = {}
    for s, w, n in sorted(sources):
        if n:
            groups.setdefault(w, []).append((-n, s))
    queues = []
    for w, g in groups.items():
        g.sort()
        queues.append((w, [(s, j) for j in range(-g[0][0]) for n, s in g if j < -n]))
    size = {s: n for s, _, n in sources}
    out = []
    live = [len(groups[w]) for w, _ in queues]
    while any(live):
        weights = [w * k for (w, _), k in zip(queues, live)]
        total, given, t = sum(weights), [0] * len(live), 0
        while True:
            ready = [(math.ceil((given[i] + 1) * total / w), i) for i, w in enumerate(weights) if w and given[i] * total // w <= t]
            i = min(ready)[1]
            s, j = queues[i][1].pop(0)
            out.append((s, j))
            given[i] += 1
            t += 1
            if j == size[s] - 1:
                live[i] -= 1
                break
    return out


def slots_of(sources):
    """(source, block) slot by slot, from the tables that the rows are joined with."""
    members, steps, ends = M.turns(sources)
    at = {}
    for g, used, n, offsets, total, first in M.phases(ends):
        for p in range(n):
            at[g, used + p] = first + p // len(offsets) * total + offsets[p % len(offsets)]
    size, out = {s: n for s, _, n in sources}, {}
    for s, g, r in members:
        for j in range(size[s]):
            (lo, k, base), = [(lo, k, base) for h, lo, hi, k, base in steps if h == g and lo <= j < hi]
            out[at[g, base + (j - lo) * k + r]] = (s, j)
    assert sorted(out) == list(range(len(out)))
    return [out[t] for t in range(len(out))]


def test_turns_and_phases_equal_a_plain_simulation():
    for m, most, seed in ((1, 5, 0), (2, 9, 1), (7, 40, 2), (40, 12, 3), (40, 3, 4), (12, 300, 5)):
        sources = many_sources(m, most, seed)
        assert slots_of(sources) == plain_order(sources)
    alike = [(f"s{i}", 1, 4) for i in range(9)]
    assert slots_of(alike) == plain_order(alike)


def test_a_thousand_sources_are_planned_within_seconds():
    import time

    sources, start = many_sources(1000, 400, 6), time.time()
    _, steps, ends = M.turns(sources)
    plan = list(M.phases(ends))
    assert time.time() - start < 10
    assert len(steps) <= 1000 and len(plan) <= 1000 * len(ends)
    assert sum(n for _, _, n, *_ in plan) == sum(n for *_, n in sources)


def test_many_sources_without_a_broadcast(spark, monkeypatch):
    sources = [x for x in many_sources(150, 9, 7) if x[2]]
    docs = [(i, f"t{i}", "en", s) for i, s in enumerate(s for s, _, n in sources for _ in range(2 * n - 1))]
    weights = {s: w for s, w, _ in sources}
    sizes = {s: 2 * n - 1 for s, _, n in sources}
    out = placed(M.place(documents(spark, docs), weights, block_rows=2))
    check(out, weights, 1, 2, sizes)
    monkeypatch.setattr(M, "BROADCAST_NUMBERS", 0)
    monkeypatch.setattr(M, "BROADCAST_ROWS", 0)
    assert placed(M.place(documents(spark, docs), weights, block_rows=2)) == out
