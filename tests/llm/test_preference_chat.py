import random

from tidemark.llm import preference_chat as P

SCHEMA = "conv_id long, turn long, role string, text string"


def render(turns):
    return "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for r, t in turns)


def spans(turns):
    out, at = [], 0
    for r, t in turns:
        block = render([(r, t)])
        if r == "assistant":
            out.append(f"{at + len('<|im_start|>' + r) + 1}:{at + len(block) - 1}")
        at += len(block)
    return ",".join(out)


def brute(rows):
    convs = {}
    for c, n, r, t in sorted((x for x in rows if x[0] is not None), key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] or "user", x[3] or "")):
        convs.setdefault(c, []).append((r or "user", t or ""))
    groups, out = {}, []
    for c in sorted(convs):
        groups.setdefault(convs[c][0], []).append(c)
    for ids in groups.values():
        for k in range(0, len(ids), 2):
            two = sorted(ids[k:k + 2], key=lambda c: (-len(convs[c]), c))
            a = convs[two[0]]
            if len(two) == 2:
                b = convs[two[1]]
            else:
                says = [i for i, (r, _) in enumerate(a) if r == "assistant"]
                b = a if not says else a[:says[-1]] + ([a[says[-2]]] if len(says) > 1 else [])
            n = 0
            while n < min(len(a), len(b)) and a[n] == b[n]:
                n += 1
            out.append((two[0], two[1] if len(two) == 2 else None, n, render(a[:n]), render(a[n:]), spans(a[n:]), render(b[n:]), spans(b[n:])))
    return sorted(out, key=repr)


def run(spark, rows):
    out = P.preferences(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as turns", "2 as chosen", "3 as block"))
    return sorted(((r.chosen_id, r.rejected_id, r.n_common, r.prompt, r.chosen, r.chosen_mask, r.rejected, r.rejected_mask)
                   for r in out.collect()), key=repr)


def test_random_conversations_with_common_openings(spark):
    rng, rows = random.Random(8), []
    for c in range(150):
        for t in range(rng.randint(1, 6)):
            rows.append((c, t, "system" if t == 0 and c % 5 == 0 else ("user", "assistant")[t % 2],
                         "hello" if t == 0 and c % 3 else rng.choice(["yes\n", "no é😀", "maybe", ""]) + str(rng.randint(0, 2))))
    assert run(spark, rows) == brute(rows)


def test_siblings_are_paired_however_far_their_ids_are_apart(spark):
    """31 and 32, 5 and 5000: one opening leaves at most one conversation without a sibling."""
    rows = [(c, t, ("user", "assistant")[t], f"{'hello' if t == 0 else c}") for c in (31, 32) for t in range(2)]
    assert [r[:2] for r in run(spark, rows)] == [(31, 32)]
    rng, rows = random.Random(4), []
    for c in rng.sample(range(10 ** 12), 301):
        rows += [(c, 0, "user", "hello"), *[(c, t + 1, "assistant", "x") for t in range(rng.randint(0, 3))]]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = run(spark, rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == brute(rows) and sum(r[1] is None for r in got) == 1


def test_edge_cases(spark):
    rows = [(1, None, None, None), (1, 0, "assistant", None), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, 0, "user", "lost"),
            (3, 0, "user", "only"), (40, 0, "user", "same"), (41, 0, "user", "same"), (-5, 0, "user", "y" * 50000), (-5, 1, "assistant", "z")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_plan_has_no_python(spark):
    from tidemark.llm.queries import op3_url_rules, op5_preference_chat, op10_pfair_mix

    for query in (op3_url_rules, op5_preference_chat, op10_pfair_mix):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), plan
