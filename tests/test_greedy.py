"""Greedy windows by composed block functions against a plain scan."""

import random

from eventflow.operators.greedy import greedy_windows


def _scan(times, width):
    out = []
    for t in sorted(times):
        if out and t <= out[-1][0] + width:
            out[-1] = (out[-1][0], t, out[-1][2] + 1)
        else:
            out.append((t, t, 1))
    return out


def test_groups_of_every_length_against_a_scan(spark):
    rnd, width, groups = random.Random(4), 10, {}
    for k, n in enumerate([1, 1, 2, 3, 5, 9, 17, 40, 600]):
        for seed in range(3):
            t, own = rnd.randint(-50, 50), []
            for _ in range(n):
                own.append(t)
                t += rnd.choice([0, 1, 2, 3, 9, 10] if seed else [10])  # ten: the widest gap a group may have
            groups[(own[0], k * 3 + seed, None if k % 2 else "x")] = own
    df = spark.createDataFrame([(*g, t) for g, own in groups.items() for t in own], "a long, i long, b string, t long")
    got = greedy_windows(df, ["a", "i", "b"], "a", "t", width)
    rows = sorted(((r.a, r.i, r.b, r.start, r.end, r.n) for r in got.collect()), key=str)
    assert rows == sorted(((*g, *w) for g, own in groups.items() for w in _scan(own, width)), key=str)


def test_one_unbroken_group_is_many_tasks_work(spark):
    """Exchanges are keyed by (group, point) or (group, block); no Python worker is in the plan."""
    df = spark.range(2_000).selectExpr("cast(0 as long) as a", "id * 3 as t").repartition(4)
    got = greedy_windows(df, ["a"], "a", "t", 10)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "MapInPandas" not in plan
    keys = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert keys and any("_t#" in k for k in keys) and any("_b#" in k for k in keys)
    assert got.count() == 500 and got.agg({"n": "sum"}).first()[0] == 2_000


def test_no_points(spark):
    assert greedy_windows(spark.createDataFrame([], "a long, t long"), ["a"], "a", "t", 5).count() == 0
