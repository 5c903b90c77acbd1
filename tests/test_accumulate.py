"""User accumulators over windows against every window's rows taken one by one."""

import math
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest

from eventflow.operators.accumulate import Accumulator, accumulate, slide_over
from eventflow.operators.aggregates import truncated_mean_accumulator

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _spread(field="v"):
    """Greatest less smallest value; neither can be subtracted. (Inner functions reach the workers by value.)"""
    def add(state, row):
        v = row[field]
        return state if v is None else merge(state, (v, v, 1))

    def merge(a, b):
        if not a[2] or not b[2]:
            return a if a[2] else b
        return (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2])

    return Accumulator(create=lambda: (0, 0, 0), add=add, merge=merge, result=lambda s: s[1] - s[0] if s[2] else None,
                       state="low long, high long, n long", output="long")


def _events(n=600):
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{i % 5}")
        x = math.nan if i % 4 == 0 else float(i % 2)
        ts = None if i % 50 == 49 else START + timedelta(seconds=(i * i * 37) % 40_000)
        rows.append((key, x, None if i % 11 == 0 else (i * 7919) % 1000 - 500, ts))
    return rows


def _brute(rows, size, slide, value):
    held = defaultdict(list)
    for key, x, v, ts in rows:
        if ts is None:
            continue
        t = int(ts.timestamp() * 1000)
        end = t - t % slide + slide
        while end <= t - t % slide + size:
            held[(key, "nan" if x != x else x, end - size, end)].append(v)
            end += slide
    return {k: value([v for v in vs if v is not None]) for k, vs in held.items()}


def _got(df):
    return {(r.key, "nan" if r.x != r.x else r.x, r.window_start, r.window_end): r.value for r in df.collect()}


@pytest.mark.parametrize("slide, block, held", [(None, 8, 50_000), ("5 minutes", 8, 50_000), ("5 minutes", 1, 3), ("20 minutes", 2, 1)])
def test_windows_against_brute_force(spark, slide, block, held):
    rows = _events()
    df = spark.createDataFrame(rows, "key string, x double, v long, ts timestamp").repartition(3)
    slide_ms = {None: 3_600_000, "5 minutes": 300_000, "20 minutes": 1_200_000}[slide]
    got = accumulate(df, ["key", "x"], "ts", "1 hour", _spread(), ["v"], slide, block_windows=block, held=held)
    found = got.collect()
    assert len(found) == len(_got(got))  # one row a window
    assert _got(got) == _brute(rows, 3_600_000, slide_ms, lambda vs: max(vs) - min(vs) if vs else None)
    means = accumulate(df, ["key", "x"], "ts", "1 hour", truncated_mean_accumulator("v"), ["v"], slide, block_windows=block, held=held)
    assert _got(means) == _brute(rows, 3_600_000, slide_ms, lambda vs: float(math.trunc(sum(vs) / len(vs))) if vs else None)


def test_one_exchange_and_empty_table(spark):
    empty = spark.createDataFrame([], "key string, v long, ts timestamp, window_end string")
    got = accumulate(empty, ["key"], "ts", "1 hour", _spread(), ["v"], "5 minutes", out="spread")
    assert got.columns == ["key", "window_start", "window_end", "spread"] and got.collect() == []
    # A key and a field whose names clash with the operator's own columns.
    rows = [("a", 5, START, "w"), ("a", 9, START, "w")]
    df = spark.createDataFrame(rows, "_end string, _t long, ts timestamp, window string")
    got = accumulate(df, ["_end"], "ts", "1 hour", _spread("_t"), ["_t"], out="_block")
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert [(r["_end"], r["_block"]) for r in got.collect()] == [("a", 4)]


def test_merges_stay_linear():
    """A window that holds all panes costs some two merges a step, not one for every pane."""
    calls = [0]

    def merge(a, b):
        calls[0] += 1
        return (a[0] + b[0],)

    panes = [(i, (1,)) for i in range(1, 1001)]
    got = list(slide_over(panes, 1, 1499, 500, 1, merge))
    assert [s[0] for _, s in got] == [min(e, 500, 1500 - e) for e in range(1, 1500)] and calls[0] < 5000
