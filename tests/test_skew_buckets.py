"""Whole-history folds split a key's history into time buckets: the answer must not depend
on the bucket width, including when one key holds a third of all rows."""

import random

from pyspark.sql import functions as F

from eventflow.operators.caps import click_cap
from eventflow.operators.patterns import login_fail_burst, order_deadline_verdict, pay_event_verdict
from eventflow.sources.tables import login_events, order_events

from base_rows import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _skewed_orders(spark, n=1500, seed=3):
    rnd = random.Random(seed)
    rows, t = [], 1_700_000_000_000_000
    for i in range(n):
        t += rnd.choice([1, 30, 600, 3600, 40000]) * 1_000_000
        key = 0 if rnd.random() < 1 / 3 else rnd.randint(1, 40)   # key 0: a third of the rows
        rows.append((i, key, "create" if rnd.random() < 0.5 else "pay", t))
    return (spark.createDataFrame(rows, "event_id long, order_id long, event_type string, us long")
                 .withColumn("ts", F.timestamp_micros("us")))


def test_pay_and_deadline_verdicts_independent_of_bucket(spark):
    for df, within in ((order_events(spark, SF_SMALL), "1 day"), (_skewed_orders(spark), "1 hour")):
        base18 = _rows(pay_event_verdict(df, within=within, bucket="400 days"))
        base17 = _rows(order_deadline_verdict(df, within=within, bucket="400 days"))
        assert base18 and base17
        for b in ("10 minutes", "1 hour", "1 day"):
            assert _rows(pay_event_verdict(df, within=within, bucket=b)) == base18
            assert _rows(order_deadline_verdict(df, within=within, bucket=b)) == base17


def test_burst_independent_of_bucket(spark):
    logins = login_events(spark, SF_SMALL)
    skewed = _skewed_orders(spark).select(
        "event_id", F.col("order_id").alias("user_id"),
        F.when(F.col("event_type") == "pay", "fail").otherwise("success").alias("event_type"), "ts")
    for df, w in ((logins, "6 hours"), (skewed, "2 hours")):
        base = _rows(login_fail_burst(df, window=w, bucket="400 days"))
        assert base
        for b in ("1 minute", "1 hour", "1 day"):
            assert _rows(login_fail_burst(df, window=w, bucket=b)) == base


def test_click_cap_independent_of_bucket(spark):
    df = _skewed_orders(spark).withColumnRenamed("order_id", "user_id")
    base = _rows(click_cap(df, ("user_id",), max_count=5, bucket="1 day"))
    for b in ("1 minute", "1 hour"):
        assert _rows(click_cap(df, ("user_id",), max_count=5, bucket=b)) == base


def _brute_bursts(rows, w_us, n):
    """Greedy windows per key and run of fails without a success, events by (time, id)."""
    out = []
    for key in {r[1] for r in rows}:
        opened = []
        def close():
            if len(opened) >= n:
                out.append((key, opened[0] // 1000, opened[-1] // 1000, len(opened)))
        for _, _, kind, t in sorted((r for r in rows if r[1] == key and r[3] is not None), key=lambda r: (r[3], r[0])):
            if kind != "fail" or opened and t > opened[0] + w_us:
                close()
                opened = []
            if kind == "fail":
                opened.append(t)
        close()
    return sorted(out, key=str)


def test_burst_with_equal_seconds_null_keys_and_long_segments(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice([1, 1, 2, 3, None]), "fail" if rnd.random() < 0.7 else "success",
             None if rnd.random() < 0.01 else (1_700_000_000 + rnd.randint(0, 700)) * 1_000_000) for i in range(3000)]
    rows += [(10_000 + k, 9, "fail", (1_700_000_000 + k) * 1_000_000) for k in range(5000)]  # a key failing without pause
    df = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, us long").withColumn("ts", F.timestamp_micros("us"))
    got = sorted(((r.user_id, r.first_fail, r.last_fail, int(r.msg.split()[-2])) for r in login_fail_burst(df, window="2 seconds", max_failed=2).collect()), key=str)
    assert got == _brute_bursts(rows, 2_000_000, 2)
    assert sum(g[0] == 9 for g in got) == 5000 // 3 + 1  # windows of three fails, the last one of two


def test_verdicts_with_null_keys(spark):
    rows = [(1, None, "create", 0), (2, None, "pay", 7200), (3, 7, "create", 0), (4, 7, "pay", 7200), (5, None, "create", 90000), (6, None, "pay", 90060)]
    df = spark.createDataFrame(rows, "event_id long, order_id long, event_type string, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000))
    got = sorted(((r.order_id, r.verdict) for r in pay_event_verdict(df, within="15 minutes").collect()), key=str)
    assert got == [(7, "timeout"), (None, "success"), (None, "timeout")]
    got = sorted(((r.order_id, r.verdict) for r in order_deadline_verdict(df, within="15 minutes").collect()), key=str)
    assert got == [(7, "timeout"), (None, "timeout")]  # the later create finds an unexpired pay: absorbed


def test_pay_verdict_against_the_state_machine(spark):
    rnd = random.Random(8)
    rows = [(i, rnd.randint(1, 30), rnd.choice(["create", "pay"]), rnd.randint(0, 40) * 600) for i in range(1500)]
    df = spark.createDataFrame(rows, "event_id long, order_id long, event_type string, s long").withColumn("ts", F.timestamp_seconds(F.col("s") + 1_700_000_000))
    want, state = [], {}
    for i, key, kind, t in sorted(rows, key=lambda r: (r[3], r[2] != "create", r[0])):
        paid, deadline = state.get(key, (False, None))
        if kind == "create":
            state[key] = (False, None) if paid else (False, t + 3600)
        else:
            ok = deadline is None or t < deadline
            want.append((key, 1000 * (t + 1_700_000_000), "success" if ok else "timeout"))
            state[key] = (ok, None)
    assert sorted((r.order_id, r.pay_ts, r.verdict) for r in pay_event_verdict(df, within="1 hour").collect()) == sorted(want)


def test_click_cap_keeps_rows_with_null_keys_and_times(spark):
    rows = [(1, 1, 5, 10), (2, 1, None, 11), (3, None, 5, 12), (4, 1, 5, None), (5, 1, None, 13), (6, 1, 5, 14)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, ad_id long, s long").withColumn("ts", F.timestamp_seconds("s"))
    got = {r.event_id: r.click_no for r in click_cap(df, ("user_id", "ad_id")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 2, 6: 2}


def test_interval_join_forms_against_brute_force_with_a_hot_key(spark):
    from eventflow.operators.joins import interval_join

    rnd = random.Random(2)
    def side(n, seed):
        r = random.Random(seed)
        return [(i, 0 if r.random() < 0.4 else r.choice([1, 2, 3, None]), None if r.random() < 0.02 else r.randint(0, 4000)) for i in range(n)]
    a, b = side(300, 1), side(300, 2)
    make = lambda rows: spark.createDataFrame(rows, "i long, k long, s long").withColumn("ts", F.timestamp_seconds("s"))
    lo, hi = -rnd.randint(1, 9), rnd.randint(1, 9)
    pairs = sorted((x[0], y[0]) for x in a for y in b if None not in (x[1], y[1], x[2], y[2]) and x[1] == y[1] and lo <= y[2] - x[2] <= hi)
    join = lambda how: interval_join(make(a), make(b), "k", "ts", "ts", f"{lo} seconds", f"{hi} seconds", how)
    assert sorted((r.l_i, r.r_i) for r in join("inner").collect()) == pairs
    lone_a = {x[0] for x in a} - {p[0] for p in pairs}
    lone_b = {x[0] for x in b} - {p[1] for p in pairs}
    assert sorted(r.l_i for r in join("left_anti").collect()) == sorted(lone_a)
    full = [(r.l_i, r.r_i) for r in join("full_outer").collect()]
    assert sorted(full, key=str) == sorted(pairs + [(i, None) for i in lone_a] + [(None, i) for i in lone_b], key=str)


def test_a_growing_folder_is_read_anew(spark, tmp_path):
    from eventflow.sources.tables import table

    path = f"{tmp_path}/events.parquet"
    spark.range(10).write.parquet(path)
    assert table(spark, str(tmp_path), "events").count() == 10
    spark.range(5).write.mode("append").parquet(path)
    assert table(spark, str(tmp_path), "events").count() == 15


def test_a_restarted_stream_goes_on(spark, tmp_path):
    from eventflow.streaming.runner import run_available

    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    spark.range(10).write.parquet(src)
    stream = lambda: spark.readStream.schema("id long").parquet(src)
    name = f"restart-{tmp_path.name}"
    assert run_available(stream(), name, path=out).count() == 10
    spark.range(10, 15).write.mode("append").parquet(src)
    assert sorted(r.id for r in run_available(stream(), name, path=out).collect()) == list(range(15))
