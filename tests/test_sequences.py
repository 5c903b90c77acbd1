"""Time-bucketed scans against brute force on a small fixture with dense and sparse keys."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventflow.operators.sequences import bucketed_row_number, next_within, previous_within


def _events(spark, n=400, seed=7):
    rnd = random.Random(seed)
    rows, t = [], 1_700_000_000_000
    for i in range(n):
        t += rnd.choice([1, 5, 50, 900, 4000, 20000])  # ms gaps, some far apart
        key = 0 if rnd.random() < 0.4 else rnd.randint(1, 5)  # key 0 is hot
        rows.append((i, key, t, rnd.choice(["a", "b"])))
    df = spark.createDataFrame(rows, "event_id long, k long, ms long, typ string")
    return df.withColumn("ts", F.timestamp_millis("ms")), rows


def test_previous_within_brute_force(spark):
    df, rows = _events(spark)
    h = 1000
    got = {r.event_id: (r.prev_event_id, r.prev_typ) for r in
           previous_within(df, ["k"], "ts", ["ts", "event_id"], h, ["event_id", "typ"]).collect()}
    by_key = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        by_key.setdefault(r[1], []).append(r)
    want = {}
    for evs in by_key.values():
        for i, r in enumerate(evs):
            p = evs[i - 1] if i else None
            want[r[0]] = (p[0], p[3]) if p and r[2] - p[2] < h else (None, None)
    assert got == want


def test_next_within_brute_force(spark):
    df, rows = _events(spark)
    h = 5000
    out = next_within(df, ["k"], "ts", ["ts", "event_id"], h, F.col("typ") == "b", ["event_id"])
    got = {r.event_id: r.next_event_id for r in out.collect()}
    want = {}
    for r in rows:
        later = [x for x in rows if x[1] == r[1] and x[3] == "b" and (x[2], x[0]) > (r[2], r[0])]
        nxt = min(later, key=lambda x: (x[2], x[0])) if later else None
        want[r[0]] = nxt[0] if nxt and nxt[2] - r[2] < h else None
    assert got == want


def test_bucketed_row_number(spark):
    df, _ = _events(spark)
    got = bucketed_row_number(df, ["k"], ["ts", "event_id"], F.floor(F.col("ms") / 3000), "rn")
    ref = df.withColumn("rn2", F.row_number().over(Window.partitionBy("k").orderBy("ts", "event_id")))
    j = got.join(ref.select("event_id", "rn2"), "event_id")
    assert j.count() == df.count()
    assert j.filter("rn <> rn2").count() == 0


def test_reconcile_partitions_both_inputs(spark):
    """Keys unique per side: every pay and every receipt is in exactly one outcome row."""
    from eventflow.operators.joins import reconcile
    from eventflow.sources.tables import pay_events, receipt_events
    from base_rows import SF_SMALL

    pays, receipts = pay_events(spark, SF_SMALL), receipt_events(spark, SF_SMALL)
    out = reconcile(pays, receipts, "tx_id", "ts", "60 days", "30 days")
    paid = out.filter("verdict in ('matched', 'unmatched_pay')")
    got = out.filter("verdict in ('matched', 'unmatched_receipt')")
    assert paid.count() == paid.select("pay_tx_id").distinct().count() == pays.count()
    assert got.count() == got.select("receipt_tx_id").distinct().count() == receipts.count()
    assert out.filter("verdict = 'matched'").count() > 0
