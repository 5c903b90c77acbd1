"""Two connected streams with one state: reconciliation against the batch form, timers in their order."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from eventflow.operators.joins import reconcile
from eventflow.plans.orderpay import PAY_WAIT, RECEIPT_WAIT
from eventflow.plans.streams import reconcile_stream
from eventflow.sources.tables import pay_events, receipt_events
from eventflow.streaming.connected import LEFT, RIGHT, Context, connected_fold, reconcile_connected, tagged, verdicts
from eventflow.streaming.runner import checkpoint_for, run_available

from base_rows import SF_SMALL

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def _at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def _run(spark, tmp_path, name, build, schemas, spans):
    """Append each span's rows to the two inputs and run the query on to their end."""
    for sides in spans:
        for k, (schema, rows) in enumerate(zip(schemas, sides)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / f"in{k}"))
        streams = [spark.readStream.schema(schema).parquet(str(tmp_path / f"in{k}")) for k, schema in enumerate(schemas)]
        got = run_available(build(*streams), name, path=str(tmp_path / "out"))
    return got


def test_reconciliation_of_small_streams(spark, tmp_path):
    """Several rows a key on both sides, equal times, rows at the very ends of the waits, empty and null keys, rows
    without a time, a column of one name on both sides."""
    pays = [[("a", 1, _at(0)), ("a", 2, _at(10)), ("b", 3, _at(0)), ("", 4, _at(1)), (None, 5, _at(2)), ("c", 6, None), ("d", 7, _at(20)), ("d", 7, _at(20))],
            [("a", 8, _at(60)), ("e", 9, _at(61)), ("f", 10, _at(62))], [("z", 99, _at(10_000))]]
    receipts = [[("a", 1.5, _at(5)), ("a", 2.5, _at(10)), ("b", 3.5, _at(51)), ("d", None, _at(15)), ("g", 4.5, _at(3)), ("", 5.5, _at(4))],
                [("a", 6.5, _at(112)), ("e", 7.5, _at(113)), ("f", 8.5, _at(57))], [("z", 9.5, _at(9_000))]]
    schemas = ["tx_id string, n long, ts timestamp", "tx_id string, n double, ts timestamp"]
    found = _run(spark, tmp_path, "connected-small", lambda p, r: reconcile_connected(p, r, delay="1 minute"), schemas, list(zip(pays, receipts)))
    columns = ["pay_tx_id", "pay_n", "pay_ts", "receipt_tx_id", "receipt_n", "receipt_ts"]
    got = sorted((tuple(r) for r in verdicts(found, columns).collect()), key=str)
    whole = [spark.createDataFrame([r for part in rows for r in part], schema).where("ts is not null") for rows, schema in zip((pays, receipts), schemas)]
    want = reconcile(*whole).withColumns({c: F.unix_millis(c) for c in ("pay_ts", "receipt_ts")}).select("verdict", *columns)
    want = sorted((tuple(r) for r in want.collect() if "z" not in (r.pay_tx_id, r.receipt_tx_id)), key=str)
    assert [r for r in got if "z" not in r] == want and {r[0] for r in want} == {"matched", "unmatched_pay", "unmatched_receipt"}
    assert {(r.pay_tx_id, r.pay_n) for r in tagged(found, "unmatched_pay").collect()} >= {("e", 9)}


def test_whole_table_equals_batch_form(spark):
    """Q19's three outputs, but for rows whose wait the stream's end does not close."""
    def rows(df):
        return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

    columns = ["tx_id", "verdict", "pay_order_id", "pay_ts", "receipt_pay_channel", "receipt_ts"]
    pays, receipts = pay_events(spark, SF_SMALL), receipt_events(spark, SF_SMALL)
    mark = pays.select("ts").unionAll(receipts.select("ts")).agg(F.max(F.unix_millis("ts"))).first()[0]
    batch = reconcile(pays, receipts, "tx_id", "ts", PAY_WAIT, RECEIPT_WAIT).withColumns({c: F.unix_millis(c) for c in ("pay_ts", "receipt_ts")})
    days = lambda n: n * 86_400_000
    over = F.when(F.col("verdict") == "matched", F.greatest("pay_ts", "receipt_ts")).otherwise(F.coalesce(F.col("pay_ts") + days(60), F.col("receipt_ts") + days(30)))
    got = rows(reconcile_stream(spark, SF_SMALL))
    assert got == rows(batch.where(over < mark)) and {r[1] for r in got} == {"matched", "unmatched_pay", "unmatched_receipt"}


def test_timers_fire_in_their_place(spark, tmp_path):
    """One timer a side: in time order among the rows, after rows of their own time, by the watermark alone at the end;
    a timer set again is only at its new time; null keys are keys."""
    def on_left(ctx, row):
        ctx.state["seen"] = ctx.state.get("seen", "") + row["what"]
        ctx.set_timer(LEFT, ctx.time + 10_000_000)

    def on_right(ctx, row):
        ctx.emit("rows", seen=ctx.state.get("seen"), what=row["what"])
        ctx.set_timer(RIGHT, ctx.time + 4_000_000)

    def on_timer(ctx, side):
        ctx.emit("timers", side=side, at=ctx.time // 1_000_000 - base, seen=ctx.state.get("seen"))
        if side == LEFT:
            ctx.state.clear()

    base = int(START.timestamp())
    schemas = ["k string, what string, ts timestamp"] * 2
    left = [[(None, "a", _at(0)), (None, "b", _at(5)), ("x", "q", _at(2))], [(None, "c", _at(40)), ("end", "-", _at(500))]]
    right = [[(None, "r", _at(11))], [(None, "s", _at(15)), (None, "t", _at(16)), (None, "u", _at(50))]]
    found = _run(spark, tmp_path, "connected-timers", lambda p, r: connected_fold(
        p, r, ["k"], "ts", on_left, on_right, on_timer, {"rows": "seen string, what string", "timers": "side string, at long, seen string"}, "1 hour"), schemas, list(zip(left, right)))
    assert found.count() == 0  # an hour of delay: nothing is over
    late = [[("far", "-", _at(10_000))], []]
    found = _run(spark, tmp_path, "connected-timers", lambda p, r: connected_fold(
        p, r, ["k"], "ts", on_left, on_right, on_timer, {"rows": "seen string, what string", "timers": "side string, at long, seen string"}, "1 hour"), schemas, [late])
    rows = {(r.what, r.seen) for r in tagged(found, "rows").collect()}
    # The left timer of b is at 15, after the row s of that time; c sets it anew, to 50, after the row u.
    assert rows == {("r", "ab"), ("s", "ab"), ("t", None), ("u", "c")}
    timers = {(r.side, r.at, r.seen) for r in tagged(found, "timers").collect()}
    assert timers == {(LEFT, 12, "q"), (LEFT, 15, "ab"), (RIGHT, 20, None), (LEFT, 50, "c"), (RIGHT, 54, None), (LEFT, 510, "-")}


def test_buckets_of_keys_give_the_same(spark, tmp_path):
    """Many keys share a bucket's call and state row, each with a state of its own: the outputs are those of a group a
    key, over three spans, with waits that the watermark alone ends, null and empty keys, equal times."""
    rng = random.Random(3)
    keys = [f"k{k}" for k in range(60)] + ["", None]
    spans = [[[(rng.choice(keys), n, _at(span * 200 + rng.randrange(200))) for n in range(150)] for _ in range(2)] for span in range(3)]
    spans.append([[("end", 0, _at(5000))], [(None, None, None)]])
    schemas = ["tx_id string, n long, ts timestamp"] * 2
    columns = ["pay_tx_id", "pay_n", "pay_ts", "receipt_tx_id", "receipt_n", "receipt_ts"]
    got = {}
    for buckets in (None, 3):
        found = _run(spark, tmp_path / str(buckets), f"connected-buckets-{buckets}", lambda p, r: reconcile_connected(p, r, delay="1 minute", buckets=buckets), schemas, spans)
        got[buckets] = sorted((tuple(r) for r in verdicts(found, columns).collect()), key=str)
    assert got[3] == got[None] and {r[0] for r in got[3]} == {"matched", "unmatched_pay", "unmatched_receipt"}
    held = {}
    for buckets in (None, 3):  # before the watermark moves on, all rows are in state
        _run(spark, tmp_path / f"held{buckets}", f"connected-held-{buckets}", lambda p, r: reconcile_connected(p, r, delay="1 day", buckets=buckets), schemas, spans[:1])
        held[buckets] = spark.read.format("statestore").load(checkpoint_for(spark, f"connected-held-{buckets}")).count()
    assert held[3] <= 3 < held[None]


def test_buckets_keep_keys_and_nulls_apart(spark, tmp_path):
    """Keys of several columns, null parts and texts that look alike, all in one bucket."""
    def on_left(ctx, row):
        ctx.state["n"] = ctx.state.get("n", 0) + 1
        ctx.emit("rows", k=row["k"], j=row["j"], n=ctx.state["n"])

    rows = [("1", 1, _at(1)), ("1", 1, _at(2)), ("1", None, _at(3)), (None, 1, _at(4)), (None, None, _at(5)), ("null", 1, _at(6)), ('1","1', 1, _at(7)), (None, 1, _at(8)), ("z", 9, _at(100))]
    found = _run(spark, tmp_path, "connected-keys", lambda p, r: connected_fold(
        p, r, ["k", "j"], "ts", on_left, on_left, lambda ctx, side: None, {"rows": "k string, j long, n long"}, buckets=1),
        ["k string, j long, ts timestamp"] * 2, [[rows, []]])
    want = [("1", 1, 1), ("1", 1, 2), ("1", None, 1), (None, 1, 1), (None, None, 1), ("null", 1, 1), ('1","1', 1, 1), (None, 1, 2), ("z", 9, 1)]
    assert sorted((tuple(r) for r in tagged(found, "rows").collect()), key=str) == sorted(want, key=str)


def test_timers_of_the_past_are_refused():
    ctx = Context({}, [])
    ctx.time = 5
    ctx.set_timer(LEFT, 5)
    with pytest.raises(ValueError):
        ctx.set_timer(LEFT, 4)
