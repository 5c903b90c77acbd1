"""Retract streams: what each batch writes, replays, snapshots, and Q4's rankings as changes."""

import time
from collections import Counter
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from eventflow.plans.hotitems import hot_items_sql
from eventflow.plans.streams import hot_items_changes
from eventflow.sources.tables import user_behavior
from eventflow.streaming.changelog import ChangeLog, rising_ranking_writer
from eventflow.streaming.runner import run_available
from eventflow.streaming.windows import stream_windowed_count

from base_rows import SF_SMALL

SCHEMA = "w long, item string, n long"


def _log(tmp_path):
    return ChangeLog(str(tmp_path / "log"), SCHEMA, ["w", "item"], F.floor(F.col("w") / 10))


def _ops(spark, log, batch):
    rows = log.changes(spark).where(F.col("_batch") == batch).collect()
    return sorted(((r._op, r.w, r.item, r.n) for r in rows), key=str)


def _now(spark, log, upto=None):
    return sorted(((r.w, r.item, r.n) for r in log.current(spark, upto).collect()), key=str)


def test_changes_of_batches_and_replay(spark, tmp_path):
    log, frame = _log(tmp_path), lambda rows: spark.createDataFrame(rows, SCHEMA)
    groups = lambda *w: spark.createDataFrame([(x,) for x in w], "w long")
    assert _now(spark, log) == []
    log.upsert(frame([(1, "a", 1), (1, None, 2), (20, "a", 3)]), 0)
    assert _ops(spark, log, 0) == [("+I", 1, "a", 1), ("+I", 1, None, 2), ("+I", 20, "a", 3)]
    for _ in range(2):  # run again: the same changes, once
        log.upsert(frame([(1, "a", 5), (1, None, 2), (2, "b", 7)]), 1)
        assert _ops(spark, log, 1) == [("+I", 2, "b", 7), ("+U", 1, "a", 5), ("-U", 1, "a", 1)]
    log.upsert(frame([]), 2)
    log.replace(frame([(1, "c", 9)]), groups(1, 2), 3)  # group 1 has one row now, group 2 none
    assert _ops(spark, log, 3) == [("+I", 1, "c", 9), ("-D", 1, "a", 5), ("-D", 1, None, 2), ("-D", 2, "b", 7)]
    assert _now(spark, log) == [(1, "c", 9), (20, "a", 3)]
    assert _now(spark, log, 1) == [(1, "a", 5), (1, None, 2), (2, "b", 7), (20, "a", 3)]
    log.compact(spark, 3)
    log.forget(spark)
    assert log.changes(spark).count() == 0 and _now(spark, log) == [(1, "c", 9), (20, "a", 3)]
    log.upsert(frame([(2, "b", 1), (20, "a", 4)]), 4)
    assert _ops(spark, log, 4) == [("+I", 2, "b", 1), ("+U", 20, "a", 4), ("-U", 20, "a", 3)]
    assert _now(spark, log) == [(1, "c", 9), (2, "b", 1), (20, "a", 4)]


def test_rankings_retract_items_that_fall_out(spark):
    """Added up, the changes are the table: a retract consumer that adds and subtracts rows ends with Q4's rows.
    With two places a window, later batches move items and push some out."""
    log = hot_items_changes(spark, SF_SMALL, n=2)
    total = Counter()
    changes = log.changes(spark).collect()
    for r in changes:
        total[(r.window_end, r.row_num, r.item_id, r.cnt)] += 1 if r._op in ("+I", "+U") else -1
    assert {r._op for r in changes} == {"+I", "-U", "+U", "-D"} and len({r._batch for r in changes}) >= 4
    want = hot_items_sql(spark, user_behavior(spark, SF_SMALL, "pv"), "1 hour", 2).collect()
    want = {(r.window_end, r.row_num, r.item_id, r.cnt) for r in want}
    assert want == {row for row, k in total.items() if k} and set(total.values()) <= {0, 1}
    assert want == {(r.window_end, r.row_num, r.item_id, r.cnt) for r in log.current(spark).collect()}


def test_rising_rankings_against_whole_counts(spark, tmp_path):
    """Batch by batch, the kept rows give the ranking of all counts so far; unchanged rankings write nothing."""
    ranks = ChangeLog(str(tmp_path / "ranks"), "w long, item string, n long, rank long", ["w", "item"], F.floor(F.col("w") / 10))
    write = rising_ranking_writer(ranks, 2, "w", "n", ["item"], compact_every=3)
    totals, names = Counter(), ["a", "b", "c", None, "e"]
    for batch in range(7):
        changed = {}
        for i in range(30 if batch != 4 else 0):
            k = ((i * i * (batch + 2) + i) % 4 * 9, names[(i * (batch + 3) + batch) % 5])
            totals[k] += 1
            changed[k] = totals[k]
        rows = spark.createDataFrame([(w, item, n, "more") for (w, item), n in changed.items()], "w long, item string, n long, other string")
        for _ in range(2 if batch == 5 else 1):  # run again: the same rows
            write(rows, batch)
        want = []
        for w in {w for w, _ in totals}:
            best = sorted(((-n, item is not None, item or "", item) for (v, item), n in totals.items() if v == w))[:2]
            want += [(w, item, -n, k + 1) for k, (n, _, _, item) in enumerate(best)]
        got = [(r.w, r.item, r.n, r["rank"]) for r in ranks.current(spark).collect()]
        assert sorted(got, key=str) == sorted(want, key=str), batch
    # An item that stays behind: nothing is written.
    write(spark.createDataFrame([(0, "new", 1, "")], "w long, item string, n long, other string"), 7)
    assert ranks.changes(spark).where("_batch = 7").count() == 0


def test_late_rows_correct_rankings_until_the_lateness_has_passed(spark, tmp_path):
    """Windows of a minute with a minute of lateness: a row within it corrects its window, one beyond it does not, and
    the state store lets go of the windows that are over."""
    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    files = [[("a", 5), ("b", 6), ("a", 7)], [("c", 100)], [("b", 8), ("b", 9), ("a", 130)],  # b: late, within the lateness
             [("a", 400)], [("c", 400)], [("c", 10)] * 5, [("b", 410)]]  # c at 10 s: beyond it
    for rows in files:
        part = spark.createDataFrame([(u, start + timedelta(seconds=s)) for u, s in rows], "url string, ts timestamp")
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(1.1)  # the file source orders files by modification time
    stream = spark.readStream.schema("url string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = stream_windowed_count(stream, ["url"], "ts", "1 minute", delay="0 seconds", lateness="1 minute")
    ranks = ChangeLog(str(tmp_path / "ranks"), "window_end long, rank long, url string, count long", ["window_end", "url"])
    write, held = rising_ranking_writer(ranks, 1, "window_end", "count", ["url"]), []

    def counted(batch, batch_id):
        write(batch, batch_id)
        held.append(batch_id)

    run_available(counts, "late-rankings", "update", counted)
    base = int(start.timestamp() * 1000)
    got = {((r.window_end - base) // 1000, r["rank"], r.url, r["count"]) for r in ranks.current(spark).collect()}
    assert got == {(60, 1, "b", 3), (120, 1, "c", 1), (180, 1, "a", 1), (420, 1, "a", 1)} and len(held) >= len(files)
    first = [(r._op, r.url, r["count"]) for r in ranks.changes(spark).where(F.col("window_end") == base + 60_000).orderBy("_batch", "_op").collect()]
    assert first == [("+I", "a", 2), ("+I", "b", 3), ("-D", "a", 2)]
