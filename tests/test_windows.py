from pyspark.sql import functions as F

from eventflow.operators.windows import sliding_agg, tumbling_agg, windowed_count
from eventflow.sources.tables import user_behavior

from base_rows import SF_SMALL


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_sliding_methods_agree(spark):
    ev = user_behavior(spark, SF_SMALL).select("behavior", "ts", "event_id")
    cols = ["behavior", "window_start", "window_end", "count"]
    for size, slide in (("1 hour", "5 minutes"), ("10 minutes", "5 seconds")):
        a = _rows(windowed_count(ev, ["behavior"], "ts", size, slide, method="steps"), cols)
        b = _rows(windowed_count(ev, ["behavior"], "ts", size, slide, method="pane"), cols)
        c = _rows(windowed_count(ev, ["behavior"], "ts", size, slide, method="direct"), cols)
        assert a == b == c


def test_sliding_count_invariant(spark):
    ev = user_behavior(spark, SF_SMALL)
    n = ev.count()
    c = windowed_count(ev, ["behavior"], "ts", "1 hour", "10 seconds")
    assert c.agg(F.sum("count")).first()[0] == n * 360


def test_sliding_sum_min_max(spark):
    ev = user_behavior(spark, SF_SMALL).withColumn("v", F.col("event_id") % 7)
    aggs = (("s", "sum", "v"), ("lo", "min", "v"), ("hi", "max", "v"), ("n", "count", None))
    got = sliding_agg(ev, ["behavior"], "ts", "1 hour", "5 minutes", aggs)
    direct = sliding_agg(ev, ["behavior"], "ts", "1 hour", "5 minutes", aggs, method="direct")
    cols = ["behavior", "window_end", "s", "lo", "hi", "n"]
    assert _rows(got, cols) == _rows(direct, cols)
    steps = sliding_agg(ev, ["behavior"], "ts", "1 hour", "5 minutes", (("s", "sum", "v"), ("n", "count", None)))
    assert _rows(steps, ["behavior", "window_end", "s", "n"]) == _rows(direct, ["behavior", "window_end", "s", "n"])


def test_tumbling_matches_window(spark):
    ev = user_behavior(spark, SF_SMALL)
    t = tumbling_agg(ev, ["behavior"], "ts", "1 hour")
    w = ev.groupBy("behavior", F.window("ts", "1 hour").alias("w")).count().select(
        "behavior", F.unix_millis("w.end").alias("window_end"), "count")
    assert _rows(t, ["behavior", "window_end", "count"]) == _rows(w, ["behavior", "window_end", "count"])


def test_sliding_values_with_nan_nulls_and_mixed_magnitudes(spark):
    rows = [(k, "a" if k % 3 else "b", [0.1, 1e16, float("nan"), None, -3.5][k % 5] if k < 60 else None, None if k % 2 else k, 1_700_000_000 + 37 * k) for k in range(120)]
    df = spark.createDataFrame(rows, "id long, k string, x double, n long, s long").withColumn("ts", F.timestamp_seconds("s"))
    aggs = (("sx", "sum", "x"), ("mx", "avg", "x"), ("sn", "sum", "n"), ("u", "approx_distinct", "n"))
    got = {(r.k, r.window_end): r for r in sliding_agg(df, ["k"], "ts", "10 minutes", "1 minute", aggs).collect()}
    direct = {(r.k, r.window_end): r for r in sliding_agg(df, ["k"], "ts", "10 minutes", "1 minute", aggs[:3], method="direct").collect()}
    assert got.keys() == direct.keys()
    for w, r in direct.items():
        for c in ("sx", "mx"):
            a, b = r[c], got[w][c]
            assert (a is None) == (b is None) and (a is None or str(a) == str(b) or abs(a - b) <= 1e-9 * abs(a))
        assert r.sn == got[w].sn
    exact = {(r.k, r.window_end): r.sn for r in sliding_agg(df, ["k"], "ts", "10 minutes", "1 minute", (("sn", "sum", "n"),)).collect()}
    assert exact == {w: r.sn for w, r in direct.items()}  # steps: a window of nulls stays null
