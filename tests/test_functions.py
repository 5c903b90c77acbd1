import pytest
from pyspark.sql import functions as F

from eventflow.functions.hashing import poly_hash
from eventflow.functions.text import is_not_static
from eventflow.functions.time import duration_ms, java_timestamp_text, next_midnight_ms
from eventflow.sources.text import AD_CLICK, ORDER, parse_access_log, parse_delimited


def _wrapped_hash(s, seed=67, bits=29):
    res = 0
    for ch in s:
        res = (res * seed + ord(ch)) & 0xFFFFFFFFFFFFFFFF  # 64-bit wrap
    return res & ((1 << bits) - 1)


def test_duration_ms():
    assert duration_ms("1 hour") == 3_600_000
    assert duration_ms("5 seconds") == 5000
    assert duration_ms("30 days") == 30 * 86_400_000
    with pytest.raises(ValueError):
        duration_ms("soon")


def test_poly_hash_matches_wrapped_long(spark):
    ids = ["1", "543462", "12345678901234567890", "937166", "x"]
    for bits in (5, 27, 29):
        got = spark.createDataFrame([(s,) for s in ids], "s string").select(
            "s", poly_hash("s", 67, bits).alias("h")).collect()
        assert {r.s: r.h for r in got} == {s: _wrapped_hash(s, 67, bits) for s in ids}


def test_java_timestamp_text(spark):
    df = spark.createDataFrame([(1511658000000,), (1511658000500,), (1511658000120,), (1511658000007,)], "ms long")
    got = [r.t for r in df.select(java_timestamp_text("ms").alias("t")).collect()]
    assert got == ["2017-11-26 01:00:00.0", "2017-11-26 01:00:00.5", "2017-11-26 01:00:00.12",
                   "2017-11-26 01:00:00.007"]


def test_next_midnight(spark):
    df = spark.createDataFrame([(1511658000000,)], "ms long")
    assert df.select(next_midnight_ms("ms").alias("m")).first().m == 1511740800000


def test_static_url_filter(spark):
    urls = ["/a/b.css", "/a/b.css?v=1", "/x.js", "/img.png", "/favicon.ico", "/index.html", "/", "/a.cssx"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    kept = {r.url for r in df.filter(is_not_static("url")).collect()}
    assert kept == {"/a/b.css?v=1", "/index.html", "/", "/a.cssx"}


def test_parse_keeps_empty_field(spark):
    lines = spark.createDataFrame([(" 34729 , create ,, 1558430842",)], "value string")
    r = parse_delimited(lines, ORDER).first()
    assert (r.order_id, r.event_type, r.tx_id, r.ts_sec) == ("34729", "create", "", 1558430842)


def test_parse_failfast_and_permissive(spark):
    lines = spark.createDataFrame([("1,2,beijing,beijing,1511658000",), ("x,2,a,b,3",), ("1,2",)], "value string")
    good, bad = parse_delimited(lines, AD_CLICK, mode="permissive", with_rejects=True)
    assert good.count() == 1 and bad.count() == 2
    with pytest.raises(Exception):
        parse_delimited(lines, AD_CLICK).collect()


def test_parse_access_log(spark):
    line = "83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/logstash-monitorama-2013/images/kibana-search.png"
    r = parse_access_log(spark.createDataFrame([(line,)], "value string")).first()
    assert r.ip == "83.149.9.216" and r.method == "GET"
    assert r.event_time == 1431857103000
    assert r.url.endswith("kibana-search.png")
