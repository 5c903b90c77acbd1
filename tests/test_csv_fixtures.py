"""Expected results on the rows of ``fixture_rows``, parsed by SRC3-SRC6; worked out by hand."""

from pyspark.sql import functions as F

from eventflow.operators.caps import click_cap
from eventflow.operators.joins import interval_join, reconcile
from eventflow.operators.patterns import (login_fail_burst, login_fail_consecutive, match_followed_by,
                                          match_next, order_deadline_verdict, pay_event_verdict)
from eventflow.plans.market import ad_clicks_by_province
from eventflow.operators.windows import windowed_count
from eventflow.sources.text import AD_CLICK, LOGIN, ORDER, RECEIPT, parse_delimited

from base_rows import csv_lines


def table(spark, name, schema):
    """A sample input parsed by the library's line parser; the line number is the tie-break."""
    parsed = parse_delimited(csv_lines(spark, name), schema, keep=("line_no",))
    return parsed.withColumnRenamed("line_no", "event_id")


def test_ad_clicks_by_province(spark):
    clicks = table(spark, "ad", AD_CLICK)
    out = windowed_count(clicks, ["province"], "ts", "1 hour", "5 seconds")
    # north: ends 5..3610 s after the base and 720 on the next day; south: ends 5..3630 s.
    assert out.count() == 722 + 720 + 726
    agg = out.agg(F.sum("count"), F.max("count")).first()
    assert (agg[0], agg[1]) == (10 * 720, 7)
    five = windowed_count(clicks.filter("province = 'north'"), ["province"], "ts", "1 hour", "5 minutes")
    got = sorted((r.window_end // 1000, r["count"]) for r in five.collect())
    assert [c for _, c in got] == [7] * 12 + [1] * 12
    assert got[0][0] == 1700000100 and got[12][0] == 1700006700
    text = ad_clicks_by_province(clicks, "1 hour", "5 seconds").first().window_end
    assert text.endswith(".0") and len(text) == 21


def test_click_cap_as_written_and_drop_all(spark):
    clicks = table(spark, "ad", AD_CLICK)
    c = click_cap(clicks, ("user_id", "ad_id"), "ts", "event_id", 3, "as_written")
    warn = c.filter("verdict = 'blacklist'").collect()
    assert len(warn) == 1
    w = warn[0]  # the fifth click in event time arrives last
    assert (w.user_id, w.ad_id, w.event_id, w.ts_sec, w.msg) == (11, 500, 10, 1700000005, "Click over 3 times today")
    passed = c.filter("verdict = 'pass'")
    assert passed.count() == 9 and passed.filter("province = 'north'").count() == 7
    d = click_cap(clicks, ("user_id", "ad_id"), "ts", "event_id", 3, "drop_all")
    assert {r.verdict: r["count"] for r in d.groupBy("verdict").count().collect()} == {"pass": 8, "blacklist": 1, "dropped": 1}


def test_login_fail_burst(spark):
    logins = table(spark, "login", LOGIN)
    out = login_fail_burst(logins, window="2 seconds", max_failed=2).collect()
    assert sorted((r.user_id, r.first_fail // 1000, r.last_fail // 1000, r.msg) for r in out) == [
        (21, 1700000100, 1700000102, "Login fails in 2 seconds 2 times"),
        (23, 1700000110, 1700000112, "Login fails in 2 seconds 3 times")]


def test_login_fail_consecutive_and_pattern(spark):
    logins = table(spark, "login", LOGIN)
    a = login_fail_consecutive(logins, gap="2 seconds").collect()
    b = match_next(logins, "user_id", "ts", "event_type", "fail", "fail", "2 seconds").collect()
    pairs = sorted((r.user_id, r.first_fail // 1000 - 1700000000, r.last_fail // 1000 - 1700000000) for r in a)
    assert pairs == [(23, 110, 111), (23, 111, 112), (23, 112, 113)]
    assert sorted((r.user_id, r.first_ts // 1000 - 1700000000, r.second_ts // 1000 - 1700000000) for r in b) == pairs
    assert {r.msg for r in a} == {"Login fails in 2 seconds"} and {r.msg for r in b} == {"login fail"}


def test_order_followed_by(spark):
    orders = table(spark, "order", ORDER)
    out = match_followed_by(orders, "order_id", "ts", "event_type", "create", "pay", "15 minutes").collect()
    assert {r.order_id: r.verdict for r in out} == {"o1": "paid", "o2": "timeout", "o3": "timeout", "o5": "paid"}
    assert {r.result_msg for r in out} == {" order payed successfully", " order timeout"}


def test_order_deadline_verdict(spark):
    orders = table(spark, "order", ORDER)
    out = order_deadline_verdict(orders, "order_id", "ts", "event_type", "15 minutes").collect()
    assert {r.order_id: r.verdict for r in out} == {"o1": "paid", "o2": "timeout", "o3": "timeout", "o5": "paid"}


def test_pay_event_verdict(spark):
    orders = table(spark, "order", ORDER)
    out = pay_event_verdict(orders, "order_id", "ts", "event_type", "15 minutes").collect()
    assert {r.order_id: r.verdict for r in out} == {"o1": "success", "o2": "timeout", "o4": "success", "o5": "success", "o6": "success"}


def test_reconcile_and_interval_join(spark):
    pays = table(spark, "order", ORDER).filter("event_type = 'pay'")
    receipts = table(spark, "receipt", RECEIPT)
    r = reconcile(pays, receipts, "tx_id", "ts", "51 seconds", "5 seconds")
    got = sorted((x.verdict, x.tx_id) for x in r.collect())  # the pay without a transaction is in no row
    assert got == [("matched", "t1"), ("matched", "t2"), ("matched", "t5"), ("unmatched_pay", "t4"),
                   ("unmatched_receipt", "t4"), ("unmatched_receipt", "t9")]
    j = interval_join(pays, receipts, "tx_id", "ts", "ts", "-5 seconds", "5 seconds")
    assert {x.l_tx_id: x.r_ts_sec - x.l_ts_sec for x in j.collect()} == {"t1": 3, "t2": -5}
