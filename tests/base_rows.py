"""What the tests outside ``tests/llm`` share: the small tables' folder and lines of the fixture inputs."""

import fixture_rows

SF_SMALL = "/root/testdata/sf0.001"


def csv_lines(spark, name):
    """One of the inputs of ``fixture_rows``: a ``value`` row per line plus its line number."""
    text = {"ad": fixture_rows.AD_CLICKS, "login": fixture_rows.LOGINS,
            "order": fixture_rows.ORDERS, "receipt": fixture_rows.RECEIPTS}[name]
    lines = [ln for ln in text.splitlines() if ln.strip()]
    return spark.createDataFrame([(i + 1, ln) for i, ln in enumerate(lines)], "line_no long, value string")
