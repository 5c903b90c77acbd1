"""Fixed texts and text predicates (SC7, SC10, TK3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- Fixed values: these must equal the reference's output texts and patterns. ----
# URL filter: keep a URL unless it ends in a static-resource extension (SC7, FLT4).
NOT_STATIC_URL = r"^((?!\.(css|js|ico|png)$).)*$"
# Ranking report pieces (TK3).
REPORT_TIME_PREFIX = "时间："
REPORT_ITEM_LABEL = " 商品id="
REPORT_URL_LABEL = " URL="
REPORT_COUNT_LABEL = " 浏览量="
REPORT_FOOTER = "======================"
# Order verdict messages (leading space is part of the text).
MSG_ORDER_PAID = " order payed successfully"
MSG_ORDER_TIMEOUT = " order timeout"
# Warning texts; the numbers are filled from parameters.
MSG_CLICK_CAP = "Click over {max_count} times today"
MSG_LOGIN_BURST = "Login fails in {seconds} seconds {count} times"
MSG_LOGIN_CONSECUTIVE = "Login fails in {seconds} seconds"
MSG_LOGIN_PATTERN = "login fail"
# Marketing channels and behaviours of the simulated source, and the total labels.
CHANNELS = ("Play Store", "AppStore")
TOTAL_CHANNEL, TOTAL_BEHAVIOR = "app", "total"
# ------------------------------------------------------------------------------------


def is_not_static(url: Column | str) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    return url.rlike(NOT_STATIC_URL)


def seconds_text(ms: int) -> str:
    """Whole seconds of a duration, as the warning texts print them."""
    return str(ms // 1000) if ms % 1000 == 0 else str(ms / 1000)
