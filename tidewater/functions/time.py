"""Time conversions used across the warehouse.

Everything follows the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed text formats of the warehouse.
DATE_FMT = "yyyy-MM-dd"
DATETIME_FMT = "yyyy-MM-dd HH:mm:ss"
DAY_INT_FMT = "yyyyMMdd"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ms_to_ts(ms) -> Column:
    """Epoch milliseconds -> timestamp."""
    return F.timestamp_millis(col_(ms))


def s_to_ts(sec) -> Column:
    """Epoch seconds -> timestamp."""
    return F.timestamp_seconds(col_(sec))


def ms_to_date(ms) -> Column:
    """Epoch milliseconds -> 'yyyy-MM-dd' text."""
    return F.date_format(ms_to_ts(ms), DATE_FMT)


def text_to_ts(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' or 'yyyy-MM-dd' text -> timestamp; bad text -> null."""
    t = col_(text)
    return F.coalesce(F.try_to_timestamp(t, F.lit(DATETIME_FMT)),
                      F.try_to_timestamp(t, F.lit(DATE_FMT)))


def text_to_ms(text) -> Column:
    """Date or date-time text -> epoch milliseconds."""
    return F.unix_millis(text_to_ts(text))


def fraction_ts(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss.f..Z' text, with any number of decimals, -> timestamp (F15): .04
    and .040 are the same time. Bad text -> null."""
    return F.regexp_replace(col_(text), "Z$", "").try_cast("timestamp")


def not_earlier(a, b) -> Column:
    """Whether text time ``a`` is not before ``b``, compared as times."""
    return fraction_ts(a) >= fraction_ts(b)


def text_to_date(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'yyyy-MM-dd' (F7)."""
    return F.date_format(text_to_ts(text), DATE_FMT)


def first_token(text) -> Column:
    """Text before the first space."""
    return F.substring_index(col_(text), " ", 1)


def today_int() -> Column:
    """Default report day: today as yyyyMMdd."""
    return F.date_format(F.current_date(), DAY_INT_FMT).cast("int")


def tumble(ts, length: str = "10 seconds") -> Column:
    """Tumbling event-time window aligned to the epoch."""
    return F.window(col_(ts), length)


def window_text(win: str = "win") -> list[Column]:
    """stt/edt text of a window struct column."""
    return [F.date_format(F.col(f"{win}.start"), DATETIME_FMT).alias("stt"),
            F.date_format(F.col(f"{win}.end"), DATETIME_FMT).alias("edt")]


def whole_days_between(cur_date, last_date) -> Column:
    """Whole days between two dates."""
    return F.datediff(F.to_date(col_(cur_date)), F.to_date(col_(last_date)))
