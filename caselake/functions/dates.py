"""Date parsing and calendar keys.

A calendar key is a pure function of the date, so facts compute it inline
instead of joining the calendar; the calendar's range still decides whether a
key exists.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar range, the "nothing loaded yet" watermark and text formats.
CALENDAR_START = dt.date(2000, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)
EPOCH_WATERMARK = dt.datetime(1900, 1, 1)
COMPACT_FORMATS = ("yyyyMMdd HH:mm", "yyyyMMdd")
COMPACT_STAMP, COMPACT_DAY = r"^\d{8} \d{2}:\d{2}$", r"^\d{8}$"


def parse_timestamp(c: str | Column) -> Column:
    """ISO text or one of the compact formats; NULL when nothing fits.

    The form is told by its shape: trying one parser after the other would raise
    and catch an error on every row of a feed in the other form.
    """
    text = _text(c)
    stamped, plain = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in COMPACT_FORMATS]
    iso = text.try_cast("timestamp_ntz")
    return F.when(text.rlike(COMPACT_STAMP), stamped).when(text.rlike(COMPACT_DAY), plain).otherwise(iso)


def parse_date(c: str | Column) -> Column:
    text = _text(c)
    stamped, plain = [F.to_date(F.try_to_timestamp(text, F.lit(f))) for f in COMPACT_FORMATS]
    iso = text.try_cast("date")
    return F.when(text.rlike(COMPACT_STAMP), stamped).when(text.rlike(COMPACT_DAY), plain).otherwise(iso)


def date_skey(c: str | Column) -> Column:
    """yyyyMMdd as INT for dates inside the calendar, else NULL."""
    d = F.to_date(F.col(c) if isinstance(c, str) else c)
    key = F.year(d) * 10000 + F.month(d) * 100 + F.day(d)
    return F.when(d.between(F.lit(CALENDAR_START), F.lit(CALENDAR_END)), key).cast("int")


def skey_date(c: str | Column) -> Column:
    """The calendar date behind a key."""
    k = F.col(c) if isinstance(c, str) else c
    return F.make_date((k / 10000).cast("int"), (k / 100).cast("int") % 100, k % 100)


def _text(c: str | Column) -> Column:
    return F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
