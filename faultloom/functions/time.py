"""Time expressions. The session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to an instant; text that is no instant becomes null."""
    return F.try_to_timestamp(text)


def iso(ts: Column) -> Column:
    """An instant as ISO-8601 text with microseconds and a Z."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def revision_tag(ts: Column) -> Column:
    """ISO week of an instant, such as 2026-W17. The year is the week's, not the day's."""
    year = F.extract(F.lit("YEAROFWEEK"), ts).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
