"""Naive (TIMESTAMP_NTZ) <-> instant (TIMESTAMP) conversions that ignore the session time zone.

Watermarks need TIMESTAMP; the data holds naive wall-clock times. A plain cast
goes through the session zone, where a wall-clock time can fall in a DST gap.
These helpers read naive times as UTC with integer arithmetic instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz_to_instant(c) -> Column:
    """The instant whose UTC wall-clock time is the naive value (fields read as UTC)."""
    x = _c(c)
    seconds = F.extract(F.lit("SECOND"), x)  # seconds with the microsecond fraction
    return F.make_timestamp(F.year(x), F.month(x), F.dayofmonth(x), F.hour(x), F.minute(x), seconds, F.lit("UTC"))


def ntz_micros(c) -> Column:
    """Microseconds since the epoch of a naive value read as UTC."""
    return F.unix_micros(ntz_to_instant(c))


def instant_to_ntz(c) -> Column:
    """The naive UTC wall-clock time of an instant."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(c)), F.expr(_EPOCH))


def ntz_text(c) -> Column:
    """'yyyy-MM-dd HH:mm:ss[.ffffff]' of a naive timestamp, with no zone conversion."""
    return _c(c).cast("string")
