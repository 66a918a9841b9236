"""ISO-8601 text -> typed values without failing the job on bad input.

Spark 4 runs with ANSI on, where ``to_timestamp`` raises on a malformed
string.  The try_* forms return NULL instead, so one bad record drops out of
the fact (its date is NULL) instead of failing a 100 TB run.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant_utc(text: Column | str) -> Column:
    """Parse an ISO-8601 instant (``Z`` or ``+hh:mm`` offset) to a UTC wall-clock
    ``TIMESTAMP_NTZ``.  Relies on the session time zone being UTC
    (``clipstar.session.pin_semantics``)."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text).cast("timestamp_ntz")


def written_date(text: Column | str) -> Column:
    """The calendar date as written in the string, ignoring its offset.

    ``2026-07-24T23:30:00-05:00`` gives 2026-07-24 although the instant falls
    on 07-25 in UTC: event dates follow the source's own day boundary.
    """
    return F.try_to_date(F.col(text) if isinstance(text, str) else text)


def iso_millis(ts: Column | str) -> Column:
    """Format a timestamp the way the event API writes ``received_at``."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_seconds_offset(ts: Column | str) -> Column:
    """Format a timestamp the way the media API writes ``created``/``updated``."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
