"""Timestamp literals without time zones.

The warehouse keeps Oracle ``DATE`` semantics: a wall-clock time to the second,
no zone.  Literals are built from text and cast to ``timestamp_ntz`` so no
session or Python zone can shift them; Catalyst folds the cast, so a filter on
such a literal still reaches the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

_FORMAT = "%Y-%m-%d %H:%M:%S"


def to_stamp_text(value: str | _dt.datetime | _dt.date) -> str:
    """Normalise a stamp to ``yyyy-MM-dd HH:mm:ss`` text, truncated to seconds.

    A stamp with a zone, or text with anything more than a date and a time, is an
    error: dropping the rest would silently mean another instant.
    """
    if isinstance(value, _dt.datetime):
        if value.tzinfo is not None:
            raise ValueError(f"stamp with a time zone: {value.isoformat()}")
        return value.replace(microsecond=0).strftime(_FORMAT)
    if isinstance(value, _dt.date):
        return _dt.datetime(value.year, value.month, value.day).strftime(_FORMAT)
    text = str(value).strip()
    if len(text) == 10:
        text += " 00:00:00"
    return _dt.datetime.strptime(text, _FORMAT).strftime(_FORMAT)


def next_second(stamp: str) -> str:
    """The stamp one second later."""
    return to_stamp_text(_dt.datetime.strptime(stamp, _FORMAT) + _dt.timedelta(seconds=1))


def ntz_literal(value: str | _dt.datetime | _dt.date) -> Column:
    """A ``timestamp_ntz`` literal (F4: ``to_date('1900-01-01','YYYY-MM-DD')``)."""
    return F.lit(to_stamp_text(value)).cast("timestamp_ntz")


def as_ntz(value: str | _dt.datetime | _dt.date | Column | None) -> Column:
    """Accept a literal or a column; ``None`` gives a typed NULL."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return ntz_literal(value)


def current_second() -> Column:
    """``sysdate``: the local wall clock truncated to seconds, as ``timestamp_ntz``.

    ``date_trunc`` returns a zoned timestamp, so cast back.  Pipelines pass a
    fixed ``load_ts`` instead, so one run has one stamp.
    """
    return F.date_trunc("SECOND", F.localtimestamp()).cast("timestamp_ntz")
