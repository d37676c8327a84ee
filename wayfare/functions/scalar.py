"""Time, text and surrogate-key expressions.

Differences of timestamps without zone do not depend on the session zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: ColumnLike) -> Column:
    """Whole seconds since the epoch; fractions are dropped."""
    return F.unix_timestamp(_col(ts))


def duration_minutes_whole(start: ColumnLike, end: ColumnLike) -> Column:
    """Minutes between two timestamps, counted in whole seconds."""
    return (epoch_seconds(end) - epoch_seconds(start)) / F.lit(60.0)


def duration_minutes_exact(start: ColumnLike, end: ColumnLike) -> Column:
    """Minutes between two timestamps, keeping microseconds."""
    seconds = (_col(end) - _col(start)).cast("interval second").cast("decimal(18,6)")
    return (seconds * 1_000_000).cast("bigint") / F.lit(60_000_000.0)


def sunday_based_weekday(day: ColumnLike) -> Column:
    """Day of week with Sunday = 0."""
    return F.dayofweek(_col(day)) - 1


def is_weekend(day: ColumnLike) -> Column:
    return F.dayofweek(_col(day)).isin(1, 7)


def month_name(day: ColumnLike) -> Column:
    """English month name, blank-padded to nine characters."""
    return F.rpad(F.date_format(_col(day), "MMMM"), 9, " ")


def day_name(day: ColumnLike) -> Column:
    """English weekday name, blank-padded to nine characters."""
    return F.rpad(F.date_format(_col(day), "EEEE"), 9, " ")


def varchar(text: ColumnLike, length: int) -> Column:
    """Text cut to ``length`` characters, as an SQL ``varchar(length)`` cast does."""
    return F.left(_col(text).cast("string"), F.lit(length))


def initials(name: ColumnLike) -> Column:
    """Mask a person's name: ``Ann Bo -> A.B.``, ``Ann -> A.``, NULL stays NULL."""
    name = _col(name)
    words = F.split(name, " ")
    dotted = [F.concat(F.substring(F.get(words, F.lit(i)), 1, 1), F.lit(".")) for i in (0, 1)]
    return F.when(F.size(words) >= 2, F.concat(*dotted)).otherwise(dotted[0])


def rate_key(vendor: ColumnLike, passengers: ColumnLike) -> Column:
    """Derived rate-code key: 1 for vendor 1, else 1..5 from the passenger count (NULL when that is NULL)."""
    return F.when(_col(vendor).try_cast("int") == 1, F.lit(1)).otherwise(_col(passengers).try_cast("int") % 5 + 1)


def payment_key(passengers: ColumnLike) -> Column:
    """Derived payment-type key: 1 or 2 from the passenger count (NULL when that is NULL)."""
    return _col(passengers).try_cast("int") % 2 + 1
