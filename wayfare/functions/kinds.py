"""The narrowest type that holds the values of several others."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# decimal digits of the whole types, narrowest first
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 20}
_MOST_DIGITS = 38


def _digits(kind: T.DataType) -> tuple[int, int]:
    """Digits before and after the decimal point."""
    return (kind.precision - kind.scale, kind.scale) if isinstance(kind, T.DecimalType) else (_DIGITS[kind], 0)


def common_type(kinds: Iterable[T.DataType]) -> T.DataType:
    """The type that several types widen to.

    Whole types widen to the longest; with decimals, to a decimal that holds both sides; with floating-point numbers, or
    beyond 38 digits, to double. Dates and times without a zone widen to the latter. All else meets as text. A time with
    and one without a zone have no common type, as the zone to assume is not in the data.
    """
    different = [k for k in dict.fromkeys(kinds) if not isinstance(k, T.NullType)]
    if not different:
        return T.StringType()
    if len(different) == 1:
        return different[0]
    if all(k in _DIGITS for k in different):
        return max(different, key=_DIGITS.__getitem__)
    if all(k in _DIGITS or isinstance(k, T.DecimalType) for k in different):
        before, after = (max(side) for side in zip(*map(_digits, different)))
        return T.DecimalType(before + after, after) if before + after <= _MOST_DIGITS else T.DoubleType()
    if all(isinstance(k, T.NumericType) for k in different):
        return T.DoubleType()
    if set(map(type, different)) == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if {T.TimestampType, T.TimestampNTZType} <= set(map(type, different)):
        raise TypeError("times with and without a zone have no common type")
    return T.StringType()


def holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether every value of ``narrow`` is in ``wide`` as it is, by the types alone."""
    if wide == narrow or isinstance(narrow, T.NullType):
        return True
    if wide in _DIGITS and narrow in _DIGITS:
        return _DIGITS[wide] >= _DIGITS[narrow]
    if isinstance(wide, T.DecimalType) and (narrow in _DIGITS or isinstance(narrow, T.DecimalType)):
        return all(w >= n for w, n in zip(_digits(wide), _digits(narrow)))
    if isinstance(wide, T.DoubleType):
        return isinstance(narrow, T.FloatType) or (narrow in _DIGITS and _DIGITS[narrow] <= 10)
    return isinstance(wide, T.TimestampNTZType) and isinstance(narrow, T.DateType)
