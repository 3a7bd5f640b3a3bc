"""Types that can hold the values of two others without loss."""

from __future__ import annotations

from pyspark.sql import types as T

# Each type can hold all values of those before it. Fixed order.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Decimal digits that a whole number of each type may need; up to which a double is exact.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_MOST_DIGITS = 38


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The least type that holds what either holds, None if there is none.

    Whole numbers widen to wider ones and to decimals, ``float`` and whole numbers of up to 32 bits to
    ``double``, decimals to ones with more digits on either side of the point, days to times without
    a zone; arrays, maps and structs widen by their parts. Text holds no number, nor a number text:
    what is written as one would be read as the other.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {T.ByteType, T.ShortType, T.IntegerType, T.FloatType, T.DoubleType}:
        # 24 bits of a float are too few for an int.
        return T.DoubleType()
    if kinds <= {*_WHOLE, T.DecimalType}:
        return _decimal(_as_decimal(a), _as_decimal(b))
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if len(kinds) > 1:
        return None
    if isinstance(a, T.ArrayType):
        item = wider(a.elementType, b.elementType)
        return item and T.ArrayType(item, a.containsNull or b.containsNull)
    if isinstance(a, T.MapType):
        key, value = wider(a.keyType, b.keyType), wider(a.valueType, b.valueType)
        return T.MapType(key, value, a.valueContainsNull or b.valueContainsNull) if key and value else None
    if isinstance(a, T.StructType) and [n.lower() for n in a.names] == [n.lower() for n in b.names]:
        parts = [wider(x.dataType, y.dataType) for x, y in zip(a, b, strict=True)]
        if all(parts):
            return T.StructType([T.StructField(f.name, p, True) for f, p in zip(a, parts, strict=True)])
    return None


def _as_decimal(t: T.DataType) -> T.DecimalType:
    return t if isinstance(t, T.DecimalType) else T.DecimalType(_DIGITS[type(t)], 0)


def _decimal(a: T.DecimalType, b: T.DecimalType) -> T.DecimalType | None:
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    return T.DecimalType(digits, scale) if digits <= _MOST_DIGITS else None
