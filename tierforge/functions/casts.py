"""Casts that turn malformed text into NULL whatever the session's ANSI setting is.

``try_cast`` does that too, but for integers and booleans it throws and catches an exception
for every text that does not parse, which costs some fifty times as much as the cast. Raw
files have columns full of such values, so there a pattern decides first, and only text that
should parse reaches the cast. For floating numbers the exception is cheap enough, and for
dates there is none.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a cast from text trims: blanks and control characters.
_EDGE = r"[\x00-\x20\x7f]*"

_DECIMAL = rf"^{_EDGE}[+-]?([0-9]+([.][0-9]*)?|[.][0-9]*){_EDGE}$"

# The texts a cast takes for a boolean.
_BOOLEAN = rf"(?i)^{_EDGE}(t|true|y|yes|1|f|false|n|no|0){_EDGE}$"


def whole_number(text: Column, to: T.DataType) -> Column:
    """Integer cast of text that cuts a fraction off (``'3.9'`` gives 3, ``'.5'`` gives 0).

    The branches go from the commonest text to the rarest, and those for common text mention
    no costly part twice: a filter, unlike a projection, would work it out twice.
    """
    digits = 9 if isinstance(to, T.IntegerType) else 18  # that many never overflow
    whole = F.substring_index(text, ".", 1)
    wide = whole.try_cast("bigint")
    if isinstance(to, T.IntegerType):
        # A narrowing cast that overflows throws as well.
        wide = F.when(wide.between(-(2**31), 2**31 - 1), wide.cast(to))
    cut = (
        F.when(whole.rlike(rf"^{_EDGE}[+-]?[0-9]{{1,{digits}}}{_EDGE}$"), whole.try_cast(to))
        .when(whole.rlike("[0-9]"), wide)
        .otherwise(F.lit(0).cast(to))
    )
    plain = text.rlike(rf"^[+-]?[0-9]{{1,{digits}}}$")
    fraction = text.rlike(rf"^[+-]?[0-9]{{1,{digits}}}[.][0-9]*$")
    return (
        F.when(plain, text.try_cast(to))
        .when(fraction, whole.try_cast(to))
        .when(text.rlike(_DECIMAL), cut)
    )


def truth_value(text: Column) -> Column:
    return F.when(text.rlike(_BOOLEAN), text.try_cast("boolean"))


def cast_leniently(value: Column, source: T.DataType, to: T.DataType) -> Column:
    """Cast ``value`` (of type ``source``) to a contract type, NULL where it does not parse."""
    if source == to:
        return value
    if isinstance(to, T.StringType):
        return value.cast(to)
    if isinstance(source, T.StringType) and isinstance(to, (T.IntegerType, T.LongType)):
        return whole_number(value, to)
    if isinstance(source, T.StringType) and isinstance(to, T.BooleanType):
        return truth_value(value)
    return value.try_cast(to)
