"""Text to typed value, as column expressions.

Spark's own casts are too lenient for record text (they trim, read ``yes`` as a
boolean and a bare date as a timestamp), so each type has an anchored pattern that
the text must match before it is cast. A value that fails gives null; the callers
decide whether that is an error. ``\\z`` is used rather than ``$``, which would let
a trailing newline through.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted text of each type.
INTEGER_TEXT = r"\A[+-]?[0-9]+\z"
NUMBER_TEXT = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
FLOAT_TEXT = (
    r"\A[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)\z"
)
TIMESTAMP_TEXT = (
    r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} "
    r"[0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}(\.[0-9]{1,9})?\z"
)
DATE_TEXT = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"

# First characters of numbers and timestamps.
VALUE_STARTS = list("0123456789+-.NI")
# Bytes of the shortest and longest timestamp text.
TIMESTAMP_BYTES = (14, 29)

_INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
_PATTERNS = {
    T.FloatType: FLOAT_TEXT,
    T.DoubleType: FLOAT_TEXT,
    T.TimestampType: TIMESTAMP_TEXT,
    T.DateType: DATE_TEXT,
}

# Type classes a text value can fall in, as bits so that one bit_or per column
# holds everything inference needs.
INT_BIT, LONG_BIT, DOUBLE_BIT, TIMESTAMP_BIT, TEXT_BIT = 1, 2, 4, 8, 16


def _digits_that_fit(bits: int) -> int:
    """Text no longer than this is in range of the integer type, whatever it says."""
    return len(str(1 << (bits - 1))) - 1


def _in_range(text: Column, bits: int) -> Column:
    """Whether digits are in range of an integer type.

    Checked on a decimal of full width, which is null beyond 38 digits: a try_cast
    to the integer type answers an overflow by way of an exception, and that costs
    many times the parse.
    """
    top = 1 << (bits - 1)
    limit = f"decimal({len(str(top))},0)"
    number = text.try_cast("decimal(38,0)")
    return (F.octet_length(text) <= _digits_that_fit(bits)) | F.coalesce(
        number.between(F.lit(str(-top)).cast(limit), F.lit(str(top - 1)).cast(limit)),
        F.lit(False),
    )


def parse_text(text: Column, data_type: T.DataType) -> Column:
    """``text`` as ``data_type``; null where it is not written as that type."""
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.BooleanType):
        lowered = F.lower(text)
        return F.when(lowered == "true", True).when(lowered == "false", False)
    if isinstance(data_type, T.DecimalType):
        plain = F.replace(text, F.lit(","), F.lit(""))
        return F.when(plain.rlike(NUMBER_TEXT), plain.try_cast(data_type))
    bits = _INTEGER_BITS.get(type(data_type))
    if bits is not None:
        return F.when(
            text.rlike(INTEGER_TEXT) & _in_range(text, bits), text.try_cast(data_type)
        )
    pattern = _PATTERNS.get(type(data_type))
    if pattern is None:
        raise TypeError(f"unsupported data type: {data_type.simpleString()}")
    return F.when(text.rlike(pattern), text.try_cast(data_type))


def is_blank(text: Column, field: T.StructField) -> Column:
    """Whether ``text`` stands for a missing value of ``field``."""
    if field.nullable:
        return text.isNull() | (text == "")
    return text.isNull()


def strict_cast(text: Column, field: T.StructField) -> Column:
    """Cast that fails the job on the first value that does not parse."""
    if isinstance(field.dataType, T.StringType):
        return text
    problem = F.raise_error(
        F.concat(
            F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "), text
        )
    )
    parsed = F.coalesce(
        parse_text(text, field.dataType), problem.cast(field.dataType)
    )
    return F.when(~is_blank(text, field), parsed)


def permissive_cast(text: Column, field: T.StructField) -> Column:
    """Cast that gives null for a value that does not parse."""
    if isinstance(field.dataType, T.StringType):
        return text
    return F.when(~is_blank(text, field), parse_text(text, field.dataType))


def is_reject(text: Column, field: T.StructField) -> Column:
    """True for a value that is present but does not parse as the field's type."""
    if isinstance(field.dataType, T.StringType):
        return F.lit(False)
    return ~is_blank(text, field) & parse_text(text, field.dataType).isNull()


def type_bit(text: Column) -> Column:
    """The class bit of one text value; null for a missing one."""
    whole = (
        F.when(_in_range(text, 32), INT_BIT)
        .when(_in_range(text, 64), LONG_BIT)
        .otherwise(DOUBLE_BIT)
    )
    is_timestamp = (
        F.octet_length(text).between(*TIMESTAMP_BYTES)
        & text.rlike(TIMESTAMP_TEXT)
        & text.try_cast("timestamp").isNotNull()
    )
    # cheap looks at the text come first, so that most values meet one pattern only
    return (
        F.when(text.isNull() | (text == ""), F.lit(None).cast("int"))
        .when(~F.substring(text, 1, 1).isin(VALUE_STARTS), TEXT_BIT)
        .when(text.contains(":"), F.when(is_timestamp, TIMESTAMP_BIT).otherwise(TEXT_BIT))
        .when(~text.contains(".") & text.rlike(INTEGER_TEXT), whole)
        .when(text.rlike(FLOAT_TEXT), DOUBLE_BIT)
        .otherwise(TEXT_BIT)
    )


def type_of_bits(bits: Column) -> Column:
    """Name of the tightest type that holds every class seen in a column."""
    bits = F.coalesce(bits, F.lit(0))
    numeric = INT_BIT | LONG_BIT | DOUBLE_BIT
    return (
        F.when((bits == 0) | (bits >= TEXT_BIT), "string")
        .when(bits == TIMESTAMP_BIT, "timestamp")
        .when(bits > numeric, "string")
        .when(bits >= DOUBLE_BIT, "double")
        .when(bits >= LONG_BIT, "bigint")
        .otherwise("int")
    )
