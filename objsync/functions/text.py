"""CSV and URL encoding of values, as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What makes a CSV value need quotes.
NEEDS_QUOTES = '[",\n\r]'

#: Types whose text never needs quotes.
_BARE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def plain_text(value: Column, data_type: T.DataType) -> Column:
    """A value as text. Timestamps always show a fraction, at least ``.0``."""
    text = value.cast("string")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.when(F.contains(text, F.lit(".")), text).otherwise(
            F.concat(text, F.lit(".0"))
        )
    return text


def csv_value(text: Column) -> Column:
    """One CSV value: null is empty, quotes are doubled, separators are wrapped."""
    doubled = F.replace(text, F.lit('"'), F.lit('""'))
    wrapped = F.concat(F.lit('"'), doubled, F.lit('"'))
    return F.coalesce(
        F.when(text.rlike(NEEDS_QUOTES), wrapped).otherwise(text), F.lit("")
    )


def _csv_field(field: T.StructField) -> Column:
    text = plain_text(F.col(quoted(field.name)), field.dataType)
    if isinstance(field.dataType, _BARE):
        return F.coalesce(text, F.lit(""))
    return csv_value(text)


def csv_line(df: DataFrame) -> Column:
    """All columns of ``df`` as one CSV line.

    The columns are taken by name, so it also fits what ``df`` is turned into.
    """
    values = [_csv_field(f) for f in df.schema.fields]
    if len(values) == 1:
        # a lone empty value would be an empty line, which CSV readers skip
        return F.when(values[0] == "", '""').otherwise(values[0])
    return F.concat_ws(",", *values)


def csv_header(schema: T.StructType) -> str:
    """The header line for ``schema``."""
    return ",".join(
        '"' + name.replace('"', '""') + '"' if re.search(NEEDS_QUOTES, name) else name
        for name in schema.fieldNames()
    )


def row_bytes(line: Column) -> Column:
    """UTF-8 bytes of an encoded line, without its newline."""
    return F.octet_length(line).cast("bigint")


def form_encode(text: Column) -> Column:
    """URL form encoding in UTF-8."""
    return F.url_encode(text)


def chosen_fields(names: str | None) -> set[str]:
    """Field names from a comma list; matched exactly, spaces included."""
    return set(names.split(",")) if names else set()


def encode_fields(df: DataFrame, names: str | None) -> DataFrame:
    """Form-encode the listed string columns of ``df``."""
    chosen = chosen_fields(names)
    return df.select(
        *[
            form_encode(df[quoted(f.name)]).alias(f.name)
            if f.name in chosen and isinstance(f.dataType, T.StringType)
            else df[quoted(f.name)]
            for f in df.schema.fields
        ]
    )


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, ready for lookup."""
    return "`" + name.replace("`", "``") + "`"
