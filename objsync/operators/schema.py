"""Schemas over all-string records: inference, alignment and typed rows."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions import casts
from objsync.functions.text import chosen_fields, form_encode, quoted

logger = logging.getLogger(__name__)


def _by_position(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with plain positional names, and the exact original name of each.

    Names can then differ in case only, or hold dots, without Spark resolving one
    for another. Of two equal names the last counts.
    """
    plain = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*plain), dict(zip(df.columns, plain))


def _values(df: DataFrame) -> DataFrame:
    """``(position, value)`` of every value: one code path for any number of columns."""
    renamed, _ = _by_position(df)
    columns = F.array(*[renamed[c] for c in renamed.columns])
    return renamed.select(F.posexplode(columns).alias("position", "value"))


def infer_types(df: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """Inferred type of every string column: ``(position, name, type)`` rows.

    One aggregate over all columns, reduced to a row per column before it is
    shuffled. The answer depends on neither row order nor partitioning: classes are
    combined with a bitwise or, numbers mixed with timestamps are text, and a column
    without values is text. All rows are read unless ``sample_rows`` asks for the
    first few only.
    """
    source = df.limit(sample_rows) if sample_rows is not None else df
    masks = (
        _values(source)
        .groupBy("position")
        .agg(F.bit_or(casts.type_bit(F.col("value"))).alias("bits"))
    )
    # one row holding a mask per column; a column of a table without rows has none
    by_position = masks.agg(
        F.map_from_entries(F.collect_list(F.struct("position", "bits"))).alias("masks")
    )
    names = F.array(*[F.lit(name) for name in df.columns])
    return by_position.select(
        F.posexplode(names).alias("position", "name"), "masks"
    ).select(
        "position",
        "name",
        casts.type_of_bits(F.try_element_at("masks", F.col("position"))).alias("type"),
    )


def infer_schema(df: DataFrame, sample_rows: int | None = None) -> T.StructType:
    """The inferred schema, every field nullable. Runs one aggregate job."""
    schema = T.StructType()
    # one row per column
    for row in sorted(infer_types(df, sample_rows).collect()):
        schema.add(row["name"], T.DataType.fromDDL(row["type"]), nullable=True)
    return schema


def align(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns in that order; one that is missing reads as ``""``.

    Names match exactly, also in case.
    """
    renamed, position = _by_position(df)
    missing = [name for name in names if name not in position]
    if missing:
        logger.warning("columns not found, read as empty: %s", ", ".join(missing))
    return renamed.select(
        *[
            renamed[position[name]].alias(name)
            if name in position
            else F.lit("").alias(name)
            for name in names
        ]
    )


def apply_schema(
    df: DataFrame,
    schema: T.StructType,
    mode: str = "strict",
    encode_fields: str | None = None,
    rejects_col: str | None = None,
) -> DataFrame:
    """String records as typed rows, in one projection.

    ``strict`` fails the job on a value that does not parse; a column that nothing
    reads is not parsed, nor checked. ``permissive`` gives null instead and, with
    ``rejects_col``, adds an array of the refused values, so typed rows and rejects
    come from the same pass. String fields listed in ``encode_fields`` are URL
    form-encoded.
    """
    if mode not in ("strict", "permissive"):
        raise ValueError(f"mode must be strict or permissive, not {mode!r}")
    if rejects_col and mode == "strict":
        raise ValueError("rejects_col needs mode='permissive'")
    encoded = chosen_fields(encode_fields)
    records = align(df, schema.fieldNames())
    records = records.toDF(*[f"c{i}" for i in range(len(schema))])
    cast = casts.strict_cast if mode == "strict" else casts.permissive_cast
    typed = [cast(records[f"c{i}"], f).alias(f"t{i}") for i, f in enumerate(schema.fields)]
    rows = records.select("*", *typed)
    columns = []
    for i, field in enumerate(schema.fields):
        value = rows[f"t{i}"]
        if isinstance(field.dataType, T.StringType) and field.name in encoded:
            value = form_encode(value)
        columns.append(value.alias(field.name))
    if rejects_col:
        columns.append(_reject_array(rows, schema).alias(rejects_col))
    return rows.select(*columns)


def _reject_array(rows: DataFrame, schema: T.StructType) -> Column:
    """The refused values of a row, seen by what has become of each text."""
    entries = [
        F.when(
            ~casts.is_blank(rows[f"c{i}"], field) & rows[f"t{i}"].isNull(),
            F.struct(
                F.lit(field.name).alias("column"),
                rows[f"c{i}"].alias("value"),
                F.lit(field.dataType.simpleString()).alias("type"),
            ),
        )
        for i, field in enumerate(schema.fields)
        if not isinstance(field.dataType, T.StringType)
    ]
    if not entries:
        return F.array().cast("array<struct<column:string,value:string,type:string>>")
    return F.array_compact(F.array(*entries))


def cast_rejects(df: DataFrame, schema: T.StructType, key: str) -> DataFrame:
    """Values that do not parse: ``(key, column, value, type)`` rows.

    Values of all columns go through one check per type, however many columns
    there are.
    """
    fields = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    names = [f.name for f in fields]
    types = [f.dataType.simpleString() for f in fields]
    aligned = align(df, [key, *names])
    aligned = aligned.toDF("_key", *[f"c{i}" for i in range(len(names))])
    texts = F.array(*[F.col(f"c{i}") for i in range(len(names))]).cast("array<string>")
    values = aligned.select(
        F.col("_key").alias(key), F.posexplode(texts).alias("_position", "value")
    )
    rejected = F.lit(False)
    groups: dict[tuple[str, bool], list[int]] = {}
    for i, field in enumerate(fields):
        groups.setdefault((types[i], field.nullable), []).append(i)
    for positions in groups.values():
        is_member = F.col("_position").isin(positions)
        refused = casts.is_reject(F.col("value"), fields[positions[0]])
        rejected = F.when(is_member, refused).otherwise(rejected)
    at = F.col("_position") + 1
    return values.where(rejected).select(
        F.col(quoted(key)),
        F.element_at(F.array(*map(F.lit, names)).cast("array<string>"), at).alias("column"),
        "value",
        F.element_at(F.array(*map(F.lit, types)).cast("array<string>"), at).alias("type"),
    )
