"""Extracts as files and tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from objsync.functions.text import quoted


def _table(name: str) -> str:
    return ".".join(quoted(part) for part in name.split("."))


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def save_extract(df: DataFrame, path: str) -> None:
    """Write ``df`` as Parquet files, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def register_extract(spark: SparkSession, name: str, path: str) -> DataFrame:
    """An external table over extract files; dropping it keeps the files."""
    spark.sql(f"CREATE TABLE {_table(name)} USING parquet LOCATION {_literal(path)}")
    return spark.table(name)


def replace_extract(df: DataFrame, name: str, path: str) -> str:
    """Give the table ``name`` the rows of ``df``, which may be read from that table.

    The rows go to a new folder below ``path``, and the table is pointed at it once
    they are all there; until then, and if the write fails, it keeps the old rows.
    """
    version = f"{path}/version-{uuid.uuid4().hex}"
    df.write.parquet(version)
    spark = df.sparkSession
    spark.sql(f"ALTER TABLE {_table(name)} SET LOCATION {_literal(version)}")
    spark.catalog.refreshTable(_table(name))
    return version


def save_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """A table with all rows of ``df``, replacing one of that name.

    With ``path`` the table is external, with its files there.
    """
    writer = df.write.mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def create_empty_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """A table with the schema of ``df`` and no rows."""
    save_table(df.limit(0), name, path)
