"""Query text over named objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def query_objects(
    spark: SparkSession, objects: dict[str, DataFrame], sql: str
) -> DataFrame:
    """The result of ``sql``, in which each key of ``objects`` names a table.

    The names exist only while the text is analysed; a name that is already a
    table or view of the session is refused rather than hidden.
    """
    for name in objects:
        if spark.catalog.tableExists(name):
            raise ValueError(f"{name} is already a table or view")
    try:
        for name, df in objects.items():
            df.createTempView(name)
        return spark.sql(sql)
    finally:
        for name in objects:
            spark.catalog.dropTempView(name)
