"""Paged query results: JSON page documents with a done flag and records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import quoted

# Record members that describe the record and are not its fields.
RECORD_ATTRIBUTES = "attributes"
# Page member that holds the number of records of all pages.
TOTAL_SIZE = "totalSize"


def _page_schema(types: dict[str, T.DataType]) -> T.StructType:
    """The schema that holds each type at its dotted path."""
    tops: dict[str, dict[str, T.DataType]] = {}
    for path, data_type in types.items():
        top, _, rest = path.partition(".")
        tops.setdefault(top, {})[rest] = data_type
    return T.StructType(
        [
            T.StructField(top, below[""] if "" in below else _page_schema(below))
            for top, below in tops.items()
        ]
    )


def _has_path(data_type: T.DataType, path: str) -> bool:
    top, _, rest = path.partition(".")
    if not isinstance(data_type, T.StructType) or top not in data_type.names:
        return False
    return not rest or _has_path(data_type[top].dataType, rest)


def read_pages(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    records_field: str = "records",
    done_field: str = "done",
    multi_line: bool = True,
    total_field: str = TOTAL_SIZE,
) -> DataFrame:
    """Page documents below ``path``: ``(done, records, total)``, one row per page.

    All fields may be dotted paths into the document, such as ``results.records``;
    a response that has no done flag, or no total of the records of all pages, gives null. Record values are text, a nested
    value its JSON text. With ``columns`` the pages are parsed to just those fields
    and nothing is read ahead; without, one extra pass finds the fields.
    ``multi_line=False`` reads files with one page per line, which Spark can split.
    A document that does not parse, such as one cut short, fails the job.
    """
    reader = spark.read.options(
        primitivesAsString=True, multiLine=multi_line, mode="FAILFAST"
    )
    if columns is not None:
        record = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        types = {done_field: T.StringType(), total_field: T.StringType(), records_field: T.ArrayType(record)}
        reader = reader.schema(_page_schema(types))
    pages = reader.json(path)
    done = F.lit(None).cast("boolean")
    if _has_path(pages.schema, done_field):
        done = F.lower(F.col(_path_name(done_field))) == "true"
    total = F.lit(None).cast("bigint")
    if _has_path(pages.schema, total_field):
        total = F.col(_path_name(total_field)).cast("bigint")
    return pages.select(
        done.alias("done"),
        F.col(_path_name(records_field)).alias("records"),
        total.alias("total"),
    )


def _path_name(path: str) -> str:
    return ".".join(quoted(part) for part in path.split("."))


def page_records(pages: DataFrame) -> DataFrame:
    """The records of all pages, one row each, every field text."""
    record = getattr(pages.schema["records"].dataType, "elementType", None)
    if not isinstance(record, T.StructType):  # no page has a record
        return pages.select().where("false")
    return pages.select(F.explode("records").alias("r")).select(
        *[
            F.col(f"r.{quoted(f.name)}").cast("string").alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.to_json(F.col(f"r.{quoted(f.name)}")).alias(f.name)
            for f in record.fields
            if f.name != RECORD_ATTRIBUTES
        ]
    )


def page_status(pages: DataFrame) -> DataFrame:
    """``(n_pages, n_done, n_records, complete)`` of an extract.

    It is complete when exactly one page says that it is the last and, where pages tell
    how many records there are in all, every such page tells the number that is there. So
    a lost page and one that landed twice are noticed.
    """
    done = F.count_if(F.coalesce(F.col("done"), F.lit(False)))
    n_records = F.coalesce(F.sum(F.coalesce(F.size("records"), F.lit(0))), F.lit(0))
    total = F.col("total") if "total" in pages.columns else F.lit(None).cast("bigint")
    told = F.coalesce((F.min(total) == n_records) & (F.max(total) == n_records), F.lit(True))
    return pages.agg(
        F.count("*").alias("n_pages"),
        done.alias("n_done"),
        n_records.cast("bigint").alias("n_records"),
        ((done == 1) & told).alias("complete"),
    )
