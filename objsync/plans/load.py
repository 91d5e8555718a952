"""From landed results to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from objsync.functions.text import encode_fields as encode_columns
from objsync.operators.schema import apply_schema, infer_schema
from objsync.sources.objects import query_objects
from objsync.sources.pages import TOTAL_SIZE, page_records, page_status, read_pages
from objsync.sources.result_sets import read_result_sets


def typed_rows(
    records: DataFrame,
    schema: T.StructType | None = None,
    infer: bool = False,
    sample_rows: int | None = None,
    encode_fields: str | None = None,
    mode: str = "strict",
) -> DataFrame:
    """String records as rows of a given schema, of the inferred one, or as text.

    A given schema wins over inference, which looks at every row unless
    ``sample_rows`` limits it.
    """
    if not isinstance(infer, bool):
        raise ValueError("infer can only be True or False")
    if schema is None and infer:
        schema = infer_schema(records, sample_rows)
    if schema is None:
        return encode_columns(records, encode_fields)
    return apply_schema(records, schema, mode, encode_fields)


def load_object(
    spark: SparkSession,
    *,
    result_sets: str | list[str] | None = None,
    pages: str | list[str] | None = None,
    columns: list[str] | None = None,
    object_name: str | None = None,
    query: str | None = None,
    multi_line: bool = True,
    records_field: str = "records",
    done_field: str = "done",
    accept_incomplete: bool = False,
    total_field: str = TOTAL_SIZE,
    **typing,
) -> DataFrame:
    """Landed bulk result sets or query pages as a typed DataFrame.

    Exactly one of ``result_sets`` and ``pages`` names the source. ``query`` runs
    over the typed rows under ``object_name``, so that its filters and columns reach
    the file scan. ``multi_line`` is that of the readers, and ``records_field``,
    ``done_field`` and ``total_field`` those of ``read_pages``. Pages with done flags that
    ``page_status`` does not find complete are refused, unless ``accept_incomplete``; a
    response without a flag is whole. The status comes from a parse of flags and totals
    that skips the fields of records. The remaining arguments are those of ``typed_rows``.
    """
    if (result_sets is None) == (pages is None):
        raise ValueError("give exactly one of result_sets and pages")
    if (query is None) != (object_name is None):
        raise ValueError("query and object_name go together")
    if result_sets is not None:
        records = read_result_sets(spark, result_sets, columns, multi_line=multi_line)
    else:
        names = (records_field, done_field, multi_line, total_field)
        if not accept_incomplete:
            flags = read_pages(spark, pages, [], *names).where("done is not null")
            state = page_status(flags).first()
            if state["n_pages"] and not state["complete"]:
                raise ValueError(
                    f"incomplete extract: {state['n_done']} of {state['n_pages']} pages are the last"
                    f", with {state['n_records']} records in all"
                )
        landed = read_pages(spark, pages, columns, *names)
        records = page_records(landed)
    rows = typed_rows(records, **typing)
    if query is None:
        return rows
    return query_objects(spark, {object_name: rows}, query)
