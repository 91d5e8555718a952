"""

Each query is registered together with the SQL that DuckDB runs on the same tables.
Every one reads whole tables. Inputs that are text files are first written by the
query itself to the shared folder of the session.
"""

from __future__ import annotations

import importlib.util
import math
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import objsync as ob  # noqa: E402
from objsync.session import new_run_dir  # noqa: E402

FLAGSHIP_DIR = "/root/testdata/sf0.001"

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with the SQL that checks it."""

    def register(fn):
        _QUERIES[fn.__name__] = fn
        if sql is not None:
            _ORACLES[fn.__name__] = sql
        return fn

    return register


def entry(spark: SparkSession) -> DataFrame:
    """Landed opportunity records as text, queried, inferred and typed."""
    return typed_opportunities(spark, FLAGSHIP_DIR)


def _of_llm():
    """Queries and SQL of the ``llm`` subpackage and the pipeline; none if it is not there."""
    try:
        import corpus_pipeline
        from objsync.llm import queries as llm
    except ImportError:
        if importlib.util.find_spec("objsync.llm") and importlib.util.find_spec("corpus_pipeline"):
            raise
        return {}, {}
    pipeline_sql = corpus_pipeline.ORACLE_SQL
    return (
        {**llm.QUERIES, "pipeline": corpus_pipeline.run},
        {**llm.ORACLES, **({"pipeline": pipeline_sql} if pipeline_sql else {})},
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_of_llm()[0]}


def oracle_sql() -> dict[str, str]:
    return {**_ORACLES, **_of_llm()[1]}


# --------------------------------------------------------------------------- inputs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(value: Column | str) -> Column:
    """A two-digit amount as text, written alike by both engines."""
    value = F.col(value) if isinstance(value, str) else value
    return value.cast("decimal(14,2)").cast("string")


def opportunities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("amount"),
    )


def customer_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        money("c_acctbal").alias("c_acctbal"),
        "c_mktsegment",
    )


_CUSTOMER_TEXT_SQL = """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
           CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(CAST(c_acctbal AS DECIMAL(14,2)) AS VARCHAR) AS c_acctbal,
           c_mktsegment
    FROM customer"""


def order_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("name"),
        money("o_totalprice").alias("amount"),
        F.col("o_orderdate").cast("string").alias("close_date"),
    )


def event_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("ts"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        money("value").alias("value"),
        "props",
    )


# ------------------------------------------------------------------ queries over text


@query("SELECT o_orderkey AS id, o_orderpriority AS name, o_totalprice AS amount FROM orders")
def query_projection(spark, sf_dir):
    objects = {"opportunity": opportunities(spark, sf_dir)}
    return ob.query_objects(spark, objects, "select id, name, amount from opportunity")


@query('SELECT c_name AS "Name", c_mktsegment AS "Email" FROM customer')
def query_alias(spark, sf_dir):
    objects = {"people": table(spark, sf_dir, "customer")}
    return ob.query_objects(
        spark, objects, "select c_name as Name, c_mktsegment as Email from people"
    )


_TOP_SQL = """
    SELECT name, count(*) AS n_rows,
           CAST(sum(CAST(amount AS DECIMAL(14,2))) AS VARCHAR) AS total
    FROM {source}
    WHERE amount > 100000
    GROUP BY name
    HAVING count(*) > 1
    ORDER BY name
    LIMIT 3"""


@query(
    _TOP_SQL.format(
        source="(SELECT o_orderpriority AS name, o_totalprice AS amount FROM orders)"
    )
)
def query_filter_group_limit(spark, sf_dir):
    objects = {"opportunity": opportunities(spark, sf_dir)}
    sql = _TOP_SQL.format(source="opportunity").replace("VARCHAR", "STRING")
    return ob.query_objects(spark, objects, sql)


# ---------------------------------------------------------------------- landed results


def land_result_sets(spark: SparkSession, sf_dir: str) -> str:
    """The customers as CSV result sets: one with columns swapped, one lacking two."""
    customers = customer_text(spark, sf_dir)
    segment = F.col("c_mktsegment")
    sets = {
        "plain": customers.where(segment < "B"),
        "swapped": customers.where((segment >= "B") & (segment < "H")).select(
            "c_mktsegment", "c_acctbal", "c_custkey", "c_nationkey", "c_name"
        ),
        "short": customers.where(segment >= "H").drop("c_acctbal", "c_nationkey"),
    }
    path = new_run_dir(spark, "result-sets")
    for name, rows in sets.items():
        rows.write.csv(f"{path}/{name}", header=True, escape='"')
    return path


@query(
    f"""
    SELECT c_custkey, c_name, c_mktsegment,
           CASE WHEN c_mktsegment >= 'H' THEN '' ELSE c_nationkey END AS c_nationkey,
           CASE WHEN c_mktsegment >= 'H' THEN '' ELSE c_acctbal END AS c_acctbal
    FROM ({_CUSTOMER_TEXT_SQL})"""
)
def read_result_sets(spark, sf_dir):
    return ob.read_result_sets(spark, land_result_sets(spark, sf_dir))


@query(
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
           coalesce(source, '') AS source, coalesce(CAST(n_chars AS VARCHAR), '') AS n_chars
    FROM documents"""
)
def read_result_sets_split(spark, sf_dir):
    """Large files, one a split of the input, whose values hold quotes and newlines, in small chunks."""
    documents = table(spark, sf_dir, "documents")
    documents = documents.select([F.col(c).cast("string").alias(c) for c in ("doc_id", "text", "lang", "source", "n_chars")])
    path = new_run_dir(spark, "result-sets")
    ob.write_result_set(documents, path)
    return ob.read_result_sets_split(spark, path, chunk_bytes=1 << 17)


@query(_CUSTOMER_TEXT_SQL)
def read_result_sets_known_header(spark, sf_dir):
    customers = customer_text(spark, sf_dir)
    path = new_run_dir(spark, "result-sets")
    customers.write.csv(path, header=True, escape='"')
    return ob.read_result_sets(spark, path, customers.columns, multi_line=False)


PAGE_ROWS = 200


def land_pages(spark: SparkSession, sf_dir: str, nested: bool = False, lost: int | None = None) -> str:
    """The customers as JSON page documents, one per line.

    ``nested`` gives the layout of an analytics response: records below results. With
    ``lost`` pages tell how many records there are, and the page of that number is
    missing unless it is the last.
    """
    customers = customer_text(spark, sf_dir).withColumn(
        "_key", F.col("c_custkey").cast("bigint")
    )
    total = customers.count()
    last = math.ceil(total / PAGE_ROWS)
    record = F.struct(
        F.struct(F.lit("customer").alias("type")).alias("attributes"),
        *[c for c in customers.columns if c != "_key"],
    )
    pages = (
        ob.paginate(customers, ["_key"], PAGE_ROWS, unique_order=True)
        .groupBy("page_no")
        .agg(F.collect_list(record).alias("records"))
        .withColumn("done", F.col("page_no") == last)
    )
    page = F.struct("done", "records")
    if nested:
        page = F.struct(F.struct("records").alias("results"))
    if lost is not None:
        page = F.struct(F.lit(total).alias("totalSize"), "done", "records")
        pages = pages.where((F.col("page_no") != lost) | F.col("done"))
    pages = pages.select(F.to_json(page))
    path = new_run_dir(spark, "pages")
    pages.write.text(path)
    return path


@query(_CUSTOMER_TEXT_SQL)
def read_pages(spark, sf_dir):
    pages = ob.read_pages(spark, land_pages(spark, sf_dir), multi_line=False)
    return ob.page_records(pages)


@query(f'SELECT c_name AS "Name", c_mktsegment AS "Email" FROM ({_CUSTOMER_TEXT_SQL})')
def read_analytics_pages(spark, sf_dir):
    """Analytics responses: records below another member, and no done flag."""
    path = land_pages(spark, sf_dir, nested=True)
    pages = ob.read_pages(
        spark, path, ["c_name", "c_mktsegment"], "results.records", multi_line=False
    )
    return ob.query_objects(
        spark,
        {"q": ob.page_records(pages)},
        "select c_name as Name, c_mktsegment as Email from q",
    )


@query(f"SELECT c_custkey, c_name, c_acctbal FROM ({_CUSTOMER_TEXT_SQL})")
def read_pages_known_columns(spark, sf_dir):
    path = land_pages(spark, sf_dir)
    columns = ["c_custkey", "c_name", "c_acctbal"]
    return ob.page_records(ob.read_pages(spark, path, columns, multi_line=False))


@query(
    f"""
    SELECT (count(*) + {PAGE_ROWS - 1}) // {PAGE_ROWS} AS n_pages,
           CAST(1 AS BIGINT) AS n_done, count(*) AS n_records, true AS complete
    FROM customer"""
)
def page_status(spark, sf_dir):
    path = land_pages(spark, sf_dir)
    return ob.page_status(ob.read_pages(spark, path, multi_line=False))


@query(
    f"""
    SELECT n_pages - CAST(n_pages > 1 AS BIGINT) AS n_pages, CAST(1 AS BIGINT) AS n_done,
           n - CASE WHEN n_pages > 1 THEN {PAGE_ROWS} ELSE 0 END AS n_records,
           n_pages = 1 AS complete
    FROM (SELECT count(*) AS n, (count(*) + {PAGE_ROWS - 1}) // {PAGE_ROWS} AS n_pages FROM customer)"""
)
def page_status_lost_page(spark, sf_dir):
    """The first page is lost: one page is the last, but the total tells of more records."""
    path = land_pages(spark, sf_dir, lost=1)
    return ob.page_status(ob.read_pages(spark, path, [], multi_line=False))


@query(
    """
    SELECT o_orderkey, 1 + (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS page_no,
           (row_number() OVER (ORDER BY o_orderkey) - 1) % 1000 AS page_row
    FROM orders"""
)
def paginate(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return ob.paginate(orders, ["o_orderkey"], 1000, unique_order=True)


@query(
    """
    WITH paged AS (
        SELECT l_returnflag,
               1 + (row_number() OVER (ORDER BY l_returnflag) - 1) // 1000 AS page_no
        FROM lineitem)
    SELECT page_no, l_returnflag, count(*) AS n_rows FROM paged GROUP BY ALL"""
)
def paginate_ties(spark, sf_dir):
    """Pages over a key of a few values, each of which holds many rows."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_orderkey")
    paged = ob.paginate(lines, ["l_returnflag"], 1000)
    return paged.groupBy("page_no", "l_returnflag").agg(F.count("*").alias("n_rows"))


# ----------------------------------------------------------------------------- schemas


@query(
    """
    SELECT c_custkey, '' AS "C_Name", '' AS email, CAST(NULL AS INTEGER) AS rating,
           c_mktsegment
    FROM customer"""
)
def align_missing(spark, sf_dir):
    """A column absent from the records, one that differs in case, one not asked for."""
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("C_Name", T.StringType()),
            T.StructField("email", T.StringType()),
            T.StructField("rating", T.IntegerType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )
    return ob.apply_schema(customer_text(spark, sf_dir), schema)


def mixed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event records as text, with columns that mix the classes of values."""
    is_click = F.col("event_type") == "click"
    wide = F.col("event_id").cast("bigint") + 3000000000
    return event_text(spark, sf_dir).select(
        "*",
        wide.cast("string").alias("wide_id"),
        F.when(is_click, F.col("value")).otherwise(F.col("event_id")).alias("number"),
        F.when(is_click, F.col("ts")).otherwise(F.col("event_id")).alias("number_or_ts"),
        F.when(is_click, F.lit("")).otherwise(F.col("ts")).alias("ts_or_blank"),
        F.when(is_click, F.lit(None)).otherwise(F.col("user_id")).alias("id_or_null"),
        F.concat(F.lit(" "), "event_id").alias("padded"),
        F.lit("").alias("blank"),
    )


_EVENT_TEXT_SQL = """
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
           CAST(user_id AS VARCHAR) AS user_id, event_type,
           CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) AS value, props
    FROM events"""

_MIXED_TEXT_SQL = f"""
    SELECT *, CAST(CAST(event_id AS BIGINT) + 3000000000 AS VARCHAR) AS wide_id,
           CASE WHEN event_type = 'click' THEN value ELSE event_id END AS number,
           CASE WHEN event_type = 'click' THEN ts ELSE event_id END AS number_or_ts,
           CASE WHEN event_type = 'click' THEN '' ELSE ts END AS ts_or_blank,
           CASE WHEN event_type = 'click' THEN NULL ELSE user_id END AS id_or_null,
           ' ' || event_id AS padded, '' AS blank
    FROM ({_EVENT_TEXT_SQL})"""

_INT_SQL = "regexp_full_match({c}, '[+-]?[0-9]+')"
_DEC_SQL = r"regexp_full_match({c}, '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?')"
_DBL_SQL = (
    r"regexp_full_match({c}, '[+-]?(NaN|Infinity|"
    r"([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)')"
)
_TS_SQL = (
    r"regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}} "
    r"[0-9]{{1,2}}:[0-9]{{1,2}}:[0-9]{{1,2}}(\.[0-9]{{1,9}})?')"
)
_DATE_SQL = "regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}')"


def _inferred_sql(source: str, columns: list[str]) -> str:
    """SQL for the inferred type of each column, by the classes of its values."""
    bit = f"""CASE WHEN {{c}} IS NULL OR {{c}} = '' THEN NULL
        WHEN {_INT_SQL} THEN CASE WHEN TRY_CAST({{c}} AS INTEGER) IS NOT NULL THEN 1
             WHEN TRY_CAST({{c}} AS BIGINT) IS NOT NULL THEN 2 ELSE 4 END
        WHEN {_DBL_SQL} THEN 4
        WHEN {_TS_SQL} AND TRY_CAST({{c}} AS TIMESTAMP) IS NOT NULL THEN 8
        ELSE 16 END"""
    return "\nUNION ALL\n".join(
        f"""SELECT {i} AS position, '{c}' AS name,
        CASE WHEN bits = 0 OR bits >= 16 THEN 'string' WHEN bits = 8 THEN 'timestamp'
             WHEN bits > 8 THEN 'string' WHEN bits >= 4 THEN 'double'
             WHEN bits >= 2 THEN 'bigint' ELSE 'int' END AS type
        FROM (SELECT coalesce(bit_or({bit.format(c=c)}), 0) AS bits FROM ({source}))"""
        for i, c in enumerate(columns)
    )


_MIXED_COLUMNS = (
    "event_id ts user_id event_type value props "
    "wide_id number number_or_ts ts_or_blank id_or_null padded blank"
).split()


@query(_inferred_sql(_MIXED_TEXT_SQL, _MIXED_COLUMNS))
def infer_types(spark, sf_dir):
    return ob.infer_types(mixed_text(spark, sf_dir))


_ORDER_TEXT_SQL = """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS name,
           CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS amount,
           CAST(o_orderdate AS VARCHAR) AS close_date
    FROM orders"""
_ORDER_COLUMNS = ["id", "name", "amount", "close_date"]


@query(_inferred_sql(_ORDER_TEXT_SQL, _ORDER_COLUMNS))
def infer_types_orders(spark, sf_dir):
    return ob.infer_types(order_text(spark, sf_dir))


@query(
    _inferred_sql(
        f"{_ORDER_TEXT_SQL} ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
        _ORDER_COLUMNS,
    )
)
def infer_types_sampled(spark, sf_dir):
    """Inference from the first ten records only, as an option."""
    first = order_text(spark, sf_dir).orderBy(
        F.col("amount").cast("decimal(14,2)").desc(), F.col("id").cast("bigint")
    )
    return ob.infer_types(first, sample_rows=10)


@query("SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS name, "
       "o_totalprice AS amount FROM orders")
def typed_opportunities(spark, sf_dir):
    """Text records through a query, inference over all rows, and typing."""
    landed = {"opportunity": order_text(spark, sf_dir)}
    records = ob.query_objects(spark, landed, "select id, name, amount from opportunity")
    return ob.typed_rows(records, infer=True)


@query(
    "SELECT CAST(o_orderkey AS INTEGER) AS id, o_orderpriority AS name, "
    "o_totalprice AS amount FROM orders WHERE o_totalprice > 250000"
)
def load_object(spark, sf_dir):
    """Landed result sets, inferred, typed and queried."""
    path = new_run_dir(spark, "opportunity")
    order_text(spark, sf_dir).write.csv(path, header=True, escape='"')
    return ob.load_object(
        spark,
        result_sets=path,
        infer=True,
        object_name="opportunity",
        query="select id, name, amount from opportunity where amount > 250000",
    )


EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("user_id", T.IntegerType()),
        T.StructField("small_id", T.IntegerType()),
        T.StructField("tiny_id", T.ByteType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("ratio", T.FloatType()),
        T.StructField("price", T.DecimalType(14, 2)),
        T.StructField("day", T.DateType()),
        T.StructField("is_click", T.BooleanType()),
        T.StructField("blank", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)


@query(
    """
    SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id,
           CAST(user_id AS INTEGER) AS small_id,
           CAST(length(event_type) AS INTEGER) AS tiny_id, event_type, value,
           CAST(CAST(length(props) AS DOUBLE) / 2 AS DOUBLE) AS ratio,
           CAST(CAST(value AS DECIMAL(14,2)) AS VARCHAR) AS price,
           CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type = 'click' AS is_click,
           CAST(NULL AS DOUBLE) AS blank, props
    FROM events"""
)
def apply_schema(spark, sf_dir):
    """Every target type, cast from text."""
    records = event_text(spark, sf_dir).select(
        "*",
        F.col("user_id").alias("small_id"),
        F.length("event_type").cast("string").alias("tiny_id"),
        (F.length("props") / 2).cast("string").alias("ratio"),
        F.col("value").alias("price"),
        F.substring("ts", 1, 10).alias("day"),
        F.when(F.col("event_type") == "click", "TRUE").otherwise("False").alias("is_click"),
        F.lit("").alias("blank"),
    )
    typed = ob.apply_schema(records, EVENT_SCHEMA)
    return typed.select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "user_id",
        F.col("small_id").cast("int").alias("small_id"),
        F.col("tiny_id").cast("int").alias("tiny_id"),
        "event_type",
        "value",
        F.col("ratio").cast("double").alias("ratio"),
        F.col("price").cast("string").alias("price"),
        F.col("day").cast("string").alias("day"),
        "is_click",
        "blank",
        "props",
    )


# One form of each value per event type, written alike in Spark SQL and DuckDB.
_EDGE_FORMS = {
    "as_int": {
        "click": "event_id",
        "error": "' ' || event_id",
        "view": "CAST(CAST(event_id AS BIGINT) + 3000000000 AS {text})",
        "purchase": "value",
        "signup": "'+' || event_id",
    },
    "as_tiny": {
        "click": "event_id",
        "error": "event_id || '_0'",
        "view": "'-' || user_id",
        "purchase": "''",
        "signup": "user_id",
    },
    "as_double": {
        "click": "value || 'e2'",
        "error": "value || 'd'",
        "view": "'NaN'",
        "purchase": "'-Infinity'",
        "signup": "'1,' || value",
    },
    "as_bool": {
        "click": "'true'",
        "error": "'t'",
        "view": "'FALSE'",
        "purchase": "'yes'",
        "signup": "user_id",
    },
    "as_ts": {
        "click": "ts",
        "error": "replace(ts, ' ', 'T')",
        "view": "substr(ts, 1, 10)",
        "purchase": "'2016-02-30 00:00:00'",
        "signup": "substr(ts, 1, 11) || '25:00:00'",
    },
    "as_date": {
        "click": "ts",
        "error": "substr(ts, 1, 10)",
        "view": "'2016-1-1'",
        "purchase": "'2016-02-30'",
        "signup": "' ' || substr(ts, 1, 10)",
    },
    "as_decimal": {
        "click": "'1,' || value",
        "error": "value || '.1'",
        "view": "value",
        "purchase": "'$' || value",
        "signup": "value || ' '",
    },
}

_EDGE_TYPES = {
    "as_int": T.IntegerType(),
    "as_tiny": T.ByteType(),
    "as_double": T.DoubleType(),
    "as_bool": T.BooleanType(),
    "as_ts": T.TimestampType(),
    "as_date": T.DateType(),
    "as_decimal": T.DecimalType(14, 2),
}

_EDGE_CHECKS = {
    "as_int": ("int", f"{_INT_SQL} AND TRY_CAST({{c}} AS INTEGER) IS NOT NULL"),
    "as_tiny": ("tinyint", f"{_INT_SQL} AND TRY_CAST({{c}} AS TINYINT) IS NOT NULL"),
    "as_double": ("double", _DBL_SQL),
    "as_bool": ("boolean", "lower({c}) IN ('true', 'false')"),
    "as_ts": ("timestamp", f"{_TS_SQL} AND TRY_CAST({{c}} AS TIMESTAMP) IS NOT NULL"),
    "as_date": ("date", f"{_DATE_SQL} AND TRY_CAST({{c}} AS DATE) IS NOT NULL"),
    "as_decimal": ("decimal(14,2)", _DEC_SQL.replace("{c}", "replace({c}, ',', '')")),
}


def _edge_case(forms: dict[str, str], text: str) -> str:
    whens = " ".join(f"WHEN '{kind}' THEN {form}" for kind, form in forms.items())
    return f"CASE event_type {whens} END".format(text=text)


_EDGE_SQL = (
    "SELECT CAST(event_id AS BIGINT) AS event_id, "
    + ", ".join(f"{_edge_case(f, 'VARCHAR')} AS {c}" for c, f in _EDGE_FORMS.items())
    + f" FROM ({_EVENT_TEXT_SQL})"
)


def edge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_text(spark, sf_dir).select(
        F.col("event_id").cast("bigint").alias("event_id"),
        *[F.expr(_edge_case(f, "STRING")).alias(c) for c, f in _EDGE_FORMS.items()],
    )


@query(
    f"WITH edge AS ({_EDGE_SQL})\n"
    + "\nUNION ALL\n".join(
        f'SELECT event_id, \'{c}\' AS "column", {c} AS value, \'{type_name}\' AS type '
        f"FROM edge WHERE {c} <> '' AND NOT ({check.format(c=c)})"
        for c, (type_name, check) in _EDGE_CHECKS.items()
    )
)
def cast_rejects(spark, sf_dir):
    """Every value that is refused by the type it is meant for."""
    schema = T.StructType([T.StructField(c, t) for c, t in _EDGE_TYPES.items()])
    return ob.cast_rejects(edge_text(spark, sf_dir), schema, "event_id")


def _accepted(column: str, result: str) -> str:
    check = _EDGE_CHECKS[column][1].format(c=column)
    return f"CASE WHEN {column} <> '' AND {check} THEN {result} END AS {column}"


@query(
    f"""
    WITH edge AS ({_EDGE_SQL})
    SELECT event_id, {_accepted("as_int", "TRY_CAST(as_int AS INTEGER)")},
           {_accepted("as_tiny", "CAST(TRY_CAST(as_tiny AS TINYINT) AS INTEGER)")},
           {_accepted("as_bool", "lower(as_bool) = 'true'")},
           {_accepted("as_ts", "TRY_CAST(as_ts AS TIMESTAMP)")},
           {_accepted("as_date", "CAST(TRY_CAST(as_date AS DATE) AS VARCHAR)")},
           {_accepted("as_decimal",
                      "CAST(TRY_CAST(replace(as_decimal, ',', '') AS DECIMAL(14,2)) "
                      "AS VARCHAR)")},
           CAST((as_int <> '' AND NOT ({_EDGE_CHECKS["as_int"][1].format(c="as_int")}))
                AS INTEGER)
           + CAST((as_tiny <> '' AND NOT ({_EDGE_CHECKS["as_tiny"][1].format(c="as_tiny")}))
                AS INTEGER) AS n_int_rejects
    FROM edge"""
)
def apply_schema_permissive(spark, sf_dir):
    """Typed rows and their rejects from one pass."""
    schema = T.StructType(
        [T.StructField("event_id", T.LongType())]
        + [T.StructField(c, t) for c, t in _EDGE_TYPES.items()]
    )
    records = edge_text(spark, sf_dir).withColumn(
        "event_id", F.col("event_id").cast("string")
    )
    typed = ob.apply_schema(records, schema, "permissive", rejects_col="rejects")
    int_rejects = F.filter(
        "rejects", lambda r: r["column"].isin("as_int", "as_tiny")
    )
    return typed.select(
        "event_id",
        "as_int",
        F.col("as_tiny").cast("int").alias("as_tiny"),
        "as_bool",
        F.col("as_ts").cast("timestamp_ntz").alias("as_ts"),
        F.col("as_date").cast("string").alias("as_date"),
        F.col("as_decimal").cast("string").alias("as_decimal"),
        F.size(int_rejects).alias("n_int_rejects"),
    )


@query(
    """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS price
    FROM orders"""
)
def decimal_commas(spark, sf_dir):
    records = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("o_orderkey"),
        F.format_number("o_totalprice", 2).alias("price"),
    )
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("price", T.DecimalType(12, 2)),
        ]
    )
    typed = ob.apply_schema(records, schema)
    return typed.withColumn("price", F.col("price").cast("string"))


@query(
    """
    SELECT doc_id, lang, source,
           replace(replace(replace(url_encode(text), '%20', '+'), '~', '%7E'), '%2A', '*')
               AS text
    FROM documents"""
)
def encode_fields(spark, sf_dir):
    """Only names that match exactly are encoded: ``" source"`` is not a field."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return ob.encode_fields(documents, "text, source,doc_id")


# --------------------------------------------------------------------- lines and sizes


def _csv_sql(expression: str) -> str:
    return (
        f"CASE WHEN regexp_matches({expression}, '[\",\\n\\r]') "
        f"THEN '\"' || replace({expression}, '\"', '\"\"') || '\"' "
        f"ELSE coalesce({expression}, '') END"
    )


def _line_sql(*expressions: str) -> str:
    return " || ',' || ".join(_csv_sql(e) for e in expressions)


_ORDER_LINE = _line_sql(
    "CAST(o_orderkey AS VARCHAR)",
    "CAST(o_custkey AS VARCHAR)",
    "o_orderstatus",
    "CAST(o_totalprice AS VARCHAR)",
    "CAST(o_orderdate AS VARCHAR) || '.0'",
    "o_orderpriority",
)


@query(
    f"""
    SELECT doc_id, {_line_sql("CAST(doc_id AS VARCHAR)", "text", "nullif(lang, 'en')",
                              "source", "CAST(n_chars AS VARCHAR)")} AS line
    FROM documents"""
)
def csv_line(spark, sf_dir):
    """Whole documents as CSV lines, with nulls among the values."""
    documents = table(spark, sf_dir, "documents").select(
        "doc_id", "text", F.nullif("lang", F.lit("en")).alias("lang"), "source", "n_chars"
    )
    return documents.select("doc_id", ob.csv_line(documents).alias("line"))


@query(
    f"""
    SELECT conv_id, turn, {_line_sql("CAST(conv_id AS VARCHAR)", "CAST(turn AS VARCHAR)",
                                     "role", "text")} AS line
    FROM conversations"""
)
def csv_line_conversations(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "turn", ob.csv_line(turns).alias("line"))


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, sf_dir):
    """Documents encoded, landed as result sets with headers, and read back."""
    documents = table(spark, sf_dir, "documents")
    path = new_run_dir(spark, "round-trip")
    ob.write_result_set(documents, path)
    return ob.apply_schema(ob.read_result_sets(spark, path), documents.schema)


@query(
    f"SELECT count(*) AS n_rows, CAST(sum(strlen({_ORDER_LINE})) AS BIGINT) AS n_bytes "
    "FROM orders"
)
def estimate_bytes(spark, sf_dir):
    return ob.estimate_bytes(table(spark, sf_dir, "orders"))


@query("SELECT count(*) AS n_rows, true AS within_bounds FROM orders")
def estimate_bytes_sampled(spark, sf_dir):
    """Size from ten random rows, which no draw can put outside these bounds."""
    orders = table(spark, sf_dir, "orders")
    size = ob.row_bytes(ob.csv_line(orders))
    shortest, longest = orders.agg(F.min(size), F.max(size)).first()
    drawn = F.expr("10 * (n_rows div 10)")
    return ob.estimate_bytes_sampled(orders).select(
        "n_rows", F.col("n_bytes").between(drawn * shortest, drawn * longest).alias("within_bounds")
    )


# ----------------------------------------------------------------------------- batches

ORDER_BATCH_BYTES = 65536

_PLANNED_SQL = f"""
    SELECT o_orderkey, line, CAST(strlen(line) AS BIGINT) AS n_bytes,
           1 + CAST((sum(strlen(line)) OVER (ORDER BY o_orderkey) - strlen(line))
                    // {ORDER_BATCH_BYTES} AS BIGINT) AS batch_no
    FROM (SELECT o_orderkey, {_ORDER_LINE} AS line FROM orders)"""

_ORDER_HEADER = "o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority"

_LINES_SQL = """
    SELECT line, true AS counted, true AS sized, true AS within_limit, true AS in_order
    FROM ({rows})"""


def payload_lines(batches, header: str, max_bytes: int, number: str, within=()):
    """The lines of all payloads, and whether each payload is what it should be.

    Rows are ordered by their first value, a whole number.
    """
    lines = F.split("payload", "\n")
    rows = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    keys = F.transform(rows, lambda line: F.split_part(line, F.lit(","), F.lit(1)).cast("bigint"))
    checked = batches.select(
        *within,
        number,
        rows.alias("rows"),
        keys.alias("keys"),
        ((F.size(rows) == F.col("n_rows")) & (lines[0] == header)).alias("counted"),
        (F.octet_length("payload") == F.col("n_bytes")).alias("sized"),
        ((F.octet_length("payload") <= max_bytes) | (F.size(rows) == 1)).alias("within_limit"),
    )
    before = checked.select(
        *within, (F.col(number) + 1).alias(number), F.array_max("keys").alias("largest_before")
    )
    follows = F.coalesce(F.col("largest_before") < F.array_min("keys"), F.col(number) == 1)
    # judged once per payload, before its lines are spread over rows
    judged = checked.join(before, [*within, number], "left").select(
        "rows",
        "counted",
        "sized",
        "within_limit",
        (follows & (F.array_sort("keys") == F.col("keys"))).alias("in_order"),
    )
    return judged.select(F.explode("rows").alias("line"), "counted", "sized", "within_limit", "in_order")


@query(f"SELECT o_orderkey, n_bytes, batch_no FROM ({_PLANNED_SQL})")
def plan_batches(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    planned = ob.plan_batches(
        orders, ["o_orderkey"], ORDER_BATCH_BYTES, unique_order=True
    )
    return planned.select("o_orderkey", "n_bytes", "batch_no")


@query(
    """
    WITH sized AS (
        SELECT l_returnflag, strlen(l_returnflag || ',' || l_linestatus) AS n FROM lineitem)
    SELECT 1 + CAST((t - n) // 4096 AS BIGINT) AS batch_no, count(*) AS n_rows
    FROM (SELECT *, sum(n) OVER (ORDER BY l_returnflag ROWS UNBOUNDED PRECEDING) AS t
          FROM sized)
    GROUP BY 1"""
)
def plan_batches_copies(spark, sf_dir):
    """Batches over rows of few distinct values, so copies are split as well."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus")
    planned = ob.plan_batches(flags, ["l_returnflag"], 4096)
    return planned.groupBy("batch_no").agg(F.count("*").alias("n_rows"))


@query(_LINES_SQL.format(rows=_PLANNED_SQL))
def batch_payloads(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    batches = ob.payloads(orders, ["o_orderkey"], ORDER_BATCH_BYTES, unique_order=True)
    return payload_lines(batches, _ORDER_HEADER, ORDER_BATCH_BYTES, "batch_no")


def staged_orders(spark, sf_dir):
    """Staged batches of orders and their expected totals."""
    path = new_run_dir(spark, "staged")
    staged = ob.stage_batches(
        table(spark, sf_dir, "orders"),
        path,
        ["o_orderkey"],
        ORDER_BATCH_BYTES,
        unique_order=True,
    )
    return staged, ob.staged_totals(spark, path)


@query(_LINES_SQL.format(rows=_PLANNED_SQL))
def stage_batches(spark, sf_dir):
    staged, _ = staged_orders(spark, sf_dir)
    return payload_lines(staged, _ORDER_HEADER, ORDER_BATCH_BYTES, "batch_no")


_CHECKED_SQL = f"""
    SELECT count(*) AS n_rows, CAST(sum(strlen({_ORDER_LINE}) + 1) AS BIGINT) AS line_bytes,
           true AS enough_batches, {{success}} AS success
    FROM orders"""


@query(_CHECKED_SQL.format(success="true"))
def check_staged(spark, sf_dir):
    """The check of whole batches; each has a header besides its lines."""
    staged, totals = staged_orders(spark, sf_dir)
    return ob.check_staged(staged, totals).select(
        "n_rows",
        (F.col("n_bytes") - F.col("n_batches") * len(_ORDER_HEADER)).alias("line_bytes"),
        (F.col("n_batches") * ORDER_BATCH_BYTES >= F.col("n_bytes")).alias("enough_batches"),
        "success",
    )


@query("SELECT count(*) < 0 AS last_lost, count(*) < 0 AS text_lost, count(*) < 0 AS too_large FROM orders")
def check_staged_torn(spark, sf_dir):
    """The check fails without the last batch, with a cut text, and above the limit."""
    staged, totals = staged_orders(spark, sf_dir)
    last = F.col("batch_no") == totals["n_batches"]
    cut = F.when(last, F.substring("payload", 1, 10)).otherwise(F.col("payload"))
    checks = {
        "last_lost": ob.check_staged(staged.where(~last), totals),
        "text_lost": ob.check_staged(staged.withColumn("payload", cut), totals),
        "too_large": ob.check_staged(staged, {**totals, "max_bytes": 100}),
    }
    found = None
    for name, check in checks.items():
        row = check.select(
            *[F.col("success").alias(n) if n == name else F.lit(False).alias(n) for n in checks]
        )
        found = row if found is None else found.union(row)
    return found.agg(*[F.bool_or(n).alias(n) for n in checks])


@query(
    """
    SELECT o_orderkey, o_orderkey // 4096 AS shard,
           1 + (row_number() OVER (PARTITION BY o_orderkey // 4096 ORDER BY o_orderkey) - 1)
               // 1000 AS seq
    FROM orders"""
)
def cut_batches(spark, sf_dir):
    """Batches cut by their number of rows."""
    orders = table(spark, sf_dir, "orders")
    shard = F.expr("o_orderkey div 4096")
    cut = ob.cut_batches(orders, ["o_orderkey"], max_rows=1000, shard=shard)
    return cut.select("o_orderkey", "shard", "seq")


_CUT_HEADER_BYTES = len(_ORDER_HEADER) + 1


@query(
    f"""
    WITH RECURSIVE lines AS (
        SELECT o_orderkey, o_orderkey // 256 AS shard,
               row_number() OVER (PARTITION BY o_orderkey // 256 ORDER BY o_orderkey) AS rn,
               CAST(strlen({_ORDER_LINE}) + 1 AS BIGINT) AS size
        FROM orders),
    filled AS (
        SELECT o_orderkey, shard, rn, CAST(1 AS BIGINT) AS seq,
               {_CUT_HEADER_BYTES} + size AS used
        FROM lines WHERE rn = 1
        UNION ALL
        SELECT l.o_orderkey, l.shard, l.rn,
               CASE WHEN f.used + l.size > 2000 THEN f.seq + 1 ELSE f.seq END,
               CASE WHEN f.used + l.size > 2000 THEN {_CUT_HEADER_BYTES} + l.size
                    ELSE f.used + l.size END
        FROM filled f JOIN lines l ON l.shard = f.shard AND l.rn = f.rn + 1)
    SELECT o_orderkey, shard, seq FROM filled"""
)
def cut_batches_bytes(spark, sf_dir):
    """Batches cut by their bytes, header and newlines included."""
    cut = ob.cut_batches(
        table(spark, sf_dir, "orders"),
        ["o_orderkey"],
        max_bytes=2000,
        header_bytes=_CUT_HEADER_BYTES,
        shard=F.expr("o_orderkey div 256"),
    )
    return cut.select("o_orderkey", "shard", "seq")


@query("SELECT count(*) AS n_rows, true AS within_caps FROM orders")
def cut_batches_ranges(spark, sf_dir):
    """The default cut, over range partitions: all rows are there, within the caps."""
    orders = table(spark, sf_dir, "orders")
    cut = ob.cut_batches(
        orders, ["o_orderkey"], max_rows=700, max_bytes=30000, unique_order=True
    )
    line = ob.csv_line(cut.select(*orders.columns))
    batches = cut.groupBy("shard", "seq").agg(
        F.count("*").alias("n"), F.sum(ob.row_bytes(line) + 1).alias("b")
    )
    return batches.agg(
        F.sum("n").alias("n_rows"),
        F.bool_and((F.col("n") <= 700) & (F.col("b") <= 30000)).alias("within_caps"),
    )


@query(
    f"""
    SELECT shard, seq, count(*) AS n_rows,
           '{_ORDER_HEADER}' || chr(10) || string_agg(line, chr(10) ORDER BY o_orderkey)
               AS payload
    FROM (SELECT o_orderkey, o_orderkey // 4096 AS shard, {_ORDER_LINE} AS line,
                 1 + (row_number() OVER (PARTITION BY o_orderkey // 4096
                                         ORDER BY o_orderkey) - 1) // 1000 AS seq
          FROM orders)
    GROUP BY shard, seq"""
)
def cut_payloads(spark, sf_dir):
    """Payloads of batches cut by their number of rows."""
    orders = table(spark, sf_dir, "orders")
    cut = ob.cut_payloads(
        orders, ["o_orderkey"], max_rows=1000, shard=F.expr("o_orderkey div 4096")
    )
    return cut.select("shard", "seq", "n_rows", "payload")


@query(f"SELECT {_ORDER_LINE} AS line, true AS within_caps FROM orders")
def cut_payloads_ranges(spark, sf_dir):
    """The lines found in payloads cut over range partitions, and their limits."""
    orders = table(spark, sf_dir, "orders")
    cut = ob.cut_payloads(orders, ["o_orderkey"], 700, 30000, unique_order=True)
    bounded = (F.col("n_rows") <= 700) & (F.octet_length("payload") <= 30000)
    return cut.select(
        F.explode(F.slice(F.split("payload", "\n"), 2, F.col("n_rows").cast("int"))).alias(
            "line"
        ),
        bounded.alias("within_caps"),
    )


# ---------------------------------------------------------------- updates and outcomes


def account_updates(spark: SparkSession, sf_dir: str, blanks: bool = False) -> DataFrame:
    """Balance changes for two segments, with repeated and unknown keys among them."""
    customers = table(spark, sf_dir, "customer")
    segment = F.col("c_mktsegment")
    balance = F.col("c_acctbal") + 100
    if blanks:
        balance = F.when(F.col("c_nationkey") != 5, balance)
    changed = customers.where(segment.isin("HOUSEHOLD", "MACHINERY")).select(
        "c_custkey", balance.alias("c_acctbal"), F.upper("c_name").alias("c_name")
    )
    repeated = customers.where(
        (segment == "MACHINERY") & (F.col("c_nationkey") == 3)
    ).select("c_custkey", F.lit(0.0).alias("c_acctbal"), "c_name")
    unknown = customers.where(segment == "BUILDING").select(
        (-F.col("c_custkey") - 1).alias("c_custkey"), "c_acctbal", "c_name"
    )
    return changed.unionByName(repeated).unionByName(unknown)


def _updates_sql(blanks: bool = False) -> str:
    balance = "c_acctbal + 100"
    if blanks:
        balance = f"CASE WHEN c_nationkey <> 5 THEN {balance} END"
    return f"""
    SELECT c_custkey, {balance} AS c_acctbal, upper(c_name) AS c_name
    FROM customer WHERE c_mktsegment IN ('HOUSEHOLD', 'MACHINERY')
    UNION ALL
    SELECT c_custkey, 0.0, c_name FROM customer
    WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 3
    UNION ALL
    SELECT -c_custkey - 1, c_acctbal, c_name FROM customer
    WHERE c_mktsegment = 'BUILDING'"""


def _updated_sql(new_balance: str, blanks: bool) -> str:
    return f"""
    WITH u AS ({_updates_sql(blanks)}),
    single AS (SELECT c_custkey AS k, any_value(c_name) AS n, max(c_acctbal) AS b
               FROM u GROUP BY c_custkey HAVING count(*) = 1)
    SELECT c_custkey, CASE WHEN k IS NULL THEN c_name ELSE n END AS c_name, c_nationkey,
           CASE WHEN k IS NULL THEN c_acctbal ELSE {new_balance} END AS c_acctbal,
           c_mktsegment
    FROM customer LEFT JOIN single ON k = c_custkey"""


@query(_updated_sql("b", False))
def update_by_key(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return ob.update_by_key(customers, account_updates(spark, sf_dir), "c_custkey")


@query(_updated_sql("coalesce(b, c_acctbal)", True))
def update_by_key_keep_nulls(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    updates = account_updates(spark, sf_dir, blanks=True)
    return ob.update_by_key(customers, updates, "c_custkey", nulls="keep")


@query(_updated_sql("b", True))
def update_by_key_set_nulls(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    updates = account_updates(spark, sf_dir, blanks=True)
    return ob.update_by_key(customers, updates, "c_custkey", nulls="set")


@query(
    f"""
    WITH u AS ({_updates_sql(True)}),
    single AS (SELECT c_custkey AS k, any_value(c_name) AS n, any_value(c_acctbal) AS b
               FROM u GROUP BY c_custkey
               HAVING count(*) = 1 AND count(c_name) = 1 AND count(c_acctbal) = 1)
    SELECT c_custkey, coalesce(n, c_name) AS c_name, c_nationkey,
           coalesce(b, c_acctbal) AS c_acctbal, c_mktsegment
    FROM customer LEFT JOIN single ON k = c_custkey"""
)
def update_by_key_reject_nulls(spark, sf_dir):
    """Rows with a null change nothing, the others are applied."""
    customers = table(spark, sf_dir, "customer")
    updates = account_updates(spark, sf_dir, blanks=True)
    return ob.update_by_key(customers, updates, "c_custkey", nulls="reject")


@query(_updated_sql("b", True))
def update_table(spark, sf_dir):
    """An update of a table by rows computed from that same table."""
    path = new_run_dir(spark, "accounts")
    name = f"accounts_{uuid.uuid4().hex}"
    ob.save_extract(table(spark, sf_dir, "customer"), f"{path}/first")
    accounts = ob.register_extract(spark, name, f"{path}/first")
    updates = account_updates(spark, sf_dir, blanks=True)
    ob.replace_extract(
        ob.update_by_key(accounts, updates, "c_custkey", nulls="set"), name, path
    )
    return spark.table(name)


def versioned_orders(spark: SparkSession, sf_dir: str) -> str:
    """The orders as an extract with versions, its files by ranges of the key."""
    path = new_run_dir(spark, "orders")
    orders = order_text(spark, sf_dir).withColumn("id", F.col("id").cast("bigint"))
    ob.commit_extract(orders.repartitionByRange(16, "id"), path, "id")
    return path


def late_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of the last hundredth of the orders, some keys twice or unknown."""
    orders = order_text(spark, sf_dir).withColumn("id", F.col("id").cast("bigint"))
    last = orders.agg(F.max("id")).first()[0]
    late = orders.where(F.col("id") > last - last // 100).select("id", F.concat(F.lit("late "), "name").alias("name"))
    return late.unionByName(late.where("id % 7 = 0")).unionByName(late.select((F.col("id") + last).alias("id"), "name"))


_LATE_SQL = """
    SELECT o_orderkey AS id,
           CASE WHEN o_orderkey > last - last // 100 AND o_orderkey % 7 <> 0
                THEN 'late ' || o_orderpriority ELSE o_orderpriority END AS name,
           CAST(CAST(o_totalprice AS DECIMAL(14,2)) AS VARCHAR) AS amount,
           CAST(o_orderdate AS VARCHAR) AS close_date
    FROM orders, (SELECT max(o_orderkey) AS last FROM orders)"""


@query(f"SELECT *, true AS few_written FROM ({_LATE_SQL})")
def update_files(spark, sf_dir):
    """An update that writes only the files that hold its keys, a small part of them."""
    path = versioned_orders(spark, sf_dir)
    ob.update_files(spark, path, late_orders(spark, sf_dir))
    few = F.expr("n_written > 0 and n_files >= 16 and n_rows > 0").alias("few")
    written = ob.extract_versions(spark, path).orderBy(F.desc("version")).select(few, "n_written").first()
    rows = ob.read_extract(spark, path)
    return rows.withColumn("few_written", F.lit(written["few"] and written["n_written"] <= 8))


@query(
    """
    WITH n AS (SELECT count(*) AS n FROM orders)
    SELECT 1 AS version, 0 AS base, 'replace' AS operation, n AS n_rows, n AS n_read FROM n
    UNION ALL SELECT 2, 1, 'update', n, n FROM n
    UNION ALL SELECT 3, 2, 'replace', (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0),
                     (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0)"""
)
def extract_versions(spark, sf_dir):
    """The log of three writes, with the rows that each version still reads."""
    path = versioned_orders(spark, sf_dir)
    ob.update_files(spark, path, late_orders(spark, sf_dir))
    ob.commit_extract(ob.read_extract(spark, path).where("id % 2 = 0"), path, "id")
    read = None
    for version in (1, 2, 3):
        rows = ob.read_extract(spark, path, version).agg(F.count("*").alias("n_read"))
        rows = rows.withColumn("version", F.lit(version).cast("bigint"))
        read = rows if read is None else read.unionByName(rows)
    return ob.extract_versions(spark, path).select("version", "base", "operation", "n_rows").join(read, "version")


@query(f"SELECT *, 2 AS version FROM ({_LATE_SQL})")
def extract_vacuum(spark, sf_dir):
    """The latest version after all others and the files that only they name are removed."""
    path = versioned_orders(spark, sf_dir)
    ob.update_files(spark, path, late_orders(spark, sf_dir))
    ob.extract_vacuum(spark, path)
    rows = ob.read_extract(spark, path)
    return rows.join(ob.extract_versions(spark, path).select(F.col("version").cast("int").alias("version")))


_RESULTS_SQL = f"""
    SELECT "Id", error = '' AS "Success", false AS "Created", error AS "Error" FROM (
        SELECT u.c_custkey AS "Id",
               CASE WHEN c.copies > 1 THEN 'duplicate key in the update'
                    WHEN t.c_custkey IS NULL THEN 'no row with this key'
                    WHEN u.c_acctbal IS NULL OR u.c_name IS NULL
                        THEN 'null value in the update'
                    ELSE '' END AS error
        FROM ({_updates_sql(True)}) u
        JOIN (SELECT c_custkey, count(*) AS copies FROM ({_updates_sql(True)})
              GROUP BY c_custkey) c ON c.c_custkey = u.c_custkey
        LEFT JOIN customer t ON t.c_custkey = u.c_custkey)"""


def account_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    updates = account_updates(spark, sf_dir, blanks=True)
    return ob.update_results(customers, updates, "c_custkey")


@query(_RESULTS_SQL)
def update_results(spark, sf_dir):
    return account_results(spark, sf_dir)


@query('SELECT "Error", count(*) AS n_rows FROM (' + _RESULTS_SQL
       + ') WHERE NOT "Success" GROUP BY "Error"')
def error_summary(spark, sf_dir):
    return ob.error_summary(account_results(spark, sf_dir))


_NEW_CUSTOMERS_SQL = """
    SELECT -s_suppkey - 1 AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey,
           s_acctbal AS c_acctbal
    FROM supplier"""


def new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        (-F.col("s_suppkey") - 1).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.col("s_acctbal").alias("c_acctbal"),
    )


@query(
    f"""
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT *, NULL FROM ({_NEW_CUSTOMERS_SQL})"""
)
def insert_rows(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return ob.insert_rows(customers, new_customers(spark, sf_dir))


@query(
    f"""
    SELECT c_custkey AS "Id", true AS "Success", true AS "Created", '' AS "Error"
    FROM ({_NEW_CUSTOMERS_SQL})"""
)
def insert_results(spark, sf_dir):
    return ob.insert_results(new_customers(spark, sf_dir), "c_custkey")


_FAULTY_CUSTOMERS_SQL = f"""
    SELECT CASE WHEN c_nationkey <> 5 THEN c_custkey END AS c_custkey, c_name,
           c_nationkey, c_acctbal FROM ({_NEW_CUSTOMERS_SQL})
    UNION ALL
    SELECT * FROM ({_NEW_CUSTOMERS_SQL}) WHERE c_nationkey = 3"""


def faulty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New customers, some without a key and some twice."""
    rows = new_customers(spark, sf_dir)
    keyed = rows.withColumn("c_custkey", F.when(F.col("c_nationkey") != 5, F.col("c_custkey")))
    return keyed.unionByName(rows.where("c_nationkey = 3"))


@query(
    f"""
    WITH f AS ({_FAULTY_CUSTOMERS_SQL})
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    UNION ALL
    SELECT *, NULL FROM f
    WHERE c_custkey IN (SELECT c_custkey FROM f GROUP BY c_custkey HAVING count(*) = 1)"""
)
def insert_rows_refused(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    return ob.insert_rows(customers, faulty_customers(spark, sf_dir), "c_custkey")


@query(
    f"""
    SELECT c_custkey AS "Id", error = '' AS "Success", error = '' AS "Created",
           error AS "Error"
    FROM (SELECT c_custkey,
                 CASE WHEN c_custkey IS NULL THEN 'key is missing'
                      WHEN count(*) OVER (PARTITION BY c_custkey) > 1
                          THEN 'duplicate key in the insert'
                      ELSE '' END AS error
          FROM ({_FAULTY_CUSTOMERS_SQL}))"""
)
def insert_results_refused(spark, sf_dir):
    return ob.insert_results(faulty_customers(spark, sf_dir), "c_custkey")


def landed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome records as text, flags in any case, one per event."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Id"),
        F.when(kind == "click", "true")
        .when(kind == "view", "TRUE")
        .when(kind == "purchase", "True")
        .when(kind == "signup", "yes")
        .alias("Success"),
        F.when(kind == "view", "true").when(kind == "error", "true").alias("Created"),
        F.when(kind == "error", F.col("props")).otherwise(F.lit("")).alias("Error"),
    )


@query(
    """
    SELECT CASE WHEN event_type IN ('signup', 'error') THEN 'failed'
                WHEN event_type = 'view' THEN 'created' ELSE 'updated' END AS status,
           count(*) AS n_rows
    FROM events GROUP BY 1"""
)
def result_summary(spark, sf_dir):
    return ob.result_summary(landed_outcomes(spark, sf_dir))


@query(
    """
    SELECT event_id AS "Id", CASE WHEN event_type = 'error' THEN props ELSE '' END AS "Error"
    FROM events WHERE event_type IN ('signup', 'error')"""
)
def failed_rows(spark, sf_dir):
    return ob.failed_rows(landed_outcomes(spark, sf_dir))


@query(
    """
    SELECT user_id AS job_id, count(*) AS n_batches,
           count(*) FILTER (event_type IN ('click', 'view') AND value > 200) AS n_pending,
           count(*) FILTER (event_type = 'error' AND value > 100) AS n_failed,
           NOT bool_or(event_type IN ('click', 'view') AND value > 200) AS finished,
           NOT bool_or(event_type IN ('click', 'view') AND value > 200
                       OR event_type = 'error' AND value > 100) AS success
    FROM events GROUP BY user_id"""
)
def job_status(spark, sf_dir):
    kind, value = F.col("event_type"), F.col("value")
    batches = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("job_id"),
        F.col("event_id").alias("batch_id"),
        F.when((kind == "click") & (value > 200), "Queued")
        .when((kind == "view") & (value > 200), "InProgress")
        .when((kind == "error") & (value > 100), "Failed")
        .otherwise("Completed")
        .alias("state"),
    )
    return ob.job_status(batches)


# ------------------------------------------------------------------ publish and tables


@query(
    f"""
    SELECT 'Opportunity.' || name AS "fullyQualifiedName", name AS label, name,
           false AS "isSystemField", false AS "isUniqueId", false AS "isMultiValue",
           CASE WHEN type IN ('int', 'bigint', 'double') THEN 'Numeric'
                WHEN type = 'timestamp' THEN 'Date' ELSE 'Text' END AS type,
           CAST(CASE type WHEN 'int' THEN 10 WHEN 'double' THEN 18 END AS INTEGER)
               AS precision,
           CASE type WHEN 'int' THEN '0' WHEN 'double' THEN '1.5' END AS "defaultValue",
           CAST(CASE type WHEN 'int' THEN 0 WHEN 'double' THEN 2 END AS INTEGER) AS scale,
           CASE type WHEN 'timestamp' THEN 'yyyy-MM-dd HH:mm:ss' END AS format,
           CASE type WHEN 'string' THEN 'true' END AS "canTruncateValue"
    FROM ({_inferred_sql(_ORDER_TEXT_SQL, _ORDER_COLUMNS)})"""
)
def field_table(spark, sf_dir):
    """The field list of a dataset whose types are inferred from all its records."""
    typed = ob.typed_rows(order_text(spark, sf_dir), infer=True)
    config = {
        "double": {
            "type": "Numeric", "precision": "18", "scale": "2", "defaultValue": "1.5",
        },
        "timestamp": {"type": "Date", "format": "yyyy-MM-dd HH:mm:ss"},
        "string": {"type": "Text", "canTruncateValue": "true"},
    }
    return ob.field_table(typed, "Opportunity", config)


_CUSTOMER_LINE = _line_sql(
    "CAST(c_custkey AS VARCHAR)",
    "c_name",
    "CAST(c_nationkey AS VARCHAR)",
    "CAST(c_acctbal AS VARCHAR)",
    "c_mktsegment",
)

_SUPPLIER_LINE = _line_sql(
    "CAST(-s_suppkey - 1 AS VARCHAR)",
    "s_name",
    "CAST(s_nationkey AS VARCHAR)",
    "CAST(s_acctbal AS VARCHAR)",
    "NULL",
)


@query(
    _LINES_SQL.format(
        rows=f"SELECT {_CUSTOMER_LINE} AS line FROM customer "
        f"UNION ALL SELECT {_SUPPLIER_LINE} FROM supplier"
    )
)
def publish_dataset(spark, sf_dir):
    """A dataset overwritten, then appended to; the parts as a reader finds them."""
    customers = table(spark, sf_dir, "customer")
    added = new_customers(spark, sf_dir).withColumn(
        "c_mktsegment", F.lit(None).cast("string")
    )
    path = new_run_dir(spark, "dataset")
    for rows, mode in ((added, "append"), (customers, "overwrite"), (added, "append")):
        ob.publish_dataset(
            rows,
            path,
            "Customer",
            ["c_custkey"],
            mode=mode,
            max_bytes=16384,
            unique_order=True,
        )
    return payload_lines(ob.published_parts(spark, path), "", 16384, "part_no", ["run"])


@query(
    f"""
    SELECT name, CASE WHEN type IN ('int', 'double') THEN 'Numeric' ELSE 'Text' END AS type,
           CAST(CASE type WHEN 'int' THEN 10 WHEN 'double' THEN 16 END AS INTEGER)
               AS precision,
           CASE WHEN type IN ('int', 'double') THEN '0' END AS "defaultValue",
           CAST(CASE type WHEN 'int' THEN 0 WHEN 'double' THEN 6 END AS INTEGER) AS scale
    FROM ({_inferred_sql(_ORDER_TEXT_SQL, _ORDER_COLUMNS)})"""
)
def published_manifest(spark, sf_dir):
    """The manifest of a published dataset, as a reader of the dataset finds it."""
    typed = ob.typed_rows(order_text(spark, sf_dir), infer=True)
    path = new_run_dir(spark, "dataset")
    ob.publish_dataset(typed, path, "Opportunity", ["id"], unique_order=True)
    fields = ob.manifest_fields(ob.published_manifests(spark, path), "manifest")
    return fields.select("name", "type", "precision", "defaultValue", "scale")


@query(
    "SELECT n_nationkey || ',' || n_name || ',' || n_regionkey AS line FROM nation "
    "UNION ALL SELECT n_nationkey || ',' || n_name || ',' || n_regionkey FROM nation"
)
def publish_other_mode(spark, sf_dir):
    """A save mode without an operation of its own appends."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    path = new_run_dir(spark, "dataset")
    for mode in ("overwrite", "ignore"):
        ob.publish_dataset(nations, path, "Nation", ["n_nationkey"], mode=mode, unique_order=True)
    lines = F.split("payload", "\n")
    parts = ob.published_parts(spark, path)
    return parts.select(F.explode(F.slice(lines, 2, F.size(lines))).alias("line"))


@query("SELECT count(*) AS n_rows, true AS refused, false AS written FROM orders")
def refused_scale(spark, sf_dir):
    """A scale above the limit stops a publish before anything is written."""
    orders = table(spark, sf_dir, "orders")
    path = new_run_dir(spark, "dataset")
    kind = orders.schema["o_totalprice"].dataType.typeName()
    config = {kind: {"type": "Numeric", "precision": "18", "scale": "7"}}
    refused = written = False
    try:
        ob.publish_dataset(orders, path, "Order", ["o_orderkey"], config=config)
    except ValueError:
        refused = True
    try:
        written = not spark.read.text(path, recursiveFileLookup=True).isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return orders.agg(
        F.count("*").alias("n_rows"), F.lit(refused).alias("refused"), F.lit(written).alias("written")
    )


@query("SELECT *, CAST(0 AS BIGINT) AS n_before FROM orders")
def empty_table(spark, sf_dir):
    """An empty table has no rows and takes those of the table whose schema it has."""
    orders = table(spark, sf_dir, "orders")
    path = new_run_dir(spark, "empty")
    name = f"empty_{path[-12:]}"
    ob.create_empty_table(orders, name, path)
    before = spark.table(name).count()
    orders.write.insertInto(name)
    return spark.table(name).withColumn("n_before", F.lit(before).cast("bigint"))


@query("SELECT * FROM orders")
def extract_table(spark, sf_dir):
    """An extract written as files and read through a table over them."""
    path = new_run_dir(spark, "extract")
    ob.save_extract(table(spark, sf_dir, "orders"), path)
    return ob.register_extract(spark, f"extract_{uuid.uuid4().hex}", path)


@query("SELECT * FROM customer")
def load_table(spark, sf_dir):
    """A full table load."""
    name = f"loaded_{uuid.uuid4().hex}"
    ob.save_table(table(spark, sf_dir, "customer"), name, new_run_dir(spark, "table"))
    return spark.table(name)
