"""Bulk query results: a folder of CSV result sets, each with its own header."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# large enough that every file becomes a scan task of its own
_ONE_FILE_PER_TASK = str(1 << 40)
_LINES_AT_ONCE = "64"


def _headers(spark: SparkSession, path: str | list[str]) -> list[tuple[list, list]]:
    """The distinct headers below ``path``, each with the files that carry it.

    A task opens one file and stops after its first record, so the cost grows with
    the number of files and not with their size. The packing settings belong to a
    session of their own. A file without any line has no header and no rows.
    """

    def first_record(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files: list[str] = []

        def lines() -> Iterator[str]:
            for batch in batches:
                files.extend(batch.column(1).to_pylist()[:1])
                yield from (line + "\n" for line in batch.column(0).to_pylist())

        # as many lines as the record has; the reader skips blank lines before it
        header = next((record for record in csv.reader(lines()) if record), None)
        if header is not None:
            yield pa.RecordBatch.from_pydict({"header": [header], "file": files[:1]})

    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", _ONE_FILE_PER_TASK)
    session.conf.set("spark.sql.files.openCostInBytes", _ONE_FILE_PER_TASK)
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", _LINES_AT_ONCE)
    found = (
        session.read.text(path, recursiveFileLookup=True)
        .select("value", F.col("_metadata.file_path"))
        .mapInArrow(first_record, "header array<string>, file string")
        .groupBy("header")
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
        .orderBy("files")
    )
    return [(r["header"], [_exact(unquote(f)) for f in r["files"]]) for r in found.collect()]


def _exact(path: str) -> str:
    """``path`` as a pattern that only it matches."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _read(
    spark: SparkSession,
    path: str | list[str],
    header: list[str],
    multi_line: bool,
    check_header: bool = False,
) -> DataFrame:
    names = header if check_header else [f"c{i}" for i in range(len(header))]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    return spark.read.csv(
        path,
        schema=schema,
        header=True,
        multiLine=multi_line,
        escape='"',
        enforceSchema=not check_header,
        recursiveFileLookup=True,
    ).toDF(*[f"c{i}" for i in range(len(header))])


def _texts(df: DataFrame, header: list[str], columns: list[str]) -> list[Column]:
    # of two equal header names the last counts
    position = {name: f"c{i}" for i, name in enumerate(header)}
    return [
        F.coalesce(df[position[name]], F.lit("")).alias(name)
        if name in position
        else F.lit("").alias(name)
        for name in columns
    ]


def read_result_sets(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """All rows of all result sets below ``path``, sub-folders too, as text.

    Files are grouped by header and each group is read by its own header, so files
    may order their columns differently or lack some. Columns come in the order
    they are first seen. An empty value, one missing from a short row and one whose
    column a file lacks all read as ``""``.

    With ``columns`` every file must carry exactly that header; nothing is read
    ahead and Spark checks the header of each file as it scans it. Set
    ``multi_line=False`` when no value holds a newline: large files are then split.
    """
    if columns is not None:
        df = _read(spark, path, columns, multi_line, check_header=True)
        return df.select(*_texts(df, columns, columns))
    groups = _headers(spark, path)
    if not groups:
        raise ValueError(f"no result set with a header below {path}")
    names = list(dict.fromkeys(name for header, _ in groups for name in header))
    parts = []
    for header, files in groups:
        df = _read(spark, path if len(groups) == 1 else files, header, multi_line)
        parts.append(df.select(*_texts(df, header, names)))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.union(part)
    return rows
