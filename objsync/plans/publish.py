"""Dataset publish: manifest, then parts, then a commit record.

Every publish writes to a run folder of its own below the dataset's path. Its commit
record is the last thing written, and readers follow commit records only, so a
publish that fails half-way leaves nothing visible and can simply be run again.
"""

from __future__ import annotations

import json
import logging
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.operators.batches import TARGET_BATCH_BYTES, numbered
from objsync.plans.manifest import dataset_manifest
from objsync.plans.stage import check_staged, write_payloads

logger = logging.getLogger(__name__)

# Header members and their values.
FORMAT_CSV = "Csv"
OVERWRITE, APPEND = "Overwrite", "Append"
ACTION_NONE, ACTION_PROCESS = "None", "Process"

_HEADER = (
    "run string, format string, container string, alias string, operation string, "
    "action string, manifest string"
)
_COMMIT = (
    "run string, operation string, action string, committed_at bigint, "
    "n_parts bigint, n_rows bigint, n_bytes bigint"
)


def operation(mode: str) -> str:
    """The dataset operation of a save mode; an unsupported mode appends."""
    if mode.lower() == "overwrite":
        return OVERWRITE
    if mode.lower() != "append":
        logger.warning("save mode %s is not supported, appending", mode)
    return APPEND


def publish_dataset(
    df: DataFrame,
    path: str,
    name: str,
    order_by: list[str],
    mode: str = "append",
    config: dict[str, dict[str, str]] | str | None = None,
    app: str | None = None,
    max_bytes: int = TARGET_BATCH_BYTES,
    unique_order: bool = False,
    type_key: str = "type",
) -> str:
    """Publish ``df`` as dataset ``name`` under ``path``; returns the run id.

    The manifest is built before anything is written, so a type it refuses stops
    the publish. Parts start with a newline and carry no header line. They have
    ``max_bytes`` at most, but for a single row that is larger, and are written, read
    back and checked against what was sent before the commit record.
    """
    spark = df.sparkSession
    manifest = dataset_manifest(df.schema, name, config, type_key)
    # starts with a letter, so that the folder name is never taken for a number
    run = f"r{uuid.uuid4().hex}"
    oper = operation(mode)
    header = (run, FORMAT_CSV, app, name, oper, ACTION_NONE, manifest)
    _write_record(spark, header, _HEADER, f"{path}/headers/run={run}")

    parts_path = f"{path}/parts/run={run}"
    sent = write_payloads(df, parts_path, order_by, max_bytes, False, unique_order)
    stored = numbered(spark.read.parquet(parts_path), [], "part_no")
    check = check_staged(stored, sent).first()
    if not check["success"]:
        raise RuntimeError(f"parts of dataset {name} are not whole")

    sums = (check["n_batches"], check["n_rows"], check["n_bytes"])
    commit = (run, oper, ACTION_PROCESS, time.time_ns(), *sums)
    _write_record(spark, commit, _COMMIT, f"{path}/commits/run={run}")
    return run


def _write_record(spark: SparkSession, record: tuple, schema: str, path: str) -> None:
    one = spark.createDataFrame([record], schema).drop("run").coalesce(1)
    one.write.json(path)


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The commit records of a dataset, one row per successful publish."""
    return spark.read.schema(_COMMIT).json(f"{path}/commits")


def current_runs(spark: SparkSession, path: str) -> DataFrame:
    """Commit records that make up the dataset: the last overwrite and what follows.

    One row per publish.
    """
    done = commits(spark, path)
    last = done.where(F.col("operation") == OVERWRITE).agg(F.max("committed_at"))
    start = last.first()[0]
    return done if start is None else done.where(F.col("committed_at") >= start)


def published_manifests(spark: SparkSession, path: str) -> DataFrame:
    """Headers of the current runs, manifest included."""
    headers = spark.read.schema(_HEADER).json(f"{path}/headers")
    return headers.join(current_runs(spark, path).select("run"), "run", "left_semi")


def published_parts(spark: SparkSession, path: str) -> DataFrame:
    """Parts of the current runs: ``(run, part_no, n_rows, n_bytes, payload)``.

    The run is a partition folder, so parts of other runs are not read.
    """
    runs = current_runs(spark, path).select("run")
    if runs.isEmpty():
        raise ValueError(f"nothing has been published below {path}")
    parts = spark.read.parquet(f"{path}/parts").join(runs, "run", "left_semi")
    return numbered(parts, ["run"], "part_no")
