"""Row and batch outcomes: keyed updates, inserts, and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from objsync.functions.text import quoted

NULL_RULES = ("error", "keep", "set", "reject")

# rows made from one count by one task
UNFOLD_CHUNK = 10_000

# Batch states.
COMPLETED, FAILED = "Completed", "Failed"


def _changed_columns(target: DataFrame, updates: DataFrame, key: str) -> list[str]:
    unknown = [c for c in updates.columns if c not in target.columns]
    if unknown:
        raise ValueError(f"not in the target: {', '.join(unknown)}")
    if key not in updates.columns:
        raise ValueError(f"updates lack the key column {key}")
    return [c for c in updates.columns if c != key]


def _same_kind(target: DataFrame, updates: DataFrame, key: str) -> Column:
    """The key of ``updates`` in the target's type; one that cannot be cast is refused."""
    has, wants = updates.schema[key].dataType, target.schema[key].dataType
    column = F.col(quoted(key))
    if has == wants:
        return column
    if isinstance(has, T.AtomicType) and isinstance(wants, T.AtomicType):
        return column.try_cast(wants)
    raise ValueError(
        f"key {key} is {has.simpleString()} in the update and {wants.simpleString()} in the target"
    )


def _any_null(columns: list[str]) -> Column:
    held = F.lit(False)
    for name in columns:
        held = held | F.col(quoted(name)).isNull()
    return held


def _null_rule(nulls: str) -> None:
    if nulls not in NULL_RULES:
        raise ValueError(f"nulls must be one of {NULL_RULES}, not {nulls!r}")


def update_by_key(
    target: DataFrame, updates: DataFrame, key: str, nulls: str = "error"
) -> DataFrame:
    """``target`` with the columns of ``updates`` replaced where the key matches.

    A key that occurs more than once in ``updates`` changes nothing, as it is not
    defined which row should win; ``update_results`` reports it. A null in an
    update fails the job (``error``), leaves the old value (``keep``), is stored
    (``set``), or makes the row change nothing (``reject``). A key that has no value in
    the target's type matches nothing.

    Updates are reduced to one row per key, partly before they are shuffled. The join
    is on the key as a struct, which is not how the reduced updates are partitioned:
    both sides then come to it from a shuffle of their own, and only then can Spark
    split a key that holds many target rows (adaptive skew join).
    """
    _null_rule(nulls)
    changed = _changed_columns(target, updates, key)
    key_col = _same_kind(target, updates, key)
    refused = _any_null(changed) if nulls == "reject" else F.lit(False)
    single = (
        updates.where(key_col.isNotNull())
        .groupBy(key_col.alias("_key"))
        .agg(
            F.count("*").alias("_rows"),
            F.first(
                F.struct(
                    *[F.col(quoted(c)).alias(f"u{i}") for i, c in enumerate(changed)]
                )
                if changed
                else F.lit(None)
            ).alias("_new"),
            F.bool_or(refused).alias("_refused"),
        )
        .where((F.col("_rows") == 1) & ~F.col("_refused"))
        .select("_key", "_new")
    )
    old = target.alias("t")
    same_key = F.struct(F.col(f"t.{quoted(key)}").alias("k")) == F.struct(
        F.col("_key").alias("k")
    )
    joined = old.join(single, same_key, "left")
    matched = F.col("_key").isNotNull()
    columns = []
    for name in target.columns:
        value = F.col(f"t.{quoted(name)}")
        if name in changed:
            new = F.col(f"_new.u{changed.index(name)}").cast(target.schema[name].dataType)
            if nulls == "keep":
                value = F.coalesce(new, value)
            elif nulls in ("set", "reject"):
                value = F.when(matched, new).otherwise(value)
            else:
                problem = F.raise_error(F.lit(f"null in an update of column {name}"))
                value = F.when(matched, F.coalesce(new, problem)).otherwise(value)
        columns.append(value.alias(name))
    return joined.select(*columns)


def update_results(
    target: DataFrame, updates: DataFrame, key: str, nulls: str = "error"
) -> DataFrame:
    """One ``(Id, Success, Created, Error)`` row per row of ``updates``.

    It says what ``update_by_key`` does with each row under the same rule. Under
    ``error`` it names the rows at fault; the update itself fails as a whole if any of
    them would be applied, so use ``reject`` to apply the others.

    The outcome of a row depends on its key and on whether it holds a null, so the
    rows of each key are counted first, and only counts are shuffled and joined. A
    count is then unfolded into its rows, in chunks that are spread over the tasks:
    a key that holds many of the updates is never in one place.
    """
    _null_rule(nulls)
    changed = _changed_columns(target, updates, key)
    has_null = _any_null(changed) if nulls in ("error", "reject") else F.lit(False)
    key_col = _same_kind(target, updates, key)
    counted = updates.groupBy(key_col.alias("_key")).agg(
        F.count("*").alias("_of_key"), F.count_if(has_null).alias("_nulls")
    )
    known = (
        target.where(F.col(quoted(key)).isNotNull())
        .select(F.col(quoted(key)).alias("_known"))
        .distinct()
    )
    refusal = (
        F.when(F.col("_key").isNull(), "key is missing")
        .when(F.col("_of_key") > 1, "duplicate key in the update")
        .when(F.col("_known").isNull(), "no row with this key")
    )
    whole = F.coalesce(refusal, F.lit(""))
    nulled = F.coalesce(refusal, F.lit("null value in the update"))
    outcomes = counted.join(known, F.col("_key") == F.col("_known"), "left").select(
        F.col("_key"),
        F.inline(
            F.array(
                F.struct(whole.alias("_error"), (F.col("_of_key") - F.col("_nulls")).alias("_n")),
                F.struct(nulled.alias("_error"), F.col("_nulls").alias("_n")),
            )
        ),
    )
    return _unfold(outcomes.where(F.col("_n") > 0)).select(
        F.col("_key").alias("Id"),
        (F.col("_error") == "").alias("Success"),
        F.lit(False).alias("Created"),
        F.col("_error").alias("Error"),
    )


def _unfold(counts: DataFrame) -> DataFrame:
    """Each row ``_n`` times, made in chunks that are spread over the tasks."""
    last_chunk = F.call_function("div", F.col("_n") - 1, F.lit(UNFOLD_CHUNK))
    chunks = counts.select(
        "_key", "_error", "_n", F.explode(F.sequence(F.lit(0), last_chunk)).alias("_chunk")
    ).repartition("_key", "_chunk")
    size = F.least(F.lit(UNFOLD_CHUNK), F.col("_n") - F.col("_chunk") * UNFOLD_CHUNK)
    return chunks.select(
        "_key", "_error", F.explode(F.array_repeat(F.lit(0), size.cast("int")))
    )


def _key_counts(rows: DataFrame, key: str) -> DataFrame:
    return rows.groupBy(F.col(quoted(key)).alias("_key")).agg(F.count("*").alias("_n"))


def insert_rows(target: DataFrame, rows: DataFrame, key: str | None = None) -> DataFrame:
    """``target`` followed by ``rows``, matched by name; absent columns are null.

    With ``key``, rows that ``insert_results`` refuses are left out.
    """
    if key is not None:
        repeated = _key_counts(rows, key).where("_n > 1").select("_key")
        rows = rows.where(F.col(quoted(key)).isNotNull()).join(
            repeated, F.col(quoted(key)) == F.col("_key"), "left_anti"
        )
    return target.unionByName(rows, allowMissingColumns=True)


def insert_results(rows: DataFrame, key: str) -> DataFrame:
    """One ``(Id, Success, Created, Error)`` row per row to be inserted.

    A row without a key, and all rows of a key that occurs more than once, are refused.
    """
    error = (
        F.when(F.col("_key").isNull(), "key is missing")
        .when(F.col("_n") > 1, "duplicate key in the insert")
        .otherwise("")
    )
    return _unfold(_key_counts(rows, key).withColumn("_error", error)).select(
        F.col("_key").alias("Id"),
        (F.col("_error") == "").alias("Success"),
        (F.col("_error") == "").alias("Created"),
        F.col("_error").alias("Error"),
    )


def is_true(flag: Column) -> Column:
    """Outcome flag: ``true`` in any case is true, all else (null too) false."""
    return F.coalesce(F.lower(flag.cast("string")) == "true", F.lit(False))


def row_status(success: Column, created: Column) -> Column:
    """``created``, ``updated`` or ``failed``."""
    return (
        F.when(~is_true(success), "failed")
        .when(is_true(created), "created")
        .otherwise("updated")
    )


def result_summary(results: DataFrame) -> DataFrame:
    """Outcome rows counted by status."""
    status = row_status(F.col("Success"), F.col("Created")).alias("status")
    return results.groupBy(status).agg(F.count("*").alias("n_rows"))


def failed_rows(results: DataFrame) -> DataFrame:
    """The ``(Id, Error)`` of every row that did not succeed."""
    return results.where(~is_true(F.col("Success"))).select("Id", "Error")


def error_summary(results: DataFrame) -> DataFrame:
    """Failed rows counted by error text."""
    return failed_rows(results).groupBy("Error").agg(F.count("*").alias("n_rows"))


def job_status(batches: DataFrame) -> DataFrame:
    """State of each job from its ``(job_id, batch_id, state)`` rows.

    A job is finished when every batch has completed or failed, and succeeded when
    all have completed.
    """
    state = F.coalesce(F.col("state"), F.lit(""))
    pending = ~state.isin(COMPLETED, FAILED)
    return batches.groupBy("job_id").agg(
        F.count("*").alias("n_batches"),
        F.count_if(pending).alias("n_pending"),
        F.count_if(state == FAILED).alias("n_failed"),
        (~F.bool_or(pending)).alias("finished"),
        F.bool_and(state == COMPLETED).alias("success"),
    )
