"""Extracts with versions: a log of file lists, and updates that rewrite only what changes.

Below the path of an extract are ``data`` with a folder of files per write, ``lists`` with
a table per version that names its files, and ``log`` with a record per version. A file
list holds, for each file, its rows, the range of its keys and a bitmap of their hashes.

A version is there once its log record is, and that is put in place only if there is none
of its number. Of two writers that start from one version the second is refused, and its
files are left out of all lists. Readers follow the log, so they see whole versions.
"""

from __future__ import annotations

import json
import os
import uuid
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from objsync.functions.text import quoted
from objsync.operators.outcomes import _same_kind, update_by_key
from objsync.sources.result_sets import _exact

_RECORD = "version bigint, base bigint, operation string, list string, key string, n_files bigint, n_rows bigint, n_written bigint"
#: Bits of a file's bitmap for each of its rows, and the most buckets of 32768 bits.
BITS_PER_ROW, MAX_BUCKETS = 8, 1024
_BUCKET = 1 << 15


class WriteConflict(RuntimeError):
    """Another writer has made the version that this one was to make."""


def _hadoop(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where, where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, or not at all where there is one."""
    jvm, where, fs = _hadoop(spark, path)
    fs.mkdirs(where.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(f"{where.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            # a link is refused by the file system itself if the name is taken
            os.link(urlparse(draft.toString()).path, urlparse(where.toString()).path)
            return True
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), conf).rename(draft, where, options)
        return True
    except FileExistsError:
        return False
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(draft, False)


def _record(path: str, version: int) -> str:
    return f"{path}/log/{version:020d}.json"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    jvm, where, fs = _hadoop(spark, f"{path}/log")
    if not fs.exists(where):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(int(name.removesuffix(".json")) for name in names if name.endswith(".json") and name[0] != ".")


def extract_versions(spark: SparkSession, path: str) -> DataFrame:
    """``(version, base, operation, n_files, n_rows, n_written, ...)`` of every version kept."""
    files = [_record(path, v) for v in _numbers(spark, path)]
    if not files:
        return spark.createDataFrame([], _RECORD)
    return spark.read.schema(_RECORD).json(files)


def _latest(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    known = _numbers(spark, path)
    if version is None:
        version = known[-1] if known else None
    elif version not in known:
        raise ValueError(f"no version {version} of {path}")
    return None if version is None else spark.read.schema(_RECORD).json(_record(path, version)).first().asDict()


def _file_list(spark: SparkSession, folder: str, key: str | None) -> DataFrame:
    """The files of a written folder: rows, key range and bitmap of key hashes."""
    rows = spark.read.parquet(folder)
    # a path as it is read, not as a URL
    rows = rows.select(
        F.col("_metadata.file_path").alias("file"),
        (F.col(quoted(key)) if key else F.lit(None).cast("string")).alias("k"),
    )
    counted = rows.groupBy("file").agg(
        F.count("*").alias("n_rows"), F.min("k").alias("least"), F.max("k").alias("greatest")
    )
    # one number of buckets for a write, a power of two
    most = counted.agg(F.max("n_rows")).first()[0] or 0
    buckets = 1
    while buckets < MAX_BUCKETS and buckets * _BUCKET < most * BITS_PER_ROW:
        buckets *= 2
    bits = rows.where("k is not null").groupBy("file", _bucket(F.col("k"), buckets).alias("bucket")).agg(_bits(F.col("k")))
    bits = bits.groupBy("file").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("bits"))
    return counted.withColumn("buckets", F.lit(buckets)).join(bits, "file", "left")


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(key), 20), F.lit(buckets)).cast("int")


def _bits(key: Column) -> Column:
    return F.bitmap_construct_agg(F.xxhash64(key).bitwiseAND(F.lit(_BUCKET - 1))).alias("bits")


def _commit(spark: SparkSession, path: str, base: dict | None, operation: str, key: str | None, files: DataFrame, n_written: int) -> int:
    version = (base["version"] if base else 0) + 1
    name = f"lists/{uuid.uuid4().hex}"
    files.write.parquet(f"{path}/{name}")
    total = spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("f"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("r")).first()
    record = {
        "version": version,
        "base": base["version"] if base else 0,
        "operation": operation,
        "list": name,
        "key": key,
        "n_files": total["f"],
        "n_rows": total["r"],
        "n_written": n_written,
    }
    if not _put_if_absent(spark, _record(path, version), json.dumps(record)):
        raise WriteConflict(f"version {version} of {path} was made by another writer")
    return version


def _base(spark: SparkSession, path: str, base: int | None) -> dict | None:
    """The version a write starts from; 0 is the state before the first."""
    return None if base == 0 else _latest(spark, path, base)


def commit_extract(df: DataFrame, path: str, key: str | None = None, base: int | None = None) -> int:
    """Write all rows of ``df`` as the next version and return its number.

    ``base`` is the version the write starts from, the latest by default; if another
    writer has made a version after it, the write is refused. Files whose keys lie close
    together make later updates rewrite little, so order ``df`` by ranges of its key.
    """
    spark = df.sparkSession
    start = _base(spark, path, base)
    folder = f"{path}/data/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    files = _file_list(spark, folder, key)
    return _commit(spark, path, start, "replace", key, files, files.count())


def read_extract(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the latest; the driver lists its files, as for any scan."""
    held = _latest(spark, path, version)
    if held is None:
        raise ValueError(f"no version of {path}")
    return _read_files(spark, spark.read.parquet(f"{path}/{held['list']}"))


def _read_files(spark: SparkSession, files: DataFrame) -> DataFrame:
    return spark.read.parquet(*[_exact(unquote(r["file"])) for r in files.select("file").toLocalIterator()])


def _meets(mine: dict[int, bytes]):
    """Files of which some bucket shares a bit with the bitmap of the update's keys."""

    def run(batches):
        for batch in batches:
            keep = []
            for buckets, held in zip(batch.column("buckets").to_pylist(), batch.column("bits").to_pylist(), strict=True):
                own = mine.get(buckets, {})
                keep.append(
                    any(
                        (np.frombuffer(bits, np.uint8) & np.frombuffer(own[b], np.uint8)).any()
                        for b, bits in held or []
                        if b in own
                    )
                )
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def candidate_files(files: DataFrame, keys: DataFrame) -> DataFrame:
    """Those of a version's ``files`` that may hold one of ``keys`` (one column, of the key's type).

    First by the range of all keys, then by bitmaps: that of the keys is made once for
    each number of buckets that files have, powers of two up to ``MAX_BUCKETS``.
    """
    key = F.col(keys.columns[0])
    ends = keys.agg(F.min(key).alias("first"), F.max(key).alias("last"))
    near = files.join(F.broadcast(ends), (F.col("greatest") >= F.col("first")) & (F.col("least") <= F.col("last")))
    near = near.drop("first", "last")
    mine: dict[int, dict[int, bytes]] = {}
    for (buckets,) in near.select("buckets").distinct().collect():
        made = keys.where(key.isNotNull()).groupBy(_bucket(key, buckets).alias("bucket")).agg(_bits(key))
        mine[buckets] = {r["bucket"]: bytes(r["bits"]) for r in made.collect()}
    return near.mapInArrow(_meets(mine), near.schema)


def update_files(spark: SparkSession, path: str, updates: DataFrame, nulls: str = "error", base: int | None = None) -> int:
    """``update_by_key`` on the latest version, writing anew only files that hold an updated key.

    Candidate files come from the file list, those of them that really hold a key from
    one scan of their key column. All others are carried over by name. The new version's
    number is returned; its log record says how many files were written.
    """
    start = _base(spark, path, base)
    if start is None or not start["key"]:
        raise ValueError(f"{path} has no version with a key")
    key = start["key"]
    files = spark.read.parquet(f"{path}/{start['list']}")
    target = read_extract(spark, path, start["version"])
    keys = updates.select(_same_kind(target, updates, key).alias("_key")).where("_key is not null")
    near = candidate_files(files, keys)
    listed = [_exact(unquote(r["file"])) for r in near.select("file").toLocalIterator()]
    hit: list[str] = []
    if listed:
        rows = spark.read.schema(target.schema).parquet(*listed)
        rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col(quoted(key)).alias("_key"))
        held = rows.join(keys.distinct(), F.struct(rows["_key"]) == F.struct(keys["_key"]), "left_semi")
        hit = [r["file"] for r in held.select("file").distinct().toLocalIterator()]
    if not hit:
        update_by_key(target, updates, key, nulls)  # what the update must be, it must be here too
        return _commit(spark, path, start, "update", key, files, 0)
    folder = f"{path}/data/{uuid.uuid4().hex}"
    some = spark.read.schema(target.schema).parquet(*[_exact(unquote(f)) for f in hit])
    update_by_key(some, updates, key, nulls).write.parquet(folder)
    new = _file_list(spark, folder, key)
    names = spark.createDataFrame([(f,) for f in hit], "file string")
    after = files.join(names, "file", "left_anti").unionByName(new)
    return _commit(spark, path, start, "update", key, after, new.count())


def extract_vacuum(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove all versions but the last ``keep``, with the files that no kept version names.

    Log records go first, so that no reader finds a version that is being removed. Files
    of writes that were never committed are not touched, as they may belong to a writer
    at work. The number of removed data files is returned.
    """
    if keep < 1:
        raise ValueError("at least one version is kept")
    numbers = _numbers(spark, path)
    old, live = numbers[:-keep], numbers[-keep:]
    if not old:
        return 0
    records = {v: _latest(spark, path, v) for v in numbers}

    def named(versions: list[int]) -> DataFrame:
        return spark.read.parquet(*[f"{path}/{records[v]['list']}" for v in versions]).select("file").distinct()

    gone = named(old).join(named(live), "file", "left_anti")
    files = [unquote(r["file"]) for r in gone.toLocalIterator()]
    for v in old:
        _, where, fs = _hadoop(spark, _record(path, v))
        fs.delete(where, False)
    for file in files:
        _, where, fs = _hadoop(spark, file)
        fs.delete(where, False)
    for v in old:
        _, where, fs = _hadoop(spark, f"{path}/{records[v]['list']}")
        fs.delete(where, True)
    return len(files)
