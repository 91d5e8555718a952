"""Result sets of large files read in many tasks, with newlines inside of quotes.

A byte range of a CSV file does not tell whether it starts inside a quoted value. Lines
come from Spark's own splits; what a chunk of them does to that state is found for both
beginnings, so a chunk is a function of two states. Running compositions of these, a
window over one short row per chunk, give every chunk its true beginning. Records inside
a chunk are then cut apart in place, and one that goes on over chunks is put together
from its pieces.

One scan reads all files, whatever their headers: a header belongs to a file, and a row
finds its columns by the positions that its file's header gives them.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from objsync.session import new_run_dir

#: Bytes of the lines of a chunk; a longer line is one by itself.
CHUNK_BYTES = 4 << 20

_CHUNK = (
    "file string, start long, seq int, text binary, "
    "plain_ends boolean, quoted_ends boolean, head int, plain_tail int, quoted_tail int"
)
_PLACE = ["file", "start", "seq"]


def open_after(line: bytes, inside: bool) -> bool:
    """Whether a quoted value is open after a line, given whether one is before it.

    A value is quoted if it starts with a quote; two quotes inside are one. What follows
    its closing quote belongs to it up to the next comma, quotes included, and quotes in
    other values mean nothing.
    """
    at = 0
    if not inside and line.startswith(b'"'):
        inside, at = True, 1
    while True:
        if inside:
            quote = line.find(b'"', at)
            if quote < 0:
                return True
            at = quote + 1
            if line[at : at + 1] == b'"':
                at += 1
                continue
            inside = False
        quoted = line.find(b',"', at)
        if quoted < 0:
            return False
        inside, at = True, quoted + 2


class _Chunk:
    """Lines of one chunk and what they do to either state."""

    def __init__(self) -> None:
        self.lines: list[bytes] = []
        self.size = 0
        self.open = [False, True]
        # where the first record of the quoted beginning ends, and the last of both
        self.head: int | None = None
        self.tail: list[int | None] = [None, None]

    def add(self, line: bytes) -> None:
        self.lines.append(line)
        self.size += len(line) + 1
        if b'"' in line:
            plain = open_after(line, self.open[0])
            self.open = [plain, plain if self.open[1] == self.open[0] else open_after(line, self.open[1])]
        for i in (0, 1):
            if not self.open[i]:
                self.tail[i] = self.size
        if self.head is None and not self.open[1]:
            self.head = self.size

    def row(self, file: str, start: int, seq: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict(
            {
                "file": [file],
                "start": [start],
                "seq": pa.array([seq], pa.int32()),
                "text": [b"".join(line + b"\n" for line in self.lines)],
                "plain_ends": [not self.open[0]],
                "quoted_ends": [not self.open[1]],
                "head": pa.array([self.head], pa.int32()),
                "plain_tail": pa.array([self.tail[0]], pa.int32()),
                "quoted_tail": pa.array([self.tail[1]], pa.int32()),
            }
        )


def _chunks(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq, chunk = None, 0, _Chunk()
        for batch in batches:
            lines = batch.column("value").cast(pa.binary()).to_pylist()
            places = zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), strict=True)
            for line, place in zip(lines, places, strict=True):
                if place != now:
                    if chunk.lines:
                        yield chunk.row(*now, seq)
                    now, seq, chunk = place, 0, _Chunk()
                if not chunk.lines and seq == 0 and place[1] == 0 and not line.rstrip(b"\r"):
                    continue  # blank lines before the header
                if chunk.lines and chunk.size + len(line) > chunk_bytes:
                    yield chunk.row(*now, seq)
                    seq, chunk = seq + 1, _Chunk()
                chunk.add(line)
        if chunk.lines:
            yield chunk.row(*now, seq)

    return run


def _states(chunks: DataFrame) -> DataFrame:
    """For each chunk, whether it starts inside a quoted value and which chunk opened the record.

    A chunk that ends alike from both beginnings sets the state; one that exchanges them
    flips it; all others leave it. The state is the last one set and the flips since.
    """
    by_file = Window.partitionBy("file").orderBy("start", "seq")
    so_far = by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = by_file.rowsBetween(Window.unboundedPreceding, -1)
    sets = F.when(F.col("plain_ends") == F.col("quoted_ends"), (~F.col("plain_ends")).cast("int"))
    flips = (~F.col("plain_ends") & F.col("quoted_ends")).cast("int")
    rows = chunks.drop("text").withColumn("sets", sets).withColumn("flips", F.sum(flips).over(so_far))
    last_set = F.last(F.when(F.col("sets").isNotNull(), F.struct("sets", "flips")), ignorenulls=True).over(so_far)
    since = F.col("flips") - F.coalesce(last_set["flips"], F.lit(0))
    rows = rows.withColumn("open", (F.coalesce(last_set["sets"], F.lit(0)) + since) % 2 == 1)
    rows = rows.withColumn("inside", F.coalesce(F.lag("open").over(by_file), F.lit(False)))
    rows = rows.withColumn("tail", F.when(F.col("inside"), F.col("quoted_tail")).otherwise(F.col("plain_tail")))
    opens = F.col("open") & (~F.col("inside") | F.col("tail").isNotNull())
    opener = F.last(F.when(opens, F.struct("start", "seq")), ignorenulls=True).over(earlier)
    return rows.select(*_PLACE, "inside", "open", "head", "tail", opener.alias("opener"))


def _cut(text: Column, begin: Column, end: Column) -> Column:
    return F.substring(text, begin + 1, end - begin)


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of chunks that start and end between records, and whether each is its file's first."""
    for batch in batches:
        for file, first, text in zip(*(batch.column(c).to_pylist() for c in ("file", "first", "text")), strict=True):
            records, held, inside = [], [], False
            for line in text.split(b"\n")[:-1]:
                held.append(line)
                inside = open_after(line, inside) if b'"' in line else inside
                if not inside:
                    records.append(held[0] if len(held) == 1 else b"\n".join(held))
                    held = []
            if held:  # the file ends inside a value
                records.append(b"\n".join(held))
            for a in range(0, len(records), 1 << 14):
                some = records[a : a + (1 << 14)]
                flags = [False] * len(some)
                flags[0] = first and a == 0
                yield pa.RecordBatch.from_pydict({"file": [file] * len(some), "first": flags, "record": some})


def _records(chunks: DataFrame) -> DataFrame:
    """``(file, first, record)``: every record of every file; ``first`` marks headers."""
    placed = chunks.select(*_PLACE, "text").join(_states(chunks), _PLACE)
    top = (F.col("start") == 0) & (F.col("seq") == 0)
    size = F.octet_length("text")
    begin = F.when(F.col("inside"), F.col("head")).otherwise(0)
    body = placed.where(F.col("tail").isNotNull() & (F.col("tail") > begin))
    body = body.select("file", top.alias("first"), _cut(F.col("text"), begin, F.col("tail")).alias("text"))
    whole = body.mapInArrow(_bodies, "file string, first boolean, record binary")

    piece = F.struct("start", "seq", "part")
    own = F.struct("start", "seq")
    heads = placed.where("inside").select(
        "file", F.col("opener").alias("key"), "start", "seq",
        F.when(F.col("head").isNull(), F.col("text")).otherwise(_cut(F.col("text"), F.lit(0), F.col("head"))).alias("part"),
        F.lit(False).alias("first"),
    )
    tails = placed.where(F.col("open") & (~F.col("inside") | F.col("tail").isNotNull())).select(
        "file", own.alias("key"), "start", "seq",
        _cut(F.col("text"), F.coalesce("tail", F.lit(0)), size).alias("part"),
        (top & F.col("tail").isNull()).alias("first"),
    )
    joined = tails.unionByName(heads).groupBy("file", "key").agg(
        F.bool_or("first").alias("first"), F.array_sort(F.collect_list(piece)).alias("pieces")
    )
    text = F.aggregate("pieces", F.lit(b""), lambda a, p: F.concat(a, p["part"]))
    # without the newline that ends the record
    long = joined.select("file", "first", F.substring(text, F.lit(1), F.octet_length(text) - 1).alias("record"))
    every = whole.unionByName(long).withColumn("record", F.col("record").cast("string"))
    every = every.withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return every.where(F.col("record") != "")


def _header_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = [next(csv.reader(io.StringIO(text, newline=""))) for text in batch.column("record").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("file"), pa.array(names, pa.list_(pa.string()))], ["file", "header"]
        )


def read_result_sets_split(
    spark: SparkSession, path: str | list[str], chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """All rows of all result sets below ``path`` as text, large files in many tasks.

    The rows of ``read_result_sets``, whose files may hold newlines inside of quotes.
    Records end in a newline, with or without a carriage return before it; one inside of
    quotes stays as it is. Lines are written once as chunks, as the splits of a later scan
    may be others. The driver holds the distinct headers only.
    """
    lines = spark.read.text(path, lineSep="\n", recursiveFileLookup=True).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")
    )
    folder = new_run_dir(spark, "chunks")
    lines.mapInArrow(_chunks(chunk_bytes), _CHUNK).write.parquet(folder)
    records = _records(spark.read.parquet(folder))

    headers = records.where("first").select("file", "record").mapInArrow(_header_names, "file string, header array<string>")
    kept = new_run_dir(spark, "headers")
    headers.write.parquet(kept)
    headers = spark.read.parquet(kept)
    distinct = headers.groupBy("header").agg(F.min("file").alias("file")).orderBy("file").collect()
    if not distinct:
        raise ValueError(f"no result set with a header below {path}")
    names = list(dict.fromkeys(name for r in distinct for name in r["header"]))
    width = max(len(r["header"]) for r in distinct)
    schema = ", ".join(f"c{i} string" for i in range(width))

    def positions(header: Column) -> Column:
        # of two equal header names the last counts
        listed = F.array(*[F.lit(name) for name in names])
        back = F.transform(listed, lambda n: F.array_position(F.reverse(header), n))
        return F.transform(back, lambda p: F.when(p > 0, (F.size(header) - p).cast("int")))

    rows = records.where(~F.col("first"))
    if len(distinct) == 1:
        header = F.array(*[F.lit(name) for name in distinct[0]["header"]])
        rows = rows.withColumn("at", positions(header))
    else:
        rows = rows.join(headers.select("file", positions(F.col("header")).alias("at")), "file")
    parsed = F.from_csv("record", schema, {"escape": '"', "multiLine": "true"}).alias("v")
    values = F.array(*[F.col(f"v.c{i}") for i in range(width)])
    rows = rows.select("at", parsed).select("at", values.alias("values"))
    return rows.select(*[F.coalesce(F.get("values", F.get("at", F.lit(i))), F.lit("")).alias(n) for i, n in enumerate(names)])
