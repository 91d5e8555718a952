"""Matches of patterns with their places, and texts with places replaced, as columns.

Arrays grow by copies, so what is gathered from many matches is gathered in runs of
``RUN`` first: the work of a text grows with its matches, not with their square.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "struct<start:bigint,end:bigint,value:string,part:string>"
#: Elements that are folded into one array before it is put beside the others.
RUN = 64


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def runs(items: Column) -> Column:
    """``items`` as an array of arrays of ``RUN`` elements; none for an empty one."""
    numbers = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / RUN).cast("int"))
    return F.when(F.size(items) > 0, F.transform(numbers, lambda k: F.slice(items, k * RUN + 1, F.lit(RUN)))).otherwise(
        F.transform(F.slice(items, 1, 0), lambda x: F.array(x))
    )


def folded(items: Column, state: Column, step: Callable, kind: str) -> Column:
    """An array of type ``kind`` that a fold over ``items`` puts out.

    ``step(state, item)`` gives the next state, a long, and an array of what is put out.
    A first fold gives the state before each run, as an accumulator is copied at every
    step; then each run is folded by itself.
    """

    def before(held: Column, some: Column) -> Column:
        after = F.aggregate(some, held["state"], lambda at, x: step(at, x)[0])
        return F.struct(after.alias("state"), F.concat(held["starts"], F.array(held["state"])).alias("starts"))

    def one(held: Column, x: Column) -> Column:
        after, out = step(held["state"], x)
        return F.struct(after.alias("state"), F.concat(held["out"], out).alias("out"))

    def run(some: Column, start: Column) -> Column:
        begin = F.struct(start.alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(some, begin, one, lambda held: held["out"])

    def each(parts: Column) -> Column:
        begin = F.struct(state.alias("state"), F.array().cast("array<bigint>").alias("starts"))
        starts = F.aggregate(parts, begin, before, lambda held: held["starts"])
        return F.flatten(F.zip_with(parts, starts, run))

    return _bound(_bound(items, runs), each)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches, leftmost and without overlap: start, end, the match and a group of it.

    Places are code points from 0, the end exclusive. ``pattern`` never matches nothing.
    """
    zipped = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("value"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"),
    )

    def add(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["before"])
        end = start + F.coalesce(F.length(x["value"]), F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"), x["part"].alias("part"))
        return end, F.when(x["value"].isNull(), F.array().cast(f"array<{SPAN}>")).otherwise(F.array(span))

    found = folded(zipped, F.lit(0).cast("long"), add, SPAN)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def replaced(text: Column, edits: Column) -> Column:
    """``text`` with each of ``edits`` (start, end, value; apart and in order) in place.

    The text is cut run by run, and a run's edits are made in its own cut.
    """

    def run(held: Column, some: Column) -> Column:
        end = F.element_at(some, -1)["end"]

        def edited(piece: Column) -> Column:
            def one(own: Column, x: Column) -> Column:
                before = F.substring(piece, (own["at"] - held["at"] + 1).cast("int"), (x["start"] - own["at"]).cast("int"))
                return F.struct(x["end"].alias("at"), F.concat(own["parts"], F.array(before, x["value"])).alias("parts"))

            begin = F.struct(held["at"].alias("at"), F.array().cast("array<string>").alias("parts"))
            return F.aggregate(some, begin, one, lambda own: F.array_join(own["parts"], ""))

        size = (end - held["at"]).cast("int")
        return F.struct(
            end.alias("at"),
            F.substring(held["rest"], size + 1, F.lit((1 << 31) - 1)).alias("rest"),
            F.concat(held["parts"], F.array(_bound(F.substring(held["rest"], F.lit(1), size), edited))).alias("parts"),
        )

    begin = F.struct(F.lit(0).cast("long").alias("at"), text.alias("rest"), F.array().cast("array<string>").alias("parts"))
    whole = F.aggregate(
        _bound(edits, runs), begin, run, lambda held: F.array_join(F.concat(held["parts"], F.array(held["rest"])), "")
    )
    return whole


def apart(spans: Column, kind: str) -> Column:
    """Sorted spans (start first) of type ``kind`` without those that start inside an earlier one."""

    def add(end: Column, x: Column) -> tuple[Column, Column]:
        inside = end > x["start"]
        return F.when(inside, end).otherwise(x["end"]), F.when(inside, F.array().cast(f"array<{kind}>")).otherwise(F.array(x))

    return folded(F.array_sort(spans), F.lit(0).cast("long"), add, kind)


def united(spans: Column) -> Column:
    """The unions of overlapping spans (start, end), in order."""
    plain = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))))
    kind = "struct<start:bigint,end:bigint>"
    # each span leaves what lies before it and after all earlier ones; borders are then paired
    def add(end: Column, x: Column) -> tuple[Column, Column]:
        border = F.struct(end.alias("start"), x["start"].alias("end"))
        new = x["start"] >= end
        return F.greatest(end, x["end"]), F.when(new, F.array(border)).otherwise(F.array().cast(f"array<{kind}>"))

    def paired(gaps: Column) -> Column:
        last = F.aggregate(plain, F.lit(0).cast("long"), lambda a, x: F.greatest(a, x["end"]))
        ends = F.concat(F.transform(F.slice(gaps, 2, F.size(gaps)), lambda g: g["start"]), F.array(last))
        return F.zip_with(gaps, ends, lambda g, e: F.struct(g["end"].alias("start"), e.alias("end")))

    none = F.array().cast(f"array<{kind}>")
    return F.when(F.size(spans) > 0, _bound(folded(plain, F.lit(-1).cast("long"), add, kind), paired)).otherwise(none)


def clear_of(spans: Column, others: Column, kind: str) -> Column:
    """The ``spans`` of type ``kind`` that overlap none of ``others``, by two sweeps over both."""

    def marked(items: Column, other: bool) -> Column:
        return F.transform(
            items, lambda x: F.struct(x["start"].alias("start"), F.lit(not other).alias("own"), x.alias("span"))
        )

    none = F.array().cast(f"array<{kind}>")

    def forwards(end: Column, x: Column) -> tuple[Column, Column]:
        # of one start, the others come first
        after = F.when(x["own"], end).otherwise(F.greatest(end, x["span"]["end"]))
        return after, F.when(x["own"] & (end <= x["start"]), F.array(x["span"])).otherwise(none)

    def backwards(start: Column, x: Column) -> tuple[Column, Column]:
        after = F.when(x["own"], start).otherwise(x["start"])
        return after, F.when(x["own"] & (start >= x["span"]["end"]), F.array(x["span"])).otherwise(none)

    def both(items: Column) -> Column:
        return F.array_sort(F.concat(marked(items, False), marked(others, True)))

    ahead = _bound(spans, lambda s: folded(both(s), F.lit(0).cast("long"), forwards, kind))
    return _bound(ahead, lambda s: folded(F.reverse(both(s)), F.lit((1 << 62)).cast("long"), backwards, kind))
