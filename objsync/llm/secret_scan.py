"""Secrets of texts, and credentials whose parts are only telling together.

Strong patterns are reported wherever they are. Weak candidates - identifiers, short or
loosely named secrets, endpoints - are reported only when a complementary part lies
within the same scope: candidates and all parts are rows of (document, cell, place), and
an equi-join on document and cell with a condition on the distance pairs them. Only
documents with weak candidates take part in it, and no text is shuffled.

Defined results: a null text is empty and has no spans; rows that repeat an id are
scanned each; an empty table gives an empty result; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import text_or_empty, written
from .spans import SPAN, clear_of, matches, replaced, united

#: Code points between complementary parts, at most.
SCOPE = 200

# fixed values: the patterns of the base kinds, in their order
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

# weak candidates
IDENTIFIER = (
    r"""(?i:client_?id|account_?id|access_?key_?id|username|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@+-]{3,})"""
)
LOOSE = r"""\b(?i:pwd|pass|auth_?key|private_?key|credential)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{6,})"""
ENDPOINT = (
    r"""\b(?:(?i:postgres(?:ql)?|mysql|mongodb|redis|amqp|https?)://[^\s"'<>]+"""
    r"""|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}(?::\d+)?)"""
)

#: Kinds in the order of ties, with the role each plays.
KINDS = {
    "assign": "secret",
    "access": "identifier",
    "hex": "secret",
    "weak_secret": "secret",
    "weak_identifier": "identifier",
    "weak_endpoint": "endpoint",
}
_SPAN = "struct<start:bigint,kind_no:int,kind:string,end:bigint>"


def _kind(spans: Column, kind: str) -> Column:
    number = list(KINDS).index(kind)
    return F.transform(
        spans,
        lambda x: F.struct(
            x["start"].alias("start"), F.lit(number).alias("kind_no"), F.lit(kind).alias("kind"), x["end"].alias("end")
        ),
    )


def _gated(gate: Column, found: Column) -> Column:
    """``found`` where the cheap ``gate`` holds, which every match needs."""
    return F.when(gate, found).otherwise(F.array().cast("array<" + SPAN + ">"))


def _marked(text: Column) -> Column:
    """Whether there is one of the signs that all patterns but two need."""
    return text.contains("=") | text.contains(":")


def _assigned(text: Column) -> Column:
    return _gated(_marked(text), matches(text, ASSIGN, 2))


def base_spans(text: Column) -> Column:
    """Spans of the base kinds in order of start and kind."""
    assign = F.filter(_assigned(text), lambda x: F.length(x["part"]) >= 8)
    return F.array_sort(
        F.concat(
            _kind(assign, "assign"), _kind(_gated(text.contains("AKIA"), matches(text, ACCESS)), "access"), _kind(matches(text, HEX), "hex")
        )
    )


def weak_spans(text: Column) -> Column:
    short = F.filter(_assigned(text), lambda x: F.length(x["part"]).between(4, 7))
    return F.concat(
        _kind(short, "weak_secret"),
        _kind(_gated(_marked(text), matches(text, LOOSE)), "weak_secret"),
        _kind(_gated(_marked(text), matches(text, IDENTIFIER)), "weak_identifier"),
        _kind(_gated(_marked(text), matches(text, ENDPOINT)), "weak_endpoint"),
    )


def _role(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair]), kind)


def _linked(scanned: DataFrame) -> DataFrame:
    """``(key, print, linked)``: weak spans with a complementary part in their scope.

    The text alone, and so ``print``, tells the spans; ``key``, a hash of the id that is
    never null, spreads copies of a text.
    """
    key = ["key", "print"]
    some = scanned.where(F.size("weak") > 0).dropDuplicates(key)
    weak = some.select(*key, F.explode("weak").alias("s"))
    parts = some.select(*key, F.explode(F.concat("weak", "base")).alias("p"))
    weak = weak.withColumn("role", _role(F.col("s.kind")))
    # a part is in each cell that a scope around it touches
    cells = F.sequence(
        F.floor((F.col("p.start") - SCOPE) / SCOPE), F.floor((F.col("p.end") + SCOPE) / SCOPE)
    )
    parts = parts.withColumn("other", _role(F.col("p.kind"))).withColumn("cell", F.explode(cells))
    # a part before a weak span is near its start, one after it near its end
    ends = F.array_distinct(F.array(F.floor(F.col("s.start") / SCOPE), F.floor(F.col("s.end") / SCOPE)))
    weak = weak.withColumn("cell", F.explode(ends))
    gap = F.greatest(F.col("p.start") - F.col("s.end"), F.col("s.start") - F.col("p.end"))
    complementary = (F.col("role") != F.col("other")) & ((F.col("role") == "secret") | (F.col("other") == "secret"))
    pairs = weak.join(parts, [*key, "cell"]).where(complementary & gap.between(0, SCOPE))
    return pairs.groupBy(*key).agg(F.collect_set("s").alias("linked"))


def _scan(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = text_or_empty(text_column)
    base, weak = base_spans(text), weak_spans(text)
    found = documents.select(
        F.col(id_column).alias("doc_id"), F.xxhash64(id_column).alias("key"), F.xxhash64(text).alias("print"), base.alias("base"), weak.alias("weak")
    )
    # what a base span has is reported already
    some = (F.size("weak") > 0) & (F.size("base") > 0)
    return found.withColumn("weak", F.when(some, clear_of(F.col("weak"), F.col("base"), _SPAN)).otherwise(F.col("weak")))


def find_secrets(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``(doc_id, print, base, spans)``: spans of base kinds, and with linked ones."""
    scanned = written(_scan(documents, id_column, text_column), "scanned")
    linked = _linked(scanned)
    joined = scanned.alias("l").join(
        linked.alias("r"), (F.col("l.key") == F.col("r.key")) & (F.col("l.print") == F.col("r.print")), "left"
    )
    every = F.array_sort(F.concat("l.base", F.coalesce("r.linked", F.array().cast(f"array<{_SPAN}>"))))
    return joined.select("l.doc_id", "l.print", "l.base", every.alias("spans"))


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def secrets_digest(found: DataFrame) -> DataFrame:
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"),
    )


def _masked(text: Column, spans: Column) -> Column:
    edits = F.transform(
        united(spans), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit("[secret]").alias("value"))
    )
    return F.when(F.size(spans) > 0, replaced(text, edits)).otherwise(text)


def mask_secrets(
    documents: DataFrame, *, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``documents`` with every span of :func:`find_secrets` in the text masked.

    Texts are masked in place where no weak part can be; the others are scanned once and
    joined with their spans.
    """
    columns = documents.columns
    text = text_or_empty(text_column)
    maybe = _marked(text) & (text.rlike(ASSIGN) | text.rlike(LOOSE) | text.rlike(IDENTIFIER) | text.rlike(ENDPOINT))
    scanned = written(_scan(documents.where(maybe), id_column, text_column).dropDuplicates(["key", "print"]), "scanned")
    linked = scanned.select("key", "print", "base").join(_linked(scanned), ["key", "print"], "left")
    every = F.concat("base", F.coalesce("linked", F.array().cast(f"array<{_SPAN}>")))
    linked = linked.select(F.col("key").alias("__key"), F.col("print").alias("__print"), every.alias("__spans"))
    plain = documents.where(~maybe).withColumn(text_column, _masked(F.col(text_column), base_spans(text)))
    rest = documents.where(maybe).join(
        linked.where(F.size("__spans") > 0),
        (F.xxhash64(id_column) == F.col("__key")) & (F.xxhash64(text) == F.col("__print")),
        "left",
    )
    rest = rest.withColumn("__spans", F.coalesce("__spans", F.array().cast(f"array<{_SPAN}>")))
    rest = rest.withColumn(text_column, _masked(F.col(text_column), F.col("__spans")))
    return plain.select(*columns).unionByName(rest.select(*columns))
