"""Keyed surrogates for personal data, alike in type, script, gender and format.

Entities found in texts are reduced to distinct normal forms by kind, so that one person
or number has one surrogate wherever and however it is written. A surrogate is drawn
from a keyed hash of kind, normal form and attempt, character by character, so that
digits stay digits and letters stay letters of their script; card numbers keep their
checksum, addresses their top-level domain, and names after a title are drawn by the
title's gender. A surrogate that two entities share, or that is itself an original, is
drawn again for all but one of them until none is left; every few attempts the form grows
by a character (a letter of the local part, a digit at the end, a syllable, a port), so
that a form whose surrogates are all taken, or that has nothing to draw, comes to an end. Only entities are shuffled, and
the texts that have some; an entity in very many texts is joined by a join that can be
split. All mentions of the words of a name that has a title in its document are replaced
with it; a word that both genders have there is drawn for the male one where it stands
without a title.

Defined results: a null text stays null; repeated rows get the same surrogates; texts
without entities stay as they are; an empty table gives an empty result; further columns
are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import text_or_empty, written
from .spans import apart, matches, replaced

# fixed values: patterns of the kinds
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_IP = r"(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
IP = r"(?<![\d.])" + _IP
_FOURS = r"\d{4}(?:[ -]?\d{4}){3}(?![\dA-Za-z])"
#: Four groups of four digits, whatever their checksum.
CARD = r"(?<![\dA-Za-z])" + _FOURS
#: 12 to 19 digits in any grouping, the usual ones first; only with the checksum.
CARD_LUHN = (
    r"(?<![\dA-Za-z])(?=\d(?:[ -]?\d){11})(?:\d{12,19}|\d{4}[ -]\d{6}[ -]\d{4,5}|\d{4}(?:[ -]\d{4}){3}[ -]\d{3}"
    r"|\d{4}(?:[ -]\d{3}){3}|\d(?:[ -]?\d){11,18})(?![\dA-Za-z])"
)
_DATE = r"(?:\d{1,2}[./-]\d{1,2}[./-]\d{2}(?:\d{2})?|\d{4}[./-]\d{1,2}[./-]\d{1,2})(?![./-]?\d)"
#: With a country code after a plus, 7 to 15 digits in any grouping; without one, by the
#: usual forms: 3-3-4, an area code in brackets or after a zero, three groups or more of 8
#: to 15 digits, 3-4, an area code and 6 to 8 digits, and 10 to 12 digits in one.
PHONE = (
    r"(?=[+(\d])(?:\+\d{1,3} ?\(\d{3}\) ?\d{3}-\d{4}(?!\d)"
    r"|\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    rf"|\+\d(?:[ ./()-]{{1,2}}(?!{_IP}|{_FOURS})\d|\d){{6,14}}(?!\d)"
    rf"|(?<![\p{{L}}\d_])(?<!\d[./-])(?!{_DATE}|{_IP}|{_FOURS})(?:"
    r"(?:1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
    rf"|\(\d{{2,5}}\)(?:[ ./-](?!{_IP}|{_FOURS})\d|\d){{5,11}}"
    rf"|0\d(?:[ ./-](?!{_IP}|{_FOURS})\d|\d){{5,12}}"
    r"|(?=\d(?:[ ./-]?\d){7,14}(?![ ./-]?\d))\d{2,5}(?:[ ./-]\d{2,5}){2,5}"
    r"|\d{3}[.-]\d{4}|\d{3,5}[ /-]\d{6,8}|\d{10,12}"
    r")(?![\p{L}\d_]|[./-]\d))"
)
HE = r"(?:Mr\.?|Herr|Señor|Monsieur|г-н)"
SHE = r"(?:Mrs\.?|Ms\.?|Frau|Señora|Madame|г-жа)"
_AFTER = r"(?:['’](?:\p{Lu}[\p{L}\p{M}]*|[\p{L}\p{M}]{3,}))*"
#: A capitalized word of a name; an apostrophe joins, but not before a short ending.
WORD = r"(?<![\p{L}\p{M}])\p{Lu}[\p{L}\p{M}]*" + _AFTER
_PART = (
    r"(?!(?:Mrs?|Ms|Herr|Frau|Señora?|Monsieur|Madame|Dr|Prof|г-н|г-жа)(?!\p{L}))"
    rf"\p{{Lu}}[\p{{L}}\p{{M}}]*{_AFTER}(?:-(?:\p{{Ll}}{{2,3}}-)?\p{{Lu}}[\p{{L}}\p{{M}}]*{_AFTER})*"
)
_SMALL = r"(?:(?:von|vom|van|der|den|zu|zur|de|del|della|di|da|dos|du|des|la|le|las|los|el|bin|ibn|al|y|фон|де) )*(?:d['’])?"
_PARTS = rf"{_SMALL}{_PART}(?:(?<=(?<!\p{{L}})\p{{Lu}})\.)?"


def _name(title: str) -> str:
    """One to five words after a title, hyphens, small words and initials among them."""
    return rf"(?<!\p{{L}}){title}\s(?:(?:Dr|Prof|Ing)\.? )*({_PARTS}(?: {_PARTS}){{0,4}})(?!\p{{L}})"


KINDS = {
    "email": (EMAIL, 0),
    "phone": (PHONE, 0),
    "card": (CARD, 0),
    "ip": (IP, 0),
    "name_he": (_name(HE), 1),
    "name_she": (_name(SHE), 1),
}
#: Of spans with one start the first of these holds, and mentions of names come last.
PRECEDENCE = ["email", "card_luhn", "card", "ip", "phone", "name_he", "name_she", "mention"]
# fixed value: country codes, one digit to three
_COUNTRY = r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
# fixed values: syllables of names by script, and endings by script and gender
_LATIN = ["ba", "da", "fe", "ga", "ka", "le", "mi", "no", "pa", "ri", "so", "ta", "ve", "lo", "ne", "ru"]
_CYRILLIC = ["ба", "да", "ве", "га", "ка", "ле", "ми", "но", "па", "ри", "со", "та", "зе", "ло", "не", "ру"]
_ENDINGS = {"name_he": ("n", "н"), "name_she": ("a", "я")}


_ENTITY = "struct<start:bigint,number:int,end:bigint,kind:string,value:string,head:boolean>"
_EDIT = "struct<start:bigint,number:int,end:bigint,value:string,kind:string,head:boolean>"
#: Attempts at one width of a form.
TRIES = 3


def _entities(text: Column) -> Column:
    """Spans with kind and the part that is replaced, apart from each other.

    A name has a span for each of its words; ``head`` is true for the first.
    """

    def span(start: Column, end: Column, value: Column, label: str, kind: str, head: Column) -> Column:
        return F.struct(
            start.cast("long").alias("start"),
            F.lit(PRECEDENCE.index(label)).alias("number"),
            end.cast("long").alias("end"),
            F.lit(kind).alias("kind"),
            value.alias("value"),
            head.alias("head"),
        )

    def plain(found: Column, label: str, kind: str) -> Column:
        return F.transform(found, lambda x: span(x["start"], x["end"], x["value"], label, kind, F.lit(True)))

    def words(kind: str) -> Column:
        pattern, group = KINDS[kind]

        def of(x: Column) -> Column:
            at = x["end"] - F.length(x["part"])
            return F.transform(
                matches(x["part"], WORD), lambda w, i: span(at + w["start"], at + w["end"], w["value"], kind, kind, i == 0)
            )

        return F.flatten(F.transform(matches(text, pattern, group), of))

    summed = F.filter(matches(text, CARD_LUHN), lambda x: _luhn(_digits(x["value"])) == 0)
    found = [plain(matches(text, KINDS[kind][0]), kind, kind) for kind in ("email", "phone", "card", "ip")]
    return apart(F.concat(*found, plain(summed, "card_luhn", "card"), words("name_he"), words("name_she")), _ENTITY)


def _some(text: Column) -> Column:
    """Whether there may be an entity: exact but for checksums, cheap tests first."""
    numbers = text.rlike(r"\d(?:[ ()./-]{0,2}\d){3}") & text.rlike(f"{PHONE}|{CARD}|{CARD_LUHN}|{IP}")
    names = text.rlike("|".join(f"(?:{KINDS[k][0]})" for k in ("name_he", "name_she")))
    return (text.contains("@") & text.rlike(EMAIL)) | numbers | names


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def _normal(kind: Column, value: Column) -> Column:
    """One form for all ways of writing; a phone number of 3-3-4 digits is of country 1."""
    digits = _digits(value)
    phone = (
        F.when(value.startswith("+"), F.concat(F.lit("+"), digits))
        .when(digits.rlike("^00[1-9]"), F.concat(F.lit("+"), F.substring(digits, F.lit(3), F.length(digits))))
        .when(digits.rlike("^1[2-9][0-9]{9}$"), F.concat(F.lit("+"), digits))
        .when(digits.rlike("^[2-9][0-9]{9}$"), F.concat(F.lit("+1"), digits))
        .otherwise(digits)
    )
    name = F.regexp_replace(F.lower(value), "’", "'")
    return F.when(kind == "phone", phone).when(kind == "card", digits).otherwise(name)


def _byte(stream: Column, i: Column) -> Column:
    """The ``i``-th number of a keyed stream of hexadecimal digits."""
    return F.conv(F.substring(stream, (i % 62 * 2 + 1).cast("int"), F.lit(4)), 16, 10).cast("long")


def _drawn(key: str, kind: Column, normal: Column, attempt: Column) -> Column:
    stream = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, normal, attempt.cast("string")), 512)
    chars = F.split(normal, "")

    def alike(c: Column, i: Column) -> Column:
        n = _byte(stream, i)
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (n % 26 + 1).cast("int"), F.lit(1)))
            .otherwise(c)
        )

    def more(letters: str, size: Column) -> Column:
        # from the far end of the stream, whose start spells the form
        some = F.transform(
            F.sequence(F.lit(1), F.greatest(size, F.lit(1))),
            lambda i: F.substring(F.lit(letters), (_byte(stream, 61 - i) % len(letters) + 1).cast("int"), F.lit(1)),
        )
        return F.when(size > 0, F.array_join(some, "")).otherwise(F.lit(""))

    wider = F.floor(attempt / TRIES).cast("int")
    spelled = F.array_join(F.transform(chars, alike), "")
    top = F.substring_index(normal, ".", -1)
    head = F.substring(spelled, F.lit(1), F.length(normal) - F.length(top))
    local = F.substring_index(head, "@", 1)
    drawn_local = more("abcdefghijklmnopqrstuvwxyz", wider + F.when(head.rlike("[a-z0-9]"), 0).otherwise(4))
    email = F.concat(local, drawn_local, F.substring(head, F.length(local) + 1, F.length(head)), top)
    digits = more("0123456789", wider)
    # the country code or leading zeros of a phone number and the issuer digit of a card stay
    code = F.regexp_extract(normal, rf"^(?:{_COUNTRY}|0{{0,2}})", 0)
    phone = F.concat(code, F.substring(spelled, F.length(code) + 1, F.length(normal)), digits)
    card = F.concat(F.substring(normal, 1, 1), F.substring(spelled, F.lit(2), F.length(normal) - 2), digits)
    card = F.concat(card, ((_luhn(F.concat(card, F.lit("0"))) * 9 + _luhn(normal)) % 10).cast("string"))
    ip = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_byte(stream, i * 3) % 254 + 1).cast("string")), ".")
    ip = F.when(wider > 0, F.concat_ws(":", ip, F.concat(F.lit("1"), digits))).otherwise(ip)

    def name(gender: str) -> Column:
        size = F.greatest(F.lit(2), F.floor(F.length(normal) / 2)) + attempt
        def spell(syllables: list[str], end: str) -> Column:
            listed = F.array(*[F.lit(s) for s in syllables])
            parts = F.transform(F.sequence(F.lit(1), size.cast("int")), lambda i: F.get(listed, (_byte(stream, i) % 16).cast("int")))
            return F.concat(F.array_join(parts, ""), F.lit(end))

        latin, cyrillic = _ENDINGS[gender]
        return F.when(normal.rlike(r"\p{IsCyrillic}"), spell(_CYRILLIC, cyrillic)).otherwise(spell(_LATIN, latin))

    return (
        F.when(kind == "email", email)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "ip", ip)
        .when(kind == "name_he", name("name_he"))
        .otherwise(name("name_she"))
    )


def _luhn(digits: Column) -> Column:
    """The checksum of a number, modulo 10."""
    places = F.transform(
        F.reverse(F.split(digits, "")),
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)),
    )
    return F.aggregate(places, F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _written_like(value: Column, kind: Column, surrogate: Column, normal: Column) -> Column:
    """The surrogate in the format of ``value``: separators and capitals; what is longer follows."""
    chars = F.split(value, "")
    more = F.greatest(F.length(surrogate) - F.length(normal), F.lit(0))
    # a phone number may be written without its country code, or with zeros before it
    own, every = _digits(value), _digits(surrogate)
    drawn = F.substring(every, F.lit(1), F.length(every) - more)
    rest = F.substring(every, F.length(every) - more + 1, more)
    less = F.length(own) - F.length(drawn)
    shown = F.when(less > 0, F.concat(F.substring(own, F.lit(1), less), drawn)).otherwise(
        F.substring(drawn, 1 - less, F.length(own))
    )
    digits = F.aggregate(
        chars,
        F.struct(F.lit(0).alias("used"), F.lit("").alias("text")),
        lambda held, c: F.when(
            c.rlike("[0-9]"),
            F.struct(
                (held["used"] + 1).alias("used"),
                F.concat(held["text"], F.substring(shown, held["used"] + 1, F.lit(1))).alias("text"),
            ),
        ).otherwise(F.struct(held["used"].alias("used"), F.concat(held["text"], c).alias("text"))),
        lambda held: held["text"],
    )
    capitals = F.array_join(
        F.zip_with(chars, F.split(surrogate, ""), lambda c, s: F.when(c.rlike("[A-Z]"), F.upper(s)).otherwise(s)), ""
    )
    return (
        F.when(kind.isin("phone", "card"), F.concat(digits, rest))
        .when(kind == "email", capitals)
        .when(kind == "ip", surrogate)
        .when((F.length(value) > 1) & (value == F.upper(value)), F.upper(surrogate))
        .otherwise(F.initcap(surrogate))
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``(kind, normal, surrogate)`` for distinct ``(kind, normal)`` rows, all different."""
    now = written(entities.withColumn("attempt", F.lit(0)), "entities")
    while True:
        drawn = now.withColumn("surrogate", _drawn(key, F.col("kind"), F.col("normal"), F.col("attempt")))
        drawn = written(drawn, "surrogates")
        owner = drawn.groupBy("kind", "surrogate").agg(F.min("normal").alias("owner"))
        taken = drawn.select("kind", F.col("normal").alias("surrogate"), F.lit(True).alias("original"))
        judged = drawn.join(owner, ["kind", "surrogate"]).join(taken, ["kind", "surrogate"], "left")
        again = F.col("original").isNotNull() | (F.col("owner") != F.col("normal"))
        judged = written(judged.select("kind", "normal", "attempt", "surrogate", again.alias("again")), "judged")
        if judged.where("again").isEmpty():
            return judged.select("kind", "normal", "surrogate")
        now = judged.select("kind", "normal", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))


def _mentions(found: DataFrame, each: DataFrame) -> DataFrame:
    """Rows like ``each`` for all words that are words of a name found in their document."""
    zipped = F.arrays_zip(
        F.split("text", WORD, -1).alias("before"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("value")
    )
    words = found.where("text is not null").select("__print", F.posexplode(zipped).alias("i", "w"))
    words = words.select("__print", "i", F.length("w.before").alias("before"), F.col("w.value").alias("value"))
    words = words.where("value is not null").withColumn("size", F.length("value"))
    upto = F.sum(F.col("before") + F.col("size")).over(Window.partitionBy("__print").orderBy("i"))
    words = words.select("__print", (upto - F.col("size")).alias("start"), upto.alias("end"), "value")
    words = words.withColumn("normal", _normal(F.lit("name"), F.col("value")))
    names = each.where(_NAMED).where(F.length("value") > 1).groupBy("__print", "normal").agg(F.min("kind").alias("kind"))
    held = words.join(names, ["__print", "normal"])
    before = F.lag("end").over(Window.partitionBy("__print").orderBy("start"))
    head = F.coalesce(F.col("start") - before > 1, F.lit(True)).alias("head")
    number = F.lit(PRECEDENCE.index("mention")).alias("number")
    return held.select("__print", "start", number, "end", "kind", "value", head, "normal")


_NAMED = "kind in ('name_he', 'name_she')"


def replace_entities(documents: DataFrame, key: str, *, text_column: str = "text") -> DataFrame:
    """``documents`` with surrogates in their texts, and ``n_<kind>`` counts of entities."""
    text = text_or_empty(text_column)
    some = _some(text)
    print_ = F.xxhash64(text)
    found = documents.where(some).select(print_.alias("__print"), _entities(text).alias("found"), text.alias("text"))
    named = F.exists("found", lambda e: e["kind"].isin("name_he", "name_she"))
    found = written(
        found.select("__print", "found", F.when(named, F.col("text")).alias("text")).dropDuplicates(["__print"]), "found"
    )
    each = found.select("__print", F.explode("found").alias("e")).select(
        "__print", "e.*", _normal(F.col("e.kind"), F.col("e.value")).alias("normal")
    )
    # an initial is drawn as a letter, which others may share
    initial = F.expr(_NAMED) & (F.length("normal") == 1)
    mapping = surrogates(each.where(~initial).select("kind", "normal").distinct(), key)
    letters = F.when(F.col("normal").rlike(r"\p{IsCyrillic}"), F.lit("абвгдежзиклмнопрстуфхэюя")).otherwise(
        F.lit("abcdefghijklmnopqrstuvwxyz")
    )
    place = F.pmod(_byte(F.sha2(F.concat_ws("\x1f", F.lit(key), "kind", "normal"), 512), F.lit(0)), F.length(letters)) + 1
    letter = F.substring(letters, place.cast("int"), F.lit(1))
    edits = (
        each.unionByName(_mentions(found, each))
        .join(mapping, ["kind", "normal"], "left")
        .withColumn("surrogate", F.coalesce("surrogate", F.when(initial, letter)))
        .select(
            "__print",
            F.struct(
                "start", "number", "end",
                _written_like(F.col("value"), F.col("kind"), F.col("surrogate"), F.col("normal")).alias("value"), "kind", "head",
            ).alias("edit"),
        )
        .groupBy("__print")
        .agg(F.collect_list("edit").alias("__edits"))
        .withColumn("__edits", apart(F.col("__edits"), _EDIT))
    )

    def counts(edits_: Column | None) -> list[Column]:
        if edits_ is None:
            return [F.lit(0).cast("long").alias(f"n_{k}") for k in KINDS]
        heads = F.transform(F.filter(edits_, lambda x: x["head"]), lambda x: x["kind"])
        return [
            (F.size(heads) - F.size(F.array_remove(heads, k))).cast("long").alias(f"n_{k}") for k in KINDS
        ]

    others = [c for c in documents.columns if c not in {f"n_{k}" for k in KINDS}]
    plain = documents.where(~some).select(*others, *counts(None))
    rest = documents.where(some).withColumn("__print", print_).join(written(edits, "edits"), "__print", "left")
    rest = rest.withColumn("__edits", F.coalesce("__edits", F.expr("slice(__edits, 1, 0)")))
    new = F.when(F.size("__edits") > 0, replaced(F.col(text_column), F.col("__edits"))).otherwise(F.col(text_column))
    rest = rest.select(*[new.alias(c) if c == text_column else F.col(c) for c in others], *counts(F.col("__edits")))
    return plain.unionByName(rest)
