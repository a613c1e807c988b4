"""Text to number, integer, instant and JSON fields, without raising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the decimal literal both number parsers accept.
DECIMAL_LITERAL = r"[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?"

_EDGE_SPACE = r"[ \t\n\x0B\f\r]*"


def _finite(text: Column) -> Column:
    """Cast a checked literal; out-of-range magnitudes become NULL."""
    value = text.try_cast("double")
    overflow = F.abs(value) == F.lit(float("inf"))
    underflow = (value == 0.0) & text.rlike(r"^[^eE]*[1-9]")
    return F.when(~overflow & ~underflow, value)


def strict_double(text: Column) -> Column:
    """Decimal literals only (spaces around them allowed); else NULL."""
    trimmed = F.btrim(text)
    return F.when(trimmed.rlike(rf"^{DECIMAL_LITERAL}\z"), _finite(trimmed))


def lenient_double(text: Column) -> Column:
    """Decimal literals plus the spellings of NaN and the infinities; else NULL."""
    trimmed = F.regexp_replace(text, rf"^{_EDGE_SPACE}|{_EDGE_SPACE}\z", "")
    word = F.lower(trimmed)
    return (
        F.when(trimmed.rlike(rf"^{DECIMAL_LITERAL}\z"), _finite(trimmed))
        .when(word.isin("nan", "+nan", "-nan"), F.lit(float("nan")))
        .when(word.isin("infinity", "inf", "+infinity", "+inf"), F.lit(float("inf")))
        .when(word.isin("-infinity", "-inf"), F.lit(float("-inf")))
    )


def whole_number(text: Column) -> Column:
    return F.when(
        text.rlike(rf"^{_EDGE_SPACE}[+-]?\d+{_EDGE_SPACE}\z"),
        F.regexp_replace(text, rf"{_EDGE_SPACE}", "").try_cast("bigint"),
    )


# Fixed value: the months by their first three letters.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

# Other spellings of a date at the start of a text, and the ISO order of their parts.
_SLASHED = (r"^(\d{4})/(\d{1,2})/(\d{1,2})(?!\d)", "$1-$2-$3")
_COMPACT = (r"^(\d{4})(\d{2})(\d{2})(?![\d])", "$1-$2-$3")
_MONTH_FIRST = (r"^(\d{1,2})[/-](\d{1,2})[/-](\d{4})(?!\d)", "$3-$1-$2")
_NAMED = (
    (r"^(\d{1,2})[ -]([A-Za-z]{3,9})[ -](\d{4})(?!\d)", 2, "$3-#-$1"),
    (r"^([A-Za-z]{3,9})[ -](\d{1,2}),?[ -](\d{4})(?!\d)", 1, "$3-#-$2"),
    (r"^(\d{4})[ -]([A-Za-z]{3,9})[ -](\d{1,2})(?!\d)", 2, "$1-#-$3"),
)
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?( ?([Zz]|UTC|[+-]\d{2}:\d{2}))?)?\z"

# Times without colons, and zones of hours or hours and minutes without one.
_COMPACT_TIME = (r"^(\S+?)[T ](\d{2})(\d{2})(\d{2})(?!\d)", "$1 $2:$3:$4")
_HOUR_ZONE = (r"(:\d{2}(?:\.\d+)?) ?([+-]\d{2})\z", "$1$2:00")
_MINUTE_ZONE = (r"(:\d{2}(?:\.\d+)?) ?([+-]\d{2})(\d{2})\z", "$1$2:$3")


def moment(text: Column) -> Column:
    """Date or date-time text, UTC unless it carries an offset; else NULL.

    ISO 8601 with or without separators, year or month first with slashes, and dates with the
    English name of the month.
    """
    out = F.btrim(text)
    numbers = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for x in (m, str(i + 1))])
    named = F.lit(None).cast("string")
    for pattern, group, order in reversed(_NAMED):
        month = F.try_element_at(numbers, F.lower(F.substring(F.regexp_extract(out, pattern, group), 1, 3)))
        placed = F.replace(F.regexp_replace(out, pattern, order), F.lit("#"), month)
        named = F.when(out.rlike(pattern), placed).otherwise(named)
    for pattern, order in (_SLASHED, _COMPACT, _MONTH_FIRST):
        out = F.regexp_replace(out, pattern, order)
    out = F.coalesce(named, out)
    for pattern, order in (_COMPACT_TIME, _HOUR_ZONE, _MINUTE_ZONE):
        out = F.regexp_replace(out, pattern, order)
    # Most texts are ISO as they are and need none of this.
    plain = F.btrim(text)
    return F.when(plain.rlike(_ISO), plain.try_cast("timestamp")).when(out.rlike(_ISO), out.try_cast("timestamp"))


def json_marked(text: Column) -> Column:
    """The text parsed with a mark of its own behind it: a variant of ``[value, mark]``, NULL if broken.

    To be checked by :func:`json_value` in a later projection, so that a text is parsed once.
    """
    mark = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))


def json_value(marked: Column, text: Column) -> Column:
    """A variant whose first element is the value of ``text``, or NULL unless that is exactly one JSON value.

    The JSON reader stops after the first complete value. A text that closes the array early,
    or brings elements of its own, cannot leave its hash in the second and last place.
    """
    whole = F.try_variant_get(marked, "$[1]", "bigint") == F.xxhash64(text)
    # A lookup that finds nothing is dear; without a comma of its own a text brings no third element.
    last = ~text.contains(",") | F.try_variant_get(marked, "$[2]", "variant").isNull()
    return F.when(whole & last, marked)


def object_text(text: Column) -> Column:
    """The text if it can be a JSON object, else NULL."""
    return F.when(text.rlike(r"^[ \t\n\r]*\{"), text)


def object_field(parsed: Column, name: str, text: Column | None = None) -> Column:
    """Text of a field of :func:`json_value`; JSON null and absence give NULL.

    With the ``text`` it was parsed from, a field is looked up only where its key can be: spelled
    out, or with escapes.
    """
    found = F.try_variant_get(parsed, f"$[0].{name}", "string")
    return found if text is None else F.when(text.contains(name) | text.contains("\\"), found)


def overflowed_number(parsed: Column, name: str, text: Column | None = None) -> Column:
    """A JSON number too large for a double reads back as infinity."""
    field = F.try_variant_get(parsed, f"$[0].{name}", "variant")
    return object_field(parsed, name, text).isin("Infinity", "-Infinity") & (
        F.schema_of_variant(field) != "STRING"
    )
