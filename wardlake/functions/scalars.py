"""Small scalar rules shared by every layer, written as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The key namespaces of the pseudonymised tables.
KEY_NAMESPACES = ("patient", "encounter", "medication_request")

_LEADING_DATE = r"^\s*\d+-\d{1,2}-\d{1,2}"
_END_OF_DAY = r"[T ]24:00:00$"
_EXPONENT = r"^-?\d+\.\d+E-?\d+$"
# Powers of ten of values from 1e-4 up to, not including, 1e16.
_EXPONENT_IN_RANGE = r"^-?\d+\.\d+E(-4|[7-9]|1[0-5])$"


def filled_or(value: Column, fallback: Column) -> Column:
    """``value`` unless it is null or the empty string, else ``fallback``."""
    return F.coalesce(F.nullif(value, F.lit("")), fallback)


def reference_tail(reference: Column) -> Column:
    """Id part of a FHIR reference text: whatever follows the last slash."""
    return F.substring_index(F.nullif(reference, F.lit("")), "/", -1)


def stable_key(namespace: str, value: Column) -> Column:
    """Pseudonymous key: md5 over ``namespace:value``; null stays null."""
    return F.md5(F.concat(F.lit(f"{namespace}:"), value))


def wall_clock(text: Column) -> Column:
    """Local wall-clock timestamp in the first 19 characters, null if unreadable.

    Zone offsets are cut off on purpose. A bare year or year-month is not a
    timestamp, and 24:00:00 is midnight of the next day.
    """
    head = F.substring(text, 1, 19)
    next_midnight = F.substring(head, 1, 10).try_cast("date") + F.expr("interval 1 day")
    return (
        F.when(~head.rlike(_LEADING_DATE), F.lit(None))
        .when(head.rlike(_END_OF_DAY), next_midnight.cast("timestamp_ntz"))
        .otherwise(head.try_cast("timestamp_ntz"))
    )


def hour_boundaries(start: Column, end: Column) -> Column:
    """Number of full-hour marks passed between two wall-clock timestamps."""
    days = F.datediff(end, start).cast("bigint")
    return days * 24 + F.hour(end) - F.hour(start)


def number_or_null(text: Column) -> Column:
    """Double in a text value, null when the text is not a plain number."""
    bare = F.when(
        F.contains(text, F.lit("_")), F.regexp_replace(text, r"(?<=\d)_(?=\d)", "")
    ).otherwise(text)
    java_suffix = bare.rlike(r"[0-9.]\s*[dDfF]\s*$")
    return F.when(~java_suffix, bare.try_cast("double"))


def number_text(text: Column) -> Column:
    """Render a JSON number the way its decimal source would be printed.

    The JSON reader prints large and small doubles with an exponent
    (``1.23E7``, ``5.0E-4``). Between 1e-4 and 1e16 the plain form is wanted,
    outside it the short exponent form (``1e-05``, ``1e+16``).
    """
    # 16 digits before and 22 behind the point hold every double of the range.
    plain = F.regexp_replace(
        text.try_cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1"
    )
    short = F.regexp_replace(text, r"(\.0)?E-", "e-")
    short = F.regexp_replace(short, r"(\.0)?E", "e+")
    short = F.regexp_replace(short, r"(e[+-])(\d)$", "$10$2")
    infinite = F.regexp_replace(text, r'^"(-?)I(nf)inity"$', "$1i$2")
    # Nearly all numbers are plain: one cheap test decides before anything else.
    # Kept small on purpose: the JVM does not compile very large methods.
    return (
        F.when(~text.rlike('[E"]'), text)
        .when(text.rlike(_EXPONENT_IN_RANGE), plain)
        .when(text.rlike(_EXPONENT), short)
        .otherwise(infinite)
    )


def ascii_escaped(text: Column) -> Column:
    r"""Replace every non-ASCII character by its ``\uXXXX`` escape."""

    def unit(code: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lpad(F.lower(F.hex(code)), 4, "0"))

    def escape(char: Column) -> Column:
        code = F.ascii(char)
        beyond = code - 0x10000
        pair = F.concat(
            unit(F.lit(0xD800) + F.shiftright(beyond, 10)),
            unit(F.lit(0xDC00) + beyond.bitwiseAND(F.lit(0x3FF))),
        )
        return (
            F.when(code < 128, char).when(code < 0x10000, unit(code)).otherwise(pair)
        )

    escaped = F.array_join(F.transform(F.split(text, ""), escape), "")
    return F.when(text.rlike(r"[^\x00-\x7F]"), escaped).otherwise(text)
