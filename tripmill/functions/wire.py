"""Column functions for what travels on the stream: base64, JSON text, ISO timestamps, numbers.

Bad input gives null instead of an error, so that one record never fails a batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}

# Date, optionally followed by hours, minutes, seconds, a fraction and an offset.
ISO_PATTERN = (
    r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?"
    r"(Z|[+-]\d{2}:?\d{2}(:?\d{2})?)?)?$"
)
# Parts that Spark's own parser leaves out: a time of hours only, offsets without colons.
HOURS_ONLY = r"^(\d{4}-\d{2}-\d{2}[T ]\d{2})(Z|[+-].*)?$"
SHORT_OFFSET = r"([+-]\d{2})(\d{2})(\d{2})?$"
LONG_OFFSET = r"T.*[+-]\d{4,6}$"


def decoded_text(data: Column) -> Column:
    """Base64 to UTF-8 text; null when either step fails."""
    return F.try_validate_utf8(F.try_to_binary(data, F.lit("base64")).cast("string"))


def is_json(text: Column) -> Column:
    """Whether the whole text is one JSON value of any kind."""
    values = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", STRICT_JSON)
    return F.coalesce(F.size(values) == 1, F.lit(False))


def number(text: Column) -> Column:
    """Text to double; null for text that is no number. Java's ``2.5d`` notation is refused."""
    lower = F.lower(F.trim(text))
    java_suffix = (lower.endswith("d") | lower.endswith("f")) & ~lower.endswith("inf")
    return F.when(~java_suffix, text.try_cast("double"))


def plain_zone(text: Column) -> Column:
    """Zone text from JSON, where an id may have come as ``161.0``."""
    return F.when(
        text.contains("."), F.regexp_replace(text, r"^(-?\d+)\.0+$", "$1")
    ).otherwise(text)


def iso_instant(text: Column) -> Column:
    """ISO-8601 text with ``Z``, an offset or none to a UTC time without zone; else null.

    The pattern is checked first since a cast alone would also take ``2024`` or ``12:00:00``.
    """
    timed = F.regexp_replace(text, HOURS_ONLY, "$1:00$2")
    spelled = F.when(F.replace(timed, F.lit(" "), F.lit("T")).rlike(LONG_OFFSET), F.regexp_replace(
        F.regexp_replace(timed, SHORT_OFFSET, "$1:$2:$3"), ":$", "")).otherwise(timed)
    return F.when(text.rlike(ISO_PATTERN), F.try_to_timestamp(spelled).cast("timestamp_ntz"))


def iso_text(ts: Column) -> Column:
    """Timestamp to ISO-8601 text; the fraction appears only if it is not zero."""
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.replace(full, F.lit(".000000"), F.lit(""))
