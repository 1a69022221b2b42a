"""Parsing of JSON objects that tell a missing key from a null value."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions.wire import STRICT_JSON

KEYS = "object_keys"
DATA_KEYS = "data_keys"


def parse_object(df: DataFrame, text: str, fields: str, into: str, watched: Iterable[str] = (),
                 watched_data: Iterable[str] = ()) -> DataFrame:
    """Adds the object in column ``text`` as struct ``into``; null if it is not one JSON object.

    The text is parsed as a one-element array, because the JSON reader stops silently after the
    first value: ``{"a":1} tail`` must not pass. The element is taken with ``explode_outer``: a
    filter on a parsed field is not pushed below a generator, so each text is parsed once, whereas
    a plain projection would be repeated inside every filter above it.

    ``object_keys`` and ``data_keys`` list the keys of the object and of its ``data`` object. They
    are read only where a watched field is null, and null otherwise.
    """
    rows, one = F.col("_rows"), F.get("_rows", F.lit(0))
    single = F.size(rows) == 1

    def any_null(parts: list[Column]) -> Column:
        found = F.lit(False)
        for part in parts:
            found = found | part.isNull()
        return found

    top = any_null([one[name] for name in watched])
    inner = any_null([one["data"][name] for name in watched_data])  # of a data object, if any
    return (
        df.withColumn("_rows", F.from_json(F.concat(F.lit("["), F.col(text), F.lit("]")),
                                           f"ARRAY<STRUCT<{fields}>>", STRICT_JSON))
        .withColumns({
            KEYS: F.when(single & top, F.json_object_keys(text)),
            DATA_KEYS: F.when(single & one["data"].isNotNull() & inner,
                              F.json_object_keys(F.get_json_object(text, "$.data"))),
        })
        .select("*", F.explode_outer(F.when(single, rows)).alias(into))
        .drop("_rows")
    )


def has_key(keys: str, name: str) -> Column:
    """Whether a key is there, its value being null; false where the keys were not needed."""
    return F.coalesce(F.array_contains(keys, name), F.lit(False))
