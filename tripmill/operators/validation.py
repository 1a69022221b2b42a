"""Validation of trip envelopes that arrive as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill import schemas
from tripmill import settings as S
from tripmill.functions import trips as tf
from tripmill.functions import wire
from tripmill.operators.parsing import DATA_KEYS, KEYS, has_key, parse_object

def envelope_error(event: Column, check_zones: bool = False) -> Column:
    """The first broken rule of a parsed envelope, null if it is valid.

    Rules in order: one JSON object; four top-level fields; data is an object with both zones; the
    timestamp is ISO-8601; four fields are numbers if given. Zones within 1..265 is a rule on
    request.
    """
    data = event["data"]
    rules = [(event.isNull(), "not a JSON object")]
    for name in S.REQUIRED_ENVELOPE_FIELDS:
        absent = event[name].isNull() & ~has_key(KEYS, name)
        rules.append((absent, S.MISSING_FIELD.format(name)))
    rules.append((data.isNull(), "data is not an object"))
    for name in S.REQUIRED_DATA_FIELDS:
        absent = data[name].isNull() & ~has_key(DATA_KEYS, name)
        rules.append((absent, S.MISSING_DATA_FIELD.format(name)))
    rules.append(_timestamp_rule(event["timestamp"]))
    for name in S.NUMERIC_DATA_FIELDS:
        wrong = data[name].isNotNull() & wire.number(data[name]).isNull()
        rules.append((wrong, f"{name} is not a number"))
    return _first_broken(rules + _zone_rules(data, check_zones))


def _timestamp_rule(timestamp: Column) -> tuple[Column, str]:
    return wire.iso_instant(timestamp).isNull(), "timestamp is not ISO-8601"


def _zone_rules(data: Column, wanted: bool) -> list[tuple[Column, str]]:
    return [(~tf.zone_in_range(data[name]), f"{name} is not a zone")
            for name in S.REQUIRED_DATA_FIELDS if wanted]


def _first_broken(rules: list[tuple[Column, str]]) -> Column:
    first = None
    for broken, message in rules:
        first = F.when(broken, message) if first is None else first.when(broken, message)
    return first


def validate_events(events: DataFrame, payload: str = "payload",
                    check_zones: bool = False) -> DataFrame:
    """Adds ``valid`` and ``error`` to events in JSON text."""
    parsed = parse_object(events, payload, schemas.ENVELOPE_FIELDS, "event",
                          S.REQUIRED_ENVELOPE_FIELDS, S.REQUIRED_DATA_FIELDS)
    return (
        parsed.withColumn("error", envelope_error(F.col("event"), check_zones))
        .drop("event", KEYS, DATA_KEYS)
        .withColumn("valid", F.col("error").isNull())
    )


def validate_envelopes(envelopes: DataFrame, check_zones: bool = False) -> DataFrame:
    """Adds ``valid`` and ``error`` to envelopes that are still columns.

    Their fields exist and have their types, so only the reason from building them, the timestamp
    and the zones are left to check; the way through JSON text and back is saved.
    """
    rules = [_timestamp_rule(F.col("timestamp")), *_zone_rules(F.col("data"), check_zones)]
    return (
        envelopes.withColumn("error", F.coalesce(F.col("reason"), _first_broken(rules)))
        .drop("reason").withColumn("valid", F.col("error").isNull())
    )
