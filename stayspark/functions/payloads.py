"""Hotel-event JSON: reading with a schema, writing in a fixed field order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayspark.schemas import EVENT_TYPES, HOTEL_EVENT

_WITH_CORRUPT = T.StructType([*HOTEL_EVENT.fields, T.StructField("_corrupt", T.StringType())])


def parse_hotel_event(payload: Column) -> Column:
    """Struct of the event fields plus ``_corrupt``, which holds the text when it is not valid."""
    return F.from_json(
        payload, _WITH_CORRUPT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    )


def is_valid_event(event: Column) -> Column:
    """Parsed, carrying an id, and with a known event type."""
    return (
        event.isNotNull()
        & event["_corrupt"].isNull()
        & event["eventId"].isNotNull()
        & F.coalesce(event["eventType"].isin(*EVENT_TYPES), F.lit(False))
    )


def missing_fields(event: Column) -> Column:
    """Names of the declared fields an otherwise valid record does not carry."""
    names = [F.when(event[f.name].isNull(), F.lit(f.name)) for f in HOTEL_EVENT.fields]
    return F.filter(F.array(*names), lambda x: x.isNotNull())


def parse_error(event: Column) -> Column:
    """Why a payload is not a valid event; null when it is."""
    return (
        F.when(event.isNull() | event["_corrupt"].isNotNull(), F.lit("payload is not valid JSON"))
        .when(event["eventId"].isNull(), F.lit("event id is missing"))
        .when(
            ~F.coalesce(event["eventType"].isin(*EVENT_TYPES), F.lit(False)),
            F.lit("unknown event type"),
        )
    )
