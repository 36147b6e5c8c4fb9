"""Scalar column helpers. Everything compiles to built-in Spark expressions."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Context labels written by the ingest step, keyed by the UTC hour of the run.
RUN_CONTEXTS = {
    9: "MADRUGADA_CRITICA",
    17: "MEDIODIA_SEGUIMIENTO",
    23: "NOCTURNA_PLANIFICACION",
}
OTHER_CONTEXT = "MANUAL_TESTING"

# Fixed value: the local zone of the landing reports.
LOCAL_ZONE = "America/Panama"


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def as_literal(moment, like: T.DataType | None = None) -> Column:
    """A clock argument (column, datetime, date or text) as a column, cast to the type of the column it meets."""
    column = moment if isinstance(moment, Column) else F.lit(moment)
    if like is None:
        like = T.DateType() if type(moment) is date else T.TimestampType()
    if isinstance(moment, (str, datetime, date)) and isinstance(like, T.TimestampNTZType):
        text = moment if isinstance(moment, str) else str(moment)
        column = F.lit(text)
    return column.cast(like)


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch, for zoned and zone-less timestamps alike."""
    return F.unix_timestamp(_column(ts))


def truncate(df: DataFrame, ts: str, unit: str = "hour") -> Column:
    """``date_trunc`` that keeps the type of the input column."""
    return F.date_trunc(unit, F.col(ts)).cast(df.schema[ts].dataType)


def parse_ts(text) -> Column:
    """Feed text to timestamp; text that does not parse becomes NULL instead of failing the job."""
    return F.try_to_timestamp(_column(text))


def hours_between(earlier, later) -> Column:
    """Hours from one instant to another, at second precision."""
    return (epoch_seconds(later) - epoch_seconds(earlier)) / F.lit(3600.0)


def minutes_since(ts, as_of) -> Column:
    """Age of a timestamp in whole minutes at the moment ``as_of``."""
    moment = as_of if isinstance(as_of, Column) else as_literal(as_of)
    return F.round((epoch_seconds(moment) - epoch_seconds(ts)) / F.lit(60.0), 0).cast("int")


def local_time(ts_utc, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in a zone for a UTC instant."""
    return F.from_utc_timestamp(_column(ts_utc), zone)


def run_context(ts) -> Column:
    """Label of a run from its UTC hour."""
    hour = F.hour(_column(ts))
    label = F.lit(OTHER_CONTEXT)
    for at, name in RUN_CONTEXTS.items():
        label = F.when(hour == at, F.lit(name)).otherwise(label)
    return label


def tide_kind(state) -> Column:
    """HIGH or LOW for every spelling of a tide extreme; any other text passes through."""
    raw = _column(state)
    spelling = F.upper(F.translate(F.trim(raw), " -", "__"))
    return (
        F.when(spelling.isin("HIGH", "HIGH_TIDE"), F.lit("HIGH"))
        .when(spelling.isin("LOW", "LOW_TIDE"), F.lit("LOW"))
        .otherwise(raw)
    )


def clip_round(value, low: float = 0.0, high: float = 100.0, digits: int = 2) -> Column:
    """Limit a number to a range and round it; NULL stays NULL."""
    raw = _column(value)
    return F.when(raw.isNotNull(), F.round(F.least(F.greatest(raw, F.lit(low)), F.lit(high)), digits))


def json_field(text, schema: str, field: str) -> Column:
    """One field of a JSON document read with an explicit schema."""
    return F.from_json(_column(text), schema)[field]
