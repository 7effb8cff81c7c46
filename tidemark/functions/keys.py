"""Column expressions for silver keys and validity bounds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from tidemark.spec import PRIMARY_KEY, VALID_FROM, ScdSpec


def is_ntz(data_type: T.DataType) -> bool:
    return isinstance(data_type, T.TimestampNTZType)


def is_timestamp(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))


def primary_key(spec: ScdSpec) -> Column:
    parts = [F.col(c).cast("string") for c in (*spec.keys, spec.order_col)]
    joined = [parts[0]]
    for part in parts[1:]:
        joined += [F.lit("-"), part]
    return F.concat(*joined)


def utc_text(stamp: Column, data_type: T.DataType) -> Column:
    """Text of a timestamp in UTC, whatever the session time zone is."""
    if not isinstance(data_type, T.TimestampType):
        return stamp.cast("string")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(stamp), epoch).cast("string")


def version_key(
    data_type: T.DataType, primary: str | Column = PRIMARY_KEY, valid_from: str | Column = VALID_FROM
) -> Column:
    primary = F.col(primary) if isinstance(primary, str) else primary
    valid_from = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    return F.sha2(F.concat_ws("|", primary, utc_text(valid_from, data_type)), 256)


def sentinel(text: str, data_type: T.DataType) -> Column:
    """Begin or end of time: a wall-clock literal in UTC, typed like the change stamp."""
    if is_ntz(data_type):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(f"{text}Z" if "." in text else f"{text}.0Z").cast("timestamp")


def just_before(stamp: Column) -> Column:
    return F.timestamp_add("MICROSECOND", F.lit(-1), stamp)


def deletion_time(spec: ScdSpec, data_type: T.DataType) -> Column:
    """Instant of a delete from the event's epoch milliseconds, typed like the change stamp."""
    instant = F.timestamp_millis(F.col(spec.ts_ms_col))
    if is_ntz(data_type):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.col(spec.ts_ms_col) * 1000, epoch)
    return instant
