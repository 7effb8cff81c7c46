"""Row schemas declared as Connect schema documents."""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

# Connect type names and the Spark types they stand for.
PLAIN_TYPES = {
    "int8": T.IntegerType(),
    "int16": T.IntegerType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.FloatType(),
    "float32": T.FloatType(),
    "double": T.DoubleType(),
    "float64": T.DoubleType(),
    "boolean": T.BooleanType(),
    "bytes": T.BinaryType(),
    "string": T.StringType(),
}
DECIMAL_PRECISION = "connect.decimal.precision"
DECIMAL_DEFAULT = (38, 10)


@dataclass(frozen=True)
class ConnectField:
    name: str
    data_type: T.DataType
    optional: bool = True
    default: Any = None
    unit: str | None = None
    """How an integer holds a timestamp: ``millis``, ``micros`` or ``nanos`` since 1970."""

    def decode(self, column: Column) -> Column:
        """The column as this field's type; an integer timestamp is scaled by its declared unit."""
        if self.unit == "millis":
            return F.timestamp_millis(column.try_cast("bigint"))
        if self.unit == "micros":
            return F.timestamp_micros(column.try_cast("bigint"))
        if self.unit == "nanos":
            return F.timestamp_micros(F.floor(column.try_cast("bigint") / 1000).cast("bigint"))
        return column.try_cast(self.data_type)


def connect_fields(document: str | None) -> dict[str, ConnectField]:
    """Fields of the row a schema document describes, by name; nothing for a blank or broken document.

    The row is the envelope's ``after`` struct, else its ``before`` struct, else the document itself.
    """
    if document is None or not document.strip():
        return {}
    try:
        root = json.loads(document)
    except ValueError:
        log.warning("unreadable Connect schema document; treated as empty")
        return {}
    fields = _fields(root)
    structs = {f.get("field"): f for f in fields if f.get("type") == "struct"}
    row = structs.get("after") or structs.get("before")
    parsed = (_field(f) for f in (_fields(row) if row else fields))
    return {f.name: f for f in parsed if f is not None}


def _fields(node: Any) -> list[dict]:
    found = node.get("fields") if isinstance(node, dict) else None
    return [f for f in found if isinstance(f, dict)] if isinstance(found, list) else []


def _field(node: dict) -> ConnectField | None:
    name = node.get("field")
    if not isinstance(name, str) or not name.strip():
        return None
    logical = node.get("name") or ""
    data_type = _spark_type(node, logical)
    unit = None
    if node.get("type") == "int64" and isinstance(data_type, T.TimestampType):
        unit = "micros" if "Micro" in logical else "nanos" if "Nano" in logical else "millis"
    default = node.get("default")
    if not isinstance(default, (bool, int, float, str)):
        default = None
    return ConnectField(name, data_type, bool(node.get("optional", True)), default, unit)


def _spark_type(node: dict, logical: str) -> T.DataType:
    kind = node.get("type")
    if kind in ("int64", "string") and "Timestamp" in logical:
        return T.TimestampType()
    if kind == "string" and "Date" in logical:
        return T.DateType()
    if kind == "bytes" and "Decimal" in logical:
        parameters = node.get("parameters") or {}
        precision, scale = DECIMAL_DEFAULT
        return T.DecimalType(int(parameters.get(DECIMAL_PRECISION, precision)), int(parameters.get("scale", scale)))
    return PLAIN_TYPES.get(kind, T.StringType())


def row_schema(document: str | None) -> T.StructType:
    """The declared row as a read schema (integer timestamps are read as integers, then decoded)."""
    return T.StructType(
        [
            T.StructField(f.name, T.LongType() if f.unit else f.data_type, True)
            for f in connect_fields(document).values()
        ]
    )
