"""Short notation for flat record schemas, usable without a running session."""

from __future__ import annotations

from pyspark.sql import types as T

PLAIN = {"date": T.DateType, "string": T.StringType, "bigint": T.LongType, "int": T.IntegerType, "timestamp": T.TimestampType}
PLAIN |= {f"array<{name}>": lambda kind=kind: T.ArrayType(kind()) for name, kind in PLAIN.items()}


def record(text: str) -> T.StructType:
    """``"a string, b bigint"`` as a schema."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, PLAIN[kind]()) for name, kind in pairs])
