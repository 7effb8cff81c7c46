"""Schema evolution: add, widen, keep, never drop; and aligning incoming rows to what results."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.functions.connect import ConnectField
from tidemark.functions.keys import is_timestamp
from tidemark.functions.timestamps import parse_iso
from tidemark.spec import AFTER_PREFIX, BEFORE_PREFIX

BRONZE = "bronze"
SILVER = "silver"
# Spark's own field metadata for the value that files without the column read as.
EXISTS_DEFAULT = "EXISTS_DEFAULT"
CURRENT_DEFAULT = "CURRENT_DEFAULT"

# Type changes that lose nothing, beyond decimals and timestamp flavours.
SAFE_WIDENINGS = {("int", "bigint"), ("float", "double")}


class SchemaIncompatibleError(Exception):
    """A column would have to change to a type its stored values do not fit."""

    def __init__(self, table: str, column: str, current: T.DataType, wanted: T.DataType):
        self.table, self.column = table, column
        self.current, self.wanted = current.simpleString(), wanted.simpleString()
        super().__init__(f"{table}.{column}: cannot change {self.current} to {self.wanted}")


@dataclass(frozen=True)
class Desired:
    """One wanted column: its type, its default for rows that lack it, and how to decode incoming values."""

    data_type: T.DataType
    default: object = None
    declared: ConnectField | None = None


def same_type(left: T.DataType, right: T.DataType) -> bool:
    return left.simpleString() == right.simpleString() or (is_timestamp(left) and is_timestamp(right))


def safe_coercion(current: T.DataType, wanted: T.DataType) -> bool:
    if same_type(current, wanted):
        return True
    if isinstance(current, T.StringType) and is_timestamp(wanted):
        return True
    if isinstance(current, T.DecimalType) and isinstance(wanted, T.DecimalType):
        whole = wanted.precision - wanted.scale >= current.precision - current.scale
        return whole and wanted.scale >= current.scale
    return (current.simpleString(), wanted.simpleString()) in SAFE_WIDENINGS


def desired_columns(incoming: T.StructType, declared: dict[str, ConnectField], layer: str) -> dict[str, Desired]:
    """Incoming columns and declared fields together; the declared type wins.

    The exception: a column already parsed to a timestamp stays one where the document says plain string.
    """
    wanted = {f.name: Desired(f.dataType) for f in incoming.fields}
    prefixes = (BEFORE_PREFIX, AFTER_PREFIX) if layer == BRONZE else ("",)
    for connect in declared.values():
        for prefix in prefixes:
            name = prefix + connect.name
            found = wanted.get(name)
            data_type = connect.data_type
            decode: ConnectField | None = connect
            if found is not None and is_timestamp(found.data_type):
                if isinstance(data_type, T.StringType):
                    data_type = found.data_type
                decode = None
            wanted[name] = Desired(data_type, connect.default, decode)
    return wanted


@dataclass
class Evolution:
    """What a table's schema must become, and how."""

    schema: T.StructType
    added: list[str] = field(default_factory=list)
    widened: list[str] = field(default_factory=list)
    rewritten: list[str] = field(default_factory=list)
    """Widened columns whose stored values a reader cannot widen: they are converted when read, or rewritten."""

    @property
    def changed(self) -> bool:
        return bool(self.added or self.widened or self.rewritten)


def plan_evolution(table: str, current: T.StructType, desired: dict[str, Desired]) -> Evolution:
    """Decide column by column; raises before anything is touched if one change is impossible.

    Columns missing upstream stay. Nothing is NOT NULL, so there is nothing to relax.
    """
    result = Evolution(T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in current.fields]))
    index = {f.name: i for i, f in enumerate(current.fields)}
    for name, want in desired.items():
        if name not in index:
            metadata = default_metadata(want)
            result.schema.add(T.StructField(name, want.data_type, True, metadata))
            result.added.append(name)
            continue
        have = current.fields[index[name]]
        if same_type(have.dataType, want.data_type) or safe_coercion(want.data_type, have.dataType):
            continue
        if not safe_coercion(have.dataType, want.data_type):
            raise SchemaIncompatibleError(table, name, have.dataType, want.data_type)
        result.schema.fields[index[name]] = T.StructField(name, want.data_type, True, have.metadata)
        needs_files = isinstance(have.dataType, T.StringType)
        (result.rewritten if needs_files else result.widened).append(name)
    return result


def default_metadata(want: Desired) -> dict:
    """A default as column metadata: older files read as the default, without being rewritten."""
    if want.default is None:
        return {}
    text = default_sql(want.default, want.data_type)
    return {EXISTS_DEFAULT: text, CURRENT_DEFAULT: text}


def default_sql(value: object, data_type: T.DataType) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        literal = repr(value)
    else:
        escaped = str(value).replace("\\", "\\\\").replace("'", "\\'")
        literal = f"'{escaped}'"
    if isinstance(data_type, T.StringType) and isinstance(value, str):
        return literal
    # A default that does not fit its own column must not make the table unreadable.
    return f"TRY_CAST({literal} AS {data_type.simpleString()})"


def convert(column: Column, current: T.DataType, wanted: T.DataType, declared: ConnectField | None = None) -> Column:
    """Cast that gives null, never an error, for a value that does not fit."""
    if declared is not None and declared.unit and isinstance(current, (T.IntegerType, T.LongType)):
        column, current = declared.decode(column), T.TimestampType()
    if current.simpleString() == wanted.simpleString():
        return column
    if isinstance(current, T.StringType) and is_timestamp(wanted):
        return F.coalesce(parse_iso(column), column.try_cast("timestamp")).cast(wanted)
    return column.try_cast(wanted)


def align(df: DataFrame, desired: dict[str, Desired], table: T.StructType | None = None) -> DataFrame:
    """Incoming rows in the table's columns, types and order: one projection.

    Columns the table keeps but the rows lack are null; further columns follow in incoming order.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    target = {f.name: f.dataType for f in table.fields} if table is not None else {}
    names = [*target, *(n for n in (*present, *desired) if n not in target)]
    columns = []
    for name in dict.fromkeys(names):
        want = desired.get(name)
        wanted = target.get(name) or (want.data_type if want else present[name])
        if name not in present:
            columns.append(F.lit(None).cast(wanted).alias(name))
            continue
        value = F.col(f"`{name}`")
        middle = want.data_type if want else present[name]
        value = convert(value, present[name], middle, want.declared if want else None)
        columns.append(convert(value, middle, wanted).alias(name))
    return df.select(*columns)


def lossy(df: DataFrame, desired: dict[str, Desired], table: T.StructType | None = None) -> Column | None:
    """True for rows in which aligning turns a value into null; None when no column is cast."""
    present = {f.name: f.dataType for f in df.schema.fields}
    target = {f.name: f.dataType for f in table.fields} if table is not None else {}
    lost = None
    for name, current in present.items():
        want = desired.get(name)
        middle = want.data_type if want else current
        wanted = target.get(name, middle)
        if current.simpleString() == middle.simpleString() == wanted.simpleString():
            continue
        value = F.col(f"`{name}`")
        result = convert(convert(value, current, middle, want.declared if want else None), middle, wanted)
        gone = value.isNotNull() & result.isNull()
        lost = gone if lost is None else lost | gone
    return lost
