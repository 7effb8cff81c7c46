"""Change envelopes → flat bronze columns, and bronze rows → one row image per change."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tidemark.spec import AFTER_PREFIX, BEFORE_PREFIX, SOURCE_PREFIX, ScdSpec

log = logging.getLogger(__name__)

BEFORE, AFTER, PAYLOAD = ("payload", "before"), ("payload", "after"), ("payload",)
# Parts of an envelope, and what the columns made of their fields begin with.
COLUMNS_OF = {AFTER: AFTER_PREFIX, BEFORE: BEFORE_PREFIX, ("payload", "source"): SOURCE_PREFIX, PAYLOAD: "_", ("extract",): "_"}
METADATA_FIELDS = ("op", "transaction", "ts_ms", "ts_ns", "ts_us")


def _type_at(schema: T.DataType | None, path: tuple[str, ...]) -> T.DataType | None:
    for name in path:
        inside = isinstance(schema, T.StructType) and name in schema.fieldNames()
        schema = schema[name].dataType if inside else None
    return schema


def flatten_envelope(raw: DataFrame, *passed: str) -> DataFrame:
    """One narrow projection: ``before_*``, ``after_*``, ``_source_*``, event metadata, extract lineage, and columns passed on.

    An image whose type is not a struct (every value null, so the reader could not infer it) takes the shape of
    the other image, as typed nulls; a part that is no struct otherwise has no columns.
    """
    types = {path: _type_at(raw.schema, path) for path in COLUMNS_OF}
    structs = {path: t for path, t in types.items() if isinstance(t, T.StructType)}
    image = structs.get(AFTER, structs.get(BEFORE, T.StructType()))
    shapes = structs | {path: image for path in (BEFORE, AFTER) if types[path] is not None and path not in structs}
    empty = [".".join(path) for path, t in types.items() if t is not None and not shapes.get(path)]
    if empty:
        log.warning("no fields to expand in %s", ", ".join(empty))

    def column(path: tuple[str, ...], field: T.StructField) -> Column:
        prefix = COLUMNS_OF[path]
        name = field.name if prefix == "_" and field.name.startswith("_") else prefix + field.name
        full = ".".join(f"`{part}`" for part in (*path, field.name))
        return (F.col(full) if path in structs else F.lit(None).cast(field.dataType)).alias(name)

    return raw.select(
        *(
            column(path, field)
            for path in COLUMNS_OF
            for field in shapes.get(path, T.StructType()).fields
            if path != PAYLOAD or field.name in METADATA_FIELDS
        ),
        *passed,
    )


def is_delete(spec: ScdSpec) -> Column:
    return F.col(spec.op_col).eqNullSafe(spec.delete_op)


def deletes(bronze: DataFrame, spec: ScdSpec) -> DataFrame:
    return bronze.where(is_delete(spec))


def upserts(bronze: DataFrame, spec: ScdSpec) -> DataFrame:
    """Every change that is not a delete, a missing operation code included."""
    return bronze.where(~is_delete(spec))


def _one_image(bronze: DataFrame, keep: str, drop: str) -> DataFrame:
    return bronze.select(
        *(
            F.col(f"`{name}`").alias(name.removeprefix(keep))
            for name in bronze.columns
            if not name.startswith(drop)
        )
    )


def after_image(bronze: DataFrame) -> DataFrame:
    return _one_image(bronze, AFTER_PREFIX, BEFORE_PREFIX)


def before_image(bronze: DataFrame) -> DataFrame:
    return _one_image(bronze, BEFORE_PREFIX, AFTER_PREFIX)


def change_image(bronze: DataFrame, spec: ScdSpec) -> DataFrame:
    """The image that counts for each change: before for deletes, after for the rest.

    Deletes and upserts stay in one relation, so bronze is scanned once.
    """
    names = list(bronze.columns)
    present = set(names)
    columns: list[Column] = []
    for name in names:
        if name.startswith(AFTER_PREFIX):
            plain = name.removeprefix(AFTER_PREFIX)
            old = f"`{BEFORE_PREFIX}{plain}`"
            value = F.col(f"`{name}`")
            if f"{BEFORE_PREFIX}{plain}" in present:
                value = F.when(is_delete(spec), F.col(old)).otherwise(value)
            else:
                value = F.when(~is_delete(spec), value)
            columns.append(value.alias(plain))
        elif name.startswith(BEFORE_PREFIX):
            plain = name.removeprefix(BEFORE_PREFIX)
            if f"{AFTER_PREFIX}{plain}" not in present:
                columns.append(F.when(is_delete(spec), F.col(f"`{name}`")).alias(plain))
        else:
            columns.append(F.col(f"`{name}`"))
    return bronze.select(*columns)


def has_key(spec: ScdSpec) -> Column:
    """False for changes no row can be identified by, such as truncates."""
    present = F.col(spec.order_col).isNotNull()
    for key in spec.keys:
        present = present & F.col(key).isNotNull()
    return present
