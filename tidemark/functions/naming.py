"""Names of tables, namespaces, paths and subjects, as plain functions and as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Naming conventions of files and tables.
FLUSH_FILE = r"^(.+)-(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2}-\d{3})-(\d{6})\.(jsonl|avro)$"
LEGACY_FILE = r"^(.+)-(\d{4}-\d{2}-\d{2}_\d{2}-\d{2}-\d{2})\.(jsonl|avro)$"
RAW_EXTENSION = r"\.(jsonl|avro)$"
BRONZE_SUFFIX = "_bronze"
SILVER_SUFFIX = "_silver"
TYPE1_SUFFIX = "_type1"
TYPE2_SUFFIX = "_type2"
UNKNOWN = "unknown"


def table_fqn_from_file_name(name: str) -> str:
    for pattern in (FLUSH_FILE, LEGACY_FILE):
        match = re.match(pattern, name)
        if match:
            return match.group(1)
    return re.sub(RAW_EXTENSION, "", name)


def table_fqn_column(file_name: Column) -> Column:
    """File name → source table, for routing a whole directory in one pass."""
    return F.coalesce(
        F.nullif(F.regexp_extract(file_name, FLUSH_FILE, 1), F.lit("")),
        F.nullif(F.regexp_extract(file_name, LEGACY_FILE, 1), F.lit("")),
        F.regexp_replace(file_name, RAW_EXTENSION, ""),
    )


def bronze_namespace(source_schema: str) -> str:
    return source_schema + BRONZE_SUFFIX


def silver_namespace(source_schema: str) -> str:
    return source_schema + SILVER_SUFFIX


def type1_table(source_table: str) -> str:
    return source_table + TYPE1_SUFFIX


def type2_table(source_table: str) -> str:
    return source_table + TYPE2_SUFFIX


def split_fqn(fqn: str) -> tuple[str, str, str]:
    parts = fqn.split(".", 2)
    if len(parts) != 3 or not all(parts):
        raise ValueError(f"expected database.schema.table, got {fqn!r}")
    return parts[0], parts[1], parts[2]


def bronze_fqn(source_fqn: str) -> str:
    database, schema, table = split_fqn(source_fqn)
    return f"{database}.{bronze_namespace(schema)}.{table}"


def silver_from_bronze(namespace: str | None) -> str | None:
    if namespace is not None and namespace.endswith(BRONZE_SUFFIX):
        return namespace[: -len(BRONZE_SUFFIX)] + SILVER_SUFFIX
    return namespace


def silver_fqn(bronze: str, suffix: str) -> str:
    """Bronze table name → its silver type-1 or type-2 table name."""
    database, namespace, table = split_fqn(bronze)
    return f"{database}.{silver_from_bronze(namespace)}.{table}{suffix}"


def value_subject(database: str, namespace: str, table: str) -> str:
    return f"iceberg.{database}.{namespace}.{table}-value"


def table_path(base: str, fqn: str) -> str:
    return "/".join((base.rstrip("/"), *split_fqn(fqn)))


def identity_from_path(path: str) -> dict[str, str]:
    """Last three path segments name the table; what is before them is the warehouse."""
    parts = [p for p in path.split("/") if p not in ("", ".")]
    if len(parts) < 3:
        raise ValueError(f"a table path needs database/schema/table segments, got {path!r}")
    root = "/" if path.startswith("/") else ""
    return {
        "database": parts[-3],
        "namespace": parts[-2],
        "table": parts[-1],
        "warehouse": root + "/".join(parts[:-3]),
    }


def bronze_fqn_column(source_fqn: Column) -> Column:
    parts = F.split(source_fqn, r"\.", 3)
    return F.when(
        F.size(parts) == 3,
        F.concat_ws(".", parts[0], F.concat(parts[1], F.lit(BRONZE_SUFFIX)), parts[2]),
    )


def silver_from_bronze_column(namespace: Column) -> Column:
    return F.regexp_replace(namespace, f"{BRONZE_SUFFIX}$", SILVER_SUFFIX)


def table_path_column(base: Column | str, fqn: Column) -> Column:
    base = F.lit(base) if isinstance(base, str) else base
    return F.concat_ws("/", base, F.array_join(F.slice(F.split(fqn, r"\."), 1, 3), "/"))


def identity_columns(path: Column) -> dict[str, Column]:
    """Table identity of a path as columns; all null when the path has fewer than three segments."""
    parts = F.filter(F.split(path, "/"), lambda p: (p != "") & (p != "."))
    enough = F.size(parts) >= 3
    root = F.when(path.startswith("/"), F.lit("/")).otherwise(F.lit(""))
    warehouse = F.concat(root, F.array_join(F.slice(parts, 1, F.greatest(F.size(parts) - 3, F.lit(0))), "/"))
    return {
        "database": F.when(enough, F.try_element_at(parts, F.lit(-3))),
        "namespace": F.when(enough, F.try_element_at(parts, F.lit(-2))),
        "table": F.when(enough, F.try_element_at(parts, F.lit(-1))),
        "warehouse": F.when(enough, warehouse),
    }


def present(column: Column) -> Column:
    return F.coalesce(F.trim(column) != "", F.lit(False))


def normalized_id(column: Column) -> Column:
    return F.when(present(column), column).otherwise(F.lit(UNKNOWN))


def first_present(*columns: Column) -> Column:
    return F.coalesce(*(F.when(present(c), c) for c in columns))


def identity_complete(*columns: Column) -> Column:
    complete = F.lit(True)
    for column in columns:
        complete = complete & present(column)
    return complete


def is_present(value: str | None) -> bool:
    return value is not None and value.strip() != ""
