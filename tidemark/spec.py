"""Column roles and fixed names of the change-log and silver tables."""

from __future__ import annotations

from dataclasses import dataclass

# Column names and sentinels of the published table layout.
BEFORE_PREFIX = "before_"
AFTER_PREFIX = "after_"
SOURCE_PREFIX = "_source_"
VALID_FROM = "_valid_from"
VALID_TO = "_valid_to"
IS_CURRENT = "_is_current"
IS_DELETED = "_is_deleted"
PRIMARY_KEY = "primary_key"
VERSION_KEY = "version_key"
NATURAL_KEY = "natural_key"
RECORD_NUMBER = "_record_number"
RECORD_COUNT = "_record_count"
TRANSFORMED_AT = "_transformed_at"
BEGIN_OF_TIME = "1970-01-01 00:00:00"
END_OF_TIME = "9999-12-31 23:59:59.999999"
END_OF_TIME_YEAR_10000 = "10000-12-31 23:59:59.999999"
DATE_PARTITIONS = ("_year", "_month", "_day")

# Highest change sequence number folded into a silver row (not in the published layout).
LAST_SEEN = "_last_lsn"
# Tells a key's present history from versions that a rebuild of the key has replaced (hidden from readers).
GENERATION = "_generation"
# The raw file a change came from (hidden from readers).
RAW_FILE = "_raw_file"

TYPE2_COLUMNS = (
    VALID_FROM,
    VALID_TO,
    IS_CURRENT,
    IS_DELETED,
    PRIMARY_KEY,
    VERSION_KEY,
    NATURAL_KEY,
    RECORD_NUMBER,
    RECORD_COUNT,
    LAST_SEEN,
)
TYPE1_DROPPED = (IS_CURRENT, VALID_FROM, VALID_TO)


@dataclass(frozen=True)
class ScdSpec:
    """Which columns play which role, and from what size on a key counts as hot.

    ``hot_rows`` is a planning threshold only: it decides where work is split, never what the result is.
    """

    keys: tuple[str, ...] = ("id",)
    change_col: str = "updated_at"
    order_col: str = "_source_lsn"
    op_col: str = "_op"
    ts_ms_col: str = "_ts_ms"
    delete_op: str = "d"
    lineage: tuple[str, ...] = ("_extract_job_id", "_extract_buffer_id", "_extract_type", "_extracted_at")
    arrival: tuple[str, ...] = ("_extracted_at", "_extract_buffer_id")
    begin_of_time: str = BEGIN_OF_TIME
    end_of_time: str = END_OF_TIME
    hot_rows: int = 5_000_000

    def lineage_in(self, columns) -> list[str]:
        return [c for c in self.lineage if c in columns]

    def arrival_in(self, columns) -> list[str]:
        return [c for c in self.arrival if c in columns]
