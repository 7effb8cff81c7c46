"""Brute-force walk of the type-2 rule over small change logs, event by event."""

from __future__ import annotations

import hashlib
import itertools
import random
from datetime import datetime, timedelta, timezone

START = datetime(1970, 1, 1)
END = datetime(9999, 12, 31, 23, 59, 59, 999999)
DAY0 = datetime(2026, 1, 1)
JOBS = itertools.count()
SCHEMA = (
    "id bigint, name string, updated_at timestamp_ntz, _op string, _source_lsn bigint, _ts_ms bigint, "
    "_extract_buffer_id string, _extract_job_id string"
)
SHOWN = (
    "id", "name", "_source_lsn", "_extract_buffer_id", "_extract_job_id", "_valid_from", "_valid_to",
    "_is_current", "_is_deleted", "primary_key", "version_key", "natural_key", "_record_number",
    "_record_count", "_last_lsn",
)


def random_log(rng: random.Random, key: int, conflicts: bool = True, nulls: bool = True) -> list[tuple]:
    """Rows of SCHEMA for one key: stamps repeat and run backwards, events come in copies."""
    rows = []
    lsn = 0
    for _ in range(rng.randint(1, 9)):
        lsn += rng.randint(1, 3)
        rows.append(_event(rng, key, lsn, nulls))
        while rng.random() < 0.2:
            if conflicts and rng.random() < 0.3:
                rows.append(_event(rng, key, lsn, nulls))
            else:
                rows.append((*rows[-1][:6], f"b{rng.randint(0, 5)}", f"j{next(JOBS):06d}"))
    return rows


def _event(rng, key, lsn, nulls):
    op = rng.choice("cuurdd")
    stamp = DAY0 + timedelta(days=rng.randint(0, 3))
    if op == "d" or (nulls and rng.random() < 0.05):
        stamp = None
    ms = int((DAY0 + timedelta(days=lsn, milliseconds=rng.randint(0, 999))).replace(tzinfo=timezone.utc).timestamp() * 1000)
    return (key, f"n{lsn}{rng.choice('xy')}", stamp, op, lsn, ms, f"b{rng.randint(0, 5)}", f"j{next(JOBS):06d}")


def text(stamp):
    if stamp is None:
        return None
    base = stamp.strftime("%Y-%m-%d %H:%M:%S")
    return base + (f".{stamp.microsecond:06d}".rstrip("0") if stamp.microsecond else "")


def walk(rows: list[tuple]) -> list[tuple]:
    """Expected type-2 rows (columns SHOWN) of one key, from all its events in any order."""
    by_lsn: dict[int, list[tuple]] = {}
    for row in rows:
        by_lsn.setdefault(row[4], []).append(row)
    versions: list[dict] = []
    stamp_of_run = None
    for lsn in sorted(by_lsn):
        copies = sorted(by_lsn[lsn], key=lambda r: r[6:])
        key, name, stamp, op, _, ms, _, _ = copies[0]
        lineage = copies[0 if op == "d" else -1][6:]
        last = versions[-1] if versions else None
        if op == "d":
            ends = START + timedelta(milliseconds=ms)
            if last is None:
                versions.append(
                    dict(id=key, name=name, lsn=lsn, lineage=lineage, start=START, end=ends, current=True,
                         deleted=True, seen=lsn, live=False, stamp=None)
                )
                continue
            last.update(end=ends, deleted=True, live=False, seen=lsn)
            if last["start"] != START or last["stamp"] is not None:
                last["current"] = last["current"] and last.get("tombstone", False)
            continue
        if last is not None and last["live"] and stamp is not None and last["stamp"] == stamp:
            last.update(lineage=lineage, seen=lsn)
            continue
        if last is not None:
            if last["live"]:
                last["end"] = None if stamp is None else stamp - timedelta(microseconds=1)
            last.update(current=False, live=False)
        versions.append(
            dict(id=key, name=name, lsn=lsn, lineage=lineage, start=stamp, end=END, current=True, deleted=False,
                 seen=lsn, live=True, stamp=stamp)
        )
    out = []
    for number, v in enumerate(versions, 1):
        primary = f"{v['id']}-{v['lsn']}"
        hashed = "|".join(x for x in (primary, text(v["start"])) if x is not None)
        out.append(
            (v["id"], v["name"], v["lsn"], *v["lineage"], v["start"], v["end"], v["current"], v["deleted"], primary,
             hashlib.sha256(hashed.encode()).hexdigest(), v["id"], number, len(versions), v["seen"])
        )
    return out


def expected(rows: list[tuple]) -> list[tuple]:
    groups: dict[int, list[tuple]] = {}
    for row in rows:
        groups.setdefault(row[0], []).append(row)
    return sorted((v for g in groups.values() for v in walk(g)), key=lambda r: (r[0], r[2]))
