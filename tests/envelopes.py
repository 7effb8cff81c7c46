"""Change envelopes as JSON lines, in the shape a connector writes them."""

from __future__ import annotations

import json
import os

V1 = ("2026-05-31T02:27:24.242870Z", 32591512)
V2 = ("2026-05-31T03:27:24.242870Z", 32592000)
V3 = ("2026-05-31T04:27:24.242870Z", 32596512)


def envelope(buffer, op, key, lsn, updated_at=None, name="one", value=1.5, ts_ms=1780194444583, job="job-1",
             kind="stream", **extra):
    row = {"id": key, "name": name, "value": value, "created_at": "2026-05-30T00:00:00Z", "updated_at": updated_at}
    row.update(extra)
    return {
        "extract": {
            "extract_job_id": job, "extract_buffer_id": buffer, "extract_type": kind,
            "extracted_at": "2026-05-31T05:00:00.000001Z",
        },
        "schema": {"type": "struct"},
        "payload": {
            "before": row if op == "d" else None,
            "after": None if op == "d" else row,
            "source": {"db": "geo", "schema": "public", "table": "scalars", "lsn": lsn, "ts_ms": ts_ms},
            "transaction": None, "op": op, "ts_ms": ts_ms, "ts_us": ts_ms * 1000, "ts_ns": ts_ms * 1000000,
        },
    }


def write_lines(path, envelopes):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        for line in envelopes:
            out.write((line if isinstance(line, str) else json.dumps(line)) + "\n")
    return str(path)
