"""What the last run of each table came to; for people, never for resuming."""

from __future__ import annotations

import json
import logging
import os
import tempfile
import time

log = logging.getLogger(__name__)


class State:
    """A JSON file, replaced whole; one that can't be read counts as a first run."""

    def __init__(self, path: str):
        self.path, self.tables = path, {}
        try:
            with open(path) as f:
                self.tables = json.load(f)["tables"]
        except FileNotFoundError:
            pass
        except (ValueError, KeyError, TypeError) as e:
            log.warning("%s can't be read (%s); starting anew", path, e)

    def update(self, table: str, status: str, mode: str | None = None, rows: int | None = None, seconds: float | None = None, error: str | None = None) -> None:
        """What last went well stays said until something goes well again."""
        have = self.tables.get(table, {})
        now = time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())
        entry = {**have, "last_run_at": now, "last_run_status": status, "last_run_duration_ms": None if seconds is None else int(seconds * 1000), "error": error}
        if status == "success":
            entry |= {"last_success_at": now, "last_run_rows": rows, "extraction_mode": mode}
        self.tables[table] = entry
        self.save()

    def save(self) -> None:
        folder = os.path.dirname(os.path.abspath(self.path))
        fd, draft = tempfile.mkstemp(dir=folder, prefix=".state-")
        with os.fdopen(fd, "w") as f:
            json.dump({"tables": self.tables}, f, indent=1, sort_keys=True)
            f.flush()
            os.fsync(f.fileno())
        os.replace(draft, self.path)
        fd = os.open(folder, os.O_RDONLY)
        try:
            os.fsync(fd)
        finally:
            os.close(fd)
