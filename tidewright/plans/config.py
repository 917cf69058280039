"""Configuration from the environment: strict, complete before anything runs, secrets masked."""

from __future__ import annotations

import contextlib
import logging
import os
import re
from collections.abc import Mapping
from dataclasses import dataclass, field

log = logging.getLogger(__name__)

AUTO, INCREMENTAL, FULL_REFRESH, TWO_STREAM = "auto", "incremental", "full_refresh", "two_stream"
#: The longest key of a watermark: after all rows of its time.
DEFAULT_BATCH = 10_000


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Config:
    database_url: str
    tables: list[str]
    root: str
    target_memory_mb: int
    merge_memory_mb: int
    s3_bucket: str | None = None
    s3_access_key_id: str | None = None
    s3_secret_access_key: str | None = None
    s3_endpoint: str | None = None
    s3_region: str = "us-east-1"
    s3_prefix: str = "lake"
    merge_spill_dir: str | None = None
    default_batch_size: int = DEFAULT_BATCH
    read_connections: int = 8
    log_level: str = "info"
    update_strategy: str = "replace"
    modes: dict[str, str] = field(default_factory=dict)
    timestamps: dict[str, str] = field(default_factory=dict)
    initial_hwm: dict[str, tuple[str, int]] = field(default_factory=dict)
    insert_cursors: dict[str, str] = field(default_factory=dict)
    update_cursors: dict[str, str] = field(default_factory=dict)
    reconcile: frozenset[str] = frozenset()

    def two_stream(self, table: str) -> tuple[str, str] | None:
        both = self.insert_cursors.get(table), self.update_cursors.get(table)
        return both if all(both) else None

    def __repr__(self) -> str:
        return f"Config(database_url={masked_url(self.database_url)!r}, tables={self.tables!r}, root={self.root!r}, target_memory_mb={self.target_memory_mb}, s3_access_key_id={masked(self.s3_access_key_id)!r}, s3_secret_access_key={masked(self.s3_secret_access_key)!r}, modes={self.modes!r})"


def masked(secret: str | None) -> str | None:
    return None if secret is None else "***"


def masked_url(url: str) -> str:
    """The URL without its password."""
    return re.sub(r"(//[^:/@]*):[^@]*@", r"\1:***@", url)


def _number(env: Mapping[str, str], name: str, default: int | None) -> int:
    raw = env.get(name, "").strip()
    if not raw:
        if default is None:
            raise ConfigError(f"{name} is required")
        return default
    if not raw.isdigit() or int(raw) == 0:
        raise ConfigError(f"{name}={raw}: a number above 0 is needed")
    return int(raw)


def _needed(env: Mapping[str, str], name: str) -> str:
    if not env.get(name):
        raise ConfigError(f"{name} is required")
    return env[name]


def _per_table(env: Mapping[str, str], prefix: str, tables: list[str]) -> dict[str, str]:
    return {t: v for t in tables if (v := env.get(f"{prefix}_{t}", "").strip())}


def parse_tables(raw: str) -> list[str]:
    return [t for x in raw.split(",") if (t := x.strip())]


def parse_modes(env: Mapping[str, str], tables: list[str]) -> dict[str, str]:
    out = {}
    for t in tables:
        if (raw := env.get(f"TABLE_MODE_{t}")) is None:
            continue
        mode = raw.strip().lower()
        if mode == TWO_STREAM:
            raise ConfigError(f"TABLE_MODE_{t}={raw}: two streams are chosen by TABLE_INSERT_CURSOR_{t} and TABLE_UPDATE_CURSOR_{t}")
        if mode not in (AUTO, INCREMENTAL, FULL_REFRESH):
            raise ConfigError(f"TABLE_MODE_{t}={raw}: the modes are {AUTO}, {INCREMENTAL} and {FULL_REFRESH}")
        out[t] = mode
    return out


def parse_initial_hwm(env: Mapping[str, str], tables: list[str]) -> dict[str, tuple[str, int]]:
    out = {}
    for t, raw in _per_table(env, "TABLE_HWM", tables).items():
        at, comma, last = (x.strip() for x in raw.partition(","))
        if not comma or not at or not re.fullmatch(r"[+-]?\d+", last) or not -(1 << 63) <= int(last) < 1 << 63:
            raise ConfigError(f"TABLE_HWM_{t}={raw}: a time, a comma and a whole number are needed")
        out[t] = (at, int(last))
    return out


def parse_reconcile(env: Mapping[str, str], tables: list[str]) -> frozenset[str]:
    chosen = set()
    for t in tables:
        raw = env.get(f"TABLE_RECONCILE_{t}")
        if raw is None:
            continue
        if raw.strip().lower() not in ("true", "false"):
            raise ConfigError(f"TABLE_RECONCILE_{t}={raw}: true or false is needed")
        if raw.strip().lower() == "true":
            chosen.add(t)
    return frozenset(chosen)


def physical_memory_mb() -> int | None:
    try:
        with open("/proc/meminfo") as f:
            return next(int(x.split()[1]) // 1024 for x in f if x.startswith("MemTotal:"))
    except (OSError, StopIteration, ValueError):
        return None


def check_memory(target: int, merge: int, there: int | None) -> None:
    """Budgets beyond the machine's memory are errors; a target beyond half of it is a warning. Unknown memory: no check."""
    if there is None:
        return
    for name, value in (("TARGET_MEMORY_MB", target), ("MERGE_MEMORY_MB", merge)):
        if value > there:
            raise ConfigError(f"{name} ({value}) is more than the machine's memory ({there} MB)")
    if 2 * target > there:
        log.warning("TARGET_MEMORY_MB (%s) is more than half of the machine's memory (%s MB)", target, there)


def check_conflicts(c: Config) -> None:
    for t in c.tables:
        if c.two_stream(t) and c.modes.get(t, AUTO) != AUTO:
            raise ConfigError(f"{t} has both cursors of two streams and TABLE_MODE_{t}={c.modes[t]}; one of them has to go")
        if t in c.reconcile:
            if not c.two_stream(t):
                raise ConfigError(f"TABLE_RECONCILE_{t} needs TABLE_INSERT_CURSOR_{t} and TABLE_UPDATE_CURSOR_{t}")
            if t in c.modes:
                raise ConfigError(f"TABLE_RECONCILE_{t} and TABLE_MODE_{t} exclude each other")


def load(env: Mapping[str, str] | None = None, local: str | None = None, memory_mb: int | None = None) -> Config:
    """The configuration; with `local`, tables go below that folder and no S3 setting is needed."""
    env = os.environ if env is None else env
    url = _needed(env, "DATABASE_URL")
    s3 = {n: None if local else _needed(env, n) for n in ("S3_BUCKET", "S3_ACCESS_KEY_ID", "S3_SECRET_ACCESS_KEY")}
    raw_tables = _needed(env, "TABLES")
    if not url.startswith(("mysql://", "jdbc:", "parquet:")):
        raise ConfigError("DATABASE_URL begins with mysql://, jdbc: or parquet:")
    tables = parse_tables(raw_tables)
    if not tables:
        raise ConfigError("TABLES names no table")
    target = _number(env, "TARGET_MEMORY_MB", None)
    merge = _number(env, "MERGE_MEMORY_MB", target)
    check_memory(target, merge, memory_mb if memory_mb is not None else physical_memory_mb())
    strategy = env.get("UPDATE_STRATEGY", "")
    if strategy not in ("", "merge"):
        raise ConfigError(f"UPDATE_STRATEGY={strategy}: only merge can be asked for; unset, changed files are replaced")
    for name in ("MERGE_SORT_RESERVATION_MB", "MERGE_TARGET_PARTITIONS"):
        raw = env.get(name, "").strip()
        if raw and (not raw.isdigit() or (name.endswith("PARTITIONS") and int(raw) == 0)):
            raise ConfigError(f"{name}={raw}: a whole number is needed")
    prefix = env.get("S3_PREFIX") or "lake"
    c = Config(
        database_url=url, tables=tables, root=local or f"s3a://{s3['S3_BUCKET']}/{prefix}", target_memory_mb=target, merge_memory_mb=merge,
        s3_bucket=s3["S3_BUCKET"], s3_access_key_id=s3["S3_ACCESS_KEY_ID"], s3_secret_access_key=s3["S3_SECRET_ACCESS_KEY"],
        s3_endpoint=env.get("S3_ENDPOINT") or None, s3_region=env.get("S3_REGION") or "us-east-1", s3_prefix=prefix,
        merge_spill_dir=env.get("MERGE_SPILL_DIR") or None, default_batch_size=_number(env, "DEFAULT_BATCH_SIZE", DEFAULT_BATCH), read_connections=_number(env, "READ_CONNECTIONS", 8),
        log_level=env.get("LOG_LEVEL") or "info", update_strategy=strategy or "replace", modes=parse_modes(env, tables),
        timestamps=_per_table(env, "TABLE_TIMESTAMP", tables), initial_hwm=parse_initial_hwm(env, tables),
        insert_cursors=_per_table(env, "TABLE_INSERT_CURSOR", tables), update_cursors=_per_table(env, "TABLE_UPDATE_CURSOR", tables), reconcile=parse_reconcile(env, tables),
    )
    check_conflicts(c)
    return c


def with_env_file(env: Mapping[str, str] | None = None, path: str = ".env") -> dict[str, str]:
    """The environment over what a file of NAME=value lines says; no file, no harm."""
    found: dict[str, str] = {}
    with contextlib.suppress(FileNotFoundError), open(path) as f:
        for line in f:
            name, mark, value = line.strip().removeprefix("export ").partition("=")
            if mark and not name.startswith("#"):
                found[name.strip()] = value.strip().strip("\"'")
    return found | dict(os.environ if env is None else env)


def load_inspect(env: Mapping[str, str] | None = None) -> str:
    """All that an inspection needs: the source's URL."""
    return _needed(os.environ if env is None else env, "DATABASE_URL")
