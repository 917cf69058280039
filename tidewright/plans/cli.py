"""The command line: runs, checks, inspection, verification and vacuum."""

from __future__ import annotations

import argparse
import logging
import signal
import sys
import time

from pyspark.sql import SparkSession

from ..sources.catalog import JdbcCatalog, ParquetCatalog, SourceCatalog
from ..sources.lake_table import RETENTION_HOURS, LakeTable
from . import config as C
from . import inspect as I  # noqa: E741
from . import preflight
from .decisions import run_exit_code
from .modes import run_table
from .state import State
from .verify import Verifier, fold, plan_for

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidewright", description="Keeps lake tables in step with their source, and verifies it.")
    p.add_argument("--check", action="store_true", help="check configuration and storage, then stop")
    p.add_argument("--progress", action="store_true", help="say more of each window")
    p.add_argument("--local", metavar="DIR", help="keep tables below DIR instead of S3")
    p.add_argument("--inspect", metavar="TABLE", help="grade the table's possible cursors")
    p.add_argument("--verify", metavar="TABLE", nargs="?", const="*", help="verify one table or all")
    p.add_argument("--verify-deep", action="store_true", help="verify tables of any size")
    p.add_argument("--verify-after", action="store_true", help="verify after the run")
    p.add_argument("--strict", action="store_true", help="exit with 2 if a probe failed")
    p.add_argument("--vacuum", metavar="TABLE", nargs="?", const="*", help="name files that no version needs")
    p.add_argument("--vacuum-apply", action="store_true", help="delete them")
    p.add_argument("--vacuum-retention-hours", type=int, default=RETENTION_HOURS)
    p.add_argument("--vacuum-full", action="store_true", help="also files that no commit knows")
    p.add_argument("--vacuum-force", action="store_true", help="allow a shorter retention")
    return p


def catalog(spark: SparkSession, url: str) -> SourceCatalog:
    if url.startswith("parquet:"):
        return ParquetCatalog(spark, url.removeprefix("parquet:"))
    if url.startswith("mysql://"):
        from urllib.parse import unquote, urlsplit

        u = urlsplit(url)
        return JdbcCatalog(spark, f"jdbc:mariadb://{u.hostname}:{u.port or 3306}{u.path}", {"user": unquote(u.username or ""), "password": unquote(u.password or ""), "driver": "org.mariadb.jdbc.Driver"})
    return JdbcCatalog(spark, url)


class Stop:
    """Set by the first signal; a second one ends the process at once."""

    def __init__(self):
        self.asked = False

    def __call__(self) -> bool:
        return self.asked

    def install(self) -> Stop:
        for s in (signal.SIGINT, signal.SIGTERM):
            signal.signal(s, self._on)
        return self

    def _on(self, *_):
        if self.asked:
            sys.exit(130)
        self.asked = True


def run(spark: SparkSession, source: SourceCatalog, config: C.Config, state: State, stop=lambda: False) -> int:
    """All tables, one after the other; one that fails leaves the others alone."""
    good = bad = 0
    for table in config.tables:
        if stop():
            return run_exit_code(good, bad, True)
        began = time.time()
        try:
            mode, rows = run_table(spark, source, config, table, stop)
        except Exception as e:
            bad += 1
            log.exception("%s failed", table)
            state.update(table, "failed", seconds=time.time() - began, error=str(e)[:2000])
            continue
        if stop():
            state.update(table, "interrupted", mode, rows, time.time() - began)
            return run_exit_code(good, bad, True)
        good += 1
        state.update(table, "success", mode, rows, time.time() - began)
    return run_exit_code(good, bad)


def verify(spark: SparkSession, source: SourceCatalog, config: C.Config, only: str | None = None, deep: bool = False, strict: bool = False, say=print) -> int:
    lake_of = lambda t: LakeTable(spark, f"{config.root}/{t}")
    tables = config.tables if only in (None, "*") else [only]
    plans = [plan_for(source, lake_of(t), config, t) for t in tables]
    return fold(Verifier(source, lake_of, deep, say=say).run(plans), strict)


def vacuum(spark: SparkSession, config: C.Config, only: str, apply: bool, hours: int, full: bool, force: bool, say=print) -> int:
    failed = 0
    for t in config.tables if only == "*" else [only]:
        try:
            r = LakeTable(spark, f"{config.root}/{t}").vacuum(apply, hours, full, force)
            say(f"vacuum {t}: {len(r.files)} files named, {r.files_present} there, {r.bytes} bytes, {'deleted' if r.applied else 'nothing deleted'}")
        except Exception as e:
            failed += 1
            say(f"vacuum {t}: failed: {e}")
    return int(failed > 0)


def main(argv: list[str] | None = None, env=None, spark: SparkSession | None = None) -> int:
    args, env = parser().parse_args(argv), C.with_env_file(env)
    logging.basicConfig(level=logging.INFO if args.progress else logging.WARNING)
    new = lambda: spark or SparkSession.builder.appName("tidewright").getOrCreate()
    try:
        if args.inspect:
            source = catalog(new(), C.load_inspect(env))
            columns, indexes = source.columns(args.inspect), source.indexes(args.inspect)
            print(I.render(args.inspect, I.evaluate(args.inspect, columns, indexes, env.get(f"TABLE_TIMESTAMP_{args.inspect}"))))
            return 0
        config = C.load(env, args.local)
    except Exception as e:
        print(f"error: {e}", file=sys.stderr)
        return 2
    session = new()
    if config.s3_access_key_id:
        conf = session.sparkContext._jsc.hadoopConfiguration()
        for k, v in (("access.key", config.s3_access_key_id), ("secret.key", config.s3_secret_access_key), ("endpoint", config.s3_endpoint), ("endpoint.region", config.s3_region)):
            if v:
                conf.set(f"fs.s3a.{k}", v)
    source = catalog(session, config.database_url)
    if args.check:
        return int(preflight.check(session, source, config) > 0)
    if args.vacuum:
        return vacuum(session, config, args.vacuum, args.vacuum_apply, args.vacuum_retention_hours, args.vacuum_full, args.vacuum_force)
    if args.verify or (args.verify_deep and not args.verify_after):
        return verify(session, source, config, args.verify, args.verify_deep, args.strict)
    code = run(session, source, config, State("state.json"), Stop().install())
    return max(code, verify(session, source, config, None, args.verify_deep, args.strict)) if args.verify_after else code


if __name__ == "__main__":
    sys.exit(main())
