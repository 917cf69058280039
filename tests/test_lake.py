"""Lake tables, runs, verification and streams over small tables."""

import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewright.functions import fingerprint as P
from tidewright.functions.cursors import MAX_LONG, Hwm
from tidewright.operators import upsert as U
from tidewright.operators import windows as W
from tidewright.plans import cli
from tidewright.plans import config as C
from tidewright.plans import modes as M
from tidewright.plans.verify import DISCREPANCY, DRIFT, PARTIAL, PASS, SKIPPED, Plan, Verifier, plan_for
from tidewright.sources.catalog import JdbcCatalog, ParquetCatalog, SourceTableMissing
from tidewright.sources.lake_table import CommitConflict, LakeTable, Marks, TableMissing
from tidewright.streaming.cursor_stream import append_stream


def rows(spark, data, schema="id long, name string, at timestamp_ntz"):
    df = spark.createDataFrame([(i, n, t) for i, n, t in data], "id long, name string, at string")
    return df.withColumn("at", F.col("at").cast("timestamp_ntz"))


@pytest.fixture
def lake(spark, tmp_path):
    return LakeTable(spark, str(tmp_path / "t"))


def ids(df):
    return sorted((r[0] for r in df.select("id").collect()), key=lambda x: (x is None, x))


def test_append_merges_schema_and_keeps_marks(spark, lake):
    with pytest.raises(TableMissing):
        lake.snapshot()
    assert lake.schema() is None and not lake.has_data()
    lake.append(rows(spark, [(1, "a", "2024-01-01")]), Marks(Hwm("2024-01-01T00:00:00", 1)))
    lake.append(rows(spark, [(2, "b", "2024-01-02")]).withColumn("extra", F.lit(5)))
    assert lake.append(rows(spark, []).limit(0)) is None or lake.row_count() == 2
    assert ids(lake.read()) == [1, 2] and [r.extra for r in lake.read().orderBy("id").collect()] == [None, 5]
    assert lake.marks() == Marks(Hwm("2024-01-01T00:00:00", 1)) and lake.row_count() == 2
    with pytest.raises(Exception, match="does not fit|CAST"):
        lake.append(spark.createDataFrame([("x", "b", None)], "id string, name string, at timestamp_ntz"))
    assert ids(lake.read()) == [1, 2]


def test_staged_overwrite_is_all_or_nothing(spark, lake):
    lake.append(rows(spark, [(1, "a", None), (2, "b", None)]), Marks(Hwm("2024-01-01", 2), 2))
    new = spark.createDataFrame([(7, 1.5)], "id long, price double")
    with pytest.raises(RuntimeError), lake.overwrite(new.schema) as session:
        session.stage(new)
        assert ids(lake.read()) == [1, 2]
        raise RuntimeError("crash")
    assert ids(lake.read()) == [1, 2] and not [n for n, _, _ in lake.log.files.walk() if n.startswith("data-") and n.partition("/")[0] not in {f.partition("/")[0] for f in lake.snapshot().files}]
    with lake.overwrite(new.schema) as session:
        session.stage(new)
        session.stage(new.withColumn("id", F.lit(8).cast("long")))
        session.commit()
    assert ids(lake.read()) == [7, 8] and lake.read().columns == ["id", "price"]
    assert lake.marks() == Marks()  # a plain refresh makes older marks void
    assert ids(lake.read(1)) == [1, 2]


def test_marks_look_back_so_far(spark, lake):
    lake.append(rows(spark, [(1, "a", None)]), Marks(Hwm("2024-01-01", 1)))
    lake.commit_marks(Marks(insert=9))
    assert lake.marks() == Marks(Hwm("2024-01-01", 1), 9)
    for _ in range(63):
        lake.log.commit(lake.snapshot().version + 1, [], "HOUSEKEEPING")
    assert lake.marks() == Marks(None, 9)


def test_a_long_log_is_summed_up(spark, tmp_path, monkeypatch):
    from tidewright.sources.lake_log import CommitLog

    monkeypatch.setattr(CommitLog, "SUMMARY_EVERY", 3)
    lake = LakeTable(spark, str(tmp_path / "t"))
    for i in range(7):
        lake.append(rows(spark, [(i, "x", None)]).coalesce(1))
    assert lake.replace(rows(spark, [(50, "x", None)])) and lake.replace(rows(spark, []).limit(0)) is None
    fresh, read = LakeTable(spark, lake.path), []
    plain = fresh.log.actions
    monkeypatch.setattr(fresh.log, "actions", lambda v: read.append(v) or plain(v))
    assert ids(fresh.read()) == [50] and min(read) > 3 and ids(fresh.read(2)) == [0, 1]
    before = len(read)
    fresh.snapshot()
    assert len(read) == before  # nothing new, nothing read
    lake.append(rows(spark, [(51, "x", None)]))
    assert ids(fresh.read()) == [50, 51]


def test_two_writers_of_one_version(spark, lake):
    lake.append(rows(spark, [(1, "a", None)]))
    v = lake.snapshot().version
    lake.log.commit(v + 1, [], "A")
    with pytest.raises(CommitConflict):
        lake.log.commit(v + 1, [], "B")


@pytest.mark.parametrize("merge", [False, True])
def test_upsert(spark, lake, merge):
    lake.append(rows(spark, [(1, "a", "2024-01-01"), (None, "null key", None)]))
    lake.append(rows(spark, [(2, "b", "2024-01-01")]))
    before = set(lake.snapshot().files)
    new = rows(spark, [(1, "old", "2024-01-02"), (1, "new", "2024-01-03"), (3, "c", "2024-01-03")]).withColumn("extra", F.lit("x"))
    lake.upsert(new, "id", "at", Marks(Hwm("2024-01-03", 3), 3), merge)
    got = {r.id: (r.name, r.extra) for r in lake.read().collect()}
    assert got == {None: ("null key", None), 1: ("new", "x"), 2: ("b", None), 3: ("c", "x")} and lake.row_count() == 4
    assert lake.marks() == Marks(Hwm("2024-01-03", 3), 3)
    if not merge:
        assert len(before & set(lake.snapshot().files)) >= 1  # the file without a matched key stays
    with pytest.raises(ValueError, match="null id"):
        lake.upsert(rows(spark, [(None, "x", None)]), "id", "at", merge=merge)


def test_both_upserts_agree(spark):
    target = rows(spark, [(i, str(i), None) for i in range(20)])
    new = rows(spark, [(i, "n", None) for i in range(15, 30)])
    a, b = U.upsert_by_replacement(target, new, "id"), U.upsert_by_merge(target, new, "id")
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_vacuum(spark, lake):
    lake.append(rows(spark, [(1, "a", None)]))
    with lake.overwrite(lake.schema()) as s:
        s.stage(rows(spark, [(2, "b", None)]))
        s.commit()
    lake.stage(rows(spark, [(3, "orphan", None)]))
    later = time.time() + 200 * 3600
    with pytest.raises(ValueError, match="force"):
        lake.vacuum(hours=1)
    assert lake.vacuum().files == []
    lite, full = lake.vacuum(now=later), lake.vacuum(now=later, full=True)
    assert lite.files and len(full.files) > len(lite.files) and not lite.applied and lite.files_present == len(lite.files) and lite.bytes > 0
    done = lake.vacuum(True, now=later, full=True)
    assert done.applied and ids(lake.read()) == [2] and lake.vacuum(now=later, full=True).files_present == 0


class Rows(ParquetCatalog):
    """A source whose rows a test sets."""

    def __init__(self, spark, df, not_null=("at",)):
        super().__init__(spark, "", {"t": ["id"]}, {"t": list(not_null)})
        self.df = df

    def read(self, table):
        return self.df

    def average_row_bytes(self, table):
        return None


def config(tmp_path, **more):
    return C.Config("parquet:", ["t"], str(tmp_path), 64, 64, **more)


DAY = [(i, f"n{i}", f"2024-01-{1 + i // 3:02d}") for i in range(12)]  # three rows of each time


def test_incremental_runs(spark, tmp_path):
    cfg = config(tmp_path, timestamps={"t": "at"}, default_batch_size=2)  # a window smaller than the rows of one time
    source = Rows(spark, rows(spark, DAY[:7]))
    assert M.run_table(spark, source, cfg, "t") == ("incremental", 7)
    assert M.run_table(spark, source, cfg, "t") == ("incremental", 0)
    source.df = rows(spark, [*DAY, (99, "late", "2023-01-01")])
    assert M.run_table(spark, source, cfg, "t") == ("incremental", 5)  # what is before the watermark is not taken
    lake = LakeTable(spark, str(tmp_path / "t"))
    assert ids(lake.read()) == list(range(12)) and lake.marks().update == Hwm("2024-01-04T00:00:00.000000", 11)
    source.df = rows(spark, [*DAY, (12, "x", "2024-02-01")]).withColumn("more", F.lit(1))
    M.run_table(spark, source, cfg, "t")
    assert lake.read().where("id = 12").first().more == 1 and lake.read().where("id = 1").first().more is None
    source.df = rows(spark, DAY).drop("name")
    with pytest.raises(ValueError, match="name is gone"):
        M.run_table(spark, source, cfg, "t")


def test_incremental_refuses_to_start_over(spark, tmp_path):
    lake = LakeTable(spark, str(tmp_path / "t"))
    lake.append(rows(spark, DAY[:2]))
    source = Rows(spark, rows(spark, DAY))
    with pytest.raises(RuntimeError, match="no watermark"):
        M.run_table(spark, source, config(tmp_path, timestamps={"t": "at"}), "t")
    M.run_table(spark, source, config(tmp_path, timestamps={"t": "at"}, initial_hwm={"t": ("2024-01-01 00:00:00", 1)}), "t")
    assert ids(lake.read()) == list(range(12))


def test_null_cursors_are_left_out(spark, tmp_path):
    source = Rows(spark, rows(spark, [*DAY[:3], (50, "null", None)]), not_null=())
    assert M.run_table(spark, source, config(tmp_path, timestamps={"t": "at"}, modes={"t": "incremental"}), "t")[1] == 3


def test_full_refresh(spark, tmp_path):
    source, cfg = Rows(spark, rows(spark, DAY)), config(tmp_path, modes={"t": "full_refresh"})
    assert M.run_table(spark, source, cfg, "t") == ("full_refresh", 12)
    source.df = rows(spark, DAY[:2]).drop("name").withColumn("id", F.col("id").cast("int"))
    M.run_table(spark, source, cfg, "t")
    lake = LakeTable(spark, str(tmp_path / "t"))
    assert ids(lake.read()) == [0, 1] and lake.read().columns == ["id", "at"]
    source.df = source.df.limit(0)
    assert M.run_table(spark, source, cfg, "t")[1] == 0 and ids(lake.read()) == [0, 1]  # an empty source leaves it
    source.df = rows(spark, DAY)
    job, _, _ = M.prepare(spark, source, cfg, "t", stop=lambda: True)
    assert M.run_full_refresh(job) == 0 and ids(lake.read()) == [0, 1]


def test_two_streams(spark, tmp_path):
    cfg = config(tmp_path, insert_cursors={"t": "id"}, update_cursors={"t": "at"}, default_batch_size=5)
    source = Rows(spark, rows(spark, []).limit(0))
    assert M.run_table(spark, source, cfg, "t") == ("two_stream", 0)
    source.df = rows(spark, DAY)
    lake = LakeTable(spark, str(tmp_path / "t"))
    M.run_table(spark, source, cfg, "t")
    assert ids(lake.read()) == list(range(12)) and lake.marks().insert == 11
    changed = [(i, "new" if i == 4 else n, "2024-03-01" if i == 4 else t) for i, n, t in DAY]
    source.df = rows(spark, [*changed, (12, "n12", "2024-03-02")])
    M.run_table(spark, source, cfg, "t")
    assert lake.row_count() == 13 and lake.read().where("id = 4").first().name == "new"
    assert M.run_table(spark, source, cfg, "t")[1] == 0
    source.df = source.df.where("id <> 3")
    again = C.Config("parquet:", ["t"], str(tmp_path), 64, 64, insert_cursors={"t": "id"}, update_cursors={"t": "at"}, reconcile=frozenset({"t"}))
    M.run_table(spark, source, again, "t")
    assert 3 not in ids(lake.read()) and lake.marks() == Marks(Hwm("2024-03-02 00:00:00.000000", MAX_LONG), 12)


def test_a_seed_is_kept_though_nothing_came(spark, tmp_path):
    source = Rows(spark, rows(spark, DAY))
    cfg = config(tmp_path, insert_cursors={"t": "id"}, update_cursors={"t": "at"}, initial_hwm={"t": ("2024-02-01 00:00:00", 100)})
    assert M.run_table(spark, source, cfg, "t")[1] == 0
    assert LakeTable(spark, str(tmp_path / "t")).marks() == Marks(Hwm("2024-02-01 00:00:00", MAX_LONG), 100)


def test_verification(spark, tmp_path):
    lake, said = LakeTable(spark, str(tmp_path / "t")), []
    lake.append(rows(spark, DAY))
    source = Rows(spark, rows(spark, DAY))
    check = lambda mode="full_refresh", **k: Verifier(source, lambda _: lake, say=said.append, **k).run([Plan("t", mode, "at", hwm=Hwm("2024-01-04 00:00:00", 11) if mode == "incremental" else None)])[0].verdict
    assert check() == PASS and any("sample" in s for s in said)
    assert check(row_cap=3) == SKIPPED and check(row_cap=3, deep=True) == PASS
    source.df = rows(spark, [*DAY, (50, "x", "2024-01-01")])
    assert check() == DISCREPANCY or check() == DRIFT
    source.df = rows(spark, [(i, "same length"[: len(n)] if i == 3 else n, t) for i, n, t in DAY])
    assert check() == PASS  # of texts only the mass is compared
    source.df = rows(spark, [(i, None if i == 3 else n, t) for i, n, t in DAY])
    assert check() == DISCREPANCY
    source.df = rows(spark, [(i, n, "2025-01-01" if i == 2 else t) for i, n, t in DAY])
    assert check("incremental") == DRIFT  # changed beyond the watermark since
    source.df = rows(spark, DAY).drop("id")
    assert check() == PARTIAL
    source.df = rows(spark, DAY).withColumn("new", F.lit(1))
    assert check() == DISCREPANCY
    assert plan_for(source, lake, config(tmp_path, timestamps={"t": "gone"}), "t") == Plan("t")


def test_scoped_verification_takes_the_latest_version(spark, tmp_path):
    cfg = config(tmp_path, timestamps={"t": "at"})
    source = Rows(spark, rows(spark, DAY))
    M.run_table(spark, source, cfg, "t")
    source.df = rows(spark, [(i, "changed" if i == 1 else n, "2024-02-01" if i == 1 else t) for i, n, t in DAY])
    M.run_table(spark, source, cfg, "t")  # the lake has two versions of 1 now
    lake = LakeTable(spark, str(tmp_path / "t"))
    assert lake.row_count() == 13
    assert Verifier(source, lambda _: lake, say=lambda _: None).run([plan_for(source, lake, cfg, "t")])[0].verdict == PASS


def test_wide_numbers_and_unsigned_keys(spark):
    big = ["9" * 50, "-" + "9" * 49, "5", None, "garbage", "-12.5"]
    df = spark.createDataFrame([(x,) for x in big], "w string")
    spec = [P.ColumnAgg("w", "decimal", 2)]
    v = P.agg_values(P.value_aggregates(df, spec).first(), spec)[0]
    assert v.sum == f"{int('9' * 50) - int('9' * 49) + 5 - 13}.50" and v.min == "-" + "9" * 49 and v.max == "9" * 50 and v.count == 5
    keys = spark.createDataFrame([(Decimal(7),), (Decimal(2**64 - 1),), (Decimal(2**64 - 1),)], "k decimal(20,0)")
    s = P.key_stats_value(P.key_stats(keys, "k").first())
    assert (s.count, s.distinct, s.min, s.max, s.sum) == (3, 2, 7, 2**64 - 1, 2**64 + 6) and s.distinct_xor == ~7 and s.xor == 7
    assert P.key_stats_value(P.key_stats(keys.limit(0), "k").first()) == P.KeyStats(0, 0, None, None, 0, 0, 0)


def test_hwm_of_a_batch(spark):
    df = rows(spark, [(1, "", "2024-01-01"), (5, "", "2024-01-02"), (3, "", "2024-01-02"), (9, "", None)])
    r = W.batch_hwm(df, "at", "id").first()
    assert (r.hwm_updated_at, r.hwm_last_id) == ("2024-01-02T00:00:00.000000", 5)
    r = W.batch_hwm(df.union(rows(spark, [(None, "", "2024-01-01")])), "at", "id").first()
    assert r.hwm_updated_at is None


def test_plans_stay_what_they_should_be(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = W.cursor_window(orders, ["o_orderkey"], "o_orderdate", "o_orderkey", Hwm("1998-01-01", 5), 10)._jdf.queryExecution().toString()
    assert "TakeOrderedAndProject" in plan and "o_comment" not in plan and "PushedFilters: [IsNotNull(o_orderdate)" in plan
    anti = U.survivors(orders, orders.limit(3), "o_orderkey", 3)._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in anti and "LeftAnti" in anti and "BroadcastNestedLoop" not in anti


def test_what_spark_reads_itself_comes_in_one_commit(spark, tmp_path):
    """No top-n over all that is left, and each commit lists its own folder alone."""
    (tmp_path / "src").mkdir()
    rows(spark, DAY).write.parquet(str(tmp_path / "src/t.parquet"))
    source = ParquetCatalog(spark, str(tmp_path / "src"), {"t": ["id"]}, {"t": ["at"]})
    cfg = config(tmp_path / "lake", timestamps={"t": "at"}, default_batch_size=2)
    job, ts, _ = M.prepare(spark, source, cfg, "t")
    plan = job.cursor_rows(ts, "id", None)._jdf.queryExecution().toString()
    assert job.rows is None and "TakeOrdered" not in plan and "Sort" not in plan
    assert M.run_incremental(job, ts, "id") == 12 and job.lake.snapshot().version == 1
    folder = next(iter(job.lake.snapshot().files)).partition("/")[0]
    assert {n.partition("/")[0] for n, _, _ in job.lake.log.files.walk(folder)} == {folder}


def test_windows_fit_the_rows(spark, tmp_path):
    job = M.Job(spark, None, None, config(tmp_path), "t", [], [], [], 100, row_bytes=10)
    wide = spark.createDataFrame([(1, "x" * 1000), (2, None)], "id long, v string")
    assert M.measured_row_bytes(wide) == 1008
    job.resize(wide)
    assert job.rows == job.config.target_memory_mb * (1 << 20) // 1008 and job.row_bytes == 1008
    job.resize(wide)
    assert job.rows == job.config.target_memory_mb * (1 << 20) // 1008


def test_jdbc_source(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    c = spark._jvm.java.sql.DriverManager.getConnection(url)
    s = c.createStatement()
    s.execute('CREATE TABLE "t" ("id" BIGINT NOT NULL PRIMARY KEY, "name" VARCHAR(20), "at" TIMESTAMP NOT NULL, "d" DECIMAL(10,2))')
    s.execute('CREATE INDEX "ia" ON "t" ("at", "id")')
    for i, n, t in DAY:
        s.execute(f"INSERT INTO \"t\" VALUES ({i}, '{n}', TIMESTAMP('{t} 00:00:00'), {i}.25)")
    s.close()
    c.close()
    source = JdbcCatalog(spark, url)
    assert [(x.name, x.data_type, x.nullable) for x in source.columns("t")] == [("id", "bigint", False), ("name", "varchar", True), ("at", "timestamp", False), ("d", "decimal", True)]
    assert [(i.name, i.columns) for i in source.indexes("t")][0] == ("PRIMARY", ("id",)) and ("at", "id") in [i.columns for i in source.indexes("t")]
    with pytest.raises(SourceTableMissing):
        source.columns("nowhere")
    assert source.read("t", ("id", 0, 12, 3)).count() == 12
    split = source.read_by_key("t", "id", 4)
    assert split.rdd.getNumPartitions() == 4 and ids(split) == list(range(12)) and source.read_by_key("t", "id", 1).rdd.getNumPartitions() == 1
    whole = config(tmp_path / "whole", modes={"t": "full_refresh"}, read_connections=4)
    assert M.run_table(spark, source, whole, "t") == ("full_refresh", 12) and len(LakeTable(spark, str(tmp_path / "whole/t")).snapshot().files) == 4
    cfg = config(tmp_path / "lake", timestamps={"t": "at"}, default_batch_size=5)
    assert M.run_table(spark, source, cfg, "t") == ("incremental", 12)
    assert ids(LakeTable(spark, str(tmp_path / "lake/t")).read()) == list(range(12))


def test_stream(spark, tmp_path):
    lake = LakeTable(spark, str(tmp_path / "t"))
    rows(spark, DAY[:6]).write.parquet(str(tmp_path / "in"))
    run = lambda ck: append_stream(spark.readStream.schema(rows(spark, DAY).schema).parquet(str(tmp_path / "in")), lake, "at", "id", str(tmp_path / ck), "s").awaitTermination(120)
    run("ck")
    rows(spark, DAY[6:]).write.mode("append").parquet(str(tmp_path / "in"))
    run("ck")
    assert ids(lake.read()) == list(range(12)) and lake.marks().update == Hwm("2024-01-04T00:00:00.000000", 11)
    n = lake.snapshot().version
    run("ck")
    assert lake.snapshot().version == n


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "src").mkdir()
    rows(spark, DAY).withColumnRenamed("at", "updated_at").write.parquet(str(tmp_path / "src/t.parquet"))
    env = {"DATABASE_URL": f"parquet:{tmp_path}/src", "TABLES": "t", "TARGET_MEMORY_MB": "64", "TABLE_MODE_t": "full_refresh"}
    go = lambda *a: cli.main([*a, "--local", str(tmp_path / "lake")], env, spark)
    assert go("--check") == 0 and not LakeTable(spark, str(tmp_path / "lake/t")).exists()
    cfg = C.load(env, str(tmp_path / "lake"))
    state = cli.State(str(tmp_path / "state.json"))
    assert cli.run(spark, cli.catalog(spark, cfg.database_url), cfg, state) == 0 and state.tables["t"]["last_run_rows"] == 12
    assert go("--verify") == 0 and go("--vacuum") == 0
    assert cli.main(["--inspect", "t"], env, spark) == 0 and "full_refresh" in capsys.readouterr().out
    assert cli.main(["--check"], {}, spark) == 2
    bad = C.load({**env, "TABLES": "t,nowhere"}, str(tmp_path / "lake"))
    assert cli.run(spark, cli.catalog(spark, bad.database_url), bad, state) == 1 and state.tables["nowhere"]["last_run_status"] == "failed"
    assert cli.run(spark, cli.catalog(spark, cfg.database_url), cfg, state, stop=lambda: True) == 1
