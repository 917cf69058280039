"""Pure rules: types, cursors, decisions, verdicts, configuration."""

from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tidewright.functions import cursors as K
from tidewright.functions import fingerprint as P
from tidewright.functions import types as Y
from tidewright.plans import config as C
from tidewright.plans import decisions as D
from tidewright.plans import inspect as I  # noqa: E741
from tidewright.plans import verify as V
from tidewright.plans.preflight import key_reason, shown_hwm
from tidewright.plans.state import State

ID = Y.ColumnInfo("id", "bigint", "bigint(20)", False)
AT = Y.ColumnInfo("updated_at", "timestamp", "timestamp", False)
LOOSE = Y.ColumnInfo("updated_at", "timestamp", "timestamp", True)
PK = [Y.IndexInfo("PRIMARY", True, ("id",))]


@pytest.mark.parametrize(("kind", "declared", "want"), [("tinyint", "tinyint(4)", T.ByteType()), ("tinyint", "tinyint(3) unsigned", T.ShortType()), ("smallint", "smallint unsigned", T.IntegerType()), ("mediumint", "mediumint unsigned", T.IntegerType()), ("int", "int(11)", T.IntegerType()), ("int", "int unsigned", T.LongType()), ("bigint", "bigint unsigned", T.LongType()), ("decimal", "decimal(18,2)", T.DecimalType(18, 2)), ("decimal", "decimal(50,0)", T.StringType()), ("datetime", "datetime(6)", T.TimestampNTZType()), ("date", "date", T.DateType()), ("bool", "tinyint(1)", T.ByteType()), ("json", "longtext", T.StringType()), ("varbinary", "varbinary(8)", T.BinaryType())])
def test_types(kind, declared, want):
    assert Y.spark_type(kind, declared) == want
    assert kind in Y.EXTRACTABLE


def test_types_that_are_not_taken():
    columns = [ID, Y.ColumnInfo("t", "TIME"), Y.ColumnInfo("y", "year"), Y.ColumnInfo("x", "VARCHAR", "varchar(9)")]
    assert [c.name for c in Y.extractable(columns)] == ["id", "x"]
    with pytest.raises(ValueError, match="geometry"):
        Y.spark_type("geometry")
    assert all(Y.spark_type(k, k, compat=True) is not None for k in Y.EXTRACTABLE)


def test_evolution():
    lake = Y.lake_schema([ID, AT])
    assert Y.evolved_columns([ID, AT, Y.ColumnInfo("new", "int", "int")], lake) == ["id", "updated_at", "new"]
    assert Y.evolved_columns([ID, AT, Y.ColumnInfo("new", "time", "time")], lake) == ["id", "updated_at"]
    with pytest.raises(ValueError, match="updated_at is gone"):
        Y.evolved_columns([ID], lake)
    with pytest.raises(ValueError, match="changed its type"):
        Y.evolved_columns([Y.ColumnInfo("id", "varchar", "varchar(5)"), AT], lake)
    assert Y.same_type(T.IntegerType(), T.ByteType()) and not Y.same_type(T.LongType(), T.IntegerType())


def test_times_in_either_form():
    assert K.parse_time("2024-01-02T03:04:05.5") == K.parse_time("2024-01-02 03:04:05.500000") == datetime(2024, 1, 2, 3, 4, 5, 500000)
    assert K.parse_time("2024-01-02") == datetime(2024, 1, 2)
    assert K.parse_time("no time") is None and K.parse_time("2024-13-02") is None
    assert K.Hwm("2024-01-02T00:00:00.000001", 1).after(K.Hwm("2024-01-02 00:00:00", 9))
    assert not K.Hwm("2024-01-02T00:00:00", 9).after(K.Hwm("2024-01-02 00:00:00.000", 9))
    assert K.Hwm("x", 2).after(K.Hwm("x", 1)) and K.Hwm("2024-01-01", 0).after(None)


@given(st.datetimes(min_value=datetime(1900, 1, 1)), st.datetimes(min_value=datetime(1900, 1, 1)), st.integers(0, 9), st.integers(0, 9))
def test_watermarks_order_as_pairs(a, b, i, j):
    assert K.Hwm(a.isoformat(), i).after(K.Hwm(b.isoformat(sep=" "), j)) == ((a, i) > (b, j))


def test_sql_text():
    sql = K.window_sql("or`ders", ["id", "a`b"], "at", "id", K.Hwm("2024-01-01 o'clock", 7), 10, 99)
    assert sql == "SELECT `id`, `a``b` FROM `or``ders` WHERE `at` IS NOT NULL AND ((`at` = '2024-01-01 o''clock' AND `id` > 7) OR `at` > '2024-01-01 o''clock') AND `id` <= 99 ORDER BY `at`, `id` LIMIT 10"
    assert K.keyset_sql("t", ["id"], "id", None, 5) == "SELECT `id` FROM `t` ORDER BY `id` LIMIT 5"
    assert K.offset_sql("t", ["a", "b"], [("a", True), ("b", False)], 5, 10) == "SELECT `a`, `b` FROM `t` ORDER BY BINARY `a`, `b` LIMIT 5 OFFSET 10"
    assert "FETCH FIRST 5 ROWS ONLY" in K.keyset_sql("t", ["id"], "id", 3, 5, K.DERBY)


def test_modes():
    assert D.detect_timestamp([ID, LOOSE, Y.ColumnInfo("created_at", "datetime", "", False)]) == "created_at"
    assert D.detect_mode([ID, AT], None, "updated_at", True) == C.INCREMENTAL
    assert D.detect_mode([ID, LOOSE], None, "updated_at", True) == C.FULL_REFRESH
    assert D.detect_mode([ID, AT], "auto", "updated_at", False) == C.FULL_REFRESH
    assert D.detect_mode([ID, LOOSE], C.INCREMENTAL, "updated_at", False) == C.INCREMENTAL
    assert D.integer_key([ID], PK) == "id" and D.integer_key([ID], [Y.IndexInfo("PRIMARY", True, ("id", "b"))]) is None
    cfg = C.Config("parquet:", ["t"], "", 1, 1, insert_cursors={"t": "id"})
    with pytest.raises(ValueError, match="both"):
        D.resolve([ID, AT], PK, cfg, "t")
    cfg = C.Config("parquet:", ["t"], "", 1, 1, insert_cursors={"t": "id"}, update_cursors={"t": "updated_at"}, timestamps={"t": "nowhere"})
    assert D.resolve([ID, AT], PK, cfg, "t") == ("nowhere", C.TWO_STREAM)
    with pytest.raises(ValueError, match="nowhere"):
        D.resolve([ID, AT], PK, C.Config("parquet:", ["t"], "", 1, 1, timestamps={"t": "nowhere"}), "t")


def test_paging_and_windows():
    text, num = Y.ColumnInfo("a", "varchar", "", True), Y.ColumnInfo("b", "int", "", False)
    assert D.paging_order(["a", "b"], [text, num], [Y.IndexInfo("u", True, ("b",))]) == [("b", False)]
    assert D.paging_order(["a", "b"], [text, num], [Y.IndexInfo("u", True, ("a",))]) == [("a", True), ("b", False)]
    assert D.window_rows(1, 1024) == 1024 and D.window_rows(1, None) == D.DEFAULT_BATCH and D.window_rows(1, 1 << 30) == 1
    assert D.resized(100, 1, 10, 15) == 100 and D.resized(100, 1, 10, 1024) == 1024 and D.resized(100, 1, None, 9) == 100
    assert [D.run_exit_code(*x) for x in ((2, 0), (1, 1), (0, 2), (2, 0, True))] == [0, 1, 2, 1]


def stats(count, distinct, low, high, xor=0, total=0):
    return P.KeyStats(count, distinct, low, high, xor, xor, total)


def test_key_verdicts():
    same = stats(5, 5, 1, 5, 3, 15)
    assert V.keys_outcome(same, same).verdict == V.PASS
    assert V.keys_outcome(same, stats(9, 5, 1, 5, 3, 15)).verdict == V.PASS
    assert V.keys_outcome(same, stats(4, 4, 1, 4)).verdict == V.DRIFT
    assert V.keys_outcome(same, stats(0, 0, None, None)).verdict == V.DRIFT
    assert V.keys_outcome(same, stats(4, 4, 1, 6)).verdict == V.DISCREPANCY
    assert V.keys_outcome(same, stats(6, 6, 1, 5)).verdict == V.DISCREPANCY
    assert V.scoped_keys_outcome(same, stats(6, 6, 1, 5)).verdict == V.DRIFT
    assert V.scoped_keys_outcome(same, stats(6, 6, 0, 5)).verdict == V.DISCREPANCY
    assert V.scoped_keys_outcome(same, stats(5, 5, 1, 5, 3, 16)).verdict == V.DISCREPANCY


def test_two_stream_verdicts():
    source = stats(5, 5, 1, 5, 3, 15)
    assert V.two_stream_outcome(source, source).verdict == V.PASS
    assert V.two_stream_outcome(source, stats(7, 6, 1, 6)).verdict == V.DISCREPANCY
    assert V.two_stream_outcome(source, stats(6, 6, 0, 5)).verdict == V.DRIFT
    assert V.two_stream_outcome(source, stats(6, 6, 2, 9)).verdict == V.DISCREPANCY
    assert V.two_stream_outcome(source, stats(4, 4, 1, 5)).verdict == V.DISCREPANCY


def test_string_key_verdicts_and_exit_codes():
    a = P.StringKeyStats(3, 3, "a", "c")
    assert V.string_keys_outcome(a, a).verdict == V.PASS
    assert V.string_keys_outcome(a, P.StringKeyStats(2, 2, "a", "b")).verdict == V.DRIFT
    assert V.string_keys_outcome(a, P.StringKeyStats(2, 2, "A", "b")).verdict == V.DISCREPANCY
    o = lambda *k: [V.Outcome(x) for x in k]
    assert V.fold(o(V.PASS, V.DRIFT, V.SKIPPED)) == 0 and V.fold(o(V.PARTIAL, V.PASS)) == 3 and V.fold(o(V.PARTIAL, V.DISCREPANCY)) == 1
    assert V.fold([V.Outcome(V.SKIPPED, "probe error: x")], strict=True) == 2


def test_fingerprint_texts():
    specs = [P.ColumnAgg("i", "integer"), P.ColumnAgg("d", "decimal", 2), P.ColumnAgg("t", "text"), P.ColumnAgg("s", "seconds")]
    values = [P.AggValues("6", "1", "3", 3), P.AggValues("1.5", "0.5", "1", 2), P.AggValues(None, None, None, 0), P.AggValues(None, None, None, 0)]
    pairs = P.fingerprints(specs, values, values)
    assert pairs[0][0] == "sum=6|min=1|max=3|n=3" and pairs[1][0] == "sum=1.50|min=0.50|max=1.00|n=2" and pairs[2][0] == "len=0|n=0" and pairs[3][0] == "min=∅|max=∅|n=0"
    wide = P.AggValues("1", "1", "9" * 64, 10)
    assert P.sum_may_overflow(specs[0], wide) and not P.sum_may_overflow(specs[0], P.AggValues("1", "1", "9" * 63, 10))
    assert P.fingerprints(specs[:1], [wide], [P.AggValues("2", "1", "9" * 64, 10)])[0][0].startswith("sum=skipped|")


@given(st.lists(st.integers(-(10**60), 10**60), min_size=1, max_size=20), st.integers(0, 6))
def test_limbs(numbers, scale):
    sums = [0] * P.LIMBS
    for n in numbers:
        digits = f"{abs(n):0{P.LIMB * P.LIMBS}d}"
        for i in range(P.LIMBS):
            sums[i] += (1 if n >= 0 else -1) * int(digits[i * P.LIMB : (i + 1) * P.LIMB])
    text = P.limbs_value(sums, scale)
    assert int(text.replace(".", "")) == sum(numbers)


ENV = {"DATABASE_URL": "mysql://u:hunter2@h/db", "S3_BUCKET": "b", "S3_ACCESS_KEY_ID": "k", "S3_SECRET_ACCESS_KEY": "s", "TABLES": "a, b,", "TARGET_MEMORY_MB": "64"}


def test_config():
    c = C.load(ENV, memory_mb=1000)
    assert c.tables == ["a", "b"] and c.merge_memory_mb == 64 and c.root == "s3a://b/lake" and c.default_batch_size == 10_000
    assert "hunter2" not in repr(c) and "'s'" not in repr(c)
    assert C.load({k: v for k, v in ENV.items() if not k.startswith("S3")}, local="/x", memory_mb=1000).root == "/x"


@pytest.mark.parametrize("more", [{"TABLES": " ,"}, {"TABLES": ""}, {"DATABASE_URL": "postgres://x"}, {"TARGET_MEMORY_MB": "0"}, {"TARGET_MEMORY_MB": "x"}, {"TARGET_MEMORY_MB": "2000"}, {"MERGE_MEMORY_MB": "2000"}, {"UPDATE_STRATEGY": "delete_append"}, {"MERGE_TARGET_PARTITIONS": "0"}, {"DEFAULT_BATCH_SIZE": "-1"}, {"TABLE_MODE_a": "two_stream"}, {"TABLE_MODE_a": "sideways"}, {"TABLE_HWM_a": "2024-01-01"}, {"TABLE_HWM_a": ",5"}, {"TABLE_HWM_a": "2024-01-01,x"}, {"TABLE_RECONCILE_a": "yes"}, {"TABLE_RECONCILE_a": "true"}, {"TABLE_INSERT_CURSOR_a": "id", "TABLE_UPDATE_CURSOR_a": "u", "TABLE_MODE_a": "incremental"}])
def test_config_errors(more):
    with pytest.raises(C.ConfigError):
        C.load({**ENV, **more}, memory_mb=1000)


def test_config_per_table():
    c = C.load({**ENV, "TABLE_MODE_a": " Incremental ", "TABLE_HWM_a": "2024-01-01 00:00:00, 7", "TABLE_INSERT_CURSOR_b": "id", "TABLE_UPDATE_CURSOR_b": "u", "TABLE_RECONCILE_b": "TRUE", "UPDATE_STRATEGY": "merge"}, memory_mb=1000)
    assert c.modes == {"a": "incremental"} and c.initial_hwm == {"a": ("2024-01-01 00:00:00", 7)} and c.two_stream("b") == ("id", "u") and c.reconcile == {"b"} and c.update_strategy == "merge"


def test_env_file(tmp_path):
    (tmp_path / "e").write_text("# a comment\nTABLES='x,y'\nexport TARGET_MEMORY_MB = 9\nbroken\n")
    assert C.with_env_file({"TABLES": "z"}, str(tmp_path / "e")) == {"TABLES": "z", "TARGET_MEMORY_MB": "9"}
    assert C.with_env_file({}, str(tmp_path / "none")) == {}


def test_inspection():
    cols = [ID, Y.ColumnInfo("a", "datetime", "", False), Y.ColumnInfo("b", "datetime", "", True)]
    report = I.evaluate("t", cols, [*PK, Y.IndexInfo("i", False, ("x", "a"))], "b")
    assert [c.verdict for c in report.candidates] == [I.OK, I.UNSAFE] and "TABLE_TIMESTAMP_t=a" in report.recommendation and "b may be null" in report.recommendation
    assert "full_refresh" in I.evaluate("t", cols[1:], []).recommendation and "full_refresh" in I.evaluate("t", [ID, cols[2]], PK).recommendation
    assert "[configured]" in I.render("t", report) and "PRIMARY" in I.render("t", report)


def test_preflight_words():
    cfg = C.Config("parquet:", ["t"], "", 1, 1)
    assert key_reason([ID, AT], PK, cfg, "t", "updated_at", C.INCREMENTAL) == "id, updated_at"
    assert key_reason([ID, LOOSE], PK, cfg, "t", "updated_at", C.FULL_REFRESH) == "nullable updated_at (unsafe cursor)"
    assert key_reason([AT], [], cfg, "t", "updated_at", C.FULL_REFRESH) == "no id" and key_reason([ID], [], cfg, "t", "updated_at", C.FULL_REFRESH) == "no id/updated_at"
    assert shown_hwm(C.TWO_STREAM, K.Hwm("x", 3), 9) == "ins=9 upd=x page=3" and shown_hwm(C.TWO_STREAM, None, None) == "ins=— upd=— page=—" and shown_hwm(C.INCREMENTAL, None, None) == "—"


def test_state(tmp_path):
    path = str(tmp_path / "s.json")
    s = State(path)
    s.update("t", "success", "incremental", 5, 1.5)
    s.update("t", "failed", error="boom")
    again = State(path).tables["t"]
    assert again["last_run_status"] == "failed" and again["last_run_rows"] == 5 and again["error"] == "boom"
    (tmp_path / "s.json").write_text("{broken")
    assert State(path).tables == {}
