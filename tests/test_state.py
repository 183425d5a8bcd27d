import datetime as dt

from pyspark.sql import functions as F

from partload.operators import audit, retention, state
from partload.sources import jdbc

UNITS = "unit_key string, target_path string, row_count bigint"
STATE = "unit_key string, status string, records_read bigint, records_failed bigint"


def test_latest_event_wins_and_unkeyed_events_are_skipped(spark):
    rows = [
        ("j", "d", 1, "u1", "exported", 0, 0), ("j", "d", 3, "u1", "written", 7, 0),
        ("j", "d", 2, "u1", "exported", 5, 0), ("j", "d", 9, "", "written", 1, 0),
        ("j", "d", 9, None, "written", 1, 0), ("j", "e", 1, "u1", "exported", 0, 0),
    ]
    got = state.latest_state(spark.createDataFrame(rows, state.STATE_SCHEMA)).collect()
    assert {(r.processing_date, r.unit_key, r.status, r.records_read) for r in got} == {
        ("d", "u1", "written", 7), ("e", "u1", "exported", 0),
    }


def test_a_partition_with_one_unwritten_unit_is_loaded_as_a_whole(spark):
    units = spark.createDataFrame([("a:1", "p1", 1), ("b:1", "p1", 2), ("a:2", "p2", 3)], UNITS)
    known = spark.createDataFrame([("a:1", "written", 1, 0), ("a:2", "written", 3, 0), ("b:1", "exported", 0, 0)], STATE)
    pending = state.pending_units(units, known)
    assert {r.unit_key for r in pending.collect()} == {"a:1", "b:1"}
    reused = state.reused_units(units, known, pending).collect()
    assert [(r.unit_key, r.records_read) for r in reused] == [("a:2", 3)]
    assert state.paths_to_clear(units, known).isEmpty()


def test_state_table(spark, tmp_path):
    table = state.StateTable(spark, str(tmp_path / "state"))
    assert table.latest("my job/1", "2024-01-01").isEmpty() and table.events().isEmpty()
    units = spark.createDataFrame([("a:1", "p", 5)], UNITS)
    table.append("my job/1", "2024-01-01", units, "exported")
    table.append("my job/1", "2024-01-01", units, "written")
    table.append("other", "2024-01-01", units, "exported")
    (row,) = table.latest("my job/1", "2024-01-01").collect()
    assert (row.unit_key, row.status, row.records_read) == ("a:1", "written", 5)
    assert {r.job_name for r in table.events().collect()} == {"my job/1", "other"}
    folder = tmp_path / "state" / "job_name=other" / "processing_date=2024-01-01"
    (folder / "part-broken.json").write_text('{"seq": 1, "unit_key"\n')
    assert table.latest("other", "2024-01-01").count() == 1
    assert table.clear("my job/1", "2024-01-01") > 0
    assert table.latest("my job/1", "2024-01-01").isEmpty()
    assert table.latest("other", "2024-01-01").count() == 1


def plan(spark, days, *dates):
    parts = spark.createDataFrame([(d,) for d in dates], "partition_date date")
    return {r.partition_date: r.action for r in retention.retention_plan(parts, dt.date(2024, 1, 31), days).collect()}


def test_retention_boundary(spark):
    on, after = dt.date(2024, 1, 21), dt.date(2024, 1, 22)
    assert plan(spark, 10, on, after) == {on: "expired", after: "kept"}
    assert plan(spark, None, dt.date(1999, 1, 1)) == {dt.date(1999, 1, 1): "kept"}
    assert plan(spark, 0, dt.date(2024, 1, 31)) == {dt.date(2024, 1, 31): "expired"}


def test_failed_metadata_step_is_reported(spark, tmp_path):
    (tmp_path / "processing_date=2024-01-01").mkdir()
    (tmp_path / "processing_date=2024-01-01" / "x").write_text("x")
    day = dt.date(2024, 1, 1)
    row = retention.expire_one(spark, day, f"{tmp_path}/processing_date=2024-01-01", "no_such_table")
    assert row[3] == 1 and row[4] is False and "still registered" in row[5]
    rows = spark.createDataFrame([row], retention.EXPIRY_SCHEMA).withColumn("action", F.lit("expired"))
    assert retention.retention_summary(rows).first().had_errors


def test_alert_text(spark):
    rows = spark.createDataFrame(
        [("r1", "j", "d", 5, 4, "dq_mismatch", None), ("r2", "j", "d", 5, None, "failed", "x" * 150),
         ("r3", "j", "d", 5, 5, "success", None), ("r4", "j", "d", 5, 4, "dq_mismatch", "")],
        "run_id string, job_name string, processing_date string, source_row_count bigint, "
        "target_row_count bigint, status string, error_detail string",
    )
    got = {r.run_id: r.message for r in audit.alert_rows(rows).collect()}
    assert got == {
        "r1": "DQ_MISMATCH: j/d (source=5 target=4)",
        "r2": "FAILED: j/d (source=5 target=null) - " + "x" * 100,
        "r4": "DQ_MISMATCH: j/d (source=5 target=4)",
    }


def test_jdbc_statements():
    assert jdbc.select_statement("o", "t", ["a", 'q"x'], "1 = 1", {"a": "DOUBLE"}) == (
        'SELECT CAST("a" AS DOUBLE) AS "a", "q""x" FROM "o"."t" WHERE 1 = 1'
    )
    assert jdbc.select_statement("", "t", ["k"], distinct=True) == 'SELECT DISTINCT "k" FROM "t"'
    assert jdbc.count_statement("o", "t") == 'SELECT COUNT(*) AS "row_count" FROM "o"."t"'
    assert jdbc.predicate({"k": 7, "v": "it's", "n": None}) == '"k" = 7 AND "v" = \'it\'\'s\' AND "n" IS NULL'
    assert jdbc.predicate({}) == "1 = 1"
    assert "secret" not in repr(jdbc.JdbcSource("jdbc:x", properties={"password": "secret"}))
