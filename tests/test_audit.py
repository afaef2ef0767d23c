from datetime import datetime, timedelta

import pytest

from faultline.operators import audit
from faultline.plans import jobs
from faultline.sources import tables
from pyspark.sql import functions as F

NOW = datetime(2025, 1, 1, 12, 0)


def timed(spark, minutes, column="processed_at"):
    return spark.createDataFrame([(NOW - timedelta(minutes=m),) for m in minutes], f"{column} timestamp")


@pytest.fixture
def base(spark, tmp_path):
    frames = {
        "fresh": timed(spark, [1, 9, 30]), "stale": timed(spark, [10, 11]), "empty": timed(spark, []),
        "proximity": timed(spark, [2], "analysis_time"), "plain": spark.range(3),
    }
    for name, df in frames.items():
        tables.write_table(df, str(tmp_path / name))
    return tmp_path


def test_audit(spark, base):
    names = ["fresh", "stale", "empty", "proximity", "plain", "missing"]
    rows, ok = jobs.check_tables(spark, {n: str(base / n) for n in names}, NOW)
    got = {r.name: (r.total, r.recent, r.status) for r in rows.collect()}
    assert got == {
        "fresh": (3, 2, "OK"), "stale": (2, 0, "WARN"), "empty": (0, 0, "FAILED"),
        "proximity": (1, 1, "OK"), "plain": (3, None, "OK"), "missing": (None, None, "FAILED"),
    }
    assert not ok
    assert jobs.check_tables(spark, {n: str(base / n) for n in ("fresh", "stale", "plain")}, NOW)[1]


def test_unreadable_table_fails_alone(spark, base):
    (base / "broken").mkdir()
    (base / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    rows = audit.audit_tables(spark, {n: str(base / n) for n in ("broken", "fresh")}, NOW).collect()
    assert [r.status for r in rows] == ["FAILED", "OK"] and rows[0].note.startswith("unreadable")


def test_latest_rows(spark, base):
    got = audit.latest_rows(tables.read_table(spark, str(base / "fresh")), 2).collect()
    assert [r.processed_at for r in got] == [NOW - timedelta(minutes=m) for m in (1, 9)]
    got = audit.latest_rows(tables.read_table(spark, str(base / "proximity")))
    assert got.columns == ["analysis_time"]
    assert audit.latest_rows(spark.range(9), 4).count() == 4
    assert audit.sample_rows(spark.range(9)).count() == 5


def test_recent_count(spark):
    row = audit.recent_count(timed(spark, [1, 9, 10, 30]), "processed_at", now=NOW).first()
    assert (row.total, row.recent) == (4, 2)


def test_summary(spark, base):
    rows = {r.table: r for r in audit.table_summary(spark, str(base)).collect()}
    assert rows.keys() == {"fresh", "stale", "empty", "proximity", "plain"}
    for name, row in rows.items():
        files = list((base / name).glob("*.parquet"))
        assert row.files == len(files) and row.size_bytes == sum(f.stat().st_size for f in files)
        assert row.size_mb == round(row.size_bytes / 1024 / 1024, 2)
    counts = audit.table_rows(spark, {n: str(base / n) for n in rows}).collect()
    assert {r.table: r.rows for r in counts}["fresh"] == 3
    schema = audit.table_schema(tables.read_table(spark, str(base / "fresh")), "fresh").collect()
    assert [(r.column, r.type) for r in schema] == [("processed_at", "timestamp")]


def test_history(spark, tmp_path):
    path, log = str(tmp_path / "t"), str(tmp_path / "log")
    assert tables.table_history(spark, path, log=log).count() == 0
    for mode, n in (("append", 3), ("append", 4), ("overwrite", 5), ("append", 6)):
        tables.write_table(spark.range(n), path, mode, log=log)
    tables.write_table(spark.range(1).withColumn("x", F.lit("a")), path, replace_schema=True, log=log)
    tables.write_table(spark.range(2), str(tmp_path / "other"), log=log)
    got = [(r.version, r.operation, r.rows) for r in tables.table_history(spark, path, log=log).collect()]
    assert got == [(4, "overwrite", 1), (3, "append", 6), (2, "overwrite", 5)]
    assert tables.read_table(spark, path).columns == ["id", "x"]
