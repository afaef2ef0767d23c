"""Accounted ingestion: outcomes, repeats over runs, late rows, merges, failures."""

import json
from datetime import datetime

import pytest
from conftest import run
from pyspark.sql import functions as F
from test_ingest import event, values

from faultline.operators.ingest import tag_events
from faultline.plans import jobs
from faultline.streaming import ledger


def at(unid, time, **more):
    return event(unid=unid, time=f"2025-01-01T{time}:00Z", **more)


def account(spark, root, messages, feed="quakes", late_after=None):
    values(spark, messages).coalesce(1).write.mode("append").text(f"{root}/in")
    source = {"fmt": "text", "path": f"{root}/in"}
    run(lambda now: jobs.account_feed(spark, feed, source, f"{root}/t", f"{root}/cp", late_after, now))
    found = ledger.Accounts(f"{root}/t")
    return {(r.outcome, r.reason): r.messages for r in found.totals(spark).collect()}, found


def unids(spark, found, name="accepted"):
    return sorted((r.unid, r.event_time.strftime("%H:%M")) for r in found.read(spark, name).collect())


def test_outcomes_over_runs(spark, tmp_path):
    first = [at("u1", "01:00"), at("u2", "02:00"), at("u1", "00:30"), "{", event(unid=None), event(lat=99.0)]
    totals, _ = account(spark, tmp_path, first)
    bad = {("rejected", "malformed_json"): 1, ("rejected", "missing_unid"): 1, ("rejected", "out_of_range"): 1}
    assert totals == {("accepted", ""): 2, ("repeat", ""): 1} | bad
    totals, found = account(spark, tmp_path, [at("u2", "02:00"), at("u3", "00:00"), at("u3", "00:00")])
    assert totals == {("accepted", ""): 3, ("repeat", ""): 3} | bad
    assert unids(spark, found) == [("u1", "00:30"), ("u2", "02:00"), ("u3", "00:00")]
    rows = found.read(spark, "accepted")
    assert {"processed_at", "processing_date", "arrived_at"} <= set(rows.columns)
    assert rows.filter(F.col("arrived_at").isNull()).count() == 0
    assert sorted(r.json_string for r in found.read(spark, "rejects").collect()) == sorted(first[3:])


def test_late_rows_are_kept(spark, tmp_path):
    how = {"late_after": "15 minutes"}
    account(spark, tmp_path, [at("u1", "00:00"), at("u2", "02:00")], **how)
    late = [at("u3", "01:44"), at("u1", "00:00"), at("u4", "01:45"), at("u2", "02:00"), event(unid="u5", time="bad")]
    totals, found = account(spark, tmp_path, late, **how)
    # a batch is measured by those before it, so the first has no late rows
    assert totals == {("accepted", ""): 4, ("repeat", ""): 1, ("late", ""): 2}
    assert unids(spark, found, "late") == [("u1", "00:00"), ("u3", "01:44")]
    assert {r.reason for r in found.read(spark, "late").collect()} == {"late"}


def test_stations(spark, tmp_path):
    good = {"region": "r", "latitude": 1, "longitude": 2, "create_at": "2031-03-05 10:11:12", "Station": "a"}
    rows = [good, good | {"Station": "b"}, good | {"latitude": None}, good | {"region": None}, good | {"create_at": None}, good | {"longitude": 200}]
    totals, found = account(spark, tmp_path, [*map(json.dumps, rows), "[", "x"], "stations")
    reasons = {"missing_coordinates": 1, "missing_region": 1, "missing_create_at": 1, "out_of_range": 1, "malformed_json": 2}
    assert totals == {("accepted", ""): 1, ("repeat", ""): 1} | {("rejected", k): n for k, n in reasons.items()}
    row = found.read(spark, "accepted").first()
    assert (row.Station, row.create_at_ts) == ("a", datetime(2031, 3, 5, 10, 11, 12)) and row.kafka_timestamp
    with pytest.raises(ValueError):
        jobs.account_feed(spark, "other", {"fmt": "text", "path": f"{tmp_path}/in"}, "x", "y")


def batches(spark, root, monkeypatch, feeds, late_after=None):
    """Runs the sink itself, batch by batch, so that a batch can be repeated."""
    sink = {}
    monkeypatch.setattr(ledger, "batch_stream", lambda tagged, write, *_: sink.setdefault("write", write))
    ledger.accounted(None, str(root), "", ["unid"], "event_time", ["event_time"], late_after)
    for n, messages in feeds:
        sink["write"](tag_events(values(spark, messages)), n)
    return sink["write"], ledger.Accounts(str(root))


def test_a_repeated_batch_changes_nothing(spark, tmp_path, monkeypatch):
    feeds = [(0, [at("u1", "00:00")]), (1, [at("u1", "00:00"), at("u2", "01:00")])]
    write, found = batches(spark, tmp_path, monkeypatch, feeds)
    before = unids(spark, found), sorted(found.totals(spark).collect())
    write(tag_events(values(spark, feeds[1][1])), 1)
    assert (unids(spark, found), sorted(found.totals(spark).collect())) == before
    assert before[0] == [("u1", "00:00"), ("u2", "01:00")]


def test_merges_and_forgets(spark, tmp_path, monkeypatch):
    """Keys are merged every few batches; with a limit on lateness old ones leave the ledger, and the bitmap stays as large."""
    monkeypatch.setattr(ledger, "MERGE_EVERY", 2)
    monkeypatch.setattr(ledger, "WORDS", 4)
    monkeypatch.setattr(ledger, "BUCKETS", 2)
    feeds = [(n, [at(f"u{n}", f"0{n}:00"), at("u0", "00:00"), at(f"v{n % 3}", f"0{n}:01")]) for n in range(6)]
    _, found = batches(spark, tmp_path / "all", monkeypatch, feeds)
    assert [u for u, _ in unids(spark, found)] == [f"u{n}" for n in range(6)] + ["v0", "v1", "v2"]
    assert ledger.Ledger(spark, found.at("ledger"), 6).bitmap().count() <= 8
    _, found = batches(spark, tmp_path / "some", monkeypatch, feeds, "90 minutes")
    assert ledger.Ledger(spark, found.at("ledger"), 6).newest() == datetime(2025, 1, 1, 5, 1)
    merged = spark.read.parquet(found.at("ledger/merged/upto=4"))
    assert merged.count() < spark.read.parquet(str(tmp_path / "all/ledger/merged/upto=4")).count()
    totals = {(r.outcome, r.reason): r.messages for r in found.totals(spark).collect()}
    assert sum(totals.values()) == 18 and totals["late", ""] == 3


def test_only_touched_buckets_are_read(spark, tmp_path, monkeypatch):
    """Keys that the bitmap hasn't seen are new without a look at the ledger."""
    _, found = batches(spark, tmp_path, monkeypatch, [(0, [at(f"u{n}", "00:00") for n in range(20)])])
    asked = []
    own = ledger.Ledger(spark, found.at("ledger"), 1)
    monkeypatch.setattr(own, "keys", lambda buckets: asked.extend(buckets) or ledger.Ledger.keys(own, buckets))
    new = ledger.with_key(spark.createDataFrame([("w1",), ("w2",)], "unid string"), ["unid"])
    assert ledger.fresh_rows(new, own).count() == 2 and not asked
    mixed = ledger.with_key(spark.createDataFrame([("w1",), ("u3",)], "unid string"), ["unid"])
    assert [r.unid for r in ledger.fresh_rows(mixed, own).collect()] == ["w1"] and len(asked) == 1
    plan = own.keys(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_failed_attempts_are_counted(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "first_by", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batches(spark, tmp_path, monkeypatch, [(0, [at("u1", "00:00"), at("u2", "00:00")])])
    monkeypatch.undo()
    _, found = batches(spark, tmp_path, monkeypatch, [(0, [at("u1", "00:00"), at("u2", "00:00")])])
    totals = {(r.outcome, r.reason): r.messages for r in found.totals(spark).collect()}
    assert totals == {("accepted", ""): 2, ("failed", "ZeroDivisionError"): 2}


def test_keys_with_nulls_differ(spark):
    rows = spark.createDataFrame([(None, "a"), ("a", None), (None, None), ("", "a")], "x string, y string")
    assert ledger.with_key(rows, ["x", "y"]).select("_k1", "_k2").distinct().count() == 4


def test_a_large_split_is_dealt_over_tasks(spark, tmp_path, monkeypatch):
    """One split of a source that reads as many bytes is no single task at any later step."""
    monkeypatch.setattr(ledger, "TASK_BYTES", 2000, raising=False)
    monkeypatch.setattr(ledger, "batch_stream", lambda tagged, write, *_: write)
    write = ledger.accounted(None, str(tmp_path), "", ["unid"], "event_time", ["event_time"])
    messages = [at(f"u{n % 60}", "00:00", lat=99.0 if n % 2 else 1.0) for n in range(120)]
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    write(tag_events(values(spark, messages).coalesce(1)), 0)
    assert spark.conf.get("spark.sql.shuffle.partitions") == shuffled
    found = ledger.Accounts(str(tmp_path))
    files = found.read(spark, "rejects").groupBy(F.input_file_name()).count().collect()
    assert sum(f["count"] for f in files) == 60 and len(files) > 4
    assert {(r.outcome, r.reason): r.messages for r in found.totals(spark).collect()} == {
        ("accepted", ""): 30, ("repeat", ""): 30, ("rejected", "out_of_range"): 60,
    }
