import json

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators import dedup, ingest, points, render, validate
from faultline.sources import export, raw, tables

# An invented event.
PROPERTIES = {
    "unid": "u1", "source_id": "31", "source_catalog": "INV", "time": "2031-03-04T05:06:07.250Z",
    "lastupdate": "2031-03-05 10:11:12", "flynn_region": "NOWHERE", "lat": -12.5, "lon": 101.75,
    "depth": 33.0, "mag": 4.4, "magtype": "mw", "evtype": "ke", "auth": "AUTH",
}


def event(coordinates=(101.75, -12.5, -33.0), drop=(), **changes):
    props = {k: v for k, v in {**PROPERTIES, **changes}.items() if k not in drop}
    geometry = {"type": "Point", "coordinates": list(coordinates)}
    data = {"type": "Feature", "id": props.get("unid"), "geometry": geometry, "properties": props}
    return json.dumps({"action": "create", "data": data})


def values(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_flat_columns_and_types(spark):
    flat = ingest.flatten_events(ingest.parse_events(values(spark, [event()])))
    assert flat.columns == [
        "action", "event_id", "unid", "event_time", "last_update", "latitude", "longitude", "depth_km",
        "coord_longitude", "coord_latitude", "coord_depth", "magnitude", "magnitude_type", "region",
        "authority", "event_type", "source_id", "source_catalog", "processed_at", "processing_date",
    ]
    types = dict(flat.dtypes)
    assert types["event_time"] == types["processed_at"] == "timestamp"
    assert types["processing_date"] == "date"
    row = flat.first()
    assert (row.latitude, row.coord_depth, row.region) == (-12.5, -33.0, "NOWHERE")
    assert str(row.event_time) == "2031-03-04 05:06:07.250000" and str(row.last_update) == "2031-03-05 10:11:12"
    assert row.processed_at is not None and row.processing_date is not None


def test_binary_values_parse(spark):
    binary = values(spark, [event()]).select(F.col("value").cast("binary"))
    assert ingest.ingest_events(binary).first().unid == "u1"


EDGES = [
    ("not json", "malformed_json"),
    ("[]", "missing_unid"),
    ("{}", "missing_unid"),
    ("", "empty"),
    (None, "empty"),
    (event(lat="x"), "missing_coordinates"),
    (event(mag="x"), None),
    (event(time="bad"), None),
    (event(coordinates=[28.9, 39.2]), None),
    (event(drop=["unid"]), "missing_unid"),
    (event(lat=90.0, lon=-180.0), None),
    (event(lat=90.0001), "out_of_range"),
    (event(lon=180.0001), "out_of_range"),
]


def test_edge_messages(spark):
    tagged = ingest.tag_events(values(spark, [m for m, _ in EDGES]))
    reasons = {r.json_string: r.reject_reason for r in tagged.collect()}
    assert reasons == dict(EDGES)
    # The plain path keeps exactly the accepted ones.
    kept = ingest.ingest_events(values(spark, [m for m, _ in EDGES])).collect()
    assert len(kept) == sum(reason is None for _, reason in EDGES)
    assert sum(r.magnitude is None for r in kept) == 1
    assert sum(r.event_time is None for r in kept) == 1
    assert sum(r.coord_depth is None for r in kept) == 1


def test_rejects_keep_the_text(spark):
    accepted, rejected = ingest.split_rejects(values(spark, [m for m, _ in EDGES]))
    assert "processed_at" in rejected.columns and "json_string" not in accepted.columns
    assert rejected.count() + accepted.count() == len(EDGES)
    assert rejected.filter(F.col("json_string") == "not json").first().reject_reason == "malformed_json"


def test_event_validation(spark):
    cases = [
        (event(), None), ("not json", "malformed_json"), ("", "malformed_json"), (None, "malformed_json"),
        ("[]", "no_data"), ("5", "no_data"), ('{"data":null}', "no_data"), ("{}", "no_data"),
        ('{"data":{}}', "empty_properties"), ('{"data":{"properties":{}}}', "empty_properties"),
        (event(drop=["unid"]), "missing_unid"), (event(drop=["time", "mag"]), "missing_time"),
        (event(lat=None), "missing_lat"), (event(drop=["mag"]), "missing_mag"),
        (event(lat="39.5"), None), (event(lat="x"), "not_numeric"), (event(lon=[1]), "not_numeric"),
        (event(lat=-90.0001), "out_of_range"), (event(lat=-90, lon=180), None),
    ]
    got = validate.validate_events(values(spark, [m for m, _ in cases])).collect()
    assert [(r.value, r.reason) for r in got] == cases
    assert all(r.valid == (r.reason is None) for r in got)


def test_station_validation(spark):
    def station(**kw):
        return json.dumps({"type": "reading", "latitude": 1.0, "longitude": 2.0, "Station": "S1", **kw})

    cases = [
        (station(), None), ('{"type":"heartbeat"}', "heartbeat"), ("oops", "malformed_json"),
        ("[]", "not_an_object"), ('{"type":"reading"}', "missing_latitude"), (station(Station=None), "missing_Station"),
        (station(latitude="x"), "not_numeric"), (station(longitude=181), "out_of_range"),
    ]
    checked = validate.validate_stations(values(spark, [m for m, _ in cases]))
    assert [(r.value, r.reason) for r in checked.collect()] == cases
    seen = Observation()
    validate.with_metrics(checked, seen).collect()
    assert seen.get == {"sent": 1, "validation_errors": 5, "json_errors": 1, "heartbeats": 1}


def test_station_columns(spark):
    message = json.dumps({"region": "r", "latitude": 1, "longitude": 2, "create_at": "2031-03-05 10:11:12",
                          "update_at": "bad", "PGA": 0.5, "private": True, "Station": "S"})
    source = values(spark, [message, '{"type":"heartbeat"}']).withColumn("timestamp", F.current_timestamp())
    flat = ingest.flatten_stations(ingest.parse_stations(source))
    assert len(flat.columns) == 35 + 1 + 2 + 1
    rows = ingest.clean_stations(flat).collect()
    assert len(rows) == 1 and rows[0].update_at_ts is None and rows[0].create_at_ts is not None
    assert rows[0].kafka_timestamp is not None and rows[0].processed_at is not None


def test_revisions(spark):
    rows = values(spark, [event(lastupdate="2025-01-01T00:00:00Z", mag=1.0), event(lastupdate="2025-01-02T00:00:00Z", mag=2.0)])
    quakes = ingest.ingest_events(rows)
    assert dedup.first_by(quakes, ["unid"], ["last_update"]).first().magnitude == 1.0
    assert dedup.latest_by(quakes, ["unid"], ["last_update"]).first().magnitude == 2.0
    assert dedup.dedup(quakes, ["unid"]).count() == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    plan = dedup.first_by(spark.range(10).selectExpr("id", "id % 3 AS k"), ["k"], ["id"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("Exchange") < text.rindex("WindowGroupLimit")


SITE = dict(ident=None, icao=None, name="n", latitude=1.0, longitude=2.0)


def sites_table(spark, rows):
    full = [{**dict.fromkeys(n for n in tables.SITES_CSV.names), **SITE, **r} for r in rows]
    return spark.createDataFrame([tuple(r[n] for n in tables.SITES_CSV.names) for r in full], tables.SITES_CSV)


def test_sites_without_icao(spark):
    sites = sites_table(spark, [dict(id=i, ident=f"I{i}") for i in (1, 2, 3)] + [dict(id=4, icao="K", ident="I4")])
    assert points.dedup_sites(sites).count() == 4
    shrunk = points.dedup_sites(sites, "icao").collect()
    assert sorted(r.id for r in shrunk) == [1, 4]
    with pytest.raises(ValueError):
        points.dedup_sites(sites, "name")


def test_clean_sites(spark):
    sites = sites_table(spark, [
        dict(id=1, ident="I"), dict(id=2, icao="K"), dict(id=3), dict(id=4, ident="I", latitude=None),
        dict(id=5, ident="I", longitude=None),
    ])
    loaded = points.load_sites(sites)
    assert sorted(r.id for r in loaded.collect()) == [1, 2]
    assert loaded.columns[-3:] == ["last_update", "processed_at", "processing_date"]


def test_sites_csv_round_trip_and_header_check(spark, tmp_path):
    sites = sites_table(spark, [dict(id=1, ident="I", keywords='a "b", c')])
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    sites.write.option("header", True).csv(good)
    assert tables.read_sites_csv(spark, good).first().keywords == 'a "b", c'
    sites.withColumnRenamed("icao", "iata2").write.option("header", True).csv(bad)
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_sites_csv(spark, bad).collect()


def test_rendered_block(spark):
    full, bare = render.render_events(values(spark, [event(mag=0.0002), "{}"])).collect()
    assert "[create] Earthquake Event" in full.text and "Magnitude: mw 0.0002\n" in full.text
    assert full.text.startswith("\n" + "=" * 80) and full.text.endswith("=" * 80 + "\n")
    for line in ("[UNKNOWN]", "Location:  Unknown Region", "Depth:     N/A km", "Coords:    N/A°N, N/A°E"):
        assert line in bare.text


def test_csv_export_appends(spark, tmp_path):
    path = str(tmp_path / "events")
    for _ in range(2):
        export.export_events_csv(values(spark, [event(drop=["auth"])]), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == render.CSV_HEADERS and back.count() == 2
    assert back.first().authority is None and back.first().magnitude == "4.4"


def test_keyed_json(spark):
    row = export.to_keyed_json(spark.createDataFrame([(7, "a")], "id int, t string"), "id").first()
    assert row.key == "7" and json.loads(row.value) == {"id": 7, "t": "a"}


def test_message_sources(spark, tmp_path):
    path = str(tmp_path / "text")
    values(spark, [event()]).write.text(path)
    got = raw.read_stations(spark, fmt="text", path=path, streaming=False)
    assert got.dtypes == [("value", "string"), ("timestamp", "timestamp")] and got.count() == 1
    assert raw.read_events(spark, fmt="text", path=path).isStreaming


def test_wrong_kinds_fail_early(spark):
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), "/nowhere", "replace")
    assert isinstance(ingest.EVENT_MESSAGE, T.StructType)


def test_the_sources_own_option_names_win():
    given = raw.source_options("kafka", True, "earliest", {"startingOffsets": "latest", "failondataloss": "false", "subscribe": "t"})
    assert given == {"startingOffsets": "latest", "failondataloss": "false", "subscribe": "t"}
    assert raw.source_options("kafka", False, "earliest", {}) == {"startingOffsets": "earliest", "failOnDataLoss": "false"}
    assert raw.source_options("text", True, "earliest", {"wholetext": "true"}) == {"wholetext": "true"}
