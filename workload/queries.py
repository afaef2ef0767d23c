"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

All of them read whole tables. Time columns that depend on the clock are left
out of the results, and other times are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from faultline.functions.geo import DISTANCES
from faultline.functions.values import size_mb
from faultline.operators import audit, dedup, ingest, intensity, points, render, validate
from faultline.operators.distance_join import proximity, within_distance
from faultline.operators.nearest import build_site_index, nearest_site, rank_sites
from faultline.plans import jobs
from faultline.schemas import EVENT_PROPERTIES
from faultline.session import scratch_dir
from faultline.sources import export, raw, tables
from faultline.streaming import ledger, streams

from . import inputs

KM = 500.0
# Class bounds at which the derived quakes fall into all three classes.
LOW, MID = 0.00001, 0.0001
KEYS = 4000
NOW = datetime(2024, 1, 30, 23, 59)
NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return f(spark, sf.rstrip("/"))

    run.__doc__ = f.__doc__
    _QUERIES[f.__name__] = run
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def text_time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(name)


def km3(name: str = "distance_km") -> Column:
    return F.round(name, 3).alias("km")


# --- ingestion -------------------------------------------------------------


@query
def parse_flatten_events(spark, sf):
    flat = ingest.flatten_events(ingest.parse_events(inputs.messages(spark, sf)))
    rest = [c for c in flat.columns if c not in ("event_time", "last_update", "processed_at", "processing_date")]
    return flat.select(text_time("event_time"), text_time("last_update"), *rest)


@query
def valid_coordinates(spark, sf):
    rows = ingest.ingest_events(inputs.faulty_messages(spark, sf))
    return rows.select("event_id", "unid", "latitude", "longitude", "magnitude")


@query
def stamped_columns(spark, sf):
    rows = ingest.ingest_events(inputs.messages(spark, sf))
    return rows.agg(
        F.count("processed_at").alias("processed"), F.count("processing_date").alias("dated")
    )


@query
def parse_stations(spark, sf):
    rows = ingest.ingest_stations(inputs.station_messages(spark, sf))
    return rows.select(
        "type", "region", "latitude", "longitude", "version", "PGA", "PGV", "Max_PGA", "Shindo",
        "Intensity", "private", "create_at", "Station", text_time("kafka_timestamp"),
        text_time("create_at_ts"), text_time("update_at_ts"),
    )


@query
def station_fields(spark, sf):
    """Every field of the station message, from bytes."""
    rows = ingest.ingest_stations(inputs.full_station_messages(spark, sf))
    return rows.select("*").drop("processed_at", "kafka_timestamp", "create_at_ts", "update_at_ts")


@query
def stations_required(spark, sf):
    """Stations without a region or a time are left out."""
    made = inputs.station_messages(spark, sf)
    for every, name in ((7, "region"), (5, "create_at")):
        without = F.regexp_replace("value", f'"{name}":"[^"]*"', f'"{name}":null')
        made = made.withColumn("value", F.when(F.col("event_id") % every == 0, without).otherwise(F.col("value")))
    rows = ingest.ingest_stations(made)
    return rows.groupBy("region", "create_at").agg(F.count(F.lit(1)).alias("rows"))


@query
def event_points_strings(spark, sf):
    """Points of quakes whose numbers are text, some of them absent."""
    rows = ingest.ingest_events(inputs.faulty_messages(spark, sf))
    text = {c: F.col(c).cast("string") for c in ("latitude", "longitude", "magnitude")}
    return points.event_points(rows.withColumns(text)).select("event_id", "lat", "lon", "magnitude", "region")


@query
def validate_events_reasons(spark, sf):
    return validate.reason_counts(validate.validate_events(inputs.faulty_messages(spark, sf)))


@query
def validate_stations_reasons(spark, sf):
    return validate.reason_counts(validate.validate_stations(inputs.station_messages(spark, sf)))


@query
def validation_metrics(spark, sf):
    """Counters observed while the messages pass by, both feeds."""
    rows = []
    for feed, checked in (
        ("events", validate.validate_events(inputs.faulty_messages(spark, sf))),
        ("stations", validate.validate_stations(inputs.station_messages(spark, sf))),
    ):
        seen = Observation()
        validate.with_metrics(checked, seen).write.format("noop").mode("overwrite").save()
        rows.append((feed, *(seen.get[c] for c in ("sent", "validation_errors", "json_errors", "heartbeats"))))
    return spark.createDataFrame(
        rows, "feed string, sent long, validation_errors long, json_errors long, heartbeats long"
    )


@query
def rejects(spark, sf):
    _, rejected = ingest.split_rejects(inputs.faulty_messages(spark, sf))
    return rejected.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


# --- duplicates ------------------------------------------------------------


def _keyed(spark, sf):
    return inputs.quakes(spark, sf).withColumn("unid", F.col("event_id") % KEYS)


@query
def dedup_events_first(spark, sf):
    return dedup.first_by(_keyed(spark, sf), ["unid"], ["ts", "event_id"]).select("unid", "event_id", "magnitude")


@query
def dedup_events_latest(spark, sf):
    return dedup.latest_by(_keyed(spark, sf), ["unid"], ["ts", "event_id"]).select("unid", "event_id", "magnitude")


@query
def dedup_stations(spark, sf):
    rows = ingest.ingest_stations(inputs.station_messages(spark, sf))
    return dedup.dedup(rows, dedup.STATION_KEY).select(*dedup.STATION_KEY)


# --- sites -----------------------------------------------------------------


@query
def clean_sites(spark, sf):
    """Sites written as CSV, read back under the schema and cleaned."""
    path = f"{scratch_dir(spark)}/sites.csv"
    inputs.supplier_sites(spark, sf).write.option("header", True).csv(path)
    return points.clean_sites(tables.read_sites_csv(spark, path)).select(
        "id", "ident", "icao", "name", "latitude", "longitude", "elevation", "country"
    )


@query
def dedup_sites_null_keys(spark, sf):
    rows = [
        points.dedup_sites(inputs.supplier_sites(spark, sf), key).select(F.lit(key).alias("mode"), "site_key", "id")
        for key in ("coalesce", "icao")
    ]
    return reduce(DataFrame.unionByName, rows)


# --- distance --------------------------------------------------------------


def _paired(spark, sf, method):
    """Every event with one site; the number of sites is read off the table."""
    sites = inputs.bare_sites(spark, sf)
    n = sites.count()
    pairs = inputs.quakes(spark, sf).withColumn("site_id", F.col("user_id") % n).join(sites, "site_id")
    km = DISTANCES[method](*(F.col(c) for c in ("lat", "lon", "site_lat", "site_lon")))
    return pairs.select("event_id", "site_id", F.round(km, 3).alias("km"))


@query
def distance_haversine(spark, sf):
    return _paired(spark, sf, "haversine")


@query
def distance_slc(spark, sf):
    return _paired(spark, sf, "slc")


def _within(spark, sf, strategy):
    pairs = within_distance(inputs.points(spark, sf), inputs.bare_sites(spark, sf), KM, strategy)
    return pairs.select("event_id", "site_id", km3())


@query
def within_500km(spark, sf):
    return _within(spark, sf, "auto")


@query
def within_500km_grid(spark, sf):
    return _within(spark, sf, "grid")


@query
def proximity_rows(spark, sf):
    """Pairs with every column but the time of analysis, of which there has to be one."""
    events = inputs.quakes(spark, sf).filter("lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")
    events = events.selectExpr("event_id", "lat", "lon", "magnitude", "upper(event_type) AS region")
    rows = proximity(events, inputs.sites(spark, sf), KM).filter("analysis_time IS NOT NULL")
    return rows.select("event_id", "site_id", "airport_name", "magnitude", "region", F.round("dist_km", 3).alias("km"))


def _nearest(spark, sf, **how):
    return nearest_site(inputs.points(spark, sf), inputs.bare_sites(spark, sf), **how)


@query
def nearest_site_auto(spark, sf):
    return _nearest(spark, sf).select("event_id", "site_id", km3())


@query
def nearest_site_slc(spark, sf):
    return _nearest(spark, sf, method="slc").select("event_id", "site_id", km3())


@query
def nearest_site_grid(spark, sf):
    return _nearest(spark, sf, strategy="grid").select("event_id", "site_id", km3())


@query
def nearest_site_clustered(spark, sf):
    """Many sites in few places: one per customer, in 25 spots of a tenth of a degree."""
    index = build_site_index(inputs.clustered_sites(spark, sf), few_sites=0)
    return nearest_site(inputs.points(spark, sf), index).select("event_id", "site_id", km3())


@query
def top3_sites(spark, sf):
    rows = rank_sites(inputs.points(spark, sf), inputs.bare_sites(spark, sf), 3)
    return rows.select("event_id", "rank", "site_id", km3())


# --- motion and intensity --------------------------------------------------


def _moved(spark, sf):
    """Motion at the nearest site; km and PGV rounded so that no row depends on
    the last bit of a double."""
    near = _nearest(spark, sf, ids_unique=True).withColumn("distance_km", F.round("distance_km", 3))
    return intensity.ground_motion(near).withColumn("estimated_pgv", F.round("estimated_pgv", 9))


def _classified(spark, sf, null_policy="null"):
    return intensity.classify(_moved(spark, sf), LOW, MID, null_policy)


@query
def ground_motion(spark, sf):
    rows = _moved(spark, sf)
    return rows.select("event_id", "estimated_pgv", F.round("estimated_pgd", 9).alias("estimated_pgd"))


@query
def intensity_class(spark, sf):
    return _classified(spark, sf).select("event_id", "intensity_label", "high_intensity_flag")


@query
def intensity_class_reference_nulls(spark, sf):
    rows = _classified(spark, sf, "reference")
    return rows.select("event_id", "intensity_label", "high_intensity_flag")


@query
def high_intensity(spark, sf):
    return intensity.high_intensity(_classified(spark, sf)).select("event_id", "magnitude", "site_id")


@query
def intensity_summary(spark, sf):
    return intensity.intensity_summary(_classified(spark, sf))


@query
def intensity_table(spark, sf):
    """The whole job: quakes and sites tables in, intensity table and summary out.

    Class bounds are the defaults; depth is left NULL for some rows.
    """
    root = scratch_dir(spark)
    messages = inputs.messages(spark, sf)
    tables.write_table(ingest.ingest_events(messages), f"{root}/quakes")
    tables.write_table(points.load_sites(inputs.supplier_sites(spark, sf)), f"{root}/sites")
    return jobs.analyse_intensity(spark, f"{root}/quakes", f"{root}/sites", f"{root}/intensity", ids_unique=True)


# --- table health ----------------------------------------------------------


@query
def audit_tables(spark, sf):
    names = {n: f"{sf}/{n}.parquet" for n in ("events", "orders", "lineitem", "absent")}
    rows = audit.audit_tables(
        spark, names, NOW, columns={"events": "ts", "orders": "o_orderdate"}
    )
    return rows.select("name", F.coalesce("total", F.lit(-1)).alias("total"),
                       F.coalesce("recent", F.lit(-1)).alias("recent"), "status", "note")


@query
def recent_count(spark, sf):
    return audit.recent_count(inputs.table(spark, sf, "events"), "ts", 60 * 24, NOW)


def _stamped(spark, sf):
    return inputs.table(spark, sf, "events").withColumnRenamed("ts", "processed_at")


@query
def latest_rows(spark, sf):
    rows = audit.latest_rows(_stamped(spark, sf), 20, ["event_id"])
    return rows.select("event_id", "user_id", "value", text_time("processed_at"))


@query
def sample_rows(spark, sf):
    return audit.sample_rows(inputs.table(spark, sf, "events"))


@query
def sample_rows_known(spark, sf):
    """How many rows a sample has, and how many of them the table holds."""
    events = inputs.table(spark, sf, "events")
    sample = audit.sample_rows(events)
    return sample.join(events.select("event_id"), "event_id", "left_semi").agg(F.count(F.lit(1)).alias("rows"))


@query
def table_summary(spark, sf):
    names = {f"{n}.parquet": f"{sf}/{n}.parquet" for n in NAMES}
    summary = audit.table_summary(spark, sf).join(audit.table_rows(spark, names), "table")
    return summary.select("table", "files", "rows", (F.col("size_bytes") > 0).alias("has_bytes"))


@query
def table_overwrite(spark, sf):
    """A table written over with rows of another schema."""
    path, events = f"{scratch_dir(spark)}/t", inputs.table(spark, sf, "events")
    tables.write_table(events, path)
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.max("event_id").alias("last_id"))
    tables.write_table(per_user, path, "overwrite", replace_schema=True)
    return tables.read_table(spark, path).select("*")


@query
def size_in_mb(spark, sf):
    """Bytes of text per source, in megabytes."""
    bytes_ = F.sum(F.octet_length("text"))
    return inputs.table(spark, sf, "documents").groupBy("source").agg(size_mb(bytes_).alias("size_mb"))


@query
def table_history(spark, sf):
    root = scratch_dir(spark)
    log = f"{root}/log"
    out = []
    for name, writes in (("events", ["append", "append", "overwrite", "append"]), ("orders", ["overwrite"])):
        keys = inputs.table(spark, sf, name).select(inputs.table(spark, sf, name).columns[0])
        for mode in writes:
            tables.write_table(keys, f"{root}/{name}", mode, log=log)
        history = tables.table_history(spark, f"{root}/{name}", 3, log)
        out.append(history.select(F.lit(name).alias("table"), "version", "operation", "rows"))
    return reduce(DataFrame.unionByName, out)


# --- exports ---------------------------------------------------------------


@query
def render_events(spark, sf):
    return render.render_events(inputs.messages(spark, sf))


@query
def export_csv_rows(spark, sf):
    path = f"{scratch_dir(spark)}/events.csv"
    export.export_events_csv(inputs.messages(spark, sf), path)
    back = spark.read.option("header", True).csv(path)
    received = F.col("received_timestamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$")
    return back.select(
        received.alias("received"), *render.CSV_HEADERS[1:]
    )


@query
def keyed_json(spark, sf):
    """Valid events as keyed messages, written, read back and parsed."""
    path = f"{scratch_dir(spark)}/messages"
    rows = ingest.ingest_events(inputs.messages(spark, sf))
    out = rows.selectExpr("unid", "latitude AS lat", "longitude AS lon", "depth_km AS depth", "magnitude AS mag")
    export.publish(export.to_keyed_json(out, "unid"), "json", path)
    back = spark.read.schema("key string, value string").json(path)
    parsed = F.from_json("value", EVENT_PROPERTIES)
    return back.select("key", parsed.alias("p")).selectExpr("key", "p.unid", "p.lat", "p.lon", "p.depth", "p.mag")


# --- streams ---------------------------------------------------------------


def _run(spark, start):
    """Start a stream that reads all there is, and wait. State gets a partition
    per core; it is fixed by the checkpoint, so it is set before the start."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(spark.sparkContext.defaultParallelism))
    try:
        start({"availableNow": True}).awaitTermination()
    finally:
        spark.conf.set(key, before)


def _feed(messages: DataFrame, path: str) -> None:
    messages.select("value").write.mode("append").text(path)


def _text_events(spark, path):
    return raw.read_events(spark, fmt="text", path=path)


def _halves(spark, sf) -> int:
    """First event id of the second half of the table."""
    last = inputs.table(spark, sf, "events").agg(F.max("event_id")).first()[0]
    return (last + 2) // 2


@query
def stream_ingest(spark, sf):
    root = scratch_dir(spark)
    _feed(inputs.faulty_messages(spark, sf), f"{root}/in")
    source = {"fmt": "text", "path": f"{root}/in"}
    _run(spark, lambda now: jobs.ingest_quakes(spark, source, f"{root}/out", f"{root}/cp", trigger=now))
    rows = tables.read_table(spark, f"{root}/out")
    return rows.select("event_id", "unid", "latitude", "longitude", "magnitude", text_time("event_time"))


@query
def stream_stations(spark, sf):
    root = scratch_dir(spark)
    feed = inputs.station_messages(spark, sf).selectExpr("cast(event_id AS string) AS key", "value", "timestamp")
    feed.write.parquet(f"{root}/in")
    source = {"fmt": "parquet", "path": f"{root}/in"}
    _run(spark, lambda now: jobs.ingest_stations(spark, source, f"{root}/out", f"{root}/cp", None, now))
    return tables.read_table(spark, f"{root}/out").select(*dedup.STATION_KEY)


@query
def stream_rejects(spark, sf):
    root = scratch_dir(spark)
    _feed(inputs.faulty_messages(spark, sf), f"{root}/in")
    stream = _text_events(spark, f"{root}/in")
    _run(spark, lambda now: streams.ingest_with_rejects(stream, f"{root}/out", f"{root}/bad", f"{root}/cp", now))
    accepted = tables.read_table(spark, f"{root}/out").select(F.lit("accepted").alias("reject_reason"))
    rejected = tables.read_table(spark, f"{root}/bad").select("reject_reason")
    return accepted.unionByName(rejected).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("messages"))


@query
def stream_dedup_restart(spark, sf):
    """Two runs over one checkpoint; the second brings repeats and new ids."""
    root, half = scratch_dir(spark), _halves(spark, sf)
    made = inputs.messages(
        spark, sf, f"concat('u', event_id % {KEYS})", f"if(event_id < {half}, 'create', 'update')"
    )
    for part in (F.col("event_id") < half, F.col("event_id") >= half):
        _feed(made.filter(part), f"{root}/in")
        rows = streams.deduped_events(_text_events(spark, f"{root}/in"), None)
        _run(spark, lambda now: streams.append_stream(rows, f"{root}/out", f"{root}/cp", now))
    return tables.read_table(spark, f"{root}/out").select("unid", "action")


@query
def stream_dedup_watermark(spark, sf):
    """Two runs with every id once in each; ids of which the state has expired
    come through again."""
    root, half = scratch_dir(spark), _halves(spark, sf)
    made = inputs.messages(spark, sf, f"concat('u', event_id % {half})")
    for part in (F.col("event_id") < half, F.col("event_id") >= half):
        _feed(made.filter(part), f"{root}/in")
        rows = streams.deduped_events(_text_events(spark, f"{root}/in"), "15 minutes")
        _run(spark, lambda now: streams.append_stream(rows, f"{root}/out", f"{root}/cp", now))
    return tables.read_table(spark, f"{root}/out").select("event_id", "unid")


@query
def stream_late_rows(spark, sf):
    """The newest events first, then all older ones, under the job's defaults: every id arrives."""
    root = scratch_dir(spark)
    made = inputs.messages(spark, sf, f"concat('u', event_id % {KEYS})")
    source = {"fmt": "text", "path": f"{root}/in"}
    for part in (F.col("ts") >= F.lit(NOW) - F.expr("INTERVAL 1 DAY"), F.lit(True)):
        _feed(made.filter(part), f"{root}/in")
        _run(spark, lambda now: jobs.ingest_quakes(spark, source, f"{root}/out", f"{root}/cp", trigger=now))
    return tables.read_table(spark, f"{root}/out").groupBy("unid").agg(F.count(F.lit(1)).alias("rows"))


@query
def stream_bad_times(spark, sf):
    """Events without a valid time, twice over one checkpoint: one row per id all the same."""
    root = scratch_dir(spark)
    made = inputs.messages(spark, sf, f"concat('u', event_id % {KEYS})")
    made = made.withColumn("value", F.regexp_replace("value", '"time":"[^"]*"', '"time":"bad"'))
    source = {"fmt": "text", "path": f"{root}/in"}
    for _ in range(2):
        _feed(made, f"{root}/in")
        _run(spark, lambda now: jobs.ingest_quakes(spark, source, f"{root}/out", f"{root}/cp", trigger=now))
    rows = tables.read_table(spark, f"{root}/out")
    return rows.groupBy("unid").agg(F.count(F.lit(1)).alias("rows"), F.count("event_time").alias("times"))


@query
def ingest_accounted(spark, sf):
    """Every message is in the table, a repeat of a row of it, or in the rejects."""
    root = scratch_dir(spark)
    messages = inputs.faulty_messages(spark, sf)
    for _ in range(2):
        _feed(messages, f"{root}/in")
    source = {"fmt": "text", "path": f"{root}/in"}
    _run(spark, lambda now: jobs.ingest_quakes(spark, source, f"{root}/out", f"{root}/cp", trigger=now))
    _run(spark, lambda now: jobs.reject_quakes(spark, source, f"{root}/bad", f"{root}/bad-cp", now))
    kept = tables.read_table(spark, f"{root}/out").select(F.lit("accepted").alias("outcome"))
    bad = tables.read_table(spark, f"{root}/bad").select(F.lit("rejected").alias("outcome"))
    return kept.unionByName(bad).groupBy("outcome").agg(F.count(F.lit(1)).alias("messages"))


def _account(spark, sf, root, runs, **how):
    """The quake feed in one run after the other over one checkpoint."""
    source = {"fmt": "text", "path": f"{root}/in"}
    for messages in runs:
        _feed(messages, f"{root}/in")
        _run(spark, lambda now: jobs.account_feed(spark, "quakes", source, root, f"{root}/cp", trigger=now, **how))
    return ledger.Accounts(root)


@query
def stream_exact_dedup(spark, sf):
    """One row per id over two runs, without state: the ledger tells repeats, old ones too."""
    root, half = scratch_dir(spark), _halves(spark, sf)
    made = inputs.messages(spark, sf, f"concat('u', event_id % {KEYS})")
    runs = made.filter(F.col("event_id") < half), made
    rows = _account(spark, sf, root, runs).read(spark, "accepted")
    return rows.select("unid", "event_id", text_time("event_time"))


@query
def stream_accounts(spark, sf):
    """Every message of two runs by outcome; the second repeats the first, and its old rows are late."""
    root, half = scratch_dir(spark), _halves(spark, sf)
    made = inputs.faulty_messages(spark, sf)
    runs = made.filter(F.col("event_id") < half), made
    return _account(spark, sf, root, runs, late_after="15 minutes").totals(spark)


@query
def stream_late_table(spark, sf):
    """The rows that are late, whole."""
    root, half = scratch_dir(spark), _halves(spark, sf)
    made = inputs.faulty_messages(spark, sf)
    runs = made.filter(F.col("event_id") < half), made
    rows = _account(spark, sf, root, runs, late_after="15 minutes").read(spark, "late")
    return rows.select("reason", "unid", "event_id", "latitude", "longitude", "magnitude", text_time("event_time"))


@query
def stream_station_accounts(spark, sf):
    """The station feed, some messages without region, time or place, by outcome; sent twice."""
    root = scratch_dir(spark)
    made = inputs.station_messages(spark, sf)
    for every, name in ((7, "region"), (5, "create_at")):
        without = F.regexp_replace("value", f'"{name}":"[^"]*"', f'"{name}":null')
        made = made.withColumn("value", F.when(F.col("event_id") % every == 0, without).otherwise(F.col("value")))
    feed = made.selectExpr("cast(event_id AS string) AS key", "if(event_id % 13 = 0, substr(value, 1, 30), value) AS value", "timestamp")
    source = {"fmt": "parquet", "path": f"{root}/in"}
    for _ in range(2):
        feed.write.mode("append").parquet(f"{root}/in")
        _run(spark, lambda now: jobs.account_feed(spark, "stations", source, root, f"{root}/cp", trigger=now))
    return ledger.Accounts(root).totals(spark)


@query
def stream_revisions(spark, sf):
    """Corrections kept: the latest revision per id over two runs."""
    root, half = scratch_dir(spark), _halves(spark, sf)
    made = inputs.messages(spark, sf, f"concat('u', event_id % {KEYS})")
    order = ("last_update", "event_time")
    for part in (F.col("event_id") < half, F.col("event_id") >= half):
        _feed(made.filter(part), f"{root}/in")
        rows = ingest.ingest_events(_text_events(spark, f"{root}/in"))
        _run(spark, lambda now: streams.revisions(rows, f"{root}/out", f"{root}/cp", order=order, trigger=now))
    latest = dedup.latest_by(tables.read_table(spark, f"{root}/out"), dedup.EVENT_KEY, list(order))
    return latest.select("unid", "event_id")


def _quakes_table(spark, sf, path):
    rows = ingest.ingest_events(inputs.messages(spark, sf))
    tables.write_table(rows, path)


@query
def stream_proximity(spark, sf):
    """The quakes table as a stream against the sites table."""
    root = scratch_dir(spark)
    _quakes_table(spark, sf, f"{root}/quakes")
    tables.write_table(points.load_sites(inputs.supplier_sites(spark, sf)), f"{root}/sites")
    _run(
        spark,
        lambda now: jobs.find_proximity(
            spark, f"{root}/quakes", f"{root}/sites", KM, f"{root}/out", f"{root}/cp", now
        ),
    )
    rows = tables.read_table(spark, f"{root}/out").filter("analysis_time IS NOT NULL")
    event = F.col("event_id").cast("bigint").alias("event_id")
    return rows.select(event, "site_id", "airport_name", "magnitude", "region", F.round("dist_km", 3).alias("km"))


@query
def stream_nearest(spark, sf):
    """Nearest site of each quake of a stream, against a candidate table built once."""
    root = scratch_dir(spark)
    _quakes_table(spark, sf, f"{root}/quakes")
    index = build_site_index(inputs.bare_sites(spark, sf))
    quakes = points.event_points(tables.stream_table(spark, f"{root}/quakes"))
    _run(spark, lambda now: streams.nearest_stream(quakes, index, f"{root}/out", f"{root}/cp", now))
    rows = tables.read_table(spark, f"{root}/out")
    return rows.select(F.col("event_id").cast("bigint").alias("event_id"), "site_id", km3())


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Events per intensity class at their nearest site."""
    return _QUERIES["intensity_summary"](spark, sf)
