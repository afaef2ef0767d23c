"""Quakes, stations and sites derived from the given tables.

Every row of the source table becomes one row or message here; some get the
faults a real feed has (missing fields, broken text, repeated ids).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.schemas import SITES_CSV, STATION_MESSAGE


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The events table, dealt out over the cores when it comes in fewer splits
    than there are cores. A table of many files is left as it is."""
    df = table(spark, sf, "events")
    cores = spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, "event_id")


def quakes(spark: SparkSession, sf: str) -> DataFrame:
    return (
        events(spark, sf)
        .withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
        .selectExpr(
            "event_id",
            "ts",
            "user_id",
            "event_type",
            "k",
            "(event_id * 37) % 2000 / 10D - 100 AS lat",
            "(event_id * 91) % 3800 / 10D - 190 AS lon",
            "value / 50 AS magnitude",
            "if(k % 10 = 0, NULL, cast(k * 7 AS double)) AS depth",
        )
    )


def points(spark: SparkSession, sf: str) -> DataFrame:
    """Quakes with valid coordinates, as the joins take them."""
    return (
        quakes(spark, sf)
        .filter("lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")
        .select("event_id", "lat", "lon", "depth", "magnitude")
    )


def supplier_sites(spark: SparkSession, sf: str) -> DataFrame:
    """The sites table: 20 columns."""
    text = [
        "iata", "gps_code", "local_code", "continent", "country", "region", "municipality",
        "scheduled_service", "web_url", "wikipedia_url", "keywords", "timezone",
    ]
    made = (
        table(spark, sf, "supplier")
        .selectExpr(
            "cast(s_suppkey AS int) AS id",
            "if(s_suppkey % 5 = 0, NULL, concat('I', s_suppkey)) AS ident",
            "if(s_suppkey % 7 = 0, NULL, concat('K', s_suppkey)) AS icao",
            "s_name AS name",
            "(s_suppkey * 53) % 1800 / 10D - 90 AS latitude",
            "(s_suppkey * 131) % 3600 / 10D - 180 AS longitude",
            "s_acctbal AS elevation",
            "'large_airport' AS airport_type",
            *[f"concat('{c}-', s_nationkey) AS {c}" for c in text],
        )
    )
    return made.select(*SITES_CSV.names)


def sites(spark: SparkSession, sf: str) -> DataFrame:
    """Sites as the joins take them."""
    return table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS site_id",
        "s_name AS site_name",
        "(s_suppkey * 53) % 1800 / 10D - 90 AS site_lat",
        "(s_suppkey * 131) % 3600 / 10D - 180 AS site_lon",
    )


def bare_sites(spark: SparkSession, sf: str) -> DataFrame:
    return sites(spark, sf).drop("site_name")


def clustered_sites(spark: SparkSession, sf: str) -> DataFrame:
    """A site per customer, close to one of a spot per nation."""
    return table(spark, sf, "customer").selectExpr(
        "c_custkey AS site_id",
        "(c_nationkey * 53) % 150 - 75 + (c_custkey * 7919) % 1000 / 10000D AS site_lat",
        "(c_nationkey * 131) % 340 - 170 + (c_custkey * 104729) % 997 / 9970D AS site_lon",
    )


def iso(ts: Column | str) -> Column:
    return F.concat(F.replace(F.col(ts).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))


def messages(
    spark: SparkSession,
    sf: str,
    unid: str = "concat('u', event_id)",
    action: str = "'create'",
    mag: str = "magnitude",
) -> DataFrame:
    """One JSON event message per row in ``value``; beside it event_id and ts."""
    q = quakes(spark, sf).withColumns({"time": iso("ts"), "ts2": F.expr("ts + make_dt_interval(0, 0, 0, k)")})
    q = q.withColumn("updated", iso("ts2"))
    properties = F.expr(
        f"""named_struct(
            'unid', {unid}, 'source_id', cast(user_id AS string), 'source_catalog', 'CAT',
            'lastupdate', updated, 'time', time, 'flynn_region', upper(event_type),
            'lat', lat, 'lon', lon, 'depth', depth, 'evtype', 'ke',
            'auth', concat('A', user_id % 7), 'mag', {mag}, 'magtype', 'ml')"""
    )
    message = F.struct(
        F.expr(action).alias("action"),
        F.struct(
            F.lit("Feature").alias("type"),
            F.col("event_id").cast("string").alias("id"),
            F.struct(
                F.lit("Point").alias("type"), F.expr("array(lon, lat, -depth)").alias("coordinates")
            ).alias("geometry"),
            properties.alias("properties"),
        ).alias("data"),
    )
    return q.select("event_id", "ts", F.to_json(message).alias("value"))


def faulty_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Event messages with the faults of a feed."""
    made = messages(
        spark,
        sf,
        unid="if(event_id % 17 = 0, NULL, concat('u', event_id))",
        mag="if(event_id % 13 = 0, NULL, magnitude)",
    )
    broken = """CASE
        WHEN event_id % 37 = 0 THEN ''
        WHEN event_id % 23 = 0 THEN substr(value, 1, 40)
        WHEN event_id % 31 = 0 THEN '{"action":"create","data":{"properties":{}}}'
        WHEN event_id % 41 = 0 THEN '[]'
        WHEN event_id % 29 = 0 THEN regexp_replace(value, '"lat":[^,]*', '"lat":"x"')
        WHEN event_id % 43 = 0 THEN regexp_replace(value, '"lat":([^,]*)', '"lat":"$1"')
        ELSE value END AS value"""
    return made.selectExpr("event_id", "ts", broken)


def full_station_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Station messages in which every field of the schema has a value, as bytes.

    Doubles are ``value`` times the field's number, other fields as listed.
    """
    q = events(spark, sf)
    given = {
        "region": "event_type",
        "latitude": "(user_id * 29) % 1800 / 10D - 90",
        "longitude": "(user_id * 71) % 3600 / 10D - 180",
        "create_at": "cast(date_trunc('day', ts) AS string)",
        "update_at": "cast(ts AS string)",
    }
    kinds = {"double": "value * {i}D", "string": "concat('{name}', event_id % 8)", "boolean": "(event_id + {i}) % 2 = 0"}
    fields = [
        F.expr(given.get(f.name, kinds[f.dataType.simpleString()].format(i=i, name=f.name))).alias(f.name)
        for i, f in enumerate(STATION_MESSAGE.fields, 1)
    ]
    value = F.to_json(F.struct(*fields)).cast("binary")
    return q.select("event_id", value.alias("value"), F.col("ts").cast("timestamp").alias("timestamp"))


def station_messages(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON station message per row in ``value``, with its arrival time."""
    q = events(spark, sf).withColumn("day", F.date_trunc("day", "ts").cast("string"))
    message = F.expr(
        """named_struct(
            'type', if(event_id % 11 = 0, 'heartbeat', 'reading'), 'region', event_type,
            'latitude', (user_id * 29) % 1800 / 10D - 90,
            'longitude', (user_id * 71) % 3600 / 10D - 180,
            'version', '1', 'PGA', value, 'PGV', value / 4, 'Max_PGA', value * 2,
            'Shindo', cast(event_id % 8 AS string), 'Intensity', value / 8,
            'private', user_id % 2 = 0, 'update_at', cast(ts AS string), 'create_at', day,
            'Station', if(event_id % 19 = 0, NULL, concat('S', user_id)))"""
    )
    return q.select(
        "event_id", F.to_json(message).alias("value"), F.col("ts").cast("timestamp").alias("timestamp")
    )
