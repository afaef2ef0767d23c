"""Raw messages to typed, checked rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.geo import valid_coords
from ..functions.values import ts
from ..schemas import CORRUPT, EVENT_MESSAGE, STATION_MESSAGE


def stamp(df: DataFrame, *columns: str) -> DataFrame:
    """Processing metadata: ``*_date`` columns get today, the others now."""
    return df.withColumns(
        {c: F.current_date() if c.endswith("_date") else F.current_timestamp() for c in columns}
    )


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Keep rows where all the columns are present."""
    return df.dropna(subset=list(columns))


def once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Adds a costly column computed once per row.

    As a plain column it would be copied into every filter that Spark moves
    below it, so a message would be parsed once per condition. (Outer, as Spark
    filters on the size of other exploded arrays, which computes them again.)
    """
    return df.withColumn(name, F.explode_outer(F.array(column)))


def _parsed_from(name: str, schema: T.StructType) -> Column:
    """Column ``name`` under ``schema`` plus a field for the text of a bad record."""
    fields = [*schema.fields, T.StructField(CORRUPT, T.StringType())]
    return F.from_json(
        F.col(name).cast("string"),
        T.StructType(fields),
        {"columnNameOfCorruptRecord": CORRUPT},
    )


def parse_events(raw: DataFrame, drop_null: bool = True) -> DataFrame:
    """``json_string`` and the parsed ``message``.

    Only NULL and empty input parse to NULL; other bad input gives a message of
    NULLs that fails the later checks. Where ``raw`` has the time of arrival,
    ``timestamp``, it is kept as ``arrived_at``.
    """
    arrival = [F.col("timestamp").alias("arrived_at")] if "timestamp" in raw.columns else []
    parsed = once(raw.select(F.col("value").cast("string").alias("json_string"), *arrival), "message", _parsed_from("json_string", EVENT_MESSAGE))
    return parsed.filter(F.col("message").isNotNull()) if drop_null else parsed


def _event_columns() -> dict[str, Column]:
    prop = "message.data.properties."
    point = F.col("message.data.geometry.coordinates")
    return {
        "action": F.col("message.action"),
        "event_id": F.col("message.data.id"),
        "unid": F.col(prop + "unid"),
        "event_time": ts(F.col(prop + "time")),
        "last_update": ts(F.col(prop + "lastupdate")),
        "latitude": F.col(prop + "lat"),
        "longitude": F.col(prop + "lon"),
        "depth_km": F.col(prop + "depth"),
        # Short arrays give NULL, not an error.
        "coord_longitude": F.get(point, 0),
        "coord_latitude": F.get(point, 1),
        "coord_depth": F.get(point, 2),
        "magnitude": F.col(prop + "mag"),
        "magnitude_type": F.col(prop + "magtype"),
        "region": F.col(prop + "flynn_region"),
        "authority": F.col(prop + "auth"),
        "event_type": F.col(prop + "evtype"),
        "source_id": F.col(prop + "source_id"),
        "source_catalog": F.col(prop + "source_catalog"),
    }


def flatten_events(parsed: DataFrame) -> DataFrame:
    """The 18 event columns plus processed_at and processing_date."""
    flat = parsed.select(*[c.alias(n) for n, c in _event_columns().items()])
    return stamp(flat, "processed_at", "processing_date")


def clean_events(flat: DataFrame) -> DataFrame:
    return require(flat, "unid").filter(valid_coords(F.col("latitude"), F.col("longitude")))


def ingest_events(raw: DataFrame) -> DataFrame:
    """Raw messages to checked event rows; one narrow stage."""
    return clean_events(flatten_events(parse_events(raw)))


def parse_stations(raw: DataFrame) -> DataFrame:
    """Parsed ``station`` message beside the arrival time."""
    parsed = once(raw, "station", _parsed_from("value", STATION_MESSAGE)).filter(F.col("station").isNotNull())
    return parsed.select("station", F.col("timestamp").alias("kafka_timestamp"))


def flatten_stations(parsed: DataFrame) -> DataFrame:
    """Every station field, the arrival time, parsed times and processed_at."""
    flat = parsed.select("station.*", "kafka_timestamp").drop(CORRUPT)
    return stamp(
        flat.withColumns({"create_at_ts": ts(F.col("create_at")), "update_at_ts": ts(F.col("update_at"))}),
        "processed_at",
    )


def clean_stations(flat: DataFrame) -> DataFrame:
    return require(flat, "create_at", "region").filter(
        valid_coords(F.col("latitude"), F.col("longitude"))
    )


def ingest_stations(raw: DataFrame) -> DataFrame:
    return clean_stations(flatten_stations(parse_stations(raw)))


def tag_events(raw: DataFrame) -> DataFrame:
    """Event rows with the raw text and a ``reject_reason``, NULL if accepted.

    The corrupt-record text is only ever a reason, never the test: a message
    with one bad optional field keeps its other fields and is accepted.
    """
    parsed = parse_events(raw, drop_null=False)
    lat, lon = F.col("latitude"), F.col("longitude")
    rejected = F.col("unid").isNull() | ~F.coalesce(valid_coords(lat, lon), F.lit(False))
    reason = (
        F.when(F.col("message").isNull(), "empty")
        .when(F.col("corrupt").isNotNull() & F.try_parse_json("json_string").isNull(), "malformed_json")
        .when(F.col("unid").isNull(), "missing_unid")
        .when(lat.isNull() | lon.isNull(), "missing_coordinates")
        .otherwise("out_of_range")
    )
    return (
        parsed.select(
            "json_string",
            "message",
            *[c for c in parsed.columns if c == "arrived_at"],
            F.col(f"message.{CORRUPT}").alias("corrupt"),
            *[c.alias(n) for n, c in _event_columns().items()],
        )
        .withColumn("reject_reason", F.when(rejected, reason))
        .drop("message", "corrupt")
    )


def tag_stations(raw: DataFrame) -> DataFrame:
    """Station rows with the raw text and a ``reject_reason``, NULL if accepted; as ``tag_events``."""
    value = F.col("value").cast("string").alias("json_string")
    texts = raw.select(value, F.col("timestamp").alias("kafka_timestamp"))
    parsed = once(texts, "station", _parsed_from("json_string", STATION_MESSAGE))
    flat = parsed.select("json_string", "kafka_timestamp", F.col("station").isNull().alias("_empty"), "station.*")
    lat, lon = F.col("latitude"), F.col("longitude")
    missing = F.col("region").isNull() | F.col("create_at").isNull()
    rejected = missing | ~F.coalesce(valid_coords(lat, lon), F.lit(False))
    reason = (
        F.when(F.col("_empty"), "empty")
        .when(F.col(CORRUPT).isNotNull() & F.try_parse_json("json_string").isNull(), "malformed_json")
        .when(F.col("region").isNull(), "missing_region")
        .when(F.col("create_at").isNull(), "missing_create_at")
        .when(lat.isNull() | lon.isNull(), "missing_coordinates")
        .otherwise("out_of_range")
    )
    times = {"create_at_ts": ts(F.col("create_at")), "update_at_ts": ts(F.col("update_at"))}
    return flat.withColumns(times | {"reject_reason": F.when(rejected, reason)}).drop("_empty", CORRUPT)


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted event rows, rejected messages with their reason)."""
    tagged = tag_events(raw)
    accepted = tagged.filter(F.col("reject_reason").isNull()).drop("json_string", "reject_reason")
    rejected = tagged.filter(F.col("reject_reason").isNotNull()).select("json_string", "reject_reason")
    return (
        stamp(accepted, "processed_at", "processing_date"),
        stamp(rejected, "processed_at"),
    )
