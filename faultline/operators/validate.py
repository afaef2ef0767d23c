"""Feed validation with a reason per message, and counters over it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.geo import valid_coords
from ..functions.values import number
from ..schemas import CORRUPT
from .ingest import once

# What the feeds must carry, in the order it is checked.
EVENT_FIELDS = ("unid", "time", "lat", "lon", "mag")
STATION_FIELDS = ("latitude", "longitude", "Station")


def _text(raw: DataFrame) -> DataFrame:
    return raw.withColumn("json_string", F.col("value").cast("string"))


def _field(fields: Column, name: str) -> Column:
    return F.try_element_at(fields, F.lit(name))


def _field_reasons(chain: Column, fields: Column, names: tuple, lat: str, lon: str) -> Column:
    chain = reduce(
        lambda c, n: c.when(_field(fields, n).isNull(), f"missing_{n}"), names, chain
    )
    y, x = number(_field(fields, lat)), number(_field(fields, lon))
    return chain.when(y.isNull() | x.isNull(), "not_numeric").when(
        ~valid_coords(y, x), "out_of_range"
    )


def validate_events(raw: DataFrame) -> DataFrame:
    """Adds ``valid`` and ``reason`` to raw event messages.

    Properties are read as a map of texts, so that a quoted number still counts
    as one and an empty object is told from a missing one.
    """
    parsed = F.from_json(
        "json_string",
        f"data struct<properties:map<string,string>>, {CORRUPT} string",
        {"columnNameOfCorruptRecord": CORRUPT},
    )
    props = F.col("_parsed.data.properties")
    # The second parse runs only for records the first one complains about.
    bad = F.col(f"_parsed.{CORRUPT}").isNotNull() & F.try_parse_json("json_string").isNull()
    start = (
        F.when(F.col("_parsed").isNull() | bad, "malformed_json")
        .when(F.col("_parsed.data").isNull(), "no_data")
        .when(props.isNull() | (F.cardinality(props) == 0), "empty_properties")
    )
    return _finish(
        once(_text(raw), "_parsed", parsed),
        _field_reasons(start, props, EVENT_FIELDS, "lat", "lon"),
    )


def validate_stations(raw: DataFrame) -> DataFrame:
    """Adds ``valid`` and ``reason`` to raw station messages; heartbeats have
    a reason of their own and are no errors."""
    fields = F.col("_parsed")
    start = (
        F.when(fields.isNull() & F.try_parse_json("json_string").isNull(), "malformed_json")
        .when(fields.isNull(), "not_an_object")
        .when(_field(fields, "type") == "heartbeat", "heartbeat")
    )
    parsed = F.from_json("json_string", "map<string,string>")
    return _finish(
        once(_text(raw), "_parsed", parsed),
        _field_reasons(start, fields, STATION_FIELDS, "latitude", "longitude"),
    )


def _finish(df: DataFrame, reason: Column) -> DataFrame:
    return (
        df.withColumn("reason", reason)
        .withColumn("valid", F.col("reason").isNull())
        .drop("_parsed", "json_string")
    )


def reason_counts(validated: DataFrame) -> DataFrame:
    """Messages per reason; valid ones under ``valid``."""
    return validated.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(
        F.count(F.lit(1)).alias("messages")
    )


def with_metrics(validated: DataFrame, observation: Observation | str) -> DataFrame:
    """Counts sent, invalid and unparsable messages while they pass by.

    Give an ``Observation`` in batch, a name in streaming (it shows up in the
    query progress).
    """
    reason = F.col("reason")
    ignored = F.coalesce(reason.isin("malformed_json", "heartbeat"), F.lit(False))
    return validated.observe(
        observation,
        F.count_if("valid").alias("sent"),
        F.count_if(~F.col("valid") & ~ignored).alias("validation_errors"),
        F.count_if(F.coalesce(reason == "malformed_json", F.lit(False))).alias("json_errors"),
        F.count_if(F.coalesce(reason == "heartbeat", F.lit(False))).alias("heartbeats"),
    )
