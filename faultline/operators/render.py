"""Raw event messages as text blocks and as CSV rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.values import format_ts, or_default, plain_number
from .ingest import once

# Property behind each shown field, and the CSV headers in order.
_PROPERTIES = {
    "event_time": "time",
    "magnitude": "mag",
    "magnitude_type": "magtype",
    "region": "flynn_region",
    "depth_km": "depth",
    "latitude": "lat",
    "longitude": "lon",
    "authority": "auth",
    "event_id": "unid",
}
CSV_HEADERS = [
    "received_timestamp", "event_time", "action", "magnitude", "magnitude_type", "region",
    "depth_km", "latitude", "longitude", "authority", "event_id",
]
_NUMBERS = ("magnitude", "depth_km", "latitude", "longitude")
RULE = "=" * 80


def _shown_fields(raw: DataFrame) -> DataFrame:
    message = F.from_json(
        F.col("value").cast("string"),
        "action string, data struct<properties:map<string,string>>",
    )

    def shown(name: str, prop: str) -> Column:
        text = F.try_element_at("_m.data.properties", F.lit(prop))
        return plain_number(text) if name in _NUMBERS else text

    return once(raw, "_m", message).select(
        F.col("_m.action").alias("action"),
        *[shown(n, p).alias(n) for n, p in _PROPERTIES.items()],
    )


def render_events(raw: DataFrame) -> DataFrame:
    """One text block per message in ``text``, beside its ``event_id``."""
    f = {n: or_default(F.col(n), "N/A") for n in _PROPERTIES}
    f["region"] = or_default(F.col("region"), "Unknown Region")
    text = F.format_string(
        f"\n{RULE}\n[%s] Earthquake Event\n{RULE}\n"
        "  Time:      %s\n  Magnitude: %s %s\n  Location:  %s\n  Depth:     %s km\n"
        "  Coords:    %s°N, %s°E\n  Authority: %s\n  Event ID:  %s\n"
        f"{RULE}\n",
        or_default(F.col("action"), "UNKNOWN"),
        *[
            f[n]
            for n in (
                "event_time", "magnitude_type", "magnitude", "region", "depth_km",
                "latitude", "longitude", "authority", "event_id",
            )
        ],
    )
    return _shown_fields(raw).select("event_id", text.alias("text"))


def csv_rows(raw: DataFrame, received: Column | None = None) -> DataFrame:
    """The 11 CSV columns as text; missing values are empty."""
    received = F.current_timestamp() if received is None else received
    return (
        _shown_fields(raw)
        .withColumn("action", or_default(F.col("action"), "UNKNOWN"))
        .withColumn("received_timestamp", format_ts(received))
        .select(*[or_default(F.col(h), "").alias(h) for h in CSV_HEADERS])
    )
