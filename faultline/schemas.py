"""Fixed input schemas. Every field is nullable; nothing is inferred."""

from pyspark.sql import types as T


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind, True) for n in names]


_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()

CORRUPT = "_corrupt_record"

# The nested event message.
EVENT_PROPERTIES = T.StructType(
    _fields(_S, "unid", "source_id", "source_catalog", "lastupdate", "time", "flynn_region")
    + _fields(_D, "lat", "lon", "depth")
    + _fields(_S, "evtype", "auth")
    + _fields(_D, "mag")
    + _fields(_S, "magtype")
)
EVENT_GEOMETRY = T.StructType(
    _fields(_S, "type") + [T.StructField("coordinates", T.ArrayType(_D), True)]
)
EVENT_MESSAGE = T.StructType(
    [
        T.StructField("action", _S, True),
        T.StructField(
            "data",
            T.StructType(
                _fields(_S, "type", "id")
                + [
                    T.StructField("geometry", EVENT_GEOMETRY, True),
                    T.StructField("properties", EVENT_PROPERTIES, True),
                ]
            ),
            True,
        ),
    ]
)

# The flat station message; Station is added (the feed requires it).
STATION_MESSAGE = T.StructType(
    _fields(_S, "type", "region")
    + _fields(_D, "latitude", "longitude")
    + _fields(_S, "version")
    + _fields(_D, "PGA", "PGV", "PGD", "PGA_EW", "PGV_EW", "PGD_EW", "PGA_NS", "PGV_NS", "PGD_NS")
    + _fields(_D, "PGA_UD", "PGV_UD", "PGD_UD", "Max_PGA", "Max_PGV", "Max_PGD")
    + _fields(_S, "Shindo", "Max_Shindo")
    + _fields(_D, "CalcShindo", "Max_CalcShindo", "Intensity", "Max_Intensity")
    + _fields(_D, "LPGM", "Max_LPGM", "Sva30", "Max_Sva30")
    + _fields(_B, "private", "High_Precision")
    + _fields(_S, "update_at", "create_at", "Station")
)

# The sites CSV, in column order.
SITES_CSV = T.StructType(
    _fields(T.IntegerType(), "id")
    + _fields(_S, "ident", "icao", "iata", "gps_code", "local_code", "name")
    + _fields(_D, "latitude", "longitude", "elevation")
    + _fields(_S, "continent", "country", "region", "municipality", "scheduled_service")
    + _fields(_S, "web_url", "wikipedia_url", "keywords", "timezone", "airport_type")
)

# A topic written out as a table, for file sources and sinks.
MESSAGE = T.StructType(
    [
        T.StructField("key", _S, True),
        T.StructField("value", _S, True),
        T.StructField("timestamp", T.TimestampType(), True),
    ]
)
