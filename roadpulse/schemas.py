"""Feed registry: one StructType per feed; wire decode, raw reads and table DDL derive from it."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

VEHICLE = "vehicle_data"
GPS = "gps_data"
TRAFFIC = "traffic_data"
WEATHER = "weather_data"
EMERGENCY = "emergency_data"
FEEDS: tuple[str, ...] = (VEHICLE, GPS, TRAFFIC, WEATHER, EMERGENCY)

_S, _TS, _D, _I, _B = StringType(), TimestampType(), DoubleType(), IntegerType(), BooleanType()


def _struct(*fields: tuple[str, DataType]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# Feed names, columns, types and the columns refining adds, in their natural order; the
# tables must carry these. Raw (wire) schemas first. Every field is nullable; `id` is the record key.
FEED_SCHEMAS: dict[str, StructType] = {
    VEHICLE: _struct(("id", _S), ("vehicle_id", _S), ("timestamp", _TS), ("location", _S),
                     ("speed", _D), ("direction", _S), ("make", _S), ("model", _S),
                     ("year", _I), ("fuelType", _S)),
    GPS: _struct(("id", _S), ("vehicle_id", _S), ("timestamp", _TS), ("speed", _D),
                 ("direction", _S), ("vehicleType", _S)),
    TRAFFIC: _struct(("id", _S), ("vehicle_id", _S), ("camera_id", _S), ("location", _S),
                     ("timestamp", _TS), ("snapshot", _S)),
    WEATHER: _struct(("id", _S), ("vehicle_id", _S), ("location", _S), ("timestamp", _TS),
                     ("temperature", _D), ("weatherCondition", _S), ("precipitation", _D),
                     ("windSpeed", _D), ("humidity", _I), ("airQualityIndex", _D)),
    EMERGENCY: _struct(("id", _S), ("vehicle_id", _S), ("incidentId", _S), ("type", _S),
                       ("timestamp", _TS), ("location", _S), ("status", _S), ("description", _S)),
}

# Columns the refine step adds (in order) and drops, per feed. `date` is the partition column.
REFINED_ADDED: dict[str, list[tuple[str, DataType]]] = {
    VEHICLE: [("hour", _I), ("speed_kmh", _D), ("is_ev", _B)],
    GPS: [("hour", _I)],
    TRAFFIC: [],
    WEATHER: [("heat_index", _D), ("aqi_category", _S)],
    EMERGENCY: [("is_active", _B), ("is_real_incident", _B)],
}
REFINED_DROPPED: dict[str, tuple[str, ...]] = {TRAFFIC: ("snapshot",)}
PARTITION_COLUMN = "date"


def refined_schema(feed: str) -> StructType:
    """Data columns of a refined table (partition column excluded)."""
    dropped = REFINED_DROPPED.get(feed, ())
    kept = [f for f in FEED_SCHEMAS[feed].fields if f.name not in dropped]
    return StructType(kept + [StructField(n, t, True) for n, t in REFINED_ADDED[feed]])


def table_ddl(db: str, feed: str, location: str) -> str:
    """CREATE TABLE for a refined feed: Parquet, partitioned by a STRING `date`."""
    cols = ",\n  ".join(f"`{f.name}` {f.dataType.simpleString().upper()}"
                        for f in refined_schema(feed).fields)
    return (f"CREATE TABLE IF NOT EXISTS `{db}`.`{feed}` (\n  {cols},\n  `{PARTITION_COLUMN}` STRING\n)\n"
            f"USING parquet\nPARTITIONED BY (`{PARTITION_COLUMN}`)\nLOCATION '{location}'")
