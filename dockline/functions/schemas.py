"""Declared schemas (nothing is inferred on read).

A consumer names the record fields it reads and gets an envelope schema of just these, so the JSON parser
skips the rest.
"""
from __future__ import annotations

from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, DataType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampType)


def _struct(fields: dict[str, DataType]) -> StructType:
    return StructType([StructField(n, t) for n, t in fields.items()])


# ---- fixed values (wire format of the feeds) -------------------------------
GEO = _struct({"lon": DoubleType(), "lat": DoubleType()})
STATION_FIELDS = {
    "stationcode": StringType(),
    "name": StringType(),
    "capacity": LongType(),
    "coordonnees_geo": GEO,
}
AVAILABILITY_FIELDS = {
    "stationcode": StringType(),
    "name": StringType(),
    "capacity": LongType(),
    "numdocksavailable": LongType(),
    "numbikesavailable": LongType(),
    "ebike": LongType(),
    "is_renting": StringType(),
    "is_returning": StringType(),
    "duedate": StringType(),
    "coordonnees_geo": GEO,
    "nom_arrondissement_communes": StringType(),
}
# ---------------------------------------------------------------------------

CORRUPT_COL = "_corrupt_record"


def record(fields: dict, *names: str) -> StructType:
    """Record schema of the named fields (all where none is named)."""
    return _struct({n: fields[n] for n in (names or fields)})


def envelope(record_schema: StructType) -> StructType:
    """One feed page with records of ``record_schema``; text that is no envelope lands in the corrupt column."""
    text = {n: StringType() for n in ("source", "fetched_at", "batch_id")}
    payload = _struct({"total_count": LongType(), "results": ArrayType(record_schema)})
    return _struct({**text, "payload": payload, CORRUPT_COL: StringType()})


STATION_RESULT = record(STATION_FIELDS)
AVAILABILITY_RESULT = record(AVAILABILITY_FIELDS)
# what the reading rule looks at
RULE_RESULT = record(AVAILABILITY_FIELDS, "stationcode", "capacity", "numdocksavailable", "numbikesavailable", "duedate")
CODE_RESULT = record(AVAILABILITY_FIELDS, "stationcode")

# Kafka-shaped record (the stream source contract).
MESSAGE = _struct({"key": BinaryType(), "value": BinaryType(), "topic": StringType(), "partition": IntegerType(),
                   "offset": LongType(), "timestamp": TimestampType(), "timestampType": IntegerType()})

STATIONS = _struct({"station_id": StringType(), "name": StringType(), "latitude": DoubleType(), "longitude": DoubleType(),
                    "capacity": LongType(), "commune": StringType(), "is_installed": BooleanType(), "updated_at": TimestampType()})
