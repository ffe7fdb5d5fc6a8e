"""Envelope decoding and record projections (P1-P7), message summaries.

All steps are narrow (Project / Generate / Filter): no shuffle. ``from_json`` stands once
in a plan of one consumer, with the fields that it reads.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import settings as S
from ..functions import schemas as SC
from ..functions import timefn as T

MSG_COLS = ["topic", "partition", "offset", "timestamp"]


def decode(messages: DataFrame, result_schema: StructType) -> DataFrame:
    """One row per message with the envelope fields. ``is_corrupt`` is
    true when the text is not a JSON envelope (D6); ``n_results`` counts the
    records (NULL or missing array -> 0, A15)."""
    env = F.from_json(F.col("value").cast("string"), SC.envelope(result_schema),
                      {"columnNameOfCorruptRecord": SC.CORRUPT_COL, "mode": "PERMISSIVE"})
    extra = [c for c in messages.columns if c not in MSG_COLS + ["key", "value", "timestampType"]]
    # a generator of one row: Spark moves no filter below it, where it would parse the text once more per condition
    m = messages.select(*MSG_COLS, *extra, F.explode(F.array(env)).alias("env"))
    return m.select(
        *MSG_COLS, *extra,
        F.col("env.source").alias("source"),
        F.col("env.batch_id").alias("batch_id"),
        T.to_ntz(T.parse_instant(F.col("env.fetched_at"))).alias("fetched_at"),
        F.col("env.payload.total_count").alias("total_count"),
        F.col("env.payload.results").alias("results"),
        # a badly typed field fills the corrupt column, too, but leaves the rest of the envelope readable
        (F.col(f"env.{SC.CORRUPT_COL}").isNotNull()
         & F.coalesce(F.col("env.source"), F.col("env.batch_id"), F.col("env.fetched_at")).isNull()
         & F.col("env.payload").isNull()).alias("is_corrupt"),
        F.coalesce(F.size(F.col("env.payload.results")), F.lit(0)).alias("n_results"),
    )


def explode_records(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per element of ``payload.results``; NULL or empty arrays
    give no row. ``pos`` keeps the element position for duplicate ordering (D4)."""
    keep = keep or (MSG_COLS + ["batch_id", "fetched_at"])
    # the outer form: Spark would evaluate the arrays of the inner one once more below it to drop empty ones
    return decoded.select(*keep, F.posexplode_outer("results").alias("pos", "r")).filter(F.col("pos").isNotNull())


def order_key() -> Column:
    """The order in which a keyed write would apply rows."""
    return F.struct(F.col("fetched_at"), F.col("partition"), F.col("offset"), F.col("pos"))


def project_stations(records: DataFrame) -> DataFrame:
    """Flatten station records."""
    return records.select(
        *[c for c in records.columns if c != "r"],
        F.col("r.stationcode").alias("station_id"),
        F.col("r.name").alias("name"),
        F.col("r.capacity").alias("capacity"),
        F.col("r.coordonnees_geo.lat").alias("latitude"),
        F.col("r.coordonnees_geo.lon").alias("longitude"),
    )


def project_availability(records: DataFrame) -> DataFrame:
    """P5 + P7: flatten availability records; booleans from the "OUI" flag
    (NULL stays NULL); ``duedate`` parsed once to an instant, kept as UTC
    wall clock (``timestamp_ntz``) for the tables."""
    return records.select(
        *[c for c in records.columns if c != "r"],
        F.col("r.stationcode").alias("station_id"),
        F.col("r.numbikesavailable").alias("num_bikes_available"),
        F.col("r.ebike").alias("num_ebikes_available"),
        F.col("r.numdocksavailable").alias("num_docks_available"),
        (F.col("r.is_renting") == S.TRUE_FLAG).alias("is_renting"),
        (F.col("r.is_returning") == S.TRUE_FLAG).alias("is_returning"),
        T.to_ntz(T.parse_instant(F.col("r.duedate"))).alias("observed_at"),
        F.col("r.capacity").alias("capacity"),
        F.col("r.name").alias("name"),
        F.col("r.coordonnees_geo.lat").alias("latitude"),
        F.col("r.coordonnees_geo.lon").alias("longitude"),
        F.col("r.nom_arrondissement_communes").alias("commune"),
    )


FACT_COLS = ["station_id", "num_bikes_available", "num_ebikes_available", "num_docks_available",
             "is_renting", "is_returning", "observed_at", "batch_id"]


def fact_rows(valid_availability: DataFrame) -> DataFrame:
    """Drop the reference attributes; every row keeps its own envelope's
    ``batch_id`` (D2)."""
    return valid_availability.select(*FACT_COLS)


def with_arrival_hour(messages: DataFrame, col: str = "micro_batch") -> DataFrame:
    """Batch stand-in for a streaming micro-batch: messages that arrived in
    the same clock hour form one batch."""
    return messages.withColumn(col, F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))


# ---- one row per message ---------------------------------------------------
def summarise(messages: DataFrame, record_schema: StructType, valid, observed=None) -> DataFrame:
    """One small row per message instead of its records: how many there are (``n_total``), how many ``valid``
    lets through (``n_valid``), and of these the newest observation and the sum of
    their ages at the fetch in microseconds. Both are functions of one record; the array is reduced inside
    the row, so nothing is exploded or shuffled."""
    dec = decode(messages, record_schema)
    kept = [c for c in dec.columns if c not in ("results", "total_count")]
    good = F.filter(F.coalesce(F.col("results"), F.array()), valid)
    seen = F.transform(F.col("good"), observed) if observed else F.array().cast("array<timestamp_ntz>")
    df = dec.select(*kept, F.col("n_results").alias("n_total"), good.alias("good"))
    df = df.select(*kept, "n_total", F.size("good").alias("n_valid"), seen.alias("seen"))
    fetched = F.unix_micros(F.col("fetched_at").cast("timestamp"))
    age = F.aggregate("seen", F.lit(0).cast("bigint"), lambda acc, t: acc + fetched - F.unix_micros(t.cast("timestamp")))
    return df.select(*kept, "n_total", "n_valid", F.array_max("seen").alias("newest_observed"), age.alias("age_us"))
