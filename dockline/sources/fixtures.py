"""Domain views derived deterministically from the driver tables.

The driver ships no bike-share data, so stations, readings and feed
messages are projections of ``customer``, ``nation``, ``events`` and
``supplier``. Every view is a lazy DataFrame over the whole tables: its work
grows with them. The same definitions exist as DuckDB CTEs in
``dockline.plans.oracle``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import timefn as T
from ..operators.publish import envelope_json, pages
from .tables import table

AVAILABILITY_TOPIC = "availability.raw"
STATIONS_TOPIC = "stations.raw"


def _custkey_station(k: Column, name: Column, commune: Column) -> list[Column]:
    return [
        k.cast("string").alias("station_id"),
        name.alias("name"),
        F.when(k % 53 == 7, F.lit(43.2965))
         .otherwise(F.lit(48.80) + (k % 101).cast("double") * F.lit(0.001)).alias("latitude"),
        (F.lit(2.25) + (k % 151).cast("double") * F.lit(0.001)).alias("longitude"),
        F.when(k % 37 == 5, F.lit(None).cast("bigint")).otherwise(F.lit(40) + k % 41).alias("capacity"),
        F.when(k % 11 == 3, F.lit(None).cast("string")).otherwise(commune).alias("commune"),
    ]


def stations_base(spark: SparkSession, d: str) -> DataFrame:
    """Stations = customers that appear in ``events`` (semi join against the
    distinct users, which partial aggregation bounds by the customer count)."""
    users = table(spark, d, "events", "user_id").distinct()
    c = table(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    c = c.join(users, c.c_custkey == users.user_id, "left_semi")
    n = table(spark, d, "nation", "n_nationkey", "n_name")
    s = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return s.select(F.col("c_custkey").alias("skey"),
                    *_custkey_station(F.col("c_custkey"), F.col("c_name"), F.col("n_name")))


def stations_v(spark: SparkSession, d: str) -> DataFrame:
    return stations_base(spark, d).drop("skey")


def readings_base(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    k = F.get_json_object("props", "$.k").try_cast("bigint")
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").alias("station_id"),
        F.floor(F.col("value") / 4).cast("bigint").alias("num_bikes_available"),
        (k % 5).alias("num_ebikes_available"),
        (k % 40).alias("num_docks_available"),
        (F.col("event_type") != "error").alias("is_renting"),
        (F.col("event_type") != "signup").alias("is_returning"),
        F.col("ts").alias("observed_at"),
    )


def readings_v(spark: SparkSession, d: str) -> DataFrame:
    return readings_base(spark, d).drop("event_id")


def known_stations_v(spark: SparkSession, d: str) -> DataFrame:
    """The stations snapshot as it stood before the availability feed ran:
    every station whose key is not a multiple of 4."""
    return stations_base(spark, d).filter(F.col("skey") % 4 != 0).drop("skey")


def stored_stations_v(spark: SparkSession, d: str) -> DataFrame:
    """``known_stations_v`` as a stored table: last written long ago, every fifth station out of service."""
    s = stations_base(spark, d).filter(F.col("skey") % 4 != 0)
    return s.select("station_id", "name", "latitude", "longitude", F.coalesce("capacity", F.lit(1)).alias("capacity"), "commune",
                    (F.col("skey") % 5 != 0).alias("is_installed"), F.lit("2000-01-01 00:00:00").cast("timestamp_ntz").alias("updated_at"))


def positions_v(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, d, "supplier", "s_suppkey").select(
        k.alias("position_id"),
        (F.lit(48.82) + (k % 60).cast("double") * F.lit(0.001)).alias("latitude"),
        (F.lit(2.28) + (k % 120).cast("double") * F.lit(0.001)).alias("longitude"))


def fetches_v(spark: SparkSession, d: str) -> DataFrame:
    """Distinct fetch minutes per source (event type)."""
    ev = table(spark, d, "events", "event_type", "ts")
    return ev.select(F.col("event_type").alias("source"),
                     F.date_trunc("minute", "ts").cast("timestamp_ntz").alias("fetched_at")).distinct()


def messages_v(spark: SparkSession, d: str) -> DataFrame:
    ev = table(spark, d, "events", "event_type", "ts")
    return ev.select(F.col("event_type").alias("topic"), F.col("ts").alias("timestamp"))


# ---- feed records and envelopes ------------------------------------------
def _flag(c: Column) -> Column:
    return F.when(c, F.lit(S.TRUE_FLAG)).when(~c, F.lit("NON"))


def availability_records(spark: SparkSession, d: str) -> DataFrame:
    """One availability feed record per reading, carrying the station's
    reference attributes as the live feed does."""
    r = readings_base(spark, d)
    s = stations_v(spark, d)
    j = r.join(s, "station_id", "left")
    rec = F.struct(
        F.col("station_id").alias("stationcode"), F.col("name"), F.col("capacity"),
        F.col("num_docks_available").alias("numdocksavailable"),
        F.col("num_bikes_available").alias("numbikesavailable"),
        F.col("num_ebikes_available").alias("ebike"),
        _flag(F.col("is_renting")).alias("is_renting"),
        _flag(F.col("is_returning")).alias("is_returning"),
        T.iso_utc(F.col("observed_at")).alias("duedate"),
        F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("coordonnees_geo"),
        F.col("commune").alias("nom_arrondissement_communes"),
    )
    return j.select("event_id", "station_id", "observed_at",
                    F.date_trunc("hour", "observed_at").cast("timestamp_ntz").alias("slot"),
                    rec.alias("record"))


def _paged(df: DataFrame, slot: str, key: str, counts: DataFrame | None = None) -> DataFrame:
    """Split each slot into pages of about PAGE_SIZE records: pages =
    ceil(n / PAGE_SIZE), page = key mod pages. The per-slot counts are one row
    per slot (bounded by the time span), so the join back is a small build
    side; ``counts`` (slot, _n) may come from a cheaper source than ``df``."""
    if counts is None:
        counts = df.groupBy(slot).agg(F.count(F.lit(1)).alias("_n"))
    return (df.join(counts, slot)
              .withColumn("_pages", F.ceil(F.col("_n") / F.lit(S.PAGE_SIZE)))
              .withColumn("page", F.pmod(F.col(key), F.col("_pages")))
              .drop("_n", "_pages"))


def _kafka_shape(df: DataFrame, topic: str, value: Column, partition: Column, offset: Column,
                 ts: Column) -> DataFrame:
    return df.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        partition.cast("int").alias("partition"),
        offset.cast("bigint").alias("offset"),
        ts.cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def availability_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Hourly fetches of the availability feed, paged by PAGE_SIZE: one
    envelope per (hour, page), fetched at the end of the hour. Columns: the
    Kafka record shape plus ``fetched_at`` (ntz), ``batch_id``, ``n_results``."""
    # one availability record per event: count the slots from the timestamp column alone
    counts = (table(spark, d, "events", "ts")
              .groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("slot"))
              .agg(F.count(F.lit(1)).alias("_n")))
    rec = _paged(availability_records(spark, d), "slot", "event_id", counts)
    env = pages(rec, ["slot", "page"], ["observed_at", "station_id", "event_id"])
    fetched = (F.col("slot") + F.expr("INTERVAL 1 HOUR")).cast("timestamp_ntz")
    batch_id = F.concat(F.lit("b-"), F.date_format("slot", "yyyyMMddHH"), F.lit("-"), F.col("page").cast("string"))
    env = env.select("slot", "page", fetched.alias("fetched_at"), batch_id.alias("batch_id"),
                     "results")
    hour_index = F.floor(F.unix_micros(F.col("slot").cast("timestamp")) / F.lit(3_600_000_000))
    out = _kafka_shape(
        env, AVAILABILITY_TOPIC,
        envelope_json(S.SOURCE_AVAILABILITY, F.col("fetched_at"), F.col("batch_id"), F.col("results")),
        F.pmod(F.col("page"), F.lit(4)), hour_index * S.PAGES_PER_SLOT + F.col("page"), F.col("fetched_at"))
    return out


def injected_bad_messages(spark: SparkSession, d: str) -> DataFrame:
    """Messages a real feed also delivers: unparseable text (events with
    id % 97 = 0) and well-formed envelopes with no results (id % 89 = 0)."""
    ev = table(spark, d, "events", "event_id", "ts", "props")
    bad = ev.filter((F.col("event_id") % 97 == 0) | (F.col("event_id") % 89 == 0))
    empty_value = envelope_json(S.SOURCE_AVAILABILITY, F.col("ts"),
                                 F.concat(F.lit("e-"), F.col("event_id").cast("string")),
                                 F.array().cast("array<string>"))
    value = F.when(F.col("event_id") % 97 == 0, F.substring("props", 2, 1 << 30)).otherwise(empty_value)
    return _kafka_shape(bad, AVAILABILITY_TOPIC, value, F.lit(4), F.col("event_id"), F.col("ts"))


def availability_messages(spark: SparkSession, d: str) -> DataFrame:
    """The raw availability topic: good envelopes plus injected bad ones."""
    return availability_envelopes(spark, d).unionByName(injected_bad_messages(spark, d))


def station_envelopes(spark: SparkSession, d: str) -> DataFrame:
    """Daily fetches of the station feed: every station seen in the readings
    of a day, capacity + (day of month % 2), paged by PAGE_SIZE, fetched at
    the next midnight."""
    seen = (table(spark, d, "events", "user_id", "ts")
            .select(F.col("user_id").alias("skey"), F.to_date("ts").alias("day")).distinct())
    s = stations_base(spark, d)
    j = seen.join(s, "skey")
    rec = F.struct(
        F.col("station_id").alias("stationcode"), F.col("name"),
        (F.col("capacity") + F.dayofmonth("day") % 2).alias("capacity"),
        F.struct(F.col("longitude").alias("lon"), F.col("latitude").alias("lat")).alias("coordonnees_geo"),
    )
    j = _paged(j.select("skey", "day", "station_id", rec.alias("record")), "day", "skey")
    env = pages(j, ["day", "page"], ["skey"])
    fetched = F.date_add("day", 1).cast("timestamp_ntz")
    batch_id = F.concat(F.lit("s-"), F.date_format("day", "yyyyMMdd"), F.lit("-"), F.col("page").cast("string"))
    env = env.select("day", "page", fetched.alias("fetched_at"), batch_id.alias("batch_id"), "results")
    day_index = F.datediff(F.col("day"), F.lit("1970-01-01").cast("date"))
    return _kafka_shape(
        env, STATIONS_TOPIC,
        envelope_json(S.SOURCE_STATIONS, F.col("fetched_at"), F.col("batch_id"), F.col("results")),
        F.pmod(F.col("page"), F.lit(2)), day_index * S.PAGES_PER_SLOT + F.col("page"), F.col("fetched_at"))
