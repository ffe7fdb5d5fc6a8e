"""Feed jobs over the derived message streams: decode -> explode -> project
-> validate, shared by the query registry and the bench."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import rules as R
from ..functions import schemas as SC
from ..operators import alerts as AL
from ..operators import parse as P
from ..sources import fixtures as FX

KEEP = P.MSG_COLS + ["batch_id", "fetched_at", "micro_batch"]


def availability_decoded(spark: SparkSession, d: str, *fields: str) -> DataFrame:
    """The topic decoded with the record fields named (all where none is)."""
    return P.decode(P.with_arrival_hour(FX.availability_messages(spark, d)), SC.record(SC.AVAILABILITY_FIELDS, *fields))


def availability_summary(spark: SparkSession, d: str) -> DataFrame:
    """One row per message of the availability topic, written once in the shared checkpoint folder for the
    branches that read it."""
    from ..session import materialize
    msgs = P.with_arrival_hour(FX.availability_messages(spark, d))
    return materialize(P.summarise(msgs, SC.RULE_RESULT, R.record_reading_valid, R.record_observed_at), "summary")


def stations_summary(spark: SparkSession, d: str) -> DataFrame:
    return P.summarise(P.with_arrival_hour(FX.station_envelopes(spark, d)), SC.STATION_RESULT, R.record_station_valid)


def availability_parsed(spark: SparkSession, d: str, decoded: DataFrame | None = None) -> DataFrame:
    dec = decoded if decoded is not None else availability_decoded(spark, d)
    av = P.project_availability(P.explode_records(dec, keep=KEEP))
    return (av.withColumn("reject_reason", R.reading_reject_reason())
              .withColumn("is_valid", F.col("reject_reason").isNull()))


def stations_decoded(spark: SparkSession, d: str) -> DataFrame:
    return P.decode(P.with_arrival_hour(FX.station_envelopes(spark, d)), SC.STATION_RESULT)


def stations_parsed(spark: SparkSession, d: str) -> DataFrame:
    st = P.project_stations(P.explode_records(stations_decoded(spark, d), keep=KEEP))
    return (st.withColumn("reject_reason", R.station_reject_reason())
              .withColumn("is_valid", F.col("reject_reason").isNull()))


def all_alerts(spark: SparkSession, d: str, av: DataFrame | None = None) -> DataFrame:
    """Every alert kind over the derived feeds (alerts_v), from the message summaries."""
    av = av if av is not None else availability_summary(spark, d)
    return AL.union_alerts(
        AL.reject_rate_alerts(AL.reject_ratio(stations_summary(spark, d)), "Stations", S.SOURCE_STATIONS),
        AL.reject_rate_alerts(AL.reject_ratio(av), "Disponibilite", S.SOURCE_AVAILABILITY),
        AL.freshness_alerts(AL.freshness(av), S.SOURCE_AVAILABILITY),
        AL.empty_fetch_alerts(av),
        AL.feed_gap_alerts(AL.feed_gaps(FX.fetches_v(spark, d))),
        AL.malformed_alerts(av),
    )
