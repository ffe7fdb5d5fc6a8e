"""Query registry: one callable (spark, sf_dir) -> DataFrame per key of the
operator inventory. Every query reads the driver tables (or DataFrames Spark
derives from them) in full."""
from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import session as SESSION
from .. import settings as S
from ..functions import rules as R
from ..functions import schemas as SC
from ..functions import timefn as T
from ..operators import alerts as AL
from ..operators import analytics as A
from ..operators import demand as DM
from ..operators import merge as M
from ..operators import parse as P
from ..operators import recommend as RC
from ..sources import bronze as BZ
from ..sources import fixtures as FX
from . import jobs as J

USER_POSITION = (48.8530, 2.3499)   # example user position of the recommender

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, d: str) -> DataFrame:
            SESSION.prepare(spark)
            return fn(spark, d)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run
    return deco


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _st(spark, d):
    return FX.stations_v(spark, d)


def _rd(spark, d):
    return FX.readings_v(spark, d)


# ---- dashboard and descriptive statistics --------------------------------
@query("top_stations_panel")
def top_stations_panel(spark, d):
    return A.top_stations_panel(_rd(spark, d), _st(spark, d))


@query("network_overview")
def network_overview(spark, d):
    return A.network_overview(_st(spark, d), _rd(spark, d))


@query("observation_span")
def observation_span(spark, d):
    return A.observation_span(_rd(spark, d))


@query("network_occupancy")
def network_occupancy(spark, d):
    return A.network_occupancy(_rd(spark, d))


@query("capacity_incoherent")
def capacity_incoherent(spark, d):
    return A.capacity_incoherent(_rd(spark, d), _st(spark, d))


@query("stations_by_commune")
def stations_by_commune(spark, d):
    return A.stations_by_commune(_st(spark, d))


@query("station_occupancy")
def station_occupancy(spark, d):
    return A.station_occupancy(_rd(spark, d), _st(spark, d))


@query("top10_loaded")
def top10_loaded(spark, d):
    return A.top10_loaded(_rd(spark, d), _st(spark, d))


@query("bottom10_loaded")
def bottom10_loaded(spark, d):
    return A.bottom10_loaded(_rd(spark, d), _st(spark, d))


@query("hourly_availability")
def hourly_availability(spark, d):
    return A.hourly_availability(_rd(spark, d))


@query("hourly_resample")
def hourly_resample(spark, d):
    return A.hourly_resample(_rd(spark, d))


@query("latest_reading")
def latest_reading(spark, d):
    return A.latest_reading(_rd(spark, d))


@query("bikes_histogram")
def bikes_histogram(spark, d):
    # the notebook bins the readings left-joined to stations; station_id is the
    # stations key, so the join cannot change the rows and is left out
    return A.bikes_histogram(_rd(spark, d))


@query("occupancy_per_reading")
def occupancy_per_reading(spark, d):
    return A.occupancy_per_reading(_rd(spark, d))


@query("calendar_features")
def calendar_features(spark, d):
    return _rd(spark, d).select("station_id", "observed_at",
                                T.hour_of_day("observed_at").alias("hour"),
                                T.weekday_monday0("observed_at").alias("weekday"))


@query("readings_enriched")
def readings_enriched(spark, d):
    return A.readings_enriched(_rd(spark, d), _st(spark, d))


@query("orphan_readings")
def orphan_readings(spark, d):
    return A.orphan_readings(_rd(spark, d), FX.known_stations_v(spark, d)).select("station_id", "observed_at")


@query("message_rate")
def message_rate(spark, d):
    return A.message_rate(FX.messages_v(spark, d))


# ---- quality rules --------------------------------------------------------
def _readings_with_capacity(spark, d):
    return _rd(spark, d).join(_st(spark, d).select("station_id", "capacity"), "station_id", "left")


@query("valid_stations")
def valid_stations(spark, d):
    return _st(spark, d).filter(R.station_valid()).select("station_id", "name", "capacity", "latitude", "longitude")


@query("valid_readings")
def valid_readings(spark, d):
    return (_readings_with_capacity(spark, d).filter(R.reading_valid())
            .select("station_id", "observed_at", "num_bikes_available", "num_docks_available", "capacity"))


@query("valid_readings_strict")
def valid_readings_strict(spark, d):
    return (_readings_with_capacity(spark, d).filter(R.reading_valid(strict=True))
            .select("station_id", "observed_at", "num_bikes_available", "num_docks_available", "capacity"))


@query("reject_reasons")
def reject_reasons(spark, d):
    st = _st(spark, d).select(F.lit(S.SOURCE_STATIONS).alias("feed"), R.station_reject_reason().alias("reason"))
    rd = _readings_with_capacity(spark, d).select(F.lit(S.SOURCE_AVAILABILITY).alias("feed"),
                                                  R.reading_reject_reason().alias("reason"))
    return (st.unionByName(rd).filter(F.col("reason").isNotNull())
            .groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("n")))


@query("constraint_violations")
def constraint_violations(spark, d):
    """F8 over the availability feed: fact rows that break the readings
    table, and the station attributes they carry (stub candidates) that break
    the stations table. Such rows go to quarantine instead of aborting."""
    av = J.availability_parsed(spark, d).filter("is_valid")
    facts = av.select("station_id", "observed_at", R.reading_row_violation().alias("violation")) \
        .withColumn("table_name", F.lit("disponibilite_releve"))
    stubs = (av.select("station_id", "name", "latitude", "longitude", "capacity", "commune").distinct()
             .select("station_id", F.lit(None).cast("timestamp_ntz").alias("observed_at"),
                     R.station_row_violation().alias("violation"))
             .withColumn("table_name", F.lit("stations")))
    return (facts.unionByName(stubs).filter(F.col("violation").isNotNull())
            .select("table_name", "station_id", "observed_at", "violation"))


# ---- envelope round trip --------------------------------------------------
@query("parse_props")
def parse_props(spark, d):
    dec = J.availability_decoded(spark, d, "stationcode")
    return dec.select("topic", "partition", "offset", "source", "batch_id", "fetched_at",
                      "total_count", "n_results", "is_corrupt")


@query("explode_results")
def explode_results(spark, d):
    rec = P.explode_records(J.availability_decoded(spark, d, "stationcode"), keep=["batch_id"])
    return rec.select("batch_id", F.col("pos").cast("int").alias("pos"), F.col("r.stationcode").alias("station_id"))


@query("station_project")
def station_project(spark, d):
    return J.stations_parsed(spark, d).select("batch_id", "station_id", "name", "capacity", "latitude", "longitude")


@query("reading_project")
def reading_project(spark, d):
    return J.availability_parsed(spark, d).select(
        "batch_id", "station_id", "num_bikes_available", "num_ebikes_available", "num_docks_available",
        "is_renting", "is_returning", "observed_at", "capacity", "name", "latitude", "longitude", "commune")


@query("reading_fact_rows")
def reading_fact_rows(spark, d):
    return P.fact_rows(J.availability_parsed(spark, d).filter("is_valid"))


@query("timestamp_parse")
def timestamp_parse(spark, d):
    rec = P.explode_records(J.availability_decoded(spark, d, "stationcode", "duedate"), keep=["batch_id"])
    return rec.select(F.col("r.stationcode").alias("station_id"), F.col("r.duedate").alias("duedate"),
                      T.to_ntz(T.parse_instant(F.col("r.duedate"))).alias("observed_at"))


@query("envelope_build")
def envelope_build(spark, d):
    """Build the availability envelopes, then decode what was built."""
    env = FX.availability_envelopes(spark, d)
    dec = P.decode(env, SC.CODE_RESULT)
    return dec.select("source", "batch_id", "fetched_at", "total_count", "n_results")


@query("bronze_archive")
def bronze_archive(spark, d):
    """S3: archive the raw availability topic (value unchanged, partitioned
    by source and day), then list what the archive holds."""
    path = SESSION.shared_path(spark, "bronze")
    BZ.archive(FX.availability_messages(spark, d), path)
    return BZ.listing(spark, path)


@query("bronze_replay")
def bronze_replay(spark, d):
    """Replay the archived messages through the same parse/validate path."""
    path = SESSION.shared_path(spark, "bronze")
    BZ.archive(FX.availability_messages(spark, d), path)
    msgs = P.with_arrival_hour(BZ.replay(spark, path))
    dec = P.decode(msgs, SC.AVAILABILITY_RESULT)
    av = J.availability_parsed(spark, d, dec)
    return P.fact_rows(av.filter("is_valid"))


# ---- keyed writes ---------------------------------------------------------
@query("station_upsert")
def station_upsert(spark, d):
    st = J.stations_parsed(spark, d).filter("is_valid")
    return M.station_upsert(FX.stored_stations_v(spark, d), st, P.order_key(), F.col("fetched_at"))


def dup_readings(av: DataFrame) -> DataFrame:
    """Valid fact rows of the feed plus a second, later delivery of every
    tenth reading with one more bike (a replayed page)."""
    order = ["fetched_at", "partition", "offset", "pos"]
    base = av.select(*P.FACT_COLS, *order)
    again = (av.filter(F.col("num_bikes_available") % 10 == 0)
             .withColumn("num_bikes_available", F.col("num_bikes_available") + 1)
             .withColumn("batch_id", F.concat(F.lit("dup-"), F.col("batch_id")))
             .withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 1 DAY")).select(*P.FACT_COLS, *order))
    return base.unionByName(again)


@query("reading_dedup")
def reading_dedup(spark, d):
    """First-wins insert of the duplicated feed into a table that
    already holds the morning readings. The feed is parsed once."""
    av = J.availability_parsed(spark, d).filter("is_valid").select(*P.FACT_COLS, "fetched_at", "partition", "offset", "pos")
    av = SESSION.materialize(av, "facts")
    target = av.filter(F.hour("observed_at") < 12).select(*P.FACT_COLS)
    inserted = M.reading_insert(target, dup_readings(av), P.order_key(), P.FACT_COLS)
    return target.unionByName(inserted)


@query("station_stub")
def station_stub(spark, d):
    snap = FX.known_stations_v(spark, d)
    av = J.availability_parsed(spark, d).filter("is_valid")
    ok, _ = M.station_stubs(snap, av, P.order_key(), F.col("fetched_at"))
    old = snap.select("station_id", "name", "latitude", "longitude", "capacity", F.lit("snapshot").alias("origin"))
    new = ok.select("station_id", "name", "latitude", "longitude", "capacity", F.lit("stub").alias("origin"))
    return old.unionByName(new)


@query("commune_backfill")
def commune_backfill(spark, d):
    snap = FX.known_stations_v(spark, d).withColumn("commune", F.lit("UNKNOWN"))
    av = J.availability_parsed(spark, d).filter("is_valid")
    upd = M.commune_updates(av, P.order_key())
    return M.commune_backfill(snap, upd).select("station_id", "commune")


# ---- alerts ---------------------------------------------------------------
@query("reject_ratio")
def reject_ratio(spark, d):
    r = AL.reject_ratio(J.availability_summary(spark, d))
    return r.select("micro_batch", "batch_id", "n_total", "n_valid", "reject_ratio")


@query("freshness")
def freshness(spark, d):
    f = AL.freshness(J.availability_summary(spark, d))
    return f.select("micro_batch", "batch_id", "max_observed_at", "as_of", "freshness_min")


@query("alert_reject_rate")
def alert_reject_rate(spark, d):
    return AL.union_alerts(
        AL.reject_rate_alerts(AL.reject_ratio(J.stations_summary(spark, d)), "Stations", S.SOURCE_STATIONS),
        AL.reject_rate_alerts(AL.reject_ratio(J.availability_summary(spark, d)), "Disponibilite",
                              S.SOURCE_AVAILABILITY))


@query("alert_freshness")
def alert_freshness(spark, d):
    return AL.freshness_alerts(AL.freshness(J.availability_summary(spark, d)), S.SOURCE_AVAILABILITY)


@query("empty_fetches")
def empty_fetches(spark, d):
    return AL.empty_fetch_alerts(J.availability_decoded(spark, d, "stationcode"))


@query("malformed_messages")
def malformed_messages(spark, d):
    return AL.malformed_alerts(J.availability_decoded(spark, d, "stationcode"))


@query("alert_feed_gap")
def alert_feed_gap(spark, d):
    return AL.feed_gap_alerts(AL.feed_gaps(FX.fetches_v(spark, d)))


@query("alerts_all")
def alerts_all(spark, d):
    return J.all_alerts(spark, d)


@query("alert_counts")
def alert_counts(spark, d):
    return A.alert_counts(J.all_alerts(spark, d))


@query("latest_alerts")
def latest_alerts(spark, d):
    return A.latest_alerts(J.all_alerts(spark, d))


@query("pipeline_kpis")
def pipeline_kpis(spark, d):
    """Q7: share rejected, alert count, feed latency and feed availability."""
    av = J.availability_summary(spark, d)
    msg = av.agg(F.count(F.lit(1)).alias("n_messages"), F.count_if("is_corrupt").alias("n_malformed"))
    rec = av.filter("n_total > 0").agg(
        F.sum("n_total").alias("n_records"),
        (F.sum("n_total") - F.sum("n_valid")).alias("n_rejected"),
        F.round(F.sum("age_us") / F.nullif(F.sum(F.when(F.col("age_us").isNotNull(), F.col("n_valid"))), F.lit(0)) / F.lit(60_000_000.0), 6)
         .alias("avg_feed_latency_min"),
        F.count_distinct("micro_batch").alias("n_batches"),
        F.min("micro_batch").alias("_b0"), F.max("micro_batch").alias("_b1"))
    n_alerts = J.all_alerts(spark, d, av).select(F.count(F.lit(1))).scalar()
    # one scalar subquery returning a struct: the record aggregate runs once
    out = msg.withColumn("_r", rec.select(F.struct(*rec.columns)).scalar()).select(
        "n_messages", "n_malformed", "_r.*")
    expected = F.floor(T.minutes_between(F.col("_b1"), F.col("_b0")) / 60).cast("bigint") + 1
    return out.select(
        "n_messages", "n_malformed", "n_records", "n_rejected",
        F.round(F.col("n_rejected") / F.nullif(F.col("n_records"), F.lit(0)), 9).alias("reject_share"),
        n_alerts.alias("n_alerts"), "avg_feed_latency_min",
        F.round(F.col("n_batches") / expected, 9).alias("feed_availability"))


# ---- recommender and models ----------------------------------------------
@query("haversine_distance")
def haversine_distance(spark, d):
    return RC.station_distances(_st(spark, d), *USER_POSITION)


@query("recommend_bike")
def recommend_bike(spark, d):
    return RC.recommend(RC.latest_stock(_rd(spark, d), _st(spark, d)), *USER_POSITION, need="velo")


@query("recommend_dock")
def recommend_dock(spark, d):
    return RC.recommend(RC.latest_stock(_rd(spark, d), _st(spark, d)), *USER_POSITION, need="dock")


@query("recommend_many_users")
def recommend_many_users(spark, d):
    return RC.recommend_many(FX.positions_v(spark, d), RC.latest_stock(_rd(spark, d), _st(spark, d)), need="velo")


@query("ml_training_set")
def ml_training_set(spark, d):
    return DM.training_set(_rd(spark, d), _st(spark, d))


@query("ml_split_counts")
def ml_split_counts(spark, d):
    return DM.split_counts(_rd(spark, d), _st(spark, d))


def _fitted(spark, d):
    """The models fitted on ``d``, once per session; the session's settings remember where they are saved."""
    key = "dockline.models." + hashlib.md5(d.encode()).hexdigest()
    path = spark.conf.get(key, None)
    if path is None:
        path = SESSION.shared_path(spark, "models")
        DM.save(path, *DM.fit_and_compare(_rd(spark, d), _st(spark, d)))
        spark.conf.set(key, path)
        SESSION.tidy(spark)
    return DM.load(spark, path)


@query("model_comparison")
def model_comparison(spark, d):
    comp, _, _ = _fitted(spark, d)
    return comp


@query("feature_importance")
def feature_importance(spark, d):
    """Of the best tree model; a linear one has no importances."""
    comp, model, test = _fitted(spark, d)
    return DM.feature_importance(model(DM.best_model_name(comp, trees_only=True)), test)


@query("prediction_vs_actual")
def prediction_vs_actual(spark, d):
    comp, model, test = _fitted(spark, d)
    return DM.prediction_vs_actual(model(DM.best_model_name(comp)), test)
