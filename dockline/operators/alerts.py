"""Quality and supervision alerts.

Records are reduced to one row per message first (``per_message``, or inside the row by
``parse.summarise``); the measures of a micro-batch are aggregates over messages with
map-side partial aggregation, so a hot micro-batch or source is combined per task before the shuffle.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import timefn as T

ALERT_COLS = ["alert_id", "alert_type", "severity", "description", "metric_value", "batch_id", "detected_at"]


def _tenths(x: Column) -> Column:
    """Text of x rounded half-up to one decimal, from integer arithmetic so
    every engine prints the same digits."""
    t = F.floor(x * F.lit(10.0) + F.lit(0.5)).cast("bigint")
    return F.concat(F.floor(t / 10).cast("bigint").cast("string"), F.lit("."), F.pmod(t, F.lit(10)).cast("string"))


def _alert(df: DataFrame, alert_type: str, severity: str, description: Column, metric: Column,
           batch_id: Column, detected_at: Column, id_parts: list[Column]) -> DataFrame:
    return df.select(
        F.md5(F.concat_ws("|", F.lit(alert_type), *id_parts)).alias("alert_id"),
        F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"),
        description.alias("description"),
        metric.cast("double").alias("metric_value"),
        batch_id.cast("string").alias("batch_id"),
        detected_at.cast("timestamp_ntz").alias("detected_at"),
    )


# ---- one row per message ---------------------------------------------------
def per_message(validated: DataFrame, batch_col: str = "micro_batch", valid_col: str = "is_valid") -> DataFrame:
    """Counts and newest valid observation of every message, from its validated records. All aggregates are of
    fixed width, so records go through a hash aggregate; frames that hold one row per message
    already (``parse.summarise``) are returned as they are."""
    if "n_total" in validated.columns:
        return validated
    seen = F.max(F.when(F.col(valid_col), F.col("observed_at"))) if "observed_at" in validated.columns else F.lit(None).cast("timestamp_ntz")
    return validated.groupBy(batch_col, "timestamp", "topic", "partition", "offset", "batch_id", "fetched_at").agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(F.col(valid_col)).alias("n_valid"), seen.alias("newest_observed"))


_NEWEST = ("timestamp", "partition", "offset")


# ---- A12: reject ratio per micro-batch ------------------------------------
def reject_ratio(validated: DataFrame, batch_col: str = "micro_batch", valid_col: str = "is_valid") -> DataFrame:
    """One row per micro-batch with records: records, valid records, ratio, the id of the
    batch's newest message by (timestamp, partition, offset) (D2) and the
    newest fetch time (the batch's ``as_of``). The ratio is rejected / total:
    ``1 - valid / total`` would give 0.020000000000000018 for 2 rejects in
    100 and break the strict threshold."""
    m = per_message(validated, batch_col, valid_col).filter("n_total > 0")
    return (m.groupBy(batch_col).agg(
        F.sum("n_total").alias("n_total"),
        F.sum("n_valid").alias("n_valid"),
        F.max_by("batch_id", F.struct(*_NEWEST)).alias("batch_id"),
        F.max("fetched_at").alias("as_of"),
    ).withColumn("reject_ratio", (F.col("n_total") - F.col("n_valid")).cast("double") / F.col("n_total")))


def reject_rate_alerts(ratios: DataFrame, feed_label: str, source: str) -> DataFrame:
    """Q1 / Q2: ratio strictly above the threshold."""
    hot = ratios.filter(F.col("reject_ratio") > S.REJECT_RATE_ALERT_THRESHOLD)
    desc = F.concat(F.lit(f"{feed_label} : "), _tenths(F.col("reject_ratio") * 100),
                    F.lit("% of records rejected by the quality rules"))
    return _alert(hot, "TAUX_REJET_ELEVE", "WARNING", desc, F.col("reject_ratio"), F.col("batch_id"),
                  F.col("as_of"), [F.lit(source), F.col("batch_id")])


# ---- A13: freshness per micro-batch --------------------------------------
def freshness(validated: DataFrame, batch_col: str = "micro_batch", valid_col: str = "is_valid",
              as_of: Column | None = None) -> DataFrame:
    """Age in minutes of the newest *valid* reading of each micro-batch, seen
    from ``as_of`` (default: the batch's newest fetch time; D9). Batches
    without a valid row give no row (no freshness alert)."""
    m = per_message(validated, batch_col, valid_col).filter("n_valid > 0")
    g = m.groupBy(batch_col).agg(
        F.max("newest_observed").alias("max_observed_at"),
        F.max("fetched_at").alias("as_of"),
        F.max_by("batch_id", F.struct(*_NEWEST)).alias("batch_id"))
    if as_of is not None:
        g = g.withColumn("as_of", as_of.cast("timestamp_ntz"))
    return g.withColumn("freshness_min", T.minutes_between(F.col("as_of"), F.col("max_observed_at")))


def freshness_alerts(fresh: DataFrame, source: str) -> DataFrame:
    """Q3: newest valid reading strictly older than the threshold."""
    hot = fresh.filter(F.col("freshness_min") > S.FRESHNESS_ALERT_THRESHOLD_MINUTES)
    desc = F.concat(F.lit("newest reading is "), _tenths(F.col("freshness_min")), F.lit(" minutes old"))
    return _alert(hot, "FRAICHEUR_DEGRADEE", "WARNING", desc, F.col("freshness_min"), F.col("batch_id"),
                  F.col("as_of"), [F.lit(source), F.col("batch_id")])


# ---- A15 / Q4: empty fetches ---------------------------------------------
def empty_fetch_alerts(decoded: DataFrame) -> DataFrame:
    """Q4: a parsed envelope with no results (missing array counts as 0)."""
    hot = decoded.filter(~F.col("is_corrupt") & (F.col("n_results") == 0))
    desc = F.concat(F.coalesce(F.col("source"), F.lit("unknown")), F.lit(" returned 0 records"))
    return _alert(hot, "API_REPONSE_VIDE", "WARNING", desc, F.lit(None), F.lit(None),
                  F.col("timestamp"),
                  [F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")])


# ---- Q6: malformed messages ----------------------------------------------
def malformed_alerts(decoded: DataFrame) -> DataFrame:
    hot = decoded.filter(F.col("is_corrupt"))
    desc = F.concat(F.lit("unparseable message "), F.col("topic"), F.lit("/"),
                    F.col("partition").cast("string"), F.lit("/"), F.col("offset").cast("string"))
    return _alert(hot, "SCHEMA_INVALIDE", "CRITICAL", desc, F.lit(None), F.lit(None), F.col("timestamp"),
                  [F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")])


# ---- Q5: feed gaps -------------------------------------------------------
def feed_gaps(fetches: DataFrame, source_col: str = "source", ts_col: str = "fetched_at") -> DataFrame:
    """Gap to the previous fetch of the same source. The input is first
    reduced to distinct fetch minutes, so a window partition holds at most one
    row per minute of the time span whatever the data volume."""
    minutes = (fetches.select(F.col(source_col).alias("source"),
                              F.date_trunc("minute", ts_col).cast("timestamp_ntz").alias("fetched_at"))
               .distinct())
    w = Window.partitionBy("source").orderBy("fetched_at")
    return (minutes.withColumn("previous_fetch", F.lag("fetched_at").over(w))
                   .filter(F.col("previous_fetch").isNotNull())
                   .withColumn("gap_min", T.minutes_between(F.col("fetched_at"), F.col("previous_fetch"))))


def gaps_after(fetches: DataFrame, state: DataFrame | None) -> DataFrame:
    """``feed_gaps`` of a micro-batch that knows the newest earlier fetch per source (``state``: source,
    last_fetch). Fetches up to that one have been judged by the epoch that saw them."""
    if state is None:
        return feed_gaps(fetches)
    last = state.select("source", F.date_trunc("minute", "last_fetch").cast("timestamp_ntz").alias("last_fetch"))
    late = fetches.join(last, "source", "left").filter("last_fetch IS NULL OR fetched_at > last_fetch").select("source", "fetched_at")
    return feed_gaps(late.unionByName(last.select("source", F.col("last_fetch").alias("fetched_at"))))


def silence_alerts(state: DataFrame, as_of: Column, threshold_min: float = S.FEED_GAP_MINUTES) -> DataFrame:
    """Q5 without a new message: sources whose newest fetch is older than the threshold at ``as_of``."""
    at = as_of.cast("timestamp_ntz")
    silent = state.select("source", at.alias("now"), "last_fetch", T.minutes_between(at, F.col("last_fetch")).alias("gap_min"))
    hot = silent.filter(F.col("gap_min") > threshold_min)
    desc = F.concat(F.col("source"), F.lit(" feed silent for "), _tenths(F.col("gap_min")), F.lit(" minutes"))
    # one alert per silence, however often it is looked at
    return _alert(hot, "API_INDISPONIBLE", "CRITICAL", desc, F.col("gap_min"), F.lit(None), F.col("now"),
                  [F.col("source"), F.lit("since"), F.unix_micros(F.col("last_fetch").cast("timestamp")).cast("string")])


def feed_gap_alerts(gaps: DataFrame, threshold_min: float = S.FEED_GAP_MINUTES) -> DataFrame:
    hot = gaps.filter(F.col("gap_min") > threshold_min)
    desc = F.concat(F.col("source"), F.lit(" feed silent for "), _tenths(F.col("gap_min")), F.lit(" minutes"))
    return _alert(hot, "API_INDISPONIBLE", "CRITICAL", desc, F.col("gap_min"), F.lit(None), F.col("fetched_at"),
                  [F.col("source"), F.unix_micros(F.col("fetched_at").cast("timestamp")).cast("string")])


def union_alerts(*frames: DataFrame) -> DataFrame:
    out = frames[0].select(*ALERT_COLS)
    for f in frames[1:]:
        out = out.unionByName(f.select(*ALERT_COLS))
    return out
