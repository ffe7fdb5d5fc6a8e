"""Dashboard panels and descriptive statistics (A1-A11, A14, W1, W4, W5,
L1-L6, J1, J2, J4, F4, F10).

Per-station measures aggregate the fact table *before* joining the station
dimension: the hash aggregate combines map-side (so a station holding a third
of all readings is folded per task), and the join then sees one row per
station. The join strategy is left to Catalyst/AQE: the dimension is
broadcast only when its measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``; otherwise it stays a
shuffle join.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import rules as R
from ..functions import timefn as T
from .merge import newest_rows

AVG_DIGITS = 9


def _r(c: Column, digits: int = AVG_DIGITS) -> Column:
    return F.round(c, digits)


# ---- A1-A3 ---------------------------------------------------------------
def network_overview(stations: DataFrame, readings: DataFrame) -> DataFrame:
    observed = readings.select(F.count_distinct("station_id")).scalar()
    return stations.agg(
        F.count(F.lit(1)).alias("n_stations"),
        F.sum("capacity").alias("total_capacity"),
        F.count_distinct("commune").alias("n_communes"),
    ).withColumn("n_stations_observed", observed)


# ---- A4 ------------------------------------------------------------------
def observation_span(readings: DataFrame) -> DataFrame:
    return readings.agg(F.count(F.lit(1)).alias("n_readings"),
                        F.min("observed_at").alias("first_observed_at"),
                        F.max("observed_at").alias("last_observed_at"))


# ---- A5 ------------------------------------------------------------------
def network_occupancy(readings: DataFrame) -> DataFrame:
    return readings.agg(_r(F.avg(T.occupancy_ratio()) * 100).alias("occupancy_pct"))


def occupancy_per_reading(readings: DataFrame) -> DataFrame:
    return readings.select("station_id", "observed_at", T.occupancy_ratio().alias("occupancy"))


# ---- J1 / J2 / J4 --------------------------------------------------------
def readings_enriched(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Every reading with its station's name, commune and capacity."""
    return readings.join(stations.select("station_id", "name", "commune", "capacity"), "station_id", "left")


def orphan_readings(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings whose station is not in the dimension (FK orphans)."""
    return readings.join(stations.select("station_id"), "station_id", "left_anti")


# ---- F4 / A6 -------------------------------------------------------------
def capacity_incoherent(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings with bikes + docks > capacity + 5, their count and share of
    all readings (left join, so readings of unknown stations count as
    coherent). Readings are counted per station, bikes and docks first, so
    the join and a hot station see combinations, not readings."""
    counts = (readings.groupBy("station_id", "num_bikes_available", "num_docks_available")
              .agg(F.count(F.lit(1)).alias("n")))
    j = counts.join(stations.select("station_id", "capacity"), "station_id", "left")
    return j.agg(
        F.coalesce(F.sum(F.when(R.capacity_incoherent(), F.col("n"))), F.lit(0)).alias("n_incoherent"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_readings"),
    ).withColumn("share_incoherent", _r(F.col("n_incoherent").cast("double") / F.nullif(F.col("n_readings"), F.lit(0))))


# ---- A7 / F10 / L3 -------------------------------------------------------
def stations_by_commune(stations: DataFrame, top: int = S.TOP_N_STATIONS) -> DataFrame:
    return (stations.filter(F.col("commune").isNotNull())
            .groupBy("commune").agg(F.count(F.lit(1)).alias("n_stations"))
            .orderBy(F.desc("n_stations"), F.asc("commune")).limit(top))


# ---- A8 / L1 / L2 --------------------------------------------------------
def _occupancy_sums(readings: DataFrame) -> DataFrame:
    ratio = T.occupancy_ratio()
    return readings.groupBy("station_id").agg(F.sum(ratio).alias("_sum"), F.count(ratio).alias("_cnt"))


def station_occupancy(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Mean occupancy per (station_id, name); NULL ratios skipped; stations
    whose readings have no ratio keep a NULL mean. Groups with a NULL name
    are dropped, as a grouped mean over the joined frame does."""
    sums = _occupancy_sums(readings)
    j = sums.join(stations.select("station_id", "name"), "station_id", "left").filter(F.col("name").isNotNull())
    mean = F.when(F.col("_cnt") > 0, F.col("_sum") / F.col("_cnt"))
    return j.select("station_id", "name", _r(mean).alias("mean_occupancy"))


def top10_loaded(readings: DataFrame, stations: DataFrame, top: int = S.TOP_N_STATIONS) -> DataFrame:
    occ = station_occupancy(readings, stations)
    return occ.orderBy(F.desc_nulls_last("mean_occupancy"), F.asc("station_id")).limit(top)


def bottom10_loaded(readings: DataFrame, stations: DataFrame, top: int = S.TOP_N_STATIONS) -> DataFrame:
    """The tail of the descending ranking (NULL means sort last there, so
    they come first here)."""
    occ = station_occupancy(readings, stations)
    return occ.orderBy(F.asc_nulls_first("mean_occupancy"), F.desc("station_id")).limit(top)


# ---- A9 / L1 panel -------------------------------------------------------
def top_stations_panel(readings: DataFrame, stations: DataFrame, top: int = S.TOP_N_STATIONS) -> DataFrame:
    """Mean occupancy % per (name, commune), inner join, NULL means first as
    in the dashboard's ORDER BY ... DESC, ties by name then commune."""
    sums = _occupancy_sums(readings)
    j = sums.join(stations.select("station_id", "name", "commune"), "station_id", "inner")
    g = j.groupBy("name", "commune").agg(F.sum("_sum").alias("_s"), F.sum("_cnt").alias("_c"))
    pct = F.when(F.col("_c") > 0, F.col("_s") / F.col("_c") * 100)
    return (g.select(F.col("name").alias("station_name"), "commune", _r(pct).alias("occupancy_pct"))
             .orderBy(F.desc_nulls_first("occupancy_pct"), F.asc_nulls_first("station_name"),
                      F.asc_nulls_first("commune"))
             .limit(top))


# ---- A10 / W4 ------------------------------------------------------------
def hourly_availability(readings: DataFrame) -> DataFrame:
    """Sparse hourly mean of available bikes (hours without data absent)."""
    h = F.date_trunc("hour", "observed_at").cast("timestamp_ntz")
    return (readings.groupBy(h.alias("hour")).agg(_r(F.avg("num_bikes_available")).alias("avg_bikes"))
            .orderBy("hour"))


def hourly_resample(readings: DataFrame) -> DataFrame:
    """Dense hourly series: every hour from the first to the last reading,
    left-closed bins, empty hours NULL. The grid is generated from one
    bounds row and is as long as the time span, not the data."""
    h = F.date_trunc("hour", "observed_at").cast("timestamp_ntz")
    sparse = readings.groupBy(h.alias("hour")).agg(F.sum("num_bikes_available").alias("_s"),
                                                   F.count("num_bikes_available").alias("_c"))
    bounds = sparse.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    grid = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    mean = F.when(F.col("_c") > 0, F.col("_s") / F.col("_c"))
    return grid.join(sparse, "hour", "left").select("hour", _r(mean).alias("avg_bikes"))


# ---- W1 ------------------------------------------------------------------
LATEST_COLS = ["num_bikes_available", "num_ebikes_available", "num_docks_available", "is_renting", "is_returning"]


def latest_reading(readings: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Newest reading per station, ties by the other columns; see ``merge.newest_rows``."""
    cols = cols if cols is not None else [c for c in LATEST_COLS if c in readings.columns]
    return newest_rows(readings, ["station_id"], "observed_at", cols)


# ---- A14 -----------------------------------------------------------------
def bikes_histogram(readings: DataFrame, bins: int = S.HISTOGRAM_BINS, col: str = "num_bikes_available") -> DataFrame:
    """Equal-width histogram over [min, max], last bin closed, empty bins
    kept with 0. min = max widens the range by 0.5 each side. The bounds are
    scalar subqueries, not a join."""
    stats = readings.agg(F.min(col).cast("double").alias("mn"), F.max(col).cast("double").alias("mx"))
    bounds = stats.select(F.struct("mn", "mx")).scalar()   # one subquery, reused
    mn0, mx0 = bounds["mn"], bounds["mx"]
    same = mn0 == mx0
    mn = F.when(same, mn0 - 0.5).otherwise(mn0)
    mx = F.when(same, mx0 + 0.5).otherwise(mx0)
    x = F.col(col).cast("double")
    idx = F.least(F.floor((x - mn) * F.lit(float(bins)) / (mx - mn)), F.lit(bins - 1)).cast("int")
    counts = readings.filter(F.col(col).isNotNull()).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = readings.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (mx - mn) / F.lit(float(bins))
    return grid.join(counts, "bin", "left").select(
        "bin",
        _r(mn + F.col("bin") * width).alias("bin_start"),
        _r(mn + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"))


# ---- A11 / L4 / L6 -------------------------------------------------------
def alert_counts(alerts: DataFrame) -> DataFrame:
    return (alerts.groupBy("alert_type", "severity").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "alert_type", "severity"))


def latest_alerts(alerts: DataFrame, top: int = S.LATEST_ALERTS) -> DataFrame:
    return (alerts.select("detected_at", "alert_type", "severity", "description", "alert_id")
            .orderBy(F.desc_nulls_last("detected_at"), F.asc("alert_id")).limit(top))


# ---- W5 ------------------------------------------------------------------
def message_rate(messages: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
                 seconds: int = 300, cell: str = "1 minute") -> DataFrame:
    """Messages per second per topic over sliding windows. Messages are counted per
    ``cell`` first, which must divide ``length`` and ``slide``; only the counts slide."""
    cells = (messages.groupBy("topic", F.window("timestamp", cell).alias("c")).agg(F.count(F.lit(1)).alias("n"))
             .select("topic", F.col("c.start").alias("at"), "n"))
    g = cells.groupBy("topic", F.window("at", length, slide).alias("w")).agg(F.sum("n").alias("n_messages"))
    return g.select("topic", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    "n_messages", (F.col("n_messages") / F.lit(float(seconds))).alias("rate_per_s"))
