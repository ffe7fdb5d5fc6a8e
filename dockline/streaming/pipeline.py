"""Structured Streaming ingest.

Each feed is one streaming query: ``foreachBatch`` with
``trigger(availableNow=True)`` processes what is available and stops; the
checkpoint keeps the read position between runs.

Per micro-batch everything is derived from one decoded, persisted batch:

* bronze archive (raw values unchanged, partitioned by source / day);
* station changes: feed rows and stubs that satisfy the table's constraints, and communes;
* readings: those that satisfy the table's constraints and whose station is stored or comes with
  an accepted stub (the foreign key), first-wins per (station_id, observed_at), minus keys
  already committed (without this epoch's own earlier output, so a replayed epoch rewrites the same rows);
* quarantine with a reason for every row that breaks a constraint (D5), orphans included;
* alerts with deterministic ids (D8); feed gaps and freshness know the newest fetch and
  observation of earlier epochs.

All outputs of an epoch become visible by one marker written last (S11, ``versions``). The stations
table is stored in versions: ``fold_stations`` merges the changes since the last version into it.
"""
from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import settings as S
from ..functions import rules as R
from ..functions import schemas as SC
from ..functions import timefn as TF
from ..operators import alerts as AL
from ..operators import merge as M
from ..operators import parse as P
from ..sources import bronze as BZ
from .versions import Root

KEEP = P.MSG_COLS + ["batch_id", "fetched_at", "micro_batch"]
READINGS_SCHEMA = ("station_id string, num_bikes_available bigint, num_ebikes_available bigint, "
                   "num_docks_available bigint, is_renting boolean, is_returning boolean, "
                   "observed_at timestamp_ntz, batch_id string, ingested_at timestamp_ntz, obs_date date")
ALERTS_SCHEMA = ("alert_id string, alert_type string, severity string, description string, "
                 "metric_value double, batch_id string, detected_at timestamp_ntz")
QUARANTINE_SCHEMA = "table_name string, station_id string, observed_at timestamp_ntz, batch_id string, violation string"
STATIONS = "stations"
FILTER_BITS = 1 << 18


def _write(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _query_id(spark: SparkSession) -> str:
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def _change_rows(df: DataFrame, kind: str) -> DataFrame:
    cols = {c: (F.col(c) if c in df.columns else F.lit(None)) for c in
            ["name", "latitude", "longitude", "capacity", "commune"]}
    return df.select(
        F.lit(kind).alias("kind"), "station_id",
        cols["name"].cast("string").alias("name"), cols["latitude"].cast("double").alias("latitude"),
        cols["longitude"].cast("double").alias("longitude"), cols["capacity"].cast("bigint").alias("capacity"),
        cols["commune"].cast("string").alias("commune"),
        F.col("fetched_at").alias("updated_at"),
        F.col("fetched_at").alias("o_fetched_at"), F.col("partition").alias("o_partition"),
        F.col("offset").alias("o_offset"), F.col("pos").cast("int").alias("o_pos"))


def key_filter(keys: DataFrame, cols: list[str], bits: int = FILTER_BITS) -> Column:
    """Condition that holds for every row with a key of ``keys`` and for few others: a bit filter of fixed
    size, as a literal, so it is evaluated in the scan's stage. A batch that fills it filters less."""
    at = F.pmod(F.xxhash64(*cols), F.lit(bits))
    blocks = (keys.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("block"))
              .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("bits")).collect())    # at most bits / 64 rows
    words = [0] * (bits // 64)
    for r in blocks:
        words[r.block] = r.bits
    word = F.element_at(F.lit(words).cast("array<bigint>"), (F.shiftright(at, 6) + 1).cast("int"))
    return word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))) != 0


def history_for(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Committed readings that can meet a key of ``batch``: its observation dates as partition literals,
    then the bit filter of its keys."""
    dates = [r.d for r in batch.select(F.to_date("observed_at").alias("d")).distinct().collect() if r.d is not None]   # one row per day
    return prior.filter(F.col("obs_date").isin(dates)).filter(key_filter(batch, M.READING_KEY))


def _known(root: Root, exclude: tuple[str, int]) -> DataFrame | None:
    """Ids of the stored stations, and of those accepted since the stored version."""
    _, segments, covered = root.latest(STATIONS)
    old = root.read_segments(STATIONS, M.STATE_SCHEMA, segments)
    new = root.read_epochs("station_changes", M.CHANGES_SCHEMA, root.epochs(after=covered, exclude=exclude))
    parts = [] if old is None else [old.filter("feed_row IS NOT NULL OR stub_row IS NOT NULL").select("station_id")]
    parts += [] if new is None else [new.filter("kind IN ('station', 'stub')").select("station_id")]
    return reduce(DataFrame.unionByName, parts) if parts else None


def _rejected(df: DataFrame, table: str) -> DataFrame:
    seen = F.col("observed_at") if "observed_at" in df.columns else F.lit(None).cast("timestamp_ntz")
    return df.select(F.lit(table).alias("table_name"), "station_id", seen.alias("observed_at"), "batch_id", "violation")


def process_batch(batch: DataFrame, epoch_id: int, root: str, feed: str, run: str | None = None,
                  as_of: Column | None = None) -> None:
    """One micro-batch of one feed (``feed`` = "stations" | "disponibilite"). ``as_of``: the time freshness
    is judged at, the clock by default."""
    spark = batch.sparkSession
    run = run or _query_id(spark)
    r, me = Root(spark, root), (run, epoch_id)
    as_of = F.current_timestamp() if as_of is None else as_of
    stations = feed == S.SOURCE_STATIONS
    cached = []

    def hold(df: DataFrame) -> DataFrame:
        cached.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return cached[-1]
    try:
        batch = hold(batch)                                  # archive and parse read the source once
        msgs = batch.withColumn("micro_batch", F.lit(epoch_id).cast("bigint"))
        dec = hold(P.decode(msgs, SC.STATION_RESULT if stations else SC.AVAILABILITY_RESULT))
        # bronze (raw values unchanged; D6: malformed text is archived too)
        BZ.archive(batch, r.epoch_path("bronze", run, epoch_id))
        rec = P.explode_records(dec, keep=KEEP)
        if stations:
            rows = P.project_stations(rec).withColumn("reject_reason", R.station_reject_reason())
        else:
            rows = P.project_availability(rec).withColumn("reject_reason", R.reading_reject_reason())
        rows = hold(rows.withColumn("is_valid", F.col("reject_reason").isNull()))
        valid = rows.filter("is_valid")
        state = r.feed_state(before=me)
        fetches = dec.filter("source IS NOT NULL AND fetched_at IS NOT NULL").select("source", "fetched_at")
        alerts = [AL.reject_rate_alerts(AL.reject_ratio(rows), feed.capitalize(), feed),
                  AL.malformed_alerts(dec), AL.empty_fetch_alerts(dec),
                  AL.feed_gap_alerts(AL.gaps_after(fetches, state))]
        no_commune = F.lit(None).cast("string")
        if stations:
            checked = valid.withColumn("violation", R.station_row_violation(commune=no_commune))
            changes = _change_rows(checked.filter("violation IS NULL"), "station")
            quarantine = _rejected(checked.filter("violation IS NOT NULL"), "stations")
        else:
            alerts.append(AL.freshness_alerts(AL.freshness(rows, as_of=as_of), feed))
            known = _known(r, me)
            strange = valid if known is None else valid.join(known, "station_id", "left_anti")
            stubs = strange.withColumn("violation", R.station_row_violation(commune=no_commune))
            accepted = hold(stubs.filter("violation IS NULL"))
            facts = valid.withColumn("violation", R.reading_row_violation())
            good = facts.filter("violation IS NULL")
            # foreign key: strange stations count with an accepted stub only
            homeless = strange.select("station_id").distinct().join(accepted.select("station_id"), "station_id", "left_anti")
            homed = hold(good.join(homeless, "station_id", "left_anti"))
            prior = r.read("readings", READINGS_SCHEMA, feed=feed, exclude=me)
            new = M.reading_insert(None if prior is None else history_for(prior, homed), homed, P.order_key(), P.FACT_COLS)
            new = new.withColumn("ingested_at", F.current_timestamp().cast("timestamp_ntz")) \
                     .withColumn("obs_date", F.to_date("observed_at"))
            _write(new, r.epoch_path("readings", run, epoch_id), partition_by=["obs_date"])
            commune_src = homed.filter(F.col("commune").isNotNull() & (F.col("commune") != ""))
            changes = _change_rows(accepted, "stub").unionByName(
                _change_rows(commune_src.select("station_id", "commune", "fetched_at", "partition", "offset", "pos"), "commune"))
            orphans = good.join(homeless, "station_id", "left_semi").withColumn("violation", F.lit("station_unknown"))
            bad_stubs = stubs.filter("violation IS NOT NULL").join(accepted.select("station_id"), "station_id", "left_anti")
            quarantine = reduce(DataFrame.unionByName, [
                _rejected(facts.filter("violation IS NOT NULL"), "disponibilite_releve"), _rejected(orphans, "disponibilite_releve"),
                _rejected(bad_stubs.drop("observed_at"), "stations").distinct()])
        _write(quarantine, r.epoch_path("quarantine", run, epoch_id))
        _write(changes, r.epoch_path("station_changes", run, epoch_id))
        alerts = AL.union_alerts(*alerts).withColumn("violation", R.alert_row_violation())
        _write(alerts.filter("violation IS NULL").drop("violation"), r.epoch_path("alerts", run, epoch_id))
        seen = AL.per_message(rows).select("topic", "partition", "offset", "n_total", "n_valid", "newest_observed")
        newest = (dec.select("source", "fetched_at", "topic", "partition", "offset").join(seen, ["topic", "partition", "offset"], "left")
                  .filter("source IS NOT NULL").groupBy("source")
                  .agg(F.max("fetched_at").alias("last_fetch"), F.max("newest_observed").alias("newest_observed"),
                       *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_total", "n_valid")]))
        r.commit(feed, run, epoch_id, newest)
    finally:
        for df in cached:
            df.unpersist()


def start(stream: DataFrame, root: str, checkpoint: str, feed: str, available_now: bool = True,
          as_of: Column | None = None) -> StreamingQuery:
    """One feed's query with its own checkpoint."""
    w = (stream.writeStream.foreachBatch(lambda df, eid: process_batch(df, eid, root, feed, as_of=as_of))
         .option("checkpointLocation", checkpoint).queryName(f"ingest_{feed}"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")
    return w.start()


def run_both(spark: SparkSession, stations_stream: DataFrame, availability_stream: DataFrame, root: str,
             checkpoint_root: str) -> None:
    """Both feeds concurrently; a failure in either surfaces at once."""
    qs = [start(stations_stream, root, f"{checkpoint_root.rstrip('/')}/stations", S.SOURCE_STATIONS),
          start(availability_stream, root, f"{checkpoint_root.rstrip('/')}/availability", S.SOURCE_AVAILABILITY)]
    try:
        while any(q.isActive for q in qs):
            for q in qs:
                q.awaitTermination(1)                        # raises what the query failed with
    finally:
        for q in qs:
            if q.isActive:
                q.stop()


def file_source(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Stand-in for the Kafka source: Parquet files with the Kafka record
    schema (the Kafka connector jar is not on this classpath)."""
    return spark.readStream.schema(SC.MESSAGE).option("maxFilesPerTrigger", max_files).parquet(path)


# ---- stored tables -------------------------------------------------------
def readings_table(spark: SparkSession, root: str) -> DataFrame | None:
    return Root(spark, root).read("readings", READINGS_SCHEMA, feed=S.SOURCE_AVAILABILITY)


def alerts_table(spark: SparkSession, root: str) -> DataFrame | None:
    t = Root(spark, root).read("alerts", ALERTS_SCHEMA)
    return None if t is None else t.dropDuplicates(["alert_id"])


def quarantine_table(spark: SparkSession, root: str) -> DataFrame | None:
    return Root(spark, root).read("quarantine", QUARANTINE_SCHEMA)


def _station_state(root: Root) -> tuple[DataFrame | None, list[tuple[str, int]]]:
    """Stored state merged with the changes after it, and the epochs these come from."""
    _, segments, covered = root.latest(STATIONS)
    old = root.read_segments(STATIONS, M.STATE_SCHEMA, segments)
    epochs = root.epochs(after=covered)
    new = root.read_epochs("station_changes", M.CHANGES_SCHEMA, epochs)
    parts = [p for p in (old, None if new is None else M.lift_changes(new)) if p is not None]
    return (M.merge_states(reduce(DataFrame.unionByName, parts)) if parts else None), epochs


def fold_stations(spark: SparkSession, root: str) -> int | None:
    """Merge the changes since the stored version into a new one; returns its number, None where
    nothing has changed. Older versions stay as they are for whoever reads them."""
    r = Root(spark, root)
    state, epochs = _station_state(r)
    return r.publish(STATIONS, state, epochs, replace=True) if epochs else None


def current_stations(spark: SparkSession, root: str) -> DataFrame | None:
    """The stations, from the stored version and the changes after it."""
    state, _ = _station_state(Root(spark, root))
    return None if state is None else M.stations_of(state)


def compact_readings(spark: SparkSession, root: str) -> int | None:
    """Committed epochs of the readings that no version covers, as one segment of files by observation date."""
    r = Root(spark, root)
    _, _, covered = r.latest("readings")
    epochs = r.epochs(feed=S.SOURCE_AVAILABILITY, after=covered)
    new = r.read_epochs("readings", READINGS_SCHEMA, epochs)
    if new is None:
        return None
    return r.publish("readings", new.drop("run", "epoch").repartition("obs_date"), epochs, replace=False, partition_by=("obs_date",))


def feed_status(spark: SparkSession, root: str, as_of: Column | None = None) -> DataFrame | None:
    """Q3 / Q5 without a new batch: per source the newest fetch and valid observation and their ages in minutes."""
    state = Root(spark, root).feed_state()
    at = (F.current_timestamp() if as_of is None else as_of).cast("timestamp_ntz")
    return None if state is None else state.select(
        "source", "last_fetch", "newest_observed", TF.minutes_between(at, F.col("last_fetch")).alias("silent_min"),
        TF.minutes_between(at, F.col("newest_observed")).alias("freshness_min"))


def ingest_kpis(spark: SparkSession, root: str) -> DataFrame | None:
    """Q7 over what the stream has stored, one row: share of the span's minutes in which every
    source's feed was alive (a fetch at most FEED_GAP_MINUTES ago), minutes from an observation to its
    row in the table (mean, share within LATENCY_TARGET_MINUTES), share of records rejected, alerts raised."""
    r = Root(spark, root)
    man, readings, alerts = r.manifest(), readings_table(spark, root), alerts_table(spark, root)
    if man is None:
        return None
    counts = man.agg(F.sum("n_total").alias("n_records"), (F.sum("n_total") - F.sum("n_valid")).alias("n_rejected"))
    bronze = BZ.read_committed(spark, root)
    fetched = bronze.select("source", TF.to_ntz(TF.parse_instant(F.get_json_object(F.col("value").cast("string"), "$.fetched_at"))).alias("fetched_at"))
    span = fetched.filter("fetched_at IS NOT NULL").groupBy("source").agg(F.min("fetched_at").alias("lo"), F.max("fetched_at").alias("hi"))
    gaps = AL.feed_gaps(fetched.filter("fetched_at IS NOT NULL")).groupBy("source").agg(
        F.sum(F.greatest(F.col("gap_min") - S.FEED_GAP_MINUTES, F.lit(0.0))).alias("dead"))
    alive = span.join(gaps, "source", "left").agg(
        F.min(F.lit(1.0) - F.coalesce("dead", F.lit(0.0)) / F.greatest(TF.minutes_between("hi", "lo"), F.lit(1.0))).alias("feed_availability"))
    out = counts.withColumn("_a", alive.scalar())
    late = TF.minutes_between("ingested_at", "observed_at")
    if readings is not None:
        lag = readings.agg(F.struct(F.count(F.lit(1)).alias("n_readings"), F.avg(late).alias("latency_min"),
                                    F.avg((late < S.LATENCY_TARGET_MINUTES).cast("int")).alias("share_in_time")))
        out = out.withColumn("_l", lag.scalar())
    else:
        out = out.withColumn("_l", F.lit(None).cast("struct<n_readings:bigint,latency_min:double,share_in_time:double>"))
    n_alerts = alerts.agg(F.count(F.lit(1))).scalar() if alerts is not None else F.lit(0).cast("bigint")
    return out.select("n_records", "n_rejected", (F.col("n_rejected") / F.nullif(F.col("n_records"), F.lit(0))).alias("reject_share"),
                      n_alerts.alias("n_alerts"), "_l.*", F.col("_a").alias("feed_availability"))
