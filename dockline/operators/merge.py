"""Keyed writes without a transactional table format (S4-S7, S11, W2, W3,
J5, J6, D12).

Duplicates inside a batch are resolved with grouped ``max``/``min`` over a
struct whose first field is the D4 order key. Spark sorts for such an aggregate, but
combines per task, so a station that holds a third of a batch is never gathered in one
window partition. ``newest_rows`` does without the sort where the input is cheap to read twice.

The stored stations (D10) are a merge of three extremes per station (newest feed row, oldest
stub, newest commune). Each is the same in whatever order and how often changes are merged, so
replays, reruns and the interleaving of the two feeds don't matter (D12).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R

STATION_ATTRS = ["name", "latitude", "longitude", "capacity"]
SNAPSHOT_COLS = ["station_id", "name", "latitude", "longitude", "capacity", "commune", "is_installed", "updated_at"]


def _pick(df: DataFrame, keys: list[str], order: Column, cols: list[str], last: bool) -> DataFrame:
    agg = F.max if last else F.min
    packed = F.struct(order.alias("_o"), *[F.col(c) for c in cols])
    g = df.groupBy(*keys).agg(agg(packed).alias("_p"))
    return g.select(*keys, *[F.col(f"_p.{c}").alias(c) for c in cols], F.col("_p._o").alias("_order"))


def last_wins(df: DataFrame, keys: list[str], order: Column, cols: list[str]) -> DataFrame:
    """Per key, the row that an ``ON CONFLICT DO UPDATE`` applied in
    ``order`` would leave."""
    return _pick(df, keys, order, cols, last=True)


def first_wins(df: DataFrame, keys: list[str], order: Column, cols: list[str]) -> DataFrame:
    """Per key, the row that ``ON CONFLICT DO NOTHING`` would keep."""
    return _pick(df, keys, order, cols, last=False)


def newest_rows(df: DataFrame, keys: list[str], order: str, cols: list[str]) -> DataFrame:
    """Per key the row with the greatest ``order`` (ties: the greatest ``cols``), without sorting the facts:
    the greatest order per key by a hash aggregate, the rows that reach it by a semi join, and the struct
    aggregate over these few only."""
    top = df.groupBy(*keys).agg(F.max(order).alias("_top"))
    top = top.select(*[F.col(k).alias(f"_k_{k}") for k in keys], "_top")
    cond = F.col(order).eqNullSafe(F.col("_top"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    few = df.join(top, cond, "left_semi")
    return few.groupBy(*keys).agg(F.max(F.struct(order, *cols)).alias("_m")).select(*keys, "_m.*")


# ---- S4: station upsert --------------------------------------------------
def station_upsert(snapshot: DataFrame | None, valid_stations: DataFrame, order: Column,
                   updated_at: Column) -> DataFrame:
    """New snapshot after upserting valid station-feed rows: name, position,
    capacity and ``updated_at`` from the newest row per station; commune and
    ``is_installed`` untouched (new stations: NULL commune, installed)."""
    new = last_wins(valid_stations.withColumn("_upd", updated_at), ["station_id"], order,
                    STATION_ATTRS + ["_upd"])
    new = new.select("station_id", *STATION_ATTRS, F.col("_upd").alias("updated_at"))
    if snapshot is None:
        return new.select(*[F.col(c) for c in ["station_id", *STATION_ATTRS]],
                          F.lit(None).cast("string").alias("commune"), F.lit(True).alias("is_installed"),
                          F.col("updated_at"))
    o = snapshot.select(*[F.col(c).alias(f"o_{c}") for c in SNAPSHOT_COLS])
    j = o.join(new, o.o_station_id == new.station_id, "full_outer")
    hit = F.col("station_id").isNotNull()
    out = [F.coalesce(F.col("station_id"), F.col("o_station_id")).alias("station_id")]
    out += [F.when(hit, F.col(c)).otherwise(F.col(f"o_{c}")).alias(c) for c in STATION_ATTRS]
    out += [F.col("o_commune").alias("commune"),
            F.coalesce(F.col("o_is_installed"), F.lit(True)).alias("is_installed"),
            F.when(hit, F.col("updated_at")).otherwise(F.col("o_updated_at")).alias("updated_at")]
    return j.select(*out)


# ---- S5: reading insert-if-absent ---------------------------------------
READING_KEY = ["station_id", "observed_at"]


def reading_insert(target: DataFrame | None, batch: DataFrame, order: Column, cols: list[str]) -> DataFrame:
    """Rows of ``batch`` to append: first row per (station_id, observed_at)
    in ``order``, minus keys already in ``target``. The anti join carries the
    observation date so a target partitioned by ``obs_date`` is pruned to
    the dates present in the batch."""
    first = first_wins(batch, READING_KEY, order, [c for c in cols if c not in READING_KEY]).drop("_order")
    if target is None:
        return first.select(*cols)
    first = first.withColumn("obs_date", F.to_date("observed_at"))
    t = target.select(*READING_KEY, F.to_date("observed_at").alias("obs_date")) \
        if "obs_date" not in target.columns else target.select(*READING_KEY, "obs_date")
    return first.join(t, READING_KEY + ["obs_date"], "left_anti").select(*cols)


# ---- S6: station stubs ---------------------------------------------------
def station_stubs(snapshot: DataFrame, valid_availability: DataFrame, order: Column,
                  updated_at: Column) -> tuple[DataFrame, DataFrame]:
    """Stations referenced by readings but absent from the snapshot, taken
    from the oldest availability row (DO NOTHING keeps the first). Returns
    (stubs that satisfy the table constraints, quarantined stubs with reason)."""
    # constraints first: a bad oldest row must not hide a good later one
    cand = valid_availability.withColumn("_upd", updated_at).join(snapshot.select("station_id"), "station_id", "left_anti")
    cand = cand.withColumn("violation", R.station_row_violation(commune=F.lit(None).cast("string")))
    good = first_wins(cand.filter(F.col("violation").isNull()), ["station_id"], order, STATION_ATTRS + ["_upd"])
    ok = good.select(
        "station_id", *STATION_ATTRS, F.lit(None).cast("string").alias("commune"),
        F.lit(True).alias("is_installed"), F.col("_upd").alias("updated_at"))
    bad = (first_wins(cand.filter(F.col("violation").isNotNull()), ["station_id"], order, STATION_ATTRS + ["violation"])
           .join(good.select("station_id"), "station_id", "left_anti").select("station_id", *STATION_ATTRS, "violation"))
    return ok, bad


# ---- S7: commune backfill ------------------------------------------------
def commune_updates(valid_availability: DataFrame, order: Column) -> DataFrame:
    """Newest non-empty commune per station (NULL and '' never overwrite)."""
    c = valid_availability.filter(F.col("commune").isNotNull() & (F.col("commune") != ""))
    return last_wins(c, ["station_id"], order, ["commune"]).drop("_order")


def commune_backfill(snapshot: DataFrame, updates: DataFrame) -> DataFrame:
    """UPDATE stations SET commune = new WHERE station_id = key; other columns
    (``updated_at`` included) unchanged."""
    u = updates.select("station_id", F.col("commune").alias("_new"))
    j = snapshot.join(u, "station_id", "left")
    return j.withColumn("commune", F.coalesce(F.col("_new"), F.col("commune"))).drop("_new")


# ---- D10 / D12: stored stations ---------------------------------------------
CHANGES_SCHEMA = ("kind string, station_id string, name string, latitude double, longitude double, "
                  "capacity bigint, commune string, updated_at timestamp_ntz, o_fetched_at timestamp_ntz, "
                  "o_partition int, o_offset bigint, o_pos int")
ORDER_FIELDS = ["o_fetched_at", "o_partition", "o_offset", "o_pos"]
_ORDER = "o_fetched_at:timestamp_ntz,o_partition:int,o_offset:bigint,o_pos:int"
_ATTRS = f"struct<{_ORDER},name:string,latitude:double,longitude:double,capacity:bigint,updated_at:timestamp_ntz>"
STATE_SCHEMA = f"station_id string, feed_row {_ATTRS}, stub_row {_ATTRS}, commune_row struct<{_ORDER},commune:string>"


def lift_changes(changes: DataFrame) -> DataFrame:
    """Change log rows as station states of one change each."""
    attrs = F.struct(*ORDER_FIELDS, *STATION_ATTRS, "updated_at")
    return changes.filter("station_id IS NOT NULL").select(
        "station_id", F.when(F.col("kind") == "station", attrs).alias("feed_row"), F.when(F.col("kind") == "stub", attrs).alias("stub_row"),
        F.when((F.col("kind") == "commune") & (F.col("commune") != ""), F.struct(*ORDER_FIELDS, "commune")).alias("commune_row"))


def merge_states(states: DataFrame) -> DataFrame:
    """One state per station: newest feed row (DO UPDATE), oldest stub (DO NOTHING), newest commune."""
    return states.groupBy("station_id").agg(F.max("feed_row").alias("feed_row"), F.min("stub_row").alias("stub_row"),
                                            F.max("commune_row").alias("commune_row"))


def stations_of(state: DataFrame) -> DataFrame:
    """The stations table of a state. A commune alone makes no station."""
    a = F.coalesce("feed_row", "stub_row")
    return state.filter("feed_row IS NOT NULL OR stub_row IS NOT NULL").select(
        "station_id", *[a[c].alias(c) for c in STATION_ATTRS], F.col("commune_row.commune").alias("commune"),
        F.lit(True).alias("is_installed"), a["updated_at"].alias("updated_at"))
