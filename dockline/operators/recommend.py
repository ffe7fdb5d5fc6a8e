"""Nearest-station recommender (M11, J7, haversine).

Single position: a top-k over the latest reading per station
(``TakeOrderedAndProject``; each task keeps its k best).

Many positions (J7): an exact k-nearest-neighbour join without a cross join, by branch and bound over a
tree of cells. Positions on the globe are points of the unit sphere in space, where neither the 180th meridian
nor the poles are special and the chord grows with the distance. Space is cut into cubes, each level
eight times finer along an edge than the one above; only occupied cells exist, each with the number and the
bounding box of its stations. Every position starts with all cells of the finest level that has a few only.
Round by round its cells are replaced by their children (an equi-join on the cell), and
cells go whose nearest point is farther than a distance within which other cells are known to hold k
stations. Cells of few stations are not split further; in the end their stations are ranked by the exact
distance. A dense cell is thus entered only by positions for which some of its parts may matter, and
a position far from all stations keeps few cells. Stations at one and the same point that can't be among
the first k there are left out beforehand. Each round is written to the shared folder.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import settings as S
from ..functions.geo import haversine_km
from ..session import materialize
from .merge import newest_rows

DIST_DIGITS = 6


def ml_frame(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings x stations, capacity > 0, commune known (the frame both the
    models and the recommender use)."""
    s = stations.filter((F.col("capacity") > 0) & F.col("commune").isNotNull()).select(
        "station_id", "name", "capacity", "commune", "latitude", "longitude")
    r = readings.select("station_id", "num_bikes_available", "num_docks_available", "observed_at")
    return r.join(s, "station_id", "inner")


def latest_stock(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Newest reading per station of the ML frame, with name and position.
    Readings are reduced to one row per station before the join."""
    s = stations.filter((F.col("capacity") > 0) & F.col("commune").isNotNull()).select(
        "station_id", "name", "latitude", "longitude")
    of_these = readings.join(s.select("station_id"), "station_id", "left_semi")
    newest = newest_rows(of_these, ["station_id"], "observed_at", ["num_bikes_available", "num_docks_available"])
    return newest.join(s, "station_id", "inner")


def _stock_filter(df: DataFrame, need: str) -> DataFrame:
    col = "num_bikes_available" if need == "velo" else "num_docks_available"
    return df.filter(F.col(col) > 0)


def recommend(latest: DataFrame, lat: float, lon: float, need: str = "velo",
              top_n: int = S.RECOMMEND_TOP_N) -> DataFrame:
    """Nearest ``top_n`` stations with a bike (``need='velo'``) or, for any
    other need, a free dock."""
    d = _stock_filter(latest, need).withColumn(
        "_d", haversine_km(F.lit(float(lat)), F.lit(float(lon)), F.col("latitude"), F.col("longitude")))
    return (d.orderBy("_d", "name", "station_id").limit(top_n)
             .select("station_id", "name", F.round("_d", DIST_DIGITS).alias("distance_km"),
                     "num_bikes_available", "num_docks_available"))


def station_distances(stations: DataFrame, lat: float, lon: float) -> DataFrame:
    return (stations.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
            .select("station_id", F.round(haversine_km(F.lit(float(lat)), F.lit(float(lon)),
                                                        "latitude", "longitude"), DIST_DIGITS).alias("distance_km")))


# ---- J7: many positions ---------------------------------------------------
STEP = 3                       # binary levels per level of the tree
DEEPEST = 21                   # cells of about 6 m; three coordinates fit one bigint
LEAF = 16                      # stations in a cell that is not split further
START = 32                     # cells that every position starts with, at most
_SLACK = 1e-12                 # chord units (micrometres), against rounding


def _on_sphere(df: DataFrame, lat: str, lon: str, prefix: str) -> DataFrame:
    la, lo = F.radians(lat), F.radians(lon)
    return df.withColumns({prefix + "x": F.cos(la) * F.cos(lo), prefix + "y": F.cos(la) * F.sin(lo), prefix + "z": F.sin(la)})


def _cell(level: int) -> Column:
    """Key of the cell of (x, y, z) at ``level``."""
    n = 1 << level
    at = [F.least(F.floor((F.col(c) + 1) * F.lit(n / 2)).cast("bigint"), F.lit(n - 1)) for c in ("x", "y", "z")]
    return (at[0] * n + at[1]) * n + at[2]


def _reach(side: str) -> Column:
    """Chord from (px, py, pz) to the nearest or farthest point of a cell's bounding box."""
    total = None
    for c in ("x", "y", "z"):
        lo, hi, p = F.col(f"{c}0"), F.col(f"{c}1"), F.col("p" + c)
        gap = F.greatest(lo - p, p - hi, F.lit(0.0)) if side == "near" else F.greatest(F.abs(p - lo), F.abs(hi - p))
        total = gap * gap if total is None else total + gap * gap
    return F.sqrt(total)


def recommend_many(positions: DataFrame, latest: DataFrame, need: str = "velo",
                   top_n: int = S.RECOMMEND_TOP_N) -> DataFrame:
    """Exact ``top_n`` nearest stations with stock for every position that has coordinates.
    Output: position_id, rank, station_id, name, distance_km."""
    st = _stock_filter(latest, need).filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    here = Window.partitionBy("latitude", "longitude").orderBy("name", "station_id")
    st = st.withColumn("_r", F.row_number().over(here)).filter(F.col("_r") <= top_n)
    st = _on_sphere(st.select("station_id", "name", F.col("latitude").alias("s_lat"), F.col("longitude").alias("s_lon")), "s_lat", "s_lon", "")
    levels = range(0, DEEPEST + 1, STEP)
    st = st.withColumn("_c", F.explode(F.array(*[F.struct(F.lit(lv).alias("level"), _cell(lv).alias("cell"),
                                                        (_cell(lv - STEP) if lv else F.lit(0).cast("bigint")).alias("up")) for lv in levels])))
    st = materialize(st.select("*", "_c.*").drop("_c"), "near-stations")
    box = [f(c).alias(c + i) for c in ("x", "y", "z") for f, i in ((F.min, "0"), (F.max, "1"))]
    cells = st.groupBy("level", "up", "cell").agg(F.count(F.lit(1)).alias("n"), *box)
    cells = materialize(cells.withColumn("leaf", (F.col("n") <= LEAF) | (F.col("level") == DEEPEST)), "near-cells")
    sizes = {r.level: r.n for r in cells.groupBy("level").agg(F.count(F.lit(1)).alias("n")).collect()}      # one row per level
    first = max((lv for lv in levels if sizes.get(lv, 0) <= START), default=0)

    where = ["cell", "level", "n", "leaf", "x0", "x1", "y0", "y1", "z0", "z1"]
    pos = positions.select("position_id", "latitude", "longitude").filter("latitude IS NOT NULL AND longitude IS NOT NULL")
    pos = _on_sphere(pos, "latitude", "longitude", "p").withColumn("_p", F.monotonically_increasing_id())
    pos = materialize(pos, "near-positions")
    me = ["_p", "px", "py", "pz"]
    roots = cells.filter(F.col("level") == first).select(*where).collect()          # at most START rows
    schema = cells.select(*where).schema.simpleString()
    held = pos.select(*me, F.explode(F.from_json(F.lit(json.dumps([r.asDict() for r in roots])), f"array<{schema}>")).alias("c")).select(*me, "c.*")
    by_reach = Window.partitionBy("_p").orderBy("far").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for lv in range(first, DEEPEST + 1, STEP):
        held = held.withColumns({"near": _reach("near"), "far": _reach("far")})
        held = held.withColumn("sure", F.when(F.sum("n").over(by_reach) >= top_n, F.col("far")))
        held = held.withColumn("bound", F.min("sure").over(Window.partitionBy("_p")))
        held = held.filter(F.col("bound").isNull() | (F.col("near") <= F.col("bound") + F.lit(_SLACK)))
        open_ = materialize(held.select(*me, *where), "near-open")
        if open_.filter("NOT leaf").isEmpty():
            break
        below = cells.filter(F.col("level") == lv + STEP).select("up", *where)
        down = open_.filter("NOT leaf").select(*me, F.col("cell").alias("up")).join(below, "up").select(*me, *where)
        held = open_.filter("leaf").unionByName(down)
    found = (open_.select("_p", "level", "cell").join(st.select("level", "cell", "station_id", "name", "s_lat", "s_lon"), ["level", "cell"])
             .join(pos.select("_p", "position_id", "latitude", "longitude"), "_p")
             .withColumn("_d", haversine_km("latitude", "longitude", "s_lat", "s_lon")))
    w = Window.partitionBy("_p").orderBy("_d", "name", "station_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_n)
            .select("position_id", F.col("rank").cast("int").alias("rank"), "station_id", "name", F.round("_d", DIST_DIGITS).alias("distance_km")))
