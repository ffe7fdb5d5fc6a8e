"""Descriptive statistics, recommender and models on hand-made rows."""
import datetime as dt

from pyspark.sql import functions as F

from dockline.operators import analytics as A
from dockline.operators import demand as DM
from dockline.operators import recommend as RC

RD = ("station_id string, num_bikes_available bigint, num_ebikes_available bigint, num_docks_available bigint, "
      "is_renting boolean, is_returning boolean, observed_at timestamp_ntz")
ST = "station_id string, name string, latitude double, longitude double, capacity bigint, commune string"


def ts(h, m=0):
    return dt.datetime(2026, 7, 1, h, m)


def test_zero_zero_station_ranks(spark):
    rd = spark.createDataFrame([("a", 0, 0, 0, True, True, ts(10)), ("b", 5, 0, 5, True, True, ts(10)),
                                ("c", 9, 0, 1, True, True, ts(10))], RD)
    st = spark.createDataFrame([("a", "A", 48.8, 2.3, 10, "X"), ("b", "B", 48.8, 2.3, 10, "X"),
                                ("c", "C", 48.8, 2.3, 10, "Y")], ST)
    panel = [r["station_name"] for r in A.top_stations_panel(rd, st, top=1).collect()]
    assert panel == ["A"]                       # NULL mean first in the panel
    assert [r["station_id"] for r in A.top10_loaded(rd, st).collect()][-1] == "a"   # last in the notebook
    assert A.bottom10_loaded(rd, st, top=1).first()["station_id"] == "a"


def test_sparse_and_dense_hourly(spark):
    rd = spark.createDataFrame([("a", 4, 0, 1, True, True, ts(10, 5)), ("a", 6, 0, 1, True, True, ts(13, 30))], RD)
    assert A.hourly_availability(rd).count() == 2
    dense = A.hourly_resample(rd).orderBy("hour").collect()
    assert [r["avg_bikes"] for r in dense] == [4.0, None, None, 6.0]


def test_histogram_closed_last_bin(spark):
    rows = [("a", b, 0, 1, True, True, ts(10, b % 60)) for b in range(0, 61)]
    rd = spark.createDataFrame(rows, RD)
    h = A.bikes_histogram(rd).orderBy("bin").collect()
    assert len(h) == 30 and sum(r["n"] for r in h) == 61
    assert h[-1]["n"] == 3                      # 58, 59 and the maximum 60
    one = A.bikes_histogram(spark.createDataFrame([rows[5]], RD)).collect()
    assert sum(r["n"] for r in one) == 1


def test_recommendation_filters(spark):
    st = spark.createDataFrame([
        ("near0", "Near empty", 48.8531, 2.3500, 10, "X"),
        ("nullc", "No commune", 48.8532, 2.3500, 10, None),
        ("cap0", "Zero capacity", 48.8533, 2.3500, 0, "X"),
        ("ok1", "Ok 1", 48.8600, 2.3500, 10, "X"),
        ("ok2", "Ok 2", 48.8700, 2.3500, 10, "X"),
        ("ok3", "Ok 3", 48.8800, 2.3500, 10, "X"),
        ("ok4", "Ok 4", 48.9000, 2.3500, 10, "X")], ST)
    rd = spark.createDataFrame([(s, 0 if s == "near0" else 3, 0, 2, True, True, ts(10)) for s in
                                ["near0", "nullc", "cap0", "ok1", "ok2", "ok3", "ok4"]], RD)
    latest = RC.latest_stock(rd, st)
    got = [r["station_id"] for r in RC.recommend(latest, 48.8530, 2.3499, "velo").collect()]
    assert got == ["ok1", "ok2", "ok3"]
    dock = [r["station_id"] for r in RC.recommend(latest, 48.8530, 2.3499, "dock").collect()]
    assert dock == ["near0", "ok1", "ok2"]


def test_recommend_many_matches_brute_force(spark):
    from dockline.sources import fixtures as FX
    d = "/root/testdata/sf0.001"
    latest = RC.latest_stock(FX.readings_v(spark, d), FX.stations_v(spark, d))
    pos = FX.positions_v(spark, d).unionByName(
        spark.createDataFrame([(10_000, 45.0, 5.0), (10_001, 48.86, 2.30)], "position_id bigint, latitude double, longitude double"))
    fast = RC.recommend_many(pos, latest, top_n=3)
    st = latest.filter("num_bikes_available > 0").select("station_id", "name", F.col("latitude").alias("sl"),
                                                          F.col("longitude").alias("so"))
    from pyspark.sql import Window
    from dockline.functions.geo import haversine_km
    brute = (pos.crossJoin(st).withColumn("_d", haversine_km("latitude", "longitude", "sl", "so"))
             .withColumn("rank", F.row_number().over(Window.partitionBy("position_id").orderBy("_d", "name", "station_id")))
             .filter("rank <= 3").select("position_id", "rank", "station_id"))
    a = sorted(tuple(r) for r in fast.select("position_id", "rank", "station_id").collect())
    b = sorted(tuple(r) for r in brute.collect())
    assert a == b and len(a) == 3 * pos.count()


def test_unseen_category_scores_with_zero_vector(spark):
    rows = [("s1", ts(8), "A", 10, 8, 0, 3), ("s2", ts(9), "B", 12, 9, 1, 5), ("s1", ts(10), "A", 10, 10, 2, 4)]
    train = spark.createDataFrame(rows, "station_id string, observed_at timestamp_ntz, commune string, capacity bigint, "
                                        "hour int, weekday int, num_bikes_available bigint") \
        .withColumn("num_bikes_available", F.col("num_bikes_available").cast("double"))
    model = DM._features_pipeline(DM.candidates()["linear_regression"]).fit(train)
    unseen = spark.createDataFrame([("s9", ts(11), "Z", 11, 11, 3, 0.0)], train.schema)
    out = model.transform(unseen).first()
    assert out["prediction"] is not None
    vec = out["features"].toArray()
    assert vec[3:].sum() == 0.0
