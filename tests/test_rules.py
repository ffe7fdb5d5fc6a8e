"""The reference's 13 rule cases as rows, plus border cases."""
from pyspark.sql import functions as F

from dockline.functions import rules as R

ST = "station_id string, capacity bigint, latitude double, longitude double"
RD = "station_id string, num_bikes_available bigint, num_docks_available bigint, observed_at string, capacity bigint"
BASE_ST = ("16107", 30, 48.8566, 2.3522)
BASE_RD = ("16107", 10, 15, "2026-07-01T10:00:00+00:00", 25)


def _station(spark, row):
    return spark.createDataFrame([row], ST).select(R.station_valid().alias("v")).first()["v"]


def _reading(spark, row, strict=False):
    return spark.createDataFrame([row], RD).select(R.reading_valid(strict=strict).alias("v")).first()["v"]


def test_station_cases(spark):
    assert _station(spark, BASE_ST) is True
    assert _station(spark, (None, 30, 48.8566, 2.3522)) is False
    assert _station(spark, ("16107", -1, 48.8566, 2.3522)) is False
    assert _station(spark, ("16107", None, 48.8566, 2.3522)) is False
    assert _station(spark, ("16107", 30, 43.2965, 2.3522)) is False
    assert _station(spark, ("16107", 30, None, None)) is False


def test_reading_cases(spark):
    assert _reading(spark, BASE_RD) is True
    assert _reading(spark, (None, 10, 15, "2026-07-01T10:00:00+00:00", 25)) is False
    assert _reading(spark, ("16107", -1, 15, "2026-07-01T10:00:00+00:00", 25)) is False
    assert _reading(spark, ("16107", 10, 15, None, 25)) is False
    assert _reading(spark, ("16107", 50, 50, "2026-07-01T10:00:00+00:00", 25)) is False
    assert _reading(spark, ("16107", 27, 0, "2026-07-01T10:00:00+00:00", 25)) is True


def test_unknown_capacity_default_and_strict(spark):
    row = ("16107", 999, 15, "2026-07-01T10:00:00+00:00", None)
    assert _reading(spark, row) is True
    assert _reading(spark, row, strict=True) is False


def test_bounding_box_is_inclusive(spark):
    for lat, lon in [(48.0, 1.5), (49.5, 3.0), (48.0, 3.0), (49.5, 1.5)]:
        assert _station(spark, ("1", 10, lat, lon)) is True
    for lat, lon in [(47.9999, 2.0), (49.5001, 2.0), (48.5, 1.4999), (48.5, 3.0001)]:
        assert _station(spark, ("1", 10, lat, lon)) is False


def test_capacity_plus_three_is_invalid(spark):
    assert _reading(spark, ("1", 28, 0, "t", 25)) is False
    assert _reading(spark, ("1", 27, 0, "t", 25)) is True


def test_first_failing_reason(spark):
    df = spark.createDataFrame([(None, -1, None, None), ("1", -1, 48.5, 2.0), ("1", 5, 43.0, 2.0)], ST)
    got = [r[0] for r in df.select(R.station_reject_reason()).collect()]
    assert got == ["missing_station_id", "negative_capacity", "latitude_out_of_box"]


def test_constraint_violations(spark):
    df = spark.createDataFrame(
        [("1", None, 48.5, 2.0, 10, None), ("2", "x" * 300, 48.5, 2.0, 10, None), ("3", "ok", 48.5, 2.0, 10, "c")],
        "station_id string, name string, latitude double, longitude double, capacity bigint, commune string")
    got = [r[0] for r in df.select(R.station_row_violation()).orderBy(F.col("station_id")).collect()]
    assert got == ["name_null", "name_too_long", None]
