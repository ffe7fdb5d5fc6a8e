"""Envelope decoding, alerts and keyed writes on hand-made messages."""
import datetime as dt
import json

from pyspark.sql import functions as F

from dockline.functions import schemas as SC
from dockline.operators import alerts as AL
from dockline.operators import merge as M
from dockline.operators import parse as P
from dockline.functions import rules as R

T0 = dt.datetime(2026, 7, 1, 10, 0, 0)


def rec(code, bikes=5, docks=5, cap=20, due="2026-07-01T10:00:00+00:00", name=None, commune="Paris",
        renting="OUI", ebike=1):
    return {"stationcode": code, "name": name or f"S{code}", "capacity": cap, "numdocksavailable": docks,
            "numbikesavailable": bikes, "ebike": ebike, "is_renting": renting, "is_returning": "OUI",
            "duedate": due, "coordonnees_geo": {"lon": 2.35, "lat": 48.85}, "nom_arrondissement_communes": commune}


def env(results, batch="b1", fetched="2026-07-01T10:05:00+00:00", source="disponibilite"):
    return json.dumps({"source": source, "fetched_at": fetched, "batch_id": batch,
                       "payload": {"total_count": len(results), "results": results}})


def messages(spark, values, ts=T0):
    rows = [(None, v.encode() if isinstance(v, str) else v, "t", 0, i, ts + dt.timedelta(seconds=i), 0)
            for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SC.MESSAGE).withColumn("micro_batch", F.lit(1).cast("bigint"))


def parsed(spark, values):
    dec = P.decode(messages(spark, values), SC.AVAILABILITY_RESULT)
    rows = P.project_availability(P.explode_records(dec, keep=P.MSG_COLS + ["batch_id", "fetched_at", "micro_batch"]))
    return dec, rows.withColumn("is_valid", R.reading_valid())


def test_empty_missing_and_malformed(spark):
    vals = [env([]), json.dumps({"source": "disponibilite", "batch_id": "x"}), '{"source": "dispo', env([rec("1")])]
    dec, rows = parsed(spark, vals)
    assert rows.count() == 1
    assert AL.empty_fetch_alerts(dec).count() == 2
    bad = AL.malformed_alerts(dec).collect()
    assert len(bad) == 1 and bad[0]["severity"] == "CRITICAL"


def test_badly_typed_field_keeps_neighbours(spark):
    r = rec("2")
    r["capacity"] = "xx"
    dec, rows = parsed(spark, [env([rec("1"), r, rec("3")])])
    got = {x["station_id"]: x["capacity"] for x in rows.collect()}
    assert got == {"1": 20, "2": None, "3": 20}


def test_offset_instants_are_equal(spark):
    dec, rows = parsed(spark, [env([rec("1", due="2026-07-01T12:00:00+02:00"), rec("1", due="2026-07-01T10:00:00Z")])])
    ts = {x["observed_at"] for x in rows.collect()}
    assert ts == {dt.datetime(2026, 7, 1, 10, 0)}
    first = M.first_wins(rows, ["station_id", "observed_at"], P.order_key(), ["num_bikes_available"])
    assert first.count() == 1


def _ratio_alerts(spark, n, bad):
    results = [rec(str(i)) for i in range(n - bad)] + [rec(str(1000 + i), bikes=-1) for i in range(bad)]
    dec, rows = parsed(spark, [env(results)])
    return AL.reject_rate_alerts(AL.reject_ratio(rows), "Disponibilite", "disponibilite").collect()


def test_reject_threshold_is_strict(spark):
    assert _ratio_alerts(spark, 100, 2) == []
    got = _ratio_alerts(spark, 100, 3)
    assert len(got) == 1 and abs(got[0]["metric_value"] - 0.03) < 1e-12
    assert got[0]["description"].startswith("Disponibilite : 3.0%")


def test_freshness_threshold(spark):
    def alerts(due):
        dec, rows = parsed(spark, [env([rec("1", due=due)], fetched="2026-07-01T10:10:00+00:00")])
        return AL.freshness_alerts(AL.freshness(rows), "disponibilite").count()
    assert alerts("2026-07-01T10:00:00+00:00") == 0
    assert alerts("2026-07-01T09:59:59+00:00") == 1


def test_all_invalid_gives_reject_alert_only(spark):
    dec, rows = parsed(spark, [env([rec("1", bikes=-1), rec("2", bikes=-5)])])
    assert AL.reject_rate_alerts(AL.reject_ratio(rows), "D", "d").count() == 1
    assert AL.freshness_alerts(AL.freshness(rows), "d").count() == 0


def test_last_wins_and_first_wins(spark):
    dec, rows = parsed(spark, [env([rec("1", name="old", bikes=1)], batch="a"),
                               env([rec("1", name="new", bikes=2)], batch="b")])
    snap = M.station_upsert(None, rows, P.order_key(), F.col("fetched_at")).collect()
    assert len(snap) == 1 and snap[0]["name"] == "new"
    first = M.first_wins(rows, ["station_id", "observed_at"], P.order_key(), ["num_bikes_available"]).collect()
    assert first[0]["num_bikes_available"] == 1


def test_stub_and_known_station(spark):
    dec, rows = parsed(spark, [env([rec("1", name="other"), rec("9", name="brand new")])])
    snap = spark.createDataFrame([("1", "known", 48.8, 2.3, 10, "Paris", True, T0)], SC.STATIONS)
    ok, bad = M.station_stubs(snap, rows, P.order_key(), F.col("fetched_at"))
    got = {r["station_id"]: r["name"] for r in ok.collect()}
    assert got == {"9": "brand new"} and bad.count() == 0


def test_stub_with_null_name_is_quarantined(spark):
    r = rec("7")
    r["name"] = None
    dec, rows = parsed(spark, [env([r, rec("8")])])
    snap = spark.createDataFrame([], SC.STATIONS)
    ok, bad = M.station_stubs(snap, rows, P.order_key(), F.col("fetched_at"))
    assert [x["station_id"] for x in ok.collect()] == ["8"]
    assert [(x["station_id"], x["violation"]) for x in bad.collect()] == [("7", "name_null")]


def test_null_ebike_and_renting_quarantined(spark):
    dec, rows = parsed(spark, [env([rec("1", ebike=None), rec("2", renting=None), rec("3")])])
    facts = rows.withColumn("batch_id", F.lit("b")).withColumn("v", R.reading_row_violation())
    got = {r["station_id"]: r["v"] for r in facts.collect()}
    assert got == {"1": "ebikes_null", "2": "is_renting_null", "3": None}


def test_empty_commune_does_not_clear(spark):
    dec, rows = parsed(spark, [env([rec("1", commune="Paris")], batch="a"), env([rec("1", commune="")], batch="b")])
    upd = M.commune_updates(rows, P.order_key())
    snap = spark.createDataFrame([("1", "S1", 48.8, 2.3, 10, None, True, T0)], SC.STATIONS)
    out = M.commune_backfill(snap, upd).collect()
    assert out[0]["commune"] == "Paris" and out[0]["updated_at"] == T0


def test_each_row_keeps_its_batch_id(spark):
    dec, rows = parsed(spark, [env([rec("1")], batch="a"), env([rec("2")], batch="b")])
    got = {r["station_id"]: r["batch_id"] for r in P.fact_rows(rows).collect()}
    assert got == {"1": "a", "2": "b"}


def test_reading_insert_skips_existing_keys(spark):
    dec, rows = parsed(spark, [env([rec("1", bikes=3), rec("2", bikes=4)])])
    target = P.fact_rows(rows.filter("station_id = '1'"))
    new = M.reading_insert(target, rows, P.order_key(), P.FACT_COLS).collect()
    assert [r["station_id"] for r in new] == ["2"]
