"""Stored stations, constraints, feed state, pruned history, bronze across epochs, publisher: on hand-made feeds."""
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from dockline import settings as S
from dockline.functions import rules as R
from dockline.functions import schemas as SC
from dockline.operators import alerts as AL
from dockline.operators import merge as M
from dockline.operators import parse as P
from dockline.operators import publish as PUB
from dockline.plans import jobs as J
from dockline.plans import registry
from dockline.sources import bronze as BZ
from dockline.streaming import pipeline as PL
from dockline.streaming.versions import Root

D = "/root/testdata/sf0.001"
T0 = dt.datetime(2026, 7, 1, 10, 0, 0)
AV, ST = S.SOURCE_AVAILABILITY, S.SOURCE_STATIONS


def at(minutes):
    return (T0 + dt.timedelta(minutes=minutes)).isoformat() + "+00:00"


def reading(code, due=0, bikes=5, docks=5, cap=20, name="", commune="Paris", ebike=1, renting="OUI"):
    return {"stationcode": code, "name": f"S{code}" if name == "" else name, "capacity": cap, "numdocksavailable": docks,
            "numbikesavailable": bikes, "ebike": ebike, "is_renting": renting, "is_returning": "OUI", "duedate": at(due),
            "coordonnees_geo": {"lon": 2.35, "lat": 48.85}, "nom_arrondissement_communes": commune}


def station(code, name="", cap=20):
    return {"stationcode": code, "name": f"F{code}" if name == "" else name, "capacity": cap, "coordonnees_geo": {"lon": 2.35, "lat": 48.85}}


def env(results, batch, fetched=5, source=AV, **more):
    return json.dumps({"source": source, "fetched_at": at(fetched), "batch_id": batch,
                       "payload": {"total_count": len(results), "results": results}, **more})


def messages(spark, values, first=0, topic="t"):
    rows = [(None, v.encode(), topic, 0, first + i, T0 + dt.timedelta(seconds=first + i), 0) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SC.MESSAGE)


def epoch(spark, root, n, values, feed=AV, run="r", as_of=None):
    PL.process_batch(messages(spark, values, 100 * n, feed), n, root, feed, run=run,
                     as_of=F.lit((T0 + dt.timedelta(minutes=6)).isoformat(" ")).cast("timestamp") if as_of is None else as_of)


def stations(df):
    return {r.station_id: (r.name, r.commune, r.capacity) for r in df.collect()}


def test_stored_stations_are_updated_in_versions(spark, scratch):
    epoch(spark, scratch, 0, [env([station("1", "old"), station("2")], "s1", 1, ST)], ST, "st")
    epoch(spark, scratch, 0, [env([reading("1", commune="Paris"), reading("9", commune="")], "a1", 2)])
    assert PL.fold_stations(spark, scratch) == 1
    reader = PL.current_stations(spark, scratch)
    want = {"1": ("old", "Paris", 20), "2": ("F2", None, 20), "9": ("S9", None, 20)}
    assert stations(reader) == want
    # an update, a commune that clears nothing, a stub of a known station, an older feed row that comes late
    epoch(spark, scratch, 1, [env([station("1", "new", 31)], "s2", 8, ST), env([station("2", "late")], "s0", 0, ST)], ST, "st")
    epoch(spark, scratch, 1, [env([reading("1", 1, name="other", commune=""), reading("9", 1, commune="Lyon")], "a2", 9)])
    newer = {"1": ("new", "Paris", 31), "2": ("F2", None, 20), "9": ("S9", "Lyon", 20)}
    assert stations(PL.current_stations(spark, scratch)) == newer
    r = Root(spark, scratch)
    assert r.latest("stations")[0] == 1 and PL.fold_stations(spark, scratch) == 2
    # the fold read the new epochs only, and nothing is left to fold
    assert r.latest("stations")[2] == {"st": 1, "r": 1} and r.epochs(after=r.latest("stations")[2]) == []
    assert PL.fold_stations(spark, scratch) is None
    assert stations(reader) == want                       # a reader keeps the version it resolved
    assert stations(PL.current_stations(spark, scratch)) == newer
    # the same changes once more, by another run and in another order
    epoch(spark, scratch, 0, [env([station("2", "late")], "s0", 0, ST), env([station("1", "new", 31)], "s2", 8, ST)], ST, "st2")
    epoch(spark, scratch, 1, [env([station("1", "old"), station("2")], "s1", 1, ST)], ST, "st2")
    assert stations(PL.current_stations(spark, scratch)) == newer and PL.fold_stations(spark, scratch) == 3
    assert stations(PL.current_stations(spark, scratch)) == newer


def test_states_merge_alike_in_any_order(spark):
    order = [(T0 + dt.timedelta(minutes=m), 0, m, 0) for m in range(4)]
    rows = [("station", "1", "b", 1.0, 1.0, 2, None, T0, *order[1]), ("station", "1", "a", 1.0, 1.0, 1, None, T0, *order[0]),
            ("stub", "1", "s", 1.0, 1.0, 1, None, T0, *order[0]), ("stub", "2", "t", 1.0, 1.0, 1, None, T0, *order[2]),
            ("stub", "2", "u", 1.0, 1.0, 1, None, T0, *order[3]), ("commune", "2", None, None, None, None, "Paris", T0, *order[2]),
            ("commune", "2", None, None, None, None, "", T0, *order[3]), ("commune", "3", None, None, None, None, "Lyon", T0, *order[3])]
    lifted = M.lift_changes(spark.createDataFrame(rows, M.CHANGES_SCHEMA))
    once = M.merge_states(lifted)
    assert stations(M.stations_of(once)) == {"1": ("b", None, 2), "2": ("t", "Paris", 1)}
    halves = M.merge_states(lifted.filter("station_id <> '2'")).unionByName(M.merge_states(lifted.filter("station_id = '2'"))).unionByName(once)
    assert sorted(map(str, M.merge_states(halves).collect())) == sorted(map(str, once.collect()))


def test_epoch_keeps_constraints_and_foreign_key(spark, scratch):
    epoch(spark, scratch, 0, [env([station("1"), station("2", None), station("3", "n" * 300)], "s", 1, ST)], ST, "st")
    epoch(spark, scratch, 0, [env([reading("1", name=None), reading("2", name=None), reading("3", name="n" * 300), reading("4"),
                                   reading("5", ebike=None), reading("6", renting=None), reading("7", cap=None),
                                   reading("8", name=None), reading("8", 1)], "a", 2)])
    got = {r.station_id for r in PL.readings_table(spark, scratch).collect()}
    assert got == {"1", "4", "8"}                         # 1 is stored, 4 and 8 come with a good stub
    table = stations(PL.current_stations(spark, scratch))
    assert set(table) == {"1", "4", "5", "6", "8"} and table["8"][0] == "S8"
    assert PL.readings_table(spark, scratch).join(PL.current_stations(spark, scratch), "station_id", "left_anti").count() == 0
    bad = {(r.table_name, r.station_id, r.violation) for r in PL.quarantine_table(spark, scratch).collect()}
    assert bad == {("stations", "2", "name_null"), ("stations", "3", "name_too_long"), ("stations", "7", "capacity_null"),
                   ("disponibilite_releve", "2", "station_unknown"), ("disponibilite_releve", "3", "station_unknown"),
                   ("disponibilite_releve", "7", "station_unknown"), ("disponibilite_releve", "5", "ebikes_null"),
                   ("disponibilite_releve", "6", "is_renting_null")}
    # a station of the feed makes later readings welcome, without touching its row
    epoch(spark, scratch, 1, [env([station("2", "now known")], "s3", 3, ST)], ST, "st")
    epoch(spark, scratch, 1, [env([reading("2", 1, name=None)], "a3", 4)])
    assert "2" in {r.station_id for r in PL.readings_table(spark, scratch).collect()}
    assert stations(PL.current_stations(spark, scratch))["2"][0] == "now known"


def gaps(spark, root):
    return sorted((r.detected_at, r.metric_value) for r in PL.alerts_table(spark, root).filter("alert_type = 'API_INDISPONIBLE'").collect())


def test_gap_across_epochs_is_raised_once(spark, scratch):
    epoch(spark, scratch, 0, [env([reading("1")], "a", 0), env([reading("1", 1)], "b", 10)])
    assert gaps(spark, scratch) == []
    epoch(spark, scratch, 1, [env([reading("1", 2)], "c", 25), env([reading("1", 3)], "d", 26)])
    want = [(T0 + dt.timedelta(minutes=25), 15.0)]
    assert gaps(spark, scratch) == want
    epoch(spark, scratch, 1, [env([reading("1", 2)], "c", 25), env([reading("1", 3)], "d", 26)])          # replay
    epoch(spark, scratch, 0, [env([reading("1")], "a", 0), env([reading("1", 2)], "c", 25)], run="again")  # fresh checkpoint
    assert gaps(spark, scratch) == want
    status = PL.feed_status(spark, scratch, F.lit("2026-07-01 10:40:00").cast("timestamp")).collect()
    assert [(r.source, r.silent_min, r.freshness_min) for r in status] == [(AV, 14.0, 37.0)]
    state = Root(spark, scratch).feed_state()
    silent = [AL.silence_alerts(state, F.lit(f"2026-07-01 10:{m}:00").cast("timestamp")).collect() for m in (36, 37, 50)]
    assert [len(s) for s in silent] == [0, 1, 1] and silent[1][0].alert_id == silent[2][0].alert_id


def test_freshness_against_the_clock(spark, scratch):
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    young = (now - dt.timedelta(minutes=2) - T0).total_seconds() / 60
    def alerts(root, due):
        PL.process_batch(messages(spark, [env([reading("1", due)], "a", due + 1)]), 0, root, AV, run="r")
        return PL.alerts_table(spark, root).filter("alert_type = 'FRAICHEUR_DEGRADEE'").count()
    assert alerts(os.path.join(scratch, "young"), young) == 0
    assert alerts(os.path.join(scratch, "old"), young - 9) == 1      # fetched at once, but 11 minutes old by now


def test_history_is_pruned_by_dates_and_keys(spark, scratch):
    day = 24 * 60
    for n in range(3):
        epoch(spark, scratch, n, [env([reading(str(i), n * day) for i in range(50)], f"a{n}", n * day + 1)])
    batch = PL.readings_table(spark, scratch).filter("obs_date = DATE'2026-07-02' AND station_id < '2'").select("station_id", "observed_at")
    prior = Root(spark, scratch).read("readings", PL.READINGS_SCHEMA)
    pruned = PL.history_for(prior, batch)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(obs_date" in plan and "= 2026-07-02)" in plan
    keys = {(r.station_id, r.observed_at) for r in batch.collect()}
    kept = {(r.station_id, r.observed_at) for r in pruned.collect()}
    assert keys <= kept and len(kept) <= len(keys) + 2
    # compacted history gives the same answer, and a page delivered again adds nothing
    before = sorted(map(str, PL.readings_table(spark, scratch).drop("ingested_at").collect()))
    assert PL.compact_readings(spark, scratch) == 1 and PL.compact_readings(spark, scratch) is None
    epoch(spark, scratch, 3, [env([reading(str(i), day, bikes=9) for i in range(50)], "again", day + 9)])
    assert sorted(map(str, PL.readings_table(spark, scratch).drop("ingested_at").collect())) == before


def test_key_filter_lets_every_key_through(spark):
    keys = spark.range(0, 5000, 7).select(F.col("id").cast("string").alias("k"), F.col("id").alias("t"))
    everything = spark.range(20000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("t"))
    for bits, most in ((64, 20000), (1 << 18, 800)):
        kept = everything.filter(PL.key_filter(keys, ["k", "t"], bits))
        assert keys.join(kept, ["k", "t"], "left_anti").count() == 0 and kept.count() <= most
    assert everything.filter(PL.key_filter(keys.limit(0), ["k", "t"])).count() == 0


def test_kpis_of_the_stored_tables(spark, scratch):
    assert PL.ingest_kpis(spark, scratch) is None
    now = (dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - T0).total_seconds() / 60
    epoch(spark, scratch, 0, [env([reading("1", now - 60), reading("2", now - 1), reading("3", bikes=-1)], "a", now - 60)])
    epoch(spark, scratch, 1, [env([reading("1", now)], "b", now - 30), '{"bad'])
    k = PL.ingest_kpis(spark, scratch).collect()
    assert len(k) == 1
    k = k[0]
    assert (k.n_records, k.n_rejected, k.reject_share, k.n_readings) == (4, 1, 0.25, 3)
    assert k.share_in_time == pytest.approx(2 / 3) and 20 < k.latency_min < 25
    # 30 minutes between the fetches, 10 of them covered by the first
    assert k.feed_availability == pytest.approx(1 - 20 / 30, abs=0.03)
    assert k.n_alerts == PL.alerts_table(spark, scratch).count() > 0


def test_bronze_across_epochs(spark, scratch):
    epoch(spark, scratch, 0, [env([reading("1")], "b1", n=1), env([reading("2")], "b2"), '{"broken'])
    epoch(spark, scratch, 1, [env([reading("1", bikes=7)], "b1", n=2), env([reading("3")], "b3")])
    def held():
        return sorted((r.batch_id, json.loads(r.value).get("n") if r.value.startswith(b'{"source') else None) for r in BZ.read_committed(spark, scratch).collect())
    want = [("b1", 2), ("b2", None), ("b3", None), (f"{AV}-0-2", None)]
    assert held() == want
    assert BZ.compact(spark, scratch) == 1 and BZ.compact(spark, scratch) is None and held() == want
    assert Root(spark, scratch).epochs(after=Root(spark, scratch).latest("bronze")[2]) == []
    epoch(spark, scratch, 2, [env([reading("1", bikes=8)], "b1", n=3)])
    assert held() == [("b1", 3)] + want[1:]
    assert BZ.compact(spark, scratch) == 2 and held() == [("b1", 3)] + want[1:]
    # what was streamed can be replayed
    msgs = BZ.as_messages(BZ.read_committed(spark, scratch))
    assert msgs.columns == [f.name for f in SC.MESSAGE.fields]
    rows = P.project_availability(P.explode_records(P.decode(msgs, SC.AVAILABILITY_RESULT)))
    assert {(r.station_id, r.num_bikes_available) for r in rows.collect()} == {("1", 8), ("2", 5), ("3", 5)}


def test_empty_batch_commits_nothing_but_its_marker(spark, scratch):
    for feed in (AV, ST):
        PL.process_batch(messages(spark, []), 0, scratch, feed, run=feed)
    assert Root(spark, scratch).epochs() == [(AV, 0), (ST, 0)]
    assert PL.readings_table(spark, scratch).count() == 0 and PL.alerts_table(spark, scratch).count() == 0
    assert PL.feed_status(spark, scratch).count() == 0 and PL.current_stations(spark, scratch).count() == 0


def test_a_failing_feed_stops_both(spark, scratch):
    good, bad = os.path.join(scratch, "good"), os.path.join(scratch, "bad")
    messages(spark, [env([reading("1")], "a")]).write.parquet(good)
    messages(spark, [env([station("1")], "s", 1, ST)]).write.parquet(bad)
    broken = PL.file_source(spark, bad).withColumn("partition", F.raise_error(F.lit("feed broke")).cast("int"))
    with pytest.raises(Exception, match="feed broke"):
        PL.run_both(spark, broken, PL.file_source(spark, good), os.path.join(scratch, "out"), os.path.join(scratch, "ck"))
    assert not spark.streams.active


def test_publish_and_read_back(spark, scratch):
    topic = os.path.join(scratch, "topic")
    recs = [("p1", i, reading(str(i))) for i in range(3)] + [("p2", 9, reading("9"))]
    schema = f"page string, pos int, record {SC.AVAILABILITY_RESULT.simpleString()}"
    fetched = PUB.pages(spark.createDataFrame(recs, schema), ["page"], ["pos"]).unionByName(
        spark.createDataFrame([("none", [])], f"page string, results array<{SC.AVAILABILITY_RESULT.simpleString()}>"))

    def sink(df):
        assert df.columns == ["key", "value", "topic"]
        (df.withColumn("partition", F.lit(0)).withColumn("offset", F.monotonically_increasing_id())
         .withColumn("timestamp", F.current_timestamp()).withColumn("timestampType", F.lit(0)).write.parquet(topic))

    def source(session, conf):
        assert conf["startingOffsets"] == "earliest" and conf["subscribe"] == "availability.raw"
        return PL.file_source(session, topic)
    PUB.publish(fetched, AV, "availability.raw", sink=sink)
    root = os.path.join(scratch, "out")
    PL.start(PUB.subscribe(spark, "availability.raw", source=source), root, os.path.join(scratch, "ck"), AV).awaitTermination()
    assert sorted(r.station_id for r in PL.readings_table(spark, root).collect()) == ["0", "1", "2", "9"]
    held = BZ.read_committed(spark, root).select("batch_id").collect()
    assert len({r.batch_id for r in held}) == 3 and all(len(r.batch_id) == 36 for r in held)
    assert PL.alerts_table(spark, root).filter("alert_type = 'API_REPONSE_VIDE'").count() == 1


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["reading_project", "station_project", "explode_results", "timestamp_parse", "parse_props", "malformed_messages"])
def test_messages_are_parsed_once(spark, key):
    assert plan_of(registry.queries()[key](spark, D)).count("from_json(") == 1


def test_no_sort_aggregate_over_facts(spark):
    rd, st = registry._rd(spark, D), registry._st(spark, D)
    from dockline.operators import analytics as A
    from dockline.operators import recommend as RC
    for df in (A.latest_reading(rd), RC.latest_stock(rd, st)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join LeftSemi" in plan
    msgs = AL.per_message(J.availability_parsed(spark, D))
    assert "SortAggregate" not in plan_of(msgs) and "HashAggregate" in plan_of(msgs)


def test_message_summary_equals_its_records(spark):
    vals = [env([reading("1"), reading("2", bikes=-1), reading("3", 3)], "a"), env([], "b"), '{"x', env([reading("4", cap=None, bikes=99), None], "c")]
    msgs = messages(spark, vals).withColumn("micro_batch", F.lit(1).cast("bigint"))
    got = P.summarise(msgs, SC.RULE_RESULT, R.record_reading_valid, R.record_observed_at)
    rows = P.project_availability(P.explode_records(P.decode(msgs, SC.AVAILABILITY_RESULT), keep=PL.KEEP)).withColumn("is_valid", R.reading_valid())
    cols = ["offset", "n_total", "n_valid", "newest_observed"]
    a = [tuple(r) for r in got.filter("n_total > 0").select(*cols).orderBy("offset").collect()]
    assert a == [tuple(r) for r in AL.per_message(rows).select(*cols).orderBy("offset").collect()]
    assert [r.age_us for r in got.orderBy("offset").collect()] == [5 * 60_000_000 + 2 * 60_000_000, 0, 0, 5 * 60_000_000]
    for f in (AL.reject_ratio, AL.freshness):
        assert [r.asDict() for r in f(got).collect()] == [r.asDict() for r in f(rows).collect()]


def test_over_a_thousand_pages_a_slot_have_their_own_offsets(spark, monkeypatch):
    from dockline.sources import fixtures as FX
    monkeypatch.setattr(S, "PAGE_SIZE", 1)
    n = FX._paged(spark.range(3000).select("id", F.lit(0).alias("slot")), "slot", "id").select("page").distinct().count()
    assert n == 3000 < S.PAGES_PER_SLOT
    offs = FX.availability_envelopes(spark, D).select("partition", "offset")
    assert offs.count() == offs.distinct().count()
