"""Stream = batch; rerun, replay of an epoch and a fresh checkpoint change nothing."""
import json
import os

from pyspark.sql import functions as F

from dockline.functions import rules as R
from dockline.operators import parse as P
from dockline.plans import jobs as J
from dockline.sources import fixtures as FX
from dockline.streaming import pipeline as PL

D = "/root/testdata/sf0.001"
KEY = ["station_id", "observed_at", "num_bikes_available", "num_docks_available", "batch_id"]


def _rows(df):
    return sorted(tuple(r) for r in df.select(*KEY).collect())


def test_stream_equals_batch_and_is_idempotent(spark, scratch):
    src = os.path.join(scratch, "in")
    msgs = FX.availability_messages(spark, D)
    msgs.repartition(3, "offset").write.parquet(src)
    st_src = os.path.join(scratch, "in_st")
    FX.station_envelopes(spark, D).coalesce(1).write.parquet(st_src)
    root, ck = os.path.join(scratch, "out"), os.path.join(scratch, "ck")

    PL.run_both(spark, PL.file_source(spark, st_src), PL.file_source(spark, src), root, ck)
    # readings whose station has no row that the stations table takes stay out (foreign key)
    av = J.availability_parsed(spark, D).filter("is_valid")
    homes = av.filter(R.station_row_violation(commune=F.lit(None).cast("string")).isNull()).select("station_id").distinct()
    assert 0 < av.join(homes, "station_id", "left_anti").count()
    batch = P.fact_rows(av.join(homes, "station_id", "left_semi"))
    first = _rows(PL.readings_table(spark, root))
    assert first == _rows(batch)
    n_alerts = PL.alerts_table(spark, root).count()
    assert n_alerts > 0
    snap1 = sorted(tuple(r) for r in PL.current_stations(spark, root).collect())

    # rerun on the same checkpoint: nothing new is read
    PL.run_both(spark, PL.file_source(spark, st_src), PL.file_source(spark, src), root, ck)
    assert _rows(PL.readings_table(spark, root)) == first

    # replay one epoch of the availability query (same query id, same epoch)
    man = spark.read.parquet(os.path.join(root, "_manifest")).filter("feed = 'disponibilite'").first()
    epoch = man["epoch"]
    log = os.path.join(ck, "availability", "sources", "0", str(epoch))
    files = [json.loads(line)["path"] for line in open(log).read().splitlines()[1:] if line.strip()]
    epoch_df = spark.read.schema(msgs.schema).parquet(*files)
    PL.process_batch(epoch_df, epoch, root, "disponibilite", run=man["run"])
    assert _rows(PL.readings_table(spark, root)) == first

    # a fresh checkpoint (new query id) re-reads everything: no duplicates
    PL.run_both(spark, PL.file_source(spark, st_src), PL.file_source(spark, src), root, ck + "2")
    assert _rows(PL.readings_table(spark, root)) == first
    assert PL.alerts_table(spark, root).count() == n_alerts
    assert sorted(tuple(r) for r in PL.current_stations(spark, root).collect()) == snap1
    snap = PL.current_stations(spark, root)
    assert snap.count() == snap.select("station_id").distinct().count()
    assert snap.filter(F.col("commune").isNotNull()).count() > 0
