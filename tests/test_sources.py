"""Bronze archive, feed gaps and message rates on hand-made messages."""
import datetime as dt
import json
import os

from pyspark.sql import functions as F

from dockline.functions import schemas as SC
from dockline.operators import alerts as AL
from dockline.operators import analytics as A
from dockline.sources import bronze as BZ

T0 = dt.datetime(2026, 7, 1, 10, 0, 0)


def _msg(value, offset, ts):
    return (None, value.encode(), "t", 0, offset, ts, 0)


def test_bronze_keeps_newest_per_batch_id_and_malformed(spark, scratch):
    v1 = json.dumps({"source": "disponibilite", "batch_id": "b1", "payload": {"results": []}, "n": 1})
    v2 = json.dumps({"source": "disponibilite", "batch_id": "b1", "payload": {"results": []}, "n": 2})
    msgs = spark.createDataFrame([_msg(v1, 1, T0), _msg(v2, 2, T0 + dt.timedelta(seconds=5)),
                                  _msg('{"broken', 3, T0)], SC.MESSAGE)
    path = os.path.join(scratch, "bronze")
    BZ.archive(msgs, path)
    got = {(r["source"], r["batch_id"]): r["value"] for r in BZ.read_archive(spark, path).collect()}
    assert got[("disponibilite", "b1")] == v2.encode()
    assert got[("t", "t-0-3")] == b'{"broken'
    replay = BZ.replay(spark, path)
    assert replay.columns == [f.name for f in SC.MESSAGE.fields] and replay.count() == 2


def test_feed_gap_threshold_is_strict(spark):
    rows = [("s", T0), ("s", T0 + dt.timedelta(minutes=10)), ("s", T0 + dt.timedelta(minutes=21)),
            ("s", T0 + dt.timedelta(minutes=21, seconds=30)), ("u", T0)]
    f = spark.createDataFrame(rows, "source string, fetched_at timestamp_ntz")
    alerts = AL.feed_gap_alerts(AL.feed_gaps(f)).collect()
    assert [(a["metric_value"], a["severity"]) for a in alerts] == [(11.0, "CRITICAL")]


def test_sliding_message_rate(spark):
    m = spark.createDataFrame([("t", T0 + dt.timedelta(minutes=2, seconds=30))], "topic string, timestamp timestamp_ntz")
    r = A.message_rate(m).orderBy("window_start").collect()
    assert len(r) == 5
    assert r[0]["window_start"] == T0 - dt.timedelta(minutes=2) and r[-1]["window_start"] == T0 + dt.timedelta(minutes=2)
    assert all(x["n_messages"] == 1 and abs(x["rate_per_s"] - 1 / 300) < 1e-15 for x in r)
