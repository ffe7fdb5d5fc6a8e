"""Committed epochs and immutable table versions.

Everything an epoch writes lies in ``<table>/run=<query>/epoch=<n>``; one marker folder per
epoch, written last, commits all of it at once. The marker also carries what the feed has to remember
between micro-batches: per source the newest fetch and the newest observation.

A version of a table is one or more segment folders that are never written again, and a marker
``_versions/<table>/version=<n>`` written last that lists them and, per run, the last
epoch they cover. A reader resolves the newest marker once, so it sees one version and the committed
epochs after it, whatever is folded meanwhile. One writer per table is assumed; a second one that
publishes the same version number fails on the existing marker folder.
"""
from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKER = ("feed string, run string, epoch bigint, source string, last_fetch timestamp_ntz, newest_observed timestamp_ntz, "
          "n_total bigint, n_valid bigint")
VERSION = "segment string, run string, upto bigint, version bigint"


def read_or_none(spark: SparkSession, schema: str, *paths: str, base: str | None = None) -> DataFrame | None:
    """The rows under ``paths``, or None where nothing has been written; any other error is raised."""
    try:
        r = spark.read.schema(schema)
        return (r.option("basePath", base) if base else r).parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


class Root:
    """The folder tree of one ingest."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ---- epochs ----------------------------------------------------------
    def epoch_path(self, table: str, run: str, epoch: int) -> str:
        return f"{self.path}/{table}/run={run}/epoch={epoch}"

    def commit(self, feed: str, run: str, epoch: int, state: DataFrame) -> None:
        """Mark an epoch committed. ``state``: source, last_fetch, newest_observed, n_total, n_valid; may be empty."""
        rows = [(feed, r.source, r.last_fetch, r.newest_observed, r.n_total, r.n_valid) for r in state.collect()]     # one row per source
        rows = rows or [(feed, None, None, None, 0, 0)]
        cols = "feed string, source string, last_fetch timestamp_ntz, newest_observed timestamp_ntz, n_total bigint, n_valid bigint"
        self.spark.createDataFrame(rows, cols).coalesce(1).write.mode("overwrite").parquet(self.epoch_path("_manifest", run, epoch))

    def manifest(self) -> DataFrame | None:
        return read_or_none(self.spark, MARKER, f"{self.path}/_manifest")

    def epochs(self, feed: str | None = None, after: dict | None = None, exclude: tuple | None = None) -> list[tuple[str, int]]:
        """Committed (run, epoch), without those that ``after`` covers and without ``exclude``."""
        man = self.manifest()
        if man is None:
            return []
        if feed:
            man = man.filter(F.col("feed") == feed)
        got = [(r.run, r.epoch) for r in man.select("run", "epoch").distinct().collect()]
        return sorted(e for e in got if e != exclude and e[1] > (after or {}).get(e[0], -1))

    def read_epochs(self, table: str, schema: str, epochs: list[tuple[str, int]]) -> DataFrame | None:
        if not epochs:
            return None
        return read_or_none(self.spark, schema + ", run string, epoch bigint", *[self.epoch_path(table, r, e) for r, e in epochs],
                            base=f"{self.path}/{table}")

    def feed_state(self, before: tuple | None = None) -> DataFrame | None:
        """Newest fetch and newest valid observation per source over the committed epochs; of the run
        of ``before`` only those before that epoch, so a replayed epoch sees what it saw at first."""
        man = self.manifest()
        if man is None:
            return None
        if before is not None:
            man = man.filter((F.col("run") != before[0]) | (F.col("epoch") < before[1]))
        return (man.filter("source IS NOT NULL").groupBy("source")
                .agg(F.max("last_fetch").alias("last_fetch"), F.max("newest_observed").alias("newest_observed")))

    # ---- versions --------------------------------------------------------
    def latest(self, table: str) -> tuple[int, list[str], dict]:
        """(version, its segments, last covered epoch per run); version 0 where there is none."""
        m = read_or_none(self.spark, VERSION, f"{self.path}/_versions/{table}")
        newest = m.agg(F.max("version")).first()[0] if m is not None else None
        if newest is None:
            return 0, [], {}
        rows = m.filter(F.col("version") == newest).collect()
        return newest, sorted(r.segment for r in rows if r.segment), {r.run: r.upto for r in rows if r.run}

    def publish(self, table: str, df: DataFrame, epochs: list[tuple[str, int]], replace: bool, partition_by: tuple = ()) -> int:
        """Write ``df`` as a new segment (in place of the older ones where ``replace``) and swap the pointer."""
        version, segments, covered = self.latest(table)
        name = uuid.uuid4().hex
        w = df.write.mode("errorifexists")
        (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{self.path}/_segments/{table}/{name}")
        covered = reduce(lambda c, e: {**c, e[0]: max(e[1], c.get(e[0], -1))}, epochs, covered)
        rows = [(s, None, None) for s in ([name] if replace else segments + [name])] + [(None, r, e) for r, e in covered.items()]
        (self.spark.createDataFrame(rows, "segment string, run string, upto bigint").coalesce(1)
         .write.mode("errorifexists").parquet(f"{self.path}/_versions/{table}/version={version + 1}"))
        return version + 1

    def read_segments(self, table: str, schema: str, segments: list[str]) -> DataFrame | None:
        frames = [read_or_none(self.spark, schema, f"{self.path}/_segments/{table}/{s}") for s in segments]
        return reduce(DataFrame.unionByName, [f for f in frames if f is not None]) if any(f is not None for f in frames) else None

    def read(self, table: str, schema: str, feed: str | None = None, exclude: tuple | None = None) -> DataFrame | None:
        """Newest version plus the committed epochs after it; None where there is neither."""
        _, segments, covered = self.latest(table)
        old = self.read_segments(table, schema, segments)
        new = self.read_epochs(table, schema, self.epochs(feed, covered, exclude))
        new = None if new is None else new.drop("run", "epoch")
        parts = [p for p in (old, new) if p is not None]
        return reduce(DataFrame.unionByName, parts) if parts else None
