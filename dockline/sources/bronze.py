"""Bronze archive (S3) and its replay.

Raw message values are stored unchanged, partitioned by ``source`` and ``dt`` (arrival day). Source and
batch id are read with ``get_json_object`` so malformed text is archived too (D6), under its topic
and a topic/partition/offset id. Writing is a narrow job.

A re-delivered batch id, in the same batch or in a later epoch, keeps the newest message by (timestamp,
partition, offset), as an object store overwrite would. Readers see to that by keys alone: rows are
named by file and row number, keys that occur more than once are found from the key columns, and
the superseded rows among them are taken out by an anti join on their names. Payloads are not
shuffled unless the superseded rows are too many to broadcast.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import schemas as SC
from ..streaming.versions import Root

ARCHIVE_SCHEMA = ("batch_id string, topic string, partition int, offset bigint, timestamp timestamp, "
                  "value binary, source string, dt date")
TABLE = "bronze"


def archive_rows(messages: DataFrame) -> DataFrame:
    text = F.col("value").cast("string")
    src = F.coalesce(F.get_json_object(text, "$.source"), F.col("topic"))
    bid = F.coalesce(F.get_json_object(text, "$.batch_id"),
                     F.concat_ws("-", F.col("topic"), F.col("partition").cast("string"), F.col("offset").cast("string")))
    return messages.select(bid.alias("batch_id"), "topic", "partition", "offset", "timestamp", "value",
                           src.alias("source"), F.to_date("timestamp").alias("dt"))


def archive(messages: DataFrame, path: str, mode: str = "overwrite") -> None:
    archive_rows(messages).write.mode(mode).partitionBy("source", "dt").parquet(path)


def _newest(stored: list[DataFrame]) -> DataFrame:
    """The newest row per (source, batch_id) of stored archives; ``_metadata`` names their rows."""
    named = [a.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")) for a in stored]
    rows = reduce(DataFrame.unionByName, named)
    keys = rows.select("source", "batch_id", "timestamp", "partition", "offset", "_file", "_row")
    twice = keys.groupBy("source", "batch_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = keys.join(twice, ["source", "batch_id"], "left_semi")
    order = F.struct("timestamp", "partition", "offset", "_file", "_row")
    best = again.groupBy("source", "batch_id").agg(F.max(order).alias("_b")).select("_b._file", "_b._row")
    lost = again.select("_file", "_row").join(best, ["_file", "_row"], "left_anti")
    return rows.join(lost, ["_file", "_row"], "left_anti").drop("_file", "_row")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    return _newest([spark.read.schema(ARCHIVE_SCHEMA).parquet(path)])


def read_committed(spark: SparkSession, root: str) -> DataFrame | None:
    """The archive that a stream has written: newest version and committed epochs, each batch id once."""
    r = Root(spark, root)
    _, segments, covered = r.latest(TABLE)
    stored = [r.read_segments(TABLE, ARCHIVE_SCHEMA, [s]) for s in segments]
    stored.append(r.read_epochs(TABLE, ARCHIVE_SCHEMA, r.epochs(after=covered)))
    stored = [s.drop("run", "epoch") if "run" in s.columns else s for s in stored if s is not None]
    return _newest(stored) if stored else None


def compact(spark: SparkSession, root: str) -> int | None:
    """Merge the committed epochs that no version covers into one segment and swap the version. Returns the new
    version, None where there is nothing new. Rows that a later epoch supersedes go when they meet in one
    segment; readers take out the rest."""
    r = Root(spark, root)
    _, _, covered = r.latest(TABLE)
    epochs = r.epochs(after=covered)
    new = r.read_epochs(TABLE, ARCHIVE_SCHEMA, epochs)
    if new is None:
        return None
    return r.publish(TABLE, _newest([new]).drop("run", "epoch"), epochs, replace=False, partition_by=("source", "dt"))


def as_messages(archived: DataFrame) -> DataFrame:
    """Archived rows as a Kafka-shaped message frame."""
    return archived.select(F.lit(None).cast("binary").alias("key"), "value", "topic", "partition", "offset", "timestamp",
                           F.lit(0).alias("timestampType"))


def replay(spark: SparkSession, path: str) -> DataFrame:
    return as_messages(read_archive(spark, path))


def listing(spark: SparkSession, path: str) -> DataFrame:
    """What the archive holds, with each value decoded again."""
    from ..operators.parse import decode
    a = read_archive(spark, path)
    dec = decode(a.select("topic", "partition", "offset", "timestamp", "value",
                          F.col("source").alias("archived_source"), F.col("dt"),
                          F.col("batch_id").alias("archived_batch_id")), SC.CODE_RESULT)
    return dec.select(F.col("archived_source").alias("source"), F.date_format("dt", "yyyy-MM-dd").alias("dt"),
                      F.col("archived_batch_id").alias("batch_id"), "topic", "partition", "offset",
                      "is_corrupt", "n_results")
