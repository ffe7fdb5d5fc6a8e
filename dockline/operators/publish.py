"""Feed envelopes and their topic.

``publish`` wraps fetched pages into envelopes with a uuid as batch id and hands them to a topic;
``subscribe`` is the stream over that topic from its earliest offset. Both ends can be
replaced (``sink``, ``source``), so the same code runs without a broker.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefn as T


def envelope_json(source: str, fetched_at: Column, batch_id: Column, results: Column) -> Column:
    """JSON text of one envelope; ``results`` is the array of the page's records."""
    return F.to_json(F.struct(
        F.lit(source).alias("source"),
        T.iso_utc(fetched_at).alias("fetched_at"),
        batch_id.alias("batch_id"),
        F.struct(F.size(results).cast("bigint").alias("total_count"), results.alias("results")).alias("payload"),
    ))


def pages(records: DataFrame, group_cols: list[str], order_cols: list[str]) -> DataFrame:
    """One page per group: its records (struct column ``record``) as the array ``results``, by ``order_cols``."""
    items = F.array_sort(F.collect_list(F.struct(*order_cols, "record")))
    return records.groupBy(*group_cols).agg(F.transform(items, lambda x: x["record"]).alias("results"))


def envelopes(fetched: DataFrame, source: str, fetched_at: Column | None = None) -> DataFrame:
    """Topic records (key, value) of fetched pages: the clock as fetch time where none is given, a new uuid each."""
    at = F.current_timestamp() if fetched_at is None else fetched_at
    return fetched.select(F.lit(None).cast("binary").alias("key"),
                          envelope_json(source, at, F.uuid(), F.col("results")).cast("binary").alias("value"))


def publish(fetched: DataFrame, source: str, topic: str, servers: str | None = None, fetched_at: Column | None = None,
            sink: Callable[[DataFrame], None] | None = None) -> None:
    """Send one envelope per page to ``topic``."""
    out = envelopes(fetched, source, fetched_at).withColumn("topic", F.lit(topic))
    if sink is not None:
        sink(out)
    else:
        out.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def subscribe(spark: SparkSession, topic: str, servers: str | None = None, options: dict | None = None,
              source: Callable[[SparkSession, dict], DataFrame] | None = None) -> DataFrame:
    """The stream over ``topic``, from the earliest offset where the checkpoint knows none."""
    conf = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest", **(options or {})}
    if source is not None:
        return source(spark, conf)
    return spark.readStream.format("kafka").options(**{k: v for k, v in conf.items() if v is not None}).load()
