"""Streams run over the landed events, with the same rows as the batch query up to the watermark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quorumlake.io import shared_checkpoints, table
from quorumlake.plans.registry import query
from quorumlake.streaming import streams as S


def _run(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    shared_checkpoints(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/streams/{uuid.uuid4()}"
    S.run_available(stream, f"{place}/rows", f"{place}/state", mode)
    return spark.read.schema(stream.schema).parquet(f"{place}/rows")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return S.folder_stream(spark, f"{folder}/event[s].parquet", "parquet", table(spark, folder, "events").schema.simpleString()[7:-1].replace(":", " "))


@query("""WITH e AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS session FROM e)
SELECT user_id, min(ts)::VARCHAR AS started, max(ts)::VARCHAR AS ended, count(*) AS n FROM s GROUP BY user_id, session HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 6 DAY""")
def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    rows = _run(spark, S.debounced(_events(spark, folder), "user_id", "ts", "30 minutes", "6 days"))
    return rows.select("user_id", F.col("started").cast("timestamp_ntz").cast("string").alias("started"), F.col("ended").cast("timestamp_ntz").cast("string").alias("ended"), "n")


@query("""SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts),'%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n FROM events GROUP BY 1,2 HAVING max(time_bucket(INTERVAL 1 HOUR, ts)) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 6 DAY""")
def stream_windows(spark: SparkSession, folder: str) -> DataFrame:
    rows = _run(spark, S.windowed(_events(spark, folder), "ts", "1 hour", "6 days", "event_type"))
    return rows.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query()
def stream_limited(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, S.limited(_events(spark, folder), "user_id", "ts", 6 * 3600, 2))
