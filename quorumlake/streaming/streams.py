"""Debounce, late arrivals, rate limits, incremental crawls and decoding of event streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def folder_stream(spark: SparkSession, path: str, fmt: str, schema: str) -> DataFrame:
    """Files of a folder as they arrive, each once; hidden files and those being written are passed over."""
    return spark.readStream.format(fmt).schema(schema).option("pathGlobFilter", "[!._]*").load(path)


def debounced(events: DataFrame, key: str, time: str, quiet: str, late: str) -> DataFrame:
    """(key, started, ended, n) of bursts that a pause of ``quiet`` ends; rows later than ``late`` are left out."""
    rows = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    burst = rows.groupBy(F.session_window("__t", quiet).alias("w"), F.col(key)).agg(F.min("__t").alias("started"), F.max("__t").alias("ended"), F.count(F.lit(1)).alias("n"))
    return burst.select(key, "started", "ended", "n")


def windowed(events: DataFrame, time: str, size: str, late: str, *keys: str) -> DataFrame:
    """(start, keys, n) of tumbling windows that the watermark has passed."""
    rows = events.withColumn("__t", F.col(time).cast("timestamp")).withWatermark("__t", late)
    return rows.groupBy(F.window("__t", size).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def once(events: DataFrame, key: str, time: str, late: str) -> DataFrame:
    """Each key once within the time that late rows may take."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def limited(events: DataFrame, key: str, time: str, seconds: int, most: int, late: str = "1 day") -> DataFrame:
    """(key, at_us, allowed): an exact sliding limit; a row beyond ``most`` in the last ``seconds`` is refused and not counted.

    The state of a key is the times of the rows allowed in the last ``seconds``, so at most ``most`` numbers; it is dropped when
    the watermark, ``late`` behind the latest row, has passed them all.  Rows are put in order within a batch; a row that comes
    in a later batch than a younger one is judged by the rows allowed so far.
    """
    kind, micros = events.schema[key].dataType.simpleString(), seconds * 1_000_000

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        kept = list(state.get[0]) if state.exists else []
        rows = []
        for t in sorted(int(t) for b in batches for t in b["at_us"]):
            kept = [x for x in kept if x > t - micros]
            ok = len(kept) < most
            if ok:
                kept.append(t)
            rows.append((k[0], t, ok))
        state.update((kept,))
        last = max(t for _, t, _ in rows) // 1000 + seconds * 1000
        state.setTimeoutTimestamp(max(last, state.getCurrentWatermarkMs()) + 1)
        yield pd.DataFrame(rows, columns=[key, "at_us", "allowed"])

    at = events.select(key, F.col(time).cast("timestamp").alias("__t")).where("__t IS NOT NULL").withWatermark("__t", late)
    rows = at.select(key, "__t", F.unix_micros("__t").alias("at_us"))
    return rows.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, at_us bigint, allowed boolean", "kept array<bigint>", "append", GroupStateTimeout.EventTimeTimeout)


def server_events(chunks: DataFrame, key: str, order: str, chunk: str) -> DataFrame:
    """(key, event_no, event, data) of chunks of a text/event-stream, which may break anywhere.

    Chunks of one answer are put together in order; events end with an empty line, fields of one name are joined.
    """
    whole = chunks.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, chunk))), lambda x: x[chunk]), "").alias("t"))
    parts = whole.select(key, F.posexplode(F.filter(F.split(F.regexp_replace("t", "\r\n?", "\n"), "\n\n"), lambda e: F.trim(e) != "")).alias("event_no", "e"))
    fields = F.split("e", "\n")
    take = lambda name: F.array_join(F.transform(F.filter(fields, lambda s: s.startswith(f"{name}:")), lambda s: F.regexp_replace(s, f"^{name}: ?", "")), "\n")
    return parts.select(key, "event_no", F.coalesce(F.nullif(take("event"), F.lit("")), F.lit("message")).alias("event"), take("data").alias("data"))


def not_landed(listed: DataFrame, landed: DataFrame, key: str, since: str | None = None, date: str = "date") -> DataFrame:
    """What an incremental crawl has still to fetch: listed, not landed, not before ``since``; the oldest first."""
    rows = listed if since is None else listed.where(F.col(date) >= since)
    return rows.join(landed.select(key).distinct(), key, "left_anti")


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Runs a stream over all that is there and stops; rows go to Parquet, once each even after a restart."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
