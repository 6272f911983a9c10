"""Structured Streaming forms: windowed ingest, replacement of whole leaves, and leases that run out."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from sunweave.sources.files import write_facts


def windowed_rollup(stream: DataFrame, delay: str = "10 minutes", width: str = "3 hours", slide: str | None = None) -> DataFrame:
    """Lit and all samples of each edge and window, tumbling or, with a slide, overlapping; the watermark drops later rows."""
    rows = stream.withColumn("datetime", F.col("datetime").cast("timestamp")).withWatermark("datetime", delay)
    out = rows.groupBy(F.window("datetime", width, slide).alias("w"), "edge_id").agg(F.count_if("is_sunlit").alias("sunlit_sum"), F.count("*").alias("sample_count"))
    return out.select(F.col("w.start").alias("window_start"), "edge_id", "sunlit_sum", "sample_count")


def ingest_leaves(stream: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Each micro-batch replaces its leaves, so that a batch that runs again changes nothing.

    Without every, what is there is taken and the query ends; with it, a batch starts at that interval.
    """

    def put(batch: DataFrame, epoch: int) -> None:
        write_facts(batch, path)

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def session_rollup(stream: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """Of each edge the sessions of facts that follow each other within a gap, with lit and all samples."""
    rows = stream.withColumn("datetime", F.col("datetime").cast("timestamp")).withWatermark("datetime", delay)
    out = rows.groupBy(F.session_window("datetime", gap).alias("w"), "edge_id").agg(F.count_if("is_sunlit").alias("sunlit_sum"), F.count("*").alias("sample_count"))
    return out.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "edge_id", "sunlit_sum", "sample_count")


def read_facts_stream(spark: SparkSession, path: str, schema: str, files_a_batch: int = 64) -> DataFrame:
    """A stream of fact files, so many at most in a batch: what arrives faster waits."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


#: A task's state: who holds it until when, and whether it is done.
_LEASE = "worker_id string, until timestamp, state string"


def lease_states(events: DataFrame) -> DataFrame:
    """(task_id, worker_id, event, accepted, state) of each event of a stream of claims, heartbeats and completions.

    events: (task_id long, worker_id string, event string, at timestamp, lease_seconds int). The state of a task is kept
    between batches: a claim holds it where nobody does or the lease is over, a heartbeat of the holder renews the lease, a
    completion of the holder ends it; everything else is answered with false. Events of one batch count in order of time.
    Leases over by the watermark go back to pending without an event.
    """

    def run(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        worker, until, now = state.get if state.exists else (None, None, "pending")
        if state.hasTimedOut:
            state.update((None, None, "pending"))
            yield pd.DataFrame({"task_id": [key[0]], "worker_id": [worker], "event": ["expired"], "accepted": [True], "state": ["pending"]})
            return
        out = []
        for e in sorted((r for b in batches for r in b.itertuples(index=False)), key=lambda r: (r.at, r.event, r.worker_id)):
            over = now == "running" and until < e.at
            if e.event == "claim" and now != "done" and (now == "pending" or over):
                good, worker, until, now = True, e.worker_id, e.at + pd.Timedelta(seconds=int(e.lease_seconds)), "running"
            elif e.event == "heartbeat" and now == "running" and worker == e.worker_id:
                good, until = True, e.at + pd.Timedelta(seconds=int(e.lease_seconds))
            elif e.event == "complete" and now == "running" and worker == e.worker_id:
                good, until, now = True, None, "done"
            else:
                good = False
            out.append((key[0], e.worker_id, e.event, good, now))
        state.update((worker, until, now))
        if now == "running" and until.timestamp() * 1000 > state.getCurrentWatermarkMs():
            state.setTimeoutTimestamp(int(until.timestamp() * 1000))
        yield pd.DataFrame(out, columns=["task_id", "worker_id", "event", "accepted", "state"])

    timed = events.withWatermark("at", "0 seconds")
    return timed.groupBy("task_id").applyInPandasWithState(run, "task_id long, worker_id string, event string, accepted boolean, state string", _LEASE, "append", GroupStateTimeout.EventTimeTimeout)


def latest_state(events: DataFrame) -> DataFrame:
    """The last heartbeat of each task. events: (task_id, worker_id, lease_expires_at), complete output mode."""
    return events.groupBy("task_id").agg(F.max(F.struct("lease_expires_at", "worker_id")).alias("last")).select("task_id", "last.*")
