"""The work queue as immutable snapshots: every transition maps a table of tasks to the next one.

tasks: (task_id, run_id, section_id, sim_date, window_index, shard_index, state, priority, est_raycasts, attempts,
max_attempts, worker_id, lease_expires_at, started_at, finished_at, rows_written, affinity_hit, last_error) and, where a
deployment keeps them, leased_at, heartbeat_at and raycasts_done; a transition leaves out what a table hasn't.
runs: (run_id, max_tasks_per_shard). shards: (shard_index, state).
Reports of workers come as tables of (task_id, worker_id, ...) with one row a task; of each, a transition answers whether
the worker still held the task, and changes nothing where it didn't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sunweave.operators.analytics import percent

LEASE_SECONDS = 120


def admissible_shards(tasks: DataFrame, shards: DataFrame, runs: DataFrame, run: str) -> DataFrame:
    """(shard_index, running, free): online shards that run fewer tasks, of whatever run, than this run allows; none for an unknown run."""
    running = tasks.where("state = 'running'").groupBy("shard_index").agg(F.count("*").alias("n"))
    cap = runs.where(F.col("run_id") == run).select(F.col("max_tasks_per_shard").cast("long").alias("cap"))
    out = shards.where("state = 'online'").select("shard_index").join(F.broadcast(cap)).join(running, "shard_index", "left")
    n = F.coalesce("n", F.lit(0))
    return out.select("shard_index", n.alias("running"), (F.col("cap") - n).alias("free")).where("free > 0")


def claimable(tasks: DataFrame, shards: DataFrame, runs: DataFrame, run: str) -> DataFrame:
    """The run's pending tasks that may start now, all at once: per shard the dearest, as many as it has free slots."""
    w = Window.partitionBy("shard_index").orderBy(F.desc("priority"), F.desc("est_raycasts"), "task_id")
    free = admissible_shards(tasks, shards, runs, run)
    pending = tasks.where((F.col("state") == "pending") & (F.col("run_id") == run)).join(F.broadcast(free), "shard_index")
    return pending.withColumn("slot", F.row_number().over(w)).where("slot <= free").select("shard_index", "slot", "task_id", "priority", "est_raycasts")


def _plus_seconds(now: Column, seconds: int) -> Column:
    return (now + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(seconds))).cast("timestamp")


def _set(tasks: DataFrame, where: Column, changes: dict[str, Column]) -> list[Column]:
    hit = F.coalesce(where, F.lit(False))
    return [F.when(hit, changes[c]).otherwise(F.col(c)).cast(tasks.schema[c].dataType).alias(c) if c in changes else F.col(c) for c in tasks.columns]


def claim(tasks: DataFrame, shards: DataFrame, runs: DataFrame, run: str, worker: str, now: Column, lease_seconds: int = LEASE_SECONDS, section: int | None = None, window: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(tasks, claimed): one task for a worker; the hinted section and window by cost first, else by priority and cost.

    claimed has no row where no admissible shard has a pending task; an unknown run raises. A task that was started before
    keeps its start.
    """
    if runs.where(F.col("run_id") == run).isEmpty():
        raise ValueError(f"run {run} does not exist")
    free = admissible_shards(tasks, shards, runs, run).select("shard_index")
    pending = tasks.where((F.col("state") == "pending") & (F.col("run_id") == run)).join(F.broadcast(free), "shard_index", "left_semi")
    near = (F.col("section_id") == section) & (F.col("window_index") == window) if section is not None and window is not None else F.lit(False)
    order = [F.desc("near"), F.desc(F.when(F.col("near"), F.lit(0)).otherwise(F.col("priority"))), F.desc("est_raycasts"), F.asc("task_id")]
    chosen = pending.withColumn("near", F.coalesce(near, F.lit(False))).orderBy(*order).limit(1).select(F.col("task_id").alias("chosen_id"), F.col("near").alias("hit"))
    pick = tasks.join(F.broadcast(chosen), F.col("task_id") == F.col("chosen_id"), "left")
    mine = F.col("chosen_id").isNotNull()
    started = F.coalesce("started_at", now) if "started_at" in tasks.columns else now
    changes = {"state": F.lit("running"), "worker_id": F.lit(worker), "attempts": F.col("attempts") + 1, "lease_expires_at": _plus_seconds(now, lease_seconds), "leased_at": now, "heartbeat_at": now, "started_at": started, "affinity_hit": F.col("hit")}
    out = pick.select(*_set(tasks, mine, changes), mine.alias("_mine"))
    return out.drop("_mine"), out.where("_mine").drop("_mine")


def _reported(tasks: DataFrame, reports: DataFrame, changes: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(tasks, answers): changes where the reporting worker holds the task; report columns are there as r.name."""
    r = reports.select(F.struct(*reports.columns).alias("r"))
    held = (F.col("r.worker_id") == F.col("worker_id")) & (F.col("state") == "running")
    joined = tasks.join(r, F.col("task_id") == F.col("r.task_id"), "left")
    after = joined.select(*_set(tasks, held, changes))
    holder = tasks.select(F.col("task_id").alias("t_id"), F.col("worker_id").alias("t_worker"), F.col("state").alias("t_state"))
    asked = reports.select("task_id", "worker_id").join(holder, F.col("task_id") == F.col("t_id"), "left")
    ok = F.coalesce((F.col("t_worker") == F.col("worker_id")) & (F.col("t_state") == "running"), F.lit(False))
    return after, asked.select("task_id", "worker_id", ok.alias("ok"))


def heartbeat(tasks: DataFrame, beats: DataFrame, now: Column, lease_seconds: int = LEASE_SECONDS) -> tuple[DataFrame, DataFrame]:
    """beats: (task_id, worker_id, raycasts_done), the last null where it isn't told."""
    changes = {"heartbeat_at": now, "lease_expires_at": _plus_seconds(now, lease_seconds)}
    if "raycasts_done" in tasks.columns:
        changes["raycasts_done"] = F.coalesce("r.raycasts_done", "raycasts_done")
    return _reported(tasks, beats, changes)


def complete(tasks: DataFrame, reports: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """reports: (task_id, worker_id, rows_written, raycasts_done)."""
    changes = {"state": F.lit("done"), "finished_at": now, "rows_written": F.col("r.rows_written"), "last_error": F.lit(None), "lease_expires_at": F.lit(None)}
    if "raycasts_done" in tasks.columns:
        changes["raycasts_done"] = F.coalesce("r.raycasts_done", "raycasts_done")
    return _reported(tasks, reports, changes)


def _next_state() -> Column:
    return F.when(F.col("attempts") >= F.col("max_attempts"), "failed").otherwise("pending")


def fail(tasks: DataFrame, reports: DataFrame, now: Column) -> tuple[DataFrame, DataFrame]:
    """reports: (task_id, worker_id, error). The task goes back, or is failed and finished after its last attempt."""
    final = F.col("attempts") >= F.col("max_attempts")
    changes = {"state": _next_state(), "last_error": F.left("r.error", F.lit(4000)), "worker_id": F.lit(None), "lease_expires_at": F.lit(None), "finished_at": F.when(final, now)}
    return _reported(tasks, reports, changes)


def expired(now: Column, run: str | None = None) -> Column:
    over = (F.col("state") == "running") & (F.col("lease_expires_at") < now)
    return over if run is None else over & (F.col("run_id") == run)


def reap_expired(tasks: DataFrame, now: Column, run: str | None = None) -> DataFrame:
    """Running tasks, of one run or all, whose lease is over go back, or fail after their last attempt."""
    beat = F.date_format("heartbeat_at", "yyyy-MM-dd HH:mm:ss") if "heartbeat_at" in tasks.columns else F.lit(None)
    error = F.concat(F.lit("lease expired (last heartbeat "), F.coalesce(beat, F.lit("never")), F.lit(", worker "), F.coalesce("worker_id", F.lit("unknown")), F.lit(")"))
    return tasks.select(*_set(tasks, expired(now, run), {"state": _next_state(), "last_error": error, "worker_id": F.lit(None), "lease_expires_at": F.lit(None)}))


def insert_tasks(tasks: DataFrame, new: DataFrame) -> DataFrame:
    """tasks and those of new whose (run, section, date, window) it hasn't yet."""
    return tasks.unionByName(new.join(tasks, ["run_id", "section_id", "sim_date", "window_index"], "left_anti"))


# --- reports --------------------------------------------------------------------------------------------------------------


def run_progress(tasks: DataFrame) -> DataFrame:
    """Counts by state, work done and planned, mean seconds of done tasks and the share of them that hit their affinity."""
    is_done = F.col("state") == "done"
    states = [F.count_if(F.col("state") == s).alias(s) for s in ("pending", "running", "done", "failed")]
    seconds = (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1_000_000
    out = tasks.groupBy("run_id").agg(
        F.count("*").alias("total"), *states,
        F.count_distinct(F.when(F.col("state") == "running", F.col("worker_id"))).alias("active_workers"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"),
        F.coalesce(F.sum(F.when(is_done, F.col("est_raycasts"))), F.lit(0)).alias("raycasts_done"),
        F.sum("est_raycasts").alias("raycasts_total"),
        F.round(F.avg(F.when(is_done, seconds)), 2).alias("avg_task_seconds"),
        F.count_if(is_done & F.col("affinity_hit")).alias("hits"),
    )
    return out.withColumns({"pct_done": percent(F.col("done"), F.col("total")), "pct_affinity_hit": percent(F.col("hits"), F.col("done"), 1)}).drop("hits")


def shard_progress(tasks: DataFrame, shards: DataFrame, runs: DataFrame) -> DataFrame:
    """Of each run and shard the counts by state, the shard's own state and the run's cap."""
    states = [F.count_if(F.col("state") == s).alias(s) for s in ("running", "done", "pending", "failed")]
    out = tasks.groupBy("run_id", "shard_index").agg(F.count("*").alias("total"), *states, F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows_written"))
    out = out.join(runs.select("run_id", F.col("max_tasks_per_shard").alias("admission_cap")), "run_id")
    out = out.join(shards.select("shard_index", F.col("state").alias("shard_state")), "shard_index", "left")
    return out.withColumn("pct_done", percent(F.col("done"), F.col("total"), 1))


def run_gaps(tasks: DataFrame) -> DataFrame:
    """Tasks that keep a run from being whole."""
    return tasks.where("state <> 'done'").select("run_id", "task_id", "section_id", "state", "attempts")


def complete_or_outstanding(tasks: DataFrame, run: str, most: int = 20) -> tuple[bool, DataFrame]:
    """(whether all tasks of the run are done and there are any, a top-k report of the outstanding ones)."""
    own = tasks.where(F.col("run_id") == run)
    n = own.agg(F.count("*").alias("all"), F.count_if(F.col("state") == "done").alias("done")).first()
    return n["all"] > 0 and n["all"] == n["done"], outstanding(own, most)


def outstanding(tasks: DataFrame, most: int = 20) -> DataFrame:
    out = tasks.where("state <> 'done'").withColumn("error", F.left(F.coalesce("last_error", F.lit("")), F.lit(70)))
    return out.orderBy("state", "shard_index", "sim_date", "section_id", "task_id").limit(most).select("task_id", "shard_index", "section_id", "window_index", "state", "attempts", "error")


def oldest_running(tasks: DataFrame, most: int = 12) -> DataFrame:
    """A top-k report of the running tasks that started first."""
    return tasks.where("state = 'running'").orderBy(F.col("started_at").asc_nulls_last(), "task_id").limit(most).select("task_id", "worker_id", "section_id", "window_index", "attempts", "started_at")


def recent_failures(tasks: DataFrame, most: int = 8) -> DataFrame:
    """A top-k report of the failed tasks, the last finished first."""
    return tasks.where("state = 'failed'").orderBy(F.col("finished_at").desc_nulls_last(), "task_id").limit(most).select("task_id", "section_id", "attempts", F.left("last_error", F.lit(70)).alias("error"))


def dearest(tasks: DataFrame, most: int = 5) -> DataFrame:
    """A top-k report of the tasks that cost most."""
    return tasks.orderBy(F.desc("est_raycasts"), "task_id").limit(most).select("task_id", "section_id", "window_index", "est_raycasts")


def cost_spread(tasks: DataFrame) -> DataFrame:
    """(least, greatest, spread): how many times the cheapest task the dearest costs."""
    e = F.col("est_raycasts")
    return tasks.agg(F.min(e).alias("least"), F.max(e).alias("greatest"), F.round(F.max(e) / F.nullif(F.min(e), F.lit(0)), 2).alias("spread"))


def throughput(tasks: DataFrame) -> DataFrame:
    """Per run, over its done tasks: first start, last finish, wall seconds, workers, rows and raycasts a second.

    Runs without a done task, or whose tasks took no time, have no row.
    """
    out = tasks.where("state = 'done'").groupBy("run_id").agg(
        F.min("started_at").alias("first_start"), F.max("finished_at").alias("last_finish"), F.count_distinct("worker_id").alias("workers"),
        F.coalesce(F.sum("rows_written"), F.lit(0)).alias("rows"), F.coalesce(F.sum("est_raycasts"), F.lit(0)).alias("raycasts"),
    )
    wall = (F.unix_micros(F.col("last_finish").cast("timestamp")) - F.unix_micros(F.col("first_start").cast("timestamp"))) / 1_000_000
    out = out.withColumn("wall_seconds", wall).where("wall_seconds > 0")
    rate = F.col("rows") / F.col("wall_seconds")
    return out.withColumns({"rows_per_second": F.round(rate, 3), "rows_per_worker": F.round(rate / F.greatest(F.lit(1), F.col("workers")), 3), "raycasts_per_second": F.round(F.col("raycasts") / F.col("wall_seconds"), 3), "raycast_pct": percent(F.col("raycasts"), F.greatest(F.lit(1), F.col("rows")), 1)})


# --- registry of shards -------------------------------------------------------------------------------------------------


def register_shards(shards: DataFrame, new: DataFrame, now: Column) -> DataFrame:
    """Adds or renews shards: (shard_index, host, port, dbname, state, vcpu, ram_gb, last_seen_at), new without the last and the state.

    A known shard keeps its state, and its size where none is told; a new one is online, its database named by its index.
    """
    n = new.select(F.struct(*new.columns).alias("n"), F.col("shard_index").alias("n_index"))
    j = shards.join(n, F.col("shard_index") == F.col("n_index"), "full")
    told = F.col("n_index").isNotNull()
    name = F.coalesce("n.dbname", F.concat(F.lit("shard_"), F.col("n_index").cast("string")))
    keep = lambda c: F.coalesce(f"n.{c}", c)
    values = {
        "shard_index": F.coalesce("shard_index", "n_index"), "host": F.when(told, F.col("n.host")).otherwise(F.col("host")),
        "port": F.when(told, F.coalesce("n.port", F.lit(5432))).otherwise(F.col("port")), "dbname": F.when(told, name).otherwise(F.col("dbname")),
        "state": F.coalesce("state", F.lit("online")), "vcpu": keep("vcpu"), "ram_gb": keep("ram_gb"), "last_seen_at": F.when(told, now).otherwise(F.col("last_seen_at")),
    }
    return j.select(*[values[c].cast(shards.schema[c].dataType).alias(c) if c in values else F.col(c) for c in shards.columns])


def set_shard_state(shards: DataFrame, shard: int, state: str) -> DataFrame:
    """online, draining (takes no new task) or offline."""
    if state not in ("online", "draining", "offline"):
        raise ValueError(f"no such state: {state}")
    return shards.select(*_set(shards, F.col("shard_index") == shard, {"state": F.lit(state)}))
