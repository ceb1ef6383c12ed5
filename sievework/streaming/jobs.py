"""Structured Streaming jobs: progressive upserts, budgets, ledgers, failure windows and their alarms, bursts, versions.

Each equals its batch form in `operators` as long as events come in the order of their times, within a batch in any.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sievework.operators import rollups
from sievework.streaming import processors


def failure_rates(events: DataFrame, at: str = "ts", kind: str = "event_type", late: str = "10 minutes", window: str = "60 seconds") -> DataFrame:
    """start, total, failed, rate by tumbling window; a window closes when the watermark passes it."""
    w = events.withWatermark(at, late).groupBy(F.window(at, window).alias("w")).agg(F.count("*").alias("total"), F.count_if(F.col(kind) == "error").alias("failed"))
    return w.select(F.col("w.start").alias("start"), "total", "failed", (F.col("failed") / F.col("total")).alias("rate"))


def sessions(events: DataFrame, key: str = "user_id", at: str = "ts", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """key, start, stop, events by session of activity."""
    w = events.withWatermark(at, late).groupBy(key, F.session_window(at, gap).alias("w")).agg(F.count("*").alias("events"))
    return w.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "events")


def health(log: DataFrame, at: str, failed: Column, late: str = "1 day") -> DataFrame:
    """day, runs, failed of a log that grows; a day is final when the watermark passes it."""
    w = log.withWatermark(at, late).groupBy(F.window(at, "1 day").alias("w")).agg(F.count("*").alias("runs"), F.count_if(failed).alias("failed"))
    return w.select(F.to_date("w.start").alias("day"), "runs", "failed")


def new_versions(observed: DataFrame, key: str, content: str, at: str, late: str = "1 day") -> DataFrame:
    """The first sight of each content of a key; later ones within the watermark are no new versions."""
    return observed.withWatermark(at, late).dropDuplicatesWithinWatermark([key, content])


#: Parts that a day's first uses are counted in before they meet in one counter.
BUDGET_PARTS = 32


def _stateful(df: DataFrame, by: list[str], processor, schema: str, at: str | None = None) -> DataFrame:
    """``df`` grouped and run through a processor with timers in event time. Such processors need the RocksDB state store, which is set for the session."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return df.groupBy(*by).transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="EventTime", eventTimeColumnName=at or "")


def budget(events: DataFrame, key: str, limit: int, at: str = "ts", order: str = "event_id", late: str = "1 day") -> DataFrame:
    """day, key, at, id, outcome by event: ok for the first uses of different keys on a day up to the limit, duplicate for a key's later ones, exhausted beyond; a limit of 0 is none.

    A (day, key) has a state of its own, which passes its first use on; a part of a day passes its first ``limit`` of
    these on; and a day counts them, so that no group holds a day's events and none gets more than ``BUDGET_PARTS`` x
    ``limit`` rows a day. Events then meet their key's decision. State goes when the watermark is a day behind.
    """
    base = events.withWatermark(at, late).select(F.to_date(at).cast("string").alias("day"), F.col(key).cast("string").alias("key"), F.col(at).alias("at"), F.col(order).cast("long").alias("id"))
    columns = "day string, key string, at timestamp, id long"
    first = _stateful(base, ["day", "key"], processors.FirstUse(), columns, "at")
    if limit > 0:
        part = first.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(BUDGET_PARTS)))
        some = _stateful(part, ["day", "part"], processors.FirstOnes(limit, False), columns + ", ok boolean", "at")
        counted = _stateful(some.where("ok"), ["day"], processors.FirstOnes(limit, True), columns + ", ok boolean", "at")
        first = counted.where("ok")
    known = first.select(F.col("day").alias("_day"), F.col("key").alias("_key"), F.col("at").alias("_at"), F.col("id").alias("_id"))
    near = F.expr("_at between at - interval 1 day and at + interval 1 day")
    # a refused key has no decision: it never will, as a day's counter doesn't go back
    both = base.join(known, (F.col("day") == F.col("_day")) & F.col("key").eqNullSafe(F.col("_key")) & near, "leftOuter")
    outcome = F.when(F.col("_id").isNull(), "exhausted").when(F.struct("at", "id") == F.struct("_at", "_id"), "ok").otherwise("duplicate")
    return both.select("day", "key", "at", "id", outcome.alias("outcome"))


def ledger(events: DataFrame, late: str = "1 day") -> DataFrame:
    """key, at, open, nature, hits, skip_runs, skipped, fetched: the ledger of known failures as its events (key, at as timestamp, kind, run, nature) come in, a row for each key that a batch or a timer changes.

    A key's last row equals ``rollups.fold_ledger`` over its events so far. An entry whose life ends before the watermark
    closes by itself, as ``fold_ledger`` has it for that time.
    """
    rows = events.withWatermark("at", late).select(F.col("key").cast("string").alias("key"), "at", "kind", "run", "nature")
    return _stateful(rows, ["key"], processors.Ledger(rollups.SKIP_RUNS, rollups.STRUCTURAL_TTL, rollups.TRANSIENT_TTL), "key string, at long, open boolean, nature string, hits long, skip_runs long, skipped long, fetched long")


def failure_alarms(events: DataFrame, share: float, run: int, at: str = "ts", kind: str = "event_type", late: str = "10 minutes", window: str = "60 seconds") -> DataFrame:
    """start, total, failed, rate, alarm by closed window: ``failure_rates``, and whether it is the last of ``run`` windows of its day in a row that exceed the share.

    A second operator keeps the length of the run at hand for each day; it gets a row a window.
    """
    w = events.withWatermark(at, late).groupBy(F.window(at, window).alias("w")).agg(F.count("*").alias("total"), F.count_if(F.col(kind) == "error").alias("failed"))
    closed = w.select(F.to_date("w.start").cast("string").alias("day"), F.col("w.start").alias("start"), "total", "failed", (F.col("failed") / F.col("total")).alias("rate"))
    return _stateful(closed, ["day"], processors.Runs(share, run), "start timestamp, total long, failed long, rate double, alarm boolean")


def bursts(events: DataFrame, key: str, seconds: int, limit: int, at: str = "ts", order: str = "event_id", late: str = "10 minutes") -> DataFrame:
    """key, at, id, recent, blocked by event: a key's events within the last seconds, this one included; blocked where they reach the limit. A key's state holds the times of these seconds alone."""
    rows = events.withWatermark(at, late).select(F.col(key).cast("string").alias("key"), F.col(at).alias("at"), F.col(order).cast("long").alias("id"))
    return _stateful(rows, ["key"], processors.Recent(seconds, limit), "key string, at timestamp, id long, recent long, blocked boolean")


def flushed(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """The table that ``progressive_upsert`` has written so far, or before a batch."""
    rows = spark.read.option("basePath", path).parquet(f"{path}/batch=*")
    return rows if before is None else rows.where(F.col("batch") < before)


def progressive_upsert(batches: DataFrame, path: str, key: str, order: str, required: list[str], checkpoint: str) -> StreamingQuery:
    """A keyed table that grows batch by batch; the first row of a key stays, so a batch adds its new keys only and rewrites nothing.

    ``path``/table has the rows, ``path``/quarantine rows with their reason (invalid_key, missing:fields),
    ``path``/counters new, duplicate and quarantine of each batch. Which keys are known is in the state store, by key, so
    a batch reads its own rows and nothing of what earlier ones have written. A batch that runs again finds the state of
    before and writes the same.
    """
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    lacks = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in required]))
    reason = F.when(blank, "invalid_key").when(F.size(lacks) > 0, F.concat(F.lit("missing:"), F.array_join(lacks, ",")))
    # rows go through the processor as JSON, so that no type changes on its way
    packed = batches.select(F.col(key).cast("string").alias("key"), reason.alias("reason"), F.col(order).cast("string").alias("order"), F.to_json(F.struct("*")).alias("row"))
    good = _untimed(packed.where("reason is null").select("key", "order", "row"), processors.NewKey(), "row string, rows long")
    bad = packed.where("reason is not null")
    tagged = good.select(F.lit(None).cast("string").alias("reason"), "row", "rows").union(bad.select("reason", "row", F.lit(1).cast("long").alias("rows")))
    values = F.from_json("row", batches.schema).alias("r")

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            into = lambda what: f"{path}/{what}/batch={number}"
            batch.where("reason is not null").select(values, "reason").select("r.*", "reason").write.mode("overwrite").parquet(into("quarantine"))
            batch.where("reason is null and row is not null").select(values).select("r.*").write.mode("overwrite").parquet(into("table"))
            new, kept = F.col("reason").isNull() & F.col("row").isNotNull(), F.when(F.col("reason").isNull(), F.col("rows")).otherwise(0)
            counters = batch.agg(F.count_if(new).alias("new"), F.coalesce(F.sum(kept), F.lit(0)).alias("_good"), F.count_if(F.col("reason").isNotNull()).alias("quarantine"))
            counters.select("new", (F.col("_good") - F.col("new")).alias("duplicate"), "quarantine").write.mode("overwrite").parquet(into("counters"))
        finally:
            batch.unpersist()

    return tagged.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _untimed(df: DataFrame, processor, schema: str) -> DataFrame:
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return df.groupBy("key").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None")
