"""Stateful streams against their batch forms."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from sievework.operators import rollups
from sievework.streaming import jobs

START = datetime(2024, 1, 1)


@pytest.fixture
def run(spark, tmp_path):
    """Runs a job over batches of rows, one file each, and returns the rows that it gives."""
    count = iter(range(100))

    def go(job, batches, schema):
        n = next(count)
        src = tmp_path / f"in{n}"
        src.mkdir()
        for i, rows in enumerate(batches):
            (src / f"{i:03}.json").write_text("\n".join(json.dumps(r, default=str) for r in rows))
            os.utime(src / f"{i:03}.json", (1_700_000_000 + i,) * 2)  # files are taken in the order of their times
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", False).json(str(src))
        name = f"out{n}_{tmp_path.name.replace('-', '_')}"
        job(stream).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / f"cp{n}")).trigger(availableNow=True).start().awaitTermination(300)
        return spark.table(name).collect()

    return go


EVENTS = "event_id long, ts timestamp, user_id long, event_type string"


def some_events(n, seed, minutes):
    rnd, at, out = random.Random(seed), START, []
    for i in range(n):
        at += timedelta(seconds=rnd.randint(1, int(60 * minutes)))
        out.append({"event_id": i, "ts": at.isoformat(), "user_id": rnd.choice([*range(12), None]), "event_type": rnd.choice(["error", "ok", "error"])})
    return out


def dealt(rows, parts, seed=1):
    """Batches in the order of time, rows of a batch in any."""
    rnd = random.Random(seed)
    size = -(-len(rows) // parts)
    return [rnd.sample(b, len(b)) for b in (rows[i : i + size] for i in range(0, len(rows), size))]


FAR = {"event_id": 10**6, "ts": "2025-06-01T00:00:00", "user_id": 999, "event_type": "ok"}


@pytest.mark.parametrize("limit", [3, 0])
def test_budget(spark, run, limit):
    rows = some_events(160, 1, 25)
    got = {r.id: r.outcome for r in run(lambda s: jobs.budget(s, "user_id", limit), [*dealt(rows, 3), [FAR], [FAR | {"event_id": 10**6 + 1, "ts": "2026-01-01T00:00:00"}]], EVENTS)}
    df = spark.createDataFrame([(r["event_id"], datetime.fromisoformat(r["ts"]), r["user_id"]) for r in rows if r["user_id"] is not None], "event_id long, ts timestamp, user_id long")
    known = {r.event_id: r.outcome for r in rollups.daily_budget(df, "user_id", "ts", "event_id", limit).collect()}
    assert {k: got[k] for k in known} == known if limit == 0 else True
    # with a limit, the null key is a key as well
    own = {}
    for day in sorted({r["ts"][:10] for r in rows}):
        used = {}
        for r in sorted((r for r in rows if r["ts"][:10] == day), key=lambda r: (r["ts"], r["event_id"])):
            k = r["user_id"]
            if k in used:
                own[r["event_id"]] = "duplicate"
            elif limit and len(used) >= limit:
                own[r["event_id"]] = "exhausted"
            else:
                used[k] = own[r["event_id"]] = "ok"
    assert {k: v for k, v in got.items() if k < 10**6} == own


def test_ledger(spark, run):
    rnd, rows = random.Random(7), []
    for key in range(20):
        at = 0
        for _ in range(rnd.randint(1, 25)):
            at += rnd.choice([1, 60, 1_000, 3_000, 86_400, 20 * 86_400, 31 * 86_400])
            rows.append({"key": key, "at": at, "kind": rnd.choice(["failure", "probe", "probe", "probe"]), "run": f"r{rnd.randint(0, 9)}", "nature": rnd.choice(["structural", "structural", "transient"])})
    rows.sort(key=lambda r: r["at"])
    last = rows[-1]["at"] + 10 * 86_400
    batches = dealt(rows, 4) + [[{"key": 99, "at": last, "kind": "probe", "run": "r", "nature": "transient"}]] * 2
    stamp = lambda s: jobs.ledger(s.withColumn("at", F.timestamp_seconds("at")))
    got = {}
    for r in run(stamp, batches, "key long, at long, kind string, run string, nature string"):
        if int(r.key) not in got or (r.at, r.skipped + r.fetched, not r.open) >= got[int(r.key)][0]:
            got[int(r.key)] = ((r.at, r.skipped + r.fetched, not r.open), tuple(r)[2:])
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "key long, at long, kind string, run string, nature string")
    fields = ("open", "nature", "hits", "skip_runs", "skipped", "fetched")
    want = {r.key: tuple(r[c] for c in fields) for r in rollups.fold_ledger(df, last - 86_400).collect()}
    assert {k: v[1] for k, v in got.items() if k != 99} == want


def test_alarms(spark, run):
    rows = some_events(300, 3, 2)
    events = lambda s: jobs.failure_alarms(s, 0.6, 2, window="120 seconds", late="1 minute")
    got = {r.start: (r.total, r.failed, r.rate, r.alarm) for r in run(events, [*dealt(rows, 4), [FAR], [FAR]], EVENTS)}
    df = spark.createDataFrame([(datetime.fromisoformat(r["ts"]), r["event_type"]) for r in rows], "ts timestamp, event_type string")
    want = {r.start: (r.total, r.failed, r.rate, r.alarm) for r in rollups.failure_windows(df, "ts", F.col("event_type") == "error", 120, 0.6, 2).collect()}
    assert got == want and 0 < sum(x[3] for x in want.values()) < len(want)


def test_bursts(spark, run):
    rows = some_events(200, 4, 3)
    rows += [rows[-1] | {"event_id": 500}, rows[-1] | {"event_id": 501}]  # peers of an instant
    got = {r.id: (r.recent, r.blocked) for r in run(lambda s: jobs.bursts(s, "user_id", 900, 4), [*dealt(rows[:-2], 3)[:2], rows[134:]], EVENTS)}
    df = spark.createDataFrame([(r["event_id"], datetime.fromisoformat(r["ts"]), r["user_id"]) for r in rows], "event_id long, ts timestamp, user_id long")
    want = {r.event_id: (r.recent, r.blocked) for r in rollups.burst(df, "user_id", "ts", 900, 4).collect()}
    assert got == want and any(b for _, b in want.values())


def test_progressive_upsert_reads_its_own_batch_alone(spark, tmp_path):
    """Batches add new keys only, whatever stands there already; one that runs again changes nothing."""
    src, out = tmp_path / "in", str(tmp_path / "t")
    src.mkdir()
    schema = "ts timestamp, user_id long, event_type string, n decimal(20,3)"
    rnd = random.Random(5)
    rows = [{"ts": (START + timedelta(minutes=i)).isoformat(), "user_id": rnd.choice([*range(40), None]), "event_type": rnd.choice(["a", "b", " "]), "n": "12345678901234567.125"} for i in range(200)]
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))
    run = lambda: jobs.progressive_upsert(stream(), out, "user_id", "ts", ["event_type"], str(tmp_path / "cp")).awaitTermination(300)
    for i in range(4):
        (src / f"{i}.json").write_text("\n".join(map(json.dumps, rows[50 * i : 50 * i + 50])))
        run()
    first = {}
    for r in rows:
        if r["user_id"] is not None and r["event_type"].strip():
            first.setdefault(r["user_id"], r)
    table = jobs.flushed(spark, f"{out}/table").collect()
    assert {r.user_id: (r.ts.isoformat(), r.event_type, str(r.n)) for r in table} == {k: (r["ts"], r["event_type"], r["n"]) for k, r in first.items()} and len(table) == len(first)
    counts = spark.read.option("basePath", f"{out}/counters").parquet(f"{out}/counters/batch=*").orderBy("batch").collect()
    assert [sum(c) for c in zip(*[(c.new, c.duplicate, c.quarantine) for c in counts], strict=True)] == [len(first), 200 - len(first) - sum(r["user_id"] is None or not r["event_type"].strip() for r in rows), sum(r["user_id"] is None or not r["event_type"].strip() for r in rows)]
    # the last batch's commit is lost: it runs again, from the state before it
    last = max(int(p.name) for p in (tmp_path / "cp/commits").glob("[0-9]*"))
    for p in (tmp_path / "cp/commits").glob(f"*{last}*"):
        p.unlink()
    run()
    assert sorted(map(tuple, jobs.flushed(spark, f"{out}/table").collect())) == sorted(map(tuple, table))
