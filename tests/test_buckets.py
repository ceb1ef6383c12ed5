"""The store in buckets against its whole forms."""

import random
from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators import buckets, store


def schema(text):
    return T.StructType.fromDDL(text) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(text)


STORED = "k long, city string, payload string, first_seen timestamp, last_seen timestamp, state string"


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_batches_rewrite_touched_parts_alone(spark, tmp_path):
    path = str(tmp_path / "jobs")
    table = buckets.Table(spark, "jobs_in_parts", path, "k", schema(STORED), parts=50, buckets=4)
    at = lambda d: F.to_timestamp(F.lit(f"2024-01-{d:02} 00:00:00"))
    rnd = random.Random(2)
    whole = spark.createDataFrame([], STORED)
    sizes = [400, 3, 60, 1]
    for day, size in enumerate(sizes, 1):
        rows = [(rnd.randrange(500), i, rnd.choice(["a", None, "b"]), f"p{day}-{i}") for i in range(size)] + [(None, 0, "x", "y")]
        batch = spark.createDataFrame(rows, "k long, turn long, city string, payload string")
        before = files(path)
        touched = buckets.upsert(table, batch, "turn", at(day), ["city"], ["payload"])
        assert touched == sorted({r.p for r in batch.where("k is not null").select(table.part().alias("p")).collect()})
        after = files(path)
        assert {f for f in before if int(f.parts[0].split("=")[1]) not in touched} == {f for f in after if before.get(f) == after[f]}
        whole = spark.createDataFrame(store.upsert(whole, batch, "k", "turn", at(day), ["city"], ["payload"]).drop("change").collect(), STORED)
        assert plain(table.read()) == plain(whole)
    before = files(path)
    assert buckets.upsert(table, batch.limit(0), "turn", at(9), ["city"], ["payload"]) == [] and files(path) == before
    # a session that doesn't know the table finds it in its folder
    spark.sql("drop table jobs_in_parts")
    assert plain(buckets.Table(spark, "jobs_in_parts", path, "k", schema(STORED), parts=50, buckets=4).read()) == plain(whole)


def test_no_exchange_of_what_is_stored(spark, tmp_path):
    table = buckets.Table(spark, "jobs_planned", str(tmp_path / "t"), "k", schema(STORED), parts=50, buckets=4)
    batch = spark.range(400).selectExpr("id as k", "id as turn", "'c' as city", "'p' as payload")
    buckets.upsert(table, batch, "turn", F.current_timestamp(), ["city"], ["payload"])
    few = batch.where("k < 2")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts, rows = buckets.merged(table, few, "turn", F.current_timestamp(), ["city"], ["payload"])
        rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    final = plan.split("Initial Plan")[0]
    scan = final[: final.index("FileScan")]
    assert "SelectedBucketsCount: 4 out of 4" in final and 0 < len(parts) <= 2
    # between the join and the stored rows stands no exchange; the batch has its own
    assert "Exchange" not in scan[scan.index("SortMergeJoin") :] and "Exchange" in final


def test_versions_in_any_order_of_batches(spark, tmp_path):
    rnd = random.Random(11)
    rows = [(rnd.randrange(12), rnd.choice(["", None, "c1", "c2", "c3"]), rnd.choice(["", None, "t1", "t2"]), rnd.choice([None, "10K", "20K"]), rnd.randrange(1000)) for _ in range(240)]
    kind = "k long, jd string, title string, pay string, at long"
    fields = ["title", "pay"]
    want = plain(store.full_versions(spark.createDataFrame(rows, kind), "k", "jd", fields, "at"))
    for n, deal in enumerate((sorted(rows, key=lambda r: r[4]), rows, sorted(rows, key=lambda r: -r[4]))):
        facts = buckets.Table(spark, f"facts_{n}", str(tmp_path / f"f{n}"), "k", schema("k long, jd string, captured long, title struct<v:string,at:long>, pay struct<v:string,at:long>"), parts=8, buckets=2)
        versions = buckets.Table(spark, f"versions_{n}", str(tmp_path / f"v{n}"), "k", schema("k long, jd string, title string, pay string, captured long, version int"), parts=8, buckets=2)
        for i in range(0, len(deal), 80):
            batch = spark.createDataFrame(deal[i : i + 80], kind)
            buckets.add_versions(facts, versions, batch, "jd", fields, "at")
        buckets.add_versions(facts, versions, batch, "jd", fields, "at")  # a batch run twice changes nothing
        assert plain(versions.read()) == want
    touched = buckets.add_versions(facts, versions, batch.where("k = 3"), "jd", fields, "at")
    assert len(touched) == 1
