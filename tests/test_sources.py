import json
import random

import pytest
from pyspark.sql import functions as F

from sievework.functions import records
from sievework.operators import rollups, store
from sievework.plans import ask, deliverable
from sievework.sources import files
from sievework.streaming import jobs


def record(i, **more):
    base = {"job_id": f"j{i}", "title": "AI产品经理", "salary": "20-40K·15薪", "location": "杭州·余杭区", "company_name": f"公司{i}", "jd": f"负责大模型产品{i}" * 20, "skills": ["SQL"], "job_link": f"/{i}", "experience": "1-3年"}
    return base | more


def test_exports_in_both_shapes_and_bad_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"keyword": "x", "jobs": [record(1), record(2)]}, ensure_ascii=False))
    (tmp_path / "b.json").write_text(json.dumps([record(3, extra=1)], ensure_ascii=False))
    (tmp_path / "c.json").write_text("{broken")
    got = files.read_exports(spark, str(tmp_path)).orderBy("job_id").collect()
    assert [(r.job_id, r.skills) for r in got] == [("j1", ["SQL"]), ("j2", ["SQL"]), ("j3", ["SQL"])]


def test_raw_lists_in_three_shapes(spark, tmp_path):
    item = {"encryptJobId": "e1", "jobName": "产品", "cityName": "杭州", "areaDistrict": "", "businessDistrict": "仓前", "jobExperience": "经验不限", "jobDegree": "本科", "skills": ["a"], "bossOnline": True}
    page = {"zpData": {"jobList": [item]}}
    for name, doc in {"one": page, "pages": {"list_pages": [{"page": 1, "response": page}, {"page": 2, "response": {"zpData": {}}}]}, "bare": [item]}.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(doc, ensure_ascii=False))
    got = files.item_to_record(files.read_raw_lists(spark, str(tmp_path))).collect()
    assert {r.boss_active_status for r in got} == {"在线"} and {r.link_verified_at for r in got} == {""}
    assert len(got) == 3 and {(r.location, r.tags, r.title) for r in got} == {("杭州·仓前", "本科", "产品")}


def test_log_skips_bad_lines(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"run_id": "a", "ok": 1}\nnot json\n{"run_id": "b", "ok": 2}\n')
    rows, bad = files.read_log(spark, str(tmp_path / "log.jsonl"), "run_id string, ok int")
    assert rows.count() == 2 and [r.line for r in bad.collect()] == ["not json"]


def test_csv_and_schema_growth(spark, tmp_path):
    df = spark.createDataFrame([("a", ["x", "y"])], "id string, tags array<string>")
    files.write_records(df, str(tmp_path / "csv"), "csv")
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().tags == "x | y"
    grown = files.with_schema_of(df, spark.createDataFrame([], "id string, tags array<string>, city string").schema)
    assert grown.first().city is None
    assert files.inventory(spark, str(tmp_path)).where("kind = 'csv' and name like 'part%'").count() >= 1


def test_deliverable_and_questions(spark, tmp_path):
    rows = [record(1), record(2, title="大客户销售"), record(3, jd=""), record(4, jd=record(1)["jd"], company_name="公司9"), record(5, title="产品经理", jd="兼职")]
    (tmp_path / "list.json").write_text(json.dumps({"jobs": rows}, ensure_ascii=False))
    (tmp_path / "details.json").write_text(json.dumps([record(3, jd="负责AI产品" * 10)], ensure_ascii=False))
    listed, details = files.read_exports(spark, str(tmp_path / "list.json")), files.read_details(spark, str(tmp_path / "details.json"))
    d = deliverable.build(listed, details)
    kept = {r.job_id: r for r in d.kept.collect()}
    assert set(kept) == {"j1", "j3", "j4"}
    assert {r.job_id: r.reason for r in d.dropped.collect()} == {"j2": "sales", "j5": "mismatch"}
    assert kept["j1"].dup_group == kept["j4"].dup_group != "" and kept["j1"].is_primary and not kept["j4"].is_primary
    assert (kept["j1"].salary_min, kept["j1"].salary_max, kept["j1"].salary_months) == (20000.0, 40000.0, 15)
    before = deliverable.build(listed.where("job_id <> 'j1'"), details)
    dropped = spark.createDataFrame([("j2", "x", "y", "sales"), ("j1", "x", "y", "sales"), ("j5", "x", "y", "first"), (" ", "x", "y", "blank")], "job_id string, title string, company_name string, reason string")
    past = deliverable.Deliverable(d.kept, dropped, dropped.select("job_id", "title").where("job_id = 'j1'"))
    without = deliverable.build(listed, details, exclude=spark.createDataFrame([(" j2 ",), ("j3",), ("",)], "job_id string"), before=past)
    # j2 takes no part but is remembered, j5 keeps its first reason, and j1 is kept by now
    assert {r.job_id: r.reason for r in without.dropped.collect()} == {"j2": "sales", "j5": "first"} and without.bodyless.count() == 0
    items, deliverables = deliverable.registered([("/out/old", "杭州|AI", "2024-01-01", before), ("/out/new", "杭州|AI", "2024-01-02", d)])
    diff = {r.job_id: (r.change, r.reason) for r in ask.ask("diff", items=items, deliverables=deliverables, scope="ai").collect()}
    assert diff == {"j1": ("added", "new")}
    asked = listed.select("job_id").union(spark.createDataFrame([("j9",), ("j8",)], "job_id string"))
    why = {r.job_id: (r.answer, r.reason) for r in ask.ask("why", asked=asked, items=items, deliverables=deliverables, excluded=listed.where("job_id = 'j2'"), store=spark.createDataFrame([("j8",)], "job_id string")).collect()}
    assert why["j2"] == ("dropped", "sales") and why["j1"] == ("kept", "") and why["j8"][0] == "store_only" and why["j9"][0] == "unknown"
    with pytest.raises(ValueError):
        ask.ask("weather")
    stamp = deliverable.lineage(d, {"scope_key": "杭州|AI", "city": "杭州"}).first()
    assert (stamp.city, stamp.kept, stamp.dropped, stamp.no_body) == ("杭州", 3, 2, 0)
    market = deliverable.market_summary(d)
    assert market["top_pay"].first().high == 40.0 and market["input"].first().share == 0.6 and market["top"].where("dimension = 'skill'").first().value == "SQL"


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.json").write_text("\n".join(json.dumps({"ts": f"2024-01-01T00:{m:02d}:00", "user_id": m % 3, "event_type": "error" if m % 2 else "ok"}) for m in range(6)))
    schema = "ts timestamp, user_id long, event_type string"
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(src))

    def result(df, name, mode):
        df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"cp-{name}")).trigger(availableNow=True).start().awaitTermination(120)
        return spark.table(name).collect()

    rates = result(jobs.failure_rates(stream(), window="2 minutes"), "rates", "complete")
    assert len(rates) == 3 and all(r.rate == 0.5 for r in rates)
    up = lambda: jobs.progressive_upsert(stream(), str(tmp_path / "t"), "user_id", "ts", ["event_type"], str(tmp_path / "cp-up")).awaitTermination(120)
    up()
    (src / "b.json").write_text("\n".join(json.dumps(r) for r in ({"ts": "2024-01-02T00:00:00", "user_id": 1, "event_type": "late"}, {"ts": "2024-01-02T00:00:00", "user_id": 7, "event_type": "ok"}, {"ts": "2024-01-02T00:00:00", "event_type": "ok"}, {"ts": "2024-01-02T00:00:00", "user_id": 8, "event_type": " "})))
    up()
    table = {r.user_id: r.event_type for r in jobs.flushed(spark, str(tmp_path / "t/table")).collect()}
    assert table == {0: "ok", 1: "error", 2: "ok", 7: "ok"}
    counts = spark.read.parquet(str(tmp_path / "t/counters")).orderBy("batch").collect()
    assert [(r.new, r.duplicate, r.quarantine) for r in counts] == [(3, 3, 0), (1, 1, 2)]
    assert {r.reason for r in spark.read.parquet(str(tmp_path / "t/quarantine")).collect()} == {"invalid_key", "missing:event_type"}


def test_ledger_of_failures_matches_a_plain_fold(spark):
    """Entries open, renew, change their nature, expire and are used up as a loop over each key's events has it."""
    rnd = random.Random(7)
    events = []
    for key in range(60):
        at = 0
        for _ in range(rnd.randint(1, 40)):
            at += rnd.choice([1, 60, 1_000, 3_000, 86_400, 20 * 86_400, 31 * 86_400])
            events.append((key, at, f"r{rnd.randint(0, 9)}", rnd.choice(["structural", "structural", "transient"]), rnd.choice(["failure", "probe", "probe", "probe"])))

    def plain(rows):
        entry, skipped, fetched = None, 0, 0
        for at, kind, run, nature in sorted((r[1], r[4], r[2], r[3]) for r in rows):
            if kind == "failure":
                if entry and at >= entry["until"]:
                    entry = None
                entry = entry or {"nature": nature, "hits": 0, "runs": 0, "last": None}
                if entry["nature"] != nature:
                    entry |= {"nature": nature, "runs": 0, "last": None}
                entry["hits"] += 1
                entry |= {"run": run, "until": at + (rollups.STRUCTURAL_TTL if nature == "structural" else rollups.TRANSIENT_TTL)}
                continue
            fresh = entry is not None and at < entry["until"]
            if fresh and (entry["runs"] < rollups.SKIP_RUNS if entry["nature"] == "structural" else entry["run"] == run):
                skipped += 1
                entry["runs"] += entry["last"] != run
                entry["last"] = run
            else:
                fetched += 1
                if entry and (not fresh or entry["nature"] == "structural"):
                    entry = None
        return (entry is not None, entry["nature"] if entry else "", entry["hits"] if entry else 0, entry["runs"] if entry else 0, skipped, fetched)

    df = spark.createDataFrame(events, "key long, at long, run string, nature string, kind string").repartition(5)
    got = {r.key: tuple(r)[1:] for r in rollups.fold_ledger(df).collect()}
    assert got == {k: plain([e for e in events if e[0] == k]) for k in range(60)}
    assert any(v[0] for v in got.values()) and any(v[4] for v in got.values())


def test_bad_files_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"jobs": [record(1)]}, ensure_ascii=False))
    (tmp_path / "b.json").write_text("{broken")
    (tmp_path / "c.json").write_text(" \n")
    (tmp_path / "d.json").write_text('{"other": 1}')
    good, bad = files.split_files(spark, str(tmp_path))
    assert [r.job_id for r in good.collect()] == ["j1"]
    assert {r.path.rsplit("/", 1)[-1]: r.reason for r in bad.collect()} == {"b.json": "not_json", "c.json": "empty", "d.json": "no_records"}


def test_stores_newer_than_the_code_are_refused(spark):
    meta = spark.createDataFrame([("schema_version", "3"), ("other", "x")], "key string, value string")
    assert store.schema_of_version(meta, 3).first().version == 3 and store.schema_of_version(meta.limit(0), 3).first().version == 0
    with pytest.raises(Exception, match="newer"):
        store.schema_of_version(meta, 2).collect()


def test_upserts_take_incoming_values_and_keep_where_nothing_came(spark):
    old = spark.createDataFrame([("a", "杭州", "p0", "closed"), ("b", "北京", "p0", "active")], "k string, city string, payload string, state string").withColumns({"first_seen": F.lit("t0"), "last_seen": F.lit("t0")})
    new = spark.createDataFrame([("a", 1, "上海", "p1"), ("a", 2, None, "p2"), ("c", 1, None, "p3"), (None, 1, "x", "y")], "k string, turn int, city string, payload string")
    got = {r.k: (r.city, r.payload, r.state, r.first_seen, r.last_seen, r.change) for r in store.upsert(old, new, "k", "turn", F.lit("t1"), ["city"], ["payload"]).collect()}
    assert got == {"a": ("上海", "p2", "active", "t0", "t1", "updated"), "b": ("北京", "p0", "active", "t0", "t0", "kept"), "c": (None, "p3", "new", "t1", "t1", "inserted")}


def test_csv_header_of_an_older_table(spark):
    df = spark.createDataFrame([("1", "x")], "id string, fresh string")
    assert records.with_header_of(df, ["title", "id"]).columns == ["title", "id", "fresh"]


def test_index_of_a_folder(spark, tmp_path):
    def put(name, doc):
        (tmp_path / name).write_text(json.dumps(doc, ensure_ascii=False))

    put("jobs_0101.json", {"city": "杭州", "keyword": "AI", "scraped_at": "2024-01-01T00:00:00Z", "format_version": 2, "jobs": [record(1), record(2, jd=" ")]})
    put("details_0101.json", [record(1)])
    put("d1.json", {"artifact": {"kind": "deliverable", "scope_key": "k", "created_at": "2024-01-02"}, "jobs": []})
    put("d2.json", {"artifact": {"kind": "deliverable", "scope_key": "k", "created_at": "2024-01-03"}, "jobs": [record(1)]})
    put("old.json", {"scope": "一批", "city": "杭州", "scraped_at": "2023-12-01", "jobs": []})
    put("x.failures.json", [])
    got = {r.path.rsplit("/", 1)[-1]: r for r in files.read_index(spark, str(tmp_path), F.to_timestamp(F.lit("2024-01-01 00:00:00"))).collect()}
    assert {k: r.kind for k, r in got.items()} == {"jobs_0101.json": "list", "details_0101.json": "details", "d1.json": "deliverable", "d2.json": "deliverable", "old.json": "deliverable", "x.failures.json": "ledger"}
    assert (got["jobs_0101.json"].scope_key, got["jobs_0101.json"].inferred, got["jobs_0101.json"].jobs, got["jobs_0101.json"].with_body) == ("杭州|AI", True, 2, 1)
    assert got["details_0101.json"].scope_key == "杭州|AI" and got["old.json"].scope_key == "杭州|一批"
    assert (got["d1.json"].status, got["d2.json"].status, got["old.json"].stale, got["d2.json"].stale) == ("superseded", "active", True, False)


def test_safe_json_and_logs(spark, tmp_path):
    df = spark.createDataFrame([("a", "secret", "https://h/?lid=1&q=2")], "title string, authToken string, link string")
    files.write_safe(df, str(tmp_path / "safe"))
    assert json.loads(spark.read.text(str(tmp_path / "safe")).first().value) == {"title": "a", "link": "https://h/?q=2"}
    for event in ("start", "stop"):
        files.append_log(spark.createDataFrame([(event, "mine")], "event string, ts string"), str(tmp_path / "log"), {"ts": F.lit("2024-01-01")})
    assert sorted((r.event, r.ts) for r in spark.read.json(str(tmp_path / "log"), schema="event string, ts string").collect()) == [("start", "2024-01-01"), ("stop", "2024-01-01")]


def test_csv_begins_with_a_byte_order_mark(spark, tmp_path):
    files.write_records(spark.createDataFrame([("职位", ["a", "b"])], "title string, skills array<string>").coalesce(1), str(tmp_path / "csv"), "csv")
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_bytes() == "\ufefftitle,skills\n职位,a | b\n".encode()


def test_migrations_run_once_in_order(spark):
    ran = []

    def step(n):
        def change(tables):
            ran.append(n)
            return {"jobs": tables["jobs"].withColumn(f"c{n}", F.lit(n))}

        return change

    meta = spark.createDataFrame([("schema_version", "1"), ("owner", "me")], "key string, value string")
    steps = {3: step(3), 1: step(1), 2: step(2)}
    meta, tables = store.migrated(meta, {"jobs": spark.range(2)}, steps)
    assert ran == [2, 3] and tables["jobs"].columns == ["id", "c2", "c3"]
    assert {r.key: r.value for r in meta.collect()} == {"schema_version": "3", "owner": "me"}
    assert store.migrated(meta, tables, steps)[1] == tables and ran == [2, 3]
    with pytest.raises(Exception, match="newer"):
        store.migrated(meta, tables, {1: step(1)})
