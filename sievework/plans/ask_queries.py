"""Queries of the questions: a day's events of one type stand for a deliverable, users for postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.plans import ask
from sievework.plans.registry import events, query
from sievework.plans.tables import table

_ITEMS = "select concat('/out/', event_type, '/', cast(ts as date)) as path, event_type as scope_key, cast(ts as date) as created_at, user_id as job_id, case event_id % 5 when 0 then 'dropped' when 1 then 'no_body' else 'kept' end as kind, case when event_id % 5 = 0 then concat('rule', event_id % 3) else '' end as reason from events"


def _items(spark, sf_dir):
    return events(spark, sf_dir).selectExpr("concat('/out/', event_type, '/', cast(ts as date)) as path", "event_type as scope_key", "cast(ts as date) as created_at", "user_id as job_id", "case event_id % 5 when 0 then 'dropped' when 1 then 'no_body' else 'kept' end as kind", "case when event_id % 5 = 0 then concat('rule', event_id % 3) else '' end as reason")


def _both(spark, sf_dir):
    items = _items(spark, sf_dir)
    # one reason a day, as a ledger has
    one = items.groupBy("path", "job_id", "kind").agg(F.min("reason").alias("reason"))
    return one, items.select("path", "scope_key", "created_at").distinct()


_DELIVERED = f"a as ({_ITEMS}), d as (select distinct path, scope_key, created_at from a), i as (select path, job_id, kind, min(reason) reason from a group by 1, 2, 3)"


@query(f"""with {_DELIVERED}, z as (select arg_max(path, (created_at, path)) z from d), e as (select job_id, case kind when 'kept' then 0 when 'dropped' then 1 else 2 end + case when path = z then 0 else 4 end p, reason, path, cast(created_at as varchar) as seen from i join d using (path), z
union all select distinct o_custkey, 3, '', '', '' from orders where o_orderstatus = 'F' union all select distinct o_custkey, 7, '', '', '' from orders union all select c_custkey, 8, '', '', '' from customer),
r as (select *, row_number() over (partition by job_id order by p, seen desc, path desc, reason desc) n from e) select job_id, {ask.ANSWERS!r}[p + 1] as answer, reason, path from r where n = 1 and job_id in (select c_custkey from customer)""".replace("('kept'", "['kept'").replace("'unknown')", "'unknown']"))
def ask_why(spark, sf_dir):
    items, deliverables = _both(spark, sf_dir)
    o = table(spark, sf_dir, "orders")
    asked = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("job_id"))
    ids = lambda df: df.select(F.col("o_custkey").alias("job_id"))
    return ask.ask("why", asked=asked, items=items, deliverables=deliverables, excluded=ids(o.where("o_orderstatus = 'F'")), store=ids(o))


_PAIR = f"{_DELIVERED}, s as (select arg_max(scope_key, (scope_key = 'Click', created_at, path)) s from d where contains(scope_key, 'click')), v as (select path, row_number() over (order by created_at desc, path desc) turn from d, s where scope_key = s), t as (select job_id, kind, reason, turn from i join v using (path) where turn <= 2)"


@query(f"""with {_PAIR}, o as (select distinct job_id from t where kind = 'kept' and turn = 2), n as (select distinct job_id from t where kind = 'kept' and turn = 1), f as (select coalesce(o.job_id, n.job_id) job_id, case when o.job_id is null then 'added' else 'removed' end change from o full join n on o.job_id = n.job_id where o.job_id is null or n.job_id is null),
x as (select job_id, min(reason) filter (kind = 'dropped' and turn = 2) b, min(reason) filter (kind = 'dropped' and turn = 1) w, count(*) filter (kind = 'no_body' and turn = 1) nb from t group by 1)
select job_id, change, case when change = 'added' and b is not null then 'rule_dropped_before' when change = 'added' then 'new' when w is not null then 'rule:' || w when nb > 0 then 'no_body' else 'vanished' end as reason from f join x using (job_id)""")
def ask_diff(spark, sf_dir):
    items, deliverables = _both(spark, sf_dir)
    return ask.ask("diff", items=items, deliverables=deliverables, scope="Click")


@query(f"with {_PAIR}, k as (select job_id, bool_or(turn = 1) n, bool_or(turn = 2) o from t where kind = 'kept' group by 1) select count(*) filter (n and not o) as added, count(*) filter (o and not n) as removed, count(*) filter (n and o) as kept from k")
def ask_diff_counts(spark, sf_dir):
    items, deliverables = _both(spark, sf_dir)
    return ask.ask("diff_counts", items=items, deliverables=deliverables, scope="Click")


_PROFILES = "select r_regionkey as profile, case r_regionkey when 0 then 'click' when 1 then 'view' when 2 then '' else 'none' end as scope_key, case r_regionkey when 2 then '2024-01-09' else '' end as target from region"


@query(f"with {_DELIVERED}, p as ({_PROFILES}), m as (select profile, path, created_at from p join d using (scope_key) union all select profile, path, created_at from p join d on split_part(path, '/', 4) = target), b as (select profile, arg_max(path, (created_at, path)) path from m group by 1), l as (select event_type scope_key, max(ts) t from events group by 1) select profile, b.path, t as last_run from p left join b using (profile) left join l using (scope_key)")
def ask_templates(spark, sf_dir):
    _, deliverables = _both(spark, sf_dir)
    columns = _PROFILES[len("select ") : _PROFILES.index(" from ")]
    profiles = table(spark, sf_dir, "region").selectExpr("r_regionkey as profile", *[c + " as " + n for c, n in ((columns[columns.index("case r_regionkey when 0") : columns.index(" as scope_key")], "scope_key"), (columns[columns.index("case r_regionkey when 2 then '2024") : columns.index(" as target")], "target"))])
    runs = events(spark, sf_dir).select(F.col("event_type").alias("scope_key"), F.col("ts").alias("started_at"))
    return ask.ask("templates", profiles=profiles, deliverables=deliverables, runs=runs)


@query("with h as (select case when event_id % 7 = 0 then '' when event_type = 'error' then 'failed' else 'done' end s, cast(floor(value) as bigint) - 20 a, event_id % 3 b from events) select count(*) as runs, count(*) filter (s <> 'failed') as ok_runs, count(*) filter (s = 'failed') as failed_runs, cast(sum(greatest(0, a)) as bigint) as a, cast(sum(b) as bigint) as b from h")
def ask_batches(spark, sf_dir):
    h = table(spark, sf_dir, "events").selectExpr("case when event_id % 7 = 0 then '' when event_type = 'error' then 'failed' else 'done' end as s", "cast(floor(value) as bigint) - 20 as a", "event_id % 3 as b")
    return ask.ask("batches", health=h, status="s", numbers=["a", "b"])


_TODAY = """e as (select *, cast(ts as date) d from events), o as (select * from e where d = date '2024-01-20'), w as (select event_type w, min(ts) t from o group by 1), j as (select user_id, min(d) f from e group by 1), c as (select user_id, count(*) n, min(ts) f from o group by 1),
t as (select (select count(*) from o) as runs, (select coalesce(string_agg(w, ',' order by t, w), '') from w) as keywords, (select arg_min(cast(user_id as varchar), (-n, f, cast(user_id as varchar))) from c) as city, (select count(*) from j where f = date '2024-01-20') as new_jobs, (select count(*) from o where event_type = 'purchase') as details, (select count(*) from o where event_type = 'purchase' and value > 50) as with_body, (select count(distinct user_id) from o) as used)"""


def _today(spark, sf_dir):
    e = events(spark, sf_dir)
    runs = e.select(F.col("ts").alias("started"), F.col("event_type").alias("keyword"), F.col("user_id").cast("string").alias("city"))
    jobs = e.groupBy("user_id").agg(F.min("ts").alias("first_seen"))
    details = e.where("event_type = 'purchase'").selectExpr("ts as updated", "case when value > 50 then 'x' else '' end as jd")
    used = e.where("to_date(ts) = '2024-01-20'").agg(F.count_distinct("user_id").alias("used"))
    return ask.ask("today", runs=runs, jobs=jobs, details=details, used=used, limit=30, day=F.to_date(F.lit("2024-01-20")))


@query(f"with {_TODAY} select *, greatest(0, 30 - used) as budget_left from t")
def ask_today(spark, sf_dir):
    return _today(spark, sf_dir)


@query(f"""with {_TODAY}, b as (select *, greatest(0, 30 - used) as budget_left from t), q as (select *, 'running' as state, 120::bigint as cooldown, true as old, 'held' as lock from b)
select *, array_to_string(list_filter([case when budget_left <= 0 then 'budget_spent' end, 'lock_held', 'cooling_down', 'run_is_old', case when runs = 0 then 'no_run_today' when new_jobs = 0 then 'nothing_new_today' end], lambda x: x is not null)[1:4], ',') as open from q""")
def ask_status(spark, sf_dir):
    at = lambda x: F.to_timestamp(F.lit(x))
    run = spark.range(1).select(F.lit("running").alias("state"), at("2024-01-20 10:00:00").alias("updated_at"))
    return ask.ask("status", today_=_today(spark, sf_dir), run=run, now=at("2024-01-20 12:00:00"), cooldown_until=at("2024-01-20 12:02:00"), holders=1, limit=30)
