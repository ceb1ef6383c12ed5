"""Queries of stores, scopes, ledgers and retries. Orders stand in for jobs, customers for runs, events for files and failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import records as C
from sievework.operators import scopes, store
from sievework.plans.registry import NOW, events, query
from sievework.plans.tables import table

_JOBS = "select o_orderkey as job, case when o_orderkey % 17 = 0 then '' else split_part('杭州|北京|上海', '|', cast(o_custkey % 3 as int) + 1) end as city, case when o_orderkey % 5 = 0 then 'AI产品经理' when o_orderkey % 5 = 1 then null else '运营' end as keyword, o_custkey as run_id, {day} as updated_at from orders"
_RUNS = "select c_custkey as run_id, concat('数据,', c_mktsegment) as keyword from customer"


def _columns(sql: str) -> list[str]:
    """The select list of one of the statements above, for selectExpr."""
    body, out, depth, start = sql[len("select ") : sql.rindex(" from ")], [], 0, 0
    for i, c in enumerate(body):
        depth += (c == "(") - (c == ")")
        if c == "," and not depth and body.count("'", 0, i) % 2 == 0:
            out.append(body[start:i])
            start = i + 1
    return [*out, body[start:]]


def _made(spark, sf_dir, sql: str, **more):
    return table(spark, sf_dir, sql.rsplit(" from ", 1)[1]).selectExpr(*_columns(sql.format(**more)))


def _store(spark, sf_dir):
    jobs = _made(spark, sf_dir, _JOBS, day="cast(cast(o_orderdate as date) as string)")
    return scopes.from_store(jobs, _made(spark, sf_dir, _RUNS), "杭州", "产品, building", "1995-06-01")


_SCOPE = f"j as ({_JOBS.format(day='cast(cast(o_orderdate as date) as varchar)')}), r as ({_RUNS}), b as (select j.*, r.keyword rk, j.city = '杭州' and (contains(lower(concat_ws(' ', coalesce(j.keyword, ''), coalesce(r.keyword, ''))), '产品') or contains(lower(concat_ws(' ', coalesce(j.keyword, ''), coalesce(r.keyword, ''))), 'building')) and updated_at >= '1995-06-01' as ok from j left join r using (run_id))"


@query(f"with {_SCOPE} select job, city, updated_at from b where ok")
def store_scope(spark, sf_dir):
    return _store(spark, sf_dir)[0].select("job", "city", "updated_at")


@query(f"with {_SCOPE} select count(*) as in_store, count(*) filter (city = '') as unknown_city, count(*) filter (ok) as selected from b")
def store_scope_counts(spark, sf_dir):
    return _store(spark, sf_dir)[1]


_LISTS = "select user_id as job_id, cast(ts as date) as file, event_id as place, event_type, case when event_id % 3 = 0 then '' else event_type end as file_city from events"
_BODIES = "select user_id as job_id, cast(ts as date) as file, event_id as place, case when event_id % 4 > 0 then props else ' ' end as jd from events"
_FIRST = "row_number() over (partition by job_id order by file, place) n"


def _folder(spark, sf_dir):
    return scopes.union_of_folders(_made(spark, sf_dir, _LISTS), _made(spark, sf_dir, _BODIES), "job_id", ["file", "place"], "purchase")


@query(f"with l as ({_LISTS}), f as (select *, {_FIRST} from l where file_city in ('', 'purchase')) select job_id, place, event_type from f where n = 1")
def folder_jobs(spark, sf_dir):
    return _folder(spark, sf_dir)[0].select("job_id", "place", "event_type")


@query(f"with l as ({_LISTS}), d as ({_BODIES}), f as (select *, {_FIRST} from d where trim(jd) <> '') select job_id, place, jd from f where n = 1 and job_id in (select job_id from l where file_city in ('', 'purchase'))")
def folder_details(spark, sf_dir):
    return _folder(spark, sf_dir)[1].select("job_id", "place", "jd")


@query(f"with d as ({_BODIES}), f as (select *, {_FIRST} from d where trim(jd) <> '') select job_id, place, jd from f where n = 1")
def first_details(spark, sf_dir):
    return scopes.first_of(_made(spark, sf_dir, _BODIES), "job_id", ["file", "place"], "jd").select("job_id", "place", "jd")


@query(f"with d as ({_BODIES}) select place from d where trim(jd) <> '' and job_id in (select o_custkey from orders where o_orderstatus = 'F')")
def details_with_body(spark, sf_dir):
    ids = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("job_id"))
    return scopes.with_body(_made(spark, sf_dir, _BODIES), "job_id", "jd", ids).select("place")


@query(f"with d as ({_BODIES}) select distinct job_id from d where trim(jd) <> ''")
def known_detail_ids(spark, sf_dir):
    return scopes.with_body(_made(spark, sf_dir, _BODIES), "job_id", "jd").select("job_id").distinct()


_FILES = "select concat('/out/', case when event_type = 'click' then 'jobs_' when event_type = 'view' then 'details_' else 'log_' end, cast(ts as date), case when event_type in ('click', 'view') then '' else concat('_', event_id) end, '.json') as path, case when event_type = 'click' then 'list' when event_type = 'view' then 'details' else 'other' end as kind, case when event_type = 'click' and event_id % 2 = 0 then concat('scope', event_id) end as scope, ts as created_at, ts as modified, cast(event_id as bigint) as bytes, case when event_id % 4 = 0 then 'superseded' else 'active' end as status from events"


@query(f"with f as ({_FILES}), c as (select '/out/jobs_2024-01-03.json' as path, 0 turn from f where path = '/out/jobs_2024-01-03.json' union select path, 1 from f where path = '/out/details_2024-01-05.json' union select arg_max(path, (modified, path)), 2 from f where kind = 'details') select path, min(turn) as turn from c group by 1")
def detail_candidates(spark, sf_dir):
    return scopes.candidates(_made(spark, sf_dir, _FILES), "/out/jobs_2024-01-03.json", "/out/jobs_2024-01-05.json")


@query(f"with f as ({_FILES}), s as (select replace(path, 'jobs_', 'details_') path, arg_min(scope, path) sc from f where kind = 'list' and scope is not null group by 1), q as (select path, min(scope) sc from (select path, min(scope) scope from f where kind = 'list' and scope is not null group by path) group by 1) select kind, count(*) as files, count(coalesce(scope, case when kind = 'details' then s.sc end)) as scoped from f left join s using (path) group by 1")
def paired_scopes(spark, sf_dir):
    return scopes.paired_scopes(_made(spark, sf_dir, _FILES)).groupBy("kind").agg(F.count("*").alias("files"), F.count("scope").alias("scoped"))


@query(f"with f as ({_FILES}) select path, kind, scope from f where kind = 'list' and contains(lower(coalesce(scope, '')), 'scope1')")
def scope_inventory(spark, sf_dir):
    return scopes.scope_inventory(_made(spark, sf_dir, _FILES), "list", "Scope1").select("path", "kind", "scope")


@query(f"with f as ({_FILES}) select kind, status, count(*) as files, cast(sum(bytes) as bigint) as bytes, count(*) filter (created_at < timestamp '2024-01-10') as stale from f group by 1, 2")
def inventory_counts(spark, sf_dir):
    f = _made(spark, sf_dir, _FILES).withColumn("created_at", F.col("created_at").cast("timestamp"))
    return scopes.inventory_counts(f, F.to_timestamp(F.lit("2024-01-10 00:00:00")))


@query(f"with f as ({_FILES}), g as (select *, regexp_replace(path, '\\.json$', '') stem from f), h as (select kind, stem, max(created_at) a from g group by 1, 2), n as (select *, row_number() over (partition by kind order by a desc, stem desc) r from h), o as (select stem, bool_and(r > 4) old from n group by 1) select path, old as archive from g join o using (stem)")
def archive_plan(spark, sf_dir):
    f = _made(spark, sf_dir, _FILES).withColumn("stem", F.regexp_replace("path", "\\.json$", ""))
    return scopes.archived(f, "kind", "created_at", "stem", 4)


@query("select o_orderkey, v, case when n.n_name is not null then cast(n.n_nationkey + 100000000 as varchar) when m.n_name is not null then v when regexp_full_match(v, '\\d{9}') then v end as code, coalesce(n.n_name, m.n_name) as label, n.n_name is null and m.n_name is null and not regexp_full_match(v, '\\d{9}') as error from (select o_orderkey, case o_orderkey % 4 when 0 then (select n_name from nation where n_nationkey = o_custkey % 25) when 1 then cast(100000000 + o_custkey % 25 as varchar) when 2 then '999999999' else 'nowhere' end v from orders) left join nation n on v = n.n_name left join nation m on v = cast(m.n_nationkey + 100000000 as varchar)")
def resolved_cities(spark, sf_dir):
    nation = table(spark, sf_dir, "nation").selectExpr("n_name as name", "n_nationkey + 100000000 as code")
    o = table(spark, sf_dir, "orders").join(nation.selectExpr("name", "code - 100000000 as nk"), F.expr("o_custkey % 25 = nk"))
    values = o.selectExpr("o_orderkey", "case o_orderkey % 4 when 0 then name when 1 then cast(100000000 + o_custkey % 25 as string) when 2 then '999999999' else 'nowhere' end as v")
    return scopes.resolved(values, "v", nation)


@query(f"with f as ({_FILES}), p as (select c_custkey profile, case when c_custkey % 2 = 0 then concat('scope', c_custkey) end scope_key, case when c_custkey % 3 = 0 then concat('jobs_2024-01-', lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0'), '.json') end target from customer), m as (select profile, path, created_at from p join f on p.scope_key = f.scope union all select profile, path, created_at from p join f on split_part(path, '/', 3) = target), b as (select profile, arg_max(path, (created_at, path)) path from m group by 1) select profile, b.path from p left join b using (profile)")
def profile_deliverables(spark, sf_dir):
    d = _made(spark, sf_dir, _FILES).withColumnRenamed("scope", "scope_key")
    p = table(spark, sf_dir, "customer").selectExpr("c_custkey as profile", "case when c_custkey % 2 = 0 then concat('scope', c_custkey) end as scope_key", "case when c_custkey % 3 = 0 then concat('jobs_2024-01-', lpad(cast(c_custkey % 28 + 1 as string), 2, '0'), '.json') end as target")
    return scopes.first_matches(p, d)


@query("select o_orderkey, o_custkey as run_id, c_name as run_name, coalesce(b, false) as has_body from orders left join customer on o_custkey = c_custkey left join (select l_orderkey, bool_or(l_returnflag = 'R') b from lineitem group by 1) on o_orderkey = l_orderkey")
def job_lineage(spark, sf_dir):
    jobs = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey as run_id")
    runs = table(spark, sf_dir, "customer").selectExpr("c_custkey as run_id", "c_name as name")
    details = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey as o_orderkey", "case when l_returnflag = 'R' then 'body' else '' end as jd")
    return scopes.lineage(jobs, runs, details, "o_orderkey")


# ---------------------------------------------------------------- retries and ledgers


_PENDING = """case when o_orderkey % 3 = 0 then concat('"', o_custkey, '"') else concat('{"job_id":"', o_custkey, '","attempts":', o_orderkey % 5, '}') end"""


@query("with i as (select cast(o_custkey as varchar) k, case when o_orderkey % 3 = 0 then 0 else o_orderkey % 5 end a from orders), h as (select k, max(a) a from i group by 1), f as (select cast(c_custkey as varchar) k from customer where c_mktsegment = 'BUILDING') select coalesce(h.k, f.k) as job_id, cast(coalesce(a, 0) as int) as attempts from h full join f on h.k = f.k where a < 3 or f.k is not null")
def pending_retries(spark, sf_dir):
    a = C.pending_attempts("item")
    items = table(spark, sf_dir, "orders").selectExpr(f"{_PENDING} as item").select(a["job_id"].alias("job_id"), a["attempts"].alias("attempts"))
    forced = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("job_id"))
    return scopes.pending(items, "job_id", "attempts", forced)


def _ledgers(spark, sf_dir):
    e = events(spark, sf_dir).selectExpr("cast(user_id as string) as job_id", "event_id as turn", "event_type as reason", "ts")
    old, new = (e.where(c).drop("ts") for c in ("ts < '2024-01-16'", "ts >= '2024-01-16'"))
    return old.where("reason = 'error'"), new.where("reason = 'error'"), e.where("reason = 'purchase' and ts >= '2024-01-24'").select("job_id")


_LEDGER = "e as (select cast(user_id as varchar) job_id, event_id turn, event_type reason, ts from events), present as (select job_id from e where reason = 'purchase' and ts >= timestamp '2024-01-24'), r as (select *, row_number() over (partition by job_id order by case when ts < timestamp '2024-01-16' then 0 else 1 end, turn) n from e where reason = 'error')"


@query(f"with {_LEDGER} select job_id, turn, reason from r where n = 1 and job_id not in (select job_id from present)")
def drop_ledger(spark, sf_dir):
    return scopes.merged_ledger(*_ledgers(spark, sf_dir), "job_id", "turn")


@query(f"with {_LEDGER}, d as (select distinct job_id from r where job_id not in (select job_id from present)), b as (select distinct job_id from e where reason = 'signup' and job_id not in (select job_id from present)) select (select count(*) from present) + (select count(*) from d) as with_body, (select count(*) from present) + (select count(*) from d) + (select count(*) from b) as total_before, (select count(*) from b) as dropped_no_body")
def coverage_funnel(spark, sf_dir):
    before, now, present = _ledgers(spark, sf_dir)
    bodyless = events(spark, sf_dir).where("event_type = 'signup'").selectExpr("cast(user_id as string) as job_id")
    return scopes.funnel(present, before.unionByName(now), bodyless, "job_id")


@query("with a as (select distinct user_id from events where event_type = 'view'), b as (select distinct user_id from events where event_type = 'click') select (select count(*) from a where user_id not in (select user_id from b)) + (select count(*) from b where user_id not in (select user_id from a)) > 0 as changed, (select count(*) from a where user_id not in (select user_id from b)) as only_first, (select count(*) from b where user_id not in (select user_id from a)) as only_second")
def changed_membership(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return scopes.same_members(e.where("event_type = 'view'"), e.where("event_type = 'click'"), "user_id")


@query("select distinct user_id from events where user_id is not null")
def observed_ids(spark, sf_dir):
    return table(spark, sf_dir, "events").where("user_id is not null").select("user_id").distinct().orderBy("user_id")


_BAD = "select event_id, case when event_id % 4 = 0 then '' else event_type end as fingerprint, case when event_id % 2 = 0 then 'structural' else 'transient' end as nature, case when event_id % 7 = 0 then null else event_id % 100 end as expires_at, cast(event_id % 9 as int) as skip_runs, case when event_id % 3 = 0 then 'now' else 'old' end as run_id from events"


@query(f"with b as ({_BAD}) select case when fingerprint = '' then 'unknown' else fingerprint end as fingerprint, nature, count(*) as entries from b where expires_at > 40 and case when nature = 'structural' then skip_runs < 5 else run_id = 'now' end group by 1, 2")
def known_bad(spark, sf_dir):
    return scopes.known_bad(_made(spark, sf_dir, _BAD), F.lit(40), "now")


# ---------------------------------------------------------------- store tables


@query("""with c as (select user_id, event_id, ts, case when event_id % 3 > 0 then event_type end t, case when event_id % 4 > 0 then 'p' || (event_id % 3) end p, case when event_id % 5 = 0 then '' else 'b' || (event_id % 6) end b from events),
w as (select user_id, b, arg_min(t, ts) filter (t is not null) t, arg_min(p, ts) filter (p is not null) p, min(ts) captured from c where b <> '' group by 1, 2 union all select user_id, b, t, p, min(ts) from c where b = '' and (t is not null or p is not null) group by 1, 2, 3, 4),
m as (select *, row_number() over o nth, last_value(t ignore nulls) over (o rows between unbounded preceding and 1 preceding) bt, last_value(p ignore nulls) over (o rows between unbounded preceding and 1 preceding) bp from w window o as (partition by user_id order by captured, b desc, t nulls first, p nulls first)),
k as (select * from m where b <> '' or nth = 1 or (t is not null and t is distinct from bt) or (p is not null and p is distinct from bp))
select user_id, b as body, t as title, p as pay, captured, row_number() over (partition by user_id order by captured, b desc, t nulls first, p nulls first) as version from k""")
def full_versions(spark, sf_dir):
    e = events(spark, sf_dir).selectExpr("user_id", "ts", "case when event_id % 3 > 0 then event_type end as title", "case when event_id % 4 > 0 then concat('p', event_id % 3) end as pay", "case when event_id % 5 = 0 then '' else concat('b', event_id % 6) end as body")
    return store.full_versions(e, "user_id", "body", ["title", "pay"], "ts")


@query("select c_custkey as k, c_mktsegment as flag, c_name as value from customer where c_mktsegment in ('BUILDING', 'MACHINERY')")
def flags_by_name(spark, sf_dir):
    f = table(spark, sf_dir, "customer").selectExpr("c_custkey as k", "c_mktsegment as flag", "c_name as value")
    return store.flags_of(f, "k", names=["BUILDING", "MACHINERY"])


_FLAGS = ("select user_id as k, concat(event_type, ':', event_id % 3) as flag, 'l' as value from events where event_type <> 'view'", "select user_id as k, case when event_id % 2 = 0 then concat(event_type, ':', event_id % 2) else event_type end as flag, 'd' as value from events where event_type in ('click', 'error') and value > 60")


@query(f"with l as (select distinct * from ({_FLAGS[0]})), d as (select distinct * from ({_FLAGS[1]})), s as (select distinct k, split_part(flag, ':', 1) s from d where contains(flag, ':')), b as (select l.*, 1 p from l left join s on l.k = s.k and split_part(l.flag, ':', 1) = s.s where s.k is null union all select *, 0 from d) select k, flag, arg_min(value, p) as value from b group by 1, 2")
def backfilled_flags(spark, sf_dir):
    made = lambda sql: table(spark, sf_dir, "events").where(sql.split(" where ")[1]).selectExpr(*_columns(sql.split(" where ")[0]))
    return store.backfill_flags(made(_FLAGS[0]), made(_FLAGS[1]), "k")


@query(f"""with t as (select c_custkey k, timestamp '2024-01-01' started_at, 'list' as mode, c_mktsegment scope_key, cast(null as integer) budget from customer where c_nationkey < 13), i as (select o_custkey k, o_orderkey turn, timestamp '{NOW}' started_at, o_orderstatus as mode, case when o_orderkey % 2 = 0 then o_orderpriority end scope_key, case when o_orderkey % 3 = 0 then cast(o_orderkey % 7 as integer) end budget from orders),
s as (select k, arg_max(started_at, turn) started_at, arg_max(mode, turn) as mode, arg_max(scope_key, turn) filter (scope_key is not null) scope_key, arg_max(budget, turn) filter (budget is not null) budget from i group by 1)
select coalesce(t.k, s.k) as k, coalesce(t.started_at, s.started_at) as started_at, case when s.k is not null then s.mode else t.mode end as mode, coalesce(s.scope_key, t.scope_key) as scope_key, coalesce(s.budget, t.budget) as budget from t full join s on t.k = s.k""")
def run_lineage(spark, sf_dir):
    at = lambda x: F.to_timestamp(F.lit(x))
    t = table(spark, sf_dir, "customer").where("c_nationkey < 13").selectExpr("c_custkey as k", "'list' as mode", "c_mktsegment as scope_key", "cast(null as int) as budget").withColumn("started_at", at("2024-01-01 00:00:00"))
    s = table(spark, sf_dir, "orders").selectExpr("o_custkey as k", "o_orderkey as turn", "o_orderstatus as mode", "case when o_orderkey % 2 = 0 then o_orderpriority end as scope_key", "case when o_orderkey % 3 = 0 then cast(o_orderkey % 7 as int) end as budget").withColumn("started_at", at(NOW))
    return store.record_runs(t, s, "k", "turn", ["mode"], ["scope_key", "budget"])


_EXISTING = "select c_custkey as k, 0 as turn, c_name as title, case when c_custkey % 19 = 0 then '' else c_mktsegment end as place from customer where c_nationkey < 15"
_INCOMING = "select case when o_orderkey % 23 = 0 then null else o_custkey end as k, o_orderkey as turn, concat('Customer#', lpad(cast(o_custkey as {text}), 9, '0')) as title, case when o_orderkey % 29 = 0 then '' else o_orderpriority end as place from orders"


def _flushed(spark, sf_dir):
    old = table(spark, sf_dir, "customer").where("c_nationkey < 15").selectExpr(*_columns(_EXISTING.split(" where ")[0]))
    new = table(spark, sf_dir, "orders").selectExpr(*_columns(_INCOMING.format(text="string")))
    return store.flush(old.withColumn("turn", F.col("turn").cast("long")), new, "k", "turn", ["title", "place"])


_FLUSH = f"o as ({_EXISTING}), i as ({_INCOMING.format(text='varchar')}), b as (select *, 0 side from o union all select *, 1 from i where k is not null), m as (select k, arg_min(turn, (side, turn)) turn, arg_min(title, (side, turn)) title, arg_min(place, (side, turn)) place, count(*) filter (side = 0) old, count(*) filter (side = 1) came, count(distinct (title, place)) > 1 differs from b group by 1), q as (select *, list_filter([case when title = '' then 'title' end, case when place = '' then 'place' end], lambda x: x is not null) lacks from m)"


@query(f"with {_FLUSH} select k, turn, title, place from q where len(lacks) = 0")
def flushed_table(spark, sf_dir):
    return _flushed(spark, sf_dir)[0]


@query(f"with {_FLUSH}, x as (select cast(null as bigint) k, 'invalid_key' as reason from i where k is null union all select k, 'missing:' || array_to_string(lacks, ',') from q where len(lacks) > 0 union all select k, 'conflict' from q where differs and came > 0) select reason, count(*) as n, cast(coalesce(sum(k), 0) as bigint) as keys from x group by 1")
def flush_quarantine(spark, sf_dir):
    return _flushed(spark, sf_dir)[1].groupBy("reason").agg(F.count("*").alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("keys"))


@query(f"with {_FLUSH} select count(*) filter (old = 0 and came > 0) as \"new\", cast(sum(came) as bigint) - count(*) filter (old = 0 and came > 0) as duplicate, count(*) filter (len(lacks) > 0) + count(*) filter (differs and came > 0) + (select count(*) from i where k is null) as quarantine from q")
def flush_counters(spark, sf_dir):
    return _flushed(spark, sf_dir)[2]


@query("select o_orderkey, o_orderdate, o_orderstatus, o_orderpriority from orders where o_orderstatus = 'O' and o_orderpriority = '2-HIGH' and o_orderdate >= timestamp '1996-01-01' order by o_orderdate desc, o_orderkey limit 40")
def store_search(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    return store.search(rows, "o_orderkey", "o_orderdate", {"o_orderstatus": "O", "o_orderpriority": "2-HIGH", "o_custkey": None}, "1996-01-01", 40)


@query("select user_id, event_type, captured, version from (select user_id, event_type, captured, row_number() over (partition by user_id order by captured, event_type) as version from (select user_id, event_type, min(ts) captured from (select * from events union all select * from events where event_type <> 'view') group by 1, 2))")
def replayed_versions(spark, sf_dir):
    """Replaying a part of the history changes nothing, whatever the order in which it comes."""
    e = events(spark, sf_dir)
    return store.number_versions(e.unionByName(e.where("event_type <> 'view'").orderBy(F.desc("ts"))), "user_id", "event_type", "ts")


# ---------------------------------------------------------------- raw items, versions, states


@query("""with raw as (select substr(md5(case when o_orderkey % 3 > 0 then concat('/j/', o_custkey) else concat('n', o_custkey) end), 1, 16) id, o_orderkey turn, o_orderpriority p, o_orderstatus s from orders), l as (select id, arg_max(p, turn) p, arg_max(s, turn) s from raw group by 1), r as (select substr(md5(concat('/j/', c_custkey)), 1, 16) id, case when c_custkey % 3 = 0 then '1-urgent' else '2-HIGH' end p, 'O' s from customer),
x as (select r.id, l.p rp, r.p cp, l.s rs, r.s cs from r left join l using (id)), v as (select 'priority' field, rp r, cp c from x union all select 'status', rs, cs from x), w as (select field, case when coalesce(r, '') = '' then 'no_check' when r = c then 'exact' when lower(r) = lower(c) then 'normalised' else 'mismatch' end v from v)
select field, count(*) filter (v = 'exact') as exact, count(*) filter (v = 'normalised') as normalised, count(*) filter (v = 'mismatch') as mismatch, count(*) filter (v = 'no_check') as no_check, round(count(*) filter (v in ('exact', 'normalised')) / nullif(count(*) filter (v <> 'no_check'), 0), 4) as rate from w group by 1""")
def raw_by_computed_id(spark, sf_dir):
    from sievework.operators import quality

    raw = table(spark, sf_dir, "orders").selectExpr("case when o_orderkey % 3 > 0 then concat('/j/', o_custkey) else '' end as link", "concat('n', o_custkey) as name", "o_orderkey as turn", "o_orderpriority as p", "o_orderstatus as s")
    records = table(spark, sf_dir, "customer").selectExpr("substr(md5(concat('/j/', c_custkey)), 1, 16) as job_id", "case when c_custkey % 3 = 0 then '1-urgent' else '2-HIGH' end as priority", "'O' as status")
    return quality.field_fidelity(quality.raw_pairs(raw, records, "link", "name", "turn", {"priority": "p", "status": "s"}), ["priority", "status"])


@query("select event_type, arg_max(event_id, (ts, event_id)) as event_id from events group by 1")
def newest_by_kind(spark, sf_dir):
    from sievework.operators import rollups

    return rollups.newest_by(events(spark, sf_dir), "event_type", ["ts", "event_id"], "event_id")


@query("""with i as (select distinct event_type, cast(cast(ts as date) as varchar) v, user_id from events), t as (select event_type, v, dense_rank() over (partition by event_type order by v desc) turn from (select distinct event_type, v from i)), e as (select event_type, user_id, bool_or(turn = 1) n, bool_or(turn = 2) o from i join t using (event_type, v) where turn <= 2 group by 1, 2)
select event_type, (select v from t where t.event_type = e.event_type and turn = 1) as current, (select v from t where t.event_type = e.event_type and turn = 2) as previous, count(*) filter (n and not o) as added, count(*) filter (o and not n) as removed, count(*) filter (n and o) as kept from e group by 1""")
def version_changes(spark, sf_dir):
    from sievework.operators import rollups

    items = events(spark, sf_dir).selectExpr("event_type", "cast(to_date(ts) as string) as v", "user_id")
    return rollups.version_changes(items, "event_type", "v", "user_id")


@query("with p as (select user_id, max(event_id) turn from events where ts < timestamp '2024-01-16' group by 1), c as (select user_id, max(event_id) turn from events where ts >= timestamp '2024-01-16' and event_type = 'click' group by 1) select user_id, coalesce(c.turn, p.turn) as turn from p full join c using (user_id)")
def saved_queue(spark, sf_dir):
    from sievework.operators import rollups

    e = events(spark, sf_dir).selectExpr("user_id", "event_id as turn", "ts", "event_type")
    return rollups.saved_state(e.where("ts < '2024-01-16'").drop("ts", "event_type"), e.where("ts >= '2024-01-16' and event_type = 'click'").drop("ts", "event_type"), "user_id", "turn")


_FAILED = "case event_id % 7 when 0 then 'text too short' when 1 then '登录查看完整内容' when 2 then '请输入验证码' when 3 then '正在加载 首页' when 4 then '职位描述' when 5 then 'x' else '' end"


@query("select event_id, case event_id % 7 when 0 then 'too_short' when 1 then 'login_wall' when 2 then 'risk_page' when 3 then 'shell_only' when 6 then 'unknown' else 'no_section' end as fingerprint, case when event_id % 7 in (4, 5) then 'structural' else 'transient' end as nature from events")
def failure_fingerprints(spark, sf_dir):
    from sievework.functions import postings as P

    e = table(spark, sf_dir, "events").selectExpr("event_id", f"{_FAILED} as page").select("event_id", P.failure_fingerprint(F.lit(None).cast("string"), "page").alias("fingerprint"))
    return e.withColumn("nature", P.failure_nature("fingerprint"))


@query("select event_id, case when event_id % 3 = 0 then '今日活跃' when event_id % 2 = 0 then '在线' else '' end as activity, case when event_id % 4 > 0 then date_diff('day', cast(ts as date), date '2024-02-01') end as days from events")
def activity_and_age(spark, sf_dir):
    from sievework.functions import postings as P

    e = events(spark, sf_dir).selectExpr("event_id", "case when event_id % 3 = 0 then ' 今日活跃 ' else '' end as a", "event_id % 2 = 0 as o", "case when event_id % 4 > 0 then cast(to_date(ts) as string) else 'soon' end as d")
    return e.select("event_id", P.listed_activity("a", "o").alias("activity"), P.days_since("d", F.to_date(F.lit("2024-02-01"))).cast("long").alias("days"))


@query("""with f as (select c_custkey k, string_agg(c_mktsegment || '=1', ',' order by c_mktsegment) flags from (select * from customer union all select * from customer where false) group by 1), v as (select o_custkey k, string_agg(o_orderkey, ',' order by o_orderkey) versions from orders group by 1) select c_custkey as k, coalesce(versions, '') as versions, coalesce(flags, '') as flags from customer left join f on f.k = c_custkey left join v on v.k = c_custkey""")
def assets_with_flags(spark, sf_dir):
    from sievework.operators import merge

    c = table(spark, sf_dir, "customer")
    jobs = c.select(F.col("c_custkey").alias("k"))
    flags = c.selectExpr("c_custkey as k", "c_mktsegment as flag", "'1' as value")
    out = merge.asset_view(jobs, table(spark, sf_dir, "orders").selectExpr("o_custkey as k", "o_orderkey as version"), "k", "version", [])
    out = merge.asset_view(out, flags, "k", "flag", ["value"], "flags")
    return out.select("k", F.array_join(F.transform("versions", lambda v: v.version.cast("string")), ",").alias("versions"), F.array_join(F.transform("flags", lambda v: F.concat_ws("=", v.flag, v.value)), ",").alias("flags"))


@query("select regexp_replace(concat('/d/', event_type, '-', event_id % 50, '.', case event_id % 3 when 0 then 'json' when 1 then 'csv' else 'log' end), '\\.[A-Za-z]+$', '') as stem, count(*) as files, cast(sum(event_id) as bigint) as bytes from events group by 1")
def sidecar_groups(spark, sf_dir):
    from sievework.sources import files

    f = table(spark, sf_dir, "events").selectExpr("concat('/d/', event_type, '-', event_id % 50, '.', case event_id % 3 when 0 then 'json' when 1 then 'csv' else 'log' end) as name", "cast(event_id as bigint) as bytes").withColumn("stem", F.regexp_replace("name", "\\.[A-Za-z]+$", ""))
    # each event is a file here, so files of one name count each
    return files.sidecars(f.withColumn("name", F.concat_ws("#", "name", "bytes"))).select("stem", F.size("files").cast("long").alias("files"), "bytes")
