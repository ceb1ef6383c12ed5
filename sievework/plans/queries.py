"""Registered queries of the posting engine over the driver's tables, each beside the SQL it must match."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import postings as P
from sievework.functions import text as X
from sievework.operators import dedupe, filters, merge, quality, rollups, store, summary
from sievework.plans.registry import NOW, ORACLE_SQL, QUERIES, events, query
from sievework.plans.registry import sql_any as _any
from sievework.plans.registry import sql_list as _list
from sievework.plans.tables import PLACE, placed, posting_sql, postings, table
from sievework.ruleset import DEFAULT as R

_P = f"with p as ({posting_sql()})"


# ---------------------------------------------------------------- duplicates and keyed merges

_PRINT = "select doc_id, lang, case when regexp_replace(lower(text), '\\s+', '', 'g') = '' then '' else substr(regexp_replace(lower(text), '\\s+', '', 'g'), 1, 180) || '|' || substr(lang, 1, 12) end as fp from documents"


def printed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "lang", X.fingerprint("text", "lang", unicode=False).alias("fp"))


@query(f"""with f as ({_PRINT}), s as (select fp, count(*) n, min(doc_id) first from f where fp <> '' group by fp having count(*) > 1)
select doc_id, coalesce('dup-' || substr(sha256(s.fp), 1, 8), '') as dup_group, coalesce(n, 1) as dup_size, coalesce(doc_id = first, true) as is_primary from f left join s on f.fp = s.fp""")
def dup_groups(spark, sf_dir):
    return dedupe.mark_groups(printed(spark, sf_dir), "fp", ["doc_id"]).select("doc_id", "dup_group", "dup_size", "is_primary")


@query(f"""with f as ({_PRINT}), s as (select fp, count(*) n from f where fp <> '' group by fp having count(*) > 1)
select count(*) as n_groups, cast(sum(n) as bigint) as n_records, max(n) as largest from s""")
def dup_summary(spark, sf_dir):
    sizes = printed(spark, sf_dir).where("fp <> ''").groupBy("fp").count().where("count > 1")
    return sizes.agg(F.count("*").alias("n_groups"), F.sum("count").alias("n_records"), F.max("count").alias("largest"))


@query("""with d as (select doc_id, d.lang, d.source, coalesce(l.quality, -1) quality, n_chars from documents d left join labels l using (doc_id)),
r as (select *, row_number() over (partition by lang, source order by quality desc, n_chars desc, doc_id) n, count(*) over (partition by lang, source) kept from d)
select lang, source, doc_id, kept, kept - 1 as n_others from r where n = 1""")
def dedupe_best(spark, sf_dir):
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("quality", F.coalesce("quality", F.lit(-1)))
    best, _ = dedupe.keep_best(d.select("doc_id", "lang", "source", "quality", "n_chars"), ["lang", "source"], [-F.col("quality"), -F.col("n_chars"), F.col("doc_id")], "doc_id")
    return best.select("lang", "source", "doc_id", "kept", (F.col("kept") - 1).alias("n_others"))


@query("""with r as (select doc_id, lang, source, first_value(doc_id) over (partition by lang, source order by n_chars desc, doc_id) best from documents) select lang, source, best, doc_id as other from r where doc_id <> best""")
def dedupe_others(spark, sf_dir):
    _, others = dedupe.keep_best(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"), ["lang", "source"], [-F.col("n_chars"), F.col("doc_id")], "doc_id")
    return others.select("lang", "source", "best", "other")


@query("""with e as (select event_id, user_id, event_type, ts < timestamp '2024-01-16' as old from events),
r as (select *, row_number() over (partition by user_id order by case when old then 0 else 1 end, event_id) n from e)
select event_id, user_id, event_type from r where n = 1""")
def keyed_merge_first_wins(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    old, new = (e.where(c).drop("ts") for c in ("ts < '2024-01-16'", "ts >= '2024-01-16'"))
    return dedupe.merge_keyed(old, new, "user_id", "event_id")


@query("""with e as (select event_id, user_id, event_type, ts < timestamp '2024-01-16' as old from events),
r as (select *, row_number() over (partition by user_id order by case when old then 1 else 0 end, event_id desc) n from e)
select event_id, user_id, event_type from r where n = 1""")
def keyed_merge_last_wins(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts")
    old, new = (e.where(c).drop("ts") for c in ("ts < '2024-01-16'", "ts >= '2024-01-16'"))
    return dedupe.merge_keyed(old, new, "user_id", "event_id", old_wins=False)


@query("""with p as (select cast(date_trunc('day', ts) as date) as page, list_sort(list(distinct user_id % 40)) items, count(*) n_items from events group by 1),
f as (select items, min(page) first from p group by items), m as (select page, n_items, page > first or n_items < 100 as stops, page > first as again from p join f using (items)),
e as (select min(page) ended from m where stops)
select page, n_items, stops from m, e where ended is null or page < ended or (page = ended and not again)""")
def pages_until_repeat(spark, sf_dir):
    e = events(spark, sf_dir).select(F.to_date("ts").alias("page"), (F.col("user_id") % 40).alias("item"))
    return dedupe.pages_until_repeat(e, "page", "item", 100)


# ---------------------------------------------------------------- lists and details


@query("""with d as (select l_orderkey k, l_linestatus, l_returnflag body, row_number() over (partition by l_orderkey order by l_linenumber desc) n from lineitem where l_quantity > 25)
select o_orderkey, o_orderpriority, coalesce(l_linestatus, o_orderstatus) as o_orderstatus, body, k is not null as has_detail from orders left join d on o_orderkey = k and n = 1""")
def merge_details(spark, sf_dir):
    listed = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    # line numbers repeat within an order; the SQL takes the first of these as the table has them
    details = placed(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linestatus").alias("o_orderstatus"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("").alias("body"), "l_linenumber", *PLACE)
    return merge.merge_details(listed, details, "o_orderkey", "body", "l_linenumber", ties=PLACE)


@query("""with d as (select l_orderkey k, l_returnflag body, row_number() over (partition by l_orderkey order by l_linenumber desc) n from lineitem where l_quantity > 25)
select o_orderkey, body from orders join d on o_orderkey = k and n = 1""")
def only_with_details(spark, sf_dir):
    details = placed(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_quantity") > 25, F.col("l_returnflag")).otherwise("").alias("body"), "l_linenumber", *PLACE)
    return merge.merge_details(table(spark, sf_dir, "orders").select("o_orderkey"), details, "o_orderkey", "body", "l_linenumber", keep_without=False, ties=PLACE).select("o_orderkey", "body")


@query("""select l_orderkey, count(*) as n from lineitem where exists (select 1 from orders where o_orderkey = l_orderkey and o_orderstatus = 'F') group by 1""")
def semi_details(spark, sf_dir):
    wanted = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").join(wanted, "l_orderkey", "left_semi").groupBy("l_orderkey").agg(F.count("*").alias("n"))


@query("select c_custkey, c_name from customer where not exists (select 1 from orders where o_custkey = c_custkey and o_orderpriority = '1-URGENT')")
def anti_known(spark, sf_dir):
    known = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return filters.excluded(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), known, "c_custkey")


@query("select s_suppkey, n_name as nation, r_name as region from supplier left join nation on s_nationkey = n_nationkey left join region on n_regionkey = r_regionkey")
def dimension_lookup(spark, sf_dir):
    # Spark broadcasts the dimensions by their measured size
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey, "left").join(r, n.n_regionkey == r.r_regionkey, "left").select("s_suppkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("""select o_orderkey, coalesce(string_agg(l_linenumber || ':' || l_returnflag, ',' order by l_linenumber, l_returnflag), '') as versions from orders left join lineitem on o_orderkey = l_orderkey group by 1""")
def asset_view(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_returnflag")
    out = merge.asset_view(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey", "l_linenumber", ["l_returnflag"])
    return out.select("o_orderkey", F.array_join(F.transform("versions", lambda v: F.concat_ws(":", v.l_linenumber, v.l_returnflag)), ",").alias("versions"))


@query("""with l as (select o_custkey k, count(*) l from orders group by 1), r as (select c_custkey k, count(*) r from customer group by 1), b as (select * from l full join r using (k))
select count(*) filter (r is null) as only_left, count(*) filter (l is null) as only_right, count(*) filter (l is not null and r is not null) as in_both, count(*) filter (l > 1) as repeated_left, count(*) filter (r > 1) as repeated_right,
(select count(*) from orders) as rows_left, 0::bigint as blank_left, (select count(*) from customer) as rows_right, 0::bigint as blank_right from b""")
def reconcile(spark, sf_dir):
    return merge.reconcile(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), "k")


@query("""with h as (select distinct l_orderkey from lineitem where l_returnflag = 'R')
select o_orderpriority, count(*) as listed, count(l_orderkey) as covered, count(*) - count(l_orderkey) as missing, round(count(l_orderkey) / count(*), 4) as rate from orders left join h on o_orderkey = l_orderkey group by 1""")
def coverage(spark, sf_dir):
    have = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return merge.coverage(table(spark, sf_dir, "orders"), have, "o_orderkey", "o_orderpriority")


_JOB_COLUMNS = {"job": "o_orderkey", "id": "case when o_orderkey % 3 <> 0 then o_custkey % 400 end", "link": "case when o_orderkey % 4 <> 0 then concat('l', o_orderkey % 9000) end", "title_key": "concat('t', o_orderkey % 7000)"}
_DETAIL_COLUMNS = {"detail": "c_custkey", "id": "case when c_custkey % 2 = 0 then c_custkey % 500 end", "link": "case when c_custkey % 5 <> 0 then concat('l', c_custkey * 7 % 11000) end", "title_key": "concat('t', c_custkey * 3 % 8000)"}
_of = lambda columns: ", ".join(f"{e} as {n}" for n, e in columns.items())
_FOUND = f"""j as (select {_of(_JOB_COLUMNS)} from orders), d as (select {_of(_DETAIL_COLUMNS)} from customer), a as (select min(job) job from j where id is null having count(*) = 1),
f as (select detail, job, 1 p from d join j using (id) union select detail, job, 2 from d join j using (link) where d.id is null union select detail, job, 3 from d join j using (title_key) where d.id is null union select detail, job, 4 from d, a where d.id is null),
b as (select detail, min(p) p from f group by 1), x as (select distinct detail, job, p as priority from f join b using (detail, p))"""


def _sides(spark, sf_dir):
    made = lambda name, columns: table(spark, sf_dir, name).selectExpr(*[f"{e} as {n}" for n, e in columns.items()])
    return made("orders", _JOB_COLUMNS), made("customer", _DETAIL_COLUMNS)


@query(f"with {_FOUND} select detail, job, priority from x")
def associate_details(spark, sf_dir):
    return merge.associate(*_sides(spark, sf_dir), "detail")


@query(f"with {_FOUND} select detail, priority, count(*) as candidates from x group by 1, 2")
def candidate_counts(spark, sf_dir):
    found, _, sizes = merge.association_classes(*_sides(spark, sf_dir), "detail")
    return found.join(sizes, ["priority", "value"]).groupBy("detail", "priority").agg(F.sum("jobs").alias("candidates"))


@query(f"with {_FOUND} select detail from x group by 1 having bool_and(job % 7 <> 0)")
def keep_associated(spark, sf_dir):
    jobs, details = _sides(spark, sf_dir)
    return merge.keep_associated(jobs, details, jobs.where("job % 7 = 0"), "detail")


# ---------------------------------------------------------------- keyed tables


_UPSERT_TARGET = "select c_custkey k, c_mktsegment city, c_name payload, case when c_custkey % 2 = 0 then 'closed' else 'active' end state from customer where c_nationkey < 17"
_UPSERT_SOURCE = "select o_custkey k, o_orderkey turn, case when o_orderkey % 3 > 0 then o_orderpriority end city, concat(o_orderkey, '!') payload from orders where o_orderstatus <> 'F'"


@query(f"""with t as ({_UPSERT_TARGET}), i as ({_UPSERT_SOURCE}), s as (select k, arg_max(payload, turn) payload, arg_max(city, turn) filter (city is not null) city from i group by 1)
select coalesce(t.k, s.k) as k, coalesce(s.city, t.city) as city, coalesce(s.payload, t.payload) as payload, case when t.k is not null then timestamp '2024-01-01' else timestamp '{NOW}' end as first_seen, case when s.k is not null then timestamp '{NOW}' else timestamp '2024-01-02' end as last_seen,
case when s.k is not null and t.k is not null then 'active' when s.k is not null then 'new' else t.state end as state, case when s.k is not null and t.k is not null then 'updated' when s.k is not null then 'inserted' else 'kept' end as change from t full join s on t.k = s.k""")
def upsert(spark, sf_dir):
    at = lambda x: F.to_timestamp(F.lit(x))
    c = table(spark, sf_dir, "customer").where("c_nationkey < 17")
    target = c.selectExpr("c_custkey as k", "c_mktsegment as city", "c_name as payload", "case when c_custkey % 2 = 0 then 'closed' else 'active' end as state").withColumns({"first_seen": at("2024-01-01 00:00:00"), "last_seen": at("2024-01-02 00:00:00")})
    source = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").selectExpr("o_custkey as k", "o_orderkey as turn", "case when o_orderkey % 3 > 0 then o_orderpriority end as city", "concat(o_orderkey, '!') as payload")
    return store.upsert(target, source, "k", "turn", at(NOW), ["city"], ["payload"])


@query(f"""with t as ({_UPSERT_TARGET}), i as ({_UPSERT_SOURCE}) select count(*) filter (k not in (select k from t)) as inserted, count(*) filter (k in (select k from t)) as updated from i""")
def upsert_counts(spark, sf_dir):
    target = table(spark, sf_dir, "customer").where("c_nationkey < 17").select(F.col("c_custkey").alias("k"))
    return store.upsert_counts(target, table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select(F.col("o_custkey").alias("k")), "k")


@query("""with t as (select c_custkey k, case when c_custkey % 3 = 0 then '' else c_mktsegment end a, case when c_custkey % 5 = 0 then null else c_name end b from customer), s as (select c_custkey k, 'A' a, concat('n', c_custkey) b from customer where c_custkey % 2 = 0)
select t.k, case when coalesce(t.a, '') = '' and s.k is not null then s.a else t.a end as a, case when t.b is null and s.k is not null then s.b else t.b end as b,
cast(case when coalesce(t.a, '') = '' and s.k is not null then 1 else 0 end + case when t.b is null and s.k is not null then 1 else 0 end as integer) as filled from t left join s on t.k = s.k""")
def fill_only(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    t = c.selectExpr("c_custkey as k", "case when c_custkey % 3 = 0 then '' else c_mktsegment end as a", "case when c_custkey % 5 = 0 then null else c_name end as b")
    s = c.where("c_custkey % 2 = 0").selectExpr("c_custkey as k", "'A' as a", "concat('n', c_custkey) as b")
    return store.fill_only(t, s, "k", ["a", "b"])


_VERSIONS = """with f as (select user_id, event_type, min(ts) captured from events group by 1, 2), v as (select *, row_number() over (partition by user_id order by captured, event_type) version from f)"""


@query(f"{_VERSIONS} select user_id, event_type, captured, version from v")
def version_history(spark, sf_dir):
    return store.number_versions(events(spark, sf_dir), "user_id", "event_type", "ts")


@query(f"{_VERSIONS} select user_id, max(version) as version, arg_max(event_type, version) as event_type from v group by 1")
def latest_version(spark, sf_dir):
    return store.latest_version(store.number_versions(events(spark, sf_dir), "user_id", "event_type", "ts").drop("captured"), "user_id")


@query("""with o as (select c_custkey k, c_mktsegment flag, 'x' as value, '1' rule_version, 'r1' run_id from customer), n as (select c_custkey k, c_mktsegment flag, case when c_custkey % 3 = 0 then 'y' else 'x' end as value, '1' rule_version, case when c_custkey % 2 = 0 then 'r2' end run_id from customer where c_custkey % 4 <> 0
union all select c_custkey, 'extra', 'z', '1', 'r2' from customer where c_custkey % 10 = 0)
select coalesce(o.k, n.k) as k, coalesce(o.flag, n.flag) as flag, case when n.k is not null then n.value else o.value end as value, '1' as rule_version, coalesce(n.run_id, o.run_id) as run_id, n.k is not null and (o.k is null or o.value <> n.value) as changed from o full join n on o.k = n.k and o.flag = n.flag""")
def upsert_flags(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    o = c.selectExpr("c_custkey as k", "c_mktsegment as flag", "'x' as value", "'1' as rule_version", "'r1' as run_id")
    n = c.where("c_custkey % 4 <> 0").selectExpr("c_custkey as k", "c_mktsegment as flag", "case when c_custkey % 3 = 0 then 'y' else 'x' end as value", "'1' as rule_version", "case when c_custkey % 2 = 0 then 'r2' end as run_id")
    n = n.union(c.where("c_custkey % 10 = 0").selectExpr("c_custkey", "'extra'", "'z'", "'1'", "'r2'"))
    return store.upsert_flags(o, n, "k")


@query("""select user_id, min(ts) as first_seen, max(ts) as last_seen, count(*) as seen, case when epoch(timestamp '2024-02-12') - epoch(date_trunc('second', max(ts))) > 14 * 86400 then 'stale' else 'active' end as state from events group by 1""")
def lifecycle(spark, sf_dir):
    return store.lifecycle(events(spark, sf_dir).where(F.lit(True)), "user_id", "ts", F.to_timestamp(F.lit("2024-02-12 00:00:00")), R.active_days)


@query("""with o as (select distinct event_type, user_id from events where ts < timestamp '2024-01-16' and event_type <> 'signup'), n as (select distinct event_type, user_id from events where ts >= timestamp '2024-01-16')
select coalesce(o.event_type, n.event_type) as event_type, count(*) filter (o.user_id is null) as added, count(*) filter (n.user_id is null) as removed, count(*) filter (o.user_id is not null and n.user_id is not null) as kept, count(o.user_id) = 0 as baseline from o full join n on o.event_type = n.event_type and o.user_id = n.user_id group by 1""")
def cross_run_delta(spark, sf_dir):
    e = events(spark, sf_dir)
    return store.delta(e.where("ts < '2024-01-16' and event_type <> 'signup'"), e.where("ts >= '2024-01-16'"), "user_id", "event_type")


@query("select o_orderkey, o_custkey, o_orderstatus, o_orderdate from orders where o_orderstatus = 'O' and o_orderdate >= timestamp '1996-01-01' order by o_orderdate desc, o_orderkey limit 50")
def store_query(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return rows.where("o_orderstatus = 'O' and o_orderdate >= '1996-01-01'").orderBy(F.desc("o_orderdate"), "o_orderkey").limit(50)


# ---------------------------------------------------------------- record rules

_HIDDEN = "(" + " or ".join(f"starts_with(company_name, '{s}')" for s in R.anonymous_starts) + ")"
_POST = f"case when proxy_job <> '' or boss_title = '猎头顾问' then 'agency' when {_HIDDEN} or {_any('company_name', R.fragile_terms)} then 'anonymous' else 'direct' end"
_RECRUIT = "case when job_type = '4' then 'intern' when job_type = '5' then 'campus' when job_type = '' and contains(title, '实习') then 'intern' else 'social' end"
_ACTIVE = "case when regexp_matches(activity, '(?:\\d+\\s*)?(?:个?月|周|年)\\s*前活跃') then 'inactive' when activity = '在线' or ends_with(activity, '活跃') then 'active' else 'unknown' end"


def _post():
    return P.post_type("proxy_job", F.lit(""), "boss_title", "company_name")


@query(f"{_P} select job, {_POST} as post_type, {_RECRUIT} as recruit_type, {_ACTIVE} as active_state, nullif(split_part(location, '·', 2), '') as district from p")
def posting_types(spark, sf_dir):
    return postings(spark, sf_dir).select("job", _post().alias("post_type"), P.recruit_type("job_type", "title").alias("recruit_type"), P.active_state("activity").alias("active_state"), X.district("location").alias("district"))


@query("""with p as (select o_orderkey job, o_totalprice, substr(md5(concat('https://jobs.example/', o_orderkey)), 1, 16) job_id from orders) select job, job_id, substr(sha256(concat(job_id, '|', job)), 1, 32) as content_hash from p""")
def identities(spark, sf_dir):
    rows = postings(spark, sf_dir).select("job", X.posting_id("job_link", "title").alias("job_id"))
    return rows.withColumn("content_hash", X.content_hash("job_id", F.col("job").cast("string")))


@query(f"""{_P}, n as (select job, lower(regexp_replace(title, '[·・\\-—_、,，。;；:：!！?？()（）\\[\\]【】"''`\\s]+', '', 'g')) t, lower(company_name) c, replace(lower(location), '·', '') l from p)
select job, 'cn-' || substr(sha256(t || '|' || c || '|' || l), 1, 16) as canonical_id from n""")
def canonical_ids(spark, sf_dir):
    return postings(spark, sf_dir).select("job", X.canonical_id("title", "company_name", "location", unicode=False).alias("canonical_id"))


_LOW = "coalesce(try_cast(nullif(regexp_extract(salary, '(?i)(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)\\s*K', {i}), '') as double), round(try_cast(nullif(regexp_extract(salary, '(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)\\s*元/天', {i}), '') as double) * 22 / 1000, 1))"
_MONTHS = "coalesce(try_cast(nullif(regexp_extract(salary, '(\\d+)\\s*薪', 1), '') as integer), 12)"
_PAID = f"{_P}, q as (select *, {_LOW.format(i=1)} low, {_LOW.format(i=2)} high, {_MONTHS} as months, {_POST} as post, {_RECRUIT} as recruit from p)"


@query(f"{_PAID} select job, low, high, months, round(low * months, 1) as annual_low, round(high * months, 1) as annual_high from q")
def salary_ranges(spark, sf_dir):
    m, a = P.monthly_range("salary"), P.annual_range("salary")
    return postings(spark, sf_dir).select("job", m["low"].alias("low"), m["high"].alias("high"), P.months("salary").alias("months"), a["low"].alias("annual_low"), a["high"].alias("annual_high"))


@query(f"""{_P}, h as (select job, salary, trim(split_part(salary, '·', 1)) head from p), n as (select *, regexp_extract_all(head, '\\d+(?:\\.\\d+)?') ns, case when contains(head, '/天') then 'day' when contains(head, 'K') or contains(head, '元') then 'month' else '' end unit from h),
v as (select *, try_cast(ns[1] as double) lo, try_cast(ns[len(ns)] as double) hi from n), s as (select *, case when unit = 'month' and lo <= 999 then 1000 else 1 end k from v)
select job, case when salary not in ('', '面议') then lo * k end as low, case when salary not in ('', '面议') then hi * k end as high, case when salary not in ('', '面议') then unit end as unit, case when contains(salary, '薪') then 15 end as months from s""")
def salary_parts(spark, sf_dir):
    s = P.salary_parts("salary")
    return postings(spark, sf_dir).select("job", s["low"].alias("low"), s["high"].alias("high"), s["unit"].alias("unit"), s["months"].alias("months"))


def _direction_sql() -> str:
    blob = "lower(title || chr(10) || jd || chr(10) || array_to_string(list_filter(string_split(skill_text, ','), lambda x: x <> ''), ' '))"
    return f"""{_P}, h as (select job, list_filter({_list(R.ai_terms)}, lambda t: contains({blob}, lower(t))) ai, list_filter({_list(R.product_terms)}, lambda t: contains(lower(title), lower(t))) pm from p)
select job, case when len(ai) > 0 and len(pm) > 0 then 'ai_pm' when len(pm) > 0 then 'pm_only' when len(ai) > 0 then 'ai_other' else 'other' end as label,
array_to_string(case when len(ai) > 0 and len(pm) > 0 then list_sort(list_distinct(list_concat(ai, pm)))[1:6] when len(pm) > 0 then pm[1:4] else list_sort(list_distinct(ai))[1:4] end, ',') as evidence from h"""


@query(_direction_sql())
def directions(spark, sf_dir):
    d = P.direction("title", "jd", "skills")
    return postings(spark, sf_dir).select("job", d["label"].alias("label"), F.array_join(d["evidence"], ",").alias("evidence"))


_RISK = f"""{_P}, c as (select *, {_POST} post, list_filter(string_split(location, '·'), lambda x: x <> '') place, date_diff('day', cast(updated as date), date '1998-09-01') age from p)
select job, array_to_string(list_filter([case when post = 'anonymous' then 'agency_placeholder' end, case when len(place) = 1 then 'no_district' end, case when len(list_filter({_list(R.other_cities)}, lambda t: contains(company_name, t) and t <> place[1])) > 0 then 'other_base' end,
case when age > 30 then 'stale' end, case when {_any("lower(title || ' ' || substr(jd, 1, 400))", R.part_time_terms)} then 'part_time' end], lambda x: x is not null), ',') as flags from c"""


@query(_RISK)
def risk_marks(spark, sf_dir):
    p = postings(spark, sf_dir).withColumn("post", _post())
    return p.select("job", F.array_join(P.risk_flags("company_name", "title", "jd", "location", "post", "updated", F.to_date(F.lit("1998-09-01"))), ",").alias("flags"))


@query("""with m as (select o_orderpriority, quantile_cont(o_totalprice, 0.5) mid from orders group by 1)
select o_orderkey, o_totalprice > mid * 3.0 or o_totalprice < mid * 0.25 as outlier from orders join m using (o_orderpriority)""")
def peer_outliers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return quality.outliers(o, "o_orderpriority", "o_totalprice", R.outlier_low, R.outlier_high).select("o_orderkey", "outlier")


@query("""select doc_id, regexp_replace(text, '(?i)\\b(token|access_token|secret|password|api_key|sid|session|ticket)\\s*=\\s*"?[^&\\s"''<>]+"?', '\\1=***', 'g') as text from documents""")
def scrub_secrets(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", X.scrub_secrets("text").alias("text"))


@query(f"""with u as (select page_id, split_part(url, '#', 1) b from pages), q as (select page_id, split_part(b, '?', 1) base, list_filter(string_split(case when contains(b, '?') then substr(b, strpos(b, '?') + 1) else '' end, '&'), lambda x: x <> '' and not list_contains({_list(X.DROPPED_PARAMETERS)}, split_part(x, '=', 1))) ps from u)
select page_id, base || case when len(ps) > 0 then '?' || array_to_string(ps, '&') else '' end as url from q""")
def clean_urls(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.clean_url("url").alias("url"))


@query(f"{_P} select job, array_to_string(list_filter(list_transform(string_split(replace(concat(company_name, ' ｜ ', experience, '|', title), '｜', '|'), '|'), lambda x: trim(x)), lambda x: x <> ''), ' | ') as tags, case when trim(company_industry) <> '' then trim(company_industry) else company_name end as label from p")
def tag_lists(spark, sf_dir):
    p = postings(spark, sf_dir)
    return p.select("job", X.join_tags(X.split_tags(F.concat("company_name", F.lit(" ｜ "), "experience", F.lit("|"), "title"))).alias("tags"), X.first_filled("company_industry", "company_name").alias("label"))


# ---------------------------------------------------------------- filters


@query(f"""{_P}, r as (select case when {_RECRUIT} not in ('social', 'intern') then 'recruit_type' when contains(company_industry, '餐饮') then 'industry_block' when company_industry <> '' and not (contains(company_industry, '互联网') or contains(company_industry, '智能')) then 'industry_allow' when not (contains(lower(title), '产品') or contains(lower(title), 'ai')) then 'title' else 'kept' end as reason from p)
select reason, count(*) as "rows" from r group by 1""")
def relevance_filter(spark, sf_dir):
    p = postings(spark, sf_dir)
    reason = filters.relevance_reason(P.recruit_type("job_type", "title"), F.col("company_industry"), F.col("title"), ("social", "intern"), ("餐饮",), ("互联网", "智能"), ("产品", "AI"))
    return filters.reason_counts(p, reason)


def _cascade_sql() -> str:
    bare = "(^|[^a-z])ai([^a-z]|$)"
    says = lambda c: f"({_any(c, R.evidence_terms)} or regexp_matches({c}, '{bare}'))"
    skills = "lower(array_to_string(list_filter(string_split(skill_text, ','), lambda x: x <> ''), ' '))"
    cut = X.TITLE_CUTS.replace("'", "''")
    match = f"""(jd = '' or len(list_filter(list_filter(regexp_split_to_array(low, '{cut}'), lambda c: length(c) >= 2), lambda c: contains(b, c) or (regexp_matches(c, '[\\x{{4e00}}-\\x{{9fff}}]') and length(c) > 3 and len(list_filter(range(1, length(c)), lambda i: contains(b, substr(c, cast(i as integer), 2)))) > 0))) > 0)"""
    return f"""{_P}, a as (select *, lower(title) low, lower(jd) b, regexp_replace(lower(jd), '\\s+', '', 'g') key, {skills} sk, trim(regexp_extract(title, '^([^（(]*)', 1)) core from p),
e as (select *, {says('low')} titled, {says('low')} or {says('sk')} or {_any('b', R.evidence_terms)} or regexp_matches(regexp_replace(b, '{R.incidental}', '', 'g'), '{bare}') as evident, list_filter({_list(R.sales_body_terms)}, lambda t: contains(key, t)) hits from a)
select job, case when contains(low, 'fde') then 'keep' when {_any('low', R.sales_title_terms)} then 'sales'
when {_any('low', R.tech_title_terms)} and not (ends_with(core, '产品经理') or ends_with(core, '产品运营')) and not (contains(low, '解决方案') and titled) then 'tech'
when contains(low, '新媒体') then 'noise'
when ({_any('company_industry', R.company_industries)} or regexp_matches(company_name, '(?i)(人工智能|机器人|具身智能|智能体|(^|[^a-z])ai([^a-z]|$))')) and {_any('low', R.role_words)} and not {_any('low', R.company_title_excludes)} then 'keep'
when {_any('low', R.operations_terms)} and not contains(low, '产品') and not evident then 'noise'
when not {_any('low', R.role_words)} and not contains(low, 'aigc') then 'noise'
when trim(jd) = '' then 'keep'
when len(hits) > 0 and not (evident and len(list_filter(hits, lambda t: not list_contains({_list(R.pay_terms)}, t))) = 0) then 'sales'
when evident then 'keep' when not {match} then 'mismatch'
when {_any('low', R.solution_titles)} and not {_any('low', R.solution_excludes)} then 'keep' else 'noise' end as verdict from e"""


@query(_cascade_sql())
def junk_cascade(spark, sf_dir):
    return P.with_junk_reason(postings(spark, sf_dir)).select("job", F.coalesce("reason", F.lit("keep")).alias("verdict"))


@query(f"""{_P}, s as (select o_custkey c, arg_max(case when o_orderkey % 9 = 0 then '' when o_orderkey % 4 = 0 then '3月前活跃' else '今日活跃' end, o_orderkey) d from orders where o_custkey % 3 > 0 group by 1)
select job from p left join s on customer = c where not regexp_matches(coalesce(d, activity), '(?:\\d+\\s*)?(?:个?月|周|年)\\s*前活跃')""")
def without_inactive(spark, sf_dir):
    details = table(spark, sf_dir, "orders").where("o_custkey % 3 > 0").selectExpr("o_custkey as customer", "o_orderkey as turn", "case when o_orderkey % 9 = 0 then '' when o_orderkey % 4 = 0 then '3月前活跃' else '今日活跃' end as activity")
    return filters.without_inactive(postings(spark, sf_dir).select("job", "customer", "activity"), details, "customer", "activity", "turn").select("job")


@query(f"{_P} select job, array_to_string(list_filter([case when trim(title) = '' then 'title' end, case when trim(salary) = '' then 'salary' end, case when trim(jd) = '' then 'jd' end, case when trim(boss_title) = '' then 'boss_title' end], lambda x: x is not null), ',') as missing from p")
def required_fields(spark, sf_dir):
    return postings(spark, sf_dir).select("job", F.array_join(filters.missing_fields(["title", "salary", "jd", "boss_title"]), ",").alias("missing"))


# ---------------------------------------------------------------- summaries

_STATS = "count((low + high) / 2) as parsed, count(*) filter (low is null or high is null) as unparsed, quantile_cont((low + high) / 2, 0.5) as median, round(avg((low + high) / 2), 1) as mean, round(quantile_cont(low, 0.1), 1) as p10, round(quantile_cont(high, 0.9), 1) as p90"


@query(f"{_PAID} select 'all' as market, {_STATS} from q union all select 'direct', {_STATS} from q where post = 'direct' union all select 'agency', {_STATS} from q where post <> 'direct' union all select 'social_direct', {_STATS} from q where post = 'direct' and recruit = 'social'")
def salary_market(spark, sf_dir):
    p, m = postings(spark, sf_dir), P.monthly_range("salary")
    direct = _post() == "direct"
    return summary.markets(p, m["low"], m["high"], {"all": F.lit(True), "direct": direct, "agency": ~direct, "social_direct": direct & (P.recruit_type("job_type", "title") == "social")})


_BUCKET = "case when contains(experience, '应届') or contains(experience, '在校') then '应届/在校' when experience in ('1年以内', '1-3年') then '1-3年' when experience in ('3-5年', '5-10年', '10年以上') then experience when experience in ('经验不限', '不限经验') then '经验不限' else '未标注' end"


@query(f"{_PAID} select {_BUCKET} as bucket, {_STATS} from q group by 1")
def salary_by_experience(spark, sf_dir):
    p, m = postings(spark, sf_dir).withColumn("bucket", P.experience_bucket("experience")), P.monthly_range("salary")
    return summary.pay_stats(p, m["low"], m["high"], ["bucket"])


@query(f"""{_P}, v as (select 'experience' as dimension, experience as value from p union all select 'location', location from p union all select 'company', company_name from p union all select 'skill', unnest(string_split(skill_text, ',')) from p),
c as (select dimension, value, count(*) n from v where value <> '' group by 1, 2), r as (select *, row_number() over (partition by dimension order by n desc, value) as rank from c) select dimension, value, n, rank from r where rank <= 5""")
def dimension_topn(spark, sf_dir):
    return summary.top_values(postings(spark, sf_dir), {"experience": F.col("experience"), "location": F.col("location"), "company": F.col("company_name"), "skill": F.col("skills")}, 5)


@query("""with w as (select unnest(regexp_extract_all(text, '[A-Za-z][A-Za-z0-9+#]{3,29}')) as term from documents), c as (select term, count(*) n from w where term not in ('that', 'this', 'with', 'from') group by 1 order by n desc, term limit 60) select term, n from c where n >= 2""")
def term_frequency(spark, sf_dir):
    return summary.mine_terms(table(spark, sf_dir, "documents"), "text", "[A-Za-z][A-Za-z0-9+#]{3,29}", ["that", "this", "with", "from"], 60, 2)


_TERMS = ("the", "token", "license", "pour", "ciónta")


@query(" union all ".join(f"select '{t}' as term, count(*) filter (" + (f"regexp_matches(lower(text), '(^|[^a-z0-9+#]){t}([^a-z0-9+#]|$)')" if t.isascii() else f"contains(lower(text), '{t}')") + ") as docs from documents" for t in _TERMS))
def document_frequency(spark, sf_dir):
    return summary.document_frequency(table(spark, sf_dir, "documents"), "text", list(_TERMS))


@query("""with e as (select min(o_totalprice) lo, max(o_totalprice) hi from orders) select cast(case when hi = lo then 0 else least(11, floor((o_totalprice - lo) / ((hi - lo) / 12))) end as integer) as bin, count(*) as n from orders, e group by 1""")
def price_histogram(spark, sf_dir):
    return summary.histogram(table(spark, sf_dir, "orders"), "o_totalprice", 12)


@query("with g as (select o_orderpriority, count(*) have from orders group by 1) select o_orderpriority, have, greatest(0, 4000 - have) as gap, cast(ceil(greatest(0, 4000 - have) / 30) as bigint) as requests from g")
def supply_gap(spark, sf_dir):
    return summary.supply(table(spark, sf_dir, "orders"), "o_orderpriority", 4000, 30)


@query(f"""{_P}, k as (select lower(regexp_replace(title, '\\s+', '', 'g')) as key, title, count(*) c, min(job) first from p group by 1, 2) select key, cast(sum(c) as bigint) as n, arg_max(title, c * 1000000000000 - first) as display from k group by 1""")
def title_groups(spark, sf_dir):
    rows = postings(spark, sf_dir).groupBy(X.title_key("title", unicode=False).alias("key"), "title").agg(F.count("*").alias("c"), F.min("job").alias("first"))
    return rows.groupBy("key").agg(F.sum("c").alias("n"), F.max_by("title", F.struct("c", -F.col("first"))).alias("display"))


# ---------------------------------------------------------------- quality


@query("""select 'body_missing' as id, 'error' as level, count(*) filter (coalesce(trim(text), '') = '') as count from documents union all select 'body_short', 'error', count(*) filter (length(text) < 120) from documents
union all select 'lang_illegal', 'error', count(*) filter (lang not in ('en', 'de', 'fr')) from documents union all select 'length_drift', 'error', count(*) filter (n_chars <> length(text)) from documents union all select 'source_missing', 'warn', count(*) filter (source is null) from documents""")
def quality_findings(spark, sf_dir):
    checks = {"body_missing": ("error", F.coalesce(F.trim("text"), F.lit("")) == ""), "body_short": ("error", F.length("text") < R.least_body), "lang_illegal": ("error", ~F.col("lang").isin("en", "de", "fr")), "length_drift": ("error", F.col("n_chars") != F.length("text")), "source_missing": ("warn", F.col("source").isNull())}
    return quality.findings(table(spark, sf_dir, "documents"), checks)


@query("""with p as (select distinct o_custkey a, o_orderpriority b from orders where o_custkey is not null and o_orderpriority is not null) select 'o_custkey' as side, count(*) filter (n > 1) as keys from (select a, count(*) n from p group by 1)
union all select 'o_orderpriority', count(*) filter (n > 1) from (select b, count(*) n from p group by 1)""")
def one_to_one(spark, sf_dir):
    return quality.one_to_one(table(spark, sf_dir, "orders"), "o_custkey", "o_orderpriority")


@query(f"""with f as (select fp, case when doc_id % 3 = 0 then '' else lang end g from ({_PRINT})) select fp, count(*) as "rows", count(distinct g) as groups from f where fp <> '' group by 1 having count(*) > 1 and (count(distinct g) <> 1 or count(*) filter (coalesce(g, '') = '') > 0)""")
def unmarked_groups(spark, sf_dir):
    return quality.unmarked_groups(printed(spark, sf_dir).withColumn("g", F.expr("case when doc_id % 3 = 0 then '' else lang end")), "fp", "g")


@query("""with x as (select o_orderstatus r_s, case when o_orderkey % 5 = 0 then lower(o_orderstatus) when o_orderkey % 7 = 0 then 'Z' else o_orderstatus end c_s, case when o_orderkey % 2 = 0 then o_orderpriority end r_p, o_orderpriority c_p from orders),
v as (select 's' as field, case when coalesce(r_s, '') = '' then 'no_check' when r_s = c_s then 'exact' when lower(r_s) = lower(c_s) then 'normalised' else 'mismatch' end v from x union all select 'p', case when coalesce(r_p, '') = '' then 'no_check' when r_p = c_p then 'exact' else 'mismatch' end from x)
select field, count(*) filter (v = 'exact') as exact, count(*) filter (v = 'normalised') as normalised, count(*) filter (v = 'mismatch') as mismatch, count(*) filter (v = 'no_check') as no_check, round(count(*) filter (v in ('exact', 'normalised')) / nullif(count(*) filter (v <> 'no_check'), 0), 4) as rate from v group by 1""")
def field_fidelity(spark, sf_dir):
    pairs = table(spark, sf_dir, "orders").selectExpr("o_orderstatus as r_s", "case when o_orderkey % 5 = 0 then lower(o_orderstatus) when o_orderkey % 7 = 0 then 'Z' else o_orderstatus end as c_s", "case when o_orderkey % 2 = 0 then o_orderpriority end as r_p", "o_orderpriority as c_p")
    return quality.field_fidelity(pairs, ["s", "p"])


@query("""with d as (select doc_id, text, case when doc_id % 4 = 0 then substr(text, 1, 50) when doc_id % 4 = 1 then upper(text) else text end body from documents), k as (select doc_id, regexp_replace(text, '\\s+', '', 'g') r, regexp_replace(body, '\\s+', '', 'g') b from d)
select doc_id, case when not contains(r, b) then 'error' when length(b) < 0.6 * length(r) then 'warn' else 'ok' end as verdict from k""")
def body_fidelity(spark, sf_dir):
    d = table(spark, sf_dir, "documents").withColumn("body", F.expr("case when doc_id % 4 = 0 then substr(text, 1, 50) when doc_id % 4 = 1 then upper(text) else text end"))
    return d.select("doc_id", quality.containment(F.col("text"), F.col("body"), R.fidelity_length).alias("verdict"))


@query("""with p as (select p_partkey prop, p_brand r from part), e as (select l_partkey prop from lineitem where l_quantity > 49)
select r as requirement, count(distinct prop) as properties, coalesce(sum(n), 0)::bigint as examples, coalesce(sum(n), 0) = 0 as gap from p left join (select prop, count(*) n from e group by 1) using (prop) group by 1""")
def coverage_matrix(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("property"), F.col("p_brand").alias("requirement"))
    e = table(spark, sf_dir, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("property"))
    return quality.matrix(p.select("requirement").distinct(), p, e)


# ---------------------------------------------------------------- histories


@query("with r as (select event_id, user_id, row_number() over (partition by user_id order by ts desc, event_id desc) turn from events) select event_id, user_id, turn, case when turn = 1 then 'active' else 'superseded' end as status from r")
def supersede(spark, sf_dir):
    e = events(spark, sf_dir).select("event_id", "user_id", "ts")
    return rollups.supersede(e, "user_id", [F.desc("ts"), F.desc("event_id")]).drop("ts")


@query("with r as (select event_id, user_id, row_number() over (partition by user_id order by ts desc, event_id desc) turn from events) select event_id, user_id, turn from r where turn <= 3")
def keep_newest(spark, sf_dir):
    return rollups.keep_newest(events(spark, sf_dir).select("event_id", "user_id", "ts"), "user_id", [F.desc("ts"), F.desc("event_id")], 3).drop("ts")


_VERSION_SETS = """with o as (select c_custkey k from customer where c_custkey % 3 <> 0), n as (select c_custkey k from customer where c_custkey % 4 <> 0), b as (select c_custkey k from customer where c_custkey % 5 = 0), d as (select c_custkey k from customer where c_custkey % 8 = 0), x as (select c_custkey k from customer where c_custkey % 12 = 4)"""


def _sets(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return c.where("k % 3 <> 0"), c.where("k % 4 <> 0"), c.where("k % 5 = 0").withColumn("reason", F.lit("sales")), c.where("k % 8 = 0").withColumn("reason", F.lit("tech")), c.where("k % 12 = 4")


@query(f"""{_VERSION_SETS}, f as (select coalesce(o.k, n.k) k, case when o.k is null then 'added' else 'removed' end change from o full join n on o.k = n.k where o.k is null or n.k is null)
select k, change, case when change = 'added' and k in (select k from b) then 'rule_dropped_before' when change = 'added' then 'new' when k in (select k from d) then 'rule:tech' when k in (select k from x) then 'no_body' else 'vanished' end as reason from f""")
def version_diff(spark, sf_dir):
    old, new, before, now, bare = _sets(spark, sf_dir)
    return rollups.diff_with_reasons(old, new, "k", before, now, bare)


@query(f"""{_VERSION_SETS}, s as (select k, 0 p, 'kept' a from n union all select k, 1, 'dropped' from d union all select k, 2, 'no_body' from x union all select k, 3, 'kept_before' from o union all select k, 4, 'store_only' from (select c_custkey k from customer))
select k, arg_min(a, p) as answer from s group by 1""")
def why(spark, sf_dir):
    old, new, _, now, bare = _sets(spark, sf_dir)
    everything = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return rollups.first_evidence([("kept", new), ("dropped", now), ("no_body", bare), ("kept_before", old), ("store_only", everything)], "k")


@query("""with w as (select time_bucket(interval '1 hour', ts) as start, count(*) total, count(*) filter (event_type = 'error') failed from events group by 1), r as (select *, failed / total as rate, cast(start as date) as day from w),
a as (select *, rate > 0.2 as over from r)
select start, total, failed, rate, coalesce(min(case when over then 1 else 0 end) over (partition by day order by start rows between 1 preceding and current row) = 1 and count(*) over (partition by day order by start rows between 1 preceding and current row) = 2, false) as alarm from a""")
def failure_windows(spark, sf_dir):
    return rollups.failure_windows(events(spark, sf_dir), "ts", F.col("event_type") == "error", 3600, 0.2, 2)


@query("""select event_id, user_id, count(*) over w as recent, count(*) over w >= 3 as blocked from events window w as (partition by user_id order by ts range between interval '6 hours' preceding and current row)""")
def burst_windows(spark, sf_dir):
    return rollups.burst(events(spark, sf_dir).select("event_id", "user_id", "ts"), "user_id", "ts", 6 * 3600, 3).drop("ts")


@query("""with e as (select event_id, user_id, ts, cast(ts as date) as d from events), f as (select d, user_id, min((ts, event_id)) first from e group by 1, 2), r as (select *, row_number() over (partition by d order by first) nth from f)
select event_id, case when nth > 40 then 'exhausted' when (ts, event_id) = first then 'ok' else 'duplicate' end as outcome from e join r using (d, user_id)""")
def daily_budget(spark, sf_dir):
    return rollups.daily_budget(events(spark, sf_dir).select("event_id", "user_id", "ts"), "user_id", "ts", "event_id", 40).select("event_id", "outcome")


@query("""select cast(ts as date) as day, count(*) as runs, count(*) filter (event_type <> 'error') as ok, count(*) filter (event_type = 'error') as failed, round(sum(value), 2) as total, max(ts) as latest from events group by 1""")
def run_rollup(spark, sf_dir):
    e = events(spark, sf_dir)
    return e.groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("runs"), F.count_if(F.col("event_type") != "error").alias("ok"), F.count_if(F.col("event_type") == "error").alias("failed"), F.round(F.sum("value"), 2).alias("total"), F.max("ts").alias("latest"))


@query("""with p as (select user_id, min(event_id) p from events where ts < timestamp '2024-01-10' group by 1), c as (select user_id, min(event_id) c from events where ts >= timestamp '2024-01-20' group by 1), k as (select distinct user_id from events where event_type = 'purchase' and ts >= timestamp '2024-01-25')
select user_id, p is null as fresh, coalesce(p, c) as turn from c left join p using (user_id) where user_id not in (select user_id from k)""")
def resume_queue(spark, sf_dir):
    e = events(spark, sf_dir)
    return rollups.resume_queue(e.where("ts < '2024-01-10'"), e.where("ts >= '2024-01-20'"), e.where("event_type = 'purchase' and ts >= '2024-01-25'"), "user_id", "event_id")


@query()
def failure_ledger(spark, sf_dir):
    """An ordered fold for each key, which SQL can't express."""
    e = events(spark, sf_dir).select(F.col("user_id").alias("key"), F.unix_timestamp("ts").alias("at"), F.date_format("ts", "yyyy-MM-dd").alias("run"), F.when(F.col("value") > 50, "structural").otherwise("transient").alias("nature"), F.when(F.col("event_type") == "error", "failure").otherwise("probe").alias("kind"))
    return rollups.fold_ledger(e)


# ---------------------------------------------------------------- activity, codes, audits

_RANK = "coalesce(list_position(" + _list(P.ACTIVITY_ORDER) + ", {c}), 0)"
_DETAIL_ACTIVITY = "split_part('今日活跃|在线||本周活跃|别的', '|', cast(o_orderkey % 5 as int) + 1)"


@query(f"""with p as (select o_orderkey job, {_DETAIL_ACTIVITY} d, split_part('在线|刚刚活跃||2周内活跃', '|', cast(o_custkey % 4 as int) + 1) l from orders)
select job, case when d = '' then l when l = '' then d when {_RANK.format(c='d')} > {_RANK.format(c='l')} then d else l end as activity from p""")
def activity_merge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey as job", f"{_DETAIL_ACTIVITY} as d", "split_part('在线|刚刚活跃||2周内活跃', '|', cast(o_custkey % 4 as int) + 1) as l")
    return o.select("job", P.more_precise("l", "d").alias("activity"))


@query("""with e as (select event_id, cast(event_id % 40 as varchar) as code, case when event_id % 3 = 0 then 'session expired' else '' end as m, event_id % 5 as attempt from events)
select event_id, case when code = '37' then case when m <> '' then 'token_expired' else 'env_risk' end when code = '0' then 'ok' when code = '9' then 'rate_limited' when code in ('17', '19') then 'invalid_params' when code in ('31', '35', '38') then 'env_risk' when code = '36' then 'account_risk' else 'unknown' end as kind, cast(least(60, 10 * power(2, attempt)) as double) as wait from e""")
def response_codes(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", "cast(event_id % 40 as string) as code", "case when event_id % 3 = 0 then 'session expired' else '' end as m", "event_id % 5 as attempt")
    return e.select("event_id", P.response_kind("code", "m").alias("kind"), P.backoff("attempt").alias("wait"))


@query(_direction_sql().replace("select job, case when len(ai) > 0 and len(pm) > 0 then 'ai_pm'", "select * from (select job, case when len(ai) > 0 and len(pm) > 0 then 'ai_pm'") .replace("with p as (", "with a as (with p as (", 1) + """)), t as (select count(*) total, count(*) filter (label = 'ai_pm') wanted from a), h as (select count(*) filter (o_orderkey % 12 in (0, 1, 7)) hits from orders)
select total, hits, wanted, round(hits / total, 4) as hit_rate, round(1 - wanted / total, 4) as off_rate, array_to_string(list_filter([case when round(hits / total, 4) < 0.6 then 'few_hits' end, case when round(1 - wanted / total, 4) > 0.4 then 'off_direction' end], lambda x: x is not null), ',') as warnings from t, h""")
def list_audit(spark, sf_dir):
    p = postings(spark, sf_dir)
    return quality.list_audit(p, P.direction("title", "jd", "skills")["label"], X.contains_any(F.lower("title"), ("产品经理", "产品运营")))


@query(f"""{_P} select company_name, count(*) as "rows", round(avg(cast(contains(title, '产品') as int)), 4) as root_rate, round(avg(cast(starts_with(location, '杭州') as int)), 4) as city_rate,
case when count(*) <> max(case when customer % 8 = 3 then 1 else 0 end) + count(*) then 'count' when round(avg(cast(contains(title, '产品') as int)), 4) < 0.3 then 'root' when round(avg(cast(starts_with(location, '杭州') as int)), 4) < 0.5 then 'city' else 'ok' end as verdict from p group by 1""")
def delivery_rates(spark, sf_dir):
    p = postings(spark, sf_dir)
    n = p.groupBy(F.col("company_name").alias("_c")).agg((F.count("*") + F.max(F.expr("case when customer % 8 = 3 then 1 else 0 end"))).alias("declared"))
    return quality.delivery_rates(p.join(n, F.col("company_name") == F.col("_c")), "company_name", F.col("title").contains("产品"), F.col("location").startswith("杭州"), F.col("declared"), 0.3, 0.5)


@query("""select props, count(*) as n, cast(count(distinct user_id) as bigint) as users, max_by(event_type, (ts, event_id)) as last_type from (select cast(json_extract(props, '$.k') as integer) as props, user_id, event_type, ts, event_id from events) group by 1""")
def payload_rollup(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("props", F.get_json_object("props", "$.k").try_cast("int"))
    return e.groupBy("props").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"), F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"))


@query("""with d as (select * from events where cast(ts as date) = date '2024-01-20'), k as (select event_type, min((ts, event_id)) t from d group by 1), p as (select user_id, count(*) n from d group by 1)
select (select count(*) from d) as runs, (select count(*) from d where event_type = 'error') as failed, (select string_agg(event_type, ',' order by t) from k) as keywords, (select arg_min(user_id, (-n, user_id)) from p) as place, (select count(*) from p where user_id not in (select user_id from events where cast(ts as date) < date '2024-01-20')) as new_places""")
def daily_brief(spark, sf_dir):
    from sievework.plans.reports import brief

    return brief(events(spark, sf_dir), F.to_date(F.lit("2024-01-20")), "ts", "event_type", "user_id", F.col("event_type") == "error", "event_id").withColumnRenamed("user_id", "place")


@query("""select 'events' as name, count(*) as "rows", max(strftime(date_trunc('second', ts), '%Y-%m-%d')) as latest from events union all select 'orders', count(*), max(strftime(o_orderdate, '%Y-%m-%d')) from orders""")
def store_status(spark, sf_dir):
    from sievework.plans.reports import status

    e, o = events(spark, sf_dir).withColumn("day", F.to_date("ts")), table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return status({"events": (e, "day"), "orders": (o, "day")})


from sievework.plans import acceptance_queries, ask_queries, record_queries, scope_queries, summary_queries  # noqa: E402, F401

__all__ = ["ORACLE_SQL", "QUERIES"]
