"""Queries of summaries: frequency tables, top pay, terms, channels, funnels, reports, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import postings as P
from sievework.functions import records as C
from sievework.operators import quality, rollups, summary
from sievework.plans import reports
from sievework.plans.record_queries import SQL_DEGREE, SQL_EXPERIENCE, sql_first_tag, sql_tags
from sievework.plans.registry import events, query, sql_list
from sievework.plans.tables import posting_sql, postings, table

_P = f"with p as ({posting_sql()})"
_SKILLS = f"list_filter({sql_tags('tags')}, lambda x: not {SQL_EXPERIENCE} and not {SQL_DEGREE}) || list_filter(string_split(skill_text, ','), lambda x: x <> '') || {sql_tags('job_labels')}"
_TERMS = ("大模型", "AI产品", "运营", "SQL", "ai")
_DIMENSIONS = {
    "salary": "[case when trim(salary) = '' then '未标注' else salary end]",
    "experience": f"[{sql_first_tag(SQL_EXPERIENCE, 'experience', 'tags', 'job_labels')}]",
    "degree": f"[{sql_first_tag(SQL_DEGREE, 'education', 'tags', 'job_labels')}]",
    "district": "[split_part(location, '·', 2)]",
    "company": "[case when trim(company_name) <> '' then trim(company_name) else trim(boss_name) end]",
    "scale": "[company_scale]",
    "stage": "[company_stage]",
    "industry": "[company_industry]",
    "welfare": "list_transform(string_split(welfare, ' | '), lambda x: trim(x))",
    "icon": "[case when icon_word <> '' then icon_word else split_part(icon_flags, '|', 1) end]",
    "skill": _SKILLS,
    "term": "list_filter(" + sql_list(_TERMS) + ", lambda t: case when t in ('SQL', 'ai') then regexp_matches(lower(jd), '(^|[^a-z0-9+#])' || lower(t) || '([^a-z0-9+#]|$)') else contains(lower(jd), lower(t)) end)",
    "recruit_type": "[case when job_type = '4' then 'intern' when job_type = '5' then 'campus' when job_type = '' and contains(title, '实习') then 'intern' else 'social' end]",
    "post_type": "[case when proxy_job <> '' or boss_title = '猎头顾问' then 'agency' else 'other' end]",
}


@query(_P + ", v as (" + " union all ".join(f"select '{n}' as dimension, unnest({e}) as value, job from p" for n, e in _DIMENSIONS.items()) + "), c as (select dimension, value, count(*) n, min(job) f from v where coalesce(value, '') <> '' group by 1, 2), r as (select *, row_number() over (partition by dimension order by n desc, f, value) as rank from c) select dimension, value, n, rank from r where rank <= 8")
def frequency_tables(spark, sf_dir):
    p = postings(spark, sf_dir).withColumns({"recruit_type": P.recruit_type("job_type", "title"), "post_type": F.expr("case when proxy_job <> '' or boss_title = '猎头顾问' then 'agency' else 'other' end")})
    return summary.top_values(p, summary.posting_dimensions("skills", list(_TERMS)), 8, "job")


_LOW = "coalesce(try_cast(nullif(regexp_extract(salary, '(?i)(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)\\s*K', 2), '') as double), round(try_cast(nullif(regexp_extract(salary, '(\\d+(?:\\.\\d+)?)\\s*-\\s*(\\d+(?:\\.\\d+)?)\\s*元/天', 2), '') as double) * 22 / 1000, 1))"


@query(f"{_P} select job, title, salary, company_name as company, {_LOW} as high from p where {_LOW} is not null order by high desc, job limit 15")
def top_pay(spark, sf_dir):
    return summary.top_pay(postings(spark, sf_dir).withColumn("company", F.col("company_name")), "job", ["title", "salary", "company"], 15)


@query("""with w as (select unnest(regexp_extract_all(regexp_replace(text, '[^ -~\n]', ' ', 'g'), '\\b[A-Za-z][A-Za-z0-9._-]{1,29}\\b|[\\x{4e00}-\\x{9fff}]{2,6}')) t, doc_id from documents), c as (select t, count(*) n, min(doc_id) f from w where t not in ('the', 'and') group by 1 order by n desc, f, t limit 40), d as (select t, n, f from c where n >= 2), o as (select 'Spark' as term, 0 as p, 0::bigint n, 0::bigint f union all select 'the', 1, 0, 0 union all select t, 2, n, f from d),
m as (select term, min(p) p, max(n) n, min(f) f from o group by 1) select term, p as kind from m""")
def mined_terms(spark, sf_dir):
    return summary.all_terms(table(spark, sf_dir, "documents").withColumn("text", F.regexp_replace("text", "[^ -~\\n]", " ")), "text", "doc_id", ["Spark"], ["the"], ["the", "and"], 40, 2)


@query(f"""{_P}, t as (select job, unnest(string_split(jd, ' ')) t from p), w as (select job, case when regexp_matches(t, '^[A-Za-z][A-Za-z0-9._-]*$') then [t] else regexp_extract_all(t, '[\\x{{4e00}}-\\x{{9fff}}]{{2,6}}') end w from t), v as (select job, unnest(w) t from w),
c as (select t, count(*) n, min(job) f from v where t not in ('负责', 'SQL') group by 1 order by n desc, f, t limit 12), o as (select '大模型' as term, 0 as p union all select '社区内容', 1 union all select t, 2 from c where n >= 2) select term, min(p) as kind from o group by 1""")
def mined_posting_terms(spark, sf_dir):
    return summary.all_terms(postings(spark, sf_dir), "jd", "job", ["大模型"], ["社区内容", "短"], ["负责", "SQL"], 12, 2)


_WORDS = "unnest(regexp_split_to_array(text, '[ \\n]+')) as word"


@query(f"with w as (select coalesce(lang, '') as lang, doc_id, {_WORDS} from documents), c as (select lang, word, count(*) n, min(doc_id) f from w where word <> '' group by all), r as (select lang, word, n, row_number() over (partition by lang order by n desc, f, word) as rank from c) select * from r where rank <= 25")
def frequent_words(spark, sf_dir):
    words = table(spark, sf_dir, "documents").select(F.coalesce("lang", F.lit("")).alias("lang"), "doc_id", F.explode(F.split("text", "[ \\n]+")).alias("word"))
    return summary.frequent_values(words, "lang", "word", 25, "doc_id")


@query("with w as (select event_type, user_id, event_id from events), c as (select event_type, cast(user_id as varchar) user_id, count(*) n, min(event_id) f from w where user_id is not null group by all), r as (select event_type, user_id, n, row_number() over (partition by event_type order by n desc, f, user_id) as rank from c) select * from r where rank <= 10")
def frequent_users(spark, sf_dir):
    # so few are tracked that the sketch alone can't decide, and groups are counted in full
    return summary.frequent_values(events(spark, sf_dir), "event_type", "user_id", 10, "event_id", tracked=64)


@query("with b as (select event_type, case event_id % 3 when 0 then 'api' when 1 then 'dom' else 'other' end c, value > 30 ok from events), u as (select event_type, count(distinct c) filter (ok and c in ('api', 'dom')) k, min(c) filter (ok and c in ('api', 'dom')) m, count(*) filter (ok and c = 'api') api, count(*) filter (ok and c = 'dom') dom from b group by 1) select event_type, case when k = 0 then 'unknown' when k = 1 then m else 'mixed' end as channel, api, dom from u")
def channels(spark, sf_dir):
    b = table(spark, sf_dir, "events").selectExpr("event_type", "case event_id % 3 when 0 then 'api' when 1 then 'dom' else 'other' end as c", "value > 30 as ok")
    return summary.channels(b, "event_type", F.col("c"), F.col("ok"), ("api", "dom"))


@query("""with e as (select cast(ts as date) as day, event_type <> 'error' ok, case when event_type = 'error' then case when event_id % 3 = 0 then 'session' else 'timeout' end end reason, value from events), r as (select day, reason, count(*) n from e where not ok group by 1, 2), s as (select day, string_agg(reason || ':' || n, ',' order by reason) reasons, max(n) filter (reason = 'session') s from r group by 1)
select day, count(*) as total, count(*) filter (ok) as ok, count(*) filter (not ok) as failed, coalesce(any_value(reasons), '') as reasons, cast(ceil(sum(value) / count(*)) as bigint) as seconds, count(*) filter (not ok) >= 5 and coalesce(any_value(s), 0) > 0.5 * count(*) filter (not ok) as drift from e left join s using (day) group by 1""")
def run_summaries(spark, sf_dir):
    e = events(spark, sf_dir).select(F.to_date("ts").alias("day"), (F.col("event_type") != "error").alias("ok"), F.expr("case when event_type = 'error' then case when event_id % 3 = 0 then 'session' else 'timeout' end end").alias("reason"), "value")
    return summary.run_summary(e, "day", F.col("ok"), "reason", "value", "session")


@query(f"{_P}, m as (select job, title, jd, customer from p), d as (select o_custkey customer, bool_or(o_orderstatus = 'F' and o_orderpriority = '1-URGENT') bad from orders group by 1) select count(*) as total, count(*) filter (not contains(jd, '产品') or coalesce(bad, false)) as mismatched from m left join d using (customer)")
def mismatched_jobs(spark, sf_dir):
    details = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("customer"), ((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")).alias("bad"))
    return summary.mismatches(postings(spark, sf_dir), details, "customer", ~F.col("jd").contains("产品"), F.col("bad"))


@query(f"{_P} select count(*) as kept, (select count(*) from orders where o_orderstatus = 'F') as filtered, count(*) + (select count(*) from orders where o_orderstatus = 'F') as input, round(count(*) / (count(*) + (select count(*) from orders where o_orderstatus = 'F')), 4) as share from p where trim(jd) <> ''")
def reconciled_input(spark, sf_dir):
    return summary.reconciled(postings(spark, sf_dir).where("trim(jd) <> ''"), table(spark, sf_dir, "orders").where("o_orderstatus = 'F'"))


@query("with p as (select o_orderpriority, o_orderstatus, count(*) n from orders group by 1, 2) select 'o_orderpriority' as dimension, o_orderpriority as value, cast(sum(n) as bigint) as n from p group by 2 union all select 'o_orderstatus', o_orderstatus, cast(sum(n) as bigint) from p group by 2")
def distributions(spark, sf_dir):
    return summary.distributions(table(spark, sf_dir, "orders"), ["o_orderpriority", "o_orderstatus"])


@query("with v as (select o_orderkey, cast(floor(o_totalprice / 20000) as double) v from orders), e as (select min(v) lo, max(v) hi, least(12, greatest(5, count(distinct v))) bins from v) select cast(case when hi = lo then 0 else least(bins - 1, floor((v - lo) / ((hi - lo) / bins))) end as integer) as bin, count(*) as n from v, e group by 1")
def pay_histogram(spark, sf_dir):
    return summary.histogram(table(spark, sf_dir, "orders").select(F.floor(F.col("o_totalprice") / 20000).cast("double").alias("v")), "v")


@query("select o_orderkey, o_totalprice, o_orderpriority from orders where o_orderpriority <> '1-URGENT' order by o_orderkey limit 8")
def off_direction_samples(spark, sf_dir):
    return quality.samples(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), F.col("o_orderpriority") != "1-URGENT", "o_orderkey", 8)


@query("with t as (select o_orderkey, o_orderstatus from orders) select count(*) as rows_all, count(*) filter (o_orderstatus = 'P') > 0 as usable from t")
def usable_sample(spark, sf_dir):
    return quality.usable(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "P")


@query("select event_id, user_id, ts from events order by ts desc, event_id limit 25")
def recent_runs(spark, sf_dir):
    return rollups.recent(events(spark, sf_dir).select("event_id", "user_id", "ts"), "ts", "event_id", 25)


@query("select event_id, event_type from events order by event_id desc limit 30")
def last_lines(spark, sf_dir):
    return rollups.last_lines(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_id", 30)


@query("""with o as (select c_custkey k from customer where c_mktsegment <> 'BUILDING'), n as (select c_custkey k from customer where c_nationkey < 20), f as (select coalesce(o.k, n.k) k, case when o.k is null then 'added' else 'removed' end change from o full join n on o.k = n.k where o.k is null or n.k is null), r as (select *, row_number() over (partition by change order by k) n, count(*) over (partition by change) total from f) select k, change, total, total > 10 as truncated from r where n <= 10""")
def truncated_diff(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old, new = c.where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("k")), c.where("c_nationkey < 20").select(F.col("c_custkey").alias("k"))
    return rollups.truncated(rollups.changed_keys(old, new, "k"), "change", "k", 10)


@query("with f as (select event_type as path, min(ts) as created from events group by 1), r as (select *, row_number() over (order by created, path) as turn from f) select path, created, turn from r")
def replay_order(spark, sf_dir):
    f = events(spark, sf_dir).groupBy(F.col("event_type").alias("path")).agg(F.min("ts").alias("created"))
    return rollups.replay_order(f, "created", "path")


@query("select 'events' as name, count(*) as \"rows\", count(distinct user_id) as keys, (select count(*) from (select user_id from events group by 1 having count(*) > 1)) as repeated, max(strftime(ts, '%Y-%m-%d')) as latest from events")
def store_statistics(spark, sf_dir):
    return summary.table_statistics(events(spark, sf_dir).withColumn("day", F.to_date("ts")), "events", "user_id", "day")


@query("with e as (select cast(ts as date) d, * from events), u as (select count(distinct user_id) used from e where d = date '2024-01-20') select (select count(*) from e where d = date '2024-01-20') as list_rows, (select count(*) from e where d = date '2024-01-20' and event_type = 'purchase') as detail_rows, (select count(*) from e where d = date '2024-01-20' and event_type = 'purchase' and value > 50) as with_body, (select count(*) from e where d = date '2024-01-20' and event_type = 'error') as failures, used, greatest(0, 700 - used) as budget_left from u")
def run_report(spark, sf_dir):
    e = events(spark, sf_dir).where("to_date(ts) = '2024-01-20'")
    bought = e.where("event_type = 'purchase'").withColumn("jd", F.expr("case when value > 50 then 'x' end"))
    return reports.run_report(e, bought, e.where("event_type = 'error'"), e.agg(F.count_distinct("user_id").alias("used")), 700)


@query("""with e as (select *, cast(ts as date) d from events), n as (select user_id from e group by 1 having min(d) = date '2024-01-01'), p as (select user_id, event_type from e where d = date '2024-01-01'), t as (select event_type, count(distinct user_id) c from p where user_id in (select user_id from n) group by 1)
select (select count(*) from n) as new_jobs, (select count(distinct user_id) from p where event_type = 'purchase' and user_id in (select user_id from n)) as new_in_product, (select coalesce(string_agg(event_type || ':' || c, ',' order by c desc, event_type), '') from t) as by_type""")
def new_today(spark, sf_dir):
    e = events(spark, sf_dir).withColumn("day", F.to_date("ts"))
    return reports.new_on(e, "user_id", "day", F.to_date(F.lit("2024-01-01")), "event_type", e.where("event_type = 'purchase' and day = '2024-01-01'"))


@query("with s as (select o_orderpriority, count(*) todo from orders group by 1), r as (select *, greatest(0, 3500 - todo) gap from s) select o_orderpriority, todo, gap, cast(case when gap > 0 then greatest(1, ceil(gap / 240)) else 0 end as bigint) as combos, least(todo, 3500) as ceiling from r")
def supply_plan(spark, sf_dir):
    return summary.supply_plan(table(spark, sf_dir, "orders"), "o_orderpriority", 3500, 240)


@query("with p as (select c_custkey p, c_mktsegment r from customer where c_mktsegment <> 'MACHINERY'), e as (select o_custkey p from orders where o_orderpriority = '1-URGENT'), q as (select distinct c_mktsegment r from customer where c_mktsegment <> 'BUILDING') select 'property' as kind, count(distinct p.p) as orphans from p where r not in (select r from q) union all select 'example', count(*) from e where p not in (select p from p) ")
def matrix_orphans(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    p = c.where("c_mktsegment <> 'MACHINERY'").selectExpr("c_custkey as property", "c_mktsegment as requirement")
    e = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").selectExpr("o_custkey as property")
    return quality.orphans(c.where("c_mktsegment <> 'BUILDING'").selectExpr("c_mktsegment as requirement").distinct(), p, e)


@query(f"{_P} select job, array_to_string(list_filter({_SKILLS}, lambda x: x not in ('双休', '沟通')), '|') as s from p")
def skill_mentions(spark, sf_dir):
    return postings(spark, sf_dir).select("job", F.array_join(C.skill_mentions("skills", stop=("双休", "沟通")), "|").alias("s"))
