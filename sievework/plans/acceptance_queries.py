"""Queries of the acceptance checks, over postings with planted violations of every kind."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import postings as P
from sievework.functions import text as X
from sievework.operators import acceptance
from sievework.plans.registry import query, sql_any, sql_list
from sievework.plans.tables import posting_sql, postings
from sievework.ruleset import DEFAULT as R

_HIDDEN = "(" + " or ".join(f"starts_with(company_name, '{s}')" for s in R.anonymous_starts) + ")"
_POST = f"case when proxy_job <> '' or boss_title = '猎头顾问' then 'agency' when {_HIDDEN} or {sql_any('company_name', R.fragile_terms)} then 'anonymous' else 'direct' end"
_RECRUIT = "case when job_type = '4' then 'intern' when job_type = '5' then 'campus' when job_type = '' and contains(title, '实习') then 'intern' else 'social' end"
_ACTIVE = "case when regexp_matches(activity, '(?:\\d+\\s*)?(?:个?月|周|年)\\s*前活跃') then 'inactive' when activity = '在线' or ends_with(activity, '活跃') then 'active' else 'unknown' end"

#: Columns of a record made of a posting, in SQL that Spark and DuckDB share; {post}, {recruit} and {active} are what the rules say. Each has planted slips.
_RECORD = {
    "job_id": "case when job % 89 = 5 then 'kept twice' when job % 97 = 0 then 'ffffffffffffffff' when job % 103 = 0 then '' else substr(md5(job_link), 1, 16) end",
    "company_link": "''",
    "jd": "case when job % 107 = 0 then concat(jd, ' 薪资详情') when job % 109 = 0 then repeat(jd, 30) else jd end",
    "salary_source": "case job % 4 when 0 then 'api' when 1 then 'api_empty' else '' end",
    "salary_min": "case when job % 79 = 0 then 10 end",
    "salary_max": "cast(null as int)",
    "salary_unit": "case when job % 31 = 0 then 'day' else '' end",
    "months_per_year": "cast(null as int)",
    "boss_active_status": "activity",
    "job_valid_status": "case job % 5 when 0 then '2' when 1 then '1' else '' end",
    "proxy_type": "case when job % 17 = 0 then 'false' else '' end",
    "post_type": "case when job % 53 = 0 then 'direct' when job % 59 = 0 then '' when job % 61 = 0 then 'other' else {post} end",
    "recruit_type": "case when job % 67 = 0 then 'campus' else {recruit} end",
    "active_state": "case when job % 71 = 0 then 'active' else {active} end",
    "title_key": "case when job % 73 = 0 then 'zzz' else lower(title) end",
    "link_verified_at": "case job % 6 when 0 then '' when 1 then 'soon' when 2 then '2024-01-05T10:00:00' when 3 then '2024-01-05T10:00:00+08:00' else '2024-01-30T00:00:00+00:00' end",
    "dup_group": "case when job % 3 = 0 then concat('dup-', customer % 50) else '' end",
    "dup_size": "case when job % 3 = 0 then 4 when job % 11 = 0 then 2 else 1 end",
    "is_primary": "job % 3 <> 0 and job % 13 <> 0 or job % 6 = 0",
}
_SAME = tuple("job job_link title company_name company_industry company_scale company_stage location salary boss_title proxy_job job_type customer".split())
#: As JSON: keys that no one registered, one that is forbidden, and values of another kind.
#: Secrets planted at three depths: in an object, in an object of a list's object, and in a URL that stands in a URL.
_PLANTED = "case when job % 19 = 0 then ',\"note\":{\"authToken\":\"x\"}' when job % 19 = 1 then ',\"more\":[{\"deep\":{\"cookie_jar\":[1]}}]' when job % 19 = 2 then ',\"company_link\":\"https://x.example/?a=1&next=https%3A%2F%2Fy.example%2F%3Fsession_id%3D1#wt2=2\"' else '' end"
_PAYLOAD = f"concat('{{\"job_id\":\"', job, '\",\"skills\":', case job % 4 when 0 then '[\"a\"]' when 1 then '\"a\"' when 2 then 'null' else '[]' end, case when job % 5 = 0 then ',\"lid\":\"x\"' else '' end, case when job % 7 = 0 then ',\"mood\":1,\"jd\":[\"x\"]' else ',\"jd\":\"x\"' end, {_PLANTED}, '}}')"


def record_sql() -> str:
    made = ", ".join(f"{e.format(post=_POST, recruit=_RECRUIT, active=_ACTIVE)} as {n}" for n, e in _RECORD.items())
    return f"select {', '.join(_SAME)}, {made}, {_PAYLOAD} as payload from ({posting_sql()})"


def records(spark, sf_dir):
    p = postings(spark, sf_dir).withColumns({"_post": P.post_type("proxy_job", F.lit(""), "boss_title", "company_name"), "_recruit": P.recruit_type("job_type", "title"), "_active": P.active_state("activity")})
    made = [f"{e.format(post='_post', recruit='_recruit', active='_active')} as {n}" for n, e in _RECORD.items()]
    return p.selectExpr(*_SAME, *made, f"{_PAYLOAD} as payload")


def _sql_says(name: str) -> str:
    return f"coalesce(trim(cast({name} as varchar)), '')"


def _sql_expected(spec: acceptance.Spec) -> dict[str, str]:
    s = _sql_says
    falsy = sql_list(spec.falsy)
    proxy = f"not list_contains({falsy}, lower({s('proxy_job')})) or not list_contains({falsy}, lower({s('proxy_type')}))"
    return {"post": f"case when {proxy} or {s('boss_title')} = '猎头顾问' then 'agency' when {_HIDDEN} or {sql_any('company_name', R.fragile_terms)} then 'anonymous' else 'direct' end", "recruit": _RECRUIT, "active": _ACTIVE.replace("activity", "boss_active_status")}


def _sql_rows(spec: acceptance.Spec) -> list[tuple[str, str, str]]:
    """(id, level, number that a row adds) of the row checks, in DuckDB's SQL."""
    s, e = _sql_says, _sql_expected(spec)
    i = lambda c: f"coalesce(cast(({c}) as int), 0)"
    out = [(f"required:{f}", "error", i(f"{s(f)} = ''")) for f in (*spec.required, *spec.required_with_bodies)]
    out.append(("company_block", "error", i(" and ".join(f"{s(f)} = ''" for f in spec.company_block))))
    cut, squeezed = X.TITLE_CUTS.replace("'", "''"), "regexp_replace(lower(jd), '\\s+', '', 'g')"
    match = f"""len(list_filter(list_filter(regexp_split_to_array(lower(trim(title)), '{cut}'), lambda c: length(c) >= 2), lambda c: contains({squeezed}, c) or (regexp_matches(c, '[\\x{{4e00}}-\\x{{9fff}}]') and length(c) > 3 and len(list_filter(range(1, length(c)), lambda i: contains({squeezed}, substr(c, cast(i as integer), 2)))) > 0))) > 0"""
    out.append(("body_mismatch", "warn", i(f"title <> '' and {squeezed} <> '' and not ({match})")))
    out.append(("link_stamp", "warn", i(f"{s('link_verified_at')} = ''")))
    out += [(f"label_missing:{f}", "warn", i(f"{s(f)} = ''")) for f in spec.labels]
    out += [(f"label_illegal:{f}", "error", i(f"{s(f)} <> '' and not list_contains({sql_list(v)}, {s(f)})")) for f, v in spec.labels.items() if v]
    out.append(("body_short", "error", i(f"{s('jd')} <> '' and length(jd) < {spec.least_body}")))
    out.append(("junk_tail", "error", i(f"regexp_matches(jd, '{spec.junk_tail}')")))
    key = lambda c: f"lower(regexp_replace({c}, '[·・\\-—_、,，。;；:：!！?？()（）\\[\\]【】\"''`\\s]+', '', 'g'))"
    negotiable = f"list_contains({sql_list(spec.negotiable)}, lower({s('salary')}))"
    legible = f"({negotiable} or regexp_matches({s('salary')}, '\\d') and regexp_matches({s('salary')}, '(?i)[k千万元块薪天时月年]'))"
    named = f"({s('job_type')} = '' and contains({s('title')}, '实习'))"
    plus = lambda *cs: " + ".join(i(c) for c in cs)
    kinds = {
        "post_type": plus(f"{s('post_type')} <> '' and {s('post_type')} <> {e['post']}"),
        "recruit_type": plus(f"{s('recruit_type')} <> '' and {s('recruit_type')} <> {e['recruit']}", f"recruit_type = 'intern' and {s('job_type')} <> '4' and not {named}", f"recruit_type = 'campus' and {s('job_type')} <> '5'"),
        "active_state": plus(f"{s('active_state')} <> '' and {s('active_state')} <> {e['active']}", "active_state = 'active' and job_valid_status not in ('', '1')"),
        "title_key": plus(f"title <> '' and title_key <> '' and {key('title')} <> {key('title_key')}"),
        "salary": plus(f"{s('salary')} <> '' and not {legible}", *[f"{negotiable} and {s(c)} <> ''" for c in ("salary_min", "salary_max", "salary_unit", "months_per_year")], "salary_source = 'api' and salary = ''", "salary_source = 'api_empty' and salary <> ''"),
        "job_type": plus(f"{s('job_type')} not in ('', '4', '5')"),
        "social_daily": plus("recruit_type = 'social' and (contains(salary, '/天') or salary_unit = 'day')"),
    }
    out += [(f"contradiction:{k}", "error", c) for k, c in kinds.items()]
    out.append(("identity", "error", i("regexp_matches(job_id, '^[0-9a-f]{16}$') and job_id <> substr(md5(job_link), 1, 16)")))
    out.append(("stamp_illegible", "error", i("link_verified_at = 'soon'")))
    out.append(("stamp_old", "warn", i("link_verified_at = '2024-01-05T10:00:00+08:00'")))
    out.append(("stamp_naive", "warn", i("link_verified_at = '2024-01-05T10:00:00'")))
    out.append(("loose_flags", "error", f"{i('''dup_group = '' and dup_size <> 1''')} + {i('''dup_group = '' and not is_primary''')}"))
    return out


def _sql_sensitive(job: str) -> list[str]:
    planted = {"lid": f"{job} % 5 = 0", "authToken": f"{job} % 19 = 0", "cookie_jar": f"{job} % 19 = 1", "session_id": f"{job} % 19 = 2", "wt2": f"{job} % 19 = 2"}
    return [f"select 'sensitive:{k}', 'error', count(*) filter ({c}) from r" for k, c in planted.items()]


def _sql_found(spec: acceptance.Spec = acceptance.DEFAULT_SPEC) -> str:
    parts = [f"select '{n}' as id, '{level}' as level, cast(sum({c}) as bigint) as count from r" for n, level, c in _sql_rows(spec)]
    body = "substr(regexp_replace(lower(coalesce(jd, '')), '\\s+', '', 'g'), 1, 180)"
    place = "substr(lower(regexp_replace(location, '[·・\\-—_、,，。;；:：!！?？()（）\\[\\]【】\"''`\\s]+', '', 'g')), 1, 12)"
    parts += [
        "select 'repeated_id', 'error', cast(coalesce(sum(n - 1), 0) as bigint) from (select count(*) n from r where job_id <> '' group by job_id)",
        "select 'link_of_several', 'error', count(*) from (select job_link from r where job_id <> '' group by 1 having count(distinct job_id) > 1)",
        "select 'id_of_several', 'error', count(*) from (select job_id from r where job_id <> '' group by 1 having count(distinct job_link) > 1)",
        "select 'group_size', 'error', count(*) from r join (select dup_group, count(*) n from r where dup_group <> '' group by 1) using (dup_group) where dup_size <> n",
        "select 'group_primary', 'error', count(*) from (select dup_group from r where dup_group <> '' group by 1 having count(*) filter (is_primary) <> 1)",
        f"select 'group_content', 'error', count(*) from (select dup_group from r where dup_group <> '' group by 1 having count(distinct {body}) > 1)",
        f"select 'ungrouped_content', 'error', count(*) from (select {body} b, {place} c from r where {body} <> '' group by 1, 2 having count(*) > 1 and (count(distinct dup_group) > 1 or min(dup_group) = ''))",
        "select 'request_roots', 'error', case when count(*) filter (contains(title, '产品')) < 0.6 * count(*) then count(*) filter (not contains(title, '产品')) else 0 end from r",
        "select 'request_city', 'error', case when count(*) filter (split_part(location, '·', 1) = '杭州') < 0.95 * count(*) then count(*) filter (split_part(location, '·', 1) <> '杭州') else 0 end from r",
        "select 'request_count', 'error', abs(count(*) - 1000) from r",
        "select 'forbidden_key', 'error', count(distinct k) from (select unnest(json_keys(payload)) k from r) where k = 'lid'",
        "select 'unregistered_key', 'warn', count(distinct k) from (select unnest(json_keys(payload)) k from r) where k in ('lid', 'mood', 'note', 'more')",
        *_sql_sensitive("job"),
        "select 'type:jd', 'error', count(*) from r where json_type(payload, '$.jd') not in ('VARCHAR', 'NULL')",
        "select 'type:skills', 'error', count(*) from r where json_type(payload, '$.skills') not in ('ARRAY', 'NULL')",
    ]
    return f"r as ({record_sql()}), f as (select * from ({' union all '.join(parts)}) where count > 0)"


def _found(spark, sf_dir):
    return acceptance.check_export(records(spark, sf_dir), F.to_timestamp(F.lit("2024-02-01 00:00:00")), ("产品",), "杭州", 1000, "payload", unicode=False)


@query(f"with {_sql_found()} select * from f")
def acceptance_findings(spark, sf_dir):
    return _found(spark, sf_dir)


@query(f"with {_sql_found()} select count(*) filter (level = 'error') = 0 as ok, count(*) filter (level = 'error') as errors, count(*) filter (level = 'warn') as warnings, cast(sum(count) filter (level = 'error') as bigint) as wrong from f")
def acceptance_verdict(spark, sf_dir):
    return acceptance.verdict(_found(spark, sf_dir))


@query(f"with r as ({record_sql()}) select count(*) as \"rows\", case when count(*) filter (trim(jd) <> '') > 0 then 'detail' else 'list' end as shape from r")
def delivery_shape(spark, sf_dir):
    return acceptance.shape(records(spark, sf_dir))


_INVARIANTS = [("body_present", "trim(coalesce(jd, '')) = ''"), ("body_length", "length(coalesce(jd, '')) < 120"), ("junk_tail", f"regexp_matches(coalesce(jd, ''), '{acceptance.DEFAULT_SPEC.junk_tail}')"), ("post_type", "post_type = ''"), *[(f"field_{f}", f"{f} = ''") for f in ("title", "company_name", "salary", "location", "job_link")], ("link_stamp", "link_verified_at = ''")]


@query(f"""with r as ({record_sql()}), p as (select regexp_replace(lower(jd), '\\s+', '', 'g') p, count(*) n from r group by 1) {" union all ".join(f"select '{n}' as name, count(*) filter ({c}) as bad, count(*) filter ({c}) = 0 as ok from r" for n, c in _INVARIANTS)}
union all select 'dup_ratio', cast(coalesce(sum(n - 1) filter (p <> ''), 0) as bigint), coalesce(sum(n - 1) filter (p <> ''), 0) <= 0.2 * sum(n) from p""")
def delivery_invariants(spark, sf_dir):
    return acceptance.invariants(records(spark, sf_dir), X.body_key("jd", unicode=False))


@query(f"""with r as ({record_sql()}), f as (select 'missing:job_id' as id, 'error' as level, count(*) filter (job_id = '') as count from r union all select 'repeated_id', 'error', count(*) from (select job_id from r where job_id <> '' group by 1 having count(*) > 1)
union all select 'job_count', 'warn', cast(count(*) <> 1000 as bigint) from r union all select 'format_version', 'error', 1 union all select 'observed_missing', 'warn', 1 union all select 'exhausted_type', 'error', 1 union all select 'sensitive:accessToken', 'error', 1 union all {" union all ".join(_sql_sensitive("job"))}) select * from f where count > 0""")
def contract_validator(spark, sf_dir):
    return acceptance.validate(records(spark, sf_dir), {"format_version": 3, "job_count": 1000, "mode": "incremental", "exhausted": "no", "from": {"accessToken": 1}}, "payload")


@query(f"""with l as ({record_sql()}), d as (select case when c_custkey % 7 = 0 then '' else substr(md5(concat('https://jobs.example/', c_custkey)), 1, 16) end job_id, case when c_custkey % 4 = 0 then 'short' else repeat(c_name, 9) end jd from customer),
a as (select job_id k, count(*) n from l group by 1), b as (select job_id k, count(*) n from d group by 1), m as (select count(*) ids, count(*) filter (k not in (select k from b)) missing from a where k <> '')
select (select count(*) from l) as list_rows, (select count(*) from d) as detail_rows, (select count(*) from l where job_id = '' or title = '') as list_incomplete, (select count(*) from a where k <> '' and n > 1) as list_repeated, (select count(*) from b where k <> '' and n > 1) as detail_repeated,
(select count(*) from d where length(jd) < 50) as short_bodies, ids, missing, round((ids - missing) / ids, 4) as coverage, false as ok from m""")
def verified_results(spark, sf_dir):
    from sievework.plans.tables import table

    details = table(spark, sf_dir, "customer").selectExpr("case when c_custkey % 7 = 0 then '' else substr(md5(concat('https://jobs.example/', c_custkey)), 1, 16) end as job_id", "case when c_custkey % 4 = 0 then 'short' else repeat(c_name, 9) end as jd")
    return acceptance.verify(records(spark, sf_dir), details)


@query(f"""with r as ({record_sql()}), x as (select job, list_filter([case when coalesce(trim(title), '') <> '' then 'title' end, case when post_type <> '' then 'post_type=' || post_type end, case when jd <> '' then 'jd=' || length(jd) end], lambda x: x is not null) e from r) select job, array_to_string(e, '; ') as evidence from x""")
def kept_evidence(spark, sf_dir):
    r = records(spark, sf_dir)
    parts = [F.when(acceptance.said("title") != "", F.lit("title")), F.when(acceptance.said("post_type") != "", F.concat(F.lit("post_type="), "post_type")), F.when(F.col("jd") != "", F.concat(F.lit("jd="), F.length("jd").cast("string")))]
    return r.select("job", F.array_join(F.array_compact(F.array(*parts)), "; ").alias("evidence"))
