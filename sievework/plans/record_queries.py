"""Queries of the columns of whole records."""

from __future__ import annotations

from pyspark.sql import functions as F

from sievework.functions import pages, payloads
from sievework.functions import postings as P
from sievework.functions import records as C
from sievework.functions import text as X
from sievework.operators import filters
from sievework.plans.registry import events, query, sql_any, sql_list
from sievework.plans.tables import posting_sql, postings, table
from sievework.ruleset import DEFAULT as R

_P = f"with p as ({posting_sql()})"
_HIDDEN = "(" + " or ".join(f"starts_with(company_name, '{s}')" for s in R.anonymous_starts) + ")"
_POST = f"case when proxy_job <> '' or boss_title = '猎头顾问' then 'agency' when {_HIDDEN} or {sql_any('company_name', R.fragile_terms)} then 'anonymous' else 'direct' end"
_RECRUIT = "case when job_type = '4' then 'intern' when job_type = '5' then 'campus' when job_type = '' and contains(title, '实习') then 'intern' else 'social' end"


def sql_tags(c: str) -> str:
    return f"list_filter(list_transform(string_split(replace({c}, '｜', '|'), '|'), lambda x: trim(x)), lambda x: x <> '')"


SQL_EXPERIENCE = "(contains(x, '年') or contains(x, '应届') or contains(x, '在校') or x in ('经验不限', '不限经验'))"
SQL_DEGREE = f"list_contains({sql_list(C.DEGREES)}, x)"


def sql_first_tag(test: str, *fields: str) -> str:
    return f"coalesce(list_filter({' || '.join(map(sql_tags, fields))}, lambda x: {test})[1], '')"


@query(f"{_P} select job, {sql_first_tag(SQL_EXPERIENCE, 'experience', 'tags', 'job_labels')} as experience_tag, {sql_first_tag(SQL_DEGREE, 'education', 'tags', 'job_labels')} as degree_tag from p")
def experience_and_degree(spark, sf_dir):
    return postings(spark, sf_dir).select("job", C.experience_tag().alias("experience_tag"), C.degree_tag().alias("degree_tag"))


@query(f"{_P} select job, array_to_string(list_filter(list_transform(string_split(replace(concat(keyword, ' ，', company_name, ',, ', company_stage), '，', ','), ','), lambda x: trim(x)), lambda x: x <> ''), '|') as keywords from p")
def keyword_lists(spark, sf_dir):
    return postings(spark, sf_dir).select("job", F.array_join(C.keyword_list(F.concat("keyword", F.lit(" ，"), "company_name", F.lit(",, "), "company_stage")), "|").alias("keywords"))


_ODD = "split_part('12| -7 |+3|1.5|abc||TRUE|y|0|No', '|', cast({k} % 10 as int) + 1)"


@query(f"with t as (select event_id, {_ODD.format(k='event_id')} as t from events) select event_id, case when regexp_full_match(trim(t), '[+-]?\\d+') then try_cast(trim(t) as bigint) end as whole, lower(trim(t)) in ('1', 'true', 'yes', 'y', 't') as truth from t")
def salvaged_numbers(spark, sf_dir):
    t = table(spark, sf_dir, "events").selectExpr("event_id", f"{_ODD.format(k='event_id')} as t")
    return t.select("event_id", C.as_int("t").alias("whole"), C.truthy("t").alias("truth"))


@query(f"""{_P}, h as (select job, salary, trim(split_part(salary, '·', 1)) head from p), n as (select *, regexp_extract_all(head, '\\d+(?:\\.\\d+)?') ns, not contains(head, '/天') and (contains(head, 'K') or contains(head, '元')) mon from h),
v as (select *, try_cast(ns[1] as double) lo, try_cast(ns[len(ns)] as double) hi from n) select job, case when salary not in ('', '面议') then cast(trunc(lo * case when mon and lo <= 999 then 1000 else 1 end) as bigint) end as low, case when salary not in ('', '面议') then cast(trunc(hi * case when mon and lo <= 999 then 1000 else 1 end) as bigint) end as high from v""")
def salary_bounds(spark, sf_dir):
    b = C.salary_bounds("salary")
    return postings(spark, sf_dir).select("job", b["low"].alias("low"), b["high"].alias("high"))


_STAMP = "case event_id % 4 when 0 then '2024-01-02T03:04:05Z' when 1 then '2024-01-02' when 2 then 'never' else '' end"
_SCRAPED = "case when event_id % 8 = 2 then '2024-01-03T00:00:00+08:00' else 'x' end"


@query(f"""with e as (select event_id, ts, value from events) select event_id, case when event_id % 5 > 0 then cast(least(100, greatest(0, floor(value * 100 / (event_id % 5 * 20)))) as int) end as percent, epoch(timestamp '2024-01-16') - epoch(date_trunc('second', ts)) > 300 as old,
coalesce(case event_id % 4 when 0 then timestamp '2024-01-02 03:04:05' when 1 then timestamp '2024-01-02' end, case when event_id % 8 = 2 then timestamp '2024-01-02 16:00:00' end, ts) as created from e""")
def run_progress(spark, sf_dir):
    e = events(spark, sf_dir).selectExpr("event_id", "ts", "value", f"{_STAMP} as stamp", f"{_SCRAPED} as scraped")
    return e.select("event_id", C.percent("value", F.expr("event_id % 5 * 20")).alias("percent"), C.heartbeat_old(F.date_trunc("second", "ts"), F.to_timestamp(F.lit("2024-01-16 00:00:00"))).alias("old"), C.created_at("stamp", "scraped", "ts").alias("created"))


_PROBE = {
    "url": "case when event_id % 11 = 0 then 'https://x.example/Security-Check?a=1' else 'https://x.example/list' end",
    "title": "case when event_id % 7 = 0 then '请完成安全验证' else '职位' end",
    "slider": "event_id % 29 = 0",
    "blocked": "event_id % 5 = 0",
    "restore": "case event_id % 3 when 0 then '将于 2024-01-20 20:14 恢复正常' when 1 then '将于 2024-01-20 9:05 恢复' else '' end",
    "login_required": "event_id % 13 = 0",
    "cards": "cast(event_id % 4 as int)",
    "limited": "event_id % 3 = 0",
    "wall": "event_id % 2 = 0",
}


@query(f"""with e as (select event_id, {', '.join(f'{v} as {k}' for k, v in _PROBE.items())} from events), m as (select *, case when event_id % 3 = 0 then 674 when event_id % 3 = 1 then 5 else 0 end as mins from e),
k as (select *, case when contains(lower(url), 'security-check') or slider then 'captcha' when blocked then case when login_required or mins > 30 then 'account_risk' else 'env_risk' end when cards = 0 then '' when limited then 'rate_limit' when contains(title, '安全验证') then 'captcha' when wall then 'login' else '' end category from m)
select event_id, category, cast(case when category in ('account_risk', 'env_risk') then mins else 0 end as int) as minutes from k""")
def page_risks(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", *[f"{v} as {k}" for k, v in _PROBE.items()])
    risk = C.page_risk("url", "title", "slider", "blocked", "restore", "login_required", "cards", "limited", "wall", F.to_timestamp(F.lit("2024-01-20 09:00:00")))
    return e.select("event_id", risk["category"].alias("category"), risk["minutes"].alias("minutes"))


_KEY = lambda c: f"lower(regexp_replace({c}, '[·・\\-—_、,，。;；:：!！?？()（）\\[\\]【】\"''`\\s]+', '', 'g'))"


@query(f"""{_P}, b as (select *, nullif(trim(split_part(location, '·', 1)), '') city, nullif(trim(split_part(location, '·', 2)), '') district, substr(regexp_replace(lower(jd), '\\s+', '', 'g'), 1, 180) body from p),
c as (select *, 'cn-' || substr(sha256({_KEY('title')} || '|' || {_KEY('company_name')} || '|' || {_KEY('city')}), 1, 16) canonical_id, case when body = '' then '' else body || '|' || substr({_KEY('location')}, 1, 12) end fp from b)
select job, title, company_name as company, city, district, nullif(salary, '') as salary_desc, nullif(experience, '') as experience, nullif(education, '') as education, {_RECRUIT} as recruit_type, nullif(company_industry, '') as industry, nullif(company_scale, '') as company_size, job_link as url, canonical_id, substr(sha256(canonical_id || '|' || fp), 1, 32) as content_hash from c""")
def store_columns(spark, sf_dir):
    made = C.store_columns(unicode=False)
    return postings(spark, sf_dir).select("job", *[c.alias(n) for n, c in made.items() if n not in ("salary_min", "salary_max")])


@query(f"""{_P}, f as (select job, list_filter([case when job % 4 = 0 then 'stale' end, case when job % 6 = 0 then 'part_time' end, case when {_RECRUIT} <> 'social' then 'recruit:' || {_RECRUIT} end, case when proxy_job <> '' or boss_title = '猎头顾问' then 'post:agency' end, case when job % 5 = 0 then 'ai_pm' end], lambda x: x is not null) f from p) select job, array_to_string(f, ',') as flags from f""")
def record_flags(spark, sf_dir):
    p = postings(spark, sf_dir).withColumns({"post_type": F.lit(""), "proxy_type": F.lit(""), "recruit_type": F.lit(""), "direction": F.expr("case when job % 5 = 0 then 'ai_pm' else '' end")})
    risk = F.expr("filter(array(case when job % 4 = 0 then 'stale' end, case when job % 6 = 0 then ' part_time ' end, case when job % 4 = 0 then 'stale' end), x -> x is not null)")
    return p.select("job", F.array_join(C.payload_flags(risk), ",").alias("flags"))


@query(f"{_P} select job, case when len(list_filter(string_split(skill_text, ','), lambda x: x <> '')) > 0 then '[' || array_to_string(list_transform(list_filter(string_split(skill_text, ','), lambda x: x <> ''), lambda x: '\"' || x || '\"'), ',') || ']' end as tags from p")
def skill_tags_json(spark, sf_dir):
    return postings(spark, sf_dir).select("job", C.tags_json("skills").alias("tags"))


_DETAIL = """case event_id % 6 when 0 then 'no json' when 1 then '[1]' when 2 then '{"error":"timeout"}' when 3 then '{"code":37,"msg":"session expired"}' when 4 then '{"code":0,"jd":"short"}' else concat('{"jd":"', repeat('负责　AI产品 ', 9), '","boss_active_status":"今日活跃","brand_active_time":"', user_id, '天前","job_status_desc":"最新","brand_introduce":"介绍","brand_stage_name":"A轮","brand_scale_name":null,"brand_industry_name":', event_id, '}') end"""


@query("""with e as (select event_id, coalesce(cast(user_id as varchar), '') user_id, event_id % 6 k from events) select event_id, case when k = 5 then trim(replace(repeat('负责　AI产品 ', 9), '　', ' ')) else '' end as jd, case when k = 5 then '今日活跃' else '' end as boss_active_status, case when k = 5 then user_id || '天前' else '' end as brand_active_time, case when k = 5 then '最新' else '' end as job_status_desc, case when k = 5 then '介绍' else '' end as brand_introduce, case when k = 5 then 'A轮' else '' end as brand_stage_name, '' as brand_scale_name, case when k = 5 then cast(event_id as varchar) else '' end as brand_industry_name, '' as page_update_date, case k when 0 then 'not_json' when 1 then 'not_json' when 2 then 'request' when 3 then 'code' when 4 then 'short' else '' end as failure, case when k = 3 then 'token_expired' else '' end as category from e""")
def detail_payloads(spark, sf_dir):
    d = C.detail_payload("payload")
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_DETAIL} as payload").select("event_id", *[d[n].alias(n) for n in ("jd", "page_update_date", *C.DETAIL_FIELDS, "failure", "category")])


_IDS = """case event_id % 4 when 0 then concat('["', user_id, '"," b ",""]') when 1 then concat('{"job_ids":["', user_id, '","b"]}') when 2 then concat(user_id, ', b', chr(10), 'b') else '' end"""


@query("select event_id, case when event_id % 4 = 3 then '' else concat(user_id, '|b') end as ids from events")
def id_lists(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_IDS} as t").select("event_id", F.array_join(C.id_list("t"), "|").alias("ids"))


_LEDGER = """concat('[{"job_id":"', o_orderkey, '","reason":"sales","title":"t"},"', o_custkey, '",{"reason":"no id"}]')"""


@query("select o_orderkey, concat(o_orderkey, ':sales:t|', o_custkey, '::') as entries from orders")
def dropped_entries(spark, sf_dir):
    o = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_LEDGER} as t")
    return o.select("o_orderkey", F.array_join(F.transform(C.ledger_entries("t"), lambda e: F.concat_ws(":", e.job_id, e.reason, e.title)), "|").alias("entries"))


#: Names to hide at three depths, as values of lists, and in a URL that stands in a URL's parameter; brackets, quotes and escapes that only look like structure.
_SECRET = r"""concat('{"a":[{"authToken":{"x":[1,{"y":2}]},"url":"https://x.example/p?lid=1&q=', event_id, '&next=https%3A%2F%2Fy.example%2F%3Fapi_secret%3D2%26z%3D3#session=4"}],"n":', event_id, case when event_id % 2 = 0 then ',"encryptJobId":"e"' else '' end, case when event_id % 3 = 0 then ',"deep":{"er":[[{"cookie_jar":"}]","plain":"a \\"{token=abc\\" b"}]]}' else '' end, case when event_id % 5 = 0 then ',"author":"[","lid":null' else '' end, '}')"""
_HIDES = "list_sort(list_filter(['api_secret', 'authToken', 'lid', 'session', case when event_id % 2 = 0 then 'encryptJobId' end, case when event_id % 3 = 0 then 'cookie_jar' end], lambda x: x is not null))"


@query(f"select event_id, array_to_string({_HIDES}, ',') as keys from events")
def secret_keys(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_SECRET} as t").select("event_id", F.array_join(payloads.secret_keys("t"), ",").alias("keys"))


@query(r"""select event_id, concat('{"a":[{"url":"https://x.example/p?q=', event_id, '&next=https%3A%2F%2Fy.example%2F%3Fz%3D3"}]', case when event_id % 5 = 0 then ',"author":"["' else '' end, case when event_id % 3 = 0 then ',"deep":{"er":[[{"plain":"a \"{token=***\" b"}]]}' else '' end, case when event_id % 2 = 0 then ',"encryptJobId":"e"' else '' end, ',"n":', event_id, '}') as safe from events""")
def safe_payloads(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr("event_id", f"{_SECRET} as t")
    return payloads.safe_json(rows, "t", "safe", payloads.PUBLIC_IDENTITIES).select("event_id", "safe")


@query(f"{_P} select job, title, '' as tier from p")
def public_view(spark, sf_dir):
    return C.view(postings(spark, sf_dir), ("job", "title", "salary", "tier"), ("salary",))


@query(f"{_P} select cast(job as varchar) as job, company_name as company, array_to_string(list_filter(string_split(skill_text, ','), lambda x: x <> ''), ' | ') as skills, '' as tier from p")
def csv_rows(spark, sf_dir):
    return C.flat(postings(spark, sf_dir), ("job", "company", "skills", "tier"), {"company": "company_name"})


@query(f"{_P} select job, company_name as company, tags as tags_list, job_link as link from p")
def detail_aliases(spark, sf_dir):
    return C.detail_record(postings(spark, sf_dir)).select("job", "company", "tags_list", "link")


@query(f"{_P} select job, array_to_string(list_filter([split_part(location, '·', 1), split_part(location, '·', 2), ''], lambda x: x <> '' and x <> '杭州'), '·') as joined, case when job % 3 = 0 then '' else cast(job % 3 as varchar) end as zero, coalesce(case when job % 2 = 0 then salary end, '') as plain from p")
def shaped_values(spark, sf_dir):
    p = postings(spark, sf_dir).selectExpr("job", "split_part(location, '·', 1) as a", "split_part(location, '·', 2) as b", "cast(null as string) as c", "job % 3 as z", "case when job % 2 = 0 then salary end as s")
    return p.select("job", C.shaped([F.col("a"), F.col("b"), F.col("c")], "join:·|filter:杭州").alias("joined"), C.shaped([F.col("z")], "zero_as_empty").alias("zero"), C.shaped([F.col("s")], "str").alias("plain"))


@query("""with u as (select page_id, url, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) host from pages), b as (select *, host = 'example.com' or ends_with(host, '.example.com') own, split_part(url, '#', 1) base, case when contains(url, '#') then '#' || split_part(url, '#', 2) else '' end mark from u)
select page_id, own, case when not own then '' else split_part(base, '?', 1) || '?' || array_to_string(list_filter(string_split(case when contains(base, '?') then split_part(base, '?', 2) else '' end, '&') || [case when not contains(base, 'page=') then 'page=' || page_id end], lambda x: x <> ''), '&') || mark end as link from b""")
def detail_links(spark, sf_dir):
    u = table(spark, sf_dir, "pages")
    return u.select("page_id", C.host_is("url", "example.com").alias("own"), C.with_parameters("url", "example.com", {"page": F.col("page_id").cast("string"), "none": F.lit("")}).alias("link"))


@query("select o_orderkey, case o_orderpriority when '1-URGENT' then 'urgent' when '5-LOW' then 'low' end as label from orders")
def option_labels(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", C.option_label("o_orderpriority", {"urgent": "1-URGENT", "low": "5-LOW"}).alias("label"))


@query(f"""{_P}, x as (select job, list_filter([case when skill_text <> '' then 'skills=' || replace(skill_text, ',', '、') end, case when trim(job_labels) <> '' then 'labels=' || trim(job_labels) end, 'post_type=' || {_POST}, 'recruit_type=' || {_RECRUIT}, case when jd <> '' then 'jd=' || length(jd) end], lambda x: x is not null) e from p) select job, array_to_string(e, '; ') as evidence from x""")
def evidence(spark, sf_dir):
    p = postings(spark, sf_dir).withColumns({"post_type": P.post_type("proxy_job", F.lit(""), "boss_title", "company_name"), "recruit_type": P.recruit_type("job_type", "title")})
    return p.select("job", F.array_join(C.evidence("skills"), "; ").alias("evidence"))


@query(f"{_P} select job, {_POST} <> 'direct' as is_agency, {_RECRUIT} = 'social' as is_social, {_POST} = 'direct' and {_RECRUIT} = 'social' as is_direct_social from p")
def record_predicates(spark, sf_dir):
    p = postings(spark, sf_dir).withColumns({"post_type": P.post_type("proxy_job", F.lit(""), "boss_title", "company_name"), "recruit_type": P.recruit_type("job_type", "title")})
    return p.select("job", *[c.alias(n) for n, c in C.predicates().items()])


@query(f"{_P} select job, {sql_any('lower(title)', R.sales_title_terms)} or {sql_any('''regexp_replace(lower(jd), '\\s+', '', 'g')''', R.sales_body_terms)} as sales from p")
def sales_marks(spark, sf_dir):
    return postings(spark, sf_dir).select("job", C.is_sales().alias("sales"))


@query("select event_id, cast(ts + interval 8 hours as date) = date '2024-01-20' as on_day from events")
def day_in_zone(spark, sf_dir):
    return events(spark, sf_dir).select("event_id", filters.on_day(F.col("ts"), F.to_date(F.lit("2024-01-20")), "Asia/Shanghai").alias("on_day"))


_TEXTS = "case event_id % 5 when 0 then '2024-02-03' when 1 then '2024-02-03 04:05' when 2 then '2024-02-03T04:05:06.5+08:00' when 3 then '2024-13-03' else 'x' end"


@query("select event_id, case event_id % 5 when 0 then timestamp '2024-02-03' when 1 then timestamp '2024-02-03 04:05:00' when 2 then timestamp '2024-02-02 20:05:06.5' end as at, event_id % 5 = 2 as zoned from events")
def iso_instants(spark, sf_dir):
    i = X.iso_instant("t")
    return table(spark, sf_dir, "events").selectExpr("event_id", f"{_TEXTS} as t").select("event_id", i["at"].alias("at"), i["zoned"].alias("zoned"))


_BODY = "concat(repeat('负责产品规划与需求分析，推动项目落地。', 4), job)"
#: (page, its body's text, tags, what the platform shows) and (body, activity, day, error) of each form of a page, in SQL that Spark and DuckDB share; chr(10) ends a line.
_PAGES = [
    ("''", "concat('职位描述：', chr(10), {b}, chr(10), '举报 · 分享', chr(10), '张女士', chr(10), '今日活跃', chr(10), '星海科技·招聘经理')", "", "", "{b}", "今日活跃", "", ""),
    ("concat('首页', chr(10), 'AI产品经理', chr(10), '职位描述', chr(10), 'SQL Python', chr(10), chr(10), {b}, chr(10), '李先生', chr(10), chr(10), '安全提示', chr(10), '别的')", "''", "SQL,Python", "在线", "concat({b}, chr(10), '李先生')", "在线", "", ""),
    ("'页面更新时间：2024-05-01'", "concat({b}, chr(10), '张三', chr(10), '本周活跃', chr(10), '星海科技', chr(10), '·', chr(10), '招聘经理', chr(10), '竞争力分析', chr(10), '其他')", "", "", "{b}", "本周活跃", "2024-05-01", ""),
    ("''", "concat({b}, chr(10), '张三', chr(10), '星海科技', chr(10), '·', chr(10), '招聘经理')", "", "3日内活跃", "{b}", "3日内活跃", "", ""),
    ("'半年前活跃 页面更新时间:2024-06-30'", "concat({b}, chr(10), '张女士', chr(10), '离职中', chr(10), chr(10), '星海科技', chr(10))", "", "", "{b}", "离职中", "2024-06-30", ""),
    ("'半年前活跃'", "concat({b}, chr(13), chr(10), '李先生（已认证）', chr(13), chr(10), '星海科技·招聘')", "", "离线", "{b}", "半年前活跃", "", ""),
    ("''", "concat({b}, chr(10), chr(10), '王先生')", "", "", "{b}", "", "", ""),
    ("''", "concat({b}, chr(10), 'SQL', chr(10), '王先生负责一切。', chr(10), '在线')", "SQL", "", "concat({b}, chr(10), 'SQL', chr(10), '王先生负责一切。', chr(10), '在线')", "", "", ""),
    ("concat({b}, '登录查看完整内容')", "{b}", "", "在线", "''", "", "", "login"),
    ("'无障碍专区 首页 职位 公司'", "''", "", "", "''", "", "", "navigation"),
    ("''", "'太短'", "", "今日活跃", "''", "", "", "short"),
]


def _page_form(i: int) -> str:
    return f"case job % {len(_PAGES)} " + " ".join(f"when {k} then {x[i].format(b=_BODY) if i in (0, 1, 4) else repr(x[i])}" for k, x in enumerate(_PAGES)) + " end"


@query(f"{_P} select job, {_page_form(4)} as jd, {_page_form(5)} as boss_active_status, {_page_form(6)} as page_update_date, {_page_form(7)} as error from p")
def page_bodies(spark, sf_dir):
    p = postings(spark, sf_dir).selectExpr("job", f"{_page_form(0)} as page", f"{_page_form(1)} as text", f"{_page_form(2)} as tags", f"{_page_form(3)} as shown")
    return p.select("job", pages.extract_body("text", "page", F.split("tags", ","), "shown").alias("x")).select("job", "x.*")
