"""Record-level rules of postings as Columns: pay, types, directions, activity, risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.text import as_col, body_key, contains_any, found_terms, title_matches_body
from sievework.ruleset import DEFAULT, RuleSet

_NUMBER = "(\\d+(?:\\.\\d+)?)"


def _text(c: Column | str) -> Column:
    return F.coalesce(F.trim(as_col(c)), F.lit(""))


def _number(text: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("double")


def monthly_range(salary: Column | str) -> Column:
    """struct(low, high) in thousands a month from "20-40K" or "300-500元/天" (22 days); null if neither."""
    s = _text(salary)
    k, day = f"(?i){_NUMBER}\\s*-\\s*{_NUMBER}\\s*K", f"{_NUMBER}\\s*-\\s*{_NUMBER}\\s*元/天"
    pay = lambda i: F.coalesce(_number(s, k, i), F.round(_number(s, day, i) * 22 / 1000, 1))
    return F.when(pay(1).isNotNull() & pay(2).isNotNull(), F.struct(pay(1).alias("low"), pay(2).alias("high")))


def months(salary: Column | str) -> Column:
    """Monthly payments a year, twelve if not said."""
    return F.coalesce(F.regexp_extract(_text(salary), "(\\d+)\\s*薪", 1).try_cast("int"), F.lit(12))


def annual_range(salary: Column | str) -> Column:
    m, n = monthly_range(salary), months(salary)
    return F.when(m.isNotNull(), F.struct(F.round(m["low"] * n, 1).alias("low"), F.round(m["high"] * n, 1).alias("high")))


def salary_parts(salary: Column | str, thousands_always: bool = True) -> Column:
    """struct(low, high, unit, months): amounts in yuan by day, hour, month or year.

    A month's amount up to 999 counts as thousands; without ``thousands_always`` only if the text has a K.
    """
    s = _text(salary)
    none = s.isin("", "面议", "negotiable", "不限")
    tail = F.regexp_extract(s, "·\\s*(\\d+)薪?\\s*$", 1)
    head = F.trim(F.substring_index(s, "·", 1))
    unit = F.when(head.contains("/天"), "day").when(head.contains("元/小时") | head.contains("元/时"), "hour").when(head.contains("元/年"), "year").when(F.upper(head).contains("K") | head.contains("元"), "month").otherwise("")
    numbers = F.regexp_extract_all(head, F.lit("(\\d+(?:\\.\\d+)?)"), F.lit(1))
    low, high = F.get(numbers, F.lit(0)).cast("double"), F.element_at(numbers, F.when(F.size(numbers) > 0, -1).otherwise(F.lit(None))).cast("double")
    scale = F.when((unit == "month") & (low <= 999) & (F.lit(thousands_always) | F.upper(head).contains("K")), 1000).otherwise(1)
    return F.when(~none, F.struct((low * scale).alias("low"), (high * scale).alias("high"), unit.alias("unit"), F.when(tail != "", tail.cast("int")).alias("months")))


def post_type(proxy_job, proxy_type, boss_title, company, rules: RuleSet = DEFAULT) -> Column:
    """direct, agency or anonymous: the platform's marks first, then the recruiter's title, then the company's name."""
    name = _text(company)
    hidden = F.lit(False)
    for start in rules.anonymous_starts:
        hidden = hidden | name.startswith(start)
    return F.when((_text(proxy_job) != "") | (_text(proxy_type) != "") | _text(boss_title).isin(*rules.agency_titles), "agency").when(hidden | contains_any(name, rules.fragile_terms), "anonymous").otherwise("direct")


def recruit_type(job_type, title) -> Column:
    """social, intern or campus: the platform's code, else what the title says."""
    code = _text(job_type)
    return F.when(code == "4", "intern").when(code == "5", "campus").when((code == "") & F.coalesce(as_col(title), F.lit("")).contains("实习"), "intern").otherwise("social")


def direction(title, body, skills, rules: RuleSet = DEFAULT) -> Column:
    """struct(label, evidence): ai_pm, pm_only, ai_other or other, with the terms that say so."""
    t = F.coalesce(as_col(title), F.lit(""))
    blob = F.concat_ws("\n", t, F.coalesce(as_col(body), F.lit("")), F.array_join(F.coalesce(as_col(skills), F.array().cast("array<string>")), " "))
    ai, pm = found_terms(blob, rules.ai_terms), found_terms(t, rules.product_terms)
    both = (F.size(ai) > 0) & (F.size(pm) > 0)
    label = F.when(both, "ai_pm").when(F.size(pm) > 0, "pm_only").when(F.size(ai) > 0, "ai_other").otherwise("other")
    evidence = F.when(both, F.slice(F.array_sort(F.array_distinct(F.concat(ai, pm))), 1, 6)).when(F.size(pm) > 0, F.slice(pm, 1, 4)).otherwise(F.slice(F.array_sort(F.array_distinct(ai)), 1, 4))
    return F.struct(label.alias("label"), evidence.alias("evidence"))


def active_state(status) -> Column:
    """active, inactive or unknown; nothing said is unknown."""
    s = _text(status)
    return F.when(s.rlike("(?:\\d+\\s*)?(?:个?月|周|年)\\s*前活跃"), "inactive").when((s == "在线") | s.endswith("活跃"), "active").otherwise("unknown")


def experience_bucket(tag) -> Column:
    t = _text(tag)
    return F.when(t.contains("应届") | t.contains("在校"), "应届/在校").when(t.isin("1年以内", "1-3年"), "1-3年").when(t.isin("3-5年", "5-10年", "10年以上"), t).when(t.isin("经验不限", "不限经验"), "经验不限").otherwise("未标注")


#: Order in which experience buckets are shown.
EXPERIENCE_ORDER = ("应届/在校", "1-3年", "3-5年", "5-10年", "10年以上", "经验不限", "未标注")


def risk_flags(company, title, body, location, post, updated, today: Column, salary_max=None, peer_median=None, rules: RuleSet = DEFAULT) -> Column:
    """Risk marks of a posting, in a fixed order; the clock is a parameter."""
    name, place = _text(company), F.filter(F.split(_text(location), "·"), lambda p: p != "")
    city = F.get(place, F.lit(0))
    elsewhere = F.exists(F.array(*map(F.lit, rules.other_cities)), lambda c: F.contains(name, c) & (c != city))
    age = days_since(updated, today)
    blob = F.lower(F.concat(_text(title), F.lit(" "), F.substring(_text(body), 1, 400)))
    marks = [
        F.when((name != "") & (as_col(post) == "anonymous"), "agency_placeholder"),
        F.when(F.size(place) == 1, "no_district"),
        F.when((F.size(place) > 0) & elsewhere, "other_base"),
        F.when(age > rules.stale_days, "stale"),
    ]
    if peer_median is not None:
        high, mid = as_col(salary_max), as_col(peer_median)
        marks.append(F.when((high > 0) & (mid > 0) & ((high > mid * rules.outlier_high) | (high < mid * rules.outlier_low)), "salary_outlier"))
    marks.append(F.when(contains_any(blob, rules.part_time_terms), "part_time"))
    return F.array_compact(F.array(*marks))


def evidence_level(title, body, skills, rules: RuleSet = DEFAULT) -> Column:
    """strong: title or skills speak of the field; jd_only: the body does, mentions in passing aside; else empty. Texts come in their compatibility form."""
    norm = F.lower
    t, b = norm(F.coalesce(as_col(title), F.lit(""))), norm(F.coalesce(as_col(body), F.lit("")))
    s = norm(F.array_join(F.coalesce(as_col(skills), F.array().cast("array<string>")), " "))
    says = lambda x: contains_any(x, rules.evidence_terms) | x.rlike(rules.bare_term)
    masked = F.regexp_replace(b, f"(?i){rules.incidental}", "")
    return F.when(says(t) | says(s), "strong").when(contains_any(b, rules.evidence_terms) | masked.rlike(rules.bare_term), "jd_only").otherwise("")


def with_junk_reason(df: DataFrame, title="title", body="jd", skills="skills", company="company_name", industry="company_industry", rules: RuleSet = DEFAULT, title_norm=None, body_norm=None, name: str = "reason") -> DataFrame:
    """Rows with why each is dropped: sales, tech, noise or mismatch; null if it stays. The first rule that holds decides.

    Sales and technical terms match the plain lower-case title, evidence the columns ``title_norm`` and
    ``body_norm`` in compatibility form (the plain ones, where they are known to be in it). What several rules
    ask for is projected once.
    """
    raw, body_ = F.coalesce(as_col(title), F.lit("")), F.coalesce(as_col(body), F.lit(""))
    even = raw if title_norm is None else F.coalesce(as_col(title_norm), F.lit(""))
    even_body = body_ if body_norm is None else F.coalesce(as_col(body_norm), F.lit(""))
    rows = df.withColumns({"_j_raw": raw, "_j_low": F.lower(raw), "_j_even": even, "_j_body": even_body, "_j_key": body_key(even_body, unicode=False), "_j_bare": F.trim(body_) == "", "_j_name": F.coalesce(as_col(company), F.lit(""))})
    low, even, even_body = F.col("_j_low"), F.col("_j_even"), F.col("_j_body")
    titled = evidence_level(even, F.lit(""), F.array().cast("array<string>"), rules) != ""
    rows = rows.withColumns({"_j_titled": titled, "_j_role": contains_any(low, rules.role_words)})
    # a title that is evidence needs no look at the rest
    rows = rows.withColumn("_j_full", F.col("_j_titled") | (evidence_level(F.lit(""), even_body, skills, rules) != ""))
    core = F.trim(F.regexp_extract(F.col("_j_raw"), "^([^（(]*)", 1))
    product_core = F.lit(False)
    for suffix in rules.product_suffixes:
        product_core = product_core | core.endswith(suffix)
    tech = contains_any(low, rules.tech_title_terms) & ~product_core & ~(low.contains("解决方案") & F.col("_j_titled"))
    signal = contains_any(F.coalesce(as_col(industry), F.lit("")), rules.company_industries) | F.col("_j_name").rlike(f"(?i)({rules.company_names})")
    sells = contains_any(F.col("_j_key"), rules.sales_body_terms)
    harder = contains_any(F.col("_j_key"), tuple(t for t in rules.sales_body_terms if t not in rules.pay_terms))
    normal = F.lower(even)
    solution = contains_any(normal, rules.solution_titles) & ~contains_any(normal, rules.solution_excludes)
    keep, full = F.lit(None).cast("string"), F.col("_j_full")
    reason = (
        F.when(low.contains(rules.protected_term), keep)
        .when(contains_any(low, rules.sales_title_terms), "sales")
        .when(tech, "tech")
        .when(low.contains(rules.media_term), "noise")
        .when(F.col("_j_role") & signal & ~contains_any(low, rules.company_title_excludes), keep)
        .when(contains_any(low, rules.operations_terms) & ~low.contains("产品") & ~full, "noise")
        .when(~F.col("_j_role") & ~low.contains("aigc"), "noise")
        .when(F.col("_j_bare"), keep)
        .when(sells & ~(full & ~harder), "sales")
        .when(full, keep)
        .when(~title_matches_body(even, even_body), "mismatch")
        .when(solution, keep)
        .otherwise("noise")
    )
    return rows.withColumn(name, reason).drop(*[c for c in rows.columns if c.startswith("_j_")])


#: Fingerprints of failed pages and what marks them, in order; the fingerprints that mean a page itself is bad.
FAILURES = (("login_wall", ("登录查看", "登录后可见", "请先登录", "扫码登录")), ("risk_page", ("访问受限", "暂时被限制访问", "账户存在异常行为", "验证码")), ("shell_only", ("正在加载", "javascript is required")))
STRUCTURAL = ("no_section",)


def failure_fingerprint(message, page) -> Column:
    """What kind of failure a message and the page's text tell of: too_short, login_wall, risk_page, shell_only, no_section or unknown."""
    said, text = F.coalesce(as_col(message), F.lit("")), F.coalesce(as_col(page), F.lit(""))
    both = F.concat(said, F.lit("\n"), text)
    out = F.when(both.contains("too short"), "too_short")
    for name, marks in FAILURES:
        out = out.when(contains_any(both, marks), name)
    return out.when(both.contains("职位描述") | (text != ""), "no_section").otherwise("unknown")


def failure_nature(fingerprint, reason=None) -> Column:
    """structural where the page itself is bad; transient for all else, so that it is tried again."""
    print_, said = F.lower(_text(fingerprint)), F.lower(_text(reason)) if reason is not None else F.lit("")
    return F.when(print_.isin(*STRUCTURAL) | print_.contains("no_section") | said.contains("no_section"), "structural").otherwise("transient")


def listed_activity(active, online) -> Column:
    """A list's word on a recruiter's activity: its own text, else online, else nothing."""
    return F.when(_text(active) != "", _text(active)).when(F.coalesce(as_col(online), F.lit(False)), "在线").otherwise("")


def days_since(day, today: Column) -> Column:
    """Days from an ISO date to today; null where it is none."""
    return F.datediff(today, F.to_date(F.try_to_timestamp(F.substring(_text(day), 1, 10), F.lit("yyyy-MM-dd"))))


#: Activities from vague to precise; others count as unknown.
ACTIVITY_ORDER = ("在线", "本月活跃", "2周内活跃", "本周活跃", "3日内活跃", "今日活跃", "刚刚活跃")


def more_precise(listed, detailed) -> Column:
    """The more precise of two activities; the list's if they are alike, the other one if one is blank."""
    a, b = _text(listed), _text(detailed)
    rank = lambda c: F.coalesce(F.array_position(F.array(*map(F.lit, ACTIVITY_ORDER)), c), F.lit(0))
    return F.when(b == "", a).when(a == "", b).when(rank(b) > rank(a), b).otherwise(a)


#: What response codes mean.
RESPONSE_CODES = {0: "ok", 9: "rate_limited", 17: "invalid_params", 19: "invalid_params", 31: "env_risk", 35: "env_risk", 36: "account_risk", 38: "env_risk", 121: "security_block", 122: "security_block"}


def response_kind(code, message) -> Column:
    """What a response code asks for; 37 depends on its message; other codes are unknown."""
    c, m = as_col(code).try_cast("int"), F.lower(_text(message))
    expired = contains_any(m, ("token", "session", "expired", "会话", "登录", "过期", "令牌"))
    out = F.when(c == 37, F.when(expired, "token_expired").otherwise("env_risk"))
    for k, v in RESPONSE_CODES.items():
        out = out.when(c == k, v)
    return out.otherwise("unknown")


def backoff(attempt, base: int = 10, most: int = 60) -> Column:
    """Seconds to wait before a retry: doubling, bounded."""
    return F.least(F.lit(float(most)), base * F.pow(F.lit(2.0), F.greatest(F.lit(0), as_col(attempt))))
