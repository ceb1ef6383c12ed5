"""Columns of whole records: tags, store columns, flags, payloads of details, page risks, views, values by declared shape."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.functions import postings as P
from sievework.functions.text import as_col, canonical_id, content_hash, fingerprint, first_filled, iso_instant, split_tags, tidy_lines

# Names of degrees, words of risk pages.
DEGREES = ("初中及以下", "中专/中技", "高中", "大专", "本科", "硕士", "博士", "学历不限")
RISK_TITLES = ("安全验证", "安全检查", "滑块验证", "验证码", "安全校验", "访问被拒绝", "账号异常", "账号受限")
RISK_URLS = ("security-check", "security.html", "verify", "captcha", "geetest")

#: Characters that a body of a payload has at the least; retries of a failed detail; minutes of a block that make it the account's; seconds after which a heartbeat is old.
LEAST_BODY, MOST_RETRIES, ACCOUNT_MINUTES, HEARTBEAT_SECONDS = 50, 3, 30, 300


def _text(c: Column | str) -> Column:
    return F.coalesce(F.trim(as_col(c)), F.lit(""))


def _filled(c: Column | str) -> Column:
    return F.when(_text(c) != "", _text(c))


# ---------------------------------------------------------------- tags


def is_experience(tag: Column) -> Column:
    return tag.contains("年") | tag.contains("应届") | tag.contains("在校") | tag.isin("经验不限", "不限经验")


def is_degree(tag: Column) -> Column:
    return tag.isin(*DEGREES)


def first_tag(test, *fields: Column | str) -> Column:
    """The first tag, over the fields in order, that passes; empty without one."""
    tags = F.concat(*[split_tags(f) for f in fields])
    return F.coalesce(F.get(F.filter(tags, test), F.lit(0)), F.lit(""))


def experience_tag(experience="experience", tags="tags", labels="job_labels") -> Column:
    return first_tag(is_experience, experience, tags, labels)


def degree_tag(education="education", tags="tags", labels="job_labels") -> Column:
    return first_tag(is_degree, education, tags, labels)


def skill_mentions(skills: Column | str, tags="tags", labels="job_labels", detail_tags: Column | None = None, stop: tuple[str, ...] = ()) -> Column:
    """Skills that a record names, once for each place: tags other than experience and degree, skills, labels, the detail's tags; without stop words."""
    parts = [F.filter(split_tags(tags), lambda t: ~is_experience(t) & ~is_degree(t)), F.coalesce(as_col(skills), F.array().cast("array<string>")), split_tags(labels)]
    if detail_tags is not None:
        parts.append(F.coalesce(detail_tags, F.array().cast("array<string>")))
    words = F.transform(F.concat(*parts), lambda t: F.trim(t))
    return F.filter(words, lambda t: (t != "") & ~t.isin(*stop) if stop else t != "")


def keyword_list(c: Column | str) -> Column:
    """Keywords between commas of either width, trimmed, each once in order."""
    return F.array_distinct(F.filter(F.transform(F.split(F.translate(_text(c), "，、", ",,"), ","), lambda t: F.trim(t)), lambda t: t != ""))


# ---------------------------------------------------------------- numbers, times


def as_int(c: Column | str) -> Column:
    """An integer that a text holds; null if it holds none."""
    return F.when(_text(c).rlike("^[+-]?\\d+$"), _text(c).try_cast("long"))


def truthy(c: Column | str) -> Column:
    return F.lower(_text(c)).isin("1", "true", "yes", "y", "t")


def salary_bounds(salary: Column | str) -> Column:
    """struct(low, high) of a pay text's amounts as whole numbers, cut off."""
    s = P.salary_parts(salary)
    return F.struct(s["low"].cast("long").alias("low"), s["high"].cast("long").alias("high"))


def percent(done, total) -> Column:
    """Share in whole per cent between 0 and 100; null without a total."""
    return F.when(as_col(total) > 0, F.least(F.lit(100), F.greatest(F.lit(0), F.floor(as_col(done) * 100 / as_col(total)))).cast("int"))


def created_at(stamp, scraped, modified) -> Column:
    """When a file was made: its stamp, else the time of its data, else the file's own; what is illegible is passed over."""
    return F.coalesce(iso_instant(stamp)["at"], iso_instant(scraped)["at"], as_col(modified))


def heartbeat_old(seen, now, seconds: int = HEARTBEAT_SECONDS) -> Column:
    """Whether a sign of life is too old, or missing."""
    return as_col(seen).isNull() | (F.timestamp_diff("SECOND", as_col(seen), as_col(now)) > seconds)


def restore_minutes(text, now) -> Column:
    """Whole minutes until the time that a page names ("2024-01-20 9:05"); 0 if it names none or it has passed."""
    found = F.regexp_extract(_text(text), "(\\d{4}-\\d{2}-\\d{2})\\s+(\\d{1,2}:\\d{2})", 0)
    at = F.try_to_timestamp(F.regexp_replace(found, "\\s+", " "), F.lit("yyyy-MM-dd H:mm"))
    return F.greatest(F.lit(0), F.coalesce(F.floor(F.timestamp_diff("SECOND", as_col(now), at) / 60), F.lit(0))).cast("int")


# ---------------------------------------------------------------- store


def store_columns(scope_city: Column | None = None, stored_city: Column | None = None, unicode: bool = True) -> dict[str, Column]:
    """The fifteen columns that a store keeps of a record; null where it says nothing.

    A scope's city goes before the record's on writing, a stored city on filling up later.
    """
    place = F.filter(F.transform(F.split(_text("location"), "·"), lambda p: F.trim(p)), lambda p: p != "")
    pay = salary_bounds("salary")
    city = F.coalesce(*[_filled(c) for c in (scope_city, stored_city) if c is not None], F.get(place, F.lit(0)))
    title, company = _filled("title"), first_filled("company_name")
    canonical = canonical_id(F.coalesce(title, F.lit("")), F.coalesce(company, F.lit("")), F.coalesce(city, F.lit("")), unicode)
    known = canonical != ""
    return {
        "title": title, "company": company, "city": city, "district": F.get(place, F.lit(1)), "salary_min": pay["low"], "salary_max": pay["high"], "salary_desc": _filled("salary"),
        "experience": _filled("experience"), "education": _filled("education"), "recruit_type": P.recruit_type("job_type", "title"), "industry": _filled("company_industry"), "company_size": _filled("company_scale"),
        "url": _filled("job_link"), "canonical_id": F.when(known, canonical), "content_hash": F.when(known, content_hash(canonical, fingerprint("jd", "location", unicode=unicode))),
    }


def stated_post_type() -> Column:
    """agency or anonymous where the platform says so; a company's name is no proof here."""
    said = _text("post_type")
    return F.when(said.isin("agency", "anonymous"), said).when((_text("proxy_job") != "") | (_text("proxy_type") != "") | (_text("boss_title") == "猎头顾问"), "agency").otherwise("")


def payload_flags(risk: Column) -> Column:
    """Flags of a record in order, each once: its risk marks, its type where it is no social one, who posts it, ai_pm."""
    recruit = F.coalesce(_filled("recruit_type"), P.recruit_type("job_type", "title"))
    post = stated_post_type()
    own = F.array(F.when(recruit != "social", F.concat(F.lit("recruit:"), recruit)), F.when(post != "", F.concat(F.lit("post:"), post)), F.when(_text("direction") == "ai_pm", F.lit("ai_pm")))
    return F.array_distinct(F.filter(F.concat(F.transform(F.coalesce(risk, F.array().cast("array<string>")), lambda r: F.trim(r)), own), lambda f: f.isNotNull() & (f != "")))


def tags_json(tags: Column | str) -> Column:
    """Tags as JSON text; null without any."""
    kept = F.filter(F.transform(as_col(tags), lambda t: F.trim(t)), lambda t: t != "")
    return F.when(F.size(kept) > 0, F.to_json(kept))


# ---------------------------------------------------------------- payloads


#: What a detail's response says besides its body: activity of poster and company, state of the posting, the company.
DETAIL_FIELDS = ("boss_active_status", "brand_active_time", "job_status_desc", "brand_introduce", "brand_stage_name", "brand_scale_name", "brand_industry_name")


def detail_payload(payload: Column | str, least: int = LEAST_BODY) -> Column:
    """struct of a detail's response: jd, page_update_date, ``DETAIL_FIELDS``, failure, category. Failures are values, not exceptions.

    failure: not_json, request, code or short; category: what the code asks for. A response has no day of update.
    """
    doc = F.try_parse_json(as_col(payload))
    get = lambda path: F.coalesce(F.try_variant_get(doc, path, "string"), F.lit(""))
    is_object = F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))
    jd = tidy_lines(F.translate(get("$.jd"), "\u3000", " "))
    code = F.try_variant_get(doc, "$.code", "int")
    bad_code = F.coalesce(code, F.lit(0)) != 0
    failure = F.when(~is_object, "not_json").when(get("$.error") != "", "request").when(bad_code, "code").when(F.length(jd) < least, "short").otherwise("")
    ok = failure == ""
    return F.struct(F.when(ok, jd).otherwise("").alias("jd"), F.lit("").alias("page_update_date"), *[F.when(ok, get(f"$.{n}")).otherwise("").alias(n) for n in DETAIL_FIELDS], failure.alias("failure"), F.when(failure == "code", P.response_kind(code.cast("string"), get("$.msg"))).otherwise("").alias("category"))


def page_risk(url, title, slider, blocked, restore, login_required, cards, limited, login_wall, now) -> Column:
    """struct(category, minutes) of a probed page: captcha, account_risk, env_risk, rate_limit, login, or empty.

    Address, slider and block are proof enough; an empty list of cards takes titles and walls back.
    """
    minutes = restore_minutes(restore, now)
    flag = lambda c: F.coalesce(as_col(c), F.lit(False))
    holds = lambda c, words: reduce(lambda a, w: a | _text(c).contains(w), words, F.lit(False))
    kind = (
        F.when(holds(F.lower(as_col(url)), RISK_URLS) | flag(slider), "captcha")
        .when(flag(blocked), F.when(flag(login_required) | (minutes > ACCOUNT_MINUTES), "account_risk").otherwise("env_risk"))
        .when(F.coalesce(as_col(cards) == 0, F.lit(False)), "")
        .when(flag(limited), "rate_limit")
        .when(holds(title, RISK_TITLES), "captcha")
        .when(flag(login_wall), "login")
        .otherwise("")
    )
    return F.struct(kind.alias("category"), F.when(kind.isin("account_risk", "env_risk"), minutes).otherwise(0).alias("minutes"))


def id_list(text: Column | str) -> Column:
    """Ids in any of the shapes a list comes in: a JSON array, an object with job_ids or exclude_job_ids, text with commas or lines."""
    raw = _text(text)
    doc = F.try_parse_json(raw)
    strings = lambda path: F.try_variant_get(doc, path, "array<string>")
    lines = F.split(F.regexp_replace(raw, "\\n", ","), ",")
    kind = F.schema_of_variant(doc)
    values = F.when(kind.startswith("OBJECT"), F.coalesce(strings("$.job_ids"), strings("$.exclude_job_ids"), F.array().cast("array<string>"))).when(kind.startswith("ARRAY"), F.coalesce(strings("$"), F.array().cast("array<string>"))).otherwise(lines)
    return F.array_distinct(F.filter(F.transform(values, lambda v: F.trim(F.coalesce(v, F.lit("")))), lambda v: v != ""))


def pending_attempts(item: Column | str) -> Column:
    """struct(job_id, attempts) of an entry of a retry list: an object, or in old files the id alone."""
    doc = F.try_parse_json(as_col(item))
    plain = F.schema_of_variant(doc) == "STRING"
    job = F.trim(F.when(plain, F.try_variant_get(doc, "$", "string")).otherwise(F.try_variant_get(doc, "$.job_id", "string")))
    return F.struct(F.coalesce(job, F.lit("")).alias("job_id"), F.coalesce(F.when(~plain, F.try_variant_get(doc, "$.attempts", "int")), F.lit(0)).alias("attempts"))


def ledger_entries(ledger: Column | str) -> Column:
    """array<struct(job_id, reason, title, company)> of a ledger of dropped records: objects, or in old files the ids alone; entries without an id are left out."""
    items = F.coalesce(F.try_variant_get(F.try_parse_json(as_col(ledger)), "$", "array<variant>"), F.array().cast("array<variant>"))

    def entry(v: Column) -> Column:
        get = lambda n: F.coalesce(F.try_variant_get(v, f"$.{n}", "string"), F.lit(""))
        plain = F.schema_of_variant(v) == "STRING"
        return F.struct(F.trim(F.when(plain, F.coalesce(F.try_variant_get(v, "$", "string"), F.lit(""))).otherwise(get("job_id"))).alias("job_id"), *[F.when(plain, F.lit("")).otherwise(get(n)).alias(n) for n in ("reason", "title", "company")])

    return F.filter(F.transform(items, entry), lambda e: e.job_id != "")


# ---------------------------------------------------------------- views


def view(df: DataFrame, columns: tuple[str, ...], hidden: tuple[str, ...] = ()) -> DataFrame:
    """The named columns, those that are missing as empty text, without the hidden ones."""
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in columns if c not in hidden])


def flat(df: DataFrame, columns: tuple[str, ...], sources: dict[str, str] | None = None) -> DataFrame:
    """A table for CSV: the columns in order, some taken from columns of another name, lists joined by bars, the rest as text."""
    sources, kinds = sources or {}, {f.name: f.dataType for f in df.schema}

    def cell(name: str) -> Column:
        own = sources.get(name, name)
        if own not in kinds:
            return F.lit("").alias(name)
        text = F.array_join(own, " | ") if isinstance(kinds[own], T.ArrayType) else F.col(own).cast("string")
        return F.coalesce(text, F.lit("")).alias(name)

    return df.select(*map(cell, columns))


def with_header_of(df: DataFrame, header: list[str]) -> DataFrame:
    """Columns in the order of an older table's header, new ones behind; columns that are gone stay empty."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in header], *[c for c in df.columns if c not in header])


def detail_record(df: DataFrame) -> DataFrame:
    """A record with the names that older readers use."""
    return df.withColumns({"company": F.coalesce("company_name", F.lit("")), "tags_list": F.coalesce("tags", F.lit("")), "link": F.coalesce("job_link", F.lit(""))})


def shaped(paths: list[Column], shape: str) -> Column:
    """A value from raw ones by its declared shape: str, list, zero_as_empty, or join:separator, also join:separator|filter:value, which leaves values out."""
    if shape.startswith("join:"):
        by, _, without = shape[len("join:") :].partition("|filter:")
        return F.array_join(F.filter(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in paths]), lambda v: (v != "") & (v != without)), by)
    first = paths[0]
    if shape == "zero_as_empty":
        return F.when(F.coalesce(first.cast("string"), F.lit("")).isin("", "0"), "").otherwise(first.cast("string"))
    return first if shape == "list" else F.coalesce(first.cast("string"), F.lit(""))


def host_is(url: Column | str, domain: str) -> Column:
    """Whether a URL's host is the domain or one below it; never by a part of the text."""
    host = F.lower(F.regexp_replace(F.regexp_extract(_text(url), "^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), "\\.$", ""))
    return (host == domain) | host.endswith(f".{domain}")


def with_parameters(url: Column | str, domain: str, parameters: dict[str, Column]) -> Column:
    """A URL with the parameters that have a value and that it lacks; empty for other hosts. Names and values are taken to need no escapes."""
    u = _text(url)
    base, mark = F.substring_index(u, "#", 1), F.when(u.contains("#"), F.concat(F.lit("#"), F.substring_index(u, "#", -1))).otherwise("")
    query = F.when(base.contains("?"), F.regexp_extract(base, "\\?(.*)$", 1)).otherwise("")
    pairs = F.filter(F.split(query, "&"), lambda p: p != "")
    names = F.transform(pairs, lambda p: F.substring_index(p, "=", 1))
    extra = F.array_compact(F.array(*[F.when((F.coalesce(v, F.lit("")) != "") & ~F.array_contains(names, k), F.concat(F.lit(f"{k}="), v)) for k, v in parameters.items()]))
    both = F.concat(pairs, extra)
    return F.when(host_is(u, domain), F.concat(F.substring_index(base, "?", 1), F.when(F.size(both) > 0, F.concat(F.lit("?"), F.array_join(both, "&"))).otherwise(""), mark)).otherwise("")


def option_label(code: Column | str, options: dict[str, str]) -> Column:
    """The label of a filter's code; null for a code that no option has. options: label to code."""
    return reduce(lambda w, kv: w.when(as_col(code) == kv[1], F.lit(kv[0])), options.items(), F) if options else F.lit(None).cast("string")


def evidence(skills: Column | str, direction: Column | None = None, terms: Column | None = None) -> Column:
    """Why a record was kept, as far as its columns say: direction, terms, skills, labels, who posts, type, length of the body."""
    some = lambda a: F.array_join(F.slice(F.coalesce(a, F.array().cast("array<string>")), 1, 8), "、")
    parts = [("direction", direction), ("terms", None if terms is None else some(terms)), ("skills", some(as_col(skills))), ("labels", F.substring(_text("job_labels"), 1, 60)), ("post_type", _text("post_type")), ("recruit_type", _text("recruit_type")), ("jd", F.when(_text("jd") != "", F.length("jd").cast("string")))]
    return F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{n}="), v)) for n, v in parts if v is not None]))


def predicates() -> dict[str, Column]:
    """What is often asked of a record with post_type and recruit_type: is_agency, is_social, is_direct_social."""
    post, recruit = _text("post_type"), _text("recruit_type")
    return {"is_agency": post.isin("agency", "anonymous"), "is_social": recruit == "social", "is_direct_social": (recruit == "social") & (post == "direct")}


def is_sales(title="title", body="jd", rules=P.DEFAULT) -> Column:
    """Whether a title or a body (without white space) has a term of sales."""
    low = F.lower(_text(title))
    return P.contains_any(low, rules.sales_title_terms) | P.contains_any(F.lower(F.regexp_replace(_text(body), "\\s+", "")), rules.sales_body_terms)
