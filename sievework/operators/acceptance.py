"""Acceptance of a delivery: properties of its records as findings, the consumers' contract, and the verdict.

Every property of single rows is counted in one pass; properties of groups come from aggregates that combine
before they shuffle. What is expected of derived columns is derived here again from the platform's own
columns, so that a slip in the rules that made them is found. The clock is a parameter.
"""

from __future__ import annotations

from dataclasses import dataclass, field
import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.payloads import secret_keys
from sievework.functions.text import contains_any, fingerprint, iso_instant, title_key, title_matches_body
from sievework.ruleset import DEFAULT


@dataclass(frozen=True)
class Spec:
    """What a consumer asks of a delivery, as data. The defaults are fixed values of the contract."""

    required: tuple[str, ...] = ("job_id", "title", "company_name", "salary", "location", "job_link")
    required_with_bodies: tuple[str, ...] = ("jd",)
    company_block: tuple[str, ...] = ("company_name", "company_industry", "company_scale", "company_stage", "company_link")
    labels: dict[str, tuple[str, ...]] = field(default_factory=lambda: {"post_type": ("direct", "agency", "anonymous"), "recruit_type": ("social", "intern", "campus"), "active_state": ("active", "inactive", "unknown"), "title_key": ()})
    forbidden: tuple[str, ...] = ("security_id", "lid", "encrypt_job_id", "encrypt_boss_id", "encrypt_brand_id")
    types: dict[str, str] = field(default_factory=lambda: dict.fromkeys(("jd", "title", "title_key", "salary", "location", "company_name", "job_link", "link_verified_at", "tier"), "string") | dict.fromkeys(("skills", "skill_tags", "direction_evidence", "risk_flags", "tier_evidence"), "array"))
    registry: tuple[str, ...] = tuple("job_id job_link company_link link_verified_at title title_key salary salary_source salary_min salary_max salary_unit months_per_year location tags experience education skills skill_tags job_labels welfare icon_flags icon_word job_valid_status company_name company_scale company_stage company_industry boss_name boss_title boss_active_status anonymous proxy_job proxy_type job_type jd page_update_date tags_list job_status_desc brand_introduce brand_scale_name brand_stage_name brand_industry_name brand_active_time risk_flags post_type recruit_type active_state dup_group dup_size is_primary is_ai_pm direction direction_evidence tier_evidence tier company link duplicate_count duplicate_job_ids".split())
    negotiable: tuple[str, ...] = ("面议", "面谈", "不限", "negotiable", "价格面议")
    falsy: tuple[str, ...] = ("", "0", "false", "no", "none", "null")
    junk_tail: str = "薪资详情|社保类型|提成方式|刚刚活跃|今日活跃|本周活跃|·招聘专员|奖金补贴|3日内活跃|2周内活跃|本月活跃|·招聘主管|·HRBP"
    least_body: int = 120
    link_hours: int = 168
    root_rate: float = 0.6
    city_rate: float = 0.95
    duplicate_share: float = 0.2


DEFAULT_SPEC = Spec()

#: Fixed values of the consumers' validator: its version, the fields it asks for, the formats it knows.
VALIDATOR_VERSION, CONTRACT_FIELDS, FORMATS = "2.1.0", ("job_id", "title", "location", "job_link", "company_name"), (1, 2)

Check = tuple[str, str, Column]


def said(name: str) -> Column:
    """A column's text, trimmed; empty for null."""
    return F.coalesce(F.trim(F.col(name).cast("string")), F.lit(""))


def counted(df: DataFrame, checks: list[Check]) -> DataFrame:
    """id, level, count of each check (id, level, number that a row adds or condition), in one pass; zeros included."""
    number = lambda c: F.coalesce(c.cast("long"), F.lit(0))
    row = df.agg(*[F.coalesce(F.sum(number(c)), F.lit(0)).alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    parts = [F.struct(F.lit(n).alias("id"), F.lit(level).alias("level"), F.col(f"c{i}").alias("count")) for i, (n, level, _) in enumerate(checks)]
    return row.select(F.explode(F.array(*parts)).alias("f")).select("f.*")


def expected_post_type(spec: Spec = DEFAULT_SPEC) -> Column:
    proxy = ~F.lower(said("proxy_job")).isin(*spec.falsy) | ~F.lower(said("proxy_type")).isin(*spec.falsy)
    name = said("company_name")
    hidden = reduce(lambda a, s: a | name.startswith(s), DEFAULT.anonymous_starts, F.lit(False)) | contains_any(name, DEFAULT.fragile_terms)
    return F.when(proxy | said("boss_title").isin(*DEFAULT.agency_titles), "agency").when(hidden, "anonymous").otherwise("direct")


def expected_recruit_type() -> Column:
    code = said("job_type")
    return F.when((code == "") & said("title").contains("实习"), "intern").when(code == "4", "intern").when(code == "5", "campus").otherwise("social")


def expected_active_state() -> Column:
    text = said("boss_active_status")
    return F.when(text.rlike("(?:\\d+\\s*)?(?:个?月|周|年)\\s*前活跃"), "inactive").when((text == "在线") | text.endswith("活跃"), "active").otherwise("unknown")


def contradictions(spec: Spec = DEFAULT_SPEC, unicode: bool = True) -> dict[str, Column]:
    """How often a row contradicts itself, by seven kinds."""
    n = lambda *cs: reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(False)).cast("int") for c in cs])
    post, recruit, state, code = said("post_type"), said("recruit_type"), said("active_state"), said("job_type")
    pay, source, key = said("salary"), said("salary_source"), said("title_key")
    negotiable = F.lower(pay).isin(*spec.negotiable)
    legible = negotiable | (pay.rlike("\\d") & pay.rlike("(?i)[k千万元块薪天时月年]"))
    named_intern = (code == "") & said("title").contains("实习")
    structured = [negotiable & (said(c) != "") for c in ("salary_min", "salary_max", "salary_unit", "months_per_year")]
    return {
        "post_type": n((post != "") & (post != expected_post_type(spec))),
        "recruit_type": n((recruit != "") & (recruit != expected_recruit_type()), (recruit == "intern") & (code != "4") & ~named_intern, (recruit == "campus") & (code != "5")),
        "active_state": n((state != "") & (state != expected_active_state()), (state == "active") & ~said("job_valid_status").isin("", "1")),
        "title_key": n((said("title") != "") & (key != "") & (title_key("title", unicode) != title_key("title_key", unicode))),
        "salary": n((pay != "") & ~legible, *structured, (source == "api") & (pay == ""), (source == "api_empty") & (pay != "")),
        "job_type": n(~code.isin("", "4", "5")),
        "social_daily": n((recruit == "social") & (pay.contains("/天") | (F.lower(said("salary_unit")) == "day"))),
    }


def row_checks(now: Column, spec: Spec = DEFAULT_SPEC, with_bodies: bool = True, unicode: bool = True) -> list[Check]:
    """The properties that single rows have or lack."""
    stamp, link, job = said("link_verified_at"), said("job_link"), said("job_id")
    at = iso_instant("link_verified_at")
    grouped = said("dup_group") != ""
    required = spec.required + (spec.required_with_bodies if with_bodies else ())
    body = said("jd")
    out: list[Check] = [(f"required:{f}", "error", said(f) == "") for f in required]
    out.append(("company_block", "error", reduce(lambda a, f: a & (said(f) == ""), spec.company_block, F.lit(True))))
    out.append(("body_mismatch", "warn", ~title_matches_body(F.col("title"), F.regexp_replace(F.col("jd"), "\\s+", ""))))
    out.append(("link_stamp", "warn", stamp == ""))
    out += [(f"label_missing:{f}", "warn", said(f) == "") for f in spec.labels]
    out += [(f"label_illegal:{f}", "error", (said(f) != "") & ~said(f).isin(*values)) for f, values in spec.labels.items() if values]
    out.append(("body_short", "error", (body != "") & (F.length("jd") < spec.least_body)))
    out.append(("junk_tail", "error", F.col("jd").rlike(spec.junk_tail)))
    out += [(f"contradiction:{k}", "error", c) for k, c in contradictions(spec, unicode).items()]
    out.append(("identity", "error", job.rlike("^[0-9a-f]{16}$") & (link != "") & (job != F.substring(F.md5(link), 1, 16))))
    out.append(("stamp_illegible", "error", (stamp != "") & at["at"].isNull()))
    out.append(("stamp_old", "warn", at["zoned"] & (F.timestamp_diff("SECOND", at["at"], now) > spec.link_hours * 3600)))
    out.append(("stamp_naive", "warn", at["at"].isNotNull() & ~at["zoned"]))
    # a size or a mark of a copy without a group
    out.append(("loose_flags", "error", F.coalesce((~grouped & (F.col("dup_size") != 1)).cast("int"), F.lit(0)) + F.coalesce((~grouped & ~F.col("is_primary")).cast("int"), F.lit(0))))
    return out


def group_checks(df: DataFrame, unicode: bool = True) -> DataFrame:
    """id, level, count: repeated ids, links with several ids and the reverse, groups whose size, primary or content is wrong, contents that lack a common group."""
    ids = df.where(said("job_id") != "").groupBy(said("job_id").alias("k")).agg(F.count("*").alias("n"))
    repeated = counted(ids, [("repeated_id", "error", F.col("n") - 1)])
    pairs = df.where((said("job_id") != "") & (said("job_link") != "")).select(said("job_id").alias("a"), said("job_link").alias("b"))
    # least and greatest tell whether a value stands with several, without holding them
    several = lambda x, y, name: counted(pairs.groupBy(x).agg((F.min(y) != F.max(y)).alias("bad")), [(name, "error", F.col("bad"))])
    content = F.substring(F.regexp_replace(F.lower(F.coalesce(F.col("jd"), F.lit(""))), "\\s+", ""), 1, DEFAULT.fingerprint_body)
    groups = df.where(said("dup_group") != "").groupBy(said("dup_group").alias("g"), F.col("dup_size").cast("long").alias("size")).agg(F.count("*").alias("n"), F.count_if(F.coalesce(F.col("is_primary"), F.lit(False))).alias("p"), F.min(content).alias("low"), F.max(content).alias("high"))
    sums = groups.groupBy("g").agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.min("low").alias("low"), F.max("high").alias("high"))
    wrong = groups.select("g", "size", F.col("n").alias("rows")).join(sums.select("g", "n"), "g")
    sizes = counted(wrong, [("group_size", "error", F.when(F.col("size").isNotNull() & (F.col("size") != F.col("n")), F.col("rows")))])
    members = counted(sums, [("group_primary", "error", F.col("p") != 1), ("group_content", "error", F.col("low") != F.col("high"))])
    prints = df.select(fingerprint("jd", "location", DEFAULT.fingerprint_body, DEFAULT.fingerprint_place, unicode).alias("fp"), said("dup_group").alias("g")).where("fp <> ''")
    same = prints.groupBy("fp").agg(F.count("*").alias("n"), F.min("g").alias("low"), F.max("g").alias("high")).where("n > 1")
    unmarked = counted(same, [("ungrouped_content", "error", (F.col("low") == "") | (F.col("low") != F.col("high")))])
    return reduce(DataFrame.union, [repeated, several("b", "a", "link_of_several"), several("a", "b", "id_of_several"), sizes, members, unmarked])


def request_checks(df: DataFrame, roots: tuple[str, ...] = (), city: str = "", declared: int | None = None, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """id, level, count: titles without any root and rows of other cities, where too many; a declared number that differs; what the request leaves unsaid."""
    squeezed = F.regexp_replace(F.lower(F.coalesce(F.col("title"), F.lit(""))), "\\s+", "")
    hit = contains_any(squeezed, tuple(r.lower().replace(" ", "") for r in roots))
    here = F.lower(F.trim(F.substring_index(said("location"), "·", 1))) == city.strip().lower()
    row = df.agg(F.count("*").alias("n"), F.count_if(~hit).alias("off"), F.count_if(~here).alias("away"))
    parts = [F.struct(F.lit("request_roots").alias("id"), F.lit("error" if roots else "warn").alias("level"), (F.when(F.col("n") - F.col("off") < spec.root_rate * F.col("n"), F.col("off")).otherwise(0) if roots else F.lit(1)).cast("long").alias("count"))]
    city_code = city.isdigit() and 6 <= len(city) <= 9
    known = bool(city) and not city_code
    parts.append(F.struct(F.lit("request_city").alias("id"), F.lit("error" if known else "warn").alias("level"), (F.when(F.col("n") - F.col("away") < spec.city_rate * F.col("n"), F.col("away")).otherwise(0) if known else F.lit(1)).cast("long").alias("count")))
    parts.append(F.struct(F.lit("request_count").alias("id"), F.lit("warn" if declared is None else "error").alias("level"), (F.lit(1) if declared is None else F.abs(F.col("n") - declared)).cast("long").alias("count")))
    return row.select(F.explode(F.array(*parts)).alias("f")).select("f.*")


def key_checks(payloads: DataFrame, payload: str, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """id, level, count over records as JSON: forbidden and unregistered keys (different ones), and values of another type than declared."""
    keys = payloads.select(F.explode(F.json_object_keys(payload)).alias("k")).distinct()
    found = counted(keys, [("forbidden_key", "error", F.col("k").isin(*spec.forbidden)), ("unregistered_key", "warn", ~F.col("k").isin(*spec.registry))])
    doc = payloads.select(F.try_parse_json(payload).alias("doc"))
    kind = lambda f: F.schema_of_variant(F.try_variant_get("doc", f"$.{f}", "variant"))
    fits = {"string": lambda k: k == "STRING", "array": lambda k: k.isin("ARRAY<STRING>", "ARRAY<VOID>")}
    return found.union(counted(doc, [(f"type:{f}", "error", kind(f).isNotNull() & (kind(f) != "VOID") & ~fits[t](kind(f))) for f, t in spec.types.items()]))


def sensitive_keys(payloads: DataFrame, payload: Column | None = None) -> DataFrame:
    """id, level, count: an error for each secret or internal key and URL parameter, at any depth of the records (or of their ``payload``, JSON), with the number of records that hold it."""
    text = F.to_json(F.struct("*")) if payload is None else payload
    found = payloads.select(F.explode(secret_keys(text)).alias("k")).groupBy("k").agg(F.count("*").alias("count"))
    return found.select(F.concat(F.lit("sensitive:"), "k").alias("id"), F.lit("error").alias("level"), "count")


def check_export(df: DataFrame, now: Column, roots: tuple[str, ...] = (), city: str = "", declared: int | None = None, payload: str | None = None, spec: Spec = DEFAULT_SPEC, with_bodies: bool = True, unicode: bool = True) -> DataFrame:
    """id, level, count of everything that is wrong with a delivery; an empty one has the finding ``empty``. The records as JSON (``payload``) let keys be checked too."""
    parts = [counted(df, row_checks(now, spec, with_bodies, unicode)), group_checks(df, unicode), request_checks(df, roots, city, declared, spec), sensitive_keys(df, F.col(payload) if payload else None)]
    if payload:
        parts.append(key_checks(df, payload, spec))
    found = reduce(DataFrame.union, parts).where("count > 0")
    empty = df.agg(F.count("*").alias("n")).where("n = 0").select(F.lit("empty").alias("id"), F.lit("error").alias("level"), F.lit(1).cast("long").alias("count"))
    return found.union(empty)


def verdict(found: DataFrame) -> DataFrame:
    """One row for a delivery's meta data: ok, errors, warnings (kinds), wrong (what errors count)."""
    error = F.col("level") == "error"
    return found.agg((F.count_if(error) == 0).alias("ok"), F.count_if(error).alias("errors"), F.count_if(F.col("level") == "warn").alias("warnings"), F.coalesce(F.sum(F.when(error, F.col("count"))), F.lit(0)).alias("wrong"))


def shape(df: DataFrame) -> DataFrame:
    """One row: rows and shape, detail if any record has a body, else list."""
    return df.agg(F.count("*").alias("rows"), F.when(F.coalesce(F.bool_or(said("jd") != ""), F.lit(False)), "detail").otherwise("list").alias("shape"))


def invariants(df: DataFrame, print_: Column, spec: Spec = DEFAULT_SPEC) -> DataFrame:
    """name, bad, ok: ten properties that every delivery has. dup_ratio counts rows beyond the first of a content."""
    fields = ("title", "company_name", "salary", "location", "job_link")
    # a body that is not there is short as well
    checks = [("body_present", "", said("jd") == ""), ("body_length", "", F.length(F.coalesce("jd", F.lit(""))) < spec.least_body), ("junk_tail", "", F.col("jd").rlike(spec.junk_tail)), ("post_type", "", said("post_type") == "")]
    checks += [(f"field_{f}", "", said(f) == "") for f in fields] + [("link_stamp", "", said("link_verified_at") == "")]
    rows = counted(df, checks).select(F.col("id").alias("name"), F.col("count").alias("bad"), (F.col("count") == 0).alias("ok"))
    copies = df.groupBy(print_.alias("p")).agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.when(F.col("p") != "", F.col("n") - 1)), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("all"))
    return rows.union(copies.select(F.lit("dup_ratio"), "bad", F.col("bad") <= spec.duplicate_share * F.col("all")))


def validate(jobs: DataFrame, meta: dict, payload: str | None = None) -> DataFrame:
    """id, level, count: the consumers' contract over an export's records (as JSON in ``payload``, or as they are) and its meta data (format_version, job_count, mode, observed_jobs, exhausted)."""
    blank = [(f"missing:{f}", "error", said(f) == "") for f in CONTRACT_FIELDS]
    ids = jobs.where(said("job_id") != "").groupBy(said("job_id").alias("k")).agg(F.count("*").alias("n"))
    found = counted(jobs, blank).union(counted(ids, [("repeated_id", "error", F.col("n") > 1)]))
    texts = jobs.select(F.col(payload) if payload else F.to_json(F.struct("*"))).union(jobs.sparkSession.range(1).select(F.lit(json.dumps(meta, default=str))))
    found = found.union(sensitive_keys(texts.toDF("text"), F.col("text")))
    mode, seen, done = meta.get("mode"), meta.get("observed_jobs"), meta.get("exhausted")
    said_ = [
        ("format_version", "error", type(meta.get("format_version")) is not int or meta["format_version"] not in FORMATS),
        ("mode_type", "error", mode is not None and not isinstance(mode, str)),
        ("mode_unknown", "warn", isinstance(mode, str) and mode != "incremental"),
        ("observed_type", "error", seen is not None and (not isinstance(seen, list) or not all(isinstance(x, str) for x in seen))),
        ("observed_missing", "warn", mode == "incremental" and seen is None),
        ("exhausted_type", "error", done is not None and not isinstance(done, bool)),
    ]
    counts = jobs.agg(F.count("*").alias("n"))
    declared = meta.get("job_count")
    differs = F.col("n") != declared if isinstance(declared, int) else F.lit(True)
    extra = counts.select(F.explode(F.array(F.struct(F.lit("job_count").alias("id"), F.lit("warn").alias("level"), differs.cast("long").alias("count")), *[F.struct(F.lit(n).alias("id"), F.lit(level).alias("level"), F.lit(int(bad)).cast("long").alias("count")) for n, level, bad in said_])).alias("f")).select("f.*")
    return found.union(extra).where("count > 0")


def verify(listed: DataFrame, details: DataFrame, least: int = 50) -> DataFrame:
    """One row: what is wrong with a list and its details, and how much of the list the details cover."""
    a = listed.groupBy(said("job_id").alias("k")).agg(F.count("*").alias("n"), F.count_if(said("title") == "").alias("untitled"))
    b = details.groupBy(said("job_id").alias("k")).agg(F.count("*").alias("n"), F.count_if(F.length(F.coalesce("jd", F.lit(""))) < least).alias("short"))
    both = a.select("k", F.col("n").alias("ln"), "untitled").join(b.select("k", F.col("n").alias("dn"), "short"), "k", "full")
    real = F.col("k") != ""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    out = both.agg(
        total("ln").alias("list_rows"), total("dn").alias("detail_rows"), total(F.when(real, F.col("untitled")).otherwise(F.col("ln"))).alias("list_incomplete"),
        F.count_if(real & (F.col("ln") > 1)).alias("list_repeated"), F.count_if(real & (F.col("dn") > 1)).alias("detail_repeated"), total("short").alias("short_bodies"),
        F.count_if(real & F.col("ln").isNotNull()).alias("ids"), F.count_if(real & F.col("ln").isNotNull() & F.col("dn").isNull()).alias("missing"),
    )
    return out.withColumn("coverage", F.when(F.col("ids") > 0, F.round((F.col("ids") - F.col("missing")) / F.col("ids"), 4)).otherwise(0.0)).withColumn("ok", (F.col("list_rows") > 0) & (F.col("detail_rows") > 0) & (F.col("list_incomplete") + F.col("list_repeated") + F.col("detail_repeated") + F.col("short_bodies") + F.col("missing") == 0))
