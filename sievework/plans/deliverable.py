"""The deliverable: postings derived, filtered, merged, deduplicated and marked, with the ledger of what was dropped; its lineage and its market."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions import postings as P
from sievework.functions import text as X
from sievework.operators import dedupe, filters, merge, summary
from sievework.ruleset import DEFAULT, RuleSet


@dataclass
class Deliverable:
    """kept rows; dropped rows with job_id and reason; rows without a body."""

    kept: DataFrame
    dropped: DataFrame
    bodyless: DataFrame


def derive(df: DataFrame, rules: RuleSet = DEFAULT, today: Column | None = None) -> DataFrame:
    """Records with the derived columns: types, activity, direction, pay, title key, fingerprint, marks of copies as of a single record and, given the day, risk flags."""
    d, s = P.direction("title", "jd", "skills", rules), P.salary_parts("salary")
    out = df.withColumns({
        "post_type": P.post_type("proxy_job", "proxy_type", "boss_title", "company_name", rules), "recruit_type": P.recruit_type("job_type", "title"), "active_state": P.active_state("boss_active_status"),
        "title_key": X.title_key("title"), "direction": d["label"], "direction_evidence": d["evidence"], "is_ai_pm": d["label"] == "ai_pm",
        "salary_min": s["low"], "salary_max": s["high"], "salary_unit": s["unit"], "salary_months": s["months"], "fingerprint": X.fingerprint("jd", "location", rules.fingerprint_body, rules.fingerprint_place),
        "dup_group": F.lit(""), "dup_size": F.lit(1).cast("long"), "is_primary": F.lit(True),
    })
    return out if today is None else out.withColumn("risk_flags", P.risk_flags("company_name", "title", "jd", "location", "post_type", "page_update_date", today, rules=rules))


def build(listed: DataFrame, details: DataFrame, recruit_types: tuple[str, ...] = (), block: tuple[str, ...] = (), allow: tuple[str, ...] = (), keep_junk: bool = False, keep_without_body: bool = False, rules: RuleSet = DEFAULT, today: Column | None = None, exclude: DataFrame | None = None, before: Deliverable | None = None) -> Deliverable:
    """Lists (with ordinal) and details (with ordinal) to a deliverable. Reasons are codes; nothing is dropped without one.

    Keys of ``exclude`` (job_id) take no part, neither as lists nor as details. With the deliverable ``before``, what was
    dropped and what lacks a body add up over the runs: the first entry of a key stays, until the key is kept.
    """
    if exclude is not None:
        gone = exclude.select(F.trim("job_id").alias("_gone")).where("_gone <> ''").distinct()
        listed, details = (df.join(gone, F.col("job_id") == F.col("_gone"), "left_anti") for df in (listed, details))
    merged = derive(merge.merge_details(listed, details.drop("path"), "job_id", "jd", "ordinal"), rules, today)
    merged = merged.withColumns({"_title": X.nfkc("title"), "_body": X.nfkc("jd")})
    reason = filters.relevance_reason(F.col("recruit_type"), F.col("company_industry"), F.col("title"), recruit_types, block, allow)
    marked = merged.withColumn("reason", reason)
    if not keep_junk:
        marked = P.with_junk_reason(marked, rules=rules, title_norm="_title", body_norm="_body", name="_junk").withColumn("reason", F.coalesce("reason", "_junk")).drop("_junk")
    kept, dropped = filters.split_marked(marked.drop("_title", "_body"))
    bare = F.coalesce(F.trim("jd"), F.lit("")) == ""
    bodyless = kept.where(bare)
    if not keep_without_body:
        kept = kept.where(~bare)
    newest = F.coalesce(-F.unix_date(F.to_date(F.try_to_timestamp(F.substring("page_update_date", 1, 10), F.lit("yyyy-MM-dd")))), F.lit(1))
    best, _ = dedupe.keep_best(kept.withColumns({"_title": X.title_key("title"), "_company": F.regexp_replace("company_name", "[()（）【】\\[\\]·\\s]", ""), "_city": F.substring_index("location", "·", 1)}), ["_title", "_company", "_city"], [newest, -F.length(F.coalesce("jd", F.lit(""))), F.col("job_id")], "job_id")
    marked = dedupe.mark_groups(best.drop("_title", "_company", "_city", "dup_group", "dup_size", "is_primary"), "fingerprint", ["ordinal", "job_id"])
    out = Deliverable(marked, dropped.select("job_id", "title", "company_name", "reason"), bodyless.select("job_id", "title"))
    if before is not None:
        out.dropped, out.bodyless = accumulated(before.dropped, out.dropped, marked), accumulated(before.bodyless, out.bodyless, marked)
    return out


def accumulated(before: DataFrame, now: DataFrame, kept: DataFrame, key: str = "job_id") -> DataFrame:
    """A ledger over the runs: each key's first entry, those of before first; keys that are kept by now, and blank ones, have none."""
    values = [c for c in before.columns if c != key]
    both = before.withColumn("_run", F.lit(0)).unionByName(now.select(*before.columns).withColumn("_run", F.lit(1))).where(F.coalesce(F.trim(key), F.lit("")) != "")
    first = both.groupBy(key).agg(F.min_by(F.struct(*values), F.struct("_run", *values)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in values])
    return first.join(kept.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_anti")


def registered(built: list[tuple[str, str, str, Deliverable]]) -> tuple[DataFrame, DataFrame]:
    """(items, deliverables) that the questions read, from a few deliverables: path, scope_key, created_at as ISO text, and what was built."""
    items = deliverables = None
    for path, scope, at, d in built:
        rows = d.kept.select("job_id", F.lit("kept").alias("kind"), F.lit("").alias("reason"))
        rows = rows.union(d.dropped.select("job_id", F.lit("dropped"), "reason")).union(d.bodyless.select("job_id", F.lit("no_body"), F.lit(""))).withColumn("path", F.lit(path))
        head = d.kept.sparkSession.range(1).select(F.lit(path).alias("path"), F.lit(scope).alias("scope_key"), F.lit(at).alias("created_at"))
        items, deliverables = (rows, head) if items is None else (items.unionByName(rows), deliverables.unionByName(head))
    return items, deliverables


def lineage(d: Deliverable, source: dict[str, str], rules: RuleSet = DEFAULT) -> DataFrame:
    """One row for a deliverable's meta data: where it comes from (texts such as city, keyword, scope_key), the rules' version, and what was kept, dropped and without body."""
    count = lambda df, name: df.agg(F.count("*").alias(name))
    row = count(d.kept, "kept").join(F.broadcast(count(d.dropped, "dropped"))).join(F.broadcast(count(d.bodyless, "no_body")))  # one row each
    return row.select(*[F.lit(v).alias(k) for k, v in sorted(source.items())], F.lit(rules.version).alias("ruleset_version"), "kept", "dropped", "no_body")


def market_summary(d: Deliverable, top: int = 10) -> dict[str, DataFrame]:
    m = P.monthly_range("salary")
    bucketed = d.kept.withColumn("bucket", P.experience_bucket("experience"))
    direct = F.col("post_type") == "direct"
    tables = summary.posting_dimensions("skills", [], None)
    return {
        "pay": summary.markets(d.kept, m["low"], m["high"], {"all": F.lit(True), "direct": direct, "agency": ~direct, "social_direct": direct & (F.col("recruit_type") == "social")}),
        "pay_by_experience": summary.pay_stats(bucketed, m["low"], m["high"], ["bucket"]),
        "top": summary.top_values(d.kept, {n: c for n, c in tables.items() if n not in ("term", "icon")}, top, "ordinal"),
        "top_pay": summary.top_pay(d.kept, "ordinal", ["title", "salary", "company_name", "location"], top),
        "input": summary.reconciled(d.kept, d.dropped),
        "directions": d.kept.groupBy("direction").count(),
    }
