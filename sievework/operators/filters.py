"""Filters that give reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.functions.postings import with_junk_reason
from sievework.functions.text import contains_any, nfkc
from sievework.ruleset import DEFAULT, RuleSet


def relevance_reason(recruit: Column, industry: Column, title: Column, types: tuple[str, ...] = (), block: tuple[str, ...] = (), allow: tuple[str, ...] = (), terms: tuple[str, ...] = ()) -> Column:
    """recruit_type, industry_block, industry_allow or title: the first filter that a row fails; null if it passes. A missing industry passes the allow list."""
    ind = F.coalesce(industry, F.lit(""))
    never = F.lit(False)
    return (
        F.when(~recruit.isin(*types) if types else never, "recruit_type")
        .when(contains_any(ind, block), "industry_block")
        .when((ind != "") & ~contains_any(ind, allow) if allow else never, "industry_allow")
        .when(~contains_any(F.lower(title), tuple(t.lower() for t in terms)) if terms else never, "title")
    )


def split_by(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """(kept rows, dropped rows with their reason)."""
    return split_marked(df.withColumn("reason", reason))


def split_marked(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept rows, dropped rows) of rows with a reason, null for those that stay."""
    return marked.where("reason is null").drop("reason"), marked.where("reason is not null")


def reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    return df.select(F.coalesce(reason, F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


def drop_junk(postings: DataFrame, rules: RuleSet = DEFAULT, with_body: bool = True) -> tuple[DataFrame, DataFrame]:
    """The junk cascade over postings; before details are there, without bodies."""
    rows = postings.withColumns({"_title": nfkc("title"), "_body": nfkc("jd") if with_body else F.lit("")})
    marked = with_junk_reason(rows, body=F.col("jd") if with_body else F.lit(""), rules=rules, title_norm="_title", body_norm="_body")
    return split_marked(marked.drop("_title", "_body"))


def on_day(at: Column, day: Column, zone: str) -> Column:
    """Whether an instant falls on a day of a time zone; the session runs in UTC."""
    return F.coalesce(F.to_date(F.from_utc_timestamp(at, zone)) == day, F.lit(False))


def without_inactive(df: DataFrame, statuses: DataFrame, key: str, status: str, order: str) -> DataFrame:
    """Rows but those whose newest known status says they are long inactive. A detail's status, the last by ``order``, goes before the list's, a blank one as well."""
    s = statuses.groupBy(F.col(key).alias("_k")).agg(F.max_by(F.coalesce(F.col(status), F.lit("")), order).alias("_status"))
    both = df.join(s, F.col(key) == F.col("_k"), "left").drop("_k")
    said = F.coalesce(F.col("_status"), F.col(status))
    return both.where(~F.coalesce(said.rlike("(?:\\d+\\s*)?(?:个?月|周|年)\\s*前活跃"), F.lit(False))).drop("_status")


def missing_fields(required: list[str]) -> Column:
    """Names of the required columns that are null or blank."""
    return F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in required]))


def excluded(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return df.join(keys.select(key), key, "left_anti")
