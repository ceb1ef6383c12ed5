"""Daily brief, status and texts for people, made from small result tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def brief(runs: DataFrame, day: Column, at: str, keyword: str, place: str, failed: Column, key: str) -> DataFrame:
    """One row for a day: runs, failed ones, keywords by first use, the commonest place (ties by name), new keys."""
    rows = runs.where(F.to_date(at) == day)
    first = rows.groupBy(keyword).agg(F.min(F.struct(at, key)).alias("t"))
    words = first.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", F.col(keyword).alias("w")))), lambda x: x.w), ",").alias("keywords"))
    places = rows.groupBy(place).agg(F.count("*").alias("n")).agg(F.min_by(place, F.struct(-F.col("n"), F.col(place))).alias("place"))
    known = runs.where(F.to_date(at) < day).select(F.col(place).alias("_p")).distinct()
    fresh = rows.select(place).distinct().join(known, F.col(place) == F.col("_p"), "left_anti").agg(F.count("*").alias("new_places"))
    counts = rows.agg(F.count("*").alias("runs"), F.count_if(failed).alias("failed"))
    # one row each
    return counts.join(F.broadcast(words)).join(F.broadcast(places)).join(F.broadcast(fresh))


def status(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """name, rows, latest of each table (with its time column): the head of a status report."""
    parts = [df.agg(F.lit(n).alias("name"), F.count("*").alias("rows"), F.max(F.col(at).cast("string")).alias("latest")) for n, (df, at) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def run_report(listed: DataFrame, details: DataFrame, failures: DataFrame, used: DataFrame, limit: int) -> DataFrame:
    """One row of a run: list_rows, detail_rows, with_body, failures, used and what is left of the budget. used: one row."""
    filled = F.coalesce(F.trim("jd"), F.lit("")) != ""
    parts = [listed.agg(F.count("*").alias("list_rows")), details.agg(F.count("*").alias("detail_rows"), F.count_if(filled).alias("with_body")), failures.agg(F.count("*").alias("failures")), used.select("used")]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p))  # one row each
    return out.withColumn("budget_left", F.greatest(F.lit(0), F.lit(limit) - F.col("used")))


def new_on(seen: DataFrame, key: str, day: str, on: Column, kind: str, product: DataFrame) -> DataFrame:
    """One row: keys first seen on a day, those of them in the product, and how many there are of each kind on that day (kind:count, the most first)."""
    fresh = seen.groupBy(F.col(key).alias("_k")).agg(F.min(day).alias("_first")).where(F.col("_first") == on).select("_k")
    here = fresh.join(product.select(F.col(key).alias("_p")).distinct(), F.col("_k") == F.col("_p"), "left_semi").agg(F.count("*").alias("new_in_product"))
    kinds = seen.where(F.col(day) == on).select(key, kind).distinct().join(fresh, F.col(key) == F.col("_k")).groupBy(kind).agg(F.count("*").alias("n"))
    text = kinds.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("m"), F.col(kind).alias("t")))), lambda x: F.concat_ws(":", x.t, -x.m)), ",").alias("by_type"))
    return fresh.agg(F.count("*").alias("new_jobs")).join(F.broadcast(here)).join(F.broadcast(text))  # one row each


def text_table(df: DataFrame, most: int = 20) -> str:
    """The first rows of a small result as aligned text, with a line if there are more. At most ``most`` + 1 rows reach the driver."""
    rows = df.limit(most + 1).collect()
    cells = [list(df.columns), *[["" if v is None else f"{v:g}" if isinstance(v, float) else str(v) for v in r] for r in rows[:most]]]
    width = [max(len(r[i]) for r in cells) for i in range(len(df.columns))]
    lines = ["  ".join(v.ljust(w) for v, w in zip(r, width, strict=True)).rstrip() for r in cells]
    return "\n".join(lines + ["…"] * (len(rows) > most))


def report(parts: dict[str, DataFrame], most: int = 20) -> str:
    """Several result tables under their names."""
    return "\n\n".join(f"{name}\n{text_table(df, most)}" for name, df in parts.items())
