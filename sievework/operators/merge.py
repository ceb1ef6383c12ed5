"""Joins of lists with details: merging, association, reconciling, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def filled(df: DataFrame, name: str) -> Column:
    """Column that is null where the value says nothing: blank text, empty array or map."""
    kind = df.schema[name].dataType
    c = df[name]
    if isinstance(kind, T.StringType):
        return F.when(c != "", c)
    if isinstance(kind, (T.ArrayType, T.MapType)):
        return F.when(F.size(c) > 0, c)
    return c


def last_details(details: DataFrame, key: str, body: str, order: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Of each key's details with a body, the last; of those that are last together, the first by ``ties``."""
    rows = details.where(F.trim(body) != "")
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc(), *ties))).where("_n = 1").drop("_n", *ties)


def merge_details(listed: DataFrame, details: DataFrame, key: str, body: str, order: str, keep_without: bool = True, ties: tuple[str, ...] = ()) -> DataFrame:
    """Lists with their details: a detail's filled value wins, column by column. has_detail tells which had one. ties: columns that choose among details of one order, the least first; without them such details must not differ."""
    d = last_details(details, key, body, order, ties)
    values = {c: filled(d, c) for c in d.columns if c not in (key, order)}
    d = d.select(d[key].alias("_key"), *[v.alias(f"_d_{c}") for c, v in values.items()])
    out = listed.join(d, listed[key] == d["_key"], "left" if keep_without else "inner")
    merged = {c: F.coalesce(F.col(f"_d_{c}"), F.col(c)) if c in listed.columns else F.col(f"_d_{c}") for c in values}
    return out.withColumns(merged | {"has_detail": F.col("_key").isNotNull()}).drop("_key", *[f"_d_{c}" for c in values])


def _classes(df: DataFrame, name: str, entries: list[Column]) -> DataFrame:
    """name, priority, value, once each, of rows' entries."""
    return df.select(name, F.explode(F.array_compact(F.array(*entries))).alias("c")).select(name, "c.priority", "c.value").distinct()


def _entry(priority: int, value: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(F.lit(priority).alias("priority"), value.cast("string").alias("value")))


def _jobs_classes(jobs: DataFrame) -> DataFrame:
    """Classes of jobs by id, link and title. Rows are dealt out by job before they become several, which what follows by job needs no second time."""
    return _classes(jobs.repartition("job"), "job", [_entry(1, F.col("id")), _entry(2, F.col("link")), _entry(3, F.col("title_key"))])


def _only_job(jobs: DataFrame) -> DataFrame:
    """The only job without an id: one row at most, found by an aggregate."""
    return jobs.where("id is null").agg(F.count("*").alias("n"), F.min("job").alias("job")).where("n = 1").select("job", F.lit(4).alias("priority"), F.lit("").alias("value"))


def association_classes(jobs: DataFrame, details: DataFrame, detail_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Jobs and details as members of classes (priority, value), which stand for the pairs of their members.

    A class is an id (1), a link (2), a title (3), or the only job without an id (4). Both sides have id, link, title_key
    (null where empty). A detail is in its classes of the best priority that has a job: by id alone if it has one. Gives
    the details' membership (``detail_id``, priority, value), the jobs' (job, priority, value) and each class's number of
    jobs (priority, value, jobs). No row stands for a pair, so a title that thousands share costs its members alone.
    """
    id_, link, title = F.col("id"), F.col("link"), F.col("title_key")
    alone = _only_job(jobs)
    job_in = _jobs_classes(jobs).union(alone)
    sizes = job_in.groupBy("priority", "value").agg(F.count("*").alias("jobs"))
    wanted = _classes(details, detail_id, [_entry(1, id_), F.when(id_.isNull(), _entry(2, link)), F.when(id_.isNull(), _entry(3, title))])
    found = wanted.join(sizes.where("priority < 4"), ["priority", "value"], "left_semi").select(detail_id, "priority", "value")
    last = details.where("id is null").select(detail_id).distinct().join(F.broadcast(alone.select("priority", "value")))  # one row at most
    found = found.union(last)
    best = found.groupBy(detail_id).agg(F.min("priority").alias("priority"))
    return found.join(best, [detail_id, "priority"], "left_semi"), job_in, sizes


def associate(jobs: DataFrame, details: DataFrame, detail_id: str) -> DataFrame:
    """Candidates of each detail as pairs (``detail_id``, job, priority), spelled out from ``association_classes``: as many rows as there are pairs.

    Where both a detail and a job have several classes of one priority, a pair comes from the least class that they share.
    So pairs come out once each as they are made, and none is moved or compared with others.
    """
    found, _, _ = association_classes(jobs, details, detail_id)
    of = lambda df, by, name: df.groupBy(*by).agg(F.collect_list("value").alias("_v")).select(*by, F.explode("_v").alias("value"), F.when(F.size("_v") > 1, F.col("_v")).alias(name))
    job_in = of(_jobs_classes(jobs), ("job", "priority"), "_of_job").union(_only_job(jobs).withColumn("_of_job", F.lit(None).cast("array<string>")))
    pairs = of(found, (detail_id, "priority"), "_of_detail").join(job_in, ["priority", "value"])
    least = F.col("value") == F.array_min(F.array_intersect("_of_detail", "_of_job"))
    return pairs.where(F.col("_of_detail").isNull() | F.col("_of_job").isNull() | least).select(detail_id, "job", "priority")


def keep_associated(jobs: DataFrame, details: DataFrame, bad_jobs: DataFrame, detail_id: str) -> DataFrame:
    """Details of which every candidate is retained, by how many jobs and how many bad ones their classes have; no pair is made."""
    found, job_in, _ = association_classes(jobs, details, detail_id)
    marked = job_in.join(bad_jobs.select("job").distinct().withColumn("_bad", F.lit(True)), "job", "left")
    bad = marked.groupBy("priority", "value").agg(F.bool_and(F.col("_bad").isNull()).alias("_good"))
    return found.join(bad, ["priority", "value"]).groupBy(detail_id).agg(F.bool_and("_good").alias("kept")).where("kept").select(detail_id)


def reconcile(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: rows, blank and repeated keys of both sides, keys on one side only, keys on both."""
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(F.col(key).cast("string").alias("k")).agg(F.count("*").alias(name))

    both = side(left, "l").join(side(right, "r"), "k", "full").where("k is not null and k <> ''")
    counts = both.agg(*[F.count_if(c).alias(n) for n, c in (("only_left", F.col("r").isNull()), ("only_right", F.col("l").isNull()), ("in_both", F.col("l").isNotNull() & F.col("r").isNotNull()), ("repeated_left", F.col("l") > 1), ("repeated_right", F.col("r") > 1))])
    rows = lambda df, n: df.agg(F.count("*").alias(f"rows_{n}"), F.count_if(F.col(key).isNull() | (F.col(key).cast("string") == "")).alias(f"blank_{n}"))
    return counts.join(F.broadcast(rows(left, "left"))).join(F.broadcast(rows(right, "right")))  # one row each


def coverage(listed: DataFrame, details: DataFrame, key: str, by: str) -> DataFrame:
    """by, listed, covered, missing, rate: listed keys that have a detail."""
    have = details.select(F.col(key).alias("_k")).distinct()
    rows = listed.select(by, key).distinct().join(have, F.col(key) == F.col("_k"), "left")
    return rows.groupBy(by).agg(F.count("*").alias("listed"), F.count("_k").alias("covered")).withColumns({"missing": F.col("listed") - F.col("covered"), "rate": F.round(F.col("covered") / F.col("listed"), 4)})


def asset_view(jobs: DataFrame, versions: DataFrame, key: str, order: str, fields: list[str], name: str = "versions") -> DataFrame:
    """Jobs with their versions (or flags, by another name) as an array of structs in order; an empty array without any."""
    nested = versions.groupBy(F.col(key).alias("_k")).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias(name))
    empty = F.array().cast(nested.schema[name].dataType)
    return jobs.join(nested, F.col(key) == F.col("_k"), "left").withColumn(name, F.coalesce(name, empty)).drop("_k")
