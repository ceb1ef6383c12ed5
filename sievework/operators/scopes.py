"""What a run works on: candidates and details out of stores and folders, retry lists, ledgers of what was dropped, known failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.text import contains_any, iso_instant


def _text(c: str) -> Column:
    return F.coalesce(F.trim(F.col(c).cast("string")), F.lit(""))


# ---------------------------------------------------------------- stores and folders


def from_store(jobs: DataFrame, runs: DataFrame, city: str = "", keyword: str = "", since: str = "") -> tuple[DataFrame, DataFrame]:
    """(jobs of a scope, one row of counts). jobs: run_id, city, keyword, updated_at; runs: run_id, keyword.

    A city must be the stored one; of several keywords one must stand in the job's or its run's; since is an
    ISO date or time. Jobs without a city are counted as unknown where a city is asked for.
    """
    r = runs.select(F.col("run_id").alias("_run"), F.col("keyword").alias("_keyword")).dropDuplicates(["_run"])
    both = jobs.join(r, F.col("run_id") == F.col("_run"), "left")
    here = F.lit(True) if not city else _text("city") == city
    tokens = tuple(t.strip().lower() for t in keyword.split(",") if t.strip())
    says = contains_any(F.lower(F.concat_ws(" ", F.coalesce("keyword", F.lit("")), F.coalesce("_keyword", F.lit("")))), tokens) if tokens else F.lit(True)
    late = F.coalesce(iso_instant(F.col("updated_at").cast("string"))["at"] >= iso_instant(F.lit(since))["at"], F.lit(False)) if since else F.lit(True)
    marked = both.withColumn("_in", here & says & late)
    unknown = (_text("city") == "") if city else F.lit(False)
    counts = marked.agg(F.count("*").alias("in_store"), F.count_if(unknown).alias("unknown_city"), F.count_if("_in").alias("selected"))
    return marked.where("_in").drop("_in", "_run", "_keyword"), counts


def with_body(details: DataFrame, key: str, body: str, ids: DataFrame | None = None) -> DataFrame:
    """Details that have a body, of some ids if given."""
    out = details.where(_text(body) != "")
    return out if ids is None else out.join(ids.select(F.col(key).alias("_id")).distinct(), F.col(key) == F.col("_id"), "left_semi")


def first_of(rows: DataFrame, key: str, order: list[str], filled: str | None = None) -> DataFrame:
    """The first row of each id by files and places in them; rows without an id, or without ``filled``, do not count."""
    rows = rows.where(_text(key) != "")
    rows = rows if filled is None else rows.where(_text(filled) != "")
    values = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.min_by(F.struct(*values), F.struct(*order)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in values])


def union_of_folders(lists: DataFrame, details: DataFrame, key: str, order: list[str], city: str = "") -> tuple[DataFrame, DataFrame]:
    """(jobs, details) of all files of a folder: the first row of each id in lists whose file is of the city or of none, and for these ids the first detail with a body. Lists have file_city; details have jd."""
    own = lists if not city else lists.where(_text("file_city").isin("", city))
    jobs = first_of(own, key, order)
    found = first_of(details, key, order, "jd")
    return jobs, found.join(jobs.select(F.col(key).alias("_id")), F.col(key) == F.col("_id"), "left_semi")


def candidates(files: DataFrame, explicit: str = "", listed: str = "") -> DataFrame:
    """path, turn of the detail files to look into: the one named, the one with the list's time stamp in its name, the newest one; each once. files: path, modified. At most three rows."""
    name = F.element_at(F.split("path", "/"), -1)
    details = files.where(name.startswith("details_") & ~name.endswith(".pending.json"))
    parts = [files.where(F.col("path") == explicit).select("path", F.lit(0).alias("turn"))]
    if listed.rsplit("/", 1)[-1].startswith("jobs_"):
        sibling = listed[: len(listed) - len(listed.rsplit("/", 1)[-1])] + listed.rsplit("/", 1)[-1].replace("jobs_", "details_", 1)
        parts.append(files.where(F.col("path") == sibling).select("path", F.lit(1).alias("turn")))
    parts.append(details.agg(F.max_by("path", F.struct("modified", "path")).alias("path")).where("path is not null").select("path", F.lit(2).alias("turn")))
    return reduce(DataFrame.union, parts).groupBy("path").agg(F.min("turn").alias("turn"))


def paired_scopes(files: DataFrame) -> DataFrame:
    """Files with the scope of detail files filled from the list with the same stamp in its name. files: path, kind, scope."""
    stamp = F.regexp_extract(F.element_at(F.split("path", "/"), -1), "^(?:jobs|details)_(.+)$", 1)
    rows = files.withColumn("_stamp", stamp)
    lists = rows.where("kind = 'list' and scope is not null and _stamp <> ''").groupBy(F.col("_stamp").alias("_s")).agg(F.min_by("scope", "path").alias("_scope"))
    both = rows.join(lists, (F.col("kind") == "details") & (F.col("_stamp") == F.col("_s")), "left")
    return both.withColumn("scope", F.coalesce("scope", "_scope")).drop("_stamp", "_s", "_scope")


def resolved(df: DataFrame, value: str, names: DataFrame, coded: str = "^\\d{9}$") -> DataFrame:
    """Rows with code and label: a value is a name, else a code, else a text of a code's form, which stands for itself; error tells which values are none of these. names: name, code."""
    by_name = names.select(F.col("name").alias("_n"), F.col("code").cast("string").alias("_c")).dropDuplicates(["_n"])
    by_code = names.select(F.col("code").cast("string").alias("_c2"), F.col("name").alias("_n2")).dropDuplicates(["_c2"])
    v = F.trim(F.col(value))
    both = df.join(by_name, v == F.col("_n"), "left").join(by_code, v == F.col("_c2"), "left")
    code = F.coalesce("_c", "_c2", F.when(v.rlike(coded), v))
    return both.select(*[df[c] for c in df.columns], code.alias("code"), F.coalesce("_n", "_n2").alias("label"), code.isNull().alias("error"))


def first_matches(profiles: DataFrame, deliverables: DataFrame) -> DataFrame:
    """profile, path: the newest deliverable whose scope is the profile's or whose file has the name it states; null without one. profiles: profile, scope_key, target; deliverables: path, scope_key, created_at.

    Of each scope and each name only the newest deliverable meets profiles, so there are two matches a row of profiles at most.
    """
    at = F.struct("created_at", "path")
    named = F.element_at(F.split("path", "/"), -1)
    newest = lambda by: deliverables.where(by.isNotNull()).groupBy(by.alias("_by")).agg(F.max(at).alias("_at"))
    matched = lambda c, by: profiles.where(_text(c) != "").join(newest(by), F.col(c) == F.col("_by")).select("profile", "_at")
    best = matched("scope_key", F.col("scope_key")).union(matched("target", named)).groupBy(F.col("profile").alias("_p")).agg(F.max("_at").alias("_at"))
    return profiles.select("profile").join(best, F.col("profile") == F.col("_p"), "left").select("profile", F.col("_at.path").alias("path"))


def lineage(jobs: DataFrame, runs: DataFrame, details: DataFrame, key: str, ids: list | None = None) -> DataFrame:
    """Where jobs come from: each job with its run's columns and whether its detail has a body."""
    j = jobs if ids is None else jobs.where(F.col(key).isin(ids))
    r = runs.select(*[F.col(c).alias(f"run_{c}" if c != "run_id" else "_run") for c in runs.columns])
    d = details.groupBy(F.col(key).alias("_d")).agg(F.bool_or(_text("jd") != "").alias("has_body"))
    out = j.join(r, F.col("run_id") == F.col("_run"), "left").join(d, F.col(key) == F.col("_d"), "left")
    return out.withColumn("has_body", F.coalesce("has_body", F.lit(False))).drop("_run", "_d")


def scope_inventory(files: DataFrame, kind: str = "", scope: str = "") -> DataFrame:
    """Files of a kind and with a text in their scope, by kind, time and path, all falling."""
    out = files if not kind else files.where(F.col("kind") == kind)
    out = out if not scope else out.where(F.lower(F.coalesce("scope", F.lit(""))).contains(scope.lower()))
    return out.orderBy(F.col("kind").desc(), F.col("created_at").desc(), F.col("path").desc())


def inventory_counts(files: DataFrame, stale_before: Column) -> DataFrame:
    """kind, status, files, bytes, stale."""
    return files.groupBy("kind", "status").agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.col("created_at") < stale_before).alias("stale"))


def archived(files: DataFrame, kind: str, created: str, stem: str, keep: int) -> DataFrame:
    """path, archive: which files go to the archive: all but the newest ``keep`` stems of each kind; files of one stem, sidecars too, go together."""
    heads = files.where(_text(kind) != "").groupBy(kind, stem).agg(F.max(created).alias("_at"))
    turn = F.row_number().over(Window.partitionBy(kind).orderBy(F.desc("_at"), F.desc(stem)))
    old = heads.withColumn("_n", turn).select(F.col(stem).alias("_s"), (F.col("_n") > keep).alias("_old"))
    old = old.groupBy("_s").agg(F.bool_and("_old").alias("_old"))
    return files.join(old, F.col(stem) == F.col("_s"), "left").select("path", F.coalesce("_old", F.lit(False)).alias("archive"))


# ---------------------------------------------------------------- retries and ledgers


def pending(items: DataFrame, key: str, attempts: str, forced: DataFrame, most: int = 3) -> DataFrame:
    """key, attempts of what is to be tried again: entries below the limit, and forced ids whatever their attempts, also those that no entry has."""
    have = items.where(_text(key) != "").groupBy(F.col(key).alias("_k")).agg(F.max(attempts).alias("_a"))
    want = forced.select(F.col(key).alias("_f")).where("trim(cast(_f as string)) <> ''").distinct()
    both = have.join(want, F.col("_k") == F.col("_f"), "full")
    return both.where((F.col("_a") < most) | F.col("_f").isNotNull()).select(F.coalesce("_k", "_f").alias(key), F.coalesce("_a", F.lit(0)).alias(attempts))


def merged_ledger(before: DataFrame, now: DataFrame, present: DataFrame, key: str, order: str) -> DataFrame:
    """Entries of dropped records over all runs: the first of each id, the older ledger's before the new one's, without ids that are back in the product."""
    both = before.withColumn("_side", F.lit(0)).unionByName(now.withColumn("_side", F.lit(1))).where(_text(key) != "")
    first = first_of(both, key, ["_side", order]).drop("_side")
    return first.join(present.select(F.col(key).alias("_p")).distinct(), F.col(key) == F.col("_p"), "left_anti")


def funnel(kept: DataFrame, junk: DataFrame, bodyless: DataFrame, key: str) -> DataFrame:
    """One row: with_body (kept and ever dropped as junk), total_before, dropped_no_body. Ids that are back in the product leave both ledgers."""
    ids = lambda df: df.where(_text(key) != "").select(F.col(key).cast("string").alias("k")).distinct()
    marks = kept.select(F.col(key).cast("string").alias("k"), F.lit(1).alias("p"), F.lit(0).alias("j"), F.lit(0).alias("n"))
    marks = marks.union(ids(junk).select("k", F.lit(0), F.lit(1), F.lit(0))).union(ids(bodyless).select("k", F.lit(0), F.lit(0), F.lit(1)))
    each = marks.groupBy("k").agg(F.sum("p").alias("p"), F.max("j").alias("j"), F.max("n").alias("n"))
    gone = F.col("p") == 0
    row = each.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("kept"), F.count_if(gone & (F.col("j") == 1)).alias("junk"), F.count_if(gone & (F.col("n") == 1)).alias("dropped_no_body"))
    return row.select((F.col("kept") + F.col("junk")).alias("with_body"), (F.col("kept") + F.col("junk") + F.col("dropped_no_body")).alias("total_before"), "dropped_no_body")


def same_members(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: changed, whether two sets of ids differ; only_first and only_second count how."""
    x, y = (df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).distinct().withColumn(n, F.lit(1)) for df, n in ((a, "x"), (b, "y")))
    row = x.join(y, "k", "full").agg(F.count_if(F.col("y").isNull()).alias("only_first"), F.count_if(F.col("x").isNull()).alias("only_second"))
    return row.select((F.col("only_first") + F.col("only_second") > 0).alias("changed"), "only_first", "only_second")


def known_bad(entries: DataFrame, now: Column, run: str) -> DataFrame:
    """fingerprint, nature, entries of the failures that are in force: not expired, and used up by no more than four runs if structural, of this very run if transient. entries: fingerprint, nature, expires_at (seconds), skip_runs, run_id."""
    alive = F.coalesce(F.col("expires_at") > now, F.lit(False)) & F.when(F.col("nature") == "structural", F.coalesce(F.col("skip_runs"), F.lit(0)) < 5).otherwise(F.col("run_id") == run)
    return entries.where(alive).groupBy(F.coalesce(F.when(F.col("fingerprint") != "", F.col("fingerprint")), F.lit("unknown")).alias("fingerprint"), "nature").agg(F.count("*").alias("entries"))
