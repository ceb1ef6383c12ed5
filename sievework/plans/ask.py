"""The questions asked of deliverables, runs and the store, each a DataFrame: status, today, why, diff, templates, batches.

Deliverables are tables: ``deliverables`` with path, scope_key, created_at and ``items`` with path, job_id, kind
(kept, dropped, no_body) and reason. Nothing is read but what is passed in, and the clock is a parameter.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievework.operators import rollups, scopes

#: Answers of ``why``, the first that holds.
ANSWERS = ("kept", "dropped", "no_body", "excluded", "kept_before", "dropped_before", "no_body_before", "store_only", "unknown")


def _newest(deliverables: DataFrame) -> DataFrame:
    """One row at most: the path of the deliverable that was built last."""
    return deliverables.agg(F.max_by("path", F.struct("created_at", "path")).alias("_newest"))


def why(asked: DataFrame, items: DataFrame, deliverables: DataFrame, excluded: DataFrame, store: DataFrame) -> DataFrame:
    """job_id, answer, reason, path for each asked id. The newest deliverable decides first; then a list of exclusions, older deliverables, the store; what no one knows is unknown."""
    stamped = items.join(deliverables.select(F.col("path").alias("_p"), "created_at"), F.col("path") == F.col("_p")).join(F.broadcast(_newest(deliverables)))  # one row
    kind = F.when(F.col("kind") == "kept", 0).when(F.col("kind") == "dropped", 1).otherwise(2)
    known = stamped.select("job_id", F.when(F.col("path") == F.col("_newest"), kind).otherwise(kind + 4).alias("p"), F.coalesce("reason", F.lit("")).alias("reason"), "path", F.col("created_at").cast("string").alias("at"))
    flat = lambda df, p: df.select("job_id").distinct().select("job_id", F.lit(p).alias("p"), F.lit("").alias("reason"), F.lit("").alias("path"), F.lit("").alias("at"))
    evidence = reduce(DataFrame.union, [known, flat(excluded, 3), flat(store, 7), flat(asked, 8)])
    # of several older deliverables the newest
    older = evidence.groupBy("job_id", "p").agg(F.max(F.struct("at", "path", "reason")).alias("x"))
    best = older.groupBy("job_id").agg(F.min(F.struct("p", "x")).alias("b"))
    names = F.array(*map(F.lit, ANSWERS))
    return best.join(asked.select(F.col("job_id").alias("_a")).distinct(), F.col("job_id") == F.col("_a"), "left_semi").select("job_id", F.get(names, F.col("b.p")).alias("answer"), F.col("b.x.reason").alias("reason"), F.col("b.x.path").alias("path"))


def scope_of(deliverables: DataFrame, wanted: str = "") -> DataFrame:
    """One row: the scope of that very name, else the one built last of those that hold the text, else (nothing asked) the one built last."""
    low = F.lower(F.coalesce("scope_key", F.lit("")))
    fits = deliverables if not wanted else deliverables.where((F.col("scope_key") == wanted) | low.contains(wanted.lower()))
    return fits.agg(F.max_by("scope_key", F.struct(F.col("scope_key") == F.lit(wanted), "created_at", "path")).alias("_scope"))


def versions(deliverables: DataFrame, wanted: str = "") -> DataFrame:
    """path, turn of a scope's last two deliverables, 1 for the current one: two rows at most."""
    own = deliverables.join(F.broadcast(scope_of(deliverables, wanted)), F.col("scope_key").eqNullSafe(F.col("_scope")))  # one row
    last = own.orderBy(F.col("created_at").desc(), F.col("path").desc()).limit(2)
    return rollups.supersede(last.drop("_scope"), "scope_key", [F.desc("created_at"), F.desc("path")]).select("path", "turn")


def diff(items: DataFrame, deliverables: DataFrame, scope: str = "", limit: int | None = None) -> DataFrame:
    """job_id, change, reason of what a scope's current deliverable and the one before differ in; no row if there is none before. With a limit, the first of each change, its total, and whether it is cut."""
    pair = versions(deliverables, scope)
    both = items.join(F.broadcast(pair.withColumnRenamed("path", "_p")), F.col("path") == F.col("_p"))  # two rows
    both = both.join(F.broadcast(pair.agg((F.count("*") == 2).alias("_two"))).where("_two"))
    of = lambda turn, kind: both.where((F.col("turn") == turn) & (F.col("kind") == kind)).select("job_id", "reason")
    out = rollups.diff_with_reasons(of(2, "kept"), of(1, "kept"), "job_id", of(2, "dropped"), of(1, "dropped"), of(1, "no_body"))
    return out if limit is None else rollups.truncated(out, "change", "job_id", limit)


def diff_counts(items: DataFrame, deliverables: DataFrame, scope: str = "") -> DataFrame:
    """One row: added, removed, kept between a scope's last two deliverables."""
    pair = versions(deliverables, scope)
    kept = items.where("kind = 'kept'").join(F.broadcast(pair.withColumnRenamed("path", "_p")), F.col("path") == F.col("_p"))  # two rows
    each = kept.groupBy("job_id").agg(F.bool_or(F.col("turn") == 1).alias("now"), F.bool_or(F.col("turn") == 2).alias("then"))
    return each.agg(F.count_if(F.col("now") & ~F.col("then")).alias("added"), F.count_if(F.col("then") & ~F.col("now")).alias("removed"), F.count_if(F.col("now") & F.col("then")).alias("kept"))


def templates(profiles: DataFrame, deliverables: DataFrame, runs: DataFrame) -> DataFrame:
    """profile, path (its last deliverable), last_run (when a run last had its scope), whatever either knows. profiles: profile, scope_key, target; runs: scope_key, started_at."""
    last = runs.groupBy(F.col("scope_key").alias("_s")).agg(F.max("started_at").alias("last_run"))
    found = scopes.first_matches(profiles, deliverables).withColumnRenamed("profile", "_p")
    return profiles.join(found, F.col("profile") == F.col("_p")).join(last, F.col("scope_key") == F.col("_s"), "left").select("profile", "path", "last_run")


def batches(health: DataFrame, status: str, numbers: list[str], done: tuple[str, ...] = ("ok", "done", "success")) -> DataFrame:
    """One row over all runs: runs, ok_runs, failed_runs, and the sum of each number; a run without a status went well, negative numbers count nothing."""
    said = F.coalesce(F.when(F.col(status) != "", F.col(status)), F.lit("ok"))
    return health.agg(F.count("*").alias("runs"), F.count_if(said.isin(*done)).alias("ok_runs"), F.count_if(~said.isin(*done)).alias("failed_runs"), *[F.coalesce(F.sum(F.greatest(F.lit(0), F.coalesce(F.col(n).try_cast("long"), F.lit(0)))), F.lit(0)).alias(n) for n in numbers])


def today(runs: DataFrame, jobs: DataFrame, details: DataFrame, used: DataFrame, limit: int, day: Column) -> DataFrame:
    """One row for a day: runs, keywords in the order of their first use, the commonest city, new jobs, details and those with a body, what is left of the budget. runs: started, keyword, city; jobs: first_seen; details: updated, jd; used: one row with used."""
    own = runs.where(F.to_date("started") == day)
    words = own.select("started", F.posexplode(F.split(F.coalesce("keyword", F.lit("")), ",")).alias("i", "w")).select("started", "i", F.trim("w").alias("w")).where("w <> ''")
    words = words.groupBy("w").agg(F.min(F.struct("started", "i")).alias("t")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "w"))), lambda x: x.w), ",").alias("keywords"))
    city = own.where(F.coalesce("city", F.lit("")) != "").groupBy("city").agg(F.count("*").alias("n"), F.min("started").alias("f")).agg(F.min_by("city", F.struct(-F.col("n"), "f", "city")).alias("city"))
    parts = [own.agg(F.count("*").alias("runs")), words, city, jobs.agg(F.count_if(F.to_date("first_seen") == day).alias("new_jobs")), details.where(F.to_date("updated") == day).agg(F.count("*").alias("details"), F.count_if(F.coalesce(F.trim("jd"), F.lit("")) != "").alias("with_body")), used.select("used")]
    out = reduce(lambda a, b: a.join(F.broadcast(b)), parts)  # one row each
    return out.withColumn("budget_left", F.greatest(F.lit(0), F.lit(limit) - F.col("used")) if limit > 0 else F.lit(0).cast("long"))


def status(today_: DataFrame, run: DataFrame, now: Column, cooldown_until: Column, holders: int = 0, halted: bool = False, limit: int = 700, old_seconds: int = 300) -> DataFrame:
    """One row: the day's row, the last run's state, whether it is old, the cooldown left, and what a person has to decide. run: one row with state, updated_at."""
    left = F.greatest(F.lit(0), F.coalesce(F.timestamp_diff("SECOND", now, cooldown_until), F.lit(0)))
    row = today_.join(F.broadcast(run.select(F.coalesce("state", F.lit("unknown")).alias("state"), "updated_at")))  # one row each
    row = row.withColumns({"cooldown": left, "old": (F.col("state") == "running") & (F.timestamp_diff("SECOND", F.col("updated_at"), now) > old_seconds)})
    lock = "halted" if halted else "held" if holders else "free"
    spent = F.lit(limit > 0) & (F.col("budget_left") <= 0)
    open_ = F.array_compact(F.array(F.when(spent, F.lit("budget_spent")), F.lit("lock_" + lock if lock != "free" else None).cast("string"), F.when(F.col("cooldown") > 0, F.lit("cooling_down")), F.when(F.col("old"), F.lit("run_is_old")), F.when(F.col("runs") == 0, F.lit("no_run_today")).when(F.col("new_jobs") == 0, F.lit("nothing_new_today"))))
    return row.withColumns({"lock": F.lit(lock), "open": F.array_join(F.slice(open_, 1, 4), ",")}).drop("updated_at")


QUESTIONS: dict[str, Callable[..., DataFrame]] = {f.__name__: f for f in (status, today, why, diff, diff_counts, templates, batches)}


def ask(question: str, **inputs) -> DataFrame:
    """One of the questions by name."""
    if question not in QUESTIONS:
        raise ValueError(f"unknown question {question!r}; known: {', '.join(sorted(QUESTIONS))}")
    return QUESTIONS[question](**inputs)
