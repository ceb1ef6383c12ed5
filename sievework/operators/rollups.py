"""Histories: current and previous, differences with reasons, run rollups, budgets, ledgers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def supersede(df: DataFrame, scope: str, newest: list[Column]) -> DataFrame:
    """status: active for the newest of each scope, superseded for the others; turn: 1 for the newest."""
    turn = F.row_number().over(Window.partitionBy(scope).orderBy(*newest))
    return df.withColumn("turn", turn).withColumn("status", F.when(F.col("turn") == 1, "active").otherwise("superseded"))


def keep_newest(df: DataFrame, kind: str, newest: list[Column], n: int) -> DataFrame:
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(kind).orderBy(*newest))).where(F.col("turn") <= n)


def newest_by(df: DataFrame, kind: str, newest: list[str], value: str) -> DataFrame:
    """kind and the value of its newest row."""
    return df.groupBy(kind).agg(F.max_by(value, F.struct(*newest)).alias(value))


def version_changes(items: DataFrame, scope: str, version: str, key: str) -> DataFrame:
    """scope, current, previous, added, removed, kept: each scope's last two versions, compared by key; scopes with one version are left out."""
    turns = supersede(items.select(scope, version).distinct(), scope, [F.col(version).desc()]).where("turn <= 2").select(F.col(scope).alias("_s"), F.col(version).alias("_v"), "turn")
    rows = items.join(turns, (F.col(scope) == F.col("_s")) & (F.col(version) == F.col("_v")))
    each = rows.groupBy(scope, key).agg(F.bool_or(F.col("turn") == 1).alias("now"), F.bool_or(F.col("turn") == 2).alias("then"), F.max(F.when(F.col("turn") == 1, F.col("_v"))).alias("c"), F.max(F.when(F.col("turn") == 2, F.col("_v"))).alias("p"))
    out = each.groupBy(scope).agg(F.max("c").alias("current"), F.max("p").alias("previous"), F.count_if(F.col("now") & ~F.col("then")).alias("added"), F.count_if(~F.col("now") & F.col("then")).alias("removed"), F.count_if(F.col("now") & F.col("then")).alias("kept"))
    return out.where("previous is not null")


def saved_state(previous: DataFrame, current: DataFrame, key: str, order: str) -> DataFrame:
    """A queue or state table after a run: each key's row from the run, else the one that was saved; order tells the newest of a run."""
    both = previous.withColumn("_side", F.lit(0)).unionByName(current.withColumn("_side", F.lit(1)))
    values = [c for c in previous.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*values), F.struct("_side", order)).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in values])


def recent(df: DataFrame, at: str, key: str, n: int) -> DataFrame:
    """The last rows by time; ties by key."""
    return df.orderBy(F.col(at).desc(), key).limit(n)


def last_lines(df: DataFrame, line: str, n: int) -> DataFrame:
    """The last lines of a log, the last one first."""
    return df.orderBy(F.col(line).desc()).limit(n)


def replay_order(files: DataFrame, created: str, path: str) -> DataFrame:
    """Files with their turn when a history is replayed: a day's files are numbered by themselves, after those of the days before it, so that no task orders all of them."""
    day = F.substring(F.col(created).cast("string"), 1, 10)
    days = files.groupBy(day.alias("_day")).agg(F.count("*").alias("_n"))
    # a row a day
    before = days.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy(F.col("_day").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    own = files.withColumn("_d", day).withColumn("_turn", F.row_number().over(Window.partitionBy("_d").orderBy(created, path)))
    return own.join(before, F.col("_d").eqNullSafe(F.col("_day"))).withColumn("turn", (F.col("_before") + F.col("_turn")).cast("int")).drop("_d", "_turn", "_day", "_before")


def changed_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, change: added or removed."""
    o, n = old.select(key).distinct().withColumn("o", F.lit(1)), new.select(key).distinct().withColumn("n", F.lit(1))
    return o.join(n, key, "full").where("o is null or n is null").select(key, F.when(F.col("o").isNull(), "added").otherwise("removed").alias("change"))


def truncated(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The first rows of each kind, with its total and whether rows were left out."""
    first = df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("_n") <= n).drop("_n")
    total = df.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("total"))
    return first.join(total, F.col(by) == F.col("_by")).drop("_by").withColumn("truncated", F.col("total") > n)


def diff_with_reasons(old: DataFrame, new: DataFrame, key: str, dropped_before: DataFrame, dropped_now: DataFrame, bodyless_now: DataFrame) -> DataFrame:
    """key, change, reason: what two versions differ in and why. Changes of content are no difference."""
    o, n = old.select(key).distinct().withColumn("o", F.lit(1)), new.select(key).distinct().withColumn("n", F.lit(1))
    both = o.join(n, key, "full").where("o is null or n is null").withColumn("change", F.when(F.col("o").isNull(), "added").otherwise("removed"))
    mark = lambda df, name: df.groupBy(key).agg(F.min("reason").alias(name))
    both = both.join(mark(dropped_before, "before"), key, "left").join(mark(dropped_now, "now"), key, "left").join(bodyless_now.select(key).distinct().withColumn("bare", F.lit(1)), key, "left")
    reason = F.when((F.col("change") == "added") & F.col("before").isNotNull(), "rule_dropped_before").when(F.col("change") == "added", "new").when(F.col("now").isNotNull(), F.concat(F.lit("rule:"), F.col("now"))).when(F.col("bare").isNotNull(), "no_body").otherwise("vanished")
    return both.select(key, "change", reason.alias("reason"))


def first_evidence(sources: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """key, answer: for each key the first source, in the order given, that knows it."""
    parts = [df.select(key).distinct().withColumns({"p": F.lit(i), "answer": F.lit(name)}) for i, (name, df) in enumerate(sources)]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.groupBy(key).agg(F.min(F.struct("p", "answer")).alias("x")).select(key, F.col("x.answer").alias("answer"))


def failure_windows(events: DataFrame, at: str, bad: Column, seconds: int, share: float, run: int) -> DataFrame:
    """start, total, failed, rate, alarm: tumbling windows; alarm where so many in a row exceed the share."""
    w = events.groupBy(F.window(at, f"{seconds} seconds").alias("w")).agg(F.count("*").alias("total"), F.count_if(bad).alias("failed"))
    w = w.select(F.col("w.start").alias("start"), "total", "failed", (F.col("failed") / F.col("total")).alias("rate")).withColumn("over", F.col("rate") > share)
    # a day is a part of its own; windows before midnight count for it too
    w = w.withColumn("day", F.to_date("start"))
    order = Window.partitionBy("day").orderBy("start").rowsBetween(-(run - 1), 0)
    return w.withColumn("alarm", (F.min(F.col("over").cast("int")).over(order) == 1) & (F.count("*").over(order) == run)).drop("over", "day")


def burst(events: DataFrame, key: str, at: str, seconds: int, limit: int) -> DataFrame:
    """Rows with recent: events of the key within the last seconds, this one included; blocked where they reach the limit."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(at).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return events.withColumn("recent", F.count("*").over(w)).withColumn("blocked", F.col("recent") >= limit)


def daily_budget(events: DataFrame, key: str, at: str, order: str, limit: int) -> DataFrame:
    """outcome by event: ok for the first uses of different keys on a day up to the limit, duplicate for a key's later ones, exhausted beyond. Refused uses aren't recorded; a limit of 0 is none."""
    day = F.to_date(at)
    firsts = events.groupBy(day.alias("_day"), F.col(key).alias("_key")).agg(F.min(F.struct(at, order)).alias("_first"))
    if limit > 0:
        # only the first ones are ranked: each task passes on its own first ones of a day
        firsts = firsts.withColumn("_nth", F.row_number().over(Window.partitionBy("_day").orderBy("_first"))).where(F.col("_nth") <= limit).drop("_nth")
    both = events.withColumn("_d", day).join(firsts, (F.col("_d") == F.col("_day")) & (F.col(key) == F.col("_key")), "left")
    return both.withColumn("outcome", F.when(F.col("_first").isNull(), "exhausted").when(F.struct(at, order) == F.col("_first"), "ok").otherwise("duplicate")).drop("_d", "_day", "_key", "_first")


#: Runs that a structural failure may be skipped in, and seconds that an entry lives, by nature.
SKIP_RUNS, STRUCTURAL_TTL, TRANSIENT_TTL = 5, 30 * 86_400, 30 * 60


def fold_ledger(events: DataFrame, now: int | None = None) -> DataFrame:
    """State of a ledger of known failures after all its events (key, at as seconds, run, nature; kind failure or probe).

    A failure opens an entry or renews it; another nature resets what was skipped, not the hits. A probe is
    skipped while the entry is in force: a structural one in SKIP_RUNS runs at the most, each counted once; a
    transient one in the run that recorded it. An expired entry, and a structural one that is used up, goes at
    the probe, or by the second ``now``. A key's events, which are taken to be few, are folded in order within its row.
    """
    ordered = events.groupBy("key").agg(F.array_sort(F.collect_list(F.struct(F.col("at").cast("long").alias("at"), "kind", "run", "nature"))).alias("_e"))
    fields = ("open", "nature", "hits", "skip_runs", "last_skip", "run", "until", "skipped", "fetched")
    state = lambda *values: F.struct(*[v.alias(n) for n, v in zip(fields, values, strict=True)])
    none, zero = F.lit(None).cast("string"), F.lit(0).cast("long")

    def step(s: Column, e: Column) -> Column:
        alive = s.open & (e.at < s.until)
        same = alive & (s.nature == e.nature)
        life = F.when(e.nature == "structural", F.lit(STRUCTURAL_TTL)).otherwise(F.lit(TRANSIENT_TTL))
        failed = state(F.lit(True), e.nature, F.when(alive, s.hits + 1).otherwise(F.lit(1).cast("long")), F.when(same, s.skip_runs).otherwise(zero), F.when(same, s.last_skip), e.run, e.at + life, s.skipped, s.fetched)
        structural = s.nature == "structural"
        skip = alive & F.when(structural, s.skip_runs < SKIP_RUNS).otherwise(s.run == e.run)
        first = ~F.coalesce(s.last_skip == e.run, F.lit(False))
        goes = s.open & ~skip & (~alive | structural)
        probed = state(s.open & ~goes, F.when(goes, F.lit("")).otherwise(s.nature), F.when(goes, zero).otherwise(s.hits), F.when(goes, zero).when(skip & first, s.skip_runs + 1).otherwise(s.skip_runs), F.when(skip, e.run).when(~goes, s.last_skip), s.run, s.until, s.skipped + skip.cast("long"), s.fetched + (~skip).cast("long"))
        return F.when(e.kind == "failure", failed).otherwise(probed)

    start = state(F.lit(False), F.lit(""), zero, zero, none, F.lit(""), zero, zero, zero)
    gone = F.lit(False) if now is None else F.col("_s.open") & (F.col("_s.until") <= now)
    closed = {"open": F.lit(False), "nature": F.lit(""), "hits": zero, "skip_runs": zero}
    out = ordered.select("key", F.aggregate("_e", start, step).alias("_s"))
    return out.select("key", *[F.when(gone, v).otherwise(F.col(f"_s.{c}")).alias(c) for c, v in closed.items()], "_s.skipped", "_s.fetched")


def resume_queue(previous: DataFrame, current: DataFrame, known: DataFrame, key: str, order: str) -> DataFrame:
    """key, turn: what is still to be fetched, formerly queued keys first in their order, then the current ones in theirs."""
    queued = previous.groupBy(key).agg(F.min(order).alias("_p"))
    now = current.groupBy(key).agg(F.min(order).alias("_c"))
    left = now.join(queued, key, "left").join(known.select(key).distinct(), key, "left_anti")
    return left.select(key, F.col("_p").isNull().alias("fresh"), F.coalesce("_p", "_c").alias("turn"))

