"""Keyed tables: upserts, versions, flags, lifecycle, deltas. Plain tables, rewritten as a whole."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_values(source: DataFrame, key: str, order: str, keep: list[str], overwrite: list[str]) -> DataFrame:
    """A row a key of a batch in which keys may come several times: the last ``overwrite`` values by ``order``, the last ``keep`` values that aren't null."""
    whole = F.max_by(F.struct(*overwrite), order).alias("_last") if overwrite else F.lit(None).alias("_last")
    found = source.where(F.col(key).isNotNull()).groupBy(key).agg(whole, *[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in keep])
    return found.select(key, *keep, *[F.col(f"_last.{c}").alias(c) for c in overwrite])


def upsert(target: DataFrame, source: DataFrame, key: str, order: str, at: Column, keep: list[str], overwrite: list[str]) -> DataFrame:
    """A keyed table after a batch. New keys get first_seen and state new; known ones take the batch's values and become active.

    An incoming null leaves a ``keep`` column as it was; ``overwrite`` columns take nulls as well. Of a key's
    rows in the batch the last by ``order`` counts. change: inserted, updated or kept.
    """
    t = target.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_t_{c}") for c in target.columns if c != key])
    s = last_values(source, key, order, keep, overwrite).select(key, *[F.col(c).alias(f"_s_{c}") for c in (*keep, *overwrite)])
    both = t.join(s, F.col("_k") == F.col(key), "full")
    came, was = F.col(key).isNotNull(), F.col("_k").isNotNull()
    columns = {c: F.coalesce(f"_s_{c}", f"_t_{c}") for c in keep} | {c: F.when(came, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")) for c in overwrite}
    return both.select(
        F.coalesce(F.col(key), F.col("_k")).alias(key), *[v.alias(c) for c, v in columns.items()],
        F.coalesce("_t_first_seen", at).alias("first_seen"), F.when(came, at).otherwise(F.col("_t_last_seen")).alias("last_seen"),
        F.when(came & was, "active").when(came, "new").otherwise(F.col("_t_state")).alias("state"),
        F.when(came & was, "updated").when(came, "inserted").otherwise("kept").alias("change"),
    )


def upsert_counts(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """One row: rows of a batch whose key is new and rows whose key is known; a key that comes twice counts twice."""
    known = target.select(F.col(key).alias("_k")).distinct()
    both = source.where(F.col(key).isNotNull()).join(known, F.col(key) == F.col("_k"), "left")
    return both.agg(F.count_if(F.col("_k").isNull()).alias("inserted"), F.count_if(F.col("_k").isNotNull()).alias("updated"))


def record_runs(target: DataFrame, source: DataFrame, key: str, order: str, overwrite: list[str], keep: list[str]) -> DataFrame:
    """Runs after a batch of partial records: a run's start stays, ``overwrite`` columns take what came, ``keep`` columns stay where nothing came."""
    t = target.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_t_{c}") for c in target.columns if c != key])
    s = last_values(source, key, order, keep, [*overwrite, "started_at"]).select(key, *[F.col(c).alias(f"_s_{c}") for c in (*keep, *overwrite, "started_at")])
    both = t.join(s, F.col("_k") == F.col(key), "full")
    came = F.col(key).isNotNull()
    return both.select(F.coalesce(F.col(key), F.col("_k")).alias(key), F.coalesce("_t_started_at", "_s_started_at").alias("started_at"), *[F.when(came, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c) for c in overwrite], *[F.coalesce(f"_s_{c}", f"_t_{c}").alias(c) for c in keep])


def flush(existing: DataFrame, incoming: DataFrame, key: str, order: str, required: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table, quarantine, counters) after a batch is flushed into a table with the same columns.

    What is there goes before what comes, and a batch's first row of a key before its later ones. Merged rows
    that lack a required value move to the quarantine. quarantine: key, reason (invalid_key once for each row
    without one, missing:field,..., conflict where a key came with other values); counters: one row with new,
    duplicate, quarantine. A flush that is repeated counts all its rows as duplicates.
    """
    values = [c for c in existing.columns if c not in (key, order)]
    blank = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    both = existing.withColumn("_side", F.lit(0)).unionByName(incoming.withColumn("_side", F.lit(1)))
    valid = both.where(~blank)
    mark = F.xxhash64(*values)
    # a row a key: no window holds a key that comes again and again
    merged = valid.groupBy(key).agg(F.min_by(F.struct(order, *values), F.struct("_side", order)).alias("_r"), F.count_if(F.col("_side") == 0).alias("_old"), F.count_if(F.col("_side") == 1).alias("_came"), (F.min(mark) != F.max(mark)).alias("_differs"))
    rows = merged.select(key, F.col(f"_r.{order}").alias(order), *[F.col(f"_r.{c}").alias(c) for c in values], "_old", "_came", "_differs")
    lacks = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "", F.lit(c)) for c in required]))
    rows = rows.withColumn("_lacks", lacks)
    table = rows.where(F.size("_lacks") == 0).select(*existing.columns)
    bad = incoming.where(blank).select(F.lit(None).cast(existing.schema[key].dataType).alias(key), F.lit("invalid_key").alias("reason"))
    bad = bad.union(rows.where(F.size("_lacks") > 0).select(key, F.concat(F.lit("missing:"), F.array_join("_lacks", ",")))).union(rows.where("_differs and _came > 0").select(key, F.lit("conflict")))
    counts = rows.agg(F.count_if((F.col("_old") == 0) & (F.col("_came") > 0)).alias("new"), F.coalesce(F.sum("_came"), F.lit(0)).alias("_all"), (F.count_if(F.size("_lacks") > 0) + F.count_if(F.col("_differs") & (F.col("_came") > 0))).alias("_bad"))
    unkeyed = incoming.agg(F.count_if(blank).alias("_blank"))
    counters = counts.join(F.broadcast(unkeyed)).select("new", (F.col("_all") - F.col("new")).alias("duplicate"), (F.col("_bad") + F.col("_blank")).alias("quarantine"))  # one row each
    return table, bad, counters


def fill_only(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Back-fill: blank values take the source's, others stay; run again it changes nothing. filled: number of values taken."""
    s = source.select(F.col(key).alias("_k"), *[F.col(c).alias(f"_s_{c}") for c in columns])
    both = target.join(s, F.col(key) == F.col("_k"), "left")
    blank = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) == "" for c in columns}
    gets = {c: blank[c] & (F.coalesce(F.col(f"_s_{c}").cast("string"), F.lit("")) != "") for c in columns}
    count = sum((F.when(g, 1).otherwise(0) for g in gets.values()), F.lit(0))
    return both.withColumn("filled", count).withColumns({c: F.when(g, F.col(f"_s_{c}")).otherwise(F.col(c)) for c, g in gets.items()}).drop("_k", *[f"_s_{c}" for c in columns])


def number_versions(observed: DataFrame, key: str, content: str, at: str) -> DataFrame:
    """Versions of each key: every content once, by when it was first seen; numbers are dense. Out-of-order arrivals change nothing."""
    first = observed.where(F.col(content).isNotNull() & (F.col(content) != "")).groupBy(key, content).agg(F.min(at).alias("captured"))
    return first.withColumn("version", F.row_number().over(Window.partitionBy(key).orderBy("captured", content)))


def version_facts(observed: DataFrame, key: str, content: str, fields: list[str], at: str) -> DataFrame:
    """key, content, captured and, for each of ``fields``, struct(v, at): what ``full_versions`` needs of sightings.

    A row for each content of a key, with when it was first seen and each field's first value and its time; and one for
    each set of fields that came without a content.
    """
    given = lambda c: F.when(F.coalesce(F.trim(F.col(c)), F.lit("")) != "", F.trim(F.col(c)))
    rows = observed.select(key, F.coalesce(F.col(content), F.lit("")).alias(content), F.col(at).alias("captured"), *[F.when(given(f).isNotNull(), F.struct(given(f).alias("v"), F.col(at).alias("at"))).alias(f) for f in fields])
    return merged_facts(rows, key, content, fields)


def merged_facts(facts: DataFrame, key: str, content: str, fields: list[str]) -> DataFrame:
    """Facts of several batches as one: the same as those of all their sightings, whatever the batches' order."""
    early = lambda f: F.min_by(f, F.when(F.col(f).isNotNull(), F.struct(f"{f}.at", f"{f}.v"))).alias(f)
    anything = reduce(lambda a, f: a | F.col(f).isNotNull(), fields, F.col(content) != "")
    # rows without a content are told apart by their fields
    own = [F.when(F.col(content) == "", F.col(f"{f}.v")).alias(f"_{f}") for f in fields]
    return facts.where(anything).groupBy(key, content, *own).agg(F.min("captured").alias("captured"), *map(early, fields)).select(key, content, "captured", *fields)


def versions_of(facts: DataFrame, key: str, content: str, fields: list[str]) -> DataFrame:
    """The versions that facts make, numbered by when they were first seen."""
    both = facts.select(key, content, *[F.col(f"{f}.v").alias(f) for f in fields], "captured")
    order = Window.partitionBy(key).orderBy("captured", F.desc(content), *fields)
    before = {f: F.last(f, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)) for f in fields}
    nth = F.row_number().over(order)
    changed = reduce(lambda a, f: a | (F.col(f).isNotNull() & ~F.col(f).eqNullSafe(before[f])), fields, F.lit(False))
    kept = both.withColumn("_new", (F.col(content) != "") | (nth == 1) | changed).where("_new").drop("_new")
    return kept.withColumn("version", F.row_number().over(Window.partitionBy(key).orderBy("captured", F.desc(content), *fields)))


def full_versions(observed: DataFrame, key: str, content: str, fields: list[str], at: str) -> DataFrame:
    """Versions of each key with ``fields`` (title, pay): a new one where the content is new, or where there is none and a field that is given differs from the one before.

    A content that is known already makes no version but fills fields which its version lacks, with the first
    value that came. Rows without a content count by their fields alone. Each key's rows that bring something
    new are compared with the row before; repeats of a whole row are dropped first, by an aggregate.
    """
    return versions_of(version_facts(observed, key, content, fields, at), key, content, fields)


def latest_version(versions: DataFrame, key: str, version: str = "version") -> DataFrame:
    """Each key's highest version, by an aggregate that combines before it shuffles."""
    others = [c for c in versions.columns if c not in (key, version)]
    return versions.groupBy(key).agg(F.max(F.struct(version, *others)).alias("_v")).select(key, F.col(f"_v.{version}").alias(version), *[F.col(f"_v.{c}").alias(c) for c in others])


def upsert_flags(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, flag, value, rule_version, run_id, changed: a flag changes if value or rule version do; a null run never overwrites one."""
    came, was = F.col("n._in"), F.col("o._in")
    both = old.withColumn("_in", F.lit(True)).alias("o").join(new.withColumn("_in", F.lit(True)).alias("n"), [key, "flag"], "full")
    differs = ~(F.col("o.value").eqNullSafe(F.col("n.value")) & F.col("o.rule_version").eqNullSafe(F.col("n.rule_version")))
    take = lambda c: F.when(came, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    return both.select(key, "flag", take("value"), take("rule_version"), F.coalesce("n.run_id", "o.run_id").alias("run_id"), (F.coalesce(came, F.lit(False)) & (was.isNull() | differs)).alias("changed"))


def flags_of(flags: DataFrame, key: str, keys: list | None = None, names: list[str] | None = None) -> DataFrame:
    """Flags of some keys, of some names, or both."""
    out = flags if keys is None else flags.where(F.col(key).isin(keys))
    return out if names is None else out.where(F.col("flag").isin(names))


def backfill_flags(listed: DataFrame, detailed: DataFrame, key: str) -> DataFrame:
    """key, flag, value: the list's flags, but a namespace (``recruit:``) that a detail speaks of has the detail's flags only."""
    space = F.when(F.col("flag").contains(":"), F.substring_index("flag", ":", 1))
    spoken = detailed.select(F.col(key).alias("_k"), space.alias("_s")).where("_s is not null").distinct()
    base = listed.select(key, "flag", "value", space.alias("_space")).join(spoken, (F.col(key) == F.col("_k")) & (F.col("_space") == F.col("_s")), "left_anti").drop("_space")
    both = base.withColumn("_p", F.lit(1)).unionByName(detailed.select(key, "flag", "value").withColumn("_p", F.lit(0)))
    return both.groupBy(key, "flag").agg(F.min_by("value", F.struct("_p", "value")).alias("value"))


def search(rows: DataFrame, key: str, seen: str, equal: dict[str, object] | None = None, since: str | None = None, limit: int | None = None) -> DataFrame:
    """Rows that match all the values given, seen since an instant, the last seen first; ties by key."""
    for c, v in (equal or {}).items():
        rows = rows if v in (None, "") else rows.where(F.col(c) == v)
    if since:
        rows = rows.where(F.col(seen) >= F.to_timestamp(F.lit(since)))
    rows = rows.orderBy(F.col(seen).desc(), key)
    return rows.limit(limit) if limit else rows


def schema_of_version(meta: DataFrame, supported: int) -> DataFrame:
    """The store's version (key, value); an error if it is newer than what is supported, so that no older code writes to it."""
    version = F.coalesce(F.max(F.when(F.col("key") == "schema_version", F.col("value").try_cast("int"))), F.lit(0)).alias("version")
    return meta.agg(version).select(F.when(F.col("version") <= supported, F.col("version")).otherwise(F.raise_error(F.concat(F.lit("the store is newer than this code: "), F.col("version").cast("string"))).cast("int")).alias("version"))


def migrated(meta: DataFrame, tables: dict[str, DataFrame], steps: dict[int, Callable[[dict[str, DataFrame]], dict[str, DataFrame]]]) -> tuple[DataFrame, dict[str, DataFrame]]:
    """(meta, tables) with each step whose number is above the store's version applied once, in rising order; a step gives the tables that it changes. Run again, nothing is left to do; a store newer than the steps is an error."""
    have = schema_of_version(meta, max(steps, default=0)).first()[0]  # one number
    for number in sorted(n for n in steps if n > have):
        tables = {**tables, **steps[number](tables)}
    stamp = meta.sparkSession.range(1).select(F.lit("schema_version").alias("key"), F.lit(str(max([have, *steps]))).alias("value"))
    return meta.where(F.col("key") != "schema_version").select("key", "value").union(stamp), tables


def state_by_age(seen: Column, now: Column, days: int) -> Column:
    """active, or stale once the last sight is more than so many days old; nothing legible is active."""
    return F.when(seen.isNotNull() & (F.timestamp_diff("SECOND", seen, now) > days * 86400), "stale").otherwise("active")


def lifecycle(observed: DataFrame, key: str, at: str, now: Column, days: int) -> DataFrame:
    """key, first_seen, last_seen, seen, state from all sightings."""
    rows = observed.groupBy(key).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.count("*").alias("seen"))
    return rows.withColumn("state", state_by_age(F.col("last_seen"), now, days))


def delta(before: DataFrame, after: DataFrame, key: str, by: str) -> DataFrame:
    """by, added, removed, kept, baseline: what changed for each scope; a scope without history is a baseline; null scopes take no part."""
    old = before.where(F.col(by).isNotNull()).select(by, key).distinct().withColumn("o", F.lit(1))
    new = after.where(F.col(by).isNotNull()).select(by, key).distinct().withColumn("n", F.lit(1))
    return old.join(new, [by, key], "full").groupBy(by).agg(F.count_if(F.col("o").isNull()).alias("added"), F.count_if(F.col("n").isNull()).alias("removed"), F.count_if(F.col("o").isNotNull() & F.col("n").isNotNull()).alias("kept"), (F.count("o") == 0).alias("baseline"))
