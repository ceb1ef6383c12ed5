"""Duplicates and keyed merges: marking groups, choosing the best, first or last wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def mark_groups(df: DataFrame, group: str, order: list[str | Column]) -> DataFrame:
    """dup_group, dup_size, is_primary for each row: groups of two and more rows with one non-blank ``group`` value; the first by ``order`` is primary.

    Groups are told by a hash of their value, which is what moves. Sizes come from an aggregate that combines
    before it shuffles and is joined back, and the primary from the group's least order key, so no window holds
    a large group.
    """
    keyed = df.withColumn("_key", F.when(F.col(group) != "", F.sha2(F.col(group), 256)))
    sizes = keyed.where("_key is not null").groupBy(F.col("_key").alias("_group")).agg(F.count("*").alias("dup_size"), F.min(F.struct(*order)).alias("_first")).where("dup_size > 1")
    out = keyed.join(sizes, F.col("_key") == F.col("_group"), "left")
    grouped = F.col("_group").isNotNull()
    return out.withColumns({
        "dup_group": F.when(grouped, F.concat(F.lit("dup-"), F.substring("_group", 1, 8))).otherwise(F.lit("")),
        "dup_size": F.coalesce(F.col("dup_size"), F.lit(1)),
        "is_primary": ~grouped | (F.struct(*order) == F.col("_first")),
    }).drop("_key", "_group", "_first")


def keep_best(df: DataFrame, keys: list[str], best: list[Column], id_col: str) -> tuple[DataFrame, DataFrame]:
    """(the best row for each key, the least by ``best``, with kept (rows of the key); the others as rows: keys, best, other). Rows with a null or blank key are dropped.

    The best row comes from an aggregate, and the others are rows, so that no task holds a key's rows.
    """
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    rows = df.where(whole)
    values = [c for c in df.columns if c not in keys]
    found = rows.groupBy(*keys).agg(F.min_by(F.struct(*values), F.struct(*[b.alias(f"b{i}") for i, b in enumerate(best)])).alias("_r"), F.count("*").alias("kept"))
    first = found.select(*[F.col(k) for k in keys], *[F.col(f"_r.{c}").alias(c) for c in values], "kept")
    own = first.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(id_col).alias("best"))
    same = [F.col(k) == F.col(f"_k{i}") for i, k in enumerate(keys)]
    others = rows.select(*keys, F.col(id_col).alias("other")).join(own, same).where(F.col("other") != F.col("best")).select(*keys, "best", "other")
    return first.select(*df.columns, "kept"), others


def merge_keyed(old: DataFrame, new: DataFrame, key: str, order: str, old_wins: bool = True, keep_unkeyed: bool = True) -> DataFrame:
    """One row for each key of two inputs with the same columns: the old one's first, or else the new one's last. Rows of ``old`` without a key survive if asked for."""
    both = old.withColumn("_side", F.lit(0)).unionByName(new.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    has_key = F.coalesce(F.col(key).cast("string") != "", F.lit(False))
    by = [F.col("_side"), F.col(order)] if old_wins else [F.col("_side").desc(), F.col(order).desc()]
    first = both.where(has_key).withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*by))).where("_n = 1").drop("_n", "_side")
    return first.unionByName(old.where(~has_key), allowMissingColumns=True) if keep_unkeyed else first


def pages_until_repeat(df: DataFrame, page: str, item: str, full_page: int) -> DataFrame:
    """Pages read before a listing repeats itself: a page stops the reading if its set of items occurred before; one that isn't full is the last. page, n_items, stops."""
    pages = df.groupBy(page).agg(F.count("*").alias("n_items"), F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(item).cast("string"))), ","), 256).alias("print"))
    first = pages.groupBy("print").agg(F.min(page).alias("_first"))
    marked = pages.join(first, "print").withColumn("stops", (F.col(page) > F.col("_first")) | (F.col("n_items") < full_page))
    end = marked.where("stops").agg(F.min(F.struct(page, (F.col(page) > F.col("_first")).alias("again"))).alias("_end"))
    kept = F.col("_end").isNull() | (F.col(page) < F.col(f"_end.{page}")) | ((F.col(page) == F.col(f"_end.{page}")) & ~F.col("_end.again"))
    return marked.join(F.broadcast(end)).where(kept).select(page, "n_items", "stops")  # one row
