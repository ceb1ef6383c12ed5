"""Data quality: findings, invariants, fidelity, contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges of values in which exact medians are sought.
RANGES = 1_024


def findings(df: DataFrame, checks: dict[str, tuple[str, Column]]) -> DataFrame:
    """id, level, count for each check (level, condition of a bad row), all in one pass."""
    row = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, (_, c) in checks.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("id"), F.lit(level).alias("level"), F.col(n).alias("count")) for n, (level, _) in checks.items()])).alias("f")).select("f.*")


def one_to_one(df: DataFrame, a: str, b: str) -> DataFrame:
    """side, keys: values of either column that stand with several of the other."""
    pairs = df.select(a, b).where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct()
    bad = lambda x, y: pairs.groupBy(x).agg(F.count("*").alias("n")).agg(F.lit(x).alias("side"), F.count_if(F.col("n") > 1).alias("keys"))
    return bad(a, b).union(bad(b, a))


def unmarked_groups(df: DataFrame, print_: str, group: str) -> DataFrame:
    """Contents that stand on several rows without one common, non-blank group: print, rows, groups."""
    rows = df.where(F.coalesce(F.col(print_), F.lit("")) != "").groupBy(print_).agg(F.count("*").alias("rows"), F.count_distinct(group).alias("groups"), F.count_if(F.coalesce(F.col(group), F.lit("")) == "").alias("blank"))
    return rows.where("rows > 1 and (groups <> 1 or blank > 0)").drop("blank")


def field_fidelity(pairs: DataFrame, fields: list[str]) -> DataFrame:
    """field, exact, normalised, mismatch, no_check, rate: each field of raw (r_*) and record (c_*) side by side. The rate counts comparable values only."""
    norm = lambda c: F.lower(F.regexp_replace(c, "\\s+", ""))

    def verdict(f: str) -> Column:
        r, c = F.col(f"r_{f}").cast("string"), F.col(f"c_{f}").cast("string")
        return F.when(F.coalesce(r, F.lit("")) == "", "no_check").when(r == c, "exact").when(norm(r) == norm(F.coalesce(c, F.lit(""))), "normalised").otherwise("mismatch")

    each = pairs.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), verdict(f).alias("v")) for f in fields])).alias("x")).select("x.*")
    counts = each.groupBy("field").agg(*[F.count_if(F.col("v") == v).alias(v) for v in ("exact", "normalised", "mismatch", "no_check")])
    comparable = F.col("exact") + F.col("normalised") + F.col("mismatch")
    return counts.withColumn("rate", F.when(comparable > 0, F.round((F.col("exact") + F.col("normalised")) / comparable, 4)))


def containment(raw: Column, body: Column, least: float) -> Column:
    """error if the body isn't a part of the raw text (white space aside), warn if it is much shorter, else ok."""
    r, b = (F.regexp_replace(F.coalesce(c, F.lit("")), "\\s+", "") for c in (raw, body))
    return F.when(~F.contains(r, b), "error").when(F.length(b) < least * F.length(r), "warn").otherwise("ok")


def matrix(requirements: DataFrame, properties: DataFrame, examples: DataFrame) -> DataFrame:
    """requirement, properties, examples, gap: each requirement with its properties and the counterexamples that test them."""
    p = properties.groupBy("requirement").agg(F.count("*").alias("properties"))
    e = properties.join(examples, "property").groupBy("requirement").agg(F.count("*").alias("examples"))
    return requirements.join(p, "requirement", "left").join(e, "requirement", "left").select("requirement", F.coalesce("properties", F.lit(0)).alias("properties"), F.coalesce("examples", F.lit(0)).alias("examples"), F.col("examples").isNull().alias("gap"))


def list_audit(df: DataFrame, direction: Column, hit: Column, wanted: str = "ai_pm", hit_least: float = 0.6, off_most: float = 0.4) -> DataFrame:
    """total, hits, wanted, hit_rate, off_rate, warnings: whether a list is worth fetching details for, in one row."""
    row = df.agg(F.count("*").alias("total"), F.count_if(hit).alias("hits"), F.count_if(direction == wanted).alias("wanted"))
    row = row.withColumns({"hit_rate": F.when(F.col("total") > 0, F.round(F.col("hits") / F.col("total"), 4)), "off_rate": F.when(F.col("total") > 0, F.round(1 - F.col("wanted") / F.col("total"), 4))})
    return row.withColumn("warnings", F.array_join(F.array_compact(F.array(F.when(F.col("hit_rate") < hit_least, F.lit("few_hits")), F.when(F.col("off_rate") > off_most, F.lit("off_direction")))), ","))


def delivery_rates(df: DataFrame, by: str, root: Column, city: Column, declared: Column, root_least: float, city_least: float) -> DataFrame:
    """by, rows, root_rate, city_rate, verdict: a delivery against its request; the first condition that fails names the verdict."""
    row = df.groupBy(by).agg(F.count("*").alias("rows"), F.round(F.avg(root.cast("int")), 4).alias("root_rate"), F.round(F.avg(city.cast("int")), 4).alias("city_rate"), F.max(declared).alias("_declared"))
    return row.withColumn("verdict", F.when(F.col("rows") != F.col("_declared"), "count").when(F.col("root_rate") < root_least, "root").when(F.col("city_rate") < city_least, "city").otherwise("ok")).drop("_declared")


def outliers(df: DataFrame, peers: str, value: str, low: float, high: float) -> DataFrame:
    """Rows with outlier: the value is over ``high`` times, or under ``low`` times, the median of its peers.

    The exact median comes from counts of different values: their running sums within ranges of the values, and
    the ranges' sums before them, so that no task holds all peers' values even where there are few peers.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(peers).alias("_p"), F.col(value).alias("_v")).agg(F.count("*").alias("n"))
    # ranges of about the same width between the peers' least and greatest value
    edge = counts.groupBy("_p").agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.sum("n").alias("_all")).withColumnRenamed("_p", "_q")
    part = F.least(F.lit(RANGES - 1), F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("_v") - F.col("_lo")) * RANGES / (F.col("_hi") - F.col("_lo")))).otherwise(0)).cast("int")
    ranged = counts.join(edge, F.col("_p") == F.col("_q")).withColumn("_part", part)
    sums = ranged.groupBy("_p", "_part").agg(F.sum("n").alias("_sum")).withColumn("_before", F.sum("_sum").over(Window.partitionBy("_p").orderBy("_part")) - F.col("_sum"))
    sums = sums.select(F.col("_p").alias("_a"), F.col("_part").alias("_b"), "_sum", "_before")  # RANGES rows for each kind of peers
    # the two middle places, counted from 0, are alike where the number is odd
    left, right = F.floor((F.col("_all") - 1) / 2), F.floor(F.col("_all") / 2)
    holds = lambda at: (F.col("_before") <= at) & (at < F.col("_before") + F.col("_sum"))
    near = ranged.join(sums, (F.col("_p") == F.col("_a")) & (F.col("_part") == F.col("_b"))).where(holds(left) | holds(right))
    upto = F.col("_before") + F.sum("n").over(Window.partitionBy("_p", "_part").orderBy("_v"))
    near = near.withColumn("_upto", upto)
    at = lambda place: F.min(F.when(F.col("_upto") > place, F.col("_v")))
    middle = near.groupBy("_p").agg(((at(left) + at(right)) / 2).alias("_mid"))
    both = df.join(middle, F.col(peers) == F.col("_p"), "left")
    return both.withColumn("outlier", (F.col(value) > F.col("_mid") * high) | (F.col(value) < F.col("_mid") * low)).drop("_p", "_mid")


def samples(df: DataFrame, condition: Column, order: str, n: int) -> DataFrame:
    """The first rows that meet a condition, for people to look at."""
    return df.where(condition).orderBy(order).limit(n)


def usable(df: DataFrame, condition: Column) -> DataFrame:
    """One row: rows_all, usable: whether any row meets the condition."""
    return df.agg(F.count("*").alias("rows_all"), F.coalesce(F.bool_or(condition), F.lit(False)).alias("usable"))


def orphans(requirements: DataFrame, properties: DataFrame, examples: DataFrame) -> DataFrame:
    """kind, orphans: properties whose requirement, and examples whose property, does not exist."""
    p = properties.join(requirements, "requirement", "left_anti").agg(F.lit("property").alias("kind"), F.count_distinct("property").alias("orphans"))
    return p.union(examples.join(properties, "property", "left_anti").agg(F.lit("example"), F.count("*")))


def raw_pairs(raw: DataFrame, records: DataFrame, link: str, name: str, order: str, fields: dict[str, str]) -> DataFrame:
    """r_ and c_ columns of each field, for ``field_fidelity``: records with the raw item whose computed id is theirs, the last one where several are. fields: field to raw column."""
    own = F.coalesce(F.when(F.col(link) != "", F.col(link)), F.col(name), F.lit(""))
    keyed = raw.select(F.substring(F.md5(own), 1, 16).alias("_id"), F.col(order).alias("_o"), *[F.col(r).cast("string").alias(f"r_{f}") for f, r in fields.items()])
    last = keyed.groupBy("_id").agg(F.max_by(F.struct(*[f"r_{f}" for f in fields]), "_o").alias("_r"))
    both = records.join(last, F.col("job_id") == F.col("_id"), "left")
    return both.select("job_id", *[F.col(f"_r.r_{f}").alias(f"r_{f}") for f in fields], *[F.col(f).cast("string").alias(f"c_{f}") for f in fields])
