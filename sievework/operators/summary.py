"""Market summaries: pay, frequencies, terms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievework.functions.postings import monthly_range
from sievework.functions.records import degree_tag, experience_tag, skill_mentions
from sievework.functions.text import district, first_filled, has_word


def pay_stats(df: DataFrame, low: Column, high: Column, by: list[str] = ()) -> DataFrame:
    """parsed, unparsed, median, mean, p10 of lows, p90 of highs; exact, linear quantiles.

    Rows of one pay are counted first, and the quantiles are those of the counts: what moves are different pays.
    """
    pays = df.groupBy(*by, low.alias("_low"), high.alias("_high")).agg(F.count("*").alias("_n"))
    return _of_counts(pays, by)


def _of_counts(pays: DataFrame, by: list[str]) -> DataFrame:
    n, mid = F.col("_n"), (F.col("_low") + F.col("_high")) / 2
    total = lambda c: F.coalesce(F.sum(F.when(c, n)), F.lit(0))
    return pays.groupBy(*by).agg(total(mid.isNotNull()).alias("parsed"), total(mid.isNull()).alias("unparsed"), F.percentile(mid, 0.5, n).alias("median"), F.round(F.sum(mid * n) / F.sum(F.when(mid.isNotNull(), n)), 1).alias("mean"), F.round(F.percentile("_low", 0.1, n), 1).alias("p10"), F.round(F.percentile("_high", 0.9, n), 1).alias("p90"))


def markets(df: DataFrame, low: Column, high: Column, cuts: dict[str, Column]) -> DataFrame:
    """pay_stats of several overlapping subsets, a row each, in one pass: rows are counted by pay and the subsets they belong to, and only the counts are dealt out to them."""
    names = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in cuts.items()]), lambda x: x.isNotNull())
    pays = df.groupBy(names.alias("_markets"), low.alias("_low"), high.alias("_high")).agg(F.count("*").alias("_n"))
    return _of_counts(pays.select(F.explode("_markets").alias("market"), "_low", "_high", "_n"), ["market"])


def top_values(df: DataFrame, dimensions: dict[str, Column], top: int, order: str | None = None) -> DataFrame:
    """dimension, value, n, rank: the most frequent values of several dimensions, in one pass; ties by first sight in ``order`` where given, then by value. Array columns count each element."""
    kinds = dict(df.select(*[c.alias(n) for n, c in dimensions.items()]).dtypes)
    each = [F.struct(F.lit(n).alias("dimension"), (c.cast("array<string>") if kinds[n].startswith("array") else F.array(c.cast("string"))).alias("values")) for n, c in dimensions.items()]
    seen = F.col(order) if order else F.lit(0)
    rows = df.select(seen.alias("_o"), F.explode(F.array(*each)).alias("x")).select("_o", "x.dimension", F.explode("x.values").alias("value")).where("value is not null and value <> ''")
    counts = rows.groupBy("dimension", "value").agg(F.count("*").alias("n"), F.min("_o").alias("_f"))
    return counts.withColumn("rank", F.row_number().over(Window.partitionBy("dimension").orderBy(F.col("n").desc(), "_f", "value"))).where(F.col("rank") <= top).drop("_f")


#: Values that a sketch tracks. What it leaves out has no more than SKETCH_ERROR / TRACKED of the rows: the sketch's own bound is 3.5 over its size, and a value that it doesn't report lies within twice that.
TRACKED, SKETCH_ERROR = 8192, 7.0


def frequent_values(rows: DataFrame, by: str, value: str, top: int, order: str | None = None, tracked: int = TRACKED) -> DataFrame:
    """by, value, n, rank: the same as counting all values, but what is shuffled is bounded by sketches and not by how many different values there are.

    A mergeable sketch a group proposes candidates; a second pass counts these exactly. That is the result if the last of
    the first ``top`` has more rows than any value that the sketch may have left out, or if the candidates have all rows.
    Groups where neither holds are counted in full. Ties by first sight in ``order`` where given, then by value. ``by`` is
    taken to have few values, as dimensions are.
    """
    rows = rows.select(F.col(by).alias("by"), F.col(value).cast("string").alias("value"), (F.col(order) if order else F.lit(0)).alias("_o")).where("value is not null and value <> ''")
    sketch = rows.groupBy("by").agg(F.expr(f"approx_top_k(value, {tracked}, {tracked})").alias("_k"), F.count("*").alias("_all"))
    candidates = sketch.select("by", F.explode("_k.item").alias("value"))  # ``tracked`` a group at the most
    count = lambda df: df.groupBy("by", "value").agg(F.count("*").alias("n"), F.min("_o").alias("_f"))
    ranked = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("by").orderBy(F.col("n").desc(), "_f", "value")))
    counted = ranked(count(rows.join(F.broadcast(candidates), ["by", "value"], "left_semi")))
    last = counted.groupBy("by").agg(F.sum("n").alias("_known"), F.max(F.when(F.col("rank") == top, F.col("n"))).alias("_last"))
    state = sketch.select("by", "_all").join(last, "by", "left")
    certain = (F.col("_known") == F.col("_all")) | (F.col("_last") > F.col("_all") * (SKETCH_ERROR / tracked))
    open_ = state.where(~F.coalesce(certain, F.lit(False))).select("by")  # a row a group
    in_full = ranked(count(rows.join(F.broadcast(open_), "by", "left_semi")))
    both = counted.join(F.broadcast(open_), "by", "left_anti").union(in_full)
    return both.where(F.col("rank") <= top).select(F.col("by").alias(by), F.col("value").alias(value), "n", "rank")


def posting_dimensions(skills: str, terms: list[str], detail_tags: Column | None = None, stop: tuple[str, ...] = ()) -> dict[str, Column]:
    """The fourteen dimensions of a market summary, for ``top_values``; each body counts a term once."""
    said = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    return {
        "salary": F.when(said("salary") == "", "未标注").otherwise(said("salary")), "experience": experience_tag(), "degree": degree_tag(), "district": district("location"),
        "company": first_filled("company_name", "boss_name"), "scale": said("company_scale"), "stage": said("company_stage"), "industry": said("company_industry"),
        "welfare": F.transform(F.split(said("welfare"), " \\| "), lambda w: F.trim(w)), "icon": F.when(said("icon_word") != "", said("icon_word")).otherwise(F.trim(F.substring_index(said("icon_flags"), "|", 1))),
        "skill": skill_mentions(skills, detail_tags=detail_tags, stop=stop), "term": F.array_compact(F.array(*[F.when(has_word("jd", t), F.lit(t)) for t in terms])), "recruit_type": F.col("recruit_type"), "post_type": F.col("post_type"),
    }


def top_pay(df: DataFrame, order: str, columns: list[str], n: int) -> DataFrame:
    """The rows with the highest legible pay: order, columns, high; ties by order."""
    high = monthly_range("salary")["high"]
    return df.select(order, *columns, high.alias("high")).where("high is not null").orderBy(F.col("high").desc(), order).limit(n)


def mine_terms(df: DataFrame, text: str, pattern: str, stop: list[str], top: int, least: int) -> DataFrame:
    """term, n: frequent terms by a pattern, the top ones first, then those met often enough; ties by term."""
    words = df.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("term"))
    return words.where(~F.col("term").isin(*stop)).groupBy("term").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "term").limit(top).where(F.col("n") >= least)


#: Latin words of 2 to 30 characters, and runs of 2 to 6 Chinese ones, cut from the left.
TERM = "\\b[A-Za-z][A-Za-z0-9._-]{1,29}\\b|[\\x{4e00}-\\x{9fff}]{2,6}"


def all_terms(df: DataFrame, text: str, order: str, base: list[str], keywords: list[str], stop: list[str], top: int, least: int) -> DataFrame:
    """term, kind: base terms (0), then keywords (1), then terms mined from the texts (2), each term once, under its first kind. The top ones are taken before those that are too rare go; ties by first sight."""
    words = df.select(F.col(order).alias("_o"), F.explode(F.regexp_extract_all(F.col(text), F.lit(TERM), F.lit(0))).alias("term")).where(~F.col("term").isin(*stop))
    counts = words.groupBy("term").agg(F.count("*").alias("n"), F.min("_o").alias("_f")).orderBy(F.col("n").desc(), "_f", "term").limit(top).where(F.col("n") >= least)
    spark = df.sparkSession
    given = spark.createDataFrame([(t, 0) for t in base] + [(t, 1) for t in keywords if len(t) >= 2], "term string, kind int")
    return given.union(counts.select("term", F.lit(2))).groupBy("term").agg(F.min("kind").alias("kind"))


def document_frequency(df: DataFrame, text: str, terms: list[str]) -> DataFrame:
    """term, docs: rows in which each term stands; one pass, a counter a term, no join."""
    row = df.agg(*[F.count_if(has_word(F.col(text), t)).alias(f"t{i}") for i, t in enumerate(terms)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(t).alias("term"), F.col(f"t{i}").alias("docs")) for i, t in enumerate(terms)])).alias("x")).select("x.*")


def histogram(df: DataFrame, value: str, bins: int | None = None) -> DataFrame:
    """bin, n: equal widths between least and greatest; the greatest falls into the last bin. Without a number of bins there are as many as different values, 5 to 12. Chart data, not a drawing."""
    # more than twelve different values need not be told apart
    few = F.size(F.collect_set("_v"))
    known = F.lit(bins) if bins else F.least(F.lit(12), F.greatest(F.lit(5), F.col("_d")))
    values = df.select(F.col(value).alias("_v")).where("_v is not null")
    edge = values.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi")).withColumn("_d", F.lit(0))
    if not bins:
        different = values.distinct().limit(12).agg(few.alias("_d"))
        edge = edge.drop("_d").join(F.broadcast(different))  # one row each
    edge = edge.withColumn("_bins", known)
    width = (F.col("hi") - F.col("lo")) / F.col("_bins")
    b = F.when(F.col("hi") == F.col("lo"), 0).otherwise(F.least(F.col("_bins") - 1, F.floor((F.col("_v") - F.col("lo")) / width)))
    return values.join(F.broadcast(edge)).groupBy(b.cast("int").alias("bin")).agg(F.count("*").alias("n"))  # one row


def supply(df: DataFrame, by: str, wanted: int, per_request: int) -> DataFrame:
    """by, have, gap, requests: how much is missing to a wanted number and how many requests would bring it."""
    return df.groupBy(by).agg(F.count("*").alias("have")).withColumn("gap", F.greatest(F.lit(0), F.lit(wanted) - F.col("have"))).withColumn("requests", F.ceil(F.col("gap") / per_request))


def supply_plan(df: DataFrame, by: str, remaining: int, capacity: int) -> DataFrame:
    """by, todo, gap, combos, ceiling: what is missing to the rest of a budget, how many more requests bring it, and how much can be done at the most."""
    rows = df.groupBy(by).agg(F.count("*").alias("todo")).withColumn("gap", F.greatest(F.lit(0), F.lit(remaining) - F.col("todo")))
    return rows.withColumns({"combos": F.when(F.col("gap") > 0, F.greatest(F.lit(1), F.ceil(F.col("gap") / capacity))).otherwise(0).cast("long"), "ceiling": F.least("todo", F.lit(remaining))})


def channels(df: DataFrame, by: str, channel: Column, ok: Column, known: tuple[str, ...]) -> DataFrame:
    """by, channel, a count for each known channel: how results were got; one channel's name, mixed, or unknown. Failed tries do not count."""
    counts = df.groupBy(by).agg(*[F.count_if(ok & (channel == k)).alias(k) for k in known])
    used = F.array_compact(F.array(*[F.when(F.col(k) > 0, F.lit(k)) for k in known]))
    return counts.withColumn("channel", F.when(F.size(used) == 0, "unknown").when(F.size(used) == 1, F.get(used, F.lit(0))).otherwise("mixed")).select(by, "channel", *known)


def run_summary(df: DataFrame, by: str, ok: Column, reason: str, seconds: str, session: str, least: int = 5) -> DataFrame:
    """by, total, ok, failed, reasons (reason:count, by name), seconds (a row, rounded up), drift: whether more than half of at least so many failures are of sessions."""
    each = df.groupBy(by, F.when(~ok, F.col(reason)).alias("_r"), ok.alias("_ok")).agg(F.count("*").alias("_n"), F.sum(seconds).alias("_s"))
    total, failed = F.sum("_n"), F.coalesce(F.sum(F.when(~F.col("_ok"), F.col("_n"))), F.lit(0))
    named = F.array_sort(F.collect_list(F.when(F.col("_r").isNotNull(), F.struct("_r", "_n"))))
    out = each.groupBy(by).agg(total.alias("total"), failed.alias("failed"), named.alias("_named"), F.ceil(F.sum("_s") / total).alias("seconds"), F.coalesce(F.sum(F.when(F.col("_r") == session, F.col("_n"))), F.lit(0)).alias("_session"))
    return out.select(by, "total", (F.col("total") - F.col("failed")).alias("ok"), "failed", F.array_join(F.transform("_named", lambda x: F.concat_ws(":", x["_r"], x["_n"])), ",").alias("reasons"), "seconds", ((F.col("failed") >= least) & (F.col("_session") > 0.5 * F.col("failed"))).alias("drift"))


def mismatches(jobs: DataFrame, details: DataFrame, key: str, bad_job: Column, bad_detail: Column) -> DataFrame:
    """One row: total, mismatched jobs: by themselves or by any of their details."""
    d = details.groupBy(F.col(key).alias("_k")).agg(F.bool_or(F.coalesce(bad_detail, F.lit(False))).alias("_bad"))
    own = F.coalesce(bad_job, F.lit(False))
    return jobs.withColumn("_own", own).join(d, F.col(key) == F.col("_k"), "left").agg(F.count("*").alias("total"), F.count_if(F.col("_own") | F.coalesce("_bad", F.lit(False))).alias("mismatched"))


def reconciled(kept: DataFrame, filtered: DataFrame) -> DataFrame:
    """One row: kept, filtered, input (their sum), share of what was kept."""
    row = kept.agg(F.count("*").alias("kept")).join(F.broadcast(filtered.agg(F.count("*").alias("filtered"))))  # one row each
    return row.withColumn("input", F.col("kept") + F.col("filtered")).withColumn("share", F.when(F.col("input") > 0, F.round(F.col("kept") / F.col("input"), 4)))


def distributions(df: DataFrame, columns: list[str]) -> DataFrame:
    """dimension, value, n of several columns, in one pass; nulls as unlabeled."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("dimension"), F.coalesce(F.col(c).cast("string"), F.lit("unlabeled")).alias("value")) for c in columns]))
    return df.select(each.alias("x")).select("x.*").groupBy("dimension", "value").agg(F.count("*").alias("n"))


def table_statistics(df: DataFrame, name: str, key: str, day: str) -> DataFrame:
    """One row: rows, different keys, keys that stand on several rows, the latest day."""
    each = df.groupBy(key).agg(F.count("*").alias("_n"), F.max(day).alias("_d"))
    return each.agg(F.lit(name).alias("name"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"), F.count(key).alias("keys"), F.count_if(F.col("_n") > 1).alias("repeated"), F.max(F.col("_d").cast("string")).alias("latest"))
