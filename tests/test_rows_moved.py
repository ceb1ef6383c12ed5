"""Queries whose rows meet in large groups: what their joins make and what they shuffle stays near the input."""

import random

import pytest
from pyspark.sql import functions as F

from sievework.operators import merge, scopes


def counted(df, kind, metric):
    """Sum of a metric over the executed plan's nodes of a kind."""
    df.collect()
    total, left = 0, [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        else:
            left += [node.children().apply(i) for i in range(node.children().size())]
        if kind in name and node.metrics().contains(metric):
            total += node.metrics().apply(metric).value()
    return total


def test_a_name_that_many_files_and_profiles_share_makes_no_pairs(spark):
    """2,000 profiles state one name, which 2,000 files have; 500 of them also have a scope."""
    profiles = spark.range(2000).select(F.col("id").alias("profile"), F.expr("case when id < 500 then concat('s', id % 5) end").alias("scope_key"), F.lit("a.json").alias("target"))
    files = spark.range(2000).select(F.expr("concat('/out/', id % 7, '/a.json')").alias("path"), F.expr("case when id % 3 = 0 then concat('s', id % 5) end").alias("scope_key"), (F.col("id") % 1000).alias("created_at"))
    found = scopes.first_matches(profiles, files)
    assert counted(found, "Join", "numOutputRows") <= 2 * 2000 + 500
    newest = max((i % 1000, f"/out/{i % 7}/a.json") for i in range(2000))[1]
    assert sorted(map(tuple, found.collect())) == [(i, newest) for i in range(2000)]


@pytest.fixture
def no_broadcasts(spark):
    """Joins as they are where neither side is small."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, before)


def test_pairs_of_a_hot_title_are_made_but_not_moved(spark, no_broadcasts):
    """300 jobs and 300 details of one title are 90,000 pairs; what is shuffled is their membership."""
    jobs = spark.range(300).selectExpr("id as job", "cast(null as string) as id", "concat('l', id) as link", "'hot' as title_key")
    details = spark.range(300).selectExpr("id as detail", "cast(null as string) as id", "cast(null as string) as link", "'hot' as title_key")
    pairs = merge.associate(jobs, details, "detail")
    assert counted(pairs, "ShuffleExchange", "shuffleRecordsWritten") <= 5_000
    assert pairs.count() == pairs.distinct().count() == 90_000


def test_pairs_that_share_several_classes_come_out_once(spark):
    """Jobs and details in several rows, with other ids, links and titles in each."""
    rnd = random.Random(7)
    one = lambda words, blank: None if rnd.random() < blank else rnd.choice(words)
    jobs = [(rnd.randrange(15), one("ab", 0.3), one("klmn", 0.3), one("tuvw", 0.2)) for _ in range(40)]
    details = [(rnd.randrange(15), one("abc", 0.8), one("klmnop", 0.5), one("tuvwxyz", 0.2)) for _ in range(40)]
    of = lambda id_, link, title: {(1, id_), (2, link), (3, title)}
    job_in = {(j, *c) for j, *values in jobs for c in of(*values) if c[1]}
    found = set()
    for d, id_, link, title in details:
        mine = {c for c in (of(id_, None, None) if id_ else of(None, link, title)) if c[1]}
        found |= {(d, *c) for c in mine if c in {x[1:] for x in job_in}}
    best = {d: min(p for e, p, _ in found if e == d) for d, _, _ in found}
    want = {(d, j, p) for d, p, v in found if p == best[d] for j, q, w in job_in if (p, v) == (q, w)}
    got = merge.associate(spark.createDataFrame(jobs, "job long, id string, link string, title_key string"), spark.createDataFrame(details, "detail long, id string, link string, title_key string"), "detail")
    assert sorted(map(tuple, got.collect())) == sorted(want)
