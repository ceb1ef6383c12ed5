"""Operators that work on classes and candidates instead of pairs and all values, against plain forms."""

import random
from collections import Counter

import pytest

from sievework.operators import merge, summary


@pytest.mark.parametrize("tracked", [64, 4096])
def test_frequent_values_are_exact(spark, tracked):
    rnd = random.Random(4)
    rows = [("flat", f"v{i % 900}", i) for i in range(2700)]  # all tie: no sketch can decide
    rows += [("steep", f"w{min(int(rnd.paretovariate(0.7)), 5000)}", i) for i in range(4000)]
    rows += [("few", rnd.choice("ab"), i) for i in range(50)] + [("few", "", 0), ("few", None, 0), (None, "x", 1), ("empty", None, 2)]
    df = spark.createDataFrame(rows, "kind string, v string, at long").repartition(6)
    want = []
    for kind in ("flat", "steep", "few"):
        n, first = Counter(), {}
        for k, v, at in rows:
            if k == kind and v:
                n[v] += 1
                first[v] = min(at, first.get(v, at))
        order = sorted(n, key=lambda v: (-n[v], first[v], v))[:7]
        want += [(kind, v, n[v], i) for i, v in enumerate(order, 1)]
    got = summary.frequent_values(df, "kind", "v", 7, "at", tracked).where("kind is not null")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_a_hot_title_makes_no_pairs(spark):
    """4,000 jobs and 4,000 details of one title: 16 million pairs, of which none is made."""
    jobs = spark.range(4000).selectExpr("id as job", "cast(id + 1 as string) as id", "cast(null as string) as link", "'hot' as title_key")
    details = spark.range(4000).selectExpr("id as detail", "cast(null as string) as id", "cast(null as string) as link", "case when id < 3990 then 'hot' else 'cold' end as title_key")
    found, job_in, sizes = merge.association_classes(jobs, details, "detail")
    assert found.count() == 3990 and job_in.count() == 8000
    assert sizes.where("value = 'hot'").first().jobs == 4000
    assert merge.keep_associated(jobs, details, jobs.limit(0), "detail").count() == 3990
    assert merge.keep_associated(jobs, details, jobs.where("job = 7"), "detail").count() == 0


def test_priorities_of_classes(spark):
    jobs = spark.createDataFrame([(1, "a", "l1", "t"), (2, "a", None, "t"), (3, None, "l1", "u"), (3, None, "l1", "u")], "job long, id string, link string, title_key string")
    details = spark.createDataFrame([(1, "a", "l1", "t"), (2, "none", "l1", "t"), (3, None, "l1", "t"), (4, None, "l9", "t"), (5, None, None, None), (5, None, None, "u"), (6, None, "l9", "x")], "detail long, id string, link string, title_key string")
    pairs = sorted(map(tuple, merge.associate(jobs, details, "detail").collect()))
    assert pairs == [(1, 1, 1), (1, 2, 1), (3, 1, 2), (3, 3, 2), (4, 1, 3), (4, 2, 3), (5, 3, 3)]
    alone = merge.associate(jobs.limit(3), details, "detail").where("detail = 6").collect()
    assert [tuple(r) for r in alone] == [(6, 3, 4)]
