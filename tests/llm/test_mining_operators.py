"""Quality classifier, collocations and hard negatives against plain versions."""

import math
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pandas as pd
import pytest

from sievework.llm import collocations as C
from sievework.llm import factorisation as Q
from sievework.llm import negatives as N
from sievework.llm.queries import ORACLE_SQL, QUERIES

from ..conftest import SF


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df[cols].values.tolist()))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.sql(f"create view {table} as select * from '{SF}/{table}.parquet'")
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.sql(ORACLE_SQL[name]).df())


# ---------------------------------------------------------------- collocations


def plain_collocations(texts, least, longest, first):
    """(lang, rank, phrase, a, l, r, n, score) by Python integers."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in texts:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in "".join("\n" if c in ".,;:!?\n\x0b\x0c\r" else c for c in low).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in some.items():
            if any(len(q) > len(p) and 100 * b >= 50 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in some.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:first], 1)]
    return sorted(out)


def odd_texts():
    rng = np.random.default_rng(3)
    texts = [(("en", "de", None)[i % 3], " ".join(f"W{x}" if x % 5 else f"w{x}." for x in rng.zipf(1.4, 60) % 40)) for i in range(60)]
    texts += [("en", None), ("en", ""), (None, " .\t,; "), ("und", "a b a b a b"), ("fr", "É é\x0bÉ é x\tÉ é"), ("de", "x\ty z " * 3000), ("en", "tie one tie one")]
    return texts + [("en", "hot words again and again")] * 40


@pytest.mark.parametrize(("least", "longest", "first"), [(10, 3, 2000), (3, 4, 7), (1, 2, 50)])
def test_collocations_match_plain_counts(spark, monkeypatch, least, longest, first):
    monkeypatch.setattr(C, "CELL_BITS", (8, 10))  # a sketch in which all cells are shared
    texts = odd_texts()
    docs = spark.createDataFrame([(t, lang, 1, "x") for lang, t in texts], "text string, lang string, size int, phrase string").repartition(5)
    out = C.collocations(docs, least=least, longest=longest, first=first)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, out.collect())) == plain_collocations(texts, least, longest, first)


def test_sketch_never_counts_too_few(spark):
    docs = spark.createDataFrame(odd_texts(), "lang string, text string").repartition(7)
    few, many = (C.frequent(docs, least=least).where("size > 0") for least in (10, 1))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.where("f >= 10").collect()))


def test_scores_are_exact_beyond_64_bits(spark):
    a, left, right = 987_654_321_987, 987_654_321_989, 998_765_432_101_234
    counts = spark.createDataFrame([("en", 1, "x", left), ("en", 1, "y", right), ("en", 2, "x y", a)], "lang string, size int, phrase string, f long")
    assert C.scored(counts).first().score == 10**6 * a * a // (left * right)


def test_collocations_of_empty_tables(spark):
    assert C.collocations(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).count() == 0


# ---------------------------------------------------------------- hard negatives


def plain_negatives(table):
    good = {(i, y, tuple(math.floor(256 * float(x)) for x in v)) for i, y, v in table if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, y, v in good:
        if i % 100 == 0:
            scored = sorted((-dot(v, w), j, z, w) for j, z, w in good)
            for s, j, *_ in [x for x in scored if x[2] == y and x[1] != i][:5]:
                found = [x for x in scored if x[2] != y and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
                out += [(i, j, k, n, -s, -t) for k, (t, n, *_) in enumerate(found, 1)]
    return sorted(out)


KIND = "vec_id long, label int, embedding array<float>, uid int"


def test_negatives_match_plain_search(spark, monkeypatch):
    monkeypatch.setattr(N, "GROUP_BYTES", 4096)  # many groups of queries and rows
    rng = np.random.default_rng(5)
    table = [(i, int(rng.integers(0, 3)) if i % 3 else 1, [float(x) for x in np.float32(rng.normal(0, 0.2, 5))]) for i in range(700)]
    table += [(i, 2, [0.5, 0.25, 0.0, 0.0, 0.0]) for i in range(1000, 1040)]  # ties
    table += [table[100]] * 30 + [(7, 1, table[8][2]), (200, 0, [0.1])]  # repeats, shared ids, a short vector
    table += [(None, 1, [1.0]), (900, None, [1.0]), (901, 1, None), (902, 1, [None, 1.0]), (903, 1, [float("nan")]), (904, 1, [float("inf")]), (905, 1, []), (300, 0, [0.0] * 5)]
    df = spark.createDataFrame([(*r, 1) for r in table], KIND)
    assert sorted(map(tuple, N.hard_negatives(df).collect())) == plain_negatives(table)
    assert N.hard_negatives(df.limit(0)).count() == 0


def test_negatives_of_large_components(spark):
    table = [(100, 1, [3000.0, -2.0]), (1, 1, [2000.0, 9e5]), (2, 2, [1500.0, -7e4]), (3, 2, [1200.0, 3.0]), (4, 3, [1e30, 0.0])]
    df = spark.createDataFrame([(*r, 1) for r in table], KIND)
    assert sorted(map(tuple, N.hard_negatives(df).collect())) == plain_negatives(table[:-1])  # the last could leave 64 bits


def test_intervals_hold_exact_scores(spark):
    import pyarrow as pa

    rng = np.random.default_rng(1)
    v = rng.integers(-300, 300, (400, 7))
    df = spark.createDataFrame([(i, i % 3, bytes(r.astype(np.int64).tobytes())) for i, r in enumerate(v)], "id long, label long, v binary")
    books = N.code_books(df, 7, sample=100)
    group = N.Bounded(pa.Table.from_pandas(N.indexed(df, 7, books).toPandas()), 7, books)
    near, error = group.intervals(v[:50])
    assert (np.abs(near - v[:50] @ group.v.T) <= error).all()
    assert np.median(error) < np.abs(near).max()  # and say something


# ---------------------------------------------------------------- quality classifier


def test_interactions_equal_all_pairs():
    rng = np.random.default_rng(2)
    x = Q.Rows(np.array([0, 3, 4, 9]), rng.integers(0, 50, 9), rng.normal(size=9))
    m = Q.Machine(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    plain = []
    for i in range(3):
        at = range(x.start[i], x.start[i + 1])
        pairs = sum(float(m.vector[x.feature[a]] @ m.vector[x.feature[b]]) * x.value[a] * x.value[b] for a, b in combinations(at, 2))
        plain.append(0.3 + sum(m.weight[x.feature[a]] * x.value[a] for a in at) + pairs)
    assert np.allclose(m.parts(x)[0], plain)


def test_features_are_those_of_each_text_alone():
    texts = ["", "One two TWO two!", "a | b | c\na | b | c\n", "Ünd so weiter 12 a1", "x" * 70_000]
    utf = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(b) for b in utf])])
    listed = np.arange(5.0) * 100
    whole = Q.sparse(np.frombuffer(b"".join(utf), np.uint8), off, listed)
    for i, b in enumerate(utf):
        own = Q.sparse(np.frombuffer(b, np.uint8), np.array([0, len(b)]), listed[i : i + 1])
        part = whole.take(np.array([i]))
        assert sorted(zip(own.feature, own.value.round(9), strict=True)) == sorted(zip(part.feature, part.value.round(9), strict=True))
    assert len(whole.take(np.array([1])).feature) == 2 + len(Q.STATISTICS)  # one, two


def test_held_out_quality(spark):
    sf = SF.replace("0.001", "0.01")
    out = QUERIES["op11_quality_classifier"](spark, sf).toPandas()
    labels = pd.read_parquet(f"{sf}/labels.parquet")
    assert len(out) == 1000 and out.score.between(0, 1).all() and ((out.score >= 0.3) == out.predicted).all()
    held = out[out.held_out].merge(labels, on="doc_id")
    assert len(held) > 50 and (held.predicted == held.quality).mean() > 0.9
    assert (held[held.quality == 1].predicted == 1).all()


def test_quality_of_odd_tables(spark):
    kind = "doc_id long, text string, n_chars long, score int, k string"
    odd = spark.createDataFrame([(1, None, None, 1, "a"), (2, "", 5, 1, "a"), (None, "Fine words here.", 3, 1, "a"), (3, "same", -1, 1, "b"), (3, "same", -1, 1, "b"), (4, "w" * 300_000, 1, 1, "c")], kind)
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 0), (4, None), (None, 1)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0), labels.where("quality = 1")):
        out = Q.score(odd, Q.train(odd, marks)).toPandas()
        assert len(out) == 6 and out.score.between(0, 1).all()
        assert out[out.doc_id == 3].score.nunique() == 1
    assert Q.score(odd.limit(0), Q.train(odd.limit(0), labels)).count() == 0
    assert Q.score(odd.drop("n_chars"), Q.train(odd.drop("n_chars"), labels)).count() == 6
