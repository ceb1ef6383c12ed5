"""Hard-negative mining: product quantisation with stored residual norms, rigorous bounds, exact integer rerank.

Vectors become integers. Codebooks for pairs of components are learned from a bounded sample; every row is coded with
them and keeps the norm of what the code leaves out. For a query, tables of its inner products with all code words
give each row's score but for the query's norm times that residual at most (Cauchy-Schwarz), so rows whose whole
interval lies outside what is asked, or below enough others, can't be in the result. The rest are scored exactly.

Queries and rows are dealt out in groups of a bounded size, and every group of queries meets every group of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import task, written

#: Integer components are floor(SCALE * x).
SCALE = 256
#: Components of a subspace, code words of its book, rows that the books are learned from, rounds of learning.
SUB, WORDS, SAMPLE_ROWS, ROUNDS = 2, 256, 8192, 8
#: Bytes of vectors in a group of rows or queries that one task holds.
GROUP_BYTES = 16 << 20
#: Every so many-th id is an anchor; positives of an anchor, negatives of a pair; the window of scores in per cent of the positive's.
EVERY, POSITIVES, NEGATIVES, LOW, HIGH = 100, 5, 10, 30, 90
#: Scores are computed for so many queries at once; rows of a query that are scored exactly before the rest is looked at.
QUERY_BLOCK, PROBE = 32, 64


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of packed 64-bit components."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def prepared(vectors: DataFrame, key: str, vector: str, label: str) -> tuple[DataFrame, int]:
    """((id, label, v) of the rows that take part, each once, with v as packed 64-bit integers; their number of components)."""
    # a null fails the comparison too, and so does what is not a number or infinite
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    sound = F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    rows = vectors.where(sound).select(F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), x.alias("x"))
    dim = max(1, rows.agg(F.max(F.size("x"))).first()[0] or 1)
    most = float(np.floor(np.sqrt((2**63 - 1) / dim)) - 1)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, sizes = b.column("x"), b.column("x").value_lengths().to_numpy()
            padded = np.zeros((len(sizes), dim))
            padded[np.arange(dim) < sizes[:, None]] = x.flatten().to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                scaled = np.floor(SCALE * padded)
            fits = (np.abs(scaled) <= most).all(axis=1)
            whole = np.where(fits[:, None], scaled, 0).astype(np.int64)
            packed = pa.array([r.tobytes() for r in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("label"), packed], names=["id", "label", "v"]).filter(pa.array(fits))

    return rows.mapInArrow(task(pack), "id long, label long, v binary").distinct(), dim


def code_books(rows: DataFrame, dim: int, sample: int = SAMPLE_ROWS) -> np.ndarray:
    """(subspaces, WORDS, SUB) code words, by k-means in each subspace over the first ``sample`` rows by a hash; the last subspace is filled up with zeros."""
    taken = rows.orderBy(F.xxhash64("v"), "v").limit(sample).select("v").toPandas()["v"]  # SAMPLE_ROWS rows at most
    pad = -dim % SUB
    x = np.frombuffer(b"".join(taken), np.int64).reshape(-1, dim).astype(np.float64) if len(taken) else np.zeros((1, dim))
    x = np.pad(x, ((0, 0), (0, pad)))
    rng, books = np.random.default_rng(1), np.zeros((x.shape[1] // SUB, WORDS, SUB))
    for m in range(len(books)):
        own = np.ascontiguousarray(x[:, m * SUB : (m + 1) * SUB])
        words = own[rng.integers(0, len(own), WORDS)]
        for _ in range(ROUNDS):
            nearest = (own @ words.T - (words**2).sum(1) / 2).argmax(1)
            n = np.bincount(nearest, minlength=WORDS)
            sums = np.stack([np.bincount(nearest, own[:, c], WORDS) for c in range(SUB)], 1)
            words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
        books[m] = words
    return books


def _padded(v: np.ndarray, books: np.ndarray) -> np.ndarray:
    return np.pad(v.astype(np.float64), ((0, 0), (0, len(books) * SUB - v.shape[1]))).reshape(len(v), len(books), SUB)


def indexed(rows: DataFrame, dim: int, books: np.ndarray) -> DataFrame:
    """uid, id, label, v, code, rest: every row with its code words and the norm of what they leave out; uid tells rows apart."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half = (books**2).sum(2) / 2
        for b in batches:
            v = _padded(_integers(b.column("v"), dim), books)
            code = np.empty((len(v), len(books)), np.uint8)
            rest = np.zeros(len(v))
            for m in range(len(books)):
                code[:, m] = (v[:, m] @ books[m].T - half[m]).argmax(1)
                rest += ((v[:, m] - books[m][code[:, m]]) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in code], pa.binary()), pa.array(np.sqrt(rest))], names=[*b.schema.names, "code", "rest"])

    coded = rows.mapInArrow(task(encode), "id long, label long, v binary, code binary, rest double")
    return written(coded.withColumn("uid", F.monotonically_increasing_id()), "negatives-index")


class Bounded:
    """A group of rows, ready to give intervals of scores and exact scores."""

    def __init__(self, rows: pa.Table, dim: int, books: np.ndarray):
        self.id, self.label, self.uid = (rows.column(c).to_numpy() for c in ("id", "label", "uid"))
        self.v, self.books = _integers(rows.column("v"), dim), books
        self.code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(self.id), len(books))
        self.rest = rows.column("rest").to_numpy()
        self.norm = np.sqrt((self.v.astype(np.float64) ** 2).sum(1))
        # sums of products that stay below 2 ** 53 are exact as doubles too
        self.doubles = self.v.astype(np.float64) if not len(self.v) or float(np.abs(self.v).max()) ** 2 * dim < 2**52 else None

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(estimates, their greatest errors), a row a query and a column a row."""
        q = _padded(queries, self.books)
        near = np.zeros((len(q), len(self.id)))
        for m in range(len(self.books)):
            near += (q[:, m] @ self.books[m].T)[:, self.code[:, m]]
        size = np.sqrt((q**2).sum((1, 2)))[:, None]
        # besides the residual, what rounding of doubles may add
        return near, size * (self.rest[None, :] + 1e-9 * (self.norm + self.rest)[None, :]) + 1e-6

    def exact(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        if self.doubles is not None and float(np.abs(query).max(initial=0)) * float(np.abs(self.v).max(initial=0)) * len(query) < 2**52:
            return (self.doubles[at] @ query.astype(np.float64)).astype(np.int64)
        return (self.v[at] * query).sum(1)


def _greatest(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:n]


def best_within(rows: Bounded, queries: np.ndarray, able: np.ndarray, low: list, high: list, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(query, window, rows, scores) of each query's ``n`` first rows within each of its windows of scores, among those that ``able`` allows.

    low, high: a list of windows a query; None where there is no bound.
    """
    for i in range(0, len(queries), QUERY_BLOCK):
        near, error = rows.intervals(queries[i : i + QUERY_BLOCK])
        least, most = near - error, near + error
        for k in range(len(near)):
            for w, (lo, hi) in enumerate(zip(low[i + k], high[i + k], strict=True)):
                ok, sure = able[i + k].copy(), able[i + k].copy()
                if hi is not None:
                    ok &= (least[k] <= hi) & (most[k] >= lo)
                    sure &= (most[k] <= hi) & (least[k] >= lo)
                if (held := np.flatnonzero(sure)).size >= n:
                    ok &= most[k] >= np.partition(least[k][held], len(held) - n)[len(held) - n]
                at = np.flatnonzero(ok)
                if len(at) > PROBE:
                    # exact scores of the likeliest ones raise the bar that the others' intervals must reach
                    likely = near[k][at] if hi is None else np.where(near[k][at] <= hi, near[k][at], -np.inf)
                    probe = rows.exact(queries[i + k], at[np.argpartition(-likely, PROBE)[:PROBE]])
                    if hi is not None:
                        probe = probe[(probe >= lo) & (probe <= hi)]
                    if len(probe) >= n:
                        at = at[most[k][at] >= np.partition(probe, len(probe) - n)[len(probe) - n]]
                score = rows.exact(queries[i + k], at)
                if hi is not None:
                    inside = (score >= lo) & (score <= hi)
                    at, score = at[inside], score[inside]
                first = _greatest(score, rows.id[at], n)
                yield i + k, w, at[first], score[first]


def _groups(n: int, dim: int, spark) -> int:
    """Groups to deal ``n`` rows out to: so many that one holds GROUP_BYTES at about the most, and that all tasks have work."""
    return max(1, -(-n * dim * 8 // GROUP_BYTES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 256)))


def search(queries: DataFrame, index: DataFrame, dim: int, books: np.ndarray, n: int, same: bool) -> DataFrame:
    """query, window, uid, id, score: each query's first ``n`` rows of its own label (``same``), or of another label within its windows.

    queries: uid, id, label, v, and windows as array<struct<window:long, low:long, high:long>> where not ``same``. Groups
    of queries and rows meet by a join on their numbers, so memory is bounded by GROUP_BYTES; each gives its exact first
    rows, and these are ranked.
    """
    spark = index.sparkSession
    queries = queries.toDF(*queries.columns)  # columns of their own, as these rows come from the index too
    n_queries, n_rows = queries.count(), index.count()
    q_groups, r_groups = -(-max(1, n_queries) * dim * 8 // GROUP_BYTES), _groups(n_rows, dim, spark)
    dealt = lambda df, groups, own, others, other: df.withColumn(own, F.pmod(F.xxhash64("uid", F.lit(own)), F.lit(groups)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1)))).groupBy("qg", "rg")
    left = dealt(queries, q_groups, "qg", r_groups, "rg")
    right = dealt(index, r_groups, "rg", q_groups, "qg")

    def meet(asked: pa.Table, there: pa.Table) -> pa.Table:
        out: dict[str, list] = {c: [] for c in ("query", "window", "uid", "id", "score")}
        if asked.num_rows and there.num_rows:
            rows, v, ids, labels = Bounded(there, dim, books), _integers(asked.column("v"), dim), asked.column("id").to_numpy(), asked.column("label").to_numpy()
            windows = [[(None, None, None)]] * len(v) if same else [[(w["window"], w["low"], w["high"]) for w in ws] for ws in asked.column("windows").to_pylist()]
            uid = asked.column("uid").to_numpy()
            for i in range(0, len(v), QUERY_BLOCK):
                part = slice(i, i + QUERY_BLOCK)
                able = (rows.label == labels[part, None]) & (rows.id != ids[part, None]) if same else rows.label != labels[part, None]
                for k, w, at, score in best_within(rows, v[part], able, [[x[1] for x in ws] for ws in windows[part]], [[x[2] for x in ws] for ws in windows[part]], n):
                    out["query"].append(np.full(len(at), uid[i + k]))
                    out["window"].append(np.full(len(at), windows[i + k][w][0] or 0))
                    for c, values in (("uid", rows.uid[at]), ("id", rows.id[at]), ("score", score)):
                        out[c].append(values)
        return pa.table({c: pa.array(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)) for c, x in out.items()})

    found = left.cogroup(right).applyInArrow(meet, "query long, window long, uid long, id long, score long")
    order = Window.partitionBy("query", "window").orderBy(F.col("score").desc(), "id", "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", is_anchor: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, sample: int = SAMPLE_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor (``is_anchor`` over the column id; every EVERY-th id) its first ``positives`` rows of the same label,
    and for each of these its first ``negatives`` rows of other labels whose score lies within ``low`` and ``high`` per
    cent of the positive's. Scores are exact inner products of integers; higher ones come first, ties by smaller ids.

    Rows with a null id, label or vector, or with a null or non-finite component take no part, nor does one whose
    integer components are so large that a score could leave 64 bits. Shorter vectors are filled up with zeros. A row
    that repeats in all of these counts once; rows that share an id but differ are rows of their own, and no positive of
    each other. Other columns aren't read; an empty table, and an anchor without a positive or a negative, give no rows.
    Several jobs run when this is called.
    """
    rows, dim = prepared(vectors, key, vector, label)
    rows = written(rows, "negatives-vectors")
    books = code_books(rows, dim, sample)
    index = indexed(rows, dim, books)
    anchors = index.where(F.col("id") % EVERY == 0 if is_anchor is None else is_anchor).select("uid", "id", "label", "v")
    pairs = written(search(anchors, index, dim, books, positives, True).select("query", F.col("uid").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "negatives-positives")
    # low * p <= 100 * s <= high * p, rounded inwards in whole numbers of arbitrary size
    down = lambda percent: F.expr(f"cast(floor({percent}BD * cast(positive_score as decimal(19,0)) / 100BD) as long)")
    up = lambda percent: F.expr(f"cast(ceil({percent}BD * cast(positive_score as decimal(19,0)) / 100BD) as long)")
    windows = pairs.select("query", F.struct(F.col("positive").alias("window"), up(low).alias("low"), down(high).alias("high")).alias("w")).where("w.low <= w.high")
    windows = windows.groupBy("query").agg(F.collect_list("w").alias("windows"))  # ``positives`` entries at most
    asked = anchors.join(windows, anchors.uid == windows.query).select("uid", "id", "label", "v", "windows")
    found = search(asked, index, dim, books, negatives, False)
    names = anchors.select(F.col("uid").alias("query"), F.col("id").alias("anchor_id"))
    out = found.join(pairs.withColumnRenamed("positive", "window"), ["query", "window"]).join(names, "query")
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
