"""Quality classifier: a factorisation machine over hashed words, statistics of structure and metadata.

A text's features are its words, hashed, each with a weight by how often it stands there; the bins that its statistics
of structure fall into; and bins of its metadata. The machine gives every pair of features an interaction, the product of
two short vectors. The sum of all pairs is half the square of the sum minus the sum of the squares, so a text is scored
in time linear in its features. Training is by AdaGrad over a bounded sample of labelled rows, in one task; scoring is
map-only.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, mixed, prefix_hash, runs, span_hash, task, utf8, written
from .quality import base_counts

#: Labelled rows that training takes, the first by a hash of their key; the more frequent class takes this share of them, or what the other leaves.
TRAIN_ROWS, SHARE_OF_CLASS = 12_000, 0.75
#: Slots of hashed words; length of a feature's vector.
WORD_SLOTS, RANK = 1 << 16, 8
#: Bins of a statistic.
BINS = 32
#: Rounds over the sample, rows of a step, rate, and shrinking of weights.
EPOCHS, BATCH, RATE, DECAY = 12, 64, 0.05, 1e-5
#: A text is class 1 from this score on.
THRESHOLD = 0.3

#: Statistics of structure, all rates of whole texts, and of metadata.
STATISTICS = ("words", "word_length", "symbols", "capitals", "shouted_words", "exclamations", "bars", "digits", "marks", "beyond_ascii", "line_length", "repeated_lines", "repeated_words", "distinct_words", "short_words", "blanks", "mixed_words", "listed_chars")
#: What the words and the statistics weigh against each other: their values' squares sum to these.
WORD_MASS, STATISTIC_MASS = 1.0, 4.0

_WORD = np.array([48 <= i < 58 or 65 <= i < 91 or 97 <= i < 123 or i >= 128 for i in range(256)])
_UPPER, _DIGIT, _HIGH = (np.array([f(i) for i in range(256)]) for f in (lambda i: 65 <= i < 91, lambda i: 48 <= i < 58, lambda i: i >= 128))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.array([33 <= i < 127 and not chr(i).isalnum() for i in range(256)])

DIM = WORD_SLOTS + len(STATISTICS) * BINS


@dataclass
class Rows:
    """Sparse rows: features and values of row i stand at start[i] .. start[i + 1]."""

    start: np.ndarray
    feature: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.start) - 1

    def take(self, rows: np.ndarray) -> Rows:
        size = np.diff(self.start)[rows]
        start = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.start[rows] - start[:-1], size) + np.arange(start[-1])
        return Rows(start, self.feature[at], self.value[at])


def _bin(rate: np.ndarray) -> np.ndarray:
    """Bins of rates of zero or more: zero alone, then half powers of two from 2 ** -10 on."""
    return np.where(rate > 0, np.clip(np.floor(2 * np.log2(np.maximum(rate, 1e-9)) + 21), 1, BINS - 1), 0).astype(np.int64)


def sparse(data: np.ndarray, off: np.ndarray, listed: np.ndarray) -> Rows:
    """The features of texts (as from ``utf8``) and their listed lengths (0 where there is none)."""
    n = len(off) - 1
    total = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[off])
    counts, chars = base_counts(data, off), np.maximum(1, total((data & 0xC0) != 0x80))
    starts, ends = runs(_WORD[data], off)
    owner, low = np.searchsorted(off, starts, side="right") - 1, _LOWER[data]
    prefix, _ = prefix_hash(low)
    slot = (span_hash(prefix, starts, ends) >> np.uint64(64 - WORD_SLOTS.bit_length() + 1)).astype(np.int64)
    key, times = np.unique(owner * WORD_SLOTS + slot, return_counts=True)
    of, slot = key // WORD_SLOTS, key % WORD_SLOTS
    weight = 1 + np.log(times)
    weight *= np.sqrt(WORD_MASS / np.maximum(1e-12, np.bincount(of, weight**2, n)))[of]
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    size = ends - starts
    by_word = lambda flags: np.bincount(owner[flags], minlength=n)
    shouted, digits = (upper[ends] - upper[starts] == size) & (size > 1), np.concatenate([[0], np.cumsum(_DIGIT[data])])
    with_digit = digits[ends] - digits[starts]
    words, tokens = np.maximum(1, counts["n_words"]), np.maximum(1, np.bincount(owner, minlength=n))
    rate = {
        "words": counts["n_words"] / 64,
        "word_length": counts["word_chars"] / words,
        "symbols": counts["n_symbols"] / words,
        "capitals": total(_UPPER[data]) / chars,
        "shouted_words": by_word(shouted) / tokens,
        "exclamations": total(data == 33) / words,
        "bars": total(data == 124) / words,
        "digits": total(_DIGIT[data]) / chars,
        "marks": total(_MARK[data]) / words,
        "beyond_ascii": total(_HIGH[data]) / chars,
        "line_length": chars / (1 + total(data == 10)) / 64,
        "repeated_lines": counts["n_dup_lines"] / words,
        "repeated_words": counts["n_repeat_words"] / words,
        "distinct_words": np.bincount(of, minlength=n) / tokens,
        "short_words": by_word(size <= 2) / tokens,
        "blanks": total(data == 32) / chars,
        "mixed_words": by_word((with_digit > 0) & (with_digit < size)) / tokens,
        "listed_chars": listed / 64,
    }
    bins = np.stack([_bin(rate[s]) for s in STATISTICS], 1) + WORD_SLOTS + BINS * np.arange(len(STATISTICS))
    where = np.concatenate([of, np.repeat(np.arange(n), len(STATISTICS))])
    order = np.argsort(where, kind="stable")
    value = np.concatenate([weight, np.full(bins.size, np.sqrt(STATISTIC_MASS / len(STATISTICS)))])
    return Rows(np.concatenate([[0], np.cumsum(np.bincount(where, minlength=n))]), np.concatenate([slot, bins.ravel()])[order], value[order])


@dataclass
class Machine:
    """bias, a weight a feature and a vector a feature; DIM * (RANK + 1) numbers."""

    bias: float
    weight: np.ndarray
    vector: np.ndarray

    def parts(self, x: Rows) -> tuple[np.ndarray, np.ndarray]:
        """(the rows' margins, their sums of vectors)."""
        v = self.vector[x.feature] * x.value[:, None]
        sums, squares, plain = (np.add.reduceat(a, x.start[:-1], axis=0) for a in (v, v * v, self.weight[x.feature] * x.value))
        return self.bias + plain + 0.5 * (sums**2 - squares).sum(1), sums

    def probability(self, x: Rows) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.parts(x)[0], -35, 35)))


def fit(x: Rows, y: np.ndarray, seed: int = 1) -> Machine:
    """A machine from rows and their classes, by AdaGrad on the logarithmic loss. Every row has features, as statistics always do."""
    rng = np.random.default_rng(seed)
    at = np.clip(y.mean(), 1 / (len(y) + 2), 1 - 1 / (len(y) + 2))
    m = Machine(float(np.log(at / (1 - at))), np.zeros(DIM), rng.normal(0, 0.05, (DIM, RANK)))
    seen, seen_w, seen_v = 1e-6, np.full(DIM, 1e-6), np.full((DIM, RANK), 1e-6)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for i in range(0, len(y), BATCH):
            rows = order[i : i + BATCH]
            part = x.take(rows)
            margin, sums = m.parts(part)
            slope = 1 / (1 + np.exp(-np.clip(margin, -35, 35))) - y[rows]
            each = np.repeat(slope, np.diff(part.start)) * part.value
            f, own = np.unique(part.feature, return_inverse=True)
            gw = np.bincount(own, each, len(f)) / len(rows) + DECAY * m.weight[f]
            inner = np.repeat(sums, np.diff(part.start), axis=0) - m.vector[part.feature] * part.value[:, None]
            gv = np.stack([np.bincount(own, each * inner[:, k], len(f)) for k in range(RANK)], 1) / len(rows) + DECAY * m.vector[f]
            g = slope.mean()
            seen += g * g
            seen_w[f] += gw**2
            seen_v[f] += gv**2
            m.bias -= RATE * g / np.sqrt(seen)
            m.weight[f] -= RATE * gw / np.sqrt(seen_w[f])
            m.vector[f] -= RATE * gv / np.sqrt(seen_v[f])
    return m


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", chars: str = "n_chars", sample: int = TRAIN_ROWS) -> Machine:
    """A machine from at most ``sample`` labelled rows of ``docs``, those of either class first by a hash of the key.

    A label above zero is class 1, any other class 0; a key labelled twice takes the higher label; null labels, keys
    and texts teach nothing. The more frequent class takes
    SHARE_OF_CLASS of the sample, or what the other leaves; the bias is set back to the classes' shares of all labelled rows. Without a row, every score is a half.
    """
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max((F.col(label).cast("double") > 0).cast("int")).alias("y"))
    marks = marks.join(docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k")), "k", "left_semi")
    marks = written(marks, "quality-marks")
    share = {r.y: r["count"] for r in marks.groupBy("y").count().collect()}
    more, fewer = sorted((0, 1), key=lambda y: -share.get(y, 0))
    some = share.get(fewer, 0)
    room = {more: min(share.get(more, 0), sample - min(some, int(sample * (1 - SHARE_OF_CLASS))))}
    room[fewer] = min(some, sample - room[more])
    first = [marks.where(F.col("y") == y).orderBy(F.xxhash64("k"), "k").limit(n) for y, n in room.items() if n]
    if not first:
        return Machine(0.0, np.zeros(DIM), np.zeros((DIM, RANK)))
    dealt = first[0] if len(first) == 1 else first[0].unionByName(first[1])
    # ``sample`` rows at most, and so fit for a broadcast
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"), _listed(docs, chars).alias("c")).join(F.broadcast(dealt), "k")

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8(b.column("t"))
            for i, j in groups(off):
                x = sparse(data[off[i] : off[j]], off[i : j + 1] - off[i], b.column("c").to_numpy()[i:j])
                lists = [pa.LargeListArray.from_arrays(pa.array(x.start), pa.array(a)).cast(pa.list_(pa.from_numpy_dtype(a.dtype))) for a in (x.feature, x.value)]
                yield pa.RecordBatch.from_arrays([b.column("k")[i:j], b.column("y")[i:j], *lists], names=["k", "y", "feature", "value"])

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if whole := [b for b in batches if b.num_rows]:
            t = pa.Table.from_batches(whole)
            t = t.take(pa.array(np.argsort(t.column("k").to_numpy(), kind="stable")))
            lists = t.column("feature").combine_chunks(), t.column("value").combine_chunks()
            start = np.concatenate([[0], np.cumsum(lists[0].value_lengths().to_numpy())]).astype(np.int64)
            x, y = Rows(start, lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy()), t.column("y").to_numpy().astype(float)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(x, y))], pa.binary())], names=["machine"])

    kind = docs.schema[key].dataType.simpleString()
    data = rows.select("k", "y", "t", "c").mapInArrow(task(gather), f"k {kind}, y int, feature array<long>, value array<double>")
    made = data.repartition(1).mapInArrow(task(learn), "machine binary").collect()  # one row of DIM * (RANK + 1) numbers
    m = pickle.loads(made[0].machine)
    if some:
        odds = lambda d: np.log(d[1] / d[0])
        m.bias += float(odds(share) - odds(room))
    return m


def _listed(docs: DataFrame, chars: str):
    return F.greatest(F.lit(0.0), F.coalesce(F.col(chars).cast("double"), F.lit(0.0))) if chars in docs.columns else F.lit(0.0)


def score(docs: DataFrame, model: Machine, text: str = "text", chars: str = "n_chars", keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns of every row with score (0 to 1) and predicted (1 if score >= ``threshold``).

    Every whole text is read; metadata is the listed number of characters, 0 where it is null or no such column is there.
    Null and empty texts are scored by their statistics alone; null keys, repeated rows, ties and extra columns are left
    as they are; an empty table gives an empty result. Map-only: no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # DIM * (RANK + 1) numbers
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"), _listed(docs, chars).alias("c"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, off = utf8(b.column("t"))
            for i, j in groups(off):
                x = sparse(data[off[i] : off[j]], off[i : j + 1] - off[i], b.column("c").to_numpy()[i:j])
                yield pa.RecordBatch.from_arrays([*b.slice(i, j - i).columns[:-2], pa.array(shared.value.probability(x))], names=[*b.schema.names[:-2], "score"])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    return rows.mapInArrow(task(run), kinds + "score double").toDF(*keep, "score").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
