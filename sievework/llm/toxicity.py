"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon of words and stems is learned from one part of a bounded sample of labelled rows, the trees from
the second and the calibration from the third. Every text then gets its densities of lexicon words and
stems, their nearness to second-person words, and its rates of capitals, punctuation and obfuscation, in one
map-only pass; trees and calibration are Spark ML models and run in the JVM.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import groups, offsets, task, utf8, written

# Spark ML is for the driver alone: Python workers import this module for the features, and would keep what Spark ML imports.
if TYPE_CHECKING:
    from pyspark.ml.classification import GBTClassificationModel
    from pyspark.ml.regression import IsotonicRegressionModel

#: Labelled rows that training takes, the first by a hash of their key; rows that it needs of each class.
TRAIN_ROWS, LEAST_OF_CLASS = 10_000, 3
#: What each class's rows are for, in turn.
PARTS = ("lexicon", "trees", "calibration", "lexicon", "trees", "lexicon", "lexicon", "trees", "lexicon", "calibration")
#: Words and stems in the lexicon, rows that an entry must stand in, and its least log-odds.
LEXICON, ENTRY_ROWS, ENTRY_ODDS = 600, 5, 2.5
#: Characters of a stem: the beginnings of words that share a root.
STEMS = (4, 5, 6)
#: Words between a lexicon word and a second-person word that count as near.
NEAR = 5

FEATURES = ("hit_rate", "hits", "stem_rate", "stem_hits", "near_rate", "near_hits", "veiled_hits", "capitals", "shouted", "exclamations", "punctuation", "obfuscated", "words")

# Second-person words of the languages met, and the letters that digits and signs stand for.
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos usted ustedes tú ti tus vosotros os".split())
VEILS = str.maketrans("013457@$!|", "oieastasil")

_WORD = re.compile(r"\w+(?:[@$!|*.'-]\w+)*")
_MIXED = re.compile(r"[^\W\d_][\d@$!|*][^\W\d_]")


class _Kind(dict):
    """Bits of a word, kept for words met before: 1 in the lexicon, 2 of its stems, 4 second person, 8 in it once unveiled, 16 obfuscated, 32 shouted."""

    def __init__(self, words: frozenset[str], stems: frozenset[str]):
        self.words, self.stems = words, stems

    def __missing__(self, word: str) -> int:
        low = word.lower()
        kind = (low in self.words) + 2 * any(low[:k] in self.stems for k in STEMS if len(low) > k) + 4 * (low in SECOND_PERSON)
        if _MIXED.search(word):
            plain = low.translate(VEILS)
            kind += 16 + 8 * (plain in self.words or re.sub(r"[\W_]", "", plain) in self.words)
        kind += 32 * (len(word) > 1 and word.isupper())
        if len(word) <= 40:
            if len(self) > 200_000:
                self.clear()
            self[word] = kind
        return kind


def features(text: str, kinds: _Kind) -> list[float]:
    """The features of one text, in the order of ``FEATURES``, but for capitals and the punctuation counts."""
    kind = np.fromiter(map(kinds.__getitem__, _WORD.findall(text)), np.uint8)
    n = max(1, len(kind))
    bad, stem, you = kind & 9 > 0, kind & 2 > 0, np.flatnonzero(kind & 4)
    near = 0
    if len(you) and (at := np.flatnonzero(bad | stem)).size:
        right = np.searchsorted(you, at)
        gap = np.minimum(np.abs(at - you[np.minimum(right, len(you) - 1)]), np.abs(at - you[np.maximum(right - 1, 0)]))
        near = int((gap <= NEAR).sum())
    h, s = int(bad.sum()), int(stem.sum())
    return [100 * h / n, np.log1p(h), 100 * s / n, np.log1p(s), 100 * near / n, np.log1p(near), np.log1p(int((kind & 8 > 0).sum())), 100 * int((kind & 32 > 0).sum()) / n, 100 * int((kind & 16 > 0).sum()) / n, np.log1p(len(kind))]


_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_MARKS = np.zeros(256, bool)
_MARKS[[i for i in range(33, 127) if not chr(i).isalnum()]] = True


def featured(docs: DataFrame, words: frozenset[str], stems: frozenset[str], text: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns of every row with its features. Map-only; the lexicon (``LEXICON`` entries at most) goes along."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = _Kind(words, stems)
        for whole in batches:
            for i, j in groups(offsets(whole.column("t"))):
                b = whole.slice(i, j - i)
                part, own_off = utf8(b.column("t"))
                size = np.maximum(1, np.diff(own_off))
                count = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[own_off])  # noqa: B023, E731
                own = np.array([features(t.as_py() or "", kinds) for t in b.column("t")], np.float64).reshape(-1, 10)
                rates = [100 * count(x) / size for x in (_UPPER[part], part == 33, _MARKS[part])]
                cols = [*own[:, :7].T, rates[0], own[:, 7], rates[1], rates[2], own[:, 8], own[:, 9]]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], *[pa.array(np.ascontiguousarray(c)) for c in cols]], names=[*b.schema.names[:-1], *FEATURES])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    return rows.mapInArrow(task(run), kinds + ", ".join(f"{f} double" for f in FEATURES)).toDF(*keep, *FEATURES)


@dataclass
class Model:
    """What training yields; ``rate`` alone where there were too few rows of a class."""

    rate: float = 0.0
    words: frozenset[str] = frozenset()
    stems: frozenset[str] = frozenset()
    trees: GBTClassificationModel | None = field(default=None)
    calibration: IsotonicRegressionModel | None = field(default=None)


def _units(rows: DataFrame) -> DataFrame:
    """unit, pos, neg: rows of either class in which a word or (with a leading space and its length) a stem stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen = (Counter(), Counter())
            for t, y in zip(b.column("t"), b.column("y").to_pylist(), strict=True):
                words = {w.lower() for w in _WORD.findall(t.as_py())}
                seen[y].update(words)
                seen[y].update({f" {w[:k]}" for w in words for k in STEMS if len(w) > k})
            units = list({*seen[0], *seen[1]})
            yield pa.RecordBatch.from_arrays([pa.array(units, pa.string()), *[pa.array([seen[y][u] for u in units], pa.int64()) for y in (1, 0)]], names=["unit", "pos", "neg"])

    return rows.select("t", "y").mapInArrow(task(run), "unit string, pos long, neg long").groupBy("unit").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def learn_lexicon(rows: DataFrame) -> tuple[frozenset[str], frozenset[str]]:
    """Words and stems that mark class 1, from rows (t, y)."""
    n = rows.agg(F.sum("y").alias("pos"), F.count("*").alias("all")).first()
    pos, neg = n.pos or 0, (n.all or 0) - (n.pos or 0)
    odds = F.log((F.col("pos") + 0.5) / (pos + 1)) - F.log((F.col("neg") + 0.5) / (neg + 1))
    best = _units(rows).where(F.col("pos") >= ENTRY_ROWS).withColumn("odds", odds).where(F.col("odds") >= ENTRY_ODDS)
    best = best.orderBy((F.col("odds") * F.sqrt("pos")).desc(), "unit").limit(LEXICON).collect()  # LEXICON rows at most
    return frozenset(r.unit for r in best if r.unit[0] != " "), frozenset(r.unit[1:] for r in best if r.unit[0] == " ")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """A model from at most ``TRAIN_ROWS`` labelled rows of ``docs``, the first by a hash of the key.

    A label above zero is class 1, any other class 0. A key labelled twice takes the higher label; null labels,
    null keys and null texts teach nothing. The rows of either class are dealt out to lexicon, trees and
    calibration in turn, so each part has both classes if there are ``LEAST_OF_CLASS`` rows of either.
    """
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    spark = docs.sparkSession
    marks = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max((F.col(label).cast("double") > 0).cast("int")).alias("y"))
    # labels of documents that are not here take no room in the sample
    here = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"))
    marks = marks.join(here, "k", "left_semi").orderBy(F.xxhash64("k"), "k").limit(TRAIN_ROWS)
    dealt, turn = [], [0, 0]
    for k, y in marks.collect():  # TRAIN_ROWS rows at most, and so fit for a broadcast
        dealt.append((k, y, PARTS[turn[y] % len(PARTS)]))
        turn[y] += 1
    if min(turn) < LEAST_OF_CLASS:
        return Model(rate=turn[1] / max(1, sum(turn)))
    dealt = spark.createDataFrame(dealt, f"k {marks.schema['k'].dataType.simpleString()}, y int, part string")
    rows = docs.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))
    rows = written(rows.join(F.broadcast(dealt), "k"), "toxicity-sample")
    words, stems = learn_lexicon(rows.where("part = 'lexicon'"))
    data = written(featured(rows.where("part <> 'lexicon'"), words, stems, "t", ("y", "part")), "toxicity-features")
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(data).withColumn("y", F.col("y").cast("double"))
    trees = GBTClassifier(labelCol="y", maxIter=20, maxDepth=3, stepSize=0.3, seed=1, maxBins=32).fit(data.where("part = 'trees'").repartition(1))
    scored = trees.transform(data.where("part = 'calibration'")).select("y", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="y", predictionCol="score").fit(scored)
    return Model(turn[1] / sum(turn), words, stems, trees, calibration)


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with score (0 to 1) and predicted (1 if score >= 0.5).

    Every whole text is read. Null and empty texts are scored by their features, which are zeros; null keys,
    repeated rows, ties and extra columns are left as they are; an empty table gives an empty result; a model
    without trees gives its sample's rate of class 1. Map-only: no shuffle.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    if model.trees is None:
        out = docs.select(*keep, F.lit(float(model.rate)).alias("score"))
    else:
        names = tuple(f"_{i}" for i in range(len(keep)))
        rows = featured(docs, model.words, model.stems, text, keep).toDF(*names, *FEATURES)
        rows = model.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows))
        rows = model.calibration.transform(rows.withColumn("p", vector_to_array("probability")[1]))
        out = rows.select(*[F.col(a).alias(b) for a, b in zip(names, keep, strict=True)], F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score"))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
