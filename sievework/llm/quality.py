"""Quality rules with adaptive thresholds from mergeable quantile sketches per language and source.

Each text's measures go into relative-error sketches: a count per logarithmic bucket, which merges by adding,
gives the same result in any order, and needs no more rows than buckets. Thresholds are fences around each
group's own quartiles, moved out while the group's tail goes on without a gap; a group too small for them
takes its language's merged sketch, or that of all rows. The thresholds are joined back and filter the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, mixed, prefix_hash, rolling, span_hash, task, utf8, written

#: Base rule: a text needs so many words, and at most so many per cent of them in repeated windows of so many.
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 20, 30, 8
#: Relative error of the sketches; the least value told from zero.
ERROR, LEAST = 0.01, 1e-6
#: Rows a group's own sketch must hold; else its language's is taken, else that of all rows.
MIN_ROWS = 200
#: A fence lies so many times the distance from median to quartile beyond the median; that distance is a bucket's width at the least.
FENCE = 8.0
#: A high fence's distance doubles while that takes in at least one of so many rows beyond it, so many times at most.
GAP, STEPS = 8, 8

#: measure -> (expression, least distance of the high fence, whether low values fail too). A group whose quartiles are all zero has no spread: one event in MIN_WORDS words.
MEASURES: dict[str, tuple[str, float, bool]] = {
    "word_length": ("word_chars / n_words", 0.0, True),
    "symbols_per_word": ("n_symbols / n_words", 1 / MIN_WORDS, False),
    "dup_lines_per_word": ("n_dup_lines / n_words", 1 / MIN_WORDS, False),
    "repeat_share": ("n_repeat_words / n_words", 1 / MIN_WORDS, False),
}

# White space between words, and the symbols that count.
_WHITE, _SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"


def _set(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


def base_counts(data: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text; data and off as from ``utf8``."""
    n = len(off) - 1
    before = lambda flags: np.concatenate([[0], np.cumsum(flags)])[off]
    word = ~_set(_WHITE)[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    shifted = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (~shifted | edge[:-1]))
    ends = np.flatnonzero(word & (~np.concatenate([word[1:], [False]]) | edge[1:])) + 1
    first = np.searchsorted(starts, off)
    counts = {"n_words": np.diff(first), "word_chars": np.diff(before(word & ((data & 0xC0) != 0x80))), "n_symbols": np.diff(before(_set(_SYMBOLS)[data]))}
    h, _ = prefix_hash(data)

    def repeated(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether a value stands in its text twice or more, whether it does so earlier)."""
        key = values ^ mixed(owner.astype(np.uint64) + np.uint64(1))
        order = np.argsort(key, kind="stable")
        same = np.zeros(len(key) + 1, bool)
        same[1:-1] = key[order][1:] == key[order][:-1]
        twice, earlier = np.zeros(len(key), bool), np.zeros(len(key), bool)
        twice[order], earlier[order] = same[:-1] | same[1:], same[:-1]
        return twice, earlier

    # lines with a word
    cut = np.zeros(len(data) + 1, bool)
    cut[off] = True
    newline = np.flatnonzero(data == 10)
    line_from = np.unique(np.concatenate([off[:-1], newline + 1]))
    line_from = line_from[line_from < len(data)]
    line_to = np.minimum(np.concatenate([line_from[1:], [len(data)]]), len(data)) if len(line_from) else line_from
    owner = np.searchsorted(off, line_from, side="right") - 1
    line_to = np.where((line_to > line_from) & (data[np.maximum(line_to - 1, 0)] == 10), line_to - 1, line_to) if len(line_from) else line_to
    has_word = np.searchsorted(starts, line_from) < np.searchsorted(starts, line_to)
    line_from, line_to, owner = line_from[has_word], line_to[has_word], owner[has_word]
    _, earlier = repeated(span_hash(h, line_from, line_to), owner)
    counts["n_dup_lines"] = np.bincount(owner[earlier], minlength=n)

    # windows of words
    of_word = np.repeat(np.arange(n), counts["n_words"])
    grams = rolling(span_hash(h, starts, ends), WINDOW)
    inside = of_word[: len(grams)] == of_word[WINDOW - 1 :] if len(grams) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    twice, _ = repeated(grams[at], of_word[at])
    cover = np.zeros(len(of_word) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + WINDOW, -1)
    counts["n_repeat_words"] = np.bincount(of_word[np.cumsum(cover[:-1]) > 0], minlength=n)
    return counts


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measure(docs: DataFrame, text: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` columns of every row with the base counts. Map-only."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            data, off = utf8(whole.column("t"))
            for i, j in groups(off):
                counts = base_counts(data[off[i] : off[j]], off[i : j + 1] - off[i])
                yield pa.RecordBatch.from_arrays([*whole.slice(i, j - i).columns[:-1], *[pa.array(counts[c].astype(np.int64)) for c in COUNTS]], names=[*whole.schema.names[:-1], *COUNTS])

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    return rows.mapInArrow(task(run), kinds + ", ".join(f"{c} long" for c in COUNTS)).toDF(*keep, *COUNTS)


_GAMMA = (1 + ERROR) / (1 - ERROR)


def bucket(value: Column) -> Column:
    """Sketch bucket of a value of 0 or more; null is that of zero."""
    return F.when(value >= LEAST, F.ceil(F.log(value) / math.log(_GAMMA)).cast("int"))


def bucket_value(b: Column) -> Column:
    """Middle of a bucket, within ``ERROR`` of all its values."""
    return F.coalesce(2 * F.pow(F.lit(_GAMMA), b) / (_GAMMA + 1), F.lit(0.0))


def sketch(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, measure, b, n: rows in each bucket. Sketches of parts merge by adding n."""
    measures = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.expr(e)).alias("b")) for m, (e, _, _) in MEASURES.items()])).alias("m")
    return rows.select(*by, measures).groupBy(*by, "m.measure", "m.b").agg(F.count("*").alias("n"))


def merge(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*by, "measure", "b").agg(F.sum("n").alias("n"))


def _with_quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """The sketches' rows with their group's rows, q1, q2 and q3. A group has as many rows here as its sketch has buckets, whatever the data's size."""
    w = Window.partitionBy(*by, "measure")
    ranked = sketches.withColumn("rows", F.sum("n").over(w)).withColumn("upto", F.sum("n").over(w.orderBy(F.col("b").asc_nulls_first())))
    # the first bucket that reaches the rank holds the quantile
    q = lambda p: F.min(F.when(F.col("upto") >= F.ceil(F.col("rows") * p), bucket_value(F.col("b")))).over(w)
    return ranked.withColumns({name: q(p) for name, p in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))})


def quartiles(sketches: DataFrame, by: list[str]) -> DataFrame:
    """by, measure, rows, q1, q2, q3."""
    return _with_quartiles(sketches, by).groupBy(*by, "measure").agg(*[F.max(c).alias(c) for c in ("rows", "q1", "q2", "q3")])


def fences(sketches: DataFrame, by: list[str]) -> DataFrame:
    """by, measure, rows, low, high. A tail that thins out step by step belongs to the group; rows beyond a gap do not."""
    least = reduce(lambda w, m: w.when(F.col("measure") == m, F.lit(MEASURES[m][1])), MEASURES, F)
    width = 2 * ERROR * F.col("q2")
    rows = _with_quartiles(sketches, by).withColumns({"down": FENCE * F.greatest(width, F.col("q2") - F.col("q1")), "up": F.greatest(least, FENCE * F.greatest(width, F.col("q3") - F.col("q2")))})
    beyond = [F.sum(F.when(bucket_value(F.col("b")) > F.col("q2") + F.col("up") * 2**k, F.col("n")).otherwise(0)).alias(f"_{k}") for k in range(STEPS + 1)]
    found = rows.groupBy(*by, "measure").agg(*[F.max(c).alias(c) for c in ("rows", "q2", "down", "up")], *beyond)
    step = F.coalesce(*[F.when(GAP * (F.col(f"_{k}") - F.col(f"_{k + 1}")) < F.col(f"_{k}"), F.lit(2.0**k)) for k in range(STEPS)], F.lit(2.0**STEPS))
    return found.select(*by, "measure", "rows", F.greatest(F.lit(0.0), F.col("q2") - F.col("down")).alias("low"), (F.col("q2") + F.col("up") * step).alias("high"))


def thresholds(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source and, for each measure, its low and high fence."""
    fine = sketch(rows, [lang, source])
    by_lang, over_all = merge(fine, [lang]), merge(fine, [])
    packed = lambda sketches, by, name: fences(sketches, by).select(*by, "measure", F.struct("rows", "low", "high").alias(name))
    a, b, c = packed(fine, [lang, source], "own"), packed(by_lang, [lang], "mid"), packed(over_all, [], "top")
    b, c = b.withColumnRenamed(lang, "_l").withColumnRenamed("measure", "_m"), c.withColumnRenamed("measure", "_n")
    both = a.join(b, F.col(lang).eqNullSafe(F.col("_l")) & (F.col("measure") == F.col("_m")), "left").join(c, F.col("measure") == F.col("_n"), "left")
    chosen = F.when(F.col("own.rows") >= MIN_ROWS, F.col("own")).when(F.col("mid.rows") >= MIN_ROWS, F.col("mid")).otherwise(F.col("top"))
    both = both.select(lang, source, "measure", chosen.alias("f"))
    pick = lambda m, side: F.max(F.when(F.col("measure") == m, F.col(f"f.{side}"))).alias(f"{m}_{side}")
    return both.groupBy(lang, source).agg(*[pick(m, side) for m in MEASURES for side in ("low", "high")])


def apply_rules(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", min_words: int = MIN_WORDS) -> DataFrame:
    """Every row's key and base counts, with base_failed, failed (names of the adaptive rules it breaks) and kept.

    base_failed: too few words, or too large a share of them in repeated windows. kept: neither that nor any
    adaptive rule. Thresholds come from all rows that pass the base rules. A null language or source is a
    group of its own; a null or empty text has no words and fails; a null key, repeated rows and ties are
    measured and kept like any row; extra columns are not read; an empty table gives an empty result.
    """
    renamed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(source).alias("source"))
    # the counts of all texts, some 60 bytes a row, are written once and read by the sketches and by the filter
    rows = written(measure(renamed, "text", ("key", "lang", "source")), "quality").withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    fences = thresholds(rows.where(~F.col("base_failed"))).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(fences, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    broken = []
    for m, (expression, _, low) in MEASURES.items():
        value = F.expr(expression)
        bad = value > F.col(f"{m}_high")
        if low:
            bad |= value < F.col(f"{m}_low")
        broken.append(F.when(~F.col("base_failed") & bad, F.lit(m)))
    failed = F.array_compact(F.array(*broken))
    return joined.select(F.col("key").alias(key), *COUNTS, "base_failed", failed.alias("failed"), (~F.col("base_failed") & (F.size(failed) == 0)).alias("kept"))
