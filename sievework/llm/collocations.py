"""Phrase collocation mining: merged count-min sketches, an exact second pass over what they let through, scores, subsumption.

First pass: every task counts the hashes of all words and phrases of its texts in a sketch of two rows of cells and
gives its cells away in blocks; blocks merge by adding. Counts stop at the least power of two beyond the wanted
frequency, which changes no decision. A cell counts whatever falls into it, so a sketch never counts too few and no
frequent phrase is lost. Second pass: the phrases that the sketch, and that of their parts, lets through are counted
exactly, by their words and not by a hash. Scores and subsumption are joins over the frequent phrases alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import groups, mixed, prefix_hash, runs, span_hash, task, utf8, written

#: Words of the longest phrase; occurrences that a candidate needs; phrases kept of each language.
LONGEST, LEAST, FIRST = 3, 10, 2000
#: A phrase goes if a longer candidate around it has at least so many per cent of its occurrences.
SUBSUMED_PERCENT = 50
#: Rows of a sketch; bytes of text for which a row has a cell; least and most bits of a row's cell numbers. The most
#: bounds the memory of a task (2 bytes a cell and row) and what each task reads in the second pass (a bit a cell and row).
ROWS, BYTES_A_CELL, CELL_BITS = 2, 24, (16, 26)
#: Cells of a block, the unit that sketches are merged by.
BLOCK = 1 << 16
#: Parts of a language whose phrases are ranked apart before their first ones meet.
RANK_PARTS = 32
#: Bytes of text whose words are numbered at once; hashes that go into 16-bit cells between two cuts.
CHUNK_BYTES, STEP = 4 << 20, 60_000

# What ends a piece, and what parts words within it.
_CUTS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.zeros(256, np.uint8)
_KIND[list(_BLANKS)], _KIND[list(_CUTS)] = 1, 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP_HASH = np.uint64(0x9E3779B97F4A7C15)


class Chunk:
    """The words of some texts of one language: numbers, the vocabulary, and whether a word and the next stand in one piece."""

    def __init__(self, data: np.ndarray, off: np.ndarray, lang: str):
        kind = _KIND[data]
        word = kind == 0
        starts, ends = runs(word, off)
        letters, sizes = _LOWER[data][word], np.concatenate([[0], np.cumsum(ends - starts)])
        words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(sizes.astype(np.int64)), pa.py_buffer(letters))
        coded = words.dictionary_encode()
        self.ids, self.vocabulary = coded.indices.to_numpy().astype(np.int64), coded.dictionary
        cuts, text = np.cumsum(kind == 2), np.searchsorted(off, starts, side="right")
        self.joined = (cuts[starts[1:]] == cuts[starts[:-1]]) & (text[1:] == text[:-1]) if len(starts) else np.zeros(0, bool)
        self.salt = np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))

    def hashes(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, hashes) of the phrases of 1, 2, .. words."""
        own, own_off = utf8(self.vocabulary)
        prefix, _ = prefix_hash(own)
        word = span_hash(prefix, own_off[:-1], own_off[1:])[self.ids] if len(self.ids) else np.zeros(0, np.uint64)
        at, h = np.arange(len(self.ids)), mixed(word + self.salt)
        for size in range(1, longest + 1):
            if size > 1:
                more = at + size - 1 < len(self.ids)
                more[more] = self.joined[at[more] + size - 2]
                at, h = at[more], h[more]
                h = mixed(h * _STEP_HASH + word[at + size - 1])
            yield at, h


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Chunk]]:
    """(language, chunk) over batches of (lang, text)."""
    for b in batches:
        lang = b.column("lang").dictionary_encode()
        codes = lang.indices.to_numpy()
        order = np.argsort(codes, kind="stable")
        cut = np.flatnonzero(np.diff(codes[order])) + 1
        for rows in np.split(order, cut):
            if len(rows):
                name = lang.dictionary[int(codes[rows[0]])].as_py()
                data, off = utf8(b.column("text").take(pa.array(rows)))
                for i, j in groups(off, CHUNK_BYTES):
                    yield name, Chunk(data[off[i] : off[j]], off[i : j + 1] - off[i], name)


def _cell(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    return ((h >> np.uint64(32 * row)) & np.uint64((1 << bits) - 1)).astype(np.int64)


def _planes(least: int) -> int:
    return least.bit_length()


def sketch(texts: DataFrame, bits: int, least: int, longest: int) -> DataFrame:
    """block, bits: which cells of the merged sketch hold ``least`` or more, from rows (lang, text)."""
    planes, per_row = _planes(least), max(1, (1 << bits) // BLOCK)
    cap, width = (1 << planes) - 1, min(BLOCK, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((ROWS, 1 << bits), np.uint16)
        for _, chunk in chunks(batches):
            for _, h in chunk.hashes(longest):
                for row in range(ROWS):
                    at, own = _cell(h, row, bits), cells[row]
                    for i in range(0, len(at), STEP):
                        part = at[i : i + STEP]
                        np.add.at(own, part, np.uint16(1))
                        own[part] = np.minimum(own[part], np.uint16(cap))
        for b in range(ROWS * per_row):
            own = cells[b // per_row, b % per_row * width :][:width]
            if own.any():
                packed = b"".join(np.packbits((own >> k & 1).astype(np.uint8)).tobytes() for k in range(planes))
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([packed], pa.binary())], names=["block", "planes"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], names=["block", "bits"])
        for batch in batches:
            for block, packed in zip(batch.column("block").to_pylist(), batch.column("planes"), strict=True):
                if block != at:
                    if at is not None:
                        yield done()
                    at, total = block, np.zeros(width, np.uint16)
                flags = np.unpackbits(np.frombuffer(packed.as_buffer(), np.uint8)).reshape(planes, width)
                for k in range(planes):
                    total += flags[k].astype(np.uint16) << np.uint16(k)
                np.minimum(total, cap, out=total)
        if at is not None:
            yield done()

    parts = min(ROWS * per_row, max(1, int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    counted = texts.mapInArrow(task(count), "block int, planes binary")
    return counted.repartition(parts, "block").sortWithinPartitions("block").mapInArrow(task(merge), "block int, bits binary")


def frequent(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """lang, size, phrase, f: exact counts of all words and phrases with f >= ``least``, and a row of size 0 with all words' count for each language.

    Two passes over the texts. The merged sketch is a bit a cell and row, 16 MB at the most whatever the data's size.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(CELL_BITS[1], max(CELL_BITS[0], (size // BYTES_A_CELL).bit_length() - 1))
    flags = np.zeros((ROWS, (1 << bits) // 8), np.uint8)
    per_row, width = max(1, (1 << bits) // BLOCK), min(BLOCK, 1 << bits) // 8
    for r in sketch(texts, bits, least, longest).collect():  # ROWS * 2 ** bits / 8 bytes, bounded by CELL_BITS
        flags[r.block // per_row, r.block % per_row * width :][:width] = np.frombuffer(r.bits, np.uint8)
    shared = spark.sparkContext.broadcast(flags)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value

        def let_through(h: np.ndarray) -> np.ndarray:
            out = np.ones(len(h), bool)
            for row in range(ROWS):
                c = _cell(h, row, bits)
                out &= known[row][c >> 3] >> (7 - (c & 7)).astype(np.uint8) & 1 > 0
            return out

        def rows(name: str, size: int, phrase: pa.Array, f: np.ndarray) -> pa.RecordBatch:
            n = len(f)
            return pa.RecordBatch.from_arrays([pa.array([name] * n, pa.string()), pa.array(np.full(n, size, np.int32)), phrase.cast(pa.string()), pa.array(f.astype(np.int64))], names=["lang", "size", "phrase", "f"])

        for name, chunk in chunks(batches):
            yield rows(name, 0, pa.array([""]), np.array([len(chunk.ids)]))
            # number[i]: of the phrase of the size at hand that begins at word i, exact within the chunk; -1 where none is let through
            number, phrases = chunk.ids, chunk.vocabulary
            for size, (at, h) in enumerate(chunk.hashes(longest), 1):
                at = at[let_through(h)]
                if size > 1:
                    at = at[(number[at] >= 0) & (number[at + 1] >= 0)]  # of the phrases one word shorter
                key = number[at] << 32 | chunk.ids[at + size - 1] if size > 1 else number[at]
                found, own, f = np.unique(key, return_inverse=True, return_counts=True)
                if size > 1:
                    phrases = pc.binary_join_element_wise(phrases.take(pa.array(found >> 32)), chunk.vocabulary.take(pa.array(found & 0xFFFFFFFF)), pa.scalar(" ", pa.large_string()))
                else:
                    phrases = phrases.take(pa.array(found))
                number = np.full(len(chunk.ids) + 1, -1, np.int64)
                number[at] = own
                if len(found):
                    yield rows(name, size, phrases, f)

    counted = texts.mapInArrow(task(count), "lang string, size int, phrase string, f long").groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))
    return written(counted.where((F.col("size") == 0) | (F.col("f") >= least)), "phrases")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, score of every phrase of two words or more in ``frequent``'s counts, by its lowest-scoring cut.

    The score is floor(10**6 * a * a / (l * r)) by decimals of 38 digits, exact for counts below 10**15.
    """
    words, part = F.split("phrase", " "), lambda a, n: F.array_join(F.slice(F.col("w"), a, n), " ")
    whole = counts.where(F.col("size") > 1).select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"))
    cuts = whole.select("lang", "phrase", "size", "a", "w", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "size", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    known = counts.where(F.col("size") > 0)
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(known.select("lang", F.col("phrase").alias(side), F.col("f").alias(name)), ["lang", side])
    score = F.expr("(cast(1000000 as decimal(7,0)) * cast(a as decimal(15,0)) * cast(a as decimal(15,0))) div (cast(l as decimal(15,0)) * cast(r as decimal(15,0)))")
    best = cuts.groupBy("lang", "phrase", "size", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "phrase", "size", "a", "cut.l", "cut.r", "cut.score")


def unsubsumed(phrases: DataFrame, percent: int = SUBSUMED_PERCENT) -> DataFrame:
    """The phrases (lang, phrase, size, a, ..) that stand in no longer one with ``percent`` of their occurrences or more."""
    words = F.split("phrase", " ")
    spans = lambda size: F.sequence(F.lit(1), F.col("size") - size + 1)
    inner = F.transform(F.sequence(F.lit(2), F.col("size") - 1), lambda m: F.transform(spans(m), lambda i: F.array_join(F.slice(words, i, m), " ")))
    around = phrases.where(F.col("size") > 2).select("lang", F.explode(F.array_distinct(F.flatten(inner))).alias("phrase"), F.col("a").alias("_f"))
    around = around.groupBy("lang", "phrase").agg(F.max("_f").alias("_around"))
    return phrases.join(around, ["lang", "phrase"], "left").where(F.col("_around").isNull() | (100 * F.col("_around") < percent * F.col("a"))).drop("_around")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` phrases of each language by score, then frequency, then bytes.

    Texts are lower-cased (A-Z), cut into pieces at marks and line ends, and pieces into words at blanks and tabs;
    phrases stand within a piece. A null language is `und`, together with rows that say so; a null or empty text has
    no words; repeated rows count as often as they stand there; ties go to the smaller phrase in byte order; other
    columns aren't read; an empty table, or one without a frequent phrase, gives an empty result. Whole texts are
    read. Two jobs run when this is called.
    """
    counts = frequent(docs, text, lang, least, longest)
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    ranked = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= first)
    # a language's first ones are among the first of its parts, so no task ranks what all others have passed on
    parts = unsubsumed(scored(counts)).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    best = ranked(ranked(parts, "lang", "part"), "lang")
    n = counts.where(F.col("size") == 0).select("lang", F.col("f").alias("n"))
    return best.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
