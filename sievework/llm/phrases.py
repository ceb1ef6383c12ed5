"""Document fingerprints by locally consistent parsing.

Deterministic coin tossing cuts a text into phrases at places that depend on a few neighbouring symbols only,
names each phrase by its content, and parses the names again, level upon level. Equal substrings so get equal
names inside, wherever they stand. A fingerprint holds, for each of three levels, a sketch of the phrase
names; the share of equal components estimates how much two texts have in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mixed, powers, slices_of, task

#: Components of each level's sketch, lowest level first; phrases that a level needs in both texts to be compared.
COMPONENTS, LEAST_PHRASES = (32, 32, 64), 12
#: Characters that the kernels take at once.
CHARS = 1 << 17

_RNG = np.random.Generator(np.random.PCG64(20240229))
_FACTORS = [_RNG.integers(1, 1 << 63, k, np.uint64) * np.uint64(2) + np.uint64(1) for k in COMPONENTS]


def _toss_table() -> np.ndarray:
    """New label of a symbol below 128 by (symbol, the one before it): twice the lowest bit in which they differ, plus that bit."""
    a, b = np.meshgrid(np.arange(128, dtype=np.uint8), np.arange(128, dtype=np.uint8), indexing="ij")
    d = a ^ b
    k = np.bitwise_count((d & (~d + np.uint8(1))) - np.uint8(1))
    return np.where(d == 0, a & 1, 2 * k + ((a >> (k & 7)) & 1)).astype(np.uint8).ravel()


_TOSS = _toss_table()


def toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels below 6, unequal for neighbours of one text (given that their names are), each by four names back at most. first: starts of texts."""
    d = names.copy()
    d[1:] ^= names[:-1]
    k = np.bitwise_count((d & (~d + np.uint64(1))) - np.uint64(1))
    label = (2 * k + ((names >> (k.astype(np.uint64) & np.uint64(63))) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    label[first] = (names[first] & np.uint64(1)).astype(np.uint8)
    label &= 127
    for _ in range(3):
        key = label.astype(np.int16) << 7
        key[1:] |= label[:-1]
        new = _TOSS[key]
        new[first] = label[first] & 1
        label = new
    return label


def starts(off: np.ndarray) -> np.ndarray:
    """First positions of the texts that have any."""
    return off[:-1][np.diff(off) > 0]


def cut(names: np.ndarray, off: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names of the parts, offsets by text) where parts begin at the positions ``at``, which hold every text's start."""
    if not len(at):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    size = np.diff(np.concatenate([at, [len(names)]]))
    place = np.arange(len(names)) - np.repeat(at, size)
    h = np.add.reduceat(mixed(names) * powers(int(size.max()))[place], at)
    return mixed(h + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), np.searchsorted(at, off)


def parse(names: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: runs of equal names become one, then phrases begin where labels peak."""
    edge = np.zeros(len(names) + 1, bool)
    edge[off] = True
    new = edge[:-1].copy()
    new[1:] |= names[1:] != names[:-1]
    names, off = cut(names, off, np.flatnonzero(new))
    if not len(names):
        return names, off
    edge = np.zeros(len(names) + 1, bool)
    edge[off] = True
    label = toss(names, starts(off)).astype(np.int8)
    left, right = np.empty_like(label), np.empty_like(label)
    left[0], left[1:], right[-1], right[:-1] = -1, label[:-1], -1, label[1:]
    peak = (label > left) & (label >= right)
    # a text's last symbol begins no phrase, nor does its second
    peak[edge[1:]] = False
    peak[1:] &= ~edge[:-2]
    peak |= edge[:-1]
    return cut(names, off, np.flatnonzero(peak))


def sketch(names: np.ndarray, off: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """16-bit MinHash components of each text's set of names by (text, component); zero without names."""
    out = np.zeros((len(off) - 1, len(factors)), np.uint16)
    at, full = starts(off), np.diff(off) > 0
    if len(at):
        for i, f in enumerate(factors):
            out[full, i] = mixed(np.minimum.reduceat(names * f, at)) & np.uint64(0xFFFF)
    return out


def fingerprints(texts: list[str]) -> list[str]:
    """Hexadecimal fingerprint of each text: for each level, the number of phrases (255 at most) and its sketch."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    parts = []
    for factors in _FACTORS:
        points, off = parse(points, off)
        parts.append(np.minimum(np.diff(off), 255).astype(np.uint8)[:, None])
        parts.append(sketch(points, off, factors).astype(">u2").view(np.uint8).reshape(len(texts), -1))
    return [row.tobytes().hex() for row in np.ascontiguousarray(np.hstack(parts))]


def likeness(a: str, b: str) -> float:
    """Share of equal components, 0 to 1, on the highest level where both texts have enough phrases, else on the lowest; two empty texts are alike."""
    x, y = bytes.fromhex(a), bytes.fromhex(b)
    at, chosen = 0, (0, COMPONENTS[0])
    for k in COMPONENTS:
        if at and min(x[at], y[at]) >= LEAST_PHRASES:
            chosen = at, k
        at += 1 + 2 * k
    at, k = chosen
    if not x[at] or not y[at]:
        return float(x[at] == y[at])
    u, v = (np.frombuffer(z, np.uint16, k, at + 1) for z in (x, y))
    return float((u == v).mean())


def fingerprint(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with its fingerprint. Map-only; null counts as empty."""
    rows = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(text).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at, texts, size = 0, [], 0
            for i in range(whole.num_rows):
                texts.append(whole.column("t")[i].as_py() or "")
                size += len(texts[-1])
                if size > CHARS or i == whole.num_rows - 1:
                    b = whole.slice(at, len(texts))
                    yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(fingerprints(texts))], names=[*b.schema.names[:-1], "fingerprint"])
                    at, texts, size = i + 1, [], 0

    kinds = "".join(f"k{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(keep))
    return rows.mapInArrow(task(run), kinds + "fingerprint string").toDF(*keep, "fingerprint")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much, or all, of the following text's beginning."""
    k = len(text) // 2
    return text[: len(text) - k] + following[:k]


class Cuts:
    """Borders of slices of rows in the order of (key, hash of the text): a key that several quantiles hit is cut by the hash."""

    def __init__(self, quantiles: list[int]):
        keys, times = np.unique(np.array(quantiles, np.int64), return_counts=True)
        self.keys = np.repeat(keys, times)
        self.hashes = np.array([-(1 << 63) + j * ((1 << 64) // n) for n in times.tolist() for j in range(n)], np.int64)

    def slice_of(self, keys: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        lo, hi = np.searchsorted(self.keys, keys, side="left"), np.searchsorted(self.keys, keys, side="right")
        out = hi.copy()
        for i in np.flatnonzero(hi - lo > 1):
            out[i] = lo[i] + np.searchsorted(self.hashes[lo[i] : hi[i]], hashes[i], side="right")
        return out.astype(np.int32)


def with_next(docs: DataFrame, key: str, text: str, slices: int) -> DataFrame:
    """bucket, tail, k, h, z: rows in slices of the order of key and text's hash, their texts packed; each slice ends with the first row of the next one (tail), the last with the first of all.

    The driver sees one quantile and one least key for each slice.
    """
    rows = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).alias("t"))
    least = -(1 << 63)
    ordered = F.coalesce("k", F.lit(least))
    found = rows.agg(F.percentile_approx(ordered, [i / slices for i in range(1, slices)], max(10_000, 10 * slices)).alias("q")).first().q if slices > 1 else None
    cuts = Cuts(found or [])

    def placed(b: pa.RecordBatch) -> np.ndarray:
        keys = pc.fill_null(b.column("k"), least).to_numpy(zero_copy_only=False)
        return cuts.slice_of(keys, b.column("h").to_numpy(zero_copy_only=False))

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(placed(b)), pc.fill_null(b.column("k"), least), b.column("h")], names=["bucket", "k", "h"])

    lowest = rows.select("k", "h").mapInArrow(task(sliced), "bucket int, k long, h long").groupBy("bucket").agg(F.min(F.struct("k", "h")).alias("low"))
    firsts = {r.bucket: (r.low.k, r.low.h) for r in lowest.collect()}  # a row a slice
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=1).compress
        kinds = (pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
        for b in batches:
            at, keys, hashes = placed(b).tolist(), b.column("k").to_pylist(), b.column("h").to_pylist()
            texts = [pack(t.as_buffer() if t.is_valid else b"") for t in b.column("t")]
            own = list(zip(at, [False] * len(at), keys, hashes, texts, strict=True))
            own += [(before[i], True, k, h, z) for i, _, k, h, z in own if (least if k is None else k, h) == firsts[i]]
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*own, strict=True) if own else [[]] * 5, kinds, strict=True)], names=["bucket", "tail", "k", "h", "z"])

    return rows.mapInArrow(task(packed), "bucket int, tail boolean, k long, h long, z binary")


def compare_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", slices: int | None = None) -> DataFrame:
    """Every row's key with n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The next row follows in the order of the key, nulls first (as the least long); the last row's next is the
    first. Rows with one key follow each other in an order that a hash of their texts fixes, so that they may fill
    several slices. A null text counts as empty; extra columns are not read; an empty table gives an empty result.
    Texts move once, packed, into slices of the key's order. Jobs that find the slices run when this is called.
    """
    slices = slices or slices_of(docs, text)
    kind = docs.schema[key].dataType.simpleString()
    rows = with_next(docs.withColumn(key, F.col(key).cast("long")), key, text, slices)
    rows = rows.repartition(slices, "bucket").sortWithinPartitions("bucket", "tail", "k", "h", "z")
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def finished(keys: list, texts: list[str], following: list[str]) -> pa.RecordBatch:
            changed = list(map(edited, texts, following))
            own = fingerprints([*texts, following[-1]])
            other = fingerprints(changed)
            cols = [pa.array(keys, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]), pa.array(own[:-1]), pa.array(other)]
            cols += [pa.array([likeness(a, b) for a, b in zip(own[:-1], right, strict=True)], pa.float64()) for right in (other, own[1:])]
            return pa.RecordBatch.from_arrays(cols, names=names)

        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        keys, texts, size, here = [], [], 0, None  # rows of one slice whose next row is still to come

        for b in batches:
            for bucket, tail, k, z in zip(b.column("bucket").to_pylist(), b.column("tail").to_pylist(), b.column("k").to_pylist(), b.column("z"), strict=True):
                t = unpack(z.as_py()).decode()
                if bucket != here:
                    here = bucket
                    keys, texts, size = [], [], 0
                elif tail and not keys:
                    continue  # a further row with the next slice's first key
                if keys and (tail or size > CHARS):
                    yield finished(keys, texts, [*texts[1:], t])
                    keys, texts, size = [], [], 0
                if not tail:
                    keys.append(k)
                    texts.append(t)
                    size += len(t)

    out = rows.mapInArrow(task(run), "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    return out.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
