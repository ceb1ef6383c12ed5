"""Helpers shared by the training-data operators: Arrow text access, byte hashing, shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that the numpy kernels take at once, so that their arrays stay in the processor's cache.
KERNEL_BYTES = 1 << 19
#: Bytes of text in a slice that one task takes, at about the most.
SLICE_BYTES = 64 << 20

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without a Python object a row; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


def offsets(column: pa.Array) -> np.ndarray:
    """Offsets of a string column's texts, as ``utf8`` gives them, without a copy of the texts."""
    return np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(), dtype=np.int64)])


def groups(offsets: np.ndarray, size: int = KERNEL_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1)
        yield i, j
        i = j


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values, so that every bit depends on every other."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(symbols: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of the k symbols from each position on, by doubling."""
    if len(symbols) < k:
        return np.zeros(0, np.uint64)
    cur, have = mixed(symbols.astype(np.uint64) + np.uint64(_ODD)), 1
    out, done, rest = None, 0, k
    while rest:
        if rest & 1:
            if out is None:
                out, done = cur, have
            else:
                n = min(len(out), len(cur) - done)
                out = out[:n] * np.uint64(pow(_ODD, have, 1 << 64)) + cur[done : done + n]
                done += have
        rest >>= 1
        if rest:
            cur = cur[:-have] * np.uint64(pow(_ODD, have, 1 << 64)) + cur[have:]
            have *= 2
    return mixed(out[: len(symbols) - k + 1])


def powers(n: int) -> np.ndarray:
    """_ODD ** 0 .. _ODD ** n as wrapping 64-bit values."""
    out = np.full(n + 1, _ODD, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(H, inverse powers' base table): H[i] sums byte j times _ODD ** j over j < i, for any span's hash by ``span_hash``."""
    p = powers(len(data))
    h = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * p[:-1], out=h[1:])
    return h, p


_INVERSE = pow(_ODD, -1, 1 << 64)


def span_hash(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """64-bit hash of data[lo:hi] for arrays of spans; equal bytes have equal hashes wherever they stand."""
    if not len(lo):
        return np.zeros(0, np.uint64)
    inv = np.full(int(lo.max()) + 2, _INVERSE, np.uint64)
    inv[0] = 1
    inv = np.multiply.accumulate(inv)
    return mixed((h[hi] - h[lo]) * inv[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def signed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's bigint."""
    return h.view(np.int64) if h.dtype == np.uint64 else h.astype(np.uint64).view(np.int64)


def held_out(doc_id: str = "doc_id"):
    """True for the fifth of the documents that training never sees."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def shared_path(spark: SparkSession, what: str) -> str:
    """A new path in the folder that driver and executors share. Only where all run on one machine, as in tests, may none be set: then it lies in the warehouse's folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._conf.get("spark.checkpoint.dir")
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir')}/sievework-shared"
    return f"{root.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def slices_of(rows: DataFrame, text: str) -> int:
    """Slices to deal texts out to, so that a slice holds about ``SLICE_BYTES`` of them, however many there are."""
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table in the shared folder, read again: later jobs neither redo its work nor lose it with an executor."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow, after which the worker gives its free memory back: Spark uses workers again, one stage after the other."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import ctypes
        import gc

        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return wrapped


def runs(flags: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of flagged bytes; no run goes over a text's border."""
    edge = np.zeros(len(flags) + 1, bool)
    edge[off] = True
    starts = flags & (~np.concatenate([[False], flags[:-1]]) | edge[:-1])
    ends = flags & (~np.concatenate([flags[1:], [False]]) | edge[1:])
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1
