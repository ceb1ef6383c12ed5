"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in a random but fixed order, are cut into blocks of so many bytes. The j-th block of
a source with an exact share w is released at floor(j / w) and due at ceil((j + 1) / w); earliest deadline
first gives every block a slot in its window, so that at any time each source is less than one block away
from its target, however long the mix is. A block is so large that a mix has a bounded number of them, so one
task makes the slots of the whole mix in constant memory, a row a block, as a table that documents are joined
with.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from itertools import islice
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import mixed, task, written

#: Bytes of a block at the least; blocks of all sources together at about the most, beyond which a block grows; exponent that tempers the sources' measured shares where no weights are given.
BLOCK_BYTES, MOST_BLOCKS, TEMPER = 1 << 16, 1 << 20, 0.9
#: A mix is no longer than so many times all sources' blocks; what a source with too little weight has left by then follows as a tail, by deadlines.
MOST_EPOCHS = 64
#: Rows of a table of sources up to which it is broadcast; such a row is a few numbers and a name.
MOST_SOURCES = 100_000
#: Rows of the schedule that are sent at once.
SCHEDULE_ROWS = 10_000
#: A deadline later than this is stated as this.
MOST_SLOTS = (1 << 63) - 1
#: Bytes of a part of a source within which documents are put in order, and parts of a source at most.
PART_BYTES, MOST_PARTS = 8 << 20, 4_096
#: Bytes of a written slice of the mix at about the most.
SLICE_BYTES = 128 << 20


def exact(weights: list[float]) -> list[int]:
    """The weights as whole numbers in the same proportion."""
    whole = [Fraction(w) for w in weights]
    over = lcm(*[w.denominator for w in whole])
    return [int(w * over) for w in whole]


def slots(parts: list[int], horizon: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(source, block, release, deadline, slot) for each slot up to the horizon, by earliest deadline first over the released blocks. A source's share is its part of sum(parts)."""
    total = sum(parts)
    served = [0] * len(parts)
    waiting, ready = [(0, i) for i in range(len(parts))], []
    heapq.heapify(waiting)
    for slot in range(horizon):
        while waiting and waiting[0][0] <= slot:
            release, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(served[i] + 1) * total // parts[i]), i, release))
        due, i, release = heapq.heappop(ready)
        if slot >= due:
            raise AssertionError("a block missed its deadline")
        yield i, served[i], release, due, slot
        served[i] += 1
        heapq.heappush(waiting, (served[i] * total // parts[i], i))


def schedule(parts: list[int]) -> list[list[int]]:
    """Slots of each source in one period of sum(parts) slots."""
    out: list[list[int]] = [[] for _ in parts]
    for i, _, _, _, slot in slots(parts, sum(parts)):
        out[i].append(slot)
    return out


@dataclass
class Plan:
    """A mix: for each source its number, exact weight, blocks of an epoch and parts; the slots in all; a block's bytes; and whether a tail follows."""

    sources: list
    weights: list[int]
    blocks: list[int]
    parts: list[int]
    horizon: int
    block_bytes: int
    tail: bool = False


def plan(docs: DataFrame, source: str = "source", text: str = "text", weights: dict | None = None, block_bytes: int | None = None, epochs: int = MOST_EPOCHS) -> Plan:
    """The mix of a table's sources. Without weights, a source's target is its share of bytes to the power ``TEMPER``.

    The mix ends when each source's target has reached its bytes, so a source whose weight is far below its
    share of the bytes makes the mix longer, and the others are read again until then: the result has total
    weight / weight times its bytes. It ends at ``epochs`` times all sources' bytes at the latest, whatever the
    weights; within it every source keeps its target, and blocks that have had no turn follow in a tail. The driver
    holds a few numbers for each source.
    """
    rows = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size_of(text)).alias("bytes")).collect()
    rows = sorted(rows, key=lambda r: (r.source is not None, str(r.source)))
    names, sizes = [r.source for r in rows], [r.bytes for r in rows]
    if not rows:
        return Plan([], [], [], [], 0, block_bytes or BLOCK_BYTES)
    block_bytes = block_bytes or max(BLOCK_BYTES, -(-sum(sizes) // MOST_BLOCKS))
    if weights is not None and (missing := [n for n in names if not weights.get(n, 0) > 0]):
        raise ValueError(f"no positive weight for {missing[:5]}")
    whole = exact([weights[n] for n in names] if weights is not None else [b**TEMPER for b in sizes])
    blocks = [-(-b // block_bytes) for b in sizes]
    parts = [max(1, min(MOST_PARTS, -(-b // PART_BYTES))) for b in sizes]
    total = sum(whole)
    needed = max(-(-b * total // (a * block_bytes)) for b, a in zip(sizes, whole, strict=True))
    most = max(1, epochs) * sum(blocks)
    return Plan(names, whole, blocks, parts, min(needed, most), block_bytes, needed > most)


def scheduled(spark: SparkSession, mix: Plan) -> DataFrame:
    """_i, _number, _release, _deadline, _slot: a row for each block of each source in the mix.

    A source whose last block of the first epoch is a short one may be due after the mix's end; that block
    stands beside another one's in a slot of its window. Where the mix ends before a source's first epoch does, its
    blocks that are left have the slots after the end, by their deadlines.
    """
    weights, blocks, horizon = mix.weights, mix.blocks, mix.horizon
    names = ["_i", "_number", "_release", "_deadline", "_slot"]

    def rows() -> Iterator[tuple[int, int, int, int, int]]:
        served, total = [0] * len(weights), sum(weights)
        for row in slots(weights, horizon):
            served[row[0]] += 1
            yield row
        late = ((-(-(j + 1) * total // weights[i]), i, j) for i, k in enumerate(served) for j in range(k, blocks[i])) if mix.tail else ()
        for n, (due, i, j) in enumerate(sorted(late)):  # as many as there are blocks at the most
            yield i, j, j * total // weights[i], due, horizon + n
        for i, j in enumerate(served):
            if j < blocks[i] and not mix.tail:
                release = j * total // weights[i]
                yield i, j, release, -(-(j + 1) * total // weights[i]), release + int(mixed(np.array([i], np.uint64))[0]) % (horizon - release)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            left = rows()
            while some := list(islice(left, SCHEDULE_ROWS)):
                yield pa.RecordBatch.from_arrays([pa.array([min(x, MOST_SLOTS) for x in c], pa.int64()) for c in zip(*some, strict=True)], names=names)

    return written(spark.range(0, 1, 1, 1).mapInArrow(task(run), ", ".join(f"{n} long" for n in names)), "mixing-schedule")


def size_of(text: str):
    """Bytes that a document counts; at least one, so that empty ones have a place too."""
    return F.greatest(F.lit(1), F.coalesce(F.octet_length(text), F.lit(0))).cast("long")


def place(docs: DataFrame, mix: Plan, key: str = "doc_id", source: str = "source", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """A row for each time that a document has a place: key, source, ``keep`` columns, n_bytes, epoch, block, release, deadline, slot, turn.

    Every document has a place in epoch 0; a source that ends before the mix does starts again, in later
    epochs. slot and turn order the whole mix. A null source is a source of its own; a null or empty text
    counts one byte; null keys and ties are ordered by a hash of key and text; repeated rows have a place
    each; other columns are not read; an empty table gives an empty result. A hot source is dealt out in
    parts; no window holds a whole source. The schedule is written to the shared folder when this is called.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), size_of(text).alias("_bytes"), F.xxhash64(key, text).alias("_turn"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(keep)])
    times = scheduled(spark, mix)
    # one row a source
    sources = spark.createDataFrame([(n, i, b, p) for i, (n, b, p) in enumerate(zip(mix.sources, mix.blocks, mix.parts, strict=True))], f"_name {docs.schema[source].dataType.simpleString()}, _i long, _n long, _parts int")
    small = F.broadcast if len(mix.sources) <= MOST_SOURCES else (lambda df: df)
    rows = own.join(small(sources), F.col("_source").eqNullSafe(F.col("_name"))).withColumn("_part", F.pmod(F.hash("_turn"), F.col("_parts")))
    before = Window.partitionBy("_i").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # MOST_PARTS rows a source at most
    starts = rows.groupBy("_i", "_part").agg(F.sum("_bytes").alias("_b")).select("_i", "_part", F.coalesce(F.sum("_b").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_i", "_part").orderBy("_turn", "_key").rowsBetween(Window.unboundedPreceding, -1)
    # the parts' starts, a few numbers each, are looked up after the window, by the same keys
    rows = rows.withColumn("_offset", F.coalesce(F.sum("_bytes").over(inside), F.lit(0))).join(F.broadcast(starts) if sum(mix.parts) <= 200_000 else starts, ["_i", "_part"])
    rows = rows.withColumn("_block", F.floor((F.col("_start") + F.col("_offset")) / mix.block_bytes).cast("long"))
    # blocks that a source has in the mix, those of the first epoch at the least
    rows = rows.join(small(times.groupBy("_i").agg(F.count("*").alias("_all"))), "_i")
    rows = rows.withColumn("_epoch", F.explode(F.sequence(F.lit(0), F.expr("cast((_all - 1 - _block) div _n as int)"))))
    # Spark knows the written schedule's size and broadcasts it only if it is small
    rows = rows.withColumn("_number", F.col("_block") + F.col("_epoch") * F.col("_n")).join(times, ["_i", "_number"])
    return rows.select(
        F.col("_key").alias(key), F.col("_source").alias(source), *[F.col(f"_c{i}").alias(c) for i, c in enumerate(keep)], F.col("_bytes").alias("n_bytes"), F.col("_epoch").alias("epoch"), F.col("_number").alias("block"),
        F.col("_release").alias("release"), F.col("_deadline").alias("deadline"), F.col("_slot").alias("slot"), F.col("_turn").alias("turn"),
    )


def mixed_documents(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", weights: dict | None = None) -> DataFrame:
    """The documents in the order of the mix, each as often as it has a place; ``with_position`` reads the order back from a written table."""
    # under names of their own, as a column may be called like one of the schedule's
    own = {c: f"_d{i}" for i, c in enumerate(docs.columns)}
    rows = docs.toDF(*own.values())
    others = tuple(n for c, n in own.items() if c not in (key, source))
    mix = plan(rows, own[source], own[text], weights)
    placed = place(rows, mix, own[key], own[source], own[text], others)
    slices = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-mix.horizon * mix.block_bytes // SLICE_BYTES))
    return placed.repartitionByRange(slices, "slot", "turn").sortWithinPartitions("slot", "turn", own[key]).select(*[F.col(n).alias(c) for c, n in own.items()])


def with_position(docs: DataFrame, part: str = "part", row: str = "row") -> DataFrame:
    """``docs`` with two columns that give its order: where it was read from Parquet, the number in the file's name and the row in the file, else the partition and the row in it.

    A written mix keeps its order by them: Spark numbers the files as the partitions, each of which is sorted.
    """
    try:
        files = docs.select("*", F.col("_metadata.file_name").alias(part), F.col("_metadata.row_index").alias(row))
    except AnalysisException:  # no Parquet scan
        at = F.monotonically_increasing_id()
        return docs.select("*", F.shiftright(at, 33).alias(part), at.bitwiseAND(F.lit((1 << 33) - 1)).alias(row))
    return files.withColumn(part, F.expr(f"try_cast(regexp_extract({part}, 'part-([0-9]+)', 1) as long)"))
