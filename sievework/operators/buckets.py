"""A keyed store in buckets: tables of parts, of which a batch reads and rewrites those that it touches, and no others.

A part is a folder, by a hash of the key; within it, files are bucketed by the key, so that a join on the key needs no
exchange of what is stored. Parts are overwritten as a whole when the write is committed; the rest stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievework.operators import store

#: Parts of a table and buckets of a part. A part is what a batch rewrites at the least, a bucket what a task joins.
PARTS, BUCKETS = 256, 16


class Table:
    """A table in buckets by ``key``, in a folder of its own. Where the session's catalog doesn't know it, it is registered from the folder."""

    def __init__(self, spark: SparkSession, name: str, path: str, key: str, schema: T.StructType, parts: int = PARTS, buckets: int = BUCKETS):
        self.spark, self.name, self.key, self.parts, self.buckets = spark, name, key, parts, buckets
        self.columns = [f.name for f in schema]
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            spark.sql(f"create table {name} ({columns}, _part int) using parquet partitioned by (_part) clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{path}'")
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            if folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
                spark.sql(f"msck repair table {name}")

    def part(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.parts)).cast("int")

    def touched(self, batch: DataFrame) -> list[int]:
        """The parts that a batch's keys lie in; ``parts`` numbers at the most."""
        return sorted(r[0] for r in batch.where(F.col(self.key).isNotNull()).select(self.part().alias("p")).distinct().collect())

    def read(self, parts: list[int] | None = None) -> DataFrame:
        rows = self.spark.table(self.name)
        return (rows if parts is None else rows.where(F.col("_part").isin(parts))).select(*self.columns)

    def dealt(self, batch: DataFrame) -> DataFrame:
        """A batch in the buckets of the table, so that a join exchanges the batch alone."""
        return batch.repartition(self.buckets, self.key)

    def overwrite(self, rows: DataFrame) -> None:
        """Puts rows in the place of all that their parts have held."""
        conf = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(conf)
        self.spark.conf.set(conf, "dynamic")
        try:
            rows.select(*self.columns, self.part().alias("_part")).write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set(conf, before)


def merged(table: Table, source: DataFrame, order: str, at: Column, keep: list[str], overwrite: list[str]) -> tuple[list[int], DataFrame]:
    """(touched parts, what ``store.upsert`` makes of these parts and a batch); the stored rows are not exchanged."""
    parts = table.touched(source)
    last = table.dealt(source.where(F.col(table.key).isNotNull()))
    return parts, store.upsert(table.read(parts), last, table.key, order, at, keep, overwrite)


def upsert(table: Table, source: DataFrame, order: str, at: Column, keep: list[str], overwrite: list[str]) -> list[int]:
    """A batch into a stored table (key, ``keep``, ``overwrite``, first_seen, last_seen, state), as ``store.upsert`` has it; gives the parts that were rewritten. An empty batch rewrites none."""
    parts, rows = merged(table, source, order, at, keep, overwrite)
    if parts:
        table.overwrite(rows)
    return parts


def add_versions(facts: Table, versions: Table, batch: DataFrame, content: str, fields: list[str], at: str) -> list[int]:
    """Sightings into stored versions: facts and versions of the touched parts are made anew, all others stay.

    Equal to ``store.full_versions`` over all sightings, in whatever order batches come: facts merge in any order, and a
    late one renumbers its own key's versions. Facts are a row for each content of a key, not for each sighting, so a
    batch that repeats what is known costs no more than the parts that it touches. If the second write is lost, the next
    batch that touches the part, or this one again, mends it.
    """
    key = facts.key
    parts = facts.touched(batch)
    if parts:
        came = store.version_facts(batch.where(F.col(key).isNotNull()), key, content, fields, at)
        facts.overwrite(store.merged_facts(facts.read(parts).unionByName(came.select(*facts.columns)), key, content, fields))
        versions.overwrite(store.versions_of(facts.read(parts), key, content, fields))
    return parts
