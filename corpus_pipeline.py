"""Corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's input.

1. toxicity: documents that the fitted classifier rejects go.
2. n-gram Jaccard join: one document of each group of copies and near copies stays.
3. suffix-array dedup: passages that an earlier document has are cut out of the later ones.
4. mixing: documents stand in the order of the target weights; sources that end early are read again.
5. sentencepiece: every text as identifiers, verified; part and row give the order of the mix.

In every stage a null text counts as empty, repeated rows and ties follow the operators' docstrings, extra columns are
not read and an empty table gives an empty one. Rows with a null doc_id are kept by stages 1 to 3, unless toxic.

The stages share their executors, whose heap is full after the first of them, so texts go to Python workers in batches of
``BATCH_BYTES`` instead of 10,000 rows of any length. The session keeps that setting; one that it has already stays.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievework.llm import mixing, pieces, repeats, similarity, toxicity
from sievework.llm.common import held_out, table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bytes of an Arrow batch between the JVM and Python; both hold several for each task.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def small_batches(stage: Stage) -> Stage:
    """The stage, with batches bounded by their bytes."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if spark.conf.get(BATCH_SETTING, None) is None:
            spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
        return stage(spark, docs, sf_dir)

    return bounded


@small_batches
def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below 0.5, unchanged; the classifier learns from labelled rows that are not held out."""
    model = toxicity.train(docs.where(~held_out()), table(spark, sf_dir, "labels").where(~held_out()))
    return toxicity.score(docs, model, keep=COLUMNS).where(F.col("predicted") == 0).select(*COLUMNS)


@small_batches
def stage_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least doc_id of each group of exact and near copies, unchanged; of equal rows one stays."""
    return similarity.one_of_each(docs.select(*COLUMNS))


@small_batches
def stage_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes that a 50-byte string of an earlier document covers; n_chars counts what is left.

    Bytes of a character that is cut through are left out, as a text must be valid UTF-8. A null text stays null, with null n_chars.
    """
    out = repeats.remove_repeats(docs, keep=("lang", "source"), with_text=True)
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source").withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


@small_batches
def stage_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as it has a place in the mix, in its order: by the number of the written file and the row in it."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


@small_batches
def stage_sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Identifiers of every text, verified, with the position that the mix gave it: part, row."""
    import public_tokenizers

    placed = mixing.with_position(docs.select(*COLUMNS))
    return pieces.encode(placed, public_tokenizers.path("piece_bpe_32k.model"), keep=("doc_id", "lang", "source", "part", "row"))


STAGES = [
    ("toxicity", stage_toxicity),
    ("n-gram Jaccard join", stage_near_copies),
    ("suffix-array dedup", stage_repeats),
    ("mixing sources to target weights", stage_mixing),
    ("SentencePiece encoding and decoding", stage_sentencepiece),
]

#: A fitted classifier, suffix arrays and a tokenizer are beyond SQL; tests/llm/test_pipeline.py holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over a table's documents; each but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
