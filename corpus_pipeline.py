"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again before the next.

Every stage takes (spark, docs, sf_dir), applies one operator to all rows its predecessor kept and returns the columns of
``documents``; the last returns a row per document with its tokens. Null and empty texts pass every stage: nothing can be
said against them. Rows of one doc_id with different texts are judged by their own texts, a null doc_id is a key like others,
repeated rows are near duplicates of each other. Other columns are carried along, empty tables stay empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.bpe import encode_documents
from caseloom.llm.decontaminate import find_overlaps, remove_contaminated
from caseloom.llm.jaccard import keep_one
from caseloom.llm.registry import table
from caseloom.llm.suffix import remove_repeats
from caseloom.llm.toxicity import remove_toxic
from caseloom.session import scratch_path, shared_dir

# Bytes of a passage that is cut out where it repeats. Fifty words are mostly 250 to 400 bytes, so the 400 of ``op10_`` would miss many.
PASSAGE_BYTES = 256

# What the stage before stored on its way, by session; its result has been written when the next stage begins.
_STORED: dict[str, set[str]] = {}


def _entries(spark: SparkSession) -> tuple[object, set[str]]:
    """The file system of the shared folder and what this application keeps there."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    store = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return store, {str(status.getPath()) for status in store.listStatus(base)} if store.exists(base) else set()


def staged(stage):
    """A stage that first clears what the stage before it stored in the shared folder, so that disk use does not add up.

    Only entries that came up while a stage was being built are cleared, never inputs or results.
    """

    def apply(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        owner = spark.sparkContext.applicationId
        store, before = _entries(spark)
        for path in _STORED.pop(owner, set()) & before:
            store.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), True)
        found = stage(spark, docs, sf_dir)
        _STORED[owner] = _entries(spark)[1] - before
        return found

    apply.__name__, apply.__doc__ = stage.__name__, stage.__doc__
    return apply


@staged
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go."""
    return remove_toxic(docs, table(spark, sf_dir, "labels"))


@staged
def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates stays: the one with the smallest doc_id."""
    return keep_one(docs)


@staged
def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of ``PASSAGE_BYTES`` bytes and more that occur elsewhere are cut out; n_chars follows, all rows stay.

    Texts that hold a benchmark passage stay whole: a cut could leave too little of it to be found by the next stage.
    """

    def contaminated(texts: DataFrame) -> DataFrame:
        found = find_overlaps(texts, table(spark, sf_dir, "benchmark"), key="text_id")
        return found.select(F.col("key").alias("text_id")).distinct()

    kept = remove_repeats(docs, window=PASSAGE_BYTES, whole=contaminated)
    if "n_chars" not in kept.columns:
        return kept
    changed = F.when(F.col("text").isNotNull(), F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", changed)


@staged
def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


@staged
def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left, decoded again as a check: doc_id, n_tokens, ids_sha256, decoded_sha256, ids."""
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=True)


STAGES = [("toxicity", toxicity), ("ngram_jaccard", ngram_jaccard), ("suffix_dedup", suffix_dedup), ("decontaminate", decontaminate), ("byte_bpe", byte_bpe)]

# Trained models, sketches and suffix arrays have no SQL form; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
