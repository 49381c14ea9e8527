"""Terms and the report tables of topic models."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from caseloom.functions.text import run_lengths, sorted_runs
from caseloom.operators.clean import any_over
from caseloom.operators.relational import argmax, inner_join, value_counts
from caseloom.session import BROADCAST_ROWS, materialize


def lemmatize(
    df: DataFrame, key: str, tokens: str, lexicon: DataFrame, keep: Sequence[str] = ("NOUN", "ADJ", "VERB", "ADV"),
    name: str = "lemmas",
) -> DataFrame:
    """``(key, lemmas)``: tokens replaced by the lemmas of a lexicon ``(form, lemma, pos)``, in token order.

    Only the wanted parts of speech are kept. Forms are unique in the lexicon; words it does not know stay as they
    are. A document without any lemma has an empty list. A lexicon that can be broadcast is looked up inside the rows, so
    that whole lists are shuffled and not single words.
    """
    if lexicon.count() <= BROADCAST_ROWS:
        rows = _lemmas_in_rows(df.select(key, F.col(tokens).alias("tokens")), key, lexicon, keep)
        # A key that stands in one row, as it should, has its list; lists of several rows are merged by position.
        cells = F.transform(F.col("__lists"), lambda words: F.transform(words, lambda w, i: F.when(w.isNotNull(), F.struct(i.alias("i"), w.alias("w")))))
        merged = F.transform(F.sort_array(F.array_compact(F.flatten(cells))), lambda c: c["w"])
        lists = rows.groupBy(key).agg(F.collect_list("words").alias("__lists"))
        return lists.select(key, F.when(F.size("__lists") == 1, F.array_compact(F.col("__lists")[0])).otherwise(merged).alias(name))
    words = df.select(key, F.posexplode_outer(tokens).alias("__pos", "form"))
    looked_up = words.join(lexicon, "form", "left")
    wanted = F.col("form").isNotNull() & (F.col("lemma").isNull() | F.col("pos").isin(list(keep)))
    cell = F.when(wanted, F.struct("__pos", F.coalesce("lemma", "form").alias("w")))
    lists = looked_up.groupBy(key).agg(F.sort_array(F.collect_list(cell)).alias("__cells"))
    return lists.select(key, F.col("__cells.w").alias(name))


def _lemmas_in_rows(df: DataFrame, key: str, lexicon: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(key, words)``: the words of every row by place, null where the part of speech is not wanted."""
    known = lexicon.where("form is not null").select("form", F.when(
        F.col("lemma").isNull() | F.col("pos").isin(list(keep)), F.coalesce("lemma", "form")).alias("word")).toArrow()
    forms, words = known.column("form").combine_chunks(), known.column("word").combine_chunks()

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens = batch.column("tokens")
            flat, sizes = tokens.flatten(), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            place = pc.index_in(flat, value_set=forms.cast(flat.type))
            found = pc.if_else(pc.is_null(place), flat, words.cast(flat.type).take(place))
            ends = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.ListArray.from_arrays(ends, found)], [key, "words"])

    return df.mapInArrow(look_up, StructType([df.schema[key]]).add("words", ArrayType(StringType())))


def term_counts(df: DataFrame, key: str, terms: str, min_docs: int = 2) -> DataFrame:
    """Long document-term matrix ``(key, term, n)`` of terms that occur in at least ``min_docs`` documents, stored once.

    ``df`` has one row per document. A document's terms are counted inside its row, without a shuffle; only the
    number of documents per term is, and the list of frequent terms is sent to the rows if it is small.
    """
    ordered = df.select(key, F.array_sort(terms).alias("__s"))
    runs = ordered.select(key, "__s", sorted_runs(F.col("__s")).alias("__e"))
    counts = materialize(runs.select(key, F.inline(run_lengths(F.col("__s"), F.col("__e")))), "counts")
    frequent = counts.groupBy("term").agg(F.count(F.lit(1)).alias("docs")).where(F.col("docs") >= min_docs)
    return counts.join(frequent.select("term"), "term", "left_semi").select(key, "term", "n")


def sparsity(counts: DataFrame, documents: DataFrame) -> DataFrame:
    """Percentage of non-zero cells of the document-term matrix."""
    rows = documents.agg(F.count(F.lit(1))).scalar()
    cells = counts.agg(F.count(F.lit(1)).alias("nonzero"), F.countDistinct("term").alias("vocabulary"))
    return cells.select(
        "nonzero", "vocabulary", (F.lit(100.0) * F.col("nonzero") / (F.col("vocabulary") * rows)).alias("sparsity")
    )


def grid_summary(results: DataFrame, decays: Sequence[float]) -> DataFrame:
    """Mean score per topic count, one column per decay (``decay_0_7``)."""
    wide = results.groupBy("topics").pivot("decay", list(decays)).agg(F.round(F.avg("score"))).orderBy("topics")
    return wide.toDF("topics", *[f"decay_{d}".replace(".", "_") for d in decays])


def best_setting(results: DataFrame) -> DataFrame:
    means = results.groupBy("topics", "decay").agg(F.avg("score").alias("score"))
    return means.orderBy(F.desc("score"), "topics", "decay").limit(1)


def document_topics(weights: Column, digits: int = 2) -> tuple[Column, Column]:
    """Topic weights rounded half to even, and the index of the first largest rounded weight."""
    rounded = F.transform(weights, lambda w: F.bround(w, digits))
    return rounded, argmax(rounded)


def with_dominant_topic(df: DataFrame, weights: Column, digits: int = 2) -> DataFrame:
    rounded, best = document_topics(weights, digits)
    return df.withColumn("weights", rounded).withColumn("dominant_topic", best)


def topic_columns(df: DataFrame, weights: str, k: int, name: str = "topic") -> DataFrame:
    return df.select("*", *[F.col(weights)[i].alias(f"{name}{i}") for i in range(k)])


def topic_distribution(df: DataFrame, weights: Sequence[str], topic: str, threshold: float) -> DataFrame:
    """Documents per dominant topic, and how many of them have any weight above the threshold."""
    everything = value_counts(df, topic, "num_documents")
    above = value_counts(any_over(df, weights, threshold), topic, "num_documents_in_threshold")
    return inner_join(everything, above.withColumnRenamed(topic, "__topic"), topic, "__topic")


def keyword_columns(keywords: DataFrame, n: int = 15) -> DataFrame:
    """Top words ``(topic, rank, word)`` of a topic model with one column per rank."""
    return keywords.groupBy("topic").pivot("rank", list(range(n))).agg(F.first("word")).select(
        "topic", *[F.col(str(i)).alias(f"word_{i}") for i in range(n)]
    )
