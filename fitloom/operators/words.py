"""Vocabulary, bag of words and token ids."""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fitloom.functions.text import MAX_LITERAL_WORDS, attention_mask, hashed_lookup, pad_ids
from fitloom.operators.joins import attach_by_key


def bow_vocabulary(df: DataFrame, tokens: Column, size: int = 1000, min_len: int = 2) -> DataFrame:
    """The ``size`` most frequent words, indexed alphabetically; ties go to the earlier word.

    Counts are combined before the shuffle, so a word that makes up a third of all text
    costs one row per task.
    """
    # an outer explode: an inner one makes Catalyst compute the tokens once more to filter by their size
    counts = df.select(F.explode_outer(tokens).alias("word")).where(F.length("word") >= min_len)
    top = counts.groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(size)
    return top.select("word", "n", (F.row_number().over(W.orderBy("word")) - 1).cast("int").alias("idx"))


def vocabulary_words(vocab: DataFrame) -> list[str]:
    """The fitted state: the words in index order (as many as the vocabulary size)."""
    return [r["word"] for r in vocab.select("word", "idx").orderBy("idx").collect()]


def bow_vector(df: DataFrame, tokens: Column, words: list[str], out: str = "counts") -> DataFrame:
    """Sparse count vector per row over a given vocabulary; a narrow step without shuffle."""
    model = CountVectorizerModel.from_vocabulary(words, inputCol="__tokens", outputCol=out)
    return model.transform(df.withColumn("__tokens", tokens)).drop("__tokens")


def bow_counts(df: DataFrame, tokens: Column, words: list[str], ids: list[str]) -> DataFrame:
    """(ids, idx, n) for every vocabulary word that occurs in a row; unknown words are skipped.

    The vocabulary is broadcast, so each word is looked up where it stands, and counts are combined before the shuffle:
    only occurring words are ever written; ``ids`` must name a row.
    """
    places = {w: i for i, w in enumerate(words)}
    cells = pa.table({"__word": pa.array(places.keys(), pa.string()), "idx": pa.array(places.values(), pa.int32())})
    vocab = df.sparkSession.createDataFrame(cells)
    each = df.select(*ids, F.explode_outer(tokens).alias("__word")).join(F.broadcast(vocab), "__word")
    return each.groupBy(*ids, "idx").agg(F.count(F.lit(1)).alias("n"))


def tokenize_pad_truncate(df: DataFrame, tokens: Column, vocab: DataFrame, length: int, ids: list[str]) -> DataFrame:
    """``input_ids`` and ``attention_mask`` of fixed length; 0 pads, 1 is unknown, words start at 2.

    A vocabulary of checked size is looked up inside the row. A larger one is joined: the
    at most ``length`` kept tokens of a row are looked up and put together again.
    """
    first = F.slice(tokens, 1, length)
    some = vocab.select("word", "idx").limit(MAX_LITERAL_WORDS + 1).collect()
    if len(some) <= MAX_LITERAL_WORDS:
        lookup = hashed_lookup({r["word"]: r["idx"] + 2 for r in some}, "int")
        coded = df.select(*ids, F.transform(first, lambda w: F.coalesce(lookup(w), F.lit(1))).alias("__ids"))
    else:
        each = df.select(*ids, F.posexplode_outer(first).alias("__pos", "word"))
        table = vocab.select("word", (F.col("idx") + 2).alias("__id"))
        found = attach_by_key(each, table, ["word"], [*ids, "__pos"], "left")
        pair = F.when(F.col("__pos").isNotNull(), F.struct("__pos", F.coalesce("__id", F.lit(1)).alias("id")))
        gathered = found.groupBy(*ids).agg(F.sort_array(F.collect_list(pair)).alias("__p"))
        coded = gathered.select(*ids, F.transform("__p", lambda p: p["id"]).alias("__ids"))
    return coded.select(
        *ids, pad_ids(F.col("__ids"), length).alias("input_ids"), attention_mask(F.col("__ids"), length).alias("attention_mask")
    )
