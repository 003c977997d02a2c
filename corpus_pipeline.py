"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns a frame that is
written and read again as the next stage's ``docs``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitloom.llm import decontaminate, lsh_forest, packing, secret_crf, weak_quality
from fitloom.llm.queries import ratings, tokenizer_path
from fitloom.llm.store import saved
from fitloom.operators.joins import attach_by_key
from fitloom.sources.readers import table


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names of columns that no operator uses, but for doc_id and text; and those names by the old ones."""
    names = {c: c if c in ("doc_id", "text") else f"__column_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _named(docs: DataFrame, names: dict[str, str]) -> DataFrame:
    return docs.select(*[F.col(n).alias(c) for c, n in names.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier does not reject, unchanged.

    Every row is judged by its own whole text: repeated rows and very long texts like others, a null or empty text
    as one without any sign of bad. Rows without an id are judged too, but no rating can reach them. No rows
    give none; columns named like results of the operator keep their own values.
    """
    inner, names = _apart(docs)
    scored = weak_quality.score(inner, weak_quality.fit(inner, ratings(spark, sf_dir)))
    return _named(scored.where("not rejected"), names)


NEAR_PERCENT = 80  # the 85 of near_duplicates is the contract of op8 alone


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: that of smallest id, of several rows with this id any one.

    Rows are compared as rows, whatever their ids: different texts under one id all stay, and equal or near texts leave one
    row, also if repeated or without an id (a row with an id stays before one without). Texts without words, empty
    or null, are like nothing and all stay. No rows give none; other columns, of whatever name, are left alone.
    """
    inner, names = _apart(docs)
    inner = saved(inner.withColumn("__row", F.monotonically_increasing_id()), "rows")
    found = lsh_forest.near_duplicates(inner.select("__row", "text"), doc_id="__row", percent=NEAR_PERCENT)
    places = found.select(F.col("doc_id").alias("__row"), "component_id").join(inner.select("__row", "doc_id"), "__row")
    places = saved(places, "places")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first")
    firsts = places.groupBy("component_id").agg(first).select("component_id", F.col("first.__row").alias("__first"))
    others = attach_by_key(places, firsts, ["component_id"], ["__row"]).where("__row <> __first").select("__row", F.lit(True).alias("__copy"))
    # the copies are few beside the rows: as long as they are small, the texts stay where they are
    marked = attach_by_key(inner, others, ["__row"], ["__row"], "left")
    return _named(marked.where("__copy is null"), names)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark, unchanged.

    Each row is judged by its own whole text: repeated rows and very long texts like others; a null or empty text
    has no passage and stays, with or without id. No rows give none; columns named like results of the operator keep their own values.
    """
    inner, names = _apart(docs)
    found = decontaminate.find_leaks(inner.withColumn("__scan", F.col("text")), table(spark, sf_dir, "benchmark"), text="__scan")
    return _named(found.where("n_hit = 0"), names)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced by a mark; where there is a column n_chars it counts anew.

    Each row's whole text is read: repeated rows and very long texts like others; null stays null and empty stays empty, with
    or without id. No rows give none; columns named like results of the operator keep their own values.
    """
    inner, names = _apart(docs)
    clean = _named(secret_crf.redact(inner, secret_crf.fit(inner.select("doc_id", "text"))), names)
    if "n_chars" not in docs.columns:
        return clean
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids.

    Every row is packed, also a repeated one or one without id; a null or empty text is its end alone, a very
    long one many pieces. No rows give none; other columns are left out.
    """
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # fitted models and packing are not SQL; the tests compare each stage with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
