"""From raw documents to a training mix: five stages, each a job over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents. Rows are told apart by a hash of doc_id and text,
so null and repeated ids are handled like others; columns that a stage does not know pass through unchanged.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskflow.llm import language, quality
from deskflow.llm.common import join_few, moved, row_key, stored
from deskflow.llm.decontaminate import find_items
from deskflow.llm.identifiers import find_identifiers, masked
from deskflow.llm.mixing import mix_sources
from deskflow.llm.registry import table
from deskflow.llm.signatures import shingle_components


def unused(docs: DataFrame, *names: str) -> list[str]:
    """The names after a mark that no column of `docs` begins with."""
    mark = "__"
    while any(c.startswith(mark) for c in docs.columns):
        mark += "_"
    return [mark + n for n in names]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject. It learns from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where("quality is not null")
    labels = labels.where(language.fold(F.col("doc_id"), 3) != 1)
    model = quality.fit(docs, labels)
    return docs.where(quality.score_of(spark, model)("text") >= 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, a similarity of 0.8): the one with the smallest doc_id.

    A null doc_id comes last, and a hash of the row decides between rows that share the smallest; of equal rows one
    stays. Documents without words are no copies of one another.
    """
    key, gone, copies, once = unused(docs, "key", "gone", "rows", "once")
    found = stored(shingle_components(docs, 5, 80, 100).where("n_shingles > 0").select("key", "doc_id", "component"), "copies")
    best = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("best")
    chosen = found.groupBy("component").agg(best).select("component", F.col("best.key").alias("chosen"))
    other = found.join(moved(chosen), "component").select(F.col("key").alias(key), (F.col("key") != F.col("chosen")).alias("other"))
    rows = other.groupBy(key).agg(F.max("other").alias(gone), F.count("*").alias(copies))
    rows = stored(rows.where(F.col(gone) | (F.col(copies) > 1)), "dropped")
    kept = join_few(docs.withColumn(key, row_key()), rows, key).where(F.col(gone).isNull() | ~F.col(gone))
    if rows.where(F.col(copies) > 1).limit(1).count():
        number = F.when(F.col(copies) > 1, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1)
        kept = kept.withColumn(once, number).dropDuplicates([key, once])
    return kept.select(docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item stands, with few edits or none."""
    key, leak = unused(docs, "key", "leak")
    leaks = find_items(docs, table(spark, sf_dir, "benchmark")).select(F.col("key").alias(key)).distinct()
    leaks = stored(leaks.withColumn(leak, F.lit(True)), "leaks")
    return join_few(docs.withColumn(key, row_key()), leaks, key).where(F.col(leak).isNull()).select(docs.columns)


def mask_identifiers(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind in brackets, and n_chars counted again."""
    key, spans = unused(docs, "key", "spans")
    found = find_identifiers(docs).where(F.size("spans") > 0).select(F.col("key").alias(key), F.col("spans").alias(spans))
    found = stored(found.dropDuplicates([key]), "spans")

    @F.pandas_udf("string")
    def mask(text: pd.Series, places: pd.Series) -> pd.Series:
        return pd.Series([masked(t, list(s)) if s is not None else None for t, s in zip(text, places)])

    met = join_few(docs.withColumn(key, row_key()), found, key)
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(mask(F.when(F.col(spans).isNotNull(), F.col("text")), spans))
    met = met.withColumn("text", text)
    if "n_chars" in docs.columns:
        n = F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.length("text"))
        met = met.withColumn("n_chars", n.cast(docs.schema["n_chars"].dataType))
    return met.select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What a mix of the sources to target weights takes of each document."""
    return mix_sources(docs)


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_copies),
    ("benchmark decontamination", drop_leaks),
    ("PII", mask_identifiers),
    ("mixing sources to target weights", mix),
]

# no stage of learned weights can be said in SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
