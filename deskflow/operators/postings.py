"""Term lookup over stored conversations: postings by term, so that a search reads the parts of its words only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PARTS = 64
SPREAD = 8  # files of a part, so that a term that stands in many messages is read by several tasks

# fixed values: what stands between terms
TERM = r"[^\x09-\x0D\x20.,;:!?]+"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def part_of_term(term: Column, parts: int = PARTS) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(parts)).cast("int")


class Postings:
    """(term, thread_id, version, position) below one folder, in parts by a hash of the term."""

    def __init__(self, spark: SparkSession, path: str, parts: int = PARTS):
        self.spark, self.path, self.parts = spark, path, parts

    def write(self, turns: DataFrame, batch: int = 0) -> None:
        """Adds the terms of `turns` (thread_id, version, text); the same batch again replaces itself."""
        found = turns.select("thread_id", "version", F.posexplode(terms_of(F.col("text"))).alias("position", "term"))
        found = found.withColumn("part", part_of_term(F.col("term"), self.parts))
        dealt = found.repartition("part", F.pmod(F.xxhash64("thread_id", "version"), F.lit(SPREAD)))
        dealt.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/batch={batch}")

    def of(self, terms: list[str]) -> DataFrame:
        """The postings of the given terms, from their parts alone."""
        rows = self.spark.read.schema("thread_id long, version long, position int, term string, batch long, part int").parquet(self.path)
        asked = self.spark.range(1).select(F.explode(F.array(*[part_of_term(F.lit(t), self.parts) for t in terms])).alias("p"))
        parts = sorted({r["p"] for r in asked.collect()})  # one for each word of the phrase at most
        return rows.where(F.col("part").isin(parts) & F.col("term").isin(terms)).select("term", "thread_id", "version", "position")

    def phrase(self, phrase: str) -> DataFrame:
        """thread_id, version and how often the words of `phrase` stand there one after the other.

        Every posting says where the phrase would begin; it stands where all of its words say the same place. One
        aggregate, with no join of the words' postings, so a word that is in most messages costs its own rows only.
        """
        words = self.words(phrase)
        if not words:
            raise ValueError("a phrase needs a word")
        places = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(i).alias("i")) for i, w in enumerate(words)])
        mine = F.filter(places, lambda p: p["w"] == F.col("term"))
        starts = self.of(sorted(set(words))).select("thread_id", "version", "position", F.explode(mine).alias("p"))
        starts = starts.groupBy("thread_id", "version", (F.col("position") - F.col("p.i")).alias("begin")).agg(F.count("*").alias("n"))
        return starts.where(F.col("n") == len(words)).groupBy("thread_id", "version").agg(F.count("*").alias("n_times"))

    def words(self, phrase: str) -> list[str]:
        return self.spark.range(1).select(terms_of(F.lit(phrase)).alias("w")).first()["w"]
