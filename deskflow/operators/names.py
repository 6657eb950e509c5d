"""Known names inside free text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: a name's tokens are what stands between these
TOKEN = r"[^\x09-\x0D\x20.,;:!?()\"]+"


def tokens_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(TOKEN), F.lit(0))


def runs_of(tokens: Column, n: int) -> Column:
    """All runs of n tokens, with where each begins."""
    begins = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1))).otherwise(F.array().cast("array<int>"))
    gram = lambda i: F.array_join(F.slice(tokens, i, n), " ")
    return F.transform(begins, lambda i: F.struct((i - 1).alias("position"), F.lit(n).alias("n_tokens"), gram(i).alias("gram")))


def find_names(texts: DataFrame, aliases: DataFrame, key: str, column: str) -> DataFrame:
    """`key`, position (of the first token, from 0), n_tokens and alias_id of each name in the texts, left to right.

    `aliases` has (alias, alias_id); the smallest id counts where one alias has several. All runs of tokens that are as
    long as an alias can be are joined with the aliases on equality, so a text meets the names it holds and no others.
    Where names overlap, the one that begins first is taken, the longest of those, and the search goes on behind it.
    """
    known = aliases.select(F.array_join(tokens_of(F.col("alias")), " ").alias("gram"), "alias_id").where("gram <> ''")
    known = known.groupBy("gram").agg(F.min("alias_id").alias("alias_id"))
    sizes = [r["n"] for r in known.select((F.size(F.split("gram", " "))).alias("n")).distinct().collect()]  # lengths in tokens: a few
    cut = texts.select(F.col(key), tokens_of(F.col(column)).alias("tokens"))
    runs = [runs_of(F.col("tokens"), n) for n in sorted(sizes)]
    if not runs:
        return texts.select(key).limit(0).select(key, *[F.lit(None).cast(t).alias(c) for c, t in (("position", "int"), ("n_tokens", "int"), ("alias_id", "string"))])
    met = cut.select(key, F.explode(F.concat(*runs)).alias("r")).select(key, "r.*").join(known, "gram")
    longest = F.array_sort(F.collect_list(F.struct("position", (-F.col("n_tokens")).alias("less"), "alias_id")))
    found = met.groupBy(key).agg(longest.alias("all"))
    nothing = F.struct(F.lit(0).alias("end"), F.slice("all", 1, 0).alias("kept"))
    taken = F.aggregate(
        "all",
        nothing,
        lambda state, x: F.when(
            x["position"] >= state["end"],
            F.struct((x["position"] - x["less"]).alias("end"), F.concat(state["kept"], F.array(x)).alias("kept")),
        ).otherwise(state),
    )
    kept = found.select(key, F.explode(taken["kept"]).alias("x"))
    return kept.select(key, F.col("x.position").alias("position"), (-F.col("x.less")).alias("n_tokens"), F.col("x.alias_id").alias("alias_id"))
