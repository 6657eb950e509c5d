"""Mixes sources to target weights by a low-discrepancy schedule.

Each source's documents, shuffled by a hash, form one stream of words that is cut into blocks of equal length; the
stream goes round, so a block may end in the next round. Slot i of the schedule stands at the point i * golden ratio
modulo 1; the cumulative numbers of the sources' slots say which source's interval the point is in, and the slot's
rank within its source says which block it takes. Any run of slots is thus mixed almost as the whole. Slots and the
parts of documents that lie in a block meet in a join on source and block.

All large sources have blocks of one length, which follows from the size of the corpus. A source whose target is less
than LEAST such blocks has blocks of its own, a part of its target, so the number of slots follows the number of
sources and never the smallest one, and small sources get what they should in a corpus of any size.
Ranks and positions are running totals cut into ranges, so a source with most of the rows is no task's work alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import number_rows, running_totals
from ..session import work_dir
from .common import stored

WEIGHTS = (5.0, 2.0, 1.0)
GOLDEN = 0.6180339887498949  # (sqrt(5) - 1) / 2
BLOCKS = 1 << 20  # blocks that a stream of all words would have, about
LEAST = 256  # slots that a target has at least, if it has as many words
CELLS = 4096  # of the unit interval, at least, and of each source's shuffled documents
SLOTS_PER_RANGE = 4096


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, its key, size in words, and two hashes that set the shuffled order."""
    key = F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col("source")))
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), key.alias("key"), size.alias("size"),
        F.xxhash64("doc_id").alias("h"), F.xxhash64("text", "doc_id", F.lit(1)).alias("h2"),
    )


def source_targets(rows: DataFrame, total_share: float = 1.5, most: float = 2.0) -> DataFrame:
    """key, sid, source_size and target: sources in code point order, null last, share the total by weight.

    Targets above `most` times their source's size are set to that, and what they leave is shared by the weights
    of the others, until none is above.
    """
    spark = rows.sparkSession
    sources = rows.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    sources = number_rows(sources.withColumn("unnamed", F.col("source").isNull()), ["unnamed", "source"], "sid", work_dir(spark, "sources"), 0)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    sources = stored(sources.select("key", "sid", "source_size", weight.alias("weight"), (F.col("source_size") * most).alias("cap")), "sources")
    whole = (sources.agg(F.sum("source_size")).first()[0] or 0) * total_share
    level, before = 0.0, -1
    while whole:
        full = F.col("weight") * level >= F.col("cap") if before >= 0 else F.lit(False)
        state = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("cap"))), F.lit(0.0)), F.sum(F.when(~full, F.col("weight"))), F.count(F.when(full, 1))
        ).first()
        if state[2] == before or state[1] is None:
            break
        before, level = state[2], (whole - state[0]) / state[1]
    return sources.select("key", "sid", "source_size", F.least(F.col("weight") * level, F.col("cap")).alias("target"))


def schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """slot, sid, rank, epoch, block and words of the slots; `targets` has sid, source_size and target.

    words is the length of the source's blocks, at most `block_words`. The source's blocks lie one after the other in
    its stream, round after round: a slot's begins at word (rank - 1) * words, in round `epoch`, as its block `block`.
    """
    spark = targets.sparkSession
    words = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("target") / LEAST))).cast("long")
    counts = targets.where("target > 0").select("sid", "source_size", "target", words.alias("words"))
    counts = counts.withColumn("n", F.ceil(F.col("target") / F.col("words")))
    shares = stored(running_totals(counts, [], ["sid"], F.floor(F.col("sid") / 1024), {"high": "n"}).withColumn("low", F.col("high") - F.col("n")), "shares")
    whole, sources = shares.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    cells = max(CELLS, 4 * sources)
    cell = F.sequence(F.floor(F.col("low") * cells / (whole or 1)), F.floor(F.col("high") * cells / (whole or 1)))
    shares = shares.withColumn("cell", F.explode(cell))

    point = F.col("slot") * F.lit(GOLDEN)
    slots = spark.range(0, whole).withColumnRenamed("id", "slot").withColumn("point", (point - F.floor(point)) * whole)
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells / (whole or 1))).join(shares, "cell").where("point >= low and point < high")
    slots = slots.select("slot", "sid", "source_size", "words", F.lit(1).alias("one"))
    ranked = running_totals(slots, ["sid"], ["slot"], F.floor(F.col("slot") / SLOTS_PER_RANGE), {"rank": "one"})
    ranked = ranked.withColumn("begin", (F.col("rank") - 1) * F.col("words"))
    return ranked.selectExpr("slot", "sid", "rank", "begin div source_size AS epoch", "begin % source_size div words AS block", "words")


def mix_sources(docs: DataFrame, total_share: float = 1.5, most: float = 2.0) -> DataFrame:
    """doc_id, size, source_size, target and taken for each row of `docs` (doc_id, text, source).

    taken counts the words of the row that the schedule's slots take, repeats counted, never more than `most` times
    (rounded down) its size. Null texts, and sources without words, have size 0 and nothing taken; null is a source
    of its own. Equal rows are rows of their own. No rows give no rows; other columns are ignored.
    """
    rows = stored(sized(docs), "sizes")
    targets = stored(source_targets(rows, total_share, most), "targets")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    slots = stored(schedule(targets, max(1, -(-total // BLOCKS))), "schedule")
    lengths = stored(slots.groupBy("sid").agg(F.first("words").alias("words"), F.sum("words").alias("whole")), "lengths")

    placed = rows.withColumn("one", F.lit(1)).join(targets.join(lengths, "sid", "left"), "key")
    bits = CELLS.bit_length() - 1
    placed = running_totals(placed, ["sid"], ["h", "h2"], F.shiftright(F.col("h"), 64 - bits), {"end": "size", "position": "one"})
    placed = stored(placed.select("doc_id", "sid", "position", "size", "source_size", "target", "words", "whole", "end"), "placed")

    # where a document lies in each round of its stream, as far as the slots go, and the blocks that it lies in
    parts = placed.where("size > 0").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(max(1, int(most)) - 1))))
    parts = parts.withColumn("hi", F.least(F.col("round") * F.col("source_size") + F.col("end"), F.col("whole"))).where(F.lit(most >= 1))
    parts = parts.withColumn("lo", F.col("round") * F.col("source_size") + F.col("end") - F.col("size")).where("lo < hi")
    parts = parts.select("sid", "position", "words", "lo", "hi", F.explode(F.expr("sequence(lo div words, (hi - 1) div words)")).alias("nth"))
    part = F.least("hi", (F.col("nth") + 1) * F.col("words")) - F.greatest("lo", F.col("nth") * F.col("words"))
    # Spark sizes the parts by the documents that they come from and would send them all through the driver
    parts = parts.select("sid", "position", "nth", part.alias("part")).hint("merge")
    taken = parts.join(slots.select("sid", (F.col("rank") - 1).alias("nth")), ["sid", "nth"]).groupBy("sid", "position").agg(F.sum("part").alias("taken"))
    out = placed.join(taken, ["sid", "position"], "left")
    return out.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
