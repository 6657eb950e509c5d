"""Conversation history as state per thread.

A thread may be of any length, so its messages are kept in pages of bounded size and
its versions carry running counts; nothing collects a whole thread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ci
from .ordered import RANGE_WIDTH, running_totals

PAGE = 64


def thread_versions(turns: DataFrame, width: int = RANGE_WIDTH) -> DataFrame:
    """State after every turn: how many messages and characters the thread then holds."""
    sized = turns.withColumn("one", F.lit(1)).withColumn("chars", F.length("text"))
    return running_totals(
        sized,
        ["thread_id"],
        ["version"],
        F.floor(F.col("version") / F.lit(width)),
        {"n_messages": "one", "state_chars": "chars"},
    ).drop("one", "chars")


def thread_pages(turns: DataFrame, size: int = PAGE) -> DataFrame:
    """Messages of a thread in order, one row per page of `size` turns."""
    line = F.concat(F.col("role"), F.lit(": "), F.col("text"))
    return (
        turns.groupBy("thread_id", F.floor(F.col("version") / size).alias("page"))
        .agg(
            F.min("version").alias("first_version"),
            F.max("version").alias("last_version"),
            F.count("*").alias("n_messages"),
            F.array_sort(F.collect_list(F.struct("version", line.alias("line")))).alias("m"),
        )
        .withColumn("messages", F.concat_ws("\n", F.transform("m", lambda x: x["line"])))
        .drop("m")
    )


def thread_latest(turns: DataFrame) -> DataFrame:
    """The newest message of every thread with the size of its state."""
    last = F.max_by(F.struct("version", "role", "text"), "version")
    return (
        turns.groupBy("thread_id")
        .agg(
            last.alias("l"),
            F.count("*").alias("n_messages"),
            F.sum(F.length("text")).alias("state_chars"),
        )
        .select("thread_id", "l.*", "n_messages", "state_chars")
    )


def thread_states(turns: DataFrame, delay: str) -> DataFrame:
    """A stream of thread states as change rows, one for each thread that a batch adds to.

    `turns` (thread_id, version, role, text, said_at) is a stream. A turn that comes again while its time is no older
    than the newest by more than `delay` is dropped. Per thread the state store holds the newest message, the count
    and the size, whatever the thread's length; the count is the change's sequence, so the newest state wins however
    batches are read.
    """
    once = turns.withWatermark("said_at", delay).dropDuplicatesWithinWatermark(["thread_id", "version"])
    last = F.max_by(F.struct("version", "role", "text"), "version")
    states = once.groupBy("thread_id").agg(
        last.alias("l"), F.count("*").alias("n_messages"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("state_chars")
    )
    kind = F.lit("update_postimage").alias("change_type")
    return states.select("thread_id", "l.*", F.col("n_messages").alias("n"), "state_chars", kind, F.col("n_messages").alias("sort_by"))


def thread_prompts(turns: DataFrame, instruction: str) -> DataFrame:
    """Each thread's messages at positions from 1, after one system message at 0."""
    first = (
        turns.select("thread_id")
        .distinct()
        .select(
            "thread_id",
            F.lit(0).cast("long").alias("position"),
            F.lit("system").alias("role"),
            F.lit(instruction).alias("text"),
        )
    )
    rest = turns.select("thread_id", (F.col("version") + 1).alias("position"), "role", "text")
    return first.unionByName(rest)


def search_threads(turns: DataFrame, needle: str) -> DataFrame:
    """Messages per thread that hold the needle, whatever their case."""
    return turns.groupBy("thread_id").agg(
        F.count_if(contains_ci(F.col("text"), needle)).alias("n_hits"),
        F.count("*").alias("n_messages"),
        F.max(F.when(contains_ci(F.col("text"), needle), F.col("version"))).alias("last_hit"),
    )


def payload_sizes(turns: DataFrame) -> DataFrame:
    """Rows and stored bytes per role."""
    size = F.octet_length(F.encode("text", "UTF-8"))
    return turns.groupBy("role").agg(
        F.count("*").alias("n_rows"),
        F.sum(size).alias("total_bytes"),
        F.max(size).alias("max_bytes"),
    )
