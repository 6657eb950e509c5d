import itertools
import random

import pytest
from pyspark.sql import functions as F

from deskflow.operators.memory import thread_pages, thread_versions
from deskflow.operators.ordered import next_in_key, number_rows, running_totals, top_rows
from deskflow.operators.quality import duplicate_keys, null_counts, orphans, rows_per_key
from deskflow.sources.tables import slices


def skewed(n=400, seed=3):
    rng = random.Random(seed)
    return [(0 if i % 3 else rng.randrange(1, 9), i, float(rng.randrange(100))) for i in range(n)]


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_next_in_key(spark, width):
    rows = skewed()
    found = next_in_key(spark.createDataFrame(rows, "k long, t long, v double"), ["k"], "t", "nxt", width)
    expected = {}
    for key, group in itertools.groupby(sorted(rows), key=lambda r: r[0]):
        times = [r[1] for r in group]
        expected.update({(key, a): b for a, b in itertools.zip_longest(times, times[1:])})
    assert {(r["k"], r["t"]): r["nxt"] for r in found.collect()} == expected


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_running_totals(spark, width):
    rows = skewed()
    df = spark.createDataFrame(rows, "k long, t long, v double")
    found = running_totals(df, ["k"], ["t"], F.floor(F.col("t") / width), {"total": "v"})
    expected, sums = {}, {}
    for key, t, v in sorted(rows):
        sums[key] = sums.get(key, 0.0) + v
        expected[(key, t)] = sums[key]
    assert {(r["k"], r["t"]): r["total"] for r in found.collect()} == expected


def test_number_rows(spark, folder):
    rows = skewed()
    df = spark.createDataFrame(rows, "k long, t long, v double").repartition(5)
    found = number_rows(df, ["k", "t"], "id", folder + "/n", start=11).collect()
    assert {(r["k"], r["t"]): r["id"] for r in found} == {
        (k, t): i for i, (k, t, _) in enumerate(sorted(rows), start=11)
    }


def test_numbers_are_added_without_another_shuffle(spark, folder):
    df = spark.createDataFrame(skewed(), "k long, t long, v double")
    plan = number_rows(df, ["k", "t"], "id", folder + "/n")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_top_rows(spark):
    df = spark.createDataFrame(skewed(), "k long, t long, v double")
    found = top_rows(df, ["k"], [F.desc("t")], 2)
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 2 * df.select("k").distinct().count()


@pytest.mark.parametrize("size", [1, 4, 64])
def test_pages_hold_every_message(spark, size):
    turns = [(t, v, "user", f"m{t}.{v}") for t in range(3) for v in range(9 * t + 1)]
    df = spark.createDataFrame(turns, "thread_id long, version long, role string, text string").repartition(4)
    pages = thread_pages(df, size).orderBy("thread_id", "page").collect()
    assert max(r["n_messages"] for r in pages) <= size
    lines = [line for r in pages for line in r["messages"].split("\n")]
    assert lines == [f"{role}: {text}" for _, _, role, text in turns]
    versions = thread_versions(df, width=size).collect()
    assert all(r["n_messages"] == r["version"] + 1 for r in versions)


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "z"), (None, "b")], "k long, v string")
    assert [tuple(r) for r in duplicate_keys(df, ["k"]).collect()] == [(1, 2)]
    parents = spark.createDataFrame([(1,)], "id long")
    assert [tuple(r) for r in orphans(df, "k", parents, "id").collect()] == [(2, 1)]
    assert {tuple(r) for r in null_counts(df, ["k", "v"]).collect()} == {("k", 1), ("v", 1)}
    assert tuple(rows_per_key(df, ["k"]).first()) == (4, 3, False)


@pytest.mark.parametrize("low, high, parts", [(0, 99, 4), (0, 2, 8), (5, 5, 3), (-7, 20, 5)])
def test_slices_cover_every_row_once(spark, low, high, parts):
    df = spark.createDataFrame([(i,) for i in range(low - 3, high + 4)] + [(None,)], "k long")
    predicates = slices("k", low, high, parts)
    assert len(predicates) <= parts
    assert sum(df.where(p).count() for p in predicates) == df.count()
