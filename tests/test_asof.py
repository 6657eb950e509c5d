"""As-of joins, appended keys and version tables against plain loops."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from deskflow.operators.asof import join_as_of
from deskflow.operators.keys import NumberedTable
from deskflow.streaming.changes import ROCKS, VersionTable, keep_newest, newest_from_state, read_changes
from tests.test_changes import SCHEMA, brute_current, brute_versions, random_changes


def sides(seed, n=300):
    """Half of all requests and versions are of one key; some keys and times are null."""
    rng = random.Random(seed)

    def key():
        return None if rng.random() < 0.05 else 0 if rng.random() < 0.5 else rng.randrange(1, 9)

    requests = [(key(), None if rng.random() < 0.05 else rng.randrange(100), f"r{i}") for i in range(n)]
    versions = [(key(), None if rng.random() < 0.05 else rng.randrange(100), i, f"v{i}") for i in range(n // 3)]
    return requests, versions


def plain(requests, versions, most=None):
    out = []
    for key, at, name in requests:
        fit = [v for v in versions if v[0] == key and None not in (key, at, v[1]) and v[1] <= at]
        last = max(fit, key=lambda v: (v[1], v[2]), default=(None, None, None, None))
        if most is not None and last[1] is not None and at - last[1] > most:
            last = (None, None, None, None)
        out.append((key, at, name, *last[1:]))
    return sorted(out, key=str)


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
@pytest.mark.parametrize("most", [None, 5])
def test_join_as_of(spark, width, most):
    requests, versions = sides(width)
    asked = spark.createDataFrame(requests, "k long, at long, name string").repartition(3)
    known = spark.createDataFrame(versions, "k long, since long, n long, v string").repartition(2)
    found = join_as_of(asked, known, ["k"], "at", "since", F.floor(F.col("t") / width), ["n"], None if most is None else F.lit(most))
    assert found.columns == ["k", "at", "name", "since", "n", "v"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(requests, versions, most)


def test_requests_and_versions_are_not_reduced_together(spark):
    asked = spark.range(50).selectExpr("id % 5 AS k", "id AS at", "'r' AS name")
    known = spark.range(50).selectExpr("id % 5 AS k", "id AS since", "'v' AS v")
    found = join_as_of(asked, known, ["k"], "at", "since", F.floor(F.col("t") / 10))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and not re.search(r"Aggregate [^\n]*\n[ :+-]*Union", plan)


def test_join_as_of_without_rows(spark):
    asked = spark.createDataFrame([(1, 5)], "k long, at long")
    known = spark.createDataFrame([], "k long, since long, v string")
    cut = F.floor(F.col("t") / 10)
    assert [tuple(r) for r in join_as_of(asked, known, ["k"], "at", "since", cut).collect()] == [(1, 5, None, None)]
    assert join_as_of(asked.limit(0), known, ["k"], "at", "since", cut).collect() == []
    with pytest.raises(ValueError, match="both sides"):
        join_as_of(asked.withColumn("v", F.lit(1)), known, ["k"], "at", "since", cut)


def test_a_hot_key_is_spread(spark):
    """All rows are of one key: every window over them is also cut by range."""
    asked = spark.range(5000).select(F.lit(1).alias("k"), F.col("id").alias("at"))
    known = spark.range(0, 5000, 10).select(F.lit(1).alias("k"), F.col("id").alias("since"), F.col("id").alias("v"))
    found = join_as_of(asked, known, ["k"], "at", "since", F.floor(F.col("t") / 50))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window" in line]
    rows = [line for line in windows if "__inside" in line]
    assert rows and all("__range" in line.split("windowspecdefinition(")[1].split("specifiedwindowframe")[0] for line in rows)
    assert found.where("v <> 10 * floor(at / 10)").count() == 0 and found.count() == 5000


# --- appended keys --------------------------------------------------------


def batches(spark):
    rng = random.Random(4)
    rows = [[(rng.randrange(1000), f"b{b}-{i}") for i in range(n)] for b, n in enumerate((40, 0, 25, 60))]
    return rows, [spark.createDataFrame(r, "a long, b string").repartition(3) for r in rows]


def test_keys_go_on(spark, folder):
    rows, frames = batches(spark)
    table = NumberedTable(spark, folder, frames[0].schema, ["a", "b"], "id", 100)
    assert table.rows().collect() == []
    for batch in (0, 1, 2, 2, 3, 0, 2):  # repeated at once and after others
        table.append(frames[batch], batch)
    want = [r for batch in rows for r in sorted(batch)]
    assert sorted((r["id"], r["a"], r["b"]) for r in table.rows().collect()) == [(100 + i, *r) for i, r in enumerate(want)]


def test_a_batch_without_its_block_is_not_read(spark, folder):
    _, frames = batches(spark)
    table = NumberedTable(spark, folder, frames[0].schema, ["a", "b"], "id")
    table.append(frames[0], 0)
    lost = frames[2].withColumn("id", F.lit(41).cast("long"))
    lost.write.parquet(f"{folder}/rows/batch=5")  # its writer died before the block was stored
    assert table.rows().count() == 40
    table.append(frames[2], 5)
    assert table.rows().count() == 65 and table.rows().agg(F.max("id")).first()[0] == 65


def test_rows_of_a_batch_are_written_once(spark, folder, monkeypatch):
    _, frames = batches(spark)
    table = NumberedTable(spark, folder, frames[0].schema, ["a", "b"], "id")
    written, kind = [], type(frames[0].write)
    plain_write = kind.parquet

    def parquet(self, path, *args, **kwargs):
        written.append(path)
        return plain_write(self, path, *args, **kwargs)

    monkeypatch.setattr(kind, "parquet", parquet)
    for _ in range(2):
        table.append(frames[0], 0)
    assert len([p for p in written if "/blocks/" not in p]) == 2 and table.rows().count() == 40
    assert len(os.listdir(f"{folder}/rows/batch=0")) == 1


def test_a_changed_batch_under_later_ones_is_an_error(spark, folder):
    _, frames = batches(spark)
    table = NumberedTable(spark, folder, frames[0].schema, ["a", "b"], "id")
    table.append(frames[0], 0)
    table.append(frames[2], 1)
    with pytest.raises(ValueError, match="later keys"):
        table.append(frames[3], 0)
    table.append(frames[3], 1)  # nothing follows it
    assert table.rows().count() == 100


# --- versions as they arrive ----------------------------------------------


def shown(table):
    return sorted(map(tuple, table.versions().select("key", "value", "valid_from", "valid_to", "is_current").collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_versions_in_any_order(spark, folder, seed):
    rows = random_changes(seed)
    rng = random.Random(seed)
    mixed = rng.sample(rows, len(rows))
    cuts = [mixed[:50], mixed[50:60], [], mixed[60:], mixed[40:70]]  # the last has come before
    table = VersionTable(spark, folder, spark.createDataFrame([], SCHEMA).schema, ["key"], 4)
    for i, part in enumerate(cuts):
        table.write(spark.createDataFrame(part, SCHEMA), i)
    assert shown(table) == brute_versions(rows)
    table.write(spark.createDataFrame(cuts[4], SCHEMA), 4)
    assert shown(table) == brute_versions(rows)


def test_untouched_parts_are_not_read(spark, folder):
    rows = [(k, float(s), "insert" if s == 0 else "update_postimage", s) for k in range(200) for s in range(3)]
    table = VersionTable(spark, folder, spark.createDataFrame([], SCHEMA).schema, ["key"], 16)
    table.write(spark.createDataFrame(rows, SCHEMA), 0)
    first = table.owners()
    assert set(first.values()) == {0} and len(first) == 16
    late = spark.createDataFrame([(7, 9.0, "update_postimage", 1)], SCHEMA)  # seen before
    for i in range(1, 6):
        table.write(late, i)
    owners = table.owners()
    moved = [p for p in owners if owners[p] != 0]
    assert len(moved) == 1 and owners[moved[0]] == 5
    read = table.rows(spark.createDataFrame([(7,)], "key long")).inputFiles()
    assert read and all(f"/batch=5/part={moved[0]}/" in f for f in read)
    assert table.versions().count() == 600


# --- state read from the store --------------------------------------------


def test_state_is_read_from_the_checkpoint(spark, folder):
    rows = random_changes(9)
    schema = spark.createDataFrame([], SCHEMA).schema
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    for part in (rows[60:], rows[:60]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        keep_newest(read_changes(spark, f"{folder}/log", schema), ["key"], f"{folder}/checkpoint")
    assert spark.conf.get(name) == before != ROCKS
    state = newest_from_state(spark, f"{folder}/checkpoint", schema, ["key"])
    live = sorted((r["key"], r["value"]) for r in state.where("change_type <> 'delete'").collect())
    assert live == brute_current(rows)
    early = newest_from_state(spark, f"{folder}/checkpoint", schema, ["key"], 0).where("change_type <> 'delete'")
    assert sorted((r["key"], r["value"]) for r in early.collect()) == brute_current(rows[60:])
