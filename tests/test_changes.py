import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from deskflow.operators.cdc import as_of, capture_changes, reconcile, scd1, scd2, update_where, upsert
from deskflow.plans import QUERIES
from deskflow.sources.tables import read_table, stream_table
from deskflow.streaming.changes import PARTS, KeyedTable, apply_history, apply_latest, read_changes, run_apply
from pyspark.sql import functions as F

SCHEMA = "key long, value double, change_type string, sort_by long"
POSITION = "position_id long, client_id string, instrument_id string, net_qty double"
SLOW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))

# fixed values: four positions, then one changed and one added
SEED = [(1, "CL-AC", "WTI", 250.0), (2, "CL-AC", "HO", 1500.0), (3, "CL-SU", "WTI", 400.0), (4, "CL-BCE", "BCE.TO", 30000.0)]
LATER = [(1, "CL-AC", "WTI", 900.0), *SEED[1:], (5, "CL-CVE", "NG", 800.0)]


def history(spark):
    old, new = spark.createDataFrame(SEED, POSITION), spark.createDataFrame(LATER, POSITION)
    first = capture_changes(None, old, ["position_id"], 1)
    return first.unionByName(capture_changes(old, new, ["position_id"], 2))


def test_position_history(spark):
    changes = history(spark)
    one = [tuple(r) for r in changes.where("position_id = 1").orderBy("sort_by").select("change_type", "net_qty").collect()]
    assert one == [("insert", 250.0), ("update_preimage", 250.0), ("update_postimage", 900.0)]
    assert changes.count() == 7
    assert sorted(map(tuple, scd1(changes, ["position_id"]).collect())) == sorted(LATER)


def test_versions(spark):
    rows = scd2(history(spark), ["position_id"]).where("position_id = 1").orderBy("valid_from").collect()
    assert [(r["net_qty"], r["is_current"]) for r in rows] == [(250.0, False), (900.0, True)]
    assert rows[0]["valid_to"] == rows[1]["valid_from"]


def brute_current(rows):
    state = {}
    for key, value, kind, seq in sorted((r for r in rows if r[2] and r[2] != "update_preimage"), key=lambda r: r[3]):
        state[key] = (key, value) if kind != "delete" else None
    return sorted(v for v in state.values() if v)


def brute_versions(rows):
    out = []
    kept = sorted((r for r in rows if r[2] and r[2] != "update_preimage"), key=lambda r: (r[0], r[3]))
    for i, (key, value, kind, seq) in enumerate(kept):
        following = kept[i + 1][3] if i + 1 < len(kept) and kept[i + 1][0] == key else None
        if kind != "delete":
            out.append((key, value, seq, following, following is None))
    return sorted(out, key=str)


def random_changes(seed, n=120, keys=6):
    """Half of all changes hit one key."""
    rng = random.Random(seed)
    kinds = ["insert", "update_postimage", "update_preimage", "delete", None]
    return [(0 if rng.random() < 0.5 else rng.randrange(keys), float(i), rng.choice(kinds), i) for i in range(n)]


@SLOW
@given(st.integers(0, 10_000), st.sampled_from([1, 7, 1 << 20]))
def test_batch_equals_brute_force(spark, seed, width):
    rows = random_changes(seed)
    changes = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert sorted(map(tuple, scd1(changes, ["key"]).collect())) == brute_current(rows)
    versions = scd2(changes, ["key"], width).select("key", "value", "valid_from", "valid_to", "is_current")
    assert sorted(map(tuple, versions.collect()), key=str) == brute_versions(rows)
    half = as_of(changes, ["key"], F.lit(60)).collect()
    assert sorted(map(tuple, half)) == brute_current([r for r in rows if r[3] <= 60])


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.integers(0, 10_000))
def test_any_arrival_order(spark, tmp_path_factory, seed):
    rows = random_changes(seed)
    shuffled = random.Random(seed).sample(rows, len(rows))
    schema = spark.createDataFrame([], SCHEMA).schema
    path = str(tmp_path_factory.mktemp("table"))
    current = KeyedTable(spark, f"{path}/one", schema, ["key"])
    versions = KeyedTable(spark, f"{path}/all", schema, ["key"])
    for i in range(3):  # the streams start anew with every arrival
        spark.createDataFrame(shuffled[40 * i : 40 * i + 40], SCHEMA).write.mode("append").parquet(f"{path}/log")
        apply_latest(read_changes(spark, f"{path}/log", schema), current, f"{path}/c1")
        apply_history(read_changes(spark, f"{path}/log", schema), versions, f"{path}/c2")
    assert sorted(map(tuple, current.current().collect())) == brute_current(rows)
    found = versions.versions().select("key", "value", "valid_from", "valid_to", "is_current")
    assert sorted(map(tuple, found.collect()), key=str) == brute_versions(rows)


def test_a_repeated_batch_replaces_itself(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = KeyedTable(spark, folder + "/t", schema, ["key"])
    assert table.current().count() == 0
    batch = spark.createDataFrame([(1, 1.0, "insert", 1), (2, 1.0, "insert", 2)], SCHEMA)
    for _ in range(2):
        table.write(batch, 0)
    assert table.rows().count() == 2
    table.write(spark.createDataFrame([(1, 9.0, "insert", 1)], SCHEMA), 0)
    assert [tuple(r) for r in table.current().collect()] == [(1, 9.0)]


def test_a_lookup_reads_its_parts_only(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = KeyedTable(spark, folder + "/t", schema, ["key"])
    table.write(spark.createDataFrame([(i, float(i), "insert", i) for i in range(500)], SCHEMA), 0)
    wanted = spark.createDataFrame([(7,), (9999,)], "key long")
    assert [tuple(r) for r in table.current(wanted).collect()] == [(7, 7.0)]
    text = table.rows(wanted)._jdf.queryExecution().executedPlan().toString()
    filters = text.split("PartitionFilters: [")[1].split("]")[0]
    assert "part#" in filters and 1 <= filters.count(",") + 1 <= 3 < PARTS


@SLOW
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 3)), st.dictionaries(st.integers(0, 9), st.integers(0, 3)))
def test_changes_lead_to_the_new_snapshot(spark, old, new):
    schema = "key long, value double"
    a = spark.createDataFrame([(k, float(v)) for k, v in old.items()], schema)
    b = spark.createDataFrame([(k, float(v)) for k, v in new.items()], schema)
    changes = capture_changes(a, b, ["key"], 2)
    moved = {r["key"] for r in changes.collect()}
    assert moved == {k for k in old.keys() | new.keys() if old.get(k) != new.get(k)}
    everything = capture_changes(None, a, ["key"], 1).unionByName(changes)
    assert sorted(map(tuple, scd1(everything, ["key"]).collect())) == sorted((k, float(v)) for k, v in new.items())
    both = old.keys() & new.keys()
    assert tuple(reconcile(a, b, ["key"]).first()) == (
        len(old), len(new), len(old.keys() - new.keys()), len(new.keys() - old.keys()),
        sum(old[k] != new[k] for k in both), sum(old[k] == new[k] for k in both),
    )


def test_delete_then_late_update_then_insert(spark, folder):
    schema = spark.createDataFrame([], SCHEMA).schema
    table = KeyedTable(spark, folder + "/t", schema, ["key"])

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(folder + "/log")
        apply_latest(read_changes(spark, folder + "/log", schema), table, folder + "/c")
        return [tuple(r) for r in table.current().collect()]

    assert arrive([(1, 1.0, "insert", 1), (1, 1.0, "delete", 5)]) == []
    assert arrive([(1, 2.0, "update_postimage", 3)]) == []
    assert arrive([(1, 3.0, "insert", 7)]) == [(1, 3.0)]


def test_only_changed_rows_move(spark, folder):
    reference = "client_id string, risk_limit_cad double"
    old = spark.createDataFrame([(f"CL-{i}", 250e6) for i in range(9)], reference)
    new = update_where(old, F.col("client_id") == "CL-3", {"risk_limit_cad": F.lit(300e6)})
    first = capture_changes(None, old, ["client_id"], 1)
    table = KeyedTable(spark, folder + "/t", first.schema, ["client_id"])
    sizes = []
    for changes in (first, capture_changes(old, new, ["client_id"], 2)):
        changes.write.mode("append").parquet(folder + "/feed")
        apply_latest(read_changes(spark, folder + "/feed", first.schema), table, folder + "/checkpoint")
        sizes.append(table.rows().count())
    assert sizes == [9, 10]
    assert {r["client_id"]: r["risk_limit_cad"] for r in table.current().collect()}["CL-3"] == 300e6
    assert table.current().count() == 9


def test_a_stream_without_files_gives_no_rows(spark, base, folder):
    read_table(spark, base, "events").limit(0).write.parquet(folder + "/events.parquet")
    read_table(spark, base, "conversations").limit(0).write.parquet(folder + "/conversations.parquet")
    for name in ("stream_change_scan", "scd1_stream", "scd1_state_store", "thread_state_stream"):
        assert QUERIES[name](spark, folder).count() == 0


def test_upsert(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "id long, name string, v double")
    new = spark.createDataFrame([(2, "c", None), (3, "d", 4.0)], "id long, name string, v double")
    assert sorted(map(tuple, upsert(old, new, ["id"]).collect())) == [(1, "a", 1.0), (2, "c", None), (3, "d", 4.0)]


@pytest.mark.parametrize("condition, expected", [("v > 1", [1.0, 0.0, None]), ("v is null", [1.0, 2.0, 0.0])])
def test_update_where(spark, condition, expected):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, None)], "id long, v double")
    rows = update_where(df, F.expr(condition), {"v": F.lit(0.0)}).orderBy("id").collect()
    assert [r["v"] for r in rows] == expected


def test_a_table_of_many_files_streams_whole(spark, base, folder):
    events = read_table(spark, base, "events")
    events.repartition(5, "event_id").write.parquet(folder + "/events.parquet")
    seen = []
    run_apply(stream_table(spark, folder, "events"), lambda batch, i: seen.append(batch.count()), folder + "/c")
    assert sum(seen) == events.count()
    current = QUERIES["scd1_stream"](spark, folder).collect()
    assert sorted(map(tuple, current)) == sorted(map(tuple, QUERIES["scd1_stream"](spark, base).collect()))
