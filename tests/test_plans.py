"""What the plans of the queries must look like."""

import re

import pytest
from pyspark.sql import functions as F

from deskflow.plans import QUERIES
from deskflow.operators.lookup import feature_lookup
from deskflow.session import shared_root, work_dir
from deskflow.sources.views import Desk

# writes tables or runs streams while it is built
EAGER = {
    "append_surrogate_key", "change_history", "feature_table_build", "gen_positions", "gen_trades", "hash_sort_join_count",
    "online_lookup", "publish_online", "scd1_deletes", "scd1_multi_entity",
    "scd1_out_of_order", "scd1_state_store", "scd1_stream", "scd2_stream", "seed_if_empty", "stream_change_scan",
    "stream_filter", "stream_resume", "sync_continuous", "sync_snapshot", "sync_triggered", "thread_state_stream",
    "vector_store", "write_overwrite_roundtrip",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_join_and_no_global_window(spark, base, name):
    text = plan(QUERIES[name](spark, base))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for window in re.findall(r"windowspecdefinition\(([^)]*)", text):
        first = window.split(",")[0]
        assert "ASC" not in first and "DESC" not in first, f"window without a key: {window}"


def test_filters_reach_the_scan(spark, base):
    assert "EqualTo(c_mktsegment,BUILDING)" in plan(QUERIES["filter_client"](spark, base))
    d = Desk(spark, base)
    assert "EqualTo(o_custkey,7)" in plan(d.fills.where("client_id = 7"))
    assert "EqualTo(l_partkey,11)" in plan(d.marks.where("instrument_id = 11"))
    assert "EqualTo(source,src3)" in plan(QUERIES["vector_search_filtered"](spark, base))


def test_only_needed_columns_are_read(spark, base):
    text = plan(QUERIES["days_since_last_trade"](spark, base))
    assert "l_extendedprice" not in text and "l_discount" not in text and "p_retailprice" not in text
    assert "part.parquet" not in plan(QUERIES["trade_calendar"](spark, base))


def test_small_threshold_turns_broadcasts_into_shuffles(spark, base):
    """No side is broadcast for any other reason than its size."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        for name in ("client_risk_features", "enrich_positions", "entity_resolve", "change_capture"):
            assert "Broadcast" not in plan(QUERIES[name](spark, base))
    finally:
        spark.conf.set(key, before)


def test_shared_folder_is_the_named_one(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_frequent_key_is_split_at_run_time(spark):
    """A third of the requests ask for one key; their join must not put them into one task."""
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        ids = spark.range(0, 200_000, 1, 20)
        asked = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") % 5000)
        requests = ids.select("id", asked.alias("client_id"), F.md5(F.col("id").cast("string")).alias("body"))
        features = ids.groupBy((F.col("id") % 5000).alias("client_id")).agg(F.max("id").alias("newest"))
        joined = feature_lookup(requests, features)
        assert len(joined.collect()) == 200_000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_cluster_must_name_its_shared_folder():
    class Named:
        def __init__(self, master, folder):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: folder)})

    assert shared_root(Named("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_root(Named("local[2]", None)) == shared_root(Named("local[2]", None))
    with pytest.raises(RuntimeError):
        shared_root(Named("yarn", None))


def test_facts_are_not_dealt_out_before_their_joins(spark, base):
    for name in ("enrich_trades", "daily_flow", "client_risk_features", "chunk_documents", "latest_mark"):
        assert "REPARTITION_BY_NUM" not in plan(QUERIES[name](spark, base))


def test_numbered_rows_are_shuffled_once(spark, folder):
    from deskflow.operators.ordered import number_rows

    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"))
    text = plan(number_rows(df, ["k"], "n", folder + "/n"))
    assert "rangepartitioning" not in text and "k#" not in "".join(x for x in text.splitlines() if "Exchange" in x)


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_sketches_are_not_kept_for_each_value(spark, base):
    assert "Expand" not in optimized(QUERIES["distinct_keys_sketch"](spark, base))


def test_scatter_chooses_orders_before_trades(spark, base):
    plan = optimized(QUERIES["trade_scatter"](spark, base))
    assert "Join LeftSemi, (o_custkey" in plan and "Join LeftSemi, (client_id" not in plan


def test_leaves_of_the_sunburst_are_not_summed_again(spark, base):
    plan = optimized(QUERIES["exposure_sunburst"](spark, base))
    (expand,) = [line for line in plan.splitlines() if "Expand" in line]
    assert "instrument_id" not in expand
