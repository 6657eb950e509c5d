"""Change data, current and versioned tables, streams and copies kept in step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cdc
from ..operators.asof import join_as_of
from ..session import work_dir
from ..sources.tables import stream_table
from ..sources.views import Desk, as_changes
from ..streaming.changes import (
    KeyedTable, VersionTable, apply_history, apply_latest, apply_versions, arrive_and_apply, drop_bookkeeping, keep_newest,
    newest_from_state, ranges_of, read_changes, run_apply,
)
from .common import book_at, features, last_year, reference, updated_reference
from .registry import query

AS_OF_WIDTH = 1 << 16  # of the sequence, in one range of a key

_CHANGES_SQL = """
SELECT client_id, instrument_id, n.net_qty, 'insert' AS change_type, CAST(4 AS BIGINT) AS sort_by
FROM v_booknew n LEFT JOIN v_bookold o USING (client_id, instrument_id) WHERE o.net_qty IS NULL
UNION ALL
SELECT client_id, instrument_id, o.net_qty, 'delete', 4
FROM v_bookold o LEFT JOIN v_booknew n USING (client_id, instrument_id) WHERE n.net_qty IS NULL
UNION ALL
SELECT client_id, instrument_id, o.net_qty, 'update_preimage', 4
FROM v_bookold o JOIN v_booknew n USING (client_id, instrument_id) WHERE n.net_qty <> o.net_qty
UNION ALL
SELECT client_id, instrument_id, n.net_qty, 'update_postimage', 5
FROM v_bookold o JOIN v_booknew n USING (client_id, instrument_id) WHERE n.net_qty <> o.net_qty"""


@query("change_capture_initial", "SELECT *, 'insert' AS change_type, CAST(2 AS BIGINT) AS sort_by FROM v_bookold")
def change_capture_initial(d: Desk):
    """The first snapshot of the book, back-filled as inserts."""
    return cdc.capture_changes(None, book_at(d, last_year(d)), ["client_id", "instrument_id"], 1)


@query("change_capture", _CHANGES_SQL)
def change_capture(d: Desk):
    """What changed between the book at the start of the last year and the book now."""
    return cdc.capture_changes(
        book_at(d, last_year(d)), book_at(d), ["client_id", "instrument_id"], 2
    )


@query("scd1_batch", "SELECT * FROM v_current")
def scd1_batch(d: Desk):
    return cdc.scd1(d.changes, ["key"])


@query("scd2_batch", "SELECT * FROM v_versions")
def scd2_batch(d: Desk):
    return cdc.scd2(d.changes, ["key"])


@query(
    "book_as_of",
    """SELECT * EXCLUDE (change_type, sort_by) FROM (
         SELECT * FROM v_effective WHERE sort_by <= (SELECT max(event_id) // 2 FROM events)
         QUALIFY row_number() OVER (PARTITION BY key ORDER BY sort_by DESC) = 1)
       WHERE change_type <> 'delete'""",
)
def book_as_of(d: Desk):
    """State half way along the sequence."""
    half = d.table("events").agg(F.floor(F.max("event_id") / 2)).scalar()
    return cdc.as_of(d.changes, ["key"], half)


@query(
    "change_history",
    """SELECT key, value, k, change_type, sort_by FROM v_changes
       WHERE key IN (SELECT DISTINCT key FROM v_changes ORDER BY key DESC LIMIT 3)""",
)
def change_history(d: Desk):
    """The changes of given keys, here the three highest, in order; only the parts that hold them are read."""
    changes = d.changes.drop("changed_at")
    table = KeyedTable(d.spark, f"{work_dir(d.spark, 'history')}/table", changes.schema, ["key"])
    table.write(changes, 0)
    wanted = changes.select("key").distinct().orderBy(F.desc("key")).limit(3)
    return table.rows(wanted).select("key", "value", "k", "change_type", "sort_by").orderBy("key", "sort_by")


# --- streams --------------------------------------------------------------


def change_stream(d: Desk) -> DataFrame:
    return as_changes(stream_table(d.spark, d.base, "events"))


def quarters(d: Desk) -> list[int]:
    """Three cuts of the sequence into about equal parts."""
    low, high = d.table("events").agg(F.min("event_id"), F.max("event_id")).first()
    return [low + (high - low + 1) * i // 4 for i in (1, 2, 3)]


def drained(d: Desk, name: str, stream: DataFrame) -> DataFrame:
    """Everything a stateless stream emits, read back from where it was written."""
    path = work_dir(d.spark, name)

    def write(batch: DataFrame, batch_id: int | str) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")

    schema = stream.schema
    write(d.spark.createDataFrame([], schema), "none")
    run_apply(stream, write, f"{path}/checkpoint")
    return d.spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names)


def keyed_table(d: Desk, name: str, schema, keys=("key",)) -> tuple[KeyedTable, str]:
    path = work_dir(d.spark, name)
    return KeyedTable(d.spark, f"{path}/table", schema, list(keys)), f"{path}/checkpoint"


@query("stream_change_scan", "SELECT * FROM v_changes")
def stream_change_scan(d: Desk):
    return drained(d, "scan", change_stream(d))


@query("stream_filter", "SELECT * EXCLUDE (changed_at) FROM v_effective")
def stream_filter(d: Desk):
    return drained(d, "filter", drop_bookkeeping(change_stream(d), ["changed_at"]))


@query("scd1_stream", "SELECT * EXCLUDE (changed_at) FROM v_current")
def scd1_stream(d: Desk):
    """A change stream applied as a current-state table."""
    stream = drop_bookkeeping(change_stream(d), ["changed_at"])
    table, checkpoint = keyed_table(d, "scd1", stream.schema)
    apply_latest(stream, table, checkpoint)
    return table.current()


def replay(d: Desk, name: str, apply=apply_latest, reverse: bool = False) -> KeyedTable:
    """The changes in four arrivals, each applied before the next; the stream restarts each time."""
    arrivals = ranges_of(d.changes, quarters(d))
    table, checkpoint = keyed_table(d, name, d.changes.schema)
    arrive_and_apply(
        arrivals[::-1] if reverse else arrivals, work_dir(d.spark, f"{name}-log"), table, checkpoint, apply=apply
    )
    return table


@query("scd1_out_of_order", "SELECT * FROM v_current")
def scd1_out_of_order(d: Desk):
    """The newest changes arrive first; later batches with lower sequences must lose."""
    return replay(d, "disorder", reverse=True).current()


@query(
    "scd1_deletes",
    """SELECT key, sort_by, change_type = 'delete' AS deleted FROM v_effective
       QUALIFY row_number() OVER (PARTITION BY key ORDER BY sort_by DESC) = 1""",
)
def scd1_deletes(d: Desk):
    """The latest sequence of every key, and whether it is a delete."""
    state = replay(d, "deletes").state()
    return state.select("key", "sort_by", (F.col("change_type") == "delete").alias("deleted"))


@query("scd2_stream", "SELECT * FROM v_versions")
def scd2_stream(d: Desk):
    """Versions from a stream whose batches arrive in reverse."""
    return replay(d, "scd2", apply_history, reverse=True).versions()


@query(
    "scd1_multi_entity",
    """WITH byk AS (SELECT k AS key, value, change_type, sort_by FROM v_effective),
            byuser AS (SELECT key, value, change_type, sort_by FROM v_effective)
       SELECT 'user' AS entity, key, value FROM (SELECT * FROM byuser
              QUALIFY row_number() OVER (PARTITION BY key ORDER BY sort_by DESC) = 1) WHERE change_type <> 'delete'
       UNION ALL
       SELECT 'k', CAST(key AS BIGINT), value FROM (SELECT * FROM byk
              QUALIFY row_number() OVER (PARTITION BY key ORDER BY sort_by DESC) = 1) WHERE change_type <> 'delete'""",
)
def scd1_multi_entity(d: Desk):
    """One flow for two entities that differ only in source and key."""
    tables = []
    for entity, key in (("user", "key"), ("k", "k")):
        stream = change_stream(d).select(
            F.col(key).cast("long").alias("id"), "value", "change_type", "sort_by"
        )
        table, checkpoint = keyed_table(d, f"entity-{entity}", stream.schema, ["id"])
        apply_latest(stream, table, checkpoint)
        tables.append(table.current().select(F.lit(entity).alias("entity"), F.col("id").alias("key"), "value"))
    return tables[0].unionByName(tables[1])


@query("stream_resume", "SELECT * FROM v_current")
def stream_resume(d: Desk):
    """A stopped stream restarted from its checkpoint reads only what was added since."""
    halves = ranges_of(d.changes, quarters(d)[1:2])
    table, checkpoint = keyed_table(d, "resume", d.changes.schema)
    arrive_and_apply(halves, work_dir(d.spark, "resume-log"), table, checkpoint)
    return table.current()


@query("scd1_state_store", "SELECT * EXCLUDE (changed_at) FROM v_current")
def scd1_state_store(d: Desk):
    """The state store's content, read from the stream's checkpoint; no batch writes rows anywhere."""
    stream = drop_bookkeeping(change_stream(d), ["changed_at"])
    checkpoint = f"{work_dir(d.spark, 'state')}/checkpoint"
    keep_newest(stream, ["key"], checkpoint)
    return cdc.drop_deleted(newest_from_state(d.spark, checkpoint, stream.schema, ["key"]))


@query(
    "state_after_half",
    """WITH half AS (SELECT min(event_id) + (max(event_id) - min(event_id) + 1) // 2 AS h FROM events)
       SELECT key, sort_by, change_type = 'delete' AS deleted FROM v_effective, half WHERE sort_by < h
       QUALIFY row_number() OVER (PARTITION BY key ORDER BY sort_by DESC) = 1""",
)
def state_after_half(d: Desk):
    """The state as it was after the first of two arrivals, read back from the store when both are in."""
    log, checkpoint = work_dir(d.spark, "state-log"), f"{work_dir(d.spark, 'state')}/checkpoint"
    changes = d.changes.drop("changed_at")
    for part in ranges_of(changes, quarters(d)[1:2]):
        part.coalesce(1).write.mode("append").parquet(log)
        keep_newest(read_changes(d.spark, log, changes.schema), ["key"], checkpoint)
    state = newest_from_state(d.spark, checkpoint, changes.schema, ["key"], 0)
    return state.select("key", "sort_by", (F.col("change_type") == "delete").alias("deleted"))


@query("scd2_incremental", "SELECT * FROM v_versions")
def scd2_incremental(d: Desk):
    """Versions kept up batch by batch; arrivals come in reverse and one of them twice, so nearly every row is late."""
    path, schema = work_dir(d.spark, "versions"), d.changes.schema
    table = VersionTable(d.spark, f"{path}/table", schema, ["key"])
    arrivals = ranges_of(d.changes, quarters(d))[::-1]
    for part in [*arrivals, arrivals[1]]:
        part.write.mode("append").parquet(f"{path}/log")
        apply_versions(read_changes(d.spark, f"{path}/log", schema), table, f"{path}/checkpoint")
    return table.versions()


@query(
    "version_lookup",
    """SELECT * FROM v_versions WHERE key IN (SELECT DISTINCT key FROM v_effective ORDER BY key DESC LIMIT 3)""",
)
def version_lookup(d: Desk):
    """The versions of a few keys; only the parts that hold them are read."""
    table = VersionTable(d.spark, f"{work_dir(d.spark, 'versions')}/table", d.changes.schema, ["key"])
    table.write(d.changes, 0)
    wanted = cdc.effective(d.changes).select("key").distinct().orderBy(F.desc("key")).limit(3)
    return table.versions(wanted)


@query(
    "features_as_of",
    """SELECT r.event_id, r.key, v.sort_by AS valid_from, CASE WHEN v.change_type <> 'delete' THEN v.value END AS value,
              CASE WHEN v.change_type <> 'delete' THEN v.k END AS k
       FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN (SELECT min(user_id) FROM events) ELSE user_id + 1 END AS key FROM events) r
       ASOF LEFT JOIN v_effective v ON r.key = v.key AND r.event_id >= v.sort_by""",
)
def features_as_of(d: Desk):
    """Every event asks for the features of one user as they were then; a third of all ask for one user.

    The features of a deleted user are null, though it is known since when.
    """
    events = d.table("events")
    hot = events.agg(F.min("user_id").alias("hot")).scalar()
    asked = F.when(F.col("event_id") % 3 == 0, hot).otherwise(F.col("user_id") + 1)
    versions = cdc.effective(d.changes).select("key", F.col("sort_by").alias("valid_from"), "value", "k", "change_type")
    found = join_as_of(events.select("event_id", asked.alias("key")), versions, ["key"], "event_id", "valid_from", F.floor(F.col("t") / AS_OF_WIDTH))
    there = F.col("change_type") != "delete"
    return found.select("event_id", "key", "valid_from", F.when(there, F.col("value")).alias("value"), F.when(there, F.col("k")).alias("k"))


@query(
    "trade_marks_as_of",
    """SELECT f.order_id, f.line_no, f.instrument_id, f.trade_date, CASE WHEN f.trade_date - m.price_date <= 90 THEN m.price_date END AS price_date,
              CASE WHEN f.trade_date - m.price_date <= 90 THEN m.spot_price END AS spot_price
       FROM v_fills f ASOF LEFT JOIN v_marks m ON f.instrument_id = m.instrument_id AND f.trade_date >= m.price_date""",
)
def trade_marks_as_of(d: Desk):
    """Every trade with the last mark of its instrument on or before the trade's day, unless that is over 90 days old."""
    trades = d.fills.select("order_id", "line_no", "instrument_id", "trade_date")
    marks = d.marks.select("instrument_id", "price_date", "spot_price")
    old = F.expr("interval '90' day")
    return join_as_of(trades, marks, ["instrument_id"], "trade_date", "price_date", F.year("t"), most=old)


# --- copies ---------------------------------------------------------------


@query("sync_snapshot", "SELECT * FROM v_reference")
def sync_snapshot(d: Desk):
    """A full copy of the reference table, replaced as a whole."""
    path = work_dir(d.spark, "snapshot")
    source = reference(d)
    source.write.mode("overwrite").parquet(path)
    return d.spark.read.schema(source.schema).parquet(path)


def sync_reference(d: Desk, name: str, interval: str | None) -> KeyedTable:
    """First all rows, then only the changed ones, through one change folder."""
    old, new = reference(d), updated_reference(d)
    first = cdc.capture_changes(None, old, ["client_id"], 1)
    table, checkpoint = keyed_table(d, name, first.schema, ["client_id"])
    arrivals = [first, cdc.capture_changes(old, new, ["client_id"], 2)]
    arrive_and_apply(arrivals, work_dir(d.spark, f"{name}-feed"), table, checkpoint, interval)
    return table


@query("sync_triggered", "SELECT * FROM v_updated")
def sync_triggered(d: Desk):
    return sync_reference(d, "triggered", None).current()


@query("sync_continuous", "SELECT * FROM v_updated")
def sync_continuous(d: Desk):
    return sync_reference(d, "continuous", "200 milliseconds").current()


@query("publish_online", "SELECT * FROM v_features")
def publish_online(d: Desk):
    """Features published twice into a keyed copy; the second time changes nothing."""
    rows = cdc.capture_changes(None, features(d), ["client_id"], 1)
    table, _ = keyed_table(d, "online", rows.schema, ["client_id"])
    for _ in range(2):
        table.write(rows, 0)
    return table.current()


@query(
    "online_lookup",
    "SELECT * FROM v_features WHERE client_id IN (SELECT client_id FROM v_features ORDER BY gross_notional_cad DESC, client_id LIMIT 5)",
)
def online_lookup(d: Desk):
    """The published features of a few clients; only the parts that hold them are read."""
    rows = cdc.capture_changes(None, features(d), ["client_id"], 1)
    table, _ = keyed_table(d, "lookup", rows.schema, ["client_id"])
    table.write(rows, 0)
    asked = features(d).orderBy(F.desc("gross_notional_cad"), "client_id").limit(5).select("client_id")
    return table.current(asked)
