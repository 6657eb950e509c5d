"""Change streams applied to keyed tables.

The newest change per key is held in Spark's own state store by a streaming aggregation; what it
emits is written below one folder, by batch and by a hash of the key. A repeated batch replaces
itself. A reader takes the row with the highest sequence per key, so the order of arrival and
restarts do not matter, deletes stay as rows, and a reader of given keys reads their parts only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from ..operators.cdc import drop_deleted, effective, latest_change, scd2
from ..operators.ordered import next_in_key

PARTS = 16


def newest_per_key(changes: DataFrame, keys: list[str]) -> DataFrame:
    """A stream of the newest change of each key so far, emitted when a batch has changes of it.

    The state keeps one row per key, and each task of a batch one row per key before the shuffle,
    so a frequent key needs no more room than any other.
    """
    return latest_change(effective(changes), keys)


def part_of(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")


class KeyedTable:
    """Change rows below one folder on shared storage, in parts by a hash of the key."""

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str]):
        self.spark, self.path, self.schema, self.keys = spark, path, schema, keys
        # there is a table to read before the first batch is written
        self._write(spark.createDataFrame([], schema), "none")

    def _write(self, rows: DataFrame, batch: str) -> None:
        parts = rows.select(*self.schema.names, part_of(self.keys).alias("part"))
        parts.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/batch={batch}")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch; writing it again has no further effect."""
        self._write(batch, str(batch_id))

    def rows(self, wanted: DataFrame | None = None) -> DataFrame:
        """All change rows, or those of the keys in `wanted`, whose parts alone are read."""
        schema = StructType([*self.schema.fields, StructField("batch", StringType()), StructField("part", IntegerType())])
        rows = self.spark.read.schema(schema).parquet(self.path)
        if wanted is not None:
            # at most as many numbers as there are parts
            parts = [r[0] for r in wanted.select(part_of(self.keys)).distinct().collect()]
            rows = rows.where(F.col("part").isin(parts)).join(wanted.select(*self.keys).distinct(), self.keys, "left_semi")
        return rows.select(*self.schema.names)

    def state(self, wanted: DataFrame | None = None) -> DataFrame:
        """Latest change per key with its sequence, deletes included."""
        return latest_change(effective(self.rows(wanted)), self.keys)

    def current(self, wanted: DataFrame | None = None) -> DataFrame:
        return drop_deleted(self.state(wanted))

    def versions(self) -> DataFrame:
        """All versions with their validity; a change that arrived twice counts once."""
        return scd2(self.rows().dropDuplicates([*self.keys, "sort_by"]), self.keys)


def drop_bookkeeping(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Stream or batch without bookkeeping columns and pre-images."""
    return effective(changes.drop(*columns))


def start_apply(
    stream: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Runs until what is there now is done, or continuously at an interval."""
    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).outputMode(mode)
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def run_apply(
    stream: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    interval: str | None = None,
    mode: str = "append",
) -> None:
    query = start_apply(stream, apply, checkpoint, interval, mode)
    try:
        if interval:
            query.processAllAvailable()
        else:
            query.awaitTermination()
    finally:
        query.stop()


def apply_latest(stream: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = None) -> None:
    """Keeps `table` at the newest change of every key of the stream."""
    run_apply(newest_per_key(stream, table.keys), table.write, checkpoint, interval, "update")


def apply_history(stream: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = None) -> None:
    """Keeps every change of the stream in `table`."""
    run_apply(effective(stream), table.write, checkpoint, interval)


def read_changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def ranges_of(changes: DataFrame, bounds: list[int]) -> list[DataFrame]:
    """The changes cut at the bounds of their sequence, in order."""
    edges = [None, *bounds, None]
    parts = []
    for low, high in zip(edges, edges[1:]):
        part = changes
        if low is not None:
            part = part.where(F.col("sort_by") >= low)
        if high is not None:
            part = part.where(F.col("sort_by") < high)
        parts.append(part)
    return parts


def arrive_and_apply(
    arrivals: list[DataFrame], log: str, table: KeyedTable, checkpoint: str, interval: str | None = None, apply=apply_latest
) -> None:
    """Appends each part to the change folder and applies what is new in it."""
    for part in arrivals:
        part.write.mode("append").parquet(log)
        apply(read_changes(table.spark, log, table.schema), table, checkpoint, interval)


class VersionTable:
    """Every version of every key with its validity, kept up as changes arrive in any order.

    Rows lie in parts by a hash of the key, and a part has one folder that is read. A batch reads the parts that its
    keys fall into, recomputes the validity of those keys alone, and writes these parts anew below its own number; a
    small table says which batch wrote each part last. Other parts are neither read nor written, so a batch costs what
    its parts hold, however long the history is. A repeated batch starts from the table of the batch before it and
    replaces itself. Deletes stay as rows, since a late change may come before one. Changes with a null key are left out.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: list[str], parts: int = PARTS):
        self.spark, self.path, self.keys, self.parts = spark, path, keys, parts
        self.schema = schema
        self.stored = StructType([*schema.fields, StructField("valid_to", LongType()), StructField("part", IntegerType())])
        self._write_owners(-1, {})

    def _part(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int")

    def _write_owners(self, batch_id: int, owners: dict[int, int]) -> None:
        rows = self.spark.createDataFrame(sorted(owners.items()), "part int, owner long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/owners/batch={batch_id}")

    def owners(self, before: int | None = None) -> dict[int, int]:
        """The batch that wrote each part last; at most as many rows as there are parts."""
        rows = self.spark.read.schema("part int, owner long, batch long").parquet(f"{self.path}/owners")
        if before is not None:
            rows = rows.where(F.col("batch") < before)
        last = rows.agg(F.max("batch")).first()[0]
        return {r["part"]: r["owner"] for r in rows.where(F.col("batch") == F.lit(last)).collect()}

    def _read(self, owners: dict[int, int]) -> DataFrame:
        if not owners:
            return self.spark.createDataFrame([], self.stored)
        paths = [f"{self.path}/rows/batch={batch}/part={part}" for part, batch in sorted(owners.items())]
        return self.spark.read.schema(self.stored).option("basePath", f"{self.path}/rows").parquet(*paths).select(*self.stored.names)

    def write(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of changes."""
        new = effective(batch).dropna(subset=self.keys).select(*self.schema.names, self._part().alias("part"))
        touched = [r[0] for r in new.select("part").distinct().collect()]  # at most all parts
        owners = self.owners(batch_id)
        old = self._read({p: owners[p] for p in touched if p in owners})
        hit = new.select(*self.keys).distinct().withColumn("__hit", F.lit(True))
        marked = old.join(hit, self.keys, "left")
        redo = marked.where("__hit").select(*self.schema.names, "part").unionByName(new).dropDuplicates([*self.keys, "sort_by"])
        redone = next_in_key(redo, self.keys, "sort_by", "valid_to")
        out = marked.where("__hit is null").select(*self.stored.names).unionByName(redone.select(*self.stored.names))
        # a part is cut by key, so that it is written by several tasks
        out.repartition("part", F.pmod(F.xxhash64("sort_by"), F.lit(4))).write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/rows/batch={batch_id}")
        self._write_owners(batch_id, owners | {p: batch_id for p in touched})

    def rows(self, wanted: DataFrame | None = None) -> DataFrame:
        """Change rows with valid_to, deletes included: all, or those of the keys in `wanted`, whose parts alone are read."""
        owners = self.owners()
        if wanted is None:
            return self._read(owners).drop("part")
        parts = {r[0] for r in wanted.select(self._part()).distinct().collect()}
        found = self._read({p: b for p, b in owners.items() if p in parts})
        return found.join(wanted.select(*self.keys).distinct(), self.keys, "left_semi").select(*self.stored.names).drop("part")

    def versions(self, wanted: DataFrame | None = None) -> DataFrame:
        """All versions with their validity, as scd2 gives them."""
        kept = self.rows(wanted).where("change_type <> 'delete'").withColumnRenamed("sort_by", "valid_from")
        return kept.withColumn("is_current", F.col("valid_to").isNull()).drop("change_type")


def apply_versions(stream: DataFrame, table: VersionTable, checkpoint: str, interval: str | None = None) -> None:
    """Keeps `table` at all versions of the stream's keys."""
    run_apply(stream, table.write, checkpoint, interval)


ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_newest(stream: DataFrame, keys: list[str], checkpoint: str) -> None:
    """Holds the newest change of each key in RocksDB below `checkpoint` and writes nothing else."""
    spark, name = stream.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKS)
    try:
        query = (
            newest_per_key(stream, keys).writeStream.format("noop").outputMode("update")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def newest_from_state(spark: SparkSession, checkpoint: str, schema: StructType, keys: list[str], batch_id: int | None = None) -> DataFrame:
    """The newest change of each key as the state store below `checkpoint` holds it, deletes included; now or after a batch."""
    reader = spark.read.format("statestore").option("path", checkpoint)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load()
    # the aggregate's buffer: the row, and the sequence it has
    row = F.col("value")[state.schema["value"].dataType.names[0]]
    return state.select("key.*", row.alias("row")).toDF(*keys, "row").select(*keys, "row.*").select(*schema.names)
