"""Appends in batches whose generated keys go on where the last batch ended."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .ordered import PLACED, part_sizes, place_rows


class NumberedTable:
    """A folder of batches; each batch holds the block of keys that follows the blocks of the batches before it.

    Rows are written once, with their range partition and their place in it. The block of every batch is stored beside
    them after that: a row for each partition with its first key and its size, and the folder that the rows are in. A
    batch takes its first key from the blocks of lower batch ids. A repeated batch thus gets the keys it had and
    replaces itself; a batch that died before its block was stored is redone, and until then its rows are not read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, order: list[str], name: str, start: int = 1):
        self.spark, self.path, self.order, self.name, self.start = spark, path, order, name, start
        self.schema = StructType([*schema.fields, StructField(name, LongType())])
        self.placed = StructType([*[f for f in schema.fields if f.name != name], *PLACED])
        self._write_block(-1, "", start, [])

    def _write_block(self, batch_id: int, folder: str, first: int, sizes: list[tuple[int, int]]) -> None:
        rows = []
        for part, n in sizes or [(0, 0)]:
            rows.append((folder, part, first, n))
            first += n
        block = self.spark.createDataFrame(rows, "folder string, __part int, first long, n long")
        block.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/blocks/batch={batch_id}")

    def _parts(self) -> DataFrame:
        return self.spark.read.schema("folder string, __part int, first long, n long, batch long").parquet(f"{self.path}/blocks")

    def blocks(self) -> DataFrame:
        """batch, first and n of every batch that is whole."""
        return self._parts().groupBy("batch").agg(F.min("first").alias("first"), F.sum("n").alias("n")).select("first", "n", "batch")

    def _drop_but(self, batch_id: int, folder: str) -> None:
        """Removes what earlier writers of the batch left."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/rows/batch={batch_id}")
        fs = path.getFileSystem(conf)
        for found in fs.listStatus(path):
            if found.getPath().getName() != folder:
                fs.delete(found.getPath(), True)

    def append(self, rows: DataFrame, batch_id: int) -> None:
        """Numbers the rows of one batch in a total order and stores them; the same batch again changes nothing."""
        names = [f.name for f in self.schema.fields if f.name != self.name]
        before = self.blocks().where(F.col("batch") < batch_id).agg(F.max(F.col("first") + F.col("n"))).first()[0]
        first = self.start if before is None else before
        folder = f"written-{uuid.uuid4().hex}"
        target = f"{self.path}/rows/batch={batch_id}/{folder}"
        place_rows(rows.select(*names), self.order).write.parquet(target)
        sizes = part_sizes(self.spark.read.schema(self.placed).parquet(target))
        held = self.blocks().where((F.col("batch") == batch_id) & (F.col("n") > 0)).first()
        later = self.blocks().where((F.col("batch") > batch_id) & (F.col("n") > 0)).limit(1).count()
        if held and later:
            n = sum(n for _, n in sizes)
            if (held["first"], held["n"]) != (first, n):
                raise ValueError(f"batch {batch_id} had {held['n']} rows from {held['first']}, now {n} from {first}; later keys follow them")
        self._write_block(batch_id, folder, first, sizes)
        self._drop_but(batch_id, folder)

    def rows(self) -> DataFrame:
        """The rows of all batches that are whole."""
        whole = self._parts().where("n > 0")
        paths = [f"{self.path}/rows/batch={r['batch']}/{r['folder']}" for r in whole.select("batch", "folder").distinct().collect()]  # one for each batch
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        # the parts are few and small, so Spark sends them to the rows
        parts = whole.select("folder", "__part", "first")
        rows = self.spark.read.schema(self.placed).parquet(*paths).withColumn("folder", F.regexp_extract(F.col("_metadata.file_path"), "written-[0-9a-f]{32}(?=/[^/]*$)", 0))
        return rows.join(parts, ["folder", "__part"]).withColumn(self.name, F.col("first") + F.col("__place")).select(*self.schema.names)
