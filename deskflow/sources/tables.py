"""Schemas of the input tables and their readers.

Reading with a declared schema keeps Spark from opening file footers on the driver
before every query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import base_name

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{base}/{name}.parquet")


def stream_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """The same table as a stream of its files; the table is one file or a folder of files."""
    reader = spark.readStream.schema(SCHEMAS[name])
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{name}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getFileStatus(path).isDirectory():
        return reader.parquet(f"{base}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(base)


def count_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its name and its row count."""
    counts = [
        df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Text files of a folder, one row per file with its name and whole text."""
    return spark.read.text(path, wholetext=True).select(
        base_name(F.col("_metadata.file_path")).alias("source"), F.col("value").alias("text")
    )


def write_document_files(docs: DataFrame, path: str, by: list[str], per_file: int = 1000) -> None:
    """Documents as files of at most `per_file` JSON lines below folders named by the columns `by`."""
    body = F.to_json(F.struct(*[c for c in docs.columns if c not in by]))
    writer = docs.select(body.alias("value"), *by).write.option("maxRecordsPerFile", per_file).option("lineSep", "\n")
    writer.mode("overwrite").partitionBy(*by).text(path)


def read_document_files(spark: SparkSession, path: str, schema: str, folders: str, names: str = "*.txt") -> DataFrame:
    """Documents of the files below `path`, with the folder columns and the file each came from.

    Files come through Spark's binaryFile source: a name filter and conditions on folder columns choose files before
    any is opened, and a file's bytes are decoded where it is read.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", names)
    files = reader.schema(f"path string, modificationTime timestamp, length long, content binary, {folders}").load(path)
    line = F.explode(F.split(F.decode("content", "UTF-8"), "\n")).alias("line")
    kept = [c.split(" ")[0] for c in folders.split(", ")]
    rows = files.select(*kept, base_name(F.col("path")).alias("file"), line).where("line <> ''")
    return rows.select(F.from_json("line", schema).alias("d"), *kept, "file").select("d.*", *kept, "file")


def slices(column: str, lower: int, upper: int, parts: int) -> list[str]:
    """Predicates that cut a key range into disjoint reads; NULL keys go with the first."""
    if parts < 2 or upper <= lower:
        return ["1 = 1"]
    width = max(1, (upper - lower + 1) // parts)
    cuts = [lower + width * i for i in range(1, parts) if lower + width * i <= upper]
    first = [f"{column} < {cuts[0]} or {column} is null"]
    middle = [f"{column} >= {a} and {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return first + middle + [f"{column} >= {cuts[-1]}"]


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int = 1,
) -> DataFrame:
    """A row-store table in parallel slices; filters on the result are pushed to the store."""
    if column and bounds and parts > 1:
        return spark.read.jdbc(url, table, predicates=slices(column, *bounds, parts), properties=properties)
    return spark.read.jdbc(url, table, properties=properties)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str], connections: int) -> None:
    """Snapshot into a row store: rows replaced, table definition kept.

    Spark opens no more than `connections` at a time; rows are dealt to them by a shuffle, so what
    makes the rows keeps all its tasks.
    """
    df.repartition(connections).write.option("truncate", "true").jdbc(
        url, table, mode="overwrite", properties=properties
    )
