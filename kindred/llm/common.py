"""Helpers of the training-data operators: scratch tables, Arrow batches, row keys."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot if it has over a 4096th of all rows (and over 64): there are at most 4,096 of them.
HOT_SHARE, LEAST_HOT = 4096, 64
#: Rows and bytes of one Arrow batch. They bound a Python worker's memory, whatever the table's size.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Documents are large rows: keep the Arrow batches that Python workers get short."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (spark.checkpoint.dir). Only a local master may leave it unset, as
    in tests: it then gets a folder of its own. Elsewhere every executor would write to its own disk."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not got:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        got = tempfile.mkdtemp(prefix="kindred-")
        spark.conf.set("spark.checkpoint.dir", got)
    return got.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/kindred-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it again: costly steps run once, lineage is
    cut, and a lost executor costs no more than the tasks it was running."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of stored() that no plan reads any more."""
    for table_ in tables:
        for file in {f.rsplit("/", 1)[0] for f in table_.inputFiles()}:
            at = spark._jvm.org.apache.hadoop.fs.Path(file)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_key(col: str = "text") -> Column:
    """With doc_id, the identity of a row: rows that share both are copies and get the same result."""
    return F.xxhash64(F.col(col))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def frequent(counts: DataFrame, key: str, n: str) -> DataFrame:
    """The hot keys, as column hot, of a table (key, n) with a row for each key."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) > max(LEAST_HOT, total // HOT_SHARE)).select(F.col(key).alias("hot"))


def hot_join(rows: DataFrame, key: str, table: DataFrame, table_key: str, hot: DataFrame) -> DataFrame:
    """rows left join table (one row for each table_key, no null), where the rows of a hot key (see frequent())
    never meet in one task: the few rows of table that they need are broadcast, and the others are shuffled.
    Rows with a null key match nothing. Both tables are read twice, so they are to be stored ones."""
    few = F.broadcast(hot)
    wanted = table.join(few, table[table_key] == few["hot"], "left_semi")
    most = rows.join(few, rows[key] == few["hot"], "left_anti")
    return rows.join(F.broadcast(wanted), rows[key] == wanted[table_key]).unionByName(most.join(table, most[key] == table[table_key], "left"))
