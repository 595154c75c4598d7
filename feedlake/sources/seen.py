"""Ids that earlier batches have brought, kept in buckets: a new batch meets them where they lie.

The history is a table of Parquet files bucketed by id, with a folder per source and batch.  Joining a batch with it shuffles the
batch to the buckets and leaves the history in place, however long it has become.  A batch that is written again
replaces its own folder.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed with the first batch: the folder bears the number, as it says in which file an id is.
BUCKETS = 64


def declare(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """The name of the table below ``path``, made known to this session if it is not."""
    where = f"{path.rstrip('/')}/buckets_{buckets}"
    name = f"feedlake_seen_{hashlib.sha256(where.encode()).hexdigest()[:16]}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(where)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    if not spark.catalog.tableExists(name):
        quoted = where.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {name} (id string, source string, ingest_batch bigint) USING parquet "
            f"PARTITIONED BY (source, ingest_batch) CLUSTERED BY (id) INTO {buckets} BUCKETS LOCATION '{quoted}'"
        )
    spark.catalog.recoverPartitions(name)
    return name


def remember(ids: DataFrame, table: str, source: str, batch: int) -> None:
    """Add the ids of a batch, in place of what it has added before."""
    spark = ids.sparkSession
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {table}").where("col_name = 'Num Buckets'").first().data_type)
    rows = ids.select("id").distinct().repartition(buckets, "id")  # one file a bucket
    view = f"{table}_new"
    rows.createOrReplaceTempView(view)
    quoted = source.replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION (source = '{quoted}', ingest_batch = {batch:d}) SELECT id FROM {view}")
    spark.catalog.dropTempView(view)


def exclude_remembered(posts: DataFrame, table: str, source: str, before: int) -> DataFrame:
    """The posts whose id no batch of the source earlier than ``before`` has brought."""
    history = posts.sparkSession.table(table).where((F.col("source") == source) & (F.col("ingest_batch") < before)).select("id")
    return posts.join(history, "id", "left_anti").select(*posts.columns)
