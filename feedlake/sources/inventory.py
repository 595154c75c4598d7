"""What lies in a zone: files, sizes, lines.

The binary file source opens no file as long as its ``content`` column is not asked for.  Large
folders are listed by the executors, but the list of paths is kept by the driver, as in any scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    )


def zone_inventory(spark: SparkSession, zones: dict[str, str]) -> DataFrame:
    """Files and bytes per zone, of all files."""
    parts = [
        list_files(spark, path)
        .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .select(F.lit(zone).alias("zone"), "files", "bytes")
        for zone, path in zones.items()
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def zone_files(spark: SparkSession, path: str, prefix: str = "", n: int = 100) -> DataFrame:
    """The first files by name whose path below ``path`` starts with ``prefix``."""
    files = list_files(spark, path)
    name = F.substring_index("path", path.rstrip("/") + "/", -1)
    return (
        files.select(
            name.alias("name"),
            F.round(F.col("bytes") / 1024, 2).alias("size_kb"),
            F.date_format("modified", "yyyy-MM-dd HH:mm").alias("modified"),
        )
        .where(F.col("name").startswith(prefix))
        .orderBy("name")
        .limit(n)
    )


def raw_line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per file below ``path``."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("lines"))


def preview(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The first lines of a file."""
    return spark.read.text(path).limit(n)
