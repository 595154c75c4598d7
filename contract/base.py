"""Registry of queries, and the conversion of results to plain values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Dates, times, arrays and maps as text, so that two engines can be compared."""
    def plain(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), "|", "<null>")
        elif isinstance(f.dataType, T.MapType):
            c = F.array_join(
                F.transform(
                    F.array_sort(F.map_entries(c)),
                    lambda e: F.concat(e.key, F.lit(":"), F.array_join(e.value, ",")),
                ),
                ";",
            )
        return c.alias(f.name)

    return df.select(*[plain(f) for f in df.schema.fields])


def spread(df: DataFrame) -> DataFrame:
    """The rows in as many partitions as the caller has set under ``spark.feedlake.inputPartitions``; else as they come.

    For a small table in a single row group, whose texts one core would work through alone.
    """
    n = df.sparkSession.conf.get("spark.feedlake.inputPartitions", None)
    return df.repartition(int(n)) if n else df


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that gives the same rows if there is any."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return portable(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


# --- SQL fragments -------------------------------------------------------------------


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S.%f')"


def day(expr: str) -> str:
    return f"CAST(CAST({expr} AS DATE) AS VARCHAR)"


def arr(expr: str) -> str:
    return f"array_to_string({expr}, '|')"
