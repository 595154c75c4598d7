"""Tables of the lake in the session catalog."""

from __future__ import annotations

import logging

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import schemas
from feedlake.sources.inventory import list_files
from feedlake.sources.zones import PROCESSED_BY, is_missing, raw_path

log = logging.getLogger(__name__)

# The raw tables show these columns of whatever the feed delivers.
RAW_VIEW = (
    "id string, content string, old_content string, author string, collected_at timestamp, "
    "keywords array<string>, categories array<string>, is_remapped boolean"
)


def _external(
    spark: SparkSession, name: str, fmt: str, location: str, columns: str, partition: str | None = None
) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    by = f"PARTITIONED BY ({partition})" if partition else ""
    where = location.replace("'", "\\'")
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {fmt} {by} LOCATION '{where}'")
    if partition:
        recover(spark, name)


def recover(spark: SparkSession, name: str) -> None:
    """Find the partitions that were written since; those that vanished stay listed."""
    spark.catalog.recoverPartitions(name)


def register_catalog(
    spark: SparkSession,
    database: str,
    raw: str | None = None,
    processed: str | None = None,
    curated: str | None = None,
    sources=schemas.FEEDS,
) -> list[str]:
    """Create the external tables of the zones given; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    post_columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.POST.fields)
    for source in sources:
        if raw:
            names.append(f"raw_{source}")
            _external(spark, f"{database}.raw_{source}", "json", raw_path(raw, source), RAW_VIEW)
        if processed:
            names.append(f"processed_{source}")
            _external(
                spark,
                f"{database}.processed_{source}",
                "parquet",
                f"{processed}/{source}",
                post_columns + ", ingest_batch bigint",
                ", ".join(PROCESSED_BY),
            )
    if curated:
        for table, (_, columns, by_source) in schemas.CURATED.items():
            names.append(table)
            _external(
                spark,
                f"{database}.{table}",
                "parquet",
                schemas.curated_path(curated, table),
                columns + ", aggregated_at timestamp",
                "source" if by_source else None,
            )
    return names


def discover_schema(spark: SparkSession, path: str, filled: bool = False) -> DataFrame:
    """The merged columns of all Parquet files below ``path``: (column, type).

    Names and types come from the footers alone.  ``filled`` reads the data and adds the
    number of rows that have a value.
    """
    df = spark.read.option("mergeSchema", True).parquet(path)
    types = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if not filled:
        return spark.createDataFrame(types, "column string, type string")
    counts = df.agg(*[F.count(F.col(f"`{name}`")).alias(name) for name, _ in types])
    type_of = F.create_map(*[F.lit(x) for pair in types for x in pair])
    return counts.unpivot([], [name for name, _ in types], "column", "filled_rows").select(
        "column", F.element_at(type_of, F.col("column")).alias("type"), "filled_rows"
    )


def update_table(spark: SparkSession, name: str, path: str) -> list[str]:
    """Add the columns that the files below ``path`` have and the table lacks; returns their names.

    Columns that no file has any more stay in the table and are only logged.
    """
    found = spark.read.option("mergeSchema", True).parquet(path).schema
    known = {c.name.lower() for c in spark.catalog.listColumns(name)}
    added = [f for f in found.fields if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    gone = known - {f.name.lower() for f in found.fields}
    if gone:
        log.warning("%s: no file has %s", name, ", ".join(sorted(gone)))
    return [f.name for f in added]


# --- crawling ------------------------------------------------------------------------

# Types that hold all values of the ones before them.
_WIDENING = (
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()),
    (T.FloatType(), T.DoubleType()),
    (T.ByteType(), T.ShortType(), T.IntegerType(), T.DoubleType()),
)


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The type that holds the values of both; None if there is none."""
    if a == b:
        return a
    for order in _WIDENING:
        if a in order and b in order:
            return max(a, b, key=order.index)
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        element = wider(a.elementType, b.elementType)
        return element and T.ArrayType(element)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key, value = wider(a.keyType, b.keyType), wider(a.valueType, b.valueType)
        return T.MapType(key, value) if key and value else None
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        fields, conflicts = _merge(a, b)
        return None if conflicts else T.StructType(fields)
    return None


def _merge(a: T.StructType, b: T.StructType) -> tuple[list[T.StructField], list[tuple[str, str, str]]]:
    """The fields of both, in their widest types, and those without one: name and both types."""
    fields, conflicts = {f.name.lower(): f for f in a.fields}, []
    for f in b.fields:
        known = fields.get(f.name.lower())
        if known is None:
            fields[f.name.lower()] = f
        elif (both := wider(known.dataType, f.dataType)) is None:
            conflicts.append((known.name, known.dataType.simpleString(), f.dataType.simpleString()))
        else:
            fields[f.name.lower()] = T.StructField(known.name, both)
    return list(fields.values()), conflicts


def crawl_schema(spark: SparkSession, path: str) -> tuple[T.StructType, list[tuple[str, str, str]]]:
    """The merged columns of all Parquet files below ``path``, in types that hold the values of all, and the conflicts.

    Spark merges the footers of many files in a job of its own, but gives up on different types.  The list of files is then halved until
    each part agrees, so there are a few jobs for each change of a column's type, not one per file.
    """
    files = [r.path for r in list_files(spark, path).where(F.col("path").endswith(".parquet")).orderBy("path").collect()]

    def merged(part: list[str]) -> tuple[T.StructType, list[tuple[str, str, str]]]:
        try:
            return spark.read.option("mergeSchema", True).option("recursiveFileLookup", True).parquet(*part).schema, []
        except (PySparkException, Py4JJavaError) as e:  # depending on where the footers were merged
            if len(part) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
                raise
        (a, x), (b, y) = merged(part[: len(part) // 2]), merged(part[len(part) // 2 :])
        fields, conflicts = _merge(a, b)
        return T.StructType(fields), sorted({*x, *y, *conflicts})

    return merged(files) if files else (T.StructType(), [])


def crawl_catalog(
    spark: SparkSession,
    database: str,
    processed: str | None = None,
    curated: str | None = None,
    sources=schemas.FEEDS,
) -> DataFrame:
    """Bring the tables of the zones in line with their files; (table, column, type, change) of all their columns.

    ``change``: ``kept``, ``added``, ``widened``, ``vanished`` (no file has it any more; it stays, as NULL), or ``conflict`` (files of
    a type that the table's cannot hold; the table keeps its own).  Tables that the catalog lacks are made.  Folders that are
    not there yet, or hold no file, are left out.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    places = {f"processed_{s}": (f"{processed}/{s}", PROCESSED_BY) for s in sources} if processed else {}
    for table, (_, _, by_source) in schemas.CURATED.items() if curated else ():
        places[table] = (schemas.curated_path(curated, table), ("source",) if by_source else ())
    report = []
    for table, (path, by) in places.items():
        try:
            found, conflicts = crawl_schema(spark, path)
        except AnalysisException as e:
            if not is_missing(e):
                raise
            continue
        name = f"{database}.{table}"
        if not found.fields and not spark.catalog.tableExists(name):
            continue
        declared = spark.table(name).schema if spark.catalog.tableExists(name) else T.StructType()
        known = T.StructType([f for f in declared.fields if f.name not in by])
        fields, disputed = _merge(known, T.StructType([f for f in found.fields if f.name not in by]))
        kinds = {"source": "string", "ingest_batch": "bigint"}
        columns = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + [f"{c} {kinds[c]}" for c in by])
        _external(spark, name, "parquet", path, columns, ", ".join(by) or None)
        before, there = {f.name: f.dataType for f in known.fields}, {f.name.lower() for f in found.fields}
        wrong = {c[0] for c in conflicts + disputed}
        for f in fields:
            change = (
                "conflict" if f.name in wrong
                else "added" if f.name not in before
                else "vanished" if f.name.lower() not in there
                else "widened" if f.dataType != before[f.name]
                else "kept"
            )
            report.append((table, f.name, f.dataType.simpleString(), change))
        for column, one, other in conflicts + disputed:
            log.warning("%s.%s: files of type %s and of type %s", table, column, one, other)
    return spark.createDataFrame(report, "`table` string, `column` string, type string, change string")


def refresh_tables(spark: SparkSession, database: str, names) -> None:
    """Pick up new files and partitions of the tables."""
    for name in names:
        full = f"{database}.{name}"
        spark.catalog.refreshTable(full)
        if any(c.isPartition for c in spark.catalog.listColumns(full)):
            recover(spark, full)
