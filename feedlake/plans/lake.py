"""Raw records to processed posts to curated tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators import curated
from feedlake.operators.transform import filter_future, transform_posts
from feedlake.session import brief_shuffles, scratch, write_and_reload
from feedlake.sources import seen, zones
from feedlake.streaming.live import ingest_new_files

WRITERS = 4


def curated_tables(
    activity: DataFrame, uniques: DataFrame, tags: DataFrame, iso_year: bool = False
) -> dict[str, DataFrame]:
    """The fourteen tables from the three rollups."""
    return {
        "volume_by_source": curated.volume_from_rollups(activity, uniques, "day"),
        "volume_by_week": curated.volume_from_rollups(activity, uniques, "week", iso_year),
        "volume_by_month": curated.volume_from_rollups(activity, uniques, "month"),
        "hourly_activity": curated.hourly_activity(activity),
        "remapping_stats": curated.remapping_stats(activity),
        "growth_rate": curated.growth_rate(activity),
        "content_stats": curated.content_stats(activity),
        "source_summary": curated.source_summary(activity),
        "global_summary": curated.global_summary(activity),
        "extended_summary": curated.extended_summary(activity, tags),
        "trending_keywords": curated.trending_keywords(tags),
        "trending_categories": curated.trending_categories(tags),
        "cross_source_keywords": curated.cross_source_keywords(tags),
        "keywords_by_source": curated.keywords_by_source(tags),
    }


def build_curated(
    posts: DataFrame,
    root: str,
    as_of: Column | None = None,
    iso_year: bool = False,
) -> None:
    """Write all curated tables below ``root``.

    The posts, and whatever tagging lies behind them, are gone through once: a copy without
    texts is written to the shared folder, the three rollups are made from it, and the tables
    from the rollups.  All of it is deleted when the tables are written.
    """
    spark = posts.sparkSession
    current = filter_future(posts, as_of)
    # Jobs that do not depend on each other: several at a time keep the cluster busy.
    with scratch(spark, "rollups") as folder, ThreadPoolExecutor(WRITERS) as pool:
        slim = write_and_reload(curated.slim_posts(current), f"{folder}/posts")
        rollups = {
            "activity": curated.activity_rollup(slim),
            "uniques": curated.unique_rollup(slim, iso_year),
            "tags": curated.tag_rollup(slim),
        }
        written = pool.map(lambda item: write_and_reload(item[1], f"{folder}/{item[0]}"), rollups.items())
        tables = curated_tables(*written, iso_year)
        list(pool.map(lambda item: zones.write_curated(item[1], root, item[0], as_of), tables.items()))


def ingest_source(
    spark: SparkSession,
    raw: str,
    processed: str,
    source: str,
    checkpoint: str,
    schema: str | None = None,
    discover: bool = True,
    unique: bool = False,
    **options,
) -> None:
    """Transform the raw lines of a source that no earlier run has seen, and add their posts.

    Each batch has its own partition, overwritten if the batch is run again, so that a
    failure between the write and the bookmark doubles nothing.  With ``discover``, fields
    that are not declared are columns of the records too.  Lines with something wrong are
    also kept as they came, below ``_bad``.  With ``unique``, an id that an earlier batch has
    brought gets no second post.
    """
    schema = schema or schemas.RECORDS[source]

    def process(lines: DataFrame, number: int) -> None:
        extra = zones.discover_columns(lines, schema) if discover else {}
        records = zones.parse_lines(lines, schema, extra)
        bad = records.where(F.col(zones.CORRUPT).isNotNull()).select(F.col(zones.CORRUPT).alias("value"))
        bad.write.mode("overwrite").text(f"{processed}/_bad/{source}/ingest_batch={number}")
        posts = transform_posts(records.drop(zones.CORRUPT), source, **options)
        if unique:
            known = _seen_ids(spark, processed, source, number)
            posts = seen.exclude_remembered(posts, known, source, number)
        zones.write_processed(posts, processed, source, number)
        if unique:
            written = zones.scan_processed(spark, processed, source).where(F.col("ingest_batch") == number)
            seen.remember(written.select("id"), known, source, number)

    with brief_shuffles(spark):
        ingest_new_files(spark, zones.raw_path(raw, source), checkpoint, process)


def _seen_ids(spark: SparkSession, processed: str, source: str, number: int) -> str:
    """The table of the ids of earlier batches; made of their posts where these came without it."""
    name = seen.declare(spark, f"{processed}/_seen")
    if number > 0 and spark.table(name).where(F.col("source") == source).isEmpty():
        try:
            before = zones.scan_processed(spark, processed, source).where(F.col("ingest_batch") < number)
        except AnalysisException as e:
            if not zones.is_missing(e):
                raise
        else:
            seen.remember(before.select("id"), name, source, -1)
    return name


def bad_lines(spark: SparkSession, processed: str, source: str) -> DataFrame:
    """Lines of all runs that are no JSON or hold a field of another type: ``value``, ``ingest_batch``."""
    return spark.read.schema("value string, ingest_batch bigint").text(f"{processed}/_bad/{source}")


def run_lake(
    spark: SparkSession,
    raw: str,
    processed: str,
    curated_root: str,
    as_of: Column | None = None,
    sources=schemas.FEEDS,
    **options,
) -> Mapping[str, DataFrame] | None:
    """Raw lines that came since the last run to processed, all of it to curated.

    The bookmark of each source lies beside the posts it vouches for, so a second run
    over the same lines adds nothing.  Without any post, nothing is written.
    """
    for source in sources:
        try:
            ingest_source(spark, raw, processed, source, f"{processed}/_checkpoints/{source}", now=as_of, **options)
        except AnalysisException as e:
            if not zones.is_missing(e):
                raise
    posts = zones.scan_sources(spark, processed, sources)
    if posts is None:
        return None
    build_curated(posts, curated_root, as_of)
    return zones.load_curated(spark, curated_root)
