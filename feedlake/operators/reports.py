"""Report views over curated tables.  Every top-k has a total order."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Weekday numbers start on Sunday.
WEEKDAYS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")
HOURS = range(24)


def kpi_overview(global_summary: DataFrame) -> DataFrame:
    names = ("total_posts", "active_sources", "total_with_keywords", "total_remapped")
    return global_summary.select(*[F.coalesce(n, F.lit(0)).alias(n) for n in names]).limit(1)


def source_share(source_summary: DataFrame) -> DataFrame:
    """Posts and share of all posts per source, smallest first."""
    total = source_summary.agg(F.sum("total_posts")).scalar()
    return source_summary.select(
        "source", "total_posts", (F.col("total_posts") / total).alias("share")
    ).orderBy("total_posts", "source")


def top_keywords(trending: DataFrame, n: int = 10) -> DataFrame:
    """The rows, one per day and keyword, with the most mentions."""
    return trending.orderBy(F.desc("mentions"), F.desc("date"), "keyword").limit(n)


def available_dates(trending: DataFrame) -> DataFrame:
    return trending.select("date").distinct().orderBy(F.desc("date"))


def top_keywords_on_date(trending: DataFrame, date: datetime.date | None = None, n: int = 20) -> DataFrame:
    """Top keywords of a day, by default the last one."""
    day = trending.agg(F.max("date")).scalar() if date is None else F.lit(date)
    return (
        trending.where(F.col("date") == day)
        .select("keyword", "mentions", "sources_count")
        .orderBy(F.desc("mentions"), "keyword")
        .limit(n)
    )


def top_categories(categories: DataFrame, n: int = 20) -> DataFrame:
    return categories.orderBy(F.desc("mentions"), F.desc("date"), "category").limit(n)


def top_cross_keywords(cross: DataFrame, n: int = 20) -> DataFrame:
    return (
        cross.select("keyword", "total_mentions", "sources_count", "is_viral")
        .orderBy(F.desc("total_mentions"), "keyword")
        .limit(n)
    )


def cross_table(cross: DataFrame, n: int = 50, viral_only: bool = False) -> DataFrame:
    """The head of the cross-source table in its stored order."""
    rows = cross.where("is_viral") if viral_only else cross
    return (
        rows.select("keyword", "total_mentions", "sources_count", "is_viral")
        .orderBy(F.desc("sources_count"), F.desc("total_mentions"), "keyword")
        .limit(n)
    )


def viral_summary(cross: DataFrame) -> DataFrame:
    return cross.agg(
        F.count_if("is_viral").alias("viral_keywords"),
        F.count(F.lit(1)).alias("multi_source_keywords"),
    )


def volume_series(volume: DataFrame) -> DataFrame:
    return volume.select("date", "source", "total_posts").orderBy("date", "source")


def volume_totals(volume: DataFrame) -> DataFrame:
    return volume.groupBy("source").agg(F.sum("total_posts").alias("total_posts"))


def volume_week_table(weeks: DataFrame) -> DataFrame:
    return weeks.select("year_week", "source", "total_posts").orderBy(F.desc("year_week"), "source")


def volume_month_table(months: DataFrame) -> DataFrame:
    return months.select("year_month", "source", "total_posts").orderBy("year_month", "source")


def _of_source(df: DataFrame, source: str | None) -> DataFrame:
    return df if source is None else df.where(F.col("source") == source)


def growth_kpis(growth: DataFrame, source: str | None = None) -> DataFrame:
    return _of_source(growth, source).agg(
        F.avg("growth_pct").alias("avg_growth"),
        F.max("growth_pct").alias("max_growth"),
        F.min("growth_pct").alias("min_growth"),
    )


def growth_table(growth: DataFrame, source: str | None = None) -> DataFrame:
    return (
        _of_source(growth, source)
        .select("date", "source", "total_posts", "prev_day_posts", "growth_pct", "growth_abs")
        .orderBy(F.desc("date"), "source")
    )


def avg_length_by_source(stats: DataFrame) -> DataFrame:
    """The mean of the daily means, each day weighing the same."""
    return stats.groupBy("source").agg(F.avg("avg_length").alias("avg_length"))


def long_short_melt(stats: DataFrame) -> DataFrame:
    sums = stats.groupBy("source").agg(
        F.sum("long_posts").alias("long_posts"), F.sum("short_posts").alias("short_posts")
    )
    return sums.unpivot("source", ["long_posts", "short_posts"], "type", "count")


def _in_sources(hourly: DataFrame, sources: Sequence[str] | None) -> DataFrame:
    return hourly if sources is None else hourly.where(F.col("source").isin(list(sources)))


def activity_by_hour(hourly: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    return _in_sources(hourly, sources).groupBy("hour").agg(F.sum("post_count").alias("post_count"))


def heatmap_source_hour(hourly: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    """One row per source, one column per hour (``h0`` to ``h23``), 0 where nothing was posted."""
    pivoted = _in_sources(hourly, sources).groupBy("source").pivot("hour", list(HOURS)).agg(F.sum("post_count"))
    return pivoted.select("source", *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h}") for h in HOURS])


def activity_by_weekday(hourly: DataFrame, sources: Sequence[str] | None = None) -> DataFrame:
    names = F.array(*[F.lit(d) for d in WEEKDAYS])
    return (
        _in_sources(hourly, sources)
        .groupBy("day_of_week")
        .agg(F.sum("post_count").alias("post_count"))
        .select("day_of_week", F.element_at(names, F.col("day_of_week")).alias("day_name"), "post_count")
        .orderBy("day_of_week")
    )


def remap_rates(stats: DataFrame) -> DataFrame:
    return stats.select("date", "source", "remapped_pct", "keywords_pct")
