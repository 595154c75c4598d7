"""Posts to curated tables.

Three rollups hold everything the fourteen tables need: counts per hour and source,
distinct ids per period and source, mentions per day, source and tag.  Each is one pass
over the posts that combines before its shuffle; the tables follow from the small rollups.
Counts are of ids where the post id is counted, and of rows elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.functions.times import month_label, week_label

LONG_POST = 280
CROSS_SOURCE = 2
VIRAL = 3
SHORT_KEYWORD = 2
#: Sketches of 2^16 registers: a standard error of 0.4 %, exact for small sets.
SKETCH_LG_K = 16


# --- rollups -------------------------------------------------------------------------


def slim_posts(posts: DataFrame) -> DataFrame:
    """What the rollups need of each post, without its text: one pass over the posts serves all of them.

    ``content_length``, and ``tags``: the keywords that count, in lower case, and the categories.
    """
    return posts.select(
        "id",
        "source",
        "collected_at",
        "is_remapped",
        "has_keywords",
        F.length("content_clean").alias("content_length"),
        _tags(posts).alias("tags"),
    )


def activity_rollup(posts: DataFrame, threshold: int = LONG_POST, by_hour: bool = True) -> DataFrame:
    """Additive measures per date, hour, weekday and source, or per date and source alone."""
    at = F.col("collected_at")
    length = F.col("content_length") if "content_length" in posts.columns else F.length("content_clean")
    hours = [F.hour(at).alias("hour"), F.dayofweek(at).alias("day_of_week")] if by_hour else []
    return posts.groupBy(F.to_date(at).alias("date"), "source", *hours).agg(
        F.count("id").alias("posts"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if("is_remapped").alias("remapped"),
        F.count_if("has_keywords").alias("with_keywords"),
        F.sum(length).alias("length_sum"),
        F.count(length).alias("length_rows"),
        F.min(length).alias("length_min"),
        F.max(length).alias("length_max"),
        F.count_if(length > threshold).alias("long_posts"),
        F.count_if(length <= threshold).alias("short_posts"),
        F.min(at).alias("first_post"),
        F.max(at).alias("last_post"),
    )


def unique_rollup(posts: DataFrame, iso_year: bool = False) -> DataFrame:
    """Distinct ids per (grain, period, source), for days, weeks and months at once.

    Distinct counts do not add up over periods.  One shuffle by (source, id) gathers the
    days of each id, a set no longer than the calendar, and the labels of all grains are
    counted from it.
    """
    days = (
        posts.where(F.col("id").isNotNull())
        .groupBy("source", "id")
        .agg(F.collect_set(F.to_date("collected_at")).alias("days"))
    )

    def periods(grain: str, label) -> Column:
        return F.transform(
            F.array_distinct(F.transform("days", label)),
            lambda p: F.struct(F.lit(grain).alias("grain"), p.alias("period")),
        )

    return (
        days.select(
            "source",
            F.inline(
                F.concat(
                    periods("day", lambda d: d.cast("string")),
                    periods("week", lambda d: week_label(d, iso_year)),
                    periods("month", month_label),
                )
            ),
        )
        .groupBy("grain", "period", "source")
        .agg(F.count(F.lit(1)).alias("unique_posts"))
    )


def unique_sketches(posts: DataFrame, lg_k: int = SKETCH_LG_K) -> DataFrame:
    """A sketch of the distinct ids per date and source, of bounded size; combines before the shuffle, and with other sketches."""
    return posts.groupBy(F.to_date("collected_at").alias("date"), "source").agg(
        F.hll_sketch_agg(F.col("id").cast("string"), F.lit(lg_k)).alias("sketch")
    )


def uniques_from_sketches(sketches: DataFrame, iso_year: bool = False) -> DataFrame:
    """``unique_rollup`` from sketches of any batches: unions per day, week and month, and what they estimate."""
    date = F.col("date")
    period = lambda grain, label: F.struct(F.lit(grain).alias("grain"), label.alias("period"))
    grains = F.array(
        period("day", date.cast("string")), period("week", week_label(date, iso_year)), period("month", month_label(date))
    )
    unions = sketches.select("source", "sketch", F.inline(grains)).groupBy("grain", "period", "source")
    counted = unions.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("unique_posts"))
    return counted.where("unique_posts > 0")


def merge_activity(parts: DataFrame) -> DataFrame:
    """The activity rollup of all posts from those of disjoint parts of them."""
    added = ("posts", "rows", "remapped", "with_keywords", "length_sum", "length_rows", "long_posts", "short_posts")
    return parts.groupBy("date", "source", "hour", "day_of_week").agg(
        *[F.sum(c).alias(c) for c in added],
        *[F.min(c).alias(c) for c in ("length_min", "first_post")],
        *[F.max(c).alias(c) for c in ("length_max", "last_post")],
    )


def merge_tags(parts: DataFrame) -> DataFrame:
    """The tag rollup of all posts from those of disjoint parts of them."""
    return parts.groupBy("kind", "date", "source", "tag").agg(F.sum("mentions").alias("mentions"))


def _tags(posts: DataFrame) -> Column:
    """(kind, tag) of the keywords and categories of a post.

    Keywords are in lower case.  One of two characters or fewer counts only where it
    stands alone between spaces in the content; categories are taken as they are.
    """
    # The text is looked at only where a keyword needs it.
    short = F.exists("keywords", lambda k: F.length(k) <= SHORT_KEYWORD)
    padded = F.when(short, F.concat(F.lit(" "), F.lower("content_clean"), F.lit(" ")))
    keywords = F.filter(
        F.transform("keywords", F.lower),
        lambda k: F.when(
            F.length(k) <= SHORT_KEYWORD, padded.contains(F.concat(F.lit(" "), k, F.lit(" ")))
        ).otherwise(True),
    )

    def tagged(kind: str, tags: Column) -> Column:
        rows = F.transform(tags, lambda t: F.struct(F.lit(kind).alias("kind"), t.alias("tag")))
        return F.coalesce(rows, F.array().cast("array<struct<kind:string,tag:string>>"))

    return F.concat(tagged("keyword", keywords), tagged("category", F.col("categories")))


def explode_tags(posts: DataFrame) -> DataFrame:
    """One row per post and tag: (id, date, source, kind, tag), from a single scan."""
    tags = F.col("tags") if "content_length" in posts.columns else _tags(posts)
    return posts.select("id", F.to_date("collected_at").alias("date"), "source", F.inline(tags))


def explode_keywords(posts: DataFrame) -> DataFrame:
    """One row per post and keyword: (id, date, source, keyword)."""
    return _of_kind(explode_tags(posts.withColumn("categories", F.array().cast("array<string>"))), "keyword")


def tag_rollup(posts: DataFrame) -> DataFrame:
    """Mentions per kind, date, source and tag."""
    return (
        explode_tags(posts)
        .groupBy("kind", "date", "source", "tag")
        .agg(F.count(F.lit(1)).alias("mentions"))
    )


def _of_kind(tags: DataFrame, kind: str) -> DataFrame:
    return tags.where(F.col("kind") == kind).drop("kind").withColumnRenamed("tag", kind)


# --- volume --------------------------------------------------------------------------


def _volume(posts: DataFrame, period: str, label: Column, first: str | None, last: str | None) -> DataFrame:
    # A single count_distinct: Spark groups by (period, source, id) first, in parallel.
    measures = [F.count("id").alias("total_posts"), F.count_distinct("id").alias("unique_posts")]
    if first and last:
        measures += [F.min("collected_at").alias(first), F.max("collected_at").alias(last)]
    return posts.groupBy(label.alias(period), "source").agg(*measures)


def volume_by_source(posts: DataFrame) -> DataFrame:
    return _volume(posts, "date", F.to_date("collected_at"), None, None)


def volume_by_week(posts: DataFrame, iso_year: bool = False) -> DataFrame:
    label = week_label(F.col("collected_at"), iso_year)
    return _volume(posts, "year_week", label, "week_start", "week_end")


def volume_by_month(posts: DataFrame) -> DataFrame:
    return _volume(posts, "year_month", month_label(F.col("collected_at")), "month_start", "month_end")


def volume_from_rollups(activity: DataFrame, uniques: DataFrame, grain: str, iso_year: bool = False) -> DataFrame:
    """The day, week or month volume table from the rollups alone."""
    name, label, first, last = {
        "day": ("date", F.col("date").cast("string"), None, None),
        "week": ("year_week", week_label(F.col("date"), iso_year), "week_start", "week_end"),
        "month": ("year_month", month_label(F.col("date")), "month_start", "month_end"),
    }[grain]
    totals = activity.select(label.alias("period"), "source", "posts", "first_post", "last_post")
    distinct = uniques.where(F.col("grain") == grain).select("period", "source", "unique_posts")
    out = (
        totals.unionByName(distinct, allowMissingColumns=True)
        .groupBy(F.col("period").alias(name), "source")
        .agg(
            F.sum("posts").alias("total_posts"),
            F.coalesce(F.sum("unique_posts"), F.lit(0)).alias("unique_posts"),
            F.min("first_post").alias("first"),
            F.max("last_post").alias("last"),
        )
    )
    if grain == "day":
        return out.withColumn("date", F.to_date("date")).drop("first", "last")
    return out.withColumnsRenamed({"first": first, "last": last})


# --- tables from the activity rollup -------------------------------------------------


def hourly_activity(activity: DataFrame) -> DataFrame:
    return activity.groupBy("source", "hour", "day_of_week").agg(F.sum("posts").alias("post_count"))


def remapping_stats(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy("date", "source")
        .agg(
            F.sum("rows").alias("total"),
            F.sum("remapped").alias("remapped_count"),
            F.sum("with_keywords").alias("with_keywords_count"),
        )
        .withColumns(
            {
                "remapped_pct": F.col("remapped_count") / F.col("total") * 100,
                "keywords_pct": F.col("with_keywords_count") / F.col("total") * 100,
            }
        )
    )


def growth_rate(activity: DataFrame) -> DataFrame:
    """Posts per day against the previous day that has any, per source.

    The window runs over daily totals: a source has as many rows as days, whatever its
    share of the posts.
    """
    days = Window.partitionBy("source").orderBy("date")
    before = F.col("prev_day_posts")
    change = F.col("total_posts") - before
    return (
        activity.groupBy("date", "source")
        .agg(F.sum("posts").alias("total_posts"))
        .withColumn("prev_day_posts", F.lag("total_posts", 1).over(days))
        .withColumn("growth_pct", F.when(before > 0, F.round(change / before * 100, 2)))
        .withColumn("growth_abs", change)
    )


def content_stats(activity: DataFrame) -> DataFrame:
    return (
        activity.groupBy("date", "source")
        .agg(
            F.sum("posts").alias("total_posts"),
            F.round(F.try_divide(F.sum("length_sum"), F.sum("length_rows")), 0).alias("avg_length"),
            F.min("length_min").alias("min_length"),
            F.max("length_max").alias("max_length"),
            F.sum("long_posts").alias("long_posts"),
            F.sum("short_posts").alias("short_posts"),
        )
        .withColumn(
            "long_posts_pct", F.round(F.try_divide(F.col("long_posts"), F.col("total_posts")) * 100, 2)
        )
    )


def source_summary(activity: DataFrame) -> DataFrame:
    return activity.groupBy("source").agg(
        F.sum("posts").alias("total_posts"),
        F.min("first_post").alias("first_post"),
        F.max("last_post").alias("last_post"),
    )


def _summary_measures() -> dict[str, Column]:
    return {
        "total_posts": F.coalesce(F.sum("posts"), F.lit(0)),
        "active_sources": F.count_distinct("source"),
        "first_post": F.min("first_post"),
        "last_post": F.max("last_post"),
        "total_remapped": F.sum("remapped"),
        "total_with_keywords": F.sum("with_keywords"),
    }


def global_summary(activity: DataFrame) -> DataFrame:
    return activity.agg(*[c.alias(n) for n, c in _summary_measures().items()])


def extended_summary(activity: DataFrame, tags: DataFrame) -> DataFrame:
    """The global summary with days, mean length and the number of distinct keywords.

    Both distinct counts run over (date, source) rows; the number of keywords is a scalar
    subquery, so nothing passes through the driver.
    """
    daily = activity.groupBy("date", "source").agg(
        *[F.sum(c).alias(c) for c in ("posts", "remapped", "with_keywords", "length_sum", "length_rows")],
        F.min("first_post").alias("first_post"),
        F.max("last_post").alias("last_post"),
    )
    measures = _summary_measures() | {
        "days_covered": F.count_distinct("date"),
        "avg_content_length": F.round(F.try_divide(F.sum("length_sum"), F.sum("length_rows")), 0),
    }
    unique_keywords = distinct_keywords(tags).agg(F.count(F.lit(1))).scalar()
    return (
        daily.agg(*[c.alias(n) for n, c in measures.items()])
        .withColumn("unique_keywords", unique_keywords)
        .select(
            "total_posts", "active_sources", "days_covered", "first_post", "last_post",
            "avg_content_length", "total_remapped", "total_with_keywords", "unique_keywords",
        )
    )


# --- tables from the tag rollup ------------------------------------------------------


def _trending(tags: DataFrame, kind: str) -> DataFrame:
    # The rollup has one row per source, so counting rows counts sources.
    return (
        _of_kind(tags, kind)
        .groupBy("date", kind)
        .agg(F.sum("mentions").alias("mentions"), F.count("source").alias("sources_count"))
    )


def trending_keywords(tags: DataFrame) -> DataFrame:
    return _trending(tags, "keyword")


def trending_categories(tags: DataFrame) -> DataFrame:
    return _trending(tags, "category")


def keywords_by_source(tags: DataFrame) -> DataFrame:
    return _of_kind(tags, "keyword").groupBy("source", "keyword").agg(F.sum("mentions").alias("mentions"))


def distinct_keywords(tags: DataFrame) -> DataFrame:
    return _of_kind(tags, "keyword").select("keyword").distinct()


def cross_source_keywords(tags: DataFrame, at_least: int = CROSS_SOURCE, viral: int = VIRAL) -> DataFrame:
    """Keywords of several sources, with the mentions in each.

    ``sources_list`` names each source once and ``source_mentions`` says how often, in the
    same order.  That is the whole list of sources with repeats in a row no longer than
    the number of sources.
    """
    per_source = F.when(F.col("source").isNotNull(), F.struct("source", "mentions"))
    return (
        keywords_by_source(tags)
        .groupBy("keyword")
        .agg(
            F.sum("mentions").alias("total_mentions"),
            F.count("source").alias("sources_count"),
            F.array_sort(F.collect_list(per_source)).alias("_per_source"),
        )
        .where(F.col("sources_count") >= at_least)
        .select(
            "keyword",
            "total_mentions",
            "sources_count",
            F.transform("_per_source", lambda s: s.source).alias("sources_list"),
            F.transform("_per_source", lambda s: s.mentions).alias("source_mentions"),
            (F.col("sources_count") >= viral).alias("is_viral"),
        )
    )
