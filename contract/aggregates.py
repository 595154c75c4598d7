"""Curated tables, report views and saved SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from contract.base import day, query, ts
from contract.feeds import EXPLODED, document_posts, event_posts, posts_sql
from feedlake.operators import curated, reports
from feedlake.plans import saved_sql

EV = posts_sql("events")
DOC = posts_sql("documents")
KW = f"{DOC}, {EXPLODED}"

# --- curated tables ------------------------------------------------------------------

SQL = {
    "volume_by_source": f"""WITH {EV} SELECT {day('collected_at')} AS date, source,
        count(id) AS total_posts, count(DISTINCT id) AS unique_posts FROM p GROUP BY 1, 2""",
    "volume_by_week": f"""WITH {DOC} SELECT year(collected_at) || '-W' || lpad(CAST(week(collected_at) AS VARCHAR), 2, '0')
        AS year_week, source, count(id) AS total_posts, count(DISTINCT id) AS unique_posts,
        {ts('min(collected_at)')} AS week_start, {ts('max(collected_at)')} AS week_end FROM p GROUP BY 1, 2""",
    "volume_by_month": f"""WITH {EV} SELECT strftime(collected_at, '%Y-%m') AS year_month, source,
        count(id) AS total_posts, count(DISTINCT id) AS unique_posts,
        {ts('min(collected_at)')} AS month_start, {ts('max(collected_at)')} AS month_end FROM p GROUP BY 1, 2""",
    "hourly_activity": f"""WITH {EV} SELECT source, CAST(hour(collected_at) AS INTEGER) AS hour,
        CAST(dayofweek(collected_at) + 1 AS INTEGER) AS day_of_week, count(id) AS post_count FROM p GROUP BY 1, 2, 3""",
    "growth_rate": f"""WITH {EV}, d AS (SELECT CAST(collected_at AS DATE) AS date, source, count(id) AS total_posts
        FROM p GROUP BY 1, 2), g AS (SELECT *, lag(total_posts) OVER (PARTITION BY source ORDER BY date) AS prev_day_posts
        FROM d) SELECT CAST(date AS VARCHAR) AS date, source, total_posts, prev_day_posts,
        CASE WHEN prev_day_posts > 0 THEN round((total_posts - prev_day_posts) / prev_day_posts * 100, 2) END AS growth_pct,
        total_posts - prev_day_posts AS growth_abs FROM g""",
    "remapping_stats": f"""WITH {DOC}, a AS (SELECT CAST(collected_at AS DATE) AS date, source, count(*) AS total,
        CAST(sum(CASE WHEN is_remapped THEN 1 ELSE 0 END) AS BIGINT) AS remapped_count,
        CAST(sum(CASE WHEN has_keywords THEN 1 ELSE 0 END) AS BIGINT) AS with_keywords_count FROM p GROUP BY 1, 2)
        SELECT CAST(date AS VARCHAR) AS date, source, total, remapped_count, with_keywords_count,
        remapped_count / total * 100 AS remapped_pct, with_keywords_count / total * 100 AS keywords_pct FROM a""",
    "content_stats": f"""WITH {DOC}, a AS (SELECT CAST(collected_at AS DATE) AS date, source, count(id) AS total_posts,
        round(avg(length(content_clean)), 0) AS avg_length, CAST(min(length(content_clean)) AS INTEGER) AS min_length,
        CAST(max(length(content_clean)) AS INTEGER) AS max_length,
        CAST(sum(CASE WHEN length(content_clean) > 280 THEN 1 ELSE 0 END) AS BIGINT) AS long_posts,
        CAST(sum(CASE WHEN length(content_clean) <= 280 THEN 1 ELSE 0 END) AS BIGINT) AS short_posts FROM p GROUP BY 1, 2)
        SELECT CAST(date AS VARCHAR) AS date, source, total_posts, avg_length, min_length, max_length, long_posts,
        short_posts, round(long_posts / total_posts * 100, 2) AS long_posts_pct FROM a""",
    "source_summary": f"""WITH {EV} SELECT source, count(id) AS total_posts, {ts('min(collected_at)')} AS first_post,
        {ts('max(collected_at)')} AS last_post FROM p GROUP BY 1""",
    "global_summary": f"""WITH {DOC} SELECT count(id) AS total_posts, count(DISTINCT source) AS active_sources,
        {ts('min(collected_at)')} AS first_post, {ts('max(collected_at)')} AS last_post,
        CAST(sum(CASE WHEN is_remapped THEN 1 ELSE 0 END) AS BIGINT) AS total_remapped,
        CAST(sum(CASE WHEN has_keywords THEN 1 ELSE 0 END) AS BIGINT) AS total_with_keywords FROM p""",
    "extended_summary": f"""WITH {KW} SELECT count(id) AS total_posts, count(DISTINCT source) AS active_sources,
        count(DISTINCT CAST(collected_at AS DATE)) AS days_covered,
        {ts('min(collected_at)')} AS first_post, {ts('max(collected_at)')} AS last_post,
        round(avg(length(content_clean)), 0) AS avg_content_length,
        CAST(sum(CASE WHEN is_remapped THEN 1 ELSE 0 END) AS BIGINT) AS total_remapped,
        CAST(sum(CASE WHEN has_keywords THEN 1 ELSE 0 END) AS BIGINT) AS total_with_keywords,
        (SELECT count(*) FROM (SELECT DISTINCT keyword FROM k)) AS unique_keywords FROM p""",
    "explode_keywords": f"WITH {KW} SELECT id, CAST(date AS VARCHAR) AS date, source, keyword FROM k",
    "trending_keywords": f"""WITH {KW} SELECT CAST(date AS VARCHAR) AS date, keyword, count(*) AS mentions,
        count(DISTINCT source) AS sources_count FROM k GROUP BY 1, 2""",
    "trending_categories": f"""WITH {DOC}, c AS (SELECT CAST(collected_at AS DATE) AS date, source,
        unnest(categories) AS category FROM p) SELECT CAST(date AS VARCHAR) AS date, category, count(*) AS mentions,
        count(DISTINCT source) AS sources_count FROM c GROUP BY 1, 2""",
    "keywords_by_source": f"WITH {KW} SELECT source, keyword, count(*) AS mentions FROM k GROUP BY 1, 2",
    "distinct_keywords": f"WITH {KW} SELECT DISTINCT keyword FROM k",
    "cross_source_keywords": f"""WITH {KW}, s AS (SELECT keyword, source, count(*) AS n FROM k GROUP BY 1, 2)
        SELECT keyword, CAST(sum(n) AS BIGINT) AS total_mentions, count(source) AS sources_count,
        string_agg(source, '|' ORDER BY source) AS sources_list,
        string_agg(CAST(n AS VARCHAR), '|' ORDER BY source) AS source_mentions,
        count(source) >= 3 AS is_viral FROM s GROUP BY 1 HAVING count(source) >= 2""",
}


def _activity(spark, sf, posts=event_posts, by_hour=False):
    return curated.activity_rollup(posts(spark, sf), by_hour=by_hour)


def _tags(spark, sf):
    return curated.tag_rollup(document_posts(spark, sf))


VOLUMES = {
    "volume_by_source": lambda spark, sf: curated.volume_by_source(event_posts(spark, sf)),
    "volume_by_week": lambda spark, sf: curated.volume_by_week(document_posts(spark, sf)),
    "volume_by_month": lambda spark, sf: curated.volume_by_month(event_posts(spark, sf)),
}
FROM_EVENTS = ("growth_rate", "source_summary")
FROM_DOCUMENTS = ("remapping_stats", "content_stats", "global_summary")
FROM_TAGS = (
    "trending_keywords", "trending_categories", "keywords_by_source", "distinct_keywords", "cross_source_keywords"
)

TABLES = dict(VOLUMES)
for _name in FROM_EVENTS:
    TABLES[_name] = lambda spark, sf, f=getattr(curated, _name): f(_activity(spark, sf))
for _name in FROM_DOCUMENTS:
    TABLES[_name] = lambda spark, sf, f=getattr(curated, _name): f(_activity(spark, sf, document_posts))
for _name in FROM_TAGS:
    TABLES[_name] = lambda spark, sf, f=getattr(curated, _name): f(_tags(spark, sf))
TABLES["hourly_activity"] = lambda spark, sf: curated.hourly_activity(_activity(spark, sf, by_hour=True))
TABLES["explode_keywords"] = lambda spark, sf: curated.explode_keywords(document_posts(spark, sf))
TABLES["extended_summary"] = lambda spark, sf: curated.extended_summary(
    _activity(spark, sf, document_posts), _tags(spark, sf)
)

for _name, _fn in TABLES.items():
    query(_name, SQL[_name])(_fn)


def _of(table: str) -> str:
    return f"({SQL[table]})"


@query(
    "volume_rollups",
    f"""WITH {EV}, d AS (SELECT 'day' AS grain, {day('collected_at')} AS period, source, id FROM p
    UNION ALL SELECT 'week', year(collected_at) || '-W' || lpad(CAST(week(collected_at) AS VARCHAR), 2, '0'), source, id FROM p
    UNION ALL SELECT 'month', strftime(collected_at, '%Y-%m'), source, id FROM p)
    SELECT grain, period, source, count(DISTINCT id) AS unique_posts FROM d GROUP BY 1, 2, 3""",
)
def volume_rollups(spark, sf):
    return curated.unique_rollup(event_posts(spark, sf))


# --- report views --------------------------------------------------------------------


def view(name: str, table: str, sql: str, *args, fn=None, **kwargs) -> None:
    """Register a report over one curated table; ``{t}`` in the SQL stands for that table."""
    report = fn or getattr(reports, name)
    query(name, sql.format(t=_of(table)))(lambda spark, sf: report(TABLES[table](spark, sf), *args, **kwargs))


view(
    "kpi_overview", "global_summary",
    "SELECT total_posts, active_sources, coalesce(total_with_keywords, 0) AS total_with_keywords, "
    "coalesce(total_remapped, 0) AS total_remapped FROM {t}",
)
view(
    "source_share", "source_summary",
    "SELECT source, total_posts, total_posts / (SELECT sum(total_posts) FROM {t}) AS share FROM {t}",
)
view("top_keywords", "trending_keywords", "SELECT * FROM {t} ORDER BY mentions DESC, date DESC, keyword LIMIT 10")
view("available_dates", "trending_keywords", "SELECT DISTINCT date FROM {t}")
view(
    "top_keywords_on_date", "trending_keywords",
    "SELECT keyword, mentions, sources_count FROM {t} WHERE date = (SELECT max(date) FROM {t}) "
    "ORDER BY mentions DESC, keyword LIMIT 20",
)
view(
    "keyword_table_on_date", "trending_keywords",
    "SELECT keyword, mentions, sources_count FROM {t} WHERE date = '2024-12-24' ORDER BY mentions DESC, keyword LIMIT 30",
    date(2024, 12, 24), 30, fn=reports.top_keywords_on_date,
)
view("top_categories", "trending_categories", "SELECT * FROM {t} ORDER BY mentions DESC, date DESC, category LIMIT 20")
view(
    "viral_summary", "cross_source_keywords",
    "SELECT CAST(count(*) FILTER (WHERE is_viral) AS BIGINT) AS viral_keywords, count(*) AS multi_source_keywords FROM {t}",
)
view(
    "top_cross_keywords", "cross_source_keywords",
    "SELECT keyword, total_mentions, sources_count, is_viral FROM {t} ORDER BY total_mentions DESC, keyword LIMIT 20",
)
view(
    "cross_table", "cross_source_keywords",
    "SELECT keyword, total_mentions, sources_count, is_viral FROM {t} "
    "ORDER BY sources_count DESC, total_mentions DESC, keyword LIMIT 50",
)
view(
    "viral_table", "cross_source_keywords",
    "SELECT keyword, total_mentions, sources_count, is_viral FROM {t} WHERE is_viral "
    "ORDER BY sources_count DESC, total_mentions DESC, keyword LIMIT 10",
    10, True, fn=reports.cross_table,
)
view("volume_series", "volume_by_source", "SELECT date, source, total_posts FROM {t}")
view(
    "volume_totals", "volume_by_source",
    "SELECT source, CAST(sum(total_posts) AS BIGINT) AS total_posts FROM {t} GROUP BY 1",
)
view("volume_week_table", "volume_by_week", "SELECT year_week, source, total_posts FROM {t}")
view("volume_month_table", "volume_by_month", "SELECT year_month, source, total_posts FROM {t}")
view("growth_table", "growth_rate", "SELECT * FROM {t} WHERE source = 'click'", "click")
view(
    "long_short_melt", "content_stats",
    "SELECT source, 'long_posts' AS type, CAST(sum(long_posts) AS BIGINT) AS count FROM {t} GROUP BY 1 UNION ALL "
    "SELECT source, 'short_posts', CAST(sum(short_posts) AS BIGINT) FROM {t} GROUP BY 1",
)
view("avg_length_by_source", "content_stats", "SELECT source, avg(avg_length) AS avg_length FROM {t} GROUP BY 1")
view(
    "activity_by_hour", "hourly_activity",
    "SELECT hour, CAST(sum(post_count) AS BIGINT) AS post_count FROM {t} WHERE source IN ('click', 'view') GROUP BY 1",
    ["click", "view"],
)
view(
    "heatmap_source_hour", "hourly_activity",
    "SELECT source, "
    + ", ".join(f"CAST(coalesce(sum(post_count) FILTER (WHERE hour = {h}), 0) AS BIGINT) AS h{h}" for h in range(24))
    + " FROM {t} GROUP BY 1",
)
view(
    "activity_by_weekday", "hourly_activity",
    "SELECT day_of_week, ['Sun','Mon','Tue','Wed','Thu','Fri','Sat'][day_of_week] AS day_name, "
    "CAST(sum(post_count) AS BIGINT) AS post_count FROM {t} GROUP BY 1, 2",
)
view("remap_rates", "remapping_stats", "SELECT date, source, remapped_pct, keywords_pct FROM {t}")


@query(
    "growth_kpis",
    f"""SELECT round(avg(growth_pct), 6) AS avg_growth, max(growth_pct) AS max_growth, min(growth_pct) AS min_growth
    FROM {_of('growth_rate')}""",
)
def growth_kpis(spark, sf):
    # The mean of doubles depends on their order in the last digits.
    kpis = reports.growth_kpis(TABLES["growth_rate"](spark, sf))
    return kpis.withColumn("avg_growth", F.round("avg_growth", 6))


# --- saved SQL -----------------------------------------------------------------------


def saved(name: str, table: str, sql: str, **args) -> None:
    def run(spark, sf):
        return saved_sql.run_saved(spark, name, args, {table: TABLES[table](spark, sf)})

    query(f"sql_{name}", sql.format(t=_of(table)))(run)


TODAY = date(2024, 12, 24)
LAST_DAY = date(2024, 1, 30)

saved(
    "trending_today", "trending_keywords",
    "SELECT keyword, mentions, sources_count FROM {t} WHERE date = '2024-12-24' ORDER BY mentions DESC, keyword LIMIT 50",
    as_of=TODAY,
)
saved(
    "volume_7d", "volume_by_source",
    "SELECT date, source, total_posts, unique_posts FROM {t} WHERE date >= '2024-01-23'",
    as_of=LAST_DAY,
)
saved(
    "categories_7d", "trending_categories",
    "SELECT category, CAST(sum(mentions) AS BIGINT) AS total_mentions, count(DISTINCT date) AS days_active FROM {t} "
    "WHERE date >= '2024-12-17' GROUP BY 1 ORDER BY total_mentions DESC, category LIMIT 20",
    as_of=TODAY,
)
saved(
    "search_keyword", "trending_keywords",
    "SELECT date, mentions, sources_count FROM {t} WHERE keyword = 'mit' ORDER BY date DESC LIMIT 30",
    keyword="mit",
)
saved(
    "volume_day", "volume_by_source",
    "SELECT date, source, total_posts FROM {t} ORDER BY date DESC, total_posts DESC, source LIMIT 50",
)
saved(
    "volume_week", "volume_by_week",
    "SELECT year_week, source, total_posts, unique_posts FROM {t} ORDER BY year_week DESC, source LIMIT 30",
)
saved("volume_month", "volume_by_month", "SELECT year_month, source, total_posts FROM {t}")
saved(
    "top_keywords", "trending_keywords",
    "SELECT keyword, CAST(sum(mentions) AS BIGINT) AS total_mentions FROM {t} GROUP BY 1 "
    "ORDER BY total_mentions DESC, keyword LIMIT 10",
)
saved(
    "viral", "cross_source_keywords",
    "SELECT keyword, total_mentions, sources_count FROM {t} WHERE sources_count >= 3 "
    "ORDER BY total_mentions DESC, keyword LIMIT 20",
)
saved(
    "growth", "growth_rate",
    "SELECT date, source, total_posts, growth_pct, growth_abs FROM {t} WHERE growth_pct IS NOT NULL "
    "ORDER BY date DESC, source LIMIT 50",
)
saved(
    "content", "content_stats",
    "SELECT date, source, avg_length, long_posts, short_posts FROM {t} ORDER BY date DESC, source LIMIT 30",
)
saved(
    "hourly", "hourly_activity",
    "SELECT hour, source, CAST(sum(post_count) AS BIGINT) AS total_posts FROM {t} GROUP BY 1, 2",
)
saved("global", "global_summary", "SELECT * FROM {t}")


@query(
    "run_sql",
    f"""SELECT v.source, CAST(sum(v.total_posts) AS BIGINT) AS total_posts, max(g.growth_pct) AS best_day
    FROM {_of('volume_by_source')} v JOIN {_of('growth_rate')} g ON v.date = g.date AND v.source = g.source
    WHERE v.total_posts > 5 GROUP BY 1""",
)
def run_sql(spark, sf):
    return saved_sql.run_sql(
        spark,
        """SELECT v.source, SUM(v.total_posts) AS total_posts, MAX(g.growth_pct) AS best_day
        FROM volume_by_source v JOIN growth_rate g ON v.date = g.date AND v.source = g.source
        WHERE v.total_posts > :least GROUP BY v.source""",
        {"least": 5},
        {name: TABLES[name](spark, sf) for name in ("volume_by_source", "growth_rate")},
    )
