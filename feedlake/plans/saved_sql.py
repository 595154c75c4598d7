"""Ad-hoc SQL over the curated tables, and the saved queries.

``:as_of`` stands for the current date, so that a run can be repeated.  Queries with a
limit order their rows totally.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# The saved statements: columns, filters and limits are the interface (fixed values).
SAVED = {
    "trending_today": """
        SELECT keyword, mentions, sources_count
        FROM trending_keywords WHERE date = :as_of
        ORDER BY mentions DESC, keyword LIMIT 50""",
    "volume_7d": """
        SELECT date, source, total_posts, unique_posts
        FROM volume_by_source WHERE date >= date_sub(:as_of, 7)
        ORDER BY date DESC, total_posts DESC, source""",
    "categories_7d": """
        SELECT category, SUM(mentions) AS total_mentions, COUNT(DISTINCT date) AS days_active
        FROM trending_categories WHERE date >= date_sub(:as_of, 7)
        GROUP BY category ORDER BY total_mentions DESC, category LIMIT 20""",
    "search_keyword": """
        SELECT date, mentions, sources_count
        FROM trending_keywords WHERE keyword = :keyword
        ORDER BY date DESC LIMIT 30""",
    "raw_sample": """
        SELECT id, content, author, collected_at, keywords, categories, is_remapped
        FROM raw_bluesky ORDER BY id LIMIT 100""",
    "volume_day": """
        SELECT date, source, total_posts FROM volume_by_source
        ORDER BY date DESC, total_posts DESC, source LIMIT 50""",
    "volume_week": """
        SELECT year_week, source, total_posts, unique_posts FROM volume_by_week
        ORDER BY year_week DESC, source LIMIT 30""",
    "volume_month": """
        SELECT year_month, source, total_posts FROM volume_by_month
        ORDER BY year_month DESC, source""",
    "top_keywords": """
        SELECT keyword, SUM(mentions) AS total_mentions FROM trending_keywords
        GROUP BY keyword ORDER BY total_mentions DESC, keyword LIMIT 10""",
    "viral": """
        SELECT keyword, total_mentions, sources_count FROM cross_source_keywords
        WHERE sources_count >= 3 ORDER BY total_mentions DESC, keyword LIMIT 20""",
    "growth": """
        SELECT date, source, total_posts, growth_pct, growth_abs FROM growth_rate
        WHERE growth_pct IS NOT NULL ORDER BY date DESC, source LIMIT 50""",
    "content": """
        SELECT date, source, avg_length, long_posts, short_posts FROM content_stats
        ORDER BY date DESC, source LIMIT 30""",
    "hourly": """
        SELECT hour, source, SUM(post_count) AS total_posts FROM hourly_activity
        GROUP BY hour, source ORDER BY hour, source""",
    "global": "SELECT * FROM global_summary LIMIT 1",
}


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, object] | None = None,
    views: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Run any SQL; ``views`` are known under their names inside it, and nowhere else."""
    scoped = {name: f"{name}_{uuid.uuid4().hex}" for name in views or {}}
    for name, view in scoped.items():
        views[name].createOrReplaceTempView(view)
    try:
        return spark.sql(_within(text, scoped), args=dict(args) if args else None)
    finally:
        for view in scoped.values():
            spark.catalog.dropTempView(view)  # the frame has been resolved


def _within(text: str, scoped: Mapping[str, str]) -> str:
    if not scoped:
        return text
    named = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in scoped.items())
    own = re.match(r"\s*WITH\s+(RECURSIVE\s+)?", text, re.IGNORECASE)
    return f"WITH {own[1] or ''}{named}, {text[own.end():]}" if own else f"WITH {named} {text}"


def run_saved(spark: SparkSession, name: str, args=None, views=None) -> DataFrame:
    return run_sql(spark, SAVED[name], args, views)
