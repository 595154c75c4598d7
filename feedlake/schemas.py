"""Column names and types of payloads, feed records, posts and curated tables."""

from __future__ import annotations

from pyspark.sql import types as T

FEEDS = ("bluesky", "nostr", "hackernews", "stackoverflow", "rss")

POST = (
    T.StructType()
    .add("id", "string")
    .add("source", "string")
    .add("content_clean", "string")
    .add("collected_at", "timestamp")
    .add("processed_at", "timestamp")
    .add("keywords", T.ArrayType(T.StringType()))
    .add("categories", T.ArrayType(T.StringType()))
    .add("is_remapped", "boolean")
    .add("has_keywords", "boolean")
)

# Payloads as the feeds deliver them, before normalising.
BLUESKY_PAYLOAD = (
    "kind string, did string, commit struct<collection: string, rkey: string, "
    "record: struct<text: string, createdAt: string, langs: array<string>, "
    "reply: struct<parent: struct<uri: string>>>>"
)
NOSTR_EVENT = (
    "id string, pubkey string, content string, created_at bigint, kind int, "
    "tags array<array<string>>"
)
HACKERNEWS_ITEM = (
    "id bigint, type string, title string, url string, text string, by string, "
    "score int, descendants int, time bigint"
)
STACKOVERFLOW_ITEM = (
    "question_id bigint, title string, link string, body string, "
    "owner struct<display_name: string>, tags array<string>, score int, "
    "view_count int, answer_count int, is_answered boolean, creation_date bigint"
)
RSS_ENTRY = (
    "id string, link string, title string, author string, summary string, "
    "published string, tags array<struct<term: string>>, feed_name string, feed_url string"
)

_ENVELOPE = ", _ingested_at string, _source_topic string"
_TAGGED = (
    "content string, old_content string, original_keywords array<string>, "
    "mapped_keywords array<string>, categories array<string>, "
    "categorized_keywords map<string, array<string>>, is_remapped boolean"
)

# Feed records: one JSON object per post in the raw zone.
RECORDS = {
    "bluesky": "id string, did string, " + _TAGGED
    + ", created_at string, langs array<string>, reply_to string, source string" + _ENVELOPE,
    "nostr": "id string, pubkey string, " + _TAGGED
    + ", created_at bigint, kind int, tags array<array<string>>, source string" + _ENVELOPE,
    "hackernews": "id bigint, title string, url string, text string, author string, score int, "
    "comments int, timestamp bigint, story_type string, source string" + _ENVELOPE,
    "stackoverflow": "id bigint, title string, url string, author string, body string, "
    "tags array<string>, score int, views int, answers int, is_answered boolean, "
    "timestamp bigint, source string" + _ENVELOPE,
    "rss": "id string, title string, url string, author string, summary string, "
    "feed_name string, feed_url string, published string, tags array<string>, source string"
    + _ENVELOPE,
}

# Curated tables: folder, columns, and whether the folder is partitioned by source (fixed values).
CURATED = {
    "volume_by_source": ("analytics", "date date, source string, total_posts bigint, unique_posts bigint", True),
    "hourly_activity": ("analytics", "source string, hour int, day_of_week int, post_count bigint", False),
    "remapping_stats": (
        "analytics",
        "date date, source string, total bigint, remapped_count bigint, with_keywords_count bigint, "
        "remapped_pct double, keywords_pct double",
        False,
    ),
    "volume_by_week": (
        "analytics",
        "year_week string, source string, total_posts bigint, unique_posts bigint, "
        "week_start timestamp, week_end timestamp",
        True,
    ),
    "volume_by_month": (
        "analytics",
        "year_month string, source string, total_posts bigint, unique_posts bigint, "
        "month_start timestamp, month_end timestamp",
        True,
    ),
    "growth_rate": (
        "analytics",
        "date date, source string, total_posts bigint, prev_day_posts bigint, growth_pct double, growth_abs bigint",
        True,
    ),
    "content_stats": (
        "analytics",
        "date date, source string, total_posts bigint, avg_length double, min_length int, max_length int, "
        "long_posts bigint, short_posts bigint, long_posts_pct double",
        True,
    ),
    "trending_keywords": ("trends", "date date, keyword string, mentions bigint, sources_count bigint", False),
    "trending_categories": ("trends", "date date, category string, mentions bigint, sources_count bigint", False),
    "cross_source_keywords": (
        "trends",
        "keyword string, total_mentions bigint, sources_count bigint, sources_list array<string>, "
        "source_mentions array<bigint>, is_viral boolean",
        False,
    ),
    "keywords_by_source": ("trends", "source string, keyword string, mentions bigint", True),
    "global_summary": (
        "reports",
        "total_posts bigint, active_sources bigint, first_post timestamp, last_post timestamp, "
        "total_remapped bigint, total_with_keywords bigint",
        False,
    ),
    "source_summary": ("reports", "source string, total_posts bigint, first_post timestamp, last_post timestamp", False),
    "extended_summary": (
        "reports",
        "total_posts bigint, active_sources bigint, days_covered bigint, first_post timestamp, "
        "last_post timestamp, avg_content_length double, total_remapped bigint, "
        "total_with_keywords bigint, unique_keywords bigint",
        False,
    ),
}


def curated_path(root: str, table: str) -> str:
    """Where a curated table lies; two trend tables have shorter folder names."""
    folder = {"trending_keywords": "keywords", "trending_categories": "categories"}.get(table, table)
    return f"{root.rstrip('/')}/{CURATED[table][0]}/{folder}"


def curated_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(CURATED[table][1] + ", aggregated_at timestamp")
