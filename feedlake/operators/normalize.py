"""Feed payloads to feed records: one function per feed, table in, table out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.taxonomy import Taxonomy
from feedlake.functions.text import clean_html
from feedlake.operators.tagging import tag_posts

# Ranked story lists (fixed values).
STORY_LISTS = ("top", "new", "best", "ask", "show")


def _filled(col: Column) -> Column:
    return F.when(col != "", col)


def normalize_bluesky(payloads: DataFrame, taxonomy: Taxonomy, value: str = "value") -> DataFrame:
    """Posts among the commit messages, tagged; ``value`` holds the JSON payload."""
    p = payloads.select(F.from_json(value, schemas.BLUESKY_PAYLOAD).alias("p")).select("p.*")
    posts = p.where(
        (F.col("kind") == "commit")
        & (F.col("commit.collection") == "app.bsky.feed.post")
        & (F.col("commit.record.text") != "")
    ).select(
        F.concat("did", F.lit(":"), "commit.rkey").alias("id"),
        "did",
        F.col("commit.record.text").alias("text"),
        F.col("commit.record.createdAt").alias("created_at"),
        F.coalesce("commit.record.langs", F.array().cast("array<string>")).alias("langs"),
        F.col("commit.record.reply.parent.uri").alias("reply_to"),
        F.lit("bluesky").alias("source"),
    )
    return tag_posts(posts, taxonomy)


def normalize_nostr(payloads: DataFrame, taxonomy: Taxonomy, value: str = "value") -> DataFrame:
    """Events among the relay messages, tagged; those without a keyword are left out."""
    message = F.from_json(value, "array<string>")
    events = (
        payloads.select(message.alias("m"))
        .where(F.get("m", F.lit(0)) == "EVENT")
        .select(F.from_json(F.get("m", F.lit(2)), schemas.NOSTR_EVENT).alias("e"))
        .select(
            "e.id",
            "e.pubkey",
            F.col("e.content").alias("text"),
            "e.created_at",
            "e.kind",
            F.coalesce("e.tags", F.array().cast("array<array<string>>")).alias("tags"),
            F.lit("nostr").alias("source"),
        )
    )
    tagged = tag_posts(events, taxonomy)
    # As a filter this would be pushed below the tagging, which would then run twice.
    row = F.array(F.struct(*tagged.columns))
    return tagged.select(F.inline(F.filter(row, lambda r: F.size(r.mapped_keywords) > 0)))


def normalize_hackernews(items: DataFrame, lists: DataFrame) -> DataFrame:
    """Stories on any list, labelled with the first list, in rank order, that has them."""
    rank = F.array_position(F.array(*[F.lit(name) for name in STORY_LISTS]), F.col("list"))
    first_list = lists.where(rank > 0).groupBy("id").agg(F.min(rank).cast("int").alias("rank"))
    stories = items.where(F.col("type") == "story").join(first_list, "id")
    return stories.select(
        "id",
        "title",
        "url",
        clean_html(F.col("text")).alias("text"),
        F.col("by").alias("author"),
        "score",
        F.coalesce("descendants", F.lit(0)).alias("comments"),
        F.col("time").alias("timestamp"),
        F.element_at(F.array(*[F.lit(name) for name in STORY_LISTS]), F.col("rank")).alias("story_type"),
        F.lit("hackernews").alias("source"),
    )


def _start(text: Column, chars: int | None) -> Column:
    return text if chars is None else F.substring(text, 1, chars)


def normalize_stackoverflow(questions: DataFrame, body_chars: int | None = None) -> DataFrame:
    """Questions with their whole body, or its first ``body_chars`` characters."""
    return questions.select(
        F.col("question_id").alias("id"),
        clean_html(F.col("title")).alias("title"),
        F.col("link").alias("url"),
        F.col("owner.display_name").alias("author"),
        _start(clean_html(F.col("body")), body_chars).alias("body"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        "score",
        F.col("view_count").alias("views"),
        F.col("answer_count").alias("answers"),
        "is_answered",
        F.col("creation_date").alias("timestamp"),
        F.lit("stackoverflow").alias("source"),
    )


def normalize_rss(entries: DataFrame, summary_chars: int | None = None) -> DataFrame:
    """Entries with their whole summary, or its first ``summary_chars`` characters."""
    unique = F.coalesce(_filled(F.col("id")), _filled(F.col("link")), F.col("title"), F.lit(""))
    tags = F.coalesce("tags", F.array().cast("array<struct<term:string>>"))
    return entries.select(
        F.md5(unique).alias("id"),
        clean_html(F.col("title")).alias("title"),
        F.col("link").alias("url"),
        "author",
        _start(clean_html(F.col("summary")), summary_chars).alias("summary"),
        "feed_name",
        "feed_url",
        "published",
        F.transform(tags, lambda t: t.term).alias("tags"),
        F.lit("rss").alias("source"),
    )
