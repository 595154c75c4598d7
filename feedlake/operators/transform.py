"""Feed records to posts: column picks, per-feed extras, deduplication, validity."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import schemas
from feedlake.functions.text import clean_content
from feedlake.functions.times import parse_time

# The first column of these that a table has is its content, or its time (fixed values).
CONTENT_COLUMNS = ("content", "summary", "text", "body", "title")
TIME_COLUMNS = ("collected_at", "published", "created_at", "timestamp")


class Extra(NamedTuple):
    """An extra column: its name, the names it may arrive under, default and type."""

    name: str
    aliases: tuple[str, ...]
    default: object
    type: str


def _extra(name: str, default: object, type_: str, *aliases: str) -> Extra:
    return Extra(name, (name, *aliases), default, type_)


# Extras of the feeds, their types and defaults (fixed values).
EXTRAS: dict[str, tuple[Extra, ...]] = {
    "bluesky": (
        _extra("author", "", "string"),
        _extra("created_at", None, "timestamp"),
        _extra("likes", 0, "int"),
        _extra("reposts", 0, "int"),
    ),
    "nostr": (
        _extra("pubkey", "", "string"),
        _extra("created_at", None, "timestamp"),
        _extra("kind", 1, "int"),
    ),
    "hackernews": (
        _extra("author", "", "string"),
        _extra("title", "", "string"),
        _extra("url", "", "string"),
        _extra("score", 0, "int"),
        _extra("comments", 0, "int"),
        _extra("type", "story", "string", "story_type"),
    ),
    "stackoverflow": (
        _extra("title", "", "string"),
        _extra("link", "", "string", "url"),
        _extra("score", 0, "int"),
        _extra("answer_count", 0, "int", "answers"),
        _extra("view_count", 0, "int", "views"),
        _extra("is_answered", False, "boolean"),
    ),
    "rss": (
        _extra("title", "", "string"),
        _extra("link", "", "string", "url"),
        _extra("feed_source", "", "string", "feed_name"),
        _extra("published_at", None, "timestamp", "published"),
    ),
}


def pick(df: DataFrame, names: Sequence[str]) -> str | None:
    """The first of ``names`` that the table has."""
    return next((n for n in names if n in df.columns), None)


def safe_column(df: DataFrame, names: Sequence[str], default: Column) -> Column:
    name = pick(df, names)
    return F.col(name) if name else default


def extra_column(df: DataFrame, extra: Extra) -> Column:
    """The first filled value of a row among the names the table has.

    Text keeps its NULLs; numbers and flags fall back to the default, also if malformed.
    """
    names = [n for n in extra.aliases if n in df.columns]
    if not names:
        return F.lit(extra.default).cast(extra.type)
    if extra.type == "timestamp":
        return _first_time(df, names)
    if extra.type == "string":
        return F.coalesce(*[F.col(n).cast("string") for n in names])
    return F.coalesce(*[F.col(n).try_cast(extra.type) for n in names], F.lit(extra.default).cast(extra.type))


def _first_time(df: DataFrame, names: Sequence[str]) -> Column:
    return F.coalesce(*[parse_time(F.col(n), df.schema[n].dataType) for n in names])


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def content_column(df: DataFrame, fallback: str = "table") -> Column:
    """The content: one column for the whole table, or with ``"row"`` the first filled one."""
    if fallback == "row":
        present = [F.col(c) for c in CONTENT_COLUMNS if c in df.columns]
        return F.coalesce(*[F.when(F.trim(c) != "", c) for c in present], F.lit(""))
    return safe_column(df, CONTENT_COLUMNS, F.lit(""))


def time_column(df: DataFrame, now: Column) -> Column:
    """The first time that a row has; without any such column, ``now``."""
    names = [n for n in TIME_COLUMNS if n in df.columns]
    return _first_time(df, names) if names else now


def keyword_column(df: DataFrame, source: str, keyword_columns: Sequence[str] | None = None) -> Column:
    """Keywords of a record: the names of its tags for nostr, mapped keywords otherwise."""
    if keyword_columns:
        return _first_strings(df, keyword_columns)
    if source == "nostr" and "tags" in df.columns:
        return F.transform("tags", lambda tag: F.get(tag, F.lit(0)))
    names = ("keywords",) if source == "nostr" else ("mapped_keywords", "keywords")
    return _first_strings(df, names)


def _first_strings(df: DataFrame, names: Sequence[str]) -> Column:
    """The first filled list of a row; a list that arrived as text is JSON."""
    def listed(name: str) -> Column:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        return F.from_json(name, "array<string>") if is_text else F.col(name)

    found = [listed(n) for n in names if n in df.columns]
    return F.coalesce(*found) if found else _no_strings()


def project_posts(
    records: DataFrame,
    source: str,
    now: Column | None = None,
    fallback: str = "table",
    keyword_columns: Sequence[str] | None = None,
) -> DataFrame:
    """All columns of the records, the nine post columns, and the extras of the feed."""
    now = F.current_timestamp() if now is None else now
    keywords = keyword_column(records, source, keyword_columns)
    columns = {
        "id": F.col("id").cast("string"),
        "source": F.lit(source),
        "content_clean": clean_content(content_column(records, fallback)),
        "collected_at": time_column(records, now),
        "processed_at": now,
        **{e.name: extra_column(records, e) for e in EXTRAS.get(source, ())},
        "keywords": keywords,
        "categories": _first_strings(records, ("categories",)),
        "is_remapped": F.coalesce(
            safe_column(records, ("is_remapped",), F.lit(False)).try_cast("boolean"), F.lit(False)
        ),
        "has_keywords": F.coalesce(F.size(keywords) > 0, F.lit(False)),
    }
    return records.withColumns(columns)


def dedup_posts(
    df: DataFrame, key: str = "id", order: Sequence[str] = ("collected_at", "content_clean")
) -> DataFrame:
    """One row per key: the earliest, ties settled by the content and then all other columns.

    ``min`` over a struct combines before the shuffle, so each task sends one row per key
    and a key with a third of all rows costs no more than another.  A window with
    ``row_number`` would bring all its rows into one task.  Rows without a key go first,
    before the shuffle.
    """
    maps = {f.name for f in df.schema.fields if isinstance(f.dataType, T.MapType)}
    first = [c for c in order if c in df.columns]
    rest = [c for c in df.columns if c != key and c not in first]
    ordered = [F.col(first[0]).isNull().alias("_no_time")] if first else []
    packed = F.struct(
        *ordered,
        *[F.col(c) for c in first],
        *[F.map_entries(c).alias(c) if c in maps else F.col(c) for c in rest],
    )
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(packed).alias("_row"))
    return kept.select(
        *[
            F.col(key)
            if c == key
            else (F.map_from_entries(f"_row.{c}") if c in maps else F.col(f"_row.{c}")).alias(c)
            for c in df.columns
        ]
    )


def valid_posts(df: DataFrame) -> DataFrame:
    return df.where(F.col("id").isNotNull() & (F.col("content_clean") != ""))


def transform_posts(records: DataFrame, source: str, **options: object) -> DataFrame:
    """Records of one feed to its processed posts.

    Deduplication comes before the content filter: an id whose earliest record is empty
    has no post.
    """
    return valid_posts(dedup_posts(project_posts(records, source, **options)))


def align_schema(df: DataFrame, schema: T.StructType = schemas.POST) -> DataFrame:
    """The post columns in order; missing ones get a typed empty array, false or NULL."""
    def column(f: T.StructField) -> Column:
        if f.name in df.columns:
            return F.col(f.name).cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, T.ArrayType):
            return F.array().cast(f.dataType).alias(f.name)
        if isinstance(f.dataType, T.BooleanType):
            return F.lit(False).alias(f.name)
        return F.lit(None).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in schema.fields])


def filter_future(posts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Posts collected up to ``as_of`` (now by default); posts without a time go too."""
    return posts.where(F.col("collected_at") <= (F.current_timestamp() if as_of is None else as_of))


def exclude_seen(records: DataFrame, seen: DataFrame, keys: Sequence[str] = ("source", "id")) -> DataFrame:
    """Records whose key is not among the seen ones.

    The seen keys need not be distinct: both sides come straight from one shuffle each, so
    AQE can split a hot key.
    """
    return records.join(seen.select(*keys), list(keys), "left_anti")
