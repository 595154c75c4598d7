"""Records to posts: column picks, times, extras, deduplication, alignment."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from feedlake.functions.times import parse_time, week_label
from feedlake.operators import transform
from feedlake.operators.normalize import normalize_hackernews, normalize_rss
from feedlake.sources.zones import union_sources


def posts_of(spark, rows, ddl, source="bluesky", **options):
    return transform.transform_posts(spark.createDataFrame(rows, ddl), source, **options)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Mon, 01 Jan 2024 10:00:00 GMT", datetime(2024, 1, 1, 10)),
        ("Mon, 1 Jan 2024 10:00:00 +0000", datetime(2024, 1, 1, 10)),
        ("01 Jan 2024 10:00:00 -0230", datetime(2024, 1, 1, 12, 30)),
        ("2024-01-01T00:00:00.123Z", datetime(2024, 1, 1, 0, 0, 0, 123000)),
        ("2024-01-01T00:00:00.123456", datetime(2024, 1, 1, 0, 0, 0, 123456)),
        ("n/a", None),
        ("Mon, 99 Jan 2024 10:00:00 GMT", None),
        (None, None),
    ],
)
def test_time_of_text(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_time(F.col("t"), df.schema["t"].dataType)).first()[0] == expected


def test_time_of_epoch(spark):
    df = spark.createDataFrame([(1704067200,)], "t bigint")
    assert df.select(parse_time(F.col("t"), df.schema["t"].dataType)).first()[0] == datetime(2024, 1, 1)


def test_week_label(spark):
    df = spark.createDataFrame([("2024-12-30",)], "d string").select(F.to_date("d").alias("d"))
    assert df.select(week_label(F.col("d"))).first()[0] == "2024-W01"
    assert df.select(week_label(F.col("d"), iso_year=True)).first()[0] == "2025-W01"


def test_link_post(spark):
    ddl = "id bigint, title string, text string, timestamp bigint"
    rows = [(1, "a title", "", 1704067200)]
    assert posts_of(spark, rows, ddl, "hackernews").count() == 0
    kept = posts_of(spark, rows, ddl, "hackernews", fallback="row").first()
    assert kept.content_clean == "a title" and kept.id == "1"


def test_duplicate_ids_keep_the_earliest(spark):
    ddl = "id string, content string, created_at string, categorized_keywords map<string, array<string>>"
    rows = [
        ("a", "late", "2024-01-02T00:00:00Z", {"x": ["1"]}),
        ("a", "early", "2024-01-01T00:00:00Z", {"y": ["2"]}),
        ("a", "no time", None, {}),
        ("b", "same b", "2024-01-01T00:00:00Z", None),
        ("b", "same a", "2024-01-01T00:00:00Z", None),
        (None, "no id", "2024-01-01T00:00:00Z", None),
        ("c", "", "2024-01-01T00:00:00Z", None),
        ("c", "later", "2024-01-02T00:00:00Z", None),
    ]
    for partitions in (1, 5):
        df = spark.createDataFrame(rows, ddl).repartition(partitions)
        kept = {r.id: r for r in transform.transform_posts(df, "bluesky").collect()}
        assert {k: r.content_clean for k, r in kept.items()} == {"a": "early", "b": "same a"}
        assert kept["a"].categorized_keywords == {"y": ["2"]} and kept["b"].categorized_keywords is None


def test_hot_id_is_combined_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.timestamp_seconds(F.col("id")).alias("collected_at"),
        F.lit("x").alias("content_clean"),
    )
    kept = transform.dedup_posts(df)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan and "Window" not in plan
    assert kept.count() == 667 and kept.where("id = 'hot'").first().collected_at == datetime(1970, 1, 1)


def test_defaults_and_bad_numbers(spark):
    r = posts_of(
        spark, [("1", "t", "x", "n/a", 3)], "id string, content string, link string, score string, answers int", "stackoverflow"
    ).first()
    assert (r.title, r.link, r.score, r.answer_count, r.view_count, r.is_answered) == ("", "x", 0, 3, 0, False)
    assert (r.keywords, r.categories, r.is_remapped, r.has_keywords) == ([], [], False, False)
    assert r.processed_at is not None and r.collected_at is not None


def test_first_filled_name_of_each_row(spark):
    """Fields that were not declared come as text; each row has its value under another name."""
    ddl = "id string, content string, views int, view_count string, collected_at string, timestamp bigint, keywords string"
    rows = [("1", "a", 3, None, None, 1704067200, '["k", "l"]'), ("2", "b", None, "7", "2024-01-03T00:00:00Z", None, None), ("3", "c", None, "x", None, None, None)]
    found = {r.id: r for r in posts_of(spark, rows, ddl, "stackoverflow").collect()}
    assert [found[i].view_count for i in "123"] == [3, 7, 0]
    assert [found[i].collected_at for i in "123"] == [datetime(2024, 1, 1), datetime(2024, 1, 3), None]
    assert [found[i].keywords for i in "123"] == [["k", "l"], None, None] and found["1"].has_keywords


def test_nostr_keywords_are_tag_names(spark):
    ddl = "id string, content string, created_at bigint, tags array<array<string>>, mapped_keywords array<string>"
    r = posts_of(spark, [("1", "t", 0, [["t", "x"], []], ["k"])], ddl, "nostr").first()
    assert r.keywords == ["t", None] and r.has_keywords and r.kind == 1
    none = posts_of(spark, [("1", "t", 0, None, ["k"])], ddl, "nostr").first()
    assert none.keywords is None and not none.has_keywords


def test_rss_reaches_the_posts(spark):
    ddl = "id string, summary string, published string, feed_name string, url string"
    r = posts_of(spark, [("1", "s", "Mon, 01 Jan 2024 10:00:00 GMT", "f", "u")], ddl, "rss").first()
    assert r.collected_at == r.published_at == datetime(2024, 1, 1, 10)
    assert (r.feed_source, r.link, r.title) == ("f", "u", "")


def test_align_and_union(spark):
    ts = datetime(2024, 1, 1)
    a = spark.createDataFrame([("1", "s", "c", ts)], "id string, source string, content_clean string, collected_at timestamp")
    r = union_sources([a, a.withColumn("is_remapped", F.lit(True))]).orderBy("is_remapped").collect()
    assert r[0].keywords == [] and r[0].processed_at is None and not r[0].has_keywords and r[1].is_remapped
    assert union_sources([]) is None


def test_future_posts_and_posts_without_time(spark):
    df = spark.createDataFrame(
        [(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 3)), (3, None)], "n int, collected_at timestamp"
    )
    kept = transform.filter_future(df, F.lit("2024-01-02").cast("timestamp"))
    assert [r.n for r in kept.collect()] == [1]
    assert transform.filter_future(df).count() == 2


def test_story_list_order(spark):
    items = spark.createDataFrame(
        [(1, "story", "t", "u", None, "by", 1, None, 0), (2, "job", "t", "u", "x", "by", 1, 2, 0), (3, "story", "t", "u", "x", "by", 1, 2, 0)],
        "id bigint, type string, title string, url string, text string, by string, score int, descendants int, time bigint",
    )
    lists = spark.createDataFrame([("best", 1), ("top", 1), ("show", 2), ("other", 3)], "list string, id bigint")
    rows = normalize_hackernews(items, lists).collect()
    assert [(r.id, r.story_type, r.comments, r.text) for r in rows] == [(1, "top", 0, "")]


def test_rss_digest_of_the_first_filled_key(spark):
    ddl = (
        "id string, link string, title string, author string, summary string, published string, "
        "tags array<struct<term:string>>, feed_name string, feed_url string"
    )
    rows = [("", "l", "t", None, "s" * 600, None, None, "f", "u"), (None, "", "t", None, None, None, [("x",)], "f", "u")]
    assert len(normalize_rss(spark.createDataFrame(rows, ddl)).first().summary) == 600
    r = normalize_rss(spark.createDataFrame(rows, ddl), summary_chars=500).collect()
    import hashlib

    assert [x.id for x in r] == [hashlib.md5(k.encode()).hexdigest() for k in ("l", "t")]
    assert len(r[0].summary) == 500 and r[0].tags == [] and r[1].tags == ["x"] and r[1].summary == ""
