"""Curated tables on small posts, and relations that must hold between them."""

import json
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import contract.zones as contract_zones
from contract import QUERIES
from feedlake import schemas
from feedlake.operators import curated, reports
from feedlake.plans import lake
from feedlake.sources import catalog, inventory, zones

START = datetime(2024, 12, 27, 8)


def post(id_, source="a", at=START, content="text", keywords=(), categories=(), remapped=False):
    return (id_, source, content, at, at, list(keywords), list(categories), remapped, bool(keywords))


def frame(spark, rows):
    return spark.createDataFrame(rows, schemas.POST)


def many(n=600):
    """Posts of three sources over 40 days around a new year; source b has most, ids repeat."""
    words = ("python", "ai", "go", "kafka", None)
    return [
        post(
            None if i % 97 == 0 else str(i % 250),
            "bbbac"[i % 5],
            START + timedelta(hours=i * 1.6),
            f"text ai {'x' * (i % 300)}",
            words[: i % 6],
            ("c1", "c2")[: i % 3],
            i % 4 == 0,
        )
        for i in range(n)
    ]


def test_short_keywords(spark):
    posts = frame(
        spark,
        [
            post("1", content="we use AI.", keywords=["AI"]),
            post("2", content="we use AI now", keywords=["AI", "Python"]),
            post("3", content=None, keywords=["python", "ai"]),
            post("4", content="x", keywords=[None]),
        ],
    )
    rows = {(r.id, r.keyword) for r in curated.explode_keywords(posts).collect()}
    assert rows == {("2", "ai"), ("2", "python"), ("3", "python"), ("4", None)}


def test_growth_compares_with_the_previous_present_day(spark):
    posts = frame(spark, [post(str(i), at=START + timedelta(days=d)) for i, d in enumerate((0, 0, 2, 2, 2, 5))])
    rows = curated.growth_rate(curated.activity_rollup(posts)).orderBy("date").collect()
    assert [(r.total_posts, r.prev_day_posts, r.growth_pct, r.growth_abs) for r in rows] == [
        (2, None, None, None), (3, 2, 50.0, 1), (1, 3, -66.67, -2),
    ]


def test_length_threshold(spark):
    posts = frame(spark, [post("1", content="x" * 280), post("2", content="x" * 281)])
    r = curated.content_stats(curated.activity_rollup(posts)).first()
    assert (r.short_posts, r.long_posts, r.long_posts_pct, r.avg_length) == (1, 1, 50.0, 281.0)


def test_cross_sources(spark):
    posts = frame(
        spark,
        [post(str(i), s, keywords=[k]) for i, (s, k) in enumerate(
            [("a", "one"), ("a", "one"), ("a", "two"), ("b", "two"), ("b", "two"), *[(s, "three") for s in "abc"]]
        )],
    )
    cross = curated.cross_source_keywords(curated.tag_rollup(posts))
    rows = {r.keyword: r for r in cross.collect()}
    assert set(rows) == {"two", "three"}
    assert rows["two"].sources_list == ["a", "b"] and rows["two"].source_mentions == [1, 2]
    assert not rows["two"].is_viral and rows["three"].is_viral


def test_summaries_of_nothing(spark):
    posts = frame(spark, [])
    r = curated.global_summary(curated.activity_rollup(posts)).first()
    assert r.total_posts == 0 and r.active_sources == 0 and r.first_post is None
    kpi = reports.kpi_overview(curated.global_summary(curated.activity_rollup(posts))).first()
    assert kpi.total_with_keywords == 0


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """All tables, built from posts of which some lie in the future."""
    root = str(tmp_path_factory.mktemp("curated"))
    posts = frame(spark, many())
    as_of = F.lit("2025-03-01").cast("timestamp")
    lake.build_curated(frame(spark, [*many(), post("f", at=datetime(2030, 1, 1))]), root, as_of)
    return posts, root, zones.load_curated(spark, root)


def rows_of(df):
    columns = sorted(c for c in df.columns if c != "aggregated_at")
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


def test_rollups_give_the_volumes(built):
    posts, _, tables = built
    for name in ("volume_by_source", "volume_by_week", "volume_by_month"):
        assert rows_of(tables[name]) == rows_of(getattr(curated, name)(posts)), name


def test_all_tables_follow_the_declared_types(built):
    _, _, tables = built
    assert set(tables) == set(schemas.CURATED) and len(tables) == 14
    for name, df in tables.items():
        declared = {f.name: f.dataType for f in schemas.curated_schema(name).fields}
        assert {f.name: f.dataType for f in df.schema.fields} == declared
        assert not df.isEmpty()


def test_relations(built):
    posts, _, t = built

    def total(name, column):
        return t[name].agg(F.sum(column)).first()[0]

    assert total("keywords_by_source", "mentions") == total("trending_keywords", "mentions")
    assert total("volume_by_source", "total_posts") == t["global_summary"].first().total_posts
    assert total("hourly_activity", "post_count") == total("volume_by_month", "total_posts")
    r = t["content_stats"].agg(F.sum("long_posts"), F.sum("short_posts")).first()
    assert r[0] + r[1] == posts.count()
    assert t["extended_summary"].first().unique_keywords == t["trending_keywords"].select("keyword").distinct().count()


def test_a_second_build_is_equal(spark, built, tmp_path):
    posts, _, tables = built
    lake.build_curated(posts.repartition(13), str(tmp_path), F.lit("2025-03-01").cast("timestamp"))
    again = zones.load_curated(spark, str(tmp_path))
    for name in tables:
        assert rows_of(again[name]) == rows_of(tables[name]), name


def test_catalog_has_all_tables(spark, built):
    _, root, tables = built
    names = catalog.register_catalog(spark, "feedlake_test", curated=root)
    assert set(names) == set(tables)
    for name, df in tables.items():
        assert spark.table(f"feedlake_test.{name}").count() == df.count(), name


def test_missing_curated_tables_are_empty_and_typed(spark, tmp_path):
    tables = zones.load_curated(spark, str(tmp_path / "nothing"))
    assert tables["growth_rate"].isEmpty() and "growth_pct" in tables["growth_rate"].columns


def test_heatmap_has_all_hours(spark):
    posts = frame(spark, [post("1"), post("2", "b", START + timedelta(hours=1))])
    heat = reports.heatmap_source_hour(curated.hourly_activity(curated.activity_rollup(posts))).orderBy("source").collect()
    assert len(heat[0]) == 25 and heat[0].h8 == 1 and heat[0].h9 == 0 and heat[1].h9 == 1


def test_top_on_last_day(spark):
    trending = spark.createDataFrame(
        [(date(2024, 1, 1), "a", 9, 1), (date(2024, 1, 2), "b", 1, 1), (date(2024, 1, 2), "c", 1, 1)],
        "date date, keyword string, mentions bigint, sources_count bigint",
    )
    assert [r.keyword for r in reports.top_keywords_on_date(trending).collect()] == ["b", "c"]
    assert [r.keyword for r in reports.top_keywords_on_date(trending, date(2024, 1, 1)).collect()] == ["a"]
    assert [r.keyword for r in reports.top_keywords(trending, 2).collect()] == ["a", "b"]


def test_scans_skip_what_is_missing(spark, tmp_path):
    root = str(tmp_path)
    assert zones.scan_sources(spark, root) is None
    zones.write_processed(frame(spark, [post("1", "rss")]), root, "rss")
    zones.write_processed(frame(spark, []), root, "nostr")
    assert [r.source for r in zones.scan_sources(spark, root).collect()] == ["rss"]
    assert lake.run_lake(spark, f"{root}/no_raw", f"{root}/no_processed", f"{root}/out") is None


def test_no_line_is_lost(spark, tmp_path):
    """Mistyped fields, cut lines, fields that are not declared: as many rows whatever is asked for."""
    lines = ['{"id": "1", "score": 1, "likes": 7}', "not json", '{"id": "2", "score": "n/a"}', "", '{"id": "3", "score": 2.5, "Extra": {"a": [1]}}']
    (tmp_path / "f.json").write_text("\n".join(lines))
    records = zones.scan_raw_jsonl(spark, str(tmp_path), "id string, score int", discover=True)
    assert records.count() == records.select("id").count() == records.select("score").count() == 4
    found = {r["id"]: r for r in records.collect()}
    assert found["1"].score == 1 and found["1"].likes == "7" and found["1"][zones.CORRUPT] is None
    assert found["2"].score is None and found["2"][zones.CORRUPT] == lines[2]
    assert found["3"].score is None and found["3"].Extra == '{"a":[1]}'
    assert found[None][zones.CORRUPT] == "not json"
    assert [r.value for r in inventory.preview(spark, str(tmp_path), 2).collect()] == lines[:2]


def drop_lines(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(line) for line in lines))


def news(i, **more):
    return {"id": i, "title": f"t{i}", "text": f"text {i}", "timestamp": 1704067200 + i * 60, "source": "hackernews", **more}


def test_a_second_run_adds_nothing(spark, tmp_path):
    raw, processed, out = (str(tmp_path / n) for n in ("raw", "processed", "curated"))
    drop_lines(tmp_path / "raw" / "hackernews", "1.json", [news(i) for i in range(10)])
    for _ in range(2):
        tables = lake.run_lake(spark, raw, processed, out)
        assert tables["global_summary"].first().total_posts == 10
    drop_lines(tmp_path / "raw" / "hackernews", "2.json", [news(3), news(10)])
    assert lake.run_lake(spark, raw, processed, out)["global_summary"].first().total_posts == 12  # an id of two batches is two posts
    catalog.register_catalog(spark, "feedlake_rerun", processed=processed, sources=("hackernews",))
    assert spark.table("feedlake_rerun.processed_hackernews").count() == 12


def test_an_ingest_leaves_no_shuffled_rows(spark, tmp_path):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    drop_lines(tmp_path / "raw" / "hackernews", "1.json", [news(i) for i in range(10)])
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffled(), spark.conf.get(name)
    lake.ingest_source(spark, str(tmp_path / "raw"), str(tmp_path / "processed"), "hackernews", str(tmp_path / "cp"))
    assert not shuffled() - before and spark.conf.get(name) == setting
    posts = zones.scan_processed(spark, str(tmp_path / "processed"), "hackernews")
    assert posts.count() == 10
    codecs = {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in (tmp_path / "processed").rglob("*.parquet")}
    assert codecs == {"ZSTD"}


def test_the_lake_removes_its_messages(spark, sf, tmp_path, monkeypatch):
    """Once they lie in the raw zone, which keeps all lines of both runs."""
    monkeypatch.setattr(contract_zones, "scratch_dir", lambda spark, label: str(tmp_path / label))
    found = {r.source: r.posts for r in QUERIES["run_lake_twice"](spark, sf).collect()}
    assert not (tmp_path / "lake" / "incoming").exists()
    for source, posts in found.items():
        assert zones.scan_raw_hours(spark, zones.raw_path(str(tmp_path / "lake" / "raw"), source), "id string").count() >= posts > 0


def test_unique_ids_across_batches(spark, tmp_path):
    raw, processed, out = (str(tmp_path / n) for n in ("raw", "processed", "curated"))
    for name, ids in (("1.json", (1, 2)), ("2.json", (2, 3))):
        drop_lines(tmp_path / "raw" / "hackernews", name, [news(i) for i in ids])
        tables = lake.run_lake(spark, raw, processed, out, unique=True)
    assert tables["global_summary"].first().total_posts == 3


def test_bad_lines_are_kept_apart(spark, tmp_path):
    folder = tmp_path / "raw" / "hackernews"
    drop_lines(folder, "1.json", [news(1, score="many"), news(2)])
    (folder / "2.json").write_text('{"id": 3, "tit')
    tables = lake.run_lake(spark, str(tmp_path / "raw"), str(tmp_path / "processed"), str(tmp_path / "out"))
    assert tables["global_summary"].first().total_posts == 2
    bad = [r.value for r in lake.bad_lines(spark, str(tmp_path / "processed"), "hackernews").collect()]
    assert len(bad) == 2 and '{"id": 3, "tit' in bad


def test_source_names_stay_text(spark, tmp_path):
    zones.write_processed(frame(spark, [post("1", "007")]), str(tmp_path), "007")
    assert zones.scan_processed(spark, str(tmp_path), "007").first().source == "007"


def test_other_errors_are_not_taken_for_missing_folders(spark, tmp_path):
    (tmp_path / "rss").mkdir()
    (tmp_path / "rss" / "x.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        zones.scan_sources(spark, str(tmp_path))


def test_tables_take_new_columns(spark, tmp_path, caplog):
    path = str(tmp_path / "t")
    spark.range(3).selectExpr("id", "id AS old").write.parquet(path)
    spark.sql("DROP TABLE IF EXISTS feedlake_columns")
    spark.sql(f"CREATE TABLE feedlake_columns (id bigint, gone string) USING parquet LOCATION '{path}'")
    assert catalog.update_table(spark, "feedlake_columns", path) == ["old"]
    assert "gone" in caplog.text and spark.table("feedlake_columns").columns == ["id", "gone", "old"]
    assert {r.column: r.type for r in catalog.discover_schema(spark, path).collect()} == {"id": "bigint", "old": "bigint"}


def test_scratch_is_gone_after_a_build(spark, tmp_path):
    import os

    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base)) if os.path.isdir(base) else set()
    lake.build_curated(frame(spark, many()), str(tmp_path))
    assert set(os.listdir(base)) == before


def test_rss_files(spark, tmp_path):
    (tmp_path / "feed.xml").write_text(
        "<rss><channel><title>News</title><link>http://n</link>"
        "<item><guid>g1</guid><title>A &amp; B</title><link>l1</link><description>d</description>"
        "<pubDate>Mon, 01 Jan 2024 10:00:00 GMT</pubDate><category>x</category><category>y</category></item>"
        "<item><title>C</title><link>l2</link></item></channel></rss>"
    )
    rows = zones.scan_rss_xml(spark, str(tmp_path)).orderBy("link").collect()
    assert [(r.id, r.title, r.feed_name, [t.term for t in r.tags or []]) for r in rows] == [
        ("g1", "A & B", "News", ["x", "y"]), (None, "C", "News", []),
    ]


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "k.csv").write_text("keyword,category,category_rank\npython,tech,0\nkafka,,\n")
    (tmp_path / "s.csv").write_text("word,target\nlove,python\n")
    kw, syn = zones.load_dictionary(spark, str(tmp_path / "k.csv"), str(tmp_path / "s.csv"))
    assert kw.count() == 2 and syn.first().target == "python"
