"""Curated tables by increments, ids across batches, crawling, feed files, fields of many spellings."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.operators import curated
from feedlake.plans import lake, maintained
from feedlake.session import remove_folder
from feedlake.sources import catalog, seen, zones

DAY = datetime(2024, 12, 20)
AS_OF = datetime(2025, 1, 20)


def posts(spark, days, ids, source="a", at=0):
    """One post a day of each id, over New Year, where a week label has days of both ends of a year."""
    rows = [
        (f"{i}", source, f"text {i}", DAY + timedelta(days=d, hours=(i + at) % 24), None, ["kw", f"k{i % 3}"], ["cat"], i % 2 == 0, True)
        for d in days
        for i in ids
    ]
    return spark.createDataFrame(rows, schemas.POST)


def rows_of(tables):
    return {name: sorted(map(str, df.drop("aggregated_at").collect())) for name, df in tables.items()}


@pytest.mark.parametrize("most_runs", (24, 2))
def test_increments_equal_a_full_build(spark, tmp_path, monkeypatch, most_runs):
    """Each run reads its own batch only: the batches before it are gone by then."""
    monkeypatch.setattr(maintained, "MOST_RUNS", most_runs)
    drops = [
        {"a": posts(spark, range(0, 6), range(5)), "b": posts(spark, (0, 11, 12), range(3), "b")},
        {"a": posts(spark, (5, 6, 13), range(3, 9), at=3)},  # days and ids that have been before
        {"b": posts(spark, (11, 40), range(2, 5), "b")},  # the 29th of January lies in the future
        {},
        {"a": posts(spark, (27,), (1,)), "c": posts(spark, (27,), (1,), "c")},
    ]
    update = lambda as_of: maintained.update_curated(
        spark, str(tmp_path / "new"), str(tmp_path / "state"), str(tmp_path / "out"), as_of, ("a", "b", "c")
    )
    for batch, drop in enumerate(drops):
        for source, df in drop.items():
            zones.write_processed(df, str(tmp_path / "all"), source, batch)
            zones.write_processed(df, str(tmp_path / "new"), source, batch)
        assert update(F.lit(AS_OF)) == bool(drop)
        for source in drop:
            remove_folder(spark, str(tmp_path / "new" / source / f"source={source}" / f"ingest_batch={batch}"))
        everything = zones.scan_sources(spark, str(tmp_path / "all"), ("a", "b", "c"))
        lake.build_curated(everything, str(tmp_path / "full"), F.lit(AS_OF))
        assert rows_of(zones.load_curated(spark, str(tmp_path / "out"))) == rows_of(zones.load_curated(spark, str(tmp_path / "full"))), batch
    assert not update(F.lit(AS_OF))
    later = F.lit(datetime(2025, 3, 1))  # what waited has come
    assert update(later) and not update(later)
    lake.build_curated(everything, str(tmp_path / "full"), later)
    assert rows_of(zones.load_curated(spark, str(tmp_path / "out"))) == rows_of(zones.load_curated(spark, str(tmp_path / "full")))
    runs = {p.name for p in (tmp_path / "state" / "activity").iterdir()}
    assert len(runs) == (5 if most_runs == 24 else len(runs)) <= 5 and (most_runs == 24 or len(runs) <= 3)


def test_a_run_that_failed_counts_once(spark, tmp_path, monkeypatch):
    zones.write_processed(posts(spark, range(3), range(4)), str(tmp_path / "in"), "a", 0)
    args = spark, str(tmp_path / "in"), str(tmp_path / "state"), str(tmp_path / "out"), F.lit(AS_OF), ("a",)
    with monkeypatch.context() as m:
        m.setattr(maintained, "_mark", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            maintained.update_curated(*args)
    zones.write_processed(posts(spark, range(2), range(2)), str(tmp_path / "in"), "a", 1)
    assert maintained.update_curated(*args)
    summary = zones.load_curated(spark, str(tmp_path / "out"))["global_summary"].first()
    assert summary.total_posts == 12 + 4
    with pytest.raises(ValueError):
        maintained.update_curated(*args, exact=False)


def test_sketches_merge(spark):
    """Estimates of unions of parts, of sets of 100 to 60,000 ids."""
    sizes = {"a": 100, "b": 5_000, "c": 60_000}
    rows = spark.range(60_000).select(F.explode(F.array(*map(F.lit, sizes))).alias("source"), F.col("id").alias("n"))
    limit = F.element_at(F.create_map(*[F.lit(x) for p in sizes.items() for x in p]), F.col("source"))
    rows = rows.where(F.col("n") < limit).select(
        "source", F.col("n").cast("string").alias("id"), F.expr("timestamp '2024-02-01' + make_dt_interval(int(n % 40))").alias("collected_at")
    )
    parts = [rows.where(F.pmod(F.xxhash64("id"), F.lit(3)) != p) for p in range(3)]  # each id in two of three
    sketches = [curated.unique_sketches(p) for p in parts]
    found = curated.uniques_from_sketches(sketches[0].unionByName(sketches[1]).unionByName(sketches[2]))
    exact = curated.unique_rollup(rows).withColumnRenamed("unique_posts", "exact")
    both = exact.join(found, ["grain", "period", "source"], "full").collect()
    assert len(both) > 100 and all(abs(r.unique_posts - r.exact) <= 0.02 * r.exact for r in both)


# --- ids across batches ----------------------------------------------------------------


def test_the_history_of_ids_is_not_shuffled(spark, tmp_path, monkeypatch):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = seen.declare(spark, str(tmp_path / "seen"), 4)
        ids = lambda *n: spark.createDataFrame([(str(i), "x") for i in n], "id string, source string")
        seen.remember(ids(*range(100)), table, "a", 0)
        seen.remember(ids(*range(100, 150)), table, "a", 1)
        seen.remember(ids(200), table, "b", 0)
        seen.remember(ids(*range(100, 120)), table, "a", 1)  # the batch again
        fresh = seen.exclude_remembered(ids(5, 110, 130, 200, 300), table, "a", 2)
        assert sorted(r.id for r in fresh.collect()) == ["130", "200", "300"] and fresh.columns == ["id", "source"]
        assert sorted(r.id for r in seen.exclude_remembered(ids(5, 110), table, "a", 1).collect()) == ["110"]
        plan = fresh._jdf.queryExecution().executedPlan().toString()
        history = [line for line in plan.split("\n") if "FileScan" in line and table in line]
        assert history and all("Bucketed: true" in line for line in history)
        final = plan.split("== Initial Plan ==")[0]
        assert sum("Exchange hashpartitioning" in line for line in final.split("\n")) == 1  # the batch alone
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_ids_of_batches_before_the_table_count(spark, tmp_path):
    """A zone that was filled without the table: its posts are the history."""
    lines = lambda *n: [json.dumps({"id": i, "content": f"c{i}", "source": "s", "created_at": "2024-01-01T00:00:00Z"}) for i in n]
    schema = "id bigint, source string, content string, created_at string"
    (tmp_path / "raw" / "events").mkdir(parents=True)
    for batch, ids in enumerate(((1, 2), (2, 3), (3, 4, 1))):
        (tmp_path / "raw" / "events" / f"{batch}.json").write_text("\n".join(lines(*ids)))
        lake.ingest_source(spark, str(tmp_path / "raw"), str(tmp_path / "p"), "events", str(tmp_path / "cp"), schema, unique=batch > 0)
    found = sorted((r.id, r.ingest_batch) for r in zones.scan_processed(spark, str(tmp_path / "p"), "events").collect())
    assert found == [("1", 0), ("2", 0), ("3", 1), ("4", 2)]


# --- crawling ----------------------------------------------------------------------------


def test_types_of_files_are_merged(spark, tmp_path):
    frames = [
        spark.sql("SELECT 1 AS a, float(1) AS b, array(struct(1 AS x)) AS c, 'x' AS d, decimal(1.5) AS e"),
        spark.sql("SELECT 1L AS a, 1D AS b, array(struct(2L AS x, 'y' AS y)) AS c, 1 AS d, decimal(12345.678) AS e"),
        spark.sql("SELECT smallint(1) AS a, 'new' AS f"),
    ]
    for i, df in enumerate(frames * 3):
        df.coalesce(1).write.parquet(str(tmp_path / "t" / f"part={i}"))
    schema, conflicts = catalog.crawl_schema(spark, str(tmp_path / "t"))
    types = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert types["a"] == "bigint" and types["b"] == "double" and types["c"] == "array<struct<x:bigint,y:string>>" and types["f"] == "string"
    assert {c[0] for c in conflicts} == {"d"} and types["d"] in ("string", "int")
    assert catalog.crawl_schema(spark, str(tmp_path))[0] == schema


def test_a_widened_column_can_be_read(spark, tmp_path):
    root = str(tmp_path / "p")
    df = posts(spark, (0,), range(3))
    zones.write_processed(df.withColumns({"n": F.lit(7), "x": F.lit(0.5).cast("float"), "s": F.lit("text")}), root, "a", 0)
    report = {(r.column, r.change) for r in catalog.crawl_catalog(spark, "feedlake_wide", root, sources=("a", "none")).collect()}
    assert ("n", "added") in report
    zones.write_processed(df.withColumns({"n": F.lit(2**40), "x": F.lit(0.25), "s": F.lit(3)}), root, "a", 1)
    report = {r.column: (r.type, r.change) for r in catalog.crawl_catalog(spark, "feedlake_wide", root, sources=("a",)).collect()}
    assert report["n"] == ("bigint", "widened") and report["x"] == ("double", "widened") and report["s"] == ("string", "conflict")
    rows = spark.table("feedlake_wide.processed_a").select("n", "x", "ingest_batch").distinct().collect()
    assert sorted((r.n, r.x, r.ingest_batch) for r in rows) == [(7, 0.5, 0), (2**40, 0.25, 1)]


# --- feed files --------------------------------------------------------------------------


def test_feeds_of_both_kinds(spark, tmp_path):
    files = {
        "rss.xml": '<rss xmlns:dc="d"><channel><title>R</title><link>http://r</link><item><guid isPermaLink="false">g1</guid><title>one</title>'
        "<dc:creator>me</dc:creator><description><![CDATA[<b>x</b>]]></description><category>a</category><category>b</category></item>"
        "<item><title>two</title><author>her</author><dc:creator>me</dc:creator></item></channel></rss>",
        "atom.xml": '<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title><link href="http://a"/><entry><id>e1</id><title type="html">three</title>'
        '<link rel="self" href="s"/><link href="http://a/3"/><author><name>n</name></author><content>c</content><published>p</published><updated>u</updated>'
        '<category term="t"/></entry><entry><id>e2</id><link rel="related" href="only"/></entry></feed>',
        "empty.xml": "<rss><channel><title>nothing yet</title></channel></rss>",
        "cut.xml": "<rss><channel><title>x</title><item><title>y",
        "page.html": "<html><body>moved</body></html>",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    rows = {r.title or r.id: r for r in zones.scan_rss_xml(spark, str(tmp_path)).collect()}
    assert set(rows) == {"one", "two", "three", "e2"}
    one, two, three = rows["one"], rows["two"], rows["three"]
    assert (one.id, one.author, one.summary, [t.term for t in one.tags], one.feed_url) == ("g1", "me", "<b>x</b>", ["a", "b"], "http://r")
    assert two.author == "her" and two.id is None
    assert (three.id, three.link, three.author, three.summary, three.published, three.feed_name) == ("e1", "http://a/3", "n", "c", "p", "A")
    assert rows["e2"].link == "only" and rows["e2"].feed_url == "http://a"
    bad = {r.file.rsplit("/", 1)[1]: r.value for r in zones.bad_feed_files(spark, str(tmp_path)).collect()}
    assert bad == {n: files[n] for n in ("cut.xml", "page.html")}


# --- undeclared fields -------------------------------------------------------------------


def test_all_spellings_of_a_field_are_kept(spark):
    rows = [{"id": 1, "Likes": 1}, {"id": 2, "likes": 2}, {"id": 3, "LIKES": None, "likes": 3}, {"id": 4}]
    lines = spark.createDataFrame([(json.dumps(r),) for r in rows], "value string")
    extra = zones.discover_columns(lines, "id int")
    assert extra == {"LIKES": ["LIKES", "Likes", "likes"]}
    assert sorted((r.id, r.LIKES) for r in zones.parse_lines(lines, "id int", extra).collect()) == [(1, "1"), (2, "2"), (3, "3"), (4, None)]


def test_names_without_end_are_a_map(spark, tmp_path):
    """20,000 different names: no column each, no stop, and no value lost."""
    lines = spark.range(20_000).selectExpr("to_json(map('id', cast(id as string), concat('k', id), 'v')) AS value")
    assert zones.discover_columns(lines, "id string") is None
    rows = zones.parse_lines(lines, "id string", None)
    assert rows.columns == ["id", zones.CORRUPT, zones.REST]
    assert rows.where(F.col(zones.REST)[F.concat(F.lit("k"), "id")] == "v").count() == 20_000
    schema = "id string, source string, content string, created_at string"
    lines.withColumn("value", F.regexp_replace("value", "^\\{", '{"content":"c","created_at":"2024-01-01T00:00:00Z",')).write.text(str(tmp_path / "raw" / "x"))
    lake.ingest_source(spark, str(tmp_path / "raw"), str(tmp_path / "p"), "x", str(tmp_path / "cp"), schema)
    assert zones.scan_processed(spark, str(tmp_path / "p"), "x").count() == 20_000


def test_texts_of_one_row_group_are_tagged_by_several_tasks(spark, tmp_path):
    """All documents lie in one row group, which one task reads; their texts are dealt out before they are tagged."""
    from contract import feeds

    rows = [(i, f"text {i} of spark", "en", "web") for i in range(200)] + [(None, "ai", "en", "web"), (7, None, "en", None)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    documents.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task
    try:
        posts = feeds.document_posts(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.task for r in posts}) > 1
    assert sorted(str(r.id) for r in posts if r.has_keywords) == sorted([str(i) for i in range(200)])
