"""Streams over several batches: expiry, restart, exactly one copy."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from feedlake.session import build_session, scratch_dir
from feedlake.sources import zones
from feedlake.streaming import live

DAY = datetime(2024, 1, 1)


def drop_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def record(id_, day, source="a"):
    return {"id": id_, "source": source, "at": (DAY + timedelta(days=day)).isoformat()}


def run_dedup(spark, base):
    """The time of arrival is in the records, so that a test can let days pass."""
    records = spark.readStream.schema("id string, source string, at timestamp").json(str(base / "in"))
    fresh = live.drop_seen(records, arrived=F.col("at"))
    live.write_parquet(fresh, str(base / "out"), str(base / "cp"), available_now=True).awaitTermination()
    return sorted((r.id, r.source, (r.at - DAY).days) for r in spark.read.parquet(str(base / "out")).collect())


def test_an_id_is_forgotten_after_the_ttl(spark, tmp_path):
    """Each run is a restart: the state comes back from the checkpoint."""
    drop_file(tmp_path / "in", "1.json", [record("x", 0), record("x", 1), record("x", 0, "b")])
    assert run_dedup(spark, tmp_path) in ([("x", "a", 0), ("x", "b", 0)], [("x", "a", 1), ("x", "b", 0)])
    drop_file(tmp_path / "in", "2.json", [record("x", 5), record("y", 20)])
    assert len(run_dedup(spark, tmp_path)) == 3
    drop_file(tmp_path / "in", "3.json", [record("x", 21)])
    assert ("x", "a", 21) in run_dedup(spark, tmp_path)


def test_an_old_record_never_seen_is_kept(spark, tmp_path):
    """The clock is that of arrival: the time in a record says nothing about having seen it."""
    for name, rows in (("1.json", [record("x", 30)]), ("2.json", [record("y", 0), record("x", 0)]), ("3.json", [record("z", 1)])):
        drop_file(tmp_path / "in", name, rows)
        records = spark.readStream.schema("id string, source string, at timestamp").json(str(tmp_path / "in"))
        live.write_parquet(live.drop_seen(records), str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["x", "y", "z"]


def run_sliding(spark, base, **options):
    records = spark.readStream.schema("id string, source string, at timestamp").json(str(base / "in"))
    with live.rocksdb(spark):
        fresh = live.drop_seen_sliding(records, "at", **options)
        live.write_parquet(fresh, str(base / "out"), str(base / "cp"), available_now=True).awaitTermination()
    found = spark.read.schema("id string, source string, at timestamp").parquet(str(base / "out")).collect()
    return sorted(((r.id, r.source, (r.at - DAY).days) for r in found), key=str)


def test_meeting_an_id_begins_its_time_anew(spark, tmp_path):
    drop_file(tmp_path / "in", "1.json", [record("x", 0), record("x", 5), record("x", 0, "b"), record(None, 1), record(None, 1)])
    assert run_sliding(spark, tmp_path) == [("x", "a", 0), ("x", "b", 0), (None, "a", 1), (None, "a", 1)]
    drop_file(tmp_path / "in", "2.json", [record("x", 11), record("x", 11, "b")])  # six days, eleven days
    assert run_sliding(spark, tmp_path)[:3] == [("x", "a", 0), ("x", "b", 0), ("x", "b", 11)]
    drop_file(tmp_path / "in", "3.json", [record("y", 40)])
    drop_file(tmp_path / "in", "4.json", [record("x", 41), record("x", 48), record("x", 56)])
    kept = run_sliding(spark, tmp_path)
    assert [r for r in kept if r[:2] == ("x", "a")] == [("x", "a", 0), ("x", "a", 41), ("x", "a", 56)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_the_ids_met_last_stay(spark, tmp_path):
    """A set of three: the id that was met longest ago is forgotten, though its time has not run out."""
    bound = {"most_ids": 3, "buckets": 1}
    drop_file(tmp_path / "in", "1.json", [record("a", 0), record("b", 1), record("c", 2)])
    run_sliding(spark, tmp_path, **bound)
    drop_file(tmp_path / "in", "2.json", [record("a", 3), record("d", 4)])
    run_sliding(spark, tmp_path, **bound)
    drop_file(tmp_path / "in", "3.json", [record(i, 5) for i in "abcd"])
    kept = run_sliding(spark, tmp_path, **bound)
    assert [r for r in kept if r[2] == 5] == [("b", "a", 5)]


def test_a_fresh_query_is_warmed_up(spark, tmp_path):
    rows = [("a", '{"id": "1"}', DAY), ("a", '{"id": "2"}', DAY - timedelta(days=3)), ("b", '{"id": "1"}', DAY - timedelta(hours=2))]
    messages = spark.createDataFrame(rows, "topic string, value string, timestamp timestamp")
    warm = live.replay_seen_ids(messages, F.lit(DAY), 24)
    drop_file(tmp_path / "in", "1.json", [record("1", 1), record("2", 1), record("1", 1, "b"), record("1", 1, "c")])
    assert run_sliding(spark, tmp_path, warm=warm) == [("1", "c", 1), ("2", "a", 1)]
    drop_file(tmp_path / "in", "2.json", [record("1", 2), record("2", 2), record("3", 2)])
    assert run_sliding(spark, tmp_path, warm=warm)[-1] == ("3", "a", 2)


def test_dictionaries_are_read_for_each_batch(spark, tmp_path, monkeypatch):
    from feedlake.functions import taxonomy

    monkeypatch.setattr(taxonomy, "INLINE_LIMIT", 1)  # by join
    words = tmp_path / "words"
    dictionaries = lambda s: zones.load_dictionary(s, str(words / "k.csv"), str(words / "s.csv"))
    words.mkdir()
    (words / "s.csv").write_text("word,target\nlove,spark\n")
    for run, keywords in enumerate(("kafka,tools,1\nai,,\n", "kafka,tools,1\nai,,\nspark,engines,0\n")):
        (words / "k.csv").write_text("keyword,category,category_rank\n" + keywords)
        drop_file(tmp_path / "in", f"{run}.json", [{"id": f"{run}", "text": "love Kafka"}, {"id": f"{run}x", "text": "kafka spark ai"}])
        records = spark.readStream.schema("id string, text string").json(str(tmp_path / "in"))
        live.write_tagged(records, dictionaries, str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    rows = {r.id: r for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["0"].content == rows["1"].content == "spark Kafka" and rows["0"].categories == ["tools"]
    assert rows["1"].categories == ["engines", "tools"] and rows["1"].mapped_keywords == ["kafka", "spark"]
    assert rows["0x"].mapped_keywords == ["ai", "kafka"] and rows["1x"].mapped_keywords == ["ai", "kafka", "spark"]


def test_state_of_each_batch(spark, tmp_path):
    drop_file(tmp_path / "in", "1.json", [record("x", 0), record("x", 0), record("y", 0)])
    records = spark.readStream.schema("id string, source string, at timestamp").json(str(tmp_path / "in"))
    query = live.write_parquet(live.drop_seen(records), str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True)
    query.awaitTermination()
    rows = live.state_rows(query).collect()
    assert rows[-1].batch >= 0 and rows[-1]["keys"] == 2 and rows[-1].bytes > 0


def test_raw_zone_keeps_each_message_once(spark, tmp_path):
    def message(i):
        value = json.dumps({"id": i, "_ingested_at": f"2024-01-01T0{i % 3}:00:00.000001"})
        return {"topic": "rss" if i % 2 else "nostr", "key": str(i), "value": value}

    for part in range(3):
        drop_file(tmp_path / "in", f"{part}.json", [message(part * 4 + i) for i in range(4)])
        messages = live.read_message_files(spark, str(tmp_path / "in"), max_files=1)
        live.write_raw_zone(messages, str(tmp_path / "raw"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    found = {}
    for source in ("rss", "nostr"):
        path = zones.raw_path(str(tmp_path / "raw"), source)
        found[source] = zones.scan_raw_hours(spark, path, "id int").collect()
        assert spark.read.option("recursiveFileLookup", True).text(path).count() == len(found[source])
    assert sorted(r.id for rows in found.values() for r in rows) == list(range(12))
    assert {(s, r.hour) for s, rows in found.items() for r in rows} == {(s, h) for s in found for h in (0, 1, 2)}


def test_messages_of_several_lines_are_one_line(spark, tmp_path):
    value = json.dumps({"id": "1", "content": "a\nb", "_ingested_at": "2024-01-01T00:00:00"}, indent=2)
    drop_file(tmp_path / "in", "1.json", [{"topic": "rss", "key": "1", "value": value}, {"topic": "rss", "key": "2", "value": "no\njson"}])
    messages = live.read_message_files(spark, str(tmp_path / "in"))
    live.write_raw_zone(messages, str(tmp_path / "raw"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    rows = zones.scan_raw_jsonl(spark, zones.raw_path(str(tmp_path / "raw"), "rss"), "id string, content string").collect()
    assert sorted(((r.id, r.content, r[zones.CORRUPT]) for r in rows), key=str) == [("1", "a\nb", None), (None, None, "no json")]
    parsed = live.parse_messages(spark.read.schema(live.MESSAGE).json(str(tmp_path / "in")), "id string")
    assert sorted((r.id, r[zones.CORRUPT]) for r in parsed.collect() if r.id) == [("1", None)] and parsed.count() == 2


def test_raw_zone_is_compressed_and_a_batch_is_not_kept(spark, tmp_path, monkeypatch):
    """Topics of any name; a batch that is run again replaces itself."""

    def no_copy(*_):
        raise AssertionError("a copy of the whole batch")

    topics, n = ("rss", "a b%41=c"), live.FLUSH_RECORDS + 1
    value = F.to_json(F.struct("id", F.repeat(F.lit("word "), 20).alias("content"), F.lit("2024-01-02T03:00:00").alias("_ingested_at")))
    rows = spark.range(2 * n, numPartitions=1).select(F.element_at(F.array(*map(F.lit, topics)), (F.col("id") % 2 + 1).cast("int")).alias("topic"), value.alias("value"))
    rows.write.json(str(tmp_path / "in"))
    monkeypatch.setattr(type(rows), "persist", no_copy)
    monkeypatch.setattr(type(rows), "cache", no_copy)
    for _ in range(2):
        messages = live.read_message_files(spark, str(tmp_path / "in"))
        live.write_raw_zone(messages, str(tmp_path / "raw"), str(tmp_path / "cp"), available_now=True).awaitTermination()
        for name in ("0", ".0.crc"):
            (tmp_path / "cp" / "commits" / name).unlink()
    assert sorted(p.name for p in (tmp_path / "raw").iterdir()) == sorted(topics)
    for topic in topics:
        files = [p for p in (tmp_path / "raw" / topic / "year=2024" / "month=01" / "day=02" / "hour=03" / "batch=0").glob("part-*")]
        lines = spark.read.option("recursiveFileLookup", True).text(zones.raw_path(str(tmp_path / "raw"), topic))
        assert lines.count() == lines.distinct().count() == n
        assert len(files) > 1 and sum(p.stat().st_size for p in files) < n * 50


def test_envelope(spark):
    at = F.lit("2024-01-02 03:04:05").cast("timestamp")
    records = spark.createDataFrame([(7, "x")], "id bigint, content string")
    r = live.to_messages(live.envelope(records, "rss", at)).first()
    assert (r.topic, r.key) == ("rss", "7")
    assert json.loads(r.value) == {
        "id": 7, "content": "x", "_ingested_at": "2024-01-02T03:04:05.000000", "_source_topic": "rss"
    }


def test_rate_counts_all_windows(spark, tmp_path):
    """Windows that are still open when the stream stops, and one that a second run goes on with."""
    for name, seconds in (("1.json", (0, 59, 60, 300)), ("2.json", (310,))):
        drop_file(tmp_path / "in", name, [{"source": "a", "at": (DAY + timedelta(seconds=s)).isoformat()} for s in seconds])
        records = spark.readStream.schema("source string, at timestamp").json(str(tmp_path / "in"))
        live.write_rate(live.post_rate(records, "at"), str(tmp_path / "out"), str(tmp_path / "cp"), available_now=True).awaitTermination()
    found = sorted((r.window_start, r.posts) for r in live.read_rate(spark, str(tmp_path / "out")).collect())
    assert found == [(DAY, 2), (DAY + timedelta(seconds=60), 1), (DAY + timedelta(seconds=300), 2)]


def test_replay(spark):
    rows = [("rss", '{"id": "1"}', DAY), ("rss", '{"id": "2"}', DAY - timedelta(hours=1)), ("rss", '{"x": 1}', DAY)]
    messages = spark.createDataFrame(rows, "topic string, value string, timestamp timestamp")
    ids = live.replay_seen_ids(messages, F.lit(DAY), 0.75)
    assert [(r.source, r.id) for r in ids.collect()] == [("rss", "1")]


def test_kafka_options():
    options = live.kafka_options("h:9092", ["a", "b"])
    assert options["subscribe"] == "a,b" and "maxOffsetsPerTrigger" not in options
    assert options["minOffsetsPerTrigger"] == "20000" and options["maxTriggerDelay"] == "300 seconds"
    assert live.kafka_options("h:9092", max_records=5)["maxOffsetsPerTrigger"] == "5"
    assert live.replay_options("h:9092", "a", 5)["startingTimestamp"] == "5"


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_session_is_utc():
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"
