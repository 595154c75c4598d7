"""Streaming queries, each run to the end of the files at hand and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.base import arr, query, ts
from contract.feeds import RECORDS_SQL, TAXONOMY, benchmark_dictionary, document_records, event_records, table, tagged_sql
from contract.texts import MIN_KEYWORDS, REMAP_SQL, REMAPPED_COLUMNS, synonym_table
from feedlake.operators.tagging import tag_posts
from feedlake.session import scratch_dir
from feedlake.sources import zones
from feedlake.streaming import live


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _event_messages(spark, sf, ingested_at="ts"):
    """Events as enveloped messages, by default ingested when they happened."""
    events = table(spark, sf, "events").withColumn(
        "half_day", F.timestamp_seconds(F.lit(1704067200) + F.pmod("event_id", F.lit(43200)))
    )
    records = events.select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("source"),
        F.col("props").alias("content"),
        F.col(ingested_at).cast("timestamp").alias("at"),
    )
    enveloped = live.envelope(records, F.col("source"), F.col("at")).drop("at")
    return live.to_messages(enveloped).withColumn(
        "timestamp", F.to_timestamp(F.get_json_object("value", "$._ingested_at"))
    )


def _incoming(spark, sf, root):
    _event_messages(spark, sf, "half_day").write.json(f"{root}/incoming")
    return live.read_message_files(spark, f"{root}/incoming")


def _finish(query) -> None:
    query.awaitTermination()


@query(
    "envelope_records",
    """SELECT event_type AS topic, CAST(event_id AS VARCHAR) AS key, event_id AS id, event_type AS source,
    props AS content, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS _ingested_at, event_type AS _source_topic FROM events""",
)
def envelope_records(spark, sf):
    fields = "id bigint, source string, content string, _ingested_at string, _source_topic string"
    messages = _event_messages(spark, sf)
    return messages.select("topic", "key", F.from_json("value", fields).alias("r")).select("topic", "key", "r.*")


@query(
    "stream_ingest",
    """SELECT event_id AS id, event_type AS source, props AS content, CAST(2024 AS INTEGER) AS year,
    CAST(1 AS INTEGER) AS month, CAST(1 AS INTEGER) AS day, CAST(event_id % 43200 // 3600 AS INTEGER) AS hour FROM events""",
)
def stream_ingest(spark, sf):
    root = scratch_dir(spark, "live")
    _finish(live.write_raw_zone(_incoming(spark, sf, root), f"{root}/raw", f"{root}/checkpoint", available_now=True))
    fields = "id bigint, content string, source string"
    zone = [zones.scan_raw_hours(spark, zones.raw_path(f"{root}/raw", source), fields) for source in EVENT_TYPES]
    return reduce(DataFrame.unionByName, zone).drop(zones.CORRUPT)


@query("stream_dedup", f"SELECT DISTINCT source, id FROM ({RECORDS_SQL['events']})")
def stream_dedup(spark, sf):
    root = scratch_dir(spark, "live")
    event_records(spark, sf).write.parquet(f"{root}/incoming")
    schema = "id string, source string, text string, collected_at timestamp"
    records = spark.readStream.schema(schema).parquet(f"{root}/incoming")
    # Files are read in one batch, so that the result does not depend on their order.
    fresh = live.drop_seen(records).select("source", "id")
    _finish(live.write_parquet(fresh, f"{root}/out", f"{root}/checkpoint", available_now=True))
    return spark.read.parquet(f"{root}/out")


@query(
    "stream_enrich",
    f"""WITH {tagged_sql(RECORDS_SQL['documents'])} SELECT id, content, {arr('mapped_keywords')} AS mapped_keywords,
    {arr('categories')} AS categories, is_remapped FROM tagged""",
)
def stream_enrich(spark, sf):
    root = scratch_dir(spark, "live")
    document_records(spark, sf).write.parquet(f"{root}/incoming")
    schema = "id string, source string, text string, collected_at timestamp"
    records = spark.readStream.schema(schema).parquet(f"{root}/incoming")
    tagged = tag_posts(records, TAXONOMY).select("id", "content", "mapped_keywords", "categories", "is_remapped")
    _finish(live.write_parquet(tagged, f"{root}/out", f"{root}/checkpoint", available_now=True))
    return spark.read.parquet(f"{root}/out")


@query(
    "stream_rate",
    f"""WITH m AS (SELECT date_trunc('minute', ts) AS s, event_type AS source FROM events),
    w AS (SELECT s, s + INTERVAL 60 SECOND AS e, source, count(*) AS posts FROM m GROUP BY 1, 2, 3)
    SELECT {ts('s')} AS window_start, {ts('e')} AS window_end, source, posts FROM w""",
)
def stream_rate(spark, sf):
    root = scratch_dir(spark, "live")
    event_records(spark, sf).write.parquet(f"{root}/incoming")
    schema = "id string, source string, text string, collected_at timestamp"
    records = spark.readStream.schema(schema).parquet(f"{root}/incoming")
    rate = live.post_rate(records, "collected_at")
    _finish(live.write_rate(rate, f"{root}/out", f"{root}/checkpoint", available_now=True))
    return live.read_rate(spark, f"{root}/out")


@query(
    "replay_seen_ids",
    f"""SELECT event_type AS source, CAST(event_id AS VARCHAR) AS id, {ts('max(ts)')} AS seen_at FROM events
    WHERE ts >= TIMESTAMP '2024-01-30 00:00:00' GROUP BY ALL""",
)
def replay_seen_ids(spark, sf):
    return live.replay_seen_ids(_event_messages(spark, sf), F.lit("2024-01-31 00:00:00").cast("timestamp"), 24)


@query("stream_enrich_join", REMAP_SQL)
def stream_enrich_join(spark, sf):
    """A stream against dictionary tables that are read anew for each batch and grow with the data."""
    root = scratch_dir(spark, "live")
    # The given file may be a single row group, and what arrives in one file would be read by few tasks.
    arriving = table(spark, sf, "documents").select("doc_id", "text").repartition("doc_id", "text")
    arriving.write.parquet(f"{root}/incoming")
    records = spark.readStream.schema("doc_id bigint, text string").parquet(f"{root}/incoming")
    benchmark_dictionary(spark, sf).write.parquet(f"{root}/dictionary")

    def dictionaries(session):
        dictionary = session.read.parquet(f"{root}/dictionary")
        return dictionary, synonym_table(dictionary, 5)

    options = {"key": "doc_id", "min_keywords": MIN_KEYWORDS}
    _finish(live.write_tagged(records, dictionaries, f"{root}/out", f"{root}/checkpoint", available_now=True, **options))
    return spark.read.parquet(f"{root}/out").select("doc_id", *REMAPPED_COLUMNS)


#: Ends of the slices of time that arrive one after the other.
SLICES = ("2024-01-08", "2024-01-16", "2024-01-24", "2024-02-02")
ARRIVALS = "id string, source string, arrived timestamp"


def _arrivals(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("id"), F.col("event_type").alias("source"), F.col("ts").cast("timestamp").alias("arrived")
    )


def _slices(arrivals):
    """The events of each slice of time; the last one has all the rest."""
    before = None
    for end in SLICES:
        rows = arrivals if before is None else arrivals.where(F.col("arrived") >= before)
        yield rows if end == SLICES[-1] else rows.where(F.col("arrived") < end)
        before = end


def _sliding(spark, slices, root, ttl, warm=None):
    """Each slice is a run of its own, which takes the state up from the checkpoint."""
    for rows in slices:
        rows.write.mode("append").parquet(f"{root}/incoming")
        records = spark.readStream.schema(ARRIVALS).parquet(f"{root}/incoming")
        with live.rocksdb(spark):
            fresh = live.drop_seen_sliding(records, "arrived", ttl=ttl, buckets=8, warm=warm)
            _finish(live.write_parquet(fresh, f"{root}/out", f"{root}/checkpoint", available_now=True))
    return spark.read.schema(ARRIVALS).parquet(f"{root}/out")


_GAPS = f"""a AS (SELECT CAST(user_id AS VARCHAR) AS id, event_type AS source, ts AS moment FROM events),
g AS (SELECT *, lag(moment) OVER (PARTITION BY source, id ORDER BY moment) AS prev FROM a)
SELECT id, source, {ts('moment')} AS arrived FROM g"""


@query("stream_dedup_sliding", f"WITH {_GAPS} WHERE prev IS NULL OR moment - prev > INTERVAL 36 HOUR")
def stream_dedup_sliding(spark, sf):
    root = scratch_dir(spark, "live")
    return _sliding(spark, _slices(_arrivals(spark, sf)), root, "36 hours")


@query(
    "stream_dedup_warm",
    f"WITH {_GAPS} WHERE moment >= TIMESTAMP '{SLICES[-2]}' AND (prev IS NULL OR prev < TIMESTAMP '{SLICES[-2]}' - INTERVAL 48 HOUR OR moment - prev > INTERVAL 72 HOUR)",
)
def stream_dedup_warm(spark, sf):
    """A query without a checkpoint, which knows the ids of the last 48 hours from their messages."""
    root = scratch_dir(spark, "live")
    arrivals = _arrivals(spark, sf)
    messages = live.to_messages(live.envelope(arrivals, F.col("source"), F.col("arrived"))).withColumn(
        "timestamp", F.to_timestamp(F.get_json_object("value", "$._ingested_at"))
    )
    past = messages.where(F.col("timestamp") < SLICES[-2])
    warm = live.replay_seen_ids(past, F.lit(SLICES[-2]).cast("timestamp"), 48)
    return _sliding(spark, list(_slices(arrivals))[-1:], root, "72 hours", warm)


@query(
    "stream_state",
    "WITH s(run, until) AS (VALUES " + ", ".join(f"({i}, TIMESTAMP '{end}')" for i, end in enumerate(SLICES)) + """)
    SELECT run, count(DISTINCT (event_type, user_id)) AS keys FROM s JOIN events ON ts < until OR run = 3 GROUP BY run""",
)
def stream_state(spark, sf):
    """Keys in the state of the seen set after each run."""
    root = scratch_dir(spark, "live")
    parts = []
    for run, rows in enumerate(_slices(_arrivals(spark, sf))):
        rows.write.mode("append").parquet(f"{root}/incoming")
        records = spark.readStream.schema(ARRIVALS).parquet(f"{root}/incoming")
        running = live.write_parquet(live.drop_seen(records), f"{root}/out", f"{root}/checkpoint", available_now=True)
        _finish(running)
        parts.append(live.state_rows(running).agg(F.max_by("keys", "batch").alias("keys")).select(F.lit(run).alias("run"), "keys"))
    return reduce(DataFrame.unionAll, parts)
