"""Live feeds with Structured Streaming: read, envelope, deduplicate, tag, count, store.

The connector jar for Kafka is not part of PySpark; its reader and writer are option
builders around the same steps that the file source runs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from feedlake import schemas
from feedlake.operators.tagging import tag_with_tables
from feedlake.session import move_folder, remove_folder, scratch, subfolders
from feedlake.sources.zones import parse_lines, raw_path

FLUSH_RECORDS = 10_000
FLUSH_INTERVAL = "300 seconds"
SEEN_TTL = "7 days"
#: Ids that a sliding seen set holds per source, in so many buckets, each a group of the state.
SEEN_IDS = 1_000_000
SEEN_BUCKETS = 64
REPLAY_HOURS = 24.0
#: Texts compressed at the speed of a disk. Such files cannot be split, so they hold no more lines than a flush.
COMPACT = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": str(FLUSH_RECORDS)}

MESSAGE = "topic string, key string, value string, timestamp timestamp"


# --- sources -------------------------------------------------------------------------


def kafka_options(
    servers: str,
    topics: Sequence[str] = schemas.FEEDS,
    flush_records: int = FLUSH_RECORDS,
    flush_after: str = FLUSH_INTERVAL,
    max_records: int | None = None,
) -> dict:
    """A batch starts when ``flush_records`` per topic have come, or after ``flush_after``.

    A batch takes all there is; ``max_records`` is a limit for callers who want one.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "minOffsetsPerTrigger": str(flush_records * len(topics)),
        "maxTriggerDelay": flush_after,
    }
    return options | ({"maxOffsetsPerTrigger": str(max_records)} if max_records else {})


def read_kafka(spark: SparkSession, options: dict) -> DataFrame:
    """Messages as (topic, key, value, timestamp); needs the Kafka connector jar."""
    rows = spark.readStream.format("kafka").options(**options).load()
    return rows.select("topic", F.col("key").cast("string"), F.col("value").cast("string"), "timestamp")


def replay_options(servers: str, topic: str, since_ms: int) -> dict:
    """Batch read of a topic from a time on; partitions with nothing newer give no rows."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingTimestamp": str(since_ms),
        "startingOffsetsByTimestampStrategy": "latest",
        "endingOffsets": "latest",
    }


def read_message_files(
    spark: SparkSession, path: str, max_files: int | None = None, schema: str = MESSAGE
) -> DataFrame:
    """The same messages from JSON files that arrive in a folder."""
    reader = spark.readStream.schema(T.StructType.fromDDL(schema)).option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


# --- messages ------------------------------------------------------------------------


def envelope(records: DataFrame, topic: str | Column, ingested_at: Column | None = None) -> DataFrame:
    """Stamp records with the time of ingestion and their topic."""
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return records.withColumns(
        {
            "_ingested_at": F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
            "_source_topic": F.lit(topic) if isinstance(topic, str) else topic,
        }
    )


def to_messages(records: DataFrame, key: str = "id") -> DataFrame:
    """Enveloped records as keyed JSON messages."""
    return records.select(
        F.col("_source_topic").alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*records.columns)).alias("value"),
    )


def parse_messages(messages: DataFrame, schema: str) -> DataFrame:
    """The records of messages, by the rule of the raw zone: no message is lost, bad ones keep their text."""
    return parse_lines(messages.select("value"), schema)


def replay_seen_ids(messages: DataFrame, now: Column, hours: float = REPLAY_HOURS) -> DataFrame:
    """Distinct (source, id) of the messages of the last hours, for ``exclude_seen`` or to warm up ``drop_seen_sliding``.

    ``seen_at`` is when the id came last.
    """
    since = now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(hours * 3600).cast("decimal(18,6)"))
    ids = messages.where(F.col("timestamp") >= since).select(
        F.col("topic").alias("source"), F.get_json_object("value", "$.id").alias("id"), "timestamp"
    )
    return ids.where(F.col("id") != "").groupBy("source", "id").agg(F.max("timestamp").alias("seen_at"))


# --- operators -----------------------------------------------------------------------


def drop_seen(
    records: DataFrame,
    keys: Sequence[str] = ("source", "id"),
    ttl: str = SEEN_TTL,
    arrived: Column | None = None,
) -> DataFrame:
    """The first record of each key; a key is forgotten once ``ttl`` has passed since it came.

    The clock is that of arrival: the time of the batch, which a batch that is run again keeps.  However
    old the time in a record is, a key never seen before is never dropped.  The state holds
    one entry per key.
    """
    at = F.current_timestamp() if arrived is None else arrived
    stamped = records.withColumn("_arrived", at).withWatermark("_arrived", ttl)
    return stamped.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")


def _seen_set(ttl: int, most: int, time: str, columns: list[str]) -> StatefulProcessor:
    """``columns``: those of the records, then the id as text; ``time``: the one of the arrival; ``ttl`` in milliseconds."""

    # Made here, so that it goes to the executors with all it needs.
    class SeenSet(StatefulProcessor):
        """The ids of a bucket with the time at which each was met last, in milliseconds.

        A row is passed on if its id is not in the set or was met longer than ``ttl`` ago; either way it is met now.  At
        the end of a batch at most ``most`` ids stay, those met last.  A timer drops the ids that have run out.
        """

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.met = handle.getMapState("met", "id string", "at bigint")
            self.size = handle.getValueState("size", "n bigint")

        def handleInitialState(self, key, initialState, timerValues) -> None:
            for row in initialState.itertuples():
                self.met.updateValue((row.id,), (row.seen_at.value // 1_000_000,))
            self._resize(len(initialState))

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows), ignore_index=True)
            if batch.empty:  # a bucket of the initial state without rows
                return
            batch = batch.iloc[:, : len(columns)].set_axis(columns, axis=1)  # Spark renames those that start with _
            batch["_ms"] = batch[time].astype("datetime64[ms]").astype("int64")
            batch = batch.sort_values(["_id", "_ms"], kind="stable")
            before = batch.groupby("_id")["_ms"].shift()
            first = before.isna()
            known = {i: self._last(i) for i in batch["_id"][first]}
            before = before.where(~first, batch["_id"].map(known).astype("float64"))  # milliseconds are exact
            for i, at in batch.groupby("_id")["_ms"].max().items():
                self.met.updateValue((i,), (max(at, known[i] or at),))
            self._resize(sum(at is None for at in known.values()))
            if not any(True for _ in self.handle.listTimers()):
                self.handle.registerTimer(int(batch["_ms"].max()) + ttl)
            yield batch[before.isna() | (batch["_ms"] - before > ttl)].drop(columns=["_ms", "_id"])

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now = timerValues.getCurrentWatermarkInMs()
            left = [(k[0], v[0]) for k, v in self.met.iterator()]
            for i, at in left:
                if at + ttl < now:
                    self.met.removeKey((i,))
            left = [at for _, at in left if at + ttl >= now]
            self.size.update((len(left),))
            if left:
                self.handle.registerTimer(max(min(left) + ttl, now) + 1)
            return iter(())

        def _last(self, i: str) -> int | None:
            return self.met.getValue((i,))[0] if self.met.containsKey((i,)) else None

        def _resize(self, added: int) -> None:
            n = (self.size.get()[0] if self.size.exists() else 0) + added
            if n > most:
                oldest = sorted((v[0], k[0]) for k, v in self.met.iterator())[: n - most]
                for _, i in oldest:
                    self.met.removeKey((i,))
                n = most
            self.size.update((n,))

    return SeenSet()


def drop_seen_sliding(
    records: DataFrame,
    at: str,
    keys: tuple[str, str] = ("source", "id"),
    ttl: str = SEEN_TTL,
    most_ids: int = SEEN_IDS,
    buckets: int = SEEN_BUCKETS,
    warm: DataFrame | None = None,
) -> DataFrame:
    """Records whose key was not met within ``ttl``; each time that a key is met, its time begins anew.

    ``at`` is the time of arrival, which does not fall from batch to batch.  The seen set of a source is dealt to
    ``buckets`` by a hash of the id, so that no source is one group, and holds about ``most_ids``, the ones met last.
    ``warm`` (source, id, ``seen_at``; see ``replay_seen_ids``) fills the set of a query without a checkpoint.
    Records without an id are never dropped, nor remembered.  Start the query under ``rocksdb``.
    """
    source, key = keys
    spark = records.sparkSession
    milliseconds = int(spark.sql(f"SELECT unix_millis(timestamp_seconds(0) + INTERVAL {ttl})").first()[0])
    bucket = lambda name: F.pmod(F.xxhash64(F.col(name).cast("string")), F.lit(buckets))
    stamped = records.withColumns({"_id": F.col(key).cast("string"), "_bucket": bucket(key)}).withWatermark(at, "0 seconds")
    dealt = stamped.where(F.col("_id").isNotNull()).groupBy(source, "_bucket")
    start = None
    if warm is not None:
        start = warm.select(F.col("source").alias(source), bucket("id").alias("_bucket"), F.col("id").cast("string").alias("id"), "seen_at").groupBy(source, "_bucket")
    seen = _seen_set(milliseconds, max(1, most_ids // buckets), at, [*records.columns, "_id"])
    fresh = dealt.transformWithStateInPandas(seen, records.schema, "Append", "EventTime", initialState=start)
    return fresh.unionByName(stamped.where(F.col("_id").isNull()).select(*records.columns))


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries that are started in the block keep their state in RocksDB, as keyed sets and timers need."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def state_rows(query: StreamingQuery) -> DataFrame:
    """How many keys each stateful operator of a query held after each of its last batches, and how much memory they take."""
    spark = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.active()
    rows = [
        (p.batchId, i, o.operatorName, o.numRowsTotal, o.numRowsUpdated, o.numRowsRemoved, o.memoryUsedBytes)
        for p in query.recentProgress
        for i, o in enumerate(p.stateOperators)
    ]
    return spark.createDataFrame(
        rows, "batch long, operator int, name string, keys long, updated long, removed long, bytes long"
    )


def post_rate(
    records: DataFrame, at: str, window: str = "60 seconds", delay: str = "60 seconds"
) -> DataFrame:
    """Posts per source and tumbling window, counted so far; for ``write_rate``."""
    return (
        records.withWatermark(at, delay)
        .groupBy(F.window(at, window).alias("w"), "source")
        .agg(F.count(F.lit(1)).alias("posts"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "source", "posts")
    )


# --- sinks ---------------------------------------------------------------------------


def _start(writer, available_now: bool, interval: str) -> StreamingQuery:
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def write_raw_zone(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = FLUSH_INTERVAL,
) -> StreamingQuery:
    """Store each message value as one line below ``raw_path(path, topic)``/year/month/day/hour of its ingestion.

    Line breaks in a value, which JSON allows only between its tokens, become blanks.  The lines are compressed.
    Each batch has folders of its own, overwritten if the batch is run again after a
    failure, so every message is stored once.  A batch is gone through once and not kept: it is written
    beside the zone, all topics at a time, and its folders, a short list, are then moved to their places.
    """
    at = F.coalesce(F.try_to_timestamp(F.get_json_object("value", "$._ingested_at")), "timestamp", F.current_timestamp())
    parts = {n: F.date_format(at, f) for n, f in (("year", "yyyy"), ("month", "MM"), ("day", "dd"), ("hour", "HH"))}
    rows = messages.where(F.col("topic").isNotNull()).select(
        "topic", F.regexp_replace("value", r"[\r\n]+", " ").alias("value"), *[c.alias(n) for n, c in parts.items()]
    )

    # The name follows from the checkpoint: a run that comes after a crash removes what that has left.
    staged = f"{path.rstrip('/')}/_staged-{uuid.uuid5(uuid.NAMESPACE_URL, checkpoint).hex[:12]}"

    def store(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        # Spark has no folder of its own for an empty text, so that each name gets a character in front.
        named = batch.withColumns({"topic": F.concat(F.lit("-"), "topic"), "batch": F.lit(number)})
        try:
            named.write.mode("overwrite").options(**COMPACT).partitionBy("topic", *parts, "batch").text(staged)
            for topic, *folders in subfolders(spark, staged, len(parts) + 2):
                place = raw_path(path, unescape(topic.removeprefix("topic=-")))
                move_folder(spark, "/".join([staged, topic, *folders]), "/".join([place, *folders]))
        finally:
            remove_folder(spark, staged)

    writer = rows.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, available_now, interval)


def write_tagged(
    records: DataFrame,
    dictionaries: Callable[[SparkSession], tuple[DataFrame, DataFrame]],
    path: str,
    checkpoint: str,
    available_now: bool = False,
    interval: str = FLUSH_INTERVAL,
    **options,
) -> StreamingQuery:
    """Tag and remap each batch against dictionary tables of any size, below ``path``/batch.

    ``dictionaries`` is called for each batch, so keywords that have come since the last one count.  ``options``
    are those of ``tag_with_tables``.
    """

    def store(batch: DataFrame, number: int) -> None:
        batch = batch.persist()  # read once, though its words and its texts go different ways
        with scratch(batch.sparkSession, "tags") as folder:
            tagged = tag_with_tables(batch, *dictionaries(batch.sparkSession), folder=folder, **options)
            tagged.write.mode("overwrite").parquet(f"{path}/batch={number}")
        batch.unpersist()

    return _start(records.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint), available_now, interval)


def write_rate(
    rate: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = FLUSH_INTERVAL
) -> StreamingQuery:
    """Write the counts of the windows each batch has changed, open ones too, below ``path``/batch."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    writer = rate.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint)
    return _start(writer, available_now, interval)


def read_rate(spark: SparkSession, path: str) -> DataFrame:
    """The last count of each window, of all windows; counts only grow."""
    schema = "window_start timestamp, window_end timestamp, source string, posts bigint, batch bigint"
    counts = spark.read.schema(schema).parquet(path)
    return counts.groupBy("window_start", "window_end", "source").agg(F.max("posts").alias("posts"))


def write_parquet(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False, interval: str = FLUSH_INTERVAL
) -> StreamingQuery:
    writer = (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .option("path", path)
    )
    return _start(writer, available_now, interval)


def write_kafka(messages: DataFrame, servers: str, checkpoint: str, interval: str = FLUSH_INTERVAL) -> StreamingQuery:
    """Keyed messages to their topics; needs the Kafka connector jar."""
    writer = (
        messages.select("topic", "key", "value")
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("checkpointLocation", checkpoint)
    )
    return _start(writer, False, interval)


def ingest_new_files(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    process: Callable[[DataFrame, int], None],
    max_files: int | None = None,
) -> None:
    """Hand the lines (``value``) of files that no earlier run has seen to ``process``, then stop.

    The checkpoint is the bookmark: a run that fails hands the same batch, with the same
    batch number, to the next run.
    """
    reader = spark.readStream.option("recursiveFileLookup", True)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    (
        reader.text(path)
        .where(F.trim("value") != "")
        .writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
