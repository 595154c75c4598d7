"""Zones, catalog, exports and the whole lake, written below the shared scratch folder."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contract.aggregates import SQL, TABLES
from contract.base import day, portable, query, ts
from contract.feeds import (
    CLEAN,
    as_of,
    document_posts,
    event_posts,
    lake_sql,
    posts_sql,
    table,
    tagged_sql,
)
from contract.payloads import (
    BLUESKY_SQL,
    HACKERNEWS_SQL,
    NOSTR_SQL,
    RSS_SQL,
    STACKOVERFLOW_SQL,
    all_posts,
    normalize_bluesky,
    normalize_hackernews,
    normalize_rss,
    normalize_stackoverflow,
    nostr_records,
)
from feedlake import schemas
from feedlake.operators import curated
from feedlake.operators.transform import filter_future
from feedlake.plans import lake, maintained, saved_sql
from feedlake.session import remove_folder, scratch_dir
from feedlake.sources import catalog, inventory, zones
from feedlake.streaming import live

RECORD = "id bigint, source string, content string, created_at string, value double"
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def _event_lines(spark, sf):
    """Events as feed records, one per event."""
    return table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("event_type").alias("source"),
        F.col("props").alias("content"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        "value",
        F.date_format("ts", "yyyy").alias("year"),
        F.date_format("ts", "MM").alias("month"),
        F.date_format("ts", "dd").alias("day"),
    )


def _raw_zone(spark, sf):
    root = f"{scratch_dir(spark, 'raw')}/events"
    _event_lines(spark, sf).write.partitionBy("year", "month", "day").json(root)
    return root


EVENT_LINES_SQL = f"""SELECT event_id AS id, event_type AS source, props AS content,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS created_at, value FROM events"""


@query("scan_raw_jsonl", EVENT_LINES_SQL)
def scan_raw_jsonl(spark, sf):
    return zones.scan_raw_jsonl(spark, _raw_zone(spark, sf), RECORD).drop(zones.CORRUPT)


# Clicks have a field that is not declared, in two spellings, errors a number that is none, signups a line that is cut off.
@query(
    "scan_raw_dirty",
    """SELECT CASE WHEN event_type <> 'signup' THEN event_id END AS id, CASE WHEN event_type <> 'signup' THEN event_type END AS source,
    CASE WHEN event_type NOT IN ('signup', 'error') THEN value END AS value, CASE WHEN event_type = 'click' THEN '7' END AS likes,
    event_type IN ('signup', 'error') AS bad FROM events""",
)
def scan_raw_dirty(spark, sf):
    """Live messages, pretty-printed over several lines, stored in the raw zone and scanned: no line is lost."""
    root, kind = scratch_dir(spark, "dirty"), F.col("event_type")
    body = F.concat(
        F.lit('{\n  "id": '), F.col("event_id").cast("string"), F.lit(',\r\n "source": "'), kind,
        F.when(kind == "click", F.when(F.col("event_id") % 2 == 0, '", "likes": 7').otherwise('", "Likes": 7')).otherwise('"'),
        F.lit(', "value": '), F.when(kind == "error", '"n/a"').otherwise(F.to_json(F.struct("value"))), F.lit("}"),
    )
    nested = F.regexp_replace(body, r'"value": \{"value":([^}]*)\}', r'"value": $1')
    value = F.when(kind == "signup", F.substring(nested, 1, 12)).otherwise(nested)
    messages = table(spark, sf, "events").select(
        F.lit("mixed").alias("topic"), F.col("event_id").cast("string").alias("key"), value.alias("value"),
        F.timestamp_seconds(F.lit(1704067200) + F.pmod("event_id", F.lit(43200))).alias("timestamp"),
    )
    messages.write.parquet(f"{root}/incoming")
    incoming = spark.readStream.schema(messages.schema).parquet(f"{root}/incoming")
    live.write_raw_zone(incoming, f"{root}/raw", f"{root}/checkpoint", available_now=True).awaitTermination()
    records = zones.scan_raw_jsonl(spark, zones.raw_path(f"{root}/raw", "mixed"), "id bigint, source string, value double", discover=True)
    return records.select("id", "source", "value", F.col("Likes").alias("likes"), F.col(zones.CORRUPT).isNotNull().alias("bad"))


@query(
    "scan_raw_day",
    f"""SELECT *, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, CAST(12 AS INTEGER) AS day
    FROM ({EVENT_LINES_SQL}) WHERE created_at LIKE '2024-01-12%'""",
)
def scan_raw_day(spark, sf):
    records = zones.scan_raw_hours(spark, _raw_zone(spark, sf), RECORD)
    return records.where((F.col("month") == 1) & (F.col("day") == 12)).drop("hour", zones.CORRUPT)


@query(
    "raw_line_counts",
    f"SELECT {day('ts')} AS day, count(*) AS lines FROM events GROUP BY 1",
)
def raw_line_counts(spark, sf):
    counts = inventory.raw_line_counts(spark, _raw_zone(spark, sf))
    folder = F.regexp_extract("path", r"year=(\d+)/month=(\d+)/day=(\d+)", 0)
    return counts.groupBy(F.regexp_replace(F.regexp_replace(folder, "year=", ""), "/(month|day)=", "-").alias("day")).agg(
        F.sum("lines").alias("lines")
    )


def _daily_files(spark, sf):
    """A folder per day of events, its lines in order over the files; a day with many events has several."""
    root = f"{scratch_dir(spark, 'raw')}/events"
    (
        _event_lines(spark, sf)
        .repartitionByRange("year", "month", "day", "id")
        .sortWithinPartitions("year", "month", "day", "id")
        .write.partitionBy("year", "month", "day")
        .json(root)
    )
    return root


@query("raw_preview", "SELECT event_id AS id, event_type AS source FROM events WHERE ts < (SELECT date_trunc('day', min(ts)) FROM events) + INTERVAL 1 DAY ORDER BY event_id LIMIT 5")
def raw_preview(spark, sf):
    """The first lines of the first file by name."""
    files = inventory.list_files(spark, _daily_files(spark, sf))
    lines = inventory.preview(spark, files.agg(F.min("path")).first()[0])
    return zones.parse_lines(lines, "id bigint, source string").drop(zones.CORRUPT)


@query(
    "incremental_ingest",
    f"""SELECT CAST(event_id AS VARCHAR) AS id, 'events' AS source, props AS content_clean, {ts('ts')} AS collected_at,
    CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS run FROM events""",
)
def incremental_ingest(spark, sf):
    """Two drops of files, three runs: the second sees the second drop, the third sees nothing."""
    root = scratch_dir(spark, "ingest")
    lines = _event_lines(spark, sf).drop("year", "month", "day")
    first = F.col("created_at") < "2024-01-16"
    for drop in (lines.where(first), lines.where(~first), None):
        if drop is not None:
            drop.write.mode("append").json(f"{root}/raw/events")
        lake.ingest_source(spark, f"{root}/raw", f"{root}/processed", "events", f"{root}/checkpoint", RECORD)
    posts = zones.scan_processed(spark, f"{root}/processed", "events")
    return posts.select("id", "source", "content_clean", "collected_at", F.col("ingest_batch").cast("int").alias("run"))


def _processed(spark, sf):
    root = scratch_dir(spark, "processed")
    posts = event_posts(spark, sf)
    for source in EVENT_TYPES:
        zones.write_processed(posts.where(F.col("source") == source), root, source)
    return root


@query(
    "write_processed",
    f"""WITH {posts_sql('documents')} SELECT source, count(*) AS posts, CAST(sum(len(keywords)) AS BIGINT) AS keywords,
    CAST(sum(length(content_clean)) AS BIGINT) AS chars FROM p GROUP BY 1""",
)
def write_processed(spark, sf):
    root = scratch_dir(spark, "processed")
    zones.write_processed(document_posts(spark, sf), root, "documents")
    posts = zones.scan_processed(spark, root, "documents")
    return posts.groupBy("source").agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum(F.size("keywords")).alias("keywords"),
        F.sum(F.length("content_clean")).alias("chars"),
    )


@query(
    "scan_processed",
    f"""WITH {posts_sql('events')} SELECT id, source, {ts('collected_at')} AS collected_at FROM p WHERE source = 'click'""",
)
def scan_processed(spark, sf):
    return zones.scan_processed(spark, _processed(spark, sf), "click").select("id", "source", "collected_at")


@query(
    "scan_sources",
    f"WITH {posts_sql('events')} SELECT source, count(*) AS posts FROM p GROUP BY 1",
)
def scan_sources(spark, sf):
    posts = zones.scan_sources(spark, _processed(spark, sf), (*EVENT_TYPES, "no_such_source"))
    return posts.groupBy("source").agg(F.count(F.lit(1)).alias("posts"))


def _lake_table(name: str) -> str:
    """The SQL of a curated table, over the posts of all feeds."""
    body = SQL[name].replace("WITH ", "", 1)
    for feed in ("documents", "events"):
        body = body.replace(posts_sql(feed), "lake0 AS (SELECT 1)")
    return f"(WITH lake1 AS (SELECT 1), {body})"


NUMBERS = ("bigint", "int", "double")


def _columns(name: str) -> tuple[list[str], list[str]]:
    """The columns of a curated table that say what a row is about, and its numbers."""
    fields = [column.split() for column in schemas.CURATED[name][1].split(", ")]
    numbers = [f for f, kind in fields if kind in NUMBERS]
    return [f for f, _ in fields if f not in numbers], numbers


def _long_sql(name: str) -> str:
    keys, numbers = _columns(name)
    key = " || '/' || ".join(f"coalesce(CAST({k} AS VARCHAR), '')" for k in keys) or "''"
    each = ", ".join(f"struct_pack(measure := '{m}', value := CAST({m} AS DOUBLE))" for m in numbers)
    return (
        f"SELECT name, key, u.measure AS measure, u.value AS value FROM (SELECT '{name}' AS name, {key} AS key, unnest([{each}]) AS u FROM {_lake_table(name)})"
    )


LAKE = f"WITH {lake_sql()} " + " UNION ALL ".join(_long_sql(name) for name in schemas.CURATED)


def _long(tables):
    """All columns of curated tables, one row per number."""

    def long(name, df):
        keys, numbers = _columns(name)
        plain = portable(df)
        key = F.concat_ws("/", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
        each = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in numbers])
        return plain.select(F.lit(name).alias("name"), key.alias("key"), F.inline(each))

    return reduce(DataFrame.unionByName, [long(n, df) for n, df in tables.items()])


@query("build_curated", LAKE)
def build_curated(spark, sf):
    """All fourteen tables, written and read back."""
    root = scratch_dir(spark, "curated")
    lake.build_curated(all_posts(spark, sf), root, as_of())
    return _long(zones.load_curated(spark, root))


def _batches(spark, sf, root):
    """The posts of all feeds as three batches of the processed zone, each written when it is asked for.

    Rows of one id lie in different batches, and each batch has rows of all days.
    """
    posts = all_posts(spark, sf)
    dealt = F.pmod(F.xxhash64("id", "collected_at", "source"), F.lit(7))
    for number, rows in enumerate((dealt < 4, dealt.between(4, 5), dealt == 6)):
        zones.write_processed(posts.where(rows), root, "lake", number)
        yield number


def _maintained(spark, sf, **options):
    root = scratch_dir(spark, "maintained")
    for _ in _batches(spark, sf, f"{root}/processed"):
        maintained.update_curated(spark, f"{root}/processed", f"{root}/state", f"{root}/curated", as_of(), ("lake",), **options)
    return zones.load_curated(spark, f"{root}/curated")


@query("maintained_curated", LAKE)
def maintained_curated(spark, sf):
    """All fourteen tables after three runs, of which each reads only its own batch."""
    return _long(_maintained(spark, sf))


@query(
    "volume_sketched",
    f"""WITH {lake_sql()}, v AS (
    SELECT 'day' AS grain, CAST(date AS VARCHAR) AS period, source, total_posts, unique_posts FROM {_lake_table('volume_by_source')}
    UNION ALL SELECT 'week', year_week, source, total_posts, unique_posts FROM {_lake_table('volume_by_week')}
    UNION ALL SELECT 'month', year_month, source, total_posts, unique_posts FROM {_lake_table('volume_by_month')})
    SELECT grain, period, source, total_posts, unique_posts, true AS close FROM v""",
)
def volume_sketched(spark, sf):
    """Distinct ids from sketches that were merged over three runs, each within 2 % of the exact number beside it."""
    tables = _maintained(spark, sf, exact=False)
    posts = curated.slim_posts(all_posts(spark, sf))
    exact = curated.unique_rollup(posts).withColumnRenamed("unique_posts", "exact")
    grains = {"day": ("volume_by_source", F.col("date").cast("string")), "week": ("volume_by_week", F.col("year_week")), "month": ("volume_by_month", F.col("year_month"))}
    volumes = reduce(
        DataFrame.unionByName,
        [tables[t].select(F.lit(g).alias("grain"), period.alias("period"), "source", "total_posts", "unique_posts") for g, (t, period) in grains.items()],
    )
    met = volumes.join(exact, ["grain", "period", "source"], "left").withColumn("exact", F.coalesce("exact", F.lit(0)))
    close = F.abs(F.col("unique_posts") - F.col("exact")) <= 0.02 * F.col("exact")
    return met.select("grain", "period", "source", "total_posts", F.col("exact").alias("unique_posts"), close.alias("close"))


@query(
    "load_curated",
    f"WITH {lake_sql()} " + " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {_lake_table(n)}" for n in schemas.CURATED if n != "growth_rate")
    + " UNION ALL SELECT 'growth_rate', 0",
)
def load_curated(spark, sf):
    """All tables as a dashboard loads them; one that was never written is empty."""
    root = scratch_dir(spark, "curated")
    lake.build_curated(all_posts(spark, sf), root, as_of())
    remove_folder(spark, schemas.curated_path(root, "growth_rate"))
    tables = zones.load_curated(spark, root)
    return reduce(DataFrame.unionByName, [t.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n, t in tables.items()])


_EPOCH_SQL = "TIMESTAMP '1970-01-01' + to_seconds({})"
#: The posts of five feeds, by the rules of each for content, time and keywords.
FIVE_FEEDS = f"""p AS (SELECT * FROM (
    SELECT * FROM (WITH {tagged_sql(BLUESKY_SQL, keep='id, created_at')} SELECT id, 'bluesky' AS source, {CLEAN.format('content')} AS content_clean,
      strptime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS collected_at, mapped_keywords AS keywords, categories, is_remapped, len(mapped_keywords) > 0 AS has_keywords FROM tagged)
    UNION ALL SELECT * FROM (WITH {tagged_sql(NOSTR_SQL, keep='id, created_at, tags')} SELECT id, 'nostr', {CLEAN.format('content')},
      {_EPOCH_SQL.format('created_at')}, CASE WHEN contains(tags, ',') THEN string_split(tags, ',') ELSE [tags, NULL] END, categories, is_remapped, true
      FROM tagged WHERE len(mapped_keywords) > 0)
    UNION ALL SELECT CAST(id AS VARCHAR), 'hackernews', {CLEAN.format('text')}, {_EPOCH_SQL.format('timestamp')}, [], [], false, false FROM ({HACKERNEWS_SQL})
    UNION ALL SELECT CAST(id AS VARCHAR), 'stackoverflow', {CLEAN.format('body')}, {_EPOCH_SQL.format('timestamp')}, [], [], false, false FROM ({STACKOVERFLOW_SQL})
    UNION ALL SELECT id, 'rss', content_clean, tm, [], [], false, false FROM (
      SELECT *, row_number() OVER (PARTITION BY id ORDER BY tm, content_clean) AS rn FROM (
        SELECT *, {CLEAN.format('summary')} AS content_clean, strptime(published, '%a, %d %b %Y %H:%M:%S GMT') AS tm FROM ({RSS_SQL}))) WHERE rn = 1
    ) WHERE content_clean <> '')"""


@query("run_lake", f"WITH {FIVE_FEEDS} " + " UNION ALL ".join(_long_sql(name) for name in schemas.CURATED))
def run_lake(spark, sf):
    """Records of all five feeds as raw JSON lines, through the processed zone, to all fourteen curated tables."""
    root = scratch_dir(spark, "lake")
    feeds = {
        "bluesky": normalize_bluesky, "nostr": nostr_records, "hackernews": normalize_hackernews,
        "stackoverflow": normalize_stackoverflow, "rss": normalize_rss,
    }
    for source, records in feeds.items():
        live.envelope(records(spark, sf), source).write.json(zones.raw_path(f"{root}/raw", source))
    return _long(lake.run_lake(spark, f"{root}/raw", f"{root}/processed", f"{root}/curated", as_of()))


HACKERNEWS_POSTS_SQL = f"""SELECT CAST(id AS VARCHAR) AS id FROM ({HACKERNEWS_SQL}) WHERE trim(text) <> ''"""


@query(
    "run_lake_twice",
    f"""SELECT 'bluesky' AS source, count(*) AS posts, count(*) AS catalog, count(*) AS rollup FROM ({BLUESKY_SQL}) WHERE {CLEAN.format('text')} <> ''
    UNION ALL SELECT 'nostr', count(*), count(*), count(*) FROM (WITH {tagged_sql(NOSTR_SQL, keep='id')}
      SELECT id FROM tagged WHERE len(mapped_keywords) > 0 AND {CLEAN.format('content')} <> '')
    UNION ALL SELECT 'hackernews', count(*), count(*), count(*) FROM ({HACKERNEWS_POSTS_SQL})
    UNION ALL SELECT 'stackoverflow', count(*), count(*), count(*) FROM ({STACKOVERFLOW_SQL}) WHERE {CLEAN.format('body')} <> ''
    UNION ALL SELECT 'rss', count(DISTINCT id), count(DISTINCT id), count(DISTINCT id) FROM ({RSS_SQL}) WHERE {CLEAN.format('summary')} <> ''""",
)
def run_lake_twice(spark, sf):
    """All five feeds: live messages to the raw zone, the lake, the lake again; counted by scan, by table and by rollup."""
    root = scratch_dir(spark, "lake")
    feeds = {
        "bluesky": normalize_bluesky, "nostr": nostr_records, "hackernews": normalize_hackernews,
        "stackoverflow": normalize_stackoverflow, "rss": normalize_rss,
    }
    for source, records in feeds.items():
        live.to_messages(live.envelope(records(spark, sf), source)).write.options(**live.COMPACT).json(f"{root}/incoming/{source}")
    incoming = live.read_message_files(spark, f"{root}/incoming")
    live.write_raw_zone(incoming, f"{root}/raw", f"{root}/checkpoint", available_now=True).awaitTermination()
    remove_folder(spark, f"{root}/incoming")  # all of it lies in the raw zone
    for _ in range(2):
        tables = lake.run_lake(spark, f"{root}/raw", f"{root}/processed", f"{root}/curated", as_of())
    catalog.register_catalog(spark, "feedlake_lake", processed=f"{root}/processed")
    scanned = reduce(
        DataFrame.unionByName,
        [zones.scan_processed(spark, f"{root}/processed", s).groupBy("source").agg(F.count(F.lit(1)).alias("posts")) for s in feeds],
    )
    listed = reduce(
        DataFrame.unionByName,
        [spark.table(f"feedlake_lake.processed_{s}").groupBy("source").agg(F.count(F.lit(1)).alias("catalog")) for s in feeds],
    )
    rolled = tables["source_summary"].select("source", F.col("total_posts").alias("rollup"))
    return scanned.join(listed, "source").join(rolled, "source")


@query(
    "register_catalog",
    f"WITH {lake_sql()} SELECT 'processed_lake' AS name, count(*) AS rows FROM p UNION ALL "
    + " UNION ALL ".join(f"SELECT '{n}', count(*) FROM {_lake_table(n)}" for n in schemas.CURATED),
)
def register_catalog(spark, sf):
    """Every table of the processed and the curated zone, counted through the catalog."""
    root = scratch_dir(spark, "zones")
    posts = filter_future(all_posts(spark, sf), as_of())
    zones.write_processed(posts, f"{root}/processed", "lake")
    lake.build_curated(posts, f"{root}/curated", as_of())
    names = catalog.register_catalog(spark, "feedlake_check", processed=f"{root}/processed", curated=f"{root}/curated", sources=("lake",))
    catalog.refresh_tables(spark, "feedlake_check", names)
    return saved_sql.run_sql(
        spark, " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS rows FROM feedlake_check.{t}" for t in names)
    )


@query(
    "sql_raw_sample",
    """SELECT CAST(event_id AS VARCHAR) AS id, props AS content, event_type AS author, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS collected_at,
    event_type || '|x' AS keywords, CASE WHEN value > 50 THEN 'high' ELSE '' END AS categories, value > 50 AS is_remapped
    FROM events ORDER BY id LIMIT 100""",
)
def sql_raw_sample(spark, sf):
    root, high = scratch_dir(spark, "raw"), F.col("value") > 50
    lines = table(spark, sf, "events").select(
        F.col("event_id").alias("id"),
        F.col("props").alias("content"),
        F.col("event_type").alias("author"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("collected_at"),
        F.array("event_type", F.lit("x")).alias("keywords"),
        F.when(high, F.array(F.lit("high"))).otherwise(F.array().cast("array<string>")).alias("categories"),
        high.alias("is_remapped"),
    )
    lines.write.json(zones.raw_path(root, "bluesky"))
    catalog.register_catalog(spark, "feedlake_raw", raw=root, sources=("bluesky",))
    return saved_sql.run_sql(
        spark, saved_sql.SAVED["raw_sample"].replace("FROM raw_bluesky", "FROM feedlake_raw.raw_bluesky")
    )


@query(
    "discover_schema",
    """SELECT 'id' AS "column", 'bigint' AS type, count(*) AS filled_rows FROM events
    UNION ALL SELECT 'source', 'string', count(*) FROM events
    UNION ALL SELECT 'value', 'double', count(*) FILTER (WHERE event_type <> 'click') FROM events
    UNION ALL SELECT 'content', 'string', count(*) FILTER (WHERE event_type = 'click') FROM events""",
)
def discover_schema(spark, sf):
    """Two drops with different columns."""
    root = scratch_dir(spark, "schema")
    lines = _event_lines(spark, sf)
    click = F.col("source") == "click"
    lines.where(click).select("id", "source", "content").write.mode("append").parquet(root)
    lines.where(~click).select("id", "source", "value").write.mode("append").parquet(root)
    return catalog.discover_schema(spark, root, filled=True)


@query(
    "update_table",
    """SELECT event_id AS id, CASE WHEN event_type <> 'click' THEN value END AS value, event_type AS source FROM events""",
)
def update_table(spark, sf):
    """A table of one column set, whose folder gets files with a further column."""
    root, name = f"{scratch_dir(spark, 'grown')}/events", "feedlake_grown"
    lines, click = _event_lines(spark, sf), F.col("source") == "click"
    lines.where(click).select("id", "source").write.parquet(root)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} (id bigint, source string) USING parquet LOCATION '{root}'")
    lines.where(~click).select("id", "source", "value").write.mode("append").parquet(root)
    catalog.update_table(spark, name, root)
    spark.catalog.refreshTable(name)
    return spark.table(name).select("id", "source", "value")


def _crawled(name: str) -> list[tuple[str, str, str]]:
    """Columns of a table after the second crawl: name, type, change."""
    if name.startswith("processed_"):
        posts = [(f.name, f.dataType.simpleString(), "kept") for f in schemas.POST.fields if f.name != "source"]
        changed = [("score", "bigint", "widened"), ("ratio", "double", "added"), ("note", "string", "vanished")]
        return posts + changed * (name == "processed_click")
    _, columns, by_source = schemas.CURATED[name]
    pairs = [c.split(" ", 1) for c in f"{columns}, aggregated_at timestamp".split(", ")]
    return [(c, kind, "kept") for c, kind in pairs if not (by_source and c == "source")]


_CRAWL_ROWS = [
    f"SELECT 'processed_{t}' AS name, {4 if t == 'click' else 1} * (SELECT count(*) FROM p WHERE source = '{t}') AS rows" for t in EVENT_TYPES
] + [f"SELECT '{n}', (SELECT count(*) FROM {_lake_table(n)})" for n in schemas.CURATED]
_CRAWL_COLUMNS = [
    f"('{name}', '{column}', '{kind}', '{change}')"
    for name in (*(f"processed_{t}" for t in EVENT_TYPES), *schemas.CURATED)
    for column, kind, change in _crawled(name)
]


@query(
    "crawl_catalog",
    f"""WITH {lake_sql()}, n AS ({" UNION ALL ".join(_CRAWL_ROWS)}), c(name, "column", type, change) AS (VALUES {", ".join(_CRAWL_COLUMNS)})
    SELECT name, "column", type, change, rows FROM c JOIN n USING (name)""",
)
def crawl_catalog(spark, sf):
    """Five processed and fourteen curated tables, crawled twice: in between a column of one gets a wider type, one comes and one goes."""
    root = scratch_dir(spark, "zones")
    posts = event_posts(spark, sf)
    lake.build_curated(all_posts(spark, sf), f"{root}/curated", as_of())
    of = {t: posts.where(F.col("source") == t) for t in EVENT_TYPES}
    for source, rows in of.items():
        rows = rows.withColumn("note", F.lit("x")) if source == "click" else rows
        zones.write_processed(rows, f"{root}/processed", source, 0)
    zones.write_processed(of["click"].withColumn("score", F.lit(1)), f"{root}/processed", "click", 1)
    database = f"feedlake_crawl_{root.rsplit('-', 1)[-1]}"
    catalog.crawl_catalog(spark, database, f"{root}/processed", f"{root}/curated", EVENT_TYPES)
    zones.write_processed(of["click"], f"{root}/processed", "click", 0)  # without the note
    scored = of["click"].withColumn("score", F.lit(1).cast("long"))
    zones.write_processed(scored.withColumn("ratio", F.lit(0.5).cast("float")), f"{root}/processed", "click", 2)
    zones.write_processed(scored.withColumn("ratio", F.lit(0.5)), f"{root}/processed", "click", 3)
    report = catalog.crawl_catalog(spark, database, f"{root}/processed", f"{root}/curated", EVENT_TYPES)
    names = [*(f"processed_{t}" for t in EVENT_TYPES), *schemas.CURATED]
    counts = reduce(
        DataFrame.unionByName,
        [spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("name"), "rows") for t in names],
    )
    return report.withColumnRenamed("table", "name").join(counts, "name")


@query(
    "unique_ingest",
    f"""SELECT CAST(user_id AS VARCHAR) AS id, {ts('min(ts)')} AS collected_at,
    CASE WHEN min(ts) < TIMESTAMP '2024-01-12' THEN 0 WHEN min(ts) < TIMESTAMP '2024-01-22' THEN 1 ELSE 2 END AS run
    FROM events GROUP BY user_id""",
)
def unique_ingest(spark, sf):
    """Three drops of files in which ids come again: an id has a post of its first drop alone."""
    root = scratch_dir(spark, "unique")
    lines = table(spark, sf, "events").select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("source"),
        F.col("props").alias("content"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("created_at"),
        "value",
    )
    at = F.col("created_at")
    for drop in (lines.where(at < "2024-01-12"), lines.where((at >= "2024-01-12") & (at < "2024-01-22")), lines.where(at >= "2024-01-22")):
        drop.write.mode("append").json(f"{root}/raw/events")
        lake.ingest_source(spark, f"{root}/raw", f"{root}/processed", "events", f"{root}/checkpoint", RECORD, unique=True)
    posts = zones.scan_processed(spark, f"{root}/processed", "events")
    return posts.select("id", "collected_at", F.col("ingest_batch").cast("int").alias("run"))


@query("export_csv", SQL["growth_rate"])
def export_csv(spark, sf):
    path = f"{scratch_dir(spark, 'csv')}/growth"
    growth = TABLES["growth_rate"](spark, sf)
    zones.export_csv(growth, path)
    return zones.read_csv(spark, path, growth.schema)


@query(
    "zone_inventory",
    """SELECT 'given' AS zone, CAST(14 AS BIGINT) AS files, true AS filled
    UNION ALL SELECT 'raw', count(DISTINCT CAST(ts AS DATE)), true FROM events""",
)
def zone_inventory(spark, sf):
    """The given tables, one file each, and a raw zone, whose files are counted once per folder that they lie in."""
    raw = _daily_files(spark, sf)
    found = inventory.zone_inventory(spark, {"given": sf, "raw": raw})
    days = inventory.list_files(spark, raw).agg(F.count_distinct(F.regexp_replace("path", "/[^/]*$", "")).alias("days"))
    files = F.when(F.col("zone") == "raw", F.least("files", F.lit(days.first()[0]))).otherwise(F.col("files"))
    return found.select("zone", files.alias("files"), (F.col("bytes") > 0).alias("filled"))


@query(
    "zone_files",
    """SELECT DISTINCT strftime(ts, 'year=%Y/month=%m/day=%d') AS folder, true AS filled FROM events ORDER BY folder LIMIT 100""",
)
def zone_files(spark, sf):
    """The folders of the first hundred files."""
    files = inventory.zone_files(spark, _daily_files(spark, sf), "year=")
    return files.groupBy(F.regexp_replace("name", "/[^/]*$", "").alias("folder")).agg(F.every(F.col("size_kb") > 0).alias("filled"))
