"""Feed payloads, records and posts: normalisers, transform, extras."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import arr, query, spread, ts
from contract.feeds import (
    CLEAN,
    RECORDS_SQL,
    TAXONOMY,
    as_of,
    conversation_posts,
    document_posts,
    event_posts,
    event_records,
    lake_sql,
    posts_sql,
    table,
    tagged_sql,
)
from contract.texts import clean_html_sql
from feedlake.operators import normalize, transform
from feedlake.session import scratch_dir
from feedlake.sources import zones
from feedlake.sources.zones import union_sources

EPOCH = 1704067200

# --- payloads ------------------------------------------------------------------------


def bluesky_payloads(spark, sf):
    """Documents as messages: the language decides the kind of message and the reply."""
    lang = F.col("lang")
    record = F.struct(
        "text",
        F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.col("doc_id") * 61), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
        F.when(lang != "es", F.array(lang)).alias("langs"),
        F.when(lang == "fr", F.struct(F.struct(F.concat(F.lit("at://"), "source").alias("uri")).alias("parent"))).alias("reply"),
    )
    commit = F.struct(
        F.when(lang == "de", "app.bsky.feed.like").otherwise("app.bsky.feed.post").alias("collection"),
        F.col("doc_id").cast("string").alias("rkey"),
        record.alias("record"),
    )
    return spread(table(spark, sf, "documents")).select(
        F.to_json(
            F.struct(
                F.when(F.col("source") == "src0", "identity").otherwise("commit").alias("kind"),
                F.concat(F.lit("did:"), "source").alias("did"),
                commit.alias("commit"),
            )
        ).alias("value")
    )


BLUESKY_SQL = f"""SELECT 'did:' || source || ':' || doc_id AS id, 'did:' || source AS did, text,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(doc_id * 61), '%Y-%m-%dT%H:%M:%SZ') AS created_at,
    CASE WHEN lang = 'es' THEN '' ELSE lang END AS langs,
    CASE WHEN lang = 'fr' THEN 'at://' || source END AS reply_to, 'bluesky' AS source
    FROM documents WHERE source <> 'src0' AND lang <> 'de' AND text <> ''"""

_TAGS = f"""content, old_content, {arr('original_keywords')} AS original_keywords,
    {arr('mapped_keywords')} AS mapped_keywords, {arr('categories')} AS categories, categorized_keywords, is_remapped"""


@query(
    "normalize_bluesky",
    f"""WITH {tagged_sql(BLUESKY_SQL, keep='id, did, created_at, langs, reply_to, source')}
    SELECT id, did, {_TAGS}, created_at, langs, reply_to, source FROM tagged""",
)
def normalize_bluesky(spark, sf):
    return normalize.normalize_bluesky(bluesky_payloads(spark, sf), TAXONOMY)


def nostr_payloads(spark, sf):
    """Conversation turns as relay messages; system turns are notices."""
    event = F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        F.col("role").alias("pubkey"),
        F.col("text").alias("content"),
        (F.lit(EPOCH) + F.col("conv_id") * 100 + F.col("turn")).alias("created_at"),
        F.lit(1).alias("kind"),
        F.array(
            F.array(F.col("role"), F.lit("x")),
            F.when(F.col("turn") > 2, F.array(F.lit("p"))).otherwise(F.array().cast("array<string>")),
        ).alias("tags"),
    )
    return spread(table(spark, sf, "conversations")).select(
        F.concat(
            F.when(F.col("role") == "system", '["NOTICE","s",').otherwise('["EVENT","s",'),
            F.to_json(event),
            F.lit("]"),
        ).alias("value")
    )


NOSTR_SQL = f"""SELECT conv_id || '-' || turn AS id, role AS pubkey, text, {EPOCH} + conv_id * 100 + turn AS created_at,
    CAST(1 AS INTEGER) AS kind, CASE WHEN turn > 2 THEN role || ',p' ELSE role END AS tags, 'nostr' AS source
    FROM conversations WHERE role <> 'system'"""


def nostr_records(spark, sf):
    return normalize.normalize_nostr(nostr_payloads(spark, sf), TAXONOMY)


@query(
    "normalize_nostr",
    f"""WITH {tagged_sql(NOSTR_SQL, keep='id, pubkey, created_at, kind, tags, source')}
    SELECT id, pubkey, {_TAGS}, created_at, kind, tags, source FROM tagged WHERE len(mapped_keywords) > 0""",
)
def normalize_nostr(spark, sf):
    records = nostr_records(spark, sf)
    names = F.filter(F.transform("tags", lambda t: F.get(t, F.lit(0))), lambda n: n.isNotNull())
    return records.withColumn("tags", F.array_join(names, ","))


HOST = r"//([^/]+)"


def hackernews_items(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("id"),
        F.when(url.startswith("https"), "story").otherwise("job").alias("type"),
        url.alias("title"),
        "url",
        F.col("html").alias("text"),
        F.regexp_extract("url", HOST, 1).alias("by"),
        F.length("url").alias("score"),
        F.when(url.contains("/en/"), F.length("html")).alias("descendants"),
        (F.lit(EPOCH) + F.col("page_id") * 3607).alias("time"),
    )


SEGMENT_LIST = {"AUTOMOBILE": "top", "BUILDING": "new", "FURNITURE": "best", "HOUSEHOLD": "ask", "MACHINERY": "show"}
EVENT_LIST = {"error": "top", "click": "new", "view": "best", "purchase": "ask", "signup": "show"}


def hackernews_lists(spark, sf):
    """Two memberships per id: the segment of a customer and the type of an event with that id."""
    def named(df, key, column, names):
        label = F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), F.col(column))
        return df.select(F.col(key).alias("id"), label.alias("list"))

    return named(table(spark, sf, "customer"), "c_custkey", "c_mktsegment", SEGMENT_LIST).unionByName(
        named(table(spark, sf, "events"), "event_id", "event_type", EVENT_LIST)
    )


def _rank_case(column: str, names: dict[str, str]) -> str:
    ranks = {name: i + 1 for i, name in enumerate(("top", "new", "best", "ask", "show"))}
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {ranks[v]}" for k, v in names.items()) + " END"


HACKERNEWS_SQL = f"""WITH m AS (SELECT c_custkey AS id, {_rank_case('c_mktsegment', SEGMENT_LIST)} AS r FROM customer
    UNION ALL SELECT event_id, {_rank_case('event_type', EVENT_LIST)} FROM events),
    first AS (SELECT id, min(r) AS r FROM m GROUP BY 1)
    SELECT page_id AS id, url AS title, url, {clean_html_sql('html')} AS text,
    regexp_extract(url, '{HOST}', 1) AS author, CAST(length(url) AS INTEGER) AS score,
    CAST(CASE WHEN contains(url, '/en/') THEN length(html) ELSE 0 END AS INTEGER) AS comments,
    {EPOCH} + page_id * 3607 AS timestamp, ['top','new','best','ask','show'][r] AS story_type, 'hackernews' AS source
    FROM pages JOIN first ON first.id = page_id WHERE url LIKE 'https%'"""


@query("normalize_hackernews", HACKERNEWS_SQL)
def normalize_hackernews(spark, sf):
    return normalize.normalize_hackernews(hackernews_items(spark, sf), hackernews_lists(spark, sf))


def stackoverflow_items(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("question_id"),
        F.col("html").alias("title"),
        url.alias("link"),
        F.col("html").alias("body"),
        F.when(url.contains("/en/"), F.struct(F.regexp_extract("url", HOST, 1).alias("display_name"))).alias("owner"),
        F.when(url.startswith("https"), F.split("url", "/")).alias("tags"),
        F.length("url").alias("score"),
        F.length("html").alias("view_count"),
        F.col("page_id").cast("int").alias("answer_count"),
        url.contains("?").alias("is_answered"),
        (F.lit(EPOCH) + F.col("page_id") * 3607).alias("creation_date"),
    )


STACKOVERFLOW_SQL = f"""SELECT page_id AS id, {clean_html_sql('html')} AS title, url,
    CASE WHEN contains(url, '/en/') THEN regexp_extract(url, '{HOST}', 1) END AS author,
    {clean_html_sql('html')} AS body,
    CASE WHEN url LIKE 'https%' THEN array_to_string(string_split(url, '/'), '|') ELSE '' END AS tags,
    CAST(length(url) AS INTEGER) AS score, CAST(length(html) AS INTEGER) AS views, CAST(page_id AS INTEGER) AS answers,
    contains(url, '?') AS is_answered, {EPOCH} + page_id * 3607 AS timestamp, 'stackoverflow' AS source FROM pages"""


@query("normalize_stackoverflow", STACKOVERFLOW_SQL)
def normalize_stackoverflow(spark, sf):
    return normalize.normalize_stackoverflow(stackoverflow_items(spark, sf))


def rss_entries(spark, sf):
    """Pages as entries: some lack an id, some a link, so that each key of the digest is used."""
    url = F.col("url")
    at = F.timestamp_seconds(F.lit(EPOCH) + F.col("page_id") * 3607)
    return table(spark, sf, "pages").select(
        F.when(url.startswith("https"), F.concat(F.lit("tag:"), "url")).alias("id"),
        F.when(url.contains("?"), "").otherwise(url).alias("link"),
        F.col("html").alias("title"),
        F.regexp_extract("url", HOST, 1).alias("author"),
        F.col("html").alias("summary"),
        F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'").alias("published"),
        F.transform(F.split("url", "/"), lambda t: F.struct(t.alias("term"))).alias("tags"),
        F.lit("pages").alias("feed_name"),
        F.regexp_extract("url", HOST, 1).alias("feed_url"),
    )


RSS_SQL = f"""SELECT md5(CASE WHEN url LIKE 'https%' THEN 'tag:' || url WHEN contains(url, '?') THEN html ELSE url END) AS id,
    {clean_html_sql('html')} AS title, CASE WHEN contains(url, '?') THEN '' ELSE url END AS url,
    regexp_extract(url, '{HOST}', 1) AS author, {clean_html_sql('html')} AS summary,
    'pages' AS feed_name, regexp_extract(url, '{HOST}', 1) AS feed_url,
    strftime(TIMESTAMP '2024-01-01' + to_seconds(page_id * 3607), '%a, %d %b %Y %H:%M:%S GMT') AS published,
    array_to_string(string_split(url, '/'), '|') AS tags, 'rss' AS source FROM pages"""


@query("normalize_rss", RSS_SQL)
def normalize_rss(spark, sf):
    return normalize.normalize_rss(rss_entries(spark, sf))


def _xml(c):
    """A text as XML has it."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), (chr(34), "&quot;")):
        c = F.replace(c, F.lit(plain), F.lit(entity))
    return c


#: Entries in one feed file.
FEED_ENTRIES = 50

_XML_PAGES_SQL = """WITH pages AS (SELECT page_id, url, 'p' || page_id || ' ' || regexp_replace(html, '[^ -~]+', ' ', 'g') || '.' AS html
      FROM main.pages WHERE length(url) > 0 AND NOT regexp_matches(url, '[^!-~]'))"""
_XML_RSS_SQL = (
    RSS_SQL.replace("'pages' AS feed_name", "CASE WHEN page_id % 3 = 0 THEN 'atom' ELSE 'rss' END AS feed_name")
    .replace(f"regexp_extract(url, '{HOST}', 1) AS feed_url", f"'https://feeds.example/' || (page_id // {FEED_ENTRIES}) AS feed_url")
    .replace("'%a, %d %b %Y %H:%M:%S GMT'", "'%Y-%m-%dT%H:%M:%SZ'")
)


@query(
    "normalize_rss_xml",
    f"""SELECT *, 0 AS bad_files FROM ({_XML_PAGES_SQL} {_XML_RSS_SQL})
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 2""",
)
def normalize_rss_xml(spark, sf):
    """Pages as RSS and Atom files with foreign namespaces, beside two files that cannot be read."""
    root, url = scratch_dir(spark, "feeds"), F.col("url")
    pages = table(spark, sf, "pages").where((F.length("url") > 0) & ~url.rlike("[^!-~]"))
    pages = pages.withColumn("html", F.concat(F.lit("p"), F.col("page_id").cast("string"), F.lit(" "), F.regexp_replace("html", "[^ -~]+", " "), F.lit(".")))
    key = F.when(url.startswith("https"), F.concat(F.lit("tag:"), "url")).otherwise("")
    link, host, tags = F.when(url.contains("?"), "").otherwise(url), F.regexp_extract("url", HOST, 1), F.split("url", "/")
    at = F.date_format(F.timestamp_seconds(F.lit(EPOCH) + F.col("page_id") * 3607), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    part = lambda name, text: F.concat(F.lit(f"<{name}>"), _xml(text), F.lit(f"</{name.split(' ')[0]}>"))
    each = lambda make: F.array_join(F.transform(tags, make), "")
    item = F.concat(
        F.lit("<item>"), part('guid isPermaLink="false"', key), part("link", link), part("title", F.col("html")),
        part("dc:creator", host), part("content:encoded", F.col("html")), part("dc:date", at), each(lambda t: part("category", t)), F.lit("</item>"),
    )
    entry = F.concat(
        F.lit("<entry>"), part("id", key), F.lit('<link rel="enclosure" href="file"/><link rel="alternate" href="'), _xml(link), F.lit('"/>'),
        part('title type="html"', F.col("html")), F.lit("<author>"), part("name", host), F.lit("</author>"), part("content", F.col("html")),
        part("updated", at), each(lambda t: F.concat(F.lit('<category term="'), _xml(t), F.lit('"/>'))), F.lit("</entry>"),
    )
    is_atom = F.col("page_id") % 3 == 0
    feeds = pages.select(is_atom.alias("atom"), F.expr(f"page_id div {FEED_ENTRIES}").alias("feed"), F.when(is_atom, entry).otherwise(item).alias("item"))
    joined = feeds.groupBy("atom", "feed").agg(F.array_join(F.collect_list("item"), "").alias("items"))
    address = F.concat(F.lit("https://feeds.example/"), F.col("feed").cast("string"))
    rss = F.concat(
        F.lit('<?xml version="1.0"?><rss xmlns:dc="http://purl.org/dc/elements/1.1/" xmlns:content="http://purl.org/rss/1.0/modules/content/">'),
        F.lit("<channel><title>rss</title><link>"), address, F.lit("</link>"), "items", F.lit("</channel></rss>"),
    )
    atom = F.concat(
        F.lit('<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><title>atom</title><link rel="self" href="elsewhere"/><link href="'),
        address, F.lit('"/>'), "items", F.lit("</feed>"),
    )
    one_each = {"maxRecordsPerFile": 1}  # a file is one document
    joined.select(F.when(F.col("atom"), atom).otherwise(rss)).write.options(**one_each).text(f"{root}/files/feeds")
    bad = [("<rss><channel><title>cut off</title><item><title>x</ti",), ("no feed at all",)]
    spark.createDataFrame(bad, "value string").write.options(**one_each).text(f"{root}/files/bad")
    good = normalize.normalize_rss(zones.scan_rss_xml(spark, f"{root}/files")).withColumn("bad_files", F.lit(0))
    bad = zones.bad_feed_files(spark, f"{root}/files").where(F.trim("value") != "").agg(F.count(F.lit(1)).cast("int").alias("bad_files"))
    return good.unionByName(bad, allowMissingColumns=True)


# --- records to posts ----------------------------------------------------------------

POST_COLUMNS = ("id", "source", "content_clean", "collected_at", "keywords", "categories", "is_remapped", "has_keywords")


def _posts(df, *extras):
    return df.select(*POST_COLUMNS, *extras)


def _now():
    return {"now": as_of()}


def _bluesky_posts(spark, sf):
    return transform.transform_posts(normalize_bluesky(spark, sf), "bluesky", **_now())


@query(
    "transform_posts",
    f"""WITH {tagged_sql(BLUESKY_SQL, keep='id, created_at')} SELECT id, 'bluesky' AS source,
    {CLEAN.format('content')} AS content_clean, {ts("strptime(created_at, '%Y-%m-%dT%H:%M:%SZ')")} AS collected_at,
    {arr('mapped_keywords')} AS keywords, {arr('categories')} AS categories, is_remapped,
    len(mapped_keywords) > 0 AS has_keywords FROM tagged WHERE {CLEAN.format('content')} <> ''""",
)
def transform_posts(spark, sf):
    return _posts(_bluesky_posts(spark, sf))


@query(
    "extras_bluesky",
    f"""WITH b AS ({BLUESKY_SQL}) SELECT id, '' AS author,
    {ts("strptime(created_at, '%Y-%m-%dT%H:%M:%SZ')")} AS created_at, CAST(0 AS INTEGER) AS likes,
    CAST(0 AS INTEGER) AS reposts FROM b WHERE {CLEAN.format('text')} <> ''""",
)
def extras_bluesky(spark, sf):
    return _bluesky_posts(spark, sf).select("id", "author", "created_at", "likes", "reposts")


@query(
    "extras_nostr",
    f"""WITH {tagged_sql(NOSTR_SQL, keep='id, pubkey, created_at, kind, tags')} SELECT id, pubkey,
    {ts("TIMESTAMP '1970-01-01' + to_seconds(created_at)")} AS created_at, kind,
    CASE WHEN contains(tags, ',') THEN replace(tags, ',', '|') ELSE tags || '|<null>' END AS keywords, true AS has_keywords FROM tagged
    WHERE len(mapped_keywords) > 0 AND {CLEAN.format('content')} <> ''""",
)
def extras_nostr(spark, sf):
    records = normalize.normalize_nostr(nostr_payloads(spark, sf), TAXONOMY)
    posts = transform.transform_posts(records, "nostr", **_now())
    return posts.select("id", "pubkey", "created_at", "kind", "keywords", "has_keywords")


@query(
    "extras_hackernews",
    f"""WITH h AS ({HACKERNEWS_SQL}) SELECT CAST(id AS VARCHAR) AS id, author, title, url, score, comments,
    story_type AS type, {ts("TIMESTAMP '1970-01-01' + to_seconds(timestamp)")} AS collected_at
    FROM h WHERE {CLEAN.format('text')} <> ''""",
)
def extras_hackernews(spark, sf):
    posts = transform.transform_posts(normalize_hackernews(spark, sf), "hackernews", **_now())
    return posts.select("id", "author", "title", "url", "score", "comments", "type", "collected_at")


@query(
    "extras_stackoverflow",
    f"""WITH s AS ({STACKOVERFLOW_SQL}) SELECT CAST(id AS VARCHAR) AS id, title, url AS link, score,
    answers AS answer_count, views AS view_count, is_answered,
    {ts("TIMESTAMP '1970-01-01' + to_seconds(timestamp)")} AS collected_at FROM s WHERE {CLEAN.format('body')} <> ''""",
)
def extras_stackoverflow(spark, sf):
    posts = transform.transform_posts(normalize_stackoverflow(spark, sf), "stackoverflow", **_now())
    return posts.select("id", "title", "link", "score", "answer_count", "view_count", "is_answered", "collected_at")


# Several pages may share a digest; the earliest, then the smallest content, stays.
@query(
    "extras_rss",
    f"""WITH s AS ({RSS_SQL}), t AS (SELECT *, {CLEAN.format('summary')} AS content_clean,
    strptime(published, '%a, %d %b %Y %H:%M:%S GMT') AS tm FROM s),
    o AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY tm, content_clean) AS rn FROM t)
    SELECT id, title, url AS link, feed_name AS feed_source, {ts('tm')} AS published_at, {ts('tm')} AS collected_at
    FROM o WHERE rn = 1 AND content_clean <> ''""",
)
def extras_rss(spark, sf):
    posts = transform.transform_posts(normalize_rss(spark, sf), "rss", **_now())
    return posts.select("id", "title", "link", "feed_source", "published_at", "collected_at")


@query(
    "dedup_posts",
    f"""WITH r AS ({RECORDS_SQL['events']}), o AS (SELECT *, row_number() OVER (
    PARTITION BY id ORDER BY collected_at, text, source) AS rn FROM r)
    SELECT id, source, text, {ts('collected_at')} AS collected_at FROM o WHERE rn = 1""",
)
def dedup_posts(spark, sf):
    return transform.dedup_posts(event_records(spark, sf), order=("collected_at", "text"))


@query(
    "align_schema",
    f"""WITH {posts_sql('events')} SELECT id, source, content_clean, {ts('collected_at')} AS collected_at,
    CAST(NULL AS VARCHAR) AS processed_at, '' AS keywords, '' AS categories, false AS is_remapped,
    false AS has_keywords FROM p""",
)
def align_schema(spark, sf):
    records = event_records(spark, sf).withColumn("content_clean", F.trim("text")).drop("text")
    return transform.align_schema(records)


@query(
    "filter_future",
    f"""WITH {posts_sql('events')} SELECT id, source, {ts('collected_at')} AS collected_at FROM p
    WHERE collected_at <= TIMESTAMP '2024-01-20 12:00:00'""",
)
def filter_future(spark, sf):
    posts = event_posts(spark, sf).select("id", "source", "collected_at")
    return transform.filter_future(posts, F.lit("2024-01-20 12:00:00").cast("timestamp"))


@query(
    "union_sources",
    f"""WITH {lake_sql()} SELECT id, source, content_clean, {ts('collected_at')} AS collected_at,
    {arr('keywords')} AS keywords, {arr('categories')} AS categories, is_remapped, has_keywords FROM p""",
)
def all_posts(spark, sf):
    return _posts(union_sources([f(spark, sf) for f in (document_posts, event_posts, conversation_posts)]))


@query(
    "exclude_seen",
    f"""WITH r AS ({RECORDS_SQL['events']}), seen AS (SELECT DISTINCT source, id FROM r
    WHERE collected_at < TIMESTAMP '2024-01-02') SELECT r.source, r.id, {ts('r.collected_at')} AS collected_at
    FROM r ANTI JOIN seen ON r.source = seen.source AND r.id = seen.id""",
)
def exclude_seen(spark, sf):
    records = event_records(spark, sf).select("source", "id", "collected_at")
    seen = records.where(F.col("collected_at") < F.lit("2024-01-02").cast("timestamp"))
    return transform.exclude_seen(records, seen)
