"""Posts, payloads and dictionaries made from the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract.base import spread
from feedlake.functions.taxonomy import Taxonomy
from feedlake.functions.text import clean_content
from feedlake.operators.tagging import tag_posts
from feedlake.operators.transform import align_schema, filter_future

# A small dictionary with words of the texts: plain, short, of several words, with an
# accent, and one whose end needs a word character behind it.
KEYWORDS = (
    "ai", "ar", "apache", "apache license", "copyright", "eaux", "general public license", "gnu",
    "license", "lés", "mit", "mit license", "python", "rest", "spark", "token", "version",
    "version 2.", "été", "on",
)
CATEGORIES = (
    ("ai", ("ai", "machine learning")),
    ("opensource", ("gnu", "mit", "mit license", "license", "apache license", "general public license")),
    ("cloud", ("apache", "rest", "kubernetes", "integration")),
    ("security", ("token", "license", "version 2.")),
    ("data", ("spark", "pipeline", "cluster", "python")),
)
SYNONYMS = {
    "with": "integration",
    "from": "pipeline",
    "all": "cluster",
    "work": "workflow",
    "what": "docs",
    "when": "schedule",
    "und": "merge",
    "les": "spark",
    "los": "dataset",
    "rest": "python",
}
TAXONOMY = Taxonomy(KEYWORDS, CATEGORIES, SYNONYMS)

AS_OF = "2025-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def _spread(start: str, offset, seconds: int):
    """Texts carry no time: a fixed function of the key spreads them over some weeks."""
    return F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + F.pmod(offset, F.lit(seconds)))


# --- records: (id, source, text, collected_at) ---------------------------------------


def document_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents")).select(
        F.col("doc_id").cast("string").alias("id"),
        "source",
        "text",
        _spread("2024-12-01", F.col("doc_id") * 104729, 45 * 86400).alias("collected_at"),
    )


def conversation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations")).select(
        F.concat_ws(":", "conv_id", "turn").alias("id"),
        F.col("role").alias("source"),
        "text",
        _spread("2024-12-10", F.col("conv_id") * 7919 + F.col("turn") * 60, 20 * 86400).alias("collected_at"),
    )


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("source"),
        F.col("props").alias("text"),
        F.col("ts").cast("timestamp").alias("collected_at"),
    )


RECORDS_SQL = {
    "documents": """SELECT CAST(doc_id AS VARCHAR) AS id, source, text,
        TIMESTAMP '2024-12-01' + to_seconds((doc_id * 104729) % 3888000) AS collected_at FROM documents""",
    "conversations": """SELECT conv_id || ':' || turn AS id, role AS source, text,
        TIMESTAMP '2024-12-10' + to_seconds((conv_id * 7919 + turn * 60) % 1728000) AS collected_at
        FROM conversations""",
    "events": """SELECT CAST(user_id AS VARCHAR) AS id, event_type AS source, props AS text,
        ts AS collected_at FROM events""",
}


# --- posts ---------------------------------------------------------------------------


def tagged_posts(records: DataFrame) -> DataFrame:
    # A file may be a single row group, whose texts one task would work through alone.
    tagged = tag_posts(records.repartition("id", "text"), TAXONOMY)
    posts = tagged.withColumns(
        {
            "content_clean": clean_content(F.col("content")),
            "keywords": F.col("mapped_keywords"),
            "has_keywords": F.size("mapped_keywords") > 0,
        }
    )
    return filter_future(align_schema(posts), as_of())


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_posts(document_records(spark, sf_dir))


def conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagged_posts(conversation_records(spark, sf_dir))


def event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts without tags; their ids repeat, which unique counts show."""
    records = event_records(spark, sf_dir).withColumn("content_clean", clean_content(F.col("text")))
    return filter_future(align_schema(records), as_of())


# --- the same in SQL -----------------------------------------------------------------

W = r"[\p{L}\p{N}_]"
NW = r"[^\p{L}\p{N}_]"
SPACES = r"[\s\x0B\x{85}\p{Z}\x1c-\x1f]+"


def _quote(word: str) -> str:
    return "".join(c if c.isalnum() or c == "_" else "\\" + c for c in word)


def _pattern(keyword: str) -> str:
    def is_word(c: str) -> bool:
        return c.isalnum() or c == "_"

    left = f"(^|{NW})" if is_word(keyword[0]) else W
    right = f"($|{NW})" if is_word(keyword[-1]) else W
    return left + _quote(keyword) + right


def _case(expr: str, pairs: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    return f"CASE {expr} {whens} END"


def keywords_sql(lowered: str) -> str:
    """Sorted keywords found in a lower-case text, each compared by its own pattern."""
    each = ", ".join(f"CASE WHEN regexp_matches({lowered}, '{_pattern(k)}') THEN '{k}' END" for k in sorted(KEYWORDS))
    return f"list_sort(list_filter([{each}], lambda x: x IS NOT NULL))"


def tagged_sql(records: str, text: str = "text", keep: str = "id, source, collected_at") -> str:
    """CTEs ending in ``tagged``: the kept columns, content, keywords and flags."""
    category_of: dict[str, str] = {}
    for name, words in CATEGORIES:
        for word in words:
            category_of.setdefault(word, name)
    words = ", ".join(f"'{w}'" for w in SYNONYMS)
    strip = r""".,!?;:''"()[]{}"""
    steps = []
    for i, (word, target) in enumerate(SYNONYMS.items()):
        # Neighbouring words share the separator, which a pattern can take only once: run it twice.
        pattern = f"(^|{NW})(?i:{word})($|{NW})"
        once = f"regexp_replace(content, '{pattern}', '\\1{target}\\2', 'g')"
        twice = f"regexp_replace({once}, '{pattern}', '\\1{target}\\2', 'g')"
        steps.append(
            f"c{i + 1} AS (SELECT * REPLACE (CASE WHEN list_contains(hits, '{word}') THEN {twice} "
            f"ELSE content END AS content) FROM c{i})"
        )
    return f"""r AS ({records}),
t0 AS (SELECT *, lower({text}) AS l FROM r),
t1 AS (SELECT *, {keywords_sql('l')} AS kws FROM t0),
t2 AS (SELECT *, CASE WHEN len(kws) < 2 THEN
  list_filter(list_transform(regexp_split_to_array(l, '{SPACES}'), lambda w: trim(w, '{strip}')),
              lambda w: w IN ({words})) ELSE CAST([] AS VARCHAR[]) END AS hits FROM t1),
t3 AS (SELECT *, list_concat(kws, list_transform(hits, lambda w: {_case('w', SYNONYMS)})) AS mapped FROM t2),
c0 AS (SELECT *, {text} AS content,
  list_sort(list_distinct(list_filter(list_transform(mapped, lambda k: {_case('k', category_of)}),
            lambda c: c IS NOT NULL))) AS categories FROM t3),
{', '.join(steps)},
tagged AS (SELECT {keep}, content, CASE WHEN len(hits) > 0 THEN {text} END AS old_content,
  list_concat(kws, hits) AS original_keywords, mapped AS mapped_keywords, categories,
  array_to_string(list_transform(categories, lambda c: c || ':' || array_to_string(
    list_filter(mapped, lambda k: ({_case('k', category_of)}) = c), ',')), ';') AS categorized_keywords,
  len(hits) > 0 AS is_remapped FROM c{len(SYNONYMS)})"""


CLEAN = r"trim(regexp_replace(coalesce({0}, ''), '[\n\r\t]+', ' ', 'g'))"

_POST_COLUMNS = (
    "id, source, " + CLEAN.format("content") + " AS content_clean, collected_at, "
    "mapped_keywords AS keywords, categories, is_remapped, len(mapped_keywords) > 0 AS has_keywords"
)


def posts_sql(feed: str) -> str:
    """CTEs ending in ``p``, the posts of a feed."""
    if feed == "events":
        return (
            f"r AS ({RECORDS_SQL['events']}), p AS (SELECT id, source, {CLEAN.format('text')} AS content_clean, "
            "collected_at, CAST([] AS VARCHAR[]) AS keywords, CAST([] AS VARCHAR[]) AS categories, "
            "false AS is_remapped, false AS has_keywords FROM r)"
        )
    return f"{tagged_sql(RECORDS_SQL[feed])}, p AS (SELECT {_POST_COLUMNS} FROM tagged)"


def lake_sql() -> str:
    """CTEs ending in ``p``, the posts of all three feeds."""
    union = " UNION ALL ".join(
        f"SELECT * FROM (WITH {posts_sql(feed)} SELECT * FROM p)" for feed in RECORDS_SQL
    )
    return f"p AS ({union})"


# One row per post and keyword, after the rule for short keywords; it says nothing about a NULL, which stays.
EXPLODED = """k0 AS (SELECT id, CAST(collected_at AS DATE) AS date, source, content_clean, unnest(keywords) AS raw FROM p),
k AS (SELECT id, date, source, lower(raw) AS keyword FROM k0
  WHERE CASE WHEN length(raw) <= 2 THEN contains(' ' || lower(content_clean) || ' ', ' ' || lower(raw) || ' ') ELSE true END)"""


# --- dictionary tables ---------------------------------------------------------------


def benchmark_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary that grows with the data: the words, and the word pairs, of the benchmark texts.

    The category of a word is its length, the rank the length too.
    """
    words = table(spark, sf_dir, "benchmark").select(
        F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)).alias("w")
    )
    single = words.select(F.explode("w").alias("keyword"))
    pairs = words.select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), F.greatest(F.size("w") - 1, F.lit(1))),
                lambda i: F.concat_ws(" ", F.get("w", i - 1), F.get("w", i)),
            )
        ).alias("keyword")
    )
    words = single.unionByName(pairs).where(F.length("keyword") > 2).distinct()
    return words.withColumns(
        {"category": F.concat(F.lit("len"), F.length("keyword")), "category_rank": F.length("keyword")}
    )


DICTIONARY_SQL = r"""dw AS (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark),
dict AS (SELECT DISTINCT keyword, 'len' || length(keyword) AS category FROM (
  SELECT unnest(w) AS keyword FROM dw UNION ALL
  SELECT w[i] || ' ' || w[i + 1] FROM (SELECT w, unnest(range(1, len(w))) AS i FROM dw)) WHERE length(keyword) > 2)"""
