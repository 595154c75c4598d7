"""Text operators: cleaning, tagging, remapping, dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contract.base import arr, query, spread
from contract.feeds import (
    CLEAN,
    DICTIONARY_SQL,
    RECORDS_SQL,
    TAXONOMY,
    benchmark_dictionary,
    conversation_records,
    document_records,
    table,
    tagged_sql,
)
from feedlake.functions.text import clean_content, clean_html, word_runs
from feedlake.operators import tagging

HTML_SPACES = r"[\s\x0B\x{85}\p{Z}\x1c-\x1f]+"


def clean_html_sql(expr: str) -> str:
    out = f"regexp_replace(regexp_replace(coalesce({expr}, ''), '<[^>]+>', '', 'g'), '{HTML_SPACES}', ' ', 'g')"
    for entity, plain in (
        ("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''")
    ):
        out = f"replace({out}, '{entity}', '{plain}')"
    return f"trim({out})"


@query("clean_html", f"SELECT page_id, {clean_html_sql('html')} AS text FROM pages")
def _clean_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", clean_html(F.col("html")).alias("text"))


@query("clean_content", f"SELECT doc_id, {CLEAN.format('text')} AS text FROM documents")
def _clean_content(spark, sf):
    return table(spark, sf, "documents").select("doc_id", clean_content(F.col("text")).alias("text"))


TAGGED = f"WITH {tagged_sql(RECORDS_SQL['documents'])}"


def _tagged(spark, sf):
    return tagging.tag_posts(document_records(spark, sf), TAXONOMY)


@query(
    "tag_keywords",
    f"WITH {tagged_sql(RECORDS_SQL['documents'], keep='id, source, kws')} "
    f"SELECT id, {arr('kws')} AS keywords FROM tagged",
)
def tag_keywords(spark, sf):
    return document_records(spark, sf).select(
        "id", tagging.match_keywords(F.lower("text"), TAXONOMY).alias("keywords")
    )


@query("tag_categories", f"{TAGGED} SELECT id, {arr('categories')} AS categories, categorized_keywords FROM tagged")
def tag_categories(spark, sf):
    return _tagged(spark, sf).select("id", "categories", "categorized_keywords")


@query(
    "remap_keywords",
    f"""{TAGGED} SELECT id, {arr('original_keywords')} AS original_keywords,
    {arr('mapped_keywords')} AS mapped_keywords, is_remapped FROM tagged""",
)
def remap_keywords(spark, sf):
    return _tagged(spark, sf).select("id", "original_keywords", "mapped_keywords", "is_remapped")


@query("rewrite_content", f"{TAGGED} SELECT id, content, old_content FROM tagged")
def rewrite_content(spark, sf):
    return _tagged(spark, sf).select("id", "content", "old_content")


@query(
    "tag_conversations",
    f"""WITH {tagged_sql(RECORDS_SQL['conversations'])} SELECT id, source, content,
    {arr('mapped_keywords')} AS mapped_keywords, {arr('categories')} AS categories, is_remapped FROM tagged""",
)
def tag_conversations(spark, sf):
    tagged = tagging.tag_posts(conversation_records(spark, sf), TAXONOMY)
    return tagged.select("id", "source", "content", "mapped_keywords", "categories", "is_remapped")


# Neighbouring runs are a pair if the separator between them is one space.
TAGS_BY_JOIN_SQL = r"""d AS (SELECT doc_id, lower(text) AS l FROM documents),
    w AS (SELECT doc_id, regexp_extract_all(l, '[\p{L}\p{N}_]+') AS runs,
      regexp_extract_all(l, '[^\p{L}\p{N}_]+') AS seps,
      CAST(regexp_matches(l, '^[^\p{L}\p{N}_]') AS INTEGER) AS lead FROM d),
    one AS (SELECT DISTINCT doc_id, unnest(runs) AS token FROM w),
    two AS (SELECT DISTINCT doc_id, runs[i] || ' ' || runs[i + 1] AS token
      FROM (SELECT *, unnest(range(1, len(runs))) AS i FROM w) WHERE seps[i + lead] = ' '),
    hit AS (SELECT doc_id, keyword, category FROM one JOIN dict ON dict.keyword = one.token
      UNION ALL SELECT doc_id, keyword, category FROM two JOIN dict ON dict.keyword = two.token),
    g AS (SELECT doc_id, list_sort(list(keyword)) AS keywords, list_sort(list(DISTINCT category)) AS categories
      FROM hit GROUP BY 1)"""
#: Few texts have no keyword of the large dictionary: with this many or more nothing is remapped.
MIN_KEYWORDS = 30


@query(
    "tag_by_join",
    f"""WITH {DICTIONARY_SQL}, {TAGS_BY_JOIN_SQL}
    SELECT documents.doc_id, coalesce(array_to_string(keywords, '|'), '') AS keywords,
      coalesce(array_to_string(categories, '|'), '') AS categories FROM documents LEFT JOIN g USING (doc_id)""",
)
def tag_by_join(spark, sf):
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    return tagging.tag_by_join(docs, benchmark_dictionary(spark, sf), key="doc_id").drop("text_key")


def synonyms_sql(longest: int) -> str:
    return f"""syn AS (SELECT DISTINCT keyword AS word, 'len' || length(keyword) || '_topic' AS target FROM dict
      WHERE length(keyword) <= {longest} AND NOT contains(keyword, ' '))"""


#: From ``documents``, ``g`` and ``syn``: what is mapped, and the text put together again run by run.
REMAPPED_SQL = rf"""sw AS (SELECT doc_id, trim(raw, '.,!?;:''"()[]{{}}') AS word, p FROM (
      SELECT doc_id, unnest(parts) AS raw, generate_subscripts(parts, 1) AS p FROM (
        SELECT doc_id, regexp_split_to_array(lower(text), '{HTML_SPACES}') AS parts FROM documents))),
    sh AS (SELECT doc_id, list(word ORDER BY p) AS hits, list(target ORDER BY p) AS targets FROM sw JOIN syn USING (word) GROUP BY 1),
    m AS (SELECT documents.doc_id, text, coalesce(keywords, []) AS kws, coalesce(g.categories, []) AS categories,
      CASE WHEN len(coalesce(keywords, [])) < {MIN_KEYWORDS} THEN coalesce(hits, []) ELSE [] END AS hits,
      CASE WHEN len(coalesce(keywords, [])) < {MIN_KEYWORDS} THEN coalesce(targets, []) ELSE [] END AS targets
      FROM documents LEFT JOIN g USING (doc_id) LEFT JOIN sh USING (doc_id)),
    cut AS (SELECT doc_id, unnest(runs || ['']) AS run, unnest(gaps) AS gap, generate_subscripts(gaps, 1) AS p FROM (
      SELECT doc_id, regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+') AS runs, regexp_split_to_array(text, '[\p{{L}}\p{{N}}_]+') AS gaps
      FROM m WHERE len(hits) > 0)),
    pairs AS (SELECT DISTINCT doc_id, unnest(hits) AS word, unnest(targets) AS target FROM m),
    again AS (SELECT cut.doc_id, string_agg(gap || coalesce(pairs.target, run), '' ORDER BY p) AS content
      FROM cut LEFT JOIN pairs ON cut.doc_id = pairs.doc_id AND lower(cut.run) = pairs.word GROUP BY 1)
    SELECT doc_id, coalesce(again.content, text, '') AS content, CASE WHEN len(hits) > 0 THEN text END AS old_content,
      array_to_string(list_concat(kws, hits), '|') AS original_keywords,
      array_to_string(list_concat(kws, targets), '|') AS mapped_keywords, array_to_string(categories, '|') AS categories,
      len(hits) > 0 AS is_remapped FROM m LEFT JOIN again USING (doc_id)"""


def synonym_table(dictionary, longest: int):
    """Short words and what they stand for: one run, and longer than any synonym, so that SQL can replace all of them at once."""
    return dictionary.where((F.length("keyword") <= longest) & ~F.col("keyword").contains(" ")).select(
        F.col("keyword").alias("word"), F.concat(F.lit("len"), F.length("keyword").cast("string"), F.lit("_topic")).alias("target")
    )


REMAPPED_COLUMNS = ("content", "old_content", "original_keywords", "mapped_keywords", "categories", "is_remapped")
REMAP_SQL = f"WITH {DICTIONARY_SQL}, {TAGS_BY_JOIN_SQL}, {synonyms_sql(5)}, {REMAPPED_SQL}"


@query("remap_by_join", REMAP_SQL)
def remap_by_join(spark, sf):
    """Long words and word pairs as keywords, short words as synonyms."""
    docs = spread(table(spark, sf, "documents")).select("doc_id", "text")
    dictionary = benchmark_dictionary(spark, sf)
    remapped = tagging.remap_by_join(docs, dictionary, synonym_table(dictionary, 5), key="doc_id", min_keywords=MIN_KEYWORDS)
    return remapped.select("doc_id", *REMAPPED_COLUMNS)


WORDS_SQL = r"words AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS word FROM conversations)"


@query("is_keyword", f"WITH {DICTIONARY_SQL}, {WORDS_SQL} SELECT word FROM words WHERE lower(word) IN (SELECT keyword FROM dict)")
def is_keyword(spark, sf):
    words = table(spark, sf, "conversations").select(F.explode(word_runs(F.col("text"))).alias("word")).distinct()
    return tagging.is_keyword(words, benchmark_dictionary(spark, sf))


@query(
    "dictionary_stats",
    f"WITH {DICTIONARY_SQL}, {WORDS_SQL} SELECT count(DISTINCT keyword) AS keywords, "
    "(SELECT count(DISTINCT lower(word)) FROM words) AS synonyms FROM dict",
)
def dictionary_stats(spark, sf):
    words = table(spark, sf, "conversations").select(F.explode(word_runs(F.lower("text"))).alias("word"))
    return tagging.dictionary_stats(benchmark_dictionary(spark, sf), words.select("word", F.col("word").alias("target")))
