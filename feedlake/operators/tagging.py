"""Keyword tagging, categories, synonym remapping and content rewriting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.taxonomy import Taxonomy
from feedlake.functions.text import SPACE, WORD, strip_punctuation, word_runs
from feedlake.session import scratch_dir, write_and_reload


def _no_strings() -> Column:
    return F.array().cast("array<string>")


def match_keywords(lowered: Column, taxonomy: Taxonomy) -> Column:
    """Sorted dictionary keywords that occur as whole words in a text in lower case.

    The text is cut into tokens once; a hash set keeps those that start a keyword, and
    only keywords of several words or with a non-word end are compared by pattern.  The
    work is linear in the text, not text times dictionary.
    """
    if not taxonomy.keywords:
        return _no_strings()
    starts = F.array_distinct(F.filter(word_runs(lowered), lambda t: t.isin(taxonomy.first_runs())))
    candidates = F.flatten(F.transform(starts, lambda t: F.element_at(taxonomy.candidates(), t)))
    found = F.filter(
        candidates,
        lambda c: c.pattern.isNull() | (F.contains(lowered, c.keyword) & F.rlike(lowered, c.pattern)),
    )
    return F.coalesce(F.array_sort(F.transform(found, lambda c: c.keyword)), _no_strings())


def match_synonyms(lowered: Column, taxonomy: Taxonomy) -> Column:
    """Synonym words of a text in lower case, in order of occurrence, repeats kept.

    A word stands between white space; punctuation at its ends does not count.
    """
    if not taxonomy.synonyms:
        return _no_strings()
    known = sorted(taxonomy.synonyms)
    words = F.filter(F.split(lowered, SPACE), lambda w: strip_punctuation(w).isin(known))
    return F.coalesce(F.transform(words, strip_punctuation), _no_strings())


def tag_posts(
    df: DataFrame,
    taxonomy: Taxonomy,
    text: str = "text",
    min_keywords: int = 2,
) -> DataFrame:
    """Tag ``text`` and, where it has fewer than ``min_keywords`` keywords, remap its synonyms.

    Replaces ``text`` by ``content`` and adds ``old_content``, ``original_keywords``,
    ``mapped_keywords``, ``categories``, ``categorized_keywords`` and ``is_remapped``.
    A projection of each row alone, in batch and in stream.
    """
    has_synonyms = bool(taxonomy.synonyms)
    synonyms = taxonomy.synonym_map() if has_synonyms else None
    kept = [c for c in df.columns if c != text]

    found = df.withColumn("_lower", F.lower(text))
    found = found.withColumn("_keywords", match_keywords(F.col("_lower"), taxonomy))
    found = found.withColumn(
        "_hits",
        F.when(F.size("_keywords") < min_keywords, match_synonyms(F.col("_lower"), taxonomy)).otherwise(_no_strings()),
    )
    targets = (
        F.transform("_hits", lambda w: F.element_at(synonyms, w).target) if has_synonyms else _no_strings()
    )
    mapped = found.withColumn("mapped_keywords", F.concat("_keywords", targets))

    category_of = taxonomy.category_map()
    grouped = mapped.withColumn(
        "_tagged",
        F.filter(
            F.transform(
                "mapped_keywords",
                lambda k: F.struct(F.element_at(category_of, k).alias("category"), k.alias("keyword")),
            ),
            lambda t: t.category.isNotNull(),
        ),
    ).withColumn("categories", F.array_sort(F.array_distinct(F.transform("_tagged", lambda t: t.category))))

    rewritten = (
        F.aggregate(
            F.array_distinct("_hits"),
            F.col(text),
            lambda acc, w: F.regexp_replace(
                acc, F.element_at(synonyms, w).pattern, F.element_at(synonyms, w).replacement
            ),
        )
        if has_synonyms
        else F.col(text)
    )
    is_remapped = F.size("_hits") > 0
    return grouped.select(
        *kept,
        F.when(is_remapped, rewritten).otherwise(F.coalesce(F.col(text), F.lit(""))).alias("content"),
        F.when(is_remapped, F.col(text)).alias("old_content"),
        F.concat("_keywords", "_hits").alias("original_keywords"),
        "mapped_keywords",
        "categories",
        _by_category().alias("categorized_keywords"),
        is_remapped.alias("is_remapped"),
    )


def _by_category() -> Column:
    """Map of each of ``categories`` to its keywords in ``_tagged``."""
    of = lambda c: F.transform(F.filter("_tagged", lambda t: t.category == c), lambda t: t.keyword)
    return F.map_from_entries(F.transform("categories", lambda c: F.struct(c.alias("key"), of(c).alias("value"))))


#: A keyword of more runs of word characters is looked up by this many of them and compared whole where they occur.
HEAD_RUNS = 6

_PAIRS = "array<struct<keyword:string,category:string>>"
_HITS = "array<struct<p:int,word:string,target:string,category:string>>"
_PLACES = "array<struct<r:int,target:string>>"


def dictionary_index(dictionary: DataFrame) -> DataFrame:
    """Keywords of a ``(keyword, category, category_rank)`` table by the ``gram`` that stands for them in a text.

    A gram is a number of neighbouring runs of word characters with all that stands between them; if it
    starts or ends with other characters (``lead``, ``trail``), these reach to the next run of the text,
    which is what ``taxonomy.boundary_pattern`` asks for.  It is the keyword itself, or for ``long`` ones its first
    ``HEAD_RUNS`` runs.  The category of the lowest rank wins.
    """
    keyword = F.lower("keyword")
    words = (
        dictionary.where(keyword.rlike(WORD))
        .groupBy(keyword.alias("keyword"))
        .agg(F.min(F.when(F.col("category").isNotNull(), F.struct("category_rank", "category"))).alias("c"))
        .select("keyword", F.col("c.category").alias("category"), *_cut(F.col("keyword")))
    )
    long = F.size("_runs") > HEAD_RUNS
    head = F.array_join(
        F.transform(F.sequence(F.lit(0), F.lit(HEAD_RUNS - 1)), lambda i: F.concat(F.get("_gaps", i), F.get("_runs", i))), ""
    )
    return words.select(
        "keyword",
        "category",
        F.when(long, head).otherwise(F.col("keyword")).alias("gram"),
        F.least(F.size("_runs"), F.lit(HEAD_RUNS)).alias("n"),
        (~F.col("keyword").rlike(f"^{WORD}")).alias("lead"),
        (~F.col("keyword").rlike(f"{WORD}$") & ~long).alias("trail"),
        long.alias("long"),
    )


def _cut(lowered: Column) -> list[Column]:
    """The runs of a text, and what stands before, between and behind them."""
    return [word_runs(lowered).alias("_runs"), F.split(lowered, f"{WORD}++").alias("_gaps")]


def _grams(n: int, lead: bool, trail: bool) -> Column:
    """All grams of ``n`` runs of a text that has been cut."""
    if n == 1 and not (lead or trail):
        return F.col("_runs")
    last = F.size("_runs") - n - int(trail)

    def gram(p: Column) -> Column:
        parts = [F.get("_gaps", p)] if lead else []
        for i in range(n):
            parts += [F.get("_gaps", p + i)] * bool(i) + [F.get("_runs", p + i)]
        return F.concat(*parts, *([F.get("_gaps", p + n)] if trail else []))

    return F.when(last >= int(lead), F.transform(F.sequence(F.lit(int(lead)), last), gram)).otherwise(_no_strings())


def _row_key(key: str, text: str) -> list[Column]:
    """A row without its text: rows of one key with different texts stay apart."""
    return [F.col(key).alias("_key"), F.xxhash64(text).alias("text_key")]


def _same_row(a: str, b: str) -> Column:
    return F.col(f"{a}._key").eqNullSafe(F.col(f"{b}._key")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def _found_keywords(df: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """(_key, text_key, keyword, category) of all keywords that occur; of repeated rows each.

    A text gives its distinct grams of the lengths that the dictionary has, so a row of the join is a
    keyword that stands in the text, whatever else the dictionary holds.
    """
    shapes = index.select("n", "lead", "trail", "long").distinct().collect()  # as many as keywords have lengths
    grams = [_grams(n, lead, trail) for n, lead, trail in sorted({(s.n, s.lead, s.trail) for s in shapes})]
    if not grams:
        return df.select(*_row_key(key, text), F.lit("").alias("keyword"), F.lit("").alias("category")).limit(0)
    # The key is made before the text is cut up, and only that goes along with the grams.
    cut = df.select(*_row_key(key, text), F.lower(text).alias("_lower")).select("_key", "text_key", *_cut(F.col("_lower")))
    listed = cut.select("_key", "text_key", F.array_distinct(F.concat(*grams)).alias("_grams"))
    # Of a plain ``explode`` Spark infers a filter and pushes it below, so that each gram would cut the text anew.
    met = listed.select("_key", "text_key", F.explode_outer("_grams").alias("gram")).join(index, "gram")
    hits = met.select("_key", "text_key", "keyword", "category", "long")
    if not any(s.long for s in shapes):
        return hits.drop("long")
    heads = hits.where("long").groupBy("_key", "text_key").agg(F.collect_set(F.struct("keyword", "category")).alias("_heads"))
    texts = df.select(*_row_key(key, text), F.lower(text).alias("_lower")).alias("t").join(heads.alias("h"), _same_row("t", "h"))
    stands = lambda h: F.contains("_lower", h.keyword) & F.rlike("_lower", _boundary(h.keyword))
    whole = texts.select("t._key", "t.text_key", F.explode_outer(F.filter("_heads", stands)).alias("h")).where("h IS NOT NULL").select("_key", "text_key", "h.*")
    return hits.where("NOT long").drop("long").unionByName(whole)


def tag_by_join(df: DataFrame, dictionary: DataFrame, key: str = "id", text: str = "text") -> DataFrame:
    """Keywords and categories of each row against a dictionary table of any size.

    One row per (key, hash of the text): ``key``, ``text_key``, ``keywords``, ``categories``.
    Grams of the texts meet whole keywords in an equi-join, broadcast only if Spark measures the dictionary to
    be small; a gram that stands in every text is then a skewed partition that AQE splits.
    Texts stay where they are, but for those in which the head of a long keyword occurs.
    """
    tagged = _tag_lists(df, dictionary_index(dictionary), key, text)
    return tagged.select(
        F.col("_key").alias(key),
        "text_key",
        F.transform("_pairs", lambda p: p.keyword).alias("keywords"),
        F.array_sort(F.array_distinct(F.filter(F.transform("_pairs", lambda p: p.category), lambda c: c.isNotNull()))).alias("categories"),
    )


def _tag_lists(df: DataFrame, index: DataFrame, key: str, text: str) -> DataFrame:
    """``_key``, ``text_key`` and the sorted ``_pairs`` of keyword and category, one row for rows that are equal."""
    found = _found_keywords(df, index, key, text).groupBy("_key", "text_key").agg(
        F.array_sort(F.collect_set(F.struct("keyword", "category"))).alias("_pairs")
    )
    rows = df.select(*_row_key(key, text)).distinct()
    met = rows.alias("r").join(found.alias("f"), _same_row("r", "f"), "left")
    return met.select("r._key", "r.text_key", F.coalesce("_pairs", F.array().cast(_PAIRS)).alias("_pairs"))


def _synonym_lists(df: DataFrame, rows: DataFrame, known: DataFrame, key: str, text: str) -> DataFrame:
    """Per one of ``rows`` (``_key``, ``text_key``) with synonyms: ``_found`` by word of the text, and ``_places``, the runs that they replace.

    ``known`` are (word, target, category).  A synonym is found as a whole word of the text, and then replaced wherever it
    stands, so the places are all runs that equal it.  Only the texts of ``rows`` are cut into words.
    """
    texts = df.select(*_row_key(key, text), F.col(text).alias("_text")).alias("t").join(rows.alias("r"), _same_row("t", "r"), "left_semi")
    spaced = F.transform(F.split(F.lower("_text"), SPACE), strip_punctuation)
    both = F.array(
        F.struct(F.lit(True).alias("hit"), spaced.alias("words")),
        F.struct(F.lit(False).alias("hit"), F.transform(word_runs(F.col("_text")), F.lower).alias("words")),
    )
    # Words and runs go through one join: a run counts only if its word is a hit.
    kinds = texts.select("_key", "text_key", F.explode_outer(both).alias("k")).select(
        "_key", "text_key", "k.hit", F.posexplode_outer("k.words").alias("p", "word")
    )
    words = (
        kinds.join(known, "word")
        .groupBy("_key", "text_key", "word", "target", "category")
        .agg(
            F.collect_set(F.when(F.col("hit"), F.col("p"))).alias("hits"),
            F.collect_set(F.when(~F.col("hit"), F.col("p"))).alias("places"),
        )
        .where(F.size("hits") > 0)
    )
    every = lambda c, make: F.array_sort(F.flatten(F.collect_list(F.transform(c, make))))
    hit = lambda p: F.struct(p.alias("p"), "word", "target", "category")
    place = lambda p: F.struct(p.alias("r"), "target")
    return words.groupBy("_key", "text_key").agg(every("hits", hit).alias("_found"), every("places", place).alias("_places"))


def _spliced() -> Column:
    """The text of ``_gaps`` and ``_pieces`` with the runs at ``_places`` (in order) replaced, in one pass."""

    def kept(start: Column, end: Column) -> Column:
        return F.array_join(F.slice("_pieces", start + 1, F.greatest(end - start, F.lit(0))), "")

    after = lambda i: F.when(i > 0, F.get("_places", i - 1).r + 1).otherwise(F.lit(0))
    # Up to the run of a place, its gap, and what replaces it; behind the last place the rest.
    front = F.transform("_places", lambda x, i: F.concat(kept(after(i), x.r), F.get("_gaps", x.r), x.target))
    return F.concat(F.array_join(front, ""), kept(after(F.size("_places")), F.size("_gaps")))


def remap_by_join(
    df: DataFrame,
    dictionary: DataFrame,
    synonyms: DataFrame,
    key: str = "id",
    text: str = "text",
    min_keywords: int = 2,
    folder: str | None = None,
) -> DataFrame:
    """``tag_posts`` for dictionary and synonym tables of any size, with the same columns.

    ``synonyms`` are (word, target) rows, each word once.  What is found and where is decided from grams of all texts,
    and words and runs of those with few keywords; then each text moves once, to meet its own list by key and hash.  The words of a text are replaced in one
    pass over its runs.  Only where a word has other characters inside, or where a target holds a word
    of the same text that would be replaced in turn, are they replaced one after the other, in order of occurrence.

    The dictionary and the keywords of each row, which say whose synonyms count, are written below ``folder`` and read from there
    as long as the result is: a folder that all executors reach, by default a new one in the shared scratch folder.
    """
    folder = folder or scratch_dir(df.sparkSession, "tags")
    index = write_and_reload(dictionary_index(dictionary), f"{folder}/index")
    categories = index.select(F.col("keyword").alias("target"), "category")
    known = write_and_reload(synonyms.select("word", "target").join(categories, "target", "left"), f"{folder}/synonyms")
    tags = write_and_reload(_tag_lists(df, index, key, text), f"{folder}/keywords")
    few = tags.where(F.size("_pairs") < min_keywords).select("_key", "text_key")
    lists = (
        tags.alias("t")
        .join(_synonym_lists(df, few, known, key, text).alias("s"), _same_row("t", "s"), "left")
        .select(F.col("t._key").alias("_key"), F.col("t.text_key").alias("_text_key"), "_pairs", "_found", "_places")
    )
    own = F.col(key).eqNullSafe(F.col("_key")) & (F.xxhash64(text) == F.col("_text_key"))
    met = df.join(lists, own, "left").withColumns(
        {
            "_hits": F.coalesce("_found", F.array().cast(_HITS)),
            "_places": F.coalesce("_places", F.array().cast(_PLACES)),
            "_pairs": F.coalesce("_pairs", F.array().cast(_PAIRS)),
        }
    )
    words = F.transform("_hits", lambda h: h.word)
    targets = F.flatten(F.transform("_hits", lambda h: word_runs(F.lower(h.target))))
    in_turn = F.exists("_hits", lambda h: ~h.word.rlike(f"^{WORD}+$")) | F.arrays_overlap(words, targets)
    one_by_one = F.aggregate(
        F.array_distinct(F.transform("_hits", lambda h: F.struct(h.word, h.target))),
        F.col(text),
        lambda acc, h: F.regexp_replace(
            acc,
            F.concat(F.lit("(?iu)"), _boundary(h.word)),
            F.regexp_replace(h.target, r"([\\$])", r"\\$1"),
        ),
    )
    is_remapped = F.size("_hits") > 0
    keywords = F.transform("_pairs", lambda p: p.keyword)
    met = met.withColumns({"_one_pass": is_remapped & ~in_turn, "_remapped": is_remapped})
    # Columns of their own, so that a text is cut once and not once per place.
    cut = met.withColumns({"_runs": F.when(F.col("_one_pass"), word_runs(F.col(text))), "_gaps": F.when(F.col("_one_pass"), F.split(text, f"{WORD}++"))})
    cut = cut.withColumn("_pieces", F.zip_with("_gaps", "_runs", lambda gap, run: F.concat(gap, F.coalesce(run, F.lit("")))))
    tagged = cut.withColumn(
        "_tagged",
        F.filter(
            F.concat("_pairs", F.transform("_hits", lambda h: F.struct(h.target.alias("keyword"), h.category.alias("category")))),
            lambda p: p.category.isNotNull(),
        ),
    ).withColumn("categories", F.array_sort(F.array_distinct(F.transform("_tagged", lambda t: t.category))))
    return tagged.select(
        *[c for c in df.columns if c != text],
        F.when(F.col("_one_pass"), _spliced())
        .when(F.col("_remapped"), one_by_one)
        .otherwise(F.coalesce(F.col(text), F.lit("")))
        .alias("content"),
        F.when(F.col("_remapped"), F.col(text)).alias("old_content"),
        F.concat(keywords, words).alias("original_keywords"),
        F.concat(keywords, F.transform("_hits", lambda h: h.target)).alias("mapped_keywords"),
        "categories",
        _by_category().alias("categorized_keywords"),
        F.col("_remapped").alias("is_remapped"),
    )


def tag_with_tables(
    df: DataFrame,
    dictionary: DataFrame,
    synonyms: DataFrame,
    key: str = "id",
    text: str = "text",
    min_keywords: int = 2,
    folder: str | None = None,
) -> DataFrame:
    """``tag_posts`` with dictionaries given as tables: as literals of the plan if they are small, else by join.

    Only the number of entries decides, which is read off at most ``INLINE_LIMIT`` rows; the rows are the same.
    ``folder``: see ``remap_by_join``.
    """
    small = Taxonomy.from_tables(dictionary, synonyms, refuse=False)
    if small is not None:
        return tag_posts(df, small, text, min_keywords)
    return remap_by_join(df, dictionary, synonyms, key, text, min_keywords, folder)


def _boundary(word: Column) -> Column:
    """``taxonomy.boundary_pattern`` of a column of words."""
    quoted = F.regexp_replace(word, rf"((?!{WORD}).)", r"\\$1")
    left = F.when(word.rlike(f"^{WORD}"), F.lit("(?<!")).otherwise(F.lit("(?<="))
    right = F.when(word.rlike(f"{WORD}$"), F.lit(f"(?!{WORD})")).otherwise(F.lit(f"(?={WORD})"))
    return F.concat(quoted, left, F.lit(WORD), quoted, F.lit(")"), right)


def is_keyword(words: DataFrame, dictionary: DataFrame, word: str = "word") -> DataFrame:
    """Rows whose word, in lower case, is a dictionary keyword."""
    known = dictionary.select(F.lower("keyword").alias("_known"))
    return words.join(known, F.lower(word) == F.col("_known"), "left_semi")


def dictionary_stats(keywords: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Number of distinct keywords and of synonyms, one row."""
    return keywords.agg(F.count_distinct(F.lower("keyword")).alias("keywords")).withColumn(
        "synonyms", synonyms.agg(F.count_distinct("word")).scalar()
    )
