"""Cleaning, tagging and remapping on small texts, and against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedlake.functions.taxonomy import INLINE_LIMIT, Taxonomy
from feedlake.functions.text import clean_content, clean_html
from feedlake.operators.tagging import match_keywords, remap_by_join, tag_by_join, tag_posts

SYNONYMS = {"love": "python", "all": "search", "people": "community", "great": "node", "work": "career", "less": "redis"}
WORDS = Taxonomy(
    ("less", "apache", "kafka", "apache-kafka", "c++", "c#", "r", "open source", "ai", "réseau"),
    (("first", ("kafka", "python")), ("second", ("kafka", "apache", "community"))),
    SYNONYMS,
)


def evaluate(spark, texts, make):
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    return [r.v for r in df.select("n", make(F.col("text")).alias("v")).orderBy("n").collect()]


def tags(spark, text, taxonomy=WORDS):
    return tag_posts(spark.createDataFrame([(text,)], "text string"), taxonomy).first()


def test_clean_html(spark):
    texts = ["a&amp;lt;b", "a&nbsp;&nbsp;b", "x<br>y", None, "", "  a \n\t b  ", "&#x27;q&#39; &quot;", "a  b", "1 < 2", "<<p>>"]
    assert evaluate(spark, texts, clean_html) == ["a<b", "a  b", "xy", "", "", "a b", "'q' \"", "a b", "1 < 2", ">"]


def test_clean_content(spark):
    assert evaluate(spark, [" a\n\r\tb ", None, "\n"], clean_content) == ["a b", "", ""]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Apache-Kafka!", ["apache", "apache-kafka", "kafka"]),
        ("c++ and c++11", ["c++"]),
        ("c++ and c#", []),
        ("un réseau", ["réseau"]),
        ("OPEN SOURCE, open  source", ["open source"]),
        ("openly open sourced", []),
        ("", []),
        (None, []),
    ],
)
def test_keywords(spark, text, expected):
    assert evaluate(spark, [text], lambda c: match_keywords(F.lower(c), WORDS)) == [expected]


def test_remap_applies(spark):
    r = tags(spark, "I love this, all people! LOVE")
    assert r.original_keywords == ["love", "all", "people", "love"]
    assert r.mapped_keywords == ["python", "search", "community", "python"]
    assert r.is_remapped and r.old_content == "I love this, all people! LOVE"
    assert r.content == "I python this, search community! python"
    assert r.categories == ["first", "second"]
    assert r.categorized_keywords == {"first": ["python", "python"], "second": ["community"]}


def test_remap_blocked_by_two_keywords(spark):
    r = tags(spark, "love kafka and ai")
    assert r.mapped_keywords == ["ai", "kafka"] and not r.is_remapped
    assert r.content == "love kafka and ai" and r.old_content is None


def test_hyphen(spark):
    r = tags(spark, "GREAT WORK-life")
    assert r.original_keywords == ["great"] and r.content == "node WORK-life"
    assert tags(spark, "(work) WORK-life").content == "(career) career-life"


def test_keyword_that_is_a_synonym(spark):
    r = tags(spark, "much less")
    assert r.original_keywords == ["less", "less"] and r.mapped_keywords == ["less", "redis"]
    assert r.content == "much redis"


def test_first_category_wins(spark):
    assert tags(spark, "kafka ai").categories == ["first"]


def test_empty_text(spark):
    for text in ("", None):
        r = tags(spark, text)
        assert (r.content, r.old_content, r.is_remapped) == ("", None, False)
        assert r.mapped_keywords == r.categories == r.original_keywords == [] and r.categorized_keywords == {}


def test_target_with_special_characters(spark):
    taxonomy = Taxonomy(("x1",), (), {"cost": r"us$1\n"})
    assert tags(spark, "the cost", taxonomy).content == r"the us$1\n"


def random_texts(n, seed=7):
    rng = random.Random(seed)
    parts = ["kafka", "apache", "open", "source", "c", "++", "#", "r", "-", " ", "  ", ".", ",", "é", "ai", "9", "_", "\n",
             "love", "all", "(", ")", "réseau", "11"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def brute_force(text):
    return sorted(k for k in WORDS.keywords if re.search(rf"\b{re.escape(k)}\b", text.lower(), re.IGNORECASE))


def test_keywords_equal_brute_force(spark):
    texts = random_texts(500)
    found = evaluate(spark, texts, lambda c: match_keywords(F.lower(c), WORDS))
    assert found == [brute_force(t) for t in texts]


def test_join_equals_literals(spark):
    """The dictionary as a table finds the same as the dictionary in the plan, copies of texts included."""
    texts = random_texts(300, seed=3) * 2 + [None]
    rows = [(k, None, None) for k in WORDS.keywords]
    rows += [(w, c, i) for i, (c, ws) in enumerate(WORDS.categories) for w in ws if w in WORDS.keywords]
    dictionary = spark.createDataFrame(rows, "keyword string, category string, category_rank int")
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    category = WORDS.category_of()
    tagged = tag_by_join(df, dictionary, key="n").collect()
    assert sorted(r.n for r in tagged) == list(range(len(texts)))
    for r in tagged:
        expected = brute_force(texts[r.n] or "")
        assert r.keywords == expected
        assert r.categories == sorted({category[k] for k in expected if k in category})


def test_rows_of_one_key_keep_their_own_keywords(spark):
    dictionary = spark.createDataFrame([("kafka", None, None), ("spark", None, None)], "keyword string, category string, category_rank int")
    df = spark.createDataFrame([(1, "kafka here"), (1, "only spark"), (None, "spark"), (2, None)], "id int, text string")
    rows = tag_by_join(df, dictionary).collect()
    assert sorted(str(r.keywords) for r in rows) == ["['kafka']", "['spark']", "['spark']", "[]"]


def test_texts_are_not_shuffled(spark):
    dictionary = spark.range(50_000).selectExpr("'w' || id AS keyword", "'c' AS category", "1 AS category_rank")
    df = spark.range(100).selectExpr("id", "repeat('w1 w2 ', 3) AS text")
    tagged = tag_by_join(df, dictionary)
    tagged.collect()
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    from_texts = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert from_texts and not any("text#" in line for line in from_texts)


def test_remap_by_join_equals_literals(spark):
    """Any-size remapping finds and rewrites what the dictionary in the plan does."""
    texts = random_texts(200, seed=9) + ["Love kafka, LOVE all!", "all (all) love", None]
    rows = [(k, None, None) for k in WORDS.keywords]
    rows += [(w, c, i) for i, (c, ws) in enumerate(WORDS.categories) for w in ws if w in WORDS.keywords]
    dictionary = spark.createDataFrame(rows, "keyword string, category string, category_rank int")
    synonyms = spark.createDataFrame(list(WORDS.synonyms.items()), "word string, target string")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    small = Taxonomy.from_tables(dictionary, synonyms)
    columns = ["id", "old_content", "original_keywords", "mapped_keywords", "categories", "is_remapped"]
    one = {r.id: r for r in tag_posts(df, small).collect()}
    for r in remap_by_join(df, dictionary, synonyms).collect():
        assert [r[c] for c in columns] == [one[r.id][c] for c in columns], texts[r.id]


#: Chains (a target holds a later or earlier word), words with other characters inside, targets that need quoting.
CHAINED = {
    "love": "all work", "all": "love", "work": "r$1 \\d", "c++": "cpp", "less": "more less", "é-11": "x", "kafka": "", "open": "open.source",
}


def test_rewriting_by_join_equals_literals(spark):
    """Several synonyms a text, in order of occurrence, wherever they stand."""
    texts = random_texts(400, seed=11) + ["Love all WORK-life; less (work) love", "c++ love c++11", "é-11 all é-11", "work", "a,less"]
    dictionary = spark.createDataFrame([("ai", "first", 0), ("réseau", None, None)], "keyword string, category string, category_rank int")
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for words in (CHAINED, SYNONYMS):
        synonyms = spark.createDataFrame(list(words.items()), "word string, target string")
        one = {r.id: r for r in tag_posts(df, Taxonomy.from_tables(dictionary, synonyms), min_keywords=3).collect()}
        rows = remap_by_join(df, dictionary, synonyms, min_keywords=3).collect()
        assert len(rows) == len(texts) and any(len(set(r.original_keywords)) > 2 for r in rows)
        for r in rows:
            assert r.asDict() == {c: one[r.id][c] for c in r.asDict()}, texts[r.id]


def test_long_keywords_are_compared_whole(spark):
    words = [f"w{i}" for i in range(40)]
    long = [" ".join(words[:9]), "-".join(words[5:20]), "..." + " ".join(words[:8]), " ".join(words[:7]) + "!?", " ".join(words[:6])]
    dictionary = spark.createDataFrame([(k, f"c{len(k)}", len(k)) for k in long], "keyword string, category string, category_rank int")
    texts = [" ".join(words), "-".join(words), "a..." + " ".join(words), " ".join(words[:7]) + "!?b", " ".join(words[:7]) + "!? b", " ".join(words[:6]), None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {r.id: r.keywords for r in tag_by_join(df, dictionary).collect()}
    for i, text in enumerate(texts):
        assert got[i] == sorted(k for k in long if re.search(rf"\b{re.escape(k)}\b", text or "")), text


def joined_rows(df):
    """Rows that the joins of the executed plan with the dictionary put out."""
    return rows_out(df, "Join", "gram")


def rows_out(df, kind, word):
    """Rows that the nodes of this kind put out that name the word, in the executed plan."""
    plan, found = df._jdf.queryExecution().executedPlan(), []
    stack = [plan]
    while stack:
        node = stack.pop()
        if "AdaptiveSparkPlan" in node.nodeName():
            stack.append(node.executedPlan())
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
        if kind in node.nodeName() and word in node.toString().split("\n")[0]:
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return sum(found)


def test_joined_pairs_are_hits(spark):
    """Keywords that share their runs: one text place meets only the keywords that stand there."""
    pairs = [(f"w{i} w{j}", None, None) for i in range(40) for j in range(40)]
    dictionary = spark.createDataFrame(pairs, "keyword string, category string, category_rank int")
    rng = random.Random(5)
    texts = [" ".join(f"w{rng.randint(0, 39)}" for _ in range(200)) for _ in range(50)]
    tagged = tag_by_join(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), dictionary)
    hits = sum(len(r.keywords) for r in tagged.collect())
    assert 0 < hits <= joined_rows(tagged) <= 2 * hits
    assert hits == sum(len(set(zip(t.split(), t.split()[1:], strict=False))) for t in texts)


def test_tables_of_any_size_give_the_same(spark, monkeypatch):
    from feedlake.functions import taxonomy
    from feedlake.operators import tagging

    dictionary = spark.createDataFrame([(k, f"c{len(k)}", len(k)) for k in WORDS.keywords], "keyword string, category string, category_rank int")
    synonyms = spark.createDataFrame(list(SYNONYMS.items()), "word string, target string")
    df = spark.createDataFrame(list(enumerate(random_texts(100, seed=2))), "id int, text string")
    small = sorted(map(str, tagging.tag_with_tables(df, dictionary, synonyms).collect()))
    monkeypatch.setattr(taxonomy, "INLINE_LIMIT", 10)
    large = tagging.tag_with_tables(df, dictionary, synonyms)
    assert "Join" in large._jdf.queryExecution().toString() and sorted(map(str, large.collect())) == small


def test_only_texts_with_few_keywords_are_cut_into_words(spark, tmp_path):
    """Keywords are looked for once, and synonyms only in the texts where they count."""
    dictionary = spark.createDataFrame([("ai", "a", 0), ("kafka", "b", 1)], "keyword string, category string, category_rank int")
    synonyms = spark.createDataFrame([("love", "spark"), ("w1", "x")], "word string, target string")
    many = " ".join(["ai kafka"] + [f"w{i}" for i in range(500)])
    df = spark.createDataFrame([(1, many), (None, many), (2, "love ai"), (2, "love ai"), (None, "love"), (3, None)], "id int, text string")
    remapped = remap_by_join(df, dictionary, synonyms)
    rows = {(r.id, r.old_content): r for r in remapped.collect()}
    assert [rows[k].content for k in ((1, None), (None, None), (2, "love ai"), (None, "love"), (3, None))] == [many, many, "spark ai", "spark", ""]
    assert remapped.count() == 6
    assert rows_out(remapped, "Generate", "_grams") == 0 and "_grams" not in remapped._jdf.queryExecution().toString()
    assert 0 < rows_out(remapped, "Generate", "posexplode") <= 2 * (2 + 2 + 1 + 1)


def test_tags_of_a_batch_are_deleted(spark, tmp_path, monkeypatch):
    from feedlake import session
    from feedlake.functions import taxonomy
    from feedlake.operators import tagging

    monkeypatch.setattr(taxonomy, "INLINE_LIMIT", 1)
    dictionary = spark.createDataFrame([("ai", "a", 0)], "keyword string, category string, category_rank int")
    synonyms = spark.createDataFrame([("love", "spark")], "word string, target string")
    df = spark.createDataFrame([(1, "love ai")], "id int, text string")
    monkeypatch.setattr(session, "scratch_dir", lambda _, label: str(tmp_path / label))
    with session.scratch(spark, "tags") as folder:
        rows = tagging.tag_with_tables(df, dictionary, synonyms, folder=folder).collect()
        assert (tmp_path / "tags" / "keywords").exists()
    assert [r.content for r in rows] == ["spark ai"] and not (tmp_path / "tags").exists()


def test_taxonomy_from_tables(spark):
    kw = spark.createDataFrame(
        [("Kafka", "data", 1), ("kafka", "tech", 0), ("python", None, None)],
        "keyword string, category string, category_rank int",
    )
    syn = spark.createDataFrame([("love", "python")], "word string, target string")
    t = Taxonomy.from_tables(kw, syn)
    assert t.keywords == ("kafka", "python") and t.synonyms == {"love": "python"}
    assert t.category_of()["kafka"] == "tech"


def test_large_dictionary_is_refused(spark):
    with pytest.raises(ValueError):
        Taxonomy(tuple(f"w{i}" for i in range(INLINE_LIMIT + 1)))
    with pytest.raises(ValueError):
        table = spark.range(INLINE_LIMIT + 1).selectExpr("'w' || id AS keyword", "'c' AS category", "1 AS category_rank")
        Taxonomy.from_tables(table)
