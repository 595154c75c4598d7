r"""License scans by diagonal voting.

Words are lower-cased runs of ASCII letters, digits and all non-ASCII characters.  All rolling
k-grams of words of every text are hashed and joined with the places of the same k-grams in
the templates: k is 2 for phrases and openings of a sentence, and ``LONG_GRAM`` for whole license
texts.  A match at word ``p`` of the text and word ``q`` of a template votes for the
diagonal ``p - q``; votes are added up per text, template and diagonal.  A whole copy puts all
its votes on one diagonal.  A word put in or left out moves the rest to a neighbouring
diagonal, so each diagonal is merged with its neighbours (at most ``slack`` apart).  A merged
region is verified: the places of the template it matches, each counted once, must cover the
share ``coverage`` of the template.

*Phrases* are templates that must be matched whole, on a single diagonal; each such diagonal
is a place of the phrase.  The join compares the words too, so that no hash collision counts.

Rows.  Null and empty texts have no words, no places and no labels.  Texts are read whole.  A
text is named by its id and its SHA-256; repeated rows get the same result each.  An empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.llm.common import store
from feedlake.llm.license_texts import LICENSE_TEXTS

# Phrases (label by phrase), and openings of public licenses (label by text).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "this work is licensed under the gnu general public license version 3": "gpl-3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "gpl-notice",
    "licensed under cc by nc 4 0": "cc-by-nc-4.0",
    "licensed under cc by sa 4 0": "cc-by-sa-4.0",
    "this work is licensed under a creative commons attribution 4 0 international license": "cc-by-4.0",
    "released under the mit license": "mit-notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit-text",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "isc",
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Places of templates that are sent to every task at most: some megabytes.
MOST_SENT = 50_000
PLACES = "gram string, label string, whole boolean, k int, q int, grams int"
#: Words in a gram of a whole license text.
LONG_GRAM = 5


@dataclass(frozen=True)
class Rules:
    """Phrases and templates, text to label, with two words at least; and whole texts by label, with ``LONG_GRAM``."""

    phrases: dict[str, str]
    templates: dict[str, str]
    texts: dict[str, str] = field(default_factory=dict)

    def kinds(self) -> list[tuple[list[str], str, bool, int]]:
        """Words, label, whether all must match, and k of every template."""
        rows = [(t, label, True, 2) for t, label in self.phrases.items()]
        rows += [(t, label, False, 2) for t, label in self.templates.items()]
        rows += [(t, label, False, LONG_GRAM) for label, t in self.texts.items()]
        out = [([w for w in re.split(GAP, t.lower()) if w], label, whole, k) for t, label, whole, k in rows]
        for words, label, _, k in out:
            if len(words) < k:
                raise ValueError(f"a template of {label} needs {k} words")
        return out

    def grams(self) -> list[tuple[str, str, bool, int, int, int]]:
        """A row per k-gram of each template: what it is, where it stands, how many there are."""
        return [
            (" ".join(words[q : q + k]), label, whole, k, q, len(words) - k + 1)
            for words, label, whole, k in self.kinds()
            for q in range(len(words) - k + 1)
        ]

    def first_words(self, k: int) -> list[str]:
        """Words that k-grams begin with."""
        return sorted({gram.split(" ", 1)[0] for gram, _, _, n, _, _ in self.grams() if n == k})

    def places(self, spark: SparkSession) -> DataFrame:
        rows = [*self.grams(), ("", None, None, None, None, None)]  # the last is met by each document once
        places = spark.createDataFrame(rows, PLACES).withColumn("hash", F.xxhash64("gram"))
        # Spark has no size for rows made by the driver.  Few are sent to all tasks; more are a table to join.
        return F.broadcast(places) if len(rows) <= MOST_SENT else places


PRODUCTION = Rules(PHRASES, TEMPLATES, LICENSE_TEXTS)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), GAP), "")


def matches(docs: DataFrame, rules: Rules, id_col: str, text_col: str) -> DataFrame:
    """One pass over the texts, as a stored table: a row per document (``n_words``; no label) and a row per match.

    A match is a k-gram of a text (at ``p``) that is a k-gram of a template (at ``q``).  Words that no template's k-gram begins
    with are passed over before k-grams are made, where they are few enough to be part of the plan.
    """
    cut = docs.select(
        F.col(id_col).alias("id"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"),
        words(F.col(text_col)).alias("words"),
    )

    def grams_of(k: int) -> Column:
        every = F.sequence(F.lit(0), F.size("words") - k)
        begins = rules.first_words(k)
        starts = F.filter(every, lambda i: F.get("words", i).isin(begins)) if len(begins) <= MOST_SENT else every
        gram = lambda i: F.array_join(F.array(*[F.get("words", i + n) for n in range(k)]), " ")
        made = F.transform(starts, lambda i: F.struct(i.alias("p"), gram(i).alias("here")))
        return F.when(F.size("words") >= k, made).otherwise(F.array().cast("array<struct<p:int,here:string>>"))

    # The empty gram stands for the document itself.
    itself = F.array(F.struct(F.lit(-1).alias("p"), F.lit("").alias("here")))
    grams = F.concat(itself, *[grams_of(k) for k in sorted({k for _, _, _, k in rules.kinds()})])
    # Of a plain ``explode`` Spark infers a filter and pushes it below, so that each text would be cut twice.
    rows = cut.select("id", "digest", F.size("words").cast("long").alias("n_words"), F.explode_outer(grams).alias("g"))
    same = (F.xxhash64("g.here") == F.col("hash")) & (F.col("g.here") == F.col("gram"))
    met = rows.join(rules.places(docs.sparkSession), same)
    return store(met.select("id", "digest", "n_words", "label", "whole", "k", "grams", "g.p", "q"), "matches")


def regions(found: DataFrame, coverage: float = 0.8, slack: int = 2) -> DataFrame:
    """Verified regions: ``id``, ``digest``, ``label``, ``whole``, ``start``, ``end`` (words, exclusive), ``share``.

    Every diagonal is taken together with those at most ``slack`` beside it and verified; the
    verified ones that touch are one region.  Stray votes thus never chain regions together.
    The diagonals of one text and template fit one task: they are no more than its words.
    """
    text = ["id", "digest", "label", "whole", "k", "grams"]
    diagonals = found.groupBy(*text, (F.col("p") - F.col("q")).alias("diagonal")).agg(
        F.collect_set("q").alias("qs"), F.min("p").alias("lo"), F.max("p").alias("hi")
    )
    whole = diagonals.filter(F.col("whole") & (F.size("qs") == F.col("grams"))).select(
        *text, F.col("lo").alias("start"), (F.col("hi") + F.col("k")).alias("end"), F.lit(1.0).alias("share")
    )
    along = Window.partitionBy(*text).orderBy("diagonal")
    beside = along.rangeBetween(-slack, slack)
    verified = (
        diagonals.filter(~F.col("whole"))
        .withColumn("share", F.size(F.array_distinct(F.flatten(F.collect_list("qs").over(beside)))) / F.col("grams"))
        .withColumn("start", F.min("lo").over(beside))
        .withColumn("end", F.max("hi").over(beside) + F.col("k"))
        .filter(F.col("share") >= coverage)
    )
    near = F.col("diagonal") - F.lag("diagonal").over(along) <= slack
    merged = (
        verified.withColumn("step", F.when(near, 0).otherwise(1))
        .withColumn("region", F.sum("step").over(along))
        .groupBy(*text, "region")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("share").alias("share"))
    )
    return whole.unionByName(merged.select(whole.columns))


def scan(docs: DataFrame, rules: Rules = PRODUCTION, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document: ``id``, ``digest``, ``n_words``, and ``found``, its regions by start."""
    met = matches(docs, rules, id_col, text_col)
    hits = (
        regions(met.filter("label IS NOT NULL"), **options)
        .groupBy("id", "digest")
        .agg(F.sort_array(F.collect_set(F.struct("start", "end", "label", "whole", "share"))).alias("found"))
    )
    rows = met.filter("label IS NULL").select("id", "digest", "n_words")
    r, h = rows.alias("r"), hits.alias("h")
    both = F.col("r.id").eqNullSafe(F.col("h.id")) & (F.col("r.digest") == F.col("h.digest"))
    return r.join(h, both, "left").select("r.id", "r.digest", "r.n_words", F.coalesce("h.found", F.array().cast(hits.schema["found"].dataType)).alias("found"))
