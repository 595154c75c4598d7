"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters, digits and underscore of any script.
WORD = r"[\p{L}\p{N}_]"
# White space of any script, and the four separator control characters.
SPACE = r"(?U)[\s\x1c-\x1f]+"
# Characters stripped from both ends of a word before a synonym lookup (fixed value).
PUNCTUATION = ".,!?;:'\"()[]{}"

# Entities replaced in this order (fixed values).
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#x27;", "'"),
    ("&#39;", "'"),
)


def clean_html(col: Column) -> Column:
    """Tags dropped, white space collapsed, a few entities decoded; NULL gives ''.

    Entities are decoded after the white space, and ``&amp;`` before the others, so
    ``&amp;lt;`` ends as ``<`` and two ``&nbsp;`` stay two spaces.
    """
    out = F.regexp_replace(F.coalesce(col, F.lit("")), "<[^>]+>", "")
    out = F.regexp_replace(out, SPACE, " ")
    for entity, plain in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(plain))
    return F.trim(out)


def clean_content(col: Column) -> Column:
    """Line breaks and tabs become one space; NULL gives ''."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"[\n\r\t]+", " "))


def word_runs(col: Column) -> Column:
    """All maximal runs of word characters."""
    return F.regexp_extract_all(col, F.lit(f"{WORD}++"), F.lit(0))


def strip_punctuation(col: Column) -> Column:
    return F.btrim(col, F.lit(PUNCTUATION))
