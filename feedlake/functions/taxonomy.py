"""Keyword, category and synonym dictionaries, and the rules that compare them with text.

A dictionary is a parameter of the caller.  Small ones become literals of the plan, so
tagging is a projection: no join, no shuffle, and the same code runs on a stream.  How
small is checked (``INLINE_LIMIT``); ``operators.tagging.tag_by_join`` takes any size.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.functions.text import WORD

INLINE_LIMIT = 5_000

_RUNS = re.compile(r"\w+")


def _quote(text: str) -> str:
    return "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in text)


def _is_word(ch: str) -> bool:
    return ch.isalnum() or ch == "_"


def boundary_pattern(keyword: str) -> str:
    r"""Java pattern of ``\bkeyword\b`` with Unicode word characters.

    A boundary next to a non-word character asks for a word character beyond it: ``c++``
    occurs in ``c++11``, and not in ``c++ and``.  The look-behind stands after the keyword,
    so the search looks for the keyword first.
    """
    quoted = _quote(keyword)
    left = f"(?<!{WORD}{quoted})" if _is_word(keyword[0]) else f"(?<={WORD}{quoted})"
    right = f"(?!{WORD})" if _is_word(keyword[-1]) else f"(?={WORD})"
    return quoted + left + right


def first_run(keyword: str) -> str:
    """The first run of word characters: any text with the keyword has it as a token."""
    found = _RUNS.search(keyword)
    if not found:
        raise ValueError(f"keyword without letters or digits: {keyword!r}")
    return found.group()


def needs_check(keyword: str) -> bool:
    """Whether the token alone does not prove that the keyword occurs."""
    return first_run(keyword) != keyword


def literal(value: object, ddl: str) -> Column:
    """A nested constant; Catalyst folds it once into the plan."""
    return F.from_json(F.lit(json.dumps(value)), ddl)


@dataclass(frozen=True)
class Taxonomy:
    """Keywords, categories in order of declaration, and synonyms (word to target)."""

    keywords: tuple[str, ...]
    categories: tuple[tuple[str, tuple[str, ...]], ...] = ()
    synonyms: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        object.__setattr__(self, "keywords", tuple(sorted({k.lower() for k in self.keywords})))
        size = len(self.keywords) + len(self.synonyms) + sum(len(w) for _, w in self.categories)
        if size > INLINE_LIMIT:
            raise ValueError(f"{size} dictionary entries are too many for literals; use tag_by_join")

    @classmethod
    def from_tables(cls, keywords: DataFrame, synonyms: DataFrame | None = None, refuse: bool = True) -> Taxonomy | None:
        """Read ``(keyword, category, category_rank)`` and ``(word, target)`` tables.

        No more than ``INLINE_LIMIT`` rows ever reach the driver; of larger tables it raises, or gives
        None if they are not to be refused.
        """
        rows = keywords.select("keyword", "category", "category_rank").limit(INLINE_LIMIT + 1).collect()
        others = synonyms.select("word", "target").limit(INLINE_LIMIT + 1).collect() if synonyms else []
        rows = [r for r in rows if r.keyword is not None and _RUNS.search(r.keyword)]
        # Each keyword may count twice: for itself and for its category.
        if 2 * len(rows) + len(others) > INLINE_LIMIT:
            if refuse:
                raise ValueError("dictionary tables are too large for literals; use tag_by_join")
            return None
        ranked: dict[tuple[int, str], list[str]] = {}
        for row in rows:
            if row.category is not None:
                ranked.setdefault((row.category_rank, row.category), []).append(row.keyword.lower())
        return cls(
            keywords=tuple(r.keyword for r in rows),
            categories=tuple((name, tuple(words)) for (_, name), words in sorted(ranked.items())),
            synonyms={r.word: r.target for r in others},
        )

    def category_of(self) -> dict[str, str]:
        """Word to the first category that lists it."""
        out: dict[str, str] = {}
        for name, words in self.categories:
            for word in words:
                out.setdefault(word, name)
        return out

    # Constants of the tagging plan.

    def first_runs(self) -> list[str]:
        return sorted({first_run(k) for k in self.keywords})

    def candidates(self) -> Column:
        """Map of first run to its keywords, with the pattern where the token proves nothing."""
        out: dict[str, list[dict]] = {}
        for k in self.keywords:
            out.setdefault(first_run(k), []).append(
                {"keyword": k, "pattern": boundary_pattern(k) if needs_check(k) else None}
            )
        return literal(out, "map<string, array<struct<keyword: string, pattern: string>>>")

    def synonym_map(self) -> Column:
        """Map of word to its target, the pattern of the word, and the target as replacement."""
        return literal(
            {
                w: {
                    "target": t,
                    "pattern": "(?iu)" + boundary_pattern(w),
                    "replacement": t.replace("\\", "\\\\").replace("$", "\\$"),
                }
                for w, t in self.synonyms.items()
            },
            "map<string, struct<target: string, pattern: string, replacement: string>>",
        )

    def category_map(self) -> Column:
        return literal(self.category_of(), "map<string, string>")
