"""Benchmark decontamination: windows of test items looked up in training texts.

Words are lower-cased runs of ASCII letters, digits and all non-ASCII characters.  A window is
``width`` consecutive words of an item; an item with fewer words, but at least one, is one
window.  The windows are broadcast as sorted hashes with the words behind them.  A task numbers
the words of a text, skips the places that hold a word no item has, hashes the rest and
verifies every match of a hash word by word.  Texts are never shuffled.

The broadcast is bounded: it holds at most ``most`` windows.  A larger benchmark is cut into
blocks by a hash of the window, and the blocks are looked up one after the other: before the
next block is read, the documents and what is found so far are written to the shared folder and the
broadcast is dropped.  The result is the same.

Rows.  Null or empty texts have no words and no hits.  Items with no words never occur; a null
item id is shown as an empty string.  Repeated items with one id count once.  Repeated documents are judged
each for itself.  An empty benchmark gives no hits, an empty table an empty result.  All
columns of the documents are kept; the verdict is one new struct column.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import WORD_BYTES, fresh, plain_words, remove, ship, store

VERDICT = "struct<n_words:bigint,starts:array<int>,ends:array<int>,items:array<string>>"


def windows(items: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``item`` and ``words`` (one blank between words) of every window, each once."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for item, text in zip(batch["item"], batch["text"], strict=True):
                words = plain_words(text)
                for i in range(max(min(len(words), 1), len(words) - width + 1)):
                    rows.append((item, b" ".join(words[i : i + width]).decode()))
            yield pd.DataFrame(rows, columns=["item", "words"])

    named = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), F.col(text_col).alias("text")
    )
    return named.mapInPandas(cut, "item string, words string").distinct()


@dataclass
class Lookup:
    """Windows of one length: hashes in order, the word numbers behind each, and the items that hold it."""

    hashes: np.ndarray
    numbers: np.ndarray
    items: list[list[str]]
    powers: np.ndarray

    @classmethod
    def build(cls, numbers: np.ndarray, items: list[list[str]]) -> Lookup:
        base = 0x9E3779B97F4A7C15
        while True:  # until no two windows share a hash
            powers = np.array([pow(base, j, 1 << 64) for j in range(1, numbers.shape[1] + 1)], np.uint64)
            hashes = (numbers * powers).sum(1, dtype=np.uint64)
            order = np.argsort(hashes)
            if len(np.unique(hashes)) == len(hashes):
                return cls(hashes[order], numbers[order], [items[i] for i in order], powers)
            base = (base * 6364136223846793005 + 1442695040888963407) % (1 << 64) | 1

    def find(self, text: np.ndarray, unknown: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start words of windows that occur in a text of numbered words, and which windows."""
        width = self.numbers.shape[1]
        places = np.flatnonzero(unknown[width:] == unknown[:-width])
        if not len(places):
            return places, places
        here = text[places[:, None] + np.arange(width)]
        at = np.searchsorted(self.hashes, (here * self.powers).sum(1, dtype=np.uint64))
        at[at == len(self.hashes)] = 0
        same = (self.numbers[at] == here).all(1)
        return places[same], at[same]


class Windows:
    """A block of windows in the form that is broadcast."""

    def __init__(self, items: list[str], words: list[str]):
        holders: dict[str, list[str]] = {}
        for item, window in zip(items, words, strict=True):
            holders.setdefault(window, []).append(item)
        self.number: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[list[int], list[str]]]] = {}
        for window, held in holders.items():
            numbers = [self.number.setdefault(w, len(self.number) + 1) for w in window.encode().split()]
            by_length.setdefault(len(numbers), []).append((numbers, held))
        self.lookups = [
            Lookup.build(np.array([n for n, _ in found], np.uint64), [h for _, h in found])
            for found in by_length.values()
        ]

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the items with a window that occurs."""
        hit, items = np.zeros(len(words) + 1, np.int64), set()
        text = np.fromiter(map(self.number.get, words, repeat(0)), np.uint64, len(words))
        unknown = np.r_[0, np.cumsum(text == 0)]
        for lookup in self.lookups:
            width = lookup.numbers.shape[1]
            if len(words) < width:
                continue
            places, found = lookup.find(text, unknown)
            np.add.at(hit, places, 1)
            np.add.at(hit, places + width, -1)
            for i in set(found.tolist()):
                items.update(lookup.items[i])
        return np.cumsum(hit)[:-1] > 0, items


def _spans(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.flatnonzero(np.diff(np.r_[0, hit.astype(np.int8), 0]))
    return edges[::2], edges[1::2]


def flag(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = 10,
    most: int = 500_000,
    into: str = "contamination",
) -> DataFrame:
    """``docs`` with a struct ``into``: number of words, spans of hit words (from, to), items that occur."""
    spark = docs.sparkSession
    ship(spark)
    into = fresh(docs, into)
    found = store(windows(items, item_col, item_text_col, width), "windows")
    blocks = max(1, -(-found.count() // most))
    part = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    out = docs.withColumn(into, F.lit(None).cast(VERDICT))
    stored = None
    for block in range(blocks):
        rows = found.filter(part == block).toPandas()
        ready = spark.sparkContext.broadcast(Windows(list(rows["item"]), list(rows["words"])))
        out = out.withColumn(into, _scanner(ready)(F.col(text_col), F.col(into)))
        if block + 1 < blocks:
            before, stored = stored, store(out, "flagged")
            ready.destroy()
            if before is not None:
                remove(before)
            out = stored
    return out


def _scanner(ready: Broadcast):
    def scan(text: pd.Series, before: pd.DataFrame) -> pd.DataFrame:
        out = []
        for t, starts, ends, held in zip(text, before["starts"], before["ends"], before["items"], strict=True):
            words = plain_words(t)
            hit, items = ready.value.scan(words)
            if starts is not None:  # what earlier blocks have found
                for a, b in zip(starts, ends, strict=True):
                    hit[a:b] = True
                items.update(held)
            a, b = _spans(hit)
            out.append((len(words), a, b, sorted(items)))
        return pd.DataFrame(out, columns=["n_words", "starts", "ends", "items"])

    return F.pandas_udf(scan, VERDICT).asNondeterministic()  # evaluated once, not again in a pushed filter


def hit_words(verdict: str) -> F.Column:
    """Number of hit words of the struct column."""
    return F.expr(f"cast(aggregate(zip_with(`{verdict}`.ends, `{verdict}`.starts, (b, a) -> b - a), 0, (n, x) -> n + x) as bigint)")


def drop_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The documents in which no window occurs."""
    into = fresh(docs, "contamination")
    return flag(docs, items, into=into, **options).filter(F.size(f"`{into}`.items") == 0).drop(into)


def drop_spans(docs: DataFrame, items: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All documents; from the first character of a span of hit words to its last, text is cut out."""
    into = fresh(docs, "contamination")

    def cut(text: pd.Series, verdict: pd.DataFrame) -> pd.Series:
        out = []
        for t, starts, ends in zip(text, verdict["starts"], verdict["ends"], strict=True):
            if t is not None and len(starts):
                raw = t.encode()
                letters = np.r_[0, np.frombuffer(raw.translate(WORD_BYTES), np.uint8) != 0x20, 0]
                edges = np.flatnonzero(np.diff(letters))
                first, last = edges[::2], edges[1::2]
                kept, at = [], 0
                for a, b in zip(starts, ends, strict=True):
                    kept.append(raw[at : first[a]])
                    at = last[b - 1]
                t = b"".join([*kept, raw[at:]]).decode()
            out.append(t)
        return pd.Series(out, dtype=object)

    udf = F.pandas_udf(cut, "string")
    flagged = flag(docs, items, text_col=text_col, into=into, **options)
    return flagged.withColumn(text_col, udf(F.col(text_col), F.col(into))).drop(into)
