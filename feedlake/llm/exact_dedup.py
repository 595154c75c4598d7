"""Exact deduplication with counting quotient filters.

A text has a 64-bit fingerprint, cut into a quotient (high bits) and a remainder.  Every
partition builds a counting quotient filter: for each quotient its *run*, the sorted
remainders with their counts.  Filters of the same shape merge without loss by merging the
sorted runs quotient by quotient, so the merged filter is the filter of the whole table.
A fingerprint counted once belongs to a text that is alone.  All others are only suspects:
their texts are compared byte by byte.  Runs are plain sorted arrays, 8 bytes for a remainder and 8 for its count; how
many quotients there are follows from the number of rows.

Rows.  A null text counts as empty.  Texts are equal when they are identical.  Of equal texts
the row with the largest id stays; null ids are smaller than all others.  Of repeated rows
with that id one stays.  An empty table gives an empty result.  Other columns, whatever
their names, are carried along untouched by ``drop_copies`` and not read by ``decide``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import beside, fresh, remove, ship, store

FILTER = "quotient long, remainders binary, counts binary"


#: Fingerprints in one run of the merged filter, about; a run is held by one task, with 16 bytes for each.
RUN = 1 << 18


def quotient_bits(rows: int) -> int:
    """High bits of a fingerprint that name its run, so that runs stay small whatever the number of rows."""
    return max(1, min(40, (rows // RUN).bit_length()))


def _runs(fingerprints: np.ndarray, counts: np.ndarray, bits: int) -> pd.DataFrame:
    """One row per quotient of sorted, distinct fingerprints."""
    quotients = (fingerprints >> np.uint64(64 - bits)).astype(np.int64)
    remainders = fingerprints & np.uint64((1 << (64 - bits)) - 1)
    starts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1]][: len(quotients)])
    ends = np.r_[starts, len(quotients)][1:]
    return pd.DataFrame(
        {
            "quotient": quotients[starts],
            "remainders": [remainders[a:b].astype("<u8").tobytes() for a, b in zip(starts, ends, strict=True)],
            "counts": [counts[a:b].astype("<i8").tobytes() for a, b in zip(starts, ends, strict=True)],
        }
    )


def partition_filters(fingerprints: DataFrame, bits: int) -> DataFrame:
    """One counting quotient filter per partition of a table with one column of fingerprints."""
    name = fingerprints.columns[0]

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = [b[name].to_numpy(np.int64).view(np.uint64) for b in batches]
        values, counts = np.unique(np.concatenate(seen or [np.zeros(0, np.uint64)]), return_counts=True)
        yield _runs(values, counts, bits)

    return fingerprints.mapInPandas(build, FILTER)


def merge_filters(filters: DataFrame) -> DataFrame:
    """The filter of all partitions: runs of one quotient merge in the order of their remainders."""

    def merge(runs: pd.DataFrame) -> pd.DataFrame:
        remainders = np.concatenate([np.frombuffer(r, "<u8") for r in runs["remainders"]])
        counts = np.concatenate([np.frombuffer(c, "<i8") for c in runs["counts"]])
        order = np.argsort(remainders, kind="stable")  # merges the sorted runs
        remainders, counts = remainders[order], counts[order]
        starts = np.flatnonzero(np.r_[True, remainders[1:] != remainders[:-1]])
        return pd.DataFrame(
            {
                "quotient": [runs["quotient"].iloc[0]],
                "remainders": [remainders[starts].tobytes()],
                "counts": [np.add.reduceat(counts, starts).tobytes()],
            }
        )

    return filters.groupBy("quotient").applyInPandas(merge, FILTER)


def repeated(merged: DataFrame, bits: int, name: str) -> DataFrame:
    """The fingerprints that a merged filter has counted more than once, each once."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for q, r, c in zip(batch["quotient"], batch["remainders"], batch["counts"], strict=True):
                high = np.uint64(q) << np.uint64(64 - bits)
                often = np.frombuffer(r, "<u8")[np.frombuffer(c, "<i8") > 1]
                yield pd.DataFrame({name: (often | high).astype(np.uint64).view(np.int64)})

    return merged.mapInPandas(read, f"`{name}` long")


def suspect_fingerprints(docs: DataFrame, text_col: str, name: str) -> DataFrame:
    """Fingerprints that stand for two rows or more, as a stored table with one column."""
    ship(docs.sparkSession)
    bits = quotient_bits(docs.count())
    prints = docs.select(F.xxhash64(_text(text_col)).alias(name))
    return store(repeated(merge_filters(partition_filters(prints, bits)), bits, name), "fingerprints")


def _text(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit(""))


def equal_texts(suspects: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of two rows or more with the same text, as a stored table: ``digest``, ``keep_id``, ``group_size``.

    Suspects are grouped by the text itself, which compares bytes; equal texts combine before
    the shuffle, so a text that a third of all rows share arrives once per task.  The SHA-256
    names a group afterwards.  Should two verified texts ever share it, the job stops.
    """
    rows = suspects.select(F.col(id_col).alias("id"), _text(text_col).alias("text"))
    groups = rows.groupBy("text").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    verified = groups.filter("group_size > 1").select(F.sha2("text", 256).alias("digest"), "keep_id", "group_size")
    named = verified.groupBy("digest").agg(
        F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts")
    )
    alone = F.expr("if(texts > 1, raise_error('two texts share one SHA-256'), group_size)")
    return store(named.withColumn("group_size", alone).drop("texts"), "groups")


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Rows are numbered where they lie, in a stored table without texts; of equal rows the one with the smallest number stays.
    """
    name = "fingerprint"
    rows = docs.select(F.col(id_col).alias("id"), _text(text_col).alias("text"), F.xxhash64(_text(text_col)).alias(name))
    prints = suspect_fingerprints(docs, text_col, name)
    groups = equal_texts(rows.join(beside(prints), name, "left_semi"), "id", "text")
    remove(prints)
    digest = F.sha2(_text(text_col), 256).alias("digest")
    places = store(docs.select(F.col(id_col).alias("doc_id"), digest, F.monotonically_increasing_id().alias("place")), "places")
    # The smallest number combines before the shuffle; a text that very many rows share meets its one group by a
    # join of which AQE can split both sides.
    first = (
        places.join(groups.select("digest", "keep_id").hint("rebalance"), "digest")
        .filter(F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .groupBy("digest")
        .agg(F.min("place").alias("first"))
    )
    marked = store(groups.join(first, "digest"), "marked")
    remove(groups)
    alone = F.col("group_size").isNull()
    return places.join(marked.hint("rebalance"), "digest", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("place") == F.col("first"))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns."""
    name, digest, keep, size = (fresh(docs, c) for c in ("fingerprint", "digest", "keep_id", "group_size"))
    marked = docs.withColumn(name, F.xxhash64(_text(text_col)))
    prints = beside(suspect_fingerprints(docs, text_col, name))
    suspects = marked.join(prints, name, "left_semi")
    groups = beside(equal_texts(suspects, id_col, text_col).toDF(digest, keep, size))
    found = suspects.withColumn(digest, F.sha2(_text(text_col), 256)).join(groups, digest, "left")
    single = found.filter(F.col(size).isNull())
    chosen = found.filter(F.col(size).isNotNull() & F.col(id_col).eqNullSafe(F.col(keep))).dropDuplicates([digest])
    parts = [marked.join(prints, name, "left_anti"), single, chosen]
    return reduce(DataFrame.unionByName, [p.select(*[F.col(f"`{c}`") for c in docs.columns]) for p in parts])
