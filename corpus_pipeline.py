"""From raw documents to a training mix: five stages, each one of the corpus operators.

``run`` starts from the table ``documents``.  Every stage is written to the shared folder and read
again by the next, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import decontaminate, exact_dedup, mixing, near_dedup, quality
from feedlake.llm.common import fresh, store, table
from feedlake.llm.queries import MIX, QUALITY_THRESHOLD


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Each row is judged by its text alone: null and empty texts by the bias, long ones whole, repeated rows alike.  Without
    documents or usable labels all rows get the share of good labels, which is a half where there are none.  All columns
    stay, whatever their names.
    """
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "score")
    scored = docs.withColumn(score, quality.scorer(model, spark)(F.col("text")))
    return scored.filter(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id.

    A null text is an empty one.  Null ids are smaller than all others; of repeated rows with the largest id one
    stays.  Texts are compared whole.  No documents give none.  All columns stay, whatever their names.
    """
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 or more the one with the smallest id.

    Texts without words are linked with nothing and stay.  A null id names a group only if it has no other; repeated rows
    with the smallest id stay together, which the stage before has parted.  Texts are read whole.  No documents
    give none.  All columns stay, whatever their names.
    """
    return near_dedup.drop_near_copies(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Each row is judged by its whole text alone; null and empty ones, and those without words, stay, as do all if the benchmark
    is empty.  Ids play no part, and repeated rows are judged alike.  All columns stay, whatever their names.
    """
    return decontaminate.drop_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training mix: documents by epoch, with ``domain``, ``epoch``, ``n_tokens`` and ``take_tokens``.

    Documents without tokens are not taken; a null language or source is a node of its own, and so is a source without a
    number.  A long text may be cut to its first tokens; repeated rows are one unit of the order and share its tokens.  No documents
    give none.  All columns stay; if one of them bears the name of a fact, that fact's name is lengthened by ``_``.
    """
    into = fresh(docs, "mix")
    mixed = mixing.mix(docs, MIX, into=into)
    facts = [F.col(f"{into}.{c}").alias(fresh(docs, c)) for c in ("domain", "epoch", "n_tokens", "take_tokens")]
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns], *facts)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("source_mix", mix_sources),
]

#: The classifier's fit and the minhashes are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
