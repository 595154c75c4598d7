"""Helpers that the corpus operators share: tables in the shared folder, words, row selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.session import scratch_dir, ship_package, write_and_reload

_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, for the functions that run there.

    Rows hold whole texts, so batches to Python workers are kept at 1,000 rows, unless the
    session sets fewer.
    """
    ship_package(spark)
    if int(spark.conf.get(_BATCH_ROWS)) > 1_000:
        spark.conf.set(_BATCH_ROWS, "1000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the folder that all executors share and go on from the copy.

    Later steps neither repeat the work nor depend on the executors that did it.
    """
    return write_and_reload(df, scratch_dir(df.sparkSession, label))


def remove(df: DataFrame) -> None:
    """Delete the files of a table made by ``store`` that no later step reads."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def beside(small: DataFrame, most: int = 500_000) -> DataFrame:
    """A stored table of narrow rows, as the other side of a join with texts.

    Of at most ``most`` rows, which are counted, it is sent to every task and the texts stay
    where they are; a larger one is joined by hash, which shuffles texts but does not sort them.
    """
    return F.broadcast(small) if small.count() <= most else small.hint("shuffle_hash")


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(doc_id: str | Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; null for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def sampled(labelled: DataFrame, per_class: str, most: int, sizes: dict, *key: str) -> DataFrame:
    """About ``most`` rows of every class at most, picked by a hash of ``key``.

    ``sizes``: rows of each class, of which there are few.  A filter: nothing is sorted or shuffled, and
    the same rows are picked wherever they lie.  A class of at most ``most`` rows stays whole.
    """
    share = 1 << 40  # so many places that a class of any size has rows in the first of them
    place = F.pmod(F.xxhash64(*key), F.lit(share))
    least = {name: most * share // rows for name, rows in sizes.items() if rows > most}
    picked = F.lit(True)
    for name, below in sorted(least.items()):
        picked = F.when(F.col(per_class) == F.lit(name), place < below).otherwise(picked)
    return labelled.filter(picked)


#: Bytes to words: A-Z in lower case, letters and digits and all bytes of non-ASCII characters kept, the rest blank.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the text after lower-casing A-Z, as UTF-8."""
    return text.encode().translate(WORD_BYTES).split() if text else []


def blank_words(text: str | None) -> list[bytes]:
    r"""Words ``[^\x20\x09-\x0D]+`` of the text after lower-casing A-Z, as UTF-8."""
    return text.encode().lower().split() if text else []
