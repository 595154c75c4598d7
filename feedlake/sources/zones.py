"""The raw, processed and curated zones: scans and writes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedlake import schemas
from feedlake.operators.transform import align_schema


CORRUPT = "_corrupt_record"
#: Fields that are not declared and of too many names to be columns.
REST = "_rest"
MOST_COLUMNS = 10_000


def raw_path(root: str, source: str) -> str:
    """Where the raw lines of a source lie, in folders by the time of their ingestion."""
    return f"{root.rstrip('/')}/{source}"


def is_missing(error: AnalysisException) -> bool:
    """Whether a scan failed because there is no such folder; any other failure is an error."""
    return error.getCondition() == "PATH_NOT_FOUND"


def _declared(schema: str | T.StructType) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def discover_columns(lines: DataFrame, schema: str | T.StructType, most: int = MOST_COLUMNS) -> dict[str, list[str]] | None:
    """Top-level fields that the schema does not declare, of all lines, each with all its spellings; one pass.

    Fields that differ in case alone are one column, under the spelling that sorts first.  None if there are more than
    ``most`` names: such names are data, and ``parse_lines`` then gives them as a map.
    """
    known = {f.name.lower() for f in _declared(schema).fields} | {CORRUPT, REST}
    fields = F.map_keys(F.from_json("value", "map<string,string>"))
    rows = lines.select(F.explode(fields).alias("name")).distinct().limit(most + 1).collect()
    if len(rows) > most:
        return None
    by_name: dict[str, list[str]] = {}
    for name in sorted(r.name for r in rows):
        if name.lower() not in known:
            by_name.setdefault(name.lower(), []).append(name)
    return {spellings[0]: spellings for spellings in sorted(by_name.values())}


def parse_lines(lines: DataFrame, schema: str | T.StructType, extra: Mapping[str, Sequence[str]] | None = MappingProxyType({})) -> DataFrame:
    """JSON lines (``value``) as records; no line is lost, whatever is in it.

    A field of another type than declared is NULL, and the others keep their values; a
    line that is no JSON object gives a row of NULLs.  Both have their text in ``_corrupt_record``.
    ``extra`` fields (see ``discover_columns``) are strings, nested ones as JSON; of several spellings in one line the
    first counts.  With None for ``extra`` all fields that are not declared are in one map, ``_rest``.
    """
    declared = _declared(schema)
    typed = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    beside = [c for c in lines.columns if c != "value"]
    wanted = extra is None or len(extra) > 0
    parsed = lines.select(
        F.from_json("value", typed, options).alias("r"),
        *([F.from_json("value", "map<string,string>").alias("m")] if wanted else []),
        *beside,
    )
    if extra is None:
        names = [F.lit(f.name) for f in declared.fields]
        found = [F.map_filter("m", lambda k, v: ~k.isin(*names)).alias(REST)]
    else:
        found = [F.coalesce(*[F.col("m")[s] for s in spellings]).alias(name) for name, spellings in extra.items()]
    return parsed.select("r.*", *found, *beside)


def scan_raw_jsonl(
    spark: SparkSession, path: str, schema: str | T.StructType, discover: bool = False
) -> DataFrame:
    """All JSON lines under ``path``, at any depth: the declared columns and ``_corrupt_record``.

    The number of rows is that of the lines, whichever columns are asked for.  With
    ``discover``, one more pass finds the fields that are not declared, which become columns too.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path).where(F.trim("value") != "")
    return parse_lines(lines, schema, discover_columns(lines, schema) if discover else {})


def scan_raw_hours(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """JSON lines with ``year``, ``month``, ``day`` and ``hour`` of their folders.

    A filter on these reads only the folders it names.
    """
    lines = spark.read.text(path).where(F.trim("value") != "")
    parts = [
        (F.col(p) if p in lines.columns else F.lit(None)).cast("int").alias(p) for p in ("year", "month", "day", "hour")
    ]
    return parse_lines(lines.select("value", *parts), schema)


_ITEM = (
    "struct<guid: string, link: string, title: string, author: string, creator: string, description: string, "
    "encoded: string, pubDate: string, date: string, category: array<string>>"
)
_LINKS = "array<struct<_href: string, _rel: string>>"
_ENTRY = (
    f"struct<id: string, link: {_LINKS}, title: string, author: struct<name: string>, summary: string, content: string, "
    "published: string, updated: string, category: array<struct<_term: string>>>"
)


def _xml_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """The elements ``tag`` of all files, whatever prefixes their names have, with the file each is from."""
    options = {"rowTag": tag, "ignoreNamespace": "true", "recursiveFileLookup": "true", "columnNameOfCorruptRecord": CORRUPT}
    rows = spark.read.format("xml").options(**options).schema(f"{schema}, {CORRUPT} string").load(path)
    return rows.select("*", F.col("_metadata.file_path").alias("file"))


def _address(links: Column) -> Column:
    """The link of an Atom element: the one to the page itself, else the first."""
    own = F.filter(links, lambda x: x._rel.isNull() | (x._rel == "alternate"))
    return F.coalesce(F.get(own, F.lit(0))._href, F.get(links, F.lit(0))._href)


def _rss_channels(spark: SparkSession, path: str) -> DataFrame:
    return _xml_rows(spark, path, "channel", f"title string, link string, item array<{_ITEM}>")


def _atom_feeds(spark: SparkSession, path: str) -> DataFrame:
    return _xml_rows(spark, path, "feed", f"title string, link {_LINKS}, entry array<{_ENTRY}>")


def scan_rss_xml(spark: SparkSession, path: str) -> DataFrame:
    """Entries of RSS and Atom files, one row each, with the title and address of their feed.

    Elements of other namespaces count where RSS has none of its own: ``dc:creator``, ``dc:date``, ``content:encoded``.
    Files that give nothing are in ``bad_feed_files``.
    """
    name = F.coalesce("feed_name", "feed_url").alias("feed_name")
    filled = lambda *columns: F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in columns])
    items = _rss_channels(spark, path).select(
        F.col("title").alias("feed_name"), F.col("link").alias("feed_url"), F.explode("item").alias("i")
    )
    rss = items.select(
        F.col("i.guid").alias("id"),
        "i.link",
        "i.title",
        filled("i.author", "i.creator").alias("author"),
        filled("i.description", "i.encoded").alias("summary"),
        filled("i.pubDate", "i.date").alias("published"),
        F.transform("i.category", lambda c: F.struct(c.alias("term"))).alias("tags"),
        name,
        "feed_url",
    )
    entries = _atom_feeds(spark, path).select(
        F.col("title").alias("feed_name"), _address(F.col("link")).alias("feed_url"), F.explode("entry").alias("i")
    )
    atom = entries.select(
        F.col("i.id").alias("id"),
        _address(F.col("i.link")).alias("link"),
        "i.title",
        F.col("i.author.name").alias("author"),
        filled("i.summary", "i.content").alias("summary"),
        filled("i.published", "i.updated").alias("published"),
        F.transform("i.category", lambda c: F.struct(c._term.alias("term"))).alias("tags"),
        name,
        "feed_url",
    )
    return rss.unionByName(atom)


def bad_feed_files(spark: SparkSession, path: str) -> DataFrame:
    """Files below ``path`` that hold no readable feed, whole: ``file`` and its text, ``value``.

    A file of which only one feed cannot be read is here too, and its other feeds are in ``scan_rss_xml``.
    """
    found = reduce(DataFrame.unionByName, [f(spark, path).select("file", "title", CORRUPT) for f in (_rss_channels, _atom_feeds)])
    # Spark reads no corrupt records on their own, so the titles are counted too.
    feeds = found.groupBy("file").agg(F.count("title").alias("titles"), F.count(CORRUPT).alias("broken"))
    good = feeds.where("titles >= 0 AND broken = 0").select("file")
    texts = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
    return texts.select(F.col("_metadata.file_path").alias("file"), "value").join(good, "file", "left_anti")


#: Partition columns of the processed zone: every writer and every table has both.
PROCESSED_BY = ("source", "ingest_batch")


def scan_processed(
    spark: SparkSession, root: str, source: str, schema: T.StructType = schemas.POST
) -> DataFrame:
    """One source of the processed zone, in declared types: a source called ``007`` stays that.

    A post has its columns and ``ingest_batch``, the number of the run that added it.
    """
    path = f"{root}/{source}"
    typed = T.StructType([*schema.fields, T.StructField("ingest_batch", T.LongType())])
    return spark.read.schema(typed).option("basePath", path).parquet(path)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame | None:
    """The aligned union of all tables given; None if there is none."""
    aligned = [align_schema(f) for f in frames]
    return reduce(DataFrame.unionByName, aligned) if aligned else None


def scan_sources(
    spark: SparkSession, root: str, sources: Iterable[str] = schemas.FEEDS
) -> DataFrame | None:
    """The union of the sources that can be read and hold a row; None if none does.

    Only metadata and at most one row per source are read here.
    """
    found = []
    for source in sources:
        try:
            df = scan_processed(spark, root, source)
        except AnalysisException as e:
            if not is_missing(e):
                raise
            continue
        if not df.isEmpty():
            found.append(df)
    return union_sources(found)


def write_processed(posts: DataFrame, root: str, source: str, batch: int = 0) -> None:
    """Write one batch of a source; the same batch written again replaces itself."""
    (
        posts.withColumn("ingest_batch", F.lit(batch).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(*PROCESSED_BY)
        .parquet(f"{root}/{source}")
    )


def write_curated(df: DataFrame, root: str, table: str, aggregated_at: Column | None = None) -> None:
    """Overwrite one curated table, in its declared types.

    ``rebalance`` lets AQE merge small output partitions and split the one of a large
    source, where a plain repartition by source would make it a single task.
    """
    stamp = F.current_timestamp() if aggregated_at is None else aggregated_at
    schema = schemas.curated_schema(table)
    typed = df.withColumn("aggregated_at", stamp).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    )
    by_source = schemas.CURATED[table][2]
    writer = typed.hint("rebalance", "source") if by_source else typed.hint("rebalance")
    out = writer.write.mode("overwrite")
    (out.partitionBy("source") if by_source else out).parquet(schemas.curated_path(root, table))


def load_curated(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All curated tables by name, in declared types; one that is not there is empty."""
    out = {}
    for table in schemas.CURATED:
        schema = schemas.curated_schema(table)
        try:
            out[table] = spark.read.schema(schema).parquet(schemas.curated_path(root, table)).select(*schema.names)
        except AnalysisException as e:
            if not is_missing(e):
                raise
            out[table] = spark.createDataFrame([], schema)
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """A result as CSV files with a header and no index."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def load_dictionary(spark: SparkSession, keywords: str, synonyms: str | None = None):
    """Dictionary tables from CSV: (keyword, category, category_rank) and (word, target)."""
    kw = read_csv(spark, keywords, "keyword string, category string, category_rank int")
    return kw, read_csv(spark, synonyms, "word string, target string") if synonyms else None
