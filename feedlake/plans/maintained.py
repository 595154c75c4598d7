"""Curated tables that are maintained: each run reads only the posts that came since the last one.

A state folder keeps, for every run, the rollups of the posts that were new to it: activity and tags add up, and
the distinct (source, id, day) of each run tell how many ids a period has.  Only the days, weeks and months that a run touches are
counted anew, from the ids of their days; the other periods keep their counts.  With ``exact=False`` sketches take
the place of ids: of bounded size, and merged over all runs.

A run first writes its part, then the curated tables, and last the entry that makes it count.  A run that fails in between is done again
by the next one, over the same posts or more.  Posts that lie in the future wait in the state until their time has come.
After ``MOST_RUNS`` runs the parts are merged into one.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake import schemas
from feedlake.functions.times import month_label, week_label
from feedlake.operators import curated
from feedlake.operators.transform import align_schema
from feedlake.plans.lake import WRITERS, curated_tables
from feedlake.session import remove_folder, scratch, write_and_reload
from feedlake.sources import zones

MOST_RUNS = 24

_SLIM = (
    "id string, source string, collected_at timestamp, is_remapped boolean, has_keywords boolean, content_length int, "
    "tags array<struct<kind:string,tag:string>>"
)
_RUN = "base long, exact boolean, source string, upto long, run long"
_ACTIVITY = (
    "date date, source string, hour int, day_of_week int, posts long, rows long, remapped long, with_keywords long, "
    "length_sum long, length_rows long, length_min int, length_max int, long_posts long, short_posts long, "
    "first_post timestamp, last_post timestamp"
)
_TAGS = "kind string, date date, source string, tag string, mentions long"
_IDS = "source string, id string, date date"
_SKETCHES = "date date, source string, sketch binary"
_UNIQUES = "grain string, period string, source string, unique_posts long"


@dataclass
class _State:
    """What the runs so far have left below ``path``; the parts of the runs from ``base`` on count."""

    spark: SparkSession
    path: str
    run: int = -1
    base: int = 0
    exact: bool | None = None
    upto: dict[str, int] = field(default_factory=dict)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> _State:
        out = cls(spark, path)
        try:
            runs = spark.read.schema(_RUN).parquet(f"{path}/runs")
        except AnalysisException as e:
            if not zones.is_missing(e):
                raise
            return out
        rows = runs.where(F.col("run") == runs.agg(F.max("run")).scalar()).collect()  # one per source
        if rows:
            out.run, out.base, out.exact = rows[0].run, rows[0].base, rows[0].exact
            out.upto = {r.source: r.upto for r in rows if r.source is not None}
        return out

    def folder(self, kind: str, run: int) -> str:
        return f"{self.path}/{kind}/run={run}"

    def read(self, kind: str, schema: str, runs: range) -> DataFrame | None:
        if not runs:
            return None
        paths = [self.folder(kind, r) for r in runs]
        rows = self.spark.read.schema(schema).option("basePath", f"{self.path}/{kind}").parquet(*paths)
        return rows.drop("run")  # the folder of the run

    def parts(self, kind: str, schema: str) -> DataFrame | None:
        return self.read(kind, schema, range(self.base, self.run + 1))


def new_posts(spark: SparkSession, processed: str, sources, upto: dict[str, int]) -> tuple[DataFrame | None, dict[str, int]]:
    """The posts of later batches than ``upto`` has per source, and where they end.  Only the folders of these are read."""
    frames, ends = [], dict(upto)
    for source in sources:
        try:
            posts = zones.scan_processed(spark, processed, source)
        except AnalysisException as e:
            if not zones.is_missing(e):
                raise
            continue
        later = posts.where(F.col("ingest_batch") > upto.get(source, -1))
        newest = later.agg(F.max("ingest_batch")).first()[0]
        if newest is not None:
            ends[source] = newest
            frames.append(align_schema(later.where(F.col("ingest_batch") <= newest)))
    return (reduce(DataFrame.unionByName, frames) if frames else None), ends


def _touched(ids: DataFrame, iso_year: bool) -> dict[str, list[str]]:
    """The labels of all days, weeks and months of some ids: no more than the calendar has."""
    days = ids.select("date").distinct()
    labels = days.select(
        F.col("date").cast("string").alias("day"), week_label(F.col("date"), iso_year).alias("week"), month_label(F.col("date")).alias("month")
    ).collect()
    return {grain: sorted({r[grain] for r in labels}) for grain in ("day", "week", "month")}


def _uniques(state: _State, number: int, ids: DataFrame, iso_year: bool) -> DataFrame:
    """Distinct ids of all periods after this run, of whose ids ``ids`` are the new ones."""
    counted = lambda rows: curated.unique_rollup(rows.withColumnRenamed("date", "collected_at"), iso_year)
    if state.run < 0:
        return counted(ids)
    touched = _touched(ids, iso_year)
    known = state.parts("ids", _IDS)
    date = F.col("date")
    # A condition on the folder alone, so the ids of other days are not read.
    near = week_label(date, iso_year).isin(touched["week"]) | month_label(date).isin(touched["month"])
    here = reduce(lambda a, b: a | b, [(F.col("grain") == g) & F.col("period").isin(labels) for g, labels in touched.items()])
    before = state.read("uniques", _UNIQUES, range(state.run, state.run + 1))
    return before.where(~here).unionByName(counted(known.where(near).unionByName(ids)).where(here))


def update_curated(
    spark: SparkSession,
    processed: str,
    state_path: str,
    root: str,
    as_of: Column | None = None,
    sources=schemas.FEEDS,
    iso_year: bool = False,
    exact: bool = True,
) -> bool:
    """Bring the curated tables below ``root`` up to date; False if there was nothing new.

    The tables are those that ``build_curated`` makes of all posts.  ``exact`` and ``iso_year`` stay the same from
    run to run.
    """
    state = _State.load(spark, state_path)
    if state.exact not in (None, exact):
        raise ValueError("the state was made with the other kind of distinct counts")
    posts, upto = new_posts(spark, processed, sources, state.upto)
    now = F.lit(spark.range(1).select(F.current_timestamp() if as_of is None else as_of).first()[0])
    waiting = state.read("pending", _SLIM, range(state.run, state.run + 1)) if state.run >= 0 else None
    due = waiting is not None and not waiting.where(F.col("collected_at") <= now).isEmpty()
    if posts is None and not due:
        return False
    number = state.run + 1
    frames = ([curated.slim_posts(posts)] if posts is not None else []) + ([waiting] if waiting is not None else [])
    compact = number - state.base >= MOST_RUNS
    base = number if compact else state.base
    with scratch(spark, "new_posts") as folder, ThreadPoolExecutor(WRITERS) as pool:
        slim = write_and_reload(reduce(DataFrame.unionByName, frames), f"{folder}/posts")
        current = slim.where(F.col("collected_at") <= now)

        def part(kind: str, schema: str, new: DataFrame, merge, by: str | None = None) -> DataFrame:
            """Write the part of this run, all runs in one if they are merged; all parts that count from now on."""
            known = state.parts(kind, schema)
            rows = merge(known.unionByName(new)) if compact and known is not None else new
            out = (rows.hint("rebalance", by) if by else rows).write.mode("overwrite")
            (out.partitionBy(by) if by else out).parquet(state.folder(kind, number))
            return state.read(kind, schema, range(base, number + 1))

        ids = current.where("id IS NOT NULL").select("source", "id", F.to_date("collected_at").alias("date")).distinct()
        jobs = [
            pool.submit(part, "activity", _ACTIVITY, curated.activity_rollup(current), curated.merge_activity),
            pool.submit(part, "tags", _TAGS, curated.tag_rollup(current), curated.merge_tags),
            pool.submit(slim.where(F.col("collected_at") > now).write.mode("overwrite").parquet, state.folder("pending", number)),
        ]
        if exact:
            # Counted before the parts may be merged, from what was known and what is new.
            ids = write_and_reload(ids, f"{folder}/ids")
            uniques = write_and_reload(_uniques(state, number, ids, iso_year), state.folder("uniques", number))
            part("ids", _IDS, ids, DataFrame.distinct, "date")
        else:
            unions = lambda rows: rows.groupBy("date", "source").agg(F.hll_union_agg("sketch").alias("sketch"))
            uniques = curated.uniques_from_sketches(part("sketches", _SKETCHES, curated.unique_sketches(current), unions), iso_year)
        activity, tags, _ = [job.result() for job in jobs]
        # Merged once, not by each table anew.
        merged = {"activity": curated.merge_activity(activity), "tags": curated.merge_tags(tags)}
        activity, tags = pool.map(lambda item: write_and_reload(item[1], f"{folder}/{item[0]}"), merged.items())
        tables = curated_tables(activity, uniques, tags, iso_year)
        list(pool.map(lambda item: zones.write_curated(item[1], root, item[0], as_of), tables.items()))
    _mark(state, number, base, exact, upto)
    kinds = ("activity", "tags", "ids", "sketches") if compact else ()
    for kind, run in [(k, r) for k in kinds for r in range(state.base, number)]:
        remove_folder(spark, state.folder(kind, run))
    for kind in ("uniques", "pending"):
        remove_folder(spark, state.folder(kind, number - 1))
    return True


def _mark(state: _State, number: int, base: int, exact: bool, upto: dict[str, int]) -> None:
    rows = [(base, exact, source, end) for source, end in sorted(upto.items())] or [(base, exact, None, None)]
    entry = state.spark.createDataFrame(rows, "base long, exact boolean, source string, upto long")
    entry.coalesce(1).write.mode("overwrite").parquet(state.folder("runs", number))
