"""Hot keys: joins whose large side AQE can split, aggregates that combine first."""

import pytest
from pyspark.sql import functions as F

from feedlake.operators import curated
from feedlake.operators.tagging import is_keyword
from feedlake.operators.transform import exclude_seen

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",  # only eight partitions here
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def sorted_joins(spark):
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, column, n=60000):
    """A third of the rows share one key; the payload keeps the partitions large."""
    value = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
    return spark.range(0, n, 1, 8).select(value.alias(column), F.sha2(F.col("id").cast("string"), 256).alias("payload"))


def test_seen_ids(spark, sorted_joins):
    records = hot(spark, "id").withColumn("source", F.lit("a"))
    seen = hot(spark, "id", 3000).withColumn("source", F.lit("a")).where("id <> 'hot'")
    fresh = exclude_seen(records, seen)
    plan = final_plan(fresh)
    assert "skew=true" in plan and plan.count("Exchange hashpartitioning") <= 4  # two, shown in the final and the first plan
    assert fresh.count() == 60000 - 2000 and fresh.where("id = 'hot'").count() == 20000


def test_words(spark, sorted_joins):
    known = hot(spark, "keyword", 3000)
    found = is_keyword(hot(spark, "word"), known)
    assert "skew=true" in final_plan(found)
    assert found.count() == 20000 + 2000


def test_mentions_combine_before_the_shuffle(spark):
    posts = hot(spark, "id").select(
        "id", F.lit("a").alias("source"), F.lit("text").alias("content_clean"),
        F.lit("2024-01-01").cast("timestamp").alias("collected_at"),
        F.array(F.lit("Python")).alias("keywords"), F.array(F.lit("tech")).alias("categories"),
    )
    tags = curated.tag_rollup(posts)
    assert "partial_count" in final_plan(tags)
    assert {(r.kind, r.tag, r.mentions) for r in tags.collect()} == {
        ("keyword", "python", 60000), ("category", "tech", 60000)
    }
    uniques = curated.unique_rollup(posts)
    assert "partial_collect_set" in final_plan(uniques)
    assert {(r.grain, r.period, r.unique_posts) for r in uniques.collect()} == {
        ("day", "2024-01-01", 40001), ("week", "2024-W01", 40001), ("month", "2024-01", 40001)
    }


class _Session:
    """As much of a session as the scratch folder asks for, with no checkpoint folder set."""

    def __init__(self, master):
        self.conf = {}
        self.sparkContext = type("Context", (), {"master": master})


def test_no_local_scratch_on_a_cluster():
    from feedlake.session import scratch_dir

    assert scratch_dir(_Session("local[2]"), "x") != scratch_dir(_Session("local[2]"), "x")
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            scratch_dir(_Session(master), "x")
