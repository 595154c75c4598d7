"""The corpus pipeline: each stage on its own input, against plain code."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from feedlake.llm.common import store
from feedlake.llm.queries import MIX

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """Documents before the first stage and after each."""
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF), name))
    return [df.toPandas() for df in out]


def test_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    for df in steps[:-1]:
        assert list(df.columns) == list(steps[0].columns)
    assert all(len(a) > len(b) for a, b in zip(steps[:-2], steps[1:-1]))


def test_quality_keeps_good_documents(steps):
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").df().set_index("doc_id")["quality"]
    kept = set(steps[1]["doc_id"])
    good, bad = set(labels[labels == 1].index), set(labels[labels == 0].index)
    assert len(good & kept) >= 0.99 * len(good) and len(bad & kept) <= 0.15 * len(bad)


def test_exact_copies(steps):
    before, after = steps[1], steps[2]
    keep = before.assign(text=before["text"].fillna("")).groupby("text")["doc_id"].max()
    assert sorted(after["doc_id"]) == sorted(keep)


def test_near_copies(steps):
    from test_llm_operators import plain_links

    rows = list(zip(steps[2]["doc_id"], steps[2]["text"], strict=True))
    links = plain_links(rows, 5, 80)
    assert sorted(steps[3]["doc_id"]) == sorted(i for i, (_, c) in links.items() if i == c)


def test_benchmark(steps):
    words = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c if c.isascii() and (c.isdigit() or "a" <= c <= "z") or not c.isascii() else " " for c in t or "").split(" ")
    grams = set()
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet'").fetchall():
        w = [x for x in words(text) if x]
        grams |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    clean = []
    for doc_id, text in zip(steps[3]["doc_id"], steps[3]["text"], strict=True):
        w = [x for x in words(text) if x]
        if not any(tuple(w[i : i + k]) in grams for k in {len(g) for g in grams} for i in range(len(w) - k + 1)):
            clean.append(doc_id)
    assert sorted(steps[4]["doc_id"]) == sorted(clean)


def test_mix(steps):
    before, after = steps[4], steps[5]
    total = sum(len((t or "").split()) for t in before["text"])
    assert abs(after["take_tokens"].sum() - total * MIX.share_percent // 100) <= 500
    assert set(after["doc_id"]) <= set(before["doc_id"])
    assert (after["epoch"] < MIX.max_epochs).all()
    assert not after.duplicated(["doc_id", "epoch"]).any()


def test_run_is_the_stages(spark, steps):
    out = corpus_pipeline.run(spark, SF).toPandas()
    assert sorted(zip(out["doc_id"], out["epoch"], out["take_tokens"])) == sorted(zip(steps[5]["doc_id"], steps[5]["epoch"], steps[5]["take_tokens"]))


def odd_documents(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, and columns of the names that stages use."""
    from test_llm_operators import CLASH, DOC, LONG

    rows = [(1, None, "en", "src0", 0), (2, "", None, "src1", None), (3, " \n\t", "en", None, 3), (4, LONG, "en", "src2", 1), (4, LONG, "en", "src2", 1)]
    rows += [(None, "a b c d e f", "de", "src0", 11), (None, None, None, None, None), (5, "a b c d e f", "de", "web", 11), (5, "a b c d e f", "de", "web", 11)]
    rows += [(10 + i, f"some words of text number {i} that nobody else has written, {i * i}", "en", f"src{i % 3}", 60) for i in range(40)]
    return spark.createDataFrame(rows, DOC).withColumns({c: F.lit("other") for c in CLASH})


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows_of_a_stage(spark, tmp_path, name, stage):
    docs = odd_documents(spark)
    out = stage(spark, docs, SF)
    out.write.parquet(str(tmp_path / "out"))
    out = spark.read.parquet(str(tmp_path / "out"))
    facts = ["domain_", "epoch_", "n_tokens_", "take_tokens_"] if name == "source_mix" else []
    assert out.columns == docs.columns + facts
    assert out.filter("domain <> 'other' OR mix <> 'other' OR score <> 'other'").isEmpty()
    rows = sorted(((r["doc_id"] or 0, r["text"]) for r in out.collect()), key=str)
    before = sorted(((r["doc_id"] or 0, r["text"]) for r in docs.collect()), key=str)
    if name == "source_mix":
        assert 0 < len(rows) and all((r["text"] or "").split() for r in out.collect())
        return
    assert set(rows) <= set(before)
    if name == "exact_dedup":
        assert sorted(i for i, _ in rows if i < 10) == [2, 3, 4, 5]
    if name == "near_dedup":  # of the equal texts the one with the smallest id, its copies with it
        assert sorted(i for i, _ in rows if i < 10) == [0, 1, 2, 3, 4, 4, 5, 5]
    if name == "decontamination":
        assert rows == before


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_a_stage_without_documents(spark, name, stage):
    docs = odd_documents(spark)
    assert stage(spark, docs.limit(0), SF).count() == 0
