"""What operators leave on disk: neither shuffle files of finished steps nor tables that nothing reads any more."""

import os
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from maintlake.llm import op2_lines, op10_jaccard
from maintlake.llm.shared import dropped, saved, scratch_dir


@pytest.fixture
def left(spark):
    """Columns of the saved tables that were added and are still there."""
    root = scratch_dir(spark).removeprefix("file://")
    os.makedirs(root, exist_ok=True)
    before = set(os.listdir(root))
    return lambda: [spark.read.parquet(f"{root}/{x}").columns for x in os.listdir(root) if x not in before and x.startswith("llm-")]


def shuffle_files(spark):
    top = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(top.apply(i).getName().startswith("shuffle_") for i in range(top.size()))


def texts(n=60):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=50)
        rows += [(3 * i, " ".join(text)), (3 * i + 1, " ".join([*text[:-1], "other"])), (3 * i + 2, " ".join(text) if i % 2 else None)]
    return rows


def test_a_saved_table_leaves_no_shuffle_files_and_can_be_dropped(spark, left):
    before = shuffle_files(spark)
    rows = saved(spark.range(1000).repartition(3).groupBy("id").count())
    assert shuffle_files(spark) <= before
    assert rows.count() == 1000 and len(left()) == 1
    dropped(rows)
    assert not left()


@pytest.mark.parametrize("slice_rows", [1 << 26, 500])
def test_near_duplicates_in_slices_keep_no_prefixes(spark, left, slice_rows):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    rows = op10_jaccard.linked_rows(docs, 5, Fraction(80, 100), slice_rows=slice_rows)
    assert not any({"prefix", "token", "all", "places"} & set(c) for c in left())
    want = {(i, 3 * (i // 3) if t else None) for i, t in texts()}
    assert {(r.doc_id, r.component_id) for r in rows.collect()} == want

def test_line_dedup_keeps_no_keys_of_lines(spark, left):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame([(1, f"{line}\nü"), (2, f"{line}\n\n日本\n{line[:-1]}"), (3, None)], "doc_id long, text string")
    out = op2_lines.repeated_lines(docs)
    assert not any({"keys", "token"} & set(c) for c in left())
    assert {r.doc_id: r.removed for r in out.collect()} == {1: [], 2: [0, 3], 3: []}


def test_what_a_stage_has_read_goes(spark, left, monkeypatch, tmp_path):
    spark.range(6).selectExpr("id AS doc_id", "'a b' AS text").write.parquet(f"{tmp_path}/documents.parquet")
    stage = lambda more: lambda spark, docs, sf_dir: docs.withColumn(more, F.lit(1)).filter("doc_id > 1")
    monkeypatch.setattr(corpus_pipeline, "STAGES", [(c, stage(c)) for c in "abcd"])
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert left() == [["doc_id", "text", "a", "b", "c"]]
    assert out.columns == ["doc_id", "text", "a", "b", "c", "d"] and out.count() == 4
