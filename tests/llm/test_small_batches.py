"""How much text goes to a Python worker at once."""

import pytest

from maintlake.llm import op3_pieces, op7_quality
from maintlake.llm.shared import BATCH_BYTES, in_small_batches

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.set(LIMIT, "64m")
    yield lambda: int(spark.conf.get(LIMIT))
    spark.conf.set(LIMIT, before)


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_texts_go_to_workers_in_small_batches_and_once(spark, limit):
    docs = spark.createDataFrame([(1, "some words", "en"), (2, None, "de"), (3, "", None)], "doc_id long, text string, lang string")
    out = op7_quality.with_statistics(docs, "text", ["lang", "text", "doc_id"])
    assert limit() == BATCH_BYTES
    assert "__text" not in plan(out)
    rows = {r.doc_id: (r.lang, r.text, sum(r.stats) > 0) for r in out.collect()}
    assert rows == {1: ("en", "some words", True), 2: ("de", None, False), 3: (None, "", False)}


def test_the_codec_has_small_batches_and_a_smaller_limit_stays(spark, limit):
    import public_tokenizers

    op3_pieces.encode_documents(spark.createDataFrame([(1, "a")], "doc_id long, text string"), public_tokenizers.path("piece_bpe_32k.model"))
    assert limit() == BATCH_BYTES
    spark.conf.set(LIMIT, "4096")
    in_small_batches(spark)
    assert limit() == 4096
