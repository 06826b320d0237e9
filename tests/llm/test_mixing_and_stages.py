"""Raking against plain Python, targets that can't be met, and pipeline stages on tables with clashing columns."""

import collections
import random
import warnings

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from maintlake.llm import op1_mixing, op7_quality

SF = "/root/testdata/sf0.001"
#: Names that operators give to columns of their own.
INTERNAL = (
    "stats", "label", "fold", "held_out", "score", "predicted", "topic", "n_tokens", "weight", "probability", "sampled", "tokens",
    "raked", "node", "token", "family", "component", "value", "removed", "line", "row", "text_key", "n", "left", "right", "block",
)


def raked_by_hand(cells, targets, rounds=400):
    """Weights of {(a, b): tokens} whose sums by a and by b have the shares ``targets``."""
    total = sum(cells.values())
    w = {c: t / total for c, t in cells.items()}
    for _ in range(rounds):
        for dim, share in enumerate(targets):
            sums = collections.Counter()
            for c, x in w.items():
                sums[c[dim]] += x
            known = {v: s for v, s in share.items() if sums[v] > 0}
            w = {c: x * known.get(c[dim], 0) / sum(known.values()) / sums[c[dim]] if sums[c[dim]] else 0 for c, x in w.items()}
    return {c: x * total / cells[c] for c, x in w.items()}


def documents(spark, seed=4, n=300):
    rng = random.Random(seed)
    rows = [(i, rng.choice("aaab"), rng.choice(["en", "en", "de", None]), rng.randrange(1, 30)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, lang string, n_tokens long")


@pytest.mark.parametrize("max_cells", [1000, 0])
def test_weights_are_those_raked_by_hand(spark, max_cells):
    rows, docs = documents(spark)
    cells = collections.Counter()
    for _, s, language, t in rows:
        cells[s, language] += t
    targets = {"source": {"a": 1.0, "b": 2.0, "absent": 5.0}, "lang": {"en": 0.2, "de": 0.5, None: 0.3}}
    want = raked_by_hand(cells, [{k: v / 3 for k, v in targets["source"].items()}, targets["lang"]])
    out = op1_mixing.mix_sources(docs, targets, 0.4, rounds=15, tolerance=1e-9, max_cells=max_cells).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.weight == pytest.approx(want[r.source, r.lang], rel=1e-3)
    expected = sum(r.probability * r.n_tokens for r in out)
    assert expected == pytest.approx(0.4 * sum(cells.values()), rel=1e-3)
    # a document's chance is in proportion to its weight, where it isn't certain
    ratios = {round(r.probability / r.weight, 3) for r in out if r.probability < 1}
    assert len(ratios) == 1


@pytest.mark.parametrize("max_cells", [1000, 0])
def test_targets_that_no_row_has_give_no_weight(spark, max_cells):
    _, docs = documents(spark, n=30)
    out = op1_mixing.mix_sources(docs, {"source": {"x": 1}, "lang": {"en": 1}}, 0.5, rounds=3, max_cells=max_cells).collect()
    assert {(r.weight, r.probability, r.sampled) for r in out} == {(0.0, 0.0, False)}


def test_contradictory_targets_are_a_warning(spark):
    rows = [(1, "a", "en", 10), (2, "b", "de", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_tokens long")
    targets = {"source": {"a": 1, "b": 3}, "lang": {"en": 3, "de": 1}}
    with pytest.warns(UserWarning, match="contradict"):
        op1_mixing.mix_sources(docs, targets, 0.5).collect()
    with warnings.catch_warnings():
        warnings.simplefilter("error", UserWarning)
        op1_mixing.mix_sources(docs, {"source": {"a": 1, "b": 3}, "lang": 1.0}, 0.5, rounds=5, tolerance=2.0).collect()


def test_stages_keep_columns_with_the_names_of_their_own(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    own = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id")) for c in INTERNAL})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, own, SF)
        assert out.dtypes == own.dtypes, name
        kept = out.collect()
        assert 0 < len(kept) <= 120
        assert all(r[c] == f"{c} of {r.doc_id}" for r in kept for c in INTERNAL), name


def test_quality_stage_keeps_what_the_classifier_accepts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    scored = op7_quality.score_quality(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    accepted = sorted(r.doc_id for r in scored.filter("score >= 0.3").collect())
    stage = {r.doc_id: r for r in corpus_pipeline.quality_filter(spark, docs, SF).collect()}
    assert sorted(stage) == accepted and 0 < len(accepted) < docs.count()
    assert all(stage[r.doc_id] == r for r in docs.collect() if r.doc_id in stage)


def test_mixing_stage_keeps_the_documents_it_draws(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    known = op1_mixing.with_topics(docs.select("doc_id", "text", "source", "lang"))
    mixed = op1_mixing.mix_sources(known, op1_mixing.TARGETS, share_kept=0.8)
    drawn = sorted(r.doc_id for r in mixed.filter("sampled").collect())
    stage = corpus_pipeline.source_mix(spark, docs, SF).collect()
    assert sorted(r.doc_id for r in stage) == drawn and 0 < len(drawn) < docs.count()
