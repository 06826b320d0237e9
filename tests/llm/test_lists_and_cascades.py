"""Sorted lists: what is read, and scores beyond doubles. Cascades: the size of their filters."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from maintlake.llm import op6_exact_topk, op9_urls


def brute(ids, rows, query_ids, queries, k):
    out = []
    for q, own in enumerate(query_ids):
        score = [(-sum(int(a) * int(b) for a, b in zip(row, queries[q])), int(i), r) for r, (i, row) in enumerate(zip(ids, rows)) if i != own]
        out += [(q, r, -s) for s, _, r in sorted(score)[:k]]
    return out


@pytest.mark.parametrize("size", [5, 1000, 1 << 30])
def test_lists_give_the_best_rows(size):
    rng = np.random.default_rng(3)
    for n in (1, 7, 300):
        rows = rng.integers(-size, size, (n, 6)).astype(float)
        rows[:, 5] = 0
        ids = rng.permutation(n)
        queries = np.vstack([rows[: min(n, 9)], np.zeros((1, 6))])
        query_ids = np.append(ids[: min(n, 9)], -1)
        q, r, s, _ = op6_exact_topk.block_top(ids, rows, query_ids, queries, 4)
        assert list(zip(q.tolist(), r.tolist(), s.tolist())) == brute(ids, rows, query_ids, queries, 4)


def test_reading_stops_early_where_bounds_allow_and_sooner_with_a_known_score():
    rng = np.random.default_rng(5)
    n = 4000
    rows = np.floor(1024 * rng.normal(size=(n, 16)) * 0.6 ** np.arange(16))
    ids, queries = np.arange(n), rows[:20]
    q, r, s, read = op6_exact_topk.block_top(ids, rows, ids[:20], queries, 10)
    assert list(zip(q.tolist(), r.tolist(), s.tolist())) == brute(ids, rows, ids[:20], queries, 10)
    full = 20 * n * 16
    assert read < 0.8 * full
    least = [min(s[q == i]) for i in range(20)]
    q2, r2, s2, again = op6_exact_topk.block_top(ids, rows, ids[:20], queries, 10, least)
    assert (q2 == q).all() and (r2 == r).all() and again <= read


def test_large_components_have_exact_scores_or_a_defined_error(spark):
    def found(*vectors):
        frame = spark.createDataFrame([(i, list(v)) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
        rows = op6_exact_topk.exact_top(frame, every_nth=10, block_rows=2).orderBy("query_id", "rank").collect()
        return [(r.query_id, r.vec_id, r.score) for r in rows]

    big = float(1 << 40)
    assert found((1.0, 1 / 1024), (big, 3.0), (big, 4.0)) == [(0, 2, (1 << 60) + 4096), (0, 1, (1 << 60) + 3072)]
    with pytest.raises(Exception, match="does not fit a long"):
        found((big, 1.0), (big, 1.0), (1.0, 1.0))


def cascade_bytes(keys, **options):
    return sum(level.bits // 8 for level in op9_urls.build_cascade(keys, **options))


def test_levels_are_bounded_by_the_listed_keys_however_many_others(spark):
    keys = spark.range(400_000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 80_000 == 7).alias("listed"))
    assert keys.filter("listed").count() == 5
    assert cascade_bytes(keys) <= 4096


def test_shards_judge_like_one_cascade(spark, monkeypatch):
    seen = []
    whole = op9_urls.build_cascade

    def noted(keys, bits_per_key, max_bytes):
        levels = whole(keys, bits_per_key, max_bytes)
        seen.append(sum(level.bits // 8 for level in levels))
        return levels

    monkeypatch.setattr(op9_urls, "build_cascade", noted)
    host = F.when(F.col("id") % 3 == 0, F.lit("hot.net")).otherwise(F.concat(F.lit("h"), F.col("id") % 9000, F.lit(".net")))
    pages = spark.range(30_000).select(
        F.col("id").alias("page_id"),
        F.concat(F.lit("x://"), host, F.lit("/p?"), F.when(F.col("id") % 7 == 0, "utm_a=1").otherwise("q")).alias("url"),
    )
    out = op9_urls.filter_urls(pages, F.col("url").rlike(op9_urls.CAMPAIGN), max_filter_bytes=4096).toPandas()
    assert len(seen) > 1 and max(seen) <= 4096 + 8 * 8
    assert len(out) == 30_000 and out.page_id.is_unique
    listed = {r.page_id: r.url for r in pages.collect()}
    key = {i: u[4:].split("?")[0] for i, u in listed.items()}
    blocked = {key[i] for i, u in listed.items() if "utm_" in u}
    assert all((v == "block") == (key[i] in blocked) for i, v in zip(out.page_id, out.verdict))
