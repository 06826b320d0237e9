"""Lists of a block are read once for many queries; their results stay those of brute force."""

import numpy as np
import pytest

from maintlake.llm import op6_exact_topk


@pytest.mark.parametrize("size", [1000, 1 << 28])  # the larger one needs whole numbers beyond doubles
def test_a_slice_is_read_once_for_all_queries(monkeypatch, size):
    rng = np.random.default_rng(11)
    rows = rng.integers(-size, size, (400, 5)).astype(float)
    ids = rng.permutation(400) // 2  # every id twice
    reads = []
    met = op6_exact_topk.SortedLists.met
    monkeypatch.setattr(op6_exact_topk.SortedLists, "met", lambda self, *a: reads.append(a[1:3]) or met(self, *a))
    q, r, s, _ = op6_exact_topk.block_top(ids, rows, ids[:100], rows[:100], 5, [-np.inf] * 50 + [0] * 50)
    assert 0 < len(reads) <= 2 * op6_exact_topk.SLICES
    for i in range(100):
        scores = [sum(int(a) * int(b) for a, b in zip(row, rows[i])) for row in rows]
        others = sorted((-x, int(ids[n]), n) for n, x in enumerate(scores) if ids[n] != ids[i] and (i < 50 or x >= 0))
        assert list(zip((-s[q == i]).tolist(), r[q == i].tolist())) == [(x, n) for x, _, n in others[:5]]
