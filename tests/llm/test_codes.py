"""Texts on which linear codes modulo a power of two agree, however they are multiplied."""

import numpy as np
import pytest

from maintlake.llm import op2_lines, op8_substrings, op10_jaccard
from maintlake.llm.textops import Rolling, digests, hashes


def twins(length):
    """A Thue-Morse word over two letters and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(length)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def arrays(*texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    stops = np.cumsum([len(t.encode()) for t in texts])
    return data, np.append(0, stops[:-1]), stops


@pytest.mark.parametrize("length", [1024, 2048])
def test_twins_agree_in_linear_codes_only(length):
    data, starts, ends = arrays(*twins(length))
    linear = Rolling(data).codes(starts, ends)
    assert linear[0] == linear[1]
    for seed in (0, 1):
        a, b = hashes(data, starts, ends, seed)
        assert a != b
    assert len(set(map(tuple, digests(data, starts, ends)))) == 2


def test_hashes_depend_on_content_alone():
    texts = ["a", "", "abcdefgh", "abcdefghi", "é" * 300, "abcdefgh", "x" * 512, "x" * 513, "é" * 300]
    data, starts, ends = arrays(*texts)
    for seed in (0, 1):
        codes = hashes(data, starts, ends, seed).tolist()
        alone = [int(hashes(*arrays(t), seed)[0]) for t in texts]
        assert codes == alone and len(set(codes)) == 7


@pytest.mark.parametrize("length", [1024, 2048])
def test_unlike_texts_stay(spark, length):
    one, two = twins(length)
    docs = spark.createDataFrame([(1, one), (2, two)], "doc_id long, text string")
    assert {r.n_removed for r in op2_lines.repeated_lines(docs).collect()} == {0}
    assert {r.doc_id: r.component_id for r in op10_jaccard.jaccard_components(docs).collect()} == {1: 1, 2: 2}
    tail = " ".join(f"w{i}" for i in range(19))
    passages = spark.createDataFrame([(1, f"{one} {tail}"), (2, f"{two} {tail}"), (3, f"{two} {tail}")], "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in op8_substrings.without_repeats(passages).collect()} == {1: 0, 2: 0, 3: 20}
    words = [" ".join("ab"[c == x] for c in one) for x in "ab"]  # the same letters as words, in windows of their length
    long = spark.createDataFrame(list(enumerate(words)), "doc_id long, text string")
    assert {r.n_removed for r in op8_substrings.without_repeats(long, window=length).collect()} == {0}
