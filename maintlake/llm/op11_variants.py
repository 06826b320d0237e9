"""Spelling variants by PartEnum signatures.

The multiset of a word's letters is a binary vector: one place for the first a, one for the second a, and so on. One
inserted or deleted letter changes one place, a replaced one two, so near words have vectors at Hamming distance two or
less. The places are dealt into ``parts`` parts by a hash. Two vectors at distance two differ in at most two parts, so they
agree in all the others: every choice of ``parts - 2`` parts gives a signature, the number of the choice with what the
vector has in those parts, and near words are equal in at least one.

Words with equal signatures are compared in groups (a large group in pairs of blocks, never as one), and pairs are
verified as one edit apart. A pair that meets in several choices counts only in the first one that leaves out all parts in
which it differs. So nothing has to be made distinct afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maintlake.llm.links import each_group, in_blocks
from maintlake.llm.shared import require, saved, unsent

#: Runs of ASCII and Latin-1 letters (with the two signs among the latter).
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, least_letters: int, least_n: int, deleted_every: int) -> DataFrame:
    """``word, n`` of the distinct words. Where ``deleted_every`` divides the hash of ``<doc_id>:<run>``, the run loses the
    code point that the hash points at."""
    # a run of fewer letters gives no word, with or without a deletion
    runs = F.regexp_extract_all(F.col("text").cast("string"), F.lit(RUN.replace("+", f"{{{least_letters},}}")), F.lit(0))
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.explode(runs).alias("run"))
    each = each.withColumn("run", F.translate("run", _UPPER, _LOWER))
    hashed = each.withColumn("h", F.crc32(F.concat_ws(":", "doc_id", "run").cast("binary")))
    at = F.pmod("h", F.char_length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.col("h") % deleted_every == 0, cut).otherwise(F.col("run"))
    counted = hashed.select(word.alias("word")).filter(F.char_length("word") >= least_letters).groupBy("word")
    return counted.agg(F.count("*").alias("n")).filter(F.col("n") >= least_n)


def letter_parts(points: np.ndarray, lengths: np.ndarray, parts: int) -> np.ndarray:
    """What the letter multiset of each word has in each part, as a code: one row a word, one column a part."""
    of = np.repeat(np.arange(lengths.size), lengths)
    order = np.lexsort((points, of))
    letter = points[order].astype(np.int64)
    # the number of each letter among its equals
    fresh = np.append(True, (of[1:] != of[:-1]) | (letter[1:] != letter[:-1])) if of.size else np.zeros(0, bool)
    begin = np.flatnonzero(fresh)
    nth = np.arange(of.size) - np.repeat(begin, np.diff(np.append(begin, of.size)))
    place = _mixed(letter.astype(np.uint64) * np.uint64(1 << 32) + nth.astype(np.uint64))
    out = np.zeros((lengths.size, parts), np.uint64)
    np.add.at(out, (of, (place % np.uint64(parts)).astype(np.int64)), _mixed(place))
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def _code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.array([len(w) for w in words], np.int64)


def signatures(words: DataFrame, parts: int) -> DataFrame:
    """``family, choice, node, word, n``: a row for each word and choice of ``parts - 2`` parts; family is the signature."""
    left_out = list(combinations(range(parts), 2))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes = letter_parts(*_code_points(batch.column(1).to_pylist()), parts)
            every = codes.sum(axis=1, dtype=np.uint64)
            for choice, (a, b) in enumerate(left_out):
                signature = _mixed((every - codes[:, a] - codes[:, b]) ^ _mixed(np.array([choice + 1], np.uint64)))
                columns = [pa.array(signature.view(np.int64)), pa.array(np.full(batch.num_rows, choice, np.int32)), *batch.columns]
                yield pa.RecordBatch.from_arrays(columns, names=["family", "choice", *batch.schema.names])

    return words.select("node", "word", "n").mapInArrow(rows, "family long, choice int, node long, word string, n long")


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from ``a`` to ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def near_pairs(table: pa.Table, parts: int) -> pa.RecordBatch | None:
    """Both directions of each near pair of one pair of blocks: ``word, near, near_n``."""
    left, right = table.column("left")[0].as_py(), table.column("right")[0].as_py()
    node = np.asarray(table.column("node"))
    if node.size < 2:
        return None
    choice = table.column("choice")[0].as_py()
    words, n, block = table.column("word").to_pylist(), np.asarray(table.column("n")), np.asarray(table.column("block"))
    codes = letter_parts(*_code_points(words), parts)
    left_out = list(combinations(range(parts), 2))
    # one edit leaves the first or the last half of the shorter word as it is: the least halves are compared
    half = min(map(len, words)) // 2
    heads: dict[tuple[bool, str], list[int]] = {}
    for i, w in enumerate(words):
        heads.setdefault((True, w[:half]), []).append(i)
        heads.setdefault((False, w[len(w) - half :]), []).append(i)
    found: set[tuple[int, int]] = set()
    for met in heads.values():
        for x, i in enumerate(met):
            for j in met[:x]:
                if left != right and block[i] == block[j] or (j, i) in found or abs(len(words[i]) - len(words[j])) > 1:
                    continue
                if one_edit(words[i], words[j]):
                    found.add((j, i))
    out: list[tuple[str, str, int]] = []
    for j, i in found:
        differ = set(np.flatnonzero(codes[i] != codes[j]).tolist())
        if next(c for c, p in enumerate(left_out) if differ <= set(p)) == choice:
            out += [(words[i], words[j], int(n[j])), (words[j], words[i], int(n[i]))]
    if not out:
        return None
    a, b, c = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(c, pa.int64())], names=["word", "near", "near_n"]
    )


def near_words(words: DataFrame, parts: int, block_words: int) -> DataFrame:
    """``word, near, near_n`` of all pairs of ``words`` (word, n) that are one edit apart, in both directions."""
    numbered = saved(words.withColumn("node", F.monotonically_increasing_id()))
    signed = signatures(numbered, parts)
    shared = saved(signed.groupBy("family").agg(F.count("*").alias("n")).filter("n > 1").select("family"))
    # 21 rows a word come out of Arrow batches, and Spark takes them for one
    members = unsent(signed).join(unsent(shared), "family").withColumn("weight", F.lit(1))
    spread = in_blocks(members, "weight", block_words).drop("weight")
    return each_group(spread, ["family", "left", "right"], lambda t: near_pairs(t, parts), "word string, near string, near_n long")


def last_forms(links: DataFrame) -> DataFrame:
    """``word, root`` for the words of ``links`` (word, form): where following the forms ends. Each round doubles the steps."""
    now = saved(links.select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        step = now.join(unsent(further), now["root"] == further["at"], "left")
        after = saved(step.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if after.filter("moved").isEmpty():
            return after.select("word", "root")
        now = after.select("word", "root")


def spelling_variants(
    docs: DataFrame, least_letters: int = 6, least_n: int = 5, times: int = 5, deleted_every: int = 199, parts: int = 7,
    block_words: int = 4096,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``docs`` (doc_id, text).

    Words are the distinct maximal runs of letters, A-Z lower-cased, of ``least_letters`` code points or more that occur
    ``least_n`` times or more over all documents; some runs lose a letter first (see :func:`word_counts`). ``n_near`` counts
    the words one edit away, ``form`` is the most frequent of them (ties: smallest in code-point order) if it occurs
    ``times`` as often as the word, else null, ``form_n`` its count, and ``root`` where following the forms ends (the word
    itself without a form). Null and empty texts have no words; a null id hashes as empty text. Repeated rows count as often as they
    occur. An empty table gives no rows. Other columns are ignored.
    """
    require(docs, "doc_id", "text")
    if parts < 3:
        raise ValueError("signatures need at least three parts")
    words = saved(word_counts(docs, least_letters, least_n, deleted_every))
    # the greatest n, then the smallest word: the least of (-n, word)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near_words(words, parts, block_words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= F.col("n") * times
    joined = saved(
        words.join(near, "word", "left").select(
            "word", F.when(enough, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = last_forms(joined.filter("form IS NOT NULL"))
    return joined.join(unsent(roots), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
