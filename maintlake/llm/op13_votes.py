"""Quality rules by weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Every rule is a ratio of two counts of a document. Up to a lower limit the rule votes for the document, from an upper limit
on against it, and in between (or where the ratio isn't defined) it abstains. Nobody says which documents are good: that is
the hidden class of a mixture in which rules err independently. Expectation-maximisation estimates the share of good
documents and, for each rule and class, how often a vote is right. A document's posterior probability of being good
replaces the demand that all rules be passed, so one failed rule of many need not cost a document, and a rule that errs
often counts for little.

Documents with the same votes have the same posterior, so EM runs on the counts of the vote patterns: at most
3 ** len(RULES) rows, whatever the number of documents. All documents are counted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from maintlake.llm.shared import require, saved
from maintlake.llm.textops import find_words, text_blocks

_SYMBOL, _DIGIT, _SPACE, _ALNUM, _STOP = (np.zeros(256, bool) for _ in range(5))
_SYMBOL[list(b"#*$%&|<>")] = True
_DIGIT[48:58] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ALNUM[48:58] = _ALNUM[65:91] = _ALNUM[97:123] = _ALNUM[128:] = True
_STOP[list(b".!?:;\"')")] = True

#: Counts of a document that the rules are made of; the first five are part of the result.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_sign_words", "n_marked_words", "n_top_word", "n_digits", "n_lines",
    "n_ended_lines", "n_open_lines",
)
#: Rule: counted, relative to, votes for a document up to, votes against it from.
RULES = {
    "symbols": ("n_symbols", "n_words", 0.02, 0.1),
    "marked_words": ("n_marked_words", "n_words", 0.02, 0.1),
    "sign_words": ("n_sign_words", "n_words", 0.02, 0.1),
    "repeats": ("n_repeat_words", "n_words", 0.1, 0.3),
    "top_word": ("n_top_word", "n_words", 0.15, 0.3),
    "copied_lines": ("n_dup_lines", "n_lines", 0.05, 0.3),
    "open_lines": ("n_open_lines", "n_ended_lines + n_open_lines", 0.5, 0.9),
    "long_words": ("word_chars", "n_words", 10.0, 15.0),
    "short_words": ("n_words", "word_chars", 0.34, 0.5),
    "digits": ("n_digits", "word_chars", 0.05, 0.2),
    "short_lines": ("n_lines", "n_words", 0.2, 0.5),
}
GOOD, BAD, ABSTAINS = 0, 1, 2


def _ids(data: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Numbers of consecutive stretches of ``data`` that end at ``stops``: equal ones, and only those, have the same."""
    ends = pa.py_buffer(np.append(0, stops).astype(np.int64))
    stretches = pa.Array.from_buffers(pa.large_binary(), stops.size, [None, ends, pa.py_buffer(np.ascontiguousarray(data))])
    return np.asarray(stretches.dictionary_encode().indices).astype(np.int64)


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number for each pair, below the number of pairs."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1].astype(np.int64)


def counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of COUNTS for each text."""
    n = offsets.size - 1

    def inside(mask: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(mask))
        return total[ends] - total[starts]

    def per_text(of: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(of, weight, minlength=n).astype(np.int64)

    words = find_words(data, offsets)
    of = words.owner
    chars = inside((data & 0xC0) != 0x80, words.starts, words.ends)
    sign = inside(_ALNUM[data], words.starts, words.ends) == 0
    plain, _, ends = words.joined()
    word = _ids(plain, ends + 1)
    marked = inside(_SYMBOL[data], words.starts, words.ends) > 0
    # how often each text has each of its words that hold a letter or digit
    own = _paired(of, word)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, of[~sign], np.bincount(own)[own[~sign]] if own.size else own)
    # windows of three words inside one text
    at = np.flatnonzero(of[2:] == of[:-2])
    again = np.zeros(0, np.int64)
    if at.size:
        window = _paired(_paired(own[at], word[at + 1]), word[at + 2])
        again = at[np.bincount(window)[window] > 1]
    covered = np.zeros(of.size + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + 3, -1)
    repeated = np.cumsum(covered[:-1]) > 0
    # lines, each with a line feed at its end
    lined = np.insert(data, offsets[1:], 10)
    stops = np.flatnonzero(lined == 10) + 1
    starts = np.append(0, stops[:-1])
    text = np.searchsorted(offsets[1:] + np.arange(1, n + 1), starts, "right")
    solid = np.flatnonzero(inside(~_SPACE[lined], starts, stops) > 0)
    line, text = _ids(lined, stops)[solid], text[solid]
    ink = np.append(np.flatnonzero(~_SPACE[lined]), 0)
    last = lined[ink[np.searchsorted(ink[:-1], stops[solid]) - 1]] if solid.size else np.zeros(0, np.uint8)
    copy = np.ones(solid.size, bool)
    copy[np.unique(_paired(text, line), return_index=True)[1]] = False
    ended, wide = _STOP[last], last >= 128
    return np.column_stack(
        [
            words.counts, per_text(of, chars), inside(_SYMBOL[data], offsets[:-1], offsets[1:]), per_text(text, copy),
            per_text(of, repeated), per_text(of, sign), per_text(of, marked), top, inside(_DIGIT[data], offsets[:-1], offsets[1:]), per_text(text),
            per_text(text, ended), per_text(text, ~ended & ~wide),
        ]
    )


def votes(table: np.ndarray) -> np.ndarray:
    """One row of votes (GOOD, BAD or ABSTAINS) for each row of COUNTS."""
    column = {name: table[:, i].astype(float) for i, name in enumerate(COUNTS)}
    out = []
    for part, whole, good, bad in RULES.values():
        base = sum(column[c] for c in whole.split(" + "))
        ratio = column[part] / np.maximum(base, 1)
        vote = np.where(ratio <= good, GOOD, np.where(ratio >= bad, BAD, ABSTAINS))
        out.append(np.where(base > 0, vote, ABSTAINS))
    return np.column_stack(out)


def pattern_votes(pattern: np.ndarray) -> np.ndarray:
    """Votes back from their pattern, a number in base 3."""
    return pattern[:, None] // 3 ** np.arange(len(RULES)) % 3


@dataclass(frozen=True)
class VoteModel:
    #: Share of good documents; for each rule the chance that a vote on a good, and on a bad document is right.
    good: float
    right_on_good: np.ndarray
    right_on_bad: np.ndarray

    def posterior(self, cast: np.ndarray) -> np.ndarray:
        """Probability of being good for each row of votes."""
        for_, against = cast == GOOD, cast == BAD
        a, b = self.right_on_good, self.right_on_bad
        yes = np.log(self.good) + for_ @ np.log(a) + against @ np.log(1 - a)
        no = np.log(1 - self.good) + for_ @ np.log(1 - b) + against @ np.log(b)
        return 1 / (1 + np.exp(np.clip(no - yes, -700, 700)))


def fit(cast: np.ndarray, weight: np.ndarray, rounds: int = 500, tolerance: float = 1e-9, prior: float = 2.0) -> VoteModel:
    """EM on rows of votes that occur ``weight`` times.

    It starts from what all-must-pass filtering says: good without any vote against it. For each rule and class, ``prior``
    imagined votes, right and wrong in equal parts, keep every estimate between 0 and 1.
    """
    for_, against = (cast == GOOD).astype(float), (cast == BAD).astype(float)
    yes = np.where((cast == BAD).any(axis=1), 0.1, 0.9) * weight
    model = None
    for _ in range(rounds):
        no = weight - yes

        def right(who: np.ndarray, hits: np.ndarray, misses: np.ndarray) -> np.ndarray:
            hit, miss = who @ hits, who @ misses
            return (hit + prior / 2) / (hit + miss + prior)

        after = VoteModel(
            float((yes.sum() + prior / 2) / (weight.sum() + prior)), right(yes, for_, against), right(no, against, for_)
        )
        moved = 1.0 if model is None else max(
            abs(after.good - model.good),
            np.abs(after.right_on_good - model.right_on_good).max(),
            np.abs(after.right_on_bad - model.right_on_bad).max(),
        )
        model = after
        if moved < tolerance:
            break
        yes = model.posterior(cast) * weight
    return model


def counted(docs: DataFrame) -> DataFrame:
    """``doc_id``, COUNTS and ``pattern`` (the votes as one number) of every row."""
    names = ["doc_id", *COUNTS, "pattern"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                table = counts(data, offsets)
                pattern = votes(table) @ 3 ** np.arange(len(RULES))
                columns = [batch.column(0).slice(first, last - first), *(pa.array(c) for c in table.T), pa.array(pattern)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return ids.mapInArrow(rows, ", ".join(f"{n} long" for n in names))


def voted_documents(docs: DataFrame, least: float = 0.5, least_words: int = 50, most_repeated: int = 50) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): ``doc_id``, the first five COUNTS, ``base_failed, kept, posterior``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` percent of them in repeated windows of
    three words. ``kept``: not so, and a posterior of ``least`` or more. Words are split at ASCII white space, lines at line
    feeds. Null and empty texts have no words, all rules abstain and the base fails. Repeated rows count as often as they
    occur and get equal results; null ids stay null. An empty table gives no rows. Other columns are ignored.
    """
    require(docs, "doc_id", "text")
    signals = saved(counted(docs))
    patterns = signals.groupBy("pattern").agg(F.count("*").alias("n")).orderBy("pattern").toPandas()
    known = np.asarray(patterns["pattern"], np.int64)
    model = fit(pattern_votes(known), np.asarray(patterns["n"], float))
    chance = [(int(p), float(x)) for p, x in zip(known, model.posterior(pattern_votes(known)))]
    posterior = docs.sparkSession.createDataFrame(chance, "pattern long, posterior double")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    return signals.join(posterior, "pattern").select(
        "doc_id",
        *COUNTS[:5],
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= least)).alias("kept"),
        "posterior",
    )
