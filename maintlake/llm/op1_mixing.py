"""Mixing sources to target weights: raking of token weights, then sampling by calibrated probabilities.

Tokens are summed by (source, language, topic). Iterative proportional fitting scales these cells until their sums by
source, by language and by topic have the target shares. A document's probability is its cell's raked tokens over its
actual tokens, times one factor for all, cut at 1; the factor is found so that the expected tokens make the budget.
Whether a document is drawn depends on a hash of its id alone, so a rerun draws the same ones.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maintlake.llm.shared import require, saved
from maintlake.llm.textops import U, find_words, lowered, mix, text_blocks

TOPIC_BITS = 3


def with_topics(docs: DataFrame, text: str = "text", bits: int = TOPIC_BITS) -> DataFrame:
    """``docs`` without ``text``, with ``n_tokens`` (words of the whole text) and ``topic``.

    A topic is a cell of random hyperplanes through word-count space: each word votes +1 or -1 for each bit by its
    hash. Texts about the same words share a topic. Without words: 0 tokens, topic -1.
    """
    kept = [c for c in docs.columns if c not in (text, "n_tokens", "topic")]
    source = docs.select(F.col(f"`{text}`").alias("__text"), *(F.col(f"`{c}`") for c in kept))
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in source.schema.fields[1:])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(0)):
                words = find_words(lowered(data), offsets)
                n = last - first
                codes, topic = mix(words.codes()), np.zeros(n, np.int32)
                for b in range(bits):
                    votes = ((codes >> U(b)) & U(1)).astype(float) * 2 - 1
                    topic += (np.bincount(words.owner, weights=votes, minlength=n) > 0).astype(np.int32) << b
                topic[words.counts == 0] = -1
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(words.counts), pa.array(topic)],
                    names=[*batch.schema.names[1:], "n_tokens", "topic"],
                )

    return source.mapInArrow(rows, f"{schema}n_tokens long, topic int")


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def targets_from(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Target shares in proportion to tokens ** power: 1 keeps the present shares, 0 makes them equal."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    share = F.pow(F.col("tokens").cast("double"), F.lit(power))
    total = sums.agg(F.sum(share).alias("t"))
    return sums.select(F.col(dim).alias("value"), (share / total.scalar()).alias("share"))


def rake_in_memory(tokens: np.ndarray, codes: list[np.ndarray], shares: list[np.ndarray], rounds: int, tolerance: float):
    """Raked cell weights; ``codes[d]`` numbers the cells' values of dimension d, ``shares[d]`` are their targets.

    Targets count among the values that have tokens; where none of a dimension's has a target, all weights are 0.
    """
    goals = []
    for code, share in zip(codes, shares):
        share = np.where(np.bincount(code, weights=tokens, minlength=share.size) > 0, share, 0.0)
        if not share.sum() > 0:
            return np.zeros_like(tokens)
        goals.append(share / share.sum())
    shares = goals
    w = tokens / tokens.sum()
    for _ in range(rounds):
        worst = 0.0
        for code, share in zip(codes, shares):
            now = np.bincount(code, weights=w, minlength=share.size)
            factor = np.divide(share, now, out=np.zeros_like(share), where=now > 0)
            worst = max(worst, float(np.abs(now - share)[now > 0].max(initial=0)))
            w = w * factor[code]
        if not w.sum() > 0:  # the targets of different dimensions shut out all cells together
            return np.zeros_like(w)
        w = w / w.sum()
        if worst < tolerance:
            break
    else:
        _unreached(worst, rounds)
    return w


def _unreached(miss: float, rounds: int) -> None:
    if miss > 1e-3:
        warnings.warn(f"targets contradict each other: a share is off by {miss:.3g} after {rounds} rounds", stacklevel=3)


def rake_distributed(cells: DataFrame, targets: Mapping[str, DataFrame], rounds: int, tolerance: float) -> DataFrame:
    """The same on a DataFrame, for more cells than the driver should hold: one aggregation and join a dimension."""
    total = cells.agg(F.sum("tokens").cast("double").alias("t"))
    now = saved(cells.withColumn("raked", F.coalesce(F.try_divide(F.col("tokens"), total.scalar()), F.lit(0.0))))
    goals = {}
    for dim, target in targets.items():
        some = cells.filter("tokens > 0").select(F.col(dim).alias("present")).distinct()
        target = saved(target.join(some, _same("value", "present")).drop("present"))
        sum_of = target.agg(F.sum("share").alias("t"))
        goals[dim] = target.select("value", F.coalesce(F.try_divide("share", sum_of.scalar()), F.lit(0.0)).alias("share"))
    targets = goals
    for _ in range(rounds):
        worst = []
        for dim, target in targets.items():
            sums = now.groupBy(F.col(dim).alias("value")).agg(F.sum("raked").alias("now")).filter("now > 0")
            factor = sums.alias("s").join(target.alias("t"), _same("s.value", "t.value"), "left").select(
                F.col("s.value").alias("value"),
                (F.coalesce("t.share", F.lit(0.0)) / F.col("now")).alias("factor"),
                F.abs(F.col("now") - F.coalesce("t.share", F.lit(0.0))).alias("miss"),
            )
            factor = saved(factor)
            worst.append(factor.agg(F.max("miss").alias("m")).first()["m"] or 0.0)
            now = now.alias("c").join(factor.alias("f"), _same(f"c.{dim}", "f.value"), "left").select(
                *(F.col(f"c.{c}") for c in cells.columns), (F.col("raked") * F.coalesce("factor", F.lit(0.0))).alias("raked")
            )
        # targets that shut values out leave less than 1
        sum_now = now.agg(F.sum("raked").alias("t"))
        now = saved(now.withColumn("raked", F.coalesce(F.try_divide("raked", sum_now.scalar()), F.lit(0.0))))
        if max(worst) < tolerance:
            break
    else:
        _unreached(max(worst), rounds)
    return now


def _factor(tokens: np.ndarray, raked: np.ndarray, budget: float) -> float:
    """The factor c for which sum(tokens * min(1, c * raked / tokens)) is the budget (at most all that can be had)."""
    ratio = np.divide(raked, tokens, out=np.zeros_like(raked), where=tokens > 0)
    order = np.argsort(-ratio, kind="stable")
    full, rest = np.cumsum(tokens[order]) - tokens[order], raked[order][::-1].cumsum()[::-1]
    for f, r, top in zip(full, rest, ratio[order]):  # cells above the one at hand are taken whole
        if top <= 0 or r <= 0:
            break
        if (budget - f) / r * top <= 1:
            return max(0.0, (budget - f) / r)
    return float("inf")


def mix_sources(
    docs: DataFrame,
    targets: Mapping[str, Mapping | float],
    share_kept: float = 0.5,
    rounds: int = 200,
    tolerance: float = 1e-9,
    max_cells: int = 200_000,
    seed: int = 11,
) -> DataFrame:
    """``docs`` (doc_id, n_tokens and the target columns) with ``weight``, ``probability`` and ``sampled``.

    ``targets`` has, per column, shares by value (scaled to sum 1; values that are absent get 0) or a power of the
    present token shares. Null is a value like any other (key None). ``share_kept`` of the tokens is the expected size
    of the sample. Cells without tokens, and values with target 0, have probability 0. Targets are scaled over the values that
    have tokens; if none of a column's has a target, all weights are 0. Targets that contradict each other are a warning
    (they come as near as raking gets in ``rounds``). Rows with the same id are
    drawn together; rows without id by a hash of their other columns. No row is dropped: callers filter ``sampled``.

    Cells are few (values of one column times those of the others): up to ``max_cells`` are raked on the driver,
    more on the executors.
    """
    require(docs, "doc_id", "n_tokens", *targets)
    spark = docs.sparkSession
    dims = list(targets)
    cells = saved(docs.groupBy(*dims).agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens")))
    goals = {}
    for dim, goal in targets.items():
        if isinstance(goal, Mapping):
            total = float(sum(goal.values())) or 1.0
            kind = cells.schema[dim].dataType.simpleString()
            goals[dim] = spark.createDataFrame([(k, v / total) for k, v in goal.items()], f"value {kind}, share double")
        else:
            goals[dim] = targets_from(cells, dim, goal)
    head = cells.limit(max_cells + 1).toPandas()
    if len(head) <= max_cells:
        raked = _raked_rows(spark, cells, head, {d: g.toPandas() for d, g in goals.items()}, share_kept, rounds, tolerance)
    else:
        raked = _raked_frame(cells, goals, share_kept, rounds, tolerance)
    raked = raked.select(*(F.col(d).alias(f"__{d}") for d in dims), "weight", "probability")
    on = F.lit(True)
    for d in dims:
        on = on & _same(d, f"__{d}")
    others = [c for c in docs.columns if c not in ("weight", "probability", "sampled")]
    draw = F.when(F.col("doc_id").isNotNull(), F.xxhash64(F.lit(seed), "doc_id")).otherwise(F.xxhash64(F.lit(seed), *others))
    uniform = F.pmod(draw, F.lit(1 << 52)) / float(1 << 52)
    return (
        docs.select(*others)
        .join(raked, on, "left")
        .select(*others, "weight", "probability", (uniform < F.col("probability")).alias("sampled"))
    )


def _raked_rows(spark, cells, head, goals, share_kept, rounds, tolerance) -> DataFrame:
    tokens = head["tokens"].to_numpy(float)
    raked = np.zeros_like(tokens)
    if tokens.sum() > 0:
        codes, shares = [], []
        for dim, goal in goals.items():
            known = {_plain(v): s for v, s in zip(goal["value"], goal["share"])}
            values = list(dict.fromkeys(map(_plain, head[dim])))
            number = {v: i for i, v in enumerate(values)}
            codes.append(np.array([number[_plain(v)] for v in head[dim]]))
            shares.append(np.array([known.get(v, 0.0) for v in values]))
        raked = rake_in_memory(tokens, codes, shares, rounds, tolerance) * tokens.sum()
    weight = np.divide(raked, tokens, out=np.zeros_like(tokens), where=tokens > 0)
    c = _factor(tokens, raked, share_kept * tokens.sum())
    p = np.where(weight > 0, np.minimum(1.0, weight * c if np.isfinite(c) else 1.0), 0.0)
    dims = [c for c in cells.columns if c != "tokens"]
    rows = [
        (*(_plain(v) for v in r), float(w), float(x)) for r, w, x in zip(head[dims].itertuples(index=False), weight, p)
    ]
    kinds = ", ".join(f"`{d}` {cells.schema[d].dataType.simpleString()}" for d in dims)
    return spark.createDataFrame(rows, f"{kinds}, weight double, probability double")


def _plain(value):
    """A Python value from a pandas one; missing is None."""
    if value is None or value != value:
        return None
    value = value.item() if hasattr(value, "item") else value
    return int(value) if isinstance(value, float) and value.is_integer() else value


def _raked_frame(cells, goals, share_kept, rounds, tolerance) -> DataFrame:
    raked = rake_distributed(cells, goals, rounds, tolerance)
    total = raked.agg(F.sum("tokens")).first()[0] or 0
    cells_w = saved(raked.withColumn("weight", F.when(F.col("tokens") > 0, F.col("raked") * total / F.col("tokens")).otherwise(0.0)))
    low, high, budget = 0.0, 1.0, share_kept * total
    expected = lambda c: cells_w.agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("weight") * c))).first()[0] or 0.0
    while expected(high) < budget and high < 1e9:
        high *= 4
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if expected(middle) < budget else (low, middle)
    return cells_w.withColumn("probability", F.least(F.lit(1.0), F.col("weight") * high))


#: Targets of the registered query and of the pipeline: large sources and languages damped, topics made equal.
TARGETS = {"source": 0.5, "lang": 0.7, "topic": 0.0}


def mixed_documents(docs: DataFrame, share_kept: float = 0.5) -> DataFrame:
    """Every row's id, source, language, topic, tokens, weight, probability and whether it is drawn."""
    return mix_sources(saved(with_topics(docs.select("doc_id", "text", "source", "lang"))), TARGETS, share_kept)
