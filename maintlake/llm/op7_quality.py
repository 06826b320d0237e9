"""Quality classifier: kernel ridge on document statistics by random Fourier features, then isotonic calibration.

Statistics of the whole text (shares of characters and words, repetition, lengths) are standardised over all
documents. Cosines of random projections approximate a Gaussian kernel, so ridge regression on them needs only the
sums X'X and X'y: every partition adds up its own, Spark adds the partitions, and the driver solves a system whose size
is the number of features. Pool-adjacent-violators on a held-back part of the training rows turns ridge scores into
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from maintlake.llm.shared import in_small_batches, require, saved
from maintlake.llm.textops import U, find_words, text_blocks

# classes of bytes: lower, upper, digit, space, line end, end of sentence, comma, other ASCII sign, part of a wider character
_CLASSES = 9
_CLASS = np.full(256, 7, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[[9, 11, 12, 13, 32]] = 0, 1, 2, 3
_CLASS[10], _CLASS[[33, 46, 63]], _CLASS[44], _CLASS[128:] = 4, 5, 6, 8
STATISTICS = (
    "lower", "upper", "digit", "space", "line_end", "stop", "comma", "sign", "wide", "log_bytes", "log_words",
    "word_mean", "word_deviation", "short_words", "long_words", "distinct_words", "doubled_words", "sign_ended_words",
    "words_a_line",
)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of statistics for each text; an empty text has zeros throughout."""
    n = offsets.size - 1
    sizes = np.diff(offsets)
    some = np.maximum(sizes, 1)
    owner = np.repeat(np.arange(n) * _CLASSES, sizes)
    shares = np.bincount(owner + _CLASS[data], minlength=n * _CLASSES).reshape(n, _CLASSES) / some[:, None]
    words = find_words(data, offsets)
    of, counts = words.owner, words.counts
    some_words = np.maximum(counts, 1)

    def total(values: np.ndarray) -> np.ndarray:
        return np.bincount(of, weights=values, minlength=n)

    lengths = (words.ends - words.starts).astype(float)
    mean = total(lengths) / some_words
    deviation = np.sqrt(np.maximum(total(lengths**2) / some_words - mean**2, 0))
    codes = words.codes()
    # text number in the upper bits: one sort brings the equal words of a text together
    keys = np.sort((of.astype(U) << U(40)) | (codes >> U(24)))
    fresh = np.ones(keys.size, bool)
    fresh[1:] = keys[1:] != keys[:-1]
    distinct = np.bincount((keys[fresh] >> U(40)).astype(np.int64), minlength=n)
    doubled = np.zeros(codes.size, bool)
    doubled[1:] = (codes[1:] == codes[:-1]) & (of[1:] == of[:-1])
    last = _CLASS[data[words.ends - 1]] == 7 if codes.size else np.zeros(0, bool)
    lines = shares[:, 4] * some + 1
    return np.column_stack(
        [
            shares, np.log1p(sizes), np.log1p(counts), mean, deviation, total(lengths <= 3) / some_words,
            total(lengths >= 15) / some_words, distinct / some_words, total(doubled) / some_words,
            total(last) / some_words, np.log1p(counts / lines),
        ]
    ) * (sizes > 0)[:, None]


def with_statistics(docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``stats``, an array of doubles. A text that is kept travels once."""
    in_small_batches(docs.sparkSession)
    others = [c for c in keep if c != text]
    source = docs.select(*(F.col(f"`{c}`") for c in [text, *others]))
    places = [0 if c == text else 1 + others.index(c) for c in keep]
    kept = [source.schema.fields[i] for i in places]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(0)):
                part = batch.slice(first, last - first)
                flat = statistics(data, offsets)
                stats = pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), flat.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(i) for i in places), stats], names=[*keep, "stats"])

    return source.mapInArrow(rows, f"{fields}, stats array<double>" if fields else "stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    #: Calibration: ridge scores and the probabilities there, straight lines between.
    at: np.ndarray
    probability: np.ndarray

    def features(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(z @ self.directions + self.phases) * np.sqrt(2 / self.phases.size)
        return np.column_stack([waves, z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.at, self.probability)


def pool_violators(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence nearest to ``value`` in weighted squares."""
    means: list[float] = []
    weights: list[float] = []
    sizes: list[int] = []
    for w, v in zip(weight, value):
        means.append(float(v)), weights.append(float(w)), sizes.append(1)
        while len(means) > 1 and means[-2] >= means[-1]:
            m, w2, s = means.pop(), weights.pop(), sizes.pop()
            means[-1] = (means[-1] * weights[-1] + m * w2) / (weights[-1] + w2)
            weights[-1] += w2
            sizes[-1] += s
    return np.repeat(means, sizes)




def matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, width)


def fit_quality(
    labelled: DataFrame,
    everything: DataFrame,
    n_waves: int = 256,
    width: float = 4.0,
    ridge: float = 1e-3,
    max_labelled: int = 400_000,
    grid: int = 4096,
    seed: int = 7,
) -> QualityModel:
    """Fit on ``labelled`` (stats, label 0/1, fold): fold 0 calibrates, the others fit the ridge weights.

    ``max_labelled`` bounds the rows fitted on: beyond it a part chosen by a hash of the statistics, equal at every
    run, is taken. Means and deviations come from ``everything`` (stats). Without rows of both classes the model gives
    the labels' mean (0.5 without labels).
    """
    d = len(STATISTICS)
    moments = everything.select(
        *(F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(d)),
        *(F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(d)),
    ).first()
    mean = np.array([moments[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([moments[f"s{i}"] or 1.0 for i in range(d)])
    rng = np.random.default_rng(seed)
    model = QualityModel(
        mean, scale, rng.normal(0, 1 / width, (d, n_waves)), rng.uniform(0, 2 * np.pi, n_waves),
        np.zeros(n_waves + d + 1), np.array([0.0]), np.array([0.5]),
    )
    n = labelled.count()
    if n > max_labelled:
        labelled = labelled.filter(F.pmod(F.xxhash64("stats", "label"), F.lit(1 << 30)) < int((1 << 30) * max_labelled / n))
    counts = {(r["c"], r["label"]): r["n"] for r in labelled.groupBy((F.col("fold") == 0).alias("c"), "label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = counts.get((False, 1), 0), counts.get((False, 0), 0)
    if not ones or not zeros:
        share = ones / (ones + zeros) if ones + zeros else 0.5
        return QualityModel(**{**vars(model), "probability": np.array([share])})
    size = n_waves + d + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            x = model.features(matrix(batch.column(0), d))
            total += x.T @ np.column_stack([x, np.asarray(batch.column(1), float)])
        rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), size + 1).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), rows], names=["i", "sums"])

    fitting = labelled.filter("fold <> 0").select("stats", F.col("label").cast("double").alias("label"))
    cells = (
        fitting.mapInArrow(sums, "i long, sums array<double>")
        .select("i", F.posexplode("sums").alias("j", "v"))
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .toPandas()
    )
    normal = np.zeros((size, size + 1))
    normal[cells["i"], cells["j"]] = cells["v"]
    penalty = ridge * (ones + zeros) * np.eye(size)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(normal[:, :-1] + penalty, normal[:, -1])
    model = QualityModel(**{**vars(model), "weights": weights})

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.clip(np.floor(model.raw(matrix(batch.column(0), d)) * grid / 2), -grid, grid).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), batch.column(1)], names=["cell", "label"])

    held = labelled.filter("fold = 0").select("stats", F.col("label").cast("double").alias("label"))
    steps = (
        held.mapInArrow(raw, "cell long, label double")
        .groupBy("cell")
        .agg(F.count("*").alias("n"), F.avg("label").alias("v"))
        .toPandas()
        .sort_values("cell")
    )
    if steps.empty:
        return QualityModel(**{**vars(model), "at": np.array([0.0, 1.0]), "probability": np.array([0.0, 1.0])})
    fitted = np.clip(pool_violators(steps["n"].to_numpy(), steps["v"].to_numpy()), 0, 1)
    return QualityModel(**{**vars(model), "at": (steps["cell"].to_numpy() + 0.5) * 2 / grid, "probability": fitted})


def fold_of(column: Column) -> Column:
    return F.crc32(column.cast("string").cast("binary")) % 5


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, keep: list[str] | None = None, **options) -> DataFrame:
    """``keep`` columns of ``docs`` (default: doc_id), then ``held_out, score, predicted``.

    Learns from ``labels`` (doc_id, quality) of rows whose crc32(doc_id as text) mod 5 is not 0; of these, remainder 1
    calibrates. Several labels of a document all count, null ones don't. A null or empty text has all statistics 0 and is
    scored from them. A null doc_id has no label and is not held out. Repeated rows get equal scores.
    """
    require(docs, "doc_id", "text")
    keep = keep or ["doc_id"]
    stats = saved(with_statistics(docs.select(*dict.fromkeys([*keep, "doc_id", "text"])), "text", list(dict.fromkeys([*keep, "doc_id"]))))
    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").alias("label"))
    fold = fold_of(F.col("doc_id"))
    known = known.filter(fold != 0)
    labelled = saved(
        stats.select("doc_id", "stats").join(known, "doc_id").select("stats", "label", (fold - 1).alias("fold"))
    )
    model = fit_quality(labelled, stats, **options)
    d = len(STATISTICS)
    source = stats.select("stats", *(F.col(f"`{c}`") for c in keep), F.coalesce(fold == 0, F.lit(False)).alias("__held"))
    names = [f for f in source.schema.fields[1:-1]]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in names)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.score(matrix(batch.column(0), d))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                names=[*batch.schema.names[1:-1], "held_out", "score", "predicted"],
            )

    return source.mapInArrow(rows, f"{schema}, held_out boolean, score double, predicted int")
