"""The quality classifier against ridge regression and isotonic regression written out in plain numpy."""

import numpy as np
import pytest

from maintlake.llm import op7_quality

D = len(op7_quality.STATISTICS)


@pytest.fixture(scope="module")
def fitted(spark):
    rng = np.random.default_rng(11)
    stats = rng.normal(3, 2, (200, D))
    stats[:, 4] = 1.0  # a statistic that never changes
    label = (np.sin(stats[:, 0]) + stats[:, 1] / 4 + rng.normal(0, 0.3, 200) > 0.7).astype(int)
    fold = np.arange(200) % 4
    rows = [(s.tolist(), int(y), int(f)) for s, y, f in zip(stats, label, fold)]
    frame = spark.createDataFrame(rows, "stats array<double>, label int, fold int").repartition(3)
    options = {"n_waves": 40, "width": 3.0, "ridge": 1e-2, "grid": 64}
    return stats, label, fold, op7_quality.fit_quality(frame, frame, **options), options


def features(stats, model, waves):
    scale = np.where(stats.std(axis=0) > 0, stats.std(axis=0), 1)
    z = (stats - stats.mean(axis=0)) / scale
    assert np.abs(z).max() < 8
    rows = []
    for row in z:
        cosines = [np.sqrt(2 / waves) * np.cos(row @ model.directions[:, w] + model.phases[w]) for w in range(waves)]
        rows.append([*cosines, *row, 1.0])
    return np.array(rows)


def monotone(weight, value):
    """Isotonic regression as the largest, over starts, of the smallest mean up to any end."""
    n = len(value)
    mean = lambda i, j: np.average(value[i : j + 1], weights=weight[i : j + 1])
    return np.array([max(min(mean(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)])


def test_weights_are_the_ridge_solution(fitted):
    stats, label, fold, model, options = fitted
    x = features(stats, model, options["n_waves"])[fold != 0]
    y = label[fold != 0]
    # ridge as ordinary least squares with one more row a weight; the constant isn't held back
    held_back = np.sqrt(options["ridge"] * len(y)) * np.eye(x.shape[1])[:-1]
    weights = np.linalg.lstsq(np.vstack([x, held_back]), np.append(y, np.zeros(len(held_back))), rcond=None)[0]
    assert np.allclose(model.weights, weights, atol=1e-6)


def test_scores_are_the_isotonic_fit_on_the_fold_kept_back(fitted):
    stats, label, fold, model, options = fitted
    grid = options["grid"]
    raw = features(stats, model, options["n_waves"]) @ model.weights
    cell = np.clip(np.floor(raw * grid / 2), -grid, grid)
    back = fold == 0
    cells = np.unique(cell[back])
    n = np.array([(back & (cell == c)).sum() for c in cells])
    share = np.array([label[back & (cell == c)].mean() for c in cells])
    probability = monotone(n, share)
    assert np.allclose(model.probability, probability)
    assert np.allclose(model.score(stats), np.interp(raw, (cells + 0.5) * 2 / grid, probability))


def test_waves_approximate_the_gaussian_kernel(spark):
    rng = np.random.default_rng(2)
    stats = rng.normal(size=(30, D))
    frame = spark.createDataFrame([(s.tolist(), i % 2, i % 3) for i, s in enumerate(stats)], "stats array<double>, label int, fold int")
    model = op7_quality.fit_quality(frame, frame, n_waves=200, width=4.0)
    many = np.random.default_rng(7)
    z = (stats - stats.mean(axis=0)) / stats.std(axis=0)
    # the same draw with many more waves
    wide = op7_quality.QualityModel(
        model.mean, model.scale, many.normal(0, 1 / 4.0, (D, 50_000)), many.uniform(0, 2 * np.pi, 50_000),
        np.zeros(0), model.at, model.probability,
    )
    waves = wide.features(stats)[:, :50_000]
    kernel = np.exp(-((z[:, None] - z[None]) ** 2).sum(axis=2) / (2 * 4.0**2))
    assert np.abs(waves @ waves.T - kernel).max() < 0.03
