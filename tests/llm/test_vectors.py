"""The projection forest against brute force."""

import numpy as np
import pytest

from delayworks.llm.rp_forest import near_vectors


def clustered(rng, n, dimensions=32):
    centres = rng.normal(size=(60, dimensions))
    x = centres[rng.integers(0, 60, n)] + rng.normal(size=(n, dimensions)) * rng.choice([0.02, 0.15, 0.22, 2.0], (n, 1))
    x[: n // 10] = x[0]  # copies
    x[n // 10 : n // 5] = x[1] + rng.normal(size=(n // 5 - n // 10, dimensions)) * 0.01  # a dense group
    return x.astype(np.float32)


def brute(x, least):
    x = x.astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    labels = np.arange(len(x))
    from delayworks.llm.components import merge_labels

    merge_labels(labels, *np.nonzero(near))
    return near.sum(axis=1) - 1, labels


@pytest.mark.parametrize("settings", [{}, {"leaf": 60, "sample": 500, "tile": 50}])
def test_links_and_components(spark, settings):
    x = clustered(np.random.default_rng(4), 1500)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = near_vectors(frame, **settings).toPandas().sort_values("id")
    links, labels = brute(x, 0.95)
    assert got["n_links"].sum() >= 0.99 * links.sum()  # recall
    assert (got["n_links"].to_numpy() <= links).all()  # nothing below the threshold
    assert (got["component"].to_numpy() == labels).mean() >= 0.99


def test_vectors_that_cannot_link(spark):
    rows = [
        (1, [1.0, 0.0]),
        (2, [2.0, 0.0]),
        (3, [0.0, 0.0]),
        (4, None),
        (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]),
        (7, [None, 1.0]),
        (8, []),
        (9, [1.0, 0.0, 0.0]),
        (None, [1.0, 0.0]),
        (1, [1.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, near_vectors(frame).collect()), key=repr)
    alone = [(i, 0, i) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 0, None), *alone], key=repr)
    assert near_vectors(frame.limit(0)).collect() == []
