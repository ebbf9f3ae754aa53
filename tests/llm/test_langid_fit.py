"""The language model's fit holds the normal equations and some tiles, and equals the direct solution."""

import tracemalloc

import numpy as np

from vitrine.llm import langid


def test_the_fit_makes_no_copies_of_all_vectors():
    rng = np.random.default_rng(3)
    x = rng.random((4000, langid.DIMS), np.float32).astype(np.float16)
    names = [f"l{i}" for i in rng.integers(0, 5, len(x))]
    tracemalloc.start()
    model = langid.fit(x, names)
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    assert model.weights.shape == (langid.DIMS + 1, 15)
    assert peak < 80  # (the normal equations alone: 34 MB; before: 198 MB)


def test_the_fit_equals_the_direct_solution():
    rng = np.random.default_rng(4)
    x = rng.random((700, 64), np.float32)
    names = [f"l{i}" for i in np.sort(rng.integers(0, 3, len(x)))]
    model = langid.fit(x, names)
    which = np.array([int(n[1]) for n in names])
    weight = (1 / np.bincount(which))[which]
    full = np.concatenate([x, np.ones((len(x), 1))], axis=1).astype(np.float64)
    a = (full * weight[:, None]).T @ full + langid.RIDGE * np.eye(65)
    want = np.linalg.solve(a, (full * weight[:, None]).T @ langid.codewords(3)[which])
    assert np.allclose(model.weights, want, rtol=1e-5, atol=1e-6)
    assert langid.fit(x[:0], []).weights.shape == (65, 0)
