import itertools

import numpy as np

from repotide.llm.bilstm_crf import Tagger


def tiny(seed=1):
    rng = np.random.default_rng(seed)
    tagger = Tagger(5, 3, hidden=2, seed=seed)
    tagger.p = {k: (w + 0.3 * rng.normal(0, 1, w.shape)).astype(np.float64) for k, w in tagger.p.items()}
    return tagger, rng.integers(0, 5, (2, 4)), rng.integers(0, 3, (2, 4))


def path_score(tagger, e, path):
    a = tagger.p["A"]
    return tagger.p["s"][path[0]] + sum(e[t, k] for t, k in enumerate(path)) + sum(a[i, j] for i, j in itertools.pairwise(path))


def test_likelihood_and_best_path_equal_all_paths():
    tagger, x, y = tiny()
    e = tagger.emissions(x)
    losses, best = [], []
    for n in range(2):
        scores = {p: path_score(tagger, e[:, n], p) for p in itertools.product(range(3), repeat=4)}
        losses.append(np.log(np.exp(list(scores.values())).sum()) - scores[tuple(y[n])])
        best.append(max(scores, key=scores.get))
    assert abs(np.mean(losses) - tagger.loss_and_gradients(x, y)[0]) < 1e-5
    assert tagger.decode(x).tolist() == [list(b) for b in best]


def test_gradients_equal_differences():
    tagger, x, y = tiny()
    _, grads = tagger.loss_and_gradients(x, y)
    rng = np.random.default_rng(0)
    for name, w in tagger.p.items():
        for _ in range(4):
            at = tuple(rng.integers(0, s) for s in w.shape)
            old, found = w[at], []
            for step in (1e-3, -1e-3):
                w[at] = old + step
                found.append(tagger.loss_and_gradients(x, y)[0])
            w[at] = old
            assert abs((found[0] - found[1]) / 2e-3 - grads[name][at]) < 2e-3, name


def test_learns_a_rule():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 4, (200, 12))
    y = (np.roll(x, 1, 1) == 2).astype(int)
    y[:, 0] = 0
    tagger = Tagger(4, 2, hidden=6).fit(x, y, epochs=25, batch=32)
    assert (tagger.decode(x) == y).mean() > 0.98
