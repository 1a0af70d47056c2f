"""Training pools the chunks that scoring pools, and its gradient is that of a slow network."""

import numpy as np

from tempograph.llm import quality


def slow_score(net, raw):
    """Every chunk of two blocks by itself."""
    x = np.frombuffer(raw + bytes(quality.WIDTH - 1), np.uint8)
    z = np.array([sum(net.p["w"][k][x[i + k]] for k in range(quality.WIDTH)) for i in range(len(raw))]) + net.p["b"]
    count = max(1, -(-len(raw) // quality.BLOCK) - 1)
    m = np.maximum(np.array([z[c * quality.BLOCK : (c + 2) * quality.BLOCK].max(0) for c in range(count)]), 0)
    return m, 1 / (1 + np.exp(-(np.concatenate([m.mean(0), m.max(0)]) @ net.p["v"] + net.p["c"][0])))


def test_training_takes_every_chunk():
    rng = np.random.default_rng(1)
    net = quality.Network()
    net.p["b"] += 0.01
    for n in (1, 255, 256, 257, 512, 513, 3000):
        raw = bytes(rng.integers(1, 256, n, dtype=np.uint8))
        m, score = slow_score(net, raw)
        assert np.allclose(net.pooled(raw)[1], m, atol=1e-4) and np.isclose(net.score(raw), score, atol=1e-4)
    raw = bytes(rng.integers(1, 256, 300_000, dtype=np.uint8))
    mine = net.pooled(raw)[1]
    assert np.allclose(np.concatenate([mine.mean(0), mine.max(0)]), net.features(raw), atol=1e-4)


def test_gradient_by_differences():
    rng = np.random.default_rng(2)
    raws, y = [bytes(rng.integers(1, 256, n, dtype=np.uint8)) for n in (40, 700, 1500)], np.array([1, 0, 1], np.float32)
    net = quality.Network()
    net.p["b"] += 0.01
    loss = lambda: -np.mean([np.log(net.score(r) if t else 1 - net.score(r)) for r, t in zip(raws, y)])
    grad = net.step(raws, y)
    for name, place in (("c", (0,)), ("b", (3,)), ("w", (2, raws[0][5], 7)), ("w", (0, raws[1][9], 1))):
        old, d = net.p[name][place], 1e-2
        net.p[name][place] = old + d
        up = loss()
        net.p[name][place] = old - d
        assert np.isclose((up - loss()) / (2 * d), grad[name][place], atol=2e-3)
        net.p[name][place] = old


def test_epochs_go_on_until_the_loss_is_steady():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 160).astype(np.float32)
    raws = [bytes(rng.integers(97, 123, 300, dtype=np.uint8)) + (b" good" if t else b" poor") * 5 for t in y]
    net = quality.Network().fit(raws, y)
    n = len(net.losses)
    assert quality.LEAST_EPOCHS <= n <= quality.MOST_EPOCHS and net.losses[-1] < 0.1
    assert n == quality.MOST_EPOCHS or min(net.losses[: -quality.PATIENCE]) - min(net.losses[-quality.PATIENCE :]) < quality.STEADY
    assert np.mean([(net.score(r) >= 0.5) == t for r, t in zip(raws, y)]) > 0.95
