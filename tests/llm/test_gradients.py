"""Gradients of the trained models against differences of a loss written out anew."""

import numpy as np

from kredo.llm import langid, ngrams, quality_pu


def recorder(monkeypatch, seen):
    class Recorder(ngrams.Adam):
        def step(self, values, gradient):
            seen.append((np.array(values, float), np.array(gradient, float)))
            return super().step(values, gradient)
    monkeypatch.setattr(ngrams, "Adam", Recorder)


def slope(loss, at, k, by=1e-5):
    up, down = at.copy(), at.copy()
    up[k] += by
    down[k] -= by
    return (loss(up) - loss(down)) / (2 * by)


def test_non_negative_risk_and_its_reversed_branch(monkeypatch):
    rng = np.random.default_rng(3)
    pos, unl, prior, decay = rng.normal(1.0, 1, (40, 6)), rng.normal(-0.6, 1, (60, 6)), 0.9, 0.05
    seen = []
    recorder(monkeypatch, seen)
    quality_pu.fit_risk(pos, unl, prior, steps=120, rate=0.1, decay=decay)
    scale = quality_pu.scales(unl)
    soft = lambda z: np.log(1 + np.exp(z)).mean()                       # noqa: E731
    kinds = set()
    for values, gradient in seen[::7]:
        z = lambda x, v: (x * scale) @ v[:-1] + v[-1]                   # noqa: E731
        negative = lambda v: soft(z(unl, v)) - prior * soft(z(pos, v))
        reversed_ = negative(values) < 0
        kinds.add(bool(reversed_))
        risk = (lambda v: -negative(v)) if reversed_ else (lambda v: prior * soft(-z(pos, v)) + negative(v))
        loss = lambda v: risk(v) + decay / 2 * (v[:-1] ** 2).sum()      # noqa: E731
        want = [slope(loss, values, k) for k in range(values.size)]
        np.testing.assert_allclose(gradient, want, atol=1e-6)
    assert kinds == {False, True}


def test_byte_network_gradient(monkeypatch):
    rng = np.random.default_rng(5)
    windows = rng.integers(1, langid.N_CLASSES, (7, langid.WINDOW)).astype(np.int32)
    windows[0, 20:] = 0
    target, seen = np.asarray([0, 1, 2, 0, 1, 2, 1]), []
    recorder(monkeypatch, seen)
    net = langid.train(windows, target, ["a", "b", "c"], epochs=1, batch=7)
    shapes = [net.embed.shape, *[net.filters[w].shape for w in langid.WIDTHS], net.offset.shape, net.out.shape, net.bias.shape]
    assert len(seen) == len(shapes)
    params = [v.reshape(s) for (v, _), s in zip(seen, shapes)]

    def loss():
        embed, *filters, offset, out, bias = params
        total = 0.0
        for window, t in zip(windows, target):
            x = np.concatenate((embed[window], np.zeros((max(langid.WIDTHS), langid.EMBED))))
            pooled = np.concatenate([np.max([sum(x[i + o] @ f[o] for o in range(len(f))) for i in range(langid.WINDOW)], axis=0)
                                     for f in filters])
            z = np.maximum(pooled + offset, 0) @ out + bias
            total += np.log(np.exp(z).sum()) - z[t]
        return total / len(windows)

    for p, (_, gradient) in zip(params, seen):
        places = np.flatnonzero(np.arange(p.size) >= (langid.EMBED if p.shape == net.embed.shape else 0))   # class 0 is fixed
        strong = places[np.argsort(-np.abs(gradient[places]))[:3]]
        for k in {*strong.tolist(), *rng.choice(places, 2).tolist()}:
            flat, keep = p.reshape(-1), p.reshape(-1)[k]
            flat[k] = keep + 1e-6
            up = loss()
            flat[k] = keep - 1e-6
            down = loss()
            flat[k] = keep
            assert abs((up - down) / 2e-6 - gradient[k]) < 1e-5
