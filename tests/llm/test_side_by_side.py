"""Operator 2: many texts are read side by side, each as exactly as alone."""

import numpy as np

from loam.llm import toxic_crf


def plain(model, potentials):
    """Forward-backward over one text, token by token, in the log domain."""
    n, out = len(potentials), []
    emit = np.stack((np.zeros(n), potentials), axis=1)
    forward, backward = [model.start + emit[0]], [np.zeros(2)]
    for i in range(1, n):
        forward.append(np.logaddexp.reduce(forward[-1][:, None] + model.move, axis=0) + emit[i])
    for i in range(n - 1, 0, -1):
        backward.insert(0, np.logaddexp.reduce(model.move + emit[i] + backward[0], axis=1))
    for a, b in zip(forward, backward, strict=True):
        out.append(1 / (1 + np.exp((a + b)[0] - (a + b)[1])))
    return np.array(out)


def test_pieces_give_the_marginals_of_the_whole_text():
    rng = np.random.default_rng(11)
    lengths = np.array([1, 64, 0, 65, 700, 3, 128, 63, 0, 2, 1025])
    for scale in (0.5, 3.0, 15.0):
        model = toxic_crf.Model({}, np.array([-6.0]), rng.normal(size=(2, 2)) * 2, rng.normal(size=2), np.zeros(4))
        potentials = rng.normal(size=int(lengths.sum())) * scale
        got, ends = toxic_crf.chains(model, potentials, lengths), np.cumsum(lengths)
        for end, n in zip(ends.tolist(), lengths.tolist(), strict=True):
            if n:
                assert np.allclose(got[end - n : end], plain(model, potentials[end - n : end]), rtol=1e-9, atol=1e-12)
    assert len(toxic_crf.chains(model, np.zeros(0), np.zeros(3, np.int64))) == 0


def test_texts_together_are_tagged_as_alone(monkeypatch):
    model = toxic_crf.Model({"p:vil": (9.0, 0.5, 0.0), "w:very": (0.0, 4.0, -0.5), "s:hole": (5.0, 0.0, 1.0), "shape:upper": (0.2, 0.0, 0.0)}, np.array([-6.0]), np.array([[0, -1.0], [0.3, 0.7]]), np.array([0, -1.0]), np.array([-2.0, 4.0, 1.0, 0.5]))
    rng = np.random.default_rng(12)
    words = ["very", "vilest", "hole", "Armhole", "good", "day", "NOW", "12", "\n", "é"]
    texts = [None, "", "7", *(" ".join(words[k] for k in rng.integers(0, len(words), n)) for n in (1, 2, 300, 40, 1000, 5)), "very", "vilest"]
    alone = [toxic_crf.tag(model, t) for t in texts]
    calls, real = [], toxic_crf.chains
    monkeypatch.setattr(toxic_crf, "chains", lambda *a: calls.append(1) or real(*a))
    for chars, most in ((2_000_000, 1), (100, len(texts))):
        monkeypatch.setattr(toxic_crf, "_CHARS", chars)
        calls.clear()
        together = list(toxic_crf.tags(model, texts))
        assert [t[1:] for t in together] == [t[1:] for t in alone]
        assert np.allclose([t[0] for t in together], [t[0] for t in alone], rtol=1e-12) and len(calls) <= most
    assert list(toxic_crf.tags(None, texts)) == [(0.0, [], [])] * len(texts)
