"""Only candidates that can rank are summed pair by pair."""
import numpy as np

from revbridge.llm import ann


def test_pairs_that_cannot_rank_are_not_summed(monkeypatch):
    data = np.random.default_rng(5).standard_normal((6000, 64))
    summed, plain = [], ann.inner
    monkeypatch.setattr(ann, "inner", lambda a, b: summed.append(len(a)) or plain(a, b))
    turn = ann.rotation(64)
    words, correction = ann.encode(ann.unit(data), turn)
    near = ann.Nearest(ann.QueryBlock(np.arange(40), data[:40], turn), 5)
    for i in range(0, len(data), ann.CODE_BATCH):
        part = slice(i, i + ann.CODE_BATCH)
        near.add(np.arange(len(data))[part], words[part], correction[part], data[part])
    assert sum(summed) < near.reranked / 3
    exact = ann.unit(data[:40]) @ ann.unit(data).T
    exact[np.arange(40), np.arange(40)] = -2
    found = np.mean([len(set(near.ids[i]) & set(np.argsort(-exact[i])[:5])) / 5 for i in range(40)])
    assert found >= 0.9 and np.all(np.diff(near.scores, axis=1) <= 0)
