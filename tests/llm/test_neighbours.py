"""Rows are judged by themselves."""

import numpy as np
from llm_helpers import prose

from readloom.llm import quality


def test_margins_do_not_depend_on_neighbours():
    weights = np.random.default_rng(1).normal(size=1 << quality.BITS).astype(np.float32)
    texts = [b"", b"a", b"ab", "é".encode(), *(prose(n, n).encode() for n in (1, 3, 60, 400)), b"", b"a"]
    alone = [quality.margins(quality.Batch([t]), weights)[0] for t in texts]
    for batch in (texts, texts[::-1], [b"zz " * 90_000, *texts, b"q"]):
        got = dict(zip(batch, quality.margins(quality.Batch(batch), weights)))
        assert [got[t] for t in texts] == alone
    for t, (x, v) in zip(texts, quality.vectors(quality.Batch(texts))):
        assert abs(float((weights[x] * v).sum()) - alone[texts.index(t)]) < 1e-4
        (own,) = quality.vectors(quality.Batch([t]))
        assert own[0].tolist() == x.tolist() and own[1].tolist() == v.tolist()
