"""Fragments that the cache lacks are noted by the lookup itself, learnt once and forgotten as lacking."""

import numpy as np
import pyarrow as pa

from vitrine.llm import bpe


def test_lacking_fragments_are_noted_once(monkeypatch):
    b = bpe.Bpe(bpe.default_path())
    learnt = []
    real = b._learn
    monkeypatch.setattr(b, "_learn", lambda f: learnt.append(sorted(f)) or real(f))
    texts = pa.array(["one two one", "", "two three"])
    first = [x.tolist() for x in b.encode(texts)]
    assert len(learnt) == 1 and len(learnt[0]) == len(set(learnt[0])) and not b.cache.lacking
    assert [x.tolist() for x in b.encode(texts)] == first and len(learnt) == 1
    assert [b.decode(np.array(x, np.uint32)) for x in first] == ["one two one", "", "two three"]
