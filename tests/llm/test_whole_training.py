"""The recurrent model learns from every row that is not held out."""

import zlib

from skyquilt.llm import lm


def test_every_learned_row_trains(docs, rows, monkeypatch):
    seen = []
    monkeypatch.setattr(lm, "_train", lambda own, packed, tokens: seen.extend(r["doc_id"] for r in own.collect()) or b"")
    lm.score(docs)
    learned = [r[0] for r in rows if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 10]
    assert sorted(seen, key=str) == sorted(learned, key=str)


def test_a_very_long_document_takes_the_memory_of_its_tokens():
    import tracemalloc

    import numpy as np

    from skyquilt.llm import gru

    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 40, 60_000).astype(np.uint16), *(rng.integers(0, 40, 20).astype(np.uint16) for _ in range(600))]
    model = gru.Model(np.arange(40, 0, -1), 1.0)
    tracemalloc.start()
    assert model.train(docs) == 60_000 + 600 * 20
    scores = model.log10(docs)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20
    assert abs(scores[0] - model.log10(docs[:1])[0]) < 1e-2 and len(scores) == 601


def test_sums_of_exponentials_hold_whatever_the_bound():
    import numpy as np

    from skyquilt.llm import gru

    x = np.random.default_rng(4).normal(0, 8, (50, 64)).astype(np.float32)
    exact = np.log(np.exp(x.astype(float)).sum(axis=1))
    for y, bound in ((x, float(np.abs(x).max())), (x, np.inf), (x + 500, np.inf), (x - 500, np.inf)):
        assert np.allclose(gru._log_sum(y.copy(), bound), exact + (y - x)[:, 0], rtol=1e-5)
        assert np.allclose(gru._soft(y.copy(), bound), np.exp(x - exact[:, None]), atol=1e-4)
