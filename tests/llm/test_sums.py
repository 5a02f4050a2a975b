"""What the label model's tasks send."""

import numpy as np

from marketloom.llm import toxicity


def test_tasks_send_a_row_of_sums_each(spark, monkeypatch):
    rng = np.random.default_rng(3)
    votes = rng.random((200, 11)) < 0.3
    rows = [(np.packbits(v).tobytes(), int(rng.integers(-1, 2)), 1) for v in votes]
    rates = toxicity.Rates(0.3, np.full(11, 0.4), np.full(11, 0.2), np.ones(11), 0.9)
    patterns = [spark.createDataFrame(rows, "bits binary, gold int, n long").repartition(k) for k in (1, 14)]
    made, plain = [], type(patterns[0]).mapInArrow
    monkeypatch.setattr(type(patterns[0]), "mapInArrow", lambda self, *a, **k: made.append(plain(self, *a, **k)) or made[-1])
    one, many = (toxicity._next_rates(p, rates, True) for p in patterns)
    assert [made[k].count() for k in (0, 2)] == [1, 14]
    assert np.allclose(one.on, many.on) and np.allclose(one.off, many.off) and np.allclose(one.share, many.share) and abs(one.p - many.p) < 1e-12
