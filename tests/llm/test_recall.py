"""Links of op5 where lists far exceed probes and pairs just reach the threshold."""

from __future__ import annotations

import numpy as np

from gildmill.llm import pq_dedup


def test_recall_of_pairs_just_above_the_threshold(spark):
    rng = np.random.default_rng(8)
    n, dim, pairs = 10_000, 64, 600
    rows = rng.normal(size=(n, dim))
    rows /= np.linalg.norm(rows, axis=1)[:, None]
    # Partners at a cosine of 0.90 to 0.92 to the first rows.
    away = rng.normal(size=(pairs, dim))
    away -= (away * rows[:pairs]).sum(axis=1)[:, None] * rows[:pairs]
    away /= np.linalg.norm(away, axis=1)[:, None]
    cosine = rng.uniform(0.901, 0.92, pairs)[:, None]
    every = np.concatenate([rows, cosine * rows[:pairs] + np.sqrt(1 - cosine**2) * away])
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(every)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pq_dedup.near_vectors(table.repartition(8)).collect()}
    unit = every / np.linalg.norm(every, axis=1)[:, None]
    want = np.zeros(len(unit), int)
    for at in range(0, len(unit), 1000):
        want[at : at + 1000] = (unit[at : at + 1000] @ unit.T >= 0.9).sum(axis=1) - 1
    found = np.array([got[i] for i in range(len(unit))])
    assert want.sum() >= 2 * pairs and (found <= want).all()
    recall = found.sum() / want.sum()
    print("recall", recall)
    assert recall >= 0.98
