"""Rates of the pipeline's mixing stage, which takes a document at most once."""

import logging

import numpy as np
import pytest

import corpus_pipeline
from lumenmart.llm import mixing


def documents_of(toxic, poor, clean=600):
    """Words and posteriors (toxic, poor, clean) of so many documents; clean ones look a little poor."""
    rng = np.random.default_rng(5)
    mostly = [rng.dirichlet(a, n) for a, n in (([9, 0.2, 0.8], toxic), ([0.2, 9, 0.8], poor), ([0.1, 0.5, 9], clean))]
    return rng.integers(50, 500, toxic + poor + clean), np.round(np.concatenate(mostly), 3)


@pytest.mark.parametrize(("toxic", "poor"), [(5, 40), (60, 40)])
def test_clean_documents_stay(spark, caplog, toxic, poor):
    n, p = documents_of(toxic, poor)
    rows = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "tokens bigint, posteriors array<double>")
    targets = [corpus_pipeline.TARGETS.get(name, 0.0) for name in corpus_pipeline.DOMAINS]
    with caplog.at_level(logging.WARNING):
        fitted = rows.select("posteriors", mixing.fit_rates(rows, targets, most=1.0, whole=2).alias("rate"))
    rates = {tuple(r.posteriors): r.rate for r in fitted.collect()}
    rate = np.array([rates[tuple(x)] for x in p])
    assert 0 <= rate.min() and rate.max() <= 1
    taken, have = (n * rate) @ p, n @ p
    assert (n * rate)[toxic + poor :].sum() >= 0.98 * n[toxic + poor :].sum()
    goal = 0.02 * have[2] / 0.98
    assert taken[0] == pytest.approx(min(goal, have[0]), rel=0.03)
    assert caplog.records or have[0] >= 0.999 * goal
