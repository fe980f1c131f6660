"""Topic mixtures and the likelihood bound against a plain E-step with the same topics."""

import math
import random

import numpy as np
import pytest

from innsight.operators import reviews as RV

THEMES = [["sea", "beach", "sand", "wave"], ["bus", "metro", "station", "taxi"], ["soup", "rice", "coffee", "bread"]]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    out = [(i, " ".join(rng.choices(THEMES[i % 3], k=20) + rng.choices(sum(THEMES, []), k=rng.randrange(4)))) for i in range(90)]
    return out + [(1000, ""), (1001, None), (1002, "nothing known here" * 0 + "zz")]


def digamma(x):
    """Recurrence up to 6, then the asymptotic series."""
    x = np.array(x, float)
    out = np.zeros_like(x)
    while (x < 6).any():
        small = x < 6
        out[small] -= 1 / x[small]
        x[small] += 1
    f = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - f * (1 / 12 - f * (1 / 120 - f * (1 / 252 - f / 240)))


lgamma = np.vectorize(math.lgamma)


def e_step(counts, weights, alpha):
    """Variational parameters of one text; weights: topics x terms."""
    e_beta = np.exp(digamma(weights) - digamma(weights.sum(1))[:, None])
    gamma = np.ones(len(alpha))
    for _ in range(2000):
        e_theta = np.exp(digamma(gamma) - digamma(gamma.sum()))
        phi = e_theta @ e_beta + 1e-100
        new = alpha + e_theta * (e_beta @ (counts / phi))
        if np.abs(new - gamma).mean() < 1e-9:
            break
        gamma = new
    return gamma


def test_mixtures_and_bound_are_those_of_a_plain_e_step(spark, texts):
    df = spark.createDataFrame(texts, "id long, clean_review string").repartition(3)
    fit = RV.fit_topics(df.where("id < 1000"), k=3, max_iter=8)
    weights = np.array(fit.model.topicsMatrix().toArray()).T
    alpha = np.array(fit.model.estimatedDocConcentration().toArray())
    eta = fit.model.getTopicConcentration() if fit.model.isSet("topicConcentration") else 1 / 3
    at = {w: i for i, w in enumerate(fit.vocabulary)}
    e_log_beta = digamma(weights) - digamma(weights.sum(1))[:, None]
    bound = ((eta - weights) * e_log_beta).sum() + (lgamma(weights) - math.lgamma(eta)).sum() + (
        math.lgamma(eta * weights.shape[1]) - lgamma(weights.sum(1))).sum()
    got = {r["id"]: r for r in fit.mixtures(df, "id").collect()}
    assert len(got) == len(texts)
    for i, text in texts:
        counts = np.zeros(len(at))
        for w in (text or "").split():
            if w in at:
                counts[at[w]] += 1
        assert got[i]["n_terms"] == counts.sum()
        if not counts.sum():
            assert got[i]["topic"] is None and set(got[i]["mixture"]) == {0.0}
            continue
        gamma = e_step(counts, weights, alpha)
        assert np.abs(np.array(got[i]["mixture"]) - gamma / gamma.sum()).max() < 0.01
        assert got[i]["topic"] == int(np.argmax(got[i]["mixture"]))
        e_log_theta = digamma(gamma) - digamma(gamma.sum())
        m = (e_log_theta[:, None] + e_log_beta).max(0)
        bound += (counts * (m + np.log(np.exp(e_log_theta[:, None] + e_log_beta - m).sum(0)))).sum()
        bound += ((alpha - gamma) * e_log_theta).sum() + (lgamma(gamma) - lgamma(alpha)).sum() + math.lgamma(alpha.sum()) - math.lgamma(gamma.sum())
    assert abs(fit.bound(df.where("id < 1000")) - bound) < 0.01 * abs(bound)


def test_texts_of_one_theme_share_a_topic(spark, texts):
    df = spark.createDataFrame(texts, "id long, clean_review string").where("id < 1000")
    got = {r["id"]: r["topic"] for r in RV.topic_mixtures(df, "id", k=3, max_iter=20).collect()}
    for theme in range(3):
        topics = [got[i] for i in range(theme, 90, 3)]
        assert max(topics.count(t) for t in set(topics)) >= 24
    empty = RV.topic_mixtures(df.where("false"), "id", k=3)
    assert empty.count() == 0 and empty.columns == ["id", "n_terms", "mixture", "topic"]
    none = RV.topic_mixtures(spark.createDataFrame([(1, "")], df.schema), "id", k=3).first()
    assert none["n_terms"] == 0 and none["topic"] is None
