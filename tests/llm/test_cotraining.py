"""Co-training, its features and its models against plain versions."""

import math

import numpy as np

from acctlens.llm.linear import Logistic, sigmoid
from acctlens.llm.quality import CONTENT, META, CoTrained, content_features, metadata_features


def test_the_regression_is_at_its_optimum():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 3)) * [1, 5, 0.1] + [0, 2, 9]
    y = (rng.random(400) < sigmoid(x @ [1.0, -0.3, 4.0] - 35)).astype(float)
    m = Logistic(ridge=2.0).fit(x, y)
    z = np.clip((x - x.mean(axis=0)) / x.std(axis=0), -8, 8)

    def loss(w):
        t = z @ w[:3] + w[3]
        return float(np.log1p(np.exp(t)).sum() - (y * t).sum() + (w[:3] ** 2).sum())  # half the ridge times w squared

    best = loss(m.w)
    for i in range(4):
        for step in (1e-2, -1e-2):
            w = m.w.copy()
            w[i] += step
            assert loss(w) > best
    assert np.allclose(m.predict(x), [1 / (1 + math.exp(-(float(r @ m.w[:3]) + m.w[3]))) for r in z])


def taught(a, b, y, pool_a, pool_b, back, rounds, sure, per_round):
    """The exchange of sure rows, one row at a time: (views' models, rows taught to each view)."""
    views, pools = (a, b), (pool_a, pool_b)
    rows = [[(list(v[i]), y[i]) for i in range(len(y)) if not back[i]] for v in views]
    share = sum(l for _, l in rows[0]) / len(rows[0])
    given = [{}, {}]

    def models():
        return [Logistic().fit(np.array([x for x, _ in r]), np.array([l for _, l in r])) for r in rows]

    for _ in range(rounds):
        now = models()
        for me in (0, 1):
            other = 1 - me
            for label, part in ((1, share), (0, 1 - share)):
                sure_of = []
                for i, x in enumerate(pools[me]):
                    p = float(now[me].predict(x[None])[0])
                    p = p if label else 1 - p
                    if p >= sure and i not in given[other]:
                        sure_of.append((-p, i))
                for _, i in sorted(sure_of)[: int(per_round * part)]:
                    given[other][i] = label
                    rows[other].append((list(pools[other][i]), label))
    return models(), given


def test_the_exchange_equals_a_plain_one():
    rng = np.random.default_rng(4)

    def sample(n):
        y = (rng.random(n) < 0.6).astype(float)
        return rng.standard_normal((n, 3)) + y[:, None] * [2.0, 0.5, 0], rng.standard_normal((n, 2)) + y[:, None] * [0, 2.5], y

    a, b, y = sample(60)
    pool_a, pool_b, truth = sample(300)
    back = np.arange(60) % 4 == 0
    model = CoTrained(rounds=3, sure=0.9, per_round=40).fit(a, b, y, pool_a, pool_b, back)
    (first, second), given = taught(a, b, y, pool_a, pool_b, back, 3, 0.9, 40)
    assert all(len(g) > 50 for g in given) and set(given[0]) != set(given[1])
    assert all(sum(truth[i] == l for i, l in g.items()) > 0.9 * len(g) for g in given)
    test_a, test_b, test_y = sample(500)
    assert np.allclose(model.a.logit(test_a), first.logit(test_a)) and np.allclose(model.b.logit(test_b), second.logit(test_b))
    both = Logistic(ridge=0.1).fit(np.stack([first.logit(a[back]), second.logit(b[back])], 1), y[back])
    want = both.predict(np.stack([first.logit(test_a), second.logit(test_b)], 1))
    assert np.allclose(model.predict(test_a, test_b), want)
    assert ((want >= 0.5) == test_y).mean() > 0.85
    alone = CoTrained(rounds=0).fit(a, b, y, pool_a, pool_b, back)
    assert not np.allclose(alone.a.w, model.a.w)


def test_features_by_plain_counting():
    text = "A a a B1! |\nfoo. foo. <x> 22 |\nA a a B1! |"
    words = text.split()
    n = len(words)
    run = best = 1
    for u, v in zip(words, words[1:]):
        run = run + 1 if u == v else 1
        best = max(best, run)
    assert content_features(text) == [
        math.log1p(n), len(text) / n, len(set(words)) / n, sum(u == v for u, v in zip(words, words[1:])) / n, math.log1p(best),
        sum(w.isupper() for w in words) / n, sum(w.isalpha() for w in words) / n, words.count("|") / n, text.count("!") / n,
        text.count(".") / n, sum(c in "#$%&*@^~<>{}[]\\=_+" for c in text) / n, sum(c in "0123456789" for c in text) / len(text),
        2 / 3, n / 300, sum(w[-1].isalnum() for w in words) / n]
    assert content_features("") == content_features(" \n") == [0.0] * CONTENT
    for row in ((None, None, None), ("web", "en", 5), ("", "", 0), ("web", None, -3)):
        f = metadata_features(*row)
        assert len(f) == META and sum(f[3:]) == 2 and f[0] == math.log1p(max(0, row[2] or 0)) and f[2] == (row[2] is None)
