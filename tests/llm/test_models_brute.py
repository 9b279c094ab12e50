"""The trained models' formulas against plain Python loops."""
import math
import random

import numpy as np
import pytest

from barspark.llm import toxicity, weak


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_expectation_maximisation_by_loops(seed):
    r = random.Random(seed)
    patterns = sorted({tuple(r.choice([-1, 0, 0, 1]) for _ in range(6)) for _ in range(60)})
    count = [r.randint(1, 5000) for _ in patterns]
    accuracy = [0.9] * 6
    for _ in range(weak.ROUNDS):
        posterior = []
        for p in patterns:
            good = bad = 0.5
            for a, vote in zip(accuracy, p):
                good *= {1: a, -1: 1 - a, 0: 1.0}[vote]
                bad *= {1: 1 - a, -1: a, 0: 1.0}[vote]
            posterior.append(good / (good + bad))
        new = []
        for j in range(6):
            cast = right = 0.0
            for p, n, q in zip(patterns, count, posterior):
                cast += n * (p[j] != 0)
                right += n * {1: q, -1: 1 - q, 0: 0.0}[p[j]]
            strength = 0.1 * cast + 10
            new.append(min(0.99, max(0.05, (right + 0.9 * strength) / (cast + strength))))
        moved = max(abs(a - b) for a, b in zip(accuracy, new))
        accuracy = new
        if moved < 1e-9:
            break
    q, found = weak.expectation_maximisation(np.array(patterns), np.array(count, float))
    assert found == pytest.approx(accuracy, abs=1e-7) and q == pytest.approx(posterior, abs=1e-7)


def test_vote_patterns_are_reversible():
    r = random.Random(4)
    votes = np.array([[r.choice([-1, 0, 1]) for _ in weak.LABELLERS] for _ in range(500)])
    assert (weak.patterns_to_votes(weak.pattern(votes), len(weak.LABELLERS)) == votes).all()


def test_noisy_or_by_products():
    r = random.Random(5)
    sizes = [1, 0, 4, 30, 2]
    logits = [r.uniform(-8, 8) for _ in range(sum(sizes))]
    first = np.cumsum([0, *sizes])
    want = [1 - math.prod(1 - 1 / (1 + math.exp(-x)) for x in logits[a:b]) for a, b in zip(first, first[1:])]
    assert toxicity.noisy_or(np.array(logits), first) == pytest.approx(want, abs=1e-12)


def test_sentence_scores_sum_the_weights_of_their_words():
    r = random.Random(6)
    weights = np.array([r.uniform(-2, 2) for _ in range(64)], np.float32)
    pairs = sorted({(r.randrange(9), r.randrange(64)) for _ in range(80)})
    got = toxicity.sentence_scores(np.array([f for _, f in pairs]), np.array([s for s, _ in pairs]), 10, weights, -1.5)
    assert got == pytest.approx([-1.5 + sum(float(weights[f]) for s, f in pairs if s == k) for k in range(10)], abs=1e-5)


def test_training_raises_the_likelihood_of_its_bags():
    """The loss by products, before and after; the sentence that carries the word is found in its bag."""
    feature, sentence, bag, label = [], [], [], []
    r = random.Random(7)
    for b in range(80):
        label.append(b % 2)
        for k in range(3):
            words = {r.randrange(20) for _ in range(4)} | ({40} if b % 2 and k == 1 else set())
            feature += sorted(words)
            sentence += [len(bag)] * len(words)
            bag.append(b)
    args = [np.array(x) for x in (feature, sentence, bag, label)]
    weights, bias = toxicity.fit(*args, np.ones(80), bits=6)

    def loss(w, c):
        total = 0.0
        for b in range(80):
            clean = 1.0
            for s in (k for k, x in enumerate(bag) if x == b):
                z = c + sum(w[f] for f, t in zip(feature, sentence) if t == s)
                clean *= 1 - 1 / (1 + math.exp(-z))
            total -= math.log(max(1e-12, 1 - clean if label[b] else clean))
        return total

    assert loss(weights, bias) < 0.2 * loss(np.zeros(64), toxicity.BIAS)
    scores = toxicity.sentence_scores(args[0], args[1], len(bag), weights, bias)
    assert all(int(np.argmax(scores[3 * b:3 * b + 3])) == 1 for b in range(1, 80, 2))
