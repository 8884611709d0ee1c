"""The learners against plain versions, and what the counterfactual term does to neutral mentions."""

import math
import random

import numpy as np

from landfall.llm import quality, toxicity
from landfall.llm.linear import Ftrl


def plain_ftrl(rows, epochs, size, alpha, beta, l1, l2):
    """Follow-the-regularised-leader, a coordinate at a time; rows are (index, value, label)."""
    z, n = [0.0] * size, [0.0] * size

    def weight(i):
        least = 0.0 if i == 0 else l1
        if abs(z[i]) <= least:
            return 0.0
        return (math.copysign(least, z[i]) - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for at, value, label in rows:
            w = [weight(i) for i in at]
            p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, value, strict=True))))
            for i, x, wi in zip(at, value, w, strict=True):
                g = (p - label) * x
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * wi
                n[i] += g * g
    return [weight(i) for i in range(size)]


def test_ftrl_equals_the_plain_version():
    rng = random.Random(3)
    rows = []
    for _ in range(200):
        at = [0, *sorted(rng.sample(range(1, 40), 6))]
        rows.append((at, [1.0, *[rng.choice([0.25, 0.5, 1.0]) for _ in range(6)]], int(7 in at or rng.random() < 0.2)))
    model = Ftrl(40, alpha=0.5, beta=1.0, l1=0.1, l2=0.1)
    for _ in range(2):
        for at, value, label in rows:
            model.learn((np.array(at), np.array(value, np.float32)), label)
    at, w = model.model()
    dense = np.zeros(40)
    dense[at] = w
    assert np.allclose(dense, plain_ftrl(rows, 2, 40, 0.5, 1.0, 0.1, 0.1), atol=1e-9)


def test_quality_features_and_score_are_plain_sums():
    text = "Good good text, 12 apples; good"
    at, value = quality.ngrams(text)
    again = quality.ngrams(text)
    assert at[0] == 0 and value[0] == 1 and (np.diff(at) > 0).all() and np.array_equal(at, again[0])
    assert abs(float((value[1:] ** 2).sum()) - 1) < 1e-9


def test_one_name_of_one_sentence_is_changed():
    own, changed = toxicity.with_swaps("She met him. He and she left; her work was old.")
    words = lambda *w: set(toxicity._of_words(set(w)).tolist())
    base = ["she", "met", "him", "he", "and", "left", "her", "work", "was", "old"]
    assert set(own.tolist()) == words(*base)
    # she stays in the other sentence and he is there already: no change; he goes; her and old are swapped.
    wanted = [[w for w in base if w != "he"], [w for w in base if w != "her"] + ["his"], [w for w in base if w != "old"] + ["young"]]
    assert sorted(map(sorted, (c.tolist() for c in changed))) == sorted(sorted(words(*w)) for w in wanted)
    assert toxicity.with_swaps("nothing here") [1] == [] and toxicity.with_swaps("")[1] == []
    packed = toxicity._unpack(toxicity._pack((own, changed)))
    assert np.array_equal(packed[0], own) and all(np.array_equal(a, b) for a, b in zip(packed[1], changed, strict=True))


def test_even_moves_scores_towards_each_other():
    """One step goes down the slope of penalty * (p - q)**2, found by differences."""
    model = Ftrl(10, alpha=0.05, l1=0.0, l2=0.0)
    model.z[:] = [0, -2, 1, -1, 0, 0, 0, 0, 0, 0]
    own, swapped = np.array([0, 1, 3]), np.array([0, 2, 3])
    loss = lambda: (toxicity.sigmoid(float(model.weights(own).sum())) - toxicity.sigmoid(float(model.weights(swapped).sum()))) ** 2
    before, shared = loss(), model.weights(np.array([0, 3])).copy()
    for _ in range(5):
        toxicity._even(model, own, swapped, 1.0)
    assert loss() < before and np.array_equal(model.weights(np.array([0, 3])), shared)


def test_neutral_mentions_are_flagged_less():
    """Held-out neutral texts that name the groups which the toxic texts of the sample were about."""
    rng = random.Random(5)
    neutral = [f"n{k}" for k in range(300)]
    insults = [f"bad{k}" for k in range(25)]
    group = ["muslim", "gay", "women", "black", "she"]

    def toxic():
        words = [rng.choice(neutral) for _ in range(14)] + [rng.choice(insults), rng.choice(group)]
        rng.shuffle(words)
        return " ".join(words[:8]) + ". " + " ".join(words[8:]) + "."

    def mention(names):
        words = [rng.choice(neutral) for _ in range(14)] + rng.sample(names, 2)
        rng.shuffle(words)
        return " ".join(words[:8]) + ". " + " ".join(words[8:]) + "."

    others = ["christian", "straight", "men", "white", "he"]
    rows = [(toxic(), 1) for _ in range(300)] + [(mention(others), 0) for _ in range(200)] + [(mention(group), 0) for _ in range(12)] + [(" ".join(rng.choices(neutral, k=16)), 0) for _ in range(200)]
    held = [mention(group) for _ in range(300)]
    caught = [toxic() for _ in range(300)]
    rate = {}
    for penalty in (0.0, 1.0):
        model = toxicity.fit([(toxicity.with_swaps(t), y, i) for i, (t, y) in enumerate(rows)], penalty=penalty)
        weights = toxicity.dense(model, toxicity.SIZE)
        score = lambda t: toxicity.sigmoid(float(weights[toxicity.presence(t)[0]].sum()))  # noqa: B023, E731
        rate[penalty] = (sum(score(t) >= 0.5 for t in held) / 300, sum(score(t) >= 0.5 for t in caught) / 300)
    print("false positives, caught:", rate)
    assert rate[0.0][0] > 0.5 and rate[1.0][0] < 0.1 and rate[1.0][1] > 0.8
