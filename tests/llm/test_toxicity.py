"""The factorization machine against plain sums, on pairs that weights cannot tell, and on odd labels."""

from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest

from tallyloom.llm import toxicity

RANDOM = random.Random(3)
WORDS = ["".join(RANDOM.choices("abcdefgh", k=5)) for _ in range(60)]


def test_scores_equal_a_sum_over_pairs():
    rng = np.random.default_rng(2)
    machine = toxicity.Machine(0.3, rng.normal(size=toxicity.BUCKETS), rng.normal(size=(toxicity.BUCKETS, toxicity.RANK)))
    rows = [toxicity.terms(" ".join(RANDOM.choices(WORDS, k=k))) for k in (0, 1, 2, 9, 40)]
    got = machine.raw(*toxicity._layout(rows))
    for row, score in zip(rows, got, strict=True):
        pairs = sum(machine.vectors[a] @ machine.vectors[b] for a, b in combinations(row.tolist(), 2))
        want = 0.3 + sum(machine.weights[a] for a in row.tolist()) + (pairs / len(row) if len(row) else 0)
        assert score == pytest.approx(want)


def test_pairs_are_learned_where_weights_say_nothing():
    rows, labels = [], []
    for _ in range(1200):
        a, b = RANDOM.random() < 0.5, RANDOM.random() < 0.5
        rows.append(toxicity.terms(" ".join(RANDOM.choices(WORDS, k=6) + ["grub"] * a + ["folk"] * b)))
        labels.append(float(a != b))
    labels = np.array(labels)

    def right(pairs):
        machine = toxicity.train(rows[:900], labels[:900], pairs=pairs)
        return np.mean((machine.raw(*toxicity._layout(rows[900:])) > 0) == (labels[900:] > 0))

    assert right(True) > 0.95 and right(False) < 0.7


def test_a_few_insults_are_found_and_clean_documents_left():
    insults = [f"insult{i}" for i in range(10)]
    rows, labels = [], []
    for i in range(1500):
        words = RANDOM.choices(WORDS, k=RANDOM.randint(5, 60))
        if i % 9 == 0:
            words += RANDOM.choices(insults, k=RANDOM.randint(1, 3))
        rows.append(toxicity.terms(" ".join(words)))
        labels.append(float(i % 9 == 0))
    labels = np.array(labels)
    machine = toxicity.train(rows[:1100], labels[:1100])
    found = 1 / (1 + np.exp(-machine.raw(*toxicity._layout(rows[1100:])))) >= 0.3
    assert found[labels[1100:] > 0].mean() > 0.95 and found[labels[1100:] == 0].sum() <= 3


def test_repeated_and_null_labels(spark):
    docs = spark.createDataFrame([(i, f"{'grub' if i % 2 else 'fine'} {RANDOM.choice(WORDS)}", 0.5, 1) for i in range(300)], "doc_id long, text string, score double, terms int")
    rows = [(i, i % 2) for i in range(300)] * 3 + [(0, 1), (None, 1), (5, None), (9999, 1), (7, 5)]
    labels = spark.createDataFrame(rows, "doc_id long, label int")
    score = {r.doc_id: r.score for r in toxicity.scored(docs, toxicity.fit(docs, labels)).collect()}
    assert min(s for i, s in score.items() if i % 2) > 0.8 > 0.2 > max(s for i, s in score.items() if not i % 2)
    once = toxicity.fit(docs, spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id long, label int"))
    assert {r.doc_id: r.score for r in toxicity.scored(docs, once).collect()} == pytest.approx(score)
