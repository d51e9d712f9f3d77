"""Deleted interpolation on small tables: counts, weights and scores by plain loops, blocks and ranges of any size, odd rows."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from tallyloom.llm import interpolation

RANDOM = random.Random(8)
SCHEMA = "doc_id long, text string, block long, words string, counts int, lang string"


def remainder(doc_id):
    return None if doc_id is None else crc32(str(doc_id).encode()) % 10


def tokens(text):
    return [w.decode() for w in interpolation.tokens_of((text or "").encode())]


def grams(words, order):
    """For each token: its n-grams from length 1 to ``order``, those of documents' beginnings with a start sign."""
    for i in range(len(words)):
        yield [tuple(words[max(0, i - n + 1) : i + 1]) if i - n + 1 >= 0 else ("<s>", *words[: i + 1]) for n in range(1, order + 1)]


def counted(docs, order):
    counts = [Counter() for _ in range(order)]
    for words in docs:
        for found in grams(words, order):
            for n in range(order):
                counts[n][found[n]] += 1
    return counts


def plain(rows, order):
    def shares(counts, found):
        total, words = sum(counts[0].values()), len(counts[0])
        out, bucket = [1 / (words + 1), counts[0][found[0]] / max(total, 1)], 0
        for n in range(1, order):
            # a start sign alone was seen once in each document, as often as an end
            context = found[n][:-1]
            seen = counts[0][("",)] if context == ("<s>",) else counts[len(context) - 1][context]
            out.append(counts[n][found[n]] / max(seen, 1))
            if seen:
                bucket = 64 * n + math.frexp(seen)[1]
        return bucket, out

    training = [tokens(t) for i, t in rows if remainder(i) != 0]
    every = counted(training, order)
    kept = counted([tokens(t) for i, t in rows if remainder(i) not in (0, 1)], order)
    events = [shares(kept, g) for i, t in rows if remainder(i) == 1 for g in grams(tokens(t), order)]
    weights = {b: (1 / (order + 1),) * (order + 1) for b, _ in events}
    before = None
    for _ in range(interpolation.STEPS):
        sums, size, likelihood = defaultdict(lambda: [0.0] * (order + 1)), Counter(), 0
        for b, p in events:
            mixture = sum(w * x for w, x in zip(weights[b], p))
            likelihood += math.log(mixture)
            size[b] += 1
            for k in range(order + 1):
                sums[b][k] += weights[b][k] * p[k] / mixture
        weights = {b: tuple(s / size[b] for s in v) for b, v in sums.items()}
        if before is not None and likelihood - before < interpolation.GAIN * abs(before):
            break
        before = likelihood
    table = interpolation._weight_table(weights, order)
    total, words, out = sum(every[0].values()), len(every[0]), []
    for i, t in rows:
        mine = tokens(t)
        base = sum(math.log10((every[0][(w,)] + 0.1) / (total + 0.1 * (words + 1))) for w in mine)
        score = 0.0
        for g in grams(mine, order):
            b, p = shares(every, g)
            score += math.log10(sum(w * x for w, x in zip(table[b], p)))
        out.append((i, remainder(i) == 0, len(mine), sum(every[0][(w,)] > 0 for w in mine), total, base, score))
    return out


def prose(n):
    out = ["a"]
    while len(out) < n:
        out.append(RANDOM.choice(("b", "c", "d") if out[-1] in "aef" else ("a", "e", "f", "Gé,")))
    return " ".join(out)


@pytest.mark.parametrize(("order", "block", "span"), [(2, 1 << 20, 1 << 20), (2, 40, 30), (3, 100, 50)])
def test_scores_equal_plain_loops(spark, monkeypatch, order, block, span):
    monkeypatch.setattr(interpolation, "STEPS", 4)
    rows = [(i, prose(RANDOM.randint(1, 30))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n\x0b\x0c\r"), (3, "A b"), (3, "A b"), (None, "A new word"), (204, prose(3000))] + [(205, "hot text")] * 40
    table = spark.createDataFrame([(*r, 1, "w", 1, "x") for r in rows], SCHEMA).repartition(4)
    got = sorted((tuple(r) for r in interpolation.scored(table, order, block, span).collect()), key=lambda r: (r[0] or -1, r[2], r[5]))
    want = sorted(plain(rows, order), key=lambda r: (r[0] or -1, r[2], r[5]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want, strict=True):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-6)
    held = [r for r in got if r[1] and r[2] > 5]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # contexts help


def test_packing_is_a_round_trip():
    random = np.random.default_rng(1)
    for size in (0, 1, 5, 1000):
        keys = np.unique(random.integers(0, 1 << 64, size, np.uint64))
        assert np.array_equal(interpolation.unpacked_keys(interpolation.packed_keys(keys)), keys)
        for most in (1, 300, 1 << 20, 1 << 40):
            counts = random.integers(0, most, size)
            assert np.array_equal(interpolation.unpacked(interpolation.packed(counts)), counts)


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert interpolation.scored(none).count() == 0
    held = next(i for i in range(100) if remainder(i) == 0)
    row = interpolation.scored(spark.createDataFrame([(held, "a b", 1, "", 1, "")], SCHEMA)).collect()
    assert [tuple(r) for r in row] == [(held, True, 3, 0, 0, 0.0, 0.0)]
