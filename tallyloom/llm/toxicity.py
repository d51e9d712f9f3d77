"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches, perhaps_among
from tallyloom.llm.licenses import words_of

#: Buckets of hashed terms, and length of a term's vector.
BUCKETS, RANK = 1 << 16, 4
#: Expected number of labelled documents that are learned from, if there are more: a share of all, chosen by a hash.
SAMPLE = 20_000
#: Buckets that fewer documents of the sample have are left out.
LEAST_DOCS = 5
#: A term whose share of toxic documents lies z standard errors off counts z^2 / (z^2 + EVIDENCE^2) by itself.
EVIDENCE = 3
ROWS_AT_ONCE, STEP = 128, 0.05
#: Pull of weights and of vectors to zero.
DECAY, VECTOR_DECAY = 1e-4, 1e-3
#: At most so many passes, the first third of them over weights alone; the number used is the best one on a part of the rows.
EPOCHS = 24
#: A small sample is gone over more often, for so many steps at least.
LEAST_STEPS = 1500
#: One row in so many validates.
VALIDATION = 5


def terms(text: str | None) -> np.ndarray:
    """Sorted distinct buckets of the words of one whole text."""
    return np.unique(np.fromiter((zlib.crc32(w) & (BUCKETS - 1) for w in set(words_of(text))), np.int64))


@dataclass(frozen=True)
class Machine:
    """score = bias + sum of w + sum over pairs of terms of <v, v'> / n, n the terms of the document; terms that weren't learned have zeros.

    The pairs are those of a row of unit length, so that they do not outgrow the rest in long documents.
    """

    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, flat: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid, of documents whose terms stand one after another in ``flat``."""
        out = np.full(len(counts), self.bias)
        full = np.flatnonzero(counts)
        if len(full):
            v = self.vectors[flat]
            sums, squares = np.add.reduceat(v, starts[full]), np.add.reduceat(v * v, starts[full])
            out[full] += np.add.reduceat(self.weights[flat], starts[full]) + 0.5 * (sums**2 - squares).sum(axis=1) / counts[full]
        return out


def _layout(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    counts = np.array([len(r) for r in rows], np.int64)
    return np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64), np.cumsum(counts) - counts, counts


def _fitted(rows: list[np.ndarray], labels: np.ndarray, judged: np.ndarray, passes: int, pairs: bool, seed: int) -> tuple[Machine, int]:
    """Adam steps on the logistic loss of the rows that are not ``judged``; the machine after the pass that judges those best, and its number.

    Without rows to judge the last pass counts. Weights come first, vectors join after a third of the passes.
    """
    share = (labels.sum() + 1) / (len(labels) + 2)
    random = np.random.default_rng(seed)
    flat, _, counts = _layout(rows)
    seen = np.bincount(flat, minlength=BUCKETS)
    toxic = np.bincount(flat, np.repeat(labels, counts), BUCKETS)
    names = np.flatnonzero(seen >= LEAST_DOCS)
    strength = (toxic[names] - seen[names] * share) ** 2 / (seen[names] * share * (1 - share))
    strength = strength / (strength + EVIDENCE**2)
    place = np.full(BUCKETS, -1)
    place[names] = np.arange(len(names))
    rows = [p[p >= 0] for p in (place[r] for r in rows)]
    # columns: weight, vector; the last row is the bias
    theta = np.concatenate((np.zeros((len(names) + 1, 1)), random.normal(0, 0.05, (len(names) + 1, RANK))), axis=1)
    theta[-1] = 0
    theta[-1, 0] = np.log(share / (1 - share))
    pull = np.append(DECAY, np.full(RANK, VECTOR_DECAY))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    learning, best = np.flatnonzero(~judged), (np.inf, None, passes)
    for number in range(passes):
        both = pairs and number >= passes // 3
        vectors = theta[:-1, 1:] if both else np.zeros((len(names), RANK))
        order = random.permutation(learning)
        for start in range(0, len(order), ROWS_AT_ONCE):
            chosen = order[start : start + ROWS_AT_ONCE]
            flat, starts, counts = _layout([rows[i] for i in chosen])
            machine = Machine(theta[-1, 0], theta[:-1, 0] * strength, vectors)
            error = 1 / (1 + np.exp(-np.clip(machine.raw(flat, starts, counts), -30, 30))) - labels[chosen]
            owner = np.repeat(np.arange(len(chosen)), counts)
            each = error[owner] / len(chosen)
            gradient = np.zeros_like(theta)
            gradient[:-1, 0] = np.bincount(flat, each * strength[flat], len(names))
            if both and len(flat):
                sums = np.zeros((len(chosen), RANK))
                sums[counts > 0] = np.add.reduceat(vectors[flat], starts[counts > 0])
                slopes = (each / counts[owner])[:, None] * (sums[owner] - vectors[flat])
                for c in range(RANK):
                    gradient[:-1, 1 + c] = np.bincount(flat, slopes[:, c], len(names))
            gradient[:-1] += pull * theta[:-1]
            if not both:
                gradient[:, 1:] = 0
            gradient[-1, 0] = error.mean()
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.99 * second + 0.01 * gradient**2
            theta -= STEP * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        if judged.any():
            chosen = np.flatnonzero(judged)
            score = Machine(theta[-1, 0], theta[:-1, 0] * strength, vectors).raw(*_layout([rows[i] for i in chosen]))
            loss = float(np.mean(np.logaddexp(0, np.where(labels[chosen] > 0, -score, score))))
            if loss < best[0]:
                best = (loss, number + 1)
    weights, wide = np.zeros(BUCKETS), np.zeros((BUCKETS, RANK))
    weights[names] = theta[:-1, 0] * strength
    if pairs and passes - 1 >= passes // 3:
        wide[names] = theta[:-1, 1:]
    return Machine(float(theta[-1, 0]), weights, wide), best[1]


def train(rows: list[np.ndarray], labels: np.ndarray, seed: int = 7, pairs: bool = True) -> Machine:
    """Fits a machine to ``rows`` of buckets; without both labels every score is the same. ``pairs=False`` leaves the linear part only.

    The number of passes is the one that judged a fifth of the rows best when the others were learned from; then all are.
    """
    if not 0 < labels.sum() < len(labels):
        share = (labels.sum() + 1) / (len(labels) + 2)
        return Machine(float(np.log(share / (1 - share))), np.zeros(BUCKETS), np.zeros((BUCKETS, RANK)))
    judged = np.array([zlib.crc32(np.asarray(r, np.int32).tobytes()) % VALIDATION == 0 for r in rows])
    passes = max(EPOCHS, -(-LEAST_STEPS // max(1, -(-len(rows) // ROWS_AT_ONCE))))
    best = _fitted(rows, labels, judged, passes, pairs, seed)[1] if judged.any() and not judged.all() else passes
    return _fitted(rows, labels, np.zeros(len(rows), bool), max(best, 1), pairs, seed)[0]


def _term_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    yield {"doc_id": batch.column(0), "terms": [terms(t) for t in batch.column(1).to_pylist()]}


def fit(docs: DataFrame, labels: DataFrame) -> Machine:
    """Learns from the rows of ``docs`` (doc_id, text) with a row of ``labels`` (doc_id, label); a label is 0 or 1.

    Of more than ``SAMPLE`` labels, a share chosen by a hash of the id is used. Terms, not texts, are shuffled. Of repeated
    label rows of an id the majority counts (1 at a tie).
    """
    labels = labels.select("doc_id", F.col("label").cast("int")).where("doc_id is not null and label in (0, 1)")
    labels = labels.groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    share = min(1.0, SAMPLE / max(1, labels.count()))
    labels = labels.where(f"pmod(xxhash64(doc_id), 1048576) < {share * 1048576}")
    texts = perhaps_among(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", labels.select("doc_id"))
    chosen = map_batches(texts, _term_batch, "doc_id long, terms array<int>").join(labels, "doc_id")
    table = chosen.select("label", "terms").toArrow()  # bounded by SAMPLE
    order = np.argsort([zlib.crc32(np.asarray(t, np.int32).tobytes()) for t in table.column(1).to_pylist()], kind="stable")
    lists = [np.asarray(t, np.int64) for t in table.column(1).to_pylist()]
    return train([lists[i] for i in order], np.asarray(table.column(0).to_pylist(), float)[order])


def _score_batch(batch: pa.RecordBatch, model: Machine) -> Iterator[dict]:
    for start in range(0, batch.num_rows, 1000):
        texts = batch.column(1).slice(start, 1000).to_pylist()
        raw = model.raw(*_layout([terms(t) for t in texts]))
        yield {"doc_id": batch.column(0).slice(start, 1000), "score": 1 / (1 + np.exp(-np.clip(raw, -500, 500)))}


def scored(docs: DataFrame, model: Machine) -> DataFrame:
    """doc_id and score (0 to 1; higher: toxic is likelier) for each row of ``docs`` (doc_id, text).

    A null text scores like an empty one, by the bias alone; each repeated row and each null id returns a row; other
    columns are ignored.
    """
    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        partial(_score_batch, model=model),
        "doc_id long, score double",
    )
