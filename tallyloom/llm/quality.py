"""Quality scores by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import add_columns, map_batches, perhaps_among, written

FEATURES = (
    "words", "chars_per_word", "lower", "upper", "digits", "punctuation", "symbols", "pipes", "exclamations",
    "non_ascii", "distinct_words", "repeated_neighbours", "distinct_lines", "longest_word", "capitalised", "full_stops",
)
#: Share of the class covariance that the pooled diagonal replaces, and the least variance of a standardised feature.
SHRINKAGE, FLOOR = 0.3, 0.1
#: Letters and words added to the sizes that shares are taken of, so that a few of them in a short text weigh less.
MORE_CHARS, MORE_WORDS = 60, 10

_CLASS = np.zeros((256, 9))
for _name, _bytes in enumerate((
    range(97, 123), range(65, 91), range(48, 58), b".,;:'\"()-?", b"#$%&*@^~+=<>{}[]\\/_", b"|", b"!", range(128, 256), b".",
)):
    _CLASS[list(_bytes), _name] = 1


def statistics(text: str | None) -> np.ndarray:
    """Transformed statistics of one whole text; those of the empty text are all zero."""
    out = np.zeros(len(FEATURES))
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return out
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _CLASS
    size = max(1, sum(map(len, words)))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, distinct = len(words), len(set(words))
    out[0] = np.log1p(n)
    out[1] = np.log(size / n)
    # square roots and logarithms spread small shares, which most documents have
    out[2] = (kinds[0] + MORE_CHARS) / (size + MORE_CHARS)
    out[3:10] = np.sqrt(np.minimum(1, kinds[1:8] / (size + MORE_CHARS)))
    out[10] = np.log(distinct / n) / np.log(n + 1)
    out[11] = np.sqrt(sum(map(bytes.__eq__, words, words[1:])) / (n + MORE_WORDS))
    out[12] = np.log(len(set(lines)) / len(lines))
    out[13] = np.log(max(map(len, words)))
    out[14] = np.sqrt(sum(map(bytes.istitle, words)) / (n + MORE_WORDS))
    out[15] = np.sqrt(kinds[8] / (n + MORE_WORDS))
    return out


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log offsets of the classes 0 and 1, over standardised statistics."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    inverse_factors: np.ndarray
    offsets: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Probability of class 1 from the difference of log densities."""
        x = (rows - self.centre) / self.scale
        logs = [
            self.offsets[c] - 0.5 * (((x - self.means[c]) @ self.inverse_factors[c].T) ** 2).sum(axis=1) for c in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


def _statistic_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    yield {"doc_id": batch.column(0), "row": [statistics(t) for t in batch.column(1).to_pylist()]}


def _moment_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    labels = batch.column(1).to_numpy(zero_copy_only=False)
    rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    for label in np.unique(labels):
        x = rows[labels == label]
        values = np.concatenate(([len(x)], x.sum(axis=0), (x.T @ x).ravel()))
        yield {"label": [label] * len(values), "position": range(len(values)), "value": values}


def fit(docs: DataFrame, labels: DataFrame) -> Discriminant:
    """Learns from all rows of ``docs`` (doc_id, text) with a row of ``labels`` (doc_id, label); a label is 0 or 1.

    Statistics, not texts, are shuffled to meet the labels. Tasks send sums of products, not rows, so any number of labels may be learned from. Where one class or both are
    missing, the classes are taken as alike and every score is the share of class 1 (one half without any label).
    """
    labels = labels.select("doc_id", F.col("label").cast("int")).where("doc_id is not null and label in (0, 1)")
    texts = perhaps_among(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "doc_id", labels.select("doc_id"))
    found = written(map_batches(texts, _statistic_batch, "doc_id long, row array<double>"))  # or a task would hold two Python workers
    rows = found.join(labels, "doc_id").select("row", "label")
    sums = map_batches(rows, _moment_batch, "label int, position int, value double")
    d = len(FEATURES)
    values = np.zeros((2, 1 + d + d * d))
    for r in sums.groupBy("label", "position").agg(F.sum("value").alias("value")).collect():  # 2 * (1 + d + d * d) numbers
        values[r.label, r.position] = r.value
    counts, total = values[:, 0], max(1.0, values[:, 0].sum())
    centre = values[:, 1 : d + 1].sum(axis=0) / total
    products = values[:, d + 1 :].reshape(2, d, d)
    spread = np.diag(products.sum(axis=0)) / total - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-6))
    means, covariances = np.zeros((2, d)), np.zeros((2, d, d))
    for c in (0, 1):
        n = max(1.0, counts[c])
        mean = values[c, 1 : d + 1] / n if counts[c] else centre
        covariances[c] = (products[c] / n - np.outer(mean, mean)) / np.outer(scale, scale) if counts[c] else np.eye(d)
        means[c] = (mean - centre) / scale
    if not counts.all():
        means[:], covariances[:] = 0, np.eye(d)
    pooled = np.diag((counts[:, None, None] * covariances).sum(axis=0)) / total
    factors, offsets = np.zeros((2, d, d)), np.zeros(2)
    for c in (0, 1):
        shrunk = (1 - SHRINKAGE) * covariances[c] + SHRINKAGE * np.diag(pooled) + FLOOR * np.eye(d)
        lower = np.linalg.cholesky(shrunk)
        factors[c] = np.linalg.inv(lower)
        offsets[c] = np.log((counts[c] + 1) / (total + 2)) - np.log(np.diag(lower)).sum()
    return Discriminant(centre, scale, means, factors, offsets)


def _score_batch(batch: pa.RecordBatch, model: Discriminant, text: int) -> Iterator[dict]:
    rows = np.array([statistics(t) for t in batch.column(text).to_pylist()]).reshape(-1, len(FEATURES))
    yield {"score": model.scores(rows)}


def scored(docs: DataFrame, model: Discriminant, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and score (0 to 1; higher: class 1 is likelier) for each row of ``docs`` (doc_id, text).

    A null text scores like an empty one; each repeated row and each null id returns a row; other columns are ignored.
    """
    return add_columns(docs, keep, "text", partial(_score_batch, model=model), "score double")
