"""Language-model scores by deleted interpolation of n-gram frequencies.

A token's probability is a mixture of its maximum-likelihood estimates after contexts of every length and of a uniform
one. The weights belong to buckets of how often the context was seen, and are learned by expectation-maximisation on
tokens whose documents were left out of the counts.

Documents are cut into blocks. A block asks for the counts of its distinct n-grams, packed in order of their hashes and
cut into ranges of hashes; a range adds up what blocks brought and answers each in the same order, so a block's answers,
put one after another, are the counts of its sorted n-grams, and keys travel one way only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import held_out_sql, mixed, written

#: Tokens and bytes of text that fill a block, and requests that fill a range of hashes.
BLOCK_TOKENS, BLOCK_BYTES, RANGE = 1 << 20, 16 << 20, 1 << 20
#: Longest n-gram.
ORDER = 2
#: Training documents with remainder 0 are held out of the model, those with remainder 1 out of the counts that weights are learned with.
MODULUS, HELD_OUT, DEVELOPMENT = 10, 0, 1
#: At most so many steps of expectation-maximisation; fewer when a step adds less than this share to the likelihood's logarithm.
STEPS, GAIN = 20, 1e-4
#: Least weight of an estimate.
LEAST = 1e-9
#: Added to each count of the base score.
ADDED = 0.1
_END = b""
_ODD, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def tokens_of(text: bytes | None) -> list[bytes]:
    """Words with ASCII letters in lower case, and the end, which no word equals."""
    return [*(text or b"").lower().split(), _END]


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def packed(counts: np.ndarray) -> bytes:
    """Whole numbers from 0, in as many bytes each as the largest one needs; the first byte says how many."""
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(counts) or counts.max() < 1 << 8 * w)
    return bytes([width]) + counts.astype(f"<u{width}").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted keys as steps from one to the next, all first bytes before all second ones, so that empty high bytes compress."""
    return np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_keys(raw: bytes) -> np.ndarray:
    steps = np.frombuffer(raw, np.uint8).reshape(8, -1).T.copy().view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


class _Words(dict):
    def __missing__(self, word):
        self[word] = number = len(self)
        return number


@dataclass
class _Open:
    """A block that still takes documents."""

    words: _Words = field(default_factory=_Words)
    doc_ids: list = field(default_factory=list)
    held: list[bool] = field(default_factory=list)
    ids: list[np.ndarray] = field(default_factory=list)
    tokens: int = 0
    bytes: int = 0

    def add(self, doc_id: int | None, held: bool, text: bytes | None) -> None:
        tokens = tokens_of(text)
        self.doc_ids.append(doc_id)
        self.held.append(held)
        self.ids.append(np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens)))
        self.tokens += len(tokens)
        self.bytes += len(text or b"")


_BLOCK = pa.schema(
    [
        ("block", pa.int64()),
        ("development", pa.bool_()),
        ("tokens", pa.int64()),
        ("trained", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("held", pa.list_(pa.bool_())),
        ("lengths", pa.list_(pa.int32())),
        ("ids", pa.binary()),
        ("words", pa.list_(pa.binary())),
    ]
)
_BLOCK_SQL = (
    "block long, development boolean, tokens long, trained long, doc_ids array<long>, held array<boolean>, lengths array<int>, "
    "ids binary, words array<binary>"
)


def _closed(open_block: _Open, block: int, development: bool) -> pa.RecordBatch:
    """The block as a row; its words in order of hash, and its tokens as places in that order."""
    words = list(open_block.words)
    order = np.argsort(_hashes(words), kind="stable")
    place = np.empty(len(words), "<i4")
    place[order] = np.arange(len(words))
    ids = place[np.concatenate(open_block.ids)]
    lengths = [len(i) for i in open_block.ids]
    trained = sum(n for n, held in zip(lengths, open_block.held, strict=True) if not held)
    row = (block, development, len(ids), trained, open_block.doc_ids, open_block.held, lengths, ids.tobytes(), [words[i] for i in order.tolist()])
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCK, strict=True)], schema=_BLOCK)


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    opened = {False: _Open(), True: _Open()}
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            for doc_id, held, development, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                opened[development].add(doc_id, held, text)
                if opened[development].tokens >= size or opened[development].bytes >= BLOCK_BYTES:
                    yield _closed(opened[development], number, development)
                    opened[development] = _Open()
                    number += 1
    for development, left in opened.items():
        if left.doc_ids:
            yield _closed(left, number, development)
            number += 1


def blocks(docs: DataFrame, size: int = BLOCK_TOKENS) -> DataFrame:
    """``docs`` (doc_id, text) as blocks of some ``size`` tokens; those of development documents are apart."""
    rows = docs.selectExpr(
        "cast(doc_id as bigint) as doc_id",
        f"{held_out_sql('doc_id', MODULUS, HELD_OUT)} as held",
        f"{held_out_sql('doc_id', MODULUS, DEVELOPMENT)} as development",
        "cast(cast(text as string) as binary) as text",
    )
    return rows.mapInArrow(partial(_blocks, size=size), _BLOCK_SQL)


def ngram_keys(ids: np.ndarray, first: np.ndarray, hashes: np.ndarray, order: int) -> list[np.ndarray]:
    """For 2 to ``order``, a 64-bit hash of the n-gram that ends at each token; documents begin with a start of their own.

    Hashes of 64 bits stand for n-grams: of a billion different ones, some 0.03 pairs share one and its counts. Words are
    counted by themselves.
    """
    word = hashes[ids]
    key, out = word, []
    with np.errstate(over="ignore"):
        for _ in range(2, order + 1):
            context = np.concatenate(([_START], key[:-1]))
            context[first] = _START
            key = mixed(context * _ODD + word)
            out.append(key)
    return out


def _first(lengths: list[int]) -> np.ndarray:
    begins = np.zeros(sum(lengths), bool)
    begins[np.cumsum([0, *lengths[:-1]])] = True
    return begins


_REQUEST = pa.schema(
    [("order", pa.int32()), ("range", pa.int64()), ("block", pa.int64()), ("development", pa.bool_()), ("words", pa.list_(pa.binary())), ("keys", pa.binary()), ("counts", pa.binary())]
)
_REQUEST_SQL = "order int, range long, block long, development boolean, words array<binary>, keys binary, counts binary"


def _request_rows(batches: Iterator[pa.RecordBatch], order: int, bits: int) -> Iterator[pa.RecordBatch]:
    """What each block asks: its words, and hashes of its longer n-grams, with their occurrences in training documents."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            ids, hashes = np.frombuffer(row["ids"], "<i4"), _hashes(row["words"])
            trained = np.repeat(~np.array(row["held"], bool), row["lengths"])
            asked = [(hashes, np.bincount(ids, trained, len(hashes)))]
            for keys in ngram_keys(ids, _first(row["lengths"]), hashes, order):
                found, member = np.unique(keys, return_inverse=True)
                asked.append((found, np.bincount(member, trained, len(found))))
            for n, (keys, counts) in enumerate(asked, 1):
                ranges = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                cuts = np.concatenate(([0], np.flatnonzero(np.diff(ranges)) + 1, [len(keys)])).tolist()
                spans = list(zip(cuts, cuts[1:], strict=False))
                for start in range(0, len(spans), 1000):
                    some = spans[start : start + 1000]
                    columns = [
                        [n] * len(some),
                        [int(ranges[a]) for a, _ in some],
                        [row["block"]] * len(some),
                        [row["development"]] * len(some),
                        [row["words"][a:b] if n == 1 else [] for a, b in some],
                        [packed_keys(keys[a:b]) if n > 1 else b"" for a, b in some],
                        [packed(counts[a:b]) for a, b in some],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _REQUEST, strict=True)], schema=_REQUEST)


_ANSWER_SQL = "order int, range long, block long, every binary, kept binary, words long, kept_words long"


def _answers(table: pa.Table) -> pa.Table:
    """Adds up one range: a row for each block that asked, and a row for no block with the numbers of different words."""
    order, at = table.column("order")[0].as_py(), table.column("range")[0].as_py()
    given = [unpacked(c.as_py()) for c in table.column("counts")]
    if order == 1:
        words = table.column("words").combine_chunks().flatten().dictionary_encode()
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        member, size = words.indices.to_numpy(), len(words.dictionary)
    else:
        keys, member = np.unique(np.concatenate([unpacked_keys(c.as_py()) for c in table.column("keys")]), return_inverse=True)
        size = len(keys)
    sizes = [len(g) for g in given]
    counts = np.concatenate(given)
    development = np.repeat(table.column("development").to_numpy(), sizes)
    every, kept = (np.zeros(size, np.int64) for _ in range(2))
    np.add.at(every, member, counts)
    np.add.at(kept, member, np.where(development, 0, counts))
    asked = table.column("block").to_pylist()
    ends = np.cumsum([0, *sizes])
    rows = [(order, at, b, every[member[x:y]], kept[member[x:y]] if d else None) for b, d, x, y in zip(asked, table.column("development").to_pylist(), ends, ends[1:], strict=False)]
    rows = [(*row, None, None) for row in rows]
    if order == 1:
        rows.append((order, at, None, None, None, int((every > 0).sum()), int((kept > 0).sum())))
    columns = [list(c) for c in zip(*rows, strict=True)]
    columns[3:5] = [[None if v is None else packed(v) for v in c] for c in columns[3:5]]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[p.split()[0] for p in _ANSWER_SQL.split(", ")])


def answers(table: DataFrame, order: int, tokens: int, size: int = RANGE) -> DataFrame:
    """order, range, block, every, kept: counts in all training documents and, for development blocks, in those outside development.

    Ranges take some ``size`` requests each. Rows without a block hold the numbers of different words of their range.
    """
    bits = ceil(log2(max(1, order * tokens / size)))
    asked = table.select("block", "development", "held", "lengths", "ids", "words").mapInArrow(partial(_request_rows, order=order, bits=bits), _REQUEST_SQL)
    return asked.groupBy("order", "range").applyInArrow(_answers, _ANSWER_SQL)


def answered(table: DataFrame, found: DataFrame, counts: str) -> DataFrame:
    """Blocks with their answers from the column ``counts``, in order."""
    lists = found.where("block is not null").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("order", "range", F.col(counts).alias("counts")))).alias("answers"))
    return table.join(lists.selectExpr("block", "answers.order as orders", "answers.counts as counts"), "block")


@dataclass(frozen=True)
class Model:
    """Tokens and different words of the counts, and the weights (uniform, then each order) of each bucket."""

    tokens: int
    words: int
    weights: dict[int, tuple[float, ...]]


def _token_counts(row: dict, order: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each token, its n-gram's count for each order from 1, and its context's for each order from 2."""
    ids, hashes, first = np.frombuffer(row["ids"], "<i4"), _hashes(row["words"]), _first(row["lengths"])
    given: dict[int, list[bytes]] = {}
    for n, counts in zip(row["orders"], row["counts"], strict=True):
        given.setdefault(n, []).append(unpacked(counts))
    given = {n: np.concatenate(parts) for n, parts in given.items()}
    seen = [given[1][ids]]
    for n, keys in enumerate(ngram_keys(ids, first, hashes, order), 2):
        seen.append(given[n][np.unique(keys, return_inverse=True)[1]])
    # every document begins once, and ends once
    ends = seen[0][len(ids) - 1] if len(ids) else 0
    contexts = [np.where(first, ends, np.concatenate(([0], counts[:-1]))) for counts in seen[:-1]]
    return seen, contexts


def estimates(seen: list[np.ndarray], contexts: list[np.ndarray], tokens: int, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each token, and its estimates: uniform, then one for each order (0 after a context never seen).

    A bucket is the longest context that was seen, and the power of two that its count reaches.
    """
    out = [np.full(len(seen[0]), 1 / (words + 1)), seen[0] / max(tokens, 1)]
    bucket = np.zeros(len(seen[0]), np.int64)
    for n, (counts, context) in enumerate(zip(seen[1:], contexts, strict=True), 1):
        out.append(counts / np.maximum(context, 1))
        bucket = np.where(context > 0, 64 * n + np.frexp(context.astype(float))[1], bucket)
    return bucket, np.stack(out, axis=1)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


def _events(batches: Iterator[pa.RecordBatch], order: int, tokens: int, words: int) -> Iterator[pa.RecordBatch]:
    """Different (bucket, estimates) of a block's training tokens, and how many tokens have them."""
    for row in _rows(batches):
        bucket, shares = estimates(*_token_counts(row, order), tokens, words)
        trained = np.repeat(~np.array(row["held"], bool), row["lengths"])
        columns = [bucket[trained], *shares[trained].T]
        order_of = np.lexsort(columns)
        columns = [c[order_of] for c in columns]
        new = np.flatnonzero(np.any([np.append(True, c[1:] != c[:-1]) for c in columns], axis=0)) if len(order_of) else order_of
        columns = [*(c[new] for c in columns), np.diff(np.append(new, len(order_of)))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", *(f"p{k}" for k in range(order + 1)), "n"])


def learned(events: DataFrame, order: int) -> dict[int, tuple[float, ...]]:
    """Weights by expectation-maximisation over ``events`` (bucket, p0, p1, ..., n), from equal ones; a step is one aggregate over them."""
    spark, parts = events.sparkSession, range(order + 1)
    weights = {r.bucket: (1 / (order + 1),) * (order + 1) for r in events.select("bucket").distinct().collect()}  # 64 for each order at most
    before = None
    names = [f"w{k}" for k in parts]
    schema = ", ".join(["bucket long", *(f"{w} double" for w in names)])
    mixture = " + ".join(f"w{k} * p{k}" for k in parts)
    for _ in range(STEPS if weights else 0):
        known = spark.createDataFrame([(b, *w) for b, w in weights.items()], schema)
        mixed_events = events.join(F.broadcast(known), "bucket").selectExpr("*", f"{mixture} as mixture")
        sums = [F.sum(F.expr(f"n * w{k} * p{k} / mixture")).alias(f"s{k}") for k in parts]
        rows = mixed_events.groupBy("bucket").agg(*sums, F.sum("n").alias("n"), F.sum(F.expr("n * ln(mixture)")).alias("likelihood")).collect()
        weights = {r.bucket: tuple(r[f"s{k}"] / r.n for k in parts) for r in rows}
        now = sum(r.likelihood for r in rows)
        if before is not None and now - before < GAIN * abs(before):
            break
        before = now
    return weights


def _weight_table(weights: dict[int, tuple[float, ...]], order: int) -> np.ndarray:
    """Weights for every bucket; one without development tokens takes those of the nearest smaller bucket, or equal ones."""
    table = np.zeros((64 * (order + 1), order + 1))
    last = None
    for bucket in range(len(table)):
        last = weights.get(bucket, last)
        possible = bucket // 64 + 2  # uniform, single words, and orders whose context was seen
        row = np.array(last if last else (1 / (order + 1),) * (order + 1))
        row[:possible] = np.maximum(row[:possible], LEAST)
        row[possible:] = 0
        table[bucket] = row / row.sum()
    return table


_SCORE_SQL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(batches: Iterator[pa.RecordBatch], order: int, model: Model) -> Iterator[pa.RecordBatch]:
    weights = _weight_table(model.weights, order)
    for row in _rows(batches):
        seen, contexts = _token_counts(row, order)
        bucket, shares = estimates(seen, contexts, model.tokens, model.words)
        chance = (weights[bucket] * shares).sum(axis=1) if model.tokens else shares[:, 0]
        begins = np.cumsum([0, *row["lengths"][:-1]])
        base = np.log10((seen[0] + ADDED) / (model.tokens + ADDED * (model.words + 1)))
        lengths = np.array(row["lengths"], np.int64)
        known = np.add.reduceat((seen[0] > 0).astype(np.int64), begins)
        columns = [row["doc_ids"], row["held"], lengths, known, np.full(len(lengths), model.tokens), np.add.reduceat(base, begins), np.add.reduceat(np.log10(chance), begins)]
        kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[p.split()[0] for p in _SCORE_SQL.split(", ")])


def scored(docs: DataFrame, order: int = ORDER, block: int = BLOCK_TOKENS, span: int = RANGE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text).

    Counts come from the documents that are not held out, and the weights from one part of them against the counts of the
    others; a score is the sum of the tokens' log10 probabilities.

    A null or empty text is its end alone; a null id is not held out; repeated rows count and return as often as they
    stand there; other columns are ignored; without training documents the uniform estimate is all there is (score 0); no
    rows give no rows.
    """
    table = written(blocks(docs, block), "zstd")
    total = table.agg(F.sum("tokens"), F.sum("trained"), F.sum(F.expr("if(development, 0, trained)"))).first()
    tokens, trained, kept = (n or 0 for n in total)
    found = written(answers(table, order, tokens, span), "zstd")
    words, kept_words = (n or 0 for n in found.agg(F.sum("words"), F.sum("kept_words")).first())
    names = ", ".join(["bucket long", *(f"p{k} double" for k in range(order + 1)), "n long"])
    development = answered(table.where("development"), found.where("kept is not null"), "kept")
    events = development.mapInArrow(partial(_events, order=order, tokens=kept, words=kept_words), names)
    events = written(events.groupBy(*events.columns[:-1]).agg(F.sum("n").alias("n")))
    model = Model(trained, words, learned(events, order))
    return answered(table, found, "every").mapInArrow(partial(_scores, order=order, model=model), _SCORE_SQL)
