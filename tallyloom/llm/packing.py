"""Packing of tokenized documents into sequences of bounded length, by best-two-fit.

A bin is filled greedily, always with the longest piece that still fits. Its smallest piece then leaves if two
unpacked pieces fit the widened gap more tightly than it did; the best such pair takes its place.
"""

from __future__ import annotations

import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import give_back, parts, written

#: Pieces packed by one task; every task leaves one sequence at most that lack of pieces keeps open.
PIECES_PER_TASK = 65_536
#: Words whose ids a worker remembers, at some 200 bytes each; other words are encoded again in each batch.
REMEMBERED_WORDS = 1_000_000
#: Words encoded as one text, with a mark between each two, and such texts encoded at once; encoding takes far more memory than ids.
WORDS_IN_TEXT, TEXTS_AT_ONCE = 64, 64
_MARK = "\x01"


class Encoder:
    """A tokenizer with the ids of words that it met.

    The tokenizer must drop white space and never join what it separates, so equal words have equal ids wherever they stand
    and need encoding once. Only ASCII white space separates words here; a word may hold other kinds.
    """

    def __init__(self, path: str, remembered: int = REMEMBERED_WORDS) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks use the cores already; threads would keep memory each
        from tokenizers import Tokenizer

        self.tokenizer, self.remembered = Tokenizer.from_file(path), remembered
        self.known: dict[str, bytes] = {}
        mark = self._ids([_MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, words: list[str]) -> Iterator[bytes]:
        """Ids of each word. Words without the mark are encoded as texts of many, whose ids are cut where the mark's id is."""
        plain = [w for w in words if _MARK not in w] if self.mark is not None else []
        found: dict[str, bytes] = {}
        groups = [plain[i : i + WORDS_IN_TEXT] for i in range(0, len(plain), WORDS_IN_TEXT)]
        for start in range(0, len(groups), TEXTS_AT_ONCE):
            some = groups[start : start + TEXTS_AT_ONCE]
            for group, ids in zip(some, self._ids([f" {_MARK} ".join(g) for g in some]), strict=True):
                marks = np.flatnonzero(ids == self.mark)
                if len(marks) == len(group) - 1:  # else a word has the mark's id too
                    cuts, whole = [-4, *(4 * marks).tolist(), ids.nbytes], ids.tobytes()
                    found.update((w, whole[a + 4 : b]) for w, (a, b) in zip(group, pairwise(cuts), strict=True))
        for word in words:
            yield found[word] if word in found else self._ids([word])[0].tobytes()

    def token_bytes(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers (null: no ids)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        new = [w for w in words if w not in self.known]
        fresh = dict(zip(new, self._encoded(new), strict=True))
        each = [fresh[w] if w in fresh else self.known[w] for w in words]
        self.known.update(islice(fresh.items(), max(self.remembered - len(self.known), 0)))
        codes, at = coded.indices.to_numpy(), 0
        for n in pc.list_value_length(split).to_pylist():
            yield b"".join(map(each.__getitem__, codes[at : at + n].tolist()))
            at += n


@lru_cache(maxsize=1)
def _kept_encoder(path: str, remembered: int) -> Encoder:
    return Encoder(path, remembered)


_PIECES = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _piece_batches(
    batches: Iterator[pa.RecordBatch], path: str, end_id: int, length: int, remembered: int, keep: bool
) -> Iterator[pa.RecordBatch]:
    encoder = (_kept_encoder if keep else Encoder)(path, remembered)
    end = np.array([end_id], "<u4").tobytes()
    for batch in parts(batches):
        rows: list[list] = [[] for _ in _PIECES]
        for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.token_bytes(batch.column(1)), strict=True):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * length)):
                cut = ids[at : at + 4 * length]
                for column, value in zip(rows, (doc_id, piece, at // 4, len(cut) // 4, zlib.crc32(cut)), strict=True):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(rows, _PIECES, strict=True)], schema=pa.schema(_PIECES))
    del encoder
    give_back()


def pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 4096, remembered: int = REMEMBERED_WORDS, keep: bool = True
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: every document's ids with ``end_id`` after them, cut only if longer.

    ``keep``: a worker keeps the tokenizer and the words for its next task, in which most words come again; otherwise both
    leave it with the task.
    """
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    step = partial(_piece_batches, path=tokenizer_path, end_id=end_id, length=length, remembered=remembered, keep=keep)
    return texts.mapInArrow(step, _PIECES_SQL)


def _best_pair(counts: np.ndarray, room: int) -> tuple[int, int, int]:
    """Sum and lengths of the two unpacked pieces that fill ``room`` best; zeros if no two fit."""
    lengths = np.flatnonzero(counts[: room + 1])
    if not len(lengths):
        return 0, 0, 0
    partner = np.searchsorted(lengths, room - lengths, side="right") - 1
    alone = (partner == np.arange(len(lengths))) & (counts[lengths] < 2)
    partner = np.where(alone, partner - 1, partner)
    total = np.where(partner >= 0, lengths + lengths[np.maximum(partner, 0)], 0)
    best = int(np.argmax(total))
    return int(total[best]), int(lengths[best]), int(lengths[max(partner[best], 0)])


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of positions in ``lengths`` (1 to ``capacity`` each); equal lengths leave in order of position."""
    waiting: dict[int, list[int]] = defaultdict(list)
    for position in range(len(lengths) - 1, -1, -1):
        waiting[int(lengths[position])].append(position)
    counts = np.zeros(capacity + 1, np.int64)
    for size, positions in waiting.items():
        counts[size] = len(positions)
    bins, left, top = [], len(lengths), capacity

    def take(size: int) -> int:
        counts[size] -= 1
        return waiting[size].pop()

    while left:
        chosen: list[tuple[int, int]] = []
        room = capacity
        while room and left:
            top = min(room, top) if chosen else capacity
            fitting = np.flatnonzero(counts[: top + 1])
            if not len(fitting):
                break
            size = int(fitting[-1])
            chosen.append((size, take(size)))
            left -= 1
            room -= size
            top = size
        if room and left and len(chosen) > 1:
            size, position = chosen[-1]  # the smallest, as pieces came in falling order
            total, one, two = _best_pair(counts, room + size)
            if total > size:
                chosen[-1:] = [(one, take(one)), (two, take(two))]
                counts[size] += 1
                waiting[size].append(position)
                left -= 1
        bins.append([position for _, position in chosen])
    return bins


def _packed(batches: Iterator[pa.RecordBatch], capacity: int) -> Iterator[pa.RecordBatch]:
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held).sort_by([(c, "ascending") for c in ("length", "ids_crc32", "doc_id", "piece")])
    base = TaskContext.get().partitionId() << 32
    sizes = rows.column("length").to_numpy()
    sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for number, members in enumerate(best_two_fit(sizes, capacity)):
        sequence[members] = base + number
        offset[members] = np.concatenate(([0], np.cumsum(sizes[members])[:-1]))
    rows = rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
    yield from rows.to_batches(max_chunksize=10_000)


def packed(table: DataFrame, capacity: int = 4096) -> DataFrame:
    """The rows of ``table`` (doc_id, piece, start, length, ids_crc32) with sequence_id and offset.

    Pieces are dealt evenly, whatever their documents, to tasks of some ``PIECES_PER_TASK`` rows, and each task packs
    its own; so memory is bounded and no key is crowded. Offsets have no gaps from 0.
    """
    tasks = max(1, -(-table.count() // PIECES_PER_TASK))
    return table.repartition(tasks).mapInArrow(partial(_packed, capacity=capacity), f"{_PIECES_SQL}, sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 4096, remembered: int = REMEMBERED_WORDS, keep: bool = True
) -> DataFrame:
    """Pieces of ``docs`` (doc_id, text) and their places in sequences of at most ``length`` tokens.

    A null or empty text is one piece that holds ``end_id`` alone; repeated rows and null ids are packed like others;
    other columns are ignored; no rows give no rows.
    """
    return packed(written(pieces(docs, tokenizer_path, end_id, length, remembered, keep)), length)
