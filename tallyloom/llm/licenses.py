"""Licence notices by an exact set-similarity join of text blocks with templates.

A block is a run of twice a template's words, and blocks start at every word, so whether a notice is found does not
depend on where it stands. A block matches if it holds at least a given share of the template's distinct tokens
(containment). Tokens are ordered by the number of documents that have them, rarest first: a text with a match must
hold one of the first few (prefix filter), have enough distinct words (length filter), and its tokens after the first
one found must suffice (positional filter).
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches

#: Share of a notice's distinct words that a block must hold.
CONTAINMENT = 0.9
#: Phrases whose words must stand together, with their labels (fixed values).
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
#: Notices, as their licences word them.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu lesser general public license", "lgpl"),
    ("subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("this work is licensed under a creative commons attribution license", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
)
#: Upper case to lower case, and other ASCII than letters and digits to a space; bytes above ASCII are parts of words.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


@dataclass(frozen=True)
class Template:
    words: tuple[bytes, ...]
    label: str
    share: float
    together: bool


def templates(phrases: Sequence[tuple[str, str]] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES) -> list[Template]:
    """Phrases need all words, next to each other; notices a share of them anywhere in a block."""
    made = [Template(tuple(p.encode().split()), label, 1.0, True) for p, label in phrases]
    return made + [Template(tuple(n.encode().split()), label, CONTAINMENT, False) for n, label in notices]


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def _count_batch(batch: pa.RecordBatch, vocabulary: frozenset) -> Iterator[dict]:
    counts: Counter = Counter()
    for text in batch.column(0).to_pylist():
        counts.update(vocabulary.intersection(words_of(text)))
    yield {"word": [w.decode() for w in counts], "n": list(counts.values())}


def frequencies(docs: DataFrame, items: Sequence[Template]) -> dict[bytes, int]:
    """In how many documents each word of the templates stands; as many numbers as the templates have words."""
    vocabulary = frozenset(w for t in items for w in t.words)
    counts = map_batches(docs.select(F.col("text").cast("string")), partial(_count_batch, vocabulary=vocabulary), "word string, n long")
    rows = counts.groupBy("word").agg(F.sum("n").alias("n")).collect()
    return dict.fromkeys(vocabulary, 0) | {r.word.encode(): r.n for r in rows}


@dataclass(frozen=True)
class Index:
    """Templates with their distinct words in order of frequency, and the prefix words that propose them."""

    items: tuple[Template, ...]
    ordered: tuple[tuple[bytes, ...], ...]
    needed: tuple[int, ...]
    prefixes: dict[bytes, tuple[tuple[int, int], ...]]


def index(items: Sequence[Template], counts: dict[bytes, int]) -> Index:
    ordered = tuple(tuple(sorted(set(t.words), key=lambda w: (counts[w], w))) for t in items)
    needed = tuple(ceil(t.share * len(o) - 1e-9) for t, o in zip(items, ordered, strict=True))
    prefixes: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
    for number, (tokens, need) in enumerate(zip(ordered, needed, strict=True)):
        for place, word in enumerate(tokens[: len(tokens) - need + 1]):
            prefixes[word].append((number, place))
    return Index(tuple(items), ordered, needed, {w: tuple(x) for w, x in prefixes.items()})


def _blocks(places: list[tuple[int, int]], size: int, need: int) -> Iterator[tuple[int, int]]:
    """First word and number of held words of the blocks of ``size`` words that hold ``need`` distinct words or more.

    ``places`` has, in order, position and number of each word of the template in the text. Blocks end at these words, or
    start with the text: a block of any other start holds no words that one of them lacks.
    """
    counts: Counter = Counter()
    low, best = 0, None
    for position, word in places:
        counts[word] += 1
        start = max(0, position - size + 1)
        while places[low][0] < start:
            gone = places[low][1]
            counts[gone] -= 1
            if not counts[gone]:
                del counts[gone]
            low += 1
        if best is not None and best[0] != start:
            yield best
            best = None
        if len(counts) >= need:
            best = (start, len(counts))
    if best is not None:
        yield best


def matches(words: list[bytes], found: Index) -> list[tuple[int, int, int, float]]:
    """Template number, first word, end and containment of blocks that meet their template's threshold.

    They have the labels and the greatest containment of the blocks of all starts.
    """
    held = set(words)
    # first place in the template's order of a word that the text holds
    proposed: dict[int, int] = {}
    for word in found.prefixes.keys() & held:
        for number, place in found.prefixes[word]:
            proposed[number] = min(place, proposed.get(number, place))
    possible = [(n, place) for n, place in sorted(proposed.items()) if len(held) >= found.needed[n]]
    # the words before that place are missing
    left = [n for n, place in possible if sum(w in held for w in found.ordered[n][place:]) >= found.needed[n]]
    if not left:
        return []
    wanted = {w for number in left for w in found.ordered[number]}
    where: dict[bytes, list[int]] = defaultdict(list)
    for position, word in enumerate(words):
        if word in wanted:
            where[word].append(position)
    out = []
    for number in left:
        tokens, size = found.ordered[number], 2 * len(found.items[number].words)
        places = sorted((position, k) for k, word in enumerate(tokens) for position in where.get(word, ()))
        for start, n in _blocks(places, size, found.needed[number]):
            out.append((number, start, min(len(words), start + size), n / len(tokens)))
    return out


def _scan_batch(batch: pa.RecordBatch, found: Index) -> Iterator[dict]:
    names = ("n_words", "labels", "starts", "ends", "containments", "place_labels", "places")
    rows: dict[str, list] = {n: [] for n in names}
    for text in batch.column(1).to_pylist():
        words = words_of(text)
        blocks, places = matches(words, found), set()
        for number, start, end, _ in blocks:
            item = found.items[number]
            if item.together:
                size = len(item.words)
                places |= {(p, item.label) for p in range(start, end - size + 1) if tuple(words[p : p + size]) == item.words}
        notices = [b for b in blocks if not found.items[b[0]].together]
        standing = sorted(places)
        values = (len(words), [found.items[b[0]].label for b in notices], [b[1] for b in notices], [b[2] for b in notices],
                  [b[3] for b in notices], [label for _, label in standing], [p for p, _ in standing])
        for name, value in zip(names, values, strict=True):
            rows[name].append(value)
    yield {"doc_id": batch.column(0)} | rows


def scanned(docs: DataFrame, items: Sequence[Template] | None = None) -> DataFrame:
    """What each row of ``docs`` (doc_id, text) holds of the templates.

    doc_id, n_words; for notices labels, starts, ends, containments (arrays, one entry for each matching block); for
    phrases place_labels and places (each place once, in order). Positions count words from 0. A null or empty text has
    no words and empty arrays; repeated rows and null ids return rows like others; other columns are ignored. The
    templates are a parameter of the caller, and their index goes to every task.
    """
    items = templates() if items is None else list(items)
    found = index(items, frequencies(docs, items))
    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        partial(_scan_batch, found=found),
        "doc_id long, n_words long, labels array<string>, starts array<long>, ends array<long>, containments array<double>, "
        "place_labels array<string>, places array<long>",
    )
