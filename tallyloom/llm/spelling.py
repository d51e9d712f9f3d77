"""Spelling variants of a corpus' words: pairs one edit apart, found by composing finite-state machines.

The vocabulary is a minimised acceptor; composed with the transducer that makes one edit, and with the acceptor again, it
accepts the pairs of words that differ by one code point. The composition is cut by its initial states. An edit lies in
a window of places, so both words share what stands before the window and what follows it, and reach the same state by
it; only words that share both are composed. Windows are halves of a word at first; where too many words share the same
ends, the window is halved again, down to one place, where no more words can meet than there are pairs of letters.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat
from math import ceil, log2, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written

#: Code points of the shortest words, and times that a word occurs at least.
SHORTEST, LEAST = 7, 2
#: One run in so many loses a code point.
DAMAGED = 31
#: A form is so many times as frequent as its word.
RATIO = 10
#: Words of a group that are composed without a narrower window.
GROUP = 5_000
#: Different words counted by a task before it passes them on.
COUNTED = 300_000

#: Latin-1 letters (ASCII ones in lower case, all others from C0 on as they are); every other code point parts runs.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters as Latin-1 bytes, one for each code point."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split() if text else []


def words_of(doc_id: str, text: str | None) -> list[bytes]:
    """The runs of a document, a code point less where the checksum of id and run says so."""
    runs = runs_of(text)
    start = crc32(f"{doc_id}:".encode())
    plain = [r if r.isascii() else r.decode("latin-1").encode() for r in runs]
    sums = np.fromiter(map(crc32, plain, repeat(start)), np.int64, len(runs))
    for i in np.flatnonzero(sums % DAMAGED == 0).tolist():
        at = int(sums[i]) % len(runs[i])
        runs[i] = runs[i][:at] + runs[i][at + 1 :]
    return [r for r in runs if len(r) >= SHORTEST]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def batch_of():
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            for doc_id, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                counts.update(words_of(doc_id, text))
                if len(counts) >= COUNTED:
                    yield batch_of()
                    counts.clear()
    yield batch_of()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n, its occurrences in all texts of ``docs`` (doc_id, text); a null id reads as ''."""
    texts = docs.selectExpr("coalesce(cast(doc_id as string), '') as doc_id", "cast(text as string) as text")
    counts = texts.mapInArrow(_counts, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(f"n >= {LEAST}")


class Acceptor:
    """The smallest deterministic machine that accepts the given words; states are numbers, ``root`` the initial one."""

    def __init__(self, words: list[str]) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        known: dict[tuple, int] = {}
        # states along the last word that may still get arcs
        path: list[dict[str, int]] = [{}]
        ends = [False]
        last = ""

        def close() -> int:
            arcs, final = path.pop(), ends.pop()
            key = (final, *arcs.items())
            if key not in known:
                known[key] = len(self.arcs)
                self.arcs.append(arcs)
                self.final.append(final)
            return known[key]

        for word in sorted(words):
            same = next((i for i, (a, b) in enumerate(zip(last, word)) if a != b), min(len(last), len(word)))
            for i in range(len(last), same, -1):
                state = close()
                path[-1][last[i - 1]] = state
            for _ in range(same, len(word)):
                path.append({})
                ends.append(False)
            ends[-1] = True
            last = word
        for i in range(len(last), 0, -1):
            state = close()
            path[-1][last[i - 1]] = state
        self.root = close()


def _common(left: Acceptor, p: int, right: Acceptor, q: int, but: str = "") -> Iterator[str]:
    """What both machines accept from states ``p`` and ``q`` on, without what begins with ``but``."""
    waiting = [(p, q, "")]
    while waiting:
        p, q, read = waiting.pop()
        if left.final[p] and right.final[q]:
            yield read
        out = right.arcs[q]
        for symbol, state in left.arcs[p].items():
            if symbol in out and (read or symbol != but):
                waiting.append((state, out[symbol], read + symbol))


def substituted(words: Acceptor) -> Iterator[tuple[str, str]]:
    """Pairs that the acceptor, one substitution and the acceptor accept together, the smaller word first."""
    waiting = [(words.root, "")]
    while waiting:
        state, read = waiting.pop()
        arcs = sorted(words.arcs[state].items())
        for i, (symbol, one) in enumerate(arcs):
            waiting.append((one, read + symbol))
            for other, two in arcs[i + 1 :]:
                for rest in _common(words, one, words, two):
                    yield read + symbol + rest, read + other + rest


def inserted(words: Acceptor, longer: Acceptor, places: int) -> Iterator[tuple[str, str]]:
    """Pairs that the acceptor, one insertion and the acceptor of longer words accept together.

    A letter inserted beside its like stands last of them, so each pair has one path; only those with an insertion at
    one of the first ``places`` places count.
    """
    waiting = [(words.root, longer.root, "")]
    while waiting:
        p, q, read = waiting.pop()
        out = longer.arcs[q]
        for symbol, state in out.items():
            for rest in _common(words, p, longer, state, but=symbol):
                yield read + rest, read + symbol + rest
        if len(read) + 1 < places:
            for symbol, state in words.arcs[p].items():
                if symbol in out:
                    waiting.append((state, out[symbol], read + symbol))


def group_pairs(words: list[str], size: int, start: int, stop: int) -> Iterator[tuple[str, str]]:
    """Near pairs of ``words``, of which the shorter one has ``size`` code points, with the edit at a place from ``start`` to before ``stop``.

    All words have ``size`` code points or one more, and the same beginning before ``start`` and end from ``stop`` on.
    """
    short, long = ([w for w in words if len(w) == n] for n in (size, size + 1))
    if not short or len(words) < 2:
        return
    tail = max(size - stop, 0)
    head, end = short[0][:start], short[0][size - tail :]
    machine = Acceptor([w[start : size - tail] for w in short])
    for a, b in substituted(machine):
        yield head + a + end, head + b + end
    if long:
        for a, b in inserted(machine, Acceptor([w[start : size + 1 - tail] for w in long]), stop - start):
            yield head + a + end, head + b + end


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both directions of each near pair, with counts; a group's rows follow one another."""
    rows: list[tuple] = []

    def batch_of():
        kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["word", "near", "n", "near_n"])

    def groups():
        key, held = None, {}
        for batch in batches:
            for *now, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != key:
                    if len(held) > 1:
                        yield key, held
                    key, held = now, {}
                held[word] = n
        if len(held) > 1:
            yield key, held

    for (size, start, stop, *_), held in groups():
        for a, b in group_pairs(list(held), size, start, stop):
            rows += [(a, b, held[a], held[b]), (b, a, held[b], held[a])]
            if len(rows) >= 20_000:
                yield batch_of()
                rows = []
    if rows:
        yield batch_of()


_KEY = ["size", "start", "stop", "head", "tail"]


def _keyed(rows: DataFrame, starts: str) -> DataFrame:
    """Rows (word, n, size) for windows of an array ``starts`` of structs (start, stop), with the ends that the group shares."""
    rows = rows.selectExpr("word", "n", "size", f"inline({starts})")
    return rows.selectExpr("word", "n", "size", "start", "stop", "substring(word, 1, start) as head", "right(word, greatest(size - stop, 0)) as tail")


def windows(words: DataFrame, group: int = GROUP) -> DataFrame:
    """word, n and its groups (size, start, stop, head, tail): every near pair is in one group in which its edit lies in the window.

    A group of more than ``group`` words has a window of one place, and so at most as many words as there are pairs of letters.
    """
    sizes = f"filter(array(length(word) - 1, length(word)), s -> s >= {SHORTEST})"
    halves = "array(named_struct('start', 0, 'stop', (size + 1) div 2), named_struct('start', (size + 1) div 2, 'stop', size + 1))"
    middle = "(start + stop) div 2"
    table = _keyed(words.selectExpr("word", "n", f"explode({sizes}) as size"), halves)
    ready = []
    while True:
        large = table.groupBy(*_KEY).count().where(f"count > {group} and stop - start > 1").drop("count")
        large = written(large)
        if large.isEmpty():
            break
        ready.append(table.join(large, _KEY, "left_anti").select("word", "n", *_KEY))
        halves = f"array(named_struct('start', start, 'stop', {middle}), named_struct('start', {middle}, 'stop', stop))"
        split = table.join(large, _KEY, "left_semi").selectExpr("word", "n", "size", f"{halves} as parts")
        table = written(_keyed(split, "parts"))
    for part in ready:
        table = table.select("word", "n", *_KEY).union(part)
    return table.select(*_KEY, "word", "n")


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """word, near, n, near_n: each ordered pair of ``words`` (word, n; distinct words) that one code point sets apart."""
    placed = windows(words, group).repartition(*_KEY).sortWithinPartitions(*_KEY)
    return placed.mapInArrow(_composed, "word string, near string, n long, near_n long")


def grouped(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """word, form, root, n, n_near, form_n for the words of ``docs`` (doc_id, text).

    A word's form is the most frequent of its near words (the smallest of equally frequent ones), if that is ``RATIO``
    times as frequent as the word, else null; its root is where forms lead in the end, the word itself without a form.

    Null texts have no words, a null id reads as '', each row counts whether repeated or not, other columns are ignored,
    and no rows give no rows. A word has at most 192 near words for each of its places, so none is a crowded key.
    """
    words = written(vocabulary(docs))
    near = near_pairs(words, group).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    named = written(words.join(near, "word", "left").selectExpr("word", "n", "coalesce(n_near, 0L) as n_near", f"if(-best.less >= {RATIO} * n, best, null) as best"))
    roots = named.where("best is not null").selectExpr("word", "best.near as root")
    most = named.agg(F.max("n")).first()[0] or 1
    # a step multiplies the count by RATIO at least, and each round follows twice as many steps
    for _ in range(ceil(log2(max(log10(most), 1)))):
        roots = written(roots)
        further = roots.selectExpr("word as root", "root as further")
        roots = roots.join(further, "root", "left").selectExpr("word", "coalesce(further, root) as root")
    return named.join(roots, "word", "left").selectExpr(
        "word", "best.near as form", "coalesce(root, word) as root", "n", "n_near", "-best.less as form_n"
    )


def grouped_sql() -> str:
    """The same rows in DuckDB SQL; near words share what deleting a code point of one or of both leaves."""
    step = "xor(c >> 1, 3988292384 * (c & 1))"
    table = "i"
    for _ in range(8):
        table = step.replace("c", table) if table == "i" else f"list_transform([{table}], lambda c: {step})[1]"
    byte = "('0x' || substr(h, 2 * p + 1, 2))::BIGINT"
    crc = f"""xor(list_reduce(list_transform(range(length(h) // 2), lambda p: {byte}),
        lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295), 4294967295)"""
    return f"""
    WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: {table}) AS t),
    runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id,
        unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents),
    distinct_runs AS (SELECT run, hex(encode(id || ':' || run)) AS h, count(*) AS n FROM runs WHERE length(run) >= {SHORTEST} GROUP BY id, run),
    marked AS (SELECT run, n, {crc}::BIGINT AS h FROM distinct_runs, crc),
    made AS (SELECT CASE WHEN h % {DAMAGED} = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM marked),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= {SHORTEST} GROUP BY word HAVING sum(n) >= {LEAST}),
    cut AS (SELECT word, n, place, substr(word, 1, place - 1) || substr(word, place + 1) AS rest
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
    near AS (SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.place = b.place AND a.word <> b.word
        UNION SELECT cut.word, words.word, words.n FROM cut JOIN words ON cut.rest = words.word
        UNION SELECT words.word, cut.word, cut.n FROM cut JOIN words ON cut.rest = words.word),
    best AS (SELECT word, count(*) AS n_near, min({{'less': -near_n, 'near': near}}) AS best FROM near GROUP BY word),
    formed AS (SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= {RATIO} * n THEN best END AS best FROM words LEFT JOIN best USING (word)),
    reach(word, root) AS (SELECT word, best.near FROM formed WHERE best IS NOT NULL
        UNION SELECT reach.word, formed.best.near FROM reach JOIN formed ON formed.word = reach.root WHERE formed.best IS NOT NULL),
    ends AS (SELECT reach.word, root FROM reach JOIN formed ON formed.word = reach.root WHERE formed.best IS NULL)
    SELECT formed.word, best.near AS form, coalesce(root, formed.word) AS root, n, n_near, -best.less AS form_n FROM formed LEFT JOIN ends USING (word)"""
