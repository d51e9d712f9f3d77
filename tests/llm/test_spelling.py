"""Spelling variants on small tables: brute force over all pairs, machines of any words, and odd rows."""

from __future__ import annotations

import random
from collections import Counter
from zlib import crc32

import pytest

from tallyloom.llm import spelling

RANDOM = random.Random(6)


def near(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def varied(count: int, alphabet: str = "abé") -> list[str]:
    out = []
    while len(out) < count:
        word = "".join(RANDOM.choices(alphabet, k=RANDOM.randint(7, 14))) if not out or RANDOM.random() < 0.2 else RANDOM.choice(out)
        at = RANDOM.randrange(len(word) + 1)
        word = RANDOM.choice((word[:at] + RANDOM.choice(alphabet) + word[at:], word[:at] + word[at + 1 :], word[:at] + RANDOM.choice(alphabet) + word[at + 1 :]))
        out += [word] * (len(word) >= 7)
    return out


def test_the_machine_is_minimal_and_accepts_its_words_only():
    words = sorted(set(varied(300)) | {""})
    machine = spelling.Acceptor(words)

    def language(state):
        own = {""} if machine.final[state] else set()
        return own | {s + rest for s, after in machine.arcs[state].items() for rest in language(after)}

    assert language(machine.root) == set(words)
    languages = [frozenset(language(s)) for s in range(len(machine.arcs))]
    assert len(set(languages)) == len(languages)  # no two states accept the same


@pytest.mark.parametrize("group", [10**6, 20, 2])
def test_pairs_equal_brute_force_and_come_once(spark, group):
    words = sorted(set(varied(250)) | {"x" * 9, "x" * 10, "x" * 11, "unlike words"[:7]})
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = [(r.word, r.near) for r in spelling.near_pairs(table, group).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in words for b in words if near(a, b)} and len(got) > 400


def test_grouping_equals_brute_force(spark):
    texts = []
    for word in varied(60, "abcdefgh"):
        for form, n in ((word, RANDOM.choice((1, 2, 30, 300))), (word.upper(), 1), (word[:3] + word[4:], 2), ("ß" + word + "×", 1), (word + "中" + word, 1)):
            texts += [form] * n
    texts += ["chainword"] * 500 + ["chainwxrd"] * 35 + ["chaiwxrd"] * 3
    RANDOM.shuffle(texts)
    rows = [(i if i % 9 else None, " 1-2 ".join(texts[i * 40 : i * 40 + 40])) for i in range(len(texts) // 40 + 1)]
    rows += [(7, None), (8, ""), (8, " \n"), (9, texts[0]), (9, texts[0]), (10, f"{texts[0]} " * 20_000)]
    words = Counter()
    for doc_id, text in rows:
        run = ""
        for c in f"{text or ''} ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                cut = h % len(run)
                words[run[:cut] + run[cut + 1 :] if h % 31 == 0 else run] += 1
                run = ""
    words = {w: n for w, n in words.items() if n >= 2 and len(w) >= 7}
    want = {}
    for w, n in words.items():
        others = sorted((-words[o], o) for o in words if near(w, o))
        want[w] = (others[0][1] if others and -others[0][0] >= 10 * n else None, n, len(others))
    schema = "doc_id long, text string, word string, n long, size int, form string"
    table = spark.createDataFrame([(*r, "w", 1, 1, "f") for r in rows], schema).repartition(3)
    got = {r.word: r for r in spelling.grouped(table).collect()}
    assert {w: (r.form, r.n, r.n_near) for w, r in got.items()} == want
    assert sum(f is not None for f, _, _ in want.values()) > 20
    for w, r in got.items():
        root = w
        while want[root][0]:
            root = want[root][0]
        assert r.root == root and r.form_n == (words[r.form] if r.form else None)
    assert any(want[w][0] and want[want[w][0]][0] for w in want)  # forms of forms
    assert spelling.grouped(table.limit(0)).count() == 0
