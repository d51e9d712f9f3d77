"""Source divergence on small tables: a plain sum over all terms, runs of small blocks, and odd rows."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import divergence

RANDOM = random.Random(5)
SCHEMA = "doc_id long, text string, lang string, source string, n long, term string, whole string"


def plain(rows, least=3, top=200):
    """The rows of the audit by visiting every term for every pair of sources."""
    held, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        words = [w.decode() for w in divergence.terms_of((text or "").encode())]
        held[lang or "", source or ""].update(words)
        documents[lang or ""].update(set(words))
    out = []
    for lang in documents.keys() | {k for k, _ in held}:
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = [s for k, s in held if k == lang]

        def share(counts):
            total = sum(counts[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // total for t in kept}

        p = {s: share(held[lang, s]) for s in sources}
        q = share(sum((held[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(sorted(pairs, key=lambda x: (x[0], x[1].encode())))]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if held[lang, s][t] and p[s][t] > q[t]]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])]
    return sorted(out)


def test_audit_equals_a_sum_over_all_terms(spark):
    words = ["".join(RANDOM.choices("abcdeé", k=RANDOM.randint(1, 4))) for _ in range(60)]
    rows = [(" ".join(RANDOM.choices(words, k=RANDOM.randint(0, 80))), RANDOM.choice(["x", "y", None]), f"s{i % 7}") for i in range(160)]
    rows += [("Alpha alpha-BETA 3gamma ÉÀ", "x", "hot")] * 60 + [(None, "x", "no text"), ("", "lonely", None), (None, None, None), ("alpha " * 30_000, "y", "long")]
    table = spark.createDataFrame([(i, *r, 1, "t", "w") for i, r in enumerate(rows)], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in divergence.audited(table).collect())
    assert got == plain(rows)
    assert divergence.audited(table.limit(0)).count() == 0
    assert sorted(tuple(r) for r in divergence.audited(table, least=1, top=3).collect()) == plain(rows, 1, 3)
    # no term is in a million documents: pairs have value 0, in order of names
    assert {(r.part, r.value) for r in divergence.audited(table, least=10**6).collect()} == {("pair", 0)}


@pytest.mark.parametrize("size", [1, 7, 50, 10**6])
def test_runs_of_any_size_merge_into_the_same_frequencies(monkeypatch, size):
    monkeypatch.setattr(divergence, "CHUNK", 3)
    docs = [(RANDOM.choice([b"x", b"y"]), RANDOM.choice([b"a", b"b", b"c"]), " ".join(RANDOM.choices("pqrstuvwé", k=RANDOM.randint(0, 9))).encode()) for _ in range(60)]
    chunks, block = [], divergence.Block()
    for doc in docs:
        block.add(*doc)
        if block.size >= size:
            chunks += block.run(4)
            block = divergence.Block()
    chunks += block.run(4)
    chunks.sort(key=lambda c: (c[0], c[1].langs[0], c[1].terms[0]))
    got, seen = Counter(), set()
    for lang, term, entries in divergence.merged(chunks):
        assert (lang, term) not in seen
        seen.add((lang, term))
        got[lang, term, None] = sum(c.documents[i] for c, i in entries)
        for c, i in entries:
            for code, n in zip(c.codes[c.ends[i] : c.ends[i + 1]], c.counts[c.ends[i] : c.ends[i + 1]], strict=True):
                got[lang, term, c.sources[code]] += n
    want = Counter()
    for lang, source, text in docs:
        want.update((lang, t, source) for t in divergence.terms_of(text))
        want.update((lang, t, None) for t in set(divergence.terms_of(text)))
    assert got == want


def test_strips_of_many_holders_add_up(monkeypatch):
    import pyarrow as pa

    held = [[{"source": f"s{j}", "p": 10 + i * j, "none": 3 + j} for j in range(RANDOM.randint(2, 12))] for i in range(20)]
    kind = pa.list_(pa.struct([("source", pa.string()), ("p", pa.int64()), ("none", pa.int64())]))
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 20), pa.array(held, kind)], names=["lang", "held"])
    want = Counter()
    for row in held:
        for a in row:
            for b in row:
                if a != b:
                    f = lambda p, q: (p - q) ** 2 // q
                    want[a["source"], b["source"]] += f(a["p"], b["p"]) - f(a["p"], b["none"]) - f(a["none"], b["p"]) + f(a["none"], b["none"])
    for cells, pairs in ((2_000_000, 10**6), (5, 10**6), (30, 4)):
        monkeypatch.setattr(divergence, "CELLS", cells)
        monkeypatch.setattr(divergence, "PAIRS", pairs)
        got = Counter()
        for out in divergence._both(iter([batch])):
            for row in out.to_pylist():
                got[row["source"], row["item"]] += row["value"]
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}
    assert np.array_equal(divergence.terms_of(b"A1bC\xc3\x89 d"), [b"a", b"bc\xc3\x89", b"d"])
