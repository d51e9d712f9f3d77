"""Every stage of the corpus pipeline against a plain version on the small tables, and on odd rows with clashing columns."""

from __future__ import annotations

import random
import zlib
from itertools import combinations

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

import corpus_pipeline
from tallyloom.llm import language, quality
from tallyloom.llm.queries import learnable, table, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
RANDOM = random.Random(12)


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, FOLDER, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r for r in docs.collect()}


def kept(spark, docs, number):
    return sorted(r.doc_id for r in corpus_pipeline.STAGES[number][1](spark, docs, FOLDER).select("doc_id").collect())


def test_quality_keeps_what_a_dense_discriminant_keeps(spark, docs, texts):
    labels = {r.doc_id: r.label for r in learnable(table(spark, FOLDER, "labels"), "quality", 5, 0).collect()}
    rows = {i: np.array(quality.statistics(r.text)) for i, r in texts.items()}
    x = np.array([rows[i] for i in labels if i in rows])
    y = np.array([labels[i] for i in labels if i in rows])
    centre, scale = x.mean(axis=0), np.sqrt(np.maximum(x.var(axis=0), 1e-6))
    z = (x - centre) / scale
    covariances = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = np.diag(np.diag(sum((y == c).sum() * covariances[c] for c in (0, 1)) / len(y)))

    def log_density(row, c):
        cov = (1 - quality.SHRINKAGE) * covariances[c] + quality.SHRINKAGE * pooled + quality.FLOOR * np.eye(len(row))
        off = row - z[y == c].mean(axis=0)
        return np.log(((y == c).sum() + 1) / (len(y) + 2)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * off @ np.linalg.inv(cov) @ off

    score = {}
    for i, row in rows.items():
        ratio = log_density((row - centre) / scale, 1) - log_density((row - centre) / scale, 0)
        score[i] = 1 / (1 + np.exp(-np.clip(ratio, -500, 500)))
    assert kept(spark, docs, 0) == sorted(i for i, s in score.items() if s >= corpus_pipeline.QUALITY)
    model = quality.fit(docs, learnable(table(spark, FOLDER, "labels"), "quality", 5, 0))
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert got == pytest.approx(score, abs=1e-6)


def test_language_keeps_what_direct_compression_keeps(spark, docs, texts):
    model = language.fit(docs.where("crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0"))
    want = []
    for i, r in texts.items():
        plain = language.letters(r.text)
        if not any(c.isalpha() for c in r.text or ""):
            continue
        sizes = []
        for content in model.contents:
            size = 0
            for start in range(0, len(plain), language.PART):
                one = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                packer = zstandard.ZstdCompressor(level=language.LEVEL, dict_data=one, write_checksum=False, write_content_size=False, write_dict_id=False)
                size += len(packer.compress(plain[start : start + language.PART]))
            sizes.append(size)
        one, two = sorted(sizes)[:2]
        if 1 - one / two >= language.NARROW:
            want.append(i)
    assert kept(spark, docs, 1) == sorted(want)


def test_near_copies_keeps_the_smallest_of_each_group(spark, docs, texts):
    copies = [(10_000 + i, " ".join(r.text.split()[: int(len(r.text.split()) * share)])) for (i, r), share in zip(list(texts.items())[:40], [0.95, 0.85, 0.7, 1] * 10, strict=True)]
    more = spark.createDataFrame(copies, "doc_id long, text string").selectExpr("doc_id", "text", "'en' as lang", "'s' as source", "1L as n_chars")
    everything = docs.unionByName(more)
    sets = {}
    for r in everything.collect():
        words = r.text.encode().lower().split()
        sets[r.doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in sets}
    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if v == old else v for k, v in root.items()}
    assert kept(spark, everything, 2) == sorted(i for i, r in root.items() if i == r)
    assert len(set(root.values())) < len(root) - 20


def test_benchmark_drops_documents_with_passages(spark, docs, texts):
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]

    def tokens(text):
        return [w.decode() for w in (text or "").encode().lower().split()]

    sample = docs.where("doc_id < 60").collect()
    rows = []
    for k, r in enumerate(sample):
        words = r.text.split()
        if k % 3 == 0:
            words[len(words) // 2 : 0] = []
            words = [*words[:20], *RANDOM.choice(items)[1].split(), *words[20:]]
        rows.append((r.doc_id, " ".join(words), r.lang, r.source, r.n_chars))
    table_of = spark.createDataFrame(rows, docs.schema)
    windows = {}
    for _, text in items:
        words = tokens(text)
        if len(words) >= 13:
            for i in range(len(words) - 12):
                windows[tuple(words[i : i + 13])] = True
    exact = {i for i, text, *_ in rows if any(tuple(w[j : j + 13]) in windows for w in [tokens(text)] for j in range(len(w) - 12))}
    left = set(kept(spark, table_of, 3))
    assert not left & exact and len(exact) >= len(rows) // 3 - 2
    assert len(left) >= len(rows) - len(exact) - 5  # clean documents stay


def test_packing_as_a_stage_loses_no_token(spark, docs, texts):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = corpus_pipeline.into_sequences(spark, docs, FOLDER).collect()
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    for i, r in texts.items():
        ids = [*tokenizer.encode(r.text, add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            cut = np.array(ids[start : start + 4096], "<u4")
            got = pieces.pop((i, piece))
            assert (got.start, got.length, got.ids_crc32) == (start, len(cut), zlib.crc32(cut.tobytes()))
    assert not pieces
    places: dict = {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(r.length for r in rows)
    assert len(places) <= 1.02 * total / 4096 + 2


def test_odd_rows_and_clashing_columns_in_every_stage(spark, docs):
    clash = ["score", "rejected", "lang_pred", "label", "row", "__text", "key", "node", "hashes", "component_id", "kept", "n", "words", "piece", "held"]
    few = docs.where("doc_id < 30")
    odd = few.union(few.limit(2)).union(spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0), (900, None, "en", "s", None), (901, "½ ²", None, "", 1), (902, "word " * 60_000, "en", "s", 1)], docs.schema))
    odd = odd.select("*", *[F.lit("x").alias(c) for c in clash])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, FOLDER)
        assert out.columns == odd.columns, name
        assert out.count() <= odd.count() and out.exceptAll(odd).count() == 0, name
        assert stage(spark, odd.limit(0), FOLDER).count() == 0
    assert corpus_pipeline.into_sequences(spark, odd, FOLDER).selectExpr("count(distinct sequence_id)").first()[0] > 0
    assert language.sizes("½ ²", language.Languages(("en",), (b"a",))) is None
