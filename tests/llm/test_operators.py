"""Each operator on small literal tables: edge cases of its docstring, and brute force where SQL can't say the result."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import decontamination, language, licenses, neighbours, packing, pages, quality, sharding, toxicity
from tallyloom.llm.common import shared_folder
from tallyloom.llm.near_duplicates import near_duplicates, shingle_hashes
from tallyloom.llm.queries import tokenizer_path

DOCS = "doc_id long, text string, lang string, tokens string, hash string, n long"
RANDOM = random.Random(3)
WORDS = ["".join(RANDOM.choices("abcdefgh", k=RANDOM.randint(2, 6))) for _ in range(400)]


def prose(n: int) -> str:
    return " ".join(RANDOM.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null id, null and empty text, blanks, a repeated row, a very long text; columns with names that operators use inside."""
    long_text = prose(30_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "Alpha beta gamma."), (4, "Alpha beta gamma."), (None, "Alpha beta gamma."), (5, long_text), (6, "...")]
    return spark.createDataFrame([(i, t, "en", "x", "y", 1) for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_shards_hold_every_row_once_and_grow_into_the_new_one(spark, odd, none):
    shards, more = dict.fromkeys(range(16), 1.0), dict.fromkeys(range(17), 1.0)
    many = spark.range(3000).selectExpr("id as doc_id", "cast(id as string) as text").union(spark.range(2500).selectExpr("7", "'same'"))
    rows = sharding.shard_documents(many, shards, more).collect()
    assert len(rows) == 5500
    for shard in range(16):
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert {r.grown_shard for r in rows if r.grown_shard != r.shard} == {16}
    assert 100 < sum(r.grown_shard == 16 for r in rows if r.text_crc32 != zlib.crc32(b"same")) < 260
    got = sharding.shard_documents(odd, shards, more).collect()
    assert len(got) == odd.count() and {(r.size, r.text_crc32) for r in got if r.doc_id in (1, 2)} == {(1, 0)}
    assert sharding.shard_documents(none, shards, more).count() == 0
    heavy = sharding.placed(spark.range(4000), "id", {0: 1.0, 1: 3.0}).where("shard = 1").count()
    assert 2850 < heavy < 3150


def test_leaks_with_substitutions_are_found_as_by_brute_force(spark, odd, none):
    items = [(i, prose(RANDOM.choice((9, 14, 30)))) for i in range(12)] + [(50, "too short"), (51, None), (None, prose(20))]
    docs = []
    for i in range(60):
        words = prose(80).split()
        if i % 2:
            inside = items[i % 12][1].split()
            for _ in range(i % 5):
                inside[RANDOM.randrange(len(inside))] = "zzz"
            words[40:40] = inside
        docs.append((i, " ".join(words).upper()))
    want = set()
    for d, text in docs:
        a = text.lower().split()
        for k, item in items:
            b = (item or "").split()
            if k is None or len(b) < 8:
                continue
            w = min(13, len(b))
            starts = [(x, y) for x in range(len(a) - w + 1) for y in range(len(b) - w + 1)]
            if any(sum(p == q for p, q in zip(a[x : x + w], b[y : y + w], strict=True)) >= w - w * 2 // 13 for x, y in starts):
                want.add((d, k))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.leaks(table, benchmark)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == want and len(want) > 15
    assert decontamination.leaks(odd, benchmark).count() == 0
    assert decontamination.leaks(none, benchmark).count() == 0
    assert decontamination.leaks(table, benchmark.limit(0)).count() == 0


def test_licence_places_and_notices(spark, odd, none):
    text = "x ALL rights\nreserved. " + prose(200) + " Released under the MIT License. all rights reserved"
    rows = {r.doc_id: r for r in licenses.scanned(spark.createDataFrame([(1, text), (2, "cc-by é")], "doc_id long, text string")).collect()}
    assert rows[1].places == [1, 209] and rows[1].labels.count("mit") >= 1 and rows[1].n_words == 212
    assert rows[2].place_labels == ["cc-by"] and rows[2].n_words == 3
    assert [r.n_words for r in licenses.scanned(odd).orderBy("n_words").collect()] == [0, 0, 0, 0, 3, 3, 3, 30_000]
    assert licenses.scanned(none).count() == 0


def test_notices_are_found_at_every_word_position(spark):
    items = licenses.templates()
    found = licenses.index(items, dict.fromkeys({w for t in items for w in t.words}, 1))
    notice = "licensed under the terms of the gnu lesser general public license"
    for offset in range(24):
        words = licenses.words_of("x " * offset + notice + " y" * 30)
        assert "lgpl" in {items[b[0]].label for b in licenses.matches(words, found)}, offset
    pool = sorted({w for t in items for w in t.words} | {b"x", b"y", b"z"})
    some = 0
    for _ in range(400):
        words = RANDOM.choices(pool, k=RANDOM.randint(1, 20))
        for item in RANDOM.choices(items, k=2):
            inside = list(item.words)
            for _ in range(RANDOM.randint(0, len(inside))):
                inside.insert(RANDOM.randrange(len(inside) + 1), RANDOM.choice(pool))
            words += inside + RANDOM.choices(pool, k=RANDOM.randint(0, 20))
        want = {}
        for number, item in enumerate(items):
            size, tokens = 2 * len(item.words), set(item.words)
            best = max(len(tokens & set(words[s : s + size])) / len(tokens) for s in range(len(words)))
            if best >= item.share - 1e-9:
                want[number] = best
        got: dict = {}
        for number, start, end, share in licenses.matches(words, found):
            tokens = set(items[number].words)
            assert share == len(tokens & set(words[start:end])) / len(tokens) and end - start <= 2 * len(items[number].words)
            got[number] = max(share, got.get(number, 0))
        assert got == want
        some += bool(want)
    assert some > 100


def test_toxic_pairs_score_higher(spark, odd, none):
    rows = [(i, f"{prose(20)} {'grub' if i % 2 else ''} {'folk' if i % 3 else ''}", int(i % 2 and i % 3 > 0)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    score = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert np.mean([score[i] for i, _, y in rows if y]) > 0.8 > 0.3 > np.mean([score[i] for i, _, y in rows if not y])
    assert all(0 <= r.score <= 1 for r in toxicity.scored(odd, model).collect()) and toxicity.scored(none, model).count() == 0
    blank = toxicity.fit(none, docs.select("doc_id", "label"))
    assert {round(r.score, 6) for r in toxicity.scored(odd, blank).collect()} == {0.5}


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, odd, none, width):
    rows = []
    for base in range(12):
        words = prose(120).split()
        for copy in range(8):
            changed = list(words)
            for _ in range(copy * 2 % 11):
                changed[RANDOM.randrange(120)] = RANDOM.choice(WORDS)
            rows.append((len(rows), " ".join(changed)))
    rows += [(len(rows) + k, rows[k][1].upper()) for k in range(5)]
    sets = {i: set(shingle_hashes(t, width).tolist()) for i, t in rows}
    name = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(name[i], name[j]), min(name[i], name[j])
                name = {k: new if v == old else v for k, v in name.items()}
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()
    assert {r.doc_id: r.component_id for r in got} == name and all(r.kept == (r.doc_id == r.component_id) for r in got)
    edge = near_duplicates(odd, width).collect()
    assert len(edge) == odd.count() and {(r.doc_id, r.component_id, r.n_shingles) for r in edge if r.doc_id in (1, 2, 3)} == {(k, k, 0) for k in (1, 2, 3)}
    assert [r.component_id for r in edge if r.doc_id is None] == [None]
    assert near_duplicates(none, width).count() == 0


def test_main_text(spark):
    site = "<nav><a>Menu</a></nav><div class='cookie-notice'>We use</div><p>Site line</p>{}<p>Imprint</p><div id=comments><p>Nice!</p></div>"
    rows = [
        (1, "http://a.b/x/1", "<html><body><header>Top</header><article><h1>T &amp; x</h1><p>One\n two<br>three</article><footer>F</footer>"),
        (2, "http://a.b/y/1", site.format("<p>Own <b>wor</b>ds</p>")),
        (3, "http://a.b/y/2", site.format("<p>Other words</p>")),
        (4, None, None),
        (5, "http://c.d/", ""),
        (5, "http://c.d/", ""),
    ]
    got = [(r.page_id, r.text) for r in pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    assert sorted(got) == [(1, "T & x One two three"), (2, "Own words"), (3, "Other words"), (4, ""), (5, ""), (5, "")]
    assert pages.shared_lines(list("abcxd"), list("zabd")) == {0, 1, 4}
    assert pages.extracted(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_every_page_without_marks_is_differenced(spark):
    def page(own):
        return f"<p>Site line</p><p>{own}</p><p>Imprint</p>"

    rows = [(i, "http://a.b/hot", page(f"hot {i}")) for i in range(300)] + [(300, "http://a.b/hot", page("hot 0"))]
    rows += [(400, "http://a.b/z", page("end")), (401, "http://a.b/z", page("end")), (402, "http://a.b/z", page("end"))]
    rows += [(500 + i, f"http://c.d/index.php?id={i}", page(f"item {i}")) for i in range(40)]
    rows += [(600 + i, f"e.f/{i}", page(f"bare {i}")) for i in range(2)]
    rows += [(700 + i, f"http://g.h/same?ref={i}", page("copy")) for i in range(30)] + [(800, "http://g.h/tail", page("tail"))]
    rows += [(900, None, page("no url"))]
    want = {i: html.replace("<p>Site line</p><p>", "").replace("</p><p>Imprint</p>", "") for i, _, html in rows}
    want[900] = "Site line no url Imprint"
    for ranges in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = pages.extracted(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
        finally:
            spark.conf.unset("spark.sql.shuffle.partitions"), spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want


def test_packing_keeps_every_token_and_fills_well(spark, odd, none):
    rows = packing.pack_documents(odd, tokenizer_path(), length=64).collect()
    texts = {r.doc_id: r.text for r in odd.collect()}
    from tokenizers import Tokenizer

    encoded = Tokenizer.from_file(tokenizer_path())
    for doc, text in texts.items():
        ids = [*encoded.encode(text or "", add_special_tokens=False).ids, 1]
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == doc})
        want = [(p, a, len(ids[a : a + 64]), zlib.crc32(np.array(ids[a : a + 64], "<u4").tobytes())) for p, a in enumerate(range(0, len(ids), 64))]
        assert mine == want
    bins: dict = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 64
    assert packing.pack_documents(none, tokenizer_path()).count() == 0
    # the smallest piece makes room for two that fit better
    assert sorted(sorted(np.array([60, 30, 20, 19])[b].tolist()) for b in packing.best_two_fit(np.array([60, 30, 20, 19]), 100)) == [[19, 20, 60], [30]]


def test_quality_discriminant(spark, odd, none):
    rows = [(i, prose(60).capitalize() + "." if i % 3 else "!! ".join(prose(60).upper().split()), int(i % 3 > 0)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    score = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert all((score[i] >= 0.3) == bool(y) for i, _, y in rows)
    assert all(0 <= r.score <= 1 for r in quality.scored(odd, model).collect()) and quality.scored(none, model).count() == 0
    blank = quality.fit(none, docs.select("doc_id", "label"))
    assert {round(r.score, 6) for r in quality.scored(odd, blank).collect()} == {0.5}


def test_neighbours_reach_recall_and_survive_odd_vectors(spark):
    random = np.random.default_rng(1)
    data = random.normal(size=(1500, 8))
    data[200:700] = data[200]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(2000, None), (2100, [0.0] * 8), (2200, [float("nan")] * 8), (2300, [1.0] * 3), (None, [1.0] * 8), (2400, [None] + [1.0] * 7)]
    got = neighbours.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id % 100 = 0").collect()
    hits = 0
    for q in range(0, 1500, 100):
        distance = np.sqrt(((data - data[q]) ** 2).sum(axis=1))
        order = [i for i in np.lexsort((np.arange(1500), distance)) if i != q][:10]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11)) and np.allclose([m[2] for m in mine], [distance[m[1]] for m in mine])
        hits += len({m[1] for m in mine} & set(order))
    assert hits >= 0.9 * 150 and len(got) == 150
    assert neighbours.neighbours(spark.createDataFrame([], "vec_id long, embedding array<float>"), "true").count() == 0


def test_a_repeated_id_takes_one_place_among_equal_vectors(spark):
    rows = [(1, [1.0, 2.0])] * 15 + [(i, [1.0, 2.0]) for i in (2, 3, 4)] + [(i, [float(i), -1.0]) for i in range(50, 90)] + [(100, [1.0, 2.0])]
    got = neighbours.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id = 100").collect()
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)][:4] == [(i, 0.0) for i in (1, 2, 3, 4)]


def test_language_by_compression(spark, odd, none):
    words = [a + b for a, b in zip(WORDS, WORDS[1:], strict=False)]  # long enough for a compressor's shortest match
    other = [w[::-1] + "ö" for w in words]
    rows = [(i, " ".join(RANDOM.choices(other if i % 2 else words, k=50)), "xx" if i % 2 else "yy") for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs.where("doc_id < 80"))
    got = {r.doc_id: r for r in language.identified(docs, model).collect()}
    right = [got[i].lang_pred == lang for i, _, lang in rows if i >= 80]
    assert sum(right) >= 0.95 * len(right) and all(0 <= r.score <= 1 for r in got.values())
    edge = language.identified(odd, model).collect()
    assert {r.lang_pred for r in edge if r.doc_id in (1, 2, 3, 6)} == {"und"} and len(edge) == odd.count()
    assert {r.lang_pred for r in language.identified(odd, language.fit(none)).collect()} == {"und"}


def test_copies_take_one_place_of_the_language_sample(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 12)
    texts = [prose(20) for _ in range(9)]
    rows = [(text, "xx") for text in texts] + [(f"{text.upper()}!" if n % 2 else text, "xx") for text in texts for n in range(30)]
    model = language.fit(spark.createDataFrame([(1, *r) for r in rows], "doc_id long, text string, lang string"))
    content = model.contents[model.names.index("xx")]
    assert all(content.count(language.letters(text)) == 1 for text in texts)
    more = [prose(20) for _ in range(40)]
    rows += [(text, "xx") for text in more]
    content = language.fit(spark.createDataFrame([(1, *r) for r in rows], "doc_id long, text string, lang string")).contents[0]
    assert sum(content.count(language.letters(text)) for text in texts + more) == 12


def test_the_language_sample_is_aggregated_once_and_writes_no_file(spark, tmp_path, monkeypatch):
    def files() -> int:
        return sum(len(found) for _, _, found in os.walk(shared_folder(spark).removeprefix("file://")))

    monkeypatch.setattr(language, "SAMPLE_DOCS", 5)  # so that the bound of the hashes cuts
    texts = {lang: [prose(8) for _ in range(60)] for lang in ("xx", "yy")} | {"zz": [prose(8) for _ in range(3)]}
    rows = [(text, lang) for lang, some in texts.items() for text in some for _ in range(2)]
    spark.createDataFrame(rows, "text string, lang string").write.parquet(str(tmp_path / "t"))
    docs, before = spark.read.parquet(str(tmp_path / "t")), files()
    model = language.fit(docs)
    assert files() == before and model.names == ("xx", "yy", "zz")
    order = docs.distinct().orderBy("lang", F.xxhash64("text")).collect()
    want = {lang: [r.text for r in order if r.lang == lang][:5] for lang in texts}
    assert model.contents == tuple(" ".join(want[lang]).encode() for lang in model.names)
    sample = language.sampled(docs)
    assert sorted(tuple(r) for r in sample.collect()) == [(lang, n, t) for lang in model.names for n, t in enumerate(want[lang], 1)]
    plan = sample._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in plan and "Exchange hashpartitioning(lang" in plan


def test_pipeline_stages_keep_columns_and_clean_documents(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert kept.join(docs, docs.columns, "left_anti").count() == 0
        assert stage(spark, docs.limit(0), folder).count() == 0
    repeated = docs.limit(20).union(docs.limit(20)).withColumn("text", F.lit("some words that are all the same in here"))
    assert corpus_pipeline.without_near_copies(spark, repeated, folder).count() == 1
