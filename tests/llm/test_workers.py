"""What Python workers do and keep: words encoded once, one dictionary at a time, one worker a task."""

from __future__ import annotations

import pyarrow as pa
import zstandard
from tokenizers import Tokenizer

import corpus_pipeline
from tallyloom.llm import common, language, packing, quality
from tallyloom.llm.queries import tokenizer_path

ODD = "Sea \x01 a\x01b \x1c.x y\x85z it's <|ENDOFTEXT|> <|endoftext|>x J\u030c\u2028 \u0130\u03a3. \x01\x01 12½\xa0k".split(" ")
TEXTS = [None, "", " \t\n", " ".join(ODD), "Sea\fsea\vSea, the sea.", "sea " * 200, *(f"Word{i} other{i}" for i in range(300))]


def test_words_get_the_ids_of_their_texts_and_are_encoded_once_in_a_worker(monkeypatch):
    plain = Tokenizer.from_file(tokenizer_path())
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    encoder = packing.Encoder(tokenizer_path(), remembered=5)
    for _ in range(2):
        assert [list(memoryview(ids).cast("I")) for ids in encoder.token_bytes(pa.array(TEXTS))] == want
    assert len(encoder.known) == 5

    calls, ids = [], packing.Encoder._ids
    monkeypatch.setattr(packing.Encoder, "_ids", lambda self, texts: calls.append(len(texts)) or ids(self, texts))
    batch = pa.record_batch({"doc_id": pa.array(range(len(TEXTS)), pa.int64()), "text": pa.array(TEXTS)})
    packing._kept_encoder.cache_clear()
    first, again = ([b.to_pylist() for b in packing._piece_batches(iter([batch]), tokenizer_path(), 1, 64, 10_000, True)] for _ in range(2))
    before = len(calls)
    assert next(iter([again])) == first and len(calls) == before > 0
    packing._kept_encoder.cache_clear()
    assert [b.to_pylist() for b in packing._piece_batches(iter([batch]), tokenizer_path(), 1, 64, 10_000, False)] == first
    assert packing._kept_encoder.cache_info().currsize == 0


def test_a_language_compresses_a_whole_batch_before_the_next(monkeypatch):
    model = language.Languages(("xx", "yy", "zz"), tuple(" ".join(w * 3 + str(i) for i in range(500)).encode() for w in ("ab", "cd", "ef")))
    texts = ["ababab cdcdcd " * 400, None, "½", "", "ef", *(f"abab{'cd' * i} efef" for i in range(20))]
    want = []
    for text in texts:
        cut = [language.letters(text)[i : i + language.PART] for i in range(0, len(language.letters(text)), language.PART)]
        cut = cut if any(map(str.isalpha, text or "")) else []
        want.append([sum(len(c.compress(p)) for p in cut) for c in language._compressors(model)] if cut else None)
    seen, made = [], language._compressors(model)

    class Noted:
        def __init__(self, number: int, compressor: zstandard.ZstdCompressor) -> None:
            self.number, self.compressor = number, compressor

        def compress(self, part: bytes) -> bytes:
            seen.append(self.number)
            return self.compressor.compress(part)

    monkeypatch.setattr(language, "_compressors", lambda _: [Noted(n, c) for n, c in enumerate(made)])
    names = [n for found in language._batch(pa.record_batch({"text": pa.array(texts)}), model, 0) for n in found["lang_pred"]]
    assert seen == sorted(seen) and len(seen) % 3 == 0
    assert names == ["und" if w is None else model.names[w.index(min(w))] for w in want]
    assert [f if f is None else f.tolist() for f in language.batch_sizes(texts, model)] == want


def test_quality_runs_one_python_step_in_a_stage(spark, monkeypatch):
    plans, plain = [], quality.map_batches

    def noted(df, function, schema):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return plain(df, function, schema)

    monkeypatch.setattr(quality, "map_batches", noted)
    docs = spark.createDataFrame([(i, "Some words. " * (i + 1), i % 2) for i in range(20)], "doc_id long, text string, label int")
    quality.fit(docs.select("doc_id", "text"), docs.select("doc_id", "label"))
    assert len(plans) == 2 and not any("MapInArrow" in plan for plan in plans)


def test_stages_hand_python_small_batches(spark, folder):
    def shapes(batches):
        for batch in batches:
            yield pa.record_batch({"rows": pa.array([batch.num_rows], pa.int64()), "bytes": pa.array([batch.nbytes], pa.int64())})

    limits = {f"spark.sql.execution.arrow.max{k}PerBatch": spark.conf.get(f"spark.sql.execution.arrow.max{k}PerBatch") for k in ("Records", "Bytes")}
    rows = spark.range(0, 5_000, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 100) as text", "'en' as lang", "'s' as source", "1L as n_chars")
    wide = spark.range(0, 200, 1, 1).selectExpr("repeat('x', 100000) as text")
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "benchmark":  # runs no Python
                continue
            for key, value in limits.items():
                spark.conf.set(key, value)
            stage(spark, rows.limit(20), folder)
            seen = [r.rows for r in rows.mapInArrow(shapes, "rows long, bytes long").collect()]
            assert sum(seen) == 5_000 and max(seen) <= common.ROWS_AT_ONCE, name
            assert max(r.bytes for r in wide.mapInArrow(shapes, "rows long, bytes long").collect()) <= 2 * common.BYTES_AT_ONCE, name
        spark.conf.set(next(iter(limits)), 10)
        common.small_batches(spark)
        assert spark.conf.get(next(iter(limits))) == "10"  # lower limits stay
    finally:
        for key, value in limits.items():
            spark.conf.set(key, value)


def test_a_kept_text_reaches_python_once(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")

    def seen(batch, text):
        yield {"score": [float(batch.num_columns)] * batch.num_rows, "texts": batch.column(text)}

    for keep, columns in ((["doc_id", "text"], 2), (["text", "doc_id"], 2), (["doc_id"], 2), (["doc_id", "TEXT"], 3)):
        out = common.add_columns(docs, keep, "text", seen, "score double, texts string").orderBy("doc_id").collect()
        assert [(r.doc_id, r.score, r.texts) for r in out] == [(1, columns, "a b"), (2, columns, None)]
    number = docs.select("doc_id", docs.doc_id.alias("text"))  # a text that is no string is kept and cast apart
    out = common.add_columns(number, ["doc_id", "text"], "text", seen, "score double, texts string").orderBy("doc_id").collect()
    assert [(r.text, r.score, r.texts) for r in out] == [(1, 3, "1"), (2, 3, "2")]
