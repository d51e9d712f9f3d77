"""Language identification by compression: the dictionary that makes the text smallest names its language."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import add_columns

#: At most so many documents of a language are learned from, and so many bytes from each and for each dictionary.
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 2_000, 110_000
#: Bytes compressed at once, so that the dictionary counts in each part of a long text.
PART = 2_048
LEVEL = 12
#: Relative margins of a narrow decision.
NARROW = 0.004
_OTHER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """Lower-cased letters, with one space for everything between them."""
    return _OTHER.sub(" ", (text or "").lower()).strip().encode("utf-8", "replace")


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    contents: tuple[bytes, ...]


def sampled(docs: DataFrame) -> DataFrame:
    """lang, rank and part of the documents that ``fit`` learns from; ``docs`` have a language and letters.

    Hashes are aggregated once: counting and choosing them read one shuffle. Nothing is written, as a file for each
    partition of few hashes takes some processes each on a file system that sets permissions by commands.
    """
    parts = docs.withColumn("place", F.xxhash64("text"))
    # the middle of each text
    parts = parts.withColumn("part", F.expr(f"substring(text, greatest(1, length(text) div 2 - {SAMPLE_BYTES // 2}), {SAMPLE_BYTES})"))
    plain = F.trim(F.regexp_replace(F.lower("part"), r"[^\p{L}\p{Nl}\p{No}]+", " "))
    # only hashes are made distinct and ranked; the chosen parts, of a bounded number, are fetched afterwards
    places = parts.groupBy("lang", F.xxhash64(plain).alias("letters")).agg(F.min("place").alias("place"))
    # hashes are spread evenly: those below a bound hold the smallest ones of each language, and are few for any number of documents
    bound = f"{-(2.0**63)!r}d + {2.0**64!r}d * {4 * SAMPLE_DOCS} / n"
    known_sizes = places.groupBy("lang").agg(F.count("place").alias("n"))  # count("*") would need a shuffle of its own
    places = places.join(F.broadcast(known_sizes), "lang").where(f"n <= {4 * SAMPLE_DOCS} or cast(place as double) <= {bound}")
    order = Window.partitionBy("lang").orderBy("place")
    chosen = places.withColumn("rank", F.row_number().over(order)).where(f"rank <= {SAMPLE_DOCS}").select("lang", "place", "rank")
    return parts.join(F.broadcast(chosen), ["lang", "place"]).groupBy("lang", "rank").agg(F.min("part").alias("part"))


def fit(docs: DataFrame) -> Languages:
    """Learns a raw-content dictionary for each value of ``lang`` from ``docs`` (doc_id, text, lang).

    The sample is bounded: for each language ``SAMPLE_DOCS`` documents, those with the smallest hash of their text among
    documents whose middle ``SAMPLE_BYTES`` characters have different letters, and ``SAMPLE_BYTES`` bytes of each. Copies
    take one place, however many there are. Rows without a language or without letters are left out.
    """
    known = docs.where("lang is not null and text rlike '\\\\p{L}'").select(F.col("lang").cast("string"), F.col("text").cast("string"))
    sample = sampled(known)
    found: dict[str, list[bytes]] = {}
    for row in sample.orderBy("lang", "rank").toLocalIterator():
        found.setdefault(row.lang, []).append(letters(row.part)[:SAMPLE_BYTES])
    rows = known.groupBy("lang").count().collect()  # a row for each language
    names = tuple(r.lang for r in sorted(rows, key=lambda r: (-r["count"], r.lang)))
    # the compressor reaches the end of a dictionary best; distinct parts only
    return Languages(names, tuple(b" ".join(dict.fromkeys(found[n]))[-DICTIONARY_BYTES:] for n in names))


@lru_cache(maxsize=1)
def _compressors(model: Languages) -> list[zstandard.ZstdCompressor]:
    out = []
    for content in model.contents:
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        out.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=dictionary, write_checksum=False, write_content_size=False, write_dict_id=False
            )
        )
    return out


def batch_sizes(texts: Sequence[str | None], model: Languages) -> list[np.ndarray | None]:
    """Compressed size of each whole text under each language; None without letters.

    A language takes all parts of all texts before the next one does: its tables stay in the processor's cache, which
    those of all languages together do not fit.
    """
    cut, bounds = [], [0]
    for text in texts:
        plain = letters(text)
        if plain and any(map(str.isalpha, text)):
            cut += [plain[i : i + PART] for i in range(0, len(plain), PART)]
        bounds.append(len(cut))
    ends = np.zeros((len(cut) + 1, len(model.names)), np.int64)
    for column, compressor in enumerate(_compressors(model)):
        ends[1:, column] = np.cumsum([len(part) for part in map(compressor.compress, cut)])
    return [(ends[end] - ends[start]).astype(float) if end > start else None for start, end in pairwise(bounds)]


def sizes(text: str | None, model: Languages) -> np.ndarray | None:
    """Compressed size of the whole text under each language; None without letters."""
    return batch_sizes([text], model)[0]


def _batch(batch: pa.RecordBatch, model: Languages, text: int) -> Iterator[dict]:
    names, scores, rejected = [], [], []
    texts = batch.column(text).to_pylist()
    for found in batch_sizes(texts, model) if model.names else [None] * len(texts):
        if found is None:
            names.append("und"), scores.append(0.0), rejected.append(True)
            continue
        order = np.argsort(found, kind="stable")
        margin = 1 - found[order[0]] / found[order[1]] if len(order) > 1 else 1.0
        names.append(model.names[order[0]])
        scores.append(1 - np.exp(-20 * margin))
        rejected.append(margin < NARROW)
    yield {"lang_pred": names, "score": scores, "rejected": rejected}


def identified(docs: DataFrame, model: Languages, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, lang_pred, score (0 to 1, from the margin) and rejected (narrow margin or ``und``) for each row of ``docs``.

    The prediction is ``und`` for a null text, one without letters, and all texts if no language was learned. Equal sizes
    go to the language with more documents and are narrow. Each repeated row and each null id returns a row.
    """
    return add_columns(docs, keep, "text", partial(_batch, model=model), "lang_pred string, score double, rejected boolean")
