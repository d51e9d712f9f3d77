"""How far the sources of a language differ in their words, counted by single-pass in-memory indexing.

Each task inverts its documents block by block: postings are built in memory until the block is full, then spilled as a
run, sorted by term and cut by hash into shards. The runs of a shard are merged through a heap into frequencies. Two
sources are compared over all terms without visiting all terms: as if they held none, and then corrected for each term
that one of them holds (by its count alone) and for each term that both hold (streamed from the frequencies).
"""

from __future__ import annotations

import heapq
import pickle
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written

#: A block is full at so many terms in its texts or bytes of text.
BLOCK_TERMS, BLOCK_BYTES = 3_000_000, 32 << 20
#: Entries of a run that are one row of the exchange, and terms returned at once.
CHUNK, ROWS = 1_000, 10_000
#: Pairs of sources that a task adds up before it passes them on, and comparisons made at once.
PAIRS, CELLS = 500_000, 2_000_000
#: p is a share of so many parts.
PARTS = 1_000_000_000

#: ASCII letters in lower case and all bytes of other characters; everything else parts terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


class Numbers(dict):
    """Numbers things from 0 as they are first looked up."""

    def __missing__(self, thing):
        self[thing] = number = len(self)
        return number


@dataclass
class Chunk:
    """Part of a run: for entry i its language, term, documents, and the postings (source, occurrences) from ends[i] to ends[i + 1]."""

    langs: list[bytes]
    terms: list[bytes]
    documents: list[int]
    ends: list[int]
    sources: list[bytes]
    codes: list[int]
    counts: list[int]


class Block:
    """Postings in memory, one for each document and term, with the document's language and source."""

    def __init__(self) -> None:
        self.terms, self.groups, self.held, self.of, self.size, self.bytes = Numbers(), Numbers(), [], [], 0, 0

    def add(self, lang: bytes, source: bytes, text: bytes) -> None:
        terms = terms_of(text)
        self.held.append(np.fromiter(map(self.terms.__getitem__, terms), np.int32, len(terms)))
        self.of.append(self.groups[lang, source])
        self.size += len(terms)
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return self.size >= BLOCK_TERMS or self.bytes >= BLOCK_BYTES

    def run(self, shards: int) -> Iterator[tuple[int, Chunk]]:
        """Chunks of the postings of each shard, summed by source, in order of language and term."""
        words = sorted(self.terms)
        rank = np.empty(len(words), np.int64)
        rank[np.fromiter(map(self.terms.__getitem__, words), np.int64, len(words))] = np.arange(len(words))
        lang_names, source_names = (sorted({group[i] for group in self.groups}) for i in (0, 1))
        place = [{name: i for i, name in enumerate(names)} for names in (lang_names, source_names)]
        lang_of = np.array([place[0][lang] for lang, _ in self.groups], np.int64)
        source_of = np.array([place[1][source] for _, source in self.groups], np.int64)
        width = max(len(source_names), 1)

        lengths = [len(h) for h in self.held]
        term = rank[np.concatenate(self.held)] if self.held else np.zeros(0, np.int64)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        group = np.repeat(np.array(self.of, np.int64), lengths)
        posting, counts = np.unique((lang_of[group] * len(words) + term) * width + source_of[group], return_counts=True)
        once = np.unique(doc * len(words) + term)
        entry, documents = np.unique(lang_of[np.array(self.of, np.int64)[once // max(len(words), 1)]] * len(words) + once % max(len(words), 1), return_counts=True)
        begins = np.searchsorted(posting, entry * width)
        ends = np.append(begins[1:], len(posting))
        shard = np.fromiter(map(crc32, words), np.int64, len(words))[entry % max(len(words), 1)] % shards
        order = np.argsort(shard, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1):
            for start in range(0, len(part), CHUNK):
                some = part[start : start + CHUNK]
                sizes = ends[some] - begins[some]
                stops = np.append(0, np.cumsum(sizes))
                flat = np.repeat(begins[some] - stops[:-1], sizes) + np.arange(stops[-1])
                yield (
                    int(shard[some[0]]),
                    Chunk(
                        [lang_names[i] for i in (entry[some] // len(words)).tolist()],
                        [words[i] for i in (entry[some] % len(words)).tolist()],
                        documents[some].tolist(),
                        stops.tolist(),
                        source_names,
                        (posting[flat] % width).tolist(),
                        counts[flat].tolist(),
                    ),
                )


def _spilled(block: Block, shards: int) -> Iterator[pa.RecordBatch]:
    """The block's run as rows: shard, the first language and term of a chunk, and the chunk."""
    chunks = block.run(shards)
    while part := list(islice(chunks, 50)):
        columns = [[s for s, _ in part], [c.langs[0] for _, c in part], [c.terms[0] for _, c in part], [pickle.dumps(c) for _, c in part]]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["shard", "lang", "first", "chunk"])


def _runs(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    block = Block()
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            for row in zip(*(c.to_pylist() for c in part.columns), strict=True):
                block.add(*row)
                if block.full:
                    yield from _spilled(block, shards)
                    block = Block()
    yield from _spilled(block, shards)


def merged(chunks: Iterable[tuple[int, Chunk]]) -> Iterator[tuple[bytes, bytes, list[tuple[Chunk, int]]]]:
    """Each language and term of the chunks (shard, chunk) once, with its entries (chunk, place); shards one after another.

    Chunks come in order of shard and first entry. One is opened when the merge reaches its first term, so the heap
    holds only the chunks that overlap there.
    """
    heap: list[tuple] = []
    key, entries = None, []
    for number, (shard, chunk) in enumerate(chain(chunks, [(None, None)])):
        first = (shard, chunk.langs[0], chunk.terms[0]) if chunk else None
        while heap and (first is None or heap[0][0] < first):
            now, mark, place, run = heap[0]
            if now != key:
                if key:
                    yield key[1], key[2], entries
                key, entries = now, []
            entries.append((run, place))
            place += 1
            if place < len(run.terms):
                heapq.heapreplace(heap, ((now[0], run.langs[place], run.terms[place]), mark, place, run))
            else:
                heapq.heappop(heap)
        if chunk:
            heapq.heappush(heap, (first, number, 0, chunk))
    if key:
        yield key[1], key[2], entries


_FREQUENCIES = "lang binary, term binary, whole long, sources array<binary>, counts array<long>"


def _frequency_rows(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    def chunks():
        for batch in batches:
            for i in range(batch.num_rows):
                yield batch.column(0)[i].as_py(), pickle.loads(batch.column(3)[i].as_py())

    names = Numbers()

    def batch_of():
        """Postings of ``kept`` summed by term and source."""
        width = max(len(names), 1)
        posting, total = _added(np.array(place, np.int64) * width + np.array(code, np.int64), np.array(count, np.int64))
        ends = np.searchsorted(posting, np.arange(len(kept) + 1) * width)
        flat = pa.array(list(names), pa.binary()).take(pa.array(posting % width))
        arrays = [pa.array(c, pa.binary()) for c in zip(*kept, strict=True)]
        arrays.append(pa.array(np.add.reduceat(total, ends[:-1])))
        arrays += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), x) for x in (flat, pa.array(total))]
        return pa.RecordBatch.from_arrays(arrays, names=["lang", "term", "whole", "sources", "counts"])

    kept: list[tuple[bytes, bytes]] = []
    place: list[int] = []
    code: list[int] = []
    count: list[int] = []
    for lang, term, entries in merged(chunks()):
        if sum(chunk.documents[i] for chunk, i in entries) < least:
            continue
        for chunk, i in entries:
            start, end = chunk.ends[i], chunk.ends[i + 1]
            code += [names[chunk.sources[c]] for c in chunk.codes[start:end]]
            count += chunk.counts[start:end]
            place += [len(kept)] * (end - start)
        kept.append((lang, term))
        if len(kept) >= ROWS or len(place) >= CELLS:
            yield batch_of()
            kept, place, code, count = [], [], [], []
    if kept:
        yield batch_of()


def frequencies(docs: DataFrame, least: int = 3) -> DataFrame:
    """lang, term, whole (its occurrences in the language), sources (those that hold it) and counts (occurrences in each).

    Only terms in at least ``least`` documents of the language; nulls read as ''.
    """
    shards = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    raw = docs.selectExpr(*[f"cast(coalesce(cast(`{c}` as string), '') as binary) as {c}" for c in ("lang", "source", "text")])
    runs = raw.mapInArrow(partial(_runs, shards=shards), "shard int, lang binary, first binary, chunk binary")
    runs = runs.repartition(shards, "shard").sortWithinPartitions("shard", "lang", "first")
    found = runs.mapInArrow(partial(_frequency_rows, least=least), _FREQUENCIES)
    return found.selectExpr("cast(lang as string) as lang", "cast(term as string) as term", "whole", "cast(sources as array<string>) as sources", "counts")


def _p(n: str, total: str, terms: str) -> str:
    """SQL text of 1 + floor(PARTS * (n + 1) / (total + terms)), exact for any long n."""
    return f"1 + cast({PARTS} as decimal(10, 0)) * cast({n} + 1 as decimal(19, 0)) div cast({total} + {terms} as decimal(19, 0))"


def _f(p: str, q: str) -> str:
    return f"(({p} - {q}) * ({p} - {q}) div {q})"


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def shared_corrections(p: np.ndarray, none: np.ndarray) -> np.ndarray:
    """For terms (rows) with equally many holders (columns): what each ordered pair of holders needs beyond both single corrections.

    ``p`` are the holders' shares of the term and ``none`` their shares of a term that they lack.
    """
    a, a0, b, b0 = p[:, :, None], none[:, :, None], p[:, None, :], none[:, None, :]
    return _distance(a, b) - _distance(a, b0) - _distance(a0, b) + _distance(a0, b0)


def _added(pairs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs = pairs[order]
    begins = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1])))
    return pairs[begins], np.add.reduceat(values[order], begins)


def _both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Corrections for terms that two sources hold, added up by (lang, source, item)."""
    sums: dict[tuple, int] = defaultdict(int)

    def batch_of():
        columns = [*zip(*sums, strict=True), sums.values()]
        kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "source", "item", "value"])

    for batch in batches:
        lists = batch.column(1)
        sizes = np.diff(lists.offsets.to_numpy())
        held = lists.flatten()
        langs = batch.column(0).dictionary_encode()
        sources = held.field(0).dictionary_encode()
        code = np.repeat(langs.indices.to_numpy(), sizes).astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
        codes, member = np.unique(code, return_inverse=True)
        p, none = held.field(1).to_numpy(), held.field(2).to_numpy()
        begins = np.cumsum(sizes) - sizes
        for k in np.unique(sizes).tolist():
            rows = begins[sizes == k]
            many = max(1, CELLS // (k * k))
            for start in range(0, len(rows), many):
                cells = rows[start : start + many, None] + np.arange(k)
                wide = max(1, CELLS // k)  # one term of very many holders is compared in strips
                for left in range(0, k, wide):
                    strip = cells[:, left : left + wide]
                    if k <= wide:
                        value = shared_corrections(p[cells], none[cells])
                    else:
                        a, a0, b, b0 = p[strip][:, :, None], none[strip][:, :, None], p[cells][:, None, :], none[cells][:, None, :]
                        value = _distance(a, b) - _distance(a, b0) - _distance(a0, b) + _distance(a0, b0)
                    pair = member[strip][:, :, None] * len(codes) + member[cells][:, None, :]
                    for one, total in zip(*(x.tolist() for x in _added(pair.ravel(), value.ravel())), strict=True):
                        one, other = codes[one // len(codes)], codes[one % len(codes)]
                        if one != other:
                            lang = langs.dictionary[int(one) // len(sources.dictionary)].as_py()
                            names = [sources.dictionary[int(x) % len(sources.dictionary)].as_py() for x in (one, other)]
                            sums[lang, *names] += total
                    if len(sums) >= PAIRS:
                        yield batch_of()
                        sums.clear()
    if sums:
        yield batch_of()


def audited(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from others of its language, and by which terms.

    Part ``pair`` compares a source with each other one of its language over all kept terms, part ``term`` ranks the terms
    that it uses more than the language does, ``top`` at most. Shares are p = 1 + floor(10^9 (n + 1) / (N + V)), a value is
    the sum of floor((p - q)^2 / q), in whole numbers throughout.

    Null languages, sources and texts read as ''; each row is a document, repeated or not; a source without kept terms is
    compared like others; a language without kept terms has value 0 for all its pairs and no terms; ties go to the
    smaller item by bytes; other columns are ignored; no rows give no rows.
    """
    table = written(frequencies(docs, least))
    groups = docs.selectExpr("coalesce(cast(lang as string), '') as lang", "coalesce(cast(source as string), '') as source").distinct()
    named = table.withColumnsRenamed({"sources": "source", "counts": "n"})
    detail = named.selectExpr("lang", "term", "whole", "size(source) as holders", "inline(arrays_zip(source, n))")
    totals = detail.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = table.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("whole").alias("lang_total"))
    stats = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["total", "terms", "lang_total"])
    # a row for each source: small beside the pairs that are returned
    stats = written(stats.selectExpr("*", f"if(terms > 0, {_p('0', 'total', 'terms')}, 1) as none"))

    other = stats.selectExpr("lang", "source as item", "none as item_none")
    pairs = stats.join(other, "lang").where("source <> item").select("lang", "source", "item", "terms", "none", "item_none")
    base = pairs.selectExpr("lang", "source", "item", f"terms * {_f('none', 'item_none')} as value")
    shares = detail.join(stats, ["lang", "source"]).selectExpr("lang", "source", "term", "n", "whole", "holders", "terms", "lang_total", "none", f"{_p('n', 'total', 'terms')} as p")
    counts = written(shares.groupBy("lang", "source", "p").agg(F.count("*").alias("many")))
    mine = counts.join(pairs, ["lang", "source"]).selectExpr("lang", "source", "item", f"many * ({_f('p', 'item_none')} - {_f('none', 'item_none')}) as value")
    theirs = counts.withColumnRenamed("source", "item").join(pairs, ["lang", "item"])
    theirs = theirs.selectExpr("lang", "source", "item", f"many * ({_f('none', 'p')} - {_f('none', 'item_none')}) as value")
    held = shares.where("holders > 1").groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "none")).alias("held"))
    both = held.select("lang", "held").mapInArrow(_both, "lang string, source string, item string, value long")
    values = base.union(mine).union(theirs).union(both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))

    more = shares.selectExpr("lang", "source", "term as item", "p", f"{_p('whole', 'lang_total', 'terms')} as q").where("p > q")
    more = more.selectExpr("lang", "source", "item", f"{_f('p', 'q')} as value")
    rank = "row_number() over (partition by lang, source order by value desc, item) as rank"
    out = values.selectExpr("lang", "source", "'pair' as part", "item", "value", rank)
    return out.union(more.selectExpr("lang", "source", "'term' as part", "item", "value", rank).where(f"rank <= {top}"))


def audited_sql(least: int = 3, top: int = 200) -> str:
    """The same rows in DuckDB SQL, comparing every pair of sources over every term."""
    p = f"1 + ({PARTS}::HUGEINT * ({{n}} + 1)) // ({{total}} + terms)"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        unnest([coalesce(text, '')]) AS text FROM documents),
    words AS (SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
    kept AS (SELECT lang, term, count(*) AS whole FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= {least}),
    sources AS (SELECT DISTINCT lang, source FROM docs),
    langs AS (SELECT lang, count(*) AS terms, sum(whole) AS lang_total FROM kept GROUP BY lang),
    n AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
    cells AS (SELECT s.lang, s.source, k.term, k.whole, coalesce(n.n, 0) AS n FROM sources s JOIN kept k ON s.lang = k.lang
        LEFT JOIN n ON n.lang = s.lang AND n.source = s.source AND n.term = k.term),
    summed AS (SELECT lang, source, sum(n) AS total FROM cells GROUP BY ALL),
    shares AS (SELECT c.lang, c.source, c.term, c.n, {p.format(n="c.n", total="total")} AS p, {p.format(n="c.whole", total="lang_total")} AS q
        FROM cells c JOIN summed USING (lang, source) JOIN langs USING (lang)),
    sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source),
    terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM shares WHERE n > 0 AND p > q)
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
    FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= {top}"""
