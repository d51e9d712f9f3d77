"""Near-duplicate documents by HyperMinHash sketches, exact on full shingle sets.

A sketch has 60 functions of 4 buckets. A shingle's hash under a function picks the bucket by its top two bits; the
bucket keeps the smallest hash, stored as the count of its leading zeros and ten bits after the first one (16 bits,
0 for an empty bucket). A band joins the four registers of one function with three of the next, so documents that
share a fraction J of their shingles agree in a band with a chance of about J^7. Bands overlap, so a pair at J = 0.8
misses all 60 with a chance of 1.5e-5 (5e-6 at 0.81), and this is the method's only source of loss.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import map_batches, mixed, perhaps_among, random_words, written
from tallyloom.llm.links import components

FUNCTIONS, BUCKETS, FOLLOWING, MANTISSA = 60, 4, 3, 10
REGISTERS = FUNCTIONS * BUCKETS
#: Pairs whose estimate is below the threshold by this much are not verified: almost six standard errors of 240 registers.
SLACK = 0.15
#: Documents of a group in which all open pairs are compared, and holders of a shingle up to which it is joined by itself.
SMALL_GROUP, RARE = 64, 200
#: Shingles hashed at once; bounds the memory of a task, whatever the lengths of texts.
CHUNK = 400_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles of ``width`` words (ASCII case ignored).

    A shorter text that has words is one shingle; without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width_used = min(width, len(codes))
    with np.errstate(over="ignore"):
        total = np.full(len(codes) - width_used + 1, width_used, np.uint64)
        for k in range(width_used):
            total = mixed(total * np.uint64(0x9E3779B97F4A7C15) + codes[k : len(codes) - width_used + 1 + k])
    return np.unique(total)


def _register(least: np.ndarray) -> np.ndarray:
    """Smallest hashes below 2^62 as 16-bit registers; larger ones mark empty buckets and become 0."""
    full = least < np.uint64(1 << 62)
    value = np.where(full, least, np.uint64(1))
    # a float's exponent counts the leading zeros; rounding up at a power of two alters both documents alike
    high = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    zeros = 62 - high
    shift = high - 1 - MANTISSA
    tail = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(np.uint64), value << np.maximum(-shift, 0).astype(np.uint64))
    packed = ((zeros + 1) << MANTISSA) | (tail.astype(np.int64) & ((1 << MANTISSA) - 1))
    return np.where(full, packed, 0).astype(np.uint16)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of registers for each set of hashes; the empty set has empty buckets only."""
    out = np.zeros((len(sets), REGISTERS), np.uint16)
    factors, masks = random_words(FUNCTIONS, 11) | np.uint64(1), random_words(FUNCTIONS, 12)
    full = [i for i, s in enumerate(sets) if len(s)]
    start = 0
    while start < len(full):
        end, size = start, 0
        while end < len(full) and (end == start or size + len(sets[full[end]]) <= CHUNK):
            size += len(sets[full[end]])
            end += 1
        rows = full[start:end]
        hashes = np.concatenate([sets[i] for i in rows])
        begins = np.concatenate(([0], np.cumsum([len(sets[i]) for i in rows])[:-1]))
        with np.errstate(over="ignore"):
            for f in range(FUNCTIONS):
                values = (hashes ^ masks[f]) * factors[f]
                values ^= values >> np.uint64(32)
                values *= factors[f]
                for b in range(BUCKETS):  # flipping the top bits makes bucket b the smallest one
                    least = np.minimum.reduceat(values ^ np.uint64(b << 62), begins)
                    out[rows, f * BUCKETS + b] = _register(least)
        start = end
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A signed 64-bit key for each row and band; each function's buckets and some of the next function's."""
    grouped = registers.reshape(len(registers), FUNCTIONS, BUCKETS).astype(np.uint64)
    following = np.roll(grouped, -1, axis=1)
    with np.errstate(over="ignore"):
        key = np.tile(random_words(FUNCTIONS, 13), (len(registers), 1))
        for part in (*(grouped[:, :, b] for b in range(BUCKETS)), *(following[:, :, b] for b in range(FOLLOWING))):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + part)
    return key.view(np.int64)


def estimated(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard estimates from registers, less the agreements that compressed registers reach by chance."""
    used = (left > 0) | (right > 0)
    same = ((left == right) & used).sum(axis=1)
    ratio = np.minimum(n_left, n_right) / np.maximum(np.maximum(n_left, n_right), 1)
    # chance of a collision of two unrelated registers with r mantissa bits: 0.1699 * 4x / (1 + x)^2 / 2^r
    chance = used.sum(axis=1) * 0.169919487 * 4 * ratio / (1 + ratio) ** 2 / 2**MANTISSA
    count = used.sum(axis=1)
    return np.where(count > 0, np.clip((same - chance) / np.maximum(count - chance, 1e-9), 0, 1), 0.0)


def _sketch_batch(batch: pa.RecordBatch, width: int) -> Iterator[dict]:
    ids, texts = batch.column(0), batch.column(1)
    for start in range(0, len(texts), 500):
        sets = [shingle_hashes(t, width) for t in texts.slice(start, 500).to_pylist()]
        yield {
            "doc_id": ids.slice(start, 500),
            "n_shingles": [len(s) for s in sets],
            "set_key": [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets],
            "registers": [row.tobytes() for row in sketches(sets)],
        }


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key (equal sets have equal keys; null for the empty set), registers."""
    return map_batches(
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")),
        partial(_sketch_batch, width=width),
        "doc_id long, n_shingles long, set_key binary, registers binary",
    )


def _band_batch(batch: pa.RecordBatch) -> Iterator[dict]:
    ids = batch.column(0).to_numpy(zero_copy_only=False)
    for start in range(0, len(ids), 2000):
        raw = b"".join(batch.column(1).slice(start, 2000).to_pylist())
        keys = band_keys(np.frombuffer(raw, np.uint16).reshape(-1, REGISTERS))
        yield {"key": keys.ravel(), "doc": np.repeat(ids[start : start + len(keys)], FUNCTIONS)}


def _estimate_batch(batch: pa.RecordBatch, least: float) -> Iterator[dict]:
    for start in range(0, batch.num_rows, 5000):
        part = batch.slice(start, 5000)
        left, right = (np.frombuffer(b"".join(part.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
        n_left, n_right = (part.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (4, 5))
        kept = np.flatnonzero(estimated(left, right, n_left, n_right) >= least)
        yield {"a": part.column(0).take(pa.array(kept)), "b": part.column(1).take(pa.array(kept))}


def _set_batch(batch: pa.RecordBatch, width: int) -> Iterator[dict]:
    for start in range(0, batch.num_rows, 500):
        texts = batch.column(1).slice(start, 500).to_pylist()
        yield {"node": batch.column(0).slice(start, 500), "hashes": [shingle_hashes(t, width).view(np.int64) for t in texts]}


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """node and its full set of hashes, for the documents of ``nodes`` (node); other texts are not shuffled."""
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    wanted = perhaps_among(texts, "node", nodes).join(nodes.distinct(), "node").dropDuplicates(["node"])
    sets = map_batches(wanted, partial(_set_batch, width=width), "node long, hashes array<long>")
    return written(sets.where("size(hashes) > 0"))


def _verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Of candidate pairs (a, b), those whose full sets meet the threshold; estimates come first."""
    side = classes.select("node", "n_shingles", "registers")
    for end in ("a", "b"):
        pairs = pairs.join(side.toDF(end, f"n_{end}", f"r_{end}"), end)
    # sizes alone rule out some pairs exactly
    pairs = pairs.where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
    likely = written(
        map_batches(
            pairs.select("a", "b", "r_a", "r_b", "n_a", "n_b"),
            partial(_estimate_batch, least=percent / 100 - SLACK),
            "a long, b long",
        )
    )
    ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    sets = _sets(docs, ends, width)
    for end in ("a", "b"):
        likely = likely.join(sets.toDF(end, f"set_{end}"), end)
    return written(
        likely.withColumn("both", F.size(F.array_intersect("set_a", "set_b")))
        .where(f"100 * both >= {percent} * (size(set_a) + size(set_b) - both)")
        .select("a", "b")
        .distinct()
    )


def _left_apart(crowded: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of one bucket in different components that may still be linked.

    A bucket's members outside its largest component meet all others of the bucket. The buckets with one largest component
    form a group. In a group of many documents a link needs common shingles, and those with few holders in the group are
    joined by themselves: other pairs can share no more than what remains of the smaller one, its core.
    """
    placed = crowded.join(labels.withColumnRenamed("node", "doc"), "doc", "left").selectExpr("key", "doc", "hub", "coalesce(label, doc) as label")
    open_keys = placed.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key")
    open_keys = open_keys.agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1")
    apart = placed.join(open_keys.select("key", "main"), "key").join(classes.selectExpr("node as doc", "n_shingles as n"), "doc")
    apart = written(apart)
    members = written(apart.select("main", "doc", "label", "n").distinct())
    sizes = members.groupBy("main").agg(F.count("*").alias("size"))
    large = written(members.join(sizes.where(f"size > {SMALL_GROUP}").select("main"), "main"))

    flat = large.select("main", "doc").join(_sets(docs, large.select(F.col("doc").alias("node")).distinct(), width).withColumnRenamed("node", "doc"), "doc")
    flat = written(flat.selectExpr("main", "doc", "explode(hashes) as hash"))
    rare = flat.groupBy("main", "hash").agg(F.count("*").alias("holders")).where(f"holders <= {RARE}")
    rare = written(flat.join(rare, ["main", "hash"]))
    core = rare.groupBy("main", "doc").agg(F.count("*").alias("few"))
    core = written(large.join(core, ["main", "doc"], "left").selectExpr("main", "doc", "label", "n", "n - coalesce(few, 0) as core"))

    needed = f"{100 + percent} * {{}} >= {percent} * (n + x_n)"
    ends = ("least(x, doc) as a", "greatest(x, doc) as b")
    # places in buckets; in groups of few documents all of the shorter one counts as core
    known = apart.join(core.select("main", "doc", "core"), ["main", "doc"], "left").selectExpr("key", "doc", "hub", "label", "main", "n", "coalesce(core, n) as core")
    known = known.join(apart.groupBy("key").agg(F.min("n").alias("least_n")), "key").where(f"{100 + percent} * core >= {percent} * (n + least_n)")
    # a pair is settled by any bucket that both are in, so it meets in the one of the smallest key only
    places = known.groupBy("doc").agg(F.sort_array(F.collect_set("key")).alias("keys"))  # one key of each band at most
    known = written(known.drop("least_n").join(places, "doc"))
    minor = known.where("label <> main").selectExpr("key", "doc as x", "label as x_label", "n as x_n", "core as x_core", "keys as x_keys")
    inside = minor.join(known, "key").where(
        "label <> x_label and (label = main or x < doc) and x <> hub and doc <> hub and " + needed.format("least(core, x_core)")
        + " and key = array_min(array_intersect(keys, x_keys))"
    )
    holders = rare.where("hash is not null").join(core, ["main", "doc"])
    other = holders.selectExpr("main", "hash", "doc as x", "label as x_label", "n as x_n", "core as x_core")
    sharing = holders.join(other, ["main", "hash"]).where("x < doc and label <> x_label")
    sharing = sharing.groupBy("main", "x", "doc", "n", "x_n", "core", "x_core").agg(F.count("*").alias("both"))
    sharing = sharing.where(needed.format("(least(core, x_core) + both)"))
    return inside.selectExpr(*ends).union(sharing.selectExpr(*ends)).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text; other columns are ignored).

    Two documents are linked when 100 * |A & B| >= percent * |A | B| for their sets of ``width``-word shingles; a
    component is what links reach, named by its smallest doc_id; ``kept`` marks that document.

    Equal sets form a class first, and only its smallest document goes on. Each bucket of a band compares its members
    with one hub, the member whose buckets are fullest, so a group of m near copies costs some m links and not m * m. Pairs of one
    bucket that are then still in different components are compared one by one, but for those whose numbers of common shingles
    cannot suffice; so no link is lost.

    Null and empty texts have no shingles and are components of their own; a null doc_id takes no part and has a null
    component. Repeated rows each return a row. ``doc_id`` should name one text; rows that repeat it with another text
    may end in one component. An empty table gives an empty result.
    """
    table = written(sketched(docs, width))
    real = table.where("doc_id is not null and set_key is not null")
    node = F.min_by("registers", "doc_id").alias("registers")
    classes = written(real.groupBy("set_key").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), node))
    bands = map_batches(classes.select("node", "registers"), _band_batch, "key long, doc long")

    buckets = bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    crowded = written(bands.join(buckets, "key"))
    # a document that keeps most of what its group has in common shares buckets with most of the group
    weight = crowded.groupBy("doc").agg(F.sum("n").alias("weight"))
    hubs = crowded.join(weight, "doc").groupBy("key").agg(F.max_by("doc", F.struct("weight", "doc")).alias("hub"))
    crowded = written(crowded.drop("n").join(hubs, "key"))
    star = crowded.where("doc <> hub").selectExpr("least(doc, hub) as a", "greatest(doc, hub) as b").distinct()
    links = _verified(star, classes, docs, width, percent)
    labels = written(components(links))

    rest = _left_apart(crowded, labels, classes, docs, width, percent)
    more = _verified(rest, classes, docs, width, percent)
    if not more.isEmpty():
        labels = written(components(links.union(more)))

    named = classes.join(labels, "node", "left").selectExpr("set_key", "coalesce(label, node) as component")
    return (
        table.select("doc_id", "n_shingles", "set_key")
        .join(named, "set_key", "left")
        .withColumn("component_id", F.expr("if(doc_id is null, null, coalesce(component, doc_id))"))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def near_duplicates_sql(percent: int) -> str:
    """Components for two-word shingles in DuckDB SQL: every pair that shares a shingle is counted."""
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
    WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split(translate({lowered}, {blanks}, repeat(' ', 6)), ' '), lambda w: w <> '') AS w
        FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
        WHEN len(w) = 1 THEN w ELSE [] END AS shingles FROM words),
    classes AS (SELECT list_sort(shingles) AS s, min(doc_id) AS node, any_value(len(shingles)) AS n FROM sets WHERE len(shingles) > 0 GROUP BY 1),
    flat AS (SELECT node, n, unnest(s) AS shingle FROM classes),
    shared AS (SELECT x.node AS a, y.node AS b, x.n AS na, y.n AS nb, count(*) AS c FROM flat x JOIN flat y
        ON x.shingle = y.shingle AND x.node < y.node AND 100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n) GROUP BY ALL),
    links AS (SELECT a, b FROM shared WHERE 100 * c >= {percent} * (na + nb - c)),
    both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(node, root) AS (SELECT DISTINCT a, a FROM both_ways UNION SELECT both_ways.b, reach.root FROM reach JOIN both_ways ON reach.node = both_ways.a
        WHERE reach.root < both_ways.b),
    roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node),
    placed AS (SELECT sets.doc_id, len(sets.shingles)::BIGINT AS n_shingles, coalesce(roots.root, classes.node, sets.doc_id) AS component_id
        FROM sets LEFT JOIN classes ON len(sets.shingles) > 0 AND list_sort(sets.shingles) = classes.s LEFT JOIN roots ON roots.node = classes.node)
    SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM placed"""
