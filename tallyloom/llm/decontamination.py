"""Benchmark passages in training text, by spaced-seed hashing with DataFrame operations only.

A mask picks five tokens of a short span and ignores the others; equal picks in a document and in a benchmark item
propose an alignment, which is verified on the whole windows around it. The two masks hit every window of 13 aligned
tokens with up to two substitutions, and every item of 8 to 12 tokens with one, so no overlap of that kind is lost.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written

WINDOW, SUBSTITUTIONS, SHORTEST = 13, 2, 8
MASKS = ((0, 1, 2, 4, 5), (0, 1, 2, 3, 4))
SPANS = tuple(max(m) + 1 for m in MASKS)
#: Tokens around a seed's first one that windows with this seed can reach.
LEFT, RIGHT = WINDOW - 1, WINDOW - 1 + max(SPANS)
#: Benchmark seeds broadcast at once: rows of at most 8 * (LEFT + RIGHT) + 100 bytes, so some 40 MB.
BLOCK_ROWS = 120_000


def tokens_sql(column: str) -> str:
    """Token hashes of a text: runs of letters and digits, lower-cased; none for a null text."""
    words = f"filter(split(lower(cast({column} as string)), '[^\\\\p{{L}}\\\\p{{N}}]+'), w -> w <> '')"
    return f"transform(coalesce({words}, cast(array() as array<string>)), w -> xxhash64(w))"


def seeds(table: DataFrame) -> DataFrame:
    """A row for each position and mask of ``table`` (with an array ``tokens``): pos and seed are added."""
    parts = []
    for number, (mask, span) in enumerate(zip(MASKS, SPANS, strict=True)):
        picked = ", ".join(f"get(tokens, pos + {offset})" for offset in mask)
        parts.append(f"if(pos + {span} <= size(tokens), xxhash64({number}, {picked}), cast(null as bigint))")
    # the outer form keeps the optimizer from testing, and so computing, the tokens once more before
    placed = table.withColumn("pos", F.expr(f"explode_outer(if(size(tokens) >= {min(SPANS)}, sequence(0, size(tokens) - {min(SPANS)}), null))"))
    return placed.select("*", F.expr(f"stack({len(MASKS)}, {', '.join(parts)}) as seed")).where("seed is not null")


def benchmark_seeds(benchmark: DataFrame) -> DataFrame:
    """seed, item_id, item_pos, item_size and the item's tokens around the seed; equal items count as the smallest id."""
    items = benchmark.select(F.col("item_id").cast("long"), F.expr(f"{tokens_sql('text')} as tokens"))
    items = items.where(f"item_id is not null and size(tokens) >= {SHORTEST}").groupBy("tokens").agg(F.min("item_id").alias("item_id"))
    return seeds(items).selectExpr(
        "seed",
        "item_id",
        "pos as item_pos",
        "size(tokens) as item_size",
        f"slice(tokens, greatest(pos - {LEFT}, 0) + 1, {LEFT + RIGHT}) as around",
    )


def _verified(hits: DataFrame) -> DataFrame:
    """Of seed hits, those with a window that has few enough substitutions; windows stay inside both texts."""
    left, right = f"least({LEFT}, item_pos, pos)", f"least({RIGHT}, item_size - item_pos, size(tokens) - pos)"
    hits = hits.where(f"{left} + {right} >= least({WINDOW}, item_size)").selectExpr(
        "doc_id",
        "item_id",
        f"pos - {left} as base",
        f"least({WINDOW}, item_size) as width",
        f"slice(tokens, pos - {left} + 1, {left} + {right}) as mine",
        f"slice(around, least({LEFT}, item_pos) - {left} + 1, {left} + {right}) as other",
    )
    same = "zip_with(mine, other, (x, y) -> cast(x = y as int))"
    hits = hits.selectExpr("doc_id", "item_id", "base", "width", f"width - width * {SUBSTITUTIONS} div {WINDOW} as need", f"{same} as same")
    counted = "transform(sequence(0, size(same) - width), s -> aggregate(slice(same, s + 1, width), 0, (t, x) -> t + x))"
    hits = hits.selectExpr("doc_id", "item_id", "base", "width", "need", f"{counted} as counts")
    # unfolded, not filtered: a filter on the windows would be drawn into the join and run for every token
    windows = hits.selectExpr("doc_id", "item_id", "base", "width", "need", "posexplode_outer(counts) as (start, matched)")
    return windows.where("matched >= need").selectExpr("doc_id", "item_id", "matched", "base + start as first", "base + start + width - 1 as last")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, matched, first_token, last_token for each document and benchmark item that share a passage.

    A passage is a window of 13 tokens, aligned without gaps, of which 11 at least are equal; for items of 8 to 12
    tokens the whole item with one substitution. ``matched`` is the largest number of equal tokens in a window, the
    token positions (from 0) are the ends of what all such windows cover in the document. Shorter items match nothing,
    nor do null texts; equal items are reported under their smallest item_id; repeated documents with one doc_id give
    one row for all; a null doc_id is reported as null. Other columns are ignored.

    The documents are never shuffled: the benchmark's seeds are broadcast in blocks of ``BLOCK_ROWS`` rows, as many
    blocks as it needs. Hits are verified in the task that finds them, and combined before the one small shuffle.
    """
    index = written(benchmark_seeds(benchmark))
    blocks = max(1, -(-index.count() // BLOCK_ROWS))
    tokens = docs.select(F.col("doc_id").cast("long"), F.expr(f"{tokens_sql('text')} as tokens"))
    found = []
    for block in range(blocks):
        part = index if blocks == 1 else _block(index, block, blocks)
        found.append(_verified(seeds(tokens).join(F.broadcast(part), "seed")))
    return (
        reduce(DataFrame.union, found)
        .groupBy("doc_id", "item_id")
        .agg(
            F.max("matched").cast("long").alias("matched"),
            F.min("first").cast("long").alias("first_token"),
            F.max("last").cast("long").alias("last_token"),
        )
    )


def _block(index: DataFrame, block: int, blocks: int) -> DataFrame:
    """Rows of equal share, also where many items have one seed in common."""
    return index.where(f"pmod(xxhash64(seed, item_id, item_pos), {blocks}) = {block}")


def leaks_sql() -> str:
    """The same result in DuckDB SQL from all aligned pairs of equal tokens, without seeds."""
    words = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '')"
    return f"""
    WITH item_words AS (SELECT min(item_id) AS item_id, words FROM (SELECT item_id, {words} AS words FROM benchmark WHERE text IS NOT NULL)
      WHERE len(words) >= {SHORTEST} GROUP BY words),
    item AS (SELECT item_id, len(words) AS item_size, unnest(words) AS word, unnest(range(len(words))) AS item_pos FROM item_words),
    doc AS (SELECT doc_id, len(words) AS doc_size, unnest(words) AS word, unnest(range(len(words))) AS pos
      FROM (SELECT doc_id, {words} AS words FROM documents WHERE text IS NOT NULL)),
    equal AS (SELECT doc_id, item_id, pos - item_pos AS diagonal, pos, item_pos, item_size, doc_size,
        least({WINDOW}, item_size) AS width FROM doc JOIN item USING (word)),
    dense AS (SELECT doc_id, item_id, diagonal, any_value(item_size) AS item_size, any_value(doc_size) AS doc_size, any_value(width) AS width,
        list(pos) AS positions FROM equal GROUP BY doc_id, item_id, diagonal HAVING count(*) >= any_value(width - width * {SUBSTITUTIONS} // {WINDOW})),
    windows AS (SELECT *, unnest(range(greatest(0, diagonal), least(item_size + diagonal, doc_size) - width + 1)) AS start FROM dense),
    counted AS (SELECT *, len(list_filter(positions, lambda p: p >= start AND p < start + width)) AS matched FROM windows)
    SELECT doc_id, item_id, max(matched)::BIGINT AS matched, min(start)::BIGINT AS first_token, max(start + width - 1)::BIGINT AS last_token
    FROM counted WHERE matched >= width - width * {SUBSTITUTIONS} // {WINDOW} GROUP BY doc_id, item_id"""
